"""Image directory scan into the pixel table, and its sink (S5, J1, F10, DM13/DM14).

Spark's image source decodes each file (unreadable files dropped with
``dropInvalid``) into ``(origin, height, width, nChannels, mode, data)``;
the bytes become grey values per Arrow batch, then one row per pixel.
"""

from __future__ import annotations

import os
import re
import struct
import uuid
import zlib
from contextlib import contextmanager

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, IntegerType

from tessera.session import default_parallelism, scratch_path

#: Images of one folder that a job lists, writes or reads: what the driver holds
#: of them (paths, file states, tasks) follows this number, not the images.
FOLDER_FILES = 8192
PART = "images_part"


@F.pandas_udf(ArrayType(IntegerType()))
def grey_values(data: pd.Series, channels: pd.Series) -> pd.Series:
    """Row-major grey values from decoded bytes (BGR -> grey with the usual
    fixed-point weights 0.114 B + 0.587 G + 0.299 R, rounded)."""
    out = []
    for buf, c in zip(data, channels):
        a = np.frombuffer(buf, dtype=np.uint8).astype(np.int64)
        if c == 1:
            out.append(a.astype(np.int32))
        else:
            px = a.reshape(-1, c)
            g = (px[:, 0] * 1868 + px[:, 1] * 9617 + px[:, 2] * 4899 + 8192) >> 14
            out.append(g.astype(np.int32))
    return pd.Series(out)


@F.pandas_udf(BinaryType())
def png_bytes(values: pd.Series, height: pd.Series, width: pd.Series) -> pd.Series:
    """Grey PNG file of row-major values 0..255; null without values, or where
    their number is not height times width."""
    def chunk(kind, body):
        return struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))

    def one(v, h, w):
        if v is None or pd.isna(h) or pd.isna(w) or not h * w or len(v) != h * w:
            return None
        rows = np.zeros((int(h), int(w) + 1), np.uint8)          # every row begins with its filter, 0
        rows[:, 1:] = np.asarray(v, np.uint8).reshape(int(h), int(w))
        return (b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">2I5B", int(w), int(h), 8, 0, 0, 0, 0))
                + chunk(b"IDAT", zlib.compress(rows.tobytes())) + chunk(b"IEND", b""))
    return pd.Series([one(*r) for r in zip(values, height, width)])


def write_images(images: DataFrame, path: str) -> None:
    """One file per row of ``(filename, content)`` in a folder that carries its
    name, for ``scan_images(..., named=True)``.

    Every file ends with one line break behind the content, which image readers
    pass over. Rows without a name or content are not written. Names must be
    unique: equal ones may share a file, of which readers see the first image.
    More than FOLDER_FILES images are dealt over folders by a hash of the name.

    In a folder of the file system that executors share by its path, the tasks
    put the files there themselves (``_put_files``): Spark's sink starts a process
    for each folder and each file there, to set its mode. In any other store
    Spark's sink writes them, a folder at a time.
    """
    spark = images.sparkSession
    rows = images.where(F.col("filename").isNotNull() & F.col("content").isNotNull())
    parts = -(-images.where(F.col("filename").isNotNull()).count() // FOLDER_FILES)
    part = F.pmod(F.xxhash64("filename"), F.lit(parts))
    fs, root = _file_system(spark, path)
    if fs.getScheme() == "file":
        fs.delete(root, True)
        fs.mkdirs(root)
        folder = F.lit("") if parts <= 1 else F.concat(F.lit(f"{PART}="), part, F.lit("/"))
        _put_files(rows.select("filename", F.col("content").cast("binary").alias("content"), folder.alias("folder")), root.toUri().getPath())
        return
    rows = rows.select("filename", F.col("content").cast("string").alias("value"))
    if parts <= 1:
        rows.write.mode("overwrite").partitionBy("filename").text(path)
        return
    held = scratch_path(spark, "image-rows")
    rows.withColumn(PART, part).write.partitionBy(PART).parquet(held)
    fs.delete(root, True)
    for one_part in _parts(spark, held):
        with _small_files(spark):
            one = spark.read.schema(rows.schema).parquet(f"{held}/{one_part}")
            one.write.partitionBy("filename").text(f"{path}/{one_part}")


def _put_files(rows: DataFrame, root: str) -> None:
    """Write ``(filename, content, folder)`` below ``root``, a file each.

    Equal names come to one task, one after the other, so the first is the one
    written. A file appears under its name when it is whole, and a task that runs
    again puts the same files in the place of those it left.
    """
    special = r"""[\x01-\x1f"#%'*/:=?\\\x7f{\[\]^]"""      # what Spark's sink escapes in a folder's name

    def put(batches):
        last, mine = None, f".{uuid.uuid4().hex}"
        for batch in batches:
            for name, content, folder in zip(*(c.to_pylist() for c in batch.columns)):
                if name == last:
                    continue
                last, escaped = name, re.sub(special, lambda c: f"%{ord(c[0]):02X}", name)
                at = f"{root}/{folder}filename={escaped or '__HIVE_DEFAULT_PARTITION__'}"
                os.makedirs(at, exist_ok=True)
                with open(f"{at}/{mine}", "wb") as f:
                    f.write(content + b"\n")
                os.replace(f"{at}/{mine}", f"{at}/part-00000.txt")
            yield pa.RecordBatch.from_pydict({"files": pa.array([batch.num_rows], pa.int64())})

    n = default_parallelism(rows.sparkSession)
    dealt = rows.repartition(n, "filename").sortWithinPartitions("filename")
    dealt.mapInArrow(put, "files long").agg(F.sum("files")).collect()


def _file_system(spark: SparkSession, path: str):
    root = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), root


def _parts(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders that ``path`` is dealt over; none if it is one folder."""
    fs, root = _file_system(spark, path)
    found = fs.globStatus(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root, f"{PART}=*"))
    return sorted(f.getPath().getName() for f in found or ())


@contextmanager
def _small_files(spark: SparkSession):
    """Folders of small files are listed and read by few tasks, and what was
    listed is not kept when the job is done. The image source makes a projection
    for each file: interpreted, as generating code for it takes milliseconds."""
    wanted = {"spark.sql.files.openCostInBytes": str(64 << 10), "spark.sql.hive.filesourcePartitionFileCacheSize": "0",
              "spark.sql.codegen.factoryMode": "NO_CODEGEN",
              "spark.sql.sources.parallelPartitionDiscovery.parallelism": str(default_parallelism(spark))}
    had = {k: spark.conf.get(k, None) for k in wanted}
    try:
        for k, v in wanted.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in had.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def scan_images(spark: SparkSession, path: str, named: bool = False) -> DataFrame:
    """``(filename, image_id, y, x, v, height, width)`` for every image.

    ``filename`` is the path below ``path`` (``named``: the name that the file's
    folder carries, as ``write_images`` lays them out) and ``image_id`` a hash of
    it, so equal names in two folders are two images. Each file is read and
    decoded once; the name goes along with its pixels. Folders that
    ``write_images`` has dealt are read one by one into a table of images.
    """
    root = re.sub(r"^[A-Za-z][A-Za-z0-9+.-]*:(?://[^/]*)?", "", path.rstrip("/"))

    def unescaped(c):
        return F.url_decode(F.replace(c, F.lit("+"), F.lit("%2B")))

    origin = unescaped(F.col("image.origin"))          # the source gives paths as URIs
    if named:                                          # folders escape some characters of their own
        name = unescaped(F.regexp_extract(origin, "filename=([^/]*)/[^/]*$", 1))
    else:
        name = F.substring(origin, F.instr(origin, root) + len(root) + 1, F.length(origin))

    def decoded(folder):
        return (spark.read.format("image").option("dropInvalid", True).option("recursiveFileLookup", True).load(folder)
                .select(name.alias("filename"), F.col("image.height").alias("height"), F.col("image.width").alias("width"),
                        grey_values("image.data", "image.nChannels").alias("vals")))

    parts = _parts(spark, path) if named else []
    if parts:
        kept = scratch_path(spark, "images")
        for part in parts:
            with _small_files(spark):
                one = decoded(f"{path}/{part}")
                one.write.mode("append").parquet(kept)
        img = spark.read.schema(one.schema).parquet(kept)
    else:
        img = decoded(path)
    px = img.select("filename", "height", "width", F.posexplode("vals").alias("pos", "v"))
    return px.select("filename", F.xxhash64("filename").alias("image_id"), (F.col("pos") / F.col("width")).cast("int").alias("y"),
                     (F.col("pos") % F.col("width")).cast("int").alias("x"), "v", "height", "width")


def pair_with_masks(images: DataFrame, masks: DataFrame) -> DataFrame:
    """Image pixels with their mask value, for images that have a mask file of
    the same relative path (inner join on path and position; J1, F10)."""
    m = masks.select("filename", "y", "x", F.col("v").alias("mask"))
    return images.join(m, ["filename", "y", "x"])
