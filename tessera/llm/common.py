"""Helpers the operators share: text columns, Arrow slices, bounded samples."""

from __future__ import annotations

import ctypes
import re
from collections.abc import Callable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

#: A word is a run of characters other than ASCII white space.
WORD = re.compile(r"[^\x20\x09-\x0D]+")
WORD_SQL = r"[^\\x20\\x09-\\x0D]+"

#: Remainder of crc32(doc_id as text) modulo 4 that marks held-out rows.
HELD_OUT = 2


def texts(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``text`` (null: empty) of ``docs``; other columns are left out."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))


def held_out(doc_id: str = "doc_id"):
    """True where crc32 of the id's text leaves the held-out remainder.
    A null id is never held out and never trained on."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == HELD_OUT, F.lit(False))


def one_text_each(train: DataFrame) -> DataFrame:
    """(doc_id, label, text) with one row per doc_id, the text of the smallest hash:
    a bound on ids then bounds rows, however often an id repeats. The least is
    taken in every task before the shuffle."""
    return train.groupBy("doc_id", "label").agg(F.min_by("text", F.xxhash64("text")).alias("text"))


@cache
def _trim():
    """The C library's call that gives freed memory back, where it has one."""
    try:
        return ctypes.CDLL(None).malloc_trim
    except (OSError, AttributeError):
        return lambda _: 0


def release_memory() -> None:
    """Give back what a task has freed: Python workers outlive their tasks."""
    pa.default_memory_pool().release_unused()
    _trim()(0)


def slices(batches: Iterator[pa.RecordBatch], column: str, limit: int) -> Iterator[pa.RecordBatch]:
    """Cut record batches into runs of rows holding about ``limit`` bytes of
    ``column`` (one row at least), so that working memory follows the limit
    and the longest single text, never the batch size."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        col = batch.column(batch.schema.get_field_index(column))
        ends = np.frombuffer(col.buffers()[1], np.int32 if col.type in (pa.string(), pa.binary()) else np.int64)
        ends = ends[col.offset:col.offset + len(col) + 1].astype(np.int64)
        at = 0
        while at < batch.num_rows:
            to = int(np.searchsorted(ends, ends[at] + limit, "right")) - 1
            to = min(max(to, at + 1), batch.num_rows)
            yield batch.slice(at, to - at)
            at = to
    release_memory()


def map_texts(df: DataFrame, fn: Callable[[dict], dict | None], schema: str,
              column: str = "text", limit: int = 4 << 20, arrow: bool = False) -> DataFrame:
    """Apply ``fn`` to slices of ``df`` in Arrow batches.

    ``fn`` gets a dict of Python lists (``column`` and the rest), or with
    ``arrow`` the record batch itself, and returns a dict of arrays with the
    fields of ``schema``, any number of rows.
    """
    target = to_arrow_schema(T._parse_datatype_string(schema))

    def run(batches):
        for part in slices(batches, column, limit):
            out = fn(part if arrow else part.to_pydict())
            if out is not None:
                yield pa.RecordBatch.from_arrays([pa.array(out[f.name], f.type) for f in target], schema=target)

    return df.mapInArrow(run, schema)


def buffers(texts_: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts end to end, and the n+1 boundaries."""
    raw = [t.encode("utf-8", "surrogatepass") for t in texts_]
    ends = np.zeros(len(raw) + 1, np.int64)
    np.cumsum([len(r) for r in raw], out=ends[1:])
    return np.frombuffer(b"".join(raw), np.uint8), ends


def mix64(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def packed_texts(rows: DataFrame) -> DataFrame:
    """``rows`` with ``text`` as a zstandard frame in ``packed``, for the
    shuffles that whole texts have to go through."""
    others = [f for f in rows.schema if f.name != "text"]
    names = [f.name for f in others]

    def run(batches):
        packer = zstandard.ZstdCompressor(level=1)
        for part in slices(batches, "text", 4 << 20):
            packed = [packer.compress(t.encode("utf-8", "surrogatepass")) for t in part.column(len(names)).to_pylist()]
            yield pa.RecordBatch.from_arrays([*part.columns[:len(names)], pa.array(packed, pa.binary())], names=[*names, "packed"])

    return rows.select(*names, "text").mapInArrow(run, T.StructType([*others, T.StructField("packed", T.BinaryType())]))


def unpacked(packed: bytes | None) -> bytes:
    return zstandard.ZstdDecompressor().decompress(packed) if packed else b""
