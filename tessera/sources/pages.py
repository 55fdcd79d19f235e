"""Page store sink and scans.

Two layouts:

* ``records`` (the Spark-native store): ``write.partitionBy("cycle",
  "domain").text`` with one record per page, records separated by U+001E, so
  a task writes many pages per file and the store scales to billions of
  pages. Each record is ``URL=<url>\\nDATE=<yyyy-MM-dd>\\n<text>``; both head
  lines are always there, so no line of a text is ever taken for one. U+001E
  and U+001F inside a field, and line breaks inside a head line, are written
  as two characters that begin with U+001F. Nothing of a page is lost: a null
  date leaves its line blank, a null text is empty, a null URL is marked.
* ``files`` (one text file per page, ``cycle_NNN/<domain>/page_N.txt``):
  read whole-file; cycle and domain come from the path.

Parsing follows the original loader: URL from the first line if it starts
``URL=`` (else ``Unknown URL``), DATE from the next line if present (else the
file's modification date, UTC), remaining lines stripped and joined by one
space; empty files are skipped.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

RECORD_SEP = "\u001e"
_ESCAPE = "\u001f"
#: Stands for itself last, so that undoing the others never makes a new pair.
_ESCAPES = [(RECORD_SEP, "r"), ("\n", "n"), (_ESCAPE, "u")]
_NO_URL = _ESCAPE + "0"


def _escaped(c: Column, head: bool) -> Column:
    c = F.replace(c, F.lit(_ESCAPE), F.lit(_ESCAPE + "u"))
    c = F.replace(c, F.lit(RECORD_SEP), F.lit(_ESCAPE + "r"))
    return F.replace(c, F.lit("\n"), F.lit(_ESCAPE + "n")) if head else c


def _unescaped(c: Column) -> Column:
    for plain, code in _ESCAPES:
        c = F.replace(c, F.lit(_ESCAPE + code), F.lit(plain))
    return c


def page_records(df: DataFrame, url: str = "url", date: str = "date", text: str = "text") -> Column:
    return F.concat(F.lit("URL="), F.coalesce(_escaped(F.col(url), True), F.lit(_NO_URL)),
                    F.lit("\nDATE="), F.coalesce(_escaped(F.col(date).cast("string"), True), F.lit("")),
                    F.lit("\n"), F.coalesce(_escaped(F.col(text), False), F.lit("")))


def write_page_store(df: DataFrame, path: str, mode: str = "append") -> None:
    """``(cycle, domain, url, date, text)`` -> partitioned record files.

    The ``rebalance`` hint clusters rows by (cycle, domain) and lets AQE
    size the write tasks: small domains are coalesced (one file each, not one
    per upstream task) and a domain holding a third of all pages is split
    across several tasks instead of landing in one.
    """
    (df.hint("rebalance", "cycle", "domain")
     .select("cycle", "domain", page_records(df).alias("value"))
     .write.mode(mode).partitionBy("cycle", "domain").option("lineSep", RECORD_SEP).text(path))


def commit_cycle(df: DataFrame, path: str, cycle: int) -> None:
    """S6 for one cycle ``(domain, url, date, text)``, all or nothing.

    The pages replace the cycle's folder, whatever an earlier attempt left there;
    then a manifest (domain, pages, digest) is written next to the data, and its
    presence is the commit. Until then, and while a replay is under way, readers of
    ``scan_committed`` don't see the cycle; a replayed cycle gives the same store.
    """
    spark, folder = df.sparkSession, f"{path}/{MANIFEST}/cycle={int(cycle)}"
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hadoop, True)
    (df.hint("rebalance", "domain").select("domain", page_records(df).alias("value"))
     .write.mode("overwrite").partitionBy("domain").option("lineSep", RECORD_SEP).text(f"{path}/cycle={int(cycle)}"))
    manifest(spark, path, cycle).write.mode("overwrite").parquet(folder)


#: Hidden from scans of the store by its first character.
MANIFEST = "_manifest"


def manifest(spark: SparkSession, path: str, cycle: int) -> DataFrame:
    """(domain, pages, digest) of a cycle as it lies in the store; the digest is
    an order-free sum of the records' hashes."""
    raw = (spark.read.schema("value string, domain string").option("lineSep", RECORD_SEP).text(f"{path}/cycle={int(cycle)}")
           .select("domain", F.xxhash64("value").cast("decimal(38,0)").alias("h")))
    return raw.groupBy("domain").agg(F.count(F.lit(1)).alias("pages"), F.sum("h").alias("digest"))


def committed_cycles(spark: SparkSession, path: str) -> list[int]:
    """Cycles whose manifest was finished."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/{MANIFEST}")
    fs = hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    done = []
    for f in fs.listStatus(hadoop) if fs.exists(hadoop) else []:
        marker = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f.getPath(), "_SUCCESS")
        if f.getPath().getName().startswith("cycle=") and fs.exists(marker):
            done.append(int(f.getPath().getName().split("=")[1]))
    return sorted(done)


def scan_committed(spark: SparkSession, path: str) -> DataFrame:
    """``scan_page_store`` without cycles that were not committed."""
    return scan_page_store(spark, path).where(F.col("cycle").isin(committed_cycles(spark, path)))


def damaged_domains(spark: SparkSession, path: str, cycle: int) -> DataFrame:
    """(domain) of a committed cycle whose pages are not those of its manifest."""
    noted = spark.read.schema("domain string, pages long, digest decimal(38,0)").parquet(f"{path}/{MANIFEST}/cycle={int(cycle)}")
    there = manifest(spark, path, cycle).select("domain", F.col("pages").alias("n"), F.col("digest").cast("decimal(38,0)").alias("d"))
    both = noted.join(there, "domain", "full")
    return both.where(~(F.col("pages").eqNullSafe(F.col("n")) & F.col("digest").eqNullSafe(F.col("d")))).select("domain")


def _parse(raw: DataFrame, body: str, extra: list[Column]) -> DataFrame:
    lines = F.split(F.col(body), "\n")
    first = F.trim(lines[0])
    has_url = first.startswith("URL=")
    url = F.when(has_url, F.trim(F.regexp_replace(first, "^URL=", ""))).otherwise(F.lit("Unknown URL"))
    start = F.when(has_url, F.lit(1)).otherwise(F.lit(0))
    nxt = F.element_at(lines, start + 1)
    has_date = F.coalesce(nxt.startswith("DATE="), F.lit(False))
    date_s = F.trim(F.regexp_replace(F.trim(nxt), "^DATE=", ""))
    date_s = F.when(has_date & (date_s != ""), date_s)
    start = start + F.when(has_date, 1).otherwise(0)
    rest = F.slice(lines, start + 1, F.greatest(F.size(lines) - start, F.lit(0)))
    content = F.array_join(F.transform(rest, lambda s: F.trim(s)), " ")
    return raw.filter(F.col(body) != "").select(
        *extra, url.alias("url"), date_s.alias("_date"), content.alias("content"))


def scan_page_store(spark: SparkSession, path: str) -> DataFrame:
    """S1 over the ``records`` layout: ``(cycle, domain, url, date, content)``.

    Partition filters on ``cycle``/``domain`` prune folders before reading.
    """
    # Explicit types: a domain such as "123" must stay a string.
    raw = (spark.read.schema("value string, cycle int, domain string")
           .option("lineSep", RECORD_SEP).text(path)
           .select("value", "cycle", "domain", F.col("_metadata.file_modification_time").alias("mtime")))
    out = _parse(raw, "value", [F.col("cycle"), F.col("domain"), F.col("mtime")])
    date = F.coalesce(_unescaped(F.col("_date")), F.date_format("mtime", "yyyy-MM-dd"))
    url = F.when(F.col("url") == _NO_URL, F.lit("Unknown URL")).otherwise(_unescaped(F.col("url")))
    return out.select("cycle", "domain", url.alias("url"), date.alias("date"), _unescaped(F.col("content")).alias("content"))


def scan_page_files(spark: SparkSession, path: str) -> DataFrame:
    """S1 over the ``files`` layout (one page per ``*.txt``, any depth)."""
    raw = (spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.txt")
           .text(path, wholetext=True)
           .select("value", F.col("_metadata.file_path").alias("fp"),
                   F.col("_metadata.file_modification_time").alias("mtime")))
    parts = F.split(F.col("fp"), "/")
    domain = F.element_at(parts, -2)
    file = F.element_at(parts, -1)
    cycle = F.regexp_extract(F.col("fp"), r"/cycle_(\d+)/", 1)
    out = _parse(raw, "value", [F.when(cycle != "", cycle.cast("int")).alias("cycle"),
                                domain.alias("domain"), file.alias("file"), "mtime"])
    date = F.coalesce(F.col("_date"), F.date_format("mtime", "yyyy-MM-dd"))
    return out.select("cycle", "domain", "file", "url", date.alias("date"), "content")


def next_cycle(spark: SparkSession, path: str) -> int:
    """Largest cycle of the store + 1, or 1 for an empty or missing store.
    Read from the names of the partition folders, not from the pages."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    names = [f.getPath().getName() for f in fs.listStatus(hadoop)] if fs.exists(hadoop) else []
    return max([int(n.split("=")[1]) for n in names if n.startswith("cycle=")], default=0) + 1


def cycle_folder(cycle) -> Column:
    """X11: ``cycle_%03d`` folder name."""
    return F.format_string("cycle_%03d", F.col(cycle) if isinstance(cycle, str) else cycle)


def read_seeds(spark: SparkSession, path: str) -> DataFrame:
    """One URL per line; blank lines and ``#`` comments dropped."""
    t = spark.read.text(path).select(F.trim("value").alias("url"))
    return t.filter((F.col("url") != "") & ~F.col("url").startswith("#"))
