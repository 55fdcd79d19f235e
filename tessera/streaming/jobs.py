"""Structured Streaming jobs for the endless crawl/analysis cycle.

Each job reads a file source, so an hourly cycle is
``trigger(processingTime="1 hour")`` in production and
``trigger(availableNow=True)`` in tests and batch re-runs. Sinks and
checkpoints live under the shared checkpoint folder (``spark.checkpoint.dir``),
so a restarted driver or a lost executor resumes from the last committed
micro-batch.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tessera.functions import text as tx
from tessera.operators import dedup, links
from tessera.session import scratch_path, stored


def read_stream(spark: SparkSession, path: str, schema=None, max_files: int | None = None) -> DataFrame:
    """File-source stream over ``path``: a folder of files, whatever its name, or
    one file in a folder (streamed as that folder filtered to the file's name)."""
    import os
    folder, name = (path, None) if not path.endswith(".parquet") or is_folder(spark, path) else os.path.split(path)
    r = spark.readStream.schema(schema or spark.read.parquet(path).schema)
    if name:
        r = r.option("pathGlobFilter", name)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    return r.parquet(folder)


def is_folder(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` is a folder; tables of several files are folders named like files."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.exists(p) and fs.getFileStatus(p).isDirectory()


def _start(df: DataFrame, out: str, ckpt: str, mode: str = "append", trigger: dict | None = None,
           fmt: str = "parquet") -> StreamingQuery:
    w = (df.writeStream.format(fmt).outputMode(mode).option("checkpointLocation", ckpt)
         .option("path", out))
    w = w.trigger(**(trigger or {"availableNow": True}))
    return w.start()


def ingest_pages(spark: SparkSession, pages_path: str, out: str | None = None,
                 trigger: dict | None = None) -> tuple[StreamingQuery, str]:
    """Landed raw pages -> cleaned main text, word count and hash."""
    src = read_stream(spark, pages_path).select("page_id", "url", "html")
    txt = links.page_texts(src, ["page_id", "url"])
    rows = (txt.filter(tx.nonblank("page_text"))
            .select("page_id", "url", tx.word_count("page_text").alias("direct_terms"),
                    tx.content_hash("page_text").alias("content_hash")))
    out = out or scratch_path(spark, "stream-ingest")
    return _start(rows, out, out + "-ckpt", trigger=trigger), out


def dedup_stream(spark: SparkSession, docs_path: str, out: str | None = None,
                 trigger: dict | None = None) -> tuple[StreamingQuery, str]:
    """R2: cross-cycle duplicate suppression on the cleaned-content hash.

    A page seen once stays suppressed for good, as in the original, so the
    memory of hashes is the sink itself, a table that grows with the distinct
    pages: each micro-batch keeps its smallest id per hash and anti joins the
    hashes stored before. The table is laid out by the hash's first digits, and
    a batch reads only the folders of the digits it has itself, by partition
    pruning: what a small batch reads does not grow with what others brought.
    Nothing is held in executor state. A batch writes its own folder and
    overwrites it on replay, and reads only folders of earlier batches, so a
    retry after a failure gives the same rows.
    """
    src = read_stream(spark, docs_path).select(
        "doc_id", tx.content_hash(tx.clean_text("text")).alias("content_hash"))
    out = out or scratch_path(spark, "stream-dedup")

    def sink(batch: DataFrame, epoch: int) -> None:
        first = dedup.dedup_first(batch, "doc_id", "content_hash").withColumn("bucket", F.substring("content_hash", 1, HASH_DIGITS))
        first = stored(first, "stream-batch")
        if epoch:
            own = [r.bucket for r in first.select("bucket").distinct().collect()]      # at most 16 ** HASH_DIGITS
            first = dedup.exclude_seen(first, seen_hashes(spark, out, own, epoch), "content_hash")
        first.withColumn("ingest_ts", F.current_timestamp()).select("content_hash", "doc_id", "ingest_ts", "bucket") \
            .hint("rebalance", "bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{out}/epoch={epoch}")

    q = (src.writeStream.foreachBatch(sink).option("checkpointLocation", out + "-ckpt")
         .trigger(**(trigger or {"availableNow": True})).start())
    return q, out


#: Hex digits of a hash that name its folder in the store.
HASH_DIGITS = 2


def seen_hashes(spark: SparkSession, store: str, buckets: list[str], before: int) -> DataFrame:
    """Hashes of earlier batches in the given folders of the store."""
    schema = "content_hash string, doc_id long, ingest_ts timestamp, epoch long, bucket string"
    return spark.read.schema(schema).parquet(store).where((F.col("epoch") < before) & F.col("bucket").isin(buckets))


def daily_counts_stream(spark: SparkSession, events_path: str, out: str | None = None,
                        watermark: str = "1 hour", trigger: dict | None = None):
    """Per-day, per-type counts as tumbling event-time windows, emitted in
    append mode once the watermark closes a day.

    The last day stays open until a later event closes it. Rows for a closed
    day are left out and counted (``dropped_rows``); how late a row may come is
    ``watermark``."""
    ev = read_stream(spark, events_path).select(
        F.col("ts").cast("timestamp").alias("ts"), "event_type")
    agg = (ev.withWatermark("ts", watermark)
           .groupBy(F.window("ts", "1 day"), "event_type").agg(F.count(F.lit(1)).alias("cnt"))
           .select(F.to_date(F.col("window.start")).alias("day"), "event_type", "cnt"))
    out = out or scratch_path(spark, "stream-daily")
    return _start(agg, out, out + "-ckpt", trigger=trigger), out


def cumulative_stream(spark: SparkSession, events_path: str, out: str | None = None,
                      trigger: dict | None = None):
    """Per-batch daily sums appended by ``foreachBatch``; the cumulative
    series is a running sum over the appended table when read."""
    ev = read_stream(spark, events_path).select(
        F.to_date("ts").alias("day"), F.col("value").cast("decimal(18,2)").alias("v"))
    out = out or scratch_path(spark, "stream-cumulative")

    def sink(batch: DataFrame, epoch: int) -> None:
        # One folder per epoch, overwritten on replay: a micro-batch retried
        # after a failure replaces its own output instead of appending twice.
        (batch.groupBy("day").agg(F.sum("v").alias("v"))
         .write.mode("overwrite").parquet(f"{out}/epoch={epoch}"))

    q = (ev.writeStream.foreachBatch(sink).option("checkpointLocation", out + "-ckpt")
         .trigger(**(trigger or {"availableNow": True})).start())
    return q, out


def run_to_end(q: StreamingQuery, timeout_s: float | None = None) -> None:
    """Wait for an availableNow query to drain its input, without limit unless
    one is given. A query that fails, or is still active after the limit, is an
    error: its sink holds part of the result."""
    done = q.awaitTermination(timeout_s) if timeout_s is not None else q.awaitTermination()
    if timeout_s is not None and not done:
        q.stop()
        raise TimeoutError(f"stream {q.id} had input left after {timeout_s} s; its sink is incomplete")
    if q.exception():
        raise RuntimeError(str(q.exception()))


def dropped_rows(q: StreamingQuery) -> int:
    """Rows that came after the watermark and were left out, over the batches
    whose progress the query still holds."""
    return sum(int(op.numRowsDroppedByWatermark) for p in q.recentProgress for op in p.stateOperators)
