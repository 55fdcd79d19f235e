"""Structured Streaming across cycles: state carried by the checkpoint."""

import tempfile

from tessera.streaming import jobs


def _land(spark, folder, rows, name):
    spark.createDataFrame(rows, "doc_id long, text string").coalesce(1) \
        .write.mode("overwrite").parquet(f"{folder}/{name}")


def test_dedup_suppresses_repeats_across_cycles(spark):
    root = tempfile.mkdtemp(prefix="tessera-stream-")
    src, out = f"{root}/landing", f"{root}/out"
    _land(spark, src, [(1, "same page"), (2, "other page"), (3, "same   page")], "cycle=1")
    q, _ = jobs.dedup_stream(spark, src, out=out)
    jobs.run_to_end(q)
    first = {r.content_hash for r in spark.read.parquet(out).collect()}
    assert len(first) == 2          # 1 and 3 clean to the same text
    _land(spark, src, [(4, "same page"), (5, "new page")], "cycle=2")
    q, _ = jobs.dedup_stream(spark, src, out=out)   # same checkpoint: next cycle
    jobs.run_to_end(q)
    rows = spark.read.parquet(out).collect()
    assert sorted(r.doc_id for r in rows if r.doc_id in (4, 5)) == [5]
    assert len({r.content_hash for r in rows}) == 3


def test_daily_windows_emit_when_closed(spark):
    import datetime as dt
    root = tempfile.mkdtemp(prefix="tessera-stream-")
    src, out = f"{root}/landing", f"{root}/out"
    ev = [(i, dt.datetime(2024, 1, 1 + i // 4, i % 24), "click", 1.0) for i in range(12)]
    spark.createDataFrame(ev, "event_id long, ts timestamp_ntz, event_type string, value double") \
        .coalesce(1).write.parquet(f"{src}/cycle=1")
    q, _ = jobs.daily_counts_stream(spark, src, out=out)
    jobs.run_to_end(q)
    got = {(str(r.day), r.cnt) for r in spark.read.parquet(out).collect()}
    # the last day is still open under a 1 hour watermark
    assert got == {("2024-01-01", 4), ("2024-01-02", 4)}


def test_late_event_after_watermark_is_dropped(spark):
    import datetime as dt
    root = tempfile.mkdtemp(prefix="tessera-stream-")
    src, out = f"{root}/landing", f"{root}/out"
    schema = "event_id long, ts timestamp_ntz, event_type string, value double"
    first = [(i, dt.datetime(2024, 1, 1 + i, 12), "view", 1.0) for i in range(4)]   # days 1-4
    spark.createDataFrame(first, schema).coalesce(1).write.parquet(f"{src}/cycle=1")
    q, _ = jobs.daily_counts_stream(spark, src, out=out)
    jobs.run_to_end(q)
    # a late event for day 1 (closed long ago) and one for the open day 4
    late = [(10, dt.datetime(2024, 1, 1, 13), "view", 1.0), (11, dt.datetime(2024, 1, 4, 13), "view", 1.0),
            (12, dt.datetime(2024, 1, 6, 12), "view", 1.0)]
    spark.createDataFrame(late, schema).coalesce(1).write.parquet(f"{src}/cycle=2")
    q, _ = jobs.daily_counts_stream(spark, src, out=out)
    jobs.run_to_end(q)
    got = {str(r.day): r.cnt for r in spark.read.parquet(out).collect()}
    # day 1 keeps its first count (the late row is dropped); day 4 closes with 2
    assert got == {"2024-01-01": 1, "2024-01-02": 1, "2024-01-03": 1, "2024-01-04": 2}


def test_a_limit_that_is_reached_is_an_error(spark):
    """A drained query returns; one with input left after the limit raises."""
    import pytest
    root = tempfile.mkdtemp(prefix="tessera-stream-")
    src = f"{root}/landing"
    _land(spark, src, [(k, f"page {k}") for k in range(50)], "cycle=1")
    q, _ = jobs.dedup_stream(spark, src, out=f"{root}/a")
    jobs.run_to_end(q, timeout_s=300)
    endless, _ = jobs.dedup_stream(spark, src, out=f"{root}/b", trigger={"processingTime": "1 hour"})
    with pytest.raises(TimeoutError):
        jobs.run_to_end(endless, timeout_s=2)
    assert not endless.isActive


def test_late_rows_are_counted(spark):
    import datetime as dt
    root = tempfile.mkdtemp(prefix="tessera-stream-")
    src, schema = f"{root}/landing", "event_id long, ts timestamp_ntz, event_type string, value double"
    spark.createDataFrame([(1, dt.datetime(2024, 1, 5), "view", 1.0)], schema).coalesce(1).write.parquet(f"{src}/cycle=1")
    q, _ = jobs.daily_counts_stream(spark, src, out=f"{root}/out")
    jobs.run_to_end(q)
    assert jobs.dropped_rows(q) == 0
    spark.createDataFrame([(2, dt.datetime(2024, 1, 1), "view", 1.0)], schema).coalesce(1).write.parquet(f"{src}/cycle=2")
    q, _ = jobs.daily_counts_stream(spark, src, out=f"{root}/out")
    jobs.run_to_end(q)
    assert jobs.dropped_rows(q) == 1


def test_tables_of_several_files(spark):
    """A table is a folder named like a file when it has more than one file."""
    root = tempfile.mkdtemp(prefix="tessera-stream-")
    spark.createDataFrame([(k, f"page {k % 7}") for k in range(40)], "doc_id long, text string").repartition(3).write.parquet(f"{root}/documents.parquet")
    q, out = jobs.dedup_stream(spark, f"{root}/documents.parquet", out=f"{root}/out")
    jobs.run_to_end(q)
    assert sorted(r.doc_id for r in spark.read.parquet(out).collect()) == list(range(7))
    html = "<html><body><article><p>words of page {}</p></article></body></html>"
    spark.createDataFrame([(k, f"http://a.b/{k}", html.format(k)) for k in range(9)], "page_id long, url string, html string") \
        .repartition(3).write.parquet(f"{root}/pages.parquet")
    q, out = jobs.ingest_pages(spark, f"{root}/pages.parquet", out=f"{root}/ingested")
    jobs.run_to_end(q)
    assert sorted(r.page_id for r in spark.read.parquet(out).collect()) == list(range(9))
