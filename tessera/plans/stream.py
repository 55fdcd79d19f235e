"""Registered streaming queries: each drains its file source with an
``availableNow`` trigger into a sink under the shared checkpoint folder and
returns the sink read as a batch DataFrame, which must equal the batch SQL."""

from __future__ import annotations

import warnings

from pyspark.sql import functions as F

from tessera.operators.series import running_sum
from tessera.plans.registry import register
from tessera.plans.sqltext import sql_clean, sql_word_count
from tessera.plans.sqlweb import sql_page_text
from tessera.streaming import jobs


def _p(sf, t):
    return f"{sf.rstrip('/')}/{t}.parquet"


@register("stream_ingest",
          f"SELECT page_id, {sql_word_count('t')} AS direct_terms, md5(t) AS content_hash FROM "
          f"(SELECT page_id, {sql_page_text('html')} AS t FROM pages) WHERE trim(t) <> ''")
def stream_ingest(spark, sf):
    q, out = jobs.ingest_pages(spark, _p(sf, "pages"))
    jobs.run_to_end(q)
    return spark.read.parquet(out).select("page_id", "direct_terms", "content_hash")


@register("stream_dedup",
          f"SELECT min(doc_id) AS doc_id, md5({sql_clean('text')}) AS content_hash FROM documents GROUP BY 2")
def stream_dedup(spark, sf):
    q, out = jobs.dedup_stream(spark, _p(sf, "documents"))
    jobs.run_to_end(q)
    return spark.read.parquet(out).select("doc_id", "content_hash")


@register("stream_daily_counts",
          "SELECT CAST(date_trunc('day', ts) AS DATE) AS day, event_type, count(*) AS cnt FROM events "
          "WHERE date_trunc('day', ts) + INTERVAL 1 DAY <= (SELECT max(ts) FROM events) - INTERVAL 1 HOUR "
          "GROUP BY 1, 2")
def stream_daily_counts(spark, sf):
    q, out = jobs.daily_counts_stream(spark, _p(sf, "events"), watermark="1 hour")
    jobs.run_to_end(q)
    if late := jobs.dropped_rows(q):
        warnings.warn(f"{late} events came later than the watermark allows and are not counted", stacklevel=2)
    return spark.read.parquet(out).select("day", "event_type", "cnt")


@register("stream_cumulative",
          "SELECT day, CAST(v AS DOUBLE) AS day_value, CAST(sum(v) OVER (ORDER BY day ROWS BETWEEN "
          "UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE) AS cum_value FROM "
          "(SELECT CAST(ts AS DATE) AS day, sum(CAST(value AS DECIMAL(18,2))) AS v FROM events GROUP BY 1)")
def stream_cumulative(spark, sf):
    q, out = jobs.cumulative_stream(spark, _p(sf, "events"))
    jobs.run_to_end(q)
    daily = spark.read.parquet(out).groupBy("day").agg(F.sum("v").alias("v"))
    cum = running_sum(daily, ["day"], "v", "cum")
    return cum.select("day", F.col("v").cast("double").alias("day_value"),
                      F.col("cum").cast("double").alias("cum_value"))
