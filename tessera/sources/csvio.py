"""CSV event log and report sinks/scans."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The original log writes Python's default datetime text: microseconds kept.
LOG_TS_FORMAT = "yyyy-MM-dd HH:mm:ss.SSSSSS"
EVENT_LOG_SCHEMA = "timestamp timestamp, direct_terms long"


def append_event_log(df: DataFrame, path: str) -> None:
    """Append ``(timestamp, direct_terms)`` rows as headerless CSV."""
    (df.select("timestamp", "direct_terms").write.mode("append")
     .option("timestampFormat", LOG_TS_FORMAT).csv(path))


def read_event_log(spark: SparkSession, path: str) -> DataFrame:
    """S3: headerless CSV with the given names and types."""
    return (spark.read.schema(EVENT_LOG_SCHEMA).option("timestampFormat", LOG_TS_FORMAT)
            .csv(path))


def write_timeseries_csv(pivot: DataFrame, path: str, key: str = "date") -> None:
    """``Date`` + one column per category, dates ascending, one file.

    The series has one row per date (small), so a single ordered partition
    is written."""
    (pivot.withColumnRenamed(key, "Date").orderBy("Date").coalesce(1)
     .write.mode("overwrite").option("header", True).csv(path))


def read_timeseries_csv(spark: SparkSession, path: str, categories: list[str]) -> DataFrame:
    """S4 over S8: the wide series again, one count column per category, in the
    order they were written."""
    columns = ", ".join(["Date date", *(f"`{c}` long" for c in categories)])
    return spark.read.option("header", True).option("enforceSchema", False).schema(columns).csv(path)


def write_totals_csv(totals: DataFrame, path: str) -> None:
    """Long ``Type,Name,Count`` rows."""
    (totals.select(F.col("type").alias("Type"), F.col("name").alias("Name"),
                   F.col("count").alias("Count"))
     .coalesce(1).write.mode("overwrite").option("header", True).csv(path))


def read_totals_csv(spark: SparkSession, path: str) -> DataFrame:
    """Header CSV with an explicit schema (no inference pass)."""
    return (spark.read.option("header", True).schema("Type string, Name string, Count long")
            .csv(path))
