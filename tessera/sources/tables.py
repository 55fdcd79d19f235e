"""Driver-table scans: one parquet file per table under a scale-factor folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")


# Tables whose rows carry whole texts: per-row regex work dominates, so their
# scans must be spread over every core (key used for the hash spread).
WIDE_TEXT = {"documents": "doc_id", "pages": "page_id", "benchmark": "item_id",
             "conversations": "conv_id"}


def read_table(spark: SparkSession, sf_dir: str, name: str,
               columns: list[str] | None = None) -> DataFrame:
    """Scan ``{sf_dir}/{name}.parquet``; projecting here lets the scan prune."""
    if name not in TABLES:
        raise ValueError(f"unknown table {name!r}")
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    df = df.select(*columns) if columns else df
    key = WIDE_TEXT.get(name)
    return spread(df, key if key in df.columns else None) if key else df


#: Session setting: partitions over which scans of text tables are dealt. Unset
#: (a large input has splits enough) a scan keeps its own splits.
SPREAD_CONF = "spark.tessera.scan.partitions"


def spread(df: DataFrame, key: str | None = None) -> DataFrame:
    """Hash-repartition a scan when the session asks for it: a small file is one
    split, and row-by-row text work would then run in one task."""
    n = df.sparkSession.conf.get(SPREAD_CONF, None)
    if not n:
        return df
    return df.repartition(int(n), key) if key else df.repartition(int(n))
