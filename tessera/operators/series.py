"""Zero-filled category series (A2) and skew-proof running sums."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.session import checkpoint_dir, default_parallelism


#: Rows of a slice of a running sum: what one task sorts and sums.
SLICE_ROWS = 2_000_000


def zero_filled_pivot(rows: DataFrame, key: str, category: str,
                      categories: list[str], value: str | None = None) -> DataFrame:
    """One row per key, one column per listed category, missing cells 0.

    ``rows`` holds ``(key, category[, value])``; rows whose category is NULL
    still create their key (a date with pages but no matches). Pivoting on
    a fixed value list needs no extra job to discover the categories, and
    the aggregation is partial (map-side) before the shuffle on ``key``. A
    category outside the list is an error, not a lost row.
    """
    c = F.col(category)
    rows = rows.withColumn(category, F.when(c.isNull() | c.isin(categories), c).otherwise(
        F.raise_error(F.concat(F.lit(f"unlisted {category}: "), c.cast("string")))))
    g = rows.groupBy(key).pivot(category, categories)
    out = g.agg(F.sum(value)) if value else g.agg(F.count(F.lit(1)))
    return out.select(key, *[F.coalesce(F.col(f"`{c}`"), F.lit(0)).cast("long").alias(c)
                             for c in categories])


def running_sum(df: DataFrame, order_cols: list[str], value: str, out: str,
                buckets: int | None = None, partition_cols: list[str] | None = None) -> DataFrame:
    """Cumulative sum of ``value`` in the order of ``order_cols`` (W1), within
    each ``partition_cols`` group when given (a global order otherwise).

    A plain window would pull a whole group - or, with no partition, every
    row - into one task. Instead:

    1. range-partition by (group, order key) into ``buckets`` slices (by default
       as many as the rows need at SLICE_ROWS each); range
       bounds on a unique key split even a group or timestamp that holds a
       third of all rows across many slices;
    2. sum each (slice, group) (partial aggregation: one row per slice and
       group) and prefix-sum those rows per group into offsets - a table of
       at most slices + groups rows;
    3. running sum within (slice, group) plus its offset.

    Step 1 is materialised with ``checkpoint()`` (see below).
    """
    parts = list(partition_cols or [])
    checkpoint_dir(df.sparkSession)
    # The slice id depends on range bounds sampled from the input; the sums
    # and the rows must see the same bounds, so the sliced rows are written
    # once to the shared checkpoint folder (also cutting the lineage) rather
    # than re-derived by two independently planned exchanges.
    # How many slices there are follows the rows unless the caller says so.
    n = buckets or max(default_parallelism(df.sparkSession), -(-df.count() // SLICE_ROWS))
    ranged = (df.repartitionByRange(n, *parts, *order_cols)
              .withColumn("_slice", F.spark_partition_id())
              .checkpoint(eager=True))
    sums = ranged.groupBy("_slice", *parts).agg(F.sum(value).alias("_slice_sum"))
    before = (Window.partitionBy(*parts).orderBy("_slice") if parts else Window.orderBy("_slice")) \
        .rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select("_slice", *parts, F.coalesce(F.sum("_slice_sum").over(before),
                                                       F.lit(0)).alias("_offset"))
    within = (Window.partitionBy("_slice", *parts).orderBy(*order_cols)
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    # Offsets hold one row per (slice, group): small next to the data, and
    # AQE broadcasts them when their measured size allows.
    return (ranged.join(offsets, ["_slice", *parts])
            .withColumn(out, F.col("_offset") + F.sum(value).over(within))
            .drop("_slice", "_offset"))


def rank_within(df: DataFrame, order_cols: list[str], out: str = "rank",
                partition_cols: list[str] | None = None, buckets: int | None = None) -> DataFrame:
    """1-based position in ``order_cols`` order (unique key), skew-proof."""
    one = df.withColumn("_one", F.lit(1).cast("long"))
    return running_sum(one, order_cols, "_one", out, buckets, partition_cols).drop("_one")
