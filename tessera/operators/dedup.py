"""Exact-content dedup (D1) and seen-content exclusion."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def dedup_first(df: DataFrame, id_col: str, hash_col: str, carry: bool = False) -> DataFrame:
    """Keep, per content hash, the row with the smallest id.

    The shuffle carries only ``(hash, id)`` and is pre-aggregated map-side
    (``min``), so a hash shared by a third of all rows collapses to one row
    per map task before it moves; the survivors then semi-join back on the
    unique id, which cannot be skewed. With ``carry=True`` the whole row
    rides in a partial ``min_by`` aggregate instead - one shuffle, and an
    expensive upstream (text extraction) is not evaluated twice. That is for
    narrow rows: take what is needed of a text, such as its word count, before.
    """
    if carry:
        others = [c for c in df.columns if c != hash_col]
        first = df.groupBy(hash_col).agg(F.min_by(F.struct(*others), F.col(id_col)).alias("_r"))
        return first.select(*[F.col(f"_r.{c}").alias(c) for c in others], hash_col)
    keep = df.groupBy(hash_col).agg(F.min(id_col).alias(id_col))
    if set(df.columns) <= {id_col, hash_col}:
        return keep.select(id_col, hash_col)  # the aggregate is the answer
    return df.join(keep.select(id_col), id_col, "left_semi")


def exclude_seen(df: DataFrame, seen: DataFrame, hash_col: str) -> DataFrame:
    """Rows whose hash is not in ``seen`` (anti join on the hash)."""
    return df.join(seen.select(hash_col).distinct(), hash_col, "left_anti")
