"""Small DataFrame helpers shared by the operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def computed_once(df: DataFrame) -> DataFrame:
    """Pin ``df``'s computed columns so that later filters cannot copy them.

    Catalyst pushes a filter below a projection by substituting each column
    with its defining expression, so a filter on extracted page text would
    re-run the whole HTML/regex chain per reference. Emitting the row through
    a one-element ``inline`` makes the columns generator output, which no
    rule copies through: each is computed once per row.
    """
    return df.select(F.inline(F.array(F.struct(*df.columns))))
