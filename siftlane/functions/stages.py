"""Columns that are computed once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def computed(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """``df`` with ``columns``, which later expressions and filters read instead of repeating them.

    Neighbouring projections are merged by the optimizer, which copies each column
    into every place that uses it; over several steps the expressions explode. A
    generator that makes one row of one row stands between.
    """
    return df.select("*", F.inline(F.array(F.struct(*[c.alias(n) for n, c in columns.items()]))))
