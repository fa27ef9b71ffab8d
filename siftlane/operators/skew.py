"""A join of many rows to one row per key that survives hot keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A key is hot from this share of all rows on; so at most ``HOT_PARTS`` keys are hot, whatever the data.
HOT_PARTS = 1000
#: Below so many rows of one key a single task takes them without trouble.
HOT_ROWS = 50_000


def hot_from(total: int) -> int:
    """The row count from which on a key is hot, where the counts of all keys add up to ``total``."""
    return max(HOT_ROWS, -(-total // HOT_PARTS))


def attach(rows: DataFrame, lookup: DataFrame, keys: list[str], payload: list[str], weight: Column, total: int, spread: Column) -> DataFrame:
    """Inner join of ``rows`` to ``lookup`` (one row per ``keys``), giving ``rows`` with ``payload``.

    ``weight`` is the number of rows a lookup row will meet; the weights add up to
    ``total`` or less. Hot lookup rows, at most ``HOT_PARTS`` of them, are
    broadcast. Their rows take part in the shuffle under a key made of ``spread``,
    which must differ from row to row, so that they land everywhere. Rows with a
    null key have no partner. ``rows`` must not have columns named like ``payload``.
    """
    hot = lookup.filter(weight >= hot_from(total)).select(*keys, F.struct(*payload).alias("_hot"))
    light = lookup.filter(weight < hot_from(total)).select(*keys, F.struct(*payload).alias("_light"), F.lit(False).alias("_is_hot"))
    marked = rows.join(F.broadcast(hot), keys, "left")
    is_hot = F.col("_hot").isNotNull()
    first, rest = keys[0], keys[1:]
    keyed = marked.withColumn("_is_hot", is_hot).withColumn(first, F.when(is_hot, F.xxhash64(spread).cast(rows.schema[first].dataType)).otherwise(F.col(first)))
    joined = keyed.join(light, [first, *rest, "_is_hot"], "left")
    found = F.coalesce("_hot", "_light")
    return joined.filter(found.isNotNull()).select(*[c for c in rows.columns if c not in keys], *[found[p].alias(p) for p in payload])
