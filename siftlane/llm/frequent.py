"""Most frequent values in bounded memory (problem 4).

A sketch with two parts runs over the 64-bit hashes of the values. In the *heavy*
part every bucket holds a few hashes with exact counts; a value that finds its
bucket full votes against it, and once the votes outweigh the smallest holder
``EVICT_VOTES`` times, that one is evicted and the newcomer takes its cell.
Counts of evicted and refused values fall into the *light* part, a compact
counter array. Sketches of partitions are merged bucket by bucket: equal hashes
add up, the largest stay, the others fall into the light part.

The number of sketches is bounded by a parameter, however many splits the input has, so
neither memory nor merge grow with the data, and the estimates don't depend on the
cluster.

heavy count + light counter is never below a value's true count. So the values
whose sum reaches the wanted share, and those of any light position that reaches
it by itself, contain all frequent values; they are few, as all counters together
hold each row once. Their rows are then counted exactly.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..runtime import settle
from .formatting import BLANKS

BUCKETS = 4096
CELLS = 8
EVICT_VOTES = 8
LIGHT = 1 << 16
#: Sketches at most; each takes one share of the input, whatever the cluster.
SKETCHES = 256

bucket_of = lambda key: key.bitwiseAND(F.lit(BUCKETS - 1))
light_of = lambda key: F.shiftrightunsigned(key, 20).bitwiseAND(F.lit(LIGHT - 1))


class Sketch:
    """The sketch of one partition. ``add`` takes any array of int64 hashes."""

    def __init__(self, buckets: int = BUCKETS, cells: int = CELLS, light: int = LIGHT, votes: int = EVICT_VOTES):
        self.key = np.zeros((buckets, cells), np.int64)
        self.count = np.zeros((buckets, cells), np.int64)
        self.against = np.zeros(buckets, np.int64)
        self.light = np.zeros(light, np.int64)
        self.votes = votes

    def _drop(self, keys: np.ndarray, counts: np.ndarray) -> None:
        at = (keys.view(np.uint64) >> np.uint64(20)).astype(np.int64) & (len(self.light) - 1)
        self.light += np.bincount(at, counts, len(self.light)).astype(np.int64)

    def add(self, hashes: np.ndarray) -> None:
        keys, counts = np.unique(hashes, return_counts=True)
        bucket = keys & (len(self.key) - 1)
        held = (self.key[bucket] == keys[:, None]) & (self.count[bucket] > 0)
        hit = held.any(1)
        self.count[bucket[hit], held[hit].argmax(1)] += counts[hit]
        keys, counts, bucket = keys[~hit], counts[~hit], bucket[~hit]
        order = np.lexsort((keys, -counts, bucket))
        keys, counts, bucket = keys[order], counts[order], bucket[order]
        if not len(keys):
            return
        begin = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]]))
        turn = np.arange(len(keys)) - np.repeat(begin, np.diff(np.concatenate([begin, [len(keys)]])))
        # free cells come last once a bucket's cells are sorted by count
        touched = bucket[begin]
        by_count = np.argsort(-self.count[touched], axis=1, kind="stable")
        self.key[touched] = np.take_along_axis(self.key[touched], by_count, 1)
        self.count[touched] = np.take_along_axis(self.count[touched], by_count, 1)
        free = (self.count == 0).sum(1)
        cells = self.key.shape[1]
        settled = turn < free[bucket]
        cell = cells - free[bucket[settled]] + turn[settled]
        self.key[bucket[settled], cell] = keys[settled]
        self.count[bucket[settled], cell] = counts[settled]
        keys, counts, bucket, turn = keys[~settled], counts[~settled], bucket[~settled], turn[~settled] - free[bucket[~settled]]
        if not len(keys):
            return
        np.add.at(self.against, bucket, counts)
        lead = turn == 0
        b = bucket[lead]
        least = self.count[b].argmin(1)
        wins = self.against[b] >= self.votes * self.count[b, least]
        refused = np.ones(len(keys), bool)
        winner = np.flatnonzero(lead)[wins]
        refused[winner] = False
        b, least = b[wins], least[wins]
        self._drop(self.key[b, least], self.count[b, least])
        self.key[b, least], self.count[b, least], self.against[b] = keys[winner], counts[winner], 0
        self._drop(keys[refused], counts[refused])


def sketch(keys: DataFrame, sketches: int = SKETCHES) -> DataFrame:
    """The merged sketch of a column ``key`` (bigint): rows ``part`` (heavy or light), ``slot, key, count``."""
    several = keys.coalesce(sketches)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, any_ = Sketch(), False
        for batch in batches:
            if batch.num_rows:
                own.add(batch.column(0).to_numpy())
                any_ = True
        if any_:
            b, c = np.nonzero(own.count)
            at = np.flatnonzero(own.light)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(["heavy"] * len(b) + ["light"] * len(at)),
                    pa.array(np.concatenate([b, at])),
                    pa.array(np.concatenate([own.key[b, c], np.zeros(len(at), np.int64)])),
                    pa.array(np.concatenate([own.count[b, c], own.light[at]])),
                ],
                ["part", "slot", "key", "count"],
            )

    parts = several.mapInArrow(run, "part string, slot bigint, key bigint, count bigint").groupBy("part", "slot", "key").agg(F.sum("count").alias("count"))
    # a bucket holds at most CELLS entries of each sketch
    place = F.row_number().over(Window.partitionBy("part", "slot").orderBy(F.desc("count"), "key"))
    placed = parts.withColumn("evicted", (F.col("part") == "heavy") & (place > CELLS))
    recombined = placed.select(
        F.when(F.col("evicted"), "light").otherwise(F.col("part")).alias("part"),
        F.when(F.col("evicted"), light_of(F.col("key"))).otherwise(F.col("slot")).alias("slot"),
        F.when(F.col("evicted"), F.lit(0)).otherwise(F.col("key")).alias("key"),
        "count",
    )
    return recombined.groupBy("part", "slot", "key").agg(F.sum("count").alias("count"))


def written(value: Column) -> Column:
    """Lower case without outer blanks and dots; null for null and blank values."""
    outer = BLANKS[:-2].replace("[", r"[.", 1) + "]+"
    return F.when(~value.rlike(f"^({BLANKS})?$"), F.lower(F.regexp_replace(value, f"^{outer}|{outer}$", "")))


def frequent(df: DataFrame, column: str, one_in: int = 200, sketches: int = SKETCHES) -> DataFrame:
    """Values of ``column`` held by at least one in ``one_in`` of its non-blank rows.

    Result: the value as written by :func:`written`, ``approx_count`` (heavy plus
    light, never below the true count) and ``exact_count``. Null and blank values
    count nowhere; a value at exactly the share is in; an empty table gives no rows.
    """
    values = df.select(written(df[column]).alias("value")).filter(F.col("value").isNotNull()).select("value", F.xxhash64("value").alias("key"))
    merged = settle(sketch(values.select("key"), sketches))  # at most BUCKETS * CELLS + LIGHT rows
    total = merged.agg(F.coalesce(F.sum("count"), F.lit(0))).first()[0]
    least = max(1, -(-total // one_in))
    light = merged.filter("part = 'light'").select(F.col("slot").alias("light_slot"), F.col("count").alias("light_count"))
    heavy = merged.filter("part = 'heavy'").select("key", "count").withColumn("light_slot", light_of(F.col("key")))
    upper = heavy.join(F.broadcast(light), "light_slot", "left").select("key", (F.col("count") + F.coalesce("light_count", F.lit(0))).alias("approx"))
    candidates = upper.filter(F.col("approx") >= least)
    full = light.filter(F.col("light_count") >= least)  # at most one_in positions
    rows = values.withColumn("light_slot", light_of(F.col("key"))).join(F.broadcast(candidates), "key", "left").join(F.broadcast(full), "light_slot", "left")
    chosen = rows.filter(F.col("approx").isNotNull() | F.col("light_count").isNotNull())
    counted = chosen.groupBy("value").agg(F.count(F.lit(1)).alias("exact_count"), F.max(F.coalesce("approx", "light_count")).alias("approx_count"))
    return counted.filter(F.col("exact_count") * one_in >= total).select(F.col("value").alias(column), "approx_count", "exact_count")
