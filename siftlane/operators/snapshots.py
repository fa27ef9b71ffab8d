"""What changed between full snapshots of a table (problem 1).

Keys are dealt into buckets by hash, and the rows of a bucket are brought together by
the only shuffle of the table. For every snapshot and bucket an invertible Bloom
lookup table is built with Spark's aggregates: each (key hash, value hash) pair goes to
one cell of each of three parts, and a cell keeps its count and the XOR of key
hashes, value hashes and checks. Two successive tables are subtracted cell by cell;
pairs that both snapshots hold vanish, and what remains is peeled from cells that
hold a single pair. A digest of each bucket (count and XOR of another hash) has to
agree with the peeled pairs. How many cells a table needs follows from the churn of a
sample of keys. A bucket that still can't be peeled, or whose digest differs, is read
again, alone, with ``ENLARGE`` times the cells, and after ``ROUNDS`` rounds compared pair
by pair. A key peeled from one side was added or removed; from both, it was changed.

Only pairs that differ leave this; what both snapshots share never meets in a
join. Bucket and key hash together make about 64 bits plus the bits of the bucket
number, within which two keys of one snapshot would have to collide.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..runtime import settle

#: Rows of all snapshots that share a bucket, about.
ROWS_PER_BUCKET = 16_384
#: A bucket with so many times its share holds a key that repeats; its rows are thinned out before they are brought together.
HOT_BUCKET = 4
#: Rows, about, from which the churn is estimated; it sizes tables and decides nothing else.
SAMPLE_ROWS = 32_768
#: Cells for each differing pair. Peeling needs about 1.3; the rest is for what a sample misses. Cells are never shuffled, so they are cheap.
CELLS_PER_PAIR, SPARE_CELLS = 2.0, 48
PARTS = 3
ENLARGE = 4
ROUNDS = 3
#: Changed key hashes up to which they are sent to all executors (16 bytes each).
SENT_HASHES = 1_000_000
#: Deliveries up to which their list (three numbers each) is sent to all executors.
SENT_DELIVERIES = 100_000
DIGEST = -1
CHECK_SEED, DIGEST_SEED = 7, 11
OUTER_BLANKS = r"^[\s\p{Z}\x0b\x1c-\x1f\x{85}\x{feff}]+|[\s\p{Z}\x0b\x1c-\x1f\x{85}\x{feff}]+$"


def _u(x: int) -> np.uint64:
    return np.uint64(x)


def hash_long(value: np.ndarray, seed: np.ndarray | int) -> np.ndarray:
    """XXH64 of one 64-bit integer, as Spark's ``xxhash64`` has it."""
    p1, p2, p3, p4, p5 = (_u(p) for p in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5))
    rotate = lambda x, n: (x << _u(n)) | (x >> _u(64 - n))
    with np.errstate(over="ignore"):
        h = np.asarray(seed, dtype=np.uint64) + p5 + _u(8)
        h = h ^ (rotate(value.view(np.uint64) * p2, 31) * p1)
        h = rotate(h, 27) * p1 + p4
        h = (h ^ (h >> _u(33))) * p2
        h = (h ^ (h >> _u(29))) * p3
        return h ^ (h >> _u(32))


def hash_pairs(keys: np.ndarray, values: np.ndarray, seed: int | None = None) -> np.ndarray:
    """``xxhash64(key, value[, seed])`` of Spark."""
    h = hash_long(values, hash_long(keys, 42))
    return (h if seed is None else hash_long(np.full(len(keys), seed, np.int64), h)).view(np.int64)


def cells_of(hashes: np.ndarray, size: int) -> np.ndarray:
    """The cell of each part (rows: parts) for pair hashes; ``size`` cells make a part."""
    h = hashes.view(np.uint64)
    return np.stack([part * size + ((h >> _u(20 * part)) & _u(0xFFFFF)).astype(np.int64) % size for part in range(PARTS)])


def peel(count: np.ndarray, key: np.ndarray, value: np.ndarray, check: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, bool]:
    """(keys, values, signs) of the pairs in a subtracted table, and whether nothing remains. The arrays are used up."""
    size = len(count) // PARTS
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    while True:
        at = np.flatnonzero(np.abs(count) == 1)
        at = at[hash_pairs(key[at], value[at], CHECK_SEED) == check[at]]
        if not len(at):
            break
        _, once = np.unique(np.stack([key[at], value[at]], 1), axis=0, return_index=True)
        at = at[once]
        k, v, c, sign = key[at].copy(), value[at].copy(), check[at].copy(), count[at].copy()
        for cell in cells_of(hash_pairs(k, v), size):
            np.subtract.at(count, cell, sign)
            np.bitwise_xor.at(key, cell, k)
            np.bitwise_xor.at(value, cell, v)
            np.bitwise_xor.at(check, cell, c)
        found.append((k, v, sign))
        if sum(len(f[0]) for f in found) > len(count):
            return *_joined(found), False
    return *_joined(found), not (count.any() or key.any() or value.any() or check.any())


def _joined(found: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    empty = np.zeros(0, np.int64)
    return tuple(np.concatenate([empty, *(f[i] for f in found)]) for i in range(3))  # type: ignore[return-value]


def _tables(signed: DataFrame, by: list[str], size: int) -> DataFrame:
    """Cells of pairs ``kh, vh`` with ``sign``, grouped by ``by``."""
    h = F.xxhash64("kh", "vh")
    cell = lambda part: (F.shiftrightunsigned(F.col("h"), 20 * part).bitwiseAND(F.lit(0xFFFFF)) % size + part * size).cast("int")
    spread = signed.withColumn("h", h).withColumn("cell", F.explode(F.array(F.lit(DIGEST), *[cell(p) for p in range(PARTS)])))
    check = F.when(F.col("cell") == DIGEST, F.xxhash64("kh", "vh", F.lit(DIGEST_SEED).cast("long"))).otherwise(F.xxhash64("kh", "vh", F.lit(CHECK_SEED).cast("long")))
    in_cell = lambda c: F.when(F.col("cell") == DIGEST, F.lit(0).cast("long")).otherwise(F.col(c))
    return spread.groupBy(*by, "cell").agg(F.sum("sign").alias("n"), F.bit_xor(in_cell("kh")).alias("k"), F.bit_xor(in_cell("vh")).alias("v"), F.bit_xor(check).alias("c"))


def _peeled(cells: DataFrame, size: int) -> DataFrame:
    """``later, bucket, kh, sign``, or ``sign`` 0 for a bucket that failed, from cells of subtracted tables."""
    differing = cells.filter("n <> 0 OR k <> 0 OR v <> 0 OR c <> 0")
    tables = differing.groupBy("later", "bucket").agg(F.collect_list(F.struct("cell", "n", "k", "v", "c")).alias("cells"))  # at most PARTS * size + 1 cells

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(2)
            offsets, flat = lists.offsets.to_numpy(), lists.values
            column = {f: flat.field(f).to_numpy() for f in ("cell", "n", "k", "v", "c")}
            rows: list[list[np.ndarray]] = []
            for i in range(batch.num_rows):
                part = slice(offsets[i], offsets[i + 1])
                cell = column["cell"][part]
                own = cell != DIGEST
                full = [np.zeros(PARTS * size, np.int64) for _ in range(4)]
                for target, f in zip(full, ("n", "k", "v", "c")):
                    target[cell[own]] = column[f][part][own]
                digest_n = int(column["n"][part][~own].sum())
                digest_c = int(column["c"][part][~own].sum())
                keys, values, signs, done = peel(*full)
                agreed = done and signs.sum() == digest_n and np.bitwise_xor.reduce(hash_pairs(keys, values, DIGEST_SEED), initial=0) == digest_c
                if not agreed:
                    keys, signs = np.zeros(1, np.int64), np.zeros(1, np.int64)
                rows.append([np.full(len(keys), i), keys, signs])
            if rows:
                which, keys, signs = (np.concatenate(c) for c in zip(*rows))
                take = pa.array(which.astype(np.int64))
                yield pa.RecordBatch.from_arrays([batch.column(0).take(take), batch.column(1).take(take), pa.array(keys), pa.array(signs.astype(np.int32))], ["later", "bucket", "kh", "sign"])

    return tables.select("later", "bucket", "cells").mapInArrow(run, "later int, bucket bigint, kh bigint, sign int")


def changes(df: DataFrame, key: str, snapshot: str, value: Column, order: str) -> DataFrame:
    """``record_key, snapshot_no, change_kind`` between each two successive snapshot numbers in ``df``.

    The row of a key with the latest ``order`` holds for its snapshot (a null order
    is the earliest; of equally late rows the one with the largest value hash).
    Rows with a null key or snapshot number don't count. Null values equal null
    only. The first snapshot reports nothing; a snapshot that is missing is passed
    over; an empty table gives no rows. Other columns aren't read.
    """
    total = df.count()
    narrow = df.select(df[key].cast("string").alias("key"), df[snapshot].cast("int").alias("at"), value.alias("value"), df[order].alias("order")).filter("key IS NOT NULL AND at IS NOT NULL")
    buckets = max(1, -(-total // ROWS_PER_BUCKET))
    bucket = F.pmod(F.xxhash64(F.lit(3), "key"), F.lit(buckets))
    sizes = settle(narrow.groupBy("at", bucket.alias("bucket")).agg(F.count(F.lit(1)).alias("n")))  # one row per snapshot and bucket
    numbers = sizes.select("at").distinct()  # one row per delivery
    following = settle(numbers.select("at", F.lead("at").over(Window.orderBy("at")).alias("next"), F.lag("at").over(Window.orderBy("at")).alias("last")))
    deliveries = max(1, following.count())
    if deliveries <= SENT_DELIVERIES:
        following = F.broadcast(following)
    hot = sizes.groupBy("bucket").agg(F.sum("n").alias("n")).filter(F.col("n") >= HOT_BUCKET * ROWS_PER_BUCKET).select("bucket", F.lit(True).alias("_hot"))
    any_hot = not hot.isEmpty()

    def hashed(rows: DataFrame) -> DataFrame:
        vh = F.when(F.col("value").isNull(), F.lit(0).cast("long")).otherwise(F.xxhash64(F.lit(5), F.col("value")))
        return rows.select("at", bucket.alias("bucket"), F.xxhash64("key").alias("kh"), vh.alias("vh"), "order")

    def latest(rows: DataFrame) -> DataFrame:
        return rows.groupBy("at", "bucket", "kh").agg(F.max(F.struct("order", "vh")).alias("held"))

    def holding(rows: DataFrame) -> DataFrame:
        """The pair of each key and snapshot, with all rows of a bucket in one task."""
        if any_hot:
            marked = rows.join(hot, "bucket", "left")
            thinned = latest(marked.filter("_hot"))  # one row per key and snapshot leaves each task
            rows = marked.filter("_hot IS NULL").select(*rows.columns).unionByName(thinned.select("at", "bucket", "kh", "held.vh", "held.order").select(*rows.columns))
        return latest(rows.repartition("bucket")).select("at", "bucket", "kh", F.col("held.vh").alias("vh"))

    def both_ways(rows: DataFrame) -> DataFrame:
        """Each row as part of the later (way 1) and of the earlier (way -1) snapshot of a comparison."""
        as_later = F.struct(F.when(F.col("last").isNotNull(), F.col("at")).alias("later"), F.lit(1).alias("way"))
        as_earlier = F.struct(F.col("next").alias("later"), F.lit(-1).alias("way"))
        met = rows.join(following, "at").withColumn("side", F.explode(F.array(as_later, as_earlier))).filter("side.later IS NOT NULL")
        return met.select(*[c for c in rows.columns if c != "at"], "side.later", "side.way")

    one_in = max(1, total // SAMPLE_ROWS)
    sampled = hashed(narrow.filter(F.pmod(F.xxhash64(F.lit(9), "key"), F.lit(one_in)) == 0))
    differ = both_ways(latest(sampled).select("at", "bucket", "kh", F.col("held.vh").alias("vh"))).groupBy("later", "kh", "vh").agg(F.sum("way").alias("n")).filter("n <> 0")
    most = differ.groupBy("later").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0
    pairs = most * one_in / buckets
    size = int(CELLS_PER_PAIR * (pairs + 4 * pairs**0.5) + SPARE_CELLS) // PARTS + 1

    own = _tables(holding(hashed(narrow)).withColumn("sign", F.lit(1).cast("long")), ["at", "bucket"], size)
    subtracted = both_ways(own).groupBy("later", "bucket", "cell").agg(F.sum(F.col("n") * F.col("way")).alias("n"), *[F.bit_xor(c).alias(c) for c in ("k", "v", "c")])
    done = settle(_peeled(subtracted, size))
    results = [done.filter("sign <> 0")]
    failed = done.filter("sign = 0").select("later", "bucket")
    for turn in range(1, ROUNDS + 1):
        if failed.isEmpty():
            break
        size *= ENLARGE
        # rows of failed buckets only are read again; a cell number must fit the 20 bits a part takes from the hash
        rows = hashed(narrow).join(failed.select("bucket").distinct(), "bucket", "left_semi")
        again = both_ways(holding(rows)).join(failed, ["later", "bucket"]).withColumn("sign", F.col("way").cast("long"))
        if turn < ROUNDS and size < 1 << 20:
            done = settle(_peeled(_tables(again, ["later", "bucket"], size), size))
            results.append(done.filter("sign <> 0"))
            failed = done.filter("sign = 0").select("later", "bucket")
        else:
            left = again.groupBy("later", "bucket", "kh", "vh").agg(F.sum("sign").alias("sign")).filter("sign <> 0")
            results.append(left.select("later", "bucket", "kh", F.col("sign").cast("int").alias("sign")))
            break
    differing = results[0]
    for more in results[1:]:
        differing = differing.unionByName(more)
    kinds = settle(differing.groupBy("later", "bucket", "kh").agg(F.max("sign").alias("new"), F.min("sign").alias("old")))
    kind = F.when(F.col("new") < 0, "removed").when(F.col("old") > 0, "added").otherwise("changed")
    wanted = kinds.select("bucket", "kh").distinct()
    if kinds.count() <= SENT_HASHES:
        wanted = F.broadcast(wanted)
    # the text of a key is looked up for changed hashes only, and made single behind that
    names = narrow.select("key", bucket.alias("bucket"), F.xxhash64("key").alias("kh")).join(wanted, ["bucket", "kh"], "left_semi").distinct()
    return kinds.join(names, ["bucket", "kh"]).select(F.col("key").alias("record_key"), F.col("later").alias("snapshot_no"), kind.alias("change_kind"))


def trimmed_lower(column: Column) -> Column:
    """Text for comparison: outer blanks of any kind and letter case don't count."""
    return F.lower(F.regexp_replace(column, OUTER_BLANKS, ""))
