"""State of downloaded lists: latest entries, eviction, what has to be parsed again, errors."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..runtime import settle


def error_kind(message: Column) -> Column:
    """timeout, not_found, auth, dns, network or unknown, by what an error says; the first that holds."""
    m = F.lower(F.coalesce(message, F.lit("")))
    has = lambda *parts: F.greatest(*[m.contains(p) for p in parts]) if len(parts) > 1 else m.contains(parts[0])
    return (
        F.when(has("timeout", "deadline"), "timeout")
        .when(has("404"), "not_found")
        .when(has("403", "401"), "auth")
        .when(has("name or service not known", "nodename nor servname", "getaddrinfo failed", "name resolution"), "dns")
        .when(has("connect"), "network")
        .otherwise("unknown")
    )


def latest(entries: DataFrame) -> DataFrame:
    """The newest row of each url in the last snapshot."""
    last = entries.agg(F.max("snapshot_no").alias("snapshot_no"))
    newest = F.struct("fetched_at", F.coalesce("content_hash", F.lit("")), F.coalesce("size_bytes", F.lit(0)))
    columns = [c for c in entries.columns if c != "url"]
    held = entries.join(F.broadcast(last), "snapshot_no").filter("url IS NOT NULL").groupBy("url").agg(F.max_by(F.struct(*columns), newest).alias("r"))
    return held.select("url", "r.*")


def evicted(entries: DataFrame, max_bytes: int) -> DataFrame:
    """Entries to evict, oldest first, until the rest fits ``max_bytes``; ``content_kept`` if a remaining entry has the same content.

    Entries are dealt by ranges of their time and address. The running sum is built from the
    sums of the ranges before and a sum within each range, so no task sees more than
    its range, whatever time most entries share. Without a time, an entry is the oldest.
    """
    order = [F.col("fetched_at").desc_nulls_last(), F.col("url").asc_nulls_last()]
    ranged = settle(entries.withColumn("_size", F.coalesce("size_bytes", F.lit(0))).repartitionByRange(*order).withColumn("_range", F.spark_partition_id()))
    ranges = ranged.groupBy("_range").agg(F.sum("_size").alias("_sum"))  # one row per task
    newer = ranges.select("_range", F.coalesce(F.sum("_sum").over(Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_newer"))
    within = F.sum("_size").over(Window.partitionBy("_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))
    summed = ranged.withColumn("_within", within).join(newer, "_range").withColumn("_out", F.col("_within") + F.col("_newer") > max_bytes)
    kept = summed.filter("NOT _out AND content_hash IS NOT NULL").select("content_hash", F.lit(True).alias("_kept")).distinct()
    gone = summed.filter("_out").join(kept, "content_hash", "left")
    return gone.withColumn("content_kept", F.coalesce("_kept", F.lit(False))).select(*entries.columns, "content_kept")


def stats(entries: DataFrame) -> DataFrame:
    return entries.agg(F.count(F.lit(1)).alias("entries"), F.coalesce(F.sum("size_bytes"), F.lit(0)).alias("total_bytes"), F.count_distinct("content_hash").alias("contents"))


def unchanged(entries: DataFrame) -> DataFrame:
    """``url`` of the last snapshot whose content was already there in an earlier one."""
    now = latest(entries).filter("content_hash IS NOT NULL").select("url", "content_hash", "snapshot_no")
    before = entries.select("content_hash", F.col("snapshot_no").alias("earlier")).filter("content_hash IS NOT NULL").groupBy("content_hash").agg(F.min("earlier").alias("earlier"))
    return now.join(before, "content_hash").filter("earlier < snapshot_no").select("url")


def ttl_valid(stored_at: Column, now: Column, ttl_seconds: int) -> Column:
    """Whether an entry is still valid; a ttl of 0 means forever."""
    return F.lit(True) if ttl_seconds <= 0 else F.unix_timestamp(stored_at) > F.unix_timestamp(now) - ttl_seconds
