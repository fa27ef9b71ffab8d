"""A landing folder as a stream: each micro-batch of lines is parsed and merged into the rule table.

The rule table is kept as Parquet, a folder for each batch with the parts that it
touched, so a batch that is run again after a failure finds the state of the batch before it. What is merged is
associative (sources and category), so batches may come in any order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions import domains as D
from ..operators import compile as K
from ..operators.parse import ParseOptions, parse, rules_of
from ..runtime import settle
from ..sources.store import Store

LINES = "source_ord int, line_no bigint, line string, category string"
RULES = "rule_type string, domain string, wildcard boolean, modifiers string, raw string, category string, source_ords array<int>"


def merge_rules(state: DataFrame, more: DataFrame) -> DataFrame:
    """Two rule tables as one, with merged sources and categories."""
    both = state.unionByName(more).withColumn("_p", F.coalesce(D.priority(F.col("category")), F.lit(D.LEAST_PRIORITY)))
    best = F.min(F.struct("_p", "category"))["category"]
    return both.groupBy("rule_type", "domain", "wildcard", "modifiers", "raw").agg(best.alias("category"), F.array_sort(F.array_distinct(F.flatten(F.collect_set("source_ords")))).alias("source_ords"))


def _complete(store: Store, folder: str) -> list[int]:
    """Numbers of the batches whose table is complete."""
    return sorted(int(n) for n in store.names(folder) if n.isdigit() and store.exists(f"{folder}/{n}/_DONE"))


def _state(spark: SparkSession, store: Store, folder: str, number: int) -> DataFrame:
    """The rule table after a batch: of each part, the newest writing up to that batch."""
    parts = store.read_json(f"{folder}/{number}/_DONE")["parts"]
    paths = [f"{folder}/{n}/part={p}" for p, n in parts.items()]
    return spark.read.schema(RULES).parquet(*paths) if paths else spark.createDataFrame([], RULES)


def current(spark: SparkSession, folder: str) -> DataFrame:
    """The rule table after the last complete batch."""
    store = Store(spark)
    done = _complete(store, folder)
    return _state(spark, store, folder, done[-1]) if done else spark.createDataFrame([], RULES)


def start(spark: SparkSession, landing: str, folder: str, checkpoint: str, options: ParseOptions = ParseOptions(), parts: int = 16) -> StreamingQuery:
    """Follows Parquet files of ``LINES`` in ``landing`` into the table under ``folder``.

    The table is dealt into ``parts`` by a hash of the domain (of the text, for patterns); a
    batch reads and writes those parts only that its rules touch. What a batch lacks is
    taken from the batch that wrote it last. A batch behind the first that doesn't find
    the one before it raises rather than starting anew.
    """
    lines = spark.readStream.schema(LINES).parquet(landing)
    part = F.pmod(F.xxhash64(F.when(F.col("domain") == "", F.col("raw")).otherwise(F.col("domain"))), F.lit(parts)).cast("int")

    def step(batch: DataFrame, number: int) -> None:
        own, store = batch.sparkSession, Store(batch.sparkSession)
        before = [n for n in _complete(store, folder) if n < number]
        if number and (not before or before[-1] != number - 1):
            raise RuntimeError(f"batch {number} doesn't find the table of batch {number - 1} in {folder}")
        held = store.read_json(f"{folder}/{number - 1}/_DONE")["parts"] if number else {}
        new = settle(K.dedup(rules_of(parse(batch, options))).select(*K.RULE).withColumn("part", part))
        touched = [str(r["part"]) for r in new.select("part").distinct().collect()]  # at most ``parts``
        old = [f"{folder}/{held[p]}/part={p}" for p in touched if p in held]
        state = own.read.schema(RULES).parquet(*old) if old else own.createDataFrame([], RULES)
        merged = merge_rules(state, new.drop("part")).withColumn("part", part)
        store.remove(f"{folder}/{number}")
        merged.write.partitionBy("part").parquet(f"{folder}/{number}")
        now = held | {p: number for p in touched}
        store.write_json(f"{folder}/{number}/_DONE", {"parts": now})
        # what neither this batch nor the one before it needs, should that run again
        needed = {*now.values(), *held.values(), number, number - 1}
        for n in _complete(store, folder):
            if n < number and n not in needed:
                store.remove(f"{folder}/{n}")

    return lines.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
