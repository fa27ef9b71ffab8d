"""Statistics of a compiled rule set. Rates come with their parts; rounding is for display only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import domains as D
from ..runtime import settle


def rate(part: Column, whole: Column) -> Column:
    """Per cent with one decimal, 0 where there is no whole."""
    return F.when(whole == 0, 0.0).otherwise(F.bround(part / whole * 100, 1))


def _keyed(rules: DataFrame) -> DataFrame:
    return rules.withColumn("key", F.when(F.col("domain") == "", F.col("raw")).otherwise(F.col("domain")))


def _last() -> Column:
    """Order of the rules of a key: allow rules come last."""
    return F.struct(F.when(F.col("rule_type") == "block", 0).otherwise(1), ~F.col("wildcard"), "modifiers", "raw")


def coverage(rules: DataFrame) -> DataFrame:
    """``key, sources``: by domain (patterns: by text) how many sources the last rule has, allow rules coming last."""
    return _keyed(rules).groupBy("key").agg(F.max_by(F.size("source_ords"), _last()).alias("sources"))


def _by_source(rules: DataFrame) -> DataFrame:
    """``category, sources, source_ord``: each rule of each source, with the coverage of its key. A key has few rules (one per type, wildcard and modifiers), so one aggregate holds them."""
    keys = _keyed(rules).groupBy("key").agg(F.max_by(F.size("source_ords"), _last()).alias("sources"), F.collect_list(F.struct("category", "source_ords")).alias("_r"))
    return keys.select("sources", F.inline("_r")).select("category", "sources", F.explode("source_ords").alias("source_ord"))


def contributions(rules: DataFrame, raw: DataFrame) -> DataFrame:
    """Per source of ``raw`` (``source_ord, raw_rules``): unique, shared and effective rules, and their rates."""
    counted = _by_source(rules).groupBy("source_ord").agg(F.count_if(F.col("sources") == 1).alias("u"), F.count_if(F.col("sources") != 1).alias("s"))
    zero = lambda c: F.coalesce(c, F.lit(0))
    joined = raw.join(counted, "source_ord", "left").select("source_ord", "raw_rules", zero("u").alias("unique_rules"), zero("s").alias("shared_rules"))
    with_sum = joined.withColumn("effective_rules", F.col("unique_rules") + F.col("shared_rules"))
    return with_sum.withColumns({"coverage_rate": rate(F.col("effective_rules"), F.col("raw_rules")), "unique_rate": rate(F.col("unique_rules"), F.col("effective_rules"))})


def contribution_order(frame: DataFrame) -> DataFrame:
    return frame.orderBy(F.desc("unique_rules"), F.desc("effective_rules"), "source_ord")


def source_categories(rules: DataFrame) -> DataFrame:
    return _by_source(rules).groupBy("source_ord", "category").agg(F.count(F.lit(1)).alias("rules"))


def overlap_pairs(rules: DataFrame) -> DataFrame:
    """``source_a < source_b``: rules that both carry, and what each carries.

    Rules with the same set of sources are counted first, so pairs are spelled out
    once per distinct set.
    """
    sets = rules.groupBy("source_ords").agg(F.count(F.lit(1)).alias("n"))
    pair = F.expr("flatten(transform(source_ords, (x, i) -> transform(slice(source_ords, i + 1, size(source_ords)), y -> struct(x AS a, y AS b))))")
    # at most one row per two sources
    pairs = settle(sets.select(F.explode(pair).alias("p"), "n").groupBy(F.col("p.a").alias("source_a"), F.col("p.b").alias("source_b")).agg(F.sum("n").alias("overlap")))
    own = pairs.filter("source_a = source_b")
    sized = pairs.filter("source_a < source_b").join(own.select("source_a", F.col("overlap").alias("effective_a")), "source_a").join(own.select("source_b", F.col("overlap").alias("effective_b")), "source_b")
    return sized.withColumn("joint", F.col("effective_a") + F.col("effective_b") - F.col("overlap")).select("source_a", "source_b", "overlap", "effective_a", "effective_b", "joint")


def overlap_rates(pairs: DataFrame) -> DataFrame:
    rates = {"rate_a": rate(F.col("overlap"), F.col("effective_a")), "rate_b": rate(F.col("overlap"), F.col("effective_b")), "jaccard": rate(F.col("overlap"), F.col("joint"))}
    return pairs.withColumns(rates).withColumn("heat", F.when(F.col("overlap") * 100 < F.col("joint") * 20, "low").when(F.col("overlap") * 100 < F.col("joint") * 50, "medium").when(F.col("overlap") * 100 < F.col("joint") * 80, "high").otherwise("very high"))


def overlap_matrix(pairs: DataFrame) -> DataFrame:
    """Both directions of each pair, by source: ``source_ord, other, overlap``."""
    there = pairs.select(F.col("source_a").alias("source_ord"), F.col("source_b").alias("other"), "overlap")
    back = pairs.select(F.col("source_b").alias("source_ord"), F.col("source_a").alias("other"), "overlap")
    return there.unionByName(back)


def modifier_counts(rules: DataFrame) -> DataFrame:
    return rules.select(F.explode(D.modifier_list(F.col("modifiers"))).alias("modifier")).groupBy("modifier").agg(F.count(F.lit(1)).alias("rules"))


def kind_counts(rules: DataFrame) -> DataFrame:
    return rules.groupBy("rule_type", D.rule_kind(F.col("domain"), F.col("wildcard")).alias("kind")).agg(F.count(F.lit(1)).alias("rules"))


def category_counts(rules: DataFrame) -> DataFrame:
    return rules.groupBy("category").agg(F.count(F.lit(1)).alias("rules"))


def top_suffixes(rules: DataFrame, n: int = 20) -> DataFrame:
    """The ``n`` suffixes with most rules; of equal counts the smaller text first."""
    counted = rules.filter("domain <> ''").groupBy(D.suffix(F.col("domain")).alias("suffix")).agg(F.count(F.lit(1)).alias("rules"))
    return counted.orderBy(F.desc("rules"), "suffix").limit(n)


def length_stats(rules: DataFrame) -> DataFrame:
    n = F.length("domain")
    return rules.filter("domain <> ''").agg(F.count(F.lit(1)).alias("domains"), F.coalesce(F.sum(n), F.lit(0)).alias("total_length"), F.min(n).alias("min_length"), F.max(n).alias("max_length"))


def self_dedup(frame: DataFrame) -> DataFrame:
    """How much of its own rules each source loses: rows of :func:`contributions` with ``lost`` and ``self_dedup_rate``."""
    return frame.select("source_ord", "raw_rules", "effective_rules", (F.col("raw_rules") - F.col("effective_rules")).alias("lost"), rate(F.col("raw_rules") - F.col("effective_rules"), F.col("raw_rules")).alias("self_dedup_rate"))


def self_dedup_of(frame: DataFrame) -> DataFrame:
    """All columns of :func:`contributions` with ``self_dedup_rate``."""
    return frame.withColumn("self_dedup_rate", rate(F.col("raw_rules") - F.col("effective_rules"), F.col("raw_rules")))


def overlap_order(pairs: DataFrame) -> DataFrame:
    """Pairs with most common rules first; of equal ones the smaller sources."""
    return pairs.orderBy(F.desc("overlap"), "source_a", "source_b")


def dedup_rates(contributions: DataFrame) -> DataFrame:
    """``raw_rules, rules, dedup_rate`` over all sources, where a rule counts once for each source that keeps it."""
    total = contributions.agg(F.coalesce(F.sum("raw_rules"), F.lit(0)).alias("raw_rules"), F.coalesce(F.sum("effective_rules"), F.lit(0)).alias("rules"))
    return total.withColumn("dedup_rate", rate(F.col("raw_rules") - F.col("rules"), F.col("raw_rules")))


def with_modifiers(blocks: DataFrame) -> DataFrame:
    """Block rules that formats of bare domains leave out."""
    return blocks.agg(F.count_if(F.col("modifiers") != "").alias("skipped"))


def plain_domains(blocks: DataFrame) -> DataFrame:
    """Distinct domains of block rules without modifiers."""
    return blocks.filter("modifiers = '' AND domain <> ''").select("domain").distinct()


def only_in(left: DataFrame, right: DataFrame) -> DataFrame:
    """Distinct rows of ``left`` that ``right`` lacks: the added or removed side of a comparison of two runs."""
    return left.subtract(right)
