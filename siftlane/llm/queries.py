"""The queries of this subpackage, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..runtime import table
from . import bpe, formatting, frequent, overlap, packing, truncation


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return formatting.copies(table(spark, sf_dir, "parsed"))


def p2_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return formatting.rules(table(spark, sf_dir, "parsed"))


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return frequent.frequent(table(spark, sf_dir, "parsed"), "normalized_domain").select("normalized_domain")


def p4_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return frequent.frequent(table(spark, sf_dir, "parsed"), "normalized_domain", one_in=500).drop("approx_count")


def p4_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return frequent.frequent(table(spark, sf_dir, "parsed"), "normalized_domain", one_in=500)


def _named(name: str) -> F.Column:
    outer = f"^{formatting.BLANKS}|{formatting.BLANKS}$"
    return F.lower(F.regexp_replace(name, outer, ""))


def _stated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``item, set, step`` of rule_sources, with sets as spelled in sources.name."""
    names = table(spark, sf_dir, "sources").filter("name IS NOT NULL").groupBy(_named("name").alias("_key")).agg(F.min("name").alias("set"))
    rows = table(spark, sf_dir, "rule_sources").select(_named("name").alias("_key"), F.col("rule_id").alias("item"), F.col("run_id").alias("step"))
    return rows.join(names, "_key").select("item", "set", "step")


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = overlap.similar_pairs(overlap.maintained(_stated(spark, sf_dir), leaves=False), per_cent=20)
    return found.select(F.col("a").alias("name_a"), F.col("b").alias("name_b"))


def p5_overlaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shared rules over all runs together."""
    return overlap.maintained(_stated(spark, sf_dir), leaves=False).filter("a < b").select(F.col("a").alias("name_a"), F.col("b").alias("name_b"), F.col("n").alias("shared"))


def p5_current(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shared rules in the last run, from joins and leaves of all runs."""
    return overlap.maintained(_stated(spark, sf_dir), leaves=True).filter("a < b").select(F.col("a").alias("name_a"), F.col("b").alias("name_b"), F.col("n").alias("shared"))


def p5_by_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each run changes in the number of shared rules."""
    deltas = overlap.deltas_by_step(_stated(spark, sf_dir))
    return deltas.filter("a < b").select(F.col("step").alias("run_id"), F.col("a").alias("name_a"), F.col("b").alias("name_b"), "delta")


def p6_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode(table(spark, sf_dir, "documents"))


def p6_decoded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All texts again, from their ids."""
    return bpe.decode(bpe.encode(table(spark, sf_dir, "documents")))


def p7_packed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_texts(table(spark, sf_dir, "documents"))


def p8_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return truncation.judge(table(spark, sf_dir, "documents")).filter("truncated").select("doc_id")


def p8_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    return truncation.shares(truncation.judge(table(spark, sf_dir, "documents")))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    own = (p2_found, p2_rules, p4_found, p4_counts, p4_exact, p5_found, p5_overlaps, p5_current, p5_by_run, p6_ids, p6_decoded, p7_packed, p8_found, p8_shares)
    return {f.__name__: f for f in own}


_BLANK = r"[\s\pZ\x0b\x1c-\x1f\x{85}\x{180e}\x{200b}-\x{200d}\x{2060}\x{feff}]"

_CANON = rf"""
WITH squeezed AS (
  SELECT parsed_id, run_id, raw IS NOT NULL AS by_raw, rule_type, wildcard,
    lower(regexp_replace(raw, '{_BLANK}+', '', 'g')) AS t,
    lower(regexp_replace(coalesce(normalized_domain, ''), '{_BLANK}+', '', 'g')) AS dom,
    lower(regexp_replace(coalesce(modifiers, ''), '{_BLANK}+', '', 'g')) AS mods,
    lower(regexp_replace(rule_type, '{_BLANK}+', '', 'g')) AS kind
  FROM parsed),
cut AS (
  SELECT *, regexp_replace(t, '^@@', '') AS body, by_raw AND regexp_full_match(regexp_replace(t, '^@@', ''), '/.*/(\$.*)?') AS is_pattern
  FROM squeezed),
named AS (
  SELECT *, CASE WHEN is_pattern THEN regexp_extract(body, '^(/.*/)(\$.*)?$', 1)
      WHEN by_raw THEN regexp_replace(regexp_replace(regexp_extract(body, '^[^$]*'), '^\|+', ''), '^[.^]+|[.^]+$', '', 'g')
      ELSE regexp_replace(dom, '^[.^]+|[.^]+$', '', 'g') END AS nm,
    CASE WHEN is_pattern THEN regexp_extract(body, '^/.*/\$(.*)$', 1)
      WHEN by_raw THEN regexp_extract(body, '^[^$]*\$(.*)$', 1) ELSE mods END AS ms
  FROM cut),
canon AS (
  SELECT parsed_id, run_id,
    CASE WHEN by_raw THEN CASE WHEN t LIKE '@@%' THEN 'allow' ELSE 'block' END ELSE coalesce(kind, '-') END AS k,
    CASE WHEN is_pattern THEN 'p' WHEN by_raw THEN CASE WHEN nm LIKE '*.%' THEN 'dtrue' ELSE 'dfalse' END ELSE 'd' || coalesce(wildcard::VARCHAR, '-') END AS w,
    CASE WHEN is_pattern THEN nm ELSE regexp_replace(regexp_replace(nm, '^\*\.', ''), '^[.^]+|[.^]+$', '', 'g') END AS d,
    array_to_string(list_sort(list_distinct(list_filter(string_split(ms, ','), lambda x: x <> ''))), ',') AS m
  FROM named)
"""

_NAMES = r"""
WITH names AS (SELECT lower(regexp_replace(name, '^[\s\pZ]+|[\s\pZ]+$', '', 'g')) AS k, min(name) AS name FROM sources WHERE name IS NOT NULL GROUP BY 1),
m AS (SELECT rule_id, n.name AS name, min(run_id) AS run_id FROM rule_sources r JOIN names n ON n.k = lower(regexp_replace(r.name, '^[\s\pZ]+|[\s\pZ]+$', '', 'g'))
  WHERE rule_id IS NOT NULL GROUP BY 1, 2)
"""


_RUNS = (
    _NAMES
    + r""", d AS (SELECT DISTINCT rule_id, n.name AS name, run_id FROM rule_sources r JOIN names n ON n.k = lower(regexp_replace(r.name, '^[\s\pZ]+|[\s\pZ]+$', '', 'g')) WHERE rule_id IS NOT NULL AND run_id IS NOT NULL),
f AS (SELECT run_id, lead(run_id) OVER (ORDER BY run_id) AS next FROM (SELECT DISTINCT run_id FROM d)),
c AS (SELECT x.run_id, x.name AS name_a, y.name AS name_b, count(*) AS n FROM d x JOIN d y ON x.run_id = y.run_id AND x.rule_id = y.rule_id AND x.name < y.name GROUP BY 1, 2, 3)
"""
)


def oracle_sql() -> dict[str, str]:
    return {
        "p2_found": _CANON + """, g AS (SELECT parsed_id, min(parsed_id) OVER (PARTITION BY run_id, k, w, d, m) AS keep_id FROM canon)
SELECT keep_id, parsed_id AS copy_id FROM g WHERE parsed_id <> keep_id""",
        "p2_rules": _CANON + """, forms AS (SELECT c.*, CASE WHEN raw IS NULL THEN 'f' || coalesce(rule_type, '-') || '|' || coalesce(wildcard::VARCHAR, '-') || '|' || coalesce(normalized_domain, '-') || '|' || coalesce(p.modifiers, '-') ELSE 'r' || raw END AS form
  FROM canon c JOIN parsed p USING (parsed_id))
SELECT min(parsed_id) AS keep_id, run_id, k || ' ' || w || ' ' || d || ' ' || m AS rule, count(*) AS copies, count(DISTINCT form) AS forms FROM forms GROUP BY 2, 3""",
        "p4_found": r"""WITH v AS (SELECT lower(regexp_replace(normalized_domain, '^[.\s\pZ]+|[.\s\pZ]+$', '', 'g')) AS normalized_domain FROM parsed
  WHERE regexp_matches(normalized_domain, '[^\s\pZ]'))
SELECT normalized_domain FROM v GROUP BY 1 HAVING count(*) * 200 >= (SELECT count(*) FROM v)""",
        "p4_exact": r"""WITH v AS (SELECT lower(regexp_replace(normalized_domain, '^[.\s\pZ]+|[.\s\pZ]+$', '', 'g')) AS normalized_domain FROM parsed
  WHERE regexp_matches(normalized_domain, '[^\s\pZ]'))
SELECT normalized_domain, count(*) AS exact_count FROM v GROUP BY 1 HAVING count(*) * 500 >= (SELECT count(*) FROM v)""",
        "p6_decoded": "SELECT doc_id, coalesce(text, '') AS text FROM documents",
        "p5_found": _NAMES + """, s AS (SELECT name, count(*) AS n FROM m GROUP BY 1),
p AS (SELECT x.name AS name_a, y.name AS name_b, count(*) AS shared FROM m x JOIN m y ON x.rule_id = y.rule_id AND x.name < y.name GROUP BY 1, 2)
SELECT name_a, name_b FROM p JOIN s a ON a.name = name_a JOIN s b ON b.name = name_b WHERE shared * 100 >= (a.n + b.n - shared) * 20""",
        "p5_overlaps": _NAMES + "SELECT x.name AS name_a, y.name AS name_b, count(*) AS shared FROM m x JOIN m y ON x.rule_id = y.rule_id AND x.name < y.name GROUP BY 1, 2",
        "p5_current": _RUNS + "SELECT name_a, name_b, n AS shared FROM c WHERE run_id = (SELECT max(run_id) FROM d)",
        "p5_by_run": _RUNS + """, z AS (SELECT run_id, name_a, name_b, n FROM c UNION ALL SELECT next, name_a, name_b, -n FROM c JOIN f USING (run_id) WHERE next IS NOT NULL)
SELECT run_id, name_a, name_b, sum(n)::BIGINT AS delta FROM z GROUP BY 1, 2, 3 HAVING sum(n) <> 0""",
    }
