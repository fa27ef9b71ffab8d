"""Queries of the general data problems, with SQL for comparison."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import snapshots
from ..runtime import table
from ..sources import records


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = table(spark, sf_dir, "merged_rules")
    cache = table(spark, sf_dir, "cache_entries")
    of_rules = snapshots.changes(rules, "rule_id", "snapshot_no", snapshots.trimmed_lower(rules["raw"]), "delivered_at")
    of_cache = snapshots.changes(cache, "url", "snapshot_no", snapshots.trimmed_lower(cache["content_hash"]), "fetched_at")
    named = lambda df, name: df.select(F.lit(name).alias("table_name"), "record_key", "snapshot_no", "change_kind")
    return named(of_rules, "merged_rules").unionByName(named(of_cache, "cache_entries"))


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records.split_records(table(spark, sf_dir, "rule_feed")).filter("reason IS NOT NULL").select("feed_id", "reason")


def p3_loaded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records.split_records(table(spark, sf_dir, "rule_feed")).filter("reason IS NULL").drop("reason", "reason_column", "reason_at").withColumn("added_on", F.col("added_on").cast("string"))


def p3_rejected(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records.split_records(table(spark, sf_dir, "rule_feed")).filter("reason IS NOT NULL").select("feed_id", "reason", "reason_column", "reason_at")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (p1_found, p3_found, p3_loaded, p3_rejected)}


_HELD = r"""SELECT {key}::VARCHAR AS record_key, snapshot_no, lower(regexp_replace({value}, '^[\s\pZ\x0b]+|[\s\pZ\x0b]+$', '', 'g')) AS v
    FROM {table} WHERE {key} IS NOT NULL QUALIFY row_number() OVER (PARTITION BY {key}, snapshot_no ORDER BY {order} DESC NULLS LAST) = 1"""

_COMPARED = """SELECT '{table}' AS table_name, coalesce(a.record_key, b.record_key) AS record_key, coalesce(a.snapshot_no, b.next) AS snapshot_no,
  CASE WHEN b.record_key IS NULL THEN 'added' WHEN a.record_key IS NULL THEN 'removed' ELSE 'changed' END AS change_kind
FROM (SELECT h.*, n.last FROM {h} h JOIN {n} n USING (snapshot_no) WHERE n.last IS NOT NULL) a
FULL JOIN (SELECT h.*, n.next FROM {h} h JOIN {n} n USING (snapshot_no) WHERE n.next IS NOT NULL) b ON a.record_key = b.record_key AND a.snapshot_no = b.next
WHERE a.record_key IS NULL OR b.record_key IS NULL OR a.v IS DISTINCT FROM b.v"""

_NUMBERS = "SELECT snapshot_no, lag(snapshot_no) OVER (ORDER BY snapshot_no) AS last, lead(snapshot_no) OVER (ORDER BY snapshot_no) AS next FROM (SELECT DISTINCT snapshot_no FROM {table})"

_TABLES = (("merged_rules", "rule_id", "raw", "delivered_at", "h1", "n1"), ("cache_entries", "url", "content_hash", "fetched_at", "h2", "n2"))

#: A record is quoted well if it is a row of fields each of which has no quote, or is quoted with the inner ones doubled.
_FEED = r"""WITH b AS (SELECT feed_id, CASE WHEN body LIKE '%' || chr(13) THEN left(body, length(body) - 1) ELSE body END AS t FROM rule_feed),
q AS (SELECT feed_id, t, t IS NULL OR regexp_full_match(t, '(?s)([^",]*|"([^"]|"")*")(,([^",]*|"([^"]|"")*"))*') AS quoted FROM b),
f AS (SELECT feed_id, quoted, t IS NULL OR regexp_full_match(t, '[\s\pZ\x0b]*') AS blank,
  CASE WHEN quoted AND t IS NOT NULL THEN regexp_extract_all(t || ',', '(?s)([^",]*|"(?:[^"]|"")*"),', 1) END AS raw_fields FROM q),
v AS (SELECT feed_id, quoted, blank, len(raw_fields) AS n,
  list_transform(raw_fields, lambda x: CASE WHEN x LIKE '"%' THEN replace(substr(x, 2, length(x) - 2), '""', '"') ELSE regexp_replace(x, '^[\s\pZ\x0b]+|[\s\pZ\x0b]+$', '', 'g') END) AS c FROM f),
j AS (SELECT feed_id, c, CASE WHEN NOT quoted THEN 'quoting' WHEN blank OR n <> 7 THEN 'column_count'
  WHEN c[1] NOT IN ('block', 'allow') OR c[4] NOT IN ('true', 'false') OR c[6] NOT IN ('malware', 'phishing', 'mining', 'tracking', 'ads', 'other', '')
    OR NOT (c[7] = '' OR (regexp_full_match(c[7], '[0-9]{4}-[0-9]{2}-[0-9]{2}') AND try_cast(c[7] AS DATE) IS NOT NULL))
    OR NOT (regexp_full_match(c[2], '(?s)(@@)?/.+/(\$[a-z]+(,[a-z]+)*)?')
      OR (regexp_full_match(c[2], '(?s)(@@)?\|\|(\*\.)?[A-Za-z0-9_-]{1,63}(\.[A-Za-z0-9_-]{1,63})+\^(\$.+)?')
        AND length(regexp_extract(c[2], '^(@@)?\|\|(\*\.)?([^^]*)', 3)) BETWEEN 4 AND 253)) THEN 'invalid_value' END AS reason FROM v)
"""


def oracle_sql() -> dict[str, str]:
    with_ = ", ".join(f"{h} AS ({_HELD.format(table=t, key=k, value=v, order=o)}), {n} AS ({_NUMBERS.format(table=t)})" for t, k, v, o, h, n in _TABLES)
    return {
        "p1_found": f"WITH {with_} " + " UNION ALL ".join(_COMPARED.format(table=t, h=h, n=n) for t, _, _, _, h, n in _TABLES),
        "p3_found": _FEED + "SELECT feed_id, reason FROM j WHERE reason IS NOT NULL",
        "p3_loaded": _FEED + "SELECT feed_id, c[1] AS rule_type, c[2] AS raw, c[3] AS normalized_domain, c[4] = 'true' AS wildcard, c[5] AS modifiers, nullif(c[6], '') AS category, nullif(c[7], '') AS added_on FROM j WHERE reason IS NULL",
    }
