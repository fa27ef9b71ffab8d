"""Queries on rule lists: parsing, compilation, statistics, classification, audit, exports."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import domains as D
from ..operators import audit as A
from ..operators import classify as C
from ..operators import compile as K
from ..operators import parse as P
from ..operators import stats as S
from ..sources import cache, files
from ..sources.fixture import rule_lines, sibling_lines
from ..runtime import ensure_checkpoint_dir, settle, table
from . import exports, rule_oracle

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}

#: Classifications that the default queries know; a full list is a parameter of the operator.
KNOWN_DOMAINS = [("promo.click", "advertising", 0), ("test.net", "analytics", 1), ("click", "affiliate", 2)]


def query(f: Query) -> Query:
    _QUERIES[f.__name__] = f
    return f


def _joined(ords: str) -> Column:
    return F.array_join(F.col(ords).cast("array<string>"), ",")


def _parsed(spark: SparkSession, sf_dir: str, **o: object) -> DataFrame:
    return P.parse(rule_lines(spark, sf_dir), P.ParseOptions(**o))  # type: ignore[arg-type]


def _rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.rules_of(_parsed(spark, sf_dir))


def _compiled(spark: SparkSession, sf_dir: str, **o: object) -> K.Compiled:
    return K.compile_rules(_rules(spark, sf_dir), K.CompileOptions().with_(**o))


def _flat(rules: DataFrame) -> DataFrame:
    return rules.select("rule_type", "domain", "wildcard", "modifiers", "raw", "category", _joined("source_ords").alias("sources"))


# Lines and rules


@query
def fixture_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rule_lines(spark, sf_dir).select("source_ord", "line_no", "line")


@query
def parse_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rules(spark, sf_dir)


@query
def parse_rules_strip_www(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.rules_of(_parsed(spark, sf_dir, strip_www=True))


@query
def parse_rules_filter_ip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rules on addresses are left out; numbers that are none stay."""
    k, text = F.col("o_orderkey"), lambda c: c.cast("string")
    ip = F.concat_ws(".", text(k % 256), text(k % 7), text(k * 3 % 300), text(k % 11))
    line = F.concat(F.lit("||"), F.when(k % 3 == 0, ip).otherwise(F.concat(F.lit("d"), text(k % 61), F.lit(".example.com"))), F.lit("^"))
    lines = table(spark, sf_dir, "orders").select((F.col("o_custkey") % 6).cast("int").alias("source_ord"), k.alias("line_no"), line.alias("line"), F.lit("ads").alias("category"))
    return P.rules_of(P.parse(lines, P.ParseOptions(filter_ip_rules=True))).select("source_ord", "line_no", "domain")


@query
def parse_drops(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _parsed(spark, sf_dir).filter("drop_reason IS NOT NULL").groupBy("drop_reason").agg(F.count(F.lit(1)).alias("lines"))


@query
def drop_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.drop_counters(_parsed(spark, sf_dir))


@query
def raw_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.raw_counts(_parsed(spark, sf_dir))


@query
def dedup_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flat(K.dedup(_rules(spark, sf_dir)))


@query
def dedup_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return K.dedup_counters(K.dedup(_rules(spark, sf_dir)))


@query
def dedup_counters_strip_www(spark: SparkSession, sf_dir: str) -> DataFrame:
    return K.dedup_counters(K.dedup(P.rules_of(_parsed(spark, sf_dir, strip_www=True))))


@query
def category_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.category_counts(K.dedup(_rules(spark, sf_dir)).filter("rule_type = 'block'"))


# Voiding, folding, conflicts


@query
def badfilter_survivors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flat(_compiled(spark, sf_dir).cleared)


@query
def badfilter_removed(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = _compiled(spark, sf_dir)
    keys = ["rule_type", "domain", "wildcard", "modifiers", "raw"]
    return c.deduped.select(*keys).subtract(c.cleared.select(*keys))


@query
def ancestors(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = _rules(spark, sf_dir).filter("domain <> ''").select("domain").distinct()
    return d.select("domain", F.posexplode(D.ancestors(F.col("domain"), 2)).alias("depth", "parent"))


def _fold(spark: SparkSession, sf_dir: str, suffixes: DataFrame | None = None, **o: object) -> K.Folded:
    rules = settle(K.dedup(_rules(spark, sf_dir)))
    blocks, allows = K.split(settle(K.badfilter(rules)))
    return K.fold(blocks, allows, K.FoldOptions(**o), K.cancelled(rules), suffixes)  # type: ignore[arg-type]


def _fate(folded: K.Folded, fate: str) -> DataFrame:
    return folded.marked.filter(F.col("fate") == fate).select("domain", "wildcard", "keeper_domain", "keeper_wildcard")


@query
def fold_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _fate(_fold(spark, sf_dir), "exact")


@query
def fold_wildcard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _fate(_fold(spark, sf_dir), "wildcard")


@query
def fold_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _fold(spark, sf_dir).counters()


@query
def fold_counters_promoting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _fold(spark, sf_dir, promotion_threshold=5).counters()


def _promotions(lines: DataFrame, suffixes: DataFrame | None = None, **o: object) -> DataFrame:
    rules = settle(K.dedup(P.rules_of(P.parse(lines))))
    blocks, _ = K.split(K.badfilter(rules.select(*K.RULE)))
    found = K.promotions(blocks, K.FoldOptions(**o), K.cancelled(rules), suffixes)  # type: ignore[arg-type]
    return found.select("parent", "children", "category", _joined("source_ords").alias("sources"))


@query
def promote_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _promotions(rule_lines(spark, sf_dir), promotion_threshold=5)


@query
def promote_siblings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _promotions(sibling_lines(spark, sf_dir), promotion_threshold=3, suffix_guard=False)


@query
def promote_pattern(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parents enough of whose children are numbered through."""
    return _promotions(sibling_lines(spark, sf_dir), promotion_threshold=3, suffix_guard=False, mode="pattern", pattern_ratio=0.6)


@query
def promote_guarded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parents that aren't public suffixes: by a plain rule, below a wildcard, not by an exception."""
    listed = spark.createDataFrame([("com", "plain"), ("net", "plain"), ("uk", "plain"), ("co.uk", "plain"), ("ck", "wildcard"), ("www.ck", "exception")], "rule_domain string, kind string")
    return _promotions(sibling_lines(spark, sf_dir), listed, promotion_threshold=3)


@query
def promote_guarded_by_rule(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _promotions(sibling_lines(spark, sf_dir), promotion_threshold=3)


@query
def fold_provenance(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = K.fold_provenance(_fold(spark, sf_dir))
    return f.select("domain", "wildcard", "modifiers", "raw", "category", _joined("source_ords").alias("sources"), "folded_in")


@query
def fold_provenance_stepwise(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = K.fold_provenance_stepwise(_fold(spark, sf_dir, promotion_threshold=5))
    return f.select("domain", "wildcard", "modifiers", "raw", "category", _joined("source_ords").alias("sources"), "folded_in")


def _conflict_rows(found: DataFrame) -> DataFrame:
    return K.conflict_records(found).withColumns({"blocked_sources": _joined("blocked_sources"), "whitelist_sources": _joined("whitelist_sources")})


@query
def conflicts_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _conflict_rows(_compiled(spark, sf_dir, folding=False).conflicts)


@query
def conflicts_nocascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _conflict_rows(_compiled(spark, sf_dir, folding=False, cascade=False).conflicts)


@query
def conflict_type_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _compiled(spark, sf_dir).conflicts.groupBy("conflict_type").agg(F.count(F.lit(1)).alias("rules"))


@query
def compiled_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = _compiled(spark, sf_dir).rules
    text = D.output_text(F.col("rule_type"), F.col("domain"), F.col("wildcard"), F.col("modifiers"), F.col("raw"))
    return K.ordered(rules).select("rule_type", "domain", "wildcard", "modifiers", text.alias("rule"), "category", _joined("source_ords").alias("sources"))


@query
def allow_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flat(_compiled(spark, sf_dir).allows)


@query
def funnel(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = _compiled(spark, sf_dir).keep()
    n = lambda df, name: df.agg(F.count(F.lit(1)).alias(name))
    assert c.folded is not None
    frames = [
        c.deduped.agg(F.coalesce(F.sum("copies"), F.lit(0)).alias("raw_rules"), F.count(F.lit(1)).alias("after_dedup")),
        n(c.cleared, "after_badfilter"),
        n(c.folded.survivors, "blocks_after_fold"),
        n(c.blocks, "blocks"),
        n(c.allows, "allows"),
    ]
    one = frames[0].withColumn("_", F.lit(1))
    for f in frames[1:]:  # one row each
        one = one.join(f.withColumn("_", F.lit(1)), "_")
    return one.drop("_")


def _blocks_of_some(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The result of an earlier run, when only the first five sources existed."""
    earlier = _rules(spark, sf_dir).filter("source_ord <= 4")
    return K.compile_rules(earlier).blocks


@query
def diff_added(spark: SparkSession, sf_dir: str) -> DataFrame:
    now, before = _compiled(spark, sf_dir).blocks, _blocks_of_some(spark, sf_dir)
    return S.only_in(now.filter("domain <> ''").select("domain"), before.filter("domain <> ''").select("domain"))


@query
def diff_removed(spark: SparkSession, sf_dir: str) -> DataFrame:
    now, before = _compiled(spark, sf_dir).blocks, _blocks_of_some(spark, sf_dir)
    return S.only_in(before.filter("domain <> ''").select("domain"), now.filter("domain <> ''").select("domain"))


# Statistics


def _contributions(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = _parsed(spark, sf_dir)
    return S.contributions(K.compile_rules(P.rules_of(parsed)).rules, P.raw_counts(parsed))


@query
def contributions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.contribution_order(_contributions(spark, sf_dir).drop("coverage_rate", "unique_rate"))


@query
def contribution_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _contributions(spark, sf_dir).select("source_ord", "effective_rules", "raw_rules", "unique_rules", "coverage_rate", "unique_rate")


@query
def dedup_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.dedup_rates(_contributions(spark, sf_dir))


@query
def source_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.source_categories(_compiled(spark, sf_dir).rules)


@query
def overlap_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.overlap_pairs(_compiled(spark, sf_dir).rules)


@query
def overlap_heat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.overlap_rates(S.overlap_pairs(_compiled(spark, sf_dir).rules)).select("source_a", "source_b", "heat")


@query
def overlap_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All rates, with the place of each pair in the order of reports."""
    rated = S.overlap_rates(S.overlap_pairs(_compiled(spark, sf_dir).rules)).drop("heat")
    in_order = Window.orderBy(F.desc("overlap"), "source_a", "source_b")  # one row per two sources
    return rated.withColumn("place", F.row_number().over(in_order))


@query
def overlap_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.overlap_matrix(S.overlap_pairs(_compiled(spark, sf_dir).rules))


@query
def modifier_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.modifier_counts(_compiled(spark, sf_dir).rules)


@query
def modifier_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.modifier_counts(_compiled(spark, sf_dir).rules).agg(F.coalesce(F.sum("rules"), F.lit(0)).alias("rules"))


@query
def rule_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.kind_counts(_compiled(spark, sf_dir).rules)


@query
def final_category_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.category_counts(_compiled(spark, sf_dir).blocks)


@query
def suffix_top20(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.top_suffixes(_compiled(spark, sf_dir).blocks)


@query
def length_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.length_stats(_compiled(spark, sf_dir).blocks)


@query
def self_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.self_dedup(_contributions(spark, sf_dir))


@query
def modifier_rules_skipped(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.with_modifiers(_compiled(spark, sf_dir).blocks)


# Classification and audit


def _allow_domains(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _compiled(spark, sf_dir).allows.filter("domain <> ''").select("domain").distinct()


def _all_domains(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rules(spark, sf_dir).filter("domain <> ''").select("domain").distinct()


def _classified(spark: SparkSession, domains: DataFrame) -> DataFrame:
    known = spark.createDataFrame(KNOWN_DOMAINS, "pattern string, category string, position int")
    return C.classify(domains, None, known, C.prefix_table(spark))


@query
def registered_domains(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.registered(_all_domains(spark, sf_dir))


@query
def domain_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _classified(spark, _all_domains(spark, sf_dir)).drop("registered")


@query
def hinted_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Categories of domains that point to other names."""
    classified = _classified(spark, _all_domains(spark, sf_dir))
    n = F.length("domain")
    hint = F.when(n % 4 == 0, "CDN.edge.example.com").when(n % 4 == 1, "plain.example.com").when(n % 4 == 2, "x.promo.click")
    hints = classified.select("domain", F.explode(F.array(F.struct(F.lit(2).alias("position"), F.lit("ads.late.example.com").alias("hint")), F.struct(F.lit(1).alias("position"), hint.alias("hint")))).alias("x")).select("domain", "x.hint", "x.position")
    known = spark.createDataFrame(KNOWN_DOMAINS, "pattern string, category string, position int")
    return C.with_hints(classified, hints, None, known, C.prefix_table(spark)).select("domain", "category", F.round("confidence", 4).alias("confidence"), "matched_by")


@query
def category_counts_zero(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.counts_with_zero(_classified(spark, _all_domains(spark, sf_dir)))


def _signals(domains: DataFrame) -> dict[str, DataFrame]:
    """Signal tables made up from the lengths of domains."""
    d = domains.select("domain", (F.length("domain") * 7 % 20).alias("h"))
    at = lambda *n: d.filter(F.col("h").isin(*n))
    dns = d.select("domain", (F.col("h") == 0).alias("nxdomain"), F.array(F.when(F.col("h") == 1, "10.0.0.1").otherwise("192.0.2.10")).alias("ips"), F.when(F.col("h") == 9, "timeout").alias("error"))
    return {
        "dns": dns,
        "feed": at(2, 3).select("domain", F.when(F.col("h") == 2, "URLhaus").otherwise("ThreatFox").alias("source")),
        "dnsbl": at(4, 5).select("domain", F.lit("SpamhausDBL").alias("list_name"), F.when(F.col("h") == 4, "127.0.0.11").otherwise("127.0.0.10").alias("ip")),
        "rdap": at(6).select("domain", F.lit(5).alias("domain_age_days")),
        "scam": at(7, 8).select("domain", F.when(F.col("h") == 7, "SUSPICIOUS").otherwise("CAUTION").alias("decision"), F.when(F.col("h") == 7, 55).otherwise(90).alias("risk_score")),
    }


def _audited(spark: SparkSession, sf_dir: str) -> DataFrame:
    allows = _compiled(spark, sf_dir).allows
    domains = allows.filter("domain <> ''").select("domain").distinct()
    return A.audit(allows, _classified(spark, domains), _signals(domains))


@query
def heuristics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _all_domains(spark, sf_dir).select("domain", A.heuristics(F.col("domain")).alias("score"))


@query
def private_ip(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_orderkey")
    octet = lambda n, m: (k * n % m).cast("string")
    first = F.get(F.array(*[F.lit(x) for x in ("10", "172", "192.168", "127", "169.254", "0", "8", "203.0")]), (k % 8).cast("int"))
    ip = F.concat(first, F.when(first.contains("."), "").otherwise(F.concat(F.lit("."), octet(7, 40))), F.lit("."), octet(11, 256), F.lit("."), octet(13, 256))
    return table(spark, sf_dir, "orders").select(ip.alias("ip")).distinct().select("ip", A.is_private_ip(F.col("ip")).alias("is_private"))


@query
def feed_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    domains = _allow_domains(spark, sf_dir)
    feed = _signals(domains)["feed"]
    twice = feed.unionByName(feed.select("domain", F.lit("ThreatFox").alias("source")))
    return A.feed_lookup(domains, twice)


@query
def feed_hosts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A feed of hosts with comments, markup, paths and blank lines in it."""
    k = F.col("o_orderkey")
    host = F.concat(F.lit(" Bad"), (k % 97).cast("string"), F.lit(".Example.ORG\t"))
    value = F.when(k % 11 == 0, F.concat(F.lit("# "), host)).when(k % 11 == 1, "").when(k % 11 == 2, F.concat(F.lit("http://"), F.trim(host), F.lit("/x"))).when(k % 11 == 3, "nodots").when(k % 11 == 4, F.concat(F.lit("a b"), host)).otherwise(host)
    return files.host_feed(table(spark, sf_dir, "orders").select(value.alias("value")), "URLhaus")


@query
def previous_domains(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Domains of the rule lines of an earlier result; comments and patterns have none."""
    return files.previous_domains(files.previous_lines(rule_lines(spark, sf_dir).select(F.col("line").alias("value"))))


@query
def allow_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Allow domains that the sixth source adds or takes away."""
    now, before = (K.compile_rules(r).allows.filter("domain <> ''").select("domain") for r in (_rules(spark, sf_dir), _rules(spark, sf_dir).filter("source_ord <= 4")))
    side = lambda df, name: df.withColumn("side", F.lit(name))
    return side(S.only_in(now, before), "added").unionByName(side(S.only_in(before, now), "removed"))


@query
def sidecar_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parsed rules of two sources, written by content hash and read again for one of them."""
    parsed = _parsed(spark, sf_dir).filter("source_ord <= 1").withColumns({"content_hash": F.concat(F.lit("h"), F.col("source_ord")), "options": F.lit("o")})
    ensure_checkpoint_dir(spark)
    folder = f"{spark.sparkContext._jsc.sc().getCheckpointDir().get()}/sidecar-{uuid.uuid4()}"
    files.write_parsed(parsed, folder)
    wanted = spark.createDataFrame([("h1",)], "content_hash string")
    return P.rules_of(files.read_parsed(spark, folder, wanted, "o")).select("source_ord", "line_no", "domain", "modifiers")


@query
def rdap_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Replies with two registrations, cards, handles, errors and nothing at all."""
    k = F.col("o_orderkey")
    day = lambda add: F.date_format(F.date_add(F.lit("2024-01-01").cast("date"), (add % 300).cast("int")), "yyyy-MM-dd'T'00:00:00'Z'")
    event = lambda kind, at: F.concat(F.lit(f'{{"eventAction":"{kind}","eventDate":"'), at, F.lit('"}'))
    card = F.concat(F.lit(',"vcardArray":["vcard",[["version",{},"text","4.0"],["fn",{},"text","Name '), (k % 5).cast("string"), F.lit('"]]]'))
    who = F.concat(F.lit('{"roles":["registrar"],"handle":"H'), (k % 3).cast("string"), F.lit('"'), F.when(k % 4 == 1, card).otherwise(""), F.lit("}"))
    body = F.concat(F.lit('{"events":['), event("registration", F.lit("2001-01-01T00:00:00Z")), F.lit(","), event("registration", day(k)), F.lit(","), event("expiration", day(k + 7)), F.lit('],"entities":['), who, F.lit("]}"))
    reply = F.when(k % 13 == 0, F.lit('{"errorCode":404,"title":"No such name"}')).when(k % 13 == 1, F.lit("{}")).when(k % 13 == 2, F.lit("no json")).when(k % 13 == 3, F.lit('{"notFound":true}')).otherwise(body)
    r = A.rdap(reply, F.lit("2024-11-01 12:00:00").cast("timestamp"))
    rows = table(spark, sf_dir, "orders").select("o_orderkey", r.alias("r"))
    return rows.select("o_orderkey", F.date_format("r.registered_at", "yyyy-MM-dd").alias("registered_on"), F.date_format("r.expires_at", "yyyy-MM-dd").alias("expires_on"), F.col("r.domain_age_days").alias("age_days"), "r.registrar", "r.is_new", "r.error")


@query
def rdap_age(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    reply = F.to_json(F.struct(F.array(F.struct(F.lit("registration").alias("eventAction"), F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("eventDate"))).alias("events")))
    now = F.lit("2000-01-01 12:00:00").cast("timestamp")
    return e.select("o_orderkey", A.rdap(reply, now)["domain_age_days"].alias("age_days"))


@query
def scam_decisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = F.array(*[F.lit(x) for x in ("CAUTION", "trusted", " SCAM ", "UNKNOWN", "SUSPICIOUS", "BLOCKED", "")])
    rows = table(spark, sf_dir, "orders").select(F.get(labels, (F.col("o_orderkey") % 7).cast("int")).alias("decision"), (F.col("o_custkey") % 100).cast("int").alias("score")).distinct()
    suspicious, confirmed = A.scam_decision(F.col("decision"), F.col("score"))
    return rows.select("decision", "score", suspicious.alias("suspicious"), confirmed.alias("confirmed"))


@query
def dnsbl_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_orderkey")
    listed = F.when(k % 2 == 0, "SpamhausDBL").otherwise("SURBL")
    ip = F.concat(F.when(k % 5 == 0, "127.255.255.").when(k % 11 == 0, "8.8.8.").otherwise("127.0.0."), (k % 128).cast("string"))
    rows = table(spark, sf_dir, "orders").select(listed.alias("list_name"), ip.alias("ip")).distinct()
    codes = rows.withColumn("x", A.decode_dnsbl(F.col("list_name"), F.col("ip")))
    return codes.select("list_name", "ip", F.exists("x", lambda c: c["malicious"]).alias("malicious"), F.array_join(F.transform("x", lambda c: c["label"]), ",").alias("labels"))


@query
def vt_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_orderkey")
    n = table(spark, sf_dir, "orders").select((k % 9).alias("m"), (k % 4).alias("s"), (k % 61).alias("h"), (k % 7).alias("u")).distinct()
    score, bad = A.virustotal(F.col("m"), F.col("s"), F.col("h"), F.col("u"))
    return n.select("m", "s", "h", "u", (F.col("m") * 2 + F.col("s")).alias("points"), (F.round(score * 1000, 0).cast("int")).alias("thousandths"), F.coalesce(bad, F.lit(False)).alias("malicious"))


@query
def audit_fused(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = _audited(spark, sf_dir)
    return a.select("domain", "rule", "rating", "risk_score", F.array_join("reasons", "; ").alias("reasons"), "recommendation")


@query
def audit_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The written records, with the place of each in the order of reports."""
    columns = ["domain", "rule", "rating", "category", "category_confidence", "reason", "dns_nxdomain", "urlhaus_malicious", "threatfox_malicious", "rdap_new_domain", "rdap_domain_age_days", "scam_suspicious", "scam_decision", "scam_risk_score", "virustotal_malicious", "dnsbl_listed", "dnsbl_malicious", "risk_score", "heuristics_score", "recommendation", "recommendation_label", "ai_classified"]
    place = F.row_number().over(Window.orderBy(A.rating_order(F.col("rating")), "domain", "rule"))  # allow rules are few; a report numbers them
    return A.records(_audited(spark, sf_dir)).select(*columns, F.array_join("dnsbl_hits", ",").alias("dnsbl_hits"), F.array_join("dns_ips", ",").alias("dns_ips"), place.alias("place"))


@query
def audit_failed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ratings where the audit of some domains failed."""
    domains = _allow_domains(spark, sf_dir)
    failed = domains.filter(F.length("domain") % 3 == 0).select("domain", F.lit("down").alias("error"))
    return A.fuse(domains, _signals(domains) | {"failed": failed}).select("domain", "rating", "risk_score", F.array_join("reasons", "; ").alias("reasons"), "recommendation", "failed")


@query
def ai_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Categories of low confidence, improved by a classifier's replies within its budget."""
    classified = _classified(spark, _all_domains(spark, sf_dir))
    replies = classified.select("domain", F.when(F.length("domain") % 3 == 0, "social").when(F.length("domain") % 3 == 1, "nonsense").otherwise("cdn").alias("ai_category"), (F.length("domain") % 8 / 4.0).alias("ai_confidence"))
    return A.with_ai(classified, replies, A.AuditOptions(ai_max_domains=500)).select("domain", "category", F.round("confidence", 4).alias("confidence"), "ai_classified")


@query
def audit_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.summary(_audited(spark, sf_dir))


@query
def top_risky(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.top_risky(_audited(spark, sf_dir))


@query
def ai_budget(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.within_budget(_classified(spark, _all_domains(spark, sf_dir)))


@query
def feed_freshness(spark: SparkSession, sf_dir: str) -> DataFrame:
    age = F.unix_timestamp(F.lit("2024-01-15 00:00:00").cast("timestamp")) - F.unix_timestamp("ts")
    e = table(spark, sf_dir, "events").filter("ts <= TIMESTAMP '2024-01-15 00:00:00'")
    return e.groupBy(A.feed_freshness(age).alias("state")).agg(F.count(F.lit(1)).alias("events"))


@query
def graded_allow(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exports.graded_allow_lines(_audited(spark, sf_dir), include_all_ratings=True, only=["advertising", "analytics"])


# Sources and caches


@query
def audit_cache_live(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cached results of one configuration that still hold; events stand in for the cache."""
    e = table(spark, sf_dir, "events").select(F.col("user_id").cast("string").alias("domain"), F.col("event_type").alias("fingerprint"), F.col("ts").cast("timestamp").alias("stored_at"))
    now = F.lit("2024-01-15 00:00:00").cast("timestamp")
    return A.live_cache(e.filter(F.col("stored_at") <= now), "click", now).select("domain", F.unix_micros("stored_at").alias("stored_us"))


@query
def source_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = F.array(*[F.lit(m) for m in ("Read TIMEOUT", "HTTP 404 Not Found", "HTTP 403", "getaddrinfo failed", "Connection reset", "source deadline exceeded", "bad gateway")])
    rows = table(spark, sf_dir, "orders").select(F.get(messages, (F.col("o_orderkey") % 7).cast("int")).alias("message"))
    return rows.groupBy(cache.error_kind(F.col("message")).alias("kind")).agg(F.count(F.lit(1)).alias("sources"))


@query
def cache_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cache.latest(table(spark, sf_dir, "cache_entries")).select("url", "content_hash", "size_bytes")


@query
def cache_eviction(spark: SparkSession, sf_dir: str) -> DataFrame:
    entries = cache.latest(table(spark, sf_dir, "cache_entries"))
    return cache.evicted(entries, max_bytes=200_000).select("url", "content_kept")


@query
def cache_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cache.stats(cache.latest(table(spark, sf_dir, "cache_entries")))


@query
def cache_unchanged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sources of the last snapshot that needn't be parsed again, as their content was there before."""
    return cache.unchanged(table(spark, sf_dir, "cache_entries"))


@query
def enabled_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return files.enabled(table(spark, sf_dir, "sources")).select("source_ord", "name", "category")


# Exports


@query
def content_version(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = _compiled(spark, sf_dir)
    return spark.createDataFrame([(exports.content_version(c.blocks, c.allows),)], "version string")


def _export(kind: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        c = _compiled(spark, sf_dir)
        return exports.lines(kind, c.blocks, c.allows)

    run.__name__ = f"export_{kind}"
    return run


for _kind in exports.KINDS:
    query(_export(_kind))


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return rule_oracle.oracle_sql()
