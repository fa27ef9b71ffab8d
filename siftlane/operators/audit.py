"""Risk audit of allow rules, from tables of signals.

Signals that need a network come as tables, keyed by domain; whatever is absent is
clean. The audit is a set of left joins on distinct domains and one projection; its
rows are joined back to all rules of a domain.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import domains as D
from ..functions.stages import computed
from .classify import CATEGORIES

#: Top-level domains that are given away or abused most.
RISKY_TLDS = "xyz top click country cfd sbs zip mov gq tk ml cf ga work bond rest cyou qpon monster quest icu cam lol pics buzz".split()
#: Weights of the signals.
WEIGHTS = {"threat_intel": 40, "dnsbl_malicious": 30, "scam_confirmed": 30, "dns_private_ip": 20, "scam_suspicious": 20, "dnsbl_listed": 15, "dns_nxdomain": 15, "rdap_new_domain": 15, "heuristics": 10}
#: Codes of the block lists, and whether they stand for something malicious.
DBL_CODES = {10: ("spam", False), 11: ("phishing", True), 12: ("malware", True), 13: ("botnet-c2", True), 14: ("abused-spam", False), 15: ("hijacked", False)}
SURBL_BITS = [(2, "scam", True), (3, "junk", False), (4, "phishing", True), (5, "malware", True), (6, "abused-ads", False)]
BLOCKED_ANSWERS = r"^127\.255\.25[45]\."
#: Labels of the scam check.
SCAM_NEVER, SCAM_RISKY, SCAM_CONFIRMED = ["CAUTION", "TRUSTED"], ["SUSPICIOUS", "SCAM", "BLOCKED", "HIGH_RISK"], ["SCAM", "BLOCKED", "MALICIOUS"]


#: Layers that can be switched, by the signal table (or test) they stand for.
LAYERS = ["dns", "urlhaus", "threatfox", "rdap", "scam_check", "dnsbl", "virustotal", "ai", "heuristics"]
RATINGS = ["malicious", "suspicious", "unknown", "safe"]


@dataclass(frozen=True)
class AuditOptions:
    """``off`` names layers whose signals don't count."""

    weights: dict[str, int] = field(default_factory=lambda: dict(WEIGHTS))
    new_domain_days: int = 30
    off: tuple[str, ...] = ()
    ai_min_confidence: float = 0.6
    ai_max_domains: int = 100
    cache_ttl_seconds: int = 86400

    def on(self, layer: str) -> bool:
        return layer not in self.off

    def fingerprint(self) -> str:
        """Twelve digits that change with whatever changes a rating."""
        import hashlib
        import json

        parts = {"layers": {x: self.on(x) for x in LAYERS}, "weights": self.weights, "new_domain_days": self.new_domain_days, "ttl": self.cache_ttl_seconds}
        return hashlib.sha256(json.dumps(parts, sort_keys=True).encode()).hexdigest()[:12]


def _offline(domain: Column) -> list[tuple[Column, int, str]]:
    """Cases, points and names of the offline signals of a domain."""
    d = F.regexp_replace(F.lower(domain), r"^\.+|\.+$", "")
    parts = D.labels(d)
    n = F.size(parts)
    core = F.when(n >= 2, F.get(parts, n - 2)).otherwise(d)
    digits = F.length(F.regexp_replace(core, r"(?U)[^\d]", ""))
    return [
        (d.startswith("xn--") | d.contains(".xn--"), 2, "punycode"),
        (F.get(parts, n - 1).isin(RISKY_TLDS), 1, "risky_tld"),
        (n >= 6, 1, "deep"),
        (F.length(d) >= 60, 1, "long"),
        ((digits >= 3) & (F.length(core) <= 12), 1, "digits"),
        (core.rlike("[01]") & core.rlike("[oli]"), 2, "lookalike"),
    ]


def heuristics(domain: Column) -> Column:
    """Score of the offline signals of a domain; 3 and more is risky. 0 for null and ''."""
    score = F.lit(0)
    for case, points, _ in _offline(domain):
        score = score + F.when(case, points).otherwise(0)
    return F.when(F.coalesce(F.regexp_replace(domain, r"^\.+|\.+$", ""), F.lit("")) == "", 0).otherwise(score)


def heuristics_flags(domain: Column) -> Column:
    """Names of the offline signals that a domain gives."""
    named = F.array_compact(F.array(*[F.when(case, name) for case, _, name in _offline(domain)]))
    return F.when(F.coalesce(F.regexp_replace(domain, r"^\.+|\.+$", ""), F.lit("")) == "", F.array().cast("array<string>")).otherwise(named)


def is_private_ip(ip: Column) -> Column:
    """Whether an address belongs to a private, loopback or link-local network; false for what is no address."""
    v4 = D.is_ipv4(ip) & ip.rlike(r"^(?:10|127|0)\.|^192\.168\.|^169\.254\.|^172\.(?:1[6-9]|2[0-9]|3[01])\.")
    low = F.lower(ip)
    v6 = low.rlike(r"^(?:0{1,4}:){7}0{0,3}1$|^::1$|^(?:0{1,4}:){1,6}:0{0,3}1$") | low.rlike(r"^f[cd][0-9a-f]{2}:[0-9a-f:.]*$") | low.rlike(r"^fe[89ab][0-9a-f]:[0-9a-f:.]*$")
    return F.coalesce(v4 | v6, F.lit(False))


def decode_dnsbl(list_name: Column, ip: Column) -> Column:
    """Array of ``(label, malicious)`` that an answer of a block list stands for; empty for blocked queries and other answers."""
    last = F.regexp_extract(ip, r"\.(\d+)$", 1).try_cast("int")
    code = F.lit(None).cast("struct<label:string,malicious:boolean>")
    for number, (name, bad) in DBL_CODES.items():
        code = F.when(last == number, F.struct(F.lit(name).alias("label"), F.lit(bad).alias("malicious"))).otherwise(code)
    other = F.struct(F.concat(F.lit("code-"), last.cast("string")).alias("label"), F.lit(False).alias("malicious"))
    bits = F.filter(F.array(*[F.when(F.getbit(last, F.lit(bit)) == 1, F.struct(F.lit(name).alias("label"), F.lit(bad).alias("malicious"))) for bit, name, bad in SURBL_BITS]), lambda x: x.isNotNull())
    usable = ip.startswith("127.") & ~ip.rlike(BLOCKED_ANSWERS) & last.isNotNull()
    none = F.array().cast("array<struct<label:string,malicious:boolean>>")
    return F.when(usable & (list_name == "SpamhausDBL"), F.array(F.coalesce(code, other))).when(usable, bits).otherwise(none)


def scam_decision(decision: Column, score: Column) -> tuple[Column, Column]:
    """(suspicious, confirmed) of a label and a score."""
    label = F.upper(D.strip_space(F.coalesce(decision, F.lit(""))))
    points = F.coalesce(score, F.lit(0))
    never = label.isin(SCAM_NEVER)
    return ~never & (label.isin(SCAM_RISKY) | (points >= 50)), ~never & (label.isin(SCAM_CONFIRMED) | (points >= 70))


def virustotal(malicious: Column, suspicious: Column, harmless: Column, undetected: Column) -> tuple[Column, Column]:
    """(score with three decimals, malicious): share of engines that complain, suspicions counting half."""
    total = malicious + suspicious + harmless + undetected
    score = F.when(total == 0, 0.0).otherwise(F.bround((malicious + suspicious * 0.5) / total, 3))
    return score, (malicious * 2 + suspicious) * 10 >= F.when(total == 0, F.lit(None)).otherwise(total * 2)


def domain_age_days(registered_at: Column, now: Column) -> Column:
    """Whole days of 86,400 seconds, not midnights."""
    return F.floor((F.unix_timestamp(now) - F.unix_timestamp(registered_at)) / 86400)


RDAP_SCHEMA = "events array<struct<eventAction:string,eventDate:string>>, entities array<struct<roles:array<string>,handle:string,vcardArray:array<string>>>, errorCode string, notFound string, title string"


def rdap(reply: Column, now: Column, new_days: int = 30) -> Column:
    """``registered_at, domain_age_days, registrar, expires_at, is_new, error`` of a registry's JSON reply; nulls where it has none.

    The last event of a kind holds. The registrar's name on its card comes before its
    handle. A null, unreadable or empty reply, and one that reports an error, gives
    ``error`` and nothing else.
    """
    doc = F.from_json(reply, RDAP_SCHEMA)
    at = lambda *kinds: F.try_to_timestamp(F.try_element_at(F.filter(doc["events"], lambda e: F.lower(e["eventAction"]).isin(*kinds)), F.lit(-1))["eventDate"])
    who = F.get(F.filter(doc["entities"], lambda e: F.array_contains(e["roles"], "registrar")), F.lit(0))
    card = F.from_json(F.get(who["vcardArray"], F.lit(1)), "array<array<string>>")
    name = F.get(F.get(F.filter(card, lambda x: F.get(x, F.lit(0)) == "fn"), F.lit(0)), F.lit(3))
    failed = F.coalesce(~doc["errorCode"].isin("0", "false", "null"), F.lit(False)) | F.coalesce(doc["notFound"] == "true", F.lit(False))
    nothing = doc.isNull() | (doc["events"].isNull() & doc["entities"].isNull() & doc["errorCode"].isNull() & doc["notFound"].isNull())
    error = F.when(failed, F.concat(F.lit("RDAP error: "), F.coalesce(doc["title"], F.lit("not found")))).when(nothing, "empty response")
    ok = lambda c: F.when(error.isNull(), c)
    age = ok(domain_age_days(at("registration"), now))
    return F.struct(ok(at("registration")).alias("registered_at"), age.alias("domain_age_days"), ok(F.coalesce(name, who["handle"])).alias("registrar"), ok(at("expiration", "expiry")).alias("expires_at"), F.coalesce(age < new_days, F.lit(False)).alias("is_new"), error.alias("error"))


def feed_lookup(domains: DataFrame, feed: DataFrame) -> DataFrame:
    """``domain, feed_source`` of domains in a threat feed (``domain, source``); URLhaus wins doubles."""
    one = feed.groupBy("domain").agg(F.min_by("source", F.struct(F.when(F.col("source") == "URLhaus", 0).otherwise(1), "source")).alias("feed_source"))
    return domains.select("domain").distinct().join(one, "domain", "left")


def feed_freshness(age_seconds: Column) -> Column:
    return F.when(age_seconds < 3600, "fresh").when(age_seconds < 21600, "stale").otherwise("expired")


def within_budget(candidates: DataFrame, o: AuditOptions = AuditOptions()) -> DataFrame:
    """Domains of low confidence that a paid classifier may see: the first by text, up to its budget."""
    return candidates.filter(F.col("confidence") < o.ai_min_confidence).select("domain").distinct().orderBy("domain").limit(o.ai_max_domains)


def with_ai(classified: DataFrame, ai: DataFrame, o: AuditOptions = AuditOptions()) -> DataFrame:
    """Categories improved by a classifier's replies (``domain, ai_category, ai_confidence``) where confidence is low and the budget allows; ``ai_classified`` tells where.

    An unknown category counts as none, and a null confidence as 0.
    """
    allowed = within_budget(classified, o).withColumn("_paid", F.lit(True))
    one = ai.groupBy("domain").agg(F.max(F.struct(F.coalesce("ai_confidence", F.lit(0.0)).alias("ai_confidence"), "ai_category")).alias("_ai"))
    joined = classified.join(allowed, "domain", "left").join(one, "domain", "left")
    use = F.coalesce(F.col("_paid") & F.col("_ai.ai_category").isin(CATEGORIES), F.lit(False)) & F.lit(o.on("ai"))
    weighed = F.least(F.greatest(F.col("_ai.ai_confidence"), F.lit(0.0)), F.lit(1.0)) * 0.7
    changed = {"category": F.when(use, F.col("_ai.ai_category")).otherwise(F.col("category")), "confidence": F.when(use, F.greatest("confidence", weighed)).otherwise(F.col("confidence")), "ai_classified": use}
    if "matched_by" in classified.columns:
        changed["matched_by"] = F.when(use, "ai").otherwise(F.col("matched_by"))
    return joined.withColumns(changed).drop("_ai", "_paid")


#: Signal tables and their columns; further columns aren't read, missing tables count as empty.
SIGNALS = {
    "dns": "domain string, nxdomain boolean, ips array<string>, error string",
    "feed": "domain string, source string",
    "rdap": "domain string, domain_age_days int, registrar string",
    "scam": "domain string, decision string, risk_score int",
    "dnsbl": "domain string, list_name string, ip string",
    "virustotal": "domain string, malicious boolean, reputation double",
    "failed": "domain string, error string",
}


def _signal(spark: SparkSession, signals: dict[str, DataFrame], name: str, on: bool) -> DataFrame:
    """A signal table with all its columns."""
    empty = spark.createDataFrame([], SIGNALS[name])
    if not on or name not in signals:
        return empty
    given = signals[name]
    return given.select(*[(F.col(f.name) if f.name in given.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in empty.schema.fields]).filter("domain IS NOT NULL")


def fuse(domains: DataFrame, signals: dict[str, DataFrame], o: AuditOptions = AuditOptions()) -> DataFrame:
    """One row per distinct domain: ``rating, risk_score, reasons, recommendation`` and what each layer says.

    ``signals`` holds tables of :data:`SIGNALS`. Every signal adds its weight and reason;
    the sum is capped at 100. Malicious beats suspicious, that beats unknown (name
    lookup failed), that safe. A domain in ``failed`` is unknown and has no signals.
    Null domains have no row; nulls in signals are no signals.
    """
    d = domains.select("domain").filter("domain <> ''").distinct()
    get = lambda name, on=True: _signal(d.sparkSession, signals, name, on)
    dns = get("dns", o.on("dns")).groupBy("domain").agg(F.max("nxdomain").alias("nxdomain"), F.array_sort(F.array_distinct(F.flatten(F.collect_set("ips")))).alias("ips"), F.max("error").alias("dns_error"))
    off = [s for s, layer in (("URLhaus", "urlhaus"), ("ThreatFox", "threatfox")) if not o.on(layer)]
    feeds = get("feed").filter(~F.col("source").isin(off) if off else F.lit(True)).groupBy("domain").agg(F.array_sort(F.collect_set("source")).alias("feeds"))
    rdap_ = get("rdap", o.on("rdap")).groupBy("domain").agg(F.min(F.struct(F.coalesce("domain_age_days", F.lit(2**31 - 1)).alias("o"), "domain_age_days", "registrar")).alias("r"))
    scam = get("scam", o.on("scam_check")).groupBy("domain").agg(F.max_by("decision", F.coalesce("risk_score", F.lit(0))).alias("decision"), F.max("risk_score").alias("scam_score"))
    lists = get("dnsbl", o.on("dnsbl")).select("domain", "list_name", F.explode(decode_dnsbl(F.col("list_name"), F.col("ip"))).alias("x"))
    dnsbl = lists.groupBy("domain").agg(F.max("x.malicious").alias("bl_bad"), F.array_sort(F.collect_set(F.concat("list_name", F.lit(":"), "x.label"))).alias("hits"))
    vt = get("virustotal", o.on("virustotal")).groupBy("domain").agg(F.max("malicious").alias("vt_bad"), F.max("reputation").alias("vt_reputation"))
    failed = get("failed").groupBy("domain").agg(F.max(F.coalesce("error", F.lit(""))).alias("failure"))
    row = d
    for part in (dns, feeds, rdap_, scam, dnsbl, vt, failed):
        row = row.join(part, "domain", "left")
    yes = lambda c: F.coalesce(c, F.lit(False)) & F.col("failure").isNull()
    none = F.array().cast("array<string>")
    suspicious, confirmed = scam_decision(F.col("decision"), F.col("scam_score"))
    layers = computed(
        row,
        {
            "dns_nxdomain": yes(F.col("nxdomain")),
            "dns_private": yes(F.exists("ips", is_private_ip)),
            "urlhaus_malicious": yes(F.array_contains("feeds", "URLhaus")),
            "threatfox_malicious": yes(F.array_contains("feeds", "ThreatFox")),
            "_ti": F.when(F.col("failure").isNull(), F.concat_ws("+", F.when(F.size(F.coalesce("feeds", none)) > 0, F.array_join("feeds", "+")), F.when(yes(F.col("vt_bad")), "VirusTotal"))).otherwise(""),
            "rdap_new_domain": yes(F.col("r.domain_age_days") < o.new_domain_days),
            "scam_suspicious": yes(suspicious),
            "_confirmed": yes(confirmed),
            "virustotal_malicious": yes(F.col("vt_bad")),
            "dnsbl_malicious": yes(F.col("bl_bad")),
            "dnsbl_listed": yes(F.size("hits") > 0),
            "heuristics_score": F.when(F.col("failure").isNull() & F.lit(o.on("heuristics")), heuristics(F.col("domain"))).otherwise(0),
        },
    )
    c, w, age = F.col, o.weights, F.col("r.domain_age_days")
    hits = F.array_join("hits", "+")
    cases = [
        (c("_ti") != "", w["threat_intel"], F.concat(F.lit("threat_intel:"), "_ti")),
        (c("dnsbl_malicious"), w["dnsbl_malicious"], F.concat(F.lit("dnsbl_malicious:"), hits)),
        (c("dnsbl_listed") & ~c("dnsbl_malicious"), w["dnsbl_listed"], F.concat(F.lit("dnsbl_listed:"), hits)),
        (c("dns_nxdomain"), w["dns_nxdomain"], F.lit("dns_nxdomain")),
        (~c("dns_nxdomain") & c("dns_private"), w["dns_private_ip"], F.lit("dns_private_ip")),
        (c("rdap_new_domain"), w["rdap_new_domain"], F.concat(F.lit("rdap_new_domain:"), age.cast("string"))),
        (c("scam_suspicious") & c("_confirmed"), w["scam_confirmed"], F.lit("scam_confirmed")),
        (c("scam_suspicious") & ~c("_confirmed"), w["scam_suspicious"], F.lit("scam_suspicious")),
        (c("heuristics_score") >= 3, w["heuristics"], F.lit("heuristics")),
    ]
    total = F.lit(0)
    for case, points, _ in cases:
        total = total + F.when(case, points).otherwise(0)
    reasons = F.array_compact(F.array(F.when(c("failure").isNotNull(), F.concat(F.lit("failed:"), "failure")), *[F.when(case, why) for case, _, why in cases]))
    fused = computed(layers, {"reasons": reasons, "risk_score": F.least(total, F.lit(100))})
    rating = F.when(c("failure").isNotNull(), "unknown").when(cases[0][0] | cases[1][0], "malicious").when(F.size("reasons") > 0, "suspicious").when(c("dns_error").isNotNull(), "unknown").otherwise("safe")
    rated = fused.withColumn("rating", rating)
    recommendation = F.when(c("rating") == "malicious", "remove").when(c("rating") == "safe", "keep").otherwise("review")
    blank = lambda x, other: F.when(c("failure").isNull(), F.coalesce(x, other)).otherwise(other)
    return rated.select(
        "domain", "rating", "risk_score", "reasons", recommendation.alias("recommendation"),
        blank(c("ips"), none).alias("dns_ips"), "dns_nxdomain", "dns_private", "urlhaus_malicious", "threatfox_malicious", "rdap_new_domain",
        blank(age, F.lit(None).cast("int")).alias("rdap_domain_age_days"), blank(c("r.registrar"), F.lit(None).cast("string")).alias("rdap_registrar"),
        "scam_suspicious", blank(c("decision"), F.lit(None).cast("string")).alias("scam_decision"), blank(c("scam_score"), F.lit(0)).alias("scam_risk_score"),
        "virustotal_malicious", blank(c("vt_reputation"), F.lit(0.0)).alias("virustotal_reputation"),
        "dnsbl_listed", "dnsbl_malicious", blank(c("hits"), none).alias("dnsbl_hits"),
        "heuristics_score", F.when(c("failure").isNull() & F.lit(o.on("heuristics")), heuristics_flags(c("domain"))).otherwise(none).alias("heuristics_flags"), c("failure").isNotNull().alias("failed"),
    )


#: What a recommendation is called.
RECOMMENDATION_LABELS = {"remove": "建议移除", "review": "建议复核", "keep": "建议保留"}


def audit(allows: DataFrame, classified: DataFrame, signals: dict[str, DataFrame], o: AuditOptions = AuditOptions(), ai: DataFrame | None = None, cached: DataFrame | None = None) -> DataFrame:
    """One row per allow rule with a domain: its text and sources, the rating of its domain with all layers, and its category.

    ``ai`` has a classifier's replies, see :func:`with_ai`. ``cached`` holds earlier results
    by domain (see :func:`live_cache`); their domains aren't rated again and are marked
    ``disk_cache``.
    """
    named = allows.filter("domain <> ''")
    open_ = named if cached is None else named.join(cached.select("domain"), "domain", "left_anti")
    known = with_ai(classified, ai, o) if ai is not None else classified.withColumn("ai_classified", F.lit(False))
    matched = F.col("matched_by") if "matched_by" in classified.columns else F.lit(None).cast("string")
    known = known.select("domain", F.col("category").alias("domain_category"), "confidence", matched.alias("category_reason"), "ai_classified")
    rated = fuse(open_, signals, o).join(known, "domain", "left").withColumns({"domain_category": F.when(F.col("failed"), "other").otherwise(F.coalesce("domain_category", F.lit("other"))), "confidence": F.when(F.col("failed"), 0.0).otherwise(F.coalesce("confidence", F.lit(0.0)))})
    rated = rated.withColumns({"ai_classified": F.coalesce("ai_classified", F.lit(False)) & ~F.col("failed"), "disk_cache": F.lit(False)})
    if cached is not None:
        columns = [c for c in rated.columns if c != "disk_cache"]
        rated = rated.unionByName(cached.select(*columns).withColumn("disk_cache", F.lit(True)))
    text = D.output_text(F.lit("allow"), F.col("domain"), F.col("wildcard"), F.col("modifiers"), F.lit(""))
    return named.select("domain", text.alias("rule"), "source_ords").join(rated, "domain")


def records(audited: DataFrame) -> DataFrame:
    """Audit rows under the names of the record that is written, in the order of reports."""
    label = F.lit(None).cast("string")
    for key, text in RECOMMENDATION_LABELS.items():
        label = F.when(F.col("recommendation") == key, text).otherwise(label)
    named = {"source_ords": "sources", "domain_category": "category", "confidence": "category_confidence"}
    out = audited.withColumns({"reason": F.array_join("reasons", "; "), "recommendation_label": label, "confidence": F.round("confidence", 2)}).withColumnsRenamed(named)
    return out.drop("reasons", "dns_private", "failed").orderBy(rating_order(F.col("rating")), "domain", "rule")


#: What counts as a hit of a layer.
HITS = {"dns_nxdomain": "dns_nxdomain", "dns_private_ip": "dns_private", "urlhaus": "urlhaus_malicious", "threatfox": "threatfox_malicious", "rdap_new_domain": "rdap_new_domain", "scam_check": "scam_suspicious", "virustotal": "virustotal_malicious", "dnsbl_malicious": "dnsbl_malicious", "ai_classified": "ai_classified"}


def summary(audited: DataFrame) -> DataFrame:
    """Counts of rules in long form: ``measure, bucket, rules``.

    Measures: rating, category, confidence, risk, ``layer`` (hits of each layer) and
    ``rating:category`` with buckets like ``safe:cdn``. Buckets without a rule have no row.
    """
    confidence = F.when(F.col("confidence") >= 0.9, "high").when(F.col("confidence") >= 0.6, "medium").otherwise("low")
    risk = F.when(F.col("risk_score") >= 50, "high").when(F.col("risk_score") >= 20, "medium").when(F.col("risk_score") >= 1, "low").otherwise("none")
    category = F.coalesce("domain_category", F.lit("other"))
    rows = [("rating", F.col("rating")), ("category", category), ("confidence", confidence), ("risk", risk), ("rating:category", F.concat_ws(":", "rating", category))]
    rows += [("layer", F.when(F.col(c), name)) for name, c in HITS.items()]
    rows += [("layer", F.when(F.col("dnsbl_listed") & ~F.col("dnsbl_malicious"), "dnsbl_listed")), ("layer", F.when(F.col("heuristics_score") >= 3, "heuristics"))]
    measures = F.array(*[F.struct(F.lit(m).alias("measure"), b.alias("bucket")) for m, b in rows])
    return audited.select(F.explode(measures).alias("x")).filter("x.bucket IS NOT NULL").groupBy("x.measure", "x.bucket").agg(F.count(F.lit(1)).alias("rules"))


def top_risky(audited: DataFrame, n: int = 10) -> DataFrame:
    return audited.filter("risk_score > 0").select("domain", "rule", "rating", "risk_score").orderBy(F.desc("risk_score"), "domain", "rule").limit(n)


def rating_order(rating: Column) -> Column:
    return F.when(rating == "malicious", 0).when(rating == "suspicious", 1).when(rating == "unknown", 2).otherwise(3)


def live_cache(cache: DataFrame, fingerprint: str, now: Column, ttl_seconds: int = 86400) -> DataFrame:
    """Entries of one configuration that haven't expired; the newest per domain. Reading renews nothing."""
    valid = cache.filter((F.col("fingerprint") == fingerprint) & (F.unix_timestamp("stored_at") > F.unix_timestamp(now) - ttl_seconds))
    columns = [c for c in cache.columns if c != "domain"]
    return valid.groupBy("domain").agg(F.max_by(F.struct(*columns), "stored_at").alias("r")).select("domain", "r.*")


def next_cache(cache: DataFrame | None, audited: DataFrame, fingerprint: str, now: Column, ttl_seconds: int = 86400) -> DataFrame:
    """What to keep for the next run: entries that still hold with the time they were stored at, fresh results, and the entries of other configurations."""
    columns = [c for c in audited.columns if c not in ("rule", "source_ords", "disk_cache")]
    fresh = audited.filter("NOT disk_cache AND NOT failed").select(*columns).dropDuplicates(["domain"]).withColumns({"fingerprint": F.lit(fingerprint), "stored_at": now})
    if cache is None:
        return fresh
    held = live_cache(cache, fingerprint, now, ttl_seconds).join(fresh.select("domain"), "domain", "left_anti")
    return cache.filter(F.col("fingerprint") != fingerprint).unionByName(held).unionByName(fresh)
