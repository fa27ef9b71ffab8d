from datetime import datetime

import pytest
from pyspark.sql import functions as F

from siftlane.operators import audit as A
from siftlane.operators import classify as C

ALLOW = "rule_type string, domain string, wildcard boolean, modifiers string, raw string, category string, source_ords array<int>"


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


@pytest.mark.parametrize(
    ("name", "ip", "labels", "bad"),
    [
        ("SpamhausDBL", "127.0.0.11", ["phishing"], True),
        ("SpamhausDBL", "127.0.0.15", ["hijacked"], False),
        ("SpamhausDBL", "127.0.0.99", ["code-99"], False),
        ("SURBL", "127.0.0.36", ["scam", "malware"], True),
        ("SURBL", "127.0.0.8", ["junk"], False),
        ("SURBL", "198.51.100.7", [], False),
        ("SpamhausDBL", "127.255.255.254", [], False),
    ],
)
def test_dnsbl(spark, name, ip, labels, bad):
    got = one(spark, A.decode_dnsbl(F.lit(name), F.lit(ip)))
    assert [x["label"] for x in got] == labels and any(x["malicious"] for x in got) == bad


@pytest.mark.parametrize(("label", "score", "want"), [("CAUTION", 99, (False, False)), ("TRUSTED", 99, (False, False)), ("UNKNOWN", 50, (True, False)), ("", 70, (True, True)), ("scam ", 0, (True, True)), ("SUSPICIOUS", 0, (True, False)), (None, None, (False, False))])
def test_scam(spark, label, score, want):
    s, c = A.scam_decision(F.lit(label).cast("string"), F.lit(score).cast("int"))
    assert (one(spark, s), one(spark, c)) == want


@pytest.mark.parametrize(("ip", "private"), [("10.44.0.9", True), ("172.20.8.8", True), ("172.40.1.1", False), ("192.168.77.5", True), ("127.3.2.1", True), ("169.254.9.9", True), ("0.0.0.0", True), ("198.51.100.7", False), ("::1", True), ("fd12:3::4", True), ("fe80::1", True), ("2001:db8::1", False), ("no", False), (None, False)])
def test_private(spark, ip, private):
    assert one(spark, A.is_private_ip(F.lit(ip).cast("string"))) is private


def test_heuristics(spark):
    score = lambda d: one(spark, A.heuristics(F.lit(d).cast("string")))
    assert [score(d) for d in ("example.com", "xn--a.com", "a.xyz", "g00gle.top", "a.b.c.d.e.com", "a123.com", "", None)] == [0, 2, 1, 3, 1, 1, 0, 0]
    assert score("x" * 60 + ".com") == 1


def test_rdap(spark):
    reply = '{"events":[{"eventAction":"registration","eventDate":"2024-01-01T12:00:00Z"}],"entities":[{"roles":["registrar"],"handle":"R1"}]}'
    now = F.lit("2024-01-06 11:59:59").cast("timestamp")
    got = one(spark, A.rdap(F.lit(reply), now))
    assert got["domain_age_days"] == 4 and got["registrar"] == "R1"
    assert one(spark, A.rdap(F.lit("{}"), now))["domain_age_days"] is None
    assert one(spark, A.rdap(F.lit(None).cast("string"), now))["error"] == "empty response"
    twice = '{"events":[{"eventAction":"registration","eventDate":"2001-01-01T00:00:00Z"},{"eventAction":"registration","eventDate":"2024-01-05T00:00:00Z"},{"eventAction":"expiration","eventDate":"2030-01-01T00:00:00Z"}],"entities":[{"roles":["registrar"],"handle":"R2","vcardArray":["vcard",[["version",{},"text","4.0"],["fn",{},"text","Name Inc"]]]}]}'
    got = one(spark, A.rdap(F.lit(twice), now))
    assert got["domain_age_days"] == 1 and got["is_new"] and got["registrar"] == "Name Inc" and got["expires_at"].year == 2030 and got["error"] is None
    assert one(spark, A.rdap(F.lit('{"errorCode":404,"title":"gone"}'), now))["error"] == "RDAP error: gone"


def test_fusion(spark):
    d = spark.createDataFrame([(x,) for x in ("clean.com", "gone.com", "bad.com", "all.com", "dark.com", "g00gle.top")], "domain string")
    signals = {
        "dns": spark.createDataFrame([("gone.com", True, [], None), ("dark.com", False, [], "timeout"), ("all.com", False, ["10.0.0.1"], None)], "domain string, nxdomain boolean, ips array<string>, error string"),
        "feed": spark.createDataFrame([("bad.com", "ThreatFox"), ("bad.com", "URLhaus"), ("all.com", "URLhaus")], "domain string, source string"),
        "rdap": spark.createDataFrame([("gone.com", 5), ("all.com", 1)], "domain string, domain_age_days int"),
        "scam": spark.createDataFrame([("all.com", "SCAM", 90)], "domain string, decision string, risk_score int"),
        "dnsbl": spark.createDataFrame([("all.com", "SpamhausDBL", "127.0.0.12")], "domain string, list_name string, ip string"),
    }
    got = {r["domain"]: r for r in A.fuse(d, signals).collect()}
    assert {k: (v["rating"], v["risk_score"], v["recommendation"]) for k, v in got.items()} == {
        "clean.com": ("safe", 0, "keep"),
        "gone.com": ("suspicious", 30, "review"),
        "bad.com": ("malicious", 40, "remove"),
        "all.com": ("malicious", 100, "remove"),
        "dark.com": ("unknown", 0, "review"),
        "g00gle.top": ("suspicious", 10, "review"),
    }
    assert got["bad.com"]["reasons"] == ["threat_intel:ThreatFox+URLhaus"] and len(got["all.com"]["reasons"]) == 5
    heavier = A.AuditOptions(weights=A.WEIGHTS | {"dns_nxdomain": 50})
    assert A.fuse(d.filter("domain = 'gone.com'"), {"dns": signals["dns"]}, heavier).first()["risk_score"] == 50


def test_audit_joins_back(spark):
    allows = spark.createDataFrame([("allow", "a.com", False, "", "", "ads", [1]), ("allow", "a.com", False, "important", "", "ads", [2]), ("allow", "", False, "", "/x/", "ads", [2])], ALLOW)
    empty = spark.createDataFrame([], "domain string, category string, confidence double")
    assert A.audit(allows, empty, {}).count() == 2
    assert {(r["measure"], r["bucket"], r["rules"]) for r in A.summary(A.audit(allows, empty, {})).collect()} >= {("rating", "safe", 2), ("risk", "none", 2)}


NAMES = ["a.b.example.co.uk", "example.com", "co.uk", "x.y.ck", "www.ck", "a.www.ck", "no-such-suffix-here", "deep.sub.example.com", "10.0.0.1", "nas.local", ""]


def registered_of(spark, suffixes=None):
    df = spark.createDataFrame([(n,) for n in NAMES] + [(None,), ("example.com",)], "domain string")
    return {r["domain"]: r["registered"] for r in C.registered(df, suffixes).collect()}


def test_registered_domains_by_list(spark, tmp_path):
    (tmp_path / "list.dat").write_text("// comment\ncom\nco.uk\nuk\n*.ck\n!www.ck\n// ===BEGIN PRIVATE DOMAINS===\nexample.com\n")
    got = registered_of(spark, C.read_suffixes(spark, str(tmp_path / "list.dat")))
    assert got == {"a.b.example.co.uk": "example.co.uk", "example.com": "example.com", "co.uk": "co.uk", "x.y.ck": "x.y.ck", "www.ck": "www.ck", "a.www.ck": "www.ck", "no-such-suffix-here": "no-such-suffix-here", "deep.sub.example.com": "example.com", "10.0.0.1": "10.0.0.1", "nas.local": "nas.local", "": ""}
    with pytest.raises(Exception, match="(?i)does not exist|not.found"):
        C.read_suffixes(spark, str(tmp_path / "absent.dat"))


def test_registered_domains_by_rule(spark):
    got = registered_of(spark)
    assert got["a.b.example.co.uk"] == "example.co.uk" and got["deep.sub.example.com"] == "example.com" and got["co.uk"] == "co.uk"
    assert got["x.y.ck"] == "y.ck"  # only a list knows better
    assert got["10.0.0.1"] == "10.0.0.1" and got["nas.local"] == "nas.local" and got[""] == ""


def test_known_domains_from_a_file(spark, tmp_path):
    (tmp_path / "known.csv").write_text("# category,domain\nsocial, Known.com\ncdn,known.com\n\nbroken line\n")
    assert [(r["pattern"], r["category"]) for r in C.read_known(spark, str(tmp_path / "known.csv")).orderBy("position").collect()] == [("known.com", "social"), ("known.com", "cdn")]


def test_classes(spark):
    table = spark.createDataFrame([("known.com", "social", 1), ("known.com", "cdn", 2)], "pattern string, category string, position int")
    df = spark.createDataFrame([("x.known.com",), ("evilknown.com",), ("ads.other.com",), ("a.ads.other.com",)], "domain string")
    got = {r["domain"]: (r["category"], r["confidence"]) for r in C.classify(df, None, table, C.prefix_table(spark)).collect()}
    assert got == {"x.known.com": ("social", 0.9), "evilknown.com": ("other", 0.0), "ads.other.com": ("advertising", 0.6), "a.ads.other.com": ("other", 0.0)}


def test_virustotal_and_cache(spark):
    s, bad = A.virustotal(*[F.lit(x) for x in (5, 10, 85, 0)])
    assert (one(spark, s), one(spark, bad)) == (0.1, True)  # five and half of ten engines of a hundred
    cache = spark.createDataFrame([("a.com", "f", datetime(2024, 1, 2)), ("a.com", "f", datetime(2024, 1, 2, 1)), ("b.com", "f", datetime(2024, 1, 1)), ("c.com", "g", datetime(2024, 1, 2))], "domain string, fingerprint string, stored_at timestamp")
    live = A.live_cache(cache, "f", F.lit("2024-01-02 12:00:00").cast("timestamp"))
    assert [(r["domain"], r["stored_at"].hour) for r in live.collect()] == [("a.com", 1)]


def test_failed_domains_nulls_and_clashing_columns(spark):
    d = spark.createDataFrame([("a.com", "x"), ("b.com", "x"), (None, "x"), ("", "x"), ("a.com", "y")], "domain string, rating string")
    signals = {
        "feed": spark.createDataFrame([("a.com", "URLhaus", 1), ("b.com", None, 1), (None, "URLhaus", 1)], "domain string, source string, nxdomain int"),
        "failed": spark.createDataFrame([("a.com", None)], "domain string, error string"),
        "dns": spark.createDataFrame([("b.com", None, None, None)], "domain string, nxdomain boolean, ips array<string>, error string"),
    }
    got = {r["domain"]: r for r in A.fuse(d, signals).collect()}
    assert set(got) == {"a.com", "b.com"} and got["a.com"]["rating"] == "unknown" and got["a.com"]["failed"] and not got["a.com"]["urlhaus_malicious"]
    assert got["b.com"]["rating"] == "safe" and got["b.com"]["dns_ips"] == []
    assert A.fuse(d.limit(0), signals).count() == 0


def test_fingerprint():
    base = A.AuditOptions()
    others = [A.AuditOptions(off=("dns",)), A.AuditOptions(weights=A.WEIGHTS | {"heuristics": 11}), A.AuditOptions(new_domain_days=31), A.AuditOptions(cache_ttl_seconds=1)]
    assert base.fingerprint() == A.AuditOptions().fingerprint() and len({o.fingerprint() for o in [base, *others]}) == 5


def test_classifier_replies(spark):
    known = spark.createDataFrame([("a.com", "other", 0.0, "none"), ("b.com", "cdn", 0.9, "registered"), ("c.com", "other", 0.0, "none"), ("d.com", "other", 0.0, "none")], "domain string, category string, confidence double, matched_by string")
    replies = spark.createDataFrame([("a.com", "social", 2.0), ("a.com", "social", 2.0), ("b.com", "social", 1.0), ("c.com", "no such", 1.0), ("d.com", "cdn", None)], "domain string, ai_category string, ai_confidence double")
    got = {r["domain"]: (r["category"], r["confidence"], r["ai_classified"]) for r in A.with_ai(known, replies, A.AuditOptions(ai_max_domains=2)).collect()}
    assert got == {"a.com": ("social", 0.7, True), "b.com": ("cdn", 0.9, False), "c.com": ("other", 0.0, False), "d.com": ("other", 0.0, False)}
