import pytest

from siftlane.operators.parse import ParseOptions, drop_counters, parse, rules_of

RULES = [
    ("||example.com^", ("block", "example.com", False, "")),
    ("@@||example.com^", ("allow", "example.com", False, "")),
    ("||*.example.com^", ("block", "example.com", True, "")),
    ("0.0.0.0 ads.example.com", ("block", "ads.example.com", False, "")),
    ("127.0.0.1\tads.example.com # x", ("block", "ads.example.com", False, "")),
    ("::1 ads.example.com", ("block", "ads.example.com", False, "")),
    ("0.0.0.0 a.com b.com", ("block", "a.com", False, "")),
    ("ads.example.com", ("block", "ads.example.com", False, "")),
    ("*.ads.example.com", ("block", "ads.example.com", True, "")),
    ("||example.com^$important", ("block", "example.com", False, "important")),
    ("||example.com^$Important", ("block", "example.com", False, "important")),
    ("wykop.pl$badfilter", ("block", "wykop.pl", False, "badfilter")),
    ("||deloton.com$important", ("block", "deloton.com", False, "important")),
    ("||EXAMPLE.COM.^", ("block", "example.com", False, "")),
    ("||.example.com^", ("block", "example.com", False, "")),
    ("||www.example.com^", ("block", "www.example.com", False, "")),
    ("||example.com^$script,third-party,popup", ("block", "example.com", False, "")),
    ("||example.com^$script,important", ("block", "example.com", False, "important")),
    ("||example.com^$dnstype=A", ("block", "example.com", False, "dnstype=A")),
    ("||example.com^$client=b, DNSTYPE = A,important", ("block", "example.com", False, "important,client=b,dnstype=A")),
    ("||example.com|", ("block", "example.com|", False, "")),
    ("||example.com:8080^", ("block", "example.com:8080", False, "")),
    (" ||example.com^　", ("block", "example.com", False, "")),
]
PATTERNS = [("/^192\\.168\\.\\d+$/", "block", "/^192\\.168\\.\\d+$/"), ("/regex/$b,a,b", "block", "/regex/$a,b"), ("@@/regex/$b,a", "allow", "@@/regex/$a,b"), ("/a\\/b/$b,a", "block", "/a\\/b/$a,b")]
DROPS = [
    ("example.com##.ad", "css"), ("||*-ads.example.com^", "pattern"), ("||localhost^", "quality"), ("||a.b^", "quality"), ("! note", "comment"), ("# note", "comment"), ("", "blank"), (None, "blank"), (" \t ", "blank"),
    ("||example.com/path^", "pattern"), ("||example.com^|", "pattern"), ("||example.com^text", "pattern"), ("@@||example.com/path^", "pattern"), ("/ads/$dnstype=A", "none"), ("https://x.com/y", "url"), ("127.0.0.1 localhost", "none"), ("0.0.0.0 *.x.com", "pattern"), ("||a..com^", "quality"), ("x" * 300 + ".com", "quality"), ("$important", "none"),
]


def frame(spark, lines):
    return spark.createDataFrame([(0, i, line, "ads") for i, line in enumerate(lines)], "source_ord int, line_no bigint, line string, category string")


def test_forms(spark):
    got = {r["line_no"]: r for r in parse(frame(spark, [x for x, _ in RULES])).collect()}
    for i, (line, want) in enumerate(RULES):
        assert (got[i]["rule_type"], got[i]["domain"], got[i]["wildcard"], got[i]["modifiers"]) == want, line
        assert got[i]["drop_reason"] is None


def test_patterns(spark):
    got = {r["line_no"]: r for r in parse(frame(spark, [x for x, *_ in PATTERNS])).collect()}
    for i, (line, kind, raw) in enumerate(PATTERNS):
        assert (got[i]["rule_type"], got[i]["domain"], got[i]["raw"]) == (kind, "", raw), line


def test_drops(spark):
    got = {r["line_no"]: r["drop_reason"] for r in parse(frame(spark, [x for x, _ in DROPS])).collect()}
    assert got == {i: why for i, (_, why) in enumerate(DROPS)}


def test_counters(spark):
    parsed = parse(frame(spark, ["! c", "# c", "||a.b^", "||x.com##y", "||x.com/p^", "||x.com^$script"]))
    row = drop_counters(parsed).first()
    assert row.asDict() == {"source_ord": 0, "pattern_dropped": 1, "quality_dropped": 1, "css_dropped": 1, "comment_dropped": 2, "modifier_stripped": 1}


@pytest.mark.parametrize(("options", "line", "domain"), [(ParseOptions(strip_www=True), "||www.example.com^", "example.com"), (ParseOptions(quality_filter=False), "||localhost^", "localhost"), (ParseOptions(min_domain_length=3), "||a.b^", "a.b")])
def test_options(spark, options, line, domain):
    assert [r["domain"] for r in rules_of(parse(frame(spark, [line]), options)).collect()] == [domain]


def test_filter_addresses(spark):
    assert rules_of(parse(frame(spark, ["||10.0.0.1^"]), ParseOptions(filter_ip_rules=True))).count() == 0


def test_empty_and_extra_columns(spark):
    assert parse(frame(spark, [])).count() == 0
    from pyspark.sql import functions as F

    more = frame(spark, ["||a.com^"]).withColumn("domain", F.lit("clash")).withColumn("raw", F.lit("clash"))
    assert parse(more).first()["domain"] == "a.com"
