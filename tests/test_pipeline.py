import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from siftlane import cli
from siftlane.config import check_config, load_config
from siftlane.operators import skew
from siftlane.plans import exports
from siftlane.sources import cache, files, landing
from siftlane.sources.store import Store

YAML = """
sources:
  - {{name: A, url: {a}, category: ads, id: 1}}
  - {{name: B, url: {b}, category: tracking, id: 2}}
fold: {{promotion_threshold: 0}}
output: {{formats: [hosts, clash]}}
"""


def config(tmp_path, a="||a.com^\n||b.com^\n@@||x.a.com^\n", b="||b.com^\r\n||c.com^\r||sub.c.com^\n# note\n||é\xff.com^\n"):
    (tmp_path / "a.txt").write_text(a, encoding="utf-8")
    (tmp_path / "b list.txt").write_bytes(b.encode("latin-1"))
    path = tmp_path / "c.yaml"
    path.write_text(YAML.format(a=tmp_path / "a.txt", b=tmp_path / "b list.txt"))
    return path


def test_merge(spark, tmp_path, capsys):
    path = config(tmp_path)
    out = tmp_path / "out"
    (tmp_path / "old.txt").write_text("! x\n||a.com^\n||gone.com^\n")
    assert cli.main(["merge", "--config", str(path), "--output-dir", str(out), "--previous", str(tmp_path / "old.txt")]) == 0
    block = (out / "block.txt").read_text().splitlines()
    assert block[0].startswith("! version: ") and [x for x in block if x[:2] != "! "] == ["||a.com^", "||b.com^", "||c.com^", "||��.com^"]
    assert (out / "allow.txt").read_text().splitlines()[3:] == ["@@||x.a.com^"]
    assert "0.0.0.0 b.com" in (out / "hosts.txt").read_text() and "  - DOMAIN-SUFFIX,c.com" in (out / "clash.txt").read_text()
    stats = json.loads((out / "stats.json").read_text())
    assert stats["rules"] == {"before": 7, "after_dedup": 6, "after": 5, "block": 4, "allow": 1, "dedup_rate": 28.6} and stats["dedup"]["exact_merged"] == 1 and stats["folding"]["exact_aggregated"] == 1
    assert {k: v for k, v in stats["categories"].items() if v} == {"ads": 1, "tracking": 3} and len(stats["categories"]) == 6
    assert stats["diff"] == {"added": 3, "removed": 1, "allow_added": 0, "allow_removed": 0} and stats["sources"]["not_parsed_again"] == 0
    assert (out / "diff_removed.txt").read_text().splitlines()[1:] == ["gone.com"]
    assert json.loads((out / "contributions.json").read_text())[0]["rule_categories"] and (out / "tiered" / "tracking.txt").exists()
    assert "# Merge" in (out / "report.md").read_text()
    page = (out / "report.html").read_text()
    assert "<th>A</th>" in page and '"content_version"' in page
    again = tmp_path / "again"
    cli.main(["merge", "--config", str(path), "--output-dir", str(again), "--cache-dir", str(out / ".cache"), "--quiet"])
    stats = json.loads((again / "stats.json").read_text())
    assert stats["sources"]["not_parsed_again"] == 2 and stats["dropped"]["comment_dropped"] == 1
    assert (again / "block.txt").read_bytes() == (out / "block.txt").read_bytes()


def test_all_conflicts(spark, tmp_path):
    """conflicts.json has every conflict; only the reports' table is cut."""
    names = [f"d{i:03}.com" for i in range(120)]
    path = config(tmp_path, "".join(f"||{n}^\n" for n in names), "".join(f"@@||{n}^\n" for n in names))
    out = tmp_path / "out"
    assert cli.main(["merge", "--config", str(path), "--output-dir", str(out), "--quiet"]) == 0
    records = json.loads((out / "conflicts.json").read_text())
    assert [r["domain"] for r in records] == names and json.loads((out / "stats.json").read_text())["conflicts"] == 120
    assert records[0] == {"domain": "d000.com", "blocked_rule": "||d000.com^", "blocked_category": "ads", "blocked_sources": [0], "whitelist_rule": "@@||d000.com^", "whitelist_sources": [1], "conflict_type": "exact"}
    shown = (out / "report.md").read_text()
    assert "120 in all" in shown and "\n| d049.com | \\|\\|d049.com^ | A | @@\\|\\|d049.com^ | B | exact |" in shown and "d050.com" not in shown
    page = (out / "report.html").read_text()
    assert "<td>d049.com</td>" in page and "d050.com" not in page


def test_no_conflicts(spark, tmp_path):
    out = tmp_path / "out"
    cli.main(["merge", "--config", str(config(tmp_path, "||a.com^\n", "||b.com^\n")), "--output-dir", str(out), "--quiet"])
    assert json.loads((out / "conflicts.json").read_text()) == []


def test_audit_in_merge(spark, tmp_path):
    """The audit runs in a merge, writes records, summary and graded lists, and keeps its results for the next run."""
    path = config(tmp_path, "@@||ads.good.com^\n@@||bad.com^\n@@||cdn.new.com^\n@@||broken.com^\n", "||x.com^\n")
    spark.createDataFrame([("cdn.new.com", 3, "R1")], "domain string, domain_age_days int, registrar string").write.parquet(str(tmp_path / "rdap"))
    spark.createDataFrame([("broken.com", "layer raised")], "domain string, error string").write.parquet(str(tmp_path / "failed"))
    (tmp_path / "hosts").write_text("bad.com\n")
    (tmp_path / "known.csv").write_text("social,bad.com\n")
    more = f"""
audit:
  enabled: true
  cache_results: true
  off: [scam_check]
  signals: {{rdap: {tmp_path}/rdap, failed: {tmp_path}/failed}}
  feeds: {{"hosts:URLhaus": {tmp_path}/hosts}}
  known_domains: {tmp_path}/known.csv
allow_output: {{include_all_ratings: true, categories: [advertising]}}
"""
    path.write_text(path.read_text() + more)
    for turn, hits in ((1, 0), (2, 3)):  # a failed domain is asked again
        out = tmp_path / f"out{turn}"
        assert cli.main(["merge", "--config", str(path), "--output-dir", str(out), "--cache-dir", str(tmp_path / "cache"), "--quiet"]) == 0
        audit = json.loads((out / "stats.json").read_text())["audit"]
        assert {r: audit[r] for r in ("safe", "suspicious", "malicious", "unknown")} == {"safe": 1, "suspicious": 1, "malicious": 1, "unknown": 1}
        assert audit["by_rating"]["malicious"]["social"] == 1 and audit["layer_hits"]["urlhaus"] == 1 and audit["layer_hits"]["rdap_new_domain"] == 1 and audit["disk_cache"]["hits"] == hits
        records = json.loads((out / "allow_audit.json").read_text())
        assert [r["domain"] for r in records] == ["bad.com", "cdn.new.com", "broken.com", "ads.good.com"] and len(records[0]) == 30
        assert records[0]["sources"] == ["A"] and records[1]["rdap_registrar"] == "R1" and records[2]["recommendation"] == "review" and records[3]["category"] == "advertising"
        assert (out / "allow_malicious.txt").read_text().splitlines()[3:] == ["@@||bad.com^"] and (out / "allow_by_category" / "safe_advertising.txt").exists() and (out / "allow_by_category" / "malicious_other.txt").exists()
        assert "Audit layers" in (out / "report.md").read_text()


def test_config_problems(tmp_path, capsys):
    bad = {"sources": [{"name": "A", "url": "u", "category": "x"}, {"name": "B", "url": "u", "enabled": False}, {"name": "C"}], "parse": {"min_domain_length": "4", "max_domain_length": 0}, "fold": {"mode": "other"}, "download": {"backoff": "cubic"}, "output": {"formats": ["pdf"]}}
    problems = check_config(bad)[3]
    assert len(problems) == 8
    assert check_config(None)[3] == ["sources: at least one must be enabled"]
    path = config(tmp_path)
    assert [s.name for s in load_config(str(path)).enabled] == ["A", "B"]
    assert cli.main(["validate", "--config", str(path)]) == 0 and cli.main(["version"]) == 0
    path.write_text("sources: []")
    assert cli.main(["validate", "--config", str(path)]) == 1


def test_landing(spark, tmp_path):
    replies = []
    asked = []

    def opener(url, headers, timeout):
        asked.append(headers)
        r = replies.pop(0)
        if isinstance(r, Exception):
            raise r
        return r

    clock = [0.0]
    how = {"opener": opener, "now": lambda: clock[0], "sleep": lambda s: clock.__setitem__(0, clock[0] + s)}
    get = lambda **more: landing.land("http://x/l", str(tmp_path), Store(spark), **how, **more)
    replies[:] = [OSError("Connection reset"), (200, {"ETag": "e1"}, b"||a.com^")]
    first = get()
    assert first.ok and not first.cached and Store(spark).read(first.path) == b"||a.com^"
    replies[:] = [(304, {}, b"")]
    assert get().cached and asked[-1] == {"If-None-Match": "e1"}
    replies[:] = [(500, {}, b"")] * 3
    stale = get()
    assert stale.ok and stale.cached and stale.error == "HTTP 500"
    assert get(negative_ttl=1000).error == "failed a short time ago"
    replies[:] = [(404, {}, b"")]
    assert not get().ok
    replies[:] = [OSError("x")] * 9
    assert landing.land("http://y", str(tmp_path), Store(spark), retries=8, delay=50, **how).error == "deadline exceeded"
    replies[:] = [(200, {}, b"new")]
    assert not get(use_cache=False).cached and get(ttl=1000).cached
    replies[:] = [(200, {}, b"feed"), OSError("down")]
    states = []
    for wait in (0, 10, 5000):
        clock[0] += wait
        states.append(landing.feed("http://f", str(tmp_path), Store(spark), 3600, retries=0, **how)[1])
    assert states == ["fresh", "cached", "stale"]
    assert landing.clear(str(tmp_path), Store(spark)) > 0 and Store(spark).names(str(tmp_path)) == []
    assert [landing.backoff_delay(i, 1, k) for k in ("linear", "exponential") for i in range(3)] == [1, 2, 3, 1, 2, 4]


def test_feeds_and_previous(spark, tmp_path):
    (tmp_path / "hosts").write_text("# c\nBad.com\n\nx\nhttp://a/b.c\nworse.com \n")
    (tmp_path / "csv").write_text('ioc_type,ioc_value\ndomain," Evil.com"\nurl,http://x\ndomain,\n')
    assert sorted(r["domain"] for r in files.read_host_feed(spark, str(tmp_path / "hosts"), "URLhaus").collect()) == ["bad.com", "worse.com"]
    assert [tuple(r) for r in files.read_csv_feed(spark, str(tmp_path / "csv"), "ThreatFox").collect()] == [("evil.com", "ThreatFox")]


def test_parsed_store(spark, tmp_path):
    df = spark.createDataFrame([("h1", "o", "a.com"), ("h2", "o", "b.com"), ("h1", "p", "c.com")], "content_hash string, options string, domain string")
    files.write_parsed(df, str(tmp_path / "store"))
    got = files.read_parsed(spark, str(tmp_path / "store"), spark.createDataFrame([("h1",)], "content_hash string"), "o")
    assert [r["domain"] for r in got.collect()] == ["a.com"]


def test_guard(spark):
    log = spark.createDataFrame([(True,), (False,)], "ok boolean")
    files.failure_guard(log, 0.5)
    with pytest.raises(RuntimeError):
        files.failure_guard(log, 0.4)
    with pytest.raises(RuntimeError):
        files.failure_guard(log.filter("NOT ok"), 1.0)


def test_eviction(spark):
    rows = [(f"u{i}", f"c{i % 4}", 10, f"2024-01-01 0{i}:00:00") for i in range(8)] + [("n", None, None, None)]
    df = spark.createDataFrame(rows, "url string, content_hash string, size_bytes long, t string").withColumn("fetched_at", F.col("t").cast("timestamp")).drop("t")
    gone = {r["url"]: r["content_kept"] for r in cache.evicted(df, 25).collect()}
    assert set(gone) == {"n", *(f"u{i}" for i in range(6))} and gone["u3"] and not gone["u1"]
    assert cache.evicted(df, 1000).count() == 0


def test_skewed_join(spark, monkeypatch):
    monkeypatch.setattr(skew, "HOT_ROWS", 10)
    monkeypatch.setattr(skew, "HOT_PARTS", 10)
    rows = spark.createDataFrame([(i, 1 if i % 3 else i, 5) for i in range(200)] + [(500, None, 5), (501, 1, None)], "id long, k long, k2 long")
    lookup = spark.createDataFrame([(k, 5, f"p{k}", 134 if k == 1 else 1) for k in range(100)], "k long, k2 long, p string, n long")
    got = skew.attach(rows, lookup, ["k", "k2"], ["p"], F.col("n"), 200, F.col("id"))
    want = {(r["id"], f"p{r['k']}") for r in rows.collect() if r["k"] is not None and r["k2"] == 5 and r["k"] < 100}
    assert {tuple(r) for r in got.collect()} == want


def test_stream(spark, tmp_path):
    from siftlane.streaming import compile_stream as C

    land, out, check = (str(tmp_path / x) for x in ("land", "out", "check"))
    write = lambda rows: spark.createDataFrame(rows, C.LINES).coalesce(1).write.mode("append").parquet(land)
    write([(0, 1, "||a.com^", "ads"), (0, 2, "! note", "ads")])
    C.start(spark, land, out, check).awaitTermination()
    write([(1, 1, "||a.com^", "malware"), (1, 2, "||b.com^", "ads")])
    C.start(spark, land, out, check).awaitTermination()
    got = {r["domain"]: (r["category"], r["source_ords"]) for r in C.current(spark, out).collect()}
    assert got == {"a.com": ("malware", [0, 1]), "b.com": ("ads", [1])}
    Store(spark).remove(f"{out}/1/_DONE")
    write([(2, 1, "||c.com^", "ads")])
    with pytest.raises(Exception, match="doesn't find the table"):
        C.start(spark, land, out, check).awaitTermination()


def test_a_cluster_needs_a_shared_folder():
    from types import SimpleNamespace as N

    from siftlane.runtime import ensure_checkpoint_dir

    none = N(get=lambda *a: None)
    sc = N(_jsc=N(sc=lambda: N(getCheckpointDir=lambda: N(isDefined=lambda: False))), getConf=lambda: none, master="spark://host:7077")
    with pytest.raises(RuntimeError, match="checkpoint"):
        ensure_checkpoint_dir(N(sparkContext=sc, conf=none))


def test_script_safe():
    assert exports.script_safe({"x": "</script>"}) == '{"x": "<\\/script>"}'
