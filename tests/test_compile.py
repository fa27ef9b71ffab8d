import random

from siftlane.functions import domains as D
from siftlane.operators import compile as K
from siftlane.operators import stats as S
from siftlane.operators.parse import parse, rules_of

SCHEMA = "rule_type string, domain string, wildcard boolean, modifiers string, raw string, category string, source_ords array<int>"


def rules(spark, *texts):
    """Rules from texts, one source each."""
    rows = [(i, i, t, "ads") for i, t in enumerate(texts)]
    lines = spark.createDataFrame(rows, "source_ord int, line_no bigint, line string, category string")
    return rules_of(parse(lines))


def texts(frame):
    out = D.output_text(frame["rule_type"], frame["domain"], frame["wildcard"], frame["modifiers"], frame["raw"])
    return sorted(r[0] for r in frame.select(out).collect())


def compiled(spark, *lines, **o):
    return K.compile_rules(rules(spark, *lines), K.CompileOptions().with_(**o))


def test_worked_example(spark):
    c = compiled(spark, "||a.x.com^", "||*.x.com^", "||x.com^", "||b.x.com^$important", "@@||x.com^")
    assert texts(c.blocks) == ["||b.x.com^$important"]
    assert texts(c.allows) == ["@@||x.com^"]
    assert c.folded.counters().first()["exact_aggregated"] == 1
    assert c.conflicts.count() == 2


def test_fold_cases(spark):
    def counters(*lines, **o):
        f = compiled(spark, *lines, fold=K.FoldOptions(**o)).folded
        return tuple(f.counters().first())

    assert counters("||*.example.com^", "||ads.example.com^") == (1, 0, 0)
    assert counters("||example.com^", "||ads.example.com^") == (1, 0, 0)
    assert counters("||*.example.com^", "||example.com^") == (0, 1, 0)
    assert counters("||*.example.com^", "||*.sub.example.com^") == (0, 1, 0)
    assert counters("||*.example.com^", "||*.sub.example.com^", fold_wildcards=False) == (0, 0, 0)
    assert counters("||a.example.com^", "||b.example.com^", "||c.example.com^", promotion_threshold=3) == (0, 0, 3)
    assert counters("||a.example.com^", "||b.example.com^", promotion_threshold=3) == (0, 0, 0)
    assert counters("||cdn1.example.com^", "||cdn2.example.com^", "||cdn3.example.com^", promotion_threshold=3, mode="pattern") == (0, 0, 3)
    assert counters("||cdn1.example.com^", "||foo.example.com^", "||bar.example.com^", promotion_threshold=3, mode="pattern") == (0, 0, 0)
    assert counters("||*.example.com^", "||ads.example.com^$important") == (0, 0, 0)
    assert counters("||*.example.com^$badfilter", "||a.example.com^", "||b.example.com^", "||c.example.com^", promotion_threshold=3) == (0, 0, 0)


def test_suffix_guard(spark):
    children = lambda parent: [f"||{x}.{parent}^" for x in "abc"]
    found = K.split(K.dedup(rules(spark, *children("co.uk"), *children("x.ck"), *children("www.ck"), *children("example.com"))))[0]
    parents = lambda o, suffixes=None: {r["parent"] for r in K.promotions(found, o, suffixes=suffixes).collect()}
    everything = {"co.uk", "x.ck", "www.ck", "example.com"}
    assert parents(K.FoldOptions(promotion_threshold=2, suffix_guard=False)) == everything
    assert parents(K.FoldOptions(promotion_threshold=2)) == everything - {"co.uk"}
    listed = spark.createDataFrame([("co.uk", "plain"), ("ck", "wildcard"), ("www.ck", "exception"), ("com", "plain")], "rule_domain string, kind string")
    assert parents(K.FoldOptions(promotion_threshold=2), listed) == {"www.ck", "example.com"}


def test_patterns_and_empty_tables(spark):
    c = compiled(spark, "/^ads/", "/^ads/", "@@/^ok/", "||a.com^$important", fold=K.FoldOptions(promotion_threshold=1))
    assert texts(c.blocks) == ["/^ads/", "||a.com^$important"] and texts(c.allows) == ["@@/^ok/"]
    none = compiled(spark, "! only a comment")
    assert none.rules.count() == 0 and none.conflicts.count() == 0 and tuple(none.folded.counters().first()) == (0, 0, 0)


def test_badfilter(spark):
    left = lambda *x: texts(K.badfilter(K.dedup(rules(spark, *x)).drop("copies", "first_raw", "other_raw")))
    assert left("||pl.ua^", "||pl.ua^$badfilter") == []
    assert left("||pl.ua^$badfilter") == []
    assert left("||x.com^", "||x.com^$important", "||x.com^$badfilter,important") == ["||x.com^"]
    assert left("||x.com^$client=x,important", "||x.com^$badfilter,important,client=x") == []
    assert left("@@||x.com^", "||x.com^$badfilter") == ["@@||x.com^"]


def test_conflicts(spark):
    kept = lambda *x, **o: texts(compiled(spark, *x, **o).blocks)
    assert kept("@@||example.com^", "||ads.example.com^", "||track.example.com^") == []
    assert len(kept("@@||example.com^", "||ads.example.com^", "||track.example.com^", cascade=False)) == 2
    assert kept("@@||*.example.com^", "||example.com^", "||ads.example.com^", folding=False) == ["||example.com^"]
    assert kept("@@||example.com^", "||example.com^$important") == ["||example.com^$important"]
    assert kept("@@||x.com^", "||*.x.com^") == []
    assert kept("@@||*.x.com^", "||*.x.com^") == ["||*.x.com^"]
    assert kept("@@||com^", "||x.com^", "/x/") == ["/x/", "||x.com^"]  # a single label isn't a rule


def test_merging(spark):
    lines = spark.createDataFrame([(1, 1, "||b.com^", "ads"), (0, 5, "||www.b.com^", "tracking"), (1, 2, "||b.com^", "ads"), (2, 1, "/x/$b,a", "ads"), (0, 1, "/x/$a,b", "mining")], "source_ord int, line_no bigint, line string, category string")
    from siftlane.operators.parse import ParseOptions

    d = K.dedup(rules_of(parse(lines, ParseOptions(strip_www=True))))
    got = {r["domain"]: r for r in d.collect()}
    assert got["b.com"]["category"] == "tracking" and got["b.com"]["source_ords"] == [0, 1]
    assert got[""]["category"] == "mining" and got[""]["raw"] == "/x/$a,b"
    assert tuple(K.dedup_counters(d).first()) == (0, 2, 1)


def test_integration_list(spark):
    lines = "||ads.example.com^ ||track.example.com^ ||ads.example.com^ ||child.ads.example.com^ 0.0.0.0_host.example.com @@||allow.example.com^ @@||ads.example.com^ ||cdn1.static.example.com^ ||cdn2.static.example.com^ ||cdn3.static.example.com^ #_comment /^192\\.168\\.\\d+\\.\\d+$/"
    c = compiled(spark, *[x.replace("_", " ") for x in lines.split()], fold=K.FoldOptions(promotion_threshold=2))
    assert tuple(c.folded.counters().first()) == (1, 1, 6)
    assert texts(c.blocks) == ["/^192\\.168\\.\\d+\\.\\d+$/", "||*.example.com^"]
    assert texts(c.allows) == ["@@||ads.example.com^", "@@||allow.example.com^"]


def sequential(exact, wild, allowed, least, threshold, fold_wildcards, voided):
    """Folding rule by rule, with maps that change underway."""
    up = lambda d: [".".join(d.split(".")[i:]) for i in range(1, d.count(".") + 1) if d.count(".") + 1 - i >= least]
    exact, wild = set(exact), set(wild)
    promoted = set()
    if threshold:
        groups = {}
        for d in sorted(exact):
            if d.count(".") + 1 >= least + 1:
                groups.setdefault(d.split(".", 1)[1], []).append(d)
        for parent, children in groups.items():
            if parent not in wild | exact and parent not in voided and len(children) >= threshold:
                promoted.update(children)
                wild = wild | {parent}
    gone_exact = {d for d in exact - promoted if d not in allowed and any(p in wild or p in exact for p in up(d))}
    gone_wild = {d for d in wild if fold_wildcards and d not in allowed and (d in exact or any(p in wild or p in exact for p in up(d)))}
    return (exact - promoted - gone_exact, wild - gone_wild), (len(gone_exact), len(gone_wild), len(promoted))


def test_folding_property(spark):
    rng = random.Random(5)
    names = ["a", "b", "c1", "ads2"]
    cases, rows = [], []
    for case in range(60):
        tld = f"t{case}"
        some = lambda n: {".".join(rng.choice(names) for _ in range(rng.randint(1, 3))) + "." + tld for _ in range(n)}
        exact, wild, allowed = some(8), some(3), some(2)
        cases.append((exact, wild, allowed, tld))
        rows += [("block", d, False, "", "", "ads", [case]) for d in exact] + [("block", d, True, "", "", "ads", [case]) for d in wild] + [("allow", d, False, "", "", "ads", [case]) for d in allowed]
    frame = spark.createDataFrame(rows, SCHEMA)
    for least, threshold, wildcards in ((2, 0, True), (1, 2, True), (3, 3, False), (2, 2, True)):
        blocks, allows = K.split(frame)
        f = K.fold(blocks, allows, K.FoldOptions(min_labels=least, promotion_threshold=threshold, fold_wildcards=wildcards))
        got = {}
        for r in f.marked.collect():
            got.setdefault(r["domain"].split(".")[-1], []).append(r)
        for exact, wild, allowed, tld in cases:
            (want_exact, want_wild), counts = sequential(exact, wild, allowed, least, threshold, wildcards, set())
            mine = got[tld]
            assert {r["domain"] for r in mine if r["fate"] == "kept" and not r["wildcard"]} == want_exact
            assert {r["domain"] for r in mine if r["fate"] == "kept" and r["wildcard"]} == want_wild
            assert tuple(sum(r["fate"] == x for r in mine) for x in ("exact", "wildcard", "promoted")) == counts
        kept = K.fold_provenance(f)
        assert kept.count() == f.survivors.count()
        every = {(o,) for r in kept.select("source_ords").collect() for o in [tuple(r[0])]}
        assert {x for (t,) in every for x in t} == set(range(60))  # no source is lost


def test_idempotent_and_unordered(spark):
    lines = [f"||s{i % 7}.d{i % 3}.com^" for i in range(40)] + ["@@||d1.com^", "||*.d2.com^"]
    first = texts(compiled(spark, *lines).rules)
    assert texts(compiled(spark, *reversed(lines)).rules) == first
    again = compiled(spark, *first)
    assert texts(again.rules) == first and again.conflicts.count() == 0


def test_empty(spark):
    c = compiled(spark)
    assert c.rules.count() == 0 and c.conflicts.count() == 0


def test_statistics(spark):
    final = spark.createDataFrame([("block", "a.com", False, "", "", "ads", [1, 2]), ("block", "b.com", False, "important", "", "ads", [2]), ("block", "", False, "", "/x/", "ads", [1, 2]), ("allow", "a.com", False, "", "", "ads", [2])], SCHEMA)
    raw = spark.createDataFrame([(1, 10), (2, 4), (3, 0)], "source_ord int, raw_rules bigint")
    got = {r["source_ord"]: r for r in S.contributions(final, raw).collect()}
    # the allow rule comes last for a.com, so its single source makes the domain unique
    assert (got[1]["unique_rules"], got[1]["shared_rules"], got[1]["coverage_rate"]) == (1, 1, 20.0)
    assert (got[2]["unique_rules"], got[2]["effective_rules"], got[2]["unique_rate"]) == (3, 4, 75.0)
    assert (got[3]["effective_rules"], got[3]["coverage_rate"]) == (0, 0.0)
    pair = S.overlap_rates(S.overlap_pairs(final)).first()
    assert (pair["overlap"], pair["joint"], pair["jaccard"], pair["heat"]) == (2, 4, 50.0, "high")
    assert {(r["modifier"], r["rules"]) for r in S.modifier_counts(final).collect()} == {("important", 1)}
