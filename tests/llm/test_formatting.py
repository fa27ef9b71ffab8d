from collections import defaultdict

from siftlane.llm import formatting as M

SCHEMA = "parsed_id long, run_id int, rule_type string, wildcard boolean, normalized_domain string, modifiers string, raw string, form string, canonical string"
SAME = [
    ["||a-b.example^", "||A-B.EXAMPLE^", " ||a-b.example", "|| a-b.example.^$", "||.a-b.example^$,", "||a-b.example^\r"],
    ["||*.a-b.example^$client=1,important", "||*.a-b.example$Important , CLIENT=1", "||*.a-b.example^$important,client=1,important,"],
    ["@@||a-b.example^"],
    ["||ab.example^"],
    ["||a-b.example^$client=2"],
    ["/^x\\./$b,a", " /^X\\./$a,b,a\t"],
    ["/^x\\./", "/^x\\./$"],
    ["/x\\./"],
    ["@@/^x\\./"],
]


def rows():
    out, groups, i = [], [], 100
    for run in (1, 2):
        for forms in SAME:
            ids = []
            for raw in forms * 2:
                out.append((i, run, "wrong", None, "other", "other", raw, "x", "x"))
                ids.append(i)
                i -= 1 if i % 7 else -50
            groups.append(ids)
    return out, groups


def test_groups(spark):
    data, groups = rows()
    df = spark.createDataFrame(data, SCHEMA)
    want = {(min(g), i) for g in groups for i in g if i != min(g)}
    assert {tuple(r) for r in M.copies(df).collect()} == want
    assert sorted((r["keep_id"], r["copies"]) for r in M.rules(df).collect()) == sorted((min(g), len(g)) for g in groups)


def test_null_raw_and_nulls(spark):
    data = [
        (1, 1, "block", False, "a.example.", "b,a", None, "", ""),
        (2, 1, "BLOCK", False, " A.example", "A , b,b", None, "", ""),
        (3, 1, "block", False, "x", None, "||a.example^$a,b", "", ""),
        (4, 1, "block", True, "a.example", "a,b", None, "", ""),
        (5, None, "block", True, "a.example", "a,b", None, "", ""),
        (6, 1, None, None, None, None, None, "", ""),
        (7, 1, None, None, "", "", None, "", ""),
        (None, 1, "block", False, "a.example", "a,b", None, "", ""),
        (8, 1, "block", False, None, None, "", "", ""),
        (9, 1, "block", False, None, None, " \t", "", ""),
    ]
    got = {tuple(r) for r in M.copies(spark.createDataFrame(data, SCHEMA)).collect()}
    assert got == {(1, 2), (1, 3), (1, None), (6, 7), (8, 9)}


def test_hot_keys_take_the_other_way(spark, monkeypatch):
    from siftlane.operators import skew

    monkeypatch.setattr(skew, "HOT_ROWS", 3)
    monkeypatch.setattr(skew, "HOT_PARTS", 10)
    data, groups = rows()
    data += [(1000 + i, 1, "x", None, "", "", "||hot.example^" if i % 2 else "||HOT.example^", "", "") for i in range(100)]
    got = defaultdict(int)
    for r in M.copies(spark.createDataFrame(data, SCHEMA)).collect():
        got[r["keep_id"]] += 1
    assert got[1000] == 99 and sum(got.values()) == 99 + sum(len(g) - 1 for g in groups)


def test_empty_and_long(spark):
    assert M.copies(spark.createDataFrame([], SCHEMA)).count() == 0
    long = "||" + "a." * 50_000 + "example^"
    df = spark.createDataFrame([(1, 1, "", True, "", "", long, "", ""), (2, 1, "", True, "", "", long.upper(), "", "")], SCHEMA)
    assert [tuple(r) for r in M.copies(df).collect()] == [(1, 2)]
