import random
from collections import Counter
from itertools import combinations_with_replacement

from siftlane.llm import overlap as O


def pairs(state):
    by_item = {}
    for item, s in state:
        by_item.setdefault(item, set()).add(s)
    return Counter(p for sets in by_item.values() for p in combinations_with_replacement(sorted(sets), 2))


def test_changes_add_up(spark):
    rng = random.Random(4)
    state: set = set()
    members, counts = O.empty_members(spark.createDataFrame([], "item long, set string")), None
    for _ in range(3):
        batch = [(rng.randint(0, 30), rng.choice("abcde"), rng.random() < 0.6) for _ in range(80)]
        joins = {(i, s) for i, s, j in batch if j}
        leaves = {(i, s) for i, s, j in batch if not j} - joins
        state = (state - leaves) | joins
        dirty = [*batch, *batch[:5], (None, "a", True), (1, None, True), (1, "a", None)]
        members, counts = O.apply_changes(members, counts, spark.createDataFrame(dirty, "item long, set string, joins boolean"))
        members = spark.createDataFrame([tuple(r) for r in members.collect()], members.schema)
        counts = spark.createDataFrame([tuple(r) for r in counts.collect()], "a string, b string, n long")
        assert {(r["item"], s) for r in members.collect() for s in r["sets"]} == state
        assert {(r["a"], r["b"]): r["n"] for r in counts.collect()} == dict(pairs(state))


def test_steps_with_and_without_leaves(spark):
    rng = random.Random(9)
    rows = [(rng.randint(0, 20), rng.choice("abcd"), rng.choice([1, 2, 5])) for _ in range(120)]
    df = spark.createDataFrame([*rows, *rows[:9], (None, "a", 1), (1, None, 2), (1, "a", None)], "item long, set string, step int")
    read = lambda counts: {(r["a"], r["b"]): r["n"] for r in counts.collect()}
    assert read(O.maintained(df, leaves=False)) == dict(pairs({(i, s) for i, s, _ in rows}))
    assert read(O.maintained(df, leaves=True)) == dict(pairs({(i, s) for i, s, t in rows if t == 5}))
    total = Counter()
    deltas = O.deltas_by_step(df).collect()
    for step in (1, 2, 5):
        for r in deltas:
            if r["step"] == step:
                total[r["a"], r["b"]] += r["delta"]
        assert {k: n for k, n in total.items() if n} == dict(pairs({(i, s) for i, s, t in rows if t == step}))
    assert len(deltas) == len({(r["step"], r["a"], r["b"]) for r in deltas}) and all(r["delta"] for r in deltas)
    assert O.maintained(df.limit(0), leaves=True).count() == 0 and O.deltas_by_step(df.limit(0)).count() == 0


def test_an_item_in_very_many_sets(spark):
    n = 5_000
    df = spark.range(n).selectExpr("7L AS item", "format_string('s%05d', id) AS set", "1 AS step").unionByName(spark.range(0, n, 50).selectExpr("8L", "format_string('s%05d', id)", "1").toDF("item", "set", "step"))
    got = O.maintained(df, leaves=False).selectExpr("count(*)", "sum(n)", "count_if(a > b)").first()
    one = lambda k: k * (k + 1) // 2
    assert tuple(got) == (one(n), one(n) + one(100), 0)


def test_similar(spark):
    counts = spark.createDataFrame([("a", "a", 10), ("b", "b", 10), ("c", "c", 10), ("a", "b", 4), ("a", "c", 3)], "a string, b string, n long")
    got = [(r["a"], r["b"]) for r in O.similar_pairs(counts, 25).collect()]
    assert got == [("a", "b")]
