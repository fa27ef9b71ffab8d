from collections import Counter

import numpy as np

from siftlane.llm import frequent as Q


def test_sketch_never_undercounts():
    rng = np.random.default_rng(0)
    data = np.concatenate([rng.integers(-(2**62), 2**62, 20000), np.repeat(rng.integers(-(2**62), 2**62, 20), 1000)])
    rng.shuffle(data)
    sketch = Q.Sketch(buckets=8, cells=4, light=256)
    for part in np.array_split(data, 50):
        sketch.add(part)
    truth = Counter(data.tolist())
    held = {k: c for k, c in zip(sketch.key.ravel().tolist(), sketch.count.ravel().tolist()) if c}
    assert sum(held.values()) + sketch.light.sum() == len(data)
    for key, n in truth.items():
        light = sketch.light[(np.array([key]).view(np.uint64) >> np.uint64(20)).astype(np.int64)[0] & 255]
        assert held.get(key, 0) + light >= n


def test_newcomer_evicts():
    sketch = Q.Sketch(buckets=1, cells=1, light=16)
    sketch.add(np.array([1, 1]))
    for _ in range(30):
        sketch.add(np.array([2]))
    assert sketch.key[0, 0] == 2 and sketch.light.sum() + sketch.count.sum() == 32


def test_against_counts(spark):
    values = ["hot.example"] * 60 + [" HOT.example."] * 40 + ["half.example"] * 2 + [f"v{i}.example" for i in range(300)] + [None, "", " \t"] * 5 + ["é.Example"] * 2
    df = spark.createDataFrame([(v, i) for i, v in enumerate(values)], "domain string, value int").repartition(7)
    got = {r["domain"]: r for r in Q.frequent(df, "domain").collect()}
    # 404 rows count, so three make one in two hundred
    assert set(got) == {"hot.example"} and got["hot.example"]["exact_count"] == 100 and got["hot.example"]["approx_count"] >= 100
    assert set(r["domain"] for r in Q.frequent(df, "domain", 202).collect()) == {"hot.example", "half.example", "é.example"}


def test_tiny_sketch_stays_exact(spark, monkeypatch):
    """Buckets and counters that are much too few lead to more candidates, not to other results."""
    for name, value in (("BUCKETS", 1), ("CELLS", 1), ("LIGHT", 2)):
        monkeypatch.setattr(Q, name, value)
    monkeypatch.setattr(Q.Sketch.__init__, "__defaults__", (1, 1, 2, 8))
    df = spark.createDataFrame([(f"v{i % 40}" if i % 3 else f"w{i}",) for i in range(600)], "domain string").repartition(3)
    assert len(Q.frequent(df, "domain", 100).collect()) == 40


def test_empty(spark):
    df = spark.createDataFrame([(None,), (" ",)], "domain string")
    assert Q.frequent(df, "domain").count() == 0 and Q.frequent(df.limit(0), "domain").count() == 0
