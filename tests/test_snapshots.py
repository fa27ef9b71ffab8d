import random
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from siftlane.operators import snapshots as S

SCHEMA = "key string, at int, value string, since timestamp, record_key string"


def brute(rows):
    held = {}
    for key, at, value, since, _ in rows:
        if key is None or at is None:
            continue
        rank = since or datetime.min
        if (at, key) not in held or rank > held[at, key][0]:
            held[at, key] = (rank, value if value is None else value.strip().lower())
    numbers = sorted({at for at, _ in held})
    out = set()
    for old, new in zip(numbers, numbers[1:]):
        a, b = ({k: v[1] for (at, k), v in held.items() if at == n} for n in (old, new))
        out |= {(k, new, "added") for k in b.keys() - a.keys()} | {(k, new, "removed") for k in a.keys() - b.keys()} | {(k, new, "changed") for k in a.keys() & b.keys() if a[k] != b[k]}
    return out


def run(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    return sorted(tuple(r) for r in S.changes(df, "key", "at", S.trimmed_lower(F.col("value")), "since").collect())


def make(seed, keys, churn):
    rng = random.Random(seed)
    day = datetime(2025, 1, 1)
    state = {f"k{i}": f"v{i}" for i in range(keys)}
    rows = []
    for at in (1, 2, 4, 5):
        for k, v in state.items():
            rows.append((k, at, rng.choice([v, v.upper(), f" {v}\t", None if v is None else v]) if v else v, day + timedelta(days=at), "x"))
            if rng.random() < 0.1:
                rows.append((k, at, "stale", day, "x"))
        for k in rng.sample(sorted(state), int(len(state) * churn)):
            r = rng.random()
            if r < 0.3:
                del state[k]
            else:
                state[k] = None if r < 0.4 else f"w{rng.random()}"
        for i in range(int(keys * churn)):
            state[f"n{at}_{i}"] = "new"
    rows += [(None, 1, "v", day, "x"), ("k1", None, "v", day, "x"), ("k2", 2, "late", None, "x")]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize(("keys", "churn"), [(300, 0.02), (300, 0.9), (5, 0.5)])
def test_against_brute_force(spark, keys, churn):
    rows = make(keys, keys, churn)
    got = run(spark, rows)
    assert len(got) == len(set(got)) and set(got) == brute(rows)


def test_enlarging_and_exact_fallback(spark, monkeypatch):
    """So few cells that every bucket fails at first, and in the end is compared pair by pair."""
    rows = make(1, 400, 0.8)
    monkeypatch.setattr(S, "CELLS_PER_PAIR", 0)
    monkeypatch.setattr(S, "SPARE_CELLS", 6)
    assert set(run(spark, rows)) == brute(rows)
    monkeypatch.setattr(S, "ENLARGE", 1)
    assert set(run(spark, rows)) == brute(rows)


def test_many_buckets_and_a_hot_key(spark, monkeypatch):
    monkeypatch.setattr(S, "ROWS_PER_BUCKET", 16)
    monkeypatch.setattr(S, "SENT_HASHES", 10)
    monkeypatch.setattr(S, "SENT_DELIVERIES", 1)
    rows = make(2, 100, 0.1)
    day = datetime(2025, 1, 1)
    rows += [("k3", at, "old", day - timedelta(days=i), "x") for at in (1, 2, 4) for i in range(300)]
    assert set(run(spark, rows)) == brute(rows)


def test_empty_and_single(spark):
    assert run(spark, []) == []
    assert run(spark, [("a", 1, "x", None, "")]) == []


def test_hash_equals_spark(spark):
    values = [(0, 1), (-1, 5), (2**63 - 1, -(2**63)), (12345678901, 42)]
    df = spark.createDataFrame(values, "a long, b long").select(F.xxhash64("a", "b"), F.xxhash64("a", "b", F.lit(7).cast("long")))
    a, b = (np.array(c, np.int64) for c in zip(*values))
    assert [r[0] for r in df.collect()] == S.hash_pairs(a, b).tolist()
    assert [r[1] for r in df.collect()] == S.hash_pairs(a, b, 7).tolist()


def test_peel_reports_failure():
    size = 4
    keys, values = np.arange(40, dtype=np.int64), np.arange(40, dtype=np.int64) + 100
    table = [np.zeros(3 * size, np.int64) for _ in range(4)]
    checks = S.hash_pairs(keys, values, S.CHECK_SEED)
    for cell in S.cells_of(S.hash_pairs(keys, values), size):
        np.add.at(table[0], cell, 1)
        for t, x in zip(table[1:], (keys, values, checks)):
            np.bitwise_xor.at(t, cell, x)
    assert S.peel(*table)[3] is False
