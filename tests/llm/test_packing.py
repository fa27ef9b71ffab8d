import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from siftlane.llm import packing as P


def check(histogram):
    planned = P.plan(np.array(histogram, np.int64))
    used = np.zeros(len(histogram), np.int64)
    for pattern, times in zip(planned.patterns, planned.repeats):
        assert sum(pattern) <= planned.capacity and times > 0
        for length in pattern:
            used[length] += times
    assert used[1:].tolist() == list(histogram)[1:]
    return planned


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 40), min_size=2, max_size=40))
def test_plans_hold_every_item(histogram):
    check(histogram)


def test_little_room_left():
    rng = np.random.default_rng(2)
    lengths = np.clip(rng.lognormal(5.5, 1, 20000).astype(int), 1, 2048)
    histogram = np.bincount(lengths, minlength=2049)
    planned = check(histogram)
    least = (histogram * np.arange(2049)).sum() / 2048
    assert least / planned.containers > 0.995
    assert planned.by_patterns > 0.9 * planned.containers
    few = check(np.bincount(lengths[:800], minlength=2049))
    assert few.by_patterns > 0.8 * few.containers


def test_empty_plan():
    assert check([5, 0, 0]).containers == 0


def packed(spark, sizes, capacity=10):
    df = spark.createDataFrame(sizes, "id long, size int, n string, place string")
    return P.pack(df, capacity).toPandas()


def sound(out, capacity):
    assert (out.groupby("container_id").n.sum() <= capacity).all()
    for _, g in out.sort_values(["container_id", "place"]).groupby("container_id"):
        assert g.place.tolist() == list(range(len(g)))
        filled = g[g.n > 0]
        assert filled.start.tolist() == (filled.n.cumsum() - filled.n).tolist()


def test_rows(spark):
    sizes = [(i, i % 13, "x", "x") for i in range(300)] + [(7, 7, "x", "x"), (None, 3, "x", "x"), (1000, None, "x", "x"), (1001, 25, "x", "x")]
    out = packed(spark, sizes)
    sound(out, 10)
    assert out.n.sum() == sum(s or 0 for _, s, *_ in sizes)
    assert out[out.id == 1001].n.tolist().count(10) == 2 and sorted(out[out.id == 1001].piece_no) == [0, 1, 2]
    assert len(out[out.id == 1000]) == 1 and len(out[out.id == 7]) == 2
    assert (out[(out.id != 1001) & (out.n > 0)].groupby("id").piece_no.nunique() >= 1).all()
    only_long = out.groupby("id").piece_no.max()
    assert set(only_long[only_long > 0].index) == {i for i, s, *_ in sizes if i is not None and (s or 0) > 10}


def test_hot_length_in_parts(spark, monkeypatch):
    monkeypatch.setattr(P, "RANK_ROWS", 50)
    out = packed(spark, [(i, 3 if i % 3 else i % 9, "x", "x") for i in range(900)])
    sound(out, 10)
    assert len(out) == 900


@pytest.mark.parametrize("sizes", [[], [(1, 0, "", "")] * 3, [(1, 10, "", "")] * 4])
def test_small(spark, sizes):
    out = packed(spark, sizes)
    assert len(out) == len(sizes)
    sound(out, 10)
