"""Filling containers of fixed capacity with items of varying length (problem 7).

Only the histogram of lengths reaches the driver: at most ``capacity`` rows,
whatever the data. There the packing is planned:

1. few-item *patterns* that fill their room exactly are enumerated over the lengths
   that occur, for whole containers and for halves of them;
2. how often each pattern is used is fitted to the histogram by non-negative least
   squares (accelerated projected gradient, until it no longer gains), then again on
   the support, the strongest ``SUPPORT`` patterns of each length;
3. repeat counts are rounded down, and the largest remainders up, as far as items are
   left;
4. 1 to 3 are repeated on what is left while patterns still take a part of it, and
   the residual histogram is packed best-fit, longest first, in whole groups of equal
   containers.

The plan is a table of slots: for a length, a range of ranks and the containers
these ranks go to. Its size depends on the capacity alone. Items are ranked
within their length in parts of at most about ``RANK_ROWS`` rows, so a length
that a third of all items have is still spread over many tasks.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..runtime import settle
from .bpe import DEFAULT_RANKS, count_tokens

CAPACITY = 2048
#: Items of one length that one task ranks.
RANK_ROWS = 1 << 20
#: How often a pattern of more than three items repeats one length.
REPEATED = range(3, 12)
#: Patterns kept for each length, by their repeats, when the fit is done again on its support.
SUPPORT = 4
#: The fit ends when this many rounds gain less than this share of the distance left, or after so many rounds.
GAIN_ROUNDS, GAIN, MOST_ROUNDS = 20, 0.01, 400
#: Patterns are fitted again while a turn fills at least this share of the containers that the rest needs.
LEAST_TURN = 0.02


@dataclass(frozen=True)
class Plan:
    """Groups of equal containers. ``patterns[i]`` holds the lengths of the containers ``first[i] .. first[i] + repeats[i] - 1``."""

    capacity: int
    patterns: list[tuple[int, ...]]
    repeats: list[int]
    #: Containers that fitted patterns fill, and the distance of each fit from its histogram, as a share of it.
    by_patterns: int = 0
    distances: tuple[float, ...] = ()

    @property
    def containers(self) -> int:
        return sum(self.repeats)

    def first(self) -> list[int]:
        return np.concatenate([[0], np.cumsum(np.array(self.repeats, dtype=np.int64))])[:-1].tolist() if self.repeats else []


def _with_sum(room: int, here: np.ndarray, has: np.ndarray, repeated: bool = True) -> list[np.ndarray]:
    """Patterns of one to three items, and of one length ``repeated`` with a rest, whose sum is ``room``."""
    here = here[here <= room]
    found = [here[here == room][:, None]]
    pair = here[(here <= room // 2) & has[room - here]]
    found.append(np.stack([pair, room - pair], 1))
    a, b = (x.ravel() for x in np.meshgrid(here, here, indexing="ij"))
    ok = (a <= b) & (room - a - b >= b)
    a, b = a[ok], b[ok]
    ok = has[room - a - b]
    found.append(np.stack([a[ok], b[ok], room - a[ok] - b[ok]], 1))
    for times in REPEATED if repeated else ():
        rest = room - times * here
        ok = rest > 0
        ok[ok] = has[rest[ok]]
        found.append(np.concatenate([np.repeat(here[ok][:, None], times, 1), rest[ok][:, None]], 1))
    return [x for x in found if len(x)]


def enumerate_patterns(histogram: np.ndarray) -> list[np.ndarray]:
    """Arrays of shape (patterns, items) with lengths that occur. A row's sum is the capacity, or half of an even one."""
    capacity = len(histogram) - 1
    has = histogram > 0
    has[0] = False
    here = np.flatnonzero(has)
    if capacity % 2:
        return _with_sum(capacity, here, has)
    return _with_sum(capacity, here, has, repeated=False) + _with_sum(capacity // 2, here, has)


def fit_repeats(patterns: list[np.ndarray], histogram: np.ndarray) -> tuple[list[np.ndarray], np.ndarray, float]:
    """The patterns of the support, their non-negative repeat counts that bring the lengths closest to the histogram (long items weigh more), and the distance left as a share of it."""
    weight = 0.1 + np.arange(len(histogram)) / len(histogram)
    square, scale = weight**2, max(1.0, float(histogram.max()))
    goal = histogram / scale

    def solve(rows: np.ndarray, of: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, float]:
        forward = lambda x: np.bincount(rows, x[of], len(histogram))
        backward = lambda r: np.bincount(of, (square * r)[rows], len(x))
        probe = np.ones(len(x))
        for _ in range(12):
            probe /= np.linalg.norm(probe)
            probe = backward(forward(probe))
        step = 1 / (1.05 * np.linalg.norm(probe))
        y, t, distance, past = x, 1.0, np.inf, np.inf
        for k in range(MOST_ROUNDS):
            new = np.maximum(0, y - step * backward(forward(y) - goal))
            t_new = (1 + (1 + 4 * t * t) ** 0.5) / 2
            y = new + (t - 1) / t_new * (new - x)
            x, t = new, t_new
            if k % GAIN_ROUNDS == 0:
                distance = float(np.linalg.norm(weight * (forward(x) - goal)))
                if past - distance < GAIN * distance:
                    break
                past = distance
        return x, distance / max(1e-12, float(np.linalg.norm(weight * goal)))

    spelled = lambda ps: (np.concatenate([p.ravel() for p in ps]), np.repeat(np.arange(sum(map(len, ps))), np.concatenate([np.full(len(p), p.shape[1]) for p in ps])))
    rows, of = spelled(patterns)
    x, _ = solve(rows, of, np.zeros(of[-1] + 1))
    order = np.lexsort((-x[of], rows))
    first = np.searchsorted(rows[order], np.arange(len(histogram)))
    strong = np.zeros(len(x), bool)
    strong[of[order[np.arange(len(order)) - first[rows[order]] < SUPPORT]]] = True
    bounds = np.cumsum([0, *map(len, patterns)])
    kept = [p for p in (p[strong[i:j]] for p, i, j in zip(patterns, bounds, bounds[1:])) if len(p)]
    x, distance = solve(*spelled(kept), x[strong])
    return kept, x * scale, distance


def round_repeats(patterns: list[np.ndarray], repeats: np.ndarray, left: np.ndarray) -> dict[tuple[int, ...], int]:
    """Whole repeats: rounded down, then one more for the largest remainders first, as far as ``left`` goes; it is used up."""
    rows = [tuple(r) for p in patterns for r in p.tolist()]
    whole = np.floor(repeats)
    used: dict[tuple[int, ...], int] = defaultdict(int)
    # remainders of nothing are tried last, by the same order
    for order, most in ((np.flatnonzero(whole), whole), (np.argsort(whole - repeats, kind="stable"), np.ones(len(rows)))):
        for i in order.tolist():
            need = Counter(rows[i])
            times = min(int(most[i]), *(int(left[n]) // k for n, k in need.items()))
            if times:
                for n, k in need.items():
                    left[n] -= k * times
                used[rows[i]] += times
    return used


def _halves_joined(halves: dict[tuple[int, ...], int], left: np.ndarray) -> dict[tuple[int, ...], int]:
    """Whole containers of two halves each; the items of an odd one go back to ``left``."""
    out: dict[tuple[int, ...], int] = defaultdict(int)
    waiting: tuple[int, ...] | None = None
    for half in sorted(halves):
        times = halves[half]
        if waiting is not None:
            out[tuple(sorted(waiting + half))] += 1
            times, waiting = times - 1, None
        if times // 2:
            out[tuple(sorted(half + half))] += times // 2
        if times % 2:
            waiting = half
    for n in waiting or ():
        left[n] += 1
    return out


def best_fit(histogram: np.ndarray) -> list[tuple[tuple[int, ...], int]]:
    """Packs a histogram longest first into the fullest containers that have room, in groups of equal containers."""
    capacity = len(histogram) - 1
    left = histogram.copy()
    open_: dict[int, list[tuple[tuple[int, ...], int]]] = defaultdict(list)
    room = np.zeros(capacity + 1, bool)
    for length in (np.flatnonzero(left[1:] > 0) + 1)[::-1].tolist():
        count = int(left[length])
        while count:
            free = int(np.argmax(room[length:])) + length if room[length:].any() else -1
            if free < 0:
                each = capacity // length
                whole, rest = divmod(count, each)
                for items, groups in ((each, whole), (rest, 1)):
                    if items and groups:
                        open_[capacity - items * length].append(((length,) * items, groups))
                        room[capacity - items * length] = True
                break
            pattern, groups = open_[free].pop()
            each = min(free // length, max(1, count // groups))
            used = min(groups, count // each)
            if used < groups:
                open_[free].append((pattern, groups - used))
            elif not open_[free]:
                room[free] = False
            open_[free - each * length].append((pattern + (length,) * each, used))
            room[free - each * length] = True
            count -= used * each
    return [x for groups in open_.values() for x in groups]


def plan(histogram: np.ndarray) -> Plan:
    """The packing of a histogram (index: length from 0 to the capacity; lengths of 0 take no part)."""
    capacity = len(histogram) - 1
    left = histogram.astype(np.int64).copy()
    left[0] = 0
    total: dict[tuple[int, ...], int] = defaultdict(int)
    halves: dict[tuple[int, ...], int] = defaultdict(int)
    distances = []
    lengths = np.arange(capacity + 1)
    while left.any():
        patterns = enumerate_patterns(left)
        if not patterns:
            break
        needed = (left * lengths).sum() / capacity
        patterns, repeats, distance = fit_repeats(patterns, left.astype(float))
        distances.append(distance)
        filled = 0.0
        for pattern, times in round_repeats(patterns, repeats, left).items():
            is_half = 2 * sum(pattern) == capacity
            (halves if is_half else total)[pattern] += times
            filled += times / (1 + is_half)
        if filled < LEAST_TURN * needed:
            break
    for pattern, times in _halves_joined(halves, left).items():
        total[pattern] += times
    by_patterns = sum(total.values())
    for pattern, times in best_fit(left):
        total[tuple(sorted(pattern))] += times
    ordered = sorted(total)
    return Plan(capacity, ordered, [total[p] for p in ordered], by_patterns, tuple(distances))


class Slots:
    """Finds container, place and start of an item from its length and its rank within that length."""

    def __init__(self, planned: Plan):
        rows: dict[int, list[tuple[int, int, int, int, int]]] = defaultdict(list)
        taken: dict[int, int] = defaultdict(int)
        for pattern, times, first in zip(planned.patterns, planned.repeats, planned.first()):
            place = start = 0
            for length in sorted(set(pattern)):
                each = pattern.count(length)
                rows[length].append((taken[length], first, each, place, start))
                taken[length] += times * each
                place, start = place + each, start + each * length
        self.lengths = np.array(sorted(rows), dtype=np.int64)
        self.table = {n: np.array(r, dtype=np.int64).T for n, r in rows.items()}
        self.firsts = np.array(planned.first(), dtype=np.int64)
        self.depth = np.array([len(p) for p in planned.patterns], dtype=np.int64)
        self.used = np.array([sum(p) for p in planned.patterns], dtype=np.int64)
        self.containers = planned.containers

    def find(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        container, place, start = (np.zeros(len(length), np.int64) for _ in range(3))
        for n in np.unique(length).tolist():
            rows = np.flatnonzero(length == n)
            r = rank[rows]
            if n == 0:
                many = max(1, self.containers)
                container[rows] = r % many
                if self.containers:
                    group = np.searchsorted(self.firsts, container[rows], "right") - 1
                    place[rows], start[rows] = self.depth[group] + r // many, self.used[group]
                else:
                    place[rows] = r
                continue
            low, first, each, place0, start0 = self.table[n]
            at = np.searchsorted(low, r, "right") - 1
            offset = r - low[at]
            within = offset % each[at]
            container[rows] = first[at] + offset // each[at]
            place[rows] = place0[at] + within
            start[rows] = start0[at] + within * n
        return container, place, start


def pieces(sizes: DataFrame, capacity: int) -> DataFrame:
    """``id, size`` to ``id, piece_no, n``: sizes above the capacity are split into full pieces and a rest; null counts as 0."""
    size = F.greatest(F.coalesce("size", F.lit(0)), F.lit(0))
    last = F.greatest(F.ceil(size / F.lit(capacity)) - 1, F.lit(0)).cast("int")
    cut = sizes.select("id", size.alias("size"), F.explode(F.sequence(F.lit(0), last)).alias("piece_no"))
    n = F.least(F.col("size") - F.col("piece_no").cast("long") * capacity, F.lit(capacity).cast("long"))
    return cut.select("id", "piece_no", n.cast("int").alias("n"))


def pack(sizes: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Packs ``id, size`` rows into containers.

    Result: ``id, piece_no, n, container_id, place, start`` — one row per item, or
    per piece of an item above ``capacity``. Every container holds at most
    ``capacity``; places count from 0 and starts are offsets within a container.
    Items of size 0 (also null sizes) are dealt over all containers, behind their
    other items. Repeated and null ids are items like any other.
    """
    items = settle(pieces(sizes, capacity))
    part = F.pmod(F.xxhash64("id", "piece_no"), F.lit(1 << 40))
    counted = items.groupBy("n").count().collect()  # at most capacity + 1 rows
    histogram = np.zeros(capacity + 1, dtype=np.int64)
    for row in counted:
        histogram[row["n"]] = row["count"]
    slots = items.sparkSession.sparkContext.broadcast(Slots(plan(histogram)))  # size set by the capacity
    # Lengths with many items are ranked in parts; a length has as many parts as its count asks for.
    parts = F.element_at(F.array(*[F.lit(int(1 + c // RANK_ROWS)) for c in histogram]), F.col("n") + 1) if histogram.max() >= RANK_ROWS else F.lit(1)
    salted = items.withColumn("part", (part % parts).cast("int"))
    within = salted.withColumn("rank", F.row_number().over(Window.partitionBy("n", "part").orderBy("id", "piece_no")) - 1)
    if histogram.max() >= RANK_ROWS:
        counts = salted.groupBy("n", "part").count()  # about one row for RANK_ROWS items
        before = counts.withColumn("before", F.coalesce(F.sum("count").over(Window.partitionBy("n").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
        within = within.join(before.select("n", "part", "before"), ["n", "part"])
    else:
        within = within.withColumn("before", F.lit(0).cast("long"))
    ranked = within.select("id", "piece_no", "n", (F.col("rank") + F.col("before")).cast("long").alias("rank"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = slots.value.find(batch.column(2).to_numpy().astype(np.int64), batch.column(3).to_numpy())
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], *map(pa.array, found)], ["id", "piece_no", "n", "container_id", "place", "start"])

    kind = sizes.schema["id"].dataType.simpleString()
    return ranked.mapInArrow(run, f"id {kind}, piece_no int, n int, container_id bigint, place bigint, start bigint")


def pack_texts(df: DataFrame, capacity: int = CAPACITY, id_col: str = "doc_id", text_col: str = "text", rank_path: str = DEFAULT_RANKS) -> DataFrame:
    """Containers for the texts of ``df``, measured in tokens: ``doc_id, piece_no, n_tokens, container_id, place, start``."""
    sizes = count_tokens(df, id_col, text_col, rank_path).select(F.col(id_col).alias("id"), F.col("n_tokens").alias("size"))
    return pack(sizes, capacity).withColumnsRenamed({"id": id_col, "n": "n_tokens"})
