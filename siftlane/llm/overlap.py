"""Shared identifiers of every pair of sets, kept up to date by changes (problem 5).

State is one row per item with the sets it is in, and the count of every pair of
sets. When items join or leave sets, the changes of an item meet its other
memberships in one join on the item, and every pair of sets concerned gets a signed
delta. Items with the same moves between the same memberships are counted first, so
pairs are spelled out once per distinct pattern, not per item, and no intersection
is ever materialised.

The row of an item holds as many sets as it is in. Pairs of an item in very many sets
are spelled out block by block: a row pairs two blocks of at most ``BLOCK`` sets, and
the rows of such items are dealt over all tasks. The sizes of sets are kept as the
pair of a set with itself.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..runtime import settle

#: Sets of an item that one row pairs with as many others.
BLOCK = 64
#: Batches in which the steps of a history are applied.
BATCHES = 3


def _sets(condition: Column) -> Column:
    return F.array_sort(F.collect_set(F.when(condition, F.col("set"))))


def empty_members(like: DataFrame) -> DataFrame:
    """The empty state for rows of ``item, set``."""
    kinds = {f.name: f.dataType.simpleString() for f in like.schema.fields}
    return like.sparkSession.createDataFrame([], f"item {kinds['item']}, sets array<{kinds['set']}>")


def moves(members: DataFrame, changes: DataFrame) -> DataFrame:
    """``item, kept, joined, gone`` of all items, from ``members`` (``item, sets``) and ``changes`` (``item, set, joins``).

    Changes come in any number and order; per item and set a join wins over a leave. A
    join of a member and a leave of a non-member move nothing. Rows with a null don't count.
    """
    asked = changes.filter("item IS NOT NULL AND set IS NOT NULL AND joins IS NOT NULL").groupBy("item").agg(_sets(F.col("joins")).alias("to"), _sets(~F.col("joins")).alias("off"))
    none = F.array().cast(members.schema["sets"].dataType)
    both = members.join(asked, "item", "full").select("item", *[F.coalesce(c, none).alias(c) for c in ("sets", "to", "off")])
    gone = F.array_except(F.array_intersect("sets", "off"), F.col("to"))
    return both.select("item", F.array_except(F.col("sets"), gone).alias("kept"), F.array_except("to", "sets").alias("joined"), gone.alias("gone"))


def moves_to(members: DataFrame, now: DataFrame) -> DataFrame:
    """As :func:`moves`, where ``now`` (``item, set``) states all memberships: what it lacks has left."""
    stated = now.filter("item IS NOT NULL AND set IS NOT NULL").groupBy("item").agg(_sets(F.lit(True)).alias("to"))
    none = F.array().cast(members.schema["sets"].dataType)
    both = members.join(stated, "item", "full").select("item", *[F.coalesce(c, none).alias(c) for c in ("sets", "to")])
    return both.select("item", F.array_intersect("sets", "to").alias("kept"), F.array_except("to", "sets").alias("joined"), F.array_except("sets", "to").alias("gone"))


def members_after(moved: DataFrame) -> DataFrame:
    """The state ``item, sets`` behind :func:`moves`; items in no set are left out."""
    return moved.select("item", F.array_sort(F.concat("kept", "joined")).alias("sets")).filter("size(sets) > 0")


def _blocks(column: str) -> str:
    return f"IF(size({column}) = 0, slice(array({column}), 1, 0), transform(sequence(0, (size({column}) - 1) div {BLOCK}), q -> slice({column}, q * {BLOCK} + 1, {BLOCK})))"


def deltas_of(moved: DataFrame) -> DataFrame:
    """Signed deltas ``a, b, delta`` (``a <= b``) that :func:`moves` make to the pair counts; none is 0."""
    patterns = moved.filter("size(joined) + size(gone) > 0").groupBy("kept", "joined", "gone").agg(F.count(F.lit(1)).alias("n"))
    both = F.array(F.struct(F.col("joined").alias("moved"), F.col("n").alias("d")), F.struct(F.col("gone").alias("moved"), (-F.col("n")).alias("d")))
    one_way = patterns.select("kept", F.inline(both)).filter("size(moved) > 0")
    firsts = lambda rows: rows.select("kept", "moved", "d", F.posexplode(F.expr(_blocks("moved"))).alias("i", "x"))
    heavy = F.greatest(F.size("moved"), F.size("kept")) > BLOCK
    # the blocks of heavy items are dealt over all tasks
    rows = firsts(one_way.filter(~heavy)).unionByName(firsts(one_way.filter(heavy)).repartition(F.xxhash64("x", "kept")))
    later = _blocks(f"slice(moved, i * {BLOCK} + 1, size(moved))")
    partners = f"concat(transform({later}, (y, j) -> struct(y AS y, j = 0 AS own)), transform({_blocks('kept')}, y -> struct(y AS y, false AS own)))"
    blocks = rows.select("d", "x", F.explode(F.expr(partners)).alias("p")).select("d", "x", "p.y", "p.own")
    pairs = "IF(own, flatten(transform(x, (a, i) -> transform(slice(x, i + 1, size(x)), b -> struct(a AS a, b AS b)))), flatten(transform(x, a -> transform(y, b -> struct(least(a, b) AS a, greatest(a, b) AS b)))))"
    return blocks.select("d", F.explode(F.expr(pairs)).alias("p")).groupBy(F.col("p.a").alias("a"), F.col("p.b").alias("b")).agg(F.sum("d").alias("delta")).filter("delta <> 0")


def add_deltas(counts: DataFrame | None, deltas: DataFrame) -> DataFrame:
    """Pair counts ``a, b, n`` with ``deltas`` applied; pairs that share nothing are left out."""
    new = deltas.select("a", "b", F.col("delta").alias("n"))
    return (new if counts is None else counts.select("a", "b", "n").unionByName(new)).groupBy("a", "b").agg(F.sum("n").alias("n")).filter("n > 0")


def apply_changes(members: DataFrame, counts: DataFrame | None, changes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The state ``(members, counts)`` after ``changes``. Usable as a ``foreachBatch`` step."""
    moved = settle(moves(members, changes))
    return members_after(moved), add_deltas(counts, deltas_of(moved))


def _stated(stated: DataFrame) -> DataFrame:
    return stated.filter("item IS NOT NULL AND set IS NOT NULL AND step IS NOT NULL").select("item", "set", "step").distinct()


def maintained(stated: DataFrame, leaves: bool, batches: int = BATCHES) -> DataFrame:
    """Pair counts ``a, b, n`` after all steps of ``stated`` (``item, set, step``; each step states memberships), kept up to date batch by batch.

    With ``leaves`` a membership that a step doesn't state has ended; else it stays, so the
    state is what was stated in any step. Steps are applied in order, in ``batches`` of
    about as many; what a batch changes on the whole meets the state that the last one
    left. So each batch touches the items that change, and writes the state once.
    """
    known = _stated(stated)
    steps = [r["step"] for r in known.select("step").distinct().orderBy("step").collect()]  # one row per run
    if not steps:
        kind = stated.schema["set"].dataType.simpleString()
        return stated.sparkSession.createDataFrame([], f"a {kind}, b {kind}, n bigint")
    members, counts = empty_members(known), None
    size = -(-len(steps) // batches)
    for low in range(0, len(steps), size):
        part = steps[low : low + size]
        if leaves:
            moved = moves_to(members, known.filter(F.col("step") == part[-1]))
        else:
            new = known.filter(F.col("step").between(part[0], part[-1])).select("item", "set").distinct()
            moved = moves(members, new.withColumn("joins", F.lit(True)))
        moved = settle(moved)
        members = members_after(moved)
        counts = settle(add_deltas(counts, deltas_of(moved)))
    assert counts is not None
    return counts


def deltas_by_step(stated: DataFrame) -> DataFrame:
    """``step, a, b, delta`` (``a <= b``): what each step of ``stated`` changes, with leaves, for all steps at once.

    A membership lasts from the step that first states it to the one that no longer does. Each
    meets the item's others: where both begin to last, the pair gains one, and where
    one of them ends, it loses one. The row of an item holds its memberships, at most one
    for each set and step; items in many sets are paired block by block.
    """
    known = _stated(stated)
    order = Window.orderBy("step")  # one row per run
    steps = settle(known.select("step").distinct().select("step", F.row_number().over(order).alias("k")))
    held = known.join(F.broadcast(steps), "step").groupBy("item", "set").agg(F.array_sort(F.collect_set("k")).alias("k"))
    begins = F.filter("k", lambda x: ~F.array_contains("k", x - 1))
    ends = F.transform(F.filter("k", lambda x: ~F.array_contains("k", x + 1)), lambda x: x + 1)
    lasting = held.select("item", "set", F.explode(F.arrays_zip(begins.alias("first"), ends.alias("until"))).alias("t")).select("item", F.struct("set", "t.first", "t.until").alias("m"))
    patterns = lasting.groupBy("item").agg(F.array_sort(F.collect_list("m")).alias("m")).groupBy("m").agg(F.count(F.lit(1)).alias("n"))
    firsts = lambda rows: rows.select("m", "n", F.posexplode(F.expr(_blocks("m"))).alias("i", "x"))
    rows = firsts(patterns.filter(f"size(m) <= {BLOCK}")).unionByName(firsts(patterns.filter(f"size(m) > {BLOCK}")).repartition(F.xxhash64("x")))
    later = _blocks(f"slice(m, i * {BLOCK} + 1, size(m))")
    blocks = rows.select("n", "x", F.posexplode(F.expr(later)).alias("j", "y"))
    pair = "struct(a.set AS a, b.set AS b, greatest(a.first, b.first) AS gains, least(a.until, b.until) AS loses)"
    pairs = f"IF(j = 0, flatten(transform(x, (a, i) -> transform(slice(x, i + 1, size(x)), b -> {pair}))), flatten(transform(x, a -> transform(y, b -> {pair}))))"
    # two stays of one set aren't a pair: they never overlap
    met = blocks.select("n", F.explode(F.expr(pairs)).alias("p")).filter("p.gains < p.loses")
    signed = met.select("p.a", "p.b", F.inline(F.array(F.struct(F.col("p.gains").alias("k"), F.col("n").alias("d")), F.struct(F.col("p.loses").alias("k"), (-F.col("n")).alias("d")))))
    # what ends behind the last step doesn't end
    summed = signed.groupBy("k", "a", "b").agg(F.sum("d").alias("delta")).filter("delta <> 0")
    return summed.join(F.broadcast(steps), "k").select("step", "a", "b", "delta")


def similar_pairs(counts: DataFrame, per_cent: int) -> DataFrame:
    """Pairs ``a < b`` of ``a, b, n`` whose shared items are at least ``per_cent`` of those in either: ``a, b, shared, size_a, size_b``."""
    size = counts.filter("a = b")
    pairs = counts.filter("a < b").select("a", "b", F.col("n").alias("shared"))
    sized = pairs.join(size.select("a", F.col("n").alias("size_a")), "a").join(size.select("b", F.col("n").alias("size_b")), "b")
    return sized.filter(F.col("shared") * 100 >= (F.col("size_a") + F.col("size_b") - F.col("shared")) * per_cent).select("a", "b", "shared", "size_a", "size_b")
