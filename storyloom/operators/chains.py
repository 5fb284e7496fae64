"""Cheapest chains of segments over sequences of any length, in blocks.

A chain covers the units 1 to n of a group with segments, each of at most ``longest`` units; a segment's cost is known at its
last unit. Where a chain stands is told by the ends of the last ``longest`` units, so a block of units is a
(min, +) matrix from the places before the block to those at its end. Matrices are multiplied up a tree, which gives
each block what chains cost when they come to it; each block then chooses its segments by itself, and a second tree hands
the place where the chosen chain lands from the last block to the first. No task holds more than a block or the
matrices of one node of the tree. It is SQL on arrays in the JVM, but for the matrices of long segments. Costs are longs, so sums do not depend on how they are put together;
null stands for what is not allowed.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storyloom.scratch import spread, stored

#: Units of a block, and children of a node of the tree.
BLOCK, FAN = 1024, 32


def _entered(longest: int) -> Column:
    """The state before the first unit: a chain of cost 0 that has just ended."""
    return F.concat(F.array(F.lit(0).cast("long")), F.array_repeat(F.lit(None).cast("long"), longest - 1))


def _moved(state: Column, value: Column, longest: int) -> Column:
    return F.concat(F.array(value), F.slice(state, 1, longest - 1))


def _through(state: Column, matrix: Column, longest: int) -> Column:
    """The state at the end of a block from that before it."""
    return F.transform(F.sequence(F.lit(1), F.lit(longest)), lambda j: F.array_min(F.zip_with(state, matrix, lambda x, row: x + F.element_at(row, j))))


def _let(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then`` of a value that is worked out once, however often it is used."""
    return F.transform(F.array(value), then)[0]


def _scan(tree: list[DataFrame], top: DataFrame, apply: Callable[[Column, Column], Column], kind: str, backwards: bool) -> DataFrame:
    """group, block, state: the state with which each element of the lowest level is met, from that of each group.

    ``tree`` has the elements of each level (group, block, e), the highest last; children of a node are met in order, or from the last to the first.
    """
    states = top
    for level in tree[::-1]:
        children = level.groupBy("group", F.expr(f"block div {FAN}").alias("node")).agg(F.array_sort(F.collect_list(F.struct("block", "e"))).alias("c"))  # FAN at most
        rows = children.join(states.withColumnRenamed("block", "node"), ["group", "node"])
        order = F.reverse("c") if backwards else F.col("c")
        none = F.array().cast(f"array<struct<block: bigint, state: {kind}>>")
        met = F.aggregate(order, F.struct(F.col("state").alias("now"), none.alias("met")), lambda acc, c: F.struct(apply(acc["now"], c["e"]).alias("now"), F.concat(acc["met"], F.array(F.struct(c["block"].alias("block"), acc["now"].alias("state")))).alias("met")))
        states = rows.select("group", F.inline(met["met"])).select("group", "block", "state")
    return spread(states, "group", "block")  # states are few bytes, too, and meet their blocks next


def _uniform(blocks: DataFrame, shortest: int, longest: int) -> DataFrame:
    """group, block, e: the matrices of blocks whose units have one cost for segments of any allowed length.

    A matrix follows up to ``longest`` places through every unit, which with long segments is much for array functions; here a unit is
    one minimum over an array of places.
    """
    far = np.int64(1) << np.int64(61)

    def follow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(2)
            flat, sizes = lists.flatten().to_numpy(zero_copy_only=False), lists.value_lengths().to_numpy()
            stops = np.cumsum(sizes)
            out = []
            for size, stop in zip(sizes.tolist(), stops.tolist(), strict=True):
                best = np.full((longest + size, longest), far)  # unit x place before the block, the units before it first
                best[np.arange(longest), longest - 1 - np.arange(longest)] = 0
                for i, cost in enumerate(flat[stop - size : stop].tolist(), longest):
                    np.minimum.reduce(best[i - longest : i - shortest + 1], 0, out=best[i])
                    best[i] += cost
                out.append(best[-longest:][::-1].T)
            matrix = np.concatenate(out)
            inner = pa.array(matrix.ravel(), mask=matrix.ravel() > far // 2)
            rows = pa.ListArray.from_arrays(pa.array(np.arange(len(matrix) + 1, dtype=np.int32) * longest), inner)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.ListArray.from_arrays(pa.array(np.arange(len(out) + 1, dtype=np.int32) * longest), rows)], names=["group", "block", "e"])

    rows = blocks.select("group", "block", F.transform("u", lambda u: u["cost"]).alias("costs"))
    kinds = dict(rows.dtypes)
    return rows.mapInArrow(follow, f"group {kinds['group']}, block {kinds['block']}, e array<array<long>>")


def _tree(elements: DataFrame, blocks: int, compose: Callable[[Column, Column], Column]) -> list[DataFrame]:
    """Levels of composed elements, until a group has at most FAN of them."""
    levels = [elements]
    while blocks > FAN:
        nodes = spread(levels[-1].select("group", F.expr(f"block div {FAN}").alias("node"), "block", "e"), "group", "node")
        children = nodes.groupBy("group", "node").agg(F.array_sort(F.collect_list(F.struct("block", "e"))).alias("c"))
        first = F.element_at("c", 1)["e"]
        levels.append(stored(children.select("group", F.col("node").alias("block"), F.aggregate(F.slice("c", 2, FAN), first, lambda acc, c: compose(acc, c["e"])).alias("e")), "level"))
        blocks = -(-blocks // FAN)
    return levels


def best_chains(units: DataFrame, longest: int, value: Callable[[Column, Column], Column], group: str = "grp", long_first: bool = False, block: int = BLOCK, shortest: int | None = None) -> tuple[DataFrame, DataFrame]:
    """((group, nth, start, stop) of the segments of each group's cheapest chain, (group) of the groups that no chain covers).

    units: group, pos (gapless from 1) and ``cost``, of any type. ``value(state, cost)`` gives an array of ``longest`` longs: what
    chains cost whose last segment has 1, 2, ... units and ends here, from ``state``, what they cost where that segment begins. Of equally
    cheap segments the shorter is taken, or the longer with ``long_first``. ``shortest`` says that any segment from so many units on
    may end at a unit, at the unit's one cost: then the matrices are made by :func:`_uniform`. Null groups are left out; an empty table gives no rows.
    """
    assert block >= longest
    at = F.col("pos").cast("long") - 1
    # Written once, dealt over tasks: blocks are few bytes, but are read for their matrices and for their choice, which take long.
    dealt = spread(units.where(F.col(group).isNotNull()).select(F.col(group).alias("group"), F.expr(f"(cast(pos as long) - 1) div {block}").alias("block"), at.alias("at"), "cost"), "group", "block")
    blocks = stored(dealt.groupBy("group", "block").agg(F.array_sort(F.collect_list(F.struct("at", "cost"))).alias("u")), "blocks")
    most = (blocks.agg(F.max("block")).first()[0] or 0) + 1
    start = _entered(longest)
    root = blocks.select("group").distinct().withColumn("block", F.lit(0).cast("long"))
    cheapest = lambda state, cost: F.array_min(value(state, cost))
    if most > 1:
        every = F.transform(F.sequence(F.lit(1), F.lit(longest)), lambda k: F.transform(F.sequence(F.lit(1), F.lit(longest)), lambda j: F.when(j == k, F.lit(0).cast("long"))))
        matrix = F.aggregate("u", every, lambda m, u: F.transform(m, lambda s: _moved(s, cheapest(s, u["cost"]), longest)))
        made = blocks.select("group", "block", matrix.alias("e")) if shortest is None else _uniform(blocks, shortest, longest)
        matrices = stored(made, "matrices")
        tree = _tree(matrices, most, lambda a, b: F.transform(a, lambda s: _through(s, b, longest)))
        entries = _scan(tree, root.withColumn("state", start), lambda s, m: _through(s, m, longest), "array<bigint>", False)
        entered = blocks.join(entries, ["group", "block"])
    else:
        entered = blocks.withColumn("state", start)

    def choose(acc: Column, u: Column) -> Column:
        def of(values: Column) -> Column:
            place = lambda m: longest + 1 - F.array_position(F.reverse(values), m) if long_first else F.array_position(values, m)
            return _let(F.array_min(values), lambda m: F.struct(_moved(acc["s"], m, longest).alias("s"), F.concat(acc["back"], F.array(place(m).cast("int"))).alias("back")))

        return _let(value(acc["s"], u["cost"]), of)

    none = F.array().cast("array<int>")
    run = F.aggregate("u", F.struct(F.col("state").alias("s"), none.alias("back")), choose)
    chosen = stored(entered.select("group", "block", run.alias("run")), "chosen").select("group", "block", F.col("run.back").alias("back"), F.col("run.s")[0].alias("total"))  # back: units of the segment that ends at each unit
    covered = chosen if most == 1 else chosen.join(chosen.groupBy("group").agg(F.max("block").alias("last")), "group").where("block = last")
    good, bad = covered.where("total IS NOT NULL").select("group"), covered.where("total IS NULL").select(F.col("group").alias(group))
    size = F.size("back")
    # Places are counted back from a block's end: 0 is its last unit, ``size`` the last unit of the block before.
    if most > 1:
        ends = F.sequence(F.lit(0), F.lit(longest - 1))
        step = lambda acc, i: F.transform(acc, lambda p: F.when(p == i, p + F.element_at("back", size - i)).otherwise(p))
        # A block's function: where chains that land at each of its last places land in the block before.
        landed = F.transform(F.aggregate(F.sequence(F.lit(0), size - 1), ends, step), lambda p: p - size)
        functions = stored(chosen.join(good, "group", "left_semi").select("group", "block", landed.alias("e")), "functions")
        chain = lambda f, place: F.element_at(f, place + 1)
        tree = _tree(functions, most, lambda first, later: F.transform(later, lambda p: F.when(p >= 0, chain(first, p))))
        landings = _scan(tree, root.join(good, "group", "left_semi").withColumn("state", F.lit(0)), lambda p, f: chain(f, p), "int", True)
        walked = chosen.join(landings, ["group", "block"])
    else:
        walked = chosen.where("total IS NOT NULL").withColumn("state", F.lit(0))
    walk = F.aggregate(F.sequence(F.lit(0), size - 1), F.struct(F.col("state").alias("p"), none.alias("ends")), lambda acc, i: F.when(acc["p"] == i, F.struct((acc["p"] + F.element_at("back", size - i)).alias("p"), F.concat(F.array(i), acc["ends"]).alias("ends"))).otherwise(acc))
    ends = walked.select("group", "block", "back", size.alias("size"), walk["ends"].alias("ends"))
    if most > 1:
        ends = stored(ends, "ends")
        counts = stored(ends.select("group", "block", F.size("ends").cast("long").alias("e")), "counts")
        tree = _tree(counts, most, lambda a, b: a + b)
        before = _scan(tree, root.join(good, "group", "left_semi").withColumn("state", F.lit(0).cast("long")), lambda n, e: n + e, "bigint", False)
        ends = ends.join(before.withColumnRenamed("state", "before"), ["group", "block"])
    else:
        ends = ends.withColumn("before", F.lit(0).cast("long"))
    rows = ends.select("group", "block", "back", "size", "before", F.posexplode("ends").alias("i", "p"))
    stop = (F.col("block") * block + F.col("size") - F.col("p")).cast("long")
    rows = rows.select(F.col("group").alias(group), (F.col("before") + F.col("i") + 1).alias("nth"), (stop - F.element_at("back", F.col("size") - F.col("p")) + 1).alias("start"), stop.alias("stop"))
    return rows, bad
