"""Connected components by alternating star contraction (Kiveris et al., 2014) and forests of least order (Borůvka, 1926) on edge tables."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storyloom.scratch import dropped, stored


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
    return row["n"], row["h"]


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least, "a")
    return moved.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select("a", F.col("m").alias("b"))).where("a <> b").distinct()


def _joined_up(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """node, component of the edges of one task."""
    parent: dict = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for rows in batches:
        for a, b in zip(rows["a"], rows["b"], strict=True):
            x, y = sorted((root(a), root(b)))
            parent[y] = x
    yield pd.DataFrame([(n, root(n)) for n in parent], columns=["node", "component"])


def connected_components(edges: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 60, few: int = 0) -> DataFrame:
    """(node, component) for each node of an edge, ``component`` being the smallest node reachable.

    Each round contracts stars by groupBy(min) and a join, so a hub with very many links is never
    gathered in one task. Self links and repeated links are ignored, nulls are dropped; a node that
    has only self links does not appear. The table of each round is written to the shared folder.
    Up to ``few`` edges are joined up in one task.
    """
    edges = stored(edges.select(F.col(a).alias("a"), F.col(b).alias("b")).where("a <> b").distinct(), "edges")
    before = _state(edges)
    if before[0] <= few:
        kind = dict(edges.dtypes)["a"]
        return edges.coalesce(1).mapInPandas(_joined_up, f"node {kind}, component {kind}")
    for _ in range(max_rounds):
        contracted = stored(_small_star(_large_star(edges)), "edges")
        dropped(edges)
        edges, after = contracted, _state(contracted)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError(f"no fixed point after {max_rounds} rounds")
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())


#: Edges of a contracted graph that one task may finish.
FEW = 50_000


def _pointers(edges: DataFrame) -> DataFrame:
    """node, to, ord: the least edge of each node."""
    both = edges.select(F.col("x").alias("node"), F.col("y").alias("to"), "ord").unionByName(edges.select(F.col("y").alias("node"), F.col("x").alias("to"), "ord"))
    return both.groupBy("node").agg(F.min(F.struct("ord", "to")).alias("least")).select("node", F.col("least.to").alias("to"), F.col("least.ord").alias("ord"))


def _jumped(pointers: DataFrame) -> DataFrame:
    """node, root: where the pointers lead. Orders differ, so two nodes that point at each other are the only cycles; the smaller is the root."""
    back = pointers.select(F.col("node").alias("to"), F.col("to").alias("_back"))
    roots = stored(pointers.join(back, "to", "left").select("node", F.when((F.col("_back") == F.col("node")) & (F.col("node") < F.col("to")), F.col("node")).otherwise(F.col("to")).alias("root")), "roots")
    while True:
        further = roots.join(roots.select(F.col("node").alias("root"), F.col("root").alias("_next")), "root").select("node", F.col("_next").alias("root"), (F.col("root") != F.col("_next")).alias("moved"))
        further = stored(further, "roots")
        dropped(roots)
        roots = further
        if roots.where("moved").isEmpty():
            return roots


def _kruskal(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The forest of least order of the edges of one task, which come in order."""
    parent: dict = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for rows in batches:
        keep = []
        for x, y in zip(rows["x"], rows["y"], strict=True):
            a, b = root(x), root(y)
            keep.append(a != b)
            parent[a] = b
        yield rows.loc[keep, ["ord"]]


def ordered_forest(edges: DataFrame, few: int = FEW) -> DataFrame:
    """``ord`` of the edges that a pass in order would keep: those that join two components of the edges before them.

    edges: x, y and ``ord``, any type that has an order, different for each edge. In each round every node picks its least edge,
    which such a pass always keeps, and the trees of picked edges become nodes; so the nodes are halved at least, and no task
    holds a component. Of parallel edges the least stays. What is left with ``few`` edges or less is finished in one task.
    """
    left = stored(edges.where("x <> y").groupBy(F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y")).agg(F.min("ord").alias("ord")), "edges")
    picked = []
    while left.count() > few:
        pointers = stored(_pointers(left), "pointers")
        picked.append(pointers.select("ord"))
        roots = _jumped(pointers)
        for side in "xy":
            left = left.join(roots.select(F.col("node").alias(side), F.col("root").alias("_root")), side).drop(side).withColumnRenamed("_root", side)
        left = stored(left.where("x <> y").groupBy(F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y")).agg(F.min("ord").alias("ord")), "edges")
    kind = left.schema["ord"].dataType.simpleString()
    rest = left.select("x", "y", F.to_json(F.struct("ord")).alias("_as_text"), "ord").coalesce(1).sortWithinPartitions("ord")
    rest = rest.select("x", "y", F.col("_as_text").alias("ord")).mapInPandas(_kruskal, "ord string").select(F.from_json("ord", f"struct<ord: {kind}>")["ord"].alias("ord"))
    for p in picked:
        rest = rest.unionByName(p)
    return rest.distinct()
