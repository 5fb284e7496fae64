"""K-d tree sharding by bytes (operator 4), in DataFrame functions only.

The tree's root stands for all shards. A node of several shards is cut in two along its widest metadata
dimension at the weighted median (or other weighted quantile, where its shards are odd in number), until every
leaf is one shard and so has its share of the bytes. All nodes of a level are cut together: cuts come from
histograms of at most 65,536 buckets a node, refined in the boundary bucket, so only a few numbers
reach the driver and no sort of the table is needed.

Equal texts stay together. Groups of them that are large for a shard, of which there can be few, are given
to the shards with most room before, and the tree shares out the rest by the room that is left. Only a
group that exceeds a whole shard is divided.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from storyloom.scratch import stored

#: Bits of a row's place along a dimension: its coordinate, then a hash of its text, which orders equal coordinates.
COORDINATE, TIE = 16, 28
#: A group that exceeds a shard is divided by a hash of its rows' ids and metadata below this.
SPREAD = 1 << 30
STEPS = ((28, 16), (14, 14), (0, 14))  # (shift, bits) of the histograms


@dataclass
class Node:
    shards: int
    first: int
    dimension: str | None = None
    cut: int = -1  # rows up to this place go left
    left: Node | None = None
    right: Node | None = None


def _walk(node: Node, pick) -> Column:
    """An expression that takes a row down the tree to ``pick`` of the node where it ends."""
    if node.left is None:
        return F.lit(pick(node))
    return F.when(F.col(node.dimension) <= node.cut, _walk(node.left, pick)).otherwise(_walk(node.right, pick))


def _case(column: str, values: dict[int, object]) -> Column:
    """``values`` by node number; at most as many as there are shards."""
    return F.element_at(F.create_map(*[F.lit(x) for kv in values.items() for x in kv]), F.col(column))


def _dimensions(docs: DataFrame) -> DataFrame:
    """doc_id, size, text_crc32, spread and a place along each dimension; equal texts have equal places."""
    text = F.coalesce("text", F.lit(""))
    columns = set(docs.columns)
    meta = {c: F.col(c).cast("string") if c in columns else F.lit(None).cast("string") for c in ("source", "lang")}
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), (F.octet_length(text) + 8).cast("long").alias("size"), F.crc32(text).alias("text_crc32"), F.xxhash64(text).alias("text_key"), *[F.coalesce(x, F.lit("")).alias(c) for c, x in meta.items()])
    rows = stored(rows, "rows")
    # Equal texts take the least metadata among them.
    group = ["text_key", "text_crc32", "size"]
    least = stored(rows.groupBy(*group).agg(F.min("source").alias("g_source"), F.min("lang").alias("g_lang"), F.coalesce(F.min("doc_id"), F.lit(0)).alias("g_doc")), "groups")  # written, so that the join can split the rows of a hot group
    bounds = rows.agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi")).first()
    lo, hi = bounds["lo"] or 0, bounds["hi"] or 0
    top = (1 << COORDINATE) - 1
    coordinate = {
        "by_size": F.least(F.lit(top), (F.log2("size") * (top / 40)).cast("long")),
        "by_source": F.shiftrightunsigned(F.xxhash64("g_source"), 64 - COORDINATE),
        "by_lang": F.shiftrightunsigned(F.xxhash64("g_lang"), 64 - COORDINATE),
        "by_doc": ((F.col("g_doc") - lo) / max(1, hi - lo) * top).cast("long"),
    }
    tie = F.shiftrightunsigned("text_key", 64 - TIE)
    out = rows.join(least, group).select("doc_id", "size", "text_crc32", "text_key", F.pmod(F.xxhash64("doc_id", "source", "lang"), F.lit(SPREAD)).alias("spread"), *[(F.shiftleft(x.cast("long"), TIE) + tie).alias(name) for name, x in coordinate.items()])
    return stored(out, "dimensions")


DIMENSIONS = ["by_size", "by_source", "by_lang", "by_doc"]


def _boundaries(rows: DataFrame, bucket: Column, need: dict[int, int]) -> dict[int, tuple[int, int, int]]:
    """(bucket that holds the quantile, bytes before it, bytes in it) of each node."""
    sums = rows.groupBy("node", bucket.cast("long").alias("bucket")).agg(F.sum("size").alias("w"))
    running = sums.withColumn("upto", F.sum("w").over(Window.partitionBy("node").orderBy("bucket")))
    want = _case("node", need)
    found = running.where((F.col("upto") >= want) & (F.col("upto") - F.col("w") < want)).select("node", "bucket", "upto", "w").collect()  # one row a node
    return {r["node"]: (r["bucket"], r["upto"] - r["w"], r["w"]) for r in found}


def place_groups(groups: list[tuple[int, int]], total: int, shards: int) -> tuple[list[tuple[int, int, int, int]], list[float]]:
    """((group, from, to, shard) of the groups' parts, by spread; room left in each shard).

    ``groups``: number and bytes. The largest goes first, as a whole into the shard with most room; what exceeds a shard
    fills one after the other.
    """
    target = total / shards
    room, parts = [target] * shards, []
    for group, size in sorted(groups, key=lambda g: (-g[1], g[0])):
        left, begin = float(size), 0
        while begin < SPREAD:
            shard = max(range(shards), key=lambda i: (room[i], -i))
            take = left if size <= target or room[shard] <= 0 else min(left, room[shard])
            stop = SPREAD if take >= left else min(SPREAD, begin + max(1, round(take / size * SPREAD)))
            parts.append((group, begin, stop, shard))
            room[shard], left, begin = room[shard] - take, left - take, stop
    return parts, [max(0.0, r) for r in room]


def grow(rows: DataFrame, room: list[float]) -> Node:
    """The tree over ``rows``, whose leaves get bytes in proportion to the ``room`` of their shards."""
    root = Node(len(room), 0)
    widths: dict[str, int] = {}
    while True:
        open_nodes: list[Node] = []

        def number(node: Node) -> int:
            if node.shards == 1:
                return -1
            open_nodes.append(node)
            return len(open_nodes) - 1

        node_of = _walk(root, number)
        if not open_nodes:
            return root
        here = rows.withColumn("node", node_of).where("node >= 0")
        facts = {r["node"]: r for r in here.groupBy("node").agg(F.sum("size").alias("w"), *[(F.max(d) - F.min(d)).alias(d) for d in DIMENSIONS]).collect()}
        if not widths:
            widths = {d: max(1, facts[0][d]) if 0 in facts else 1 for d in DIMENSIONS}
        need: dict[int, int] = {}
        for i, node in enumerate(open_nodes):
            half = node.shards // 2
            node.left, node.right = Node(half, node.first), Node(node.shards - half, node.first + half)
            node.dimension = DIMENSIONS[0]
            if i in facts:
                node.dimension = max(DIMENSIONS, key=lambda d: facts[i][d] / widths[d])  # noqa: B023
                whole = sum(room[node.first : node.first + node.shards])
                share = sum(room[node.first : node.first + half]) / whole if whole else half / node.shards
                need[i] = round(facts[i]["w"] * share)
        need = {i: x for i, x in need.items() if x > 0}  # where nothing goes left, the cut stays before all places
        if not need:
            continue
        place = F.coalesce(*[F.when(F.col("node").isin([i for i in need if open_nodes[i].dimension == d]), F.col(d)) for d in DIMENSIONS])
        here = here.where(F.col("node").isin(list(need))).select("node", "size", place.alias("place"))
        prefix, inside = dict.fromkeys(need, 0), dict.fromkeys(need, 0)
        for shift, bits in STEPS:
            part = here if shift == STEPS[0][0] else here.where(F.shiftright("place", shift + bits) == _case("node", prefix))
            found = _boundaries(part, F.shiftright("place", shift).bitwiseAND(F.lit((1 << bits) - 1)), need)
            for i, (bucket, before, w) in found.items():
                prefix[i] = prefix[i] << bits | bucket
                need[i], inside[i] = need[i] - before, w
        for i in need:
            open_nodes[i].cut = prefix[i] if 2 * need[i] >= inside[i] else prefix[i] - 1  # the group at the boundary, whole


def shard(docs: DataFrame, shards: int = 24, large_share: float = 0.04) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard: shards of near equal bytes.

    size is the text's UTF-8 bytes (null: none) plus 8. Equal texts share a shard, unless their group has
    more bytes than a shard: that is divided by a hash of its rows' ids and metadata. Groups of more than
    ``large_share`` of a shard, fewer than ``shards / large_share``, are placed before the tree grows. Null
    metadata counts as empty; absent or further columns do not matter; repeated rows get slots of
    their own; an empty table gives no rows.
    """
    rows = _dimensions(docs)
    total = rows.agg(F.sum("size")).first()[0] or 0
    group = ["text_key", "text_crc32", "size"]
    large = rows.groupBy(*group).agg((F.col("size") * F.count("*")).alias("bytes")).where(F.col("bytes") > large_share * total / shards).orderBy(*group).collect()
    parts, room = place_groups([(i, r["bytes"]) for i, r in enumerate(large)], total, shards)
    given = [F.struct(*[F.lit(large[g][c]).alias(c) for c in group], F.lit(a).alias("lo"), F.lit(b).alias("hi"), F.lit(s).alias("given")) for g, a, b, s in parts]
    none = F.struct(F.lit(0).cast("long").alias("text_key"), F.lit(-1).cast("long").alias("text_crc32"), F.lit(-1).cast("long").alias("size"), F.lit(0).alias("lo"), F.lit(0).alias("hi"), F.lit(0).alias("given"))
    table = docs.sparkSession.range(1).select(F.inline(F.array(none, *[x.cast("struct<text_key: bigint, text_crc32: bigint, size: bigint, lo: int, hi: int, given: int>") for x in given]))).withColumnsRenamed({c: f"_{c}" for c in group})
    same = (F.col("text_key") == F.col("_text_key")) & (F.col("text_crc32") == F.col("_text_crc32")) & (F.col("size") == F.col("_size"))
    rows = stored(rows.join(F.broadcast(table), same & (F.col("spread") >= F.col("lo")) & (F.col("spread") < F.col("hi")), "left").select("doc_id", "size", "text_crc32", "given", *DIMENSIONS), "given")
    tree = grow(rows.where("given IS NULL"), room)
    chunks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = rows.select("doc_id", "size", "text_crc32", F.coalesce("given", _walk(tree, lambda n: n.first)).cast("int").alias("shard"), F.pmod(F.xxhash64("doc_id"), F.lit(chunks)).alias("chunk"))
    # Slots: rank in (shard, chunk), after the rows of the shard's chunks before.
    counts = placed.groupBy("shard", "chunk").agg(F.count("*").alias("n"))
    before = counts.select("shard", "chunk", (F.sum("n").over(Window.partitionBy("shard").orderBy("chunk")) - F.col("n")).alias("before"))
    ranked = placed.withColumn("nth", F.row_number().over(Window.partitionBy("shard", "chunk").orderBy("doc_id", "text_crc32")) - 1)
    return ranked.join(before, ["shard", "chunk"]).select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", (F.col("before") + F.col("nth")).alias("slot"), F.lit(None).cast("int").alias("grown_shard"))


def op4_kd_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contract's query: all documents in 24 shards, under the law ``bytes``."""
    return shard(spark.read.parquet(f"{sf_dir}/documents.parquet"), shards=24)
