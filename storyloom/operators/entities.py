"""Aliases to entities: guarded components, resolvers, roll-ups, pairs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from storyloom.graph import FEW, connected_components, ordered_forest
from storyloom.scratch import stored

# Names and roots of names that are never merged.
GENERIC = "老人 女人 男人 那人 此人 众人 有人 少年 少女 中年 青年 老者 老头 老妇 孩子 童子 弟子 长老 掌门 宫主 城主 护卫 侍女 丫鬟 和尚 道人 书生 乞丐 掌柜 伙计 对方 双方 两人 三人 几人 大家 旁人 路人 某人 他 她 它 你 我".split()
GENERIC_ROOTS = "丫头 丫鬟 女孩 男孩 孩子 小子 少年 少女 老人 老者 老头 老妇 老农 汉子 男人 女人 男子 女子 青年 中年 书生 和尚 僧 道人 道姑 乞丐 护卫 侍女 弟子 修士 长老 村民 众人 大家 对方 旁人 路人 某人 那人 此人 来人 有人 群体 们".split()
PRINCIPAL, SUSPICIOUS = 5, 10
#: Rows of units and items whose pairs one task counts.
ROWS_A_TASK = 100_000


def generic(name: Column, exact: list[str] = GENERIC, roots: list[str] = GENERIC_ROOTS) -> Column:
    """Empty, listed, marked as a group, or ending with a root."""
    n = F.trim(F.coalesce(name, F.lit("")))
    out = (n == "") | n.isin(exact) | n.rlike("[（(]群体[）)]$")
    return out | n.rlike("(" + "|".join(roots) + ")$") if roots else out


def alias_edges(mentions: DataFrame, verified: DataFrame | None = None, is_generic=generic) -> DataFrame:
    """a (name), b (alias), verified, ord: one row an edge with its first place; generic on either side is left out.

    mentions: seq, pos, name, aliases. verified: a, b of curated identities (ambiguous names are not among them).
    """
    rows = mentions.select("seq", "pos", F.col("name").alias("a"), F.posexplode("aliases").alias("alias_pos", "b"))
    rows = rows.where(~is_generic(F.col("a")) & ~is_generic(F.col("b")) & (F.col("a") != F.col("b")))
    edges = rows.groupBy("a", "b").agg(F.min(F.struct("seq", "pos", "alias_pos")).alias("ord")).withColumn("verified", F.lit(False))
    if verified is not None:
        zero = F.struct(F.lit(0).cast("long").alias("seq"), F.lit(0).cast("long").alias("pos"), F.lit(0).alias("alias_pos"))
        edges = edges.withColumn("ord", F.struct(F.col("ord.seq").cast("long").alias("seq"), F.col("ord.pos").cast("long").alias("pos"), F.col("ord.alias_pos").alias("alias_pos"))).unionByName(verified.select("a", "b", zero.alias("ord"), F.lit(True).alias("verified")))
    return edges


def guarded_merge(edges: DataFrame, counts: DataFrame, principal: int = PRINCIPAL, merge: bool = True, few: int = FEW) -> tuple[DataFrame, DataFrame]:
    """((name, cluster) of each name of an edge, (a, b) of rejected edges). counts: name, n as a head name.

    Edges count in order, curated ones first and always; others unless both sides hold a principal by then. That is the forest
    of least order of a graph in which all principals are one node: an edge between two clusters with principals would close a
    ring through it. So no edge has to be replayed after another, however large a component is (see ``ordered_forest``).
    An edge was rejected if its sides end in different clusters. A component with at most one principal is a cluster as a whole.
    """
    names = edges.select(F.col("a").alias("name")).union(edges.select("b")).distinct()
    if not merge:
        return names.select("name", F.col("name").alias("cluster")), edges.select("a", "b").limit(0)
    components = connected_components(edges.select("a", "b"), few=few).withColumnRenamed("node", "name")
    chiefs = counts.where(F.col("n") >= principal).select("name")
    many = components.join(chiefs, "name").groupBy("component").agg(F.count("*").alias("p")).where("p > 1").select("component")
    simple = components.join(many, "component", "left_anti").select("name", F.col("component").alias("cluster"))
    hard = stored(components.join(many, "component"), "names")
    if hard.isEmpty():
        return simple, edges.select("a", "b").limit(0)
    rows = stored(edges.join(hard.withColumnRenamed("name", "a"), "a").select("a", "b", "verified", "ord.*"), "edges")
    # Nodes: curated clusters; those of one component that hold a principal are one node, its least name.
    curated = connected_components(rows.where("verified").select("a", "b"), few=few)
    nodes = hard.join(curated.select(F.col("node").alias("name"), F.col("component").alias("own")), "name", "left").withColumn("own", F.coalesce("own", "name"))
    held = nodes.join(chiefs, "name").select("component", "own").distinct()
    held = held.join(held.groupBy("component").agg(F.min("own").alias("chief")), "component").select("own", "chief")
    nodes = stored(nodes.join(held, "own", "left").select("name", F.coalesce("chief", "own").alias("node")), "nodes")
    least = rows.where("NOT verified").groupBy("a", "b").agg(F.min(F.struct("seq", "pos", "alias_pos", "a", "b")).alias("ord"))
    side = lambda c, to: nodes.select(F.col("name").alias(c), F.col("node").alias(to))
    kept = ordered_forest(least.join(side("a", "x"), "a").join(side("b", "y"), "b").select("x", "y", "ord"), few).select("ord.a", "ord.b")
    joined = connected_components(kept.unionByName(rows.where("verified").select("a", "b")), few=few)
    clusters = stored(hard.select("name").join(joined.select(F.col("node").alias("name"), F.col("component").alias("cluster")), "name", "left").withColumn("cluster", F.coalesce("cluster", "name")), "clusters")
    of = lambda c: clusters.select(F.col("name").alias(c), F.col("cluster").alias(f"_{c}"))
    rejected = rows.where("NOT verified").select("a", "b").distinct().join(of("a"), "a").join(of("b"), "b").where("_a <> _b").select("a", "b")
    return simple.unionByName(clusters), rejected


def canonical_names(clusters: DataFrame, counts: DataFrame, pinned: DataFrame | None = None) -> DataFrame:
    """name, canonical: of each cluster the curated name, else the most frequent, the longer, the earlier (counts: name, n, first_ord)."""
    rows = clusters.join(counts, "name", "left").fillna(0, ["n"])
    rows = rows.join(pinned.select("name", F.lit(1).alias("_pin")), "name", "left") if pinned is not None else rows.withColumn("_pin", F.lit(None).cast("int"))
    pin = F.coalesce("_pin", F.lit(0))
    length = F.when(pin == 1, 0).otherwise(F.length(F.col("name").cast("string")))
    w = Window.partitionBy("cluster").orderBy(F.desc(pin), F.desc("n"), F.desc(length), F.asc_nulls_last("first_ord"), "name")
    best = rows.withColumn("_k", F.row_number().over(w)).where("_k = 1").select("cluster", F.col("name").alias("canonical"))
    return clusters.join(best, "cluster").select("name", "canonical")


def suspicious(canonical: DataFrame, counts: DataFrame, pinned: DataFrame | None = None, least: int = SUSPICIOUS) -> DataFrame:
    """Clusters in which more than one name that is not curated is frequent."""
    rows = canonical.join(counts.where(F.col("n") >= least), "name")
    if pinned is not None:
        rows = rows.join(pinned, "name", "left_anti")
    return rows.groupBy("canonical").agg(F.count("*").alias("frequent"), F.sort_array(F.collect_set("name")).alias("names")).where("frequent > 1")


def claims(index: DataFrame) -> DataFrame:
    """alias, n and first_owner of an index (canonical, aliases): how many claim an alias, and the least of them."""
    rows = index.select("canonical", F.explode("aliases").alias("alias")).where("alias <> canonical").distinct()
    return rows.groupBy("alias").agg(F.count("*").alias("n"), F.min("canonical").alias("first_owner"))


def claimants(index: DataFrame, most: int = 1000) -> DataFrame:
    """alias, canonical, rank: each alias with its claimants, the first ``most`` by name, a row each."""
    rows = index.select(F.explode("aliases").alias("alias"), "canonical").where("alias <> canonical").distinct()
    return rows.withColumn("rank", F.row_number().over(Window.partitionBy("alias").orderBy("canonical"))).where(F.col("rank") <= most)


def resolve(names: DataFrame, index: DataFrame, curated: DataFrame | None = None, blocked: DataFrame | None = None) -> DataFrame:
    """name, owner, doubt. Levels: blocked; curated (name, owner); itself canonical; one claimant; several; unknown."""
    claimed = claims(index).select(F.col("alias").alias("name"), "n", "first_owner")
    rows = names.select("name").distinct().join(claimed, "name", "left").join(index.select(F.col("canonical").alias("name"), F.lit(True).alias("_own")).distinct(), "name", "left")
    rows = rows.join(curated.select("name", F.col("owner").alias("_curated")), "name", "left") if curated is not None else rows.withColumn("_curated", F.lit(None).cast(dict(names.dtypes)["name"]))
    rows = rows.join(blocked.select("name", F.lit(True).alias("_block")), "name", "left") if blocked is not None else rows.withColumn("_block", F.lit(None).cast("boolean"))
    block, own, n = F.coalesce("_block", F.lit(False)), F.coalesce("_own", F.lit(False)), F.coalesce("n", F.lit(0))
    owner = F.when(block, F.col("name")).when(F.col("_curated").isNotNull(), F.col("_curated")).when(own, F.col("name")).when(n == 1, F.col("first_owner")).otherwise(F.col("name"))
    doubt = F.when(block, True).when(F.col("_curated").isNotNull(), False).when(own, n > 0).when(n == 1, False).otherwise(n > 1)
    return rows.select("name", owner.alias("owner"), doubt.alias("doubt"))


def last_claimant(index: DataFrame, position: str) -> DataFrame:
    """alias, owner by the last entry that lists it: the older rule, which contested names defeat. Prefer resolve()."""
    rows = index.select("canonical", position, F.explode("aliases").alias("alias"))
    return rows.groupBy("alias").agg(F.max_by("canonical", F.struct(position, "canonical")).alias("owner"))


def mutual_aliases(index: DataFrame) -> DataFrame:
    """a < b that list each other; high when one contains the other."""
    edges = index.select(F.col("canonical").alias("x"), F.explode("aliases").alias("y")).where("x <> y")
    # A pair is one group with both directions in it: nothing is sorted for a join.
    pairs = edges.groupBy(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).agg(F.bool_or(F.col("x") < F.col("y")).alias("_to"), F.bool_or(F.col("x") > F.col("y")).alias("_from"))
    x, y = F.col("a").cast("string"), F.col("b").cast("string")
    return pairs.where("_to AND _from").select("a", "b", (F.contains(x, y) | F.contains(y, x)).alias("high"))


def contested(index: DataFrame, scenes: DataFrame | None = None) -> DataFrame:
    """name, n, kind of aliases with several owners: in a mutual pair, also a scene, or the rest."""
    pairs = mutual_aliases(index)
    flagged = pairs.select(F.col("a").alias("name")).union(pairs.select("b")).distinct().withColumn("_m", F.lit(True))
    rows = claims(index).where("n > 1").select(F.col("alias").alias("name"), "n").join(flagged, "name", "left")
    rows = rows.join(scenes.select("name").distinct().withColumn("_s", F.lit(True)), "name", "left") if scenes is not None else rows.withColumn("_s", F.lit(None).cast("boolean"))
    return rows.select("name", "n", F.when(F.col("_m"), "mutual").when(F.col("_s"), "also a scene").otherwise("rest").alias("kind"))


def rollup(mentions: DataFrame, names: DataFrame | None = None) -> DataFrame:
    """One row an entity: units, first and last seq, mentioned-only count, aliases by frequency, roles.

    mentions: seq, pos, name, mentioned_only, role. names: name, canonical (others stand for themselves).
    """
    rows = mentions.join(names, "name", "left") if names is not None else mentions.withColumn("canonical", F.lit(None).cast(dict(mentions.dtypes)["name"]))
    rows = rows.withColumn("canonical", F.coalesce("canonical", "name"))
    aliases = rows.groupBy("canonical", "name").agg(F.count("*").alias("n")).groupBy("canonical").agg(F.transform(F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("k"), "name"))), lambda x: x["name"]).alias("aliases"))
    roles = rows.groupBy("canonical", "role").agg(F.count("*").alias("n")).where("role IS NOT NULL").groupBy("canonical").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("role", "n")))).alias("roles"))
    main = rows.groupBy("canonical").agg(F.count_distinct("seq").alias("units"), F.count("*").alias("mentions"), F.min("seq").alias("first_seq"), F.max("seq").alias("last_seq"), F.count_if("mentioned_only").alias("mentioned_only"))
    return main.join(aliases, "canonical").join(roles, "canonical", "left")


def cooccurrence(items: DataFrame, most: int | None = 3000, unit: str = "seq", item: str = "name") -> DataFrame:
    """a < b, units: pairs of items by the units they share; the ``most`` frequent ones, or all for None."""
    once = stored(items.select(F.col(unit).alias("u"), F.col(item).alias("i")).distinct(), "once")
    # Most pairs are met once, so they are dealt before they are counted, over tasks that hold as much however large the table is.
    parts = max(int(once.sparkSession.conf.get("spark.sql.shuffle.partitions")), once.count() // ROWS_A_TASK)
    x, y = once.select("u", F.col("i").alias("a")).repartition(parts, "u"), once.select("u", F.col("i").alias("b")).repartition(parts, "u")
    out = x.join(y, "u").where("a < b").repartition(parts, "a", "b").groupBy("a", "b").agg(F.count("*").alias("units"))
    return out if most is None else out.orderBy(F.desc("units"), "a", "b").limit(most)


def ranked_ids(df: DataFrame, name: Column, *order: Column, letter: str = "c") -> DataFrame:
    """Add id like c001_name by rank; entities are few, so one window ranks them."""
    from storyloom.functions.text import slug

    return df.withColumn("_k", F.row_number().over(Window.orderBy(*order))).withColumn("id", F.concat(F.format_string(letter + "%03d_", "_k"), slug(name))).drop("_k")


def details(rows: DataFrame, key: str, names: DataFrame | None = None, **columns: str) -> DataFrame:
    """One row an entity: for each column named, its values with their units in order, as arrays of (seq, pos, value).

    rows: seq, pos, ``key`` and the columns, of which arrays give a value for each element; null and blank values are left
    out. names: name, canonical, by which keys are resolved (others stand for themselves).
    """
    rows = resolved(rows, key, names)
    out = rows.select(key).distinct()
    for name, column in columns.items():
        values = rows.select(key, "seq", "pos", F.explode(column).alias("value")) if dict(rows.dtypes)[column].startswith("array") else rows.select(key, "seq", "pos", F.col(column).alias("value"))
        values = values.where("trim(value) <> ''")
        out = out.join(values.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("seq", "pos", "value"))).alias(name)), key, "left")
    return out


def evidence(rows: DataFrame, key: str, names: DataFrame | None = None, size: int = 1000, **columns: str) -> DataFrame:
    """key, kind, chunk, first, n, values: as :func:`details`, but in rows of ``size`` unit numbers each, so that no row grows with the corpus.

    An entity's list is its chunks in order; ``first`` and ``n`` are an index of them, which reads no values.
    """
    rows = resolved(rows, key, names)
    each = None
    for name, column in columns.items():
        value = F.explode(column) if dict(rows.dtypes)[column].startswith("array") else F.col(column)
        part = rows.select(key, F.lit(name).alias("kind"), "seq", "pos", value.alias("value")).where("trim(value) <> ''")
        each = part if each is None else each.unionByName(part)
    chunks = each.groupBy(key, "kind", F.floor(F.col("seq") / size).alias("chunk")).agg(F.array_sort(F.collect_list(F.struct("seq", "pos", "value"))).alias("values"))
    return chunks.select(key, "kind", "chunk", F.col("values")[0]["seq"].alias("first"), F.size("values").alias("n"), "values")


def unit_sets(mentions: DataFrame, size: int = 1000, key: str = "name") -> DataFrame:
    """key, chunk, units: the distinct units of each name, sorted, in rows of ``size`` unit numbers."""
    return mentions.groupBy(key, F.floor(F.col("seq") / size).alias("chunk")).agg(F.sort_array(F.collect_set("seq")).alias("units"))


def resolved(rows: DataFrame, key: str, names: DataFrame | None) -> DataFrame:
    """``key`` replaced by its canonical name; without one it stays."""
    if names is None:
        return rows
    known = names.select(F.col("name").alias(key), F.col("canonical").alias("_canonical"))
    return rows.join(known, key, "left").withColumn(key, F.coalesce("_canonical", key)).drop("_canonical")


def counted(rows: DataFrame, key: str, value: str, names: DataFrame | None = None) -> DataFrame:
    """key, counts: how often each value occurs with each key, most frequent first; values resolved by ``names``."""
    n = resolved(rows.select(key, value), value, names).where(f"trim({value}) <> ''").groupBy(key, value).agg(F.count("*").alias("n"))
    return n.groupBy(key).agg(F.transform(F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("k"), F.col(value).alias("v")))), lambda x: F.struct(x["v"].alias("value"), (-x["k"]).alias("n"))).alias("counts"))


def flagged(rows: DataFrame, key: str, **there: DataFrame) -> DataFrame:
    """Add a flag for each table of names (column ``key``): is the row's name in it?"""
    for name, table in there.items():
        rows = rows.join(table.select(key).distinct().withColumn(name, F.lit(True)), key, "left").withColumn(name, F.coalesce(name, F.lit(False)))
    return rows
