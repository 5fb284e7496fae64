"""Request and reply tables for an external annotator, and prompt grids."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from storyloom.functions.text import json_block, united_terms


def previous_context(units: DataFrame, most: int = 3, lookback: int = 12, group: str | None = None) -> DataFrame:
    """Add context: the last ``most`` synopses that there are among the ``lookback`` units before. units: seq, synopsis."""
    if not group:  # a unit counts for those after it: no window over the whole table; texts join where their numbers are chosen
        own = units.where("synopsis IS NOT NULL").select(F.explode(F.sequence(F.col("seq") + 1, F.col("seq") + lookback)).alias("to"), F.col("seq").alias("from"))
        near = own.groupBy("to").agg(F.array_sort(F.collect_list("from")).alias("c")).select("to", F.explode(F.slice("c", F.greatest(F.lit(1), F.size("c") - most + 1), most)).alias("from"))
        texts = near.join(units.select(F.col("seq").alias("from"), "synopsis"), "from").join(units.select(F.col("seq").alias("to")), "to", "left_semi")
        found = texts.groupBy(F.col("to").alias("seq")).agg(F.transform(F.array_sort(F.collect_list(F.struct("from", "synopsis"))), lambda x: x["synopsis"]).alias("context"))
        return units.join(found, "seq", "left").withColumn("context", F.coalesce("context", F.array().cast("array<string>")))
    w = Window.partitionBy(group).orderBy("seq").rangeBetween(-lookback, -1)
    seen = F.collect_list(F.when(F.col("synopsis").isNotNull(), F.struct("seq", "synopsis"))).over(w)
    return units.withColumn("_c", F.array_sort(seen)).withColumn("context", F.transform(F.slice("_c", F.greatest(F.lit(1), F.size("_c") - most + 1), most), lambda x: x["synopsis"])).drop("_c")


def following_target(seqs: DataFrame, targets: DataFrame, block: int = 1 << 16) -> DataFrame:
    """seq, target: the least target greater than each seq (seqs: seq; targets: target). Windows are by blocks of numbers."""
    rows = seqs.select("seq", F.lit(None).cast("long").alias("target")).distinct().unionByName(targets.select(F.col("target").alias("seq"), "target").distinct())
    rows = rows.withColumn("_block", F.floor(F.col("seq") / block))
    ahead = Window.partitionBy("_block").orderBy(F.desc("seq")).rangeBetween(Window.unboundedPreceding, -1)  # a frame that grows; one that shrinks is read anew for every row
    edges = rows.groupBy("_block").agg(F.min("target").alias("_own"))
    edges = edges.select("_block", F.min("_own").over(Window.orderBy("_block").rowsBetween(1, Window.unboundedFollowing)).alias("_later"))  # a row for each block
    found = rows.withColumn("_next", F.min("target").over(ahead)).where("target IS NULL").join(edges, "_block")
    return found.select("seq", F.coalesce("_next", "_later").alias("target")).where("target IS NOT NULL")


def registry_before(mentions: DataFrame, targets: DataFrame, most: int = 400) -> DataFrame:
    """target, name, n, rank: the names seen before each target, by frequency. mentions: seq, name; targets: seq.

    A mention counts for the first target after it, and for all that follow. A name's count stays the same until its next mention,
    while others only grow, so a name can be among the ``most`` frequent ones of a target only if it was so where it
    was last counted, also among the names counted there. Only those are carried on to later targets, and only until the last of the
    ``most`` names, which can but rise from target to target, stands above them: it is found at some targets, each a quarter further on.
    """
    from storyloom.scratch import stored
    from storyloom.sources.readers import with_ordinal

    t = stored(with_ordinal(targets.select(F.col("seq").cast("long").alias("target")).distinct(), "target", "nth"), "targets")
    last = t.count()
    counts = stored(mentions.groupBy(F.col("seq").cast("long").alias("seq"), "name").agg(F.count("*").alias("n")), "counts")
    counts = counts.join(following_target(counts.select("seq"), t), "seq").join(t, "target").groupBy("name", "nth").agg(F.sum("n").alias("n"))
    own = Window.partitionBy("name").orderBy("nth")
    held = counts.select("name", "nth", F.sum("n").over(own).alias("n"), F.coalesce(F.lead("nth").over(own) - 1, F.lit(last)).alias("until"))
    ranked = lambda rows: rows.withColumn("rank", F.row_number().over(Window.partitionBy("nth").orderBy(F.desc("n"), "name"))).where(F.col("rank") <= most)
    held = stored(held, "held")
    marks = [1]
    while marks[-1] < last:
        marks.append(max(marks[-1] + 1, marks[-1] * 5 // 4))
    at = F.filter(F.array(*[F.lit(m).cast("long") for m in marks]), lambda m: (m >= F.col("nth")) & (m <= F.col("until")))
    lowest = ranked(held.select("name", "n", F.explode(at).alias("nth"))).where(F.col("rank") == most).collect()  # a row for each mark at most
    if lowest:
        bars = F.array(*[F.struct(F.lit(r.nth).cast("long").alias("nth"), F.lit(r.n).cast("long").alias("n"), F.lit(r.name).alias("name")) for r in sorted(lowest, key=lambda r: r.nth)])
        below = F.filter(bars, lambda b: (F.col("n") < b["n"]) | ((F.col("n") == b["n"]) & (F.col("name") > b["name"])))
        held = held.withColumn("until", F.least("until", F.get(below, F.lit(0))["nth"] - 1)).where("until >= nth")
    carried = ranked(held).select("name", "n", F.explode(F.sequence("nth", "until")).alias("nth"))
    return ranked(carried).join(t, "nth").select("target", "name", "n", "rank")


def request_text(registry: Column, context: Column, heading: Column, body: Column, notice: Column | None = None) -> Column:
    """The parts that there are, parted by blank lines; ``notice``: see :func:`merge_notice`."""
    part = lambda title, c: F.when(F.coalesce(c, F.lit("")) != "", F.concat(F.lit(title), c))
    return F.concat_ws("\n\n", part("Known names: ", registry), part("Before: ", context), *([] if notice is None else [notice]), heading, body)


def merge_notice(merged: Column) -> Column:
    """A warning that the titles ``merged`` share this unit's text; null where there are none."""
    return F.when(F.size(merged) > 0, F.concat(F.lit("Note: this unit also holds "), F.array_join(merged, ", "), F.lit(". Don't make up events for titles without text.")))


def parse_replies(replies: DataFrame, schema: str, text: str = "reply") -> tuple[DataFrame, DataFrame]:
    """(rows with ``parsed``, rejects): the JSON block of each reply, cast to a schema."""
    rows = replies.withColumn("parsed", F.from_json(json_block(F.col(text)), schema, {"mode": "PERMISSIVE"}))
    return rows.where("parsed IS NOT NULL"), rows.where("parsed IS NULL").drop("parsed")


def grid(targets: DataFrame, styles: DataFrame, target_ids: list | None = None, style_ids: list | None = None) -> DataFrame:
    """Every target in every style (both are small curated tables; ``styles`` is refused beyond 10,000 rows); unknown ids are an error."""
    for df, ids, key in ((targets, target_ids, "target_id"), (styles, style_ids, "style_id")):
        if ids is not None:
            there = {r[0] for r in df.select(key).where(F.col(key).isin(ids)).collect()}
            if set(ids) - there:
                raise ValueError(f"unknown {key}: {sorted(set(ids) - there)}")
    if target_ids is not None:
        targets = targets.where(F.col("target_id").isin(target_ids))
    if style_ids is not None:
        styles = styles.where(F.col("style_id").isin(style_ids))
    if styles.limit(10_001).count() > 10_000:
        raise ValueError("too many styles")
    return targets.crossJoin(F.broadcast(styles))


def prompt(prefix: Column, target: Column, style: Column, suffix: Column, *avoid: Column) -> Column:
    """Prefix, target, style, suffix, and the united list of what to avoid."""
    return F.concat_ws(" ", prefix, target, style, suffix, F.concat(F.lit("Avoid: "), F.array_join(united_terms(*avoid), ", ")))


def review_text(stage: Column, body: Column, analysis: Column) -> Column:
    """A request to judge an analysis against its unit."""
    return F.concat_ws("\n\n", F.concat(F.lit("Review: "), stage), body, F.concat(F.lit("Analysis: "), analysis))


def repair_text(body: Column, analysis: Column, reasons: Column) -> Column:
    """A request to mend an analysis, with the reasons for which it failed."""
    return F.concat_ws("\n\n", F.concat(F.lit("Repair: "), F.array_join(reasons, "; ")), body, F.concat(F.lit("Analysis: "), analysis))


def batches(missing: DataFrame, size: int) -> DataFrame:
    """missing, batches: how many rows are missing, and how many batches of ``size`` they make."""
    return missing.agg(F.count("*").alias("missing")).select("missing", F.ceil(F.col("missing") / size).cast("long").alias("batches"))


def missing_cells(expected: DataFrame, done: DataFrame, *key: str) -> DataFrame:
    return expected.join(done.select(*key), list(key), "left_anti")
