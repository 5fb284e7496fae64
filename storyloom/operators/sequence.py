"""Ordered units: timelines, change points, budgeted segments, first occurrences, rosters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from storyloom.operators.chains import BLOCK, best_chains

# Minutes of a segment, and how speech becomes minutes.
CHARS_PER_SECOND, PAUSES = 4.5, 1.20
TARGET, SOFT, HARD, SIZES = 28.0, (25.0, 32.0), (18.0, 42.0), (2, 5)
SOFT_END, OTHER_END = 8.0, 25.0
ARC = (10, 50)
#: Units of a task; of a run of them, where items are counted around each unit, or where names are counted before runs meet.
UNITS_A_TASK, ANCHORS, RUN = 4096, 32, 128


def unit_minutes(spoken: DataFrame) -> DataFrame:
    """seq, minutes from seq, text of everything that is spoken."""
    return spoken.groupBy("seq").agg((F.sum(F.length("text")) / CHARS_PER_SECOND / 60 * PAUSES).alias("minutes"))


def timeline(units: DataFrame, mentions: DataFrame, least_units: int = 8) -> DataFrame:
    """Add names, the ordered distinct names of each unit that are in ``least_units`` units. mentions: seq, pos, name."""
    major = mentions.groupBy("name").agg(F.count_distinct("seq").alias("_u")).where(F.col("_u") >= least_units).select("name")
    first = mentions.join(major, "name").groupBy("seq", "name").agg(F.min("pos").alias("pos"))
    names = first.groupBy("seq").agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "name"))), lambda x: x["name"]).alias("names"))
    return units.join(names, "seq", "left").withColumn("names", F.coalesce("names", F.array().cast("array<string>")))


def digest_line(names: Column, text: Column, most_names: int = 5, most_chars: int = 60, dash: str = "—") -> Column:
    """The first names, then the text cut to length; a dash for what is empty."""
    who = F.array_join(F.slice(names, 1, most_names), ", ")
    cut = F.substring(F.coalesce(text, F.lit("")), 1, most_chars)
    filled = lambda c: F.when(c == "", dash).otherwise(c)
    return F.concat(filled(who), F.lit(" | "), filled(cut))


def _parts(units: DataFrame) -> int:
    """Tasks that hold as many units however large the table is."""
    return max(int(units.sparkSession.conf.get("spark.sql.shuffle.partitions")), units.count() // UNITS_A_TASK)


def change_curve(items: DataFrame, units: DataFrame, width: int = 8, least: int = 3, group: str = "grp") -> DataFrame:
    """group, pos, change: 1 - Jaccard similarity of the items seen ``least`` times in the ``width`` units up to pos and after it.

    items: group, pos, item (one row an occurrence); units: group, pos (gapless from 1). Items are sent once to each run of ``ANCHORS`` units that
    they count for, over tasks that hold as many units however large the table is; there they are counted for each anchor if the run
    has ``least`` of them, so no window of rows spans a group. The last unit of a group has change 0.
    """
    parts = _parts(units)
    first, final = F.greatest(F.lit(1), F.col("pos") - width), F.col("pos") + width - 1
    run = lambda anchor: F.floor((anchor - 1) / ANCHORS)
    sent = items.select(group, "pos", "item", F.explode(F.sequence(run(first), run(final))).alias("run")).repartition(parts, group, "run")
    # What follows groups by run and more, so it needs no other shuffle.
    seen = sent.groupBy(group, "run", "item", "pos").agg(F.count("*").alias("n"))
    seen = seen.withColumn("all", F.sum("n").over(Window.partitionBy(group, "run", "item"))).where(F.col("all") >= least)
    anchors = F.sequence(F.greatest(first, F.col("run") * ANCHORS + 1), F.least(final, (F.col("run") + 1) * ANCHORS))
    met = seen.select(group, "run", "item", "pos", "n", F.explode(anchors).alias("anchor"))
    times = lambda side: F.coalesce(F.sum(F.when(side, F.col("n"))), F.lit(0)) >= least
    core = met.groupBy(group, "run", "anchor", "item").agg(times(F.col("anchor") >= F.col("pos")).alias("p"), times(F.col("anchor") < F.col("pos")).alias("n")).where("p OR n")
    sizes = core.groupBy(group, "run", F.col("anchor").alias("pos")).agg(F.count("*").alias("either"), F.count_if(F.col("p") & F.col("n")).alias("both")).drop("run")
    last = units.groupBy(group).agg(F.max("pos").alias("_last"))
    change = F.when(F.col("pos") == F.col("_last"), 0.0).when(F.col("either") > 0, 1 - F.col("both") / F.col("either")).otherwise(0.0)
    return units.select(group, "pos").join(last, group).join(sizes, [group, "pos"], "left").select(group, "pos", change.alias("change"))


def blended(people: DataFrame, scenes: DataFrame, group: str = "grp") -> DataFrame:
    """0.65 of the change in people and 0.35 of that in scenes."""
    return people.join(scenes.withColumnRenamed("change", "_s"), [group, "pos"]).select(group, "pos", (0.65 * F.col("change") + 0.35 * F.col("_s")).alias("change"))


def change_points(curve: DataFrame, group: str = "grp", cost: float | None = None, shortest: int = ARC[0], longest: int = ARC[1], block: int = BLOCK) -> DataFrame:
    """group, start, cut, feasible: segments of allowed lengths that maximise the sum of change - cost over their ends; the last end is free.

    The cost is the group's mean change unless given; sums are exact in units of 1e-9, and of equally good choices
    segments that begin earlier are taken, from the end. A group that cannot be divided gives one row with nulls and feasible
    false. A group may be of any length: see ``chains``.
    """
    last = curve.groupBy(group).agg(F.max("pos").alias("_last"), F.round(F.avg("change"), 9).alias("_cost"))
    price = F.col("_cost") if cost is None else F.lit(cost)
    paid = F.when(F.col("pos") == F.col("_last"), 0.0).otherwise(price - F.col("change"))
    units = curve.join(last, group).select(group, "pos", F.round(paid * 1e9).cast("long").alias("cost"))
    values = lambda state, c: F.concat(F.array_repeat(F.lit(None).cast("long"), shortest - 1), F.transform(F.slice(state, shortest, longest - shortest + 1), lambda x: x + c))
    chosen, none = best_chains(units, longest, values, group, long_first=True, block=block, shortest=shortest)
    missing = none.select(group, F.lit(None).cast("long").alias("start"), F.lit(None).cast("long").alias("cut"), F.lit(False).alias("feasible"))
    return chosen.select(group, "start", F.col("stop").alias("cut"), F.lit(True).alias("feasible")).unionByName(missing)


def last_units(mentions: DataFrame, units: DataFrame, least: int, group: str = "grp") -> DataFrame:
    """group, name, last: the last unit of each name that is in ``least`` units or more. mentions: group, unit, name; units: a row each.

    Units are counted in runs before the runs of a name meet, so that neither a frequent name nor a long table fills a task.
    """
    parts = _parts(units)
    once = mentions.select(group, F.floor(F.col("unit") / RUN).alias("run"), "unit", "name").repartition(parts, group, "run").distinct()
    own = once.groupBy(group, "run", "name").agg(F.max("unit").alias("last"), F.count("*").alias("n")).repartition(parts, group, "name")
    return own.groupBy(group, "name").agg(F.max("last").alias("last"), F.sum("n").alias("n")).where(F.col("n") >= least).select(group, "name", "last")


def arcs(cuts: DataFrame, entities: DataFrame | None = None, group: str = "grp") -> DataFrame:
    """group, start, stop, units, cut, exits: the ranges of :func:`change_points`; hard where entities leave, that is have their last unit at the cut.

    entities: group, name, last; ``exits`` are the names that leave, sorted.
    """
    rows = cuts.where("cut IS NOT NULL").select(group, "start", F.col("cut").alias("stop"), (F.col("cut") - F.col("start") + 1).alias("units"))
    nobody = F.array().cast("array<string>")
    if entities is None:
        return rows.select("*", F.lit("soft").alias("cut"), nobody.alias("exits"))
    exits = entities.groupBy(group, F.col("last").alias("stop")).agg(F.sort_array(F.collect_set("name")).alias("exits"))
    rows = rows.join(exits, [group, "stop"], "left")
    return rows.select(group, "start", "stop", "units", F.when(F.col("exits").isNotNull(), "hard").otherwise("soft").alias("cut"), F.coalesce("exits", nobody).alias("exits"))


def length_stats(rows: DataFrame, length: str, *keys: str) -> DataFrame:
    return rows.groupBy(*keys).agg(F.count("*").alias("n"), F.round(F.avg(length), 6).alias("mean"), F.percentile(length, 0.5).alias("median"), F.min(length).alias("least"), F.max(length).alias("most"))


def duration_penalty(minutes: Column) -> Column:
    off = F.abs(minutes - TARGET)
    return F.when((minutes < HARD[0]) | (minutes > HARD[1]), 1e5 + 100 * off).when(minutes.between(*SOFT), 0.5 * off * off).otherwise(3 * off * off)


def segment_candidates(units: DataFrame, cuts: DataFrame | None = None, group: str = "grp", sizes: tuple[int, int] = SIZES) -> DataFrame:
    """group, start, stop, units, minutes, cost of every allowed segment. units: group, pos, minutes; cuts: group, pos, kind (hard, soft).

    A segment crosses no hard cut; its end costs 0 at a hard cut or the group's end, 8 at a soft cut, else 25.
    """
    rows = units.withColumn("_kind", F.lit("")) if cuts is None else units.join(cuts.select(group, "pos", F.col("kind").alias("_kind")), [group, "pos"], "left")
    rows = rows.withColumn("_kind", F.coalesce("_kind", F.lit("")))
    last = units.groupBy(group).agg(F.max("pos").alias("_last"))
    # Every unit is sent to the starts whose segments may hold it, so that no window spans a group.
    sent = rows.withColumn("start", F.explode(F.sequence(F.greatest(F.lit(1).cast("long"), F.col("pos").cast("long") - sizes[1] + 1), F.col("pos").cast("long"))))
    near = sent.groupBy(group, "start").agg(F.array_sort(F.collect_list(F.struct("pos", "minutes", F.col("_kind").alias("kind")))).alias("u")).join(last, group)
    held = near.select(group, "start", "_last", "u", F.explode(F.sequence(F.lit(sizes[0]), F.lit(sizes[1]))).alias("units")).where(F.size("u") >= F.col("units"))
    inner, end = F.slice("u", 1, F.col("units") - 1), F.element_at("u", F.col("units"))
    minutes = F.round(F.aggregate(inner, F.lit(0.0), lambda acc, u: acc + u["minutes"]) + end["minutes"], 9)  # sums of decimals, so that limits are met exactly
    pairs = held.where(~F.exists(inner, lambda u: u["kind"] == "hard")).select(group, "start", "_last", "units", minutes.alias("minutes"), end["kind"].alias("kind"))
    stop = F.col("start") + F.col("units") - 1
    end_cost = F.when((F.col("kind") == "hard") | (stop == F.col("_last")), 0.0).when(F.col("kind") == "soft", SOFT_END).otherwise(OTHER_END)
    return pairs.select(group, "start", stop.alias("stop"), "units", "minutes", (duration_penalty(F.col("minutes")) + end_cost).alias("cost"))


def budgeted_segments(candidates: DataFrame, units: DataFrame, group: str = "grp", longest: int = SIZES[1], block: int = BLOCK) -> DataFrame:
    """group, segment (from 1), start, stop, units, minutes, feasible: the cheapest cover of each group without overlap.

    Costs are summed exactly in units of 1e-6; of equally cheap covers the one with shorter last segments is taken. Where no
    cover exists, one row says so, with nulls. A group may be of any length: see ``chains``.
    """
    by_size = [F.max(F.when(F.col("units") == n, F.round(F.col("cost") * 1e6).cast("long"))) for n in range(1, longest + 1)]
    costs = candidates.groupBy(group, F.col("stop").alias("pos")).agg(F.array(*by_size).alias("cost"))
    priced = units.select(group, F.col("pos").cast("long").alias("pos")).join(costs, [group, "pos"], "left").withColumn("cost", F.coalesce("cost", F.array_repeat(F.lit(None).cast("long"), longest)))
    chosen, none = best_chains(priced, longest, lambda state, cost: F.zip_with(state, cost, lambda x, c: x + c), group, block=block)
    minutes = candidates.select(group, "start", "stop", "minutes")
    found = chosen.join(minutes, [group, "start", "stop"]).select(group, F.col("nth").alias("segment"), "start", "stop", (F.col("stop") - F.col("start") + 1).alias("units"), "minutes", F.lit(True).alias("feasible"))
    empty = [F.lit(None).cast("long").alias(c) for c in ("segment", "start", "stop", "units")]
    return found.unionByName(none.select(group, *empty, F.lit(None).cast("double").alias("minutes"), F.lit(False).alias("feasible")))


def segment_codes(segments: DataFrame, season: str = "season") -> DataFrame:
    return segments.withColumn("code", F.format_string("S%02dE%02d", season, "segment"))


def segment_stats(segments: DataFrame, group: str = "grp") -> DataFrame:
    """group, segments, mean, least, most minutes, share in the comfortable range."""
    inside = F.col("minutes").between(*SOFT).cast("int")
    return segments.groupBy(group).agg(F.count("minutes").alias("segments"), F.round(F.avg("minutes"), 6).alias("mean"), F.round(F.min("minutes"), 6).alias("least"), F.round(F.max("minutes"), 6).alias("most"), F.round(F.avg(inside), 6).alias("comfortable"))


def into_ranges(rows: DataFrame, ranges: DataFrame, key: str = "seq", group: str | None = None) -> DataFrame:
    """Join rows to the ranges (start, stop, ...) that hold them, by equality on each number of a range."""
    numbered = ranges.withColumn(key, F.explode(F.sequence("start", "stop")))
    return rows.join(numbered, [key, *([group] if group else [])])


def first_occurrence_load(items: DataFrame) -> DataFrame:
    """part, newcomers, scenes, load: what each part shows for the first time. items: part, kind (person, scene), item. load = 2 people + scenes."""
    first = items.groupBy("kind", "item").agg(F.min("part").alias("part"))
    counts = first.groupBy("part").agg(F.count_if(F.col("kind") == "person").alias("people"), F.count_if(F.col("kind") == "scene").alias("scenes"))
    zero = F.lit(0)
    return items.select("part").distinct().join(counts, "part", "left").select("part", F.coalesce("people", zero).alias("people"), F.coalesce("scenes", zero).alias("scenes"), (2 * F.coalesce("people", zero) + F.coalesce("scenes", zero)).alias("load"))


def roster(mentions: DataFrame, group: str = "season") -> DataFrame:
    """group, name, units, first_seq, doubt, tier, units_overall, first_group, debut. mentions: group, seq, name, mentioned_only, doubt.

    Tiers: A from 10 units, B from 3, C the rest. Mentions in passing do not count.
    """
    rows = mentions.where(~F.coalesce("mentioned_only", F.lit(False)))
    own = rows.groupBy(group, "name").agg(F.count_distinct("seq").alias("units"), F.min("seq").alias("first_seq"), F.bool_or(F.coalesce("doubt", F.lit(False))).alias("doubt"))
    overall = rows.groupBy("name").agg(F.count_distinct("seq").alias("units_overall"), F.min_by(group, F.struct("seq", group)).alias("first_group"))
    tier = F.when(F.col("units") >= 10, "A").when(F.col("units") >= 3, "B").otherwise("C")
    return own.join(overall, "name").select(group, "name", "units", "first_seq", "doubt", tier.alias("tier"), "units_overall", "first_group", (F.col("first_group") == F.col(group)).alias("debut"))


def roster_totals(rows: DataFrame, group: str = "season") -> DataFrame:
    return rows.groupBy(group).agg(*[F.count_if(F.col("tier") == t).alias(f"tier_{t.lower()}") for t in "ABC"], F.count_if("debut").alias("debuts"), F.count_if("doubt").alias("doubtful"))


def timeline_details(units: DataFrame, scenes: DataFrame | None = None, **lists: DataFrame) -> DataFrame:
    """Add scenes (distinct, in order), and for each further table (seq, pos, text) its texts in order. scenes: seq, pos, name."""
    if scenes is not None:
        first = scenes.groupBy("seq", "name").agg(F.min("pos").alias("pos"))
        lists = {"scenes": first.select("seq", "pos", F.col("name").alias("text")), **lists}
    for name, rows in lists.items():
        own = rows.groupBy("seq").agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "text"))), lambda x: x["text"]).alias(name))
        units = units.join(own, "seq", "left").withColumn(name, F.coalesce(name, F.array().cast("array<string>")))
    return units


def histogram(rows: DataFrame, column: str, most: int = 8) -> DataFrame:
    """The most frequent values of a column, such as tones or cuts: value, n."""
    return rows.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("value")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "value").limit(most)


def segment_rollup(segments: DataFrame, **items: DataFrame) -> DataFrame:
    """Each segment (start, stop, ...) with the sorted distinct items of its units. items: tables of seq, name."""
    keys = segments.columns
    for column, rows in items.items():
        found = into_ranges(rows, segments.select("start", "stop"), "seq").groupBy("start", "stop").agg(F.sort_array(F.collect_set("name")).alias(column))
        segments = segments.join(found, ["start", "stop"], "left").withColumn(column, F.coalesce(column, F.array().cast("array<string>")))
    return segments.select(*keys, *items)


def load_summary(loads: DataFrame) -> DataFrame:
    return loads.agg(F.count("*").alias("parts"), F.round(F.avg("load"), 6).alias("mean"), F.max("load").alias("most"))


def heaviest(loads: DataFrame, most: int = 12) -> DataFrame:
    return loads.orderBy(F.desc("load"), "part").limit(most)


def frequent_scenes(scenes: DataFrame, group: str = "season", least: int = 3) -> DataFrame:
    """group, scenes: how many scenes are in ``least`` units of the group or more. scenes: group, seq, name."""
    own = scenes.groupBy(group, "name").agg(F.count_distinct("seq").alias("units"))
    return own.groupBy(group).agg(F.count_if(F.col("units") >= least).alias("scenes"))


def change_stats(curve: DataFrame) -> DataFrame:
    """mean, the default cost of a cut, and the 85th percentile of change."""
    return curve.agg(F.round(F.avg("change"), 9).alias("mean"), F.round(F.percentile("change", 0.85), 9).alias("p85"))
