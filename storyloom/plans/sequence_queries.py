"""Queries on ordered units and on logs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from storyloom.operators import quality, sequence
from storyloom.plans.common import SQL_MENTIONS, docs, mentions, table
from storyloom.scratch import shared_folder, stored
from storyloom.sources.readers import with_ordinal
from storyloom.streaming import monitors

Q: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        Q[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


@query("SELECT conv_id AS seq, round(sum(length(text)) / 4.5 / 60 * 1.2, 6) AS minutes FROM conversations WHERE role <> 'system' GROUP BY 1")
def unit_minutes(spark: SparkSession, sf: str) -> DataFrame:
    spoken = table(spark, sf, "conversations").where("role <> 'system'").select(F.col("conv_id").alias("seq"), "text")
    return sequence.unit_minutes(spoken).select("seq", F.round("minutes", 6).alias("minutes"))


def _units(spark, sf):
    """Documents of each source in order: grp, pos, seq, minutes."""
    numbered = with_ordinal(table(spark, sf, "documents").select("doc_id", "source", "n_chars"), "doc_id", "pos", "source")
    return stored(numbered.select(F.col("source").alias("grp"), "pos", F.col("doc_id").alias("seq"), (F.lit(4.0) + F.col("n_chars") % 60 / 10).alias("minutes")), "units")


def _mentions(spark, sf, u):
    return mentions(docs(spark, sf)).join(u.select("seq", "grp", "pos").withColumnRenamed("pos", "unit"), "seq")


def _curve(spark, sf, u=None):
    u = _units(spark, sf) if u is None else u
    items = _mentions(spark, sf, u).select("grp", F.col("unit").alias("pos"), F.col("name").alias("item"))
    return sequence.change_curve(items, u.select("grp", "pos"))


SQL_UNITS = "u AS (SELECT source AS grp, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS pos, doc_id AS seq, 4.0 + (n_chars % 60) / 10 AS minutes FROM documents)"
SQL_CURVE = f"""{SQL_MENTIONS}, {SQL_UNITS}, i AS (SELECT u.grp, u.pos, m.name AS item FROM mentions m JOIN u ON u.seq = m.seq),
c AS (SELECT a.grp, a.pos, i.item, count(*) FILTER (i.pos <= a.pos) >= 3 AS p, count(*) FILTER (i.pos > a.pos) >= 3 AS n FROM u a JOIN i ON i.grp = a.grp AND i.pos BETWEEN a.pos - 7 AND a.pos + 8 GROUP BY 1, 2, 3),
k AS (SELECT grp, pos, count(*) AS either, count(*) FILTER (p AND n) AS both FROM c WHERE p OR n GROUP BY 1, 2), l AS (SELECT grp, max(pos) AS last FROM u GROUP BY 1),
curve AS (SELECT u.grp, u.pos, CASE WHEN u.pos = l.last THEN 0.0 WHEN k.either > 0 THEN 1 - k.both / k.either ELSE 0.0 END AS change FROM u JOIN l USING (grp) LEFT JOIN k ON k.grp = u.grp AND k.pos = u.pos)"""


@query(f"WITH {SQL_CURVE} SELECT grp, pos, round(change, 9) AS change FROM curve")
def change_curve(spark, sf):
    return _curve(spark, sf).withColumn("change", F.round("change", 9))


# The choice of cuts step by step: ``b`` holds the best sum up to each position, ``k`` where its last segment begins.
SQL_CUTS = f"""{SQL_CURVE}, gc AS (SELECT grp, list(change ORDER BY pos) AS ch, count(*) AS n, round(avg(change), 9) AS cost FROM curve GROUP BY 1),
dp(grp, e, b, k) AS (SELECT grp, CAST(0 AS BIGINT), [CAST(0 AS DOUBLE)], [CAST(0 AS BIGINT)] FROM gc UNION ALL
SELECT grp, e + 1, list_append(b, list_max(list_transform(c, lambda x: x.v))), list_append(k, list_min(list_transform(list_filter(c, lambda x: x.v = list_max(list_transform(c, lambda y: y.v))), lambda x: x.j)))
FROM (SELECT grp, e, b, k, list_filter(list_transform(range(greatest(0, e - 49), e - 8), lambda j: {{'v': b[j + 1] + CASE WHEN e + 1 = n THEN 0 ELSE ch[e + 1] - cost END, 'j': j}}), lambda x: x.v IS NOT NULL) AS c FROM dp JOIN gc USING (grp) WHERE e < n)),
fin AS (SELECT grp, e, b, k FROM dp JOIN gc USING (grp) WHERE e = n), tr(grp, z) AS (SELECT grp, e FROM fin WHERE b[e + 1] IS NOT NULL UNION ALL SELECT grp, k[z + 1] FROM tr JOIN fin USING (grp) WHERE k[z + 1] > 0),
cuts AS (SELECT grp, z AS cut, true AS feasible FROM tr UNION ALL SELECT grp, NULL, false FROM fin WHERE b[e + 1] IS NULL)"""
SQL_ARCS = f"""{SQL_CUTS}, ex AS (SELECT grp, name, last FROM (SELECT u.grp, m.name, max(u.pos) AS last, count(DISTINCT u.pos) AS n FROM mentions m JOIN u ON u.seq = m.seq GROUP BY 1, 2) WHERE n >= 15),
arcs AS (SELECT grp, coalesce(lag(cut) OVER (PARTITION BY grp ORDER BY cut), 0) + 1 AS start, cut AS stop, CASE WHEN EXISTS (SELECT 1 FROM ex WHERE ex.grp = cuts.grp AND ex.last = cuts.cut) THEN 'hard' ELSE 'soft' END AS cut FROM cuts WHERE feasible)"""
SQL_SEGMENTS = f"""{SQL_ARCS}, uk AS (SELECT u.*, a.cut AS kind FROM u LEFT JOIN arcs a ON a.grp = u.grp AND a.stop = u.pos), ls AS (SELECT grp, max(pos) AS last FROM u GROUP BY 1),
cand AS (SELECT s.grp, s.pos AS start, s.pos + v.n - 1 AS stop, v.n AS units, round(sum(x.minutes), 9) AS minutes, count(*) FILTER (x.kind = 'hard' AND x.pos < s.pos + v.n - 1) AS crossed FROM uk s, (VALUES (2), (3), (4), (5)) v(n), uk x WHERE x.grp = s.grp AND x.pos BETWEEN s.pos AND s.pos + v.n - 1 GROUP BY 1, 2, 3, 4),
priced AS (SELECT c.grp, c.start, c.stop, c.units, c.minutes, CASE WHEN c.minutes < 18 OR c.minutes > 42 THEN 1e5 + 100 * abs(c.minutes - 28) WHEN c.minutes BETWEEN 25 AND 32 THEN 0.5 * abs(c.minutes - 28) * abs(c.minutes - 28) ELSE 3 * abs(c.minutes - 28) * abs(c.minutes - 28) END + CASE WHEN e.kind = 'hard' OR c.stop = ls.last THEN 0 WHEN e.kind = 'soft' THEN 8 ELSE 25 END AS cost FROM cand c JOIN uk e ON e.grp = c.grp AND e.pos = c.stop JOIN ls ON ls.grp = c.grp WHERE c.crossed = 0),
st AS (SELECT u.grp, u.pos, list({{'s': p.start, 'c': p.cost}}) FILTER (p.start IS NOT NULL) AS c FROM u LEFT JOIN priced p ON p.grp = u.grp AND p.stop = u.pos GROUP BY 1, 2), gs AS (SELECT grp, list(coalesce(c, []) ORDER BY pos) AS cs, count(*) AS n FROM st GROUP BY 1),
ds(grp, e, b, k) AS (SELECT grp, CAST(0 AS BIGINT), [CAST(0 AS DOUBLE)], [CAST(0 AS BIGINT)] FROM gs UNION ALL
SELECT grp, e + 1, list_append(b, list_min(list_transform(c, lambda x: x.v))), list_append(k, list_max(list_transform(list_filter(c, lambda x: x.v = list_min(list_transform(c, lambda y: y.v))), lambda x: x.s)))
FROM (SELECT grp, e, b, k, list_filter(list_transform(cs[e + 1], lambda x: {{'v': b[x.s] + x.c, 's': x.s}}), lambda x: x.v IS NOT NULL) AS c FROM ds JOIN gs USING (grp) WHERE e < n)),
fs AS (SELECT grp, e, b, k FROM ds JOIN gs USING (grp) WHERE e = n), ts(grp, z) AS (SELECT grp, e FROM fs WHERE b[e + 1] IS NOT NULL UNION ALL SELECT grp, k[z + 1] - 1 FROM ts JOIN fs USING (grp) WHERE k[z + 1] > 1),
segments AS (SELECT ts.grp, row_number() OVER (PARTITION BY ts.grp ORDER BY z) AS segment, k[z + 1] AS start, z AS stop, CAST(p.units AS BIGINT) AS units, p.minutes, true AS feasible FROM ts JOIN fs USING (grp) JOIN priced p ON p.grp = ts.grp AND p.start = k[z + 1] AND p.stop = z UNION ALL SELECT grp, NULL, NULL, NULL, NULL, NULL, false FROM fs WHERE b[e + 1] IS NULL)"""


@query(f"WITH RECURSIVE {SQL_CUTS} SELECT grp, coalesce(cut, -1) AS cut, feasible FROM cuts")
def change_points(spark, sf):
    return sequence.change_points(stored(_curve(spark, sf), "curve")).select("grp", F.coalesce("cut", F.lit(-1)).alias("cut"), "feasible")


@query(f"WITH RECURSIVE {SQL_ARCS} SELECT grp, start, stop, stop - start + 1 AS units, cut FROM arcs")
def arc_table(spark, sf):
    return _arcs(spark, sf).drop("exits")


@query(f"WITH RECURSIVE {SQL_ARCS.replace('n >= 15', 'n >= 3')} SELECT a.grp, a.stop, ex.name FROM arcs a JOIN ex ON ex.grp = a.grp AND ex.last = a.stop")
def arc_exits(spark, sf):
    """The names in three units or more that leave at each hard cut."""
    return _arcs(spark, sf, least=3).select("grp", "stop", F.explode("exits").alias("name"))


def _arcs(spark, sf, units=None, least=15):
    """Arcs from names that are looked for once."""
    u = _units(spark, sf) if units is None else units
    found = stored(_mentions(spark, sf, u), "mentions")
    curve = sequence.change_curve(found.select("grp", F.col("unit").alias("pos"), F.col("name").alias("item")), u.select("grp", "pos"))
    exits = sequence.last_units(found, u, least)
    return sequence.arcs(sequence.change_points(stored(curve, "curve")), exits)


@query(f"""WITH {SQL_UNITS}, l AS (SELECT grp, max(pos) AS last FROM u GROUP BY 1), k AS (SELECT a.grp, a.pos AS start, a.pos + v.n - 1 AS stop, v.n AS units, (SELECT sum(b.minutes) FROM u b WHERE b.grp = a.grp AND b.pos BETWEEN a.pos AND a.pos + v.n - 1) AS minutes FROM u a, (VALUES (2), (3), (4), (5)) v(n))
SELECT k.grp, start, stop, CAST(units AS INTEGER) AS units, round(minutes, 6) AS minutes, round(CASE WHEN minutes < 18 - 1e-9 OR minutes > 42 + 1e-9 THEN 1e5 + 100 * abs(minutes - 28) WHEN minutes BETWEEN 25 - 1e-9 AND 32 + 1e-9 THEN 0.5 * (minutes - 28) * (minutes - 28) ELSE 3 * (minutes - 28) * (minutes - 28) END + CASE WHEN stop = l.last THEN 0 WHEN stop % 4 = 0 THEN 8 ELSE 25 END, 4) AS cost
FROM k JOIN l USING (grp) WHERE stop <= l.last""")
def segment_candidates(spark, sf):
    u = _units(spark, sf)
    cuts = u.where("pos % 4 = 0").select("grp", "pos", F.lit("soft").alias("kind"))
    return sequence.segment_candidates(u.select("grp", "pos", "minutes"), cuts).select("grp", "start", "stop", "units", F.round("minutes", 6).alias("minutes"), F.round("cost", 4).alias("cost"))


@query(f"WITH RECURSIVE {SQL_SEGMENTS} SELECT grp, coalesce(segment, -1) AS segment, coalesce(start, -1) AS start, coalesce(stop, -1) AS stop, coalesce(units, -1) AS units, coalesce(round(minutes, 6), -1) AS minutes, feasible FROM segments")
def budgeted_segments(spark, sf):
    out = _segments(spark, sf).withColumn("minutes", F.round("minutes", 6))
    return out.fillna(-1, ["segment", "start", "stop", "units", "minutes"])


def _segments(spark, sf, units=None, arcs=None):
    units = _units(spark, sf) if units is None else units
    u = units.select("grp", "pos", "minutes")
    arcs = _arcs(spark, sf, units) if arcs is None else arcs
    cuts = arcs.select("grp", F.col("stop").alias("pos"), F.col("cut").alias("kind"))
    return sequence.budgeted_segments(stored(sequence.segment_candidates(u, cuts), "candidates"), u)


@query(f"WITH RECURSIVE {SQL_SEGMENTS} SELECT grp, count(minutes) AS segments, coalesce(round(avg(minutes), 6), -1) AS mean, coalesce(round(min(minutes), 6), -1) AS least, coalesce(round(max(minutes), 6), -1) AS most, coalesce(round(avg(CASE WHEN minutes BETWEEN 25 AND 32 THEN 1 WHEN minutes IS NOT NULL THEN 0 END), 6), -1) AS comfortable FROM segments GROUP BY 1")
def segment_stats(spark, sf):
    return sequence.segment_stats(_segments(spark, sf)).fillna(-1, ["mean", "least", "most", "comfortable"])


@query(f"WITH RECURSIVE {SQL_SEGMENTS} SELECT coalesce(a.cut, 'none') AS value, count(*) AS n FROM segments s LEFT JOIN arcs a ON a.grp = s.grp AND a.stop = s.stop WHERE s.feasible GROUP BY 1 ORDER BY n DESC, value LIMIT 8")
def cut_histogram(spark, sf):
    """What the segments end at."""
    units = _units(spark, sf)
    a = stored(_arcs(spark, sf, units).select("grp", "stop", "cut"), "arcs")  # made once, for the segments and for their ends
    s = _segments(spark, sf, units, a).where("feasible")
    return sequence.histogram(s.join(a, ["grp", "stop"], "left").withColumn("cut", F.coalesce("cut", F.lit("none"))), "cut")


@query("""WITH i AS (SELECT strftime(o.o_orderdate, '%Y-%m') AS part, 'person' AS kind, l.l_suppkey AS item FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey UNION ALL SELECT strftime(o_orderdate, '%Y-%m'), 'scene', o_custkey FROM orders),
f AS (SELECT kind, item, min(part) AS part FROM i GROUP BY 1, 2), p AS (SELECT DISTINCT part FROM i) SELECT p.part, count(*) FILTER (f.kind = 'person') AS people, count(*) FILTER (f.kind = 'scene') AS scenes, 2 * count(*) FILTER (f.kind = 'person') + count(*) FILTER (f.kind = 'scene') AS load FROM p LEFT JOIN f ON f.part = p.part GROUP BY 1""")
def first_occurrence_load(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey", F.date_format("o_orderdate", "yyyy-MM").alias("part"))
    people = table(spark, sf, "lineitem").join(o, F.col("l_orderkey") == F.col("o_orderkey")).select("part", F.lit("person").alias("kind"), F.col("l_suppkey").alias("item"))
    return sequence.first_occurrence_load(people.unionByName(o.select("part", F.lit("scene").alias("kind"), F.col("o_custkey").alias("item"))))


ROSTER_SQL = f"""{SQL_MENTIONS}, g AS (SELECT source AS season, name, count(DISTINCT seq) AS units, min(seq) AS first_seq FROM mentions GROUP BY 1, 2), o AS (SELECT name, count(DISTINCT seq) AS units_overall, arg_min(source, seq) AS first_group FROM mentions GROUP BY 1),
roster AS (SELECT g.season, g.name, g.units, g.first_seq, contains(g.name, 'tion') AS doubt, CASE WHEN g.units >= 10 THEN 'A' WHEN g.units >= 3 THEN 'B' ELSE 'C' END AS tier, o.units_overall, o.first_group, o.first_group = g.season AS debut FROM g JOIN o USING (name))"""


def _roster(spark, sf):
    d = docs(spark, sf)
    m = mentions(d).join(d.select("seq", F.col("source").alias("season")), "seq").select("season", "seq", "name", F.lit(False).alias("mentioned_only"), F.contains("name", F.lit("tion")).alias("doubt"))
    return sequence.roster(m)


@query(f"WITH {ROSTER_SQL} SELECT * FROM roster")
def season_roster(spark, sf):
    return _roster(spark, sf)


@query(f"WITH {ROSTER_SQL} SELECT season, count(*) FILTER (tier = 'A') AS tier_a, count(*) FILTER (tier = 'B') AS tier_b, count(*) FILTER (tier = 'C') AS tier_c, count(*) FILTER (debut) AS debuts, count(*) FILTER (doubt) AS doubtful FROM roster GROUP BY 1")
def season_totals(spark, sf):
    return sequence.roster_totals(_roster(spark, sf))


def calls(events: DataFrame) -> DataFrame:
    """The event log as a call log."""
    return events.select("ts", F.col("user_id").alias("seq"), F.col("event_type").alias("stage"), (F.col("event_id") % 3 + 1).alias("attempt"), F.when(F.col("event_type") == "error", F.col("props")).alias("error"), (F.col("event_type") == "error").alias("is_error"), F.col("value").alias("elapsed"), F.length("props").alias("chars"))


@query("SELECT event_type AS stage, count(*) AS calls, count(*) FILTER (event_id % 3 > 0) AS retries, count(*) FILTER (event_type = 'error') AS failures, round(sum(value), 2) AS elapsed, CAST(sum(length(props)) AS BIGINT) AS chars FROM events GROUP BY 1")
def usage_totals(spark, sf):
    return quality.usage(calls(table(spark, sf, "events")), "stage")


@query("SELECT strftime(date_trunc('day', ts), '%Y-%m-%d') AS start, count(*) AS calls, count(*) FILTER (event_type = 'error') AS errors, count(*) FILTER (event_id % 3 > 0) AS retries, round(avg(value), 6) AS elapsed FROM events GROUP BY 1")
def call_health_windows(spark, sf):
    return monitors.call_health(calls(table(spark, sf, "events"))).withColumn("start", F.date_format("start", "yyyy-MM-dd"))


@query("""WITH m AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) < INTERVAL 6 HOUR THEN 0 ELSE 1 END AS opens FROM events), s AS (SELECT *, sum(opens) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS session FROM m)
SELECT user_id, epoch_us(min(ts)) AS start_us, epoch_us(max(ts)) + 21600000000 AS stop_us, count(*) AS events FROM s GROUP BY user_id, session""")
def stall_sessions(spark, sf):
    return monitors.stalls(table(spark, sf, "events"), "6 hours", "1 hour", "ts", "user_id").select("user_id", F.unix_micros("start").alias("start_us"), F.unix_micros("stop").alias("stop_us"), "events")


@query("SELECT count(*) AS done, count(*) FILTER (event_type <> 'error') AS ok, count(*) FILTER (event_type = 'error') AS failed, round(epoch(max(ts)) - epoch(min(ts)), 3) AS elapsed, round(count(*) * 100 / 20000, 1) AS percent FROM events")
def progress_headline(spark, sf):
    log = table(spark, sf, "events").select("ts", (F.col("event_type") != "error").alias("passed"))
    return monitors.headline(log, 20000).select("done", "ok", "failed", F.round("elapsed", 3).alias("elapsed"), "percent")


@query("SELECT doc_id AS seq, source FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def incremental_units(spark, sf):
    """documents as a file stream; units that labels have finished are passed over."""
    import uuid

    base = f"{shared_folder(spark)}/incremental-{uuid.uuid4().hex}"
    d = table(spark, sf, "documents").select(F.col("doc_id").alias("seq"), "source")
    d.write.parquet(f"{base}/in")
    done = lambda: table(spark, sf, "labels").select(F.col("doc_id").alias("seq"), F.lit("x").alias("finished_at"), (F.col("quality") == 1).alias("passed"))
    work = lambda rows: rows.write.mode("append").parquet(f"{base}/out")
    monitors.incremental(spark.readStream.schema(d.schema).parquet(f"{base}/in"), done, work, f"{base}/checkpoint").awaitTermination()
    return spark.read.schema(d.schema).parquet(f"{base}/out")
