"""Queries that render reports, and further forms of operators that other queries use with fewer options."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from storyloom.functions.text import clip, label, numbered
from storyloom.operators import entities, mining, quality, reports, requests, segment, sequence, verify
from storyloom.plans import entity_queries, sequence_queries, text_queries
from storyloom.plans.common import SQL_MENTIONS, SQL_PARAS, docs, mentions, table
from storyloom.scratch import stored

Q: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        Q[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


SQL_HINTS = "t AS (SELECT conv_id AS seq, list(text ORDER BY turn) FILTER (role = 'user') AS f, list(text ORDER BY turn) FILTER (role = 'assistant') AS r FROM conversations GROUP BY 1)"
SQL_DIGEST = f"""{SQL_MENTIONS}, n AS (SELECT seq, name, min(pos) AS pos FROM mentions WHERE name IN (SELECT name FROM mentions GROUP BY 1 HAVING count(DISTINCT seq) >= 8) GROUP BY 1, 2), ns AS (SELECT seq, list(name ORDER BY pos) AS l FROM n GROUP BY 1), {SQL_HINTS},
d AS (SELECT doc_id AS seq, source, lang, replace(substr(text, 1, 90), chr(10), ' ') AS s, coalesce(l, []) AS l, coalesce(t.f, []) AS f, coalesce(t.r, []) AS r FROM documents LEFT JOIN ns ON ns.seq = doc_id LEFT JOIN t ON t.seq = doc_id)"""


@query(f"""WITH {SQL_DIGEST}, u AS (SELECT seq, 0 AS k, '[' || seq || '] ' || source AS line FROM d UNION ALL SELECT seq, 1, '    ' || trim(s, ' ') FROM d
UNION ALL SELECT seq, 2, '    ' || CASE WHEN len(l) = 0 THEN '-' ELSE array_to_string(l[1:5], ', ') END || ' | ' || source || ', ' || lang || ' | ' || lang FROM d
UNION ALL SELECT seq, 3, '    + ' || substr(array_to_string(f, '; '), 1, 120) FROM d WHERE len(f) > 0 UNION ALL SELECT seq, 4, '    - ' || substr(array_to_string(r, '; '), 1, 120) FROM d WHERE len(r) > 0)
SELECT seq, CAST(k AS INTEGER) AS k, line FROM u""")
def digest_report(spark: SparkSession, sf: str) -> DataFrame:
    """Documents as units, turns of the conversation of their number as what they set up and resolve."""
    turns = table(spark, sf, "conversations").select(F.col("conv_id").alias("seq"), F.col("turn").alias("pos"), "text", "role")
    units = sequence.timeline(docs(spark, sf), mentions(docs(spark, sf)))
    rows = sequence.timeline_details(units, foreshadows=turns.where("role = 'user'"), reveals=turns.where("role = 'assistant'"))
    rows = rows.select("seq", F.col("source").alias("title"), F.translate(F.substring("text", 1, 90), "\n", " ").alias("synopsis"), F.col("lang").alias("tone"), "names", F.array("source", "lang", "source").alias("scenes"), "foreshadows", "reveals")
    return reports.digest(rows, dash="-")


@query(f"""WITH {sequence_queries.ROSTER_SQL}, h AS (SELECT season, tier, count(*) AS n FROM roster GROUP BY 1, 2)
SELECT season, tier, '' AS nth, '## ' || season || ' ' || tier || ' (' || n || ')' AS line FROM h UNION ALL
SELECT season, tier, printf('%010d', 9999999999 - units) || ' ' || printf('%010d', first_seq) || ' ' || name, '- ' || name || CASE WHEN doubt THEN ' ?' ELSE '' END || CASE WHEN debut THEN ' *' ELSE '' END || ': ' || units || ' units from ' || first_seq FROM roster""")
def roster_report(spark, sf):
    return reports.roster(sequence_queries.season_roster(spark, sf))


SQL_HITS = f"{SQL_PARAS}, h AS (SELECT seq, para, unnest(regexp_extract_all(text, '({mining.longest_first(text_queries.SURE)})', 1)) AS word FROM paras)"


@query(f"""WITH {SQL_HITS}, n AS (SELECT word, seq, count(*) AS n FROM h GROUP BY 1, 2), t AS (SELECT word, CAST(sum(n) AS BIGINT) AS hits, count(*) AS units, min(seq) AS a, max(seq) AS b, list(seq || ' (' || n || ')' ORDER BY n DESC, seq)[1:20] AS top FROM n GROUP BY 1)
SELECT word, CAST(-1 AS BIGINT) AS seq, CAST(-1 AS INTEGER) AS para, CAST(0 AS INTEGER) AS k, '# ' || word AS line FROM t UNION ALL SELECT word, -1, -1, 1, '- ' || hits || ' hits in ' || units || ' units (' || a || ' to ' || b || ')' FROM t UNION ALL SELECT word, -1, -1, 2, '- densest: ' || array_to_string(top, ', ') FROM t
UNION ALL SELECT word, seq, 0, 0, '## ' || seq || ' [' || n || ']' FROM n UNION ALL SELECT DISTINCT h.word, h.seq, CAST(h.para AS INTEGER), 0, '[' || h.para || '] ' || p.text FROM h JOIN paras p ON p.seq = h.seq AND p.para = h.para""")
def dossier_report(spark, sf):
    p = stored(segment.paragraphs(table(spark, sf, "documents")), "paragraphs")
    return reports.dossier(mining.word_hits(p, text_queries.SURE, keep=("seq", "para")), p).fillna(-1, ["seq", "para"])


@query(f"""WITH g AS ({entity_queries.SQL['grid_prompts']}) SELECT DISTINCT target_id, CAST(-1 AS INTEGER) AS style_id, CAST(0 AS INTEGER) AS k, '## ' || target_id AS line FROM g
UNION ALL SELECT target_id, style_id, 0, '### ' || target_id || ' x ' || style_id FROM g UNION ALL SELECT target_id, style_id, 1, prompt FROM g""")
def prompt_report(spark, sf):
    return reports.prompts(entity_queries.grid_prompts(spark, sf)).fillna(-1, ["style_id"])


SQL_TIERS = f"{text_queries.SQL_SCORES}, x AS (SELECT seq, CASE WHEN miss > 0 THEN 'T1' WHEN verbatim_rate < 0.95 OR structure_score < 85 OR fidelity_score < 90 THEN 'T2' ELSE 'T3' END AS tier FROM s)"


@query(f"WITH {SQL_TIERS} SELECT tier, seq // 1000 AS chunk, tier || ': ' || string_agg(CAST(seq AS VARCHAR), ' ' ORDER BY seq) AS line FROM x GROUP BY 1, 2")
def tier_file(spark, sf):
    return reports.tier_lines(quality.tiers(text_queries._scores(spark, sf)))


@query("SELECT doc_id AS seq, n_chars FROM documents ORDER BY doc_id LIMIT 50")
def first_units(spark, sf):
    """The first fifty documents, a selection by number."""
    return segment.first_units(docs(spark, sf), 50).select("seq", "n_chars")


@query(f"WITH {SQL_PARAS} SELECT seq, CAST(para AS INTEGER) AS para, substr(text, 1, 40) AS line FROM paras")
def clipped_lines(spark, sf):
    """Every line of the documents on forty columns."""
    return segment.paragraphs(table(spark, sf, "documents")).select("seq", "para", clip(F.col("text"), 40).alias("line"))


@query(f"WITH {text_queries.MINED_SQL}, u AS (SELECT DISTINCT substr(s, 1, n) AS name, seq FROM b), r AS (SELECT u.*, row_number() OVER (PARTITION BY name ORDER BY seq) AS k FROM u JOIN mined USING (name)) SELECT name, seq FROM r WHERE k <= 200")
def mined_name_units(spark, sf):
    names = text_queries.name_mining(spark, sf)
    return mining.name_units(docs(spark, sf), names, text_queries.AFTER).select("name", F.explode("units").alias("seq"))


@query(f"""WITH {SQL_MENTIONS}, e AS (SELECT seq // 100 * 100 AS target, name FROM mentions), t AS (SELECT DISTINCT doc_id // 100 * 100 AS target FROM documents), c AS (SELECT t.target, m.name, count(*) AS n FROM t JOIN mentions m ON m.seq < t.target GROUP BY 1, 2),
r AS (SELECT *, row_number() OVER (PARTITION BY target ORDER BY n DESC, name) AS rank FROM c), g AS (SELECT target, string_agg(name, ', ' ORDER BY rank) AS names FROM r WHERE rank <= 400 GROUP BY 1),
b AS (SELECT doc_id, string_agg('[' || i || '] ' || x, chr(10) ORDER BY i) AS body FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS x, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM documents) GROUP BY 1)
SELECT d.doc_id AS seq, md5(concat_ws(chr(10) || chr(10), 'Known names: ' || g.names, CASE WHEN d.n_chars % 3 = 0 THEN 'Note: this unit also holds ' || d.lang || ', ' || d.source || '. Don''t make up events for titles without text.' END, 'No. ' || d.doc_id || ' ' || d.source || CASE WHEN d.n_chars % 3 = 0 THEN ' + ' || d.lang || ' + ' || d.source ELSE '' END, b.body)) AS request
FROM documents d JOIN b ON b.doc_id = d.doc_id LEFT JOIN g ON g.target = d.doc_id // 100 * 100""")
def request_with_registry(spark, sf):
    """Requests with the names known before each hundred of documents, and a notice where titles were merged."""
    d = docs(spark, sf).withColumn("target", F.floor(F.col("seq") / 100) * 100)
    known = requests.registry_before(mentions(d), d.select(F.col("target").alias("seq")).distinct())
    registry = known.groupBy("target").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("rank", "name"))), lambda x: x["name"]), ", ").alias("names"))
    merged = F.when(F.col("n_chars") % 3 == 0, F.array("lang", "source")).otherwise(F.array().cast("array<string>"))
    text = requests.request_text(F.col("names"), F.lit(None).cast("string"), label(F.col("seq"), F.col("source"), merged, "No. %d "), numbered(F.split("text", "\n")), requests.merge_notice(merged))
    return d.join(registry, "target", "left").select("seq", F.md5(text).alias("request"))


@query(f"""WITH {SQL_MENTIONS}, m AS (SELECT source AS season, seq, name FROM mentions WHERE pos % 2 = 0) SELECT season, name, count(DISTINCT seq) AS units, min(seq) AS first_seq FROM m GROUP BY 1, 2""")
def roster_without_mentions(spark, sf):
    """Every second mention is one in passing only, which does not count."""
    d = docs(spark, sf)
    m = mentions(d).join(d.select("seq", F.col("source").alias("season")), "seq").select("season", "seq", "name", (F.col("pos") % 2 == 1).alias("mentioned_only"), F.lit(False).alias("doubt"))
    return sequence.roster(m).select("season", "name", "units", "first_seq")


SQL_EVIDENCE = "SELECT user_id, 'quotes' AS kind, event_id // 10 AS seq, event_id AS pos, props AS value FROM events WHERE event_type = 'click' UNION ALL SELECT user_id, 'actions', event_id // 10, event_id, unnest([event_type, json_extract_string(props, '$.k')]) FROM events"


@query(f"SELECT * FROM ({SQL_EVIDENCE}) WHERE value <> ''")
def entity_evidence(spark, sf):
    """Quotes and actions of every user, chunk by chunk."""
    e = table(spark, sf, "events")
    rows = e.select("user_id", F.floor(F.col("event_id") / 10).alias("seq"), F.col("event_id").alias("pos"), F.when(F.col("event_type") == "click", F.col("props")).alias("quote"), F.array("event_type", F.get_json_object("props", "$.k")).alias("acts"))
    return entities.evidence(rows, "user_id", quotes="quote", actions="acts").select("user_id", "kind", F.inline("values"))


@query("""SELECT source AS scene, 'types' AS kind, doc_id AS seq, doc_id AS pos, lang AS value FROM documents UNION ALL SELECT source, 'times', doc_id, doc_id, 'h' || (n_chars % 24) FROM documents
UNION ALL SELECT d.source, 'events', d.doc_id, d.doc_id, unnest(c.l) FROM documents d JOIN (SELECT conv_id, list(role) AS l FROM conversations GROUP BY 1) c ON c.conv_id = d.doc_id""")
def scene_evidence(spark, sf):
    """Types, times and events of every source as a scene."""
    acts = table(spark, sf, "conversations").groupBy(F.col("conv_id").alias("seq")).agg(F.collect_list("role").alias("acts"))
    rows = docs(spark, sf).join(acts, "seq", "left").select(F.col("source").alias("scene"), "seq", F.col("seq").alias("pos"), "lang", F.concat(F.lit("h"), F.col("n_chars") % 24).alias("time"), "acts")
    return entities.evidence(rows, "scene", types="lang", times="time", events="acts").select("scene", "kind", F.inline("values"))


@query(f"WITH {SQL_MENTIONS} SELECT DISTINCT name, seq FROM mentions")
def entity_unit_sets(spark, sf):
    return entities.unit_sets(mentions(docs(spark, sf))).select("name", F.explode("units").alias("seq"))


@query(f"""WITH {SQL_PARAS}, t AS (SELECT conv_id AS seq, turn FROM conversations), q AS (SELECT t.seq, t.turn, regexp_replace(substr(p.text, 1, 40), '\\s+', '', 'g') AS q, t.turn + 2 AS claimed FROM t JOIN paras p ON p.seq = t.seq AND p.para = t.turn + 1),
h AS (SELECT q.seq, q.turn, min(p.para) AS least, max(CASE WHEN p.para = claimed THEN 1 ELSE 0 END) AS own FROM q JOIN paras p ON p.seq = q.seq AND contains(regexp_replace(p.text, '\\s+', '', 'g'), q.q) WHERE q.q <> '' GROUP BY 1, 2)
SELECT q.seq, q.turn, CASE WHEN q.q = '' THEN 'empty' ELSE 'exact' END AS status, CAST(CASE WHEN q.q = '' THEN -9 WHEN own = 1 THEN claimed ELSE least END AS INTEGER) AS para_found, coalesce(own, 0) = 1 AS para_correct FROM q LEFT JOIN h ON h.seq = q.seq AND h.turn = q.turn""")
def normalized_quotes(spark, sf):
    """Beginnings of lines with full-width marks, claimed a line too late: found in normal form."""
    p = stored(segment.paragraphs(table(spark, sf, "documents")), "paragraphs")
    turns = table(spark, sf, "conversations").select(F.col("conv_id").alias("seq"), "turn", (F.col("turn") + 1).cast("int").alias("para"))
    wide = F.translate(F.substring("text", 1, 40), ",.!?()", "，。！？（）")
    quotes = p.join(turns, ["seq", "para"]).select(F.xxhash64("seq", "turn").alias("qid"), "seq", "turn", (F.col("para") + 1).alias("para"), wide.alias("quote"))
    found = verify.check_quotes(quotes, p)
    return found.select("seq", "turn", "status", F.coalesce("para_found", F.lit(-9)).alias("para_found"), F.coalesce("para_correct", F.lit(False)).alias("para_correct"))


SQL_SAID = r"""t AS (SELECT conv_id AS seq, turn, role, 'So “' || replace(text, '"', ' ') || '” and “ok.” or “thing”' AS text, replace(text, '"', ' ') AS said FROM conversations),
s AS (SELECT seq, unnest(regexp_extract_all(text, '“([^“”"]{2,})', 1)) AS x FROM t), k AS (SELECT seq, regexp_replace(x, '\s+', '', 'g') AS f FROM s WHERE length(trim(x)) >= 7 OR (length(trim(x)) >= 2 AND regexp_matches(x, '[。！？…～~，,、；;：:]'))),
g AS (SELECT seq, string_agg(regexp_replace(said, '\s+', '', 'g'), '' ORDER BY turn) AS given FROM t WHERE role <> 'assistant' GROUP BY 1)"""


@query(f"WITH {SQL_SAID}, n AS (SELECT k.seq, count(*) AS speech, count(*) FILTER (contains(coalesce(g.given, ''), f)) AS covered FROM k LEFT JOIN g ON g.seq = k.seq GROUP BY 1) SELECT c.seq, coalesce(speech, 0) AS speech, coalesce(covered, 0) AS covered, coalesce(covered / speech, 1.0) AS coverage_rate FROM (SELECT DISTINCT conv_id AS seq FROM conversations) c LEFT JOIN n USING (seq)")
def speech_coverage(spark, sf):
    """Turns as speech in curly marks, with a quoted noun and a short word, against all turns but the assistant's, by the rules as they are."""
    c = table(spark, sf, "conversations").select(F.col("conv_id").alias("seq"), (F.col("turn") + 1).alias("para"), "role", F.translate("text", '"', " ").alias("said"))
    paragraphs = c.select("seq", "para", F.concat(F.lit("So “"), "said", F.lit("” and “ok.” or “thing”")).alias("text"))
    return verify.coverage(paragraphs, c.where("role <> 'assistant'").select("seq", "para", F.col("said").alias("quote"))).drop("missed")


@query("SELECT user_id, count(*) FILTER (event_id % 5 < 3) AS generic, count(*) AS names FROM events GROUP BY 1")
def generic_names(spark, sf):
    """Names that are never merged, by the lists as they are: one that is listed, one with a listed root, one marked as a group."""
    name = F.element_at(F.array(F.lit("众人"), F.lit("小丫头"), F.lit("客人（群体）"), F.concat(F.lit("u"), "user_id"), F.concat(F.lit("u"), "user_id")), (F.col("event_id") % 5 + 1).cast("int"))
    rows = table(spark, sf, "events").select("user_id", entities.generic(name).alias("is_generic"))
    return rows.groupBy("user_id").agg(F.count_if("is_generic").alias("generic"), F.count("*").alias("names"))
