"""Queries on rolled-up assets, references, reviews, logs and sinks."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from storyloom.functions.text import flat, slug, without_note
from storyloom.operators import assemble, entities, mining, quality, repair, requests, segment, sequence, verify
from storyloom.plans import entity_queries, sequence_queries, text_queries
from storyloom.plans.common import SQL_MENTIONS, SQL_PARAS, docs, mentions, table
from storyloom.scratch import shared_folder, stored
from storyloom.sources import readers
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


@query("SELECT json_extract_string(props, '$.k') AS alias, arg_max(CAST(user_id AS VARCHAR), event_id) AS owner FROM events GROUP BY 1")
def last_claimants(spark: SparkSession, sf: str) -> DataFrame:
    index = table(spark, sf, "events").select(F.col("user_id").cast("string").alias("canonical"), "event_id", F.array(F.get_json_object("props", "$.k")).alias("aliases"))
    return entities.last_claimant(index, "event_id")


@query(f"SELECT * FROM ({text_queries.SQL['newcomers_by_bucket']}) ORDER BY newcomers DESC, bucket LIMIT 8")
def hottest_buckets(spark, sf):
    return mining.hottest(text_queries.newcomers_by_bucket(spark, sf))


@query(f"""WITH {SQL_MENTIONS}, f AS (SELECT name, min(seq) AS first_seq FROM mentions GROUP BY 1), r AS (SELECT *, first_seq // 25 AS bucket, row_number() OVER (PARTITION BY first_seq // 25 ORDER BY first_seq, name) AS k FROM f)
SELECT bucket, string_agg(name, ',' ORDER BY k) AS names FROM r WHERE k <= 200 GROUP BY 1""")
def newcomer_names(spark, sf):
    names = mentions(docs(spark, sf)).groupBy("name").agg(F.min("seq").alias("first_seq"))
    return mining.newcomer_names(names, first=0).select("bucket", F.array_join("names", ",").alias("names"))


@query("SELECT doc_id AS seq, n_chars FROM documents WHERE n_chars < 800")
def short_units(spark, sf):
    return segment.short_units(docs(spark, sf).select("seq", "n_chars"), chars="n_chars")


@query("SELECT seq, EXISTS (SELECT 1 FROM documents d WHERE d.doc_id = seq) AS found FROM (VALUES (1), (5), (77), (1000000007)) v(seq) UNION ALL SELECT doc_id + 5000000000, true FROM documents WHERE doc_id BETWEEN 100 AND 150")
def selected_units(spark, sf):
    d = docs(spark, sf).select("seq")
    rows, absent = segment.selected(d, [1, 5, 77, 1_000_000_007])
    ranged = segment.in_range(d, 100, 150).select((F.col("seq") + 5_000_000_000).alias("seq"))
    return rows.union(ranged).withColumn("found", F.lit(True)).union(absent.withColumn("found", F.lit(False)))


@query("SELECT doc_id, CAST(10 + quality AS INTEGER) AS v FROM labels WHERE doc_id % 2 = 0 UNION ALL SELECT doc_id, CAST(quality AS INTEGER) FROM labels WHERE doc_id % 3 <> 0 AND doc_id % 2 <> 0")
def manifest_upsert(spark, sf):
    rows = table(spark, sf, "labels")
    done = rows.where("doc_id % 2 = 0").select("doc_id", (F.col("quality") + 10).cast("int").alias("v"))
    return readers.upserted(rows.where("doc_id % 3 <> 0").select("doc_id", F.col("quality").cast("int").alias("v")), done, "doc_id")


@query("SELECT source, count(*) AS n, round(avg(n_chars), 6) AS mean, quantile_cont(n_chars, 0.5) AS median, min(n_chars) AS least, max(n_chars) AS most FROM documents GROUP BY 1")
def length_stats(spark, sf):
    return sequence.length_stats(docs(spark, sf), "n_chars", "source")


@query("SELECT strftime(date_trunc('day', ts), '%Y-%m-%d') AS start, count(*) AS done, count(*) FILTER (event_type <> 'error') AS ok, count(*) FILTER (event_type = 'error') AS failed FROM events GROUP BY 1")
def progress_windows(spark, sf):
    log = table(spark, sf, "events").select("ts", (F.col("event_type") != "error").alias("passed"))
    return monitors.progress(log).withColumn("start", F.date_format("start", "yyyy-MM-dd"))


@query(f"""WITH {SQL_MENTIONS}, s AS (SELECT conv_id AS seq, regexp_extract(text, '^[^ ,.]*') AS name FROM conversations WHERE role <> 'system' UNION SELECT conv_id, regexp_extract(text, '[^ ,.]*.$') FROM conversations)
SELECT DISTINCT seq, name FROM s WHERE trim(name) <> '' AND NOT EXISTS (SELECT 1 FROM mentions m WHERE m.seq = s.seq AND m.name = s.name)""")
def missing_characters(spark, sf):
    c = table(spark, sf, "conversations").withColumnRenamed("conv_id", "seq")
    speakers = c.where("role <> 'system'").select("seq", F.regexp_extract("text", "^[^ ,.]*", 0).alias("name"))
    attendees = c.select("seq", F.regexp_extract("text", "[^ ,.]*.$", 0).alias("name"))
    return repair.missing_characters(speakers, attendees, mentions(docs(spark, sf)).select("seq", "name").distinct()).select("seq", "name")


@query("SELECT conv_id AS seq, role AS stage, max(turn) AS round, CAST(arg_max(length(text), turn) AS INTEGER) AS score FROM conversations GROUP BY 1, 2")
def review_rounds(spark, sf):
    c = table(spark, sf, "conversations")
    documents = c.groupBy(F.col("conv_id").alias("seq")).agg(F.array_sort(F.collect_list(F.struct(F.col("turn").alias("round"), F.col("role").alias("stage"), F.length("text").alias("score")))).alias("reviews"))
    return quality.latest_reviews(quality.reviews(documents)).select("seq", "stage", "round", "score")


@query("""WITH c AS (SELECT conv_id AS seq, role, turn, text, row_number() OVER (PARTITION BY conv_id, role ORDER BY turn) - 1 AS pos FROM conversations),
q AS (SELECT seq, CASE role WHEN 'user' THEN 'dialogues' WHEN 'assistant' THEN 'monologues' ELSE 'narration' END AS field, CAST(pos AS INTEGER) AS pos, CAST(turn AS INTEGER) AS para, text AS quote FROM c
UNION ALL SELECT seq, 'characters.appearance_quotes', CAST(row_number() OVER (PARTITION BY seq ORDER BY turn) - 1 AS INTEGER), NULL, role FROM c UNION ALL SELECT seq, 'scenes.description_quotes', 0, NULL, min(role) FROM c GROUP BY seq)
SELECT seq, field, pos, coalesce(para, -1) AS para, md5(quote) AS quote FROM q""")
def quote_tables(spark, sf):
    c = table(spark, sf, "conversations").withColumnRenamed("conv_id", "seq")
    ordered = lambda when, item: F.transform(F.array_sort(F.collect_list(F.when(when, F.struct("turn", item.alias("x"))))), lambda x: x["x"])
    spoken = F.struct("text", F.col("turn").alias("para"))
    role = F.col("role")
    analysis = F.struct(ordered(role == "user", spoken).alias("dialogues"), ordered(role == "assistant", spoken).alias("monologues"), ordered(~role.isin("user", "assistant"), spoken).alias("narration"), ordered(F.lit(True), F.struct(F.array("role").alias("appearance_quotes"))).alias("characters"), F.array(F.struct(F.array(F.min("role")).alias("description_quotes"))).alias("scenes"))
    return verify.quote_tables(c.groupBy("seq").agg(analysis.alias("analysis"))).select("seq", "field", "pos", F.coalesce("para", F.lit(-1)).alias("para"), F.md5("quote").alias("quote"))


@query(f"""WITH {SQL_MENTIONS}, l AS (SELECT max(doc_id) AS last FROM documents), r AS (SELECT unnest(range(0, (SELECT last // 25 + 1 FROM l))) AS n),
s AS (SELECT n, n * 25 AS start, n * 25 + 24 AS stop FROM r), m AS (SELECT seq // 25 AS n, string_agg(DISTINCT name, ',' ORDER BY name) AS names FROM mentions GROUP BY 1), d AS (SELECT doc_id // 25 AS n, string_agg(DISTINCT source, ',' ORDER BY source) AS names FROM documents GROUP BY 1)
SELECT s.start, s.stop, printf('S01E%02d', s.n + 1) AS code, coalesce(m.names, '') AS people, coalesce(d.names, '') AS scenes FROM s LEFT JOIN m USING (n) LEFT JOIN d USING (n)""")
def segment_assets(spark, sf):
    d = docs(spark, sf)
    last = d.agg(F.max("seq")).first()[0] or 0
    ranges = spark.range(last // 25 + 1).select((F.col("id") * 25).alias("start"), (F.col("id") * 25 + 24).alias("stop"), F.lit(1).alias("season"), (F.col("id") + 1).alias("segment"))
    coded = sequence.segment_codes(ranges).select("start", "stop", "code")
    out = sequence.segment_rollup(coded, people=mentions(d), scenes=d.select("seq", F.col("source").alias("name")))
    return out.select("start", "stop", "code", F.array_join("people", ",").alias("people"), F.array_join("scenes", ",").alias("scenes"))


@query(f"SELECT count(*) AS parts, round(avg(load), 6) AS mean, max(load) AS most FROM ({sequence_queries.SQL['first_occurrence_load']})")
def load_summary(spark, sf):
    return sequence.load_summary(sequence_queries.first_occurrence_load(spark, sf))


@query(f"SELECT * FROM ({sequence_queries.SQL['first_occurrence_load']}) ORDER BY load DESC, part LIMIT 12")
def heaviest_parts(spark, sf):
    return sequence.heaviest(sequence_queries.first_occurrence_load(spark, sf))


@query("SELECT lang AS value, count(*) AS n FROM documents WHERE lang IS NOT NULL GROUP BY 1 ORDER BY n DESC, value LIMIT 8")
def tone_histogram(spark, sf):
    return sequence.histogram(docs(spark, sf), "lang")


@query(f"""WITH {SQL_MENTIONS}, n AS (SELECT name, count(DISTINCT seq) AS units FROM mentions GROUP BY 1)
SELECT name, units, units >= 15 AS has_dossier, EXISTS (SELECT 1 FROM mentions m WHERE m.name = n.name AND m.source = 'web') AS has_card FROM n""")
def presence_flags(spark, sf):
    m = mentions(docs(spark, sf).select("seq", "text", "source")).select("seq", "name")
    web = mentions(docs(spark, sf).where("source = 'web'"))
    counts = m.groupBy("name").agg(F.count_distinct("seq").alias("units"))
    return entities.flagged(counts, "name", has_dossier=mining.spans(m.withColumnRenamed("name", "item"), 15).select(F.col("item").alias("name")), has_card=web)


@query(f"""WITH h AS (SELECT doc_id AS seq, unnest(regexp_extract_all(replace(text, 'other', chr(1)), '({mining.longest_first(text_queries.WORDS)})', 1)) AS word FROM documents), n AS (SELECT word, seq, count(*) AS n FROM h GROUP BY 1, 2), r AS (SELECT *, row_number() OVER (PARTITION BY word ORDER BY n DESC, seq) AS rank FROM n)
SELECT word, seq, n, CAST(rank AS INTEGER) AS rank FROM r WHERE rank <= 40""")
def densest_units(spark, sf):
    return mining.densest(mining.word_hits(docs(spark, sf), text_queries.WORDS, ["other"]))


@query(f"""WITH {SQL_MENTIONS}, n AS (SELECT name, count(DISTINCT seq) AS units, min(seq) AS first_seq FROM mentions GROUP BY 1 HAVING count(DISTINCT seq) >= 5), r AS (SELECT *, row_number() OVER (ORDER BY units DESC, first_seq, name) AS k FROM n)
SELECT name, units, first_seq, printf('c%03d_', k) || substr(name, 1, 20) AS id FROM r""")
def ranked_entities(spark, sf):
    n = mentions(docs(spark, sf)).groupBy("name").agg(F.count_distinct("seq").alias("units"), F.min("seq").alias("first_seq")).where("units >= 5")
    return entities.ranked_ids(n, F.col("name"), F.desc("units"), "first_seq", "name")


@query(f"""WITH {SQL_MENTIONS}, n AS (SELECT name, count(*) AS n FROM mentions GROUP BY 1 HAVING count(*) >= 10 AND name NOT LIKE 'A%'), c AS (SELECT substr(name, 1, 3) AS canonical, name FROM n)
SELECT canonical, count(*) AS frequent, string_agg(name, ',' ORDER BY name) AS names FROM c GROUP BY 1 HAVING count(*) > 1""")
def suspicious_clusters(spark, sf):
    n = mentions(docs(spark, sf)).groupBy("name").agg(F.count("*").alias("n"))
    canonical = n.select("name", F.substring("name", 1, 3).alias("canonical"))
    return entities.suspicious(canonical, n, n.where("name LIKE 'A%'").select("name")).select("canonical", "frequent", F.array_join("names", ",").alias("names"))


@query(f"""WITH {sequence_queries.SQL_CURVE}, i2 AS (SELECT DISTINCT u.grp, u.pos, d.lang || '-' || (d.n_chars % 7) AS item FROM u JOIN documents d ON d.doc_id = u.seq),
c2 AS (SELECT a.grp, a.pos, i.item, count(*) FILTER (i.pos <= a.pos) >= 2 AS p, count(*) FILTER (i.pos > a.pos) >= 2 AS n FROM u a JOIN i2 i ON i.grp = a.grp AND i.pos BETWEEN a.pos - 7 AND a.pos + 8 GROUP BY 1, 2, 3),
k2 AS (SELECT grp, pos, count(*) AS either, count(*) FILTER (p AND n) AS both FROM c2 WHERE p OR n GROUP BY 1, 2),
curve2 AS (SELECT u.grp, u.pos, CASE WHEN u.pos = l.last THEN 0.0 WHEN k.either > 0 THEN 1 - k.both / k.either ELSE 0.0 END AS change FROM u JOIN l USING (grp) LEFT JOIN k2 k ON k.grp = u.grp AND k.pos = u.pos)
SELECT a.grp, a.pos, round(0.65 * a.change + 0.35 * b.change, 9) AS change FROM curve a JOIN curve2 b ON b.grp = a.grp AND b.pos = a.pos""")
def blended_change(spark, sf):
    u = sequence_queries._units(spark, sf)
    d = table(spark, sf, "documents").select(F.col("doc_id").alias("seq"), F.concat_ws("-", "lang", (F.col("n_chars") % 7).cast("string")).alias("item"))
    scenes = sequence.change_curve(u.join(d, "seq").select("grp", "pos", "item"), u.select("grp", "pos"), least=2)
    return sequence.blended(sequence_queries._curve(spark, sf), scenes).withColumn("change", F.round("change", 9))


@query(f"WITH {sequence_queries.SQL_CURVE} SELECT round(avg(change), 9) AS mean, round(quantile_cont(change, 0.85), 9) AS p85 FROM curve")
def change_stats(spark, sf):
    return sequence.change_stats(sequence_queries._curve(spark, sf))


def _book_lines(spark, sf):
    """Each source as a raw book: a numbered title before every document's lines."""
    d = table(spark, sf, "documents")
    titled = d.select("source", "doc_id", F.concat(F.lit("第"), "doc_id", F.lit("章 "), "lang", F.lit("\n"), "text").alias("text"))
    lines = titled.select(F.col("source").alias("doc"), "doc_id", F.posexplode(F.split("text", "\n")).alias("at", "text"))
    return lines.select("doc", (F.col("doc_id") * 1_000_000 + F.col("at")).alias("line_no"), "text")


SQL_BOOK = r"""b AS (SELECT source AS doc, doc_id, lang, unnest(string_split(text, chr(10))) AS line FROM documents), t AS (SELECT doc, doc_id, lang, regexp_replace(line, '^[\s\x{A0}\x{2000}-\x{200A}\x{3000}\x{85}\x{2028}\x{2029}\x{202F}\x{205F}\x{1680}]+|[\s\x{A0}\x{2000}-\x{200A}\x{3000}\x{85}\x{2028}\x{2029}\x{202F}\x{205F}\x{1680}]+$', '', 'g') AS line FROM b),
un AS (SELECT doc, doc_id, row_number() OVER (PARTITION BY doc ORDER BY doc_id) AS seq, lang AS title, count(*) FILTER (line <> '') AS paragraph_count, CAST(coalesce(sum(length(line)) FILTER (line <> ''), 0) AS INTEGER) AS char_count FROM t GROUP BY doc, doc_id, lang)"""


@query(f"WITH {SQL_BOOK} SELECT doc, CAST(seq AS INTEGER) AS seq, printf('ch%04d', seq) AS chapter_id, CAST(doc_id AS INTEGER) AS declared_num, title, false AS is_merged, CAST(paragraph_count AS INTEGER) AS paragraph_count, char_count FROM un")
def book_units(spark, sf):
    lines = segment.classify_lines(_book_lines(spark, sf), segment.is_title(F.col("text")))
    return segment.units(lines).select("doc", "seq", "chapter_id", "declared_num", "title", "is_merged", "paragraph_count", "char_count")


@query(f"WITH {SQL_BOOK} SELECT doc, count(*) AS title_line_count, count(*) AS unit_count, CAST(0 AS BIGINT) AS merged_unit_count, CAST(min(doc_id) AS INTEGER) AS declared_num_min, CAST(max(doc_id) AS INTEGER) AS declared_num_max, CAST(sum(char_count) AS BIGINT) AS total_chars FROM un GROUP BY 1")
def corpus_meta(spark, sf):
    return segment.corpus_meta(segment.units(segment.classify_lines(_book_lines(spark, sf), segment.is_title(F.col("text")))))


SPOKEN = "concat(substr(text, 1, 30), '\"', substr(text, 31, 20), '\"', substr(text, 51))"


@query("""SELECT conv_id, turn, CASE WHEN regexp_matches(substr(text, 1, 30), '[A-Z][a-z]{3,}') AND NOT regexp_matches(substr(text, 51), '[A-Z][a-z]{3,}') THEN 'very likely' WHEN regexp_matches(substr(text, 51), '[A-Z][a-z]{3,}') THEN 'possible' ELSE 'undecided' END AS speaker FROM conversations WHERE length(text) > 50 AND NOT contains(text, '"') AND NOT contains(text, '”')""")
def likely_speakers(spark, sf):
    """Who may speak the 31st to 50th character of each turn."""
    c = table(spark, sf, "conversations").where("length(text) > 50 AND NOT contains(text, '\"') AND NOT contains(text, '”')").withColumn("text", F.expr(SPOKEN))
    return c.select("conv_id", "turn", mining.likely_speaker(F.col("text"), F.instr("text", '"'), "[A-Z][a-z]{3,}").alias("speaker"))


@query("SELECT user_id, count(*) AS n, CAST(sum(CASE WHEN event_type = 'view' THEN 3 ELSE 0 END) AS BIGINT) AS noted FROM events GROUP BY 1")
def names_without_notes(spark, sf):
    e = table(spark, sf, "events").withColumn("name", F.concat("user_id", F.when(F.col("event_type") == "view", F.lit("(in passing)")).otherwise(F.lit(""))))
    return e.groupBy(without_note(F.col("name")).cast("long").alias("user_id")).agg(F.count("*").alias("n"), F.sum(F.when(F.contains("name", F.lit("(")), 3).otherwise(0)).alias("noted"))


@query(f"""WITH {SQL_PARAS}, r AS (SELECT conv_id AS seq, turn, CAST(turn + 1 AS INTEGER) AS para, length(text) % 3 AS kind, length(text) % 4 AS q FROM conversations), x AS (SELECT r.*, p.text AS p, regexp_extract_all(p.text, '([A-Z][a-z]+)', 1) AS spans FROM r LEFT JOIN paras p ON p.seq = r.seq AND p.para = r.para)
SELECT seq, turn, CASE WHEN p IS NULL THEN 'para out of range' WHEN kind = 0 AND q >= len(spans) THEN 'q out of range' WHEN kind = 1 AND NOT contains(p, 'the') THEN 'not in paragraph' END AS error,
CASE WHEN p IS NULL THEN NULL WHEN kind = 0 THEN CASE WHEN q < len(spans) THEN spans[q + 1] END WHEN kind = 1 THEN CASE WHEN contains(p, 'the') THEN 'the' END ELSE p END AS resolved FROM x""")
def reference_kinds(spark, sf):
    """References of all three kinds: to a span, to a substring, to a paragraph."""
    kind = F.length("text") % 3
    refs = table(spark, sf, "conversations").select(F.col("conv_id").alias("seq"), "turn", (F.col("turn") + 1).cast("int").alias("para"), F.when(kind == 0, F.length("text") % 4).alias("q"), F.when(kind == 1, F.lit("the")).alias("text"))
    return verify.position_refs(refs, segment.paragraphs(table(spark, sf, "documents")), "([A-Z][a-z]+)").select("seq", "turn", "error", "resolved")


@query(f"""WITH {SQL_PARAS}, r AS (SELECT conv_id AS seq, turn, turn + 1 AS para FROM conversations), x AS (SELECT r.seq, p.text FROM r LEFT JOIN paras p ON p.seq = r.seq AND p.para = r.para),
g AS (SELECT seq, regexp_replace(coalesce(string_agg(text, '' ORDER BY para), ''), '\\s+', '', 'g') AS given FROM (SELECT r.seq, p.text, p.para FROM r JOIN paras p ON p.seq = r.seq AND p.para = r.para) GROUP BY 1),
s AS (SELECT seq, unnest(regexp_extract_all(text, '([A-Z][^.]+)', 1)) AS span FROM paras), k AS (SELECT s.seq, count(*) AS speech, count(*) FILTER (contains(coalesce(g.given, ''), regexp_replace(s.span, '\\s+', '', 'g'))) AS covered FROM s LEFT JOIN g ON g.seq = s.seq GROUP BY 1)
SELECT x.seq, count(*) FILTER (text IS NOT NULL AND regexp_replace(text, '\\s+', '', 'g') <> '') AS total, count(*) FILTER (text IS NULL) AS errors, coalesce(any_value(k.covered / k.speech), 1.0) AS coverage_rate, count(*) FILTER (text IS NULL) = 0 AND coalesce(any_value(k.covered / k.speech), 1.0) >= 0.95 AS passed FROM x LEFT JOIN k ON k.seq = x.seq GROUP BY 1""")
def assembled_units(spark, sf):
    """A reference to a paragraph for each turn, expanded, put together and verified by unit."""
    refs = table(spark, sf, "conversations").select(F.col("conv_id").alias("seq"), F.lit("dialogues").alias("field"), F.col("turn").alias("pos"), (F.col("turn") + 1).cast("int").alias("para"), F.lit(None).cast("int").alias("q"), F.lit(None).cast("string").alias("text"))
    paras = segment.paragraphs(table(spark, sf, "documents"))
    quotes, rejects = assemble.expanded(refs, paras)
    out = assemble.verified(quotes, paras, rejects, pattern="([A-Z][^.]+)", norm=flat, speech=lambda s: s.isNotNull())
    return out.select("seq", "total", "errors", "coverage_rate", "passed")


@query("SELECT conv_id AS seq, count(*) AS quotes, CAST(sum(length(text)) AS BIGINT) AS chars, count(DISTINCT role) AS fields FROM conversations GROUP BY 1")
def assembled_documents(spark, sf):
    quotes = table(spark, sf, "conversations").select(F.col("conv_id").alias("seq"), F.col("role").alias("field"), F.col("turn").alias("pos"), F.col("turn").alias("para"), F.col("text").alias("quote"))
    fields = assemble.documents(quotes).select("seq", F.size("fields").cast("long").alias("fields"), F.flatten(F.map_values("fields")).alias("q"))
    return fields.select("seq", F.size("q").cast("long").alias("quotes"), F.aggregate("q", F.lit(0).cast("long"), lambda a, x: a + F.length(x["text"])).alias("chars"), "fields")


@query(f"""WITH {SQL_MENTIONS}, dup AS (SELECT seq, count(*) AS n FROM (SELECT seq, name FROM mentions GROUP BY 1, 2 HAVING count(*) > 1) GROUP BY 1), sp AS (SELECT DISTINCT conv_id AS seq, regexp_extract(text, '^[^ ,.]*') AS name FROM conversations WHERE role = 'user'), att AS (SELECT DISTINCT conv_id AS seq, regexp_extract(text, '^[^ ,.]*') AS name FROM conversations WHERE role <> 'user'),
gh AS (SELECT seq, count(*) AS n FROM sp WHERE NOT EXISTS (SELECT 1 FROM mentions m WHERE m.seq = sp.seq AND m.name = sp.name) GROUP BY 1), un AS (SELECT seq, count(*) AS n FROM att WHERE NOT EXISTS (SELECT 1 FROM mentions m WHERE m.seq = att.seq AND m.name = att.name) GROUP BY 1),
rv AS (SELECT conv_id AS seq, count(DISTINCT role) AS stages, min(length(text)) AS len, count(*) AS calls FROM conversations GROUP BY 1),
f AS (SELECT d.doc_id AS seq, CASE WHEN n_chars % 5 <> 0 THEN text END AS synopsis, l.toxic AS miss, n_chars % 2 AS near, CASE WHEN n_chars % 7 = 0 THEN 0.9 ELSE 1.0 END AS rate, CASE WHEN n_chars % 11 = 0 THEN 0.8 ELSE 1.0 END AS cov, CASE WHEN l.quality = 1 THEN 90 END AS st, coalesce(dup.n, 0) AS dup, coalesce(gh.n, 0) AS gh, coalesce(un.n, 0) AS un, coalesce(rv.stages, 0) AS stages, coalesce(rv.len, 0) AS len, coalesce(rv.calls, 0) AS calls, d.doc_id % 3 = 0 AS manual
FROM documents d JOIN labels l ON l.doc_id = d.doc_id LEFT JOIN dup ON dup.seq = d.doc_id LEFT JOIN gh ON gh.seq = d.doc_id LEFT JOIN un ON un.seq = d.doc_id LEFT JOIN rv ON rv.seq = d.doc_id)
SELECT seq, array_to_string(list_filter([CASE WHEN synopsis IS NULL THEN 'synopsis missing' END, CASE WHEN length(synopsis) < 40 THEN 'synopsis short' END, CASE WHEN length(synopsis) > 0 AND NOT contains('.!?', right(synopsis, 1)) THEN 'synopsis truncated' END, CASE WHEN miss > 0 THEN 'fabricated' END, CASE WHEN near > 0 THEN 'reworded' END, CASE WHEN rate < 0.95 THEN 'verbatim low' END, CASE WHEN cov < 0.9 THEN 'coverage low' END, CASE WHEN dup > 0 THEN 'duplicate names' END, CASE WHEN un > 0 THEN 'unregistered attendees' END, CASE WHEN gh > 0 THEN 'ghost speakers' END, CASE WHEN stages < 2 THEN 'review missing' END, CASE WHEN st IS NULL THEN 'score missing' END, CASE WHEN len < 100 THEN 'review short' END, CASE WHEN NOT manual AND calls < 3 THEN 'calls few' END], lambda x: x IS NOT NULL), ',') AS problems FROM f""")
def unit_validation(spark, sf):
    """All problems of labelled documents as analysed units."""
    d, c = table(spark, sf, "documents"), table(spark, sf, "conversations").withColumnRenamed("conv_id", "seq")
    units = table(spark, sf, "labels").join(d, "doc_id").withColumnRenamed("doc_id", "seq")
    checked = units.select("seq", (F.col("n_chars") % 2).alias("near"), F.col("toxic").cast("long").alias("miss"), F.when(F.col("n_chars") % 7 == 0, 0.9).otherwise(1.0).alias("verbatim_rate"))
    covered = units.select("seq", F.when(F.col("n_chars") % 11 == 0, 0.8).otherwise(1.0).alias("coverage_rate"))
    named = lambda rows: rows.select("seq", F.regexp_extract("text", "^[^ ,.]*", 0).alias("name"))
    facts = assemble.facts_for_validation(checked, covered, mentions(docs(spark, sf)), named(c.where("role = 'user'")), named(c.where("role <> 'user'")), c.select("seq", F.col("role").alias("stage"), "text"))
    score = F.when(F.col("quality") == 1, 90)
    own = units.select("seq", F.when(F.col("n_chars") % 5 != 0, F.col("text")).alias("synopsis"), score.alias("structure_score"), score.alias("fidelity_score"), (F.col("seq") % 3 == 0).alias("is_manual"))
    return quality.validation(own.join(facts, "seq"), ends=".!?").select("seq", F.array_join("problems", ",").alias("problems"))


@query("""WITH e AS (SELECT user_id, event_id // 10 AS seq, event_id AS pos, event_type AS value FROM events WHERE event_type <> 'view')
SELECT CAST(user_id % 50 AS VARCHAR) AS name, count(*) AS states, md5(string_agg(seq || ':' || value, '|' ORDER BY seq, pos)) AS digest FROM e GROUP BY 1""")
def entity_details(spark, sf):
    """States of entities with their units, users resolved to the first fifty."""
    e = table(spark, sf, "events").select(F.floor(F.col("event_id") / 10).alias("seq"), F.col("event_id").alias("pos"), F.col("user_id").cast("string").alias("name"), F.when(F.col("event_type") != "view", F.col("event_type")).alias("state"))
    names = table(spark, sf, "events").select(F.col("user_id").cast("string").alias("name"), (F.col("user_id") % 50).cast("string").alias("canonical")).distinct()
    out = entities.details(e, "name", names, states="state").where("states IS NOT NULL")
    return out.select("name", F.size("states").cast("long").alias("states"), F.md5(F.array_join(F.transform("states", lambda x: F.concat(x["seq"], F.lit(":"), x["value"])), "|")).alias("digest"))


@query(f"""WITH {SQL_MENTIONS}, n AS (SELECT source AS scene, lower(name) AS value, count(*) AS n FROM mentions GROUP BY 1, 2) SELECT scene, count(*) AS attendees, md5(string_agg(value || '=' || n, ',' ORDER BY n DESC, value)) AS digest FROM n GROUP BY 1""")
def scene_attendees(spark, sf):
    """Attendee counts by scene, names resolved to lower case."""
    m = mentions(docs(spark, sf).select("seq", "text")).join(docs(spark, sf).select("seq", F.col("source").alias("scene")), "seq")
    names = m.select("name", F.lower("name").alias("canonical")).distinct()
    out = entities.counted(m, "scene", "name", names)
    return out.select("scene", F.size("counts").cast("long").alias("attendees"), F.md5(F.array_join(F.transform("counts", lambda x: F.concat(x["value"], F.lit("="), x["n"])), ",")).alias("digest"))


@query("""SELECT d.doc_id AS seq, coalesce(s.scenes, '') AS scenes, coalesce(f.l, '') AS foreshadows FROM documents d LEFT JOIN (SELECT conv_id, string_agg(role, ',' ORDER BY first) AS scenes FROM (SELECT conv_id, role, min(turn) AS first FROM conversations GROUP BY 1, 2) GROUP BY 1) s ON s.conv_id = d.doc_id
LEFT JOIN (SELECT conv_id, string_agg(CAST(length(text) AS VARCHAR), ',' ORDER BY turn) AS l FROM conversations WHERE role = 'user' GROUP BY 1) f ON f.conv_id = d.doc_id""")
def timeline_details(spark, sf):
    c = table(spark, sf, "conversations").withColumnRenamed("conv_id", "seq").withColumnRenamed("turn", "pos")
    out = sequence.timeline_details(docs(spark, sf).select("seq"), c.select("seq", "pos", F.col("role").alias("name")), foreshadows=c.where("role = 'user'").select("seq", "pos", F.length("text").cast("string").alias("text")))
    return out.select("seq", F.array_join("scenes", ",").alias("scenes"), F.array_join("foreshadows", ",").alias("foreshadows"))


@query("SELECT source AS season, count(*) FILTER (u >= 3) AS scenes FROM (SELECT source, lang, count(DISTINCT doc_id) AS u FROM documents GROUP BY 1, 2) GROUP BY 1")
def season_scenes(spark, sf):
    return sequence.frequent_scenes(docs(spark, sf).select(F.col("source").alias("season"), "seq", F.col("lang").alias("name")))


@query("SELECT event_type AS stage, CAST(sum(length(props)) AS BIGINT) AS prompt_tokens, CAST(sum(length(props) % 7) AS BIGINT) AS completion_tokens FROM events GROUP BY 1")
def token_usage(spark, sf):
    e = table(spark, sf, "events").select(F.col("event_type").alias("stage"), F.length("props").alias("prompt_tokens"), (F.length("props") % 7).alias("completion_tokens"))
    return quality.token_usage(e, "stage")


@query("SELECT count(*) AS units, count(*) FILTER (toxic > 0) AS repaired FROM labels")
def repaired_units(spark, sf):
    return quality.repaired_units(table(spark, sf, "labels").withColumnRenamed("toxic", "repair_rounds"))


@query("SELECT count(*) AS missing, CAST(ceil(count(*) / 7) AS BIGINT) AS batches FROM region, nation WHERE n_regionkey <> r_regionkey")
def missing_batches(spark, sf):
    return requests.batches(entity_queries.missing_cells(spark, sf), 7)


@query("SELECT d.doc_id AS seq, md5(concat_ws(chr(10) || chr(10), 'Review: ' || CASE WHEN l.quality = 1 THEN 'structure' ELSE 'fidelity' END, d.text, 'Analysis: ' || d.lang)) AS review, md5(concat_ws(chr(10) || chr(10), 'Repair: ' || CASE WHEN l.toxic = 1 THEN 'fabricated; verbatim' ELSE 'verbatim' END, d.text, 'Analysis: ' || d.lang)) AS repair FROM documents d JOIN labels l USING (doc_id)")
def review_texts(spark, sf):
    d = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id")
    stage, reasons = F.when(F.col("quality") == 1, "structure").otherwise("fidelity"), F.when(F.col("toxic") == 1, F.array(F.lit("fabricated"), F.lit("verbatim"))).otherwise(F.array(F.lit("verbatim")))
    return d.select(F.col("doc_id").alias("seq"), F.md5(requests.review_text(stage, F.col("text"), F.col("lang"))).alias("review"), F.md5(requests.repair_text(F.col("text"), F.col("lang"), reasons)).alias("repair"))


def _folder(spark, name):
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


@query("SELECT '## ' || source AS value, CAST(1 AS BIGINT) AS n FROM documents GROUP BY source UNION ALL SELECT '- ' || lang || ': ' || count(*), count(*) FROM documents GROUP BY source, lang")
def report_sink(spark, sf):
    """A report with a heading for each source, written as text and read back."""
    d = table(spark, sf, "documents")
    heads = d.select("source").distinct().select("source", F.lit(0).alias("kind"), F.lit("").alias("lang"), F.concat(F.lit("## "), "source").alias("line"))
    body = d.groupBy("source", "lang").agg(F.count("*").alias("n")).select("source", F.lit(1).alias("kind"), "lang", F.concat(F.lit("- "), "lang", F.lit(": "), "n").alias("line"))
    path = _folder(spark, "report")
    readers.write_report(heads.unionByName(body), path, "line", "source", "kind", "lang")
    back = spark.read.text(path)
    return back.select("value", F.when(F.col("value").startswith("##"), 1).otherwise(F.substring_index("value", ": ", -1).try_cast("long")).cast("long").alias("n"))


@query("SELECT source AS name, count(*) AS units FROM documents GROUP BY 1 HAVING count(*) >= 2")
def entity_sink(spark, sf):
    n = table(spark, sf, "documents").groupBy(F.col("source").alias("name")).agg(F.count("*").alias("units"))
    path = _folder(spark, "entities")
    readers.write_entities(n.withColumn("id", slug(F.col("name"))), path)
    return spark.read.schema("name string, units long, id string").json(path).select("name", "units")


@query("SELECT event_type AS stage, count(*) AS n FROM events GROUP BY 1 UNION ALL SELECT 'again', count(*) FROM events WHERE event_type = 'error'")
def log_sink(spark, sf):
    """A log appended to twice, read back."""
    e, path = table(spark, sf, "events"), _folder(spark, "log")
    readers.append_log(e.select(F.col("event_type").alias("stage")), path)
    readers.append_log(e.where("event_type = 'error'").select(F.lit("again").alias("stage")), path)
    return spark.read.schema("stage string").json(path).groupBy("stage").agg(F.count("*").alias("n"))


@query("SELECT doc_id AS seq, lang, length(text) AS chars FROM documents")
def document_sink(spark, sf):
    path = _folder(spark, "documents")
    readers.write_documents(table(spark, sf, "documents").select(F.col("doc_id").alias("seq"), "lang", F.length("text").alias("chars")), path)
    good, bad = readers.read_documents(spark, path, "seq long, lang string, chars long", lines=True)
    return good.drop("file").unionByName(bad.select(F.lit(-1).cast("long").alias("seq"), F.col("_corrupt").alias("lang"), F.lit(0).cast("long").alias("chars")))


@query()
def repair_log(spark, sf):
    """Repaired quotes with the rates of their units before and after."""
    quotes, p = text_queries._broken(spark, sf)
    fixed = stored(repair.repair(quotes, p, text_queries.SENTENCE), "repaired")
    after = fixed.select("qid", "seq", F.lit(None).cast("int").alias("para"), F.coalesce(F.col("parts")[0]["text"], F.col("quote")).alias("quote"))
    rates = lambda q: verify.unit_report(verify.check_quotes(q.select("qid", "seq", "para", "quote"), p, norm=flat)).select("seq", "verbatim_rate", F.lit(1.0).alias("coverage_rate"))
    return repair.repair_log(fixed, rates(quotes), rates(after)).select("qid", "seq", "field", "kind", F.array_join("after", " / ").alias("after"), "rate_before", "rate_after")


@query(f"WITH {entity_queries.SQL_INDEX}, r AS (SELECT alias, canonical, row_number() OVER (PARTITION BY alias ORDER BY canonical) AS rank FROM (SELECT DISTINCT alias, canonical FROM i WHERE alias <> canonical)) SELECT alias, canonical, CAST(rank AS INTEGER) AS rank FROM r WHERE rank <= 1000")
def alias_claimants(spark, sf):
    return entities.claimants(entity_queries._index(spark, sf))


@query(f"WITH RECURSIVE {sequence_queries.SQL_ARCS} SELECT cut, count(*) AS n, round(avg(stop - start + 1), 6) AS mean, quantile_cont(stop - start + 1, 0.5) AS median, min(stop - start + 1) AS least, max(stop - start + 1) AS most FROM arcs GROUP BY 1")
def arc_stats(spark, sf):
    return sequence.length_stats(sequence_queries.arc_table(spark, sf), "units", "cut")


def _titled(spark, sf):
    """The books with a second title after the first of every third document, and a site's notice at its end."""
    d = table(spark, sf, "documents").select("source", "doc_id", "lang", "text")
    third = F.when(F.col("doc_id") % 3 == 0, F.concat(F.lit("\n第9章 again"))).otherwise("")
    text = F.concat(F.lit("第"), "doc_id", F.lit("章 "), "lang", third, F.lit("\n"), F.coalesce("text", F.lit("")), F.lit("\n　　第7章 again\nixdzs"))
    lines = d.select(F.col("source").alias("doc"), "doc_id", F.posexplode(F.split(text, "\n")).alias("at", "text"))
    lines = lines.select("doc", (F.col("doc_id") * 1_000_000 + F.col("at")).alias("line_no"), "text")
    return segment.units(segment.classify_lines(lines, segment.is_title(F.col("text"))))


@query("SELECT 'dup title' AS kind, count(*) AS lines FROM documents UNION ALL SELECT 'inserted', count(*) FROM documents")
def junk_kinds(spark, sf):
    return segment.junk_counts(_titled(spark, sf))


@query("SELECT source AS doc, CAST(seq AS INTEGER) AS seq, lang AS title, 'again' AS merged, CAST(len(list_filter(string_split(text, chr(10)), lambda x: trim(x) <> '')) AS INTEGER) AS paragraphs FROM (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS seq FROM documents) WHERE doc_id % 3 = 0")
def merged_titles(spark, sf):
    units = stored(_titled(spark, sf), "units")
    listed = segment.merged_listing(units).join(units.select("doc", "seq", F.col("paragraph_count").cast("int").alias("paragraphs")), ["doc", "seq"])
    return listed.select("doc", "seq", "title", F.array_join("merged", ",").alias("merged"), "paragraphs")
