"""Queries on text: segmentation, metrics, verification, quality, concordance."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from storyloom.functions.text import flat
from storyloom.operators import mining, patterns, quality, repair, segment, verify
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


@query("SELECT d.doc_id AS seq, count(*) AS exact FROM documents d JOIN benchmark b ON contains(regexp_replace(d.text, '\\s+', '', 'g'), regexp_replace(b.text, '\\s+', '', 'g')) GROUP BY 1")
def verify_exact_quotes(spark: SparkSession, sf: str) -> DataFrame:
    quotes = table(spark, sf, "benchmark").select(F.col("item_id").alias("qid"), F.col("text").alias("quote"))
    return verify.containments(quotes, docs(spark, sf)).groupBy("seq").agg(F.count("*").alias("exact"))


@query(f"WITH {SQL_PARAS} SELECT seq, count(*) AS paragraph_count, CAST(sum(length(text)) AS BIGINT) AS char_count, CAST(max(length(text)) AS INTEGER) AS longest FROM paras WHERE text <> '' GROUP BY 1")
def paragraph_index(spark, sf):
    return segment.paragraphs(table(spark, sf, "documents")).where("text <> ''").groupBy("seq").agg(F.count("*").alias("paragraph_count"), F.sum(F.length("text")).alias("char_count"), F.max(F.length("text")).alias("longest"))


METRICS_SQL = """m AS (SELECT doc_id AS seq, CAST(length(text) AS BIGINT) AS chars, len(string_split(text, chr(10))) AS paragraphs, regexp_extract_all(text, '"([^"]{2,})', 1) AS l FROM documents),
metrics AS (SELECT seq, chars, CAST(paragraphs AS INTEGER) AS paragraphs, CAST(len(l) AS INTEGER) AS speech_lines, CAST(coalesce(list_sum(list_transform(l, lambda x: length(x))), 0) AS BIGINT) AS speech_chars FROM m),
full_metrics AS (SELECT *, CASE WHEN chars > 0 THEN round(speech_chars / chars, 3) ELSE 0.0 END AS dialogue_ratio FROM metrics)"""


@query(f"WITH {METRICS_SQL} SELECT * FROM full_metrics")
def unit_metrics(spark, sf):
    return mining.unit_metrics(docs(spark, sf), '"([^"]{2,})')


@query(f"WITH {METRICS_SQL} SELECT count(*) AS units, CAST(sum(chars) AS BIGINT) AS chars, median(chars) AS median_chars, median(dialogue_ratio) AS median_ratio, min(chars) AS least_chars, max(chars) AS most_chars FROM full_metrics")
def corpus_totals(spark, sf):
    return mining.corpus_totals(unit_metrics(spark, sf))


HTML_JUNK = "<(nav|script|style|footer)|class=.ad."


@query(f"""WITH l AS (SELECT page_id, unnest(string_split(regexp_replace(html, '(</[a-z0-9]+>)', '\\1' || chr(10), 'g'), chr(10))) AS line FROM pages)
SELECT CASE WHEN trim(line) = '' THEN 'blank' WHEN regexp_matches(line, '{HTML_JUNK}') THEN 'inserted' ELSE 'body' END AS kind, count(*) AS lines, CAST(sum(length(line)) AS BIGINT) AS chars, count(DISTINCT page_id) AS pages FROM l GROUP BY 1""")
def html_line_strip_audit(spark, sf):
    lines = table(spark, sf, "pages").select(F.col("page_id").alias("doc"), F.posexplode(F.split(F.regexp_replace("html", "(</[a-z0-9]+>)", "$1\n"), "\n")).alias("line_no", "text"))
    marked = segment.classify_lines(lines, F.lit(False), F.col("text").rlike(HTML_JUNK))
    return marked.groupBy("kind").agg(F.count("*").alias("lines"), F.sum(F.length("text")).alias("chars"), F.count_distinct("doc").alias("pages"))


@query(f"""WITH {SQL_PARAS}, t AS (SELECT seq, para, text, length(text) BETWEEN 1 AND 60 AS is_title FROM paras),
h AS (SELECT *, is_title AND NOT coalesce(lag(is_title) OVER (PARTITION BY seq ORDER BY para), false) AS is_head FROM t),
u AS (SELECT *, sum(CASE WHEN is_head THEN 1 ELSE 0 END) OVER (PARTITION BY seq ORDER BY para ROWS UNBOUNDED PRECEDING) AS unit FROM h)
SELECT seq, CAST(unit AS BIGINT) AS unit, count(*) FILTER (is_title) AS titles, count(*) FILTER (NOT is_title) AS body_lines, CAST(min(para) AS INTEGER) AS line_start, CAST(max(para) AS INTEGER) AS line_end FROM u WHERE unit > 0 GROUP BY 1, 2""")
def title_run_islands(spark, sf):
    lines = segment.paragraphs(table(spark, sf, "documents"))
    marked = segment.classify_lines(lines, F.length("text").between(1, 60), F.lit(False), "seq", "para").where("unit IS NOT NULL")
    is_title = F.col("kind") == "title"
    return marked.groupBy("seq", "unit").agg(F.count_if(is_title).alias("titles"), F.count_if(~is_title).alias("body_lines"), F.min("para").alias("line_start"), F.max("para").alias("line_end"))


@query("""WITH c AS (SELECT CAST(l_partkey AS BIGINT) * 3 AS number, count(*) AS n FROM lineitem GROUP BY 1), r AS (SELECT unnest(range((SELECT min(number) FROM c), (SELECT max(number) + 1 FROM c))) AS number)
SELECT number, 'duplicate' AS kind FROM c WHERE n > 1 UNION ALL SELECT number, 'missing' FROM r WHERE number NOT IN (SELECT number FROM c)""")
def number_gaps_and_dups(spark, sf):
    return segment.number_health(table(spark, sf, "lineitem").select((F.col("l_partkey") * 3).alias("n")), "n")


@query("SELECT doc_id AS seq, source, lang, n_chars FROM documents")
def light_index(spark, sf):
    return docs(spark, sf).select("seq", "source", "lang", "n_chars")


AFTER = r"[.,] ([A-Za-z]{2,8})"
MINED_SQL = r"""a AS (SELECT doc_id AS seq, unnest(regexp_extract_all(text, '[.,] ([A-Za-z]{2,8})', 1)) AS s FROM documents),
b AS (SELECT seq, s, n FROM a, (VALUES (2), (3), (4)) v(n) WHERE length(s) > n),
mined AS (SELECT substr(s, 1, n) AS name, count(*) AS hits, count(DISTINCT substr(s, n + 1, 1)) AS variety, count(DISTINCT seq) AS units, min(seq) AS first_seq, max(seq) AS last_seq FROM b GROUP BY 1 HAVING count(*) >= 20 AND count(DISTINCT substr(s, n + 1, 1)) >= 5 AND count(DISTINCT seq) >= 10)"""


@query(f"WITH {MINED_SQL} SELECT * FROM mined")
def name_mining(spark, sf):
    return mining.mine_names(docs(spark, sf), AFTER, least_hits=20, least_variety=5, least_units=10)


@query(f"WITH {MINED_SQL} SELECT * FROM mined c WHERE NOT EXISTS (SELECT 1 FROM mined q WHERE q.name <> c.name AND starts_with(c.name, q.name) AND q.variety >= c.variety)")
def name_prefix_cover(spark, sf):
    return mining.without_covered(stored(name_mining(spark, sf), "names"))


@query(f"""WITH {SQL_MENTIONS}, f AS (SELECT name, min(seq) AS first_seq FROM mentions GROUP BY 1), e AS (SELECT max(doc_id) AS last FROM documents), b AS (SELECT unnest(range(0, (SELECT last // 25 + 1 FROM e))) AS bucket)
SELECT b.bucket, b.bucket * 25 AS start, least(b.bucket * 25 + 24, (SELECT last FROM e)) AS "end", count(f.name) AS newcomers FROM b LEFT JOIN f ON f.first_seq // 25 = b.bucket GROUP BY 1""")
def newcomers_by_bucket(spark, sf):
    d = docs(spark, sf)
    names = mentions(d).groupBy("name").agg(F.min("seq").alias("first_seq"))
    return mining.newcomers(names, d.agg(F.max("seq")).first()[0] or 0, first=0)


TOPICS = {"motion": ["ation", "ing"], "matter": ["heit", "keit"], "place": ["ciudad", "elle"]}
ALTERNATION = mining.longest_first([w for ws in TOPICS.values() for w in ws])
TOPIC_CASE = "CASE " + " ".join(f"WHEN word IN ({', '.join(repr(w) for w in ws)}) THEN '{t}'" for t, ws in TOPICS.items()) + " END"


@query(f"WITH h AS (SELECT doc_id AS seq, unnest(regexp_extract_all(text, '({ALTERNATION})', 1)) AS word FROM documents) SELECT {TOPIC_CASE} AS topic, count(*) AS total, count(DISTINCT seq) AS units, min(seq) AS first, max(seq) AS last FROM h GROUP BY 1")
def keyword_threads(spark, sf):
    return mining.threads(mining.thread_hits(docs(spark, sf), TOPICS))


@query(f"WITH h AS (SELECT doc_id AS seq, unnest(regexp_extract_all(text, '({ALTERNATION})', 1)) AS word FROM documents) SELECT {TOPIC_CASE} AS topic, seq // 1000 AS chunk, seq, count(*) AS n FROM h GROUP BY 1, 2, 3")
def keyword_thread_units(spark, sf):
    """The maps of units, chunk by chunk."""
    chunks = mining.thread_chunks(mining.thread_hits(docs(spark, sf), TOPICS))
    return chunks.select("topic", "chunk", F.explode("by_seq").alias("seq", "n"))


@query("""WITH p AS (SELECT DISTINCT substr(text, 1, 12) AS word FROM benchmark UNION SELECT DISTINCT substr(text, 5, 9) FROM benchmark)
SELECT word, CAST(sum((length(d.text) - length(replace(d.text, word, ''))) // length(word)) AS BIGINT) AS hits, count(*) AS units FROM p JOIN documents d ON contains(d.text, word) WHERE word <> '' GROUP BY 1""")
def phrase_hits(spark, sf):
    """Beginnings of all benchmark items in all documents, in one pass."""
    b = table(spark, sf, "benchmark")
    words = b.select(F.substring("text", 1, 12).alias("word")).union(b.select(F.substring("text", 5, 9)))
    hits = patterns.counted_apart(patterns.pattern_hits(docs(spark, sf), words, overlapping=True))
    return hits.groupBy("word").agg(F.sum("n").alias("hits"), F.count("*").alias("units"))


@query(f"""WITH {SQL_MENTIONS}, c AS (SELECT seq // 20 AS "window", name AS item, count(*) AS n FROM mentions GROUP BY 1, 2), r AS (SELECT *, row_number() OVER (PARTITION BY "window" ORDER BY n DESC, item) AS rank FROM c) SELECT "window", item, n, CAST(rank AS INTEGER) AS rank FROM r WHERE rank <= 3""")
def topk_by_window(spark, sf):
    return mining.topk_by_window(mentions(docs(spark, sf)).withColumnRenamed("name", "item"), first=0)


@query(f"WITH {SQL_MENTIONS} SELECT name AS item, min(seq) AS first, max(seq) AS last, count(DISTINCT seq) AS units FROM mentions GROUP BY 1 HAVING count(DISTINCT seq) >= 15")
def entity_spans(spark, sf):
    return mining.spans(mentions(docs(spark, sf)).withColumnRenamed("name", "item"), 15)


WORDS = ["the", "then", "thing", "ation", "tion", "er"]


@query(f"WITH h AS (SELECT doc_id AS seq, unnest(regexp_extract_all(replace(text, 'other', chr(1)), '({mining.longest_first(WORDS)})', 1)) AS word FROM documents) SELECT seq, word, count(*) AS hits FROM h GROUP BY 1, 2")
def longest_match_counts(spark, sf):
    return mining.word_hits(docs(spark, sf), WORDS, ["other"]).groupBy("seq", "word").agg(F.count("*").alias("hits"))


SURE, AMBIGUOUS = ["Thing", "Ereing"], ["ation"]


@query(f"""WITH {SQL_PARAS}, h AS (SELECT seq, para, unnest(regexp_extract_all(text, '({mining.longest_first(SURE + AMBIGUOUS)})', 1)) AS word FROM paras), s AS (SELECT *, word IN ('Thing', 'Ereing') AS is_sure FROM h),
k AS (SELECT * FROM s WHERE is_sure OR NOT EXISTS (SELECT 1 FROM s x WHERE x.is_sure AND x.seq = s.seq AND x.para = s.para))
SELECT word, is_sure, count(*) AS hits, count(DISTINCT seq) AS units, min(seq) AS first_seq, CAST(arg_min(para, seq * 1000000 + para) AS INTEGER) AS first_para FROM k GROUP BY 1, 2""")
def dossier_stats(spark, sf):
    return mining.dossier(segment.paragraphs(table(spark, sf, "documents")), SURE, AMBIGUOUS)


TAGS = {"contact": ["@", "+1 ("], "secret": ["password=", "token ="], "licence": ["License", "Copyright"]}


@query("SELECT doc_id AS seq, unnest(list_filter([CASE WHEN contains(text, '@') OR contains(text, '+1 (') THEN 'contact' END, CASE WHEN contains(text, 'password=') OR contains(text, 'token =') THEN 'secret' END, CASE WHEN contains(text, 'License') OR contains(text, 'Copyright') THEN 'licence' END], lambda x: x IS NOT NULL)) AS tag FROM documents")
def tag_index(spark, sf):
    return mining.tags(docs(spark, sf), TAGS)


@query(f"""WITH {SQL_PARAS}, h AS (SELECT DISTINCT seq, para FROM paras WHERE contains(text, '@')), n AS (SELECT h.seq, h.para + d.d AS para, max(d.d = 0) AS is_hit FROM h, (VALUES (-2), (-1), (0), (1), (2)) d(d) GROUP BY 1, 2)
SELECT p.seq, CAST(p.para AS INTEGER) AS para, p.text, n.is_hit FROM paras p JOIN n ON n.seq = p.seq AND n.para = p.para""")
def context_window(spark, sf):
    p = segment.paragraphs(table(spark, sf, "documents"))
    return mining.context(p, p.where(F.contains("text", F.lit("@"))))


def _quotes(spark, sf):
    """Every line of the documents that have a conversation's number; a character is lost where that has an odd number of turns."""
    turns = stored(table(spark, sf, "conversations").groupBy("conv_id").agg(F.max("turn").alias("turn")), "turns")
    own = table(spark, sf, "documents").join(turns, F.col("conv_id") == F.col("doc_id"), "left_semi")  # before texts become lines
    rows = segment.paragraphs(own).join(turns, F.col("conv_id") == F.col("seq"))
    odd = F.when(F.col("turn") % 2 == 1, F.regexp_replace("text", "^(.{10}).(.*)$", "$1$2")).otherwise(F.col("text"))
    return rows.select((F.col("seq") * 1_000_000 + F.col("para")).alias("qid"), "seq", "para", odd.alias("quote"))


@query()
def quote_residue_similarity(spark, sf):
    checked = verify.check_quotes(_quotes(spark, sf), segment.paragraphs(table(spark, sf, "documents")), norm=flat)
    return checked.select("qid", "status", "para_found", "para_correct", F.round("similarity", 6).alias("similarity"))


@query(f"""WITH {SQL_PARAS}, s AS (SELECT seq, unnest(regexp_extract_all(text, '([^.\\n]{{2,}})', 1)) AS span FROM paras), f AS (SELECT seq, regexp_replace(span, '\\s+', '', 'g') AS span FROM s WHERE length(regexp_replace(span, '\\s+', '', 'g')) >= 7 OR regexp_matches(span, ',')),
g AS (SELECT conv_id AS seq, regexp_replace(string_agg(text, '' ORDER BY turn), '\\s+', '', 'g') AS given FROM conversations GROUP BY 1), k AS (SELECT f.seq, count(*) AS speech, count(*) FILTER (contains(coalesce(g.given, ''), f.span)) AS covered FROM f LEFT JOIN g ON g.seq = f.seq GROUP BY 1)
SELECT d.doc_id AS seq, coalesce(speech, 0) AS speech, coalesce(covered, 0) AS covered, coalesce(covered / speech, 1.0) AS coverage_rate FROM documents d LEFT JOIN k ON k.seq = d.doc_id""")
def dialogue_coverage(spark, sf):
    """Every sentence of every document as speech, against all turns of the conversation of its number."""
    given = table(spark, sf, "conversations").select(F.col("conv_id").alias("seq"), F.col("turn").alias("para"), F.col("text").alias("quote"))
    speech = lambda s: (F.length(flat(s)) >= 7) | F.contains(s, F.lit(","))
    return verify.coverage(segment.paragraphs(table(spark, sf, "documents")), given, r"([^.\n]{2,})", flat, speech).drop("missed")


def _scores(spark, sf):
    """Scores from labels and documents: structure 60-100 by length, fidelity by quality, rate and misses by toxicity."""
    rows = table(spark, sf, "labels").join(table(spark, sf, "documents").select("doc_id", "n_chars"), "doc_id")
    return rows.select(F.col("doc_id").alias("seq"), (60 + F.col("n_chars") % 41).cast("int").alias("structure_score"), (80 + 15 * F.col("quality")).cast("int").alias("fidelity_score"), F.when(F.col("n_chars") % 7 == 0, 0.9).otherwise(1.0).alias("verbatim_rate"), F.col("toxic").alias("miss"))


SQL_SCORES = "s AS (SELECT l.doc_id AS seq, CAST(60 + d.n_chars % 41 AS INTEGER) AS structure_score, CAST(80 + 15 * l.quality AS INTEGER) AS fidelity_score, CASE WHEN d.n_chars % 7 = 0 THEN 0.9 ELSE 1.0 END AS verbatim_rate, l.toxic AS miss FROM labels l JOIN documents d USING (doc_id))"
SQL_REASONS = "list_filter([CASE WHEN structure_score < 85 THEN 'structure' END, CASE WHEN fidelity_score < 90 THEN 'fidelity' END, CASE WHEN verbatim_rate < 0.95 THEN 'verbatim' END, CASE WHEN miss > 0 THEN 'fabricated' END], lambda x: x IS NOT NULL)"


@query(f"WITH {SQL_SCORES} SELECT seq, array_to_string({SQL_REASONS}, ',') AS reasons, len({SQL_REASONS}) = 0 AS passed FROM s")
def quality_gate(spark, sf):
    return quality.gate(_scores(spark, sf)).select("seq", F.array_join("fail_reasons", ",").alias("reasons"), "passed")


@query(f"WITH {SQL_SCORES} SELECT CASE WHEN miss > 0 THEN 'T1' WHEN verbatim_rate < 0.95 OR structure_score < 85 OR fidelity_score < 90 THEN 'T2' ELSE 'T3' END AS tier, count(*) AS units FROM s GROUP BY 1")
def severity_tiers(spark, sf):
    return quality.tiers(_scores(spark, sf)).groupBy("tier").agg(F.count("*").alias("units"))


@query(f"WITH {SQL_SCORES}, r AS (SELECT unnest({SQL_REASONS}) AS kind FROM s) SELECT kind, count(*) AS n FROM r GROUP BY 1 ORDER BY n DESC, kind LIMIT 12")
def problem_histogram(spark, sf):
    return quality.problem_histogram(quality.gate(_scores(spark, sf)).select(F.explode("fail_reasons").alias("p")), F.col("p"))


@query(f"WITH {SQL_SCORES} SELECT count(structure_score) AS n, round(avg(structure_score), 6) AS mean, median(structure_score) AS median, min(structure_score) AS least, count(*) FILTER (structure_score < 85) AS below FROM s")
def score_distribution(spark, sf):
    return quality.score_distribution(_scores(spark, sf), "structure_score", 85)


def _states(spark, sf):
    done = table(spark, sf, "labels").select(F.col("doc_id").alias("seq"), F.when(F.col("doc_id") % 11 != 0, F.lit("x")).alias("finished_at"), (F.col("quality") == 1).alias("passed"))
    return quality.work_state(docs(spark, sf), done)


SQL_STATES = "st AS (SELECT d.doc_id AS seq, CASE WHEN l.doc_id IS NULL THEN 'missing' WHEN l.doc_id % 11 = 0 THEN 'incomplete' WHEN l.quality <> 1 THEN 'failed' ELSE 'done' END AS state FROM documents d LEFT JOIN labels l USING (doc_id))"


@query(f"WITH {SQL_STATES} SELECT state, count(*) AS units FROM st GROUP BY 1")
def work_state(spark, sf):
    return _states(spark, sf).groupBy("state").agg(F.count("*").alias("units"))


@query(f"WITH {SQL_STATES} SELECT seq FROM st WHERE state = 'missing' UNION SELECT doc_id FROM labels WHERE toxic = 1")
def rerun_set(spark, sf):
    return quality.rerun_set(_states(spark, sf), table(spark, sf, "labels").where("toxic = 1").select(F.col("doc_id").alias("seq")))


@query(f"""WITH {SQL_MENTIONS}, s AS (SELECT DISTINCT conv_id AS seq, unnest(regexp_extract_all(text, '([A-Za-z]+)', 1)) AS name FROM conversations WHERE role <> 'system')
SELECT seq, name FROM s WHERE name <> '' AND NOT regexp_matches(name, 'tion|heit') AND NOT EXISTS (SELECT 1 FROM mentions m WHERE m.seq = s.seq AND m.name = s.name)""")
def unregistered_speakers(spark, sf):
    names = table(spark, sf, "conversations").where("role <> 'system'").select(F.col("conv_id").alias("seq"), F.explode(F.regexp_extract_all("text", F.lit("([A-Za-z]+)"), 1)).alias("name")).distinct()
    return quality.unregistered(names, mentions(docs(spark, sf)), ["tion", "heit"], [])


@query(f"""WITH {SQL_PARAS}, r AS (SELECT conv_id, turn, CAST(turn + 1 AS INTEGER) AS para FROM conversations)
SELECT r.conv_id, r.turn, CASE WHEN p.seq IS NULL THEN 'para out of range' END AS error, p.text AS resolved FROM r LEFT JOIN paras p ON p.seq = r.conv_id AND p.para = r.para""")
def position_refs(spark, sf):
    refs = table(spark, sf, "conversations").select(F.col("conv_id").alias("seq"), "turn", (F.col("turn") + 1).cast("int").alias("para"), F.lit(None).cast("int").alias("q"), F.lit(None).cast("string").alias("text"))
    return verify.position_refs(refs, segment.paragraphs(table(spark, sf, "documents"))).select(F.col("seq").alias("conv_id"), "turn", "error", "resolved")


def _broken(spark, sf):
    """A faulty quote for each turn, from the paragraph of that number: two sentences joined, or one with an edit."""
    turns = table(spark, sf, "conversations").select(F.col("conv_id").alias("seq"), (F.col("turn") + 1).cast("int").alias("para"), "turn")
    own = table(spark, sf, "documents").join(turns.select(F.col("seq").alias("doc_id")).distinct(), "doc_id", "left_semi")
    p = stored(segment.paragraphs(own), "paragraphs")  # of the units that have quotes
    s = p.join(turns, ["seq", "para"]).select("seq", "para", "turn", F.split("text", r"(?<=\.) ").alias("s")).where(F.size("s") >= 3)
    joined = s.where("turn % 2 = 0").select("seq", "para", F.concat(F.col("s")[0], F.col("s")[1]).alias("quote"), F.lit("dialogues").alias("field"))
    edited = s.where("turn % 2 = 1").select("seq", "para", F.regexp_replace(F.col("s")[1], "^(.{6}).(.*)$", "$1#$2").alias("quote"), F.lit("narration.x").alias("field"))
    return stored(joined.unionByName(edited).withColumn("qid", F.xxhash64("seq", "para", "field")), "quotes"), p


SENTENCE = r"(?<![^.])([^.]++\.)"  # one start for each sentence, so that long lines without an end take no time squared


SQL_SEGMENTS = r"list_filter(list_transform(regexp_extract_all(text, '([^.]+\.)', 1), lambda x: regexp_replace(regexp_replace(x, '^[\s：，、；:,;]+', ''), '\s+$', '')), lambda x: x <> '')"


@query(rf"""WITH {SQL_PARAS}, t AS (SELECT p.seq, CAST(p.para AS INTEGER) AS para, string_split(p.text, '. ') AS s FROM paras p JOIN conversations c ON c.conv_id = p.seq AND c.turn + 1 = p.para WHERE c.turn % 2 = 0),
q AS (SELECT seq, para, regexp_replace(s[1] || '.' || s[2] || '.', '\s+', '', 'g') AS joined FROM t WHERE len(s) >= 3), g AS (SELECT seq, para, {SQL_SEGMENTS} AS l FROM paras WHERE seq IN (SELECT seq FROM q)),
r AS (SELECT seq, para, i, n, list_slice(l, i, i + n - 1) AS parts FROM (SELECT seq, para, l, unnest(range(1, len(l) + 1)) AS i FROM g), (VALUES (2), (3), (4), (5), (6), (7), (8)) v(n) WHERE i + n - 1 <= len(l)),
h AS (SELECT q.seq, q.para, r.parts, row_number() OVER (PARTITION BY q.seq, q.para ORDER BY CASE WHEN r.para = q.para THEN 0 ELSE 1 END, r.para, r.i) AS k FROM q JOIN r ON r.seq = q.seq AND regexp_replace(array_to_string(r.parts, ''), '\s+', '', 'g') = q.joined)
SELECT seq, para, 'joined' AS kind, array_to_string(parts, ' / ') AS parts FROM h WHERE k = 1""")
def repair_split_concat(spark, sf):
    quotes, p = _broken(spark, sf)
    found = repair.split_joined(quotes.where("field = 'dialogues'"), repair.segments(p, SENTENCE))
    return found.join(quotes.select("qid", "seq", "para"), "qid").select("seq", "para", "kind", F.array_join(F.transform("parts", lambda x: x["text"]), " / ").alias("parts"))


@query()
def repair_align(spark, sf):
    quotes, p = _broken(spark, sf)
    own = quotes.where("field = 'narration.x'")
    return repair.align(own, p).select("qid", F.col("parts")[0]["text"].alias("span"), F.round("score", 6).alias("score"))


@query()
def repair_rollback(spark, sf):
    quotes, p = _broken(spark, sf)
    fixed = stored(repair.repair(quotes, p, SENTENCE), "repaired")
    after = fixed.select("qid", "seq", F.lit(None).cast("int").alias("para"), F.coalesce(F.col("parts")[0]["text"], F.col("quote")).alias("quote"))
    report = lambda q: verify.unit_report(verify.check_quotes(q.select("qid", "seq", "para", "quote"), p, norm=flat))
    return repair.rolled_back(report(quotes), report(after))
