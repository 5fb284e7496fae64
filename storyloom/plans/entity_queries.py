"""Queries on names and entities, and request tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from storyloom.graph import FEW, connected_components
from storyloom.operators import entities, mining, requests, sequence
from storyloom.plans.common import SQL_MENTIONS, docs, mentions, table
from storyloom.scratch import stored
from storyloom.sources.readers import chunked

Q: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        Q[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


SYNOPSIS = "CASE WHEN n_chars % 5 <> 0 THEN text END"
SQL_CONTEXT = f"u AS (SELECT doc_id AS seq, {SYNOPSIS} AS synopsis FROM documents)"


@query(f"""WITH {SQL_CONTEXT}, p AS (SELECT a.seq, b.seq AS s, b.synopsis, row_number() OVER (PARTITION BY a.seq ORDER BY b.seq DESC) AS r FROM u a JOIN u b ON b.seq BETWEEN a.seq - 12 AND a.seq - 1 AND b.synopsis IS NOT NULL)
SELECT u.seq, md5(coalesce(string_agg(p.synopsis, '|' ORDER BY p.s), '')) AS context FROM u LEFT JOIN p ON p.seq = u.seq AND p.r <= 3 GROUP BY 1""")
def prev_context(spark: SparkSession, sf: str) -> DataFrame:
    units = docs(spark, sf).select("seq", F.expr(SYNOPSIS).alias("synopsis"))
    return requests.previous_context(units).select("seq", F.md5(F.array_join("context", "|")).alias("context"))


@query(f"""WITH {SQL_MENTIONS}, t AS (SELECT DISTINCT seq // 100 * 100 + 100 AS target FROM mentions), c AS (SELECT t.target, m.name, count(*) AS n FROM t JOIN mentions m ON m.seq < t.target GROUP BY 1, 2), r AS (SELECT *, row_number() OVER (PARTITION BY target ORDER BY n DESC, name) AS rank FROM c)
SELECT target, name, CAST(n AS BIGINT) AS n, CAST(rank AS INTEGER) AS rank FROM r WHERE rank <= 400""")
def registry_before(spark, sf):
    m = mentions(docs(spark, sf))
    return requests.registry_before(m, m.select((F.floor(F.col("seq") / 100) * 100 + 100).alias("seq")))


def _edges(spark, sf):
    """Users (u1, ...) listing keys (k1, ...) of errors as aliases; place by time."""
    e = table(spark, sf, "events").where("event_type = 'error'").withColumn("k", F.get_json_object("props", "$.k"))
    return e.select(F.col("event_id").alias("seq"), F.lit(0).cast("long").alias("pos"), F.concat(F.lit("u"), "user_id").alias("name"), F.array(F.concat(F.lit("k"), "k")).alias("aliases"))


@query("""WITH RECURSIVE e AS (SELECT DISTINCT 'u' || user_id AS a, 'k' || json_extract_string(props, '$.k') AS b FROM events WHERE event_type = 'error'), d AS (SELECT a, b FROM e UNION SELECT b, a FROM e),
w(node, root) AS (SELECT a, a FROM d UNION SELECT d.b, w.root FROM w JOIN d ON d.a = w.node)
SELECT node, min(root) AS component FROM w GROUP BY 1""")
def alias_components(spark, sf):
    e = table(spark, sf, "events").where("event_type = 'error'").select(F.concat(F.lit("u"), "user_id").alias("a"), F.concat(F.lit("k"), F.get_json_object("props", "$.k")).alias("b"))
    return connected_components(e, few=FEW)


# Edges one after the other: ``lab`` has the cluster of each name, ``chief`` whether a cluster holds a principal.
SQL_MERGE = """m AS (SELECT event_id AS seq, 'u' || user_id AS a, 'k' || json_extract_string(props, '$.k') AS b FROM events WHERE event_type = 'error'), n AS (SELECT a AS name, count(*) AS n, min(seq) AS first_ord FROM m GROUP BY 1),
e0 AS (SELECT a, b, min(seq) AS seq FROM m GROUP BY 1, 2), names AS (SELECT name, row_number() OVER (ORDER BY name) AS i FROM (SELECT a AS name FROM e0 UNION SELECT b FROM e0)),
e AS (SELECT x.i AS x, y.i AS y, row_number() OVER (ORDER BY seq, a, b) AS k FROM e0 JOIN names x ON x.name = a JOIN names y ON y.name = b), s AS (SELECT list(i ORDER BY i) AS lab, list(coalesce(n.n >= 12, false) ORDER BY i) AS chief FROM names LEFT JOIN n USING (name)),
st(k, lab, chief) AS (SELECT CAST(0 AS BIGINT), lab, chief FROM s UNION ALL
SELECT k + 1, CASE WHEN ok THEN list_transform(lab, lambda l: CASE WHEN l = ly THEN lx ELSE l END) ELSE lab END, CASE WHEN ok THEN list_transform(chief, lambda c, j: CASE WHEN j = lx THEN c OR chief[ly] ELSE c END) ELSE chief END
FROM (SELECT st.k, lab, chief, lab[x] AS lx, lab[y] AS ly, lab[x] <> lab[y] AND NOT (chief[lab[x]] AND chief[lab[y]]) AS ok FROM st JOIN e ON e.k = st.k + 1)),
c AS (SELECT name, f.lab[i] AS cluster FROM names, (SELECT lab FROM st ORDER BY k DESC LIMIT 1) f),
r AS (SELECT cluster, c.name, row_number() OVER (PARTITION BY cluster ORDER BY coalesce(n.n, 0) DESC, length(c.name) DESC, first_ord NULLS LAST, c.name) AS k FROM c LEFT JOIN n USING (name))"""


@query(f"WITH RECURSIVE {SQL_MERGE} SELECT c.name, r.name AS canonical FROM c JOIN r ON r.cluster = c.cluster AND r.k = 1")
def guarded_merge(spark, sf):
    m = _edges(spark, sf)
    counts = m.groupBy("name").agg(F.count("*").alias("n"), F.min("seq").alias("first_ord"))
    clusters, _ = entities.guarded_merge(entities.alias_edges(m, is_generic=lambda n: entities.generic(n, [], [])), counts, principal=12)
    return entities.canonical_names(clusters, counts)


def _index(spark, sf):
    """Users with the keys of their events as aliases; a user's own number is also a key."""
    e = table(spark, sf, "events").select(F.col("user_id").cast("string").alias("canonical"), F.get_json_object("props", "$.k").alias("alias")).distinct()
    return e.groupBy("canonical").agg(F.collect_set("alias").alias("aliases"))


SQL_INDEX = """i AS (SELECT DISTINCT CAST(user_id AS VARCHAR) AS canonical, json_extract_string(props, '$.k') AS alias FROM events),
c AS (SELECT alias, count(*) AS n, min(canonical) AS owner FROM i WHERE alias <> canonical GROUP BY 1), own AS (SELECT DISTINCT canonical FROM i),
mutual AS (SELECT x.canonical AS a, x.alias AS b FROM i x JOIN i y ON x.canonical = y.alias AND x.alias = y.canonical WHERE x.canonical < x.alias)"""


@query(f"""WITH {SQL_INDEX}, names AS (SELECT canonical AS name FROM i UNION SELECT alias FROM i)
SELECT name, CASE WHEN name IN ('7', '8') THEN name WHEN name IN ('11', '12') THEN 'curated' WHEN o.canonical IS NOT NULL THEN name WHEN c.n = 1 THEN c.owner ELSE name END AS owner,
CASE WHEN name IN ('7', '8') THEN true WHEN name IN ('11', '12') THEN false WHEN o.canonical IS NOT NULL THEN coalesce(c.n, 0) > 0 WHEN c.n = 1 THEN false ELSE coalesce(c.n, 0) > 1 END AS doubt FROM names LEFT JOIN c ON c.alias = name LEFT JOIN own o ON o.canonical = name""")
def alias_resolver(spark, sf):
    index = stored(_index(spark, sf), "index")
    names = index.select(F.col("canonical").alias("name")).union(index.select(F.explode("aliases")))
    curated = spark.createDataFrame([("11", "curated"), ("12", "curated")], "name string, owner string")
    return entities.resolve(names, index, curated, spark.createDataFrame([("7",), ("8",)], "name string"))


@query(f"WITH {SQL_INDEX}, f AS (SELECT a AS name FROM mutual UNION SELECT b FROM mutual) SELECT alias AS name, n, CASE WHEN alias IN (SELECT name FROM f) THEN 'mutual' WHEN CAST(alias AS INTEGER) >= 95 THEN 'also a scene' ELSE 'rest' END AS kind FROM c WHERE n > 1")
def contested_names(spark, sf):
    index = stored(_index(spark, sf), "index")
    scenes = index.select(F.explode("aliases").alias("name")).where(F.col("name").cast("int") >= 95)
    return entities.contested(index, scenes)


@query(f"WITH {SQL_INDEX} SELECT a, b, contains(a, b) OR contains(b, a) AS high FROM mutual")
def mutual_aliases(spark, sf):
    return entities.mutual_aliases(stored(_index(spark, sf), "index"))


@query("""WITH r AS (SELECT user_id, event_type, count(*) AS n FROM events GROUP BY 1, 2), t AS (SELECT CAST(user_id AS VARCHAR) AS canonical, string_agg(event_type || '=' || n, ',' ORDER BY event_type) AS roles FROM r GROUP BY 1)
SELECT e.*, CAST(e.canonical AS VARCHAR) AS aliases, t.roles FROM (SELECT CAST(user_id AS VARCHAR) AS canonical, count(DISTINCT event_id // 10) AS units, count(*) AS mentions, min(event_id // 10) AS first_seq, max(event_id // 10) AS last_seq, count(*) FILTER (event_type = 'view') AS mentioned_only FROM events GROUP BY 1) e JOIN t USING (canonical)""")
def entity_rollup(spark, sf):
    m = table(spark, sf, "events").select(F.floor(F.col("event_id") / 10).alias("seq"), F.lit(0).alias("pos"), F.col("user_id").cast("string").alias("name"), (F.col("event_type") == "view").alias("mentioned_only"), F.col("event_type").alias("role"))
    return _spelled(entities.rollup(m))


def _spelled(rollup: DataFrame) -> DataFrame:
    """Aliases and roles as text, to be compared."""
    roles = F.array_join(F.transform(F.array_sort(F.map_entries("roles")), lambda x: F.concat(x["key"], F.lit("="), x["value"])), ",")
    return rollup.withColumn("aliases", F.array_join("aliases", ",")).withColumn("roles", roles)


@query("""WITH r AS (SELECT left(event_type, 1) AS canonical, props AS role, count(*) AS n FROM events GROUP BY 1, 2), t AS (SELECT canonical, string_agg(role || '=' || n, ',' ORDER BY role) AS roles FROM r GROUP BY 1), a AS (SELECT canonical, string_agg(event_type, ',' ORDER BY n DESC, event_type) AS aliases FROM (SELECT left(event_type, 1) AS canonical, event_type, count(*) AS n FROM events GROUP BY 1, 2) GROUP BY 1)
SELECT e.*, a.aliases, t.roles FROM (SELECT left(event_type, 1) AS canonical, count(DISTINCT user_id) AS units, count(*) AS mentions, min(user_id) AS first_seq, max(user_id) AS last_seq, CAST(0 AS BIGINT) AS mentioned_only FROM events GROUP BY 1) e JOIN t USING (canonical) JOIN a USING (canonical)""")
def scene_rollup(spark, sf):
    m = table(spark, sf, "events").select(F.col("user_id").alias("seq"), F.lit(0).alias("pos"), F.col("event_type").alias("name"), F.lit(False).alias("mentioned_only"), F.col("props").alias("role"))
    names = m.select("name", F.substring("name", 1, 1).alias("canonical")).distinct()
    return _spelled(entities.rollup(m, names))


@query("""WITH o AS (SELECT DISTINCT l_orderkey AS u, l_suppkey AS i FROM lineitem) SELECT x.i AS a, y.i AS b, count(*) AS units FROM o x JOIN o y ON x.u = y.u AND x.i < y.i GROUP BY 1, 2 ORDER BY units DESC, a, b LIMIT 3000""")
def cooccurrence_pairs(spark, sf):
    return entities.cooccurrence(table(spark, sf, "lineitem"), 3000, "l_orderkey", "l_suppkey")


SQL_TIMELINE = f"""{SQL_MENTIONS}, major AS (SELECT name FROM mentions GROUP BY 1 HAVING count(DISTINCT seq) >= 8), f AS (SELECT seq, name, min(pos) AS pos FROM mentions WHERE name IN (SELECT name FROM major) GROUP BY 1, 2),
n AS (SELECT seq, list(name ORDER BY pos) AS l FROM f GROUP BY 1), tl AS (SELECT d.doc_id AS seq, d.text, d.n_chars, coalesce(n.l, []) AS l FROM documents d LEFT JOIN n ON n.seq = d.doc_id)"""


def _timeline(spark, sf):
    d = docs(spark, sf)
    return sequence.timeline(d, mentions(d))


@query(f"WITH {SQL_TIMELINE} SELECT seq, array_to_string(l, ',') AS names, CAST(len(l) AS INTEGER) AS n_names, n_chars AS char_count FROM tl")
def timeline(spark, sf):
    return _timeline(spark, sf).select("seq", F.array_join("names", ",").alias("names"), F.size("names").alias("n_names"), F.col("n_chars").alias("char_count"))


SQL_LINE = "CASE WHEN len(l) = 0 THEN '-' ELSE array_to_string(l[1:5], ', ') END || ' | ' || CASE WHEN text = '' THEN '-' ELSE substr(text, 1, 60) END"


@query(f"WITH {SQL_TIMELINE} SELECT seq, {SQL_LINE} AS line FROM tl")
def digest_lines(spark, sf):
    return _timeline(spark, sf).select("seq", sequence.digest_line(F.col("names"), F.col("text"), dash="-").alias("line"))


@query("""WITH r AS (SELECT doc_id AS seq, n_chars, row_number() OVER (ORDER BY doc_id) AS i, count(*) OVER () AS n FROM documents) SELECT CAST(ceil(i / ceil(n / 7)) AS INTEGER) AS chunk, count(*) AS units, min(seq) AS first, max(seq) AS last, CAST(sum(n_chars) AS BIGINT) AS chars FROM r GROUP BY 1""")
def chunked_digest(spark, sf):
    return chunked(docs(spark, sf).select("seq", "n_chars"), "seq", 7).groupBy("chunk").agg(F.count("*").alias("units"), F.min("seq").alias("first"), F.max("seq").alias("last"), F.sum("n_chars").alias("chars"))


GRID = "concat_ws(' ', 'A', r_name, n_name, 'end', 'Avoid: ' || array_to_string(list_distinct(['blur', 'text', r_name]), ', '))"


@query("SELECT r_regionkey AS target_id, n_nationkey AS style_id, 'A ' || r_name || ' ' || n_name || ' end Avoid: blur, text, ' || r_name AS prompt FROM region, nation")
def grid_prompts(spark, sf):
    g = requests.grid(table(spark, sf, "region").withColumnRenamed("r_regionkey", "target_id"), table(spark, sf, "nation").withColumnRenamed("n_nationkey", "style_id"))
    return g.select("target_id", "style_id", requests.prompt(F.lit("A"), F.col("r_name"), F.col("n_name"), F.lit("end"), F.lit("blur, text"), F.concat(F.lit("text; "), "r_name")).alias("prompt"))


@query("SELECT r_regionkey AS target_id, n_nationkey AS style_id FROM region, nation WHERE n_regionkey <> r_regionkey")
def missing_cells(spark, sf):
    nation = table(spark, sf, "nation")
    g = requests.grid(table(spark, sf, "region").select(F.col("r_regionkey").alias("target_id")), nation.select(F.col("n_nationkey").alias("style_id")))
    return requests.missing_cells(g, nation.select(F.col("n_regionkey").alias("target_id"), F.col("n_nationkey").alias("style_id")), "target_id", "style_id")


@query(f"""WITH {SQL_CONTEXT}, p AS (SELECT a.seq, b.seq AS s, b.synopsis, row_number() OVER (PARTITION BY a.seq ORDER BY b.seq DESC) AS r FROM u a JOIN u b ON b.seq BETWEEN a.seq - 12 AND a.seq - 1 AND b.synopsis IS NOT NULL),
c AS (SELECT seq, string_agg(synopsis, '|' ORDER BY s) AS context FROM p WHERE r <= 3 GROUP BY 1), n AS (SELECT doc_id, string_agg('[' || i || '] ' || x, chr(10) ORDER BY i) AS body FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS x, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM documents) GROUP BY 1)
SELECT d.doc_id AS seq, md5(concat_ws(chr(10) || chr(10), 'Before: ' || c.context, 'No. ' || d.doc_id || ' ' || d.source, n.body)) AS request FROM documents d JOIN n ON n.doc_id = d.doc_id LEFT JOIN c ON c.seq = d.doc_id""")
def request_text(spark, sf):
    from storyloom.functions.text import label, numbered

    units = requests.previous_context(docs(spark, sf).withColumn("synopsis", F.expr(SYNOPSIS)))
    text = requests.request_text(F.lit(None).cast("string"), F.array_join("context", "|"), label(F.col("seq"), F.col("source"), pattern="No. %d "), numbered(F.split("text", "\n")))
    return units.select("seq", F.md5(text).alias("request"))


@query("SELECT event_id AS seq, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events WHERE event_type <> 'error'")
def reply_parse(spark, sf):
    e = table(spark, sf, "events")
    reply = F.when(F.col("event_type") == "error", F.lit("no object")).when(F.col("event_type") == "view", F.concat(F.lit("```json\n"), "props", F.lit("\n```"))).otherwise(F.concat(F.lit("Result: "), "props", F.lit(" done")))
    good, _ = requests.parse_replies(e.select(F.col("event_id").alias("seq"), reply.alias("reply")), "k long")
    return good.select("seq", "parsed.k")
