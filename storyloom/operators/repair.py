"""Repair of quotes: split what was joined, strip narration, align to the source, roll back if worse."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from storyloom.functions.similarity import align_span
from storyloom.functions.text import SPEECH, flat, is_speech
from storyloom.scratch import spread, stored

# Fixed value: a quoted segment, whose closing mark is not required.
SEGMENT = r'[“"]([^“”"]+)'
#: Strategies in the order in which they are tried.
ORDER = {"across paragraphs": 1, "joined": 2, "narration": 3, "aligned": 4}


def segments(paragraphs: DataFrame, pattern: str = SEGMENT) -> DataFrame:
    """seq, para, pos, segment, flat: quoted segments (leading marks off, white space off at the ends)."""
    rows = paragraphs.select("seq", "para", F.posexplode(F.regexp_extract_all("text", F.lit(pattern), 1)).alias("pos", "segment"))
    return rows.withColumn("segment", F.regexp_replace("segment", r"(?U)^[\s：，、；:,;]+|\s+$", "")).where("segment <> ''").withColumn("flat", flat(F.col("segment")))


def _joining(quotes: DataFrame, segs: DataFrame, most: int) -> DataFrame:
    """quotes with start_para, start_pos, parts: where 2 to ``most`` neighbouring segments of the unit make the whole quote, white space apart.

    Runs are not made for every segment: each carries those after it to the quotes of its unit that begin with it, and what
    the quote holds decides how many count.
    """
    w = Window.partitionBy("seq").orderBy("para", "pos").rowsBetween(0, most - 1)
    rows = segs.select("seq", F.col("para").alias("start_para"), F.col("pos").alias("start_pos"), F.collect_list(F.struct("para", "segment", "flat")).over(w).alias("_next"))
    own = quotes.withColumn("_q", flat(F.col("quote")))
    hits = rows.join(own, "seq").where(F.startswith("_q", F.col("_next")[0]["flat"]))
    joined = lambda n: F.array_join(F.transform(F.slice("_next", 1, n), lambda x: x["flat"]), "")
    n = F.filter(F.sequence(F.lit(2), F.greatest(F.lit(2), F.size("_next"))), lambda n: (n <= F.size("_next")) & (joined(n) == F.col("_q")))
    hits = hits.withColumn("_n", F.get(n, F.lit(0))).where("_n IS NOT NULL")
    return hits.withColumn("parts", F.transform(F.slice("_next", 1, F.col("_n")), lambda x: F.struct(x["segment"].alias("text"), x["para"].alias("para")))).drop("_next", "_n", "_q")


def _first(rows: DataFrame, *order) -> DataFrame:
    w = Window.partitionBy("qid").orderBy(*order)
    return rows.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def split_joined(quotes: DataFrame, segs: DataFrame, most: int = 8) -> DataFrame:
    """qid, parts: quotes that join neighbouring segments of one paragraph (the claimed one first, then the earliest)."""
    hits = _joining(quotes, segs, most).where(F.element_at("parts", -1)["para"] == F.col("start_para"))
    return _first(hits, F.desc(F.coalesce((F.col("start_para") == F.col("para")).cast("int"), F.lit(0))), "start_para", "start_pos").select("qid", F.lit("joined").alias("kind"), "parts")


def split_across(quotes: DataFrame, segs: DataFrame, span: int = 3, most: int = 8) -> DataFrame:
    """qid, parts: quotes that join segments of neighbouring paragraphs, at most ``span`` from the claimed one."""
    runs = _joining(quotes, segs, most).withColumn("end_para", F.element_at("parts", -1)["para"]).where("end_para <> start_para")
    hits = runs.where(F.col("start_para").between(F.col("para") - span, F.col("para") + span) & F.col("end_para").between(F.col("para") - span, F.col("para") + span))
    return _first(hits, "start_para", "start_pos").select("qid", F.lit("across paragraphs").alias("kind"), "parts")


def strip_narration(quotes: DataFrame, segs: DataFrame) -> DataFrame:
    """qid, parts: the segments of a paragraph, two at least, whose first 8 characters are in the quote."""
    hits = quotes.withColumn("_f", flat(F.col("quote"))).select("qid", "seq", F.col("para").alias("claimed"), "_f").join(segs, "seq").where(F.contains("_f", F.substring("flat", 1, 8)))
    found = hits.groupBy("qid", "para", "claimed").agg(F.array_sort(F.collect_list(F.struct("pos", "segment"))).alias("s")).where(F.size("s") >= 2)
    return _first(found, F.desc(F.coalesce((F.col("claimed") == F.col("para")).cast("int"), F.lit(0))), "para").select("qid", F.lit("narration").alias("kind"), F.transform("s", lambda x: F.struct(x["segment"].alias("text"), F.col("para").alias("para"))).alias("parts"))


def align(quotes: DataFrame, paragraphs: DataFrame, accept: float = 0.75) -> DataFrame:
    """qid, parts, score: the substring of the unit's paragraphs that fits best; the claimed paragraph wins ties, then the earliest."""
    rows = quotes.select("qid", "seq", "quote", F.col("para").alias("claimed")).join(paragraphs.select("seq", "para", "text"), "seq")
    rows = spread(rows, "qid", "para").withColumn("a", align_span(accept)("quote", "text"))
    rows = rows.where(F.col("a.score") >= accept)
    best = _first(rows, F.desc("a.score"), F.desc(F.coalesce((F.col("claimed") == F.col("para")).cast("int"), F.lit(0))), "para", "a.lo")
    return best.select("qid", F.lit("aligned").alias("kind"), F.array(F.struct(F.col("a.span").alias("text"), F.col("para"))).alias("parts"), F.col("a.score").alias("score"))


def repair(quotes: DataFrame, paragraphs: DataFrame, pattern: str = SEGMENT, opening: str = '^[“"]|[^“”"][“"]') -> DataFrame:
    """quotes (qid, seq, para, field, quote), all of them wrong, with kind and parts of the first strategy that works.

    Nested fields are only aligned; narration is stripped from dialogue that holds an opening quote. What
    no strategy can repair has null parts and stays.
    """
    segs = stored(segments(paragraphs.join(quotes.select("seq").distinct(), "seq", "left_semi"), pattern), "segments")
    spoken = quotes.where(~F.contains("field", F.lit(".")))
    tried = split_across(spoken, segs).unionByName(split_joined(spoken, segs)).unionByName(strip_narration(spoken.where((F.col("field") == "dialogues") & F.col("quote").rlike(opening)), segs))
    tried = stored(tried, "tried")
    left = quotes.join(tried.select("qid"), "qid", "left_anti")
    tried = tried.unionByName(align(left, paragraphs).drop("score"))
    rank = F.create_map(*[F.lit(x) for kv in ORDER.items() for x in kv])
    chosen = _first(tried.withColumn("_r", rank[F.col("kind")]), "_r").drop("_r")
    return quotes.join(chosen, "qid", "left")


def rolled_back(before: DataFrame, after: DataFrame) -> DataFrame:
    """seq, keep: ``old`` where the rate fell or misses rose, else ``new``. Both: seq, verbatim_rate, miss."""
    b, a = before.select("seq", F.col("verbatim_rate").alias("rate_before"), F.col("miss").alias("miss_before")), after.select("seq", F.col("verbatim_rate").alias("rate_after"), F.col("miss").alias("miss_after"))
    worse = (F.col("rate_after") < F.col("rate_before")) | (F.col("miss_after") > F.col("miss_before"))
    return b.join(a, "seq").withColumn("keep", F.when(worse, "old").otherwise("new"))


def missing_dialogue(paragraphs: DataFrame, extracted: DataFrame, pattern: str = SPEECH, speech=is_speech) -> DataFrame:
    """seq, para, speaker, text, _filled: speech segments that no extracted quote holds, each text once a unit."""
    found = paragraphs.select("seq", "para", F.posexplode(F.regexp_extract_all("text", F.lit(pattern), 1)).alias("pos", "segment")).where(speech(F.col("segment"))).withColumn("_f", flat(F.col("segment")))
    given = extracted.select("seq", flat(F.col("quote")).alias("_g"))
    rest = found.join(given, (found["seq"] == given["seq"]) & F.contains("_g", F.col("_f")), "left_anti")
    w = Window.partitionBy("seq", "_f").orderBy("para", "pos")
    return rest.withColumn("_n", F.row_number().over(w)).where("_n = 1").select("seq", "para", F.lit("unstated").alias("speaker"), F.col("segment").alias("text"), F.lit(True).alias("_filled"))


def missing_characters(speakers: DataFrame, attendees: DataFrame, known: DataFrame) -> DataFrame:
    """seq, name, _filled: speakers and attendees without an entry."""
    names = speakers.select("seq", "name").union(attendees.select("seq", "name")).where("name IS NOT NULL AND trim(name) <> ''").distinct()
    return names.join(known, ["seq", "name"], "left_anti").withColumn("_filled", F.lit(True))


def repair_log(repaired: DataFrame, before: DataFrame, after: DataFrame) -> DataFrame:
    """seq, field, kind, before, after and the unit's rates, one row for each quote that was repaired.

    repaired: as :func:`repair` returns it. before, after: seq, verbatim_rate, coverage_rate of the units.
    """
    changed = repaired.where("kind IS NOT NULL").select("qid", "seq", "field", "kind", F.col("quote").alias("before"), F.transform("parts", lambda x: x["text"]).alias("after"))
    rates = lambda df, when: df.select("seq", F.col("verbatim_rate").alias(f"rate_{when}"), F.col("coverage_rate").alias(f"coverage_{when}"))
    return changed.join(rates(before, "before"), "seq", "left").join(rates(after, "after"), "seq", "left")
