"""Quotes against their source: exact, near, miss; coverage of speech.

The cheap checks come first and take their rows out: a quote goes to the similarity function only
if no exact check has found it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storyloom.functions.similarity import best_window_ratio
from storyloom.functions.text import SPEECH, flat, is_speech, normalized, speech_segments
from storyloom.operators.patterns import pattern_hits
from storyloom.scratch import spread, stored

#: Units with quotes up to which they are broadcast to the paragraphs.
MOST_UNITS = 1_000_000


def check_quotes(quotes: DataFrame, paragraphs: DataFrame, near: float = 0.70, norm=normalized) -> DataFrame:
    """quotes (qid, seq, para, quote) with status, para_found, para_correct, similarity.

    Paragraph 0 is no claim. Order of checks: empty; in the claimed paragraph; in any paragraph of the unit (the first counts);
    across paragraphs (para_found -1); else near or miss by similarity. para_correct is null where no
    paragraph is claimed or the quote goes across paragraphs. Quotes meet their unit once; texts of units without quotes are not shuffled
    as long as the units with quotes are few enough to be broadcast.
    """
    own = stored(quotes.withColumn("_q", norm(F.coalesce("quote", F.lit("")))), "quotes")
    wanted = own.where("_q <> ''").select("seq").distinct()
    if wanted.limit(MOST_UNITS + 1).count() <= MOST_UNITS:
        wanted = F.broadcast(wanted)
    text = paragraphs.select("seq", "para", "text").join(wanted, "seq", "left_semi").select("seq", F.col("para").alias("p"), norm(F.col("text")).alias("t"))
    units = spread(text, "seq").groupBy("seq").agg(F.array_sort(F.collect_list(F.struct("p", "t"))).alias("_u")).withColumn("_all", F.array_join(F.transform("_u", lambda x: x["t"]), ""))
    claim = F.nullif("para", F.lit(0))
    rows = spread(own, "seq").join(units, "seq", "left").withColumn("_in", (F.col("_q") != "") & F.coalesce(F.contains("_all", F.col("_q")), F.lit(False)))
    hits = F.when(F.col("_in"), F.transform(F.filter("_u", lambda x: F.contains(x["t"], F.col("_q"))), lambda x: x["p"]))
    rows = rows.withColumn("_hits", hits).withColumn("_rest", F.when(~F.col("_in") & (F.col("_q") != ""), F.coalesce("_all", F.lit("")))).drop("_u", "_all")
    # Only quotes that no exact check has found are sent to the similarity function.
    rows = rows.withColumn("_r", best_window_ratio(F.when(F.col("_rest").isNotNull(), F.col("_q")), "_rest"))
    status = F.when(F.col("_q") == "", "empty").when(F.col("_in"), "exact").when(F.col("_r") >= near, "near").otherwise("miss")
    claimed = F.coalesce(F.array_contains("_hits", claim), F.lit(False))
    place = F.when(F.col("_in"), F.when(claimed, claim).otherwise(F.coalesce(F.array_min("_hits"), F.lit(-1)))).cast("int")
    correct = F.when(F.col("_in") & (F.size("_hits") > 0) & claim.isNotNull(), claimed)
    similarity = F.when(F.col("_in"), 1.0).when(F.col("_q") == "", 0.0).otherwise(F.col("_r"))
    kept = [c for c in quotes.columns if c != "qid"]
    return rows.select("qid", *kept, status.alias("status"), place.alias("para_found"), correct.alias("para_correct"), similarity.alias("similarity"))


def quote_tables(docs: DataFrame) -> DataFrame:
    """The quote fields of analysed documents as one table: seq, field, pos, para, quote."""
    def field(name: str, items: Column, para: Column | None, text) -> DataFrame:
        rows = docs.select("seq", F.posexplode(items).alias("pos", "x"))
        return rows.select("seq", F.lit(name).alias("field"), "pos", (F.col("x.para") if para is None else para).cast("int").alias("para"), text.alias("quote"))

    spoken = [field(n, F.col(f"analysis.{n}"), None, F.col("x.text")) for n in ("dialogues", "monologues", "narration")]
    lists = lambda n, q: F.flatten(F.transform(F.col(f"analysis.{n}.{q}"), lambda c: F.coalesce(c, F.array().cast("array<string>"))))
    nested = [field(f"{n}.{q}", lists(n, q), F.lit(None), F.col("x")) for n, q in (("characters", "appearance_quotes"), ("scenes", "description_quotes"))]
    out = spoken[0]
    for more in [*spoken[1:], *nested]:
        out = out.unionByName(more)
    return out.withColumn("qid", F.xxhash64("seq", "field", "pos"))


def unit_report(checked: DataFrame, most: int = 80) -> DataFrame:
    """Counts by status, verbatim_rate (1 when there is nothing), misplaced, first problems of each unit."""
    n = lambda s: F.count_if(F.col("status") == s)
    total = n("exact") + n("near") + n("miss")
    problem = F.when(F.col("status").isin("near", "miss"), F.struct("qid", "status", "quote"))
    return checked.groupBy("seq").agg(n("exact").alias("exact"), n("near").alias("near"), n("miss").alias("miss"), total.alias("total"), F.when(total > 0, n("exact") / total).otherwise(1.0).alias("verbatim_rate"), F.count_if(F.col("para_correct") == F.lit(False)).alias("misplaced"), F.slice(F.array_sort(F.collect_list(problem)), 1, most).alias("problems"))


def coverage(paragraphs: DataFrame, extracted: DataFrame, pattern: str = SPEECH, norm=normalized, speech=is_speech, samples: int = 20) -> DataFrame:
    """seq, speech, covered, coverage_rate (1 when there is no speech), missed: speech segments of the source in the extracted quotes.

    A segment is covered if it is in the unit's extracted texts, in normal form and in order of their paragraphs, one after the other.
    """
    found = paragraphs.select("seq", "para", F.posexplode(speech_segments(F.col("text"), pattern)).alias("pos", "segment")).where(speech(F.col("segment")))
    given = extracted.groupBy("seq").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("para", norm(F.col("quote")).alias("t")))), lambda x: x["t"]), "").alias("_given"))
    rows = found.join(given, "seq", "left").withColumn("_has", F.contains(F.coalesce("_given", F.lit("")), norm(F.col("segment"))))
    missed = F.array_sort(F.collect_list(F.when(~F.col("_has"), F.struct("para", "pos", "segment"))))
    out = rows.groupBy("seq").agg(F.count("*").alias("speech"), F.count_if(F.col("_has")).alias("covered"), F.transform(F.slice(missed, 1, samples), lambda x: x["segment"]).alias("missed"))
    every = paragraphs.select("seq").distinct().join(out, "seq", "left")
    zero = F.lit(0).cast("long")
    return every.select("seq", F.coalesce("speech", zero).alias("speech"), F.coalesce("covered", zero).alias("covered"), F.coalesce(F.col("covered") / F.col("speech"), F.lit(1.0)).alias("coverage_rate"), F.coalesce("missed", F.array().cast("array<string>")).alias("missed"))


def containments(quotes: DataFrame, docs: DataFrame, anchor: int = 3) -> DataFrame:
    """(qid, seq) for every document that contains a quote, white space apart.

    Instead of every quote with every document, the quote's second to fourth words are looked up among
    the documents' word runs; containment is then checked on the candidates. Words are hashed once and runs after positions
    are exploded, in compiled code; up to a million quotes' runs are broadcast, as their number is counted before, more are shuffled. Quotes of fewer than five
    words have no such run inside them: all of them are looked for in one pass (see ``pattern_hits``).
    """
    words = lambda t: F.filter(F.split(t, r"(?U)\s+"), lambda w: w != "")
    own = quotes.select("qid", "quote", words(F.col("quote")).alias("_w"))
    long = own.where(F.size("_w") >= anchor + 2).select("qid", "quote", F.xxhash64(*[F.xxhash64(F.get("_w", F.lit(j))) for j in range(1, anchor + 1)]).alias("_h"))
    short = own.where((F.size("_w") < anchor + 2) & (F.size("_w") > 0)).select("qid", "quote")
    hashed = docs.select("seq", F.transform(words(F.col("text")), lambda w: F.xxhash64(w)).alias("_w"))
    hashed = hashed.select("seq", "_w", F.sequence(F.lit(0), F.greatest(F.size("_w") - anchor, F.lit(0))).alias("_starts"))
    runs = hashed.select("seq", "_w", F.explode_outer("_starts").alias("_i"))
    runs = runs.select("seq", F.when(F.col("_i") + anchor <= F.size("_w"), F.xxhash64(*[F.get("_w", F.col("_i") + j) for j in range(anchor)])).alias("_h"))
    wanted = long.select("_h").distinct()
    if long.limit(1_000_001).count() <= 1_000_000:
        wanted = F.broadcast(wanted)
    pairs = runs.join(wanted, "_h", "left_semi").distinct().join(long, "_h").select("seq", "qid", "quote").distinct()
    out = pairs.join(docs.select("seq", "text"), "seq").where(F.contains(flat(F.col("text")), flat(F.col("quote")))).select("qid", "seq")
    if not short.isEmpty():
        bare = short.select("qid", flat(F.col("quote")).alias("word"))
        hits = pattern_hits(docs.select("seq", flat(F.col("text")).alias("text")), bare, overlapping=True).select("seq", "word").distinct()
        out = out.unionByName(hits.join(bare, "word").select("qid", "seq"))
    return out.distinct()


def position_refs(refs: DataFrame, paragraphs: DataFrame, pattern: str = SPEECH) -> DataFrame:
    """refs (ref, seq, para, q, text) with ``resolved`` or ``error``: the q-th quoted span (from 0), a checked substring, or the whole paragraph."""
    rows = refs.join(paragraphs.select("seq", "para", F.col("text").alias("_p")), ["seq", "para"], "left")
    spans = F.regexp_extract_all("_p", F.lit(pattern), 1)
    error = F.when(F.col("_p").isNull(), "para out of range").when(F.col("q").isNotNull() & ((F.col("q") < 0) | (F.col("q") >= F.size(spans))), "q out of range").when(F.col("q").isNull() & F.col("text").isNotNull() & ~F.contains("_p", F.col("text")), "not in paragraph")
    value = F.when(F.col("q").isNotNull(), F.get(spans, F.col("q"))).otherwise(F.coalesce("text", "_p"))
    return rows.withColumn("error", error).withColumn("resolved", F.when(F.col("error").isNull(), value)).drop("_p")
