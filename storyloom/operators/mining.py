"""Names, metrics, keyword threads and concordances by statistics alone."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from storyloom.functions.text import SPEECH, has_any, speech_segments
from storyloom.operators.patterns import pattern_hits

# Fixed value: what follows a closing quote.
AFTER_QUOTE = r"[”\"]([一-鿿]{2,6})"


def mine_names(docs: DataFrame, after: str = AFTER_QUOTE, sizes: tuple[int, ...] = (2, 3, 4), least_hits: int = 100, least_variety: int = 25, least_units: int = 20) -> DataFrame:
    """name, hits, variety, units, first_seq, last_seq: prefixes of what follows ``after``, when a character follows them.

    Names are told from phrases by the variety of characters that come next.
    """
    s = docs.select("seq", F.explode(F.regexp_extract_all("text", F.lit(after), 1)).alias("s"))
    rows = s.select("seq", "s", F.explode(F.array(*[F.lit(n) for n in sizes])).alias("n")).where(F.length("s") > F.col("n"))
    rows = rows.select("seq", F.col("s").substr(F.lit(1), F.col("n")).alias("name"), F.col("s").substr(F.col("n") + 1, F.lit(1)).alias("following"))
    out = rows.groupBy("name").agg(F.count("*").alias("hits"), F.count_distinct("following").alias("variety"), F.count_distinct("seq").alias("units"), F.min("seq").alias("first_seq"), F.max("seq").alias("last_seq"))
    return out.where((F.col("hits") >= least_hits) & (F.col("variety") >= least_variety) & (F.col("units") >= least_units))


def name_units(docs: DataFrame, names: DataFrame, after: str = AFTER_QUOTE, sizes: tuple[int, ...] = (2, 3, 4), most: int = 200) -> DataFrame:
    """name, units: the first ``most`` units of each mined name, sorted. names: see :func:`mine_names`."""
    s = docs.select("seq", F.explode(F.array_distinct(F.regexp_extract_all("text", F.lit(after), 1))).alias("s"))
    rows = s.select("seq", "s", F.explode(F.array(*[F.lit(n) for n in sizes])).alias("n")).where(F.length("s") > F.col("n"))
    found = rows.select("seq", F.col("s").substr(F.lit(1), F.col("n")).alias("name")).distinct().join(names.select("name"), "name", "left_semi")
    ranked = found.withColumn("_k", F.row_number().over(Window.partitionBy("name").orderBy("seq"))).where(F.col("_k") <= most)
    return ranked.groupBy("name").agg(F.array_sort(F.collect_list("seq")).alias("units"))


def without_covered(names: DataFrame, least: int = 1) -> DataFrame:
    """Drop names with a proper prefix among the names whose variety is no less. Prefixes are joined by equality."""
    prefixes = names.where(F.length("name") > least).select(F.col("name").alias("_long"), F.col("variety").alias("_v"), F.explode(F.transform(F.sequence(F.lit(least), F.length("name") - 1), lambda n: F.col("name").substr(F.lit(1), n))).alias("name"))
    covered = prefixes.join(names.select("name", "variety"), "name").where("variety >= _v").select(F.col("_long").alias("name")).distinct()
    return names.join(covered, "name", "left_anti")


def unit_metrics(docs: DataFrame, pattern: str = SPEECH, chars: Column | None = None) -> DataFrame:
    """seq, chars, paragraphs, speech_lines, speech_chars, dialogue_ratio (3 places, 0 for an empty unit)."""
    chars = F.length("text") if chars is None else chars
    rows = docs.select("seq", chars.cast("long").alias("chars"), F.size(F.split("text", "\n")).alias("paragraphs"), speech_segments(F.col("text"), pattern).alias("_s"))
    spoken = F.aggregate("_s", F.lit(0).cast("long"), lambda a, s: a + F.length(s))
    return rows.select("seq", "chars", "paragraphs", F.size("_s").alias("speech_lines"), spoken.alias("speech_chars"), F.when(F.col("chars") > 0, F.round(spoken / F.col("chars"), 3)).otherwise(0.0).alias("dialogue_ratio"))


def corpus_totals(metrics: DataFrame) -> DataFrame:
    return metrics.agg(F.count("*").alias("units"), F.sum("chars").alias("chars"), F.percentile("chars", 0.5).alias("median_chars"), F.percentile("dialogue_ratio", 0.5).alias("median_ratio"), F.min("chars").alias("least_chars"), F.max("chars").alias("most_chars"))


def newcomers(names: DataFrame, last_seq: int, bucket: int = 25, first: int = 1) -> DataFrame:
    """bucket, start, end, newcomers for every bucket up to ``last_seq``; names: name, first_seq. Empty buckets stay."""
    counts = names.groupBy(F.floor((F.col("first_seq") - first) / bucket).alias("bucket")).agg(F.count("*").alias("n"))
    every = names.sparkSession.range((last_seq - first) // bucket + 1).withColumnRenamed("id", "bucket")
    return every.join(counts, "bucket", "left").select("bucket", (F.col("bucket") * bucket + first).alias("start"), F.least(F.col("bucket") * bucket + first + bucket - 1, F.lit(last_seq)).alias("end"), F.coalesce("n", F.lit(0)).alias("newcomers"))


def newcomer_names(names: DataFrame, bucket: int = 25, first: int = 1, most: int = 200) -> DataFrame:
    """bucket, names: the first ``most`` newcomers of each bucket in order of appearance. names: name, first_seq."""
    rows = names.withColumn("bucket", F.floor((F.col("first_seq") - first) / bucket))
    ranked = rows.withColumn("_k", F.row_number().over(Window.partitionBy("bucket").orderBy("first_seq", "name"))).where(F.col("_k") <= most)
    return ranked.groupBy("bucket").agg(F.transform(F.array_sort(F.collect_list(F.struct("_k", "name"))), lambda x: x["name"]).alias("names"))


def hottest(buckets: DataFrame, most: int = 8) -> DataFrame:
    return buckets.orderBy(F.desc("newcomers"), "bucket").limit(most).orderBy("bucket")


def longest_first(words: list[str]) -> str:
    """An alternation that prefers longer words."""
    return "|".join(re.escape(w) for w in sorted(set(words), key=lambda w: (-len(w), w)))


#: Words that an alternation tries one after the other; more go through an automaton.
FEW_WORDS = 200


def word_hits(rows: DataFrame, words: list[str] | DataFrame, exclude: list[str] = (), keep: tuple[str, ...] = ("seq",), text: str = "text") -> DataFrame:
    """keep, word for each hit, longest match first; excluded phrases are blanked out before. words: a list, or a table (word) of any size."""
    t = F.regexp_replace(text, longest_first(list(exclude)), "\u0000") if exclude else F.col(text)
    if not isinstance(words, DataFrame):
        if len(words) <= FEW_WORDS:
            return rows.select(*keep, F.explode(F.regexp_extract_all(t, F.lit(f"({longest_first(words)})"), 1)).alias("word"))
        words = rows.sparkSession.createDataFrame([(w,) for w in words], "word string")
    return pattern_hits(rows.select(*keep, t.alias("_blanked")), words, keep, "_blanked").drop("start")


def thread_hits(docs: DataFrame, topics: dict[str, list[str]]) -> DataFrame:
    """topic, seq, n of keyword hits."""
    owner = docs.sparkSession.createDataFrame([(t, w) for t, ws in topics.items() for w in ws], "topic string, word string")
    hits = word_hits(docs, [w for ws in topics.values() for w in ws]).groupBy("seq", "word").agg(F.count("*").alias("n"))
    return hits.join(F.broadcast(owner), "word").groupBy("topic", "seq").agg(F.sum("n").alias("n"))


def threads(hits: DataFrame) -> DataFrame:
    """topic, total, units, first, last of :func:`thread_hits`."""
    return hits.groupBy("topic").agg(F.sum("n").alias("total"), F.count("*").alias("units"), F.min("seq").alias("first"), F.max("seq").alias("last"))


def thread_chunks(hits: DataFrame, size: int = 1000) -> DataFrame:
    """topic, chunk, first, by_seq: hits by unit, as maps of the units of ``size`` numbers each, so that no row grows with the corpus."""
    chunks = hits.groupBy("topic", F.floor(F.col("seq") / size).alias("chunk")).agg(F.array_sort(F.collect_list(F.struct("seq", "n"))).alias("own"))
    return chunks.select("topic", "chunk", F.col("own")[0]["seq"].alias("first"), F.map_from_entries("own").alias("by_seq"))


def topk_by_window(items: DataFrame, width: int = 20, k: int = 3, first: int = 1) -> DataFrame:
    """window, item, n, rank: the k most frequent items of each window of ``width`` units."""
    counts = items.groupBy(F.floor((F.col("seq") - first) / width).alias("window"), "item").agg(F.count("*").alias("n"))
    return counts.withColumn("rank", F.row_number().over(Window.partitionBy("window").orderBy(F.desc("n"), "item"))).where(F.col("rank") <= k)


def spans(items: DataFrame, least_units: int = 1) -> DataFrame:
    """item, first, last, units."""
    return items.groupBy("item").agg(F.min("seq").alias("first"), F.max("seq").alias("last"), F.count_distinct("seq").alias("units")).where(F.col("units") >= least_units)


def dossier(paragraphs: DataFrame, sure: list[str], ambiguous: list[str] = (), exclude: list[str] = ()) -> DataFrame:
    """word, is_sure, hits, units, first_seq, first_para: sure aliases everywhere, ambiguous ones only in paragraphs without a sure hit."""
    hits = word_hits(paragraphs, [*sure, *ambiguous], exclude, ("seq", "para")).withColumn("is_sure", F.col("word").isin(list(sure)))
    rows = hits.where("is_sure").unionByName(hits.where("NOT is_sure").join(hits.where("is_sure").select("seq", "para").distinct(), ["seq", "para"], "left_anti"))
    first = F.min(F.struct("seq", "para"))
    return rows.groupBy("word", "is_sure").agg(F.count("*").alias("hits"), F.count_distinct("seq").alias("units"), first["seq"].alias("first_seq"), first["para"].alias("first_para"))


def densest(hits: DataFrame, most: int = 40, unit: str = "seq") -> DataFrame:
    """word, unit, n, rank: the units in which each word has most hits. hits: word, unit."""
    n = hits.groupBy("word", unit).agg(F.count("*").alias("n"))
    return n.withColumn("rank", F.row_number().over(Window.partitionBy("word").orderBy(F.desc("n"), unit))).where(F.col("rank") <= most)


def tags(rows: DataFrame, words: dict[str, list[str]], keep: tuple[str, ...] = ("seq",)) -> DataFrame:
    """keep, tag: a tag applies when any of its words occurs."""
    found = F.filter(F.array(*[F.when(has_any(F.col("text"), ws), F.lit(t)) for t, ws in words.items()]), lambda t: t.isNotNull())
    return rows.select(*keep, F.explode(found).alias("tag"))


def context(paragraphs: DataFrame, hits: DataFrame, around: int = 2) -> DataFrame:
    """Paragraphs within ``around`` of hits (seq, para), each once, with is_hit; never beyond the unit."""
    near = hits.select("seq", "para").distinct().select("seq", F.explode(F.sequence(F.col("para") - around, F.col("para") + around)).alias("near"), "para")
    near = near.groupBy("seq", F.col("near").alias("para")).agg(F.max(F.col("near") == F.col("para")).alias("is_hit"))
    return paragraphs.join(near, ["seq", "para"])


def likely_speaker(text: Column, quote_at: Column, names: str) -> Column:
    """very likely: a name before the quote and none after it; possible: one after it; else undecided."""
    before = text.substr(F.lit(1), quote_at - 1)
    rest = text.substr(quote_at + 1, F.length(text))
    after = F.regexp_replace(rest, r"^[^”\"]*[”\"]?", "")
    return F.when(before.rlike(names) & ~after.rlike(names), "very likely").when(after.rlike(names), "possible").otherwise("undecided")
