"""Hand-written analyses to checked documents: references become quotes, and units are verified as a whole."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storyloom.functions.text import SPEECH, is_speech, normalized
from storyloom.operators import verify

#: A unit passes with nothing near or missing and this much of its speech covered.
LEAST_COVERAGE = 0.95


def expanded(refs: DataFrame, paragraphs: DataFrame, pattern: str = SPEECH) -> tuple[DataFrame, DataFrame]:
    """(quotes, rejects) of references to places. refs: seq, field, pos, para, q, text.

    A reference is the q-th quoted span of a paragraph (from 0), a substring that must be in it, or all of it. quotes: qid, seq,
    field, pos, para, quote; rejects: seq, field, pos, error.
    """
    found = verify.position_refs(refs, paragraphs, pattern)
    quotes = found.where("error IS NULL").select(F.xxhash64("seq", "field", "pos").alias("qid"), "seq", "field", "pos", "para", F.col("resolved").alias("quote"))
    return quotes, found.where("error IS NOT NULL").select("seq", "field", "pos", "error")


def documents(quotes: DataFrame) -> DataFrame:
    """seq, fields: a map from each field to its quotes (para, text) in order."""
    own = quotes.groupBy("seq", "field").agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "para", F.col("quote").alias("text")))), lambda x: F.struct(x["para"].alias("para"), x["text"].alias("text"))).alias("quotes"))
    return own.groupBy("seq").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("field", "quotes")))).alias("fields"))


def verified(quotes: DataFrame, paragraphs: DataFrame, rejects: DataFrame | None = None, spoken: str = "dialogues", pattern: str = SPEECH, norm=normalized, speech=is_speech) -> DataFrame:
    """seq, total, near, miss, verbatim_rate, coverage_rate, errors, passed of each unit with quotes or rejects."""
    report = verify.unit_report(verify.check_quotes(quotes, paragraphs, norm=norm)).select("seq", "total", "near", "miss", "verbatim_rate")
    covered = verify.coverage(paragraphs, quotes.where(F.col("field") == spoken), pattern, norm, speech).select("seq", "coverage_rate")
    units = report.select("seq") if rejects is None else report.select("seq").union(rejects.select("seq")).distinct()
    zero = F.lit(0).cast("long")
    errors = units.limit(0).select("seq", zero.alias("errors")) if rejects is None else rejects.groupBy("seq").agg(F.count("*").alias("errors"))
    rows = units.join(report, "seq", "left").join(covered, "seq", "left").join(errors, "seq", "left")
    rows = rows.select("seq", *[F.coalesce(c, zero).alias(c) for c in ("total", "near", "miss")], F.coalesce("verbatim_rate", F.lit(1.0)).alias("verbatim_rate"), F.coalesce("coverage_rate", F.lit(1.0)).alias("coverage_rate"), F.coalesce("errors", zero).alias("errors"))
    return rows.withColumn("passed", (F.col("near") + F.col("miss") + F.col("errors") == 0) & (F.col("coverage_rate") >= LEAST_COVERAGE))


def facts_for_validation(checked: DataFrame, covered: DataFrame, mentions: DataFrame, speakers: DataFrame, attendees: DataFrame, reviews: DataFrame, known: Column | None = None) -> DataFrame:
    """What :func:`storyloom.operators.quality.validation` looks at, but for the fields of the unit itself, by seq.

    checked: seq, near, miss, verbatim_rate. covered: seq, coverage_rate. mentions: seq, name. speakers, attendees: seq, name.
    reviews: seq, stage, text. A speaker without a mention is a ghost; an attendee without one is unregistered. ``known`` (on
    name) says which names need no entry.
    """
    free = known if known is not None else F.lit(False)
    missing = lambda rows, n: rows.where(F.col("name").isNotNull() & ~free).select("seq", "name").distinct().join(mentions.select("seq", "name").distinct(), ["seq", "name"], "left_anti").groupBy("seq").agg(F.count("*").alias(n))
    twice = mentions.groupBy("seq", "name").agg(F.count("*").alias("n")).where("n > 1").groupBy("seq").agg(F.count("*").alias("duplicate_names"))
    told = reviews.groupBy("seq").agg(F.count_distinct("stage").alias("stages"), F.min(F.length("text")).alias("review_length"), F.count("*").alias("calls"))
    out = checked.join(covered, "seq", "full").join(twice, "seq", "full").join(missing(speakers, "ghost_speakers"), "seq", "full").join(missing(attendees, "unregistered"), "seq", "full").join(told, "seq", "full")
    return out.fillna(0, ["near", "miss", "duplicate_names", "ghost_speakers", "unregistered", "stages", "review_length", "calls"]).fillna(1.0, ["verbatim_rate", "coverage_rate"])
