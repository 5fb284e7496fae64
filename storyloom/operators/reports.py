"""Reports as ordered tables of lines: keys to sort by, and ``line``. ``readers.write_report`` makes a file of them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Characters of the scenes, and of what a unit sets up or resolves, on a line of a digest.
SCENES, HINTS = 60, 120


def _stacked(*parts: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def _listed(values: Column, between: str, most: int | None = None) -> Column:
    text = F.array_join(values, between)
    return text if most is None else F.substring(text, 1, most)


def digest(rows: DataFrame, most_names: int = 5, dash: str = "—") -> DataFrame:
    """seq, k, line: heading, synopsis, and names, scenes and tone of each unit; what it sets up and resolves, where there is any.

    rows: seq, title, synopsis, tone, and the arrays names, scenes, foreshadows, reveals. A dash stands for what is empty.
    """
    filled = lambda c: F.when(F.coalesce(c, F.lit("")) == "", dash).otherwise(c)
    about = F.concat_ws(" | ", filled(_listed(F.slice("names", 1, most_names), ", ")), filled(_listed(F.array_distinct("scenes"), ", ", SCENES)), filled(F.col("tone")))
    hint = lambda sign, c: F.when(F.size(c) > 0, F.concat(F.lit(f"    {sign} "), _listed(F.col(c), "; ", HINTS)))
    lines = F.array(F.concat(F.lit("["), "seq", F.lit("] "), F.coalesce("title", F.lit(""))), F.concat(F.lit("    "), F.trim(F.coalesce("synopsis", F.lit("")))), F.concat(F.lit("    "), about), hint("+", "foreshadows"), hint("-", "reveals"))
    return rows.select("seq", F.posexplode(lines).alias("k", "line")).where("line IS NOT NULL")


def dossier(hits: DataFrame, paragraphs: DataFrame, densest: int = 20) -> DataFrame:
    """word, seq, para, k, line: for each word its totals and densest units, then by unit every paragraph that holds it.

    hits: word, seq, para, one row a hit. paragraphs: seq, para, text. Lines of the head have seq and para null.
    """
    none = F.lit(None).cast("long")
    n = hits.groupBy("word", "seq").agg(F.count("*").alias("n"))
    total = n.groupBy("word").agg(F.sum("n").alias("hits"), F.count("*").alias("units"), F.min("seq").alias("first"), F.max("seq").alias("last"), F.slice(F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("less"), "seq"))), 1, densest).alias("top"))
    about = F.concat(F.lit("- "), "hits", F.lit(" hits in "), "units", F.lit(" units ("), "first", F.lit(" to "), "last", F.lit(")"))
    top = F.concat(F.lit("- densest: "), F.array_join(F.transform("top", lambda x: F.concat(x["seq"], F.lit(" ("), -x["less"], F.lit(")"))), ", "))
    head = total.select("word", none.alias("seq"), none.cast("int").alias("para"), F.posexplode(F.array(F.concat(F.lit("# "), "word"), about, top)).alias("k", "line"))
    units = n.select("word", F.col("seq").cast("long").alias("seq"), F.lit(0).alias("para"), F.lit(0).alias("k"), F.concat(F.lit("## "), "seq", F.lit(" ["), "n", F.lit("]")).alias("line"))
    body = hits.select("word", "seq", "para").distinct().join(paragraphs.select("seq", "para", "text"), ["seq", "para"])
    return _stacked(head, units, body.select("word", F.col("seq").cast("long").alias("seq"), "para", F.lit(0).alias("k"), F.concat(F.lit("["), "para", F.lit("] "), "text").alias("line")))


def roster(rows: DataFrame, group: str = "season") -> DataFrame:
    """group, tier, nth, line: of each group its tiers with their size, then the names of each by units and first unit. rows: see ``sequence.roster``."""
    heads = rows.groupBy(group, "tier").agg(F.count("*").alias("n"))
    doubt = F.when(F.col("doubt"), " ?").otherwise("")
    debut = F.when(F.col("debut"), " *").otherwise("")
    line = F.concat(F.lit("- "), "name", doubt, debut, F.lit(": "), "units", F.lit(" units from "), "first_seq")
    body = rows.select(group, "tier", F.format_string("%010d %010d %s", F.lit(9_999_999_999) - F.col("units"), "first_seq", "name").alias("nth"), line.alias("line"))
    return _stacked(heads.select(group, "tier", F.lit("").alias("nth"), F.concat(F.lit("## "), group, F.lit(" "), "tier", F.lit(" ("), "n", F.lit(")")).alias("line")), body)


def prompts(cells: DataFrame, target: str = "target_id", style: str = "style_id") -> DataFrame:
    """target, style, k, line: a heading for each target, then its prompts, each under the style's. cells: target, style, prompt."""
    heads = cells.select(target).distinct().select(target, F.lit(None).cast(dict(cells.dtypes)[style]).alias(style), F.lit(0).alias("k"), F.concat(F.lit("## "), target).alias("line"))
    lines = F.array(F.concat(F.lit("### "), target, F.lit(" x "), style), F.col("prompt"))
    return _stacked(heads, cells.select(target, style, F.posexplode(lines).alias("k", "line")))


def tier_lines(tiers: DataFrame, width: int = 1000) -> DataFrame:
    """tier, chunk, line: the units of each tier, those of ``width`` numbers on a line. tiers: seq, tier."""
    own = tiers.groupBy("tier", F.floor(F.col("seq") / width).alias("chunk")).agg(F.array_sort(F.collect_list("seq")).alias("seqs"))
    return own.select("tier", "chunk", F.concat("tier", F.lit(": "), F.array_join(F.col("seqs").cast("array<string>"), " ")).alias("line"))
