"""Raw lines to units: title runs, body lines, junk with an audit, health."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from storyloom.functions.text import strip

# The form of a numbered title, and what site notices hold.
TITLE = r"^第\s*(\d+)\s*章(.*)$"
JUNK = "请点击下一页|本小章还未完|小主，这个章节后面还有|爱下电子书|ixdzs"


def paragraphs(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """seq, para (from 1), text of each line."""
    return docs.select(F.col(key).alias("seq"), F.posexplode(F.split(text, "\n")).alias("para", "text")).withColumn("para", F.col("para") + 1)


def is_title(line: Column, pattern: str = TITLE) -> Column:
    """Not indented, and of the form of a title."""
    return ~line.rlike("^[ 　]") & strip(line).rlike(pattern)


def classify_lines(lines: DataFrame, title: Column, junk: Column | str = JUNK, doc: str = "doc", line_no: str = "line_no") -> DataFrame:
    """Add kind (title, blank, dup title, inserted, body), is_head and unit (number of heads so far; null before the first).

    A run of titles on consecutive lines is one head; the lines after belong to its unit. Windows are by
    document.
    """
    s = strip(F.col("text"))
    inserted = s.rlike(junk) if isinstance(junk, str) else junk
    kind = F.when(title, "title").when(s == "", "blank").when(s.rlike(TITLE), "dup title").when(inserted, "inserted").otherwise("body")
    w = Window.partitionBy(doc).orderBy(line_no)
    before = F.lag(title).over(w)
    marked = lines.withColumn("kind", kind).withColumn("is_head", title & ~F.coalesce(before, F.lit(False)))
    unit = F.sum(F.col("is_head").cast("int")).over(w.rowsBetween(Window.unboundedPreceding, 0))
    return marked.withColumn("unit", F.when(unit > 0, unit))


def units(classified: DataFrame, pattern: str = TITLE, doc: str = "doc", line_no: str = "line_no") -> DataFrame:
    """One row a unit: numbers, titles, line range, counts, paragraphs, stripped lines."""
    ordered = lambda when, *cols: F.array_sort(F.collect_list(F.when(when, F.struct(line_no, *cols))))
    rows = classified.where("unit IS NOT NULL").withColumn("s", strip(F.col("text")))
    titles, body = ordered(F.col("kind") == "title", "s"), ordered(F.col("kind") == "body", "s")
    gone = ordered(F.col("kind").isin("dup title", "inserted"), "kind", "s")
    out = rows.groupBy(doc, "unit").agg(titles.alias("titles"), body.alias("body"), gone.alias("stripped_lines"), F.min(line_no).alias("line_start"), F.max(line_no).alias("line_end"))
    number = lambda t: F.regexp_extract(t, pattern, 1).cast("int")
    out = out.withColumn("seq", F.row_number().over(Window.partitionBy(doc).orderBy("unit")))
    return out.select(
        doc, "seq", F.format_string("ch%04d", "seq").alias("chapter_id"), number(F.col("titles")[0]["s"]).alias("declared_num"), strip(F.regexp_extract(F.col("titles")[0]["s"], pattern, 2)).alias("title"), F.col("titles")[0]["s"].alias("raw_title_line"),
        F.transform(F.slice("titles", 2, 1_000_000), lambda t: F.struct(number(t["s"]).alias("declared_num"), strip(F.regexp_extract(t["s"], pattern, 2)).alias("title"))).alias("merged_titles"), (F.size("titles") > 1).alias("is_merged"),
        "line_start", "line_end", F.size("body").alias("paragraph_count"), F.aggregate("body", F.lit(0), lambda a, b: a + F.length(b["s"])).alias("char_count"), "stripped_lines", F.transform("body", lambda b: b["s"]).alias("paragraphs"),
    )


def corpus_meta(units_: DataFrame) -> DataFrame:
    merged = F.size("merged_titles")
    return units_.groupBy("doc").agg(F.sum(1 + merged).alias("title_line_count"), F.count("*").alias("unit_count"), F.sum(F.col("is_merged").cast("int")).alias("merged_unit_count"), F.min("declared_num").alias("declared_num_min"), F.max("declared_num").alias("declared_num_max"), F.sum("char_count").alias("total_chars"))


def number_health(df: DataFrame, number: str) -> DataFrame:
    """number, kind: numbers that occur more than once, and those missing between the least and the largest.

    Gaps come from neighbours: a range of them is expanded where it is found, so nothing is compared with
    the whole range of numbers.
    """
    counts = df.where(F.col(number).isNotNull()).groupBy(F.col(number).cast("long").alias("number")).agg(F.count("*").alias("n"))
    bucket = F.floor(F.col("number") / 1_000_000)
    w = Window.partitionBy("bucket").orderBy("number")
    marked = counts.withColumn("bucket", bucket).withColumn("following", F.lead("number").over(w))
    # The last number of a bucket is followed by the first of the next one that has any.
    edges = marked.groupBy("bucket").agg(F.min("number").alias("first"))
    edges = edges.select("bucket", F.lead("first").over(Window.orderBy("bucket")).alias("next_first"))  # a row for each million numbers
    marked = marked.join(edges, "bucket").withColumn("following", F.coalesce("following", "next_first"))
    # A long gap is expanded in two steps, so that no row holds all of it.
    gaps = marked.where("following > number + 1").select(F.explode(F.sequence(F.col("number") + 1, F.col("following") - 1, F.lit(100_000))).alias("begin"), (F.col("following") - 1).alias("end"))
    missing = gaps.select(F.explode(F.sequence("begin", F.least(F.col("begin") + 99_999, F.col("end")))).alias("number"), F.lit("missing").alias("kind"))
    return counts.where("n > 1").select("number", F.lit("duplicate").alias("kind")).unionByName(missing)


def short_units(units_: DataFrame, least: int = 800, chars: str = "char_count") -> DataFrame:
    return units_.where(F.col(chars) < least)


def selected(df: DataFrame, wanted: list[int], key: str = "seq") -> tuple[DataFrame, DataFrame]:
    """(rows of the keys wanted, keys that there are no rows of)."""
    keys = df.sparkSession.createDataFrame([(int(k),) for k in wanted], f"{key} long")
    return df.join(F.broadcast(keys), key, "left_semi"), keys.join(df.select(key), key, "left_anti")


def first_units(df: DataFrame, n: int, key: str = "seq") -> DataFrame:
    """The rows of the ``n`` smallest keys."""
    return df.join(F.broadcast(df.select(key).distinct().orderBy(key).limit(n)), key, "left_semi")


def in_range(df: DataFrame, first: int, last: int, key: str = "seq") -> DataFrame:
    return df.where(F.col(key).between(first, last))


def junk_counts(units_: DataFrame) -> DataFrame:
    """kind, lines of what was stripped."""
    return units_.select(F.explode("stripped_lines").alias("s")).groupBy(F.col("s.kind").alias("kind")).agg(F.count("*").alias("lines"))


def merged_listing(units_: DataFrame) -> DataFrame:
    """seq, title and the titles merged into it."""
    return units_.where("is_merged").select("doc", "seq", "title", F.transform("merged_titles", lambda t: t["title"]).alias("merged"))
