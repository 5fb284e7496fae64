"""Sources and sinks: encoded text, JSON documents with rejects, ordered reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from storyloom.functions.text import strip
from storyloom.scratch import stored


#: Encodings in which the byte of a line feed is never part of another character.
LINE_SAFE = {"GB18030", "GBK", "GB2312", "BIG5", "BIG5-HKSCS", "EUC-KR", "EUC-JP", "SHIFT_JIS", "WINDOWS-1251", "WINDOWS-1252", "ISO-8859-1", "US-ASCII", "UTF-8"}


def _decoded(spark: SparkSession, frame: DataFrame, column: Column, encoding: str, name: str) -> DataFrame:
    """Add ``name``, ``column`` in an encoding that may be beyond Spark's own list; the setting that allows it is as before once the expression is made."""
    key = "spark.sql.legacy.javaCharsets"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        out = frame.withColumn(name, F.decode(column, encoding))
        out.schema  # noqa: B018  analysed now
        return out
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def read_lines(spark: SparkSession, path: str, encoding: str = "GB18030") -> DataFrame:
    """doc (file), line_no (from 0), text of encoded files; CRLF and CR count as LF, and one at the end of a file begins no further line.

    A large file is read by many tasks: Spark's text reader divides it at line feeds and keeps its bytes, which are decoded
    line by line. Numbers come from counts of the parts before. Encodings in which the byte of a line feed
    may be part of a character, such as UTF-16, are read file by file.
    """
    if encoding.upper() not in LINE_SAFE:
        files = _decoded(spark, spark.read.format("binaryFile").load(path), F.col("content"), encoding, "body")
        body = F.regexp_replace(F.regexp_replace("body", r"\r\n?", "\n"), r"\n\z", "")
        return files.select(F.col("path").alias("doc"), F.posexplode(F.split(body, "\n")).alias("line_no", "text"))
    raw = spark.read.option("lineSep", "\n").text(path).select(F.col("_metadata.file_path").alias("doc"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("at"), "value")
    rows = _decoded(spark, raw, F.col("value").cast("binary"), encoding, "text")
    rows = rows.select("doc", "block", "at", F.posexplode(F.split(F.regexp_replace("text", r"\r\z", ""), "\r")).alias("in", "text"))
    rows = stored(rows, "lines")  # the ids of rows are those of one reading
    counts = rows.groupBy("doc", "block").agg(F.count("*").alias("n"))
    before = counts.select("doc", "block", (F.sum("n").over(Window.partitionBy("doc").orderBy("block")) - F.col("n")).alias("before"))  # a row a part
    own = rows.withColumn("k", F.row_number().over(Window.partitionBy("doc", "block").orderBy("at", "in")) - 1)
    return own.join(before, ["doc", "block"]).select("doc", (F.col("before") + F.col("k")).cast("int").alias("line_no"), "text")


def read_documents(spark: SparkSession, path: str, schema: StructType | str, lines: bool = False) -> tuple[DataFrame, DataFrame]:
    """JSON documents of a folder, one a file or, with ``lines``, one a line: (good rows, rejects with file and text). Wrongly typed documents are rejects."""
    schema = schema if isinstance(schema, StructType) else StructType.fromDDL(schema)
    rows = spark.read.schema(schema.add("_corrupt", "string")).option("multiLine", not lines).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt").json(path).withColumn("file", F.col("_metadata.file_name"))
    rows = stored(rows, "documents")  # Spark does not let _corrupt be read alone
    return rows.where("_corrupt IS NULL").drop("_corrupt"), rows.where("_corrupt IS NOT NULL").select("file", "_corrupt")


def write_documents(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).json(path)


def append_log(df: DataFrame, path: str) -> None:
    df.write.mode("append").json(path)


def chunked(df: DataFrame, order: str, chunks: int, group: str | None = None) -> DataFrame:
    """Add ``chunk`` (from 1): contiguous runs of ceil(n / chunks) rows by ``order``.

    Ranks are from counts of ranges of ``order``, so without a group no single task sorts all rows.
    """
    if group:
        w = Window.partitionBy(group)
        return df.withColumn("chunk", F.ceil(F.row_number().over(w.orderBy(order)) / F.ceil(F.count("*").over(w) / chunks)).cast("int"))
    numbered = with_ordinal(df, order, "_nth")
    per = -(-max(1, df.count()) // chunks)
    return numbered.withColumn("chunk", F.ceil(F.col("_nth") / per).cast("int")).drop("_nth")


def with_ordinal(df: DataFrame, order: str, name: str = "seq", group: str | None = None) -> DataFrame:
    """Add a gapless ordinal from 1 by ``order``, of each ``group`` if given: ranks in ranges, after the rows of the ranges before.

    A range of the whole table is one task, however large a group is.
    """
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cuts = df.agg(F.percentile_approx(order, [i / n for i in range(1, n)] or [0.5], 100 * n)).first()[0] or []
    cuts = sorted(set(cuts))
    keys = [group] if group else []
    ranged = df.withColumn("_range", F.size(F.filter(F.array(*[F.lit(c) for c in cuts]), lambda c: c < F.col(order))) if cuts else F.lit(0))
    counts = ranged.groupBy(*keys, "_range").agg(F.count("*").alias("_n"))
    before = counts.select(*keys, "_range", (F.sum("_n").over(Window.partitionBy(*keys).orderBy("_range")) - F.col("_n")).alias("_before"))  # a row for each range (and group)
    ranked = ranged.withColumn("_in", F.row_number().over(Window.partitionBy(*keys, "_range").orderBy(order)))
    if group:
        before = before.withColumnRenamed(group, "_group")
        joined = ranked.join(before.withColumnRenamed("_range", "_r"), F.col(group).eqNullSafe(F.col("_group")) & (F.col("_range") == F.col("_r"))).drop("_group", "_r")
    else:
        joined = ranked.join(F.broadcast(before), "_range")
    return joined.withColumn(name, (F.col("_before") + F.col("_in")).cast("long")).drop("_range", "_in", "_before")


def parse_header(lines: DataFrame, body_mark: str = "------章节内容开始-------", site: str = "ixdzs", most: int = 40) -> DataFrame:
    """doc, title, author, declared_status, blurb, source_note, body_start from the first lines of each document."""
    s = strip(F.col("text"))
    head = lines.where(F.col("line_no") < most).withColumn("s", s)
    w = Window.partitionBy("doc").orderBy("line_no").rowsBetween(Window.unboundedPreceding, 0)
    head = head.withColumn("_mark", F.max(F.when(F.col("s") == body_mark, F.col("line_no"))).over(w)).where(F.col("_mark").isNull() | (F.col("s") == body_mark))
    bare = F.regexp_replace("s", "^[『』]+|[『』]+$", "")
    opens = F.col("s").startswith("『内容简介:")
    head = head.withColumn("_open", F.sum(opens.cast("int")).over(w)).withColumn("_closed", F.sum(((F.col("_open") > 0) & F.contains("s", F.lit(site)) & ~opens).cast("int")).over(w))
    titled = F.col("s").startswith("『") & F.contains("s", F.lit("/作者:"))
    in_blurb = (F.col("_open") > 0) & (F.col("_closed") == 0) & ~titled & ~F.col("s").startswith("『状态:") & (F.col("s") != body_mark)
    part = F.when(opens, strip(F.regexp_replace("s", "『内容简介:", ""))).when(in_blurb, F.col("s"))
    parts = F.array_sort(F.collect_list(F.when(F.coalesce(part, F.lit("")) != "", F.struct("line_no", part.alias("p")))))
    return head.groupBy("doc").agg(
        F.max(F.when(titled, F.split(bare, "/作者:")[0])).alias("title"),
        F.max(F.when(titled, F.split(bare, "/作者:")[1])).alias("author"),
        F.max(F.when(F.col("s").startswith("『状态:"), F.regexp_replace(bare, "状态:", ""))).alias("declared_status"),
        F.regexp_replace(F.array_join(F.transform(parts, lambda x: x["p"]), ""), "^』+|』+$", "").alias("blurb"),
        F.max(F.when((F.col("_closed") == 1) & F.contains("s", F.lit(site)), F.col("s"))).alias("source_note"),
        F.coalesce(F.max("_mark") + 1, F.lit(0)).alias("body_start"),
    )


def body_end(lines: DataFrame, junk: str = "^『还在连载中|ixdzs|^$", most: int = 20) -> DataFrame:
    """doc, body_end: the line after the last that is neither promotion nor blank, within the last lines."""
    last = lines.groupBy("doc").agg((F.max("line_no") + 1).alias("n"))
    tail = lines.join(last, "doc").where((F.col("line_no") >= F.greatest(F.col("n") - most + 0, F.lit(1))))
    w = Window.partitionBy("doc").orderBy(F.desc("line_no")).rowsBetween(Window.unboundedPreceding, 0)
    tail = tail.withColumn("all_junk", F.min(strip(F.col("text")).rlike(junk).cast("int")).over(w))
    return tail.groupBy("doc").agg(F.coalesce(F.min(F.when(F.col("all_junk") == 1, F.col("line_no"))), F.max("n")).cast("int").alias("body_end"))


def write_report(df: DataFrame, path: str, line: str, *order: str) -> None:
    """A text report: the column ``line``, in order, as one file (reports are for people to read)."""
    df.orderBy(*order).select(line).coalesce(1).write.mode("overwrite").text(path)


def write_entities(df: DataFrame, path: str, least: int = 2, count: str = "units") -> None:
    """One folder for each entity that has ``least`` units; former output is replaced as a whole."""
    df.where(F.col(count) >= least).write.mode("overwrite").partitionBy("id").json(path)


def upserted(manifest: DataFrame, done: DataFrame, *key: str) -> DataFrame:
    """A manifest with the entries of ``done`` in place of those of equal key."""
    return manifest.join(done, list(key), "left_anti").unionByName(done)


def curated(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """Curated tables of a JSON file: identities (name, owner), ambiguous (name), excluded (phrase), tags (tag, word).

    The file holds {"identities": [{"canonical", "aliases", "ambiguous", "exclude"}], "tags": {tag: [words]}}; what is absent is empty.
    """
    person = "struct<canonical: string, aliases: array<string>, ambiguous: array<string>, exclude: array<string>>"
    rows = spark.read.schema(f"identities array<{person}>, tags map<string, array<string>>").option("multiLine", True).json(path)
    people = rows.select(F.explode("identities").alias("p")).select("p.*")
    owned = people.select(F.explode(F.array_union(F.array("canonical"), F.coalesce("aliases", F.array().cast("array<string>")))).alias("name"), F.col("canonical").alias("owner"))
    unsure = people.select(F.explode("ambiguous").alias("name")).distinct()
    return {"identities": owned.join(unsure, "name", "left_anti"), "ambiguous": unsure, "excluded": people.select(F.explode("exclude").alias("phrase")).distinct(), "tags": rows.select(F.explode("tags").alias("tag", "words")).select("tag", F.explode("words").alias("word"))}
