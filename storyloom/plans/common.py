"""Tables of the queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents as units: seq, text, source, lang, n_chars."""
    return table(spark, sf_dir, "documents").withColumnRenamed("doc_id", "seq")


#: Names: words of four letters or more that begin with a capital, after a space or at a line's start.
NAME = r"(?:^|[ \n])([A-Z][a-z]{3,})"


def mentions(df: DataFrame) -> DataFrame:
    """seq, pos (from 0), name."""
    return df.select("seq", F.posexplode(F.regexp_extract_all("text", F.lit(NAME), 1)).alias("pos", "name"))


SQL_MENTIONS = r"""m0 AS (SELECT doc_id AS seq, source, regexp_extract_all(text, '(?:^|[ \n])([A-Z][a-z]{3,})', 1) AS l FROM documents),
mentions AS (SELECT seq, source, unnest(l) AS name, generate_subscripts(l, 1) - 1 AS pos FROM m0)"""
SQL_PARAS = """p0 AS (SELECT doc_id AS seq, string_split(text, chr(10)) AS l FROM documents),
paras AS (SELECT seq, unnest(l) AS text, generate_subscripts(l, 1) AS para FROM p0)"""
