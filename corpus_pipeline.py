"""Documents to packed training sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and works on all rows that the stage before has kept; what it
returns is written as Parquet and read again as the docs of the next. Columns other than those of documents are
dropped. Rows are judged one by one, whether their doc_id is null, repeated or their own (see ``numbered``); an
empty table gives an empty one.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from storyloom.llm import decontamination, near_duplicates, packing, substring_dedup, toxicity
from storyloom.scratch import stored
from storyloom.sources.readers import with_ordinal

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: Words of a passage that counts as repeated across documents.
PASSAGE_WORDS = 50


def numbered(docs: DataFrame) -> DataFrame:
    """The columns of documents and ``row_id``: doc_id where each row has one of its own, else an ordinal by doc_id, nulls last."""
    docs = docs.select(*COLUMNS)
    if docs.groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1 OR doc_id IS NULL").isEmpty():
        return docs.withColumn("row_id", F.col("doc_id").cast("long"))
    ordered = docs.withColumn("_order", F.coalesce(F.col("doc_id").cast("long"), F.lit((1 << 63) - 1)))
    return stored(with_ordinal(ordered, "_order", "row_id").drop("_order"), "numbered")


def by_row(rows: DataFrame) -> DataFrame:
    """Row ids in place of doc_ids, for operators."""
    return rows.select(F.col("row_id").alias("doc_id"), "text")


def without(rows: DataFrame, rejected: DataFrame) -> DataFrame:
    """The rows whose row_id is not among ``rejected`` (doc_id)."""
    ids = stored(rejected.select(F.col("doc_id").alias("row_id")).distinct(), "rejected")
    return rows.join(ids, "row_id", "left_anti").select(*COLUMNS)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 10: documents with a score of 0.7 or more go. A null or empty text has no evidence and stays."""
    rows = numbered(docs)
    model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return without(rows, toxicity.toxicity(by_row(rows), model).where("score >= 0.7"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 5: of each group of near duplicates (five-word shingles, 0.8), the row of the smallest doc_id stays.

    Of rows that are repeated as a whole one stays, too; a row without a doc_id only if no other is like it. Null and empty texts all stay.
    """
    rows = numbered(docs)
    return without(rows, near_duplicates.near_duplicates(by_row(rows), shingle_words=5, percent=80).where("NOT kept"))


def remove_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 2: passages of 50 words or more that an earlier row has are cut out of later ones.

    Texts that lose nothing stay as they are; in others, the words kept are joined by one space. A
    document all of whose words go is left out.
    """
    rows = numbered(docs).select(F.col("row_id").alias("doc_id"), F.col("doc_id").alias("own_id"), "text", "lang", "source", "n_chars")
    out = substring_dedup.remove_repeats(rows, window=PASSAGE_WORDS, keep=("own_id", "text", "lang", "source", "n_chars"))
    cut = F.col("n_removed") > 0
    out = out.where("n_removed = 0 OR kept_text <> ''")
    n_chars = F.when(cut, F.length("kept_text").cast("long")).otherwise(F.col("n_chars"))
    return out.select(F.col("own_id").alias("doc_id"), F.when(cut, F.col("kept_text")).otherwise(F.col("text")).alias("text"), "lang", "source", n_chars.alias("n_chars"))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 3: documents that hold a benchmark item, or one with other values, go. Null and empty texts hold none."""
    rows = numbered(docs)
    return without(rows, decontamination.contaminated(by_row(rows), spark.read.parquet(f"{sf_dir}/benchmark.parquet")))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 1: pieces of the documents' ids and their places in sequences of 1024. A null or empty text is its end id alone."""
    import public_tokenizers

    return packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("near_dedup", drop_near_duplicates),
    ("substring_dedup", remove_passages),
    ("decontamination", drop_contaminated),
    ("packing", pack),
]

#: Models and tokenizers are beyond SQL; tests/llm compares the stages' operators with plain versions and runs the stages on awkward rows.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read again; the last one's rows."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
