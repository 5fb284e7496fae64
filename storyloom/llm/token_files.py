"""Token ids as Parquet list columns (operator 9).

Files are in ascending doc_id order: documents are dealt out by ranges of doc_id, sorted within each,
and each range becomes one file. Every row has its text's ids, how many they are and where they start
in the file, so metadata reads do not touch the ids, and the page index lets a filter on ``doc_id``
skip row groups and pages. A table of the files' totals gives each file's place in the whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from storyloom.llm.text_arrays import flat, slices
from storyloom.llm.token_ids import encoder
from storyloom.scratch import shared_folder

#: Dictionary pages hold a vocabulary of up to 262,144 ids; "delta" is DELTA_BINARY_PACKED.
ENCODINGS = {
    "dictionary": {"parquet.enable.dictionary": "true", "parquet.dictionary.page.size": str(1 << 20)},
    "delta": {"parquet.enable.dictionary": "false", "parquet.writer.version": "PARQUET_2_0"},
}
FILE_SCHEMA = "doc_id long, part int, local_start long, n_tokens long, ids array<int>"


def encode_in_order(docs: DataFrame, tokenizer: str, cut: str, end_id: int | None) -> DataFrame:
    """Rows of the files, dealt out by ranges of doc_id and sorted; see :data:`FILE_SCHEMA`."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, done = encoder(tokenizer, cut), 0
        for batch in slices(batches):
            ids, count = enc.encode(*flat(batch.column("text")), end_id)
            ends = np.cumsum(count)
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]).astype(np.int32)), pa.array(ids, pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("part"), pa.array(done + ends - count), pa.array(count), lists], names=["doc_id", "part", "local_start", "n_tokens", "ids"])
            done += int(ends[-1])

    ordered = docs.select(F.col("doc_id").cast("long"), "text").repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    return ordered.withColumn("part", F.spark_partition_id()).mapInArrow(encode, FILE_SCHEMA)


def write_token_files(docs: DataFrame, path: str, tokenizer: str, cut: str, end_id: int | None = None, encoding: str = "dictionary", row_group_bytes: int = 32 << 20, page_rows: int = 1000) -> None:
    """Encode every whole text (null: empty) and write ``path/ids`` and ``path/parts``.

    Repeated rows and equal doc_ids are all kept, side by side; a null doc_id sorts first. An empty
    table makes files without rows. Other columns of ``docs`` are ignored.
    """
    spark = docs.sparkSession
    rows = encode_in_order(docs, tokenizer, cut, end_id)
    options = {"compression": "zstd", "parquet.block.size": str(row_group_bytes), "parquet.page.row.count.limit": str(page_rows), **ENCODINGS[encoding]}
    rows.write.options(**options).parquet(f"{path}/ids")
    written = spark.read.schema(FILE_SCHEMA).parquet(f"{path}/ids")
    # One row a file, so that the running sum over all of them is small.
    parts = written.groupBy("part").agg(F.sum("n_tokens").alias("tokens"))
    before = F.sum("tokens").over(Window.orderBy("part")) - F.col("tokens")
    parts.select("part", before.alias("part_start"), "tokens").coalesce(1).write.parquet(f"{path}/parts")


def read_token_files(spark: SparkSession, path: str, *columns: str) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens and the columns named, such as ``ids``."""
    ids = spark.read.schema(FILE_SCHEMA).parquet(f"{path}/ids")
    parts = spark.read.schema("part int, part_start long, tokens long").parquet(f"{path}/parts")
    return ids.join(parts.select("part", "part_start"), "part").select("doc_id", (F.col("part_start") + F.col("local_start")).alias("start"), "n_tokens", *columns)


def ids_crc32(rows: DataFrame, *keep: str) -> DataFrame:
    """``keep`` columns and the unsigned crc32 of ``ids`` as little-endian unsigned 32-bit integers."""
    from zlib import crc32

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(batch.schema.get_field_index("ids"))
            offsets, values = lists.offsets.to_numpy(), lists.values.to_numpy(zero_copy_only=False).astype("<u4").view(np.uint8)
            sums = [crc32(values[4 * a : 4 * b]) for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), pa.array(sums, pa.int64())], names=[*keep, "ids_crc32"])

    kinds = dict(rows.dtypes)
    return rows.select(*keep, "ids").mapInArrow(digest, ", ".join(f"{c} {kinds[c]}" for c in keep) + ", ids_crc32 long")


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contract's query: write all documents with word_bpe_49k and end id 1, read the files back."""
    import uuid

    import public_tokenizers

    path = f"{shared_folder(spark)}/token-files-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    write_token_files(docs, path, public_tokenizers.path("word_bpe_49k.json"), "white", end_id=1)
    return ids_crc32(read_token_files(spark, path, "ids"), "doc_id", "start", "n_tokens")
