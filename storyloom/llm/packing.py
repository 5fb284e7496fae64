"""Best-fit decreasing packing of token sequences (operator 1).

Best-fit decreasing looks at lengths only, and there are at most ``capacity`` of them. The plan is made
from the histogram of lengths: a segment tree over remaining capacities finds the tightest open bin
for a length in O(log capacity), and bins that are alike are filled together, as intervals of bin
numbers. Every piece then finds its bin from its rank among the pieces of its length, so neither
documents nor bins pass through the driver, and the bins are those of the sequential algorithm.
"""

from __future__ import annotations

from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from storyloom.llm.text_arrays import flat, slices
from storyloom.llm.token_ids import encoder
from storyloom.scratch import stored


class OpenBins:
    """Intervals of bin numbers by remaining capacity, under a segment tree that says where any are."""

    def __init__(self, capacity: int):
        self.leaves = 1 << capacity.bit_length()
        self.tree = bytearray(2 * self.leaves)
        self.bins: list[list[tuple[int, int]]] = [[] for _ in range(capacity + 1)]

    def push(self, remaining: int, first: int, count: int) -> None:
        if remaining and count:
            self.bins[remaining].append((first, count))
            at = remaining + self.leaves
            while at and not self.tree[at]:
                self.tree[at] = 1
                at >>= 1

    def pop(self, remaining: int) -> tuple[int, int]:
        out = self.bins[remaining].pop()
        if not self.bins[remaining]:
            at = remaining + self.leaves
            self.tree[at] = 0
            while at > 1 and not self.tree[at ^ 1]:
                at >>= 1
                self.tree[at] = 0
        return out

    def tightest(self, length: int) -> int | None:
        """Least remaining capacity of an open bin that is at least ``length``."""
        at = length + self.leaves
        if self.tree[at]:
            return length
        while at > 1:
            if not at & 1 and self.tree[at + 1]:
                at += 1
                while at < self.leaves:
                    at = 2 * at if self.tree[2 * at] else 2 * at + 1
                return at - self.leaves
            at >>= 1
        return None


def best_fit_plan(histogram: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int]]:
    """(length, rank of the first piece, pieces to each bin, first bin, offset in the bin) for each run of pieces."""
    bins, opened, plan = OpenBins(capacity), 0, []
    for length in sorted(histogram, reverse=True):
        rank, left = 0, histogram[length]
        while left:
            remaining = bins.tightest(length)
            if remaining is None:
                remaining, per = capacity, capacity // length
                first, count = opened, -(-left // per)
                opened += count
            else:
                per = remaining // length
                first, count = bins.pop(remaining)
            full = min(count, left // per)
            if full:
                plan.append((length, rank, per, first, capacity - remaining))
                bins.push(remaining - per * length, first, full)
                rank, left = rank + full * per, left - full * per
            rest = left if full < count else 0  # fewer than ``per``: they share one bin, as it is now the tightest
            if rest:
                plan.append((length, rank, rest, first + full, capacity - remaining))
                bins.push(remaining - rest * length, first + full, 1)
                rank, left, full = rank + rest, 0, full + 1
            bins.push(remaining, first + full, count - full)
    return plan


def pieces(docs: DataFrame, tokenizer: str, cut: str, end_id: int, capacity: int) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32: whole documents, only longer ones cut, the first piece shorter."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer, cut)
        for batch in slices(batches):
            ids, count = enc.encode(*flat(batch.column("text")), end_id)
            n = -(-count // capacity)
            row = np.repeat(np.arange(len(count)), n)
            piece = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
            short = (count - (n - 1) * capacity)[row]
            length = np.where(piece == 0, short, capacity)
            start = np.where(piece == 0, 0, short + (piece - 1) * capacity)
            at = (np.cumsum(count) - count)[row] + start
            raw = ids.astype("<u4").view(np.uint8)
            sums = [crc32(raw[4 * a : 4 * (a + k)]) for a, k in zip(at.tolist(), length.tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").take(pa.array(row)), pa.array(piece.astype(np.int32)), pa.array(start), pa.array(length), pa.array(sums, pa.int64())], names=["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(encode, "doc_id long, piece int, start long, length long, ids_crc32 long")


def pack(items: DataFrame, capacity: int, length: str = "length", order: tuple[str, ...] = ("doc_id", "piece")) -> DataFrame:
    """Add sequence_id and offset to ``items``, a table that is read twice and whose lengths are 1 to ``capacity``.

    Ranks within a length come from counts by (length, chunk) and a window in each chunk; the chunks are
    as many as shuffle partitions, so a length that most pieces have is spread over all tasks. Equal
    rows get different places. An empty table stays empty.
    """
    spark = items.sparkSession
    chunks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    items = items.withColumn("_chunk", F.pmod(F.xxhash64(*order), F.lit(chunks)).cast("int"))
    counts = items.groupBy(length, "_chunk").agg(F.count("*").alias("_n"))
    before = counts.withColumn("_before", F.sum("_n").over(Window.partitionBy(length).orderBy("_chunk")) - F.col("_n")).drop("_n")
    plan = best_fit_plan({r[length]: r["_n"] for r in items.groupBy(length).agg(F.count("*").alias("_n")).collect()}, capacity)  # at most ``capacity`` rows
    runs = np.array(sorted(plan), np.int64).reshape(-1, 5)
    ranked = items.withColumn("_rank", F.row_number().over(Window.partitionBy(length, "_chunk").orderBy(*order)) - 1)
    ranked = ranked.join(before, [length, "_chunk"]).withColumn("_rank", F.col("_rank") + F.col("_before")).drop("_chunk", "_before")
    keep = [c for c in ranked.columns if c != "_rank"]
    width = np.int64(1) << np.int64(48)
    keys = runs[:, 0] * width + runs[:, 1]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size = batch.column(batch.schema.get_field_index(length)).to_numpy()
            rank = batch.column(batch.schema.get_field_index("_rank")).to_numpy()
            run = runs[np.searchsorted(keys, size * width + rank, "right") - 1]
            within = rank - run[:, 1]
            yield pa.RecordBatch.from_arrays([*(batch.column(batch.schema.get_field_index(c)) for c in keep), pa.array(run[:, 3] + within // run[:, 2]), pa.array(run[:, 4] + within % run[:, 2] * size)], names=[*keep, "sequence_id", "offset"])

    kinds = dict(ranked.dtypes)
    return ranked.mapInArrow(place, ", ".join(f"`{c}` {kinds[c]}" for c in keep) + ", sequence_id long, offset long")


def pack_documents(docs: DataFrame, tokenizer: str, cut: str = "space", end_id: int = 2, capacity: int = 1024) -> DataFrame:
    """Pack all documents (a null or empty text is its end id alone) into sequences of at most ``capacity`` ids.

    Repeated rows and null doc_ids are packed like others; other columns are ignored.
    """
    return pack(stored(pieces(docs, tokenizer, cut, end_id, capacity), "pieces"), capacity)


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contract's query: byte_bpe_50k, end id 2, sequences of 1024."""
    import public_tokenizers

    return pack_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"), public_tokenizers.path("byte_bpe_50k.json"))
