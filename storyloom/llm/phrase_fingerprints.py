"""Lempel-Ziv phrase fingerprints (operator 7).

A text's UTF-8 bytes are parsed into the phrases of an incremental (LZ78) dictionary: each phrase is the
shortest one not seen before. The set of phrases is what a compressor would have learned; the share of
phrases that two texts have in common (Lempel-Ziv Jaccard distance; Raff and Nicholas, 2017) is like
their similarity under compression. The fingerprint keeps ``MINIMA`` minima of the hashed set, of 16
bits each, as hexadecimal digits.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from storyloom.llm.text_arrays import flat, slices, span_hashes
from storyloom.scratch import stored

MINIMA = 96
_rng = np.random.default_rng(78)
_FACTORS = _rng.integers(0, 2**31, MINIMA, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_TERMS = _rng.integers(0, 2**32, MINIMA, dtype=np.uint32)


def phrase_ends(data: bytes, trie: dict[int, int], node: int = 0) -> tuple[list[int], int]:
    """Where phrases end in ``data``, and the node reached; ``trie`` holds and gets the phrases so far."""
    ends, known = [], trie.get
    add = ends.append
    for at, byte in enumerate(data, 1):
        key = node << 8 | byte
        following = known(key)
        if following is None:
            trie[key] = len(trie) + 1
            node = 0
            add(at)
        else:
            node = following
    return ends, node


def _signature(data: bytes, ends: list[int]) -> np.ndarray:
    """Minima of the phrases, which lie one after the other in ``data``."""
    out = np.full(MINIMA, 0xFFFFFFFF, np.uint32)
    if ends:
        stops = np.array(ends)
        starts = np.concatenate([[0], stops[:-1]])
        x = (span_hashes(np.frombuffer(data, np.uint8), starts, stops) >> np.uint64(32)).astype(np.uint32)
        for at in range(0, len(x), 4096):
            out = np.minimum(out, (x[at : at + 4096, None] * _FACTORS + _TERMS).min(0))
    return (out ^ (out >> np.uint32(16))).astype(np.uint16)


def fingerprints_of(text: bytes, edited: bytes | None = None, shared: int = 0) -> list[np.ndarray]:
    """The signature of ``text`` and that of ``edited``, whose first ``shared`` bytes are the same."""
    trie: dict[int, int] = {}
    head, node = phrase_ends(text[:shared], trie)
    saved = dict(trie) if edited is not None else None
    tail, _ = phrase_ends(text[shared:], trie, node)
    out = [_signature(text, head + [shared + x for x in tail])]
    if saved is not None:
        tail, _ = phrase_ends(edited[shared:], saved, node)
        out.append(_signature(edited, head + [shared + x for x in tail]))
    return out


def likeness(x: np.ndarray, y: np.ndarray) -> float:
    return float((x == y).mean())


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id and fingerprint of each text (null: as empty); other columns are ignored."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            data, offsets = flat(batch.column("text"))
            raw, at = data.tobytes(), offsets.tolist()
            marks = [fingerprints_of(raw[a:b])[0].tobytes().hex() for a, b in zip(at[:-1], at[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(marks, pa.string())], names=["doc_id", "fingerprint"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(emit, "doc_id long, fingerprint string")


def _edit(text: bytes, following: bytes) -> tuple[int, bytes, int]:
    """Code points of ``text``, the text with its last half replaced by the start of ``following``, and bytes kept."""
    points = text.decode("utf-8", "replace")
    half = len(points) // 2
    kept = points[: len(points) - half].encode()
    return len(points), kept + following.decode("utf-8", "replace")[:half].encode(), len(kept)


ROW = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
_NAMES = [x.split()[0] for x in ROW.split(", ")]


def _row(doc_id: int | None, text: bytes, following: bytes) -> tuple[list, np.ndarray]:
    """All but near_next, and the fingerprint for that of the document before."""
    n, edited, shared = _edit(text, following)
    own, other = fingerprints_of(text, edited, shared)
    return [doc_id, n, hashlib.sha256(edited).hexdigest(), own.tobytes().hex(), other.tobytes().hex(), likeness(own, other)], own


def _batch(rows: list[list], names: list[str], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], schema.field(i).type) for i in range(len(names))], schema=schema)


_SCHEMA = pa.schema([("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()), ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64())])
_EDGES = _SCHEMA.append(pa.field("part", pa.int32())).append(pa.field("edge", pa.string())).append(pa.field("text", pa.binary()))


def compare_with_following(docs: DataFrame) -> DataFrame:
    """Fingerprints of each text and of its edit with the next document in ascending doc_id; see ``ROW``.

    Documents are dealt out by ranges of doc_id and sorted, and each is compared with the next in its
    range. The first and last document of each range are kept aside, and the last is then compared with
    the first of the next range that has rows; the very last with the very first. A null text is as
    empty; rows of equal doc_id lie side by side, by text; null doc_ids come first; an empty table
    gives no rows; other columns are ignored.
    """

    def within(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, waiting, part = None, None, None
        for batch in slices(batches):
            ids, parts = batch.column("doc_id").to_pylist(), batch.column("part").to_pylist()
            data, offsets = flat(batch.column("text"))
            raw, at, rows = data.tobytes(), offsets.tolist(), []
            for i, doc_id in enumerate(ids):
                text = raw[at[i] : at[i + 1]]
                if last is None:
                    part = parts[i]
                    rows.append([doc_id, *[None] * 6, part, "first", text])
                else:
                    row, own = _row(*last, text)
                    if waiting is not None:
                        rows.append([*waiting[0], likeness(waiting[1], own), part, None, None])
                    waiting = row, own
                last = doc_id, text
            if rows:
                yield _batch(rows, _EDGES.names, _EDGES)
        if last is not None:
            rows = [[last[0], *[None] * 6, part, "last", last[1]]]
            if waiting is not None:
                rows.append([*waiting[0], likeness(waiting[1], fingerprints_of(last[1])[0]), part, None, None])
            yield _batch(rows, _EDGES.names, _EDGES)

    def across(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            rows = []
            for doc_id, text, following in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "following")), strict=True):
                row, own = _row(doc_id, text, following)
                rows.append([*row, likeness(own, fingerprints_of(following)[0])])
            yield _batch(rows, _NAMES, _SCHEMA)

    ordered = docs.select(F.col("doc_id").cast("long"), "text").repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text").withColumn("part", F.spark_partition_id())
    found = stored(ordered.mapInArrow(within, ROW + ", part int, edge string, text binary"), "fingerprints")
    firsts = found.where("edge = 'first'")
    # Part numbers alone go through one task: a row for each range.
    numbers = firsts.select("part")
    chain = numbers.select("part", F.coalesce(F.lead("part").over(Window.orderBy("part")), F.min("part").over(Window.partitionBy())).alias("next_part"))
    ends = found.where("edge = 'last'").select("doc_id", "text", "part").join(chain, "part").join(firsts.select(F.col("part").alias("next_part"), F.col("text").alias("following")), "next_part")
    return found.where("edge IS NULL").select(*_NAMES).unionByName(ends.select("doc_id", "text", "following").mapInArrow(across, ROW))


def op7_phrase_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contract's query, over all documents."""
    return compare_with_following(spark.read.parquet(f"{sf_dir}/documents.parquet"))
