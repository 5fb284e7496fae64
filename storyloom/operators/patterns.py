"""Many patterns in many texts at once.

Patterns up to ``MOST_BYTES`` go to the workers as one Aho-Corasick automaton, which finds all of them in a single pass over
each text however many they are. More are not broadcast: texts are then joined with patterns by hashes of
their first characters. Both ways give the same rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bytes of patterns that are sent to the workers; their automaton takes about a hundred times as much.
MOST_BYTES = 4 << 20
#: First characters by which longer lists are joined.
HEAD = 4


def leftmost_longest(found: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Of (start, stop), those that a search from the left takes: the longest at each place, none that begins within another."""
    out, end = [], 0
    for start, stop in sorted(found, key=lambda x: (x[0], -x[1])):
        if start >= end:
            out.append((start, stop))
            end = stop
    return out


def _automaton(rows: DataFrame, words: list[str], overlapping: bool) -> DataFrame:
    keep = [c for c in rows.columns if c != "_text"]

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import ahocorasick

        machine = ahocorasick.Automaton()
        for w in words:
            machine.add_word(w, len(w))
        machine.make_automaton()
        for batch in batches:
            row, start, word = [], [], []
            for i, text in enumerate(batch.column(len(keep)).to_pylist()):
                if not text:
                    continue
                found = [(last - n + 1, last + 1) for last, n in machine.iter(text)] if words else []
                for a, b in found if overlapping else leftmost_longest(found):
                    row.append(i)
                    start.append(a)
                    word.append(text[a:b])
            columns = batch.select(list(range(len(keep)))).take(pa.array(row, pa.int64()))
            yield pa.RecordBatch.from_arrays([*columns.columns, pa.array(start, pa.int32()), pa.array(word, pa.string())], names=[*keep, "start", "word"])

    kinds = dict(rows.dtypes)
    return rows.mapInArrow(find, ", ".join(f"`{c}` {kinds[c]}" for c in keep) + ", start int, word string")


def _joined(rows: DataFrame, words: DataFrame, overlapping: bool) -> DataFrame:
    """The same by a join: every place of a text with the patterns that begin with its next characters."""
    keep = [c for c in rows.columns if c != "_text"]
    heads = words.select("word", F.least(F.length("word"), F.lit(HEAD)).alias("_k"), F.length("word").alias("_n")).withColumn("_h", F.xxhash64(F.substring("word", 1, HEAD)))
    chars = F.split("_text", "")
    texts = rows.withColumn("_row", F.monotonically_increasing_id())
    places = texts.select("_row", F.posexplode(F.transform(chars, lambda _, i: F.slice(chars, i + 1, HEAD))).alias("start", "_next"))
    each = places.select("_row", "start", F.explode(F.sequence(F.lit(1), F.size("_next"))).alias("_k"), "_next").withColumn("_h", F.xxhash64(F.array_join(F.slice("_next", 1, F.col("_k")), "")))
    found = each.join(heads, ["_k", "_h"]).select("_row", "start", "word", "_n")
    spans = F.array_sort(F.collect_list(F.struct("start", (-F.col("_n")).alias("less"), "word")))
    hits = texts.join(found.groupBy("_row").agg(spans.alias("_hits")), "_row")
    real = F.filter("_hits", lambda h: F.substr("_text", h["start"] + 1, -h["less"]) == h["word"])
    none = F.array().cast("array<struct<start: int, less: int, word: string>>")
    taken = F.aggregate(real, F.struct(F.lit(0).alias("end"), none.alias("hits")), lambda acc, h: F.when(h["start"] >= acc["end"], F.struct((h["start"] - h["less"]).alias("end"), F.concat(acc["hits"], F.array(h)).alias("hits"))).otherwise(acc))["hits"]
    return hits.select(*keep, F.explode(real if overlapping else taken).alias("_hit")).select(*keep, F.col("_hit.start").cast("int").alias("start"), "_hit.word")


def pattern_hits(rows: DataFrame, patterns: DataFrame, keep: tuple[str, ...] = ("seq",), text: str = "text", overlapping: bool = False, most_bytes: int = MOST_BYTES) -> DataFrame:
    """``keep``, start (characters before it), word of every hit of ``patterns`` (word), the longest at each place and none within another, or all hits.

    Null texts have no hits; null, empty and repeated patterns are passed over.
    """
    words = patterns.select("word").where("word <> ''").distinct()
    texts = rows.select(*keep, F.col(text).alias("_text"))
    size = words.agg(F.sum(F.octet_length("word"))).first()[0] or 0
    if size > most_bytes:
        return _joined(texts.where("_text <> ''"), words, overlapping)
    return _automaton(texts, [r.word for r in words.collect()], overlapping)


def counted_apart(hits: DataFrame, key: str = "seq") -> DataFrame:
    """``key``, word, n: hits of each word that do not overlap each other, taken from the left. hits: all of them (see :func:`pattern_hits`)."""
    taken = F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("n"))
    step = lambda acc, at: F.when(at >= acc["end"], F.struct((at + F.length("word")).alias("end"), (acc["n"] + 1).alias("n"))).otherwise(acc)
    return hits.groupBy(key, "word").agg(F.array_sort(F.collect_list("start")).alias("_at")).select(key, "word", F.aggregate("_at", taken, step)["n"].alias("n"))
