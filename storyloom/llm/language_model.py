"""Language-model scores from a log-frequency Bloom filter (operator 6).

After Talbot and Osborne (2007): n-gram counts are quantised to logarithmic levels, and an n-gram of
level q is put into a Bloom filter with each of 1..q; probing level after level until one is missing
gives the count back. The filter holds all words and all bigrams of the corpus. A smoothed probability comes from three such counts:

    P(w | h) = (v(h, w) + t(h) P(w)) / (c(h) + t(h)),   P(w) = (v(w) + 0.5) / (Q + 0.5 (V + 1)),   t(h) = max(1, v(h) ^ 0.75)

where v is the count that a level stands for, c(h) that of the history and Q the sum of v(w). As the counts of a history's
bigrams sum up to c(h), probabilities sum to one but for the rounding to levels, whose values are means, and for false positives
(about one in a thousand bigrams of known words that were not seen). t(h) grows as the number of different words after h does.

The filter has a place for every n-gram, in segments whose sizes follow from what they hold: n-grams are counted where their segment is
built, so they are shuffled once. Up to ``filter_bytes`` the filter is broadcast.
Beyond, its segments stay a table: the n-grams of blocks of texts are sent to their segments by a join, and what
they find is sent back. Both ways give the same scores. c(h) + t(h) and the exact counts of base scores come from a table of words:
its most frequent ones, at most ``head_words``, are in every task, the others reach the texts through a join.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from storyloom.llm.text_arrays import flat, mix, slices, span_hashes, words
from storyloom.scratch import stored

END = int(mix(np.array([0xE0D], np.uint64))[0])  # the end token's place among word hashes
#: Tokens of the corpus for each segment, and bits for each n-gram and level.
SEGMENT_TOKENS, BITS = 1 << 18, 16
#: A member has this many bits set in each of two words of 64.
MARKS = 5
STEP = 1.25
#: What tells words and bigrams apart in the filter.
WORD, PAIR = np.uint64(0x57), np.uint64(0x2B)
#: Bytes of text in a block, where the filter is not broadcast.
BLOCK_BYTES = 24 << 20
_LOW = np.unique(np.ceil(STEP ** np.arange(190) - 1e-9))
_LEVELS = len(_LOW)


def _mean(low: float, high: float) -> float:
    """Mean of the counts from ``low`` to ``high``, rare ones being more frequent (by the square)."""
    if high - low < 1000:
        n = np.arange(low, high + 1)
        return float((1 / n).sum() / (1 / n**2).sum())
    return math.log(high / low) / (1 / low - 1 / high)


#: Count that each level stands for (level 0: none).
VALUES = np.array([0.0, *(_mean(a, max(a, b - 1)) for a, b in zip(_LOW, _LOW[1:], strict=False))])


_STEPS = mix(np.arange(_LEVELS, dtype=np.uint64) + np.uint64(0x5EED))


def level_of(n: np.ndarray) -> np.ndarray:
    return np.searchsorted(_LOW, n, "right")


def followed(hashes: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each token's history (an end stands before each text), and the key of the two."""
    before = np.empty_like(hashes)
    before[1:] = hashes[:-1]
    first = np.ones(len(hashes), bool)
    first[1:] = row[1:] != row[:-1]
    before[first] = END
    return before, mix(mix(before ^ PAIR) + hashes)


def tokens(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the lower-cased words and one end of each text, their rows, and the texts' token counts."""
    data, offsets = flat(batch.column(batch.schema.get_field_index("text")))
    starts, ends, doc = words(data, offsets)
    count = np.bincount(doc, minlength=batch.num_rows).astype(np.int64) + 1
    out = np.full(int(count.sum()), END, np.uint64)
    out[np.arange(len(doc)) + doc] = span_hashes(data, starts, ends, lower=True)
    return out, np.repeat(np.arange(batch.num_rows), count), count


def _counted(batches: Iterator[np.ndarray], most: int = 1 << 20) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Distinct values and counts, put together in a task before they are shuffled."""
    keys, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
    for values in batches:
        one, n = np.unique(values, return_counts=True)
        both = np.concatenate([keys, one])
        order = np.argsort(both, kind="stable")
        both, n = both[order], np.concatenate([counts, n])[order]
        new = np.flatnonzero(np.concatenate([[True], both[1:] != both[:-1]])) if len(both) else np.zeros(0, np.int64)
        keys, counts = both[new], np.add.reduceat(n, new) if len(new) else n
        if len(keys) > most:
            yield keys, counts
            keys, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
    if len(keys):
        yield keys, counts


def word_counts(docs: DataFrame) -> DataFrame:
    """word (hash), c over all whole texts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, counts in _counted(tokens(b)[0].view(np.int64) for b in slices(batches)):
            yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(counts)], names=["word", "c"])

    return docs.select("text").mapInArrow(count, "word long, c long").groupBy("word").agg(F.sum("c").alias("c"))


@dataclass
class Head:
    """The most frequent words, at most ``head_words``: sorted hashes and counts."""

    keys: np.ndarray
    counts: np.ndarray

    def rank(self, hashes: np.ndarray) -> np.ndarray:
        """Place of each hash, -1 for words beyond the head."""
        if not len(self.keys):
            return np.full(len(hashes), -1)
        at = np.minimum(np.searchsorted(self.keys, hashes), len(self.keys) - 1)
        return np.where(self.keys[at] == hashes, at, -1)


def _identity(key: np.ndarray, segments: int) -> np.ndarray:
    """Segment (upper half) and 32 further bits, by which an n-gram is known in it.

    Among the n-grams of a segment, another one is the same by chance with a probability of a few in 100,000, far
    below that of the filter's own false positives.
    """
    h = mix(key)
    return ((h >> np.uint64(32)) * np.uint64(segments) >> np.uint64(32)) << np.uint64(32) | h & np.uint64(0xFFFFFFFF)


def _word(g: np.ndarray, size: np.ndarray | np.uint64) -> tuple[np.ndarray, np.ndarray]:
    """A hash's word among ``size``, and its marks there."""
    marks = np.zeros(len(g), np.uint64)
    for j in range(MARKS):
        marks |= np.uint64(1) << (g >> np.uint64(6 * j) & np.uint64(63))
    return ((g >> np.uint64(32)) * size >> np.uint64(32)).astype(np.int64), marks


def probe(filter_words: np.ndarray, sizes: np.ndarray | None, identity: np.ndarray) -> np.ndarray:
    """Level of each n-gram: how many membership probes in a row succeed. ``sizes``: words of each segment; none if there is but the one that all are in."""
    out = np.zeros(len(identity), np.int64)
    if not len(filter_words):
        return out
    if sizes is None:
        at, begin, size = np.arange(len(identity)), np.int64(0), np.uint64(len(filter_words))
    else:
        segment = (identity >> np.uint64(32)).astype(np.int64)
        at = np.flatnonzero(sizes[segment])
        begin, size = (np.cumsum(sizes) - sizes)[segment[at]], sizes[segment[at]].astype(np.uint64)
    h = identity[at]
    for q in range(1, _LEVELS):
        g = mix(h ^ _STEPS[q])
        for _ in range(2):
            place, marks = _word(g, size)
            ok = filter_words[begin + place] & marks == marks
            at, h, g = at[ok], h[ok], g[ok]
            if sizes is not None:
                begin, size = begin[ok], size[ok]
            g = mix(g)
        if not len(at):
            break
        out[at] = q
    return out


def _packed(identity: np.ndarray, n: np.ndarray | None = None, **also: int) -> pa.RecordBatch:
    """Ascending n-grams as a row for each segment: four bytes for an n-gram, four for its count, which mostly compress to one."""
    segment = (identity >> np.uint64(32)).astype(np.int32)
    first = np.flatnonzero(np.concatenate([[True], segment[1:] != segment[:-1]])) if len(segment) else np.zeros(0, np.int64)
    ends = np.append(first, len(segment))
    lists = lambda x: pa.array([x[a:b].tobytes() for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)], pa.binary())
    columns = {"segment": pa.array(segment[first]), **{k: pa.array(np.full(len(first), v, np.int32)) for k, v in also.items()}, "keys": lists(identity.astype(np.uint32))}
    if n is not None:
        columns["counts"] = lists(n.astype(np.uint32))
    return pa.RecordBatch.from_pydict(columns)


@dataclass
class Model:
    head: Head
    divisors: np.ndarray  # log10 of c + t of the head's words
    total: int  # N
    vocabulary: int  # V
    mass: float  # Q
    segments: int
    sizes: np.ndarray | None  # words of each segment
    bits: Broadcast | None  # the filter, or None where it is larger than may be broadcast
    filter: DataFrame  # segment, bits
    words: DataFrame  # word, c, divisor

    def single(self, level: np.ndarray) -> np.ndarray:
        """P(w) from the level of a word."""
        return (VALUES[level] + 0.5) / (self.mass + 0.5 * (self.vocabulary + 1))


def spread(level: np.ndarray) -> np.ndarray:
    """t(h) from the level of a history."""
    return np.maximum(1.0, VALUES[level] ** 0.75)


def _build(table: pa.Table) -> pa.Table:
    """Count the n-grams of a segment and put them in: at most ``SEGMENT_TOKENS`` on average."""
    join = lambda name: np.frombuffer(b"".join(table[name].to_pylist()), np.uint32)
    key, inverse = np.unique(join("keys"), return_inverse=True)
    level = level_of(np.bincount(inverse, join("counts")))
    h = np.uint64(table["segment"][0].as_py()) << np.uint64(32) | key.astype(np.uint64)
    filter_words = np.zeros(max(1, int(level.sum()) * BITS // 64), np.uint64)
    for q in range(1, int(level.max()) + 1):
        g = mix(h[level >= q] ^ _STEPS[q])
        for _ in range(2):
            place, marks = _word(g, np.uint64(len(filter_words)))
            np.bitwise_or.at(filter_words, place, marks)
            g = mix(g)
    return pa.table({"segment": table["segment"][:1], "bits": pa.array([filter_words.tobytes()], pa.binary())})


def fit(docs: DataFrame, head_words: int = 1 << 18, filter_bytes: int = 1 << 28) -> Model:
    """Count words and bigrams of all whole texts of ``docs`` (null: empty) and put all of them into the filter.

    An empty table gives a model without words. The head, totals and a filter of up to ``filter_bytes`` come to the driver.
    """
    spark = docs.sparkSession

    def valued(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            c = batch.column(1).to_numpy()
            level = level_of(c)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(VALUES[level]), pa.array(np.log10(c + spread(level)))], names=["word", "c", "v", "divisor"])

    counts = stored(word_counts(docs).mapInArrow(valued, "word long, c long, v double, divisor double"), "words")
    totals = counts.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count("*").alias("v"), F.coalesce(F.sum("v"), F.lit(0.0)).alias("q")).first()
    segments = max(1, -(-int(totals["n"]) // SEGMENT_TOKENS))

    def sent(key: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
        identity = _identity(key, segments)
        order = np.argsort(identity)
        return _packed(identity[order], n[order])

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def keys_of(batch: pa.RecordBatch) -> np.ndarray:
            hashes, row, _ = tokens(batch)
            return followed(hashes, row)[1].view(np.int64)

        for keys, n in _counted(keys_of(b) for b in slices(batches)):
            yield sent(keys.view(np.uint64), n)

    def single(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield sent(mix(batch.column(0).to_numpy().view(np.uint64) ^ WORD), batch.column(1).to_numpy())

    row = "segment int, keys binary, counts binary"
    grams = docs.select("text").mapInArrow(pairs, row).unionByName(counts.select("word", "c").mapInArrow(single, row))
    built = stored(grams.groupBy("segment").applyInArrow(_build, "segment int, bits binary"), "filter", compression="none")
    sizes, bits = None, None
    if (built.agg(F.sum(F.octet_length("bits"))).first()[0] or 0) <= filter_bytes:
        parts = {row["segment"]: np.frombuffer(row["bits"], np.uint64) for row in built.toLocalIterator()}
        sizes = np.array([len(parts[i]) if i in parts else 0 for i in range(segments)])
        bits = spark.sparkContext.broadcast(np.concatenate([parts[i] for i in sorted(parts)] or [np.zeros(0, np.uint64)]))

    known = counts.select("word", "c", "divisor")
    # The head's least count, from a histogram of at most 1,000 rows; without a head all words are joined.
    bins = sorted(((r["b"], r["n"]) for r in counts.groupBy(F.floor(F.log2("c") * 16).cast("int").alias("b")).agg(F.count("*").alias("n")).collect()), reverse=True)
    taken, cut = 0, None
    for b, n in bins:
        if taken + n > head_words:
            break
        taken, cut = taken + n, b
    empty = pa.table({"word": pa.array([], pa.int64()), "c": pa.array([], pa.int64()), "divisor": pa.array([], pa.float64())})
    frequent = known.where(F.floor(F.log2("c") * 16).cast("int") >= cut).toArrow() if cut is not None else empty
    keys = frequent["word"].to_numpy().view(np.uint64)
    order = np.argsort(keys)
    head = Head(keys[order], frequent["c"].to_numpy()[order])
    return Model(head, frequent["divisor"].to_numpy()[order], int(totals["n"]), int(totals["v"]), float(totals["q"]), segments, sizes, bits, built, known)


def _scored(batch: pa.RecordBatch, model: Model, levels) -> pa.RecordBatch:
    """Per text: tokens, those in the head, their base score, and the model's score but for the divisors of other histories.

    ``levels`` gives the levels of keys.
    """
    hashes, row, count = tokens(batch)
    n = batch.num_rows
    norm = model.total + 0.5 * (model.vocabulary + 1)
    rank = model.head.rank(hashes)
    known = rank >= 0
    sums = lambda x, at: np.bincount(row[at], x, n).astype(np.float64)
    base = sums(np.log10((model.head.counts + 0.5) / norm)[rank[known]], known)
    distinct, inverse = np.unique(hashes, return_inverse=True)
    word = levels(mix(distinct ^ WORD))
    before, key = followed(hashes, row)
    place = np.empty(len(hashes), np.int64)  # of the history among the distinct hashes; every text has an end
    place[1:] = inverse[:-1]
    place[before == END] = np.searchsorted(distinct, np.uint64(END))
    pair = np.zeros(len(hashes), np.int64)
    both = np.flatnonzero((word[inverse] > 0) & (word[place] > 0))  # no others can be bigrams
    pair[both] = levels(key[both])
    total = np.log10(VALUES[pair] + spread(word)[place] * model.single(word)[inverse])
    model_score = np.bincount(row, total, n) - sums(model.divisors[rank[known]], known)  # every token but an end is the history of one, and an end begins the text
    return pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("text_key"), pa.array(count), pa.array(np.bincount(row[known], minlength=n)), pa.array(base), pa.array(model_score.astype(np.float64))], names=["doc_id", "text_key", "n_tokens", "head_known", "head_base", "model_score"])


SCORED = "doc_id long, text_key long, n_tokens long, head_known long, head_base double, model_score double"


def _by_join(docs: DataFrame, model: Model) -> DataFrame:
    """:func:`_scored` where the filter is a table: keys of blocks of texts go to their segments, and levels back."""
    light = replace(model, bits=None, sizes=None, filter=None, words=None)
    segments = model.segments
    blocks = max(1, math.ceil((docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0) / BLOCK_BYTES))
    docs = docs.withColumn("block", F.pmod(F.xxhash64("doc_id", "text_key"), F.lit(blocks)).cast("int"))

    def asked(texts: pa.Table) -> np.ndarray:
        """Distinct n-grams of a block, ascending."""
        parts = [np.zeros(0, np.uint64)]
        for batch in slices(iter(texts.to_batches())):
            hashes, row, _ = tokens(batch)
            parts.append(np.unique(np.concatenate([mix(np.unique(hashes) ^ WORD), followed(hashes, row)[1]])))
        return np.unique(_identity(np.concatenate(parts), segments))

    def ask(texts: pa.Table) -> pa.Table:
        return pa.Table.from_batches([_packed(asked(texts), block=texts["block"][0].as_py())])

    def answer(wanted: pa.Table, held: pa.Table) -> pa.Table:
        filter_words = np.frombuffer(held["bits"][0].as_py(), np.uint64) if held.num_rows else np.zeros(0, np.uint64)
        upper = np.uint64(wanted["segment"][0].as_py() if wanted.num_rows else 0) << np.uint64(32)
        levels = [probe(filter_words, None, upper | np.frombuffer(k, np.uint32).astype(np.uint64)).astype(np.uint8).tobytes() for k in wanted["keys"].to_pylist()]
        return pa.table({"block": wanted["block"], "segment": wanted["segment"], "levels": pa.array(levels, pa.binary())})

    def finish(texts: pa.Table, found: pa.Table) -> pa.Table:
        if not texts.num_rows:
            return pa.Table.from_batches([], pa.schema([("doc_id", pa.int64()), ("text_key", pa.int64()), ("n_tokens", pa.int64()), ("head_known", pa.int64()), ("head_base", pa.float64()), ("model_score", pa.float64())]))
        identity = asked(texts)
        level = np.frombuffer(b"".join(found.sort_by("segment")["levels"].to_pylist()), np.uint8).astype(np.int64)
        levels = lambda keys: level[np.searchsorted(identity, _identity(keys, segments))]
        return pa.Table.from_batches([_scored(b, light, levels) for b in slices(iter(texts.to_batches()))])

    answers = docs.groupBy("block").applyInArrow(ask, "segment int, block int, keys binary").groupBy("segment").cogroup(model.filter.groupBy("segment")).applyInArrow(answer, "block int, segment int, levels binary")
    return docs.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(finish, SCORED)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, n_tokens, n_known, train_tokens, base_score and score (log10 probability of each whole text).

    A null text is as empty: one end token. Each row gets one row, repeated rows and null doc_ids
    included; other columns are ignored.
    """
    light = replace(model, filter=None, words=None)  # what goes to the tasks
    norm = model.total + 0.5 * (model.vocabulary + 1)

    def main(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            yield _scored(batch, light, lambda keys: probe(light.bits.value, light.sizes, _identity(keys, light.segments)))

    def rare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            hashes, row, _ = tokens(batch)
            at = np.flatnonzero(light.head.rank(hashes) < 0)
            order = at[np.lexsort((hashes[at], row[at]))]
            h, r = hashes[order], row[order]
            new = np.flatnonzero(np.concatenate([[True], (h[1:] != h[:-1]) | (r[1:] != r[:-1])])) if len(h) else np.zeros(0, np.int64)
            n = np.diff(np.append(new, len(h)))
            take = pa.array(r[new])
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").take(take), batch.column("text_key").take(take), pa.array(h[new].view(np.int64)), pa.array(n)], names=["doc_id", "text_key", "word", "n"])

    docs = docs.select(F.col("doc_id").cast("long"), "text", F.xxhash64("text").alias("text_key"))
    rows = docs.mapInArrow(main, SCORED) if model.bits is not None else _by_join(docs, model)
    c = F.coalesce(F.col("c"), F.lit(0))
    joined = docs.mapInArrow(rare, "doc_id long, text_key long, word long, n long").join(model.words, "word", "left")
    tail = joined.groupBy("doc_id", "text_key").agg(F.sum("n").alias("all"), F.sum(F.when(c > 0, F.col("n")).otherwise(0)).alias("tail_known"), F.sum(F.col("n") * F.log10((c + 0.5) / F.lit(norm))).alias("tail_base"), F.sum(F.col("n") * F.coalesce("divisor", F.lit(0.0))).alias("tail_divisor"))
    tail = tail.withColumnsRenamed({"doc_id": "_id", "text_key": "_key"})
    out = rows.join(tail, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_key") == F.col("_key")), "left")
    # Repeated rows meet in ``tail``: each gets its part.
    part = F.coalesce((F.col("n_tokens") - F.col("head_known")) / F.col("all"), F.lit(0.0))
    base = F.col("head_base") + F.coalesce(F.col("tail_base") * part, F.lit(0.0))
    known = F.col("head_known") + F.coalesce(F.round(F.col("tail_known") * part).cast("long"), F.lit(0))
    final = F.col("model_score") - F.coalesce(F.col("tail_divisor") * part, F.lit(0.0))
    return out.select("doc_id", "n_tokens", known.alias("n_known"), F.lit(model.total).cast("long").alias("train_tokens"), base.alias("base_score"), final.alias("score"))


def op6_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contract's query: learn from documents whose crc32(doc_id) mod 5 is not 1, score all."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 1, F.lit(False))
    found = score(docs, fit(docs.where(~held_out)))
    return found.select("doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")
