"""Language identification of code-switched text (operator 8): a linear-chain conditional random field.

Every word gets a distribution over languages from forward-backward over its text. Emissions are sums of
weights of its affixes, character n-grams and itself (a lexicon), hashed; transitions say how readily
a text changes language. Both are fitted by gradient ascent on the conditional likelihood of sequences
put together from passages of labelled texts, so that they hold real changes of language.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from storyloom.llm.text_arrays import flat, gathered, mix, slices, span_hashes, words

#: Words to a block of the two-level forward-backward.
BLOCK = 64
_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = _LETTER[128:] = True


def word_features(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashed features of words, one after the other, and how many each word has.

    Per word: itself, and every run of three and four bytes of it framed by 0 at both ends, those at
    its edges being its affixes.
    """
    length = ends - starts
    size = length + 2
    framed = np.zeros(int(size.sum()) + 4, np.uint64)
    at = np.cumsum(size) - size
    framed[gathered(at + 1, length)] = data[gathered(starts, length)]
    upper = (framed >= 65) & (framed <= 90)
    framed[upper] += np.uint64(32)
    tri = framed[:-2] | framed[1:-1] << np.uint64(8) | framed[2:] << np.uint64(16)
    four = tri[:-1] | framed[3:] << np.uint64(24) | np.uint64(1 << 32)
    count3, count4 = length, np.maximum(length - 1, 0)
    total = 1 + count3 + count4
    out = np.empty(int(total.sum()), np.uint64)
    begin = np.cumsum(total) - total
    out[begin] = span_hashes(data, starts, ends, lower=True)
    out[gathered(begin + 1, count3)] = mix(tri[gathered(at, count3)])
    out[gathered(begin + 1 + count3, count4)] = mix(four[gathered(at, count4)])
    return (out % np.uint64(width)).astype(np.int64), total


@dataclass
class Field:
    languages: list[str]
    weights: np.ndarray  # hashed features x languages
    transitions: np.ndarray  # log scores


def _scores(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Emission scores, computed once for each distinct word."""
    _, first, inverse = np.unique(span_hashes(data, starts, ends), return_index=True, return_inverse=True)
    order = np.argsort(first)
    rank = np.empty_like(order)
    rank[order] = np.arange(len(order))
    first = first[order]
    index, total = word_features(data, starts[first], ends[first], len(weights))
    sums = np.add.reduceat(weights[index], np.cumsum(total) - total) if len(total) else np.zeros((0, weights.shape[1]))
    return sums[rank[inverse]]


def _unit(x: np.ndarray, axes: tuple[int, ...]) -> np.ndarray:
    return x / x.max(axes, keepdims=True)


def posteriors(scores: np.ndarray, count: np.ndarray, transitions: np.ndarray, pairs: bool = False):
    """P(language) of each word by forward-backward over texts of ``count`` words each.

    Texts are cut into blocks. The product of a block's transfer matrices carries messages across it, so
    all blocks advance together and only one step for each block of the longest text is in series.
    With ``pairs``, also the expected number of each transition within blocks, for fitting: there,
    every sequence is one block.
    """
    k = scores.shape[1]
    move = np.exp(transitions - transitions.max())
    blocks = -(-count // BLOCK)
    first_block = np.cumsum(blocks) - blocks
    doc = np.repeat(np.arange(len(count)), blocks)
    nth = np.arange(len(doc)) - first_block[doc]
    start = (np.cumsum(count) - count)[doc] + nth * BLOCK
    size = np.minimum(BLOCK, count[doc] - nth * BLOCK)
    real = np.arange(BLOCK) < size[:, None]
    emit = np.ones((len(doc), BLOCK, k))
    emit[real] = np.exp(scores - scores.max(1, keepdims=True))
    # Transfer of each block.
    carry = np.broadcast_to(np.eye(k), (len(doc), k, k)).copy()
    for t in range(BLOCK):
        on = real[:, t]
        carry[on] = _unit(carry[on] @ move * emit[on, t, None, :], (1, 2))
    enter, leave = np.ones((len(doc), k)), np.ones((len(doc), k))
    message = np.ones((len(count), k))
    by_size = np.argsort(-blocks, kind="stable")
    many = np.sort(blocks)
    for b in range(int(blocks.max(initial=0))):
        some = by_size[: len(count) - int(np.searchsorted(many, b, "right"))]
        at = first_block[some] + b
        enter[at] = message[some]
        message[some] = _unit((message[some, None, :] @ carry[at])[:, 0], (1,))
    message = np.ones((len(count), k))
    for b in range(int(blocks.max(initial=0))):
        some = by_size[: len(count) - int(np.searchsorted(many, b, "right"))]
        at = first_block[some] + blocks[some] - 1 - b
        leave[at] = message[some]
        message[some] = _unit((carry[at] @ message[some, :, None])[:, :, 0], (1,))
    forward, backward = np.ones_like(emit), np.ones_like(emit)
    for t in range(BLOCK):
        enter = np.where(real[:, t, None], _unit(enter @ move * emit[:, t], (1,)), enter)
        forward[:, t] = enter
    for t in range(BLOCK - 1, -1, -1):
        backward[:, t] = leave
        leave = np.where(real[:, t, None], _unit((emit[:, t] * leave) @ move.T, (1,)), leave)
    both = (forward * backward)[real]
    both /= both.sum(1, keepdims=True)
    if not pairs:
        return both
    joint = (forward[:, :-1, :, None] * move * (emit * backward)[:, 1:, None, :])[real[:, 1:]]
    return both, (joint / joint.sum((1, 2), keepdims=True)).sum(0)


def fit(texts: list[bytes], labels: list[str], width: int = 1 << 17, sequences: int = 4000, rounds: int = 6, seed: int = 8) -> Field:
    """Fit a field to labelled texts: ``sequences`` sequences of passages of 8 to 48 words of random texts.

    Whole texts take part: passages begin anywhere. Gradients are scaled by their past (Adagrad) and
    weights shrink a little, so that transitions stay finite.
    """
    rng = np.random.default_rng(seed)
    languages = sorted(set(labels))
    k = len(languages)
    weights, transitions = np.zeros((width, k)), np.zeros((k, k))
    offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
    data = np.frombuffer(b"".join(texts), np.uint8)
    starts, ends, doc = words(data, offsets)
    if not len(starts) or k < 2:
        return Field(languages, weights, transitions)
    code = np.array([languages.index(x) for x in labels])
    begin, count = np.searchsorted(doc, np.arange(len(texts))), np.bincount(doc, minlength=len(texts))
    usable = [np.flatnonzero((code == j) & (count > 0)) for j in range(k)]
    usable = [x for x in usable if len(x)]
    picked, lengths = [], []
    for _ in range(sequences):
        size = 0
        while size < BLOCK:
            d = rng.choice(usable[rng.integers(len(usable))])
            take = min(int(rng.integers(8, 49)), int(count[d]), BLOCK - size)
            at = begin[d] + int(rng.integers(0, count[d] - take + 1))
            picked.append(np.arange(at, at + take))
            size += take
        lengths.append(size)
    order = np.concatenate(picked)
    truth = code[doc[order]]
    first = np.zeros(len(order), bool)
    first[::BLOCK] = True  # every sequence has BLOCK words
    past_w, past_t = np.full((width, k), 1e-8), np.full((k, k), 1e-8)
    batch = 200 * BLOCK
    known: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    for _ in range(rounds):
        for a in range(0, len(order), batch):
            w, y = order[a : a + batch], truth[a : a + batch]
            if a not in known:  # in ascending order, as spans must be
                asc = np.sort(w, kind="stable")
                distinct = asc[np.concatenate([[True], asc[1:] != asc[:-1]])]
                index, total = word_features(data, starts[distinct], ends[distinct], width)
                at = np.searchsorted(distinct, w)
                known[a] = index[gathered((np.cumsum(total) - total)[at], total[at])], total[at]
            index, total = known[a]
            scores = np.add.reduceat(weights[index], np.cumsum(total) - total)
            p, expected = posteriors(scores, np.full(len(w) // BLOCK, BLOCK), transitions, pairs=True)
            wrong = -p
            wrong[np.arange(len(w)), y] += 1
            spread = np.repeat(wrong, total, 0)
            grad = np.stack([np.bincount(index, spread[:, j], width) for j in range(k)], 1) - 1e-3 * weights
            past_w += grad**2
            weights += 0.3 * grad / np.sqrt(past_w)
            inside = ~first[a : a + batch][1:]
            seen = np.zeros((k, k))
            np.add.at(seen, (y[:-1][inside], y[1:][inside]), 1)
            gt = seen - expected - 1e-1 * transitions
            past_t += gt**2
            transitions += 0.1 * gt / np.sqrt(past_t)
    return Field(languages, weights, transitions)


def fit_sample(docs: DataFrame, max_rows: int = 1200, max_bytes: int = 24 << 20) -> Field:
    """Fit to a sample of rows with a text and a lang: of each language those of least hash, ``max_rows`` in all and ``max_bytes`` of text.

    Every language has the same number of places, one at least, so that rare ones are learned at any size. Which rows
    take part is decided by numbers alone, before any text comes to the driver. Both bounds are of the classifier's
    sample (a single text of more bytes than a language's part takes no part in it); predictions cover all rows.
    """
    known = docs.where("text IS NOT NULL AND lang IS NOT NULL").select("lang", "text", F.shiftrightunsigned(F.xxhash64("doc_id", F.length("text")), 1).alias("_h"))
    counts = {r["lang"]: r["n"] for r in known.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not counts:
        return fit([], [])
    rows, size = max(1, max_rows // len(counts)), max_bytes // len(counts)
    # Twice the places by hash, so that each language has enough, then the exact number from the driver.
    limit = F.element_at(F.create_map(*[F.lit(x) for lang, n in counts.items() for x in (lang, min(1.0, 2 * (rows + 8) / n) * 2.0**63)]), F.col("lang"))
    likely = known.where(F.col("_h") <= limit)
    facts: dict[str, list] = {}
    for r in likely.groupBy("lang", "_h").agg(F.max(F.octet_length("text")).alias("size")).collect():
        facts.setdefault(r["lang"], []).append((r["_h"], r["size"]))
    chosen = set()
    for lang, found in facts.items():
        left = size
        for h, n in sorted(found)[:rows]:
            if n <= left:
                left -= n
                chosen.add((lang, h))
    picked = likely.where(F.col("_h").isin([h for _, h in chosen])).groupBy("lang", "_h").agg(F.min("text").alias("text")).collect() if chosen else []
    texts = sorted({(r["_h"], r["lang"], r["text"]) for r in picked if (r["lang"], r["_h"]) in chosen})
    return fit([t.encode() for _, _, t in texts], [lang for _, lang, _ in texts])


def identify(docs: DataFrame, model: Field) -> DataFrame:
    """doc_id, lang_pred and score (the mean probability of that language over words with letters).

    A text that is null or has no letter gives ``und`` and 0. One row for each row; columns other than
    doc_id and text are not read. Of languages that tie, the first in alphabetical order is given.
    """
    names = model.languages or ["und"]

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            n = batch.num_rows
            data, offsets = flat(batch.column("text"))
            starts, ends, doc = words(data, offsets)
            mean = np.zeros((n, len(names)))
            if len(starts) and model.languages:
                p = posteriors(_scores(data, starts, ends, model.weights), np.bincount(doc, minlength=n), model.transitions)
                spelled = np.logical_or.reduceat(_LETTER[data], starts)
                weight = np.bincount(doc[spelled], minlength=n)
                mean = np.stack([np.bincount(doc[spelled], p[spelled, j], n) for j in range(len(names))], 1) / np.maximum(1, weight)[:, None]
            best = mean.argmax(1)
            ascii_letters = np.zeros(n, bool)
            at = np.flatnonzero(_LETTER[data] & (data < 128))
            ascii_letters[np.searchsorted(offsets, at, "right") - 1] = True
            raw = None
            labels, score = [names[b] for b in best], mean.max(1)
            for i in np.flatnonzero(~ascii_letters).tolist():
                raw = raw or data.tobytes()
                if not any(c.isalpha() for c in raw[offsets[i] : offsets[i + 1]].decode("utf-8", "replace")):
                    labels[i], score[i] = "und", 0.0
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(labels, pa.string()), pa.array(np.clip(score, 0, 1))], names=["doc_id", "lang_pred", "score"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(predict, "doc_id long, lang_pred string, score double")


def op8_language_field(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contract's query: learn from documents whose crc32(doc_id) mod 4 is not 2, predict all."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))
    found = identify(docs, fit_sample(docs.where(~held_out)))
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")
