"""Toxicity scores of restored text (operator 10): a noisy channel, then weighted evidence.

Writers hide words behind look-alike characters, spacing and repetition, invisible characters, accents and marks. Invisible characters and
combining marks are dropped first; a word with accented Latin letters is also read without the accents. Words that show any of the others
become a lattice of the characters that may have been meant; Viterbi decoding under a character
trigram model of the corpus picks the likeliest reading, which may also split a spaced run into words.
All other words stay as they are. Words of the restored text and their beginnings are then evidence
with log-odds weights from labelled rows.
"""

from __future__ import annotations

import math
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from storyloom.llm.text_arrays import flat, gathered, member, mix, slices, span_hashes, words

# What each character may stand for.
LOOKALIKES = {"0": "o", "1": "il", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c"}
SEPARATORS = "._-*~"
# Letters of other alphabets that look like Latin ones (Cyrillic, then Greek), and these.
FOREIGN = dict(zip("аеорсухѕіјһԁԛԝкмтвнαειοκνρτυχ", "aeopcyxsijhdqwkmtbhaeiokvptux", strict=True))
#: Codes of the character model: 0 a word's end, 1-26 letters, 27 any other character.
CODES = 28
_CODE = np.full(256, 27, np.uint8)
_CODE[97:123] = np.arange(1, 27)
_CODE[65:91] = np.arange(1, 27)
_ALNUM = np.zeros(256, bool)
_ALNUM[48:58] = _ALNUM[65:91] = _ALNUM[97:123] = _ALNUM[128:] = True
_LETTER = _ALNUM.copy()
_LETTER[48:58] = False
_ASCII = _LETTER.copy()
_ASCII[128:] = False
_SIGN = np.zeros(256, bool)
_SIGN[[ord(c) for c in LOOKALIKES]] = True
_SEP = np.zeros(256, bool)
_SEP[[ord(c) for c in SEPARATORS]] = True
#: Two words are read as one if that is likelier by this log ratio; less takes too many common neighbours for one word.
SURE = 2.0
_LOOSE = np.zeros(256, bool)  # may be part of a hidden word at its edge
_LOOSE[[ord(c) for c in "@$"]] = True
#: Letters of a fragment at most; three fragments or more side by side are also read as a run.
FRAGMENT = 2
_FOREIGN = np.zeros(256, bool)  # first bytes of Cyrillic, Greek and full-width letters
_FOREIGN[[0xCE, 0xCF, 0xD0, 0xD1, 0xD2, 0xD4, 0xEF]] = True


def _base_letters() -> np.ndarray:
    """ASCII letter under each accented Latin letter of two bytes (U+00C0 to U+017F), by first and second byte; 0 for others."""
    table = np.zeros((256, 256), np.uint8)
    for point in range(0xC0, 0x180):
        base, first, second = unicodedata.normalize("NFD", chr(point))[0], *chr(point).encode()
        if base.isascii() and base.isalpha():
            table[first, second] = ord(base)
    return table


_BASE_LETTER = _base_letters()


def _visible(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Texts without invisible characters (soft hyphen, zero widths, directions, joiners, byte order mark) and combining marks (U+0300 to U+036F)."""
    n = len(data)
    if not n or data.max() < 0x80:
        return data, offsets
    second, third = (np.append(data[k:], np.zeros(k, np.uint8))[:n] for k in (1, 2))
    two = (data == 0xC2) & (second == 0xAD) | (data == 0xCC) & (second >= 0x80) | (data == 0xCD) & (second >= 0x80) & (second < 0xB0)
    three = (data == 0xE2) & ((second == 0x80) & ((third >= 0x8B) & (third <= 0x8F) | (third >= 0xAA) & (third <= 0xAE)) | (second == 0x81) & (third >= 0xA0) & (third <= 0xA4)) | (data == 0xEF) & (second == 0xBB) & (third == 0xBF)
    gone = two | three
    gone[1:] |= (two | three)[:-1]
    gone[2:] |= three[:-2]
    before = np.concatenate([[0], np.cumsum(gone)])
    return data[~gone], offsets - before[offsets]


def character_counts(docs: DataFrame) -> np.ndarray:
    """Trigram counts over all whole texts, words framed by 0; ``CODES`` cubed numbers come to the driver."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(CODES**3, np.int64)
        for batch in slices(batches):
            data, offsets = flat(batch.column("text"))
            starts, ends, _ = words(data, offsets)
            if not len(starts):
                continue
            # Two frames before each word and one after: every word takes len + 3 places.
            length = ends - starts
            at = np.cumsum(length + 3) - (length + 3)
            codes = np.zeros(int((length + 3).sum()), np.int64)
            within = np.arange(int(length.sum())) - np.repeat(np.cumsum(length) - length, length)
            codes[np.repeat(at + 2, length) + within] = _CODE[data[np.repeat(starts, length) + within]]
            tri = codes[:-2] * CODES * CODES + codes[1:-1] * CODES + codes[2:]
            inside = np.ones(len(codes), bool)
            inside[at] = inside[at + 1] = False  # those that would begin the next word
            total += np.bincount(tri[inside[2:]], minlength=CODES**3)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["gram", "n"])

    rows = docs.select("text").mapInArrow(count, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n")).collect()
    out = np.zeros(CODES**3)
    for gram, n in rows:
        out[gram] = n
    return out.reshape(CODES, CODES, CODES)


def character_model(counts: np.ndarray) -> np.ndarray:
    """log P(third | first two), mixed with the shorter contexts."""
    single = counts.sum((0, 1)) + 0.5
    single /= single.sum()
    pair = counts.sum(0) + 20 * single
    pair /= pair.sum(1, keepdims=True)
    triple = counts + 20 * pair
    return np.log(triple / triple.sum(2, keepdims=True))


def _lattice(core: str) -> list[tuple[list[str], bool]]:
    """For each group of like characters: readings (one or two times the character), and whether a word may end before it."""
    out: list[tuple[list[str], bool]] = []
    at, spaced = 0, False
    while at < len(core):
        c = core[at]
        if c in SEPARATORS or c == " ":
            spaced, at = True, at + 1
            continue
        stop = at + 1
        while stop < len(core) and core[stop] == c:
            stop += 1
        n = stop - at
        base = LOOKALIKES.get(c) or FOREIGN.get(c, c)
        times = (1,) if n == 1 else (2,) if n == 2 else (1, 2)
        out.append(([r * k for r in base for k in times], spaced))
        at, spaced = stop, False
    return out


def decode(core: str, model: np.ndarray | list) -> str:
    """The likeliest reading of a hidden word or spaced run (lower case), words parted by a space.

    A state is the last two characters; each keeps its best score and a pointer to the readings before, so the
    work is linear in the length, which has no limit.
    """
    logs = model if isinstance(model, list) else model.tolist()
    states: dict[tuple[int, int], tuple[float, tuple | None]] = {(0, 0): (0.0, None)}
    bare = "".join(c for c in unicodedata.normalize("NFKD", core).lower() if not unicodedata.combining(c))
    for readings, may_split in _lattice(bare):
        following: dict[tuple[int, int], tuple[float, tuple | None]] = {}
        for (p, q), (score, path) in states.items():
            starts = [(p, q, score, "")]
            if may_split and path:
                starts.append((0, 0, score + logs[p][q][0], " "))
            for a, b, s, gap in starts:
                for reading in readings:
                    x, y, total = a, b, s
                    for ch in reading:
                        z = ord(ch) - 96 if "a" <= ch <= "z" else 27
                        total += logs[x][y][z]
                        x, y = y, z
                    if (x, y) not in following or following[x, y][0] < total:
                        following[x, y] = (total, (path, gap + reading))
        states = following
    if not states:
        return ""
    best = max(states, key=lambda s: (states[s][0] + logs[s[0]][s[1]][0], s))
    path, out = states[best][1], []
    while path:
        path, text = path
        out.append(text)
    return "".join(reversed(out))


def _joined(data: np.ndarray, first: np.ndarray, last: np.ndarray, at: np.ndarray, model: np.ndarray) -> np.ndarray:
    """Which of the words ``at`` the model finds clearly likelier as one with the next."""
    a, b = at, at + 1
    code = lambda place, inside: np.where(inside, _CODE[data[np.minimum(np.maximum(place, 0), len(data) - 1)]], 0).astype(np.int64)
    y, z = code(last[a] - 2, last[a] - first[a] > 1), code(last[a] - 1, True)
    p, q = code(first[b], True), code(first[b] + 1, last[b] - first[b] > 1)
    gain = model[y, z, p] + model[z, p, q] - model[y, z, 0] - model[0, 0, p] - model[0, p, q]
    return at[gain > SURE]


def _evidence(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of each word and of its first 4, 5 and 6 bytes (0: the word has no more)."""
    out = np.zeros((len(starts), 4), np.uint64)
    out[:, 0] = span_hashes(data, starts, ends, lower=True)
    for j, n in enumerate((4, 5, 6), 1):
        some = ends - starts > n
        out[some, j] = mix(span_hashes(data, starts[some], starts[some] + n, lower=True) ^ np.uint64(n))
    return out


def features(batch: pa.RecordBatch, model: np.ndarray, memory: dict[str, str]) -> tuple[np.ndarray, np.ndarray]:
    """Row and evidence of each distinct word of each restored text."""
    data, offsets = _visible(*flat(batch.column(batch.schema.get_field_index("text"))))
    starts, ends, doc = words(data, offsets)
    found, rows = [np.zeros((0, 4), np.uint64)], [np.zeros(0, np.int64)]
    if len(starts):
        index = np.arange(len(data))
        reach = lambda ok: (np.minimum.reduceat(np.where(ok, index, len(data)), starts), np.maximum.reduceat(np.where(ok, index, -1), starts) + 1)
        any_of = lambda ok: np.logical_or.reduceat(ok, starts)  # noqa: E731  a word's range runs on over white space, which has no class
        kind = data
        first, last = reach(_ALNUM[kind] | _LOOSE[kind])
        core = first < last
        inner = np.zeros(len(data), bool)  # not edge punctuation
        length = np.where(core, last - first, 0)
        within = np.arange(int(length.sum())) - np.repeat(np.cumsum(length) - length, length)
        inner[np.repeat(np.where(core, first, 0), length) + within] = True
        triple = np.zeros(len(data), bool)
        if len(data) > 2:
            triple[2:] = _ASCII[kind[2:]] & (kind[2:] == kind[1:-1]) & (kind[1:-1] == kind[:-2])
        lettered = any_of(_ASCII[kind])
        foreign = any_of(_FOREIGN[kind] & inner)
        odd = (lettered & (any_of((_SIGN[kind] | _SEP[kind]) & inner) | any_of(triple) | foreign)) | any_of((kind == 0xEF) & inner)
        hidden = core & odd
        letters = np.add.reduceat(_LETTER[kind].astype(np.int32), starts)
        head = kind[np.minimum(first, len(data) - 1)]
        wide = np.where(head < 0x80, 1, np.where(head < 0xE0, 2, 3))  # bytes of the first character
        single = core & (last - first == wide) & (_ASCII[head] | _SIGN[head] | _FOREIGN[head])
        plain = core & ~hidden & (letters > 0)
        found.append(_evidence(data, first[plain], last[plain]))
        rows.append(doc[plain])
        # Words with accented letters once more without them.
        base = np.zeros(len(data), np.uint8)
        base[:-1] = _BASE_LETTER[data[:-1], data[1:]]
        accented = plain & any_of((base > 0) & inner)
        if accented.any():
            folded = np.where(base > 0, base, data)
            keep = np.ones(len(data) + 1, bool)
            keep[1:] = np.append(base[:-1], 0) == 0
            keep = keep[:-1]
            before = np.concatenate([[0], np.cumsum(keep)])
            found.append(_evidence(folded[keep], before[first[accented]], before[last[accented]]))
            rows.append(doc[accented])
        # Neighbours of ASCII letters with one space between.
        spelled = plain & (np.add.reduceat(_ASCII[kind].astype(np.int32), starts) == last - first)
        next_to = spelled[:-1] & spelled[1:] & (doc[:-1] == doc[1:]) & (last[:-1] == ends[:-1]) & (first[1:] == starts[1:]) & (starts[1:] == ends[:-1] + 1)
        left = _joined(data, first, last, np.flatnonzero(next_to), model)
        if len(left):
            size = np.stack([last[left] - first[left], last[left + 1] - first[left + 1]], 1)
            pairs = data[gathered(np.stack([first[left], first[left + 1]], 1).ravel(), size.ravel())]
            stop = np.cumsum(size.sum(1))
            found.append(_evidence(pairs, stop - size.sum(1), stop))
            rows.append(doc[left])

        raw, logs = data.tobytes(), model.tolist()
        texts, owner = [], []

        def restore(text: str, row: int) -> None:
            if text not in memory:
                if len(memory) > 100_000 or len(text) > 1000:  # long ones are few and large
                    memory.clear()
                memory[text] = decode(text, logs)
            texts.extend(memory[text].split())
            owner.extend([row] * (len(texts) - len(owner)))

        for i in np.flatnonzero(hidden).tolist():
            restore(raw[first[i] : last[i]].decode("utf-8", "replace").lower(), int(doc[i]))
        # Runs of three or more words of one character each, or of fragments.
        for short in (single, spelled & (last - first <= FRAGMENT)):
            joined = np.concatenate([[False], short[1:] & short[:-1] & (doc[1:] == doc[:-1]), [False]])
            begins = np.flatnonzero(short & ~joined[:-1])
            stops = np.flatnonzero(short & ~joined[1:]) + 1
            long = stops - begins >= 3
            for a, b in zip(begins[long].tolist(), stops[long].tolist(), strict=True):
                if short is single or (last[a:b] - first[a:b]).max() > 1:
                    restore(" ".join(raw[first[i] : last[i]].decode("utf-8", "replace") for i in range(a, b)).lower(), int(doc[a]))
        if texts:
            encoded = [t.encode() for t in texts]
            size = np.fromiter(map(len, encoded), np.int64, len(encoded))
            stop = np.cumsum(size)
            found.append(_evidence(np.frombuffer(b"".join(encoded), np.uint8), stop - size, stop))
            rows.append(np.array(owner))
    word, row = np.concatenate(found), np.concatenate(rows)
    order = np.lexsort((word[:, 0], row))
    word, row = word[order], row[order]
    new = np.ones(len(word), bool)
    new[1:] = (word[1:, 0] != word[:-1, 0]) | (row[1:] != row[:-1])
    return row[new], word[new]


@dataclass
class ToxicityModel:
    characters: np.ndarray
    keys: np.ndarray
    weights: np.ndarray
    prior: float


def fit(docs: DataFrame, labels: DataFrame, max_rows: int = 40_000, least_rows: int = 4, least_evidence: float = 20.0, least_odds: float = 12.0) -> ToxicityModel:
    """Learn weights from labelled rows of ``labels`` (doc_id, toxic).

    The classifier uses at most about ``max_rows`` labelled rows, those of least hash of doc_id, so that
    the evidence it gathers is bounded; the character model covers all texts of ``docs``. A feature
    counts if it is in ``least_rows`` toxic rows its log-likelihood ratio reaches ``least_evidence``
    and it is ``least_odds`` times as frequent in toxic rows as in others (weaker evidence mostly tells long texts from short ones). Null labels and doc_ids are left out; of several labels of one doc_id, the largest holds.
    """
    model = character_model(character_counts(docs))
    known = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("toxic").alias("toxic"))
    share = min(1.0, max_rows / max(1, known.count()))
    sample = known.where(F.shiftrightunsigned(F.xxhash64("doc_id"), 1) < int(share * 2.0**63)) if share < 1 else known

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory: dict[str, str] = {}
        for batch in slices(batches):
            toxic = batch.column(batch.schema.get_field_index("toxic")).to_numpy() > 0
            row, word = features(batch, model, memory)
            row, feature = np.repeat(row, 4)[word.ravel() > 0], word.ravel()[word.ravel() > 0]
            order = np.lexsort((feature, row))
            row, feature = row[order], feature[order]
            new = np.ones(len(row), bool)
            new[1:] = (feature[1:] != feature[:-1]) | (row[1:] != row[:-1])
            row, feature = row[new], feature[new]
            distinct, inverse = np.unique(feature, return_inverse=True)
            hits = np.bincount(inverse, toxic[row], len(distinct)).astype(np.int64)
            total = np.bincount(inverse, minlength=len(distinct))
            keys = np.concatenate([distinct.view(np.int64), np.zeros(1, np.int64)])  # the last row counts texts
            yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(np.append(hits, toxic.sum())), pa.array(np.append(total, len(toxic)) - np.append(hits, toxic.sum())), pa.array(np.arange(len(keys)) == len(distinct))], names=["feature", "pos", "neg", "is_text"])

    rows = docs.select(F.col("doc_id").cast("long"), "text").join(F.broadcast(sample), "doc_id")  # at most about ``max_rows`` rows of two numbers
    seen = rows.mapInArrow(count, "feature long, pos long, neg long, is_text boolean").groupBy("is_text", "feature").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    found = seen.where(F.col("is_text") | (F.col("pos") >= least_rows)).collect()
    pos_all = sum(r.pos for r in found if r.is_text)
    neg_all = sum(r.neg for r in found if r.is_text)
    keys, weights = [], []
    for r in found:
        if r.is_text:
            continue
        a, b = (r.pos + 0.5) / (pos_all + 1), (r.neg + 3) / (neg_all + 3)  # rare features weigh little
        both = (r.pos + r.neg) / max(1, pos_all + neg_all)
        ratio = 2 * (r.pos * math.log(max(r.pos, 1e-9) / pos_all / both) + (r.neg * math.log(r.neg / neg_all / both) if r.neg else 0))
        if a >= least_odds * b and ratio >= least_evidence:
            keys.append(r.feature)
            weights.append(math.log(a / b))
    keys = np.array(keys, np.int64).view(np.uint64)
    order = np.argsort(keys)
    return ToxicityModel(model, keys[order], np.array(weights)[order], math.log((pos_all + 0.5) / (neg_all + 0.5)))


def toxicity(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """doc_id and score (0 to 1) of each whole text, one row for each row.

    A null or empty text gets the score of no evidence. Other columns, labels among them, are not read.
    """

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory: dict[str, str] = {}
        for batch in slices(batches):
            row, word = features(batch, model.characters, memory)
            some = member(word.ravel(), model.keys)
            weight = np.zeros(word.size)
            weight[some] = model.weights[np.searchsorted(model.keys, word.ravel()[some])]
            total = model.prior + np.bincount(row, weight.reshape(word.shape).max(1, initial=0), batch.num_rows)  # a word counts once
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(1 / (1 + np.exp(-np.clip(total, -50, 50))))], names=["doc_id", "score"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(score, "doc_id long, score double")


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contract's query: learn from rows whose crc32(doc_id) mod 3 is not 1, score all."""
    held_out = F.crc32(F.col("doc_id").cast("string")) % 3 == 1
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    scored = toxicity(docs, fit(docs, labels.where(~held_out)))
    return scored.select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "score", F.when(F.col("score") >= 0.7, 1).otherwise(0).alias("predicted"))
