"""BPE encoding by a trie of distinct words, and decoding (operator 12).

In a BPE encoding, the tokens up to any of its borders are the encoding of the text up to there. A prefix of a word
hence has one last token, and its encoding is that of the prefix before this token, and the token. Words
that begin alike share nodes of a trie; a node's state is the last token of its prefix and the node where
that token begins. Distinct words are inserted in order, so every new node extends the path to the word before, and nodes are
made depth first, each after its parent; the path is all of the trie that must be held. A new node finds its last token
among the vocabulary's entries that end there: the one that stays next to the last token of the prefix
before it. A whole word follows the states back to the root.

Two tokens stay next to each other if no merge across their border comes before the merges that make them.
Both sides are walked in order of rank (``stays``), so nothing is merged by trial.

Texts are split at special tokens, then cut into words by the vocabulary's own normalizer and pattern
(see ``token_ids``). The words of a batch that a worker has not met are inserted into its trie; Spark
spreads the batches, no word table is shuffled, and a lost task is encoded anew from its texts alone.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import cache
from hashlib import sha256
from math import inf

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from storyloom.llm.text_arrays import flat, gathered, slices
from storyloom.llm.token_ids import Encoder

#: Characters by which the common prefix of words is told; what they share beyond is worked out again.
SHARED = 32
#: Pairs of tokens of which a worker remembers whether they stay next to each other.
MOST_PAIRS = 200_000
#: Ids are below this.
_WIDE = 1 << 20


class PrefixTrie:
    """Encodes words with merges of given ranks; ``suffix`` marks the last character of a word."""

    def __init__(self, vocabulary: dict[str, int], merges: list[tuple[str, str]], suffix: str = ""):
        self.vocabulary, self.suffix = vocabulary, suffix
        self.rank: dict[tuple[int, int], float] = {}
        self.halves: dict[int, tuple[int, int, int]] = {}
        for rank, (left, right) in enumerate(merges):
            pair, whole = (vocabulary[left], vocabulary[right]), vocabulary[left + right]
            self.rank.setdefault(pair, rank)
            self.halves.setdefault(whole, (*pair, rank))
        self.longest = max(map(len, vocabulary), default=1)
        self._left: dict[int, list[tuple[int, float]]] = {}
        self._right: dict[int, list[tuple[int, float]]] = {}
        self._whole: dict[int, bool] = {}
        self._next_to: dict[int, bool] = {}
        self.nodes = 0  # made so far

    def edge(self, token: int, side: int) -> list[tuple[int, float]]:
        """The symbols and tokens at the left (0) or right (1) end of a token while it is made, each with the rank of the merge that takes it."""
        known = self._right if side else self._left
        if token not in known:
            parts, until = [], inf
            at = token
            while True:
                parts.append((at, until))
                if at not in self.halves:
                    break
                until = self.halves[at][2]
                at = self.halves[at][side]
            known[token] = parts[::-1]
        return known[token]

    def border(self, a: int, b: int) -> tuple[float, bool]:
        """Rank of the first merge across the border of ``a`` and ``b`` when both are made from symbols (inf: none), and whether both are made by then.

        Of merges of equal rank the one further left comes first.
        """
        left, right = self.edge(a, 1), self.edge(b, 0)
        i = j = 0
        while True:
            (x, until_x), (y, until_y) = left[i], right[j]
            across, made = self.rank.get((x, y), inf), until_x == until_y == inf
            if made or across < until_x and across <= until_y:
                return across, made
            if until_x <= until_y:
                i += 1
            else:
                j += 1

    def whole(self, token: int) -> bool:
        """Whether a token's own symbols are merged into it."""
        if token not in self._whole:
            left, right, rank = self.halves.get(token, (token, token, None))
            self._whole[token] = rank is None or (self.whole(left) and self.whole(right) and self.border(left, right) == (rank, True))
        return self._whole[token]

    def stays(self, a: int, b: int) -> bool:
        """Whether ``a`` and ``b`` next to each other are left as they are."""
        found = self._next_to.get(a * _WIDE + b)
        if found is None:
            found = self.whole(b) and self.border(a, b)[0] == inf
            if len(self._next_to) >= MOST_PAIRS:
                self._next_to.clear()
            self._next_to[a * _WIDE + b] = found
        return found

    def shared(self, words: list[str]) -> list[int]:
        """Nodes that each of ``words``, in order and distinct, shares with the one before it; a word's end is a node of its own if it is marked."""
        if len(words) < 2:
            return [0] * len(words)
        heads = np.array([w[:SHARED] for w in words])
        matrix = np.ascontiguousarray(heads).view(np.uint32).reshape(len(words), -1)
        differ = matrix[1:] != matrix[:-1]
        first = np.where(differ.any(1), differ.argmax(1), matrix.shape[1])
        inner = np.fromiter(map(len, words), np.int64, len(words)) - bool(self.suffix)
        return [0, *np.minimum(first, np.minimum(inner[1:], inner[:-1])).tolist()]

    def encode(self, words: list[str]) -> list[list[int]]:
        """Token ids of each of ``words``, distinct ones of characters that the vocabulary has."""
        vocabulary, next_to, suffix, longest = self.vocabulary, self._next_to, self.suffix, self.longest
        out: list[list[int]] = [[]] * len(words)
        order = sorted(range(len(words)), key=words.__getitem__)
        last, begin = [-1], [0]  # of the nodes on the path, the root first
        for k, common in zip(order, self.shared([words[k] for k in order]), strict=True):
            word = words[k]
            del last[common + 1 :], begin[common + 1 :]
            self.nodes += len(word) - common
            for end in range(common + 1, len(word) + 1):
                mark = suffix if end == len(word) else ""
                for start in range(end - 1, max(-1, end - 1 - longest), -1):
                    token = vocabulary.get(word[start:end] + mark)
                    if token is None:
                        continue
                    if not start:
                        stays = self.whole(token)
                    else:
                        stays = next_to.get(last[start] * _WIDE + token)
                        if stays is None:
                            stays = self.stays(last[start], token)
                    if stays:
                        break
                else:
                    raise ValueError(f"no last token for {word[:end]!r}: these merges don't give one encoding for each prefix")
                last.append(token)
                begin.append(start)
            ids, end = [], len(word)
            while end:
                ids.append(last[end])
                end = begin[end]
            ids.reverse()
            out[k] = ids
        return out


class TrieEncoder(Encoder):
    """An encoder whose distinct pieces go through the trie instead of the library's own merges."""

    def __init__(self, path: str, cut: str):
        super().__init__(path, cut)
        with open(path, encoding="utf-8") as f:
            model = json.load(f)
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["model"]["merges"]]
        self.special = {x["content"]: x["id"] for x in model["added_tokens"]}
        self.trie = PrefixTrie(model["model"]["vocab"], pairs, model["model"].get("end_of_word_suffix") or "")

    def words(self, texts: list[str]) -> list[list[str]]:
        """Words of each text, by the vocabulary's own normalizer and pattern. Where white space is dropped, one call splits all texts."""
        normal, split = self.tokenizer.normalizer, self.tokenizer.pre_tokenizer.pre_tokenize_str
        if normal:
            texts = [normal.normalize_str(t) for t in texts]
        if not self.folds:
            return [[w for w, _ in split(t)] for t in texts]
        stops = np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)) + 1)
        found = split(" ".join(texts))
        of = np.searchsorted(stops, np.fromiter((at for _, (at, _) in found), np.int64, len(found)), "right")
        out: list[list[str]] = [[] for _ in texts]
        for i, (word, _) in zip(of.tolist(), found, strict=True):
            out[i].append(word)
        return out

    def within(self, word: str) -> str:
        """A word without the characters that the vocabulary lacks."""
        of = self.trie.vocabulary
        return word if all(map(of.__contains__, word)) else "".join(c for c in word if c in of)

    def sections(self, piece: str) -> list[str | int]:
        """A piece cut at the names of special tokens, which stand as ids."""
        out: list[str | int] = [piece]
        for name, i in self.special.items():
            cut: list[str | int] = []
            for part in out:
                found = part.split(name) if isinstance(part, str) and name in part else [part]
                cut += [x for k, y in enumerate(found) for x in ((i, y) if k else (y,))]
            out = cut
        return [x for x in out if x != ""]

    def encoded(self, pieces: list[str]) -> list[list[int]]:
        """Ids of each piece; all distinct words of the pieces go into the trie together."""
        special = any(name in p for name in self.special for p in pieces)
        parts = [self.sections(p) for p in pieces] if special else [[p] for p in pieces]
        texts = [x for row in parts for x in row if isinstance(x, str)]
        split = iter(self.words(texts))
        rows = [[x if isinstance(x, int) else next(split) for x in row] for row in parts]
        numbers: dict[str, int] = {}
        for row in rows:
            for x in row:
                if not isinstance(x, int):
                    for word in x:
                        numbers.setdefault(word, len(numbers))
        names = [self.within(w) for w in numbers]
        distinct = list(dict.fromkeys(names))
        found = dict(zip(distinct, self.trie.encode(distinct), strict=True))
        ids = {word: found[name] for word, name in zip(numbers, names, strict=True)}
        return [[i for x in row for i in ((x,) if isinstance(x, int) else (i for word in x for i in ids[word]))] for row in rows]


@cache
def trie_encoder(path: str, cut: str) -> TrieEncoder:
    """One for each Python worker."""
    return TrieEncoder(path, cut)


class Decoder:
    """Bytes of token ids: names joined by a space where the file names no decoder, or byte characters back to bytes."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            model = json.load(f)
        kind = (model["decoder"] or {}).get("type")
        if kind not in (None, "ByteLevel"):
            raise ValueError(f"decoder {kind} is not known")
        self.gap = b"" if kind else b" "
        names = {i: t for t, i in model["model"]["vocab"].items()}
        back = byte_characters() if kind else {}
        piece = {i: (bytes(back[c] for c in t) if kind and all(c in back for c in t) else t.encode()) for i, t in names.items()}
        piece |= {x["id"]: x["content"].encode() for x in model["added_tokens"]}
        self.none = max(piece) + 1
        raw = [piece.get(i, b"") + (self.gap if i in piece else b"") for i in range(self.none + 1)]
        self.size = np.fromiter(map(len, raw), np.int64, len(raw))
        self.at = np.cumsum(self.size) - self.size
        self.pool = np.frombuffer(b"".join(raw), np.uint8)

    def decode(self, ids: np.ndarray, offsets: np.ndarray) -> list[bytes]:
        """UTF-8 of each list of ids; ids that the vocabulary lacks are left out, as bytes that are no UTF-8 become U+FFFD."""
        known = np.where((ids >= 0) & (ids < self.none), ids, self.none)
        size = self.size[known]
        raw = self.pool[gathered(self.at[known], size)].tobytes()
        stops = np.concatenate([[0], np.cumsum(size)])[offsets].tolist()
        texts = [raw[a : b - len(self.gap) if b > a else b] for a, b in zip(stops[:-1], stops[1:], strict=True)]
        return texts if self.gap else [x.decode("utf-8", "replace").encode() for x in texts]


def byte_characters() -> dict[str, int]:
    """Byte of each character of byte-level vocabularies: printable Latin-1 stands for itself, the others follow from U+0100 on in order."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(others)}


@cache
def decoder(path: str) -> Decoder:
    return Decoder(path)


def _kinds(rows: DataFrame, keep: tuple[str, ...]) -> str:
    kinds = dict(rows.dtypes)
    return ", ".join(f"`{c}` {kinds[c]}" for c in keep)


def _lists(ids: np.ndarray, count: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(count)]).astype(np.int32)), pa.array(ids, pa.int32()))


def _read_back(dec: Decoder, lists: pa.ListArray) -> list[pa.Array]:
    """n_tokens, ids_sha256, decoded of lists of ids."""
    count = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    values = lists.flatten().to_numpy(zero_copy_only=False)
    offsets = np.concatenate([[0], np.cumsum(count)]).astype(np.int64)
    raw = values.astype("<u4").view(np.uint8)
    sums = [sha256(raw[4 * a : 4 * b]).hexdigest() for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
    return [pa.array(count), pa.array(sums, pa.string()), pa.array(dec.decode(values, offsets), pa.binary()).cast(pa.string())]


def encode_documents(docs: DataFrame, tokenizer: str, cut: str, text: str = "text", keep: tuple[str, ...] = ("doc_id",), decoded: bool = False) -> DataFrame:
    """``keep`` columns and ``ids`` of every whole text, one row for each row; with ``decoded`` also what :func:`decode_ids` gives for them.

    A null or empty text has no ids. Repeated rows, null ids and ties are encoded like others; other columns are ignored.
    Ids are decoded in the same task if asked for, so that a task needs one worker.
    """
    more = ["n_tokens", "ids_sha256", "decoded"] if decoded else []

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = trie_encoder(tokenizer, cut)
        for batch in slices(batches, "_text"):
            lists = _lists(*enc.encode(*flat(batch.column(batch.schema.get_field_index("_text")))))
            back = _read_back(decoder(tokenizer), lists) if decoded else []
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in range(len(keep))), lists, *back], names=[*keep, "ids", *more])

    rows = docs.select(*keep, F.col(text).alias("_text"))
    return rows.mapInArrow(encode, f"{_kinds(rows, keep)}, ids array<int>" + (", n_tokens long, ids_sha256 string, decoded string" if decoded else ""))


def decode_ids(rows: DataFrame, tokenizer: str, ids: str = "ids", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns, ``n_tokens``, ``ids_sha256`` (of little-endian unsigned 32-bit ids) and ``decoded``; a null list counts as empty."""

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            back = _read_back(decoder(tokenizer), batch.column(len(keep)))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in range(len(keep))), *back], names=[*keep, "n_tokens", "ids_sha256", "decoded"])

    picked = rows.select(*keep, ids)
    return picked.mapInArrow(decode, f"{_kinds(picked, keep)}, n_tokens long, ids_sha256 string, decoded string")


def op12_prefix_trie_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contract's query: all documents with word_bpe_49k, encoded and decoded."""
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select(F.col("doc_id").cast("long"), "text")
    out = encode_documents(docs, public_tokenizers.path("word_bpe_49k.json"), "white", decoded=True)
    return out.select("doc_id", "n_tokens", "ids_sha256", F.sha2("decoded", 256).alias("decoded_sha256"))
