"""Token ids of public tokenizers for Arrow batches.

Texts are cut where the tokenizer itself always cuts (``cut``), each distinct piece is encoded once
per worker, and ids are put together by array operations; the ids equal those of the whole text. This holds for
vocabularies whose own pattern cuts there, too; each worker compares its first texts, and then one text of every batch,
with whole encodings and fails where they differ.
"""

from __future__ import annotations

import os
from functools import cache
from itertools import chain

import numpy as np

from storyloom.llm.text_arrays import gathered, span_hashes, words

#: Pieces that a worker remembers at most, places in its hash table, and pieces encoded in one call.
CACHE_PIECES, SLOTS, LEARN = 1_000_000, 1 << 21, 1 << 13
#: Texts of up to so many bytes that a worker compares with whole encodings: at first, and of each batch.
COMPARED, COMPARED_BYTES, COMPARED_EACH = 32, 4096, 1

_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = True
#: Both vocabularies cut between a letter and such a byte; "|" is left out, for the names of special tokens.
_AFTER_LETTERS = np.zeros(256, bool)
_AFTER_LETTERS[0x21:0x7F] = ~_LETTER[0x21:0x7F]
_AFTER_LETTERS[0x7C] = False


def _letters_end(data: np.ndarray) -> np.ndarray:
    return _LETTER[data[:-1]] & _AFTER_LETTERS[data[1:]]


def _before_spaces(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Cut before a space that a character other than white space follows, and where letters end.

    The byte-level pattern takes one such space with what follows and leaves any other white space
    before it. Lead bytes that may begin Unicode white space (and control bytes) are not cut at.
    """
    n = len(data)
    if not n:
        return (np.zeros(0, np.int64),) * 3
    follows = np.zeros(256, bool)
    follows[0x21:] = True
    follows[[0x7F, 0xC2, 0xE1, 0xE2, 0xE3]] = False
    between = np.zeros(n + 1, bool)  # texts end there
    between[offsets] = True
    cut = between.copy()
    cut[: n - 1] |= (data[:-1] == 0x20) & follows[data[1:]] & ~between[1:n]
    cut[1:n] |= _letters_end(data)
    at = np.flatnonzero(cut)
    starts, ends = at[:-1], at[1:]
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1


def _words_and_letters(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words, cut once more where letters end inside a word (a text's end is a word's end already)."""
    starts, ends, _ = words(data, offsets)
    if not len(data):
        return (np.zeros(0, np.int64),) * 3
    between = np.zeros(len(data) + 1, bool)
    between[offsets] = True
    inner = np.flatnonzero(_letters_end(data) & ~between[1:-1]) + 1
    starts, ends = (np.sort(np.concatenate([x, inner]), kind="stable") for x in (starts, ends))
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1


#: How texts may be cut: byte-level vocabularies keep white space, word vocabularies drop it.
CUTS = {"space": _before_spaces, "white": _words_and_letters}


class Encoder:
    def __init__(self, path: str, cut: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.cut = CUTS[cut]
        self.folds = cut == "white"
        self.compared = 0
        self.forget()

    def forget(self, slots: int = SLOTS) -> None:
        """Open addressing: ``keys[slot]`` is a piece's hash (0: free), ``entry[slot]`` its place in ``at`` and ``size``."""
        self.keys, self.entry = np.zeros(slots, np.uint64), np.zeros(slots, np.int32)
        self.at, self.size, self.known, self.used = np.zeros(1 << 16, np.int64), np.zeros(1 << 16, np.int64), 0, 0
        self.pool = np.zeros(1 << 18, np.int32)

    def _find(self, hashes: np.ndarray) -> np.ndarray:
        """Entry of each piece, -1 if it is new."""
        last = len(self.keys) - 1
        slot = (hashes & np.uint64(last)).astype(np.int64)
        found = self.keys[slot]
        out = np.where(found == hashes, self.entry[slot], -1)
        at = np.flatnonzero((found != hashes) & (found != 0))
        while len(at):
            slot[at] = (slot[at] + 1) & last
            found = self.keys[slot[at]]
            same = found == hashes[at]
            out[at[same]] = self.entry[slot[at[same]]]
            at = at[~same & (found != 0)]
        return out

    def encoded(self, pieces: list[str]) -> list[list[int]]:
        """Ids of each piece."""
        return [x.ids for x in self.tokenizer.encode_batch_fast(pieces, add_special_tokens=False)]

    def _learn(self, hashes: np.ndarray, pieces: list[str]) -> None:
        ids = self.encoded(pieces)
        size = np.fromiter(map(len, ids), np.int64, len(ids))
        flat_ids = np.fromiter(chain.from_iterable(ids), np.int32, int(size.sum()))
        entry = np.arange(self.known, self.known + len(ids))
        while len(self.pool) < self.used + len(flat_ids):
            self.pool = np.concatenate([self.pool, np.zeros_like(self.pool)])
        while len(self.at) < self.known + len(ids):
            self.at, self.size = (np.concatenate([x, np.zeros_like(x)]) for x in (self.at, self.size))
        self.pool[self.used : self.used + len(flat_ids)] = flat_ids
        self.at[entry], self.size[entry] = self.used + np.cumsum(size) - size, size
        self.used, self.known = self.used + len(flat_ids), self.known + len(ids)
        last = len(self.keys) - 1
        slot, todo = (hashes & np.uint64(last)).astype(np.int64), np.arange(len(hashes))
        while len(todo):
            free = todo[self.keys[slot[todo]] == 0]
            self.keys[slot[free]], self.entry[slot[free]] = hashes[free], entry[free]  # of several for one slot, the last stays
            todo = todo[self.keys[slot[todo]] != hashes[todo]]
            slot[todo] = (slot[todo] + 1) & last

    def encode(self, data: np.ndarray, offsets: np.ndarray, end: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after the other, and how many each text has; ``end`` closes each text."""
        if self.known > CACHE_PIECES:
            self.forget()
        starts, ends, doc = self.cut(data, offsets)
        raw = data.tobytes()
        # The word vocabulary has lower case only, but for names of special tokens.
        hashes = span_hashes(data, starts, ends, self.folds and b"<|" not in raw)
        hashes[hashes == 0] = 1  # 0 marks a free slot
        entry = self._find(hashes)
        new = np.flatnonzero(entry < 0)
        if len(new):
            distinct, first = np.unique(hashes[new], return_index=True)
            if 4 * (self.known + len(distinct)) > 3 * len(self.keys):  # very long texts: begin anew, in a table that holds them
                new = np.arange(len(hashes))
                distinct, first = np.unique(hashes, return_index=True)
                self.forget(max(SLOTS, 1 << (2 * len(distinct)).bit_length()))
            spans = zip(starts[new[first]].tolist(), ends[new[first]].tolist(), strict=True)
            texts = [raw[a:b].decode("utf-8", "replace") for a, b in spans]
            for at in range(0, len(texts), LEARN):
                self._learn(distinct[at : at + LEARN], texts[at : at + LEARN])
            entry[new] = self._find(hashes[new])
        size = self.size[entry]
        ids = self.pool[gathered(self.at[entry], size)]
        count = np.bincount(doc, size, len(offsets) - 1).astype(np.int64)
        self._compare(raw, offsets, ids, count)
        if end is not None:
            closed = np.empty(len(ids) + len(count), np.int32)
            closed[np.arange(len(ids)) + np.repeat(doc, size)] = ids
            count += 1
            closed[np.cumsum(count) - 1] = end
            ids = closed
        return ids, count

    def _compare(self, raw: bytes, offsets: np.ndarray, ids: np.ndarray, count: np.ndarray) -> None:
        """Some texts against the tokenizer's own ids: those of a worker's first batches, then such as stand at changing places."""
        stops = np.cumsum(count)
        short = np.flatnonzero((np.diff(offsets) > 0) & (np.diff(offsets) <= COMPARED_BYTES))
        if len(short):
            short = np.roll(short, -(self.compared * 7919 % len(short)) if self.compared >= COMPARED else 0)
        for i in short[: max(COMPARED - self.compared, COMPARED_EACH)].tolist():
            whole = self.tokenizer.encode(raw[offsets[i] : offsets[i + 1]].decode("utf-8", "replace"), add_special_tokens=False).ids
            if whole != ids[stops[i] - count[i] : stops[i]].tolist():
                raise ValueError("this tokenizer doesn't cut texts where they were cut: its ids differ from those of whole texts")
            self.compared += 1


@cache
def encoder(path: str, cut: str) -> Encoder:
    """One for each Python worker, which keeps what it has encoded."""
    return Encoder(path, cut)
