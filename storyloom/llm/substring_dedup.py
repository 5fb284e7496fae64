"""Removal of passages that repeat across documents (operator 2): seed and extend.

A window is ``window`` consecutive words. Its anchor is the least hash among its runs of ``seed_words``
words (winnowing: neighbouring windows mostly share it, and equal windows always do). Documents are joined
on anchors that two of them have, with the words around: the partner of an anchor's window is its first
owner, the smallest doc_id that has the window and its first place there. It comes from min(), so a passage that very many documents share is
never gathered in one task, and no pairs of all its holders arise; as every repeated window has a first owner, no
repeated word is lost.

From there, matches are extended. Windows that follow each other in both documents are one run. A first owner may end
where its partner goes on: the next window then has another first owner. So every run is extended along its diagonal, to the left and to the
right, into the neighbouring runs: a window of the document and that of its partner are equal if both have the same first
owner, and this holds for a stretch of both documents' runs at a time, so texts need not meet. The longest extents, those within no
other, are the maximal repeats of ``window`` words or more, and their words go.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from storyloom.llm.text_arrays import flat, gathered, member, ngrams, slices, span_hashes, words
from storyloom.scratch import dropped, stored


class Windows:
    """Words of a batch and the hashes and seeds of its windows."""

    def __init__(self, batch: pa.RecordBatch, window: int, seed_words: int, seeds: bool = True):
        self.data, self.offsets = flat(batch.column(batch.schema.get_field_index("text")))
        self.starts, self.ends, self.doc = words(self.data, self.offsets)
        hashes = span_hashes(self.data, self.starts, self.ends)
        self.hashes, self.at = ngrams(hashes, self.doc, window)
        self.owner = self.doc[self.at]
        self.seeds = np.zeros(0, np.uint64)
        if seeds and len(self.at):
            m = len(hashes) - seed_words + 1
            runs, at = ngrams(hashes, np.zeros(len(hashes), np.int8), seed_words)  # over text ends too; such runs are in no window
            assert len(at) == m
            span, width = runs, 1
            wide = window - seed_words + 1
            while 2 * width <= wide:
                span, width = np.minimum(span[:-width], span[width:]), 2 * width
            rest = wide - width
            self.seeds = (np.minimum(span[: len(span) - rest], span[rest:]) if rest else span)[self.at]


def _column(batch: pa.RecordBatch, name: str) -> np.ndarray:
    return batch.column(batch.schema.get_field_index(name)).to_numpy()


def _rows(batch: pa.RecordBatch) -> np.ndarray:
    return _column(batch, "doc_id")


def _seeds(docs: DataFrame, window: int, seed_words: int) -> DataFrame:
    """seed, doc_id for each document's seeds (equal neighbours once)."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            w = Windows(batch, window, seed_words)
            new = np.ones(len(w.seeds), bool)
            new[1:] = (w.seeds[1:] != w.seeds[:-1]) | (w.owner[1:] != w.owner[:-1])
            yield pa.RecordBatch.from_arrays([pa.array(w.seeds[new].view(np.int64)), pa.array(_rows(batch)[w.owner[new]])], names=["seed", "doc_id"])

    return docs.mapInArrow(emit, "seed long, doc_id long")


def _windows_at(docs: DataFrame, window: int, seed_words: int) -> DataFrame:
    """hash, doc_id, place of the windows around the anchors listed in ``seeds``; a place is the text's tag and the window's position."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            w = Windows(batch, window, seed_words)
            wanted = batch.column(batch.schema.get_field_index("seeds")).flatten().to_numpy().view(np.uint64)
            at = member(w.seeds, wanted)
            owner = w.owner[at]
            first = np.searchsorted(w.doc, np.arange(batch.num_rows))
            place = _column(batch, "tag")[owner] << 32 | (w.at[at] - first[owner])
            yield pa.RecordBatch.from_arrays([pa.array(w.hashes[at].view(np.int64)), pa.array(_rows(batch)[owner]), pa.array(place)], names=["hash", "doc_id", "place"])

    return docs.mapInArrow(emit, "hash long, doc_id long, place long")


RUN = "start long, windows long, first_doc long, first_tag long, first_start long"
REPEAT = "start long, n_words long, first_doc long, first_start long"
_fields = lambda kind: [x.split()[0] for x in kind.split(", ")]
_struct = lambda kind: "struct<" + ", ".join(x.replace(" ", ": ") for x in kind.split(", ")) + ">"


def runs_of(at: np.ndarray, first_doc: np.ndarray, first_place: np.ndarray) -> np.ndarray:
    """Rows of :data:`RUN` from matched windows of one text, by start: windows that follow each other there and in one partner's text are a run."""
    tag, first_at = first_place >> 32, first_place & 0xFFFFFFFF
    order = np.argsort(at, kind="stable")  # a window has one first owner
    a, d, t, f = at[order], (at - first_at)[order], tag[order], first_doc[order]
    new = np.ones(len(a), bool)
    new[1:] = (a[1:] != a[:-1] + 1) | (d[1:] != d[:-1]) | (t[1:] != t[:-1]) | (f[1:] != f[:-1])
    begin = np.flatnonzero(new)
    stop = np.append(begin[1:], len(a))
    return np.stack([a[begin], stop - begin, f[begin], t[begin], a[begin] - d[begin]], 1) if len(begin) else np.zeros((0, 5), np.int64)


def _runs(matches: DataFrame) -> DataFrame:
    """doc_id, tag, runs of each text from its document's ``matches``."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            docs, tags, found, sizes = [], [], [np.zeros((0, 5), np.int64)], []
            lists = batch.column(1)
            place, first_doc, first_place = (lists.flatten().field(i).to_numpy() for i in range(3))
            stops = np.cumsum(lists.value_lengths().to_numpy())
            for doc, low, high in zip(_rows(batch).tolist(), [0, *stops[:-1].tolist()], stops.tolist(), strict=True):
                own = place[low:high] >> 32
                for tag in np.unique(own).tolist():  # rows of one doc_id may have different texts
                    at = np.flatnonzero(own == tag) + low
                    found.append(runs_of(place[at] & 0xFFFFFFFF, first_doc[at], first_place[at]))
                    docs.append(doc)
                    tags.append(tag)
                    sizes.append(len(found[-1]))
            table = np.concatenate(found)
            structs = pa.StructArray.from_arrays([pa.array(np.ascontiguousarray(c)) for c in table.T], names=_fields(RUN))
            yield pa.RecordBatch.from_arrays([pa.array(docs, pa.int64()), pa.array(tags, pa.int64()), pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)), structs)], names=["doc_id", "tag", "runs"])

    return matches.mapInArrow(emit, f"doc_id long, tag long, runs array<{_struct(RUN)}>")


#: Above any place in a text.
_FAR = np.int64(1) << np.int64(32)


class RunTable:
    """Runs of many texts in order, to be looked up by text and place; a last run, of no text, stands for none."""

    def __init__(self, text: np.ndarray, runs: np.ndarray):
        none = np.array([[0, 0, -1, -1, 0]], np.int64)
        self.text, runs = np.append(text, -1), np.concatenate([runs, none])
        self.start, self.end = runs[:, 0], runs[:, 0] + runs[:, 1]
        self.doc, self.tag, self.shift = runs[:, 2], runs[:, 3], runs[:, 0] - runs[:, 4]
        self.key = text * _FAR + runs[:-1, 0]

    def at(self, text: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number of the run at or before each place (-1: none of this text), and whether the place is in it."""
        i = np.searchsorted(self.key, text * _FAR + place, "right") - 1
        i[self.text[i] != text] = -1
        return i, (i >= 0) & (place < self.end[i])


def _reached(own: RunTable, theirs: RunTable, text: np.ndarray, partner: np.ndarray, first: tuple[np.ndarray, np.ndarray], shift: np.ndarray, edge: np.ndarray, way: int) -> np.ndarray:
    """How far runs extend along their diagonals from their edges, as long as both texts' windows have one first owner; a stretch of both at a time."""
    at, active = edge + way, np.arange(len(edge))
    while len(active):
        i, held = own.at(text[active], at[active])
        held &= at[active] >= shift[active]
        active, i = active[held], i[held]
        a, s, k = at[active], shift[active], partner[active]
        j, inside = theirs.at(k, a - s)
        # A window of the partner that is in no run is its own first owner.
        same = own.doc[i] == np.where(inside, theirs.doc[j], first[0][active])
        same &= own.tag[i] == np.where(inside, theirs.tag[j], first[1][active])
        same &= own.shift[i] == s + np.where(inside, theirs.shift[j], 0)
        active, i, j, inside, s, k = (x[same] for x in (active, i, j, inside, s, k))
        if way < 0:
            low = np.where(j < 0, 0, np.where(inside, theirs.start[j], theirs.end[j]))
            at[active] = np.maximum(np.maximum(own.start[i], low + s), s) - 1
        else:
            high = np.where(inside, theirs.end[j], np.where(theirs.text[j + 1] == k, theirs.start[j + 1], _FAR))
            at[active] = np.minimum(own.end[i], high + s)
    return at - way


def maximal(text: np.ndarray, runs: np.ndarray, doc_ids: np.ndarray, partner: np.ndarray, theirs: RunTable, window: int) -> tuple[np.ndarray, np.ndarray]:
    """(text, rows of :data:`REPEAT`) of the maximal repeats of texts, from their runs and those of the texts that are their first owners.

    ``partner`` numbers the runs of each run's first owner in ``theirs`` (-1: not there). Runs whose first owner is the document itself only name windows.
    On each diagonal of a partner the first run is extended, then the first that lies beyond, and so on.
    """
    own, shift = RunTable(text, runs), runs[:, 0] - runs[:, 4]
    left = np.flatnonzero(runs[:, 2] != doc_ids[text])
    order = np.lexsort((runs[left, 0], shift[left], runs[left, 3], runs[left, 2], text[left]))
    left = left[order]
    found = [np.zeros((0, 5), np.int64)]
    while len(left):
        keys = np.stack([text[left], runs[left, 2], runs[left, 3], shift[left]], 1)
        new = np.ones(len(left), bool)
        new[1:] = (keys[1:] != keys[:-1]).any(1)
        head = left[new]
        side = lambda edge, way: _reached(own, theirs, text[head], partner[head], (runs[head, 2], runs[head, 3]), shift[head], edge, way)
        low, high = side(runs[head, 0], -1), side(runs[head, 0] + runs[head, 1] - 1, 1)
        found.append(np.stack([text[head], low, high, runs[head, 2], low - shift[head]], 1))
        left = left[runs[left, 0] > high[np.cumsum(new) - 1]]
    table = np.concatenate(found)
    table = table[np.lexsort((table[:, 4], table[:, 3], -table[:, 2], table[:, 1], table[:, 0]))]
    end = table[:, 0] * _FAR + table[:, 2]
    kept = np.ones(len(table), bool)
    kept[1:] = end[1:] > np.maximum.accumulate(end)[:-1]  # within no other
    table = table[kept]
    return table[:, 0], np.stack([table[:, 1], table[:, 2] - table[:, 1] + window, table[:, 3], table[:, 4]], 1)


def _table(lists: pa.ListArray) -> tuple[list[np.ndarray], np.ndarray]:
    """Columns of the structs of all lists, and where each list begins and the last ends."""
    sizes = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    flat_lists = lists.flatten()
    return [flat_lists.field(i) for i in range(flat_lists.type.num_fields)], np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)


def _without(docs: DataFrame, window: int, carried: list[str]) -> DataFrame:
    """Extend the ``runs`` of each text with its ``partners`` to maximal repeats, and take them out."""
    fields = _fields(REPEAT)

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            n = batch.num_rows
            data, offsets = flat(batch.column(batch.schema.get_field_index("text")))
            starts, ends, doc = words(data, offsets)
            first = np.searchsorted(doc, np.arange(n))
            ids = batch.column(batch.schema.get_field_index("doc_id"))
            columns, at = _table(batch.column(batch.schema.get_field_index("runs")))
            runs = np.stack([c.to_numpy(zero_copy_only=False) for c in columns], 1).astype(np.int64).reshape(-1, 5)
            (p_doc, p_tag, p_runs), p_at = _table(batch.column(batch.schema.get_field_index("partners")))
            q_columns, q_at = _table(p_runs)
            theirs = np.stack([c.to_numpy(zero_copy_only=False) for c in q_columns], 1).astype(np.int64).reshape(-1, 5)
            number = {x: k for k, x in enumerate(zip(np.repeat(np.arange(n), np.diff(p_at)).tolist(), p_doc.to_pylist(), p_tag.to_pylist(), strict=True))}
            of = np.repeat(np.arange(n), np.diff(at))
            partner = np.full(len(runs), -1, np.int64)
            some = np.flatnonzero(np.diff(p_at)[of])
            partner[some] = [number.get(x, -1) for x in zip(of[some].tolist(), runs[some, 2].tolist(), runs[some, 3].tolist(), strict=True)]
            row, found = maximal(of, runs, ids.fill_null(0).to_numpy(), partner, RunTable(np.repeat(np.arange(len(p_doc)), np.diff(q_at)), theirs), window)
            many = np.bincount(row, minlength=n)
            cover = np.zeros(len(starts) + 1, np.int64)
            np.add.at(cover, first[row] + found[:, 0], 1)
            np.add.at(cover, first[row] + found[:, 0] + found[:, 1], -1)
            keep = np.cumsum(cover[:-1]) == 0
            begin, length, kept = starts[keep], (ends - starts)[keep], doc[keep]
            spaced = length + 1
            buffer = np.full(int(spaced.sum()), 0x20, np.uint8)
            buffer[gathered(np.cumsum(spaced) - spaced, length)] = data[gathered(begin, length)]
            stops = np.cumsum(np.bincount(kept, spaced, n).astype(np.int64))
            raw, begins = buffer.tobytes(), np.concatenate([[0], stops[:-1]])
            texts = [raw[a : max(a, b - 1)] for a, b in zip(begins.tolist(), stops.tolist(), strict=True)]
            total = np.bincount(doc, minlength=n).astype(np.int64)
            removed = total - np.bincount(kept, minlength=n)
            repeats = pa.StructArray.from_arrays([pa.array(np.ascontiguousarray(c)) for c in found.T], names=fields)
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(many)]).astype(np.int32)), repeats)
            more = [batch.column(batch.schema.get_field_index(c)) for c in carried]
            yield pa.RecordBatch.from_arrays([ids, pa.array(total), pa.array(removed), lists, pa.array(texts, pa.binary()).cast(pa.string()), *more], names=["doc_id", "n_words", "n_removed", "repeats", "kept_text", *carried])

    kinds = dict(docs.dtypes)
    return docs.mapInArrow(emit, f"doc_id long, n_words long, n_removed long, repeats array<{_struct(REPEAT)}>, kept_text string" + "".join(f", {c} {kinds[c]}" for c in carried))


def _partners(runs: DataFrame) -> DataFrame:
    """doc_id, tag, partners (doc, tag, runs) of texts with runs that touch: what their first owners' own runs are where the texts may go on alike.

    A run that no other touches is maximal as it is: the windows next to it are in no earlier document.
    """
    end = lambda r: r["start"] + r["windows"]
    size = F.size("runs")
    # Stretches of runs without a gap: the first and last window of each run's stretch.
    stretches = F.aggregate("runs", F.array().cast("array<struct<low: bigint, high: bigint>>"), lambda acc, r: F.when((F.size(acc) > 0) & (F.try_element_at(acc, F.lit(-1))["high"] == r["start"]), F.concat(F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0))), F.array(F.struct(F.try_element_at(acc, F.lit(-1))["low"].alias("low"), end(r).alias("high"))))).otherwise(F.concat(acc, F.array(F.struct(r["start"].alias("low"), end(r).alias("high"))))))
    wide = runs.where(size > 1).select("doc_id", "tag", "runs", stretches.alias("stretches")).where(F.size("stretches") < size)
    each = wide.select("doc_id", "tag", F.explode("runs").alias("r"), "stretches").select("doc_id", "tag", "r", F.filter("stretches", lambda s: (s["low"] <= F.col("r.start")) & (F.col("r.start") < s["high"]))[0].alias("s"))
    each = each.where("r.first_doc < doc_id AND s.high - s.low > r.windows")
    shift = F.col("r.start") - F.col("r.first_start")
    asked = each.groupBy("doc_id", "tag", F.col("r.first_doc").alias("doc"), F.col("r.first_tag").alias("first_tag")).agg(F.min(F.col("s.low") - shift).alias("low"), F.max(F.col("s.high") - shift).alias("high"))
    theirs = runs.select(F.col("doc_id").alias("doc"), F.col("tag").alias("first_tag"), F.col("runs").alias("own"))
    near = F.filter("own", lambda r: (r["start"] < F.col("high")) & (end(r) > F.col("low")))
    return asked.join(theirs, ["doc", "first_tag"]).groupBy("doc_id", "tag").agg(F.collect_list(F.struct("doc", F.col("first_tag").alias("tag"), near.alias("runs"))).alias("partners"))


def remove_repeats(docs: DataFrame, window: int = 13, seed_words: int | None = None, keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, n_words, n_removed, repeats and kept_text (kept words joined by one space), one row for each row.

    A word goes if a window that covers it also starts in a document with a smaller doc_id. ``repeats``
    are the maximal repeats of the text with first owners of its windows, by words from 0, without those that lie within another (see
    :data:`REPEAT`). A null
    text has no words; texts of fewer than ``window`` words are kept whole. Rows of equal doc_id
    never remove each other; rows whose doc_id is null neither remove nor lose words. Other columns are
    ignored, but for those of ``keep``, which come along (``text`` may be one). Windows are compared by 64-bit hashes.
    """
    seed_words = seed_words or max(1, min(8, window - 5))
    names = {c: "text" if c == "text" else f"_keep{i}" for i, c in enumerate(keep)}
    docs = docs.select(F.col("doc_id").cast("long"), "text", F.xxhash64("text").bitwiseAND(F.lit(0x7FFFFFFF)).alias("tag"), *[F.col(c).alias(n) for c, n in names.items() if c != "text"])
    known = docs.where("doc_id IS NOT NULL").select("doc_id", "text", "tag")
    seeds = _seeds(known, window, seed_words)
    repeated = stored(seeds.groupBy("seed").agg(F.min("doc_id").alias("a"), F.max("doc_id").alias("b")).where("a < b").select("seed"), "seeds")
    places = stored(seeds.join(repeated, "seed", "left_semi").groupBy("doc_id").agg(F.collect_set("seed").alias("seeds")), "places")
    dropped(repeated)
    windows = stored(_windows_at(known.join(places, "doc_id"), window, seed_words), "windows")
    dropped(places)
    # Written first: joined in the stage of its own aggregation, a hot window's rows could not be split.
    owners = stored(windows.groupBy("hash").agg(F.min(F.struct("doc_id", "place")).alias("first"), F.max("doc_id").alias("last")).where("first.doc_id < last").select("hash", F.col("first.doc_id").alias("first_doc"), F.col("first.place").alias("first_place")), "owners")
    matched = windows.join(owners, "hash").where("first_doc < doc_id OR first_doc = doc_id AND first_place <> place")
    runs = stored(_runs(matched.groupBy("doc_id").agg(F.collect_list(F.struct("place", "first_doc", "first_place")).alias("matches"))), "runs")
    dropped(windows, owners)
    found = stored(runs.join(_partners(runs), ["doc_id", "tag"], "left"), "partners")
    dropped(runs)
    out = _without(docs.join(found, ["doc_id", "tag"], "left"), window, list(names.values()))
    return out.select("doc_id", "n_words", "n_removed", "repeats", "kept_text", *[F.col(n).alias(c) for c, n in names.items()])


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contract's query: windows of 13 words."""
    out = remove_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet"), window=13)
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))
