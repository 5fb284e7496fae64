"""Vector codes by product quantisation over a trie of distinct parts (operator 13).

Vectors of integers are cut into equal parts. Distinct parts are counted once and stored in lexicographic order, so each
file is a trie read depth first: neighbours share their common dimension prefix. Along a path, the squared distances to
all entries of the codebook are added up dimension by dimension; a part starts from the sums of the prefix that it
shares with the part before it, and adds only the dimensions that differ. At a leaf, the least sum gives
the entry, and the part enters the entry's sums as often as it occurs.

Leaves are visited in blocks, so that a level of the trie is one array operation over its nodes; the path to the last leaf of a
block is carried into the next one. Memory is that of a block, whatever the number of vectors. Codebooks
(``entries`` x dimensions integers) are the only thing that passes through the driver.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from storyloom.scratch import dropped, stored

#: Leaves of a block.
BLOCK = 512
#: Components are floor(SCALE * x); beyond LARGEST, squared distances would not fit a long.
SCALE, LARGEST = 1024, 1 << 27


class TrieWalk:
    """Distances of sorted parts to the entries of a codebook, block by block."""

    def __init__(self, codebook: np.ndarray):
        self.codebook = np.ascontiguousarray(codebook.T)  # dimension x entry
        self.width, self.entries = self.codebook.shape
        self.last: np.ndarray | None = None
        self.path = np.zeros((self.width + 1, self.entries), np.int64)  # sums along the path to the last leaf

    def block(self, parts: np.ndarray) -> np.ndarray:
        """leaf x entry squared distances of ``parts``, sorted and distinct, which follow those of the last call."""
        n = len(parts)
        shared = np.zeros(n, np.int64)  # dimensions that a part shares with the one before it
        if self.last is not None and n:
            differ = np.flatnonzero(parts[0] != self.last)
            shared[0] = differ[0] if len(differ) else self.width
        if n > 1:
            differ = parts[1:] != parts[:-1]
            shared[1:] = np.where(differ.any(1), differ.argmax(1), self.width)
        sums, node = self.path[:1], np.zeros(n, np.int64)  # level 0: the root, above all leaves
        kept = [sums[0]]
        for d in range(self.width):
            new = shared <= d  # leaves that open a node of this level
            carried = int(n > 0 and not new[0])  # the first node may be the one on the carried path
            opened = np.flatnonzero(new)
            step = parts[opened, d][:, None] - self.codebook[d]
            level = np.empty((carried + len(opened), self.entries), np.int64)
            level[:carried] = self.path[d + 1]
            np.multiply(step, step, out=step)
            np.add(sums[node[opened]], step, out=level[carried:])
            node = np.cumsum(new) - 1 + carried
            sums = level
            kept.append(level[-1] if n else self.path[d + 1])
        if n:
            self.path, self.last = np.array(kept), parts[-1].copy()
        return sums[node]

    def nearest(self, parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Entry (the lower of equally near ones) and squared distance of each of ``parts``, sorted and distinct."""
        entry, distance = np.zeros(len(parts), np.int64), np.zeros(len(parts), np.int64)
        for at in range(0, len(parts), BLOCK):
            found = self.block(parts[at : at + BLOCK])
            best = found.argmin(1)
            entry[at : at + BLOCK], distance[at : at + BLOCK] = best, found[np.arange(len(best)), best]
        return entry, distance


def _matrix(lists: pa.Array, width: int) -> np.ndarray:
    return lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(lists), width)


def _sorted(parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct rows in lexicographic order, and which of them each row is."""
    order = np.lexsort(parts.T[::-1]) if parts.shape[1] else np.arange(len(parts))
    rows = parts[order]
    new = np.ones(len(rows), bool)
    new[1:] = (rows[1:] != rows[:-1]).any(1)
    of = np.empty(len(rows), np.int64)
    of[order] = np.cumsum(new) - 1
    return rows[new], of


def usable(vector: Column) -> Column:
    """Whether a vector is not null and all its components are finite."""
    return vector.isNotNull() & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))


def integer_vectors(vectors: DataFrame, vector: str = "embedding", keep: tuple[str, ...] = ("vec_id",)) -> DataFrame:
    """``keep`` columns and ``v``, the integers floor(1024 * x), of the usable rows."""
    return vectors.where(usable(F.col(vector))).select(*keep, F.transform(vector, lambda x: F.floor(x.cast("double") * SCALE)).alias("v"))


def first_codebooks(rows: DataFrame, parts: int, entries: int) -> np.ndarray:
    """part x entry x dimension: the parts of the ``entries`` smallest vec_ids (nulls last, ties by vector)."""
    first = [r.v for r in rows.orderBy(F.col("vec_id").asc_nulls_last(), "v").limit(entries).select("v").collect()]
    width = len(first[0]) if first else 0
    if width % parts:
        raise ValueError(f"vectors of {width} components can't be cut into {parts} equal parts")
    return np.array(first, np.int64).reshape(len(first), parts, width // parts).transpose(1, 0, 2)


def distinct_parts(rows: DataFrame, parts: int, width: int) -> DataFrame:
    """position, part, weight: each distinct part once with its number of vectors, stored in order within its files.

    Copies are counted before the shuffle, so parts that very many vectors share weigh on no task.
    """
    cut = F.array(*[F.struct(F.lit(p).alias("position"), F.slice("v", p * width + 1, width).alias("part")) for p in range(parts)])
    counted = rows.select(F.inline(cut)).groupBy("position", "part").agg(F.count("*").alias("weight"))
    return stored(counted.sortWithinPartitions("position", "part"), "parts")


def entry_sums(parts: DataFrame, codebooks: np.ndarray) -> list:
    """position, entry, at, total, weight of the parts nearest to each entry: one row for each entry and dimension."""
    width = codebooks.shape[2]

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shape = codebooks.shape
        sums, counts = np.zeros(shape, np.int64), np.zeros(shape[:2], np.int64)
        walks: dict[int, TrieWalk] = {}
        for batch in batches:
            position, weight = (batch.column(batch.schema.get_field_index(c)).to_numpy() for c in ("position", "weight"))
            matrix = _matrix(batch.column(batch.schema.get_field_index("part")), width)
            for p in np.unique(position).tolist():
                at = np.flatnonzero(position == p)
                own = matrix[at]
                entry, _ = walks.setdefault(p, TrieWalk(codebooks[p])).nearest(own)
                np.add.at(sums[p], entry, own * weight[at][:, None])
                np.add.at(counts[p], entry, weight[at])
        used = np.argwhere(counts > 0)
        if len(used):
            p, e = (np.repeat(x, width) for x in used.T)
            d = np.tile(np.arange(width), len(used))
            yield pa.RecordBatch.from_arrays([pa.array(p.astype(np.int32)), pa.array(e.astype(np.int32)), pa.array(d.astype(np.int32)), pa.array(sums[p, e, d]), pa.array(counts[p, e])], names=["position", "entry", "at", "total", "weight"])

    summed = parts.mapInArrow(walk, "position int, entry int, at int, total long, weight long").groupBy("position", "entry", "at")
    return summed.agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"), F.sum("weight").alias("weight")).collect()


def fit(rows: DataFrame, parts: int = 4, entries: int = 256, rounds: int = 4) -> np.ndarray:
    """Codebooks (part x entry x dimension) after ``rounds`` rounds over all rows; see :func:`integer_vectors` for ``rows``.

    An entry becomes the floor of the mean of its parts; one that no part is nearest to stays.
    """
    codebooks = first_codebooks(rows, parts, entries)
    if codebooks.size == 0 or not rounds:
        return codebooks
    table = distinct_parts(rows, parts, codebooks.shape[2])
    for _ in range(rounds):
        found, codebooks = entry_sums(table, codebooks), codebooks.copy()  # entries x dimensions rows
        for r in found:
            codebooks[r.position, r.entry, r.at] = int(r.total) // r.weight
    dropped(table)
    return codebooks


def encode(rows: DataFrame, codebooks: np.ndarray, keep: tuple[str, ...] = ("vec_id",)) -> DataFrame:
    """``keep`` columns, ``code`` (two hexadecimal digits a part) and ``error`` (squared distances summed over parts) of each row.

    The distinct parts of a batch are put in order, walked, and their entries handed back to the rows.
    """
    parts, _, width = codebooks.shape

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digits = np.array([f"{i:02x}" for i in range(max(256, codebooks.shape[1]))])
        for batch in batches:
            if not batch.num_rows:
                continue
            matrix = _matrix(batch.column(batch.schema.get_field_index("v")), parts * width)
            code, error = np.full(batch.num_rows, "", "U1"), np.zeros(batch.num_rows, np.int64)
            for p in range(parts):
                distinct, of = _sorted(matrix[:, p * width : (p + 1) * width])
                entry, distance = TrieWalk(codebooks[p]).nearest(distinct)
                code = np.char.add(code, digits[entry[of]])
                error += distance[of]
            yield pa.RecordBatch.from_arrays([*(batch.column(batch.schema.get_field_index(c)) for c in keep), pa.array(code.tolist()), pa.array(error)], names=[*keep, "code", "error"])

    picked = rows.select(*keep, "v")
    kinds = dict(picked.dtypes)
    return picked.mapInArrow(assign, ", ".join(f"`{c}` {kinds[c]}" for c in keep) + ", code string, error long")


def decode(codes: DataFrame, codebooks: np.ndarray, code: str = "code", keep: tuple[str, ...] = ("vec_id",)) -> DataFrame:
    """``keep`` columns and ``v``, the integer vector that a code stands for: its entries one after the other."""
    books = [F.lit([[int(x) for x in e] for e in book]) for book in codebooks]
    entry = lambda p: F.conv(F.substring(code, 2 * p + 1, 2), 16, 10).cast("int") + 1
    return codes.select(*keep, F.concat(*[F.element_at(b, entry(p)) for p, b in enumerate(books)]).cast("array<long>").alias("v"))


def codebooks_sha256(codebooks: np.ndarray) -> str:
    """Of all components in decimal, by part, entry and place, joined by commas."""
    return sha256(",".join(map(str, codebooks.ravel().tolist())).encode()).hexdigest()


def compress(vectors: DataFrame, vector: str = "embedding", parts: int = 4, entries: int = 256, rounds: int = 4) -> tuple[DataFrame, np.ndarray]:
    """(vec_id, label, code, error, label_error for each usable row; the codebooks). vectors: vec_id, label and the vector.

    Rows whose vector is null or holds a null or non-finite component are left out. Repeated rows are all kept and count as often as they are there.
    Null vec_ids come last in the first codebooks; null labels are one label. An empty table gives no rows, empty vectors have
    error 0. Vectors of unequal length, of a length that can't be cut, or with components beyond 2^27 / 1024 raise ValueError. Other columns
    are ignored.
    """
    rows = stored(integer_vectors(vectors, vector, ("vec_id", "label")), "vectors")
    shape = rows.agg(F.min(F.size("v")).alias("a"), F.max(F.size("v")).alias("b"), F.max(F.array_max(F.transform("v", lambda x: F.abs(x)))).alias("most")).first()
    if shape.a != shape.b:
        raise ValueError(f"vectors have {shape.a} to {shape.b} components")
    if (shape.most or 0) > LARGEST:
        raise ValueError(f"components beyond {LARGEST // SCALE} have squared distances that a long doesn't hold")
    codebooks = fit(rows, parts, entries, rounds)
    coded = stored(encode(rows, codebooks, ("vec_id", "label")), "codes")
    by_label = coded.groupBy(F.col("label").alias("_label")).agg(F.sum("error").alias("label_error"))
    return coded.join(by_label, F.col("label").eqNullSafe(F.col("_label"))).drop("_label"), codebooks


def op13_part_trie_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contract's query: 4 parts, 256 entries, 4 rounds over all embeddings."""
    coded, codebooks = compress(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    return coded.select("vec_id", "code", "error", "label_error", F.lit(codebooks_sha256(codebooks)).alias("codebooks_sha256"))


def _sql(parts: int = 4, entries: int = 256, rounds: int = 4) -> str:
    near = "arg_min(entry, {'d': d, 'e': entry})"
    distance = "list_sum(list_transform(list_zip(p.part, b.part), lambda z: CAST(z[1] - z[2] AS HUGEINT) * (z[1] - z[2])))"
    assigned = lambda r: f"a{r} AS MATERIALIZED (SELECT position, part, {near} AS entry, min(d) AS d FROM (SELECT p.position, p.part, b.entry, {distance} AS d FROM u p JOIN b{r} b USING (position)) GROUP BY 1, 2)"
    ctes = [
        "v AS MATERIALIZED (SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor(CAST(x AS DOUBLE) * 1024) AS BIGINT)) AS v FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)",
        f"p AS MATERIALIZED (SELECT vec_id, label, position, v[position * len(v) // {parts} + 1:(position + 1) * len(v) // {parts}] AS part FROM v, (SELECT unnest(range({parts})) AS position))",
        "u AS MATERIALIZED (SELECT position, part, count(*) AS weight FROM p GROUP BY 1, 2)",
        f"f AS (SELECT vec_id, row_number() OVER (ORDER BY vec_id, v) - 1 AS entry FROM v ORDER BY vec_id, v LIMIT {entries})",
        "b0 AS MATERIALIZED (SELECT position, entry, part FROM f JOIN p USING (vec_id))",
    ]
    for r in range(rounds):
        ctes += [
            assigned(r),
            f"s{r} AS (SELECT position, entry, i, sum(x * weight) AS total, sum(weight) AS n FROM (SELECT a.position, a.entry, u.weight, unnest(u.part) AS x, generate_subscripts(u.part, 1) AS i FROM a{r} a JOIN u USING (position, part)) GROUP BY 1, 2, 3)",
            f"m{r} AS (SELECT position, entry, list(CAST((total - ((total % n) + n) % n) // n AS BIGINT) ORDER BY i) AS part FROM s{r} GROUP BY 1, 2)",
            f"b{r + 1} AS MATERIALIZED (SELECT b.position, b.entry, coalesce(m.part, b.part) AS part FROM b{r} b LEFT JOIN m{r} m USING (position, entry))",
        ]
    ctes += [
        assigned(rounds),
        f"c AS (SELECT vec_id, label, string_agg(format('{{:02x}}', entry), '' ORDER BY position) AS code, CAST(sum(d) AS BIGINT) AS error FROM p JOIN a{rounds} USING (position, part) GROUP BY 1, 2)",
        f"h AS (SELECT sha256(string_agg(array_to_string(part, ','), ',' ORDER BY position, entry)) AS codebooks_sha256 FROM b{rounds})",
    ]
    return f"WITH {', '.join(ctes)} SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256 FROM c, h"


OP13_SQL = _sql()
