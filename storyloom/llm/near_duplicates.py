"""Near-duplicate classes by b-bit MinHash (operator 5).

Signatures hold ``MINIMA`` minima. Bands of ``BAND_ROWS`` whole minima give candidates; only the low
``BITS`` bits of each minimum are kept, packed into longs, and bit counts of their differences give an
estimate of similarity that is corrected for chance collisions (Li and König, 2010). Candidates whose
estimate is not far below the threshold are confirmed on the full sets.

Documents with equal sets form one class before anything is paired. In each bucket, the classes are
first compared with one of them only, the one that most others meet in any band: an original rather
than one of its edited copies. What that joins needs no further comparison. Buckets that still hold several
components compare all classes outside their largest component with all others of the bucket,
inside a join whose condition has the estimate and takes each pair in one band only, so that no list of
all pairs arises. A pair at the threshold of 0.85 shares no band with a probability of about 2e-8.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from storyloom.graph import connected_components
from storyloom.llm.text_arrays import _BASE, flat, mix, ngrams, slices, span_hashes, words
from storyloom.scratch import stored

#: Minima kept as low bits, those that also make bands, minima in a band, bits kept.
MINIMA, BANDED, BAND_ROWS, BITS = 1024, 96, 4, 4
#: Comparisons of whole buckets with one of their classes, before the rest is compared pair by pair; more
#: than one are with a class outside the largest component.
STARS = 1
_rng = np.random.default_rng(85)
_FACTORS = _rng.integers(0, 2**31, MINIMA, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_TERMS = _rng.integers(0, 2**32, MINIMA, dtype=np.uint32)


def shingle_sets(batch: pa.RecordBatch, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text, sorted within it, and how many each has."""
    data, offsets = flat(batch.column(batch.schema.get_field_index("text")))
    starts, ends, doc = words(data, offsets)
    hashes = span_hashes(data, starts, ends, lower=True)
    grams, at = ngrams(hashes, doc, n)
    owner = doc[at]
    count = np.bincount(doc, minlength=batch.num_rows)
    first = np.cumsum(count) - count
    short = np.flatnonzero((count > 0) & (count < n))
    if len(short):  # the whole sequence is the one shingle
        whole = hashes[first[short]].copy()
        for j in range(1, n - 1):
            more = count[short] > j
            whole[more] = whole[more] * _BASE + hashes[first[short][more] + j]
        grams, owner = np.concatenate([grams, mix(whole ^ count[short].astype(np.uint64))]), np.concatenate([owner, short])
    order = np.lexsort((grams, owner))
    grams, owner = grams[order], owner[order]
    new = np.ones(len(grams), bool)
    new[1:] = (grams[1:] != grams[:-1]) | (owner[1:] != owner[:-1])
    return grams[new], np.bincount(owner[new], minlength=batch.num_rows)


def _lists(values: np.ndarray) -> pa.ListArray:
    rows, width = values.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(0, (rows + 1) * width, width, dtype=np.int32)), pa.array(np.ascontiguousarray(values).view(np.int64).ravel()))


def signatures(docs: DataFrame, shingle_words: int) -> DataFrame:
    """doc_id, n_shingles, s1 and s2 (128 bits that name the set), bits, bands."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            sets, count = shingle_sets(batch, shingle_words)
            full = np.flatnonzero(count)
            firsts = (np.cumsum(count) - count)[full]
            minima = np.zeros((batch.num_rows, MINIMA), np.uint32)
            s1, s2 = np.zeros(batch.num_rows, np.uint64), np.zeros(batch.num_rows, np.uint64)
            if len(full):
                x = (sets >> np.uint64(32)).astype(np.uint32)
                for j in range(MINIMA):
                    minima[full, j] = np.minimum.reduceat(x * _FACTORS[j] + _TERMS[j], firsts)
                s1[full] = np.add.reduceat(mix(sets), firsts)
                s2[full] = np.add.reduceat(mix(sets ^ _BASE), firsts)
            low = ((minima ^ (minima >> np.uint32(16))) & np.uint32((1 << BITS) - 1)).astype(np.uint64)
            per = 64 // BITS
            packed = (low.reshape(batch.num_rows, -1, per) << (np.arange(per, dtype=np.uint64) * np.uint64(BITS))).sum(2, dtype=np.uint64)
            whole = minima[:, :BANDED].astype(np.uint64).reshape(batch.num_rows, -1, BAND_ROWS)
            bands = np.zeros(whole.shape[:2], np.uint64)
            for j in range(BAND_ROWS):
                bands = mix(bands ^ whole[:, :, j])
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(count.astype(np.int64)), pa.array(s1.view(np.int64)), pa.array(s2.view(np.int64)), _lists(packed), _lists(bands)], names=["doc_id", "n_shingles", "s1", "s2", "bits", "bands"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(sign, "doc_id long, n_shingles long, s1 long, s2 long, bits array<long>, bands array<long>")


def full_sets(docs: DataFrame, shingle_words: int) -> DataFrame:
    """doc_id and ``shingles``, its whole set."""

    def collect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            sets, count = shingle_sets(batch, shingle_words)
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(count)]).astype(np.int32)), pa.array(sets.view(np.int64)))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), lists], names=["doc_id", "shingles"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(collect, "doc_id long, shingles array<long>")


def _differing(x: Column, y: Column) -> Column:
    """How many of the minima in two longs differ."""
    differ = x.bitwiseXOR(y)
    for shift in (1, 2):
        differ = differ.bitwiseOR(F.shiftrightunsigned(differ, shift))
    return F.bit_count(differ.bitwiseAND(F.lit(0x1111111111111111)))


def _most_differing(percent: int, minima: int) -> int:
    """Differing minima of a pair at the threshold: chance collisions taken off, five standard deviations allowed."""
    differ = (1 - percent / 100) * (1 - 2.0**-BITS)
    return int(minima * differ + 5 * (minima * differ * (1 - differ)) ** 0.5)


def estimate(x: Column, y: Column) -> Column:
    """Similarity from packed low bits: the share of equal minima, less what chance would give."""
    differ = F.aggregate(F.zip_with(x, y, _differing), F.lit(0), lambda a, b: a + b)
    return 1 - differ / F.lit(MINIMA) / (1 - 2.0**-BITS)


def _could_link(n: Column, m: Column, x: Column, y: Column, percent: int, also: Column) -> Column:
    """Sizes that allow a link, then a quick look at the first minima, then ``also``, then the estimate from all."""
    quick = sum((_differing(x[i], y[i]) for i in range(1, 12)), _differing(x[0], y[0])) <= _most_differing(percent, 12 * 64 // BITS)
    least = 1 - (_most_differing(percent, MINIMA) + 1) / MINIMA / (1 - 2.0**-BITS)
    return (F.least(n, m) * 100 >= F.greatest(n, m) * percent) & quick & also & (estimate(x, y) > least)


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) with 100 * intersection >= percent * union."""
    left = sets.select(F.col("doc_id").alias("a"), F.col("shingles").alias("sa"))
    right = sets.select(F.col("doc_id").alias("b"), F.col("shingles").alias("sb"))
    common = F.size(F.array_intersect("sa", "sb"))
    return pairs.join(right, "b").join(left, "a").where(common * (100 + percent) >= (F.size("sa") + F.size("sb")) * percent).select("a", "b")


def near_duplicates(docs: DataFrame, shingle_words: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest doc_id reachable over links) and kept, one row for each row.

    Words are compared with A-Z in lower case. Documents without words (null or empty text) are linked
    with nothing. Rows of one doc_id count as one node; a row whose doc_id is null gets the component
    of its set, and null if no other row has that set. Other columns are ignored.
    """
    key = ["s1", "s2", "n_shingles"]
    signed = stored(signatures(docs, shingle_words), "signatures")
    classes = signed.where("n_shingles > 0").groupBy(*key).agg(F.min("doc_id").alias("rep"))
    nodes = stored(signed.join(classes, key).where("doc_id = rep").select("rep", "n_shingles", "bits", "bands").dropDuplicates(["rep", "n_shingles", "bits"]), "nodes")

    buckets = nodes.select("rep", F.posexplode("bands").alias("band", "value"))
    shared = buckets.groupBy("band", "value").agg(F.min("rep").alias("first"), F.max("rep").alias("last"), F.count("*").alias("met")).where("first <> last")
    members = stored(buckets.join(shared.select("band", "value", "met"), ["band", "value"]), "members")
    popular = stored(members.groupBy("rep").agg(F.sum("met").alias("met")), "popular")
    sets = stored(full_sets(docs.select("doc_id", "text").join(popular.select(F.col("rep").alias("doc_id")), "doc_id", "left_semi"), shingle_words), "sets")

    facts = nodes.select("rep", "n_shingles", "bits")
    hub_facts = facts.select(F.col("rep").alias("a"), F.col("n_shingles").alias("na"), F.col("bits").alias("xa"))
    own_facts = facts.select(F.col("rep").alias("b"), F.col("n_shingles").alias("nb"), F.col("bits").alias("xb"))
    place = ["band", "value"]
    placed = members.select(*place, "rep").join(popular, "rep").withColumn("component", F.col("rep"))
    links, components = None, None
    for nth in range(STARS + 1):
        if nth:
            placed = members.select(*place, "rep").join(popular, "rep").join(components.withColumnRenamed("node", "rep"), "rep", "left").withColumn("component", F.coalesce("component", "rep"))
            sizes = placed.groupBy(*place, "component").agg(F.count("*").alias("n"))
            mixed = sizes.groupBy(*place).agg(F.max_by("component", F.struct("n", "component")).alias("largest"), F.count("*").alias("parts")).where("parts > 1")
            placed = stored(placed.join(mixed.drop("parts"), place), "placed")
            if nth == STARS:
                break
        candidates = placed.where("component <> largest") if nth else placed
        hubs = candidates.groupBy(*place).agg(F.max_by(F.struct("rep", "component"), F.struct("met", "rep")).alias("hub"))
        stars = placed.join(hubs, place).where("rep <> hub.rep AND component <> hub.component").select(F.col("hub.rep").alias("a"), F.col("rep").alias("b")).distinct()
        likely = stars.join(own_facts, "b").join(hub_facts, "a").where(_could_link(F.col("na"), F.col("nb"), F.col("xa"), F.col("xb"), percent, F.lit(True))).select("a", "b")
        more = stored(_confirmed(likely, sets, percent), "links")
        links = more if links is None else links.unionByName(more)
        components = connected_components(links)

    rest = placed.select(*place, "rep", "component", "largest").join(nodes.select("rep", "n_shingles", "bits", "bands"), "rep")
    x, y = rest.where("component <> largest").alias("x"), rest.alias("y")
    earlier = F.forall(F.sequence(F.lit(0), F.col("x.band")), lambda i: (i == F.col("x.band")) | (F.get("x.bands", i) != F.get("y.bands", i)))
    apart = (F.col("x.band") == F.col("y.band")) & (F.col("x.value") == F.col("y.value")) & (F.col("x.component") != F.col("y.component"))
    once = (F.col("y.component") == F.col("y.largest")) | (F.col("x.rep") < F.col("y.rep"))
    open_pairs = x.join(y, apart & once & _could_link(F.col("x.n_shingles"), F.col("y.n_shingles"), F.col("x.bits"), F.col("y.bits"), percent, earlier))
    open_pairs = open_pairs.select(F.col("x.rep").alias("a"), F.col("y.rep").alias("b")).distinct()
    more = stored(_confirmed(open_pairs, sets, percent), "links")
    if not more.isEmpty():
        components = connected_components(links.unionByName(more))

    # Classes and components are joined first, as there are fewer of them than documents.
    found = classes.join(components.withColumnRenamed("node", "rep"), "rep", "left").select(*key, F.coalesce("component", "rep").alias("component_id"))
    out = signed.select("doc_id", *key).join(found, key, "left").withColumn("component_id", F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id")))
    return out.select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def op5_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contract's query: three-word shingles, similarity of 0.85 or more."""
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"), shingle_words=3, percent=85)
