"""Audit of text filters in all their orders (operator 11).

Every document gets a mask of the conditions that it fails. Documents of one part with one mask fare alike in any order,
so they are counted first: a part has at most 2^5 mask cells. Each cell then folds across
the array of all orders, a constant of the plan: ``transform`` over orders, ``aggregate`` over an
order's steps, which gives 120 x 5 = 600 structs weighted with the cell's counts. The cells of a part are merged by
elementwise sums. All of it is SQL on the JVM.
"""

from __future__ import annotations

import json
from itertools import permutations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Letters of the filters; a filter's bit in a mask is 1 << its place here.
FILTERS = "ABCDE"
ORDERS = ["".join(p) for p in permutations(FILTERS)]
COUNTS = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost"]
#: What separates words.
WHITE = r"[\x20\x09-\x0D]"


def text_failures(text: Column) -> Column:
    """Bits of the conditions A to D that a text fails; ``text`` is not null.

    A: under 50 words; B: 100 * distinct words < 65 * words; C: 100 * characters A-Z > 5 * code points; D: holds any of # $ % & * |.
    A text without words passes B, an empty one C and D, too.
    """
    words = F.array_remove(F.split(text, WHITE), "")
    conditions = [
        F.size(words) < 50,
        100 * F.size(F.array_distinct(words)).cast("long") < 65 * F.size(words).cast("long"),
        100 * F.regexp_count(text, F.lit("[A-Z]")).cast("long") > 5 * F.length(text).cast("long"),
        text.rlike(r"[#$%&*|]"),
    ]
    bits = [F.when(c, F.lit(1 << i)).otherwise(F.lit(0)) for i, c in enumerate(conditions)]
    return bits[0] + bits[1] + bits[2] + bits[3]


def failure_masks(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """part, digest, mask (A to D), doc_id, good, toxic for each row, without its text."""
    flag = lambda c: F.coalesce(F.max((F.col(c) == 1).cast("int")), F.lit(0))
    marks = labels.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("_key")).agg(flag("quality").alias("_good"), flag("toxic").alias("_toxic"))
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce("source", F.lit("")).alias("part"),
        F.unhex(F.sha2(text.cast("binary"), 256)).alias("digest"),
        text_failures(text).alias("mask"),
        F.coalesce(F.col("doc_id").cast("long"), F.monotonically_increasing_id()).alias("_key"),  # spreads rows without an id; nothing else hangs on it
    )
    labelled = F.col("doc_id").isNotNull()
    mark = lambda c: F.when(labelled, F.coalesce(c, F.lit(0))).otherwise(0).cast("long")
    return rows.join(marks, "_key", "left").select("part", "digest", "mask", "doc_id", mark("_good").alias("good"), mark("_toxic").alias("toxic"))


def mask_cells(rows: DataFrame) -> DataFrame:
    """part, mask (A to E), n, good, toxic: at most 32 rows a part.

    Copies of a text are counted by part before they meet, together with those of them that have the least doc_id
    of the part; E is failed by all copies but those of the least doc_id of all.
    """
    counts = [F.count("*").alias("n"), F.sum("good").alias("good"), F.sum("toxic").alias("toxic")]
    by_id = rows.groupBy("doc_id", "digest", "part", "mask").agg(*counts)
    all_counts = [F.sum(c).alias(c) for c in ("n", "good", "toxic")]
    first = F.min(F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "n", "good", "toxic"))).alias("first")
    none = F.sum(F.when(F.col("doc_id").isNull(), F.col("n"))).alias("no_id")
    copies = by_id.groupBy("digest", "part", "mask").agg(*all_counts, first, none)
    least = copies.groupBy("digest").agg(F.min("first.doc_id").alias("least"))
    copies = copies.join(least, "digest")
    passes = lambda c: F.coalesce(F.when(F.col("first.doc_id") == F.col("least"), F.col(f"first.{c}")), F.lit(0)) + (F.coalesce("no_id", F.lit(0)) if c == "n" else F.lit(0))
    # Rows without a doc_id have no labels, and no doc_id is smaller than theirs.
    split = F.array(
        F.struct(F.col("mask"), *[passes(c).alias(c) for c in ("n", "good", "toxic")]),
        F.struct((F.col("mask") + F.lit(1 << 4)).alias("mask"), *[(F.col(c) - passes(c)).alias(c) for c in ("n", "good", "toxic")]),
    )
    both = copies.select("part", F.inline(split))
    return both.where("n > 0").groupBy("part", "mask").agg(*all_counts)


def _constant(value: list, kind: str) -> Column:
    """A literal of nested type, which Catalyst folds and sends along with the plan."""
    return F.from_json(F.lit(json.dumps(value)), kind)


def order_steps(mask: Column, n: Column, good: Column, toxic: Column) -> Column:
    """600 structs of counts, those of each order's steps one after the other, for a cell of ``n`` documents."""
    orders = _constant([[1 << FILTERS.index(x) for x in order] for order in ORDERS], "array<array<int>>")
    zero = F.lit(0).cast("long")

    def step(state: Column, bit: Column) -> Column:
        fails = mask.bitwiseAND(bit) != 0
        alive = state["alive"]
        removed = alive & fails
        here = F.struct(
            F.when(alive & ~fails, n).otherwise(zero).alias("kept"),
            F.when(removed, n).otherwise(zero).alias("removed"),
            F.when(fails & ~alive, n).otherwise(zero).alias("redundant"),
            F.when(mask == bit, n).otherwise(zero).alias("unique_fails"),
            F.when(removed, good).otherwise(zero).alias("good_lost"),
            F.when(removed, toxic).otherwise(zero).alias("toxic_lost"),
        )
        return F.struct((alive & ~fails).alias("alive"), F.concat(state["steps"], F.array(here)).alias("steps"))

    kind = ", ".join(f"{c}: bigint" for c in COUNTS)
    start = F.struct(F.lit(True).alias("alive"), F.array().cast(f"array<struct<{kind}>>").alias("steps"))
    return F.flatten(F.transform(orders, lambda order: F.aggregate(order, start, step, lambda s: s["steps"])))


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """part, filter_order, step, the counts and shapley for each part (source; null: empty), order and step.

    A null text is empty; a null doc_id has no labels and fails E never; rows of equal doc_id and text pass or fail E together. A document with
    several label rows counts as good or toxic if any says so. An empty table gives no rows. Other columns are ignored.
    """
    cells = mask_cells(failure_masks(docs, labels))
    kind = ", ".join(f"{c}: bigint" for c in COUNTS)
    zeros = F.array_repeat(F.struct(*[F.lit(0).cast("long").alias(c) for c in COUNTS]), len(ORDERS) * len(FILTERS)).cast(f"array<struct<{kind}>>")
    summed = lambda a, b: F.zip_with(a, b, lambda x, y: F.struct(*[(x[c] + y[c]).alias(c) for c in COUNTS]))
    parts = cells.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("cells"))  # 32 at most
    merged = parts.select("part", F.aggregate("cells", zeros, lambda acc, c: summed(acc, order_steps(c["mask"], c["n"], c["good"], c["toxic"]))).alias("steps"))
    names = _constant([{"filter_order": order, "step": k + 1, "filter": FILTERS.index(x)} for order in ORDERS for k, x in enumerate(order)], "array<struct<filter_order: string, step: int, filter: int>>")
    named = merged.select("part", F.zip_with("steps", names, lambda s, o: F.struct(o["filter_order"].alias("filter_order"), o["step"].alias("step"), o["filter"].alias("filter"), *[s[c].alias(c) for c in COUNTS])).alias("steps"))
    removed = lambda i: F.aggregate(F.filter("steps", lambda s: s["filter"] == i), F.lit(0).cast("long"), lambda acc, s: acc + s["removed"])
    whole = named.withColumn("by_filter", F.array(*[removed(i) for i in range(len(FILTERS))]))
    return whole.select("part", "by_filter", F.inline("steps")).select("part", "filter_order", "step", *COUNTS, F.element_at("by_filter", F.col("filter") + 1).alias("shapley"))


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contract's query: five filters over all documents, by source."""
    return audit(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))


OP11_SQL = r"""WITH d AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
f AS (SELECT text, min(doc_id) AS least FROM d GROUP BY 1),
l AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic FROM labels GROUP BY 1),
m AS (SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic, [len(w) < 50, 100 * len(list_distinct(w)) < 65 * len(w), 100 * (length(text) - length(regexp_replace(text, '[A-Z]', '', 'g'))) > 5 * length(text), regexp_matches(text, '[#$%&*|]'), coalesce(d.doc_id > f.least, false)] AS fails
  FROM d JOIN f USING (text) LEFT JOIN l ON l.doc_id = d.doc_id),
c AS (SELECT part, fails, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM m GROUP BY 1, 2),
x AS (SELECT unnest([1, 2, 3, 4, 5]) AS i), o AS (SELECT [a.i, b.i, c.i, d.i, e.i] AS o FROM x a, x b, x c, x d, x e WHERE len(list_distinct([a.i, b.i, c.i, d.i, e.i])) = 5),
s AS (SELECT part, array_to_string(list_transform(o, lambda i: 'ABCDE'[i]), '') AS filter_order, k.i AS step, o[k.i] AS filter, n, good, toxic, fails[o[k.i]] AS fail, list_bool_or(list_transform(o[1:k.i - 1], lambda j: fails[j])) IS TRUE AS gone, len(list_filter(fails, lambda b: b)) AS many FROM c, o, x k),
r AS (SELECT part, filter_order, step, filter, CAST(sum(CASE WHEN NOT gone AND NOT fail THEN n ELSE 0 END) AS BIGINT) AS kept, CAST(sum(CASE WHEN NOT gone AND fail THEN n ELSE 0 END) AS BIGINT) AS removed, CAST(sum(CASE WHEN gone AND fail THEN n ELSE 0 END) AS BIGINT) AS redundant,
  CAST(sum(CASE WHEN fail AND many = 1 THEN n ELSE 0 END) AS BIGINT) AS unique_fails, CAST(sum(CASE WHEN NOT gone AND fail THEN good ELSE 0 END) AS BIGINT) AS good_lost, CAST(sum(CASE WHEN NOT gone AND fail THEN toxic ELSE 0 END) AS BIGINT) AS toxic_lost FROM s GROUP BY 1, 2, 3, 4)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, filter) AS BIGINT) AS shapley FROM r"""
