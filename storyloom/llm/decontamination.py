"""Benchmark decontamination by templates (operator 3), in DataFrame functions only.

Numbers, names and units become typed placeholders, so that a question stays recognisable when its
values are changed. Windows of template words are joined by hash. Where they match, the values in the
placeholders must be consistent: each value of the benchmark item is always replaced by the same value.

Two passes keep the work in proportion. The first hashes every window of each document and looks for it
among all windows of the benchmark, so that every run of ``window`` equal template words is found, wherever
it lies; items of fewer words are windows as a whole. The second compares the words of the windows found, by occurrence, since a document may hold an
item several times with different values.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from storyloom.scratch import stored

# Units of measure and money, as they follow a number.
UNITS = ["mm", "cm", "m", "km", "inch", "inches", "foot", "feet", "mile", "miles", "mg", "g", "kg", "lb", "lbs", "ton", "tons", "ml", "l", "litre", "litres", "liter", "liters", "s", "sec", "second", "seconds", "minute", "minutes", "hour", "hours", "day", "days", "week", "weeks", "month", "months", "year", "years", "percent", "dollar", "dollars", "euro", "euros", "pound", "pounds", "cent", "cents", "usd", "eur"]
# Numbers in words.
NUMBER_WORDS = ["two", "three", "four", "five", "six", "seven", "eight", "nine", "ten", "eleven", "twelve", "thirteen", "fourteen", "fifteen", "sixteen", "seventeen", "eighteen", "nineteen", "twenty", "thirty", "forty", "fifty", "sixty", "seventy", "eighty", "ninety", "hundred", "thousand", "million"]
#: First characters of words that are names, numbers, quantities or units, and of words that may be names.
_NAME, _NUMBER, _QUANTITY, _UNIT, _MAYBE = "\x01", "\x02", "\x03", "\x04", "\x05"
#: Between names or number words that are one.
_LINK = "\x06"
_TYPED = {_NAME: "<name>", _NUMBER: "<number>", _QUANTITY: "<quantity>", _UNIT: "<unit>"}
#: Benchmark windows up to this many are broadcast (8 bytes each); more are joined by a shuffle.
BROADCAST_WINDOWS = 1_000_000


def _marked(text: Column) -> Column:
    """Words in lower case without ASCII punctuation; those that a template replaces have their type's mark before them.

    Patterns begin with what is rare, so that most characters are passed at the first test. Names are
    capitalised words inside a sentence; at its start they may be names (``_MAYBE``).
    """
    marked = F.regexp_replace(F.concat(F.lit(" "), F.coalesce(text, F.lit(""))), r"\s[\"'(\[“‘„«¿¡]{0,3}(?=\p{Lu}\p{Ll})", f"$0{_MAYBE}")
    marked = F.regexp_replace(marked, rf"{_MAYBE}(?<=[\p{{L}}\p{{N}},;:]\s{_MAYBE})", _NAME)
    clean = F.concat(F.lit(" "), F.regexp_replace(F.lower(marked), r"[!-/:-@\[-`{-~]+", ""))
    spelled = rf"\s(?=[tfsenhm][weiouhal])({'|'.join(NUMBER_WORDS)})(?=\s|$)"
    clean = F.regexp_replace(clean, spelled, f" {_NUMBER}$1")
    units = "|".join(UNITS)
    numbers = F.regexp_replace(clean, r"[0-9](?<=\s[0-9])(?=[0-9]*(?:\s|$))", f"{_NUMBER}$0")
    quantities = F.regexp_replace(numbers, rf"[0-9](?<=\s[0-9])(?=[0-9]*(?:{units})(?:\s|$))", f"{_QUANTITY}$0")
    measured = F.regexp_replace(quantities, rf"({_NUMBER}[^\s]+\s+){_MAYBE}?(?={units})(?=(?:{units})(?:\s|$))", f"$1{_UNIT}")
    return F.btrim(F.when(clean.rlike(f"[0-9{_NUMBER}]"), measured).otherwise(clean), F.lit(" \t\n\r\f\x0b"))


def _linked(marked: Column) -> Column:
    """Marked words with names that follow each other as one, and numbers in words likewise."""
    names = F.regexp_replace(marked, rf"\s{_NAME}(?<={_NAME}\S{{1,40}}\s{_NAME})", _LINK)
    return F.regexp_replace(names, rf"\s{_NUMBER}(?<={_NUMBER}[a-z]{{3,10}}\s{_NUMBER})(?=[a-z])", _LINK)


def _raw(word: Column) -> Column:
    return F.when(word < "\x06", F.substring(word, 2, 1 << 30)).otherwise(word)


def _is_slot(word: Column, maybe: bool) -> Column:
    """Is the word replaced, that is, typed or, in the form ``maybe``, perhaps a name?"""
    return (word < (_MAYBE if not maybe else "\x06")) & (word != "")


def _template(word: Column, maybe: bool) -> Column:
    """The word as it stands in a template; ``maybe``: words that may be names are."""
    typed = F.when(word.startswith(_MAYBE), F.lit("<name>") if maybe else F.substring(word, 2, 1 << 30))
    for mark, name in _TYPED.items():
        typed = typed.when(word.startswith(mark), name)
    return F.when(word < "\x06", typed).otherwise(word)


def templates(rows: DataFrame, key: str) -> DataFrame:
    """key, a hash of the text (``copy``) and its marked words; once more with linked names and numbers where that differs.

    So "Mary Ann" may stand for "Anna" and "twenty five" for "25", and words that are the same word for word still match singly.
    """
    marked = rows.select(F.col(key).cast("long").alias(key), F.xxhash64("text").alias("copy"), _marked(F.col("text")).alias("text"))
    both = marked.select(key, "copy", "text", F.when(F.col("text").rlike(rf"[{_NAME}{_NUMBER}]\S+\s[{_NAME}{_NUMBER}]"), _linked(F.col("text"))).alias("linked"))
    forms = F.array(F.struct("copy", "text"), F.when(F.col("linked") != F.col("text"), F.struct(F.xxhash64("copy", F.lit("linked")).alias("copy"), F.col("linked").alias("text"))))
    each = both.select(key, F.explode(forms).alias("form")).where("form IS NOT NULL")
    return each.select(key, "form.copy", F.split("form.text", r"\s+").alias("marked"))


def _windows(frame: DataFrame, window: int, exact: list[int], typed: bool = True) -> DataFrame:
    """Add ``at`` (from 1), ``hash`` and ``plain`` of each window, once more as names (not ``plain``) where that differs.

    For each length of ``exact``, every run of so many words is a window, too, known by its words as they
    stand. Each word is hashed once, positions are exploded, and windows are hashes of hashes, in code that
    is small enough to be compiled. The outer explode drops no row: a filter on sizes before it would be
    moved below the template expressions and compute them twice.
    """
    keys = [c for c in frame.columns if c != "marked"]
    forms = {"_plain": F.transform("marked", lambda w: F.xxhash64(_template(w, False))), "_named": F.transform("marked", lambda w: F.xxhash64(_template(w, True)))} if typed else {}
    if exact:
        forms["_raw"] = F.transform("marked", lambda w: F.xxhash64(_raw(w)))
    lengths = [*([window] if typed else []), *exact]
    starts = F.sequence(F.lit(0), F.greatest(F.size("marked") - min(lengths), F.lit(0)))
    rows = frame.select(*keys, F.size("marked").alias("_size"), *[c.alias(n) for n, c in forms.items()], starts.alias("_starts"))
    rows = rows.select(*keys, "_size", *forms, F.explode_outer("_starts").alias("_i"))
    run = lambda c, n: [F.get(c, F.col("_i") + j) for j in range(n)]
    fits = lambda n: F.col("_i") + n <= F.col("_size")
    hashes = [F.when(fits(window), F.xxhash64(*run(c, window))).alias(c) for c in ("_plain", "_named") if typed]
    hashes += [F.when(fits(n), F.xxhash64(F.lit(n), *run("_raw", n))).alias(f"_{n}") for n in exact]
    rows = rows.select(*keys, "_i", *hashes)
    every = F.array(*(["_plain", F.nullif("_named", "_plain")] if typed else [F.lit(None).cast("long")] * 2), *[f"_{n}" for n in exact])
    out = rows.select(*keys, "_i", F.posexplode_outer(every).alias("_k", "hash")).where("hash IS NOT NULL")
    return out.select(*keys, (F.col("_i") + 1).alias("at"), "hash", (F.col("_k") != 1).alias("plain"))


def _item_windows(wanted: DataFrame, window: int) -> tuple[DataFrame, list[int]]:
    """Windows of the benchmark, and the lengths of those that are known by their words as they stand.

    These are items of fewer than ``window`` words, which are one window each, and all windows of ``window`` words: those of
    placeholders only say too little as templates, and names can't be told in a copy that is all in capitals.
    """
    exact = sorted(r["n"] for r in wanted.select(F.least("item_words", F.lit(window)).alias("n")).distinct().collect())  # at most ``window`` numbers
    long = wanted.where(F.col("item_words") >= window)
    parts = [_windows(wanted.where(F.col("item_words") == n), window, [n], typed=False) for n in exact if n < window]
    slots = F.forall(F.slice("marked", F.col("at"), window), lambda w: _is_slot(w, True))
    whole = long.join(_windows(long, window, []).select("item_id", "version", "at", "hash", "plain"), ["item_id", "version"]).where(~slots)
    parts.append(whole.select("item_id", "version", "item_words", "at", "hash", "plain"))
    if window in exact:
        values = long.join(_windows(long, window, [window], typed=False).select("item_id", "version", "at", "hash", "plain"), ["item_id", "version"])
        parts.append(values.select("item_id", "version", "item_words", "at", "hash", "plain"))
    rows = reduce(DataFrame.unionByName, parts)
    return rows.select("item_id", "version", "item_words", F.col("at").alias("item_at"), "hash", F.col("plain").alias("item_plain")).distinct(), exact


def _occurrences(pairs: DataFrame) -> DataFrame:
    """Each pair of windows with the parts of the document by which it is judged (``part``).

    These are the whole document; the diagonal (document place less item place), which holds one
    alignment even where the item repeats itself; and the stretch, in which the item's windows follow
    in order on neighbouring diagonals, as around an edit. A stretch takes of each document window the
    match on the strongest diagonal, and ends where the item begins again or the diagonal jumps by more
    than the item's length.
    """
    key = ["doc_id", "copy", "item_id", "version"]
    part = lambda kind, n: F.struct(F.lit(kind).alias("kind"), n.cast("long").alias("n"))
    sides = pairs.withColumn("part", F.explode(F.array(part("whole", F.lit(0)), part("diagonal", F.col("diagonal")))))
    weighed = pairs.withColumn("_weight", F.count("*").over(Window.partitionBy(*key, "diagonal")))
    ranked = weighed.withColumn("_rank", F.row_number().over(Window.partitionBy(*key, "at").orderBy(F.desc("_weight"), "item_at")))
    order = Window.partitionBy(*key).orderBy("at")
    back = (F.col("item_at") <= F.lag("item_at").over(order)) | (F.abs(F.col("diagonal") - F.lag("diagonal").over(order)) > F.col("item_words"))
    broken = ranked.where("_rank = 1").withColumn("_new", F.coalesce(back, F.lit(False)).cast("int"))
    stretches = broken.withColumn("part", part("stretch", F.sum("_new").over(order))).drop("_weight", "_rank", "_new")
    return sides.unionByName(stretches)


def contaminated(docs: DataFrame, benchmark: DataFrame, window: int = 8, coverage: float = 0.5, consistency: float = 0.8) -> DataFrame:
    """One row for each (doc_id, item_id) where the document holds the item or a variant with other values.

    ``matched_words`` of the item's ``item_words`` lie in windows of equal template words, at least
    ``coverage`` of them. Of the item's ``slots`` that matched, at least ``consistency`` must be
    consistent: an item's value always meets the same value. A capitalised word at the start of a sentence
    matches as the word it is or as a name. Both are judged for the whole document and
    for each occurrence in it; one that passes is enough, and of several the row describes the one with
    most matched words. ``reparameterised`` says that some value differs there. An item of fewer than
    ``window`` words is one window as a whole, and only with its own values, as so short a template says too
    little. Null or empty texts and null ids match nothing. Repeated rows of one id count as one; other
    columns are ignored.
    """
    wanted = templates(benchmark.where("item_id IS NOT NULL"), "item_id").where("marked[0] <> '' OR size(marked) > 1")
    wanted = stored(wanted.withColumnRenamed("copy", "version").withColumn("item_words", F.size("marked").cast("long")), "wanted")
    items, exact = _item_windows(wanted, window)
    items = stored(items, "items")
    hashes = items.select("hash").distinct()
    small = items.count() <= BROADCAST_WINDOWS
    if small:
        hashes, items = F.broadcast(hashes), F.broadcast(items)
    known = docs.where("doc_id IS NOT NULL")
    seen = _windows(templates(known, "doc_id"), window, exact).join(hashes, "hash", "left_semi")
    seen = stored(seen, "seen").distinct()
    pairs = seen.join(items, "hash").groupBy("doc_id", "copy", "item_id", "version", "item_words", "at", "item_at").agg(F.max(F.col("plain") & F.col("item_plain")).alias("plain"))
    pairs = stored(pairs.withColumn("diagonal", F.col("at") - F.col("item_at")), "pairs")
    # From here on all is done text by text: dealt out once, windows, joins and sums need no other shuffle.
    dealt = pairs.repartition("doc_id", "copy")
    # Windows equal as plain words are judged by themselves and with the others. Of windows that follow each other on
    # a diagonal, each gives only the places that those before have not given.
    key = ["doc_id", "copy", "item_id", "version", "item_words", "part", "diagonal", "plain"]
    met = _occurrences(dealt).withColumn("plain", F.explode(F.when(F.col("plain"), F.array(F.lit(True), F.lit(False))).otherwise(F.array(F.lit(False)))))
    last = F.least(F.col("item_at") + window - 1, F.col("item_words"))
    given = F.max(last).over(Window.partitionBy(*key).orderBy("item_at").rowsBetween(Window.unboundedPreceding, -1))
    met = met.withColumn("_from", F.greatest(F.col("item_at"), F.coalesce(given + 1, F.lit(1)))).where(F.col("_from") <= last)
    met = met.select(*key, F.explode_outer(F.sequence("_from", last)).alias("place"))
    # Each word of the item with each word it met; what repeated rows repeat is counted once below. The ids
    # are written first, so that the join knows their size and need not shuffle the texts.
    likely = known.join(stored(pairs.select("doc_id").distinct(), "likely"), "doc_id", "left_semi")
    ours = templates(likely, "doc_id").dropDuplicates(["doc_id", "copy"])
    theirs = wanted.select("item_id", "version", F.posexplode("marked").alias("place", "w"))
    theirs = theirs.select("item_id", "version", (F.col("place") + 1).alias("place"), _raw(F.col("w")).alias("theirs"), _is_slot(F.col("w"), False).alias("_words"), _is_slot(F.col("w"), True).alias("_named"))
    if small:
        theirs = F.broadcast(theirs)
    # Files say little of what their rows explode to, so no side is broadcast by their size.
    met = met.hint("merge").join(ours, ["doc_id", "copy"]).withColumn("ours", _raw(F.get("marked", F.col("place") + F.col("diagonal") - 1))).drop("marked")
    met = met.join(theirs, ["item_id", "version", "place"]).withColumn("is_slot", F.when(F.col("plain"), F.col("_words")).otherwise(F.col("_named")))
    group = ["doc_id", "copy", "item_id", "version", "item_words", "part", "plain"]
    slot = F.when(F.col("is_slot"), F.col("ours"))
    each = met.groupBy(*group, "theirs", "place").agg(F.max("is_slot").alias("is_slot"), F.min(slot).alias("least"), F.max(slot).alias("most"), F.max(F.col("is_slot") & (F.col("ours") != F.col("theirs"))).alias("changed"))
    values = each.groupBy(*group, "theirs").agg(F.count("*").alias("places"), F.count_if("is_slot").alias("slots"), (F.min("least") == F.max("most")).alias("one"), F.max("changed").alias("changed"))
    judged = values.groupBy(*group).agg(F.sum("places").alias("matched_words"), F.sum("slots").alias("slots"), F.sum(F.when(F.col("one"), F.col("slots")).otherwise(0)).alias("consistent_slots"), F.max("changed").alias("changed"))
    passed = judged.where((F.col("matched_words") >= F.col("item_words") * coverage) & (F.col("consistent_slots") >= F.col("slots") * consistency))
    best = passed.groupBy("doc_id", "item_id").agg(F.max(F.struct("matched_words", "consistent_slots", (-F.col("slots")).alias("slots"), (~F.col("changed")).alias("same"), "item_words")).alias("b"))
    return best.select("doc_id", "item_id", "b.matched_words", "b.item_words", (-F.col("b.slots")).alias("slots"), "b.consistent_slots", (~F.col("b.same")).alias("reparameterised"))


def op3_template_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents against the whole benchmark: the pairs in which a document holds an item or a variant."""
    return contaminated(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
