"""Numbered operators against plain versions, on the given tables and on awkward rows."""

import bisect
import hashlib
import re
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from storyloom.llm import decontamination, language_field, language_model, near_duplicates, packing, phrase_fingerprints, sharding, substring_dedup, token_files, toxicity
from storyloom.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
WORDS = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
LONG = " ".join(f"word{i % 977} é{i % 13}" for i in range(30_000))
AWKWARD = [(1, "One two three four five six seven eight nine ten eleven twelve thirteen fourteen.", "en", "a"), (1, "One two three four five six seven eight nine ten eleven twelve thirteen fourteen.", "en", "a"), (2, None, None, None), (3, "", "fr", "b"), (4, LONG, "en", "a"), (5, " \n\t ", "en", "a"), (None, "A text without an id, but with words", "en", None), (7, "One two three four five six seven eight nine ten eleven twelve thirteen fourteen.", "de", "c"), (8, "12345 !!! ***", "en", "a"), (9, LONG, "en", "a"), (10, "ñandú ÄÖÜ 中文字符 \U0001f600", "es", "d"), (11, "x", "en", "a")]
CLASHING = ["seed", "hash", "part", "band", "component", "n", "bucket", "shard", "size", "word", "text_key", "score", "raw", "words", "rep", "chunk", "length"]


@pytest.fixture(scope="module")
def awkward(spark):
    df = spark.createDataFrame(AWKWARD, "doc_id long, text string, lang string, source string").withColumn("n_chars", F.length("text").cast("long"))
    return df.select("*", *[F.lit("x").alias(c) for c in CLASHING]).cache()


@pytest.fixture(scope="module")
def empty(awkward):
    return awkward.limit(0)


@pytest.fixture(scope="module")
def given(spark):
    return {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}


def byte_path():
    return public_tokenizers.path("byte_bpe_50k.json")


def run_all(spark, docs):
    labels = spark.createDataFrame([(1, 1), (7, 0), (None, 1), (4, None)], "doc_id long, toxic int")
    items = spark.createDataFrame([(1, "One two three four five six seven eight nine ten eleven twelve"), (2, None), (3, "")], "item_id long, text string")
    return {
        1: packing.pack_documents(docs, byte_path()).collect(),
        2: substring_dedup.remove_repeats(docs).collect(),
        3: decontamination.contaminated(docs, items).collect(),
        4: sharding.shard(docs).collect(),
        5: near_duplicates.near_duplicates(docs).collect(),
        6: language_model.score(docs, language_model.fit(docs)).collect(),
        7: phrase_fingerprints.compare_with_following(docs).collect(),
        8: language_field.identify(docs, language_field.fit_sample(docs)).collect(),
        10: toxicity.toxicity(docs, toxicity.fit(docs, labels)).collect(),
    }


def test_empty_tables(spark, empty, tmp_path):
    assert all(not rows for rows in run_all(spark, empty).values())
    token_files.write_token_files(empty, str(tmp_path / "t"), byte_path(), "space", 2)
    assert token_files.read_token_files(spark, str(tmp_path / "t"), "ids").count() == 0


def test_awkward_rows(spark, awkward, tmp_path):
    out = run_all(spark, awkward)
    n = len(AWKWARD)
    assert all(len(out[k]) == n for k in (2, 4, 5, 6, 7, 8, 10))
    pieces = defaultdict(list)
    for r in out[1]:
        pieces[r.sequence_id].append((r.offset, r.length))
    assert all(sum(x for _, x in p) <= 1024 and sorted(p)[0][0] == 0 for p in pieces.values())
    assert {r.doc_id for r in out[3]} == {1, 7}
    assert {r.doc_id: r.component_id for r in out[5] if r.doc_id} == {1: 1, 2: 2, 3: 3, 4: 4, 5: 5, 7: 1, 8: 8, 9: 4, 10: 10, 11: 11}
    assert {r.doc_id: r.n_removed for r in out[2] if r.doc_id in (1, 7, 9)} == {1: 0, 7: 14, 9: 60_000}
    assert {r.doc_id: r.lang_pred for r in out[8]}[8] == "und" and all(0 <= r.score <= 1 for r in out[8])
    assert {r.doc_id: r.n_tokens for r in out[6]}[2] == 1
    for s in {r.shard for r in out[4]}:
        assert sorted(r.slot for r in out[4] if r.shard == s) == list(range(sum(r.shard == s for r in out[4])))
    token_files.write_token_files(awkward, str(tmp_path / "t"), byte_path(), "space", 2)
    rows = token_files.read_token_files(spark, str(tmp_path / "t"), "ids").orderBy("start").collect()
    assert len(rows) == n and [r.start for r in rows] == [sum(len(x.ids) for x in rows[:i]) for i in range(n)]
    known = {}
    for r in out[7]:
        known.setdefault(r.doc_id, r.fingerprint)
    assert known[1] == known[7] and known[2] == known[3]


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_ids_equal_the_tokenizer(name, given):
    import pyarrow as pa

    from storyloom.llm.text_arrays import flat
    from storyloom.llm.token_ids import Encoder

    texts = [*list(given.values())[:60], "a  b\n c", "x 　y", " lead", "trail ", "don't we'll", "a \x1fb", "a<|endoftext|>b", 'foo.Bar,don\'t"x', "a1b2.c", "", "ab", "c", "A<|ENDOFTEXT|>"]
    plain, cut = Tokenizer.from_file(public_tokenizers.path(name)), "space" if name.startswith("byte") else "white"
    ids, count = Encoder(public_tokenizers.path(name), cut).encode(*flat(pa.array(texts)))
    assert [x.tolist() for x in np.split(ids, np.cumsum(count)[:-1])] == [plain.encode(t, add_special_tokens=False).ids for t in texts]


def test_packing_equals_sequential_best_fit():
    rng = np.random.default_rng(1)
    lengths = np.minimum(64, rng.geometric(0.08, 500))
    plan = packing.best_fit_plan({int(k): int((lengths == k).sum()) for k in set(lengths)}, 64)
    used = defaultdict(list)
    for i, (length, rank, per, first, offset) in enumerate(plan):
        following = [p[1] for p in plan[i + 1 :] if p[0] == length]
        stop = following[0] if following else int((lengths == length).sum())
        for r in range(rank, stop):
            used[first + (r - rank) // per].append((offset + (r - rank) % per * length, length))
    for spans in used.values():
        at = 0
        for o, k in sorted(spans):
            assert o == at
            at += k
        assert at <= 64
    bins = []
    opened = 0
    for k in sorted(lengths, reverse=True):
        i = bisect.bisect_left(bins, k)
        left = bins.pop(i) - k if i < len(bins) else 64 - k
        opened += i >= len(bins) + (left != 64 - k)
        bisect.insort(bins, left)
    assert len(used) == len(bins)


def test_op2(spark, given):
    found = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in QUERIES["op2_substring_dedup"](spark, SF).collect()}
    words = {d: WORDS.findall(t or "") for d, t in sorted(given.items())}
    first = {}
    for d, w in words.items():
        for i in range(len(w) - 12):
            first.setdefault(tuple(w[i : i + 13]), d)
    for d, w in words.items():
        keep = [True] * len(w)
        for i in range(len(w) - 12):
            if first[tuple(w[i : i + 13])] < d:
                keep[i : i + 13] = [False] * 13
        kept = " ".join(x for x, k in zip(w, keep, strict=True) if k)
        assert found[d] == (len(w), len(w) - sum(keep), hashlib.sha256(kept.encode()).hexdigest())


def test_op5(spark, given):
    found = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in QUERIES["op5_near_duplicates"](spark, SF).collect()}
    sets = {}
    for d, t in given.items():
        w = WORDS.findall((t or "").translate(LOWER))
        sets[d] = {tuple(w[i : i + 3]) for i in range(len(w) - 2)} if len(w) >= 3 else ({tuple(w)} if w else set())
    parent = {d: d for d in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in sets:
        for b in sets:
            if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b]):
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    assert found == {d: (len(s), root(d), root(d) == d) for d, s in sets.items()}


def test_near_copies_around_an_original_all_meet(spark):
    """Copies of one text that are too far from each other, but near it, and a chain."""
    rng = np.random.default_rng(2)
    base = [f"w{i}" for i in range(120)]

    def edited(k):
        out = list(base)
        for i in rng.choice(120, k, replace=False):
            out[i] = f"e{rng.integers(10**9)}"
        return " ".join(out)

    rows = [(i, edited(2)) for i in range(60)] + [(100, " ".join(base))] + [(200 + i, edited(30)) for i in range(20)]
    found = near_duplicates.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 3, 85).collect()
    assert {r.component_id for r in found if r.doc_id <= 100} == {0}
    assert all(r.kept for r in found if r.doc_id >= 200)


def test_op6_base_is_exact_and_model_helps(spark, given):
    import math
    from collections import Counter

    found = {r.doc_id: r for r in QUERIES["op6_language_model"](spark, SF).collect()}
    tokens = {d: [*WORDS.findall((t or "").translate(LOWER)), None] for d, t in given.items()}
    c = Counter(x for d, w in tokens.items() if zlib.crc32(str(d).encode()) % 5 != 1 for x in w)
    n, v = sum(c.values()), len(c)
    for d, w in tokens.items():
        r = found[d]
        base = sum(math.log10((c[x] + 0.5) / (n + 0.5 * (v + 1))) for x in w)
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(w), sum(c[x] > 0 for x in w), n)
        assert r.base_score == pytest.approx(base)
    held = [r for r in found.values() if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_op7(spark, given):
    found = {r.doc_id: r for r in QUERIES["op7_phrase_fingerprints"](spark, SF).collect()}
    rows = sorted(given.items())
    for i, (d, t) in enumerate(rows):
        following, half = rows[(i + 1) % len(rows)][1], len(t) // 2
        edit = t[: len(t) - half] + following[:half]
        own, other, after = (phrase_fingerprints.fingerprints_of(x.encode())[0] for x in (t, edit, following))
        r = found[d]
        assert (r.n_chars, r.edited_sha256, r.fingerprint, r.edited_fingerprint) == (len(t), hashlib.sha256(edit.encode()).hexdigest(), own.tobytes().hex(), other.tobytes().hex())
        assert (r.near_edited, r.near_next) == (phrase_fingerprints.likeness(own, other), phrase_fingerprints.likeness(own, after))


def test_phrases_are_those_of_the_plain_parse():
    text, seen, cur = b"abababacabacabbbbabc" * 5, [], b""
    for i in range(len(text)):
        cur += text[i : i + 1]
        if cur not in seen:
            seen.append(cur)
            cur = b""
    ends, _ = phrase_fingerprints.phrase_ends(text, {})
    assert [text[a:b] for a, b in zip([0, *ends[:-1]], ends, strict=True)] == seen


def test_forward_backward():
    rng = np.random.default_rng(1)
    count, k = np.array([0, 5, 200, 64, 1]), 3
    scores, move = rng.normal(size=(count.sum(), k)), rng.normal(size=(k, k))
    found, at = language_field.posteriors(scores, count, move), 0
    for c in count:
        e, forward, state = np.exp(scores[at : at + c]), [], np.ones(k)
        for t in range(c):
            state = (state @ np.exp(move)) * e[t]
            state /= state.sum()
            forward.append(state)
        back = np.ones(k)
        for t in range(c - 1, -1, -1):
            both = forward[t] * back
            assert np.allclose(found[at + t], both / both.sum())
            back = np.exp(move) @ (e[t] * back)
            back /= back.sum()
        at += c


def test_op8_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    held = [r for r in QUERIES["op8_language_field"](spark, sf).collect() if r.held_out]
    assert sum(truth[r.doc_id] == r.lang_pred for r in held) >= 0.98 * len(held)


def test_op10_held_out_and_hidden_words(spark):
    sf = "/root/testdata/sf0.1"
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    held = [r for r in QUERIES["op10_toxicity"](spark, sf).collect() if r.held_out and r.doc_id in labels]
    caught = [r.predicted for r in held if labels[r.doc_id]]
    clean = [r.predicted for r in held if not labels[r.doc_id]]
    assert sum(caught) >= 0.8 * len(caught) and sum(clean) <= 0.03 * len(clean)
    model = toxicity.character_model(toxicity.character_counts(spark.read.parquet(f"{sf}/documents.parquet")))
    for hidden, word in (("l0ser", "loser"), ("1d10t", "idiot"), ("s t u p i d", "stupid"), ("mooooron", "moron"), ("tr@sh", "trash"), ("i-d-i-o-t", "idiot")):
        assert toxicity.decode(hidden, model) == word


def test_op3_variants(spark):
    item = spark.createDataFrame([(1, "Then Anna bought 12 apples for 3 dollars and gave 12 of them to Bob yesterday evening.")], "item_id long, text string")
    docs = spark.createDataFrame([(1, "x y z. Then Mary bought 7 apples for 9 dollars and gave 7 of them to Tom yesterday evening. foo"), (2, "Then Mary bought 7 apples for 9 dollars and gave 8 of them to Tom yesterday evening."), (3, "Then Anna bought 12 apples for 3 dollars and gave 12 of them to Bob yesterday evening.")], "doc_id long, text string")
    assert {r.doc_id: r.reparameterised for r in decontamination.contaminated(docs, item).collect()} == {1: True, 3: False}


def test_op3_finds_all_exact_copies(spark, given):
    items = {r.item_id: r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()}
    found = {(r.doc_id, r.item_id) for r in QUERIES["op3_template_decontamination"](spark, SF).collect()}
    assert {(d, i) for d, t in given.items() for i, x in items.items() if x in (t or "") and len(x.split()) >= 11} <= found


def test_op3_short_runs_at_all_offsets(spark):
    item = "seven tall trees stand near old grey stone walls behind many quiet green hills under very pale morning skies today"
    words = item.split()
    items = [(n, " ".join(words[:n])) for n in (8, 9, 10, 20)]
    docs = [(100 * k + n, " ".join([f"before{i}" for i in range(k)] + words[:n] + ["after"] * 30)) for k in range(4) for n in (8, 9, 10)]
    found = {(r.doc_id, r.item_id, r.matched_words) for r in decontamination.contaminated(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()}
    assert found == {(100 * k + n, m, min(n, m)) for k in range(4) for n in (8, 9, 10) for m in (8, 9, 10, 20) if min(n, m) >= m / 2}


def test_op3_item_and_variants_in_one_document(spark):
    text = "Then {0} bought {1} apples for {2} dollars and gave {1} of them to {3} yesterday{4} evening in the garden."
    a, b, c, d = text.format("Anna", 12, 3, "Bob", ""), text.format("Mary", 7, 9, "Tom", ""), text.format("Eve", 5, 8, "Max", ""), text.format("Eve", 5, 8, "Max", " again in the late")
    bad = "Then Mary bought 7 apples for 9 dollars and gave 8 of them to Tom yesterday evening in the garden."
    docs = [(1, f"{a} Some words. {b} {c}"), (2, f"{b} {c}"), (3, f"{b} {b}"), (4, f"{bad} and {bad}"), (5, f"{bad} and {d} {d} {b}"), (6, f"{d} {text.format('Mary', 7, 9, 'Tom', ' again in the late')}")]
    rows = decontamination.contaminated(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame([(1, a)], "item_id long, text string")).collect()
    assert {r.doc_id: r.reparameterised for r in rows} == {1: False, 2: True, 3: True, 5: True, 6: True} and len(rows) == 5


def test_op3_names_at_sentence_starts(spark):
    text = "{0} has {2} apples. {0} gives {3} to {1}. {1} eats one of them. {0} sells the rest at noon! {1} asks how many are left? {0} says nothing."
    item = text.format("Anna", "Bob", 12, 3)
    docs = [(1, text.format("Mary", "Tom", 9, 4)), (2, f"He said: {text.format('Mary', 'Tom', 9, 4)}"), (3, item), (4, item.lower()), (5, text.format("Mary", "Tom", 9, 4).replace("Mary says", "Eve says").replace("Tom asks", "Max asks").replace("Mary sells", "Sue sells").replace("Tom eats", "Jim eats"))]
    rows = decontamination.contaminated(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame([(1, item)], "item_id long, text string")).collect()
    assert {r.doc_id: r.reparameterised for r in rows} == {1: True, 2: True, 3: False, 4: False}
    plain = "The tall trees stand near old grey stone walls. Behind many quiet green hills a pale morning sky is seen."
    rows = decontamination.contaminated(spark.createDataFrame([(1, plain.lower()), (2, plain)], "doc_id long, text string"), spark.createDataFrame([(1, plain)], "item_id long, text string")).collect()
    assert {(r.doc_id, r.matched_words, r.reparameterised) for r in rows} == {(1, 20, False), (2, 20, False)}


def test_op4(spark, given):
    rows = QUERIES["op4_kd_shards"](spark, "/root/testdata/sf0.1").collect()
    size = defaultdict(int)
    for r in rows:
        size[r.shard] += r.size
    mean = sum(size.values()) / 24
    assert set(size) == set(range(24)) and max(size.values()) < 1.1 * mean and min(size.values()) > 0.9 * mean


def test_pipeline(spark, given):
    import corpus_pipeline

    docs, kept = spark.read.parquet(f"{SF}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF).cache()
        assert docs.columns == corpus_pipeline.COLUMNS
        kept.append((name, docs.count()))
    assert 0 < kept[-1][1] <= kept[0][1] <= len(given)
    out = corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()
    assert {r.doc_id for r in out} == {r.doc_id for r in docs.collect()}


def test_op6_filter_as_a_table_gives_the_same_scores(spark, given):
    docs = spark.createDataFrame([(d, t) for d, t in sorted(given.items())[:60]] + [(900, None), (901, "zzz qqq zzz")], "doc_id long, text string")
    train = docs.where("doc_id % 3 <> 1")
    held = language_model.fit(train)
    large = language_model.fit(train, head_words=0, filter_bytes=0)  # no head, no broadcast
    assert held.bits is not None and large.bits is None and len(large.head.keys) == 0
    one = {r.doc_id: r for r in language_model.score(docs, held).collect()}
    two = {r.doc_id: r for r in language_model.score(docs, large).collect()}
    assert set(one) == set(two) == {r.doc_id for r in docs.collect()}
    for d, r in one.items():
        assert (r.n_tokens, r.n_known, r.train_tokens) == (two[d].n_tokens, two[d].n_known, two[d].train_tokens)
        assert r.base_score == pytest.approx(two[d].base_score) and r.score == pytest.approx(two[d].score)


def test_op6_scores_equal_plain_counts_and_sum_to_one(spark, given):
    """Against a plain model with counts in dictionaries; a false positive of the filter may change single words."""
    import math
    from collections import Counter

    texts = dict(sorted(given.items())[:80])
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    model = language_model.fit(docs.where("doc_id % 4 <> 0"))
    tokens = {d: [None, *WORDS.findall((t or "").translate(LOWER)), None] for d, t in texts.items()}
    words, pairs = Counter(), Counter()
    for d, w in tokens.items():
        if d % 4:
            words.update(w[1:])
            pairs.update(zip(w, w[1:], strict=False))
    value = lambda n: language_model.VALUES[language_model.level_of(np.array([n]))[0]]
    q, v = sum(value(n) for n in words.values()), len(words)
    single = lambda w: (value(words[w]) + 0.5) / (q + 0.5 * (v + 1))
    t = lambda h: max(1.0, value(words[h]) ** 0.75)
    p = lambda h, w: (value(pairs[h, w]) + t(h) * single(w)) / (words[h] + t(h))
    for h in [w for w, _ in words.most_common(10)]:
        assert sum(p(h, w) for w in words) + p(h, "not a word") == pytest.approx(1, abs=0.015)
    found = {r.doc_id: r.score for r in language_model.score(docs, model).collect()}
    near = 0
    for d, w in tokens.items():
        want = sum(math.log10(p(a, b)) for a, b in zip(w, w[1:], strict=False))
        assert found[d] == pytest.approx(want, abs=0.02 * len(w))
        near += found[d] == pytest.approx(want)
    assert near >= 0.5 * len(tokens)  # no false positive at all in these


def test_op4_groups_stay_whole_and_sizes_are_near(spark):
    for sf in ("sf0.001", "sf0.01"):
        docs = {r.doc_id: r.text for r in spark.read.parquet(f"/root/testdata/{sf}/documents.parquet").collect()}
        rows = QUERIES["op4_kd_shards"](spark, f"/root/testdata/{sf}").collect()
        assert sorted(r.doc_id for r in rows) == sorted(docs)
        shards, size = defaultdict(set), defaultdict(int)
        for r in rows:
            raw = (docs[r.doc_id] or "").encode()
            assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(raw) + 8, zlib.crc32(raw), "bytes", None)
            shards[docs[r.doc_id] or ""].add(r.shard)
            size[r.shard] += r.size
        assert all(len(s) == 1 for s in shards.values())
        for s in range(24):
            assert sorted(r.slot for r in rows if r.shard == s) == list(range(sum(r.shard == s for r in rows)))
        mean, group = sum(size.values()) / 24, max(len((t or "").encode()) for t in docs.values())
        assert max(size.values()) <= max(1.1 * mean, mean + group)


def test_op4_only_a_group_larger_than_a_shard_is_divided(spark):
    rows = [(i, "the same text again " * 5, "en", "web") for i in range(3000)] + [(5000 + i, f"text {i} " * (1 + i % 30), "en", f"s{i % 5}") for i in range(3000)]
    found = sharding.shard(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string"), 8).collect()
    size, split = defaultdict(int), {r.shard for r in found if r.doc_id < 3000}
    for r in found:
        size[r.shard] += r.size
    mean = sum(size.values()) / 8
    assert len(split) == -(-3000 * 108 // int(mean)) and max(size.values()) < 1.06 * mean and min(size.values()) > 0.94 * mean


def test_op2_repeats_are_maximal(spark):
    shared = " ".join(f"s{i}" for i in range(40))
    docs = [(1, f"a b c {shared} d"), (2, f"x {shared} y z"), (3, f"{shared} {shared}")]
    found = {r.doc_id: r for r in substring_dedup.remove_repeats(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert found[1].repeats == [] and [tuple(x) for x in found[2].repeats] == [(1, 40, 1, 3)]
    assert [tuple(x) for x in found[3].repeats] == [(0, 40, 1, 3), (40, 40, 1, 3)] and found[3].kept_text == ""
    # Rows of one doc_id with different texts keep to their own places.
    docs = [(1, shared), (2, f"q {shared}"), (2, f"{shared} r r")]
    assert sorted(r.kept_text for r in substring_dedup.remove_repeats(spark.createDataFrame(docs, "doc_id long, text string")).collect() if r.doc_id == 2) == ["q", "r r"]


def test_op3_short_items_and_placeholders_match_by_their_values(spark):
    items = spark.createDataFrame([(1, "What is the capital city of France?"), (2, "10 20 30 40 50 60 70 80 90"), (3, "Yes.")], "item_id long, text string")
    docs = spark.createDataFrame([(1, "Tell me: what is the capital city of France? Now."), (2, "what is the capital city of Spain"), (3, "x 10 20 30 40 50 60 70 80 90 y"), (4, "x 11 21 31 41 51 61 71 81 91 y"), (5, "what is the capital")], "doc_id long, text string")
    assert {(r.doc_id, r.item_id, r.reparameterised) for r in decontamination.contaminated(docs, items).collect()} == {(1, 1, False), (3, 2, False)}


def test_op3_copies_of_any_length_at_every_place(spark):
    sizes, letters = (3, 7, 8, 9, 13, 20), "abcdefghijklmnopqrstuvwxyz"
    words = {n: [f"{letters[n]}w{letters[i]}" for i in range(n)] for n in sizes}
    docs = [(100 * n + k, " ".join(["before"] * k + words[n] + ["after"] * 9)) for n in sizes for k in range(9)]
    docs += [(100 * n + 50, " ".join(words[n][1:])) for n in sizes] + [(9000, "before after " * 20)]
    items = spark.createDataFrame([(n, " ".join(w)) for n, w in words.items()], "item_id long, text string")
    found = {(r.doc_id, r.item_id): r.matched_words for r in decontamination.contaminated(spark.createDataFrame(docs, "doc_id long, text string"), items).collect()}
    assert {k for k, m in found.items() if m == k[1]} == {(100 * n + k, n) for n in sizes for k in range(9)}
    assert {k for k, m in found.items() if m != k[1]} == {(100 * n + 50, n) for n in sizes if n > 8}


def test_op10_long_runs_spaces_and_other_alphabets(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    plain = spark.createDataFrame([(i, "you are a stupid person and a stupid fool") for i in range(30)] + [(100 + i, "the garden is green and the person walks there") for i in range(300)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1) for i in range(30)] + [(100 + i, 0) for i in range(300)], "doc_id long, toxic int")
    model = toxicity.fit(docs.select(F.col("doc_id") + 1000, "text").unionByName(plain.withColumnRenamed("doc_id", "(doc_id + 1000)")).toDF("doc_id", "text").unionByName(plain), labels)
    spaced = " ".join("you are quite a stupid person to say so about the garden".replace(" ", ""))
    hidden = {1: "stupid", 2: spaced, 3: "st upid", 4: "stu pid, yes", 5: "ѕtuріd", 6: "ｓｔｕｐｉｄ", 7: "s" + "t" * 60 + "upid", 8: ".".join("stupid" * 12)}
    clean = {20: "the garden is green", 21: "", 22: None, 23: "x" * 5000}
    rows = spark.createDataFrame([*hidden.items(), *clean.items()], "doc_id long, text string")
    score = {r.doc_id: r.score for r in toxicity.toxicity(rows, model).collect()}
    assert all(score[d] > score[21] for d in hidden), score
    assert all(score[d] <= score[21] + 1e-9 for d in clean), score


STAGE_ROWS = [*AWKWARD, (None, None, None, None), (20, "We are the only ones who write this here, and nobody else does it", "en", "a"), (None, "We are the only ones who write this here, and nobody else does it", "en", "b")]


def stage_rows(spark):
    docs = spark.createDataFrame(STAGE_ROWS, "doc_id long, text string, lang string, source string").withColumn("n_chars", F.length("text").cast("long"))
    return docs.select("*", *[F.lit("x").alias(c) for c in [*CLASHING, "row_id", "kept_text", "item_id"]])


def test_stages_on_awkward_rows(spark):
    import corpus_pipeline

    docs, stages = stage_rows(spark).cache(), dict(corpus_pipeline.STAGES)
    kept = {}
    for name in ("toxicity", "near_dedup", "substring_dedup", "decontamination"):
        out = stages[name](spark, docs, SF)
        assert out.columns == corpus_pipeline.COLUMNS
        kept[name] = [(r.doc_id, r.text) for r in out.collect()]
    everything = [(r[0], r[1]) for r in STAGE_ROWS]
    assert len(kept["toxicity"]) == len(everything) == len(kept["decontamination"])
    # Rows 1, 1 and 7 are one text, 4 and 9 are, and 20 and a row without an id: of each the smallest id stays.
    near = sorted(kept["near_dedup"], key=repr)
    assert sorted((d, t) for d, t in near if t and t.startswith("One two")) == [(1, AWKWARD[0][1])]
    assert [d for d, t in near if t == LONG] == [4] and [d for d, t in near if t and t.startswith("We are")] == [20]
    assert sum(t is None for _, t in near) == 2 and (3, "") in near and (5, " \n\t ") in near
    assert [d for d, t in kept["substring_dedup"] if t == LONG] == [4]
    assert stages["packing"](spark, docs, SF).count() >= len(everything)


def test_stages_on_an_empty_table(spark):
    import corpus_pipeline

    docs = stage_rows(spark).limit(0)
    assert all(stage(spark, docs, SF).count() == 0 for _, stage in corpus_pipeline.STAGES)


def test_op1_query_against_the_tokenizer(spark, given):
    """Pieces, their ids and places of the whole query, and no more sequences than one by one best fit makes."""
    plain, pieces, bins = Tokenizer.from_file(byte_path()), {}, []
    for d, t in given.items():
        ids = [*plain.encode(t or "", add_special_tokens=False).ids, 2]
        first = len(ids) - (len(ids) - 1) // 1024 * 1024
        cuts = [0, *range(first, len(ids) + 1, 1024)]
        for i, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
            pieces[d, i] = (a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes()))
    rows = QUERIES["op1_best_fit_packing"](spark, SF).collect()
    assert {(r.doc_id, r.piece): (r.start, r.length, r.ids_crc32) for r in rows} == pieces and len(rows) == len(pieces)
    places = defaultdict(list)
    for r in rows:
        places[r.sequence_id].append((r.offset, r.length))
    for spans in places.values():
        spans.sort()
        assert [o for o, _ in spans] == [sum(n for _, n in spans[:i]) for i in range(len(spans))] and sum(n for _, n in spans) <= 1024
    for n in sorted((x[1] for x in pieces.values()), reverse=True):
        i = bisect.bisect_left(bins, n)
        left = bins.pop(i) - n if i < len(bins) else 1024 - n
        bisect.insort(bins, left)
    assert len(places) == len(bins)


def test_op9_query_against_the_tokenizer(spark, given):
    plain, start = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json")), 0
    found = {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in QUERIES["op9_token_files"](spark, SF).collect()}
    for d, t in sorted(given.items()):
        ids = np.array([*plain.encode(t or "", add_special_tokens=False).ids, 1], "<u4")
        assert found[d] == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)


@pytest.mark.parametrize("encoding", ["dictionary", "delta"])
def test_token_files_are_encoded_as_asked_and_read_selectively(spark, given, tmp_path, encoding):
    import pyarrow.parquet as pq

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    token_files.write_token_files(docs, str(tmp_path / "t"), byte_path(), "space", 2, encoding)
    meta = pq.read_metadata(next((tmp_path / "t" / "ids").glob("*.parquet"))).row_group(0)
    used = {meta.column(i).path_in_schema.split(".")[0]: meta.column(i).encodings for i in range(meta.num_columns)}["ids"]
    assert ("RLE_DICTIONARY" in used or "PLAIN_DICTIONARY" in used) if encoding == "dictionary" else "DELTA_BINARY_PACKED" in used
    one = token_files.read_token_files(spark, str(tmp_path / "t"), "ids").where("doc_id = 7").collect()
    assert one[0].ids == [*Tokenizer.from_file(byte_path()).encode(given[7], add_special_tokens=False).ids, 2]


def test_op7_fingerprints_from_plain_sets(spark, given):
    """Minima over the set of phrases of a plain parse, byte by byte, without the operator's own parse."""
    from storyloom.llm.text_arrays import span_hashes

    found = {r.doc_id: r.fingerprint for r in QUERIES["op7_phrase_fingerprints"](spark, SF).collect()}
    for d, t in sorted(given.items())[:25]:
        seen, at, text = set(), 0, (t or "").encode()[:3000]
        if len((t or "").encode()) > 3000:
            continue
        for i in range(1, len(text) + 1):
            if text[at:i] not in seen:
                seen.add(text[at:i])
                at = i
        x = [np.uint32(span_hashes(np.frombuffer(p, np.uint8), np.array([0]), np.array([len(p)]))[0] >> np.uint64(32)) for p in seen]
        minima = [min((int(v) * int(f) + int(e)) % 2**32 for v in x) if x else 0xFFFFFFFF for f, e in zip(phrase_fingerprints._FACTORS, phrase_fingerprints._TERMS, strict=True)]
        assert found[d] == np.array([(m ^ (m >> 16)) & 0xFFFF for m in minima], np.uint16).tobytes().hex()


def test_op8_learns_rare_languages_and_never_needs_more_than_the_sample(spark):
    rows = [(i, f"the house and the garden {i}", "en") for i in range(3000)] + [(5000 + i, f"qux zork blip vrang {i}", "zz") for i in range(5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language_field.fit_sample(docs, max_rows=100)
    found = {r.doc_id: r.lang_pred for r in language_field.identify(spark.createDataFrame([(1, "zork vrang blip"), (2, "the garden and the house")], "doc_id long, text string"), model).collect()}
    assert model.languages == ["en", "zz"] and found == {1: "zz", 2: "en"}
