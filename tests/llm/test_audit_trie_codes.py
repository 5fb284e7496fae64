"""Operators 11 to 13 against plain versions and on awkward rows."""

import itertools
import math
import random
import re
from collections import Counter, defaultdict
from hashlib import sha256

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from storyloom.llm import filter_audit, part_trie, prefix_trie
from storyloom.llm.queries import QUERIES
from storyloom.llm.text_arrays import flat
from tests.llm.test_token_ids import VOCABULARIES, random_texts, split_ids

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
LONG = " ".join(f"word{i % 977} é{i % 13}" for i in range(20_000))
DOCS = [(1, "a b c", "s"), (1, "a b c", "s"), (2, "a b c", "t"), (None, "a b c", "t"), (3, None, None), (4, "", ""), (5, LONG, "s"), (6, LONG, "s"), (7, "A B$ " * 40, "s"), (8, " \t\n\x0b\x0c\r ", "t"), (2, "a b c", "t"), (9, "É ÀB " * 30, None), (10, "x\x85y z" * 3, "s"), (None, None, None)]
LABELS = [(1, 1, 0), (2, 0, 1), (2, 1, None), (None, 1, 1), (5, None, 1), (99, 1, 1), (7, 1, 1)]


def plain_audit(docs, labels):
    def mask(text):
        words = WORDS.findall(text)
        return [len(words) < 50, 100 * len(set(words)) < 65 * len(words), 100 * len(re.findall("[A-Z]", text)) > 5 * len(text), bool(re.search(r"[#$%&*|]", text))]

    good, toxic = ({d for d, *x in labels if d is not None and x[i] == 1} for i in (0, 1))
    rows = [(d, t or "", s or "") for d, t, s in docs]
    out = {}
    for part in {s for *_, s in rows}:
        own = []
        for d, t, s in rows:
            if s == part:
                earlier = d is not None and any(t == u and e is not None and e < d for e, u, _ in rows)
                own.append((d, [*mask(t), earlier]))
        shapley = Counter()
        for order in itertools.permutations("ABCDE"):
            alive = list(own)
            for k, letter in enumerate(order):
                i = "ABCDE".index(letter)
                gone, left = [x for x in alive if x[1][i]], [x for x in alive if not x[1][i]]
                shapley[letter] += len(gone)
                out[part, "".join(order), k + 1] = [len(left), len(gone), sum(x[1][i] for x in own) - len(gone), sum(x[1][i] and sum(x[1]) == 1 for x in own), sum(d in good for d, _ in gone), sum(d in toxic for d, _ in gone), letter]
                alive = left
        for key, value in out.items():
            if key[0] == part:
                value[-1] = shapley["ABCDE".index(value[-1])] if isinstance(value[-1], int) else shapley[value[-1]]
    return out


@pytest.fixture(scope="module")
def tables(spark):
    docs = spark.createDataFrame(DOCS, "doc_id long, text string, source string").select("*", *[F.lit("x").alias(c) for c in ("part", "mask", "digest", "good", "n", "ids", "_key", "lang", "label")])
    return docs, spark.createDataFrame(LABELS, "doc_id long, quality int, toxic int").withColumn("part", F.lit(1))


def test_op11_equals_a_plain_audit(tables):
    found = {(r.part, r.filter_order, r.step): [r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley] for r in filter_audit.audit(*tables).collect()}
    assert found == plain_audit(DOCS, LABELS)
    assert len(found) == 600 * 3


def test_op11_of_an_empty_table_has_no_rows(tables):
    docs, labels = tables
    assert filter_audit.audit(docs.limit(0), labels).count() == 0
    assert filter_audit.audit(docs, labels.limit(0)).agg(F.sum("good_lost"), F.sum("toxic_lost")).first() == (0, 0)


@pytest.mark.parametrize("name, cut", VOCABULARIES)
def test_trie_gives_the_tokenizers_ids_and_texts(name, cut):
    path = public_tokenizers.path(name)
    tokenizer, encoder, decoder = Tokenizer.from_file(path), prefix_trie.TrieEncoder(path, cut), prefix_trie.Decoder(path)
    rng = random.Random(12)
    letters = "abcdefghijklmnopqrstuvwxyzéñ'0"
    words = ["".join(rng.choices(letters[: rng.choice([2, 3, 26, 30])], k=rng.randint(1, 40))) for _ in range(5000)]
    for texts in (words, [*(a * 3000 for a in ("a", "ab", "é")), LONG], *(random_texts(seed, 200) for seed in range(20))):
        found = split_ids(encoder, texts)
        whole = [x.ids for x in tokenizer.encode_batch(texts, add_special_tokens=False)]
        assert found == whole
        offsets = np.concatenate([[0], np.cumsum([len(x) for x in whole])])
        decoded = decoder.decode(np.array([i for x in whole for i in x], np.int32), offsets)
        assert [x.decode() for x in decoded] == [tokenizer.decode(x, skip_special_tokens=False) for x in whole]


def test_prefixes_of_words_share_nodes():
    path = public_tokenizers.path("word_bpe_49k.json")
    encoder = prefix_trie.TrieEncoder(path, "white")
    words = [f"prefix{'abc' * (i % 7)}" for i in range(300)] + ["preface", "prefer"]
    assert encoder.encoded(words) == [x.ids for x in encoder.tokenizer.encode_batch(words, add_special_tokens=False)]
    # One path of 6 + 18 letters, an end of each of the seven words, and what is not "pre" or "pref" of the two others; ends are nodes of their own.
    assert encoder.trie.nodes == 24 + 6 + len("ace") + len("er")


def test_op12_on_awkward_rows(spark, tables, tmp_path):
    docs, _ = tables
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))

    def row(d, text):
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids
        return d, len(ids), sha256(np.array(ids, "<u4").tobytes()).hexdigest(), sha256(tokenizer.decode(ids, skip_special_tokens=False).encode()).hexdigest()

    found = QUERIES["op12_prefix_trie_bpe"](spark, str(tmp_path)).collect()
    assert Counter(map(tuple, found)) == Counter(row(d, t) for d, t, _ in DOCS)
    path = public_tokenizers.path("word_bpe_49k.json")
    again = prefix_trie.decode_ids(prefix_trie.encode_documents(docs, path, "white"), path)
    assert Counter(tuple(r)[:3] for r in again.collect()) == Counter(row(d, t)[:3] for d, t, _ in DOCS)
    docs.limit(0).write.parquet(str(tmp_path / "none" / "documents.parquet"))
    assert QUERIES["op12_prefix_trie_bpe"](spark, str(tmp_path / "none")).count() == 0


def test_op12_query_against_the_tokenizer(spark):
    sf = "/root/testdata/sf0.001"
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    given = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    for r in QUERIES["op12_prefix_trie_bpe"](spark, sf).collect():
        ids = tokenizer.encode(given[r.doc_id], add_special_tokens=False).ids
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (len(ids), sha256(np.array(ids, "<u4").tobytes()).hexdigest(), sha256(tokenizer.decode(ids, skip_special_tokens=False).encode()).hexdigest())


def plain_codes(vectors, parts, entries, rounds):
    kept = [(i, l, [math.floor(1024 * x) for x in v]) for i, v, l in vectors if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    first = sorted(kept, key=lambda r: (r[0] is None, r[0] or 0, r[2]))[:entries]
    width = len(kept[0][2]) // parts
    piece = lambda v, p: v[p * width : (p + 1) * width]
    books = [[piece(v, p) for *_, v in first] for p in range(parts)]
    near = lambda x, book: min((sum((a - b) ** 2 for a, b in zip(x, e, strict=True)), k) for k, e in enumerate(book))
    for _ in range(rounds):
        for p in range(parts):
            of = defaultdict(list)
            for *_, v in kept:
                of[near(piece(v, p), books[p])[1]].append(piece(v, p))
            books[p] = [[sum(c) // len(of[k]) for c in zip(*of[k], strict=True)] if k in of else e for k, e in enumerate(books[p])]
    rows = [(i, l, [near(piece(v, p), books[p]) for p in range(parts)]) for i, l, v in kept]
    by_label = Counter()
    for _, l, n in rows:
        by_label[l] += sum(d for d, _ in n)
    digest = sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    return Counter((i, "".join(f"{k:02x}" for _, k in n), sum(d for d, _ in n), by_label[l]) for i, l, n in rows), digest


def vectors_like_the_tables(rng, n):
    rows = [(i, [float(np.float32(rng.choice([rng.gauss(0, 0.1), 0.25, -0.1]))) for _ in range(8)], rng.choice([None, 1, 2])) for i in range(n)]
    rows += [(n, None, 1), (n + 1, [1.0] * 7 + [None], 1), (n + 2, [math.nan] + [0.0] * 7, 2), (n + 3, [math.inf] + [0.0] * 7, None), (None, [0.5] * 8, None), (3, [-0.5] * 8, 1)]
    return rows + [rows[5]] * 40


@pytest.mark.parametrize("n, entries, rounds", [(150, 16, 4), (5, 256, 2), (150, 256, 0)])
def test_op13_equals_plain_rounds(spark, n, entries, rounds):
    rows = vectors_like_the_tables(random.Random(n), n)
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").select("*", *[F.lit("x").alias(c) for c in ("v", "part", "position", "weight", "code", "_label")])
    coded, books = part_trie.compress(table.repartition(3), parts=4, entries=entries, rounds=rounds)
    plain, digest = plain_codes(rows, 4, entries, rounds)
    assert Counter((r.vec_id, r.code, r.error, r.label_error) for r in coded.collect()) == plain
    assert part_trie.codebooks_sha256(books) == digest
    back = {r.vec_id: r.v for r in part_trie.decode(coded, books).collect()}
    own = {r.vec_id: r.v for r in part_trie.integer_vectors(table).collect()}
    errors = {r.vec_id: r.error for r in coded.collect()}
    assert all(sum((a - b) ** 2 for a, b in zip(back[i], own[i], strict=True)) == errors[i] for i in range(n) if i != 3)


def test_op13_of_empty_tables_and_vectors(spark):
    kind = "vec_id long, embedding array<float>, label int"
    assert part_trie.compress(spark.createDataFrame([], kind))[0].count() == 0
    assert part_trie.compress(spark.createDataFrame([(1, None, 1)], kind))[0].count() == 0
    assert [tuple(r) for r in part_trie.compress(spark.createDataFrame([(1, [], 1), (2, [], None)], kind))[0].orderBy("vec_id").collect()] == [(1, 1, "00000000", 0, 0), (2, None, "00000000", 0, 0)]
    for rows in ([(1, [1.0] * 8, 1), (2, [1.0] * 4, 1)], [(1, [1.0] * 6, 1)], [(1, [1e30] * 8, 1)]):
        with pytest.raises(ValueError):
            part_trie.compress(spark.createDataFrame(rows, kind))


def test_walk_shares_prefixes_across_blocks_and_ties_go_to_the_lower_entry():
    rng = np.random.default_rng(13)
    parts = np.unique(rng.integers(-3, 4, (3000, 5)), axis=0)
    book = rng.integers(-3, 4, (40, 5))
    entry, distance = part_trie.TrieWalk(book).nearest(parts)
    every = ((parts[:, None] - book[None]) ** 2).sum(2)
    assert (entry == every.argmin(1)).all() and (distance == every.min(1)).all()
