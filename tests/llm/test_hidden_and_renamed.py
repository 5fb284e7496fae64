"""Operator 10 on texts hidden in further ways, and operator 3 on renamed, respelled and capitalised copies."""

import itertools

import numpy as np
import pyarrow as pa
import pytest

from storyloom.llm import decontamination, toxicity

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def model(spark):
    return toxicity.fit(spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet"))


HIDDEN = ["st​upid", "st­upid", "stúpid", "stúpid", "s t u p i d", "ѕ t u р i d", "st up id", "s.t.ú.p.i.d", "s‍t⁠u﻿pid", "STÚPID", "5tup1d", "stuuupid"]


def test_hidden_words_are_read(spark, model):
    words = lambda t: {tuple(x) for x in toxicity.features(pa.RecordBatch.from_pydict({"text": [t]}), model.characters, {})[1].tolist()}
    (plain,) = words("stupid")
    for text in HIDDEN:
        assert any(w[0] == plain[0] for w in words(f"you are {text} , yes")), text


def test_clean_texts_keep_their_words(model):
    texts = ["más añós naïve über", "", None, "​", "́", "é", "a­"]
    rows, found = toxicity.features(pa.RecordBatch.from_pydict({"text": pa.array(texts, pa.string())}), model.characters, {})
    assert set(rows.tolist()) == {0, 5, 6} and (found[:, 0] != 0).all()
    assert (rows == 0).sum() == 8  # each of four words with and without its accents


def test_decoder_finds_the_likeliest_of_all_readings():
    rng = np.random.default_rng(4)
    model = toxicity.character_model(rng.integers(0, 50, (28, 28, 28)).astype(float))
    code = lambda c: 0 if c == " " else ord(c) - 96 if "a" <= c <= "z" else 27

    def score(text):
        total = 0.0
        for word in text.split(" "):
            a = b = 0
            for c in [*word, " "]:
                total, a, b = total + model[a, b, code(c)], b, code(c)
        return total

    for core in ("5t1l", "a a", "b1 1b", "4@4 $", "x11", "c.a.t", "00 7"):
        lattice = toxicity._lattice(core)
        ways = [("", False)]
        for readings, split in lattice:
            ways = [(w + gap + r, True) for w, begun in ways for gap in ([""] + ([" "] if split and begun else [])) for r in readings]
        best = max(score(w) for w, _ in ways)
        assert abs(score(toxicity.decode(core, model)) - best) < 1e-9, core


ITEM = "Yesterday morning Anna walked twelve km to the old market in town with Peter and bought 25 red apples for Mary before she went back home"
COPIES = {
    "same": ITEM,
    "capitals": ITEM.upper(),
    "two names": ITEM.replace("Anna", "Mary Ann").replace("Peter", "Jean Paul Marie"),
    "digits": ITEM.replace("twelve", "12").replace("25", "twenty five"),
    "other numbers": ITEM.replace("twelve", "31").replace("25", "seven hundred"),
    "lower": ITEM.lower(),
}


@pytest.mark.parametrize("kind", COPIES)
def test_item_is_found_whatever_stands_for_names_and_numbers(spark, kind):
    items = spark.createDataFrame([(1, ITEM)], "item_id long, text string")
    other = "A text about quite different things that nobody has asked for, told at some length and without end"
    docs = spark.createDataFrame([(1, f"{other}. {COPIES[kind]}. {other}"), (2, other), (3, " ".join(ITEM.split()[:6]))], "doc_id long, text string")
    assert [r.doc_id for r in decontamination.contaminated(docs, items).collect()] == [1]


def test_op3_equals_plain_search_on_both_sides(spark):
    """Copies of items are found, and documents without a run of eight words of any item have none."""
    from tests.llm.test_llm_operators import QUERIES

    found = {(r.doc_id, r.item_id) for r in QUERIES["op3_template_decontamination"](spark, SF).collect()}
    bare = lambda t: " ".join("".join(c for c in w if c.isalnum() or ord(c) > 127) for w in (t or "").lower().split())
    items = {r.item_id: bare(r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()}
    docs = {r.doc_id: bare(r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    whole = {(d, i) for d, t in docs.items() for i, x in items.items() if f" {x} " in f" {t} "}
    runs = {i: [" ".join(x.split()[k : k + 4]) for k in range(len(x.split()) - 3)] for i, x in items.items()}
    touched = {(d, i) for (d, t), (i, r) in itertools.product(docs.items(), runs.items()) if any(f" {x} " in f" {t} " for x in r)}
    assert whole <= found <= touched
