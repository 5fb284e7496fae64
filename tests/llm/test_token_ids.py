"""Ids from pieces against the tokenizers' own, in any order of texts."""

import random
import uuid

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from storyloom.llm import token_ids
from storyloom.llm.queries import QUERIES
from storyloom.llm.text_arrays import flat

PARTS = ["a", "the", "Garden", '"', "'s", "'t", "1", "23", " ", "  ", "\n", "\t", "é", "é", "ß", "日本", "—", "“", "'", "<|endoftext|>", "<|startoftext|>", "<|", "|>", "|", "<", "İ", "​", " ", "　", "ﬁ", "Don't", ".", ",", "!!", "≠", "́", "🙂", "x", "Z", "__", "\x00", "\x85", "\x1c", "-", "(", "мир", "ς", "Σ"]
VOCABULARIES = [("word_bpe_49k.json", "white"), ("byte_bpe_50k.json", "space")]


def random_texts(seed: int, n: int) -> list[str]:
    rng = random.Random(seed)
    return ["".join(rng.choices(PARTS, k=rng.choice([0, 1, 2, 3, 5, 9, 20]))) for _ in range(n)]


def own_ids(tokenizer: Tokenizer, texts: list[str]) -> list[list[int]]:
    return [x.ids for x in tokenizer.encode_batch(texts, add_special_tokens=False)]


def split_ids(encoder, texts: list[str]) -> list[list[int]]:
    ids, count = encoder.encode(*flat(pa.array(texts, pa.string())))
    return [x.tolist() for x in np.split(ids, np.cumsum(count)[:-1])]


@pytest.mark.parametrize("name, cut", VOCABULARIES)
def test_texts_next_to_each_other_do_not_run_together(name, cut):
    path = public_tokenizers.path(name)
    tokenizer, encoder = Tokenizer.from_file(path), token_ids.Encoder(path, cut)
    texts = ["The house and the garden", '"Yes," she said', "The end", "1 of 2", "", "end", ".", "x", "<|endoftext|>", "a"]
    assert split_ids(encoder, texts) == own_ids(tokenizer, texts)
    for seed in range(40):
        texts = random_texts(seed, 250)
        assert split_ids(encoder, texts) == own_ids(tokenizer, texts)


def test_op9_on_texts_that_end_in_letters_before_marks(spark, tmp_path):
    texts = [*random_texts(99, 60), "The house and the garden", '"Yes," she said', "The end", "12 then", None, "end"]
    folder = str(tmp_path / uuid.uuid4().hex)
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1).write.parquet(f"{folder}/documents.parquet")
    found = {r.doc_id: r for r in QUERIES["op9_token_files"](spark, folder).collect()}
    ids = own_ids(Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json")), [t or "" for t in texts])
    from zlib import crc32

    at = 0
    for i, x in enumerate(ids):
        whole = np.array([*x, 1], "<u4").tobytes()
        assert (found[i].start, found[i].n_tokens, found[i].ids_crc32) == (at, len(x) + 1, crc32(whole))
        at += len(x) + 1
