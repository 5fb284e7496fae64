"""Maximal repeats of operator 2 against plain comparison of all places."""

import random

import pytest

from storyloom.llm import substring_dedup


def plain_repeats(docs: dict[int, str], window: int):
    """Per document: maximal common stretches with first owners of its windows, on their diagonals, without those that lie within another; and words removed."""
    words = {d: t.split() for d, t in docs.items()}
    first = {}
    for d in sorted(words):
        for i in range(len(words[d]) - window + 1):
            first.setdefault(tuple(words[d][i : i + window]), (d, i))
    out = {}
    for d, w in words.items():
        spans = {}
        for i in range(len(w) - window + 1):
            s, j = first[tuple(w[i : i + window])]
            if s < d:
                v, lo, hi = words[s], i, i + window
                while lo and j - (i - lo) and w[lo - 1] == v[j - (i - lo) - 1]:
                    lo -= 1
                while hi < len(w) and j + hi - i < len(v) and w[hi] == v[j + hi - i]:
                    hi += 1
                spans[lo, hi] = min(spans.get((lo, hi), (s, j - i + lo)), (s, j - i + lo))
        kept = [(lo, hi - lo, *o) for (lo, hi), o in spans.items() if not any((a, b) != (lo, hi) and a <= lo and hi <= b for a, b in spans)]
        out[d] = sorted(kept), len({k for lo, n, *_ in kept for k in range(lo, lo + n)})
    return out


def found_repeats(spark, docs, window, seed_words):
    rows = substring_dedup.remove_repeats(spark.createDataFrame(list(docs.items()), "doc_id long, text string").repartition(3), window, seed_words).collect()
    return {r.doc_id: (sorted(map(tuple, r.repeats)), r.n_removed) for r in rows}


def test_owner_changes_inside_a_repeat(spark):
    s = [f"s{i}" for i in range(40)]
    docs = {1: " ".join(s[:20]), 2: " ".join(s), 3: " ".join(s), 4: f"x {' '.join(s[5:])} y"}
    found = found_repeats(spark, docs, 13, 8)
    assert found == plain_repeats(docs, 13)
    assert found[3] == ([(0, 40, 2, 0)], 40) and found[4] == ([(1, 35, 2, 5)], 35)


@pytest.mark.parametrize("seed", range(6))
def test_repeats_equal_plain_search(spark, seed):
    rng = random.Random(seed)
    window, seed_words = rng.choice([(4, 2), (5, 3), (13, 8)])
    base = [[rng.choice("abcdefgh" if seed < 3 else "ab") + str(rng.randrange(3)) for _ in range(60)] for _ in range(4)]
    docs = {}
    for d in rng.sample(range(100), 25):
        text = []
        for _ in range(rng.randrange(1, 4)):
            b = rng.choice(base)
            i, n = rng.randrange(50), rng.randrange(3, 60)
            text += b[i : i + n] + [f"u{rng.randrange(10_000)}"] * rng.randrange(2)
        docs[d] = " ".join(text)
    assert found_repeats(spark, docs, window, seed_words) == plain_repeats(docs, window)
