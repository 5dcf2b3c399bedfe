"""Ranked search against plain Python over all documents."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from tierflow.llm import lexical_search as ls
from tierflow.llm.common import Words

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
DDL = "doc_id long, text string, score int, item_id string"


def terms(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items, top=10):
    counts = [(d, Counter(terms(t))) for d, t in docs]
    some = [(d, c) for d, c in counts if c]
    documents, words = len(some), sum(c.total() for _, c in some)
    df = Counter(t for _, c in some for t in c)
    asked = {}
    for i, t in items:
        asked.setdefault(i, set()).update(terms(t))
    out = []
    for i, wanted in asked.items():
        scores = []
        for d, c in some:
            m = 10 + 90 * c.total() * documents // words
            score = sum(math.floor(1000 * math.log((2 * documents + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 8 * m)) for t in wanted if c[t])
            if score > 0:
                scores.append((-score, d is None, d or 0, d))
        out += [(i, k, s[3], -s[0]) for k, s in enumerate(sorted(scores)[:top], 1)]
    return sorted(out, key=str)


def corpus(seed, n=300):
    rng = random.Random(seed)
    vocab = ["".join(rng.choice("abcé1") for _ in range(rng.randint(1, 4))) for _ in range(120)]
    text = lambda most: " ".join(rng.choice(vocab[: rng.choice([5, 40, 120])]).upper() if rng.random() < 0.2 else rng.choice(vocab) for _ in range(rng.randint(0, most)))
    docs = [(i, text(60)) for i in range(n)]
    docs += [(n + i, docs[7][1]) for i in range(40)] + [(3, docs[3][1]), (None, docs[8][1]), (None, None), (n + 50, None), (n + 51, ""), (n + 52, "a b " * 5000), (n + 53, "x" * 5000), (-4, docs[7][1])]
    items = [(i, text(25)) for i in range(30)] + [(None, "a b c"), (31, ""), (32, None), (33, docs[7][1]), (33, "a 1"), (34, "x" * 5000), (35, "none_of these-words")]
    rng.shuffle(docs)
    return docs, items


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("small", [False, True])
def test_like_plain_python(spark, monkeypatch, seed, small):
    if small:  # many tiles, passes and blocks
        monkeypatch.setattr(ls, "TILE_ITEMS", 4)
        monkeypatch.setattr(ls, "PASS_TILES", 3)
    docs, items = corpus(seed)
    d = spark.createDataFrame([(*r, 1, "x") for r in docs], DDL).repartition(5)
    i = spark.createDataFrame([(*r, 2, 3) for r in items], "item_id int, text string, score int, doc_id int")
    assert sorted([tuple(r) for r in ls.search(d, i).collect()], key=str) == brute(docs, items)
    assert sorted([tuple(r) for r in ls.search(d, i, top=3).collect()], key=str) == brute(docs, items, 3)


def test_empty_tables(spark):
    docs, items = corpus(1, 20)
    d, none = spark.createDataFrame([(*r, 1, "x") for r in docs], DDL), spark.createDataFrame([], DDL)
    i = spark.createDataFrame(items, "item_id int, text string")
    assert ls.search(none, i).collect() == [] and ls.search(d, i.limit(0)).collect() == []


def test_products_are_exact_and_bounded(monkeypatch):
    rng = np.random.default_rng(5)
    for heaviest, depth in ((26_000, 4096), (26_000, 3), (1 << 30, 4096)):
        monkeypatch.setattr(ls, "DEPTH", depth)
        weights = rng.integers(0, heaviest, (7, 50)).astype(np.float64)
        doc, term = (x.ravel() for x in np.meshgrid(np.arange(20), np.arange(50)))
        impact = rng.integers(0, ls.IMPACT, len(doc))
        dense = np.zeros((50, 20), object)
        dense[term, doc] = impact
        want = [[sum(int(weights[i, t]) * int(dense[t, d]) for t in range(50)) for d in range(20)] for i in range(7)]
        assert ls.multiply(weights, doc, term, impact.astype(np.float64), 20, heaviest).tolist() == want


def test_terms_that_share_a_hash(monkeypatch):
    import tierflow.llm.common as common

    blind = lambda v, s, e: np.zeros(len(s), np.uint64)
    monkeypatch.setattr(ls, "span_hashes", blind)
    monkeypatch.setattr(common, "span_hashes", blind)
    w = Words(np.array([0, 11]), np.frombuffer(b"ab cd ef ab", np.uint8))
    word, term = ls.Vocabulary([b"ab", b"ef", b"zz"]).find(w)
    assert sorted(zip(word.tolist(), term.tolist(), strict=True)) == [(0, 0), (2, 1), (3, 0)]


def test_lengths_beyond_64_bits():
    n = np.array([10**7, 3])
    assert ls.damping(n, 10**12, 10**15).tolist() == [10 + 90 * 10**7 * 10**12 // 10**15, 10 + 270 * 10**12 // 10**15]
