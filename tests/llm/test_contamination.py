"""Decontamination against brute force over every window of every document."""

import random
import re

import pytest
from pyspark.sql import functions as F

from tierflow.llm.contamination import contamination, digest

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items):
    wins = set()
    for i, t in items:
        w = words(t)
        n = min(13, len(w))
        wins |= {(i, tuple(w[s : s + n])) for s in range(len(w) - n + 1) if n}
    out = []
    for d, t in docs:
        w = words(t)
        hit, found = set(), set()
        for i, k in wins:
            for s in range(len(w) - len(k) + 1):
                if tuple(w[s : s + len(k)]) == k:
                    hit |= set(range(s, s + len(k)))
                    found.add(i)
        out.append((d, len(w), len(hit), sorted(found, key=lambda x: (x is not None, x))))
    return sorted(out, key=str)


def case(seed):
    rng = random.Random(seed)
    vocab = ["the", "Of", "and", *["".join(rng.choice("abéZ9") for _ in range(rng.randint(1, 5))) for _ in range(60)]]
    say = lambda k: "".join(rng.choice(vocab) + rng.choice([" ", ", ", ".\n"]) for _ in range(k))
    items = [(i, say(rng.choice([0, 1, 2, 3, 5, 12, 13, 14, 40]))) for i in range(12)]
    items += [(50, items[8][1]), (50, items[8][1]), (51, None), (52, "the the the the"), (52, "and then")]
    docs = []
    for d in range(40):
        t = say(rng.randint(0, 80))
        for _, p in rng.sample(items, 2):
            if p and rng.random() < 0.6:
                w = p.split()
                a = rng.randint(0, 3)
                t += " " + " ".join(w[a : a + rng.randint(1, 45)]).upper().replace("É", "é") + "! " + say(3)
        docs.append((d, t))
    docs += [(100, None), (101, ""), (102, "... !"), (None, docs[0][1]), (3, docs[5][1]), (3, docs[3][1]), (103, "the " * 300)]
    return docs, items


@pytest.mark.parametrize("seed", [1, 2])
def test_like_brute_force(spark, seed):
    docs, items = case(seed)
    d = spark.createDataFrame([(*r, 0, "x") for r in docs], "doc_id long, text string, item_id int, words string")
    i = spark.createDataFrame([(*r, 1) for r in items], "item_id long, text string, doc_id long")
    got = contamination(d, i)
    assert sorted([(r.doc_id, r.n_words, r.n_hit, list(r["items"])) for r in got.collect()], key=str) == brute(docs, items)
    assert got.filter("n_hit > 0").count() > 10
    row = digest(got).filter("doc_id = 100").first()
    assert (row.n_words, row.n_items, row.contaminated) == (0, 0, False)
    assert row.items_sha256 == got.select(F.sha2(F.lit(""), 256)).first()[0]


def test_empty_tables(spark):
    none_d = spark.createDataFrame([], "doc_id long, text string")
    none_i = spark.createDataFrame([], "item_id long, text string")
    some_d = spark.createDataFrame([(1, "a b c")], "doc_id long, text string")
    assert contamination(none_d, none_i).count() == 0
    assert [(r.n_words, r.n_hit) for r in contamination(some_d, none_i).collect()] == [(3, 0)]
    assert contamination(none_d, spark.createDataFrame([(1, "a b")], "item_id long, text string")).count() == 0
