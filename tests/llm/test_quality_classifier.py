"""Statistics, trees and scores against plain Python; held-out accuracy."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from tierflow.llm import quality_classifier as qc
from tierflow.llm.common import ragged

WORD = re.compile(rb"[0-9A-Za-z\x80-\xff]+")


def plain(text):
    """The statistics of one text."""
    raw = (text or "").encode()
    n = len(raw)
    share = lambda a, b: a / max(1, b)
    kinds = [sum(b in x for b in raw) for x in qc._KINDS.values()]
    kinds += [sum(b >= 0x80 for b in raw)]
    kinds += [n - sum(kinds)]
    out = [math.log1p(n), *(share(k, n) for k in kinds)]
    out.append(-sum(c / n * math.log2(c / n) for c in Counter(raw).values()))
    out.append(share(sum(a == b and b > 0x20 for a, b in zip(raw, raw[1:], strict=False)), n))
    words = WORD.findall(raw)
    low = [w.lower() for w in words]
    size = [len(w) for w in words]
    mean = share(sum(size), len(words))
    out += [mean, math.sqrt(max(0, share(sum(s * s for s in size), len(words)) - mean**2)), math.log1p(max(size, default=0))]
    upper = lambda w: all(0x41 <= b <= 0x5A for b in w)
    caps = [upper(w) and len(w) > 1 for w in words]
    out += [share(sum(caps), len(words)), share(sum(upper(w[:1]) and not c for w, c in zip(words, caps, strict=True)), len(words)), share(sum(all(0x30 <= b <= 0x39 for b in w) for w in words), len(words))]
    out += [share(sum(a <= s <= b for s in size), len(words)) for a, b in qc._LENGTHS]
    out.append(share(n - sum(size), len(words)))
    pairs = list(zip(low, low[1:], strict=False))
    out.append(share(sum(a == b for a, b in pairs), len(words)))
    out += [share(len(set(low)), len(words)), share(max(Counter(low).values(), default=0), len(words)), share(len(set(pairs)), len(pairs))]
    lines = [x for x in raw.split(b"\n") if x]
    out += [len(words) / (1 + kinds[list(qc._KINDS).index("stop")]), share(len(words), len(lines)), math.log1p(len(lines))]
    out += [share(sum(x[-1:] in (b".", b"!", b"?") for x in lines), len(lines)), 1 - len(set(lines)) / len(lines) if lines else 0]
    return out


def texts(seed, n=200):
    rng = random.Random(seed)
    signs = [*"abcABC  \n.!?,1290#$%|éß中\t\x01", "word ", "Word ", "WORD ", "word word ", "\n\n", "...", "a line.\n"]
    return ["".join(rng.choice(signs) for _ in range(rng.choice([0, 1, 5, 80]))) for _ in range(n)] + ["", "\n", " ", "x" * 5000, "word " * 3000]


def test_statistics():
    found = texts(1)
    got = qc.statistics(*ragged(pa.array([t.encode() for t in found], pa.binary())))
    assert got.shape == (len(found), len(qc.NAMES))
    np.testing.assert_allclose(got, [plain(t) for t in found], rtol=1e-9, atol=1e-7)
    assert qc.statistics(np.zeros(1, np.int64), np.zeros(0, np.uint8)).shape == (0, len(qc.NAMES))


def walk(trees, row):
    """One row down each tree, one step at a time."""
    total = trees.base
    for feature, threshold, leaf in zip(trees.feature, trees.threshold, trees.leaf, strict=True):
        at = 0
        while at < len(feature):
            at = 2 * at + (2 if row[feature[at]] > threshold[at] else 1)
        total += leaf[at - len(feature)]
    return 1 / (1 + math.exp(-total))


def test_trees():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(1500, 5))
    x[:, 3] = x[:, 3] > 0
    y = ((x[:, 0] * x[:, 1] > 0) ^ (x[:, 3] > 0.5)).astype(float)
    trees = qc.fit(x[:1000], y[:1000])
    got = trees.probability(x)
    np.testing.assert_allclose(got, [walk(trees, r) for r in x], rtol=1e-12)
    assert ((got > 0.5) == y)[1000:].mean() > 0.93


def test_a_split_is_the_best_of_all():
    """The first split of the first tree against a search over every feature and value."""
    rng = np.random.default_rng(4)
    x = rng.integers(0, 12, (300, 3)).astype(float)
    y = (rng.random(300) < 1 / (1 + np.exp(3 - x[:, 1]))).astype(float)
    trees = qc.fit(x, y, 1)
    g, h = y.mean() - y, np.full(300, y.mean() * (1 - y.mean()))
    gain = {}
    for f in range(3):
        for v in np.unique(x[:, f])[:-1]:
            left = x[:, f] <= v
            if min(h[left].sum(), h[~left].sum()) >= qc.LEAST:
                gain[f, v] = g[left].sum() ** 2 / (h[left].sum() + qc.PULL) + g[~left].sum() ** 2 / (h[~left].sum() + qc.PULL)
    assert (trees.feature[0, 0], trees.threshold[0, 0]) == max(gain, key=gain.get)


def test_one_label_or_none(spark):
    docs = spark.createDataFrame([(i, "some text", 5) for i in range(6)], "doc_id long, text string, score int")
    for labels, want in (([], 0.5), ([(i, 1) for i in range(6)], 0.99), ([(i, None) for i in range(6)], 0.5), ([(i, j) for i in range(6) for j in (0, 1)], 0.5)):
        trees = qc.train(docs, spark.createDataFrame(labels, "doc_id long, quality int"))
        assert {round(r.score, 9) for r in qc.score(docs, trees).collect()} == {want}


@pytest.fixture(scope="module")
def learned(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    return docs, labels, qc.train(docs, labels)


def test_held_out_rows(learned):
    docs, labels, trees = learned
    rows = qc.digest(qc.score(docs, trees)).join(labels, "doc_id").filter("quality is not null").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and r.predicted == int(r.score >= 0.3) for r in rows)
    held = [r for r in rows if r.held_out]
    assert len(held) > 50
    for label in (0, 1):
        same = [r.predicted == label for r in held if r.quality == label]
        assert sum(same) / len(same) >= 0.9


def test_held_out_labels_are_not_read(spark, learned):
    docs, labels, trees = learned
    other = labels.selectExpr("doc_id", "case when crc32(cast(doc_id as string)) % 5 = 0 then 1 - quality else quality end as quality")
    again = qc.train(docs, other)
    assert np.array_equal(again.threshold, trees.threshold) and np.array_equal(again.leaf, trees.leaf)


def test_scores_like_plain_python(spark, learned):
    trees = learned[2]
    rows = [(i, t) for i, t in enumerate(texts(2, 60))] + [(1000, None), (None, "no id"), (3, "twice"), (3, "twice")]
    docs = spark.createDataFrame([(d, t, 0.5, "x") for d, t in rows], "doc_id long, text string, score double, label string")
    got = qc.score(docs, trees, keep=["doc_id", "text"], name="p").collect()
    # statistics agree to rounding only: leave out rows that stand on a threshold
    for r in got:
        assert r.p == pytest.approx(walk(trees, qc.statistics(*ragged(pa.array([(r.text or "").encode()], pa.binary())))[0]), abs=1e-9)
    assert len(got) == len(rows)
    assert qc.score(docs.limit(0), trees).collect() == []
