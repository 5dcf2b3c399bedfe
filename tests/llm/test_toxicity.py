"""Toxicity: held-out accuracy on the test table, folding, exceptions, odd rows."""

import random
import zlib

import pytest

from tierflow.llm import toxicity as tox

SF = "/root/testdata/sf0.01"


def test_folding():
    assert tox.fold("1D10T") == "idiot"
    assert tox.fold("ѕсum") == "scum"
    assert tox.fold("ｉｄｉｏｔ") == "idiot"
    assert tox.fold("in 2014 and 10 of 5") == "in 2014 and 10 of 5"
    assert tox.fold(None) == ""


def test_held_out_accuracy(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    result = tox.digest(tox.score(docs, tox.train(docs, labels)))
    assert result.count() == docs.count()
    rows = result.join(labels, "doc_id").filter("held_out").collect()
    right = sum(r.predicted == r.toxic for r in rows)
    bad = [r.score for r in rows if r.toxic == 1]
    good = [r.score for r in rows if r.toxic == 0]
    auc = sum((b > g) + 0.5 * (b == g) for b in bad for g in good) / (len(bad) * len(good))
    assert right / len(rows) > 0.95
    assert auc > 0.85  # 33 toxic texts to learn from; the larger tables give 0.97 and 1.00
    for r in result.limit(50).collect():
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1)


def labelled(spark, n=600):
    rng = random.Random(4)
    say = lambda: " ".join("".join(rng.choice("abcdefg") for _ in range(4)) for _ in range(40))
    rows = []
    for i in range(n):
        if i % 4 == 0:
            rows.append((i, say() + " vermin " + say() + " vermin", 1))
        elif i % 8 == 1:
            rows.append((i, say() + " pest vermin control " + say(), 0))
        else:
            rows.append((i, say(), 0))
    return spark.createDataFrame([(a, b) for a, b, _ in rows], "doc_id long, text string"), spark.createDataFrame([(a, c, 0) for a, _, c in rows], "doc_id long, toxic int, text int")


def test_exception_phrase_and_signs(spark):
    docs, labels = labelled(spark)
    model = tox.train(docs, labels)
    assert ("<vermin", "control") in model.exceptions
    tests = [(1, "v3rm1n and vеrmin you abcd"), (2, "the pest vermin control came"), (3, None), (4, ""), (5, "fine words " * 50000), (5, "fine words " * 50000)]
    got = {r.doc_id: r.score for r in tox.score(spark.createDataFrame(tests, "doc_id long, text string"), model).collect()}
    assert got[1] >= tox.THRESHOLD
    assert got[2] == got[3] == got[4] == got[5] < 0.5


def plain_score(model, text):
    """One text's score, word by word."""
    folded = tox.fold(text)
    words = list(tox._WORD.finditer(folded))
    total = 0.0
    for i, m in enumerate(words):
        found = [w for t, w in model.weights.items() if (m[0] == t[:-1] if t.endswith("$") else m[0].startswith(t))]
        before, after = words[i - 1][0] if i else "", words[i + 1][0] if i + 1 < len(words) else ""
        if found and (before, m[0] + ">") not in model.exceptions and ("<" + m[0], after) not in model.exceptions:
            total += max(found)
    return model.score(100 * total / max(1, len(folded.split())) if total else 0.0)


def test_scores_like_plain_python(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    model = tox.train(docs, labels)
    assert model.weights
    rows = tox.score(docs, model, keep=["doc_id", "text"]).collect()
    assert len({r.score for r in rows}) > 5
    for r in rows:
        assert r.score == pytest.approx(plain_score(model, r.text), rel=1e-9)


def test_words_around_a_match_at_any_distance(spark):
    gap = " ," * 500
    model = tox.Model({"vermin$": 3.0}, frozenset({("pest", "vermin>"), ("<vermin", "control")}), 2.0, -3.0)
    found = list(model.matches(f"pest{gap} vermin x vermin{gap}control", model.matcher()))
    assert found == [(3.0, "pest", "vermin", "x"), (3.0, "x", "vermin", "control")]
    assert list(model.matches("vermin", model.matcher())) == [(3.0, "", "vermin", "")]


def test_one_text_of_a_family(spark):
    rng = random.Random(9)
    say = lambda n: [rng.choice(["red", "blue", "cat", "dog", "sun", "sky", "tree", "run"]) + str(rng.randrange(50)) for _ in range(n)]
    base, passage = say(200), say(60)
    near = [[*base] for _ in range(4)]
    for i, words in enumerate(near):
        words[40 * i + 10] = "other"
    rows = [(10 + i, 1, " ".join(w)) for i, w in enumerate(near)] + [(20, 0, " ".join(base)), (21, 0, " ".join(base))]
    rows += [(30 + i, 0, " ".join(say(150) + passage + say(150))) for i in range(5)] + [(40, 0, ""), (41, 0, None), (42, 0, "one")]
    kept = {r.id for r in tox.one_of_family(spark.createDataFrame(rows, "id long, toxic int, text string")).collect()}
    assert kept == {10, 20, *range(30, 35), 40, 41, 42}


def test_odd_labels_and_empty_tables(spark):
    docs, labels = labelled(spark, 40)
    odd = labels.unionByName(labels.selectExpr("doc_id", "1 - toxic AS toxic", "text")).unionByName(spark.createDataFrame([(None, 1, 0), (3, None, 0)], labels.schema))
    model = tox.train(docs, odd)
    assert model.weights == {}
    none = docs.limit(0)
    assert tox.score(none, tox.train(none, labels.limit(0))).count() == 0
    assert tox.score(docs, model).select("score").distinct().count() == 1


@pytest.mark.parametrize("rows", [100])
def test_sample_is_bounded(spark, rows):
    docs, labels = labelled(spark)
    model = tox.train(docs, labels, rows=rows)
    assert any(t.startswith("verm") for t in model.weights)
