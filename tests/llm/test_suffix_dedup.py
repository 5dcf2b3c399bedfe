"""Suffix-array dedup against brute force over every window."""

import hashlib
import random

import numpy as np
import pytest

from tierflow.llm import suffix_dedup as sd
from tierflow.llm.suffix_dedup import suffix_array_dedup
from twins import twins

DDL = "doc_id long, text string, part int, kind string"


def brute(rows, span):
    """{(doc_id, text): (n_bytes, n_removed, n_spans, sha)} by a dictionary of all windows."""
    first = {}
    for doc, text in rows:
        if doc is None:
            continue
        data = (text or "").encode()
        for p in range(len(data) - span + 1):
            w = data[p : p + span]
            first[w] = min(first.get(w, doc), doc)
    out = []
    for doc, text in rows:
        data = (text or "").encode()
        gone = [False] * len(data)
        for p in range(len(data) - span + 1):
            if doc is not None and first[data[p : p + span]] < doc:
                gone[p : p + span] = [True] * span
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        kept = bytes(b for b, g in zip(data, gone, strict=True) if not g)
        out.append((doc, len(data), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def run(spark, rows, **kw):
    df = spark.createDataFrame([(d, t, 1, "x") for d, t in rows], DDL)
    return sorted([tuple(r) for r in suffix_array_dedup(df, **kw).collect()], key=str)


def corpus(seed, n=60):
    rng = random.Random(seed)
    vocab = ["".join(rng.choice("abcdeéß") for _ in range(rng.randint(1, 9))) for _ in range(200)]
    words = lambda k: " ".join(rng.choice(vocab) for _ in range(k))
    shared = [words(30) for _ in range(4)]
    rows = []
    for i in range(n):
        text = words(rng.randint(0, 120))
        for s in rng.sample(shared, rng.randint(0, 2)):
            a = rng.randint(0, len(s) // 2)
            cut = rng.randint(0, len(text))
            text = text[:cut] + s[a : a + rng.randint(20, 160)] + text[cut:]
        rows.append((i * 7 % n, text))
    rows += [(n + i, rows[rng.randrange(n)][1]) for i in range(10)]
    rows += [(n + 20, None), (n + 21, ""), (None, rows[0][1]), (n + 22, "a" * 500), (n + 23, "a" * 120 + "b" * 60), (5, rows[9][1]), (5, rows[9][1])]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed,span", [(1, 50), (2, 50), (3, 28)])
def test_like_brute_force(spark, seed, span):
    rows = corpus(seed)
    got = run(spark, rows, span=span)
    assert got == brute(rows, span)
    assert sum(r[2] for r in got) > 1000


def test_long_texts_in_slices(spark, monkeypatch):
    import tierflow.llm.suffix_dedup as s

    rows = [(d, t) for d, t in corpus(4)]
    rows += [(200, " ".join(t or "" for _, t in rows[:30])), (201, "xyz" * 40)]
    monkeypatch.setattr(s, "SLICE", 97)
    texts = run_local(rows, 50)
    assert texts == brute(rows, 50)


def run_local(rows, span):
    """The same tasks without Spark, where a patched slice length holds."""
    import numpy as np
    import pyarrow as pa

    import tierflow.llm.suffix_dedup as s

    def batch(more=None):
        cols = {"doc_id": pa.array([r[0] for r in rows], pa.int64()), "text": pa.array([(r[1] or "").encode() for r in rows], pa.binary())}
        return cols

    live = [i for i, r in enumerate(rows) if r[0] is not None and len((r[1] or "").encode()) >= span]
    cols = batch()
    first = pa.RecordBatch.from_arrays([c.take(pa.array(live)) for c in cols.values()], names=list(cols))
    sent = pa.Table.from_batches(list(s._send_units(3, span)([first]))).to_pylist()
    decided = []
    for part in range(3):
        mine = [r for r in sent if r["part"] == part]
        if mine:
            for b in s._decide_units(6)([pa.RecordBatch.from_pylist(mine, schema=s._ROWS)]):
                decided += b.to_pylist()
    hot = np.array([int(np.frombuffer(r["blob"], np.uint64)[0]) & 0xFFFFFFFF for r in decided if r["kind"] == s.HOT], np.int64)
    assert len(hot)

    def joined(kinds, extra=()):
        ranges = {}
        for r in [*[d for d in decided if d["kind"] in kinds], *extra]:
            ranges.setdefault(r["doc"], []).append(r["blob"])
        return ranges

    asked = joined({s.ASK})
    keep = [i for i in live if rows[i][0] in asked]
    b = pa.RecordBatch.from_arrays([cols["doc_id"].take(pa.array(keep)), cols["text"].take(pa.array(keep)), pa.array([asked[rows[i][0]] for i in keep], pa.list_(pa.binary()))], names=["a", "b", "c"])
    pieces = pa.Table.from_batches(list(s._send_bytes(3, span, hot)([b]))).to_pylist()
    found = []
    for part in range(3):
        mine = [r for r in pieces if r["part"] == part]
        if mine:
            for x in s._match_bytes(span)([pa.RecordBatch.from_pylist(mine, schema=s._ROWS)]):
                found += x.to_pylist()
    gone = joined({s.FULL}, found)
    last = pa.RecordBatch.from_arrays([cols["doc_id"], cols["text"], pa.array([gone.get(r[0]) for r in rows], pa.list_(pa.binary()))], names=["a", "b", "c"])
    out = pa.Table.from_batches(list(s._remove(span, frozenset())([last]))).to_pylist()
    return sorted([tuple(r.values()) for r in out], key=str)


def test_other_columns_and_cut_characters(spark):
    same = "é" * 60
    df = spark.createDataFrame([(1, same, 5, "a"), (2, "x" + same[:30] + "é" * 40 + "yz", 6, "b")], DDL)
    got = {r.doc_id: r for r in suffix_array_dedup(df, with_text=True, with_bytes=True, keep=("part", "kind")).collect()}
    assert (got[1].kept_text, got[1].rest.part, got[1].rest.kind) == (same, 5, "a")
    assert (got[2].kept_text, got[2].rest.kind) == ("xyz", "b")


def test_empty_table(spark):
    assert run(spark, []) == []


def test_very_short_span_is_refused(spark):
    with pytest.raises(ValueError):
        suffix_array_dedup(spark.createDataFrame([], DDL), span=10)


def test_texts_that_sums_cannot_tell_apart(spark):
    units = [t for n in (1024, 2048) for t in twins(n, "xy", "yx")]
    rows = [(i, f"{i} begins {t} ends {i}") for i, t in enumerate(units)]
    rows += [(10 + i, t + "!" * 60 + units[i ^ 1]) for i, t in enumerate(units)]
    assert run(spark, rows) == brute(rows, 50)


@pytest.mark.parametrize("seed", range(6))
def test_longest_previous_factors(seed):
    rng = np.random.default_rng(seed)
    texts = [bytes(rng.choice(list(b"ab" if seed % 2 else b"abcd\x00\xff"), rng.integers(0, 60)).astype(np.uint8)) for _ in range(30)]
    texts += [texts[3], b"a" * 50, b"a" * 50, texts[5] + texts[6]]
    span = 12 if seed < 3 else 28
    owner_of = rng.integers(0, 12, len(texts))
    buffer = np.frombuffer(b"".join(texts), np.uint8)
    offsets = np.cumsum([0, *map(len, texts)])
    starts, owner = (np.concatenate(x).astype(np.int64) for x in zip(*[(np.arange(a, b - span + 1), np.full(max(0, b - span + 1 - a), o)) for a, b, o in zip(offsets[:-1], offsets[1:], owner_of, strict=True)], strict=True))
    got = sd.longest_previous_factors(buffer, starts, owner, span)
    windows = [buffer[s : s + span].tobytes() for s in starts]
    for i, w in enumerate(windows):
        best = 0
        for j, v in enumerate(windows):
            if owner[j] < owner[i]:
                same = next((k for k in range(span) if w[k] != v[k]), span)
                best = max(best, same)
        assert got[i] == best
    assert sd.longest_previous_factors(buffer, starts[:0], owner[:0], span).tolist() == []


def test_long_runs_of_one_owner_end_soon():
    """Pointers jump, so a long way to the next smaller owner takes few rounds."""
    n = 200_000
    buffer = np.zeros(n + 50, np.uint8)
    owner = np.arange(n)[::-1] + 1
    owner[-1] = 0
    got = sd.longest_previous_factors(buffer, np.arange(n), owner, 50)
    assert got.tolist() == [50 * int(o > 0) for o in owner]
