"""Embedding links, counts and components against all pairs."""

import numpy as np
import pytest

from tierflow.llm import embedding_dedup as ed

DDL = "vec_id long, embedding array<float>, label int, n int, node string"


def brute(rows):
    ok = [e is not None and lab is not None and len(e) > 0 and all(x is not None and np.isfinite(x) for x in e) and any(x != 0 for x in e) for _, e, lab in rows]
    n = len(rows)
    v = [np.array(e, np.float32).astype(np.float64) if o else None for (_, e, _), o in zip(rows, ok, strict=True)]
    links, root = [0] * n, list(range(n))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(n):
        for j in range(i):
            if ok[i] and ok[j] and rows[i][2] == rows[j][2] and len(v[i]) == len(v[j]) and v[i] @ v[j] / (np.linalg.norm(v[i]) * np.linalg.norm(v[j])) >= 0.98:
                links[i] += 1
                links[j] += 1
                root[find(i)] = find(j)
    least = {}
    for i, (d, _, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(least.get(find(i), d), d)
    out = [(d, links[i], least.get(find(i)), d == least.get(find(i))) for i, (d, _, _) in enumerate(rows)]
    return sorted(out, key=str)


def corpus(seed, size=16):
    rng = np.random.default_rng(seed)
    rows, i = [], 0
    for label in range(3):
        for _ in range(25):
            base = rng.standard_normal(size)
            for _ in range(rng.integers(1, 7)):
                v = base + rng.standard_normal(size) * rng.choice([0, 0.02, 0.1, 0.14])
                rows.append((i, [float(x) for x in np.float32(v * rng.choice([1, 3]))], label))
                i += 1
    rows += [(1000 + k, rows[0][1], 0) for k in range(6)] + [(1010, rows[0][1], 1), (1011, rows[0][1], None)]
    rows += [(1020, None, 0), (1021, [], 0), (1022, [0.0] * size, 0), (1023, [float("nan")] * size, 0), (1024, [1.0, None, *[0.0] * (size - 2)], 0), (1025, [float("inf")] * size, 0)]
    rows += [(1030, [1.0, 2.0], 0), (1031, [2.0, 4.0], 0), (1032, [3.0], 0), (None, rows[3][1], 0), (5, rows[5][1], rows[5][2])]
    return rows


@pytest.mark.parametrize("seed,block", [(1, 2048), (2, 5)])
def test_like_all_pairs(spark, seed, block, monkeypatch):
    monkeypatch.setattr(ed, "BLOCK", block)
    rows = corpus(seed)
    df = spark.createDataFrame([(*r, 0, "x") for r in rows], DDL)
    got = sorted([tuple(r) for r in ed.near_duplicates(df).collect()], key=str)
    assert got == brute(rows)
    assert sum(r[1] for r in got) > 200


def test_least_count_is_calibrated():
    rng = np.random.default_rng(1)
    need, size = ed.least_count(), 64
    ways = ed.directions(size)[:, 1:]
    window = ed.WIDTH * 0.2 / np.sqrt(size)
    d = rng.standard_normal((20000, size))
    d *= 0.2 / np.linalg.norm(d, axis=1)[:, None]
    assert ((np.abs(d @ ways) <= window).sum(1) >= need).mean() > 0.9999
    far = rng.standard_normal((20000, size))
    far *= np.sqrt(2) / np.linalg.norm(far, axis=1)[:, None]
    assert ((np.abs(far @ ways) <= window).sum(1) >= need).mean() < 0.01


def test_empty_and_all_bad(spark):
    assert ed.near_duplicates(spark.createDataFrame([], DDL)).count() == 0
    rows = [(1, None, 1, 0, ""), (None, [0.0], 1, 0, "")]
    got = ed.near_duplicates(spark.createDataFrame(rows, DDL)).collect()
    assert sorted([tuple(r) for r in got], key=str) == [(1, 0, 1, True), (None, 0, None, True)]
