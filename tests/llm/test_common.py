"""Shared helpers: components against union-find, span hashes, packed arrays."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tierflow.llm import common
from twins import twins

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


@pytest.mark.parametrize("kind", ["path", "random", "star", "none"])
def test_components(spark, kind):
    rng = random.Random(1)
    n = 60
    ids = rng.sample(range(10_000), n)
    edges = {
        "path": list(zip(ids, ids[1:], strict=False)),
        "random": [(rng.choice(ids), rng.choice(ids)) for _ in range(40)],
        "star": [(ids[0], i) for i in ids[1:30]] + [(i, i) for i in ids],
        "none": [],
    }[kind]
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in edges:
        x, y = sorted((find(a), find(b)))
        root[y] = x
    nodes = spark.createDataFrame([(i,) for i in ids], "id long")
    got = common.components(nodes, spark.createDataFrame(edges, "a long, b long")).collect()
    assert {r.id: r.component for r in got} == {i: find(i) for i in ids}


def test_components_in_as_many_tasks_as_the_edges_need(spark, monkeypatch):
    parts, keep = [], common.staged
    monkeypatch.setattr(common, "staged", lambda df: parts.append(keep(df).rdd.getNumPartitions()) or keep(df))
    edges = [(i, i + 1) for i in range(100) if i % 10]
    few = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.enabled")}
    try:
        for k, v in (("spark.sql.shuffle.partitions", "16"), ("spark.sql.adaptive.enabled", "false")):
            spark.conf.set(k, v)
        for each, most in ((1000, 1), (25, 4)):
            monkeypatch.setattr(common, "EDGES", each)
            parts.clear()
            got = common.components(spark.range(101), spark.createDataFrame(edges, "a long, b long")).collect()
            assert {r.id: r.component for r in got} == {i: max(0, (i - 1) // 10 * 10 + 1) for i in range(101)}
            assert max(parts[1:]) <= most < 16  # the first are the edges as they came
    finally:
        for k, v in few.items():
            spark.conf.set(k, v)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="aZ9 é.,\n中", max_size=12), max_size=8))
def test_words_like_a_pattern(texts):
    offsets, raw = common.ragged(pa.array([t.encode() for t in texts], pa.binary()))
    w = common.Words(offsets, raw)
    for i, t in enumerate(texts):
        lower = re.sub("[A-Z]", lambda m: m[0].lower(), t)
        assert [x.decode() for x in w.text(w.first[i], w.first[i + 1])] == WORD.findall(lower)
    seen = {}
    for h, x in zip(w.hash.tolist(), w.text(0, len(w.start)), strict=True):
        assert seen.setdefault(x, h) == h
    assert len(set(seen.values())) == len(seen)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 2**63 - 1), max_size=20), st.lists(st.integers(0, 5), max_size=20))
def test_packed_arrays(values, counts):
    a = np.array(values, np.int64)
    assert common.unplanes(common.planes(a), np.int64, len(a)).tolist() == values
    starts = np.arange(len(counts)) * 100
    want = [s + k for s, n in zip(starts.tolist(), counts, strict=True) for k in range(n)]
    assert common.spread(starts, np.array(counts, np.int64)).tolist() == want


def test_bit_table(spark):
    hashes = [random.Random(3).randrange(-(2**63), 2**63) for _ in range(300)] + [-1, 0]
    table = common.bit_table(spark.createDataFrame([(h,) for h in hashes], "h long"), "h")
    assert len(table) == 2 << 20
    assert common.bit_hits(np.array(hashes, np.int64), table).tolist() == list(range(len(hashes)))
    others = np.random.default_rng(1).integers(-(2**62), 2**62, 100_000)
    assert len(common.bit_hits(others, table)) < 50


def test_packs_and_nulls():
    offsets, raw = common.ragged(pa.array([b"abc", None, b"", b"defg"], pa.binary()).slice(1))
    assert (offsets.tolist(), raw.tobytes()) == ([0, 0, 0, 4], b"defg")
    assert list(common.packs(np.array([0, 5, 5, 30, 31, 33]), 10)) == [(0, 2), (2, 3), (3, 5)]
    assert list(common.packs(np.array([0]), 10)) == []


@settings(max_examples=80, deadline=None)
@given(st.lists(st.text(alphabet="ab", max_size=24), max_size=30), st.sampled_from([np.uint8, np.uint16, np.uint32]), st.booleans(), st.integers(0, 9))
def test_distinct_spans(texts, dtype, blind, long):
    values = np.frombuffer("".join(texts).encode(), np.uint8).astype(dtype)
    ends = np.cumsum([0, *map(len, texts)])
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(common, "LONG_SPAN", long)
        if blind:  # every span under one hash
            patch.setattr(common, "span_hashes", lambda v, s, e: np.zeros(len(s), np.uint64))
        example, which = common.distinct_spans(values, ends[:-1], ends[1:])
    assert [texts[example[i]] for i in which.tolist()] == texts
    assert len(example) == len(set(texts))


@pytest.mark.parametrize("dtype", [np.uint8, np.uint16, np.uint32])
def test_loads_are_the_next_64_bits(dtype):
    rng = np.random.default_rng(4)
    values = rng.integers(0, np.iinfo(dtype).max, 50).astype(dtype)
    for some in (values, values[::2], values[:0]):
        x, masks, each = common.loads(some)
        width = 8 * some.itemsize
        padded = [*some.tolist(), *[0] * 2 * each]
        assert x.tolist() == [sum(v << (width * k) for k, v in enumerate(padded[i : i + each])) for i in range(len(some) + each)]
        assert masks.tolist() == [(1 << (width * k)) - 1 for k in range(each + 1)]


def test_spans_that_sums_cannot_tell_apart():
    for n in (1024, 2048, 4096):
        a, b = (np.frombuffer(t.encode(), np.uint8) for t in twins(n))
        both = np.concatenate([a, b])
        h = common.span_hashes(both, np.array([0, n, 0]), np.array([n, 2 * n, n]))
        assert h[0] != h[1] and h[0] == h[2]
        assert common.same_spans(both, np.array([0, 0]), np.array([n, 0]), np.array([n, n])).tolist() == [False, True]
        assert common.same_spans(a, np.array([0, 1]), np.array([n, 1]), np.array([n, 9]), both).tolist() == [False, True]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="aZ9 é.,\n中", max_size=12), max_size=8))
def test_joined_words(texts):
    offsets, raw = common.ragged(pa.array([t.encode() for t in texts], pa.binary()))
    lower = [re.sub("[A-Z]", lambda m: m[0].lower(), t) for t in texts]
    assert [x.decode() for x in common.Words(offsets, raw).joined()] == [" ".join(WORD.findall(t)) for t in lower]


def test_names_that_no_column_has(spark):
    df = spark.createDataFrame([(1, 2)], "own int, _OWN int")
    assert common.free_name(df, "own") == "__own" and common.free_name(df, "tag") == "tag"


def test_a_folder_without_a_scheme_is_spark_s(spark, monkeypatch):
    monkeypatch.setattr(common, "checkpoint_root", lambda s: "/shared/without/scheme")
    path = common.scratch_path(spark, "what")
    assert path.startswith(f"{spark.sparkContext.getCheckpointDir()}/tierflow-llm/what-") and path.startswith("file:")
    monkeypatch.setattr(common, "checkpoint_root", lambda s: "store://shared/")
    assert common.scratch_path(spark, "what").startswith("store://shared/tierflow-llm/what-")
