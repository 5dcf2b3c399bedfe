"""Property tests: bucket labels and the guarded ratio against a plain-Python
model of the rules (Spark semantics: NaN compares greater than any number)."""

import math

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tierflow.functions.expressions import (
    SIZE_OTHERWISE,
    SIZE_RULES,
    SIZE_UNKNOWN,
    TIER_OTHERWISE,
    TIER_RULES,
    guarded_ratio,
    population_tier,
    size_category,
)

BOUNDS = [b for b, _ in SIZE_RULES] + [b for b, _ in TIER_RULES] + [0]
near_bounds = st.sampled_from(BOUNDS).flatmap(lambda b: st.sampled_from([b - 1, b, b + 1, -b]))
doubles = st.one_of(
    st.none(),
    near_bounds.map(float),
    st.floats(allow_nan=True, allow_infinity=True, width=64),
    st.integers(-(10**12), 10**12).map(float),
)
longs = st.one_of(st.none(), near_bounds, st.integers(-(2**62), 2**62))


def _gt(x, b):  # Spark: NaN is greater than every number
    return math.isnan(x) or x > b


def _ge(x, b):
    return math.isnan(x) or x >= b


def size_model(area):
    if area is None:
        return SIZE_UNKNOWN
    for bound, label in SIZE_RULES:
        if _gt(area, bound):
            return label
    return SIZE_OTHERWISE


def tier_model(pop):
    if pop is not None:
        for bound, label in TIER_RULES:
            if pop >= bound:
                return label
    return TIER_OTHERWISE  # NULL and negatives fall through


@settings(max_examples=8, deadline=None)
@given(st.lists(doubles, min_size=1, max_size=300))
def test_size_category_matches_model(spark, areas):
    df = spark.createDataFrame([(i, a) for i, a in enumerate(areas)], "i int, area double")
    got = {r.i: r.label for r in df.select("i", size_category("area").alias("label")).collect()}
    assert [got[i] for i in range(len(areas))] == [size_model(a) for a in areas]


@settings(max_examples=8, deadline=None)
@given(st.lists(longs, min_size=1, max_size=300))
def test_population_tier_matches_model(spark, pops):
    df = spark.createDataFrame([(i, p) for i, p in enumerate(pops)], "i int, population bigint")
    got = {r.i: r.tier for r in df.select("i", population_tier("population").alias("tier")).collect()}
    assert [got[i] for i in range(len(pops))] == [tier_model(p) for p in pops]


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(longs, doubles), min_size=1, max_size=300))
def test_guarded_ratio_is_null_unless_positive_area(spark, pairs):
    rows = [(i, p, a) for i, (p, a) in enumerate(pairs)]
    df = spark.createDataFrame(rows, "i int, population bigint, area double")
    out = {r.i: r.d for r in df.select("i", guarded_ratio("population", "area", None).alias("d")).collect()}
    for i, p, a in rows:
        positive = a is not None and _gt(a, 0)
        if not positive or p is None:
            assert out[i] is None, (p, a)
        elif not math.isnan(a) and not math.isinf(a):
            assert out[i] == p / a or math.isclose(out[i], p / a, rel_tol=1e-15), (p, a)


@settings(max_examples=10, deadline=None)
@given(
    st.lists(
        st.tuples(
            st.one_of(st.none(), st.integers(0, 6)),
            st.one_of(st.none(), st.sampled_from(["a", "b", ""])),
            st.one_of(st.none(), st.integers(-3, 3)),
        ),
        min_size=0,
        max_size=60,
    ),
    st.integers(0, 30),
    st.sampled_from([0.0, 0.05, 0.25, 1.0]),
)
def test_quality_report_matches_model(spark, rows, lo, rate):
    from tierflow.operators.quality import (
        NoNegatives,
        NoNulls,
        NonEmpty,
        NullRateAtMost,
        RowCountBetween,
        Unique,
        quality_report,
    )

    hi = lo + 10
    df = spark.createDataFrame(rows, "k int, r string, p int")
    rules = [NonEmpty(), RowCountBetween(lo, hi), Unique(("k",)), Unique(("k", "r")),
             NullRateAtMost("r", rate), NoNulls("p"), NoNegatives("p")]
    got = {x.check: (x.observed, x.passed) for x in quality_report(df, rules, "t").collect()}
    n = len(rows)
    null_rate = (sum(r is None for _, r, _ in rows) / n) if n else 1.0
    model = {
        "non_empty": (float(n), n > 0),
        f"row_count_in_range": (float(n), lo <= n <= hi),
        "duplicate_keys(k)": (float(n - len({k for k, _, _ in rows})), n == len({k for k, _, _ in rows})),
        "duplicate_keys(k,r)": (float(n - len({(k, r) for k, r, _ in rows})), n == len({(k, r) for k, r, _ in rows})),
        f"null_rate(r)": (null_rate, null_rate <= rate),
        "null_count(p)": (float(sum(p is None for _, _, p in rows)), all(p is not None for _, _, p in rows)),
        "negative_count(p)": (float(sum(p is not None and p < 0 for _, _, p in rows)),
                              not any(p is not None and p < 0 for _, _, p in rows)),
    }
    for check, (observed, passed) in model.items():
        assert got[check][1] is passed, (check, got[check], observed)
        assert math.isclose(got[check][0], observed), (check, got[check], observed)


def _sum_or_none(values):
    values = [v for v in values if v is not None]
    return sum(values) if values else None


@settings(max_examples=8, deadline=None)
@given(
    st.lists(
        st.tuples(
            st.one_of(st.none(), st.sampled_from(["Europe", "Asia"])),
            st.one_of(st.none(), st.sampled_from(["West", "East"])),
            st.one_of(st.none(), st.integers(0, 200_000_000)),
            st.one_of(st.none(), st.integers(0, 2_000_000).map(float)),
            st.one_of(st.none(), st.booleans()),
        ),
        min_size=0,
        max_size=80,
    )
)
def test_summaries_match_model(spark, rows):
    import datetime as dt

    from tierflow.operators.summaries import SUMMARY_BY_NAME, summary_groups

    stamp = dt.datetime(2024, 1, 1)
    data = [("n", "o", f"k{i}", "x", reg, sub, pop, area, None, un, stamp)
            for i, (reg, sub, pop, area, un) in enumerate(rows)]
    silver = spark.createDataFrame(
        data,
        "name_common string, name_official string, cca2 string, cca3 string, region string, subregion string, "
        "population bigint, area double, landlocked boolean, un_member boolean, source_ingested_at timestamp",
    )
    groups = {}
    for _, _, _, _, reg, sub, pop, area, _, un, _ in data:
        groups.setdefault((reg, sub), []).append((pop, area, un))
    model = {
        key: (len(g), _sum_or_none([p for p, _, _ in g]), _sum_or_none([a for _, a, _ in g]),
              _sum_or_none([int(u) if u is not None else None for _, _, u in g]))
        for key, g in groups.items()
    }
    one_scan = summary_groups(silver)
    for frame in (SUMMARY_BY_NAME["countries_by_region"].build(silver), one_scan.summary("countries_by_region")):
        got = {(r.region, r.subregion): (r.country_count, r.total_population, r.total_area_km2, r.un_member_count)
               for r in frame.collect()}
        assert got == model
