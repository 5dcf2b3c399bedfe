import pytest
from pyspark.sql import functions as F

from tierflow.operators import quality
from tierflow.operators.quality import (
    NonEmpty,
    NoNegatives,
    NoNulls,
    NullRateAtMost,
    RowCountBetween,
    Unique,
    enforce,
    quality_report,
    reconcile_report,
    union_reports,
)


def _df(spark, rows):
    return spark.createDataFrame(rows, "k string, r string, p bigint")


def _report(spark, rows, rules):
    return {r.check: r for r in quality_report(_df(spark, rows), rules, "t").collect()}


@pytest.mark.parametrize("n, ok", [(219, False), (220, True), (260, True), (261, False)])
def test_row_count_inclusive(spark, n, ok):
    rows = [(str(i), "x", 1) for i in range(n)]
    assert _report(spark, rows, [RowCountBetween(220, 260)])["row_count_in_range"].passed is ok


@pytest.mark.parametrize("nulls, ok", [(4, True), (5, True), (6, False)])
def test_null_rate_exactly_five_percent_passes(spark, nulls, ok):
    rows = [(str(i), None if i < nulls else "x", 1) for i in range(100)]
    rep = _report(spark, rows, [NullRateAtMost("r", 0.05)])["null_rate(r)"]
    assert rep.observed == nulls / 100 and rep.passed is ok


def test_empty_table_rules(spark):
    rep = _report(spark, [], [NonEmpty(), NullRateAtMost("r", 0.05), Unique(("k",)), NoNulls("p")])
    assert rep["non_empty"].passed is False
    assert rep["null_rate(r)"].observed == 1.0 and rep["null_rate(r)"].passed is False
    assert rep["duplicate_keys(k)"].observed == 0 and rep["duplicate_keys(k)"].passed
    assert rep["null_count(p)"].passed


def test_unique_counts_null_as_a_value(spark):
    rows = [("a", "x", 1), ("a", "x", 1), (None, "x", 1), (None, "x", 1), ("b", "x", 1)]
    rep = _report(spark, rows, [Unique(("k",)), Unique(("k", "r"))])
    assert rep["duplicate_keys(k)"].observed == 2
    assert rep["duplicate_keys(k,r)"].observed == 2


def test_negatives_and_nulls(spark):
    rows = [("a", "x", 0), ("b", "x", -1), ("c", "x", None)]
    rep = _report(spark, rows, [NoNegatives("p"), NoNulls("p")])
    assert rep["negative_count(p)"].observed == 1 and not rep["negative_count(p)"].passed
    assert rep["null_count(p)"].observed == 1
    zero_only = _report(spark, [("a", "x", 0)], [NoNegatives("p")])
    assert zero_only["negative_count(p)"].passed  # zero is valid


def test_reconcile(spark):
    detail = _df(spark, [("a", "x", 1), ("b", "x", 1), ("c", "y", 1)])
    summary = detail.groupBy("r").count().withColumnRenamed("count", "n")
    assert reconcile_report(summary, "n", detail, "s").first().passed
    bad = summary.filter("r = 'x'")
    assert not reconcile_report(bad, "n", detail, "s").first().passed
    empty = summary.filter("false")
    assert not reconcile_report(empty, "n", detail.filter("false"), "s").first().passed


def test_enforce_lists_every_failure(spark):
    rows = [("a", None, -1), ("a", None, None)]
    rep = union_reports(
        [quality_report(_df(spark, rows), [Unique(("k",)), NoNulls("p"), NoNegatives("p")], "t"),
         quality_report(_df(spark, []), [NonEmpty()], "empty")]
    )
    with pytest.raises(AssertionError) as e:
        enforce(rep)
    msg = str(e.value)
    assert msg.startswith("4 data quality check(s) failed:")
    for part in ("duplicate_keys(k)", "null_count(p)", "negative_count(p)", "empty: non_empty"):
        assert part in msg
    enforce(quality_report(_df(spark, [("a", "x", 1)]), [NonEmpty()], "ok"))


def test_row_counts_of_tables(spark):
    from tierflow.operators.quality import non_empty_report, row_counts

    got = non_empty_report(row_counts({"a": spark.range(7), "b": spark.range(0)})).collect()
    assert sorted((r.table_name, r.observed, r.passed) for r in got) == [("a", 7.0, True), ("b", 0.0, False)]
    with pytest.raises(ValueError):
        row_counts({})


def _duplicates(df, columns, **kw):
    return tuple(quality.duplicate_rows(df, columns, **kw).first())


def test_duplicate_rows_equal_the_distinct_count(spark):
    rows = [(i, f"key {i}" * 20, None if i % 40 == 0 else i % 3) for i in range(900)] + [(5, "key 5" * 20, 2)] * 300 + [(None, None, None)] * 3 + [(None, "", None)]
    df = spark.createDataFrame(rows, "a int, b string, c int")
    for columns in (["a"], ["b"], ["a", "b", "c"], ["c"], ["a", "c"]):
        distinct = df.select(*columns).distinct().count()
        for few in (500_000, 5):  # candidates sent to the tasks, or too many of them
            assert _duplicates(df, columns, few=few) == (df.count(), df.count() - distinct)
    assert _duplicates(df.limit(0), ["a"]) == (0, 0)
    assert _duplicates(spark.range(50), ["id"]) == (50, 0)


def test_unlike_keys_under_one_hash(spark, monkeypatch):
    monkeypatch.setattr(quality.F, "xxhash64", lambda *a: F.lit(7).cast("long"))
    assert _duplicates(spark.createDataFrame([("x",), ("y",), ("y",), (None,)], "k string"), ["k"]) == (4, 1)


def test_wide_unique_keys_are_not_shuffled(spark):
    df = spark.range(20_000).select(F.sha2(F.col("id").cast("string"), 512).alias("a"), F.sha2((-F.col("id")).cast("string"), 512).alias("b"))
    out = quality.duplicate_rows(df.unionByName(df.limit(10)), ["a", "b"])
    assert tuple(out.first()) == (20_010, 10)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Filter _hash" in plan  # ten hashes, where the rows are read
