import math

from pyspark.sql import functions as F

from tierflow.functions.expressions import (
    guarded_ratio,
    human_number,
    payload_bytes,
    population_tier,
    size_category,
)


def _one_col(spark, values, dtype, expr):
    df = spark.createDataFrame([(v,) for v in values], f"x {dtype}")
    return [r[0] for r in df.select(expr(F.col("x"))).collect()]


def test_size_category_bounds(spark):
    vals = [None, -5.0, 0.0, 10_000.0, 10_000.5, 100_000.0, 100_001.0, 1_000_000.0, 1_000_000.1, float("nan")]
    out = _one_col(spark, vals, "double", size_category)
    assert out == [
        "Unknown",
        "Small (<10k km2)",
        "Small (<10k km2)",
        "Small (<10k km2)",
        "Medium (10k-100k km2)",
        "Medium (10k-100k km2)",
        "Large (100k-1M km2)",
        "Large (100k-1M km2)",
        "Very Large (>1M km2)",
        "Very Large (>1M km2)",
    ]


def test_population_tier_bounds(spark):
    vals = [None, -1, 0, 999_999, 1_000_000, 9_999_999, 10_000_000, 99_999_999, 100_000_000]
    out = _one_col(spark, vals, "bigint", population_tier)
    assert out == [
        "Micro (<1M)",
        "Micro (<1M)",
        "Micro (<1M)",
        "Micro (<1M)",
        "Small (1M-10M)",
        "Small (1M-10M)",
        "Medium (10M-100M)",
        "Medium (10M-100M)",
        "Large (>=100M)",
    ]


def test_guarded_ratio_fixture_countries(spark):
    # NL, DE, TD and the guard cases: zero, negative and NULL area
    rows = [(17590672, 41543.0), (83240525, 357114.0), (16425859, 1284000.0), (5, 0.0), (5, -1.0), (5, None), (None, 3.0)]
    df = spark.createDataFrame(rows, "p bigint, a double")
    out = [r[0] for r in df.select(guarded_ratio("p", "a")).collect()]
    assert out[:3] == [423.43, 233.09, 12.79]
    assert out[3:] == [None, None, None, None]


def test_guarded_ratio_rounds_half_up(spark):
    df = spark.createDataFrame([(1.005, 1.0), (2.675, 1.0)], "p double, a double")
    assert [r[0] for r in df.select(guarded_ratio("p", "a")).collect()] == [1.01, 2.68]


def test_size_labels_of_fixture(spark):
    out = _one_col(spark, [41543.0, 357114.0, 1284000.0], "double", size_category)
    assert out == ["Medium (10k-100k km2)", "Large (100k-1M km2)", "Very Large (>1M km2)"]
    tiers = _one_col(spark, [17590672, 83240525, 16425859], "bigint", population_tier)
    assert tiers == ["Medium (10M-100M)"] * 3


def test_human_number(spark):
    vals = [None, -7, 0, 999, 1000, 1049, 1_250_000, 999_950, 7_900_000_000, 2_345_000_000, 1_000_000_000]
    out = _one_col(spark, vals, "bigint", human_number)
    assert out == [None, "-7", "0", "999", "1.0K", "1.0K", "1.3M", "1000.0K", "7.90B", "2.35B", "1.00B"]


def test_payload_bytes_counts_utf8(spark):
    out = _one_col(spark, ['{"a":"x"}', '{"a":"é"}'], "string", payload_bytes)
    assert out == [9, 10]
    assert not any(isinstance(v, float) and math.isnan(v) for v in out)
