import datetime as dt

from pyspark.sql import functions as F

from tierflow.operators.summaries import GOLD_SUMMARIES, SUMMARY_BY_NAME, distinct_with_null, enrich

T = dt.datetime(2024, 1, 1)
T2 = dt.datetime(2024, 1, 2)
SILVER = (
    "name_common string, name_official string, cca2 string, cca3 string, region string, "
    "subregion string, population bigint, area double, landlocked boolean, un_member boolean, "
    "source_ingested_at timestamp"
)
ROWS = [
    ("Netherlands", "NL-off", "NL", "NLD", "Europe", "Western Europe", 17590672, 41543.0, False, True, T),
    ("Germany", "DE-off", "DE", "DEU", "Europe", "Western Europe", 83240525, 357114.0, False, True, T2),
    ("Chad", "TD-off", "TD", "TCD", "Africa", "Middle Africa", 16425859, 1284000.0, True, True, T),
    ("Nowhere", "X", "XX", "XXX", None, None, None, None, None, None, T),
    ("Nowhere2", "Y", "YY", "YYY", None, None, None, None, None, None, T2),
]


def _silver(spark, rows=ROWS):
    return spark.createDataFrame(rows, SILVER)


def test_by_region_semantics(spark):
    out = {(r.region, r.subregion): r for r in SUMMARY_BY_NAME["countries_by_region"].build(_silver(spark)).collect()}
    eu = out[("Europe", "Western Europe")]
    assert (eu.country_count, eu.total_population, eu.total_area_km2, eu.un_member_count) == (2, 100831197, 398657.0, 2)
    assert eu.source_ingested_at == T2
    null_group = out[(None, None)]
    # all-NULL group: sums are NULL, the boolean count is NULL too (not 0)
    assert (null_group.country_count, null_group.total_population, null_group.total_area_km2, null_group.un_member_count) == (2, None, None, None)


def test_summary_columns(spark):
    s = _silver(spark)
    cols = {spec.name: spec.build(s, F.current_timestamp()).columns for spec in GOLD_SUMMARIES}
    assert cols["countries_by_region"] == ["region", "subregion", "country_count", "total_population", "total_area_km2", "un_member_count", "source_ingested_at", "updated_at"]
    assert cols["countries_by_continent"] == ["continent", "country_count", "total_population", "total_area_km2", "un_member_count", "source_ingested_at", "updated_at"]
    assert cols["population_tiers"] == ["population_tier", "country_count", "total_population", "source_ingested_at", "updated_at"]
    assert cols["landlocked_vs_coastal"] == ["region", "landlocked", "country_count", "total_population", "total_area_km2", "source_ingested_at", "updated_at"]
    assert cols["un_membership_summary"] == ["region", "un_member", "country_count", "total_population", "source_ingested_at", "updated_at"]


def test_tiers_null_population_is_micro(spark):
    out = {r.population_tier: r.country_count for r in SUMMARY_BY_NAME["population_tiers"].build(_silver(spark)).collect()}
    assert out == {"Medium (10M-100M)": 3, "Micro (<1M)": 2}


def test_boolean_null_is_its_own_group(spark):
    out = {(r.region, r.landlocked): r.country_count for r in SUMMARY_BY_NAME["landlocked_vs_coastal"].build(_silver(spark)).collect()}
    assert out == {("Europe", False): 2, ("Africa", True): 1, (None, None): 2}


def test_enrich_columns_and_values(spark):
    out = enrich(_silver(spark), F.current_timestamp())
    assert out.columns == [
        "name_common", "name_official", "cca2", "cca3", "region", "subregion", "population", "area",
        "population_density", "size_category", "landlocked", "un_member", "source_ingested_at", "updated_at",
    ]
    got = {r.cca2: (r.population_density, r.size_category) for r in out.collect()}
    assert got["NL"] == (423.43, "Medium (10k-100k km2)")
    assert got["DE"] == (233.09, "Large (100k-1M km2)")
    assert got["TD"] == (12.79, "Very Large (>1M km2)")
    assert got["XX"] == (None, "Unknown")


def test_distinct_with_null(spark):
    s = _silver(spark)
    assert s.agg(distinct_with_null("region")).first()[0] == 3
    assert s.filter("false").agg(distinct_with_null("region")).first()[0] == 0


def _rows_by_key(df, nkeys):
    # doubles rounded: a different addition order may move the last bits
    return sorted(
        (
            (tuple(r[:nkeys]), tuple(round(v, 6) if isinstance(v, float) else v for v in r[nkeys:]))
            for r in df.collect()
        ),
        key=repr,
    )


def test_summary_groups_equal_separate_summaries(spark):
    from tierflow.operators.summaries import summary_groups

    s = _silver(spark)
    groups = summary_groups(s)
    for spec in GOLD_SUMMARIES:
        one = groups.summary(spec.name, F.lit(T))
        sep = spec.build(s, F.lit(T))
        assert one.columns == sep.columns
        n = len(spec.keys())
        assert _rows_by_key(one, n) == _rows_by_key(sep, n), spec.name


def test_summary_groups_is_one_aggregate(spark):
    from tierflow.operators.summaries import summary_groups

    plan = summary_groups(_silver(spark)).rows._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Expand") == 1 and plan.count("Exchange hashpartitioning") == 1
    assert plan.count("Scan ExistingRDD") == 1


def test_summary_groups_repeated_set_and_conflicting_measure(spark):
    import pytest

    from tierflow.operators.summaries import SummarySpec, summary_groups, total

    s = _silver(spark)
    a = SummarySpec("a", lambda: [F.col("region")], lambda: [total("population", "p")], "")
    b = SummarySpec("b", lambda: [F.col("region")], lambda: [F.count(F.lit(1)).alias("n")], "")
    g = summary_groups(s, [a, b])
    # the same grouping set twice must not double its groups
    assert {r.region: r.p for r in g.summary("a").collect()} == {"Europe": 100831197, "Africa": 16425859, None: None}
    assert {r.region: r.n for r in g.summary("b").collect()} == {"Europe": 2, "Africa": 1, None: 2}
    c = SummarySpec("c", lambda: [F.col("subregion")], lambda: [total("area", "p")], "")
    with pytest.raises(ValueError, match="'p'"):
        summary_groups(s, [a, c])
    d = SummarySpec("d", lambda: [F.col("subregion").alias("region")], lambda: [total("population", "p")], "")
    with pytest.raises(ValueError, match="distinct column names"):
        summary_groups(s, [a, d]).long_form()
