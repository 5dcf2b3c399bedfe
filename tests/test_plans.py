"""Plan-shape checks for the properties that matter at scale."""

import re

from tierflow.operators import quality, refine, summaries
from tierflow.operators.inspect import kpi_extremes
from tierflow.plans import catalog

SF = "/root/testdata/sf0.001"


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _optimized(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_silver_parses_each_row_once(spark):
    plan = _optimized(catalog.silver(spark, SF))
    assert len(re.findall(r"from_json\(", plan)) == 1
    # the naive form pushes the key filter below the projection: two parses
    naive = refine.keep_keyed(refine.parse_records(catalog.bronze(spark, SF)))
    assert len(re.findall(r"from_json\(", _optimized(naive))) == 2


def test_scan_reads_only_needed_columns(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    plan = _plan(catalog.queries()["by_two_keys"](spark, SF))
    schema = re.search(r"ReadSchema: struct<([^>]*)>", plan).group(1)
    assert "props" not in schema
    li = _plan(catalog.queries()["lineitem_summary"](spark, SF))
    li_schema = re.search(r"ReadSchema: struct<([^>]*)>", li).group(1)
    assert set(c.split(":")[0] for c in li_schema.split(",")) == {
        "l_quantity", "l_extendedprice", "l_returnflag", "l_linestatus", "l_shipdate"
    }


def test_summaries_aggregate_before_the_shuffle(spark):
    for name in ("by_two_keys", "by_one_key", "tiers", "by_key_flag", "by_key_flag2", "dq_report", "kpi_at_a_glance"):
        plan = catalog.queries()[name](spark, SF)._jdf.queryExecution().sparkPlan().toString()
        assert "partial_" in plan, name
        assert "BroadcastExchange" not in plan and "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_no_joins_anywhere(spark):
    for name, q in catalog.queries().items():
        plan = q(spark, SF)._jdf.queryExecution().sparkPlan().toString()
        for op in ("BroadcastNestedLoopJoin", "CartesianProduct", "SortMergeJoin", "BroadcastHashJoin"):
            assert op not in plan, (name, op)


def _hot(spark, n=3000):
    # one region holds a third of all rows
    rows = [
        (f"n{i}", f"N{i}", f"k{i}", f"K{i}", "hot" if i % 3 == 0 else f"r{i % 50}", f"s{i % 7}",
         i * 1000, float(i), i % 2 == 0, i % 5 != 0, None)
        for i in range(n)
    ]
    return spark.createDataFrame(rows, summaries_schema())


def summaries_schema():
    from tests.test_summaries import SILVER

    return SILVER


def test_hot_key_results_are_whole(spark):
    s = _hot(spark)
    by = {r.continent: r for r in summaries.SUMMARY_BY_NAME["countries_by_continent"].build(s).collect()}
    assert by["hot"].country_count == 1000
    assert sum(r.country_count for r in by.values()) == 3000
    rep = {r.check: r for r in quality.quality_report(s, [quality.Unique(("region",))], "t").collect()}
    assert rep["duplicate_keys(region)"].observed == 3000 - 51
    e = kpi_extremes(summaries.enrich(s), summaries.SUMMARY_BY_NAME["countries_by_continent"].build(s)).first()
    assert e.total_countries == 3000 and e.num_continents == 51
    # the one-scan form splits the same hot group exactly like the separate summaries
    g = summaries.summary_groups(s)
    one = {r.continent: r.country_count for r in g.summary("countries_by_continent").collect()}
    assert one["hot"] == 1000 and sum(one.values()) == 3000
    tiers = g.summary("population_tiers").collect()
    assert sum(r.country_count for r in tiers) == 3000
