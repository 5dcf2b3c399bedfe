import datetime as dt

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tierflow.operators import inspect
from tierflow.operators.summaries import SUMMARY_BY_NAME, enrich
from tests.test_summaries import ROWS, _silver

T = dt.datetime(2024, 1, 1)


def test_top_n_ties_and_nulls(spark):
    rows = ROWS + [("Aland", "A", "AX", "ALA", "Europe", "N", 83240525, 1.0, False, True, T)]
    g = enrich(_silver(spark, rows))
    top = inspect.top_n(g, 3, "population", ["name_common", "population"], ["name_common"]).collect()
    assert [r.name_common for r in top] == ["Aland", "Germany", "Netherlands"]
    plan = inspect.top_n(g, 3, "population", None, ["name_common"])._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan


def test_sort_nulls_first_ascending(spark):
    rows = ROWS + [(None, "Z", "ZZ", "ZZZ", "Asia", "S", 1, 1.0, False, True, T)]
    out = inspect.sort_by(_silver(spark, rows), ["name_common"], ["cca2"]).collect()
    assert out[0].name_common is None and out[1].name_common == "Chad"


def test_kpis(spark):
    s = _silver(spark)
    k = inspect.kpi_at_a_glance(s).first()
    assert (k.total_countries, k.regions, k.un_members, k.landlocked) == (5, 3, 3, 1)
    g = enrich(s)
    e = inspect.kpi_extremes(g, SUMMARY_BY_NAME["countries_by_continent"].build(s)).first()
    assert e.total_countries == 5 and e.total_population == 17590672 + 83240525 + 16425859
    assert e.num_continents == 3
    assert (e.largest_name, e.largest_area) == ("Chad", 1284000.0)
    assert (e.most_populous_name, e.most_populous_population) == ("Germany", 83240525)
    assert (e.densest_name, e.densest_density) == ("Netherlands", 423.43)
    txt = inspect.kpi_text(inspect.kpi_extremes(g, SUMMARY_BY_NAME["countries_by_continent"].build(s))).first()
    assert txt.world_population == "117.3M" and txt.largest_area == "1.3M" and txt.densest_density == "423"


def test_arg_max_ties_pick_greatest_name(spark):
    rows = [(n, n, n, n, "R", "S", 10, 5.0, False, True, T) for n in ("b", "c", "a")]
    e = inspect.kpi_extremes(enrich(_silver(spark, rows)), SUMMARY_BY_NAME["countries_by_continent"].build(_silver(spark, rows))).first()
    assert e.largest_name == "c" and e.most_populous_name == "c"


def test_batch_inventory_and_meta(spark):
    b = spark.createDataFrame(
        [("{}", "u", "b1", T), ("{}", "u", "b1", T), ("{}", "u", "b2", dt.datetime(2024, 1, 2))],
        "raw_json string, source_url string, batch_id string, ingested_at timestamp",
    )
    inv = inspect.batch_inventory(b).collect()
    assert [(r.batch_id, r.row_count) for r in inv] == [("b2", 1), ("b1", 2)]
    meta = inspect.newest_batch_meta(b).collect()
    assert [(r.batch_id, r.source_url) for r in meta] == [("b2", "u")]
    sample = inspect.payload_sample(b, 2).collect()
    assert [r.batch_id for r in sample] == ["b2", "b1"] and sample[0].payload_bytes == 2


def test_bronze_views_from_the_batch_log_equal_full_scans(spark):
    from pyspark.sql import functions as F

    from tests.test_refine import _scan_metrics

    t1, t2, t3 = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2), dt.datetime(2024, 1, 3)
    sizes = {"b1": (t1, 3), "b2": (t2, 2), "b3": (t3, 2), "b4": (t3, 1), "b0": (None, 2)}
    rows = [
        (f'{{"cca2":"{b}{i}"}}', f"src-{b}", b, ts) for b, (ts, n) in sizes.items() for i in range(n)
    ]
    spark.sql("CREATE SCHEMA IF NOT EXISTS bl")
    df = spark.createDataFrame(rows, "raw_json string, source_url string, batch_id string, ingested_at timestamp")
    df.write.partitionBy("batch_id").saveAsTable("bl.raw")
    df.groupBy("batch_id").agg(
        F.max("ingested_at").alias("ingested_at"),
        F.max("source_url").alias("source_url"),
        F.count(F.lit(1)).alias("record_count"),
    ).write.saveAsTable("bl.raw_batches")
    bronze, log = spark.table("bl.raw"), spark.table("bl.raw_batches")

    for k in range(1, 13):
        plain = [tuple(r) for r in inspect.payload_sample(bronze, k).collect()]
        logged = [tuple(r) for r in inspect.payload_sample(bronze, k, batch_log=log).collect()]
        assert logged == plain, k
    # the k newest batches and their ties; k=11 needs all
    for k, parts in ((1, 2), (2, 2), (3, 3), (11, 5)):
        assert _scan_metrics(inspect.payload_sample(bronze, k, batch_log=log), "bl.raw")["numPartitions"] == parts

    assert [tuple(r) for r in inspect.newest_batch_meta(bronze, batch_log=log).collect()] == [
        tuple(r) for r in inspect.newest_batch_meta(bronze).collect()
    ]
    assert [tuple(r) for r in inspect.batch_inventory(bronze, batch_log=log).collect()] == [
        tuple(r) for r in inspect.batch_inventory(bronze).collect()
    ]


def test_sort_splits_exact_copies_of_a_stored_table(spark):
    from pyspark.sql import functions as F

    spark.sql("CREATE SCHEMA IF NOT EXISTS srt")
    rows = [("same", "K") if i % 3 == 0 else (f"n{i:05d}", f"k{i}") for i in range(9000)]
    spark.createDataFrame(rows, "name string, key string").repartition(8).write.saveAsTable("srt.copies")
    table = spark.table("srt.copies")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        out = inspect.sort_by(table, ["name"], ["key"])
        assert out.columns == ["name", "key"]
        sizes = [r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()]
        plain = inspect.sort_by(table, ["name"], ["key"], split_copies=False)
        plain_sizes = [r["count"] for r in plain.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert max(plain_sizes) >= 3000 and max(sizes) < 2000  # the hot third is spread
    got = [tuple(r) for r in out.collect()]
    assert sorted(got) == got and len(got) == 9000  # still sorted, nothing lost
    # a derived frame cannot see its file rows: plain tie-breakers only
    derived = table.groupBy("name").count()
    assert inspect.sort_by(derived, ["name"]).count() == derived.count()


def _in_order(df, keys):
    """Whether rows stand in order across and within partitions: (rows, breaks, largest partition's share)."""
    placed = df.select(*keys, F.spark_partition_id().alias("p"), F.monotonically_increasing_id().alias("i"))
    now = F.struct(*keys)
    checked = placed.withColumn("before", F.lag(now).over(Window.orderBy("p", "i"))).withColumn("now", now)
    n = placed.count()
    return n, checked.filter("before > now").count(), placed.groupBy("p").count().agg(F.max("count")).first()[0] / n


@pytest.mark.parametrize("parts", [1, 7, 16])
def test_runs_are_sorted_and_spread(spark, parts):
    # behind a generator no file row is seen: a third of the rows is one copy
    df = spark.range(6000).select((F.col("id") % 2500 * 7919 % 2500).cast("string").alias("name"), F.explode(F.array(F.lit(1), F.lit(2))).alias("k"))
    df = df.unionByName(df.limit(0)).unionByName(spark.range(6000).select(F.lit("15x").alias("name"), F.lit(1).alias("k"))).repartition(5)
    assert inspect._sees_file_rows(df) is False
    out = inspect.sort_runs(df, ["name"], partitions=parts)
    n, breaks, largest = _in_order(out, ["name", "k"])
    assert (n, breaks) == (18000, 0)
    assert largest <= 1.01 / parts + 0.001
    assert out.groupBy("name", "k").count().exceptAll(df.groupBy("name", "k").count()).count() == 0


def test_runs_with_nulls_directions_and_no_rows(spark):
    df = spark.createDataFrame([(None, 1), ("a", 2), ("a", 2), (None, 1), ("b", None), ("a", 3)], "name string, k int")
    got = [tuple(r) for r in inspect.sort_runs(df, ["name", F.col("k").desc()], partitions=3).collect()]
    assert got == [(None, 1), (None, 1), ("a", 3), ("a", 2), ("a", 2), ("b", None)]
    assert inspect.sort_runs(df.limit(0), ["name"]).collect() == []
