"""Small files of stored batches: packing, switching, folding, landings meanwhile."""

import datetime as dt

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from tierflow.plans.medallion import Layout, compact_log, record_batch
from tierflow.sinks import compaction as co
from tierflow.sinks.tables import ensure_namespace, land_batch


@given(st.dictionaries(st.text("abc", min_size=1, max_size=4), st.integers(0, 30)), st.integers(1, 25))
def test_first_fit(sizes, room):
    bins = co.first_fit(sizes, room)
    assert sorted(n for names in bins for n in names) == sorted(sizes)
    assert all(sum(sizes[n] for n in names) <= room or len(names) == 1 for names in bins)
    # no two bins fit into one
    used = sorted(sum(sizes[n] for n in names) for names in bins)
    assert len(used) < 2 or used[0] + used[1] > room


def test_partitions_are_packed_and_switched(spark):
    ensure_namespace(spark, "cmp_part")
    t = "cmp_part.t"
    df = spark.range(3000).select("id", F.concat(F.lit("b "), (F.col("id") % 3).cast("string")).alias("batch_id"))
    df.filter("batch_id <> 'b 2'").repartition(12).write.partitionBy("batch_id").saveAsTable(t)
    land_batch(df.filter("batch_id = 'b 2'").coalesce(1), t, "b 2")
    before = co._listing(spark, t, "batch_id")
    assert [len(before[f"b {i}"]) for i in range(3)] == [12, 12, 1]
    assert co.compact_partitions(spark, t) == ["b 0", "b 1"]
    after = co._listing(spark, t, "batch_id")
    assert [len(after[f"b {i}"]) for i in range(3)] == [1, 1, 1] and after["b 2"] == before["b 2"]
    assert sorted(map(tuple, spark.table(t).collect())) == sorted(map(tuple, df.collect()))
    assert co.compact_partitions(spark, t) == []
    land_batch(spark.range(2).withColumn("batch_id", F.lit("b 0")), t, "b 0")  # a batch can still be replaced
    assert spark.table(t).filter("batch_id = 'b 0'").count() == 2


def test_bins_are_written_without_a_sort(spark, monkeypatch):
    """A bin is of one batch, so its rows need no sort by batch, which would hold a bin's rows in memory."""
    seen, write = [], DataFrameWriter.parquet
    monkeypatch.setattr(DataFrameWriter, "parquet", lambda self, path: seen.append(spark.conf.get(co.WRITERS)) or write(self, path))
    before = spark.conf.get(co.WRITERS)
    ensure_namespace(spark, "cmp_unsorted")
    name = "cmp_unsorted.t"
    for batch in ("a", "b"):
        land_batch(spark.range(0, 40, 1, 5).withColumn("batch_id", F.lit(batch)), name, batch)
    assert co.compact_partitions(spark, name) == ["a", "b"]
    assert seen == ["1"] and spark.conf.get(co.WRITERS) == before
    assert {b: set(f) and len(f) for b, f in co._listing(spark, name, "batch_id").items()} == {"a": 1, "b": 1}
    rows = spark.table(name).groupBy("batch_id").agg(F.count("id").alias("n"), F.sum("id").alias("s")).collect()
    assert sorted(map(tuple, rows)) == [("a", 40, 780), ("b", 40, 780)]


def test_a_partition_that_changed_meanwhile_stays(spark, monkeypatch):
    ensure_namespace(spark, "cmp_race")
    t = "cmp_race.t"
    spark.range(100).selectExpr("id", "concat('b', id % 2) as batch_id").repartition(6).write.partitionBy("batch_id").saveAsTable(t)
    listing, calls = co._listing, []

    def late(*args):
        calls.append(1)
        if len(calls) == 2:  # after the rewrite, before the switch
            land_batch(spark.range(7).withColumn("batch_id", F.lit("b0")), t, "b0")
        return listing(*args)

    monkeypatch.setattr(co, "_listing", late)
    assert co.compact_partitions(spark, t) == ["b1"]
    monkeypatch.undo()
    assert spark.table(t).filter("batch_id = 'b0'").count() == 7 and spark.table(t).filter("batch_id = 'b1'").count() == 50


@pytest.fixture
def log(spark, request):
    lay = Layout(bronze_db=f"cmp_{request.node.name[5:25]}")
    ensure_namespace(spark, lay.bronze_db)
    rows = spark.range(300).select(
        F.lit(dt.datetime(2024, 1, 1)).alias("ingested_at"), F.lit("u").alias("source_url"), F.col("id").alias("record_count"), F.lit("cca2").alias("keyed_by"), F.col("id").alias("keyed_count"), F.concat(F.lit("b"), "id").alias("batch_id")
    )
    rows.repartition(8).write.partitionBy("batch_id").saveAsTable(lay.batch_log)
    return lay


def rows_of(spark, name):
    return sorted(map(str, spark.table(name).collect()))


def test_many_small_batches_become_few_files(spark, log):
    before = rows_of(spark, log.batch_log)
    assert len(spark.table(log.batch_log).inputFiles()) == 300
    assert compact_log(spark, log) == 300
    assert rows_of(spark, log.batch_log) == before
    assert len(spark.table(log.batch_log).inputFiles()) < 5

    # later landings, a batch landed again, and a second fold
    spark.createDataFrame([("x", "u", dt.datetime(2024, 2, 1), b) for b in ("b7", "new")], "raw_json string, source_url string, ingested_at timestamp, batch_id string").write.partitionBy("batch_id").saveAsTable(log.bronze)
    for batch in ("b7", "new"):
        record_batch(spark, log, batch, "cca2", 1)
    shown = {r.batch_id: r.record_count for r in spark.table(log.batch_log).collect()}
    assert len(shown) == 301 == spark.table(log.batch_log).count() and (shown["b7"], shown["new"], shown["b8"]) == (1, 1, 8)
    want = rows_of(spark, log.batch_log)
    assert compact_log(spark, log) == 2 and rows_of(spark, log.batch_log) == want
    assert compact_log(spark, log) == 0 and len(co._folded(spark, log.batch_log)) == 1


def test_landings_while_folding_stay(spark, log, monkeypatch):
    listing, calls = co._listing, []

    def late(*args):
        calls.append(1)
        if len(calls) == 2:  # the rows are written, the batches not yet dropped
            spark.createDataFrame([("x", "u", dt.datetime(2024, 2, 1), b) for b in ("b3", "new")], "raw_json string, source_url string, ingested_at timestamp, batch_id string").write.partitionBy("batch_id").saveAsTable(log.bronze)
            for batch in ("b3", "new"):
                record_batch(spark, log, batch, "cca2", 1)
        return listing(*args)

    monkeypatch.setattr(co, "_listing", late)
    assert compact_log(spark, log) == 299
    shown = {r.batch_id: r.record_count for r in spark.table(log.batch_log).collect()}
    assert spark.table(log.batch_log).count() == 301 and (shown["b3"], shown["new"], shown["b4"]) == (1, 1, 4)


def test_nothing_is_missed_or_seen_twice_when_folding_fails(spark, log, monkeypatch):
    want = rows_of(spark, log.batch_log)
    sql = type(spark).sql

    def run(self, query, *a, **k):
        if "DROP IF EXISTS PARTITION" in query and "'b99'" in query:
            raise RuntimeError("lost")
        return sql(self, query, *a, **k)

    monkeypatch.setattr(type(spark), "sql", run)
    with pytest.raises(RuntimeError, match="lost"):
        compact_log(spark, log)
    monkeypatch.undo()
    assert rows_of(spark, log.batch_log) == want
    compact_log(spark, log)
    assert rows_of(spark, log.batch_log) == want and len(spark.table(log.batch_log).inputFiles()) < 5
