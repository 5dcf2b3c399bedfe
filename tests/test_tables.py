import datetime as dt

import pytest
from pyspark.sql import functions as F

from tierflow.sinks.tables import ensure_namespace, land_batch, table_comment, write_table

T = dt.datetime(2024, 1, 1)


def test_land_batch_evolves_schema_and_is_idempotent(spark):
    ensure_namespace(spark, "k1_bronze")
    t = "k1_bronze.raw"
    b1 = spark.createDataFrame([("a", "u", "b1", T)], "raw_json string, source_url string, batch_id string, ingested_at timestamp")
    land_batch(b1, t, "b1")
    b2 = b1.withColumn("batch_id", F.lit("b2")).withColumn("extra", F.lit(7))
    land_batch(b2, t, "b2")
    land_batch(b2, t, "b2")  # retried run with the same batch id: no duplicate
    b3 = b1.withColumn("batch_id", F.lit("b3")).drop("source_url")  # missing column → NULL
    land_batch(b3, t, "b3")
    rows = {r.batch_id: r for r in spark.table(t).collect()}
    assert sorted(rows) == ["b1", "b2", "b3"]
    assert rows["b1"].extra is None and rows["b2"].extra == 7
    assert rows["b3"].source_url is None
    assert spark.table(t).count() == 3


def test_write_table_overwrites_schema_comment_and_counts(spark):
    ensure_namespace(spark, "k2_gold")
    t = "k2_gold.summary"
    n = write_table(spark.range(10).withColumn("x", F.lit("a")), t, "It's the first")
    assert n == 10 and table_comment(spark, t) == "It's the first"
    n2 = write_table(spark.range(3).select(F.col("id").alias("y")), t, "second")
    assert n2 == 3
    assert spark.table(t).columns == ["y"] and table_comment(spark, t) == "second"


def test_overwrite_of_a_table_read_in_the_same_plan_is_refused(spark):
    ensure_namespace(spark, "k2_self")
    t = "k2_self.t"
    write_table(spark.range(5), t)
    with pytest.raises(Exception):
        write_table(spark.table(t).filter("id > 1"), t, replace="in_place")
    assert spark.table(t).count() == 5


def test_swap_refresh_keeps_the_old_table_on_failure_and_may_read_itself(spark):
    ensure_namespace(spark, "k2_swap")
    t = "k2_swap.t"
    write_table(spark.range(5), t, "v1")
    failing = spark.range(100).select(
        F.when(F.col("id") == 77, F.raise_error(F.lit("boom"))).otherwise(F.col("id")).alias("id")
    )
    with pytest.raises(Exception, match="boom"):
        write_table(failing, t, "v2")
    assert spark.table(t).count() == 5 and table_comment(spark, t) == "v1"
    # a refresh computed from the table itself
    assert write_table(spark.table(t).filter("id > 1"), t, "v3") == 3
    assert sorted(r.id for r in spark.table(t).collect()) == [2, 3, 4]
    assert table_comment(spark, t) == "v3"
    assert [x.name for x in spark.catalog.listTables("k2_swap") if not x.isTemporary] == ["t"]


def test_refresh_failing_before_the_switch_keeps_the_old_rows(spark, monkeypatch):
    from tierflow.sinks import tables

    ensure_namespace(spark, "k2_atomic")
    t = "k2_atomic.t"
    write_table(spark.range(5), t, "v1")
    where = tables._location(spark, t)
    switch = spark.sql
    monkeypatch.setattr(type(spark), "sql", lambda self, q, *a, **k: (_ for _ in ()).throw(RuntimeError("lost")) if "SET LOCATION" in q else switch(q, *a, **k))
    with pytest.raises(RuntimeError, match="lost"):
        write_table(spark.range(9), t, "v2")
    monkeypatch.undo()
    assert spark.table(t).count() == 5 and tables._location(spark, t) == where
    assert write_table(spark.range(9), t, "v2") == 9
    assert write_table(spark.range(11), t, "v3") == 11
    assert spark.table(t).count() == 11 and table_comment(spark, t) == "v3"
    assert tables.remove_old_versions(spark, t) == 3  # v1, the lost one and v2
    assert spark.table(t).count() == 11


def test_delta_writer_options():
    from tierflow.sinks.tables import DELTA_LANDING, DELTA_REFRESH

    assert (DELTA_LANDING, DELTA_REFRESH) == ({"mergeSchema": "true"}, {"overwriteSchema": "true"})


def test_swap_refresh_of_a_partitioned_table(spark):
    ensure_namespace(spark, "k2_part")
    t = "k2_part.t"
    df = spark.range(12).selectExpr("id", "CAST(id % 3 AS STRING) AS p")
    write_table(df, t, partition_by=["p"])
    write_table(df.filter("id < 6"), t, partition_by=["p"])
    assert spark.table(t).count() == 6
    assert spark.table(t).filter("p = '1'").count() == 2


def test_write_table_compacts_small_partitions(spark):
    ensure_namespace(spark, "tcmp")
    df = spark.range(4000).repartition(40)
    write_table(df, "tcmp.compacted")
    write_table(df, "tcmp.as_is", compact=False)
    compacted = len(spark.table("tcmp.compacted").inputFiles())
    as_is = len(spark.table("tcmp.as_is").inputFiles())
    assert as_is == 40 and compacted < 5
    assert spark.table("tcmp.compacted").count() == 4000


def test_staged_copy_lives_under_the_checkpoint_folder_and_is_dropped(spark):
    from tierflow.sinks.tables import STAGING_NAMESPACE, staged, staging_root

    with staged(spark.range(7)) as copy:
        assert copy.count() == 7
        name = [
            t.name for t in spark.catalog.listTables(STAGING_NAMESPACE)
            if not t.isTemporary and t.name.startswith("stage_")
        ]
        assert len(name) == 1
        where = spark.sql(f"DESCRIBE TABLE EXTENDED {STAGING_NAMESPACE}.{name[-1]}").filter(
            "col_name = 'Location'").first().data_type
        root = staging_root(spark).replace("file:", "")
        assert root.rstrip("/") in where
        files = copy.inputFiles()
    import os

    assert not any(os.path.exists(f.replace("file:", "")) for f in files)
