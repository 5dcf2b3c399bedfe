"""The job path (landing, batch log, log-fed gate, pruned refine) equals the
registered-query path on the driver's ``events`` table, one batch per day."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from tierflow.plans import catalog
from tierflow.plans.medallion import Layout, bronze_to_silver, ingest, inspect_bronze

SF = "/root/testdata/sf0.001"


def test_daily_batches_from_events(spark, tmp_dir):
    bronze = catalog.bronze(spark, SF)
    days = sorted(r.batch_id for r in bronze.select("batch_id").distinct().collect())
    lay = Layout(bronze_db="ev_bronze", silver_db="ev_silver", gold_db="ev_gold")
    root = os.path.join(tmp_dir, "events-landing")
    bronze.select("batch_id", "raw_json").write.partitionBy("batch_id").text(root)
    for day in days:
        stamp = dt.datetime.fromisoformat(day)
        ingest(spark, os.path.join(root, f"batch_id={day}"), lay, doc_layout="lines",
               batch_id=day, as_of=stamp, validate="inline")
    log = spark.table(lay.batch_log)
    assert log.count() == len(days)
    assert log.agg(F.sum("record_count")).first()[0] == bronze.count()

    # sf0.001's newest day drops 2.5 % of its rows: the log-fed gate fails like the data gate
    expected_gate = catalog.queries()["drop_rate"](spark, SF).first()
    with pytest.raises(ValueError, match=f"dropped {expected_gate.dropped_rows}/{expected_gate.total_rows}"):
        bronze_to_silver(spark, lay)
    res = bronze_to_silver(spark, lay, max_drop=0.03)
    assert (res.gate.total_rows, res.gate.kept_rows) == (expected_gate.total_rows, expected_gate.kept_rows)

    cols = ["name_common", "cca2", "region", "population", "area", "landlocked", "un_member"]
    got = sorted(map(tuple, spark.table(lay.silver).select(*cols).collect()), key=repr)
    want = sorted(map(tuple, catalog.queries()["parse_json"](spark, SF).select(*cols).collect()), key=repr)
    assert got == want

    views = inspect_bronze(spark, lay, k=5)
    assert [r.batch_id for r in views["batch_inventory"].collect()] == days[::-1]
    assert views["newest_batch"].first().batch_id == days[-1]
    assert sorted(r.raw_json for r in views["payload_sample"].collect()) == sorted(
        r.raw_json for r in catalog.queries()["payload_sample"](spark, SF).collect()
    )


def test_hot_newest_batch_through_the_jobs(spark, tmp_dir):
    """A newest batch holding about a third of all rows: results stay whole."""
    from tierflow.plans.medallion import silver_to_gold, verify

    events = catalog._table(spark, SF, "events")
    bronze = catalog.bronze(spark, SF).withColumn("cca3", F.get_json_object("raw_json", "$.cca3"))
    ids = events.select(F.concat(F.lit("E"), "event_id").alias("cca3"), "event_id")
    src = bronze.join(ids, "cca3").withColumn("part", F.when(F.col("event_id") % 3 == 0, "hot").otherwise("rest"))
    root = os.path.join(tmp_dir, "hot-landing")
    src.select("part", "raw_json").write.partitionBy("part").text(root)
    lay = Layout(bronze_db="hb_bronze", silver_db="hb_silver", gold_db="hb_gold")
    ingest(spark, os.path.join(root, "part=rest"), lay, doc_layout="lines", batch_id="rest",
           as_of=dt.datetime(2024, 1, 1), validate="inline")
    ingest(spark, os.path.join(root, "part=hot"), lay, doc_layout="lines", batch_id="hot",
           as_of=dt.datetime(2024, 1, 2), validate="inline")
    hot = events.filter(F.col("event_id") % 3 == 0).count()
    log = {r.batch_id: r.record_count for r in spark.table(lay.batch_log).collect()}
    assert log == {"hot": hot, "rest": events.count() - hot}

    res = bronze_to_silver(spark, lay, max_drop=0.05)
    assert res.gate.total_rows == hot
    counts = silver_to_gold(spark, lay)
    assert counts["countries"] == res.rows
    for name in ("countries_by_region", "countries_by_continent", "population_tiers"):
        assert spark.table(lay.gold(name)).agg(F.sum("country_count")).first()[0] == res.rows
    report = {r.check: r.passed for r in verify(spark, lay, enforce=False, count_bounds=(0, 10**9)).collect()}
    assert report["reconcile(sum(country_count))"] and report["duplicate_keys(cca2)"]
