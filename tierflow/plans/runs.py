"""Registered queries that run the jobs and table operators on the test tables.

Each lands, refines, publishes or rewrites real tables in namespaces of its own
under ``spark.checkpoint.dir``, reads what they hold, keeps that as a checkpoint
and drops the namespaces.
"""

from __future__ import annotations

import contextlib
import datetime as dt
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierflow.plans import medallion
from tierflow.plans.adapters import events_bronze
from tierflow.session import checkpoint_root
from tierflow.sinks import compaction, evolution, generations
from tierflow.sinks.tables import land_batch, quote, staged_files
from tierflow.sources.landing import land_raw

AS_OF = dt.datetime(2024, 5, 6, 8, 0)
#: Batches that the log and evolution queries land.
BATCHES = 3


@contextlib.contextmanager
def scratch_layout(spark: SparkSession) -> Iterator[medallion.Layout]:
    """The eight tables in namespaces of this run, dropped on exit."""
    tag = f"tierflow_run_{uuid.uuid4().hex}"
    root = checkpoint_root(spark).rstrip("/")
    lay = medallion.Layout(bronze_db=f"{tag}_bronze", silver_db=f"{tag}_silver", gold_db=f"{tag}_gold")
    spaces = (lay.bronze_db, lay.silver_db, lay.gold_db)
    try:
        for db in spaces:
            spark.sql(f"CREATE SCHEMA {quote(db)} LOCATION '{root}/tierflow-runs/{db}'")
        yield lay
    finally:
        for db in spaces:
            spark.sql(f"DROP SCHEMA IF EXISTS {quote(db)} CASCADE")


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


@contextlib.contextmanager
def _published(spark: SparkSession, sf_dir: str) -> Iterator[medallion.Layout]:
    """All events through ingest, refine and publish (the six gold tables as one run)."""
    payloads = events_bronze(_events(spark, sf_dir)).select(F.col("raw_json").alias("value"))
    with scratch_layout(spark) as lay, staged_files(payloads, "text") as folder:
        medallion.ingest(spark, folder, lay, doc_layout="lines", source_url="table:events", batch_id="run", as_of=AS_OF)
        medallion.bronze_to_silver(spark, lay, as_of=AS_OF)
        medallion.silver_to_gold(spark, lay, as_of=AS_OF, together=True)
        yield lay


def job_summaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What ``countries_by_region`` holds after a run."""
    with _published(spark, sf_dir) as lay:
        return spark.table(lay.gold("countries_by_region")).checkpoint()


def job_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report on a run's eight tables (their names without the namespace)."""
    with _published(spark, sf_dir) as lay:
        report = medallion.verify_report(spark, lay)
        return report.withColumn("table_name", F.regexp_replace("table_name", r"^.*_(bronze|silver|gold)\.", "$1.")).checkpoint()


def compacted_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K1, K5: three batches landed and logged, the log folded, one batch landed again."""
    number = F.expr("cast(substring(get_json_object(raw_json, '$.cca3'), 2) as long)")
    raw = events_bronze(_events(spark, sf_dir)).select("raw_json", (number % BATCHES).alias("part"))
    with scratch_layout(spark) as lay:
        for step in (*range(BATCHES), "fold", 0, "fold"):
            if step == "fold":
                medallion.compact_log(spark, lay)
                continue
            batch = f"b{step}"
            land_batch(land_raw(raw.filter(F.col("part") == step), "table:events", batch, AS_OF), lay.bronze, batch)
            medallion.record_batch(spark, lay, batch)
        compaction.compact_partitions(spark, lay.bronze)
        landed = spark.table(lay.bronze).groupBy("batch_id").agg(F.count(F.lit(1)).alias("landed"))
        return spark.table(lay.batch_log).join(landed, "batch_id").select("batch_id", "ingested_at", "source_url", "record_count", "landed").checkpoint()


def evolved_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K1: batches of three schemas under one name: narrow, then nested and respelt, then wide with a new field."""
    events = _events(spark, sf_dir)
    shapes = [
        events.select(F.col("event_id").cast("int").alias("id"), F.struct(F.col("event_type").alias("kind")).alias("what")),
        events.select(F.struct(F.col("user_id").alias("who"), F.col("event_type").alias("KIND")).alias("What"), F.col("event_id").cast("int").alias("ID")),
        events.select(F.col("event_id").alias("id"), F.struct(F.col("event_type").alias("kind")).alias("what"), F.array(F.struct(F.col("user_id").alias("n"))).alias("more")),
    ]
    with scratch_layout(spark) as lay:
        name = f"{lay.bronze_db}.evolving"
        for i, shape in enumerate(shapes):
            evolution.land_evolving(shape.filter(F.col("id") % BATCHES == i), name, f"b{i}")
        return spark.table(name).select("id", F.col("what.kind").alias("kind"), F.col("what.who").alias("who"), F.col("more")[0]["n"].alias("n"), "batch_id").checkpoint()


def published_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two names refreshed twice as one run, the second time with other columns."""
    events = _events(spark, sf_dir)
    days = events.groupBy(F.to_date("ts").alias("day")).agg(F.count(F.lit(1)).alias("events"))
    kinds = events.groupBy("event_type").agg(F.count(F.lit(1)).alias("events"))
    with scratch_layout(spark) as lay:
        names = [f"{lay.gold_db}.{n}" for n in ("days", "kinds")]
        pointer = f"{lay.gold_db}.{generations.POINTER}"
        first = {names[0]: (days.limit(0), None), names[1]: (kinds.select(F.lit("old").alias("note")), None)}
        generations.publish_together(spark, first, pointer)
        generations.publish_together(spark, {names[0]: (days, "Events by day"), names[1]: (kinds, "Events by kind")}, pointer)
        shown = [spark.table(n).select(F.lit(n.rsplit(".", 1)[1]).alias("name"), F.col(spark.table(n).columns[0]).cast("string").alias("key"), "events") for n in names]
        return shown[0].unionByName(shown[1]).checkpoint()


QUERIES = {
    "job_summaries": job_summaries,
    "job_report": job_report,
    "compacted_log": compacted_log,
    "evolved_batches": evolved_batches,
    "published_versions": published_versions,
}
