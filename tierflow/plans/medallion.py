"""The medallion run (J1–J5): ingest → refine → publish → verify (+ KPIs).

Each step is a Spark job handing off through catalog tables, which also
cuts lineage: a lost executor re-computes at most the current step from
the last written table. Gates run before writes, so a failed gate leaves
the previous table in place.
"""

from __future__ import annotations

import datetime as _dt
import uuid
import warnings
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tierflow.functions.stamps import load_stamp
from tierflow.operators import inspect, quality, summaries
from tierflow.operators.refine import (
    COUNTRY_KEY,
    COUNTRY_MAPPING,
    MAX_DROP_FRACTION,
    keyed_count,
    refine,
)
from tierflow.plans.catalog import SILVER_COUNT_MAX, SILVER_COUNT_MIN, MAX_NULL_REGION_RATE
from tierflow.plans.documented import documented_queries
from tierflow.sinks import generations
from tierflow.sinks.compaction import compact_partitions, fold, live_of
from tierflow.sinks.tables import (
    drop_batch,
    ensure_namespace,
    land_batch,
    staged,
    staging_root,
    table_exists,
    write_table,
)
from tierflow.sources.contract import COUNTRY_CONTRACT, RecordContract, enforce_contract, missing_keys
from tierflow.sources.landing import enforce_documents, land_raw, read_json_documents


@dataclass(frozen=True)
class Layout:
    """Where the eight tables live: ``[catalog.]layer.table``."""

    catalog: str | None = None
    bronze_db: str = "bronze"
    silver_db: str = "silver"
    gold_db: str = "gold"
    raw_table: str = "countries_raw"
    entity_table: str = "countries"
    fmt: str = "parquet"  # of every table: parquet, or delta where its jar is there

    def _name(self, db: str, table: str) -> str:
        return ".".join(p for p in (self.catalog, db, table) if p)

    def namespace(self, db: str) -> str:
        return ".".join(p for p in (self.catalog, db) if p)

    @property
    def bronze(self) -> str:
        return self._name(self.bronze_db, self.raw_table)

    @property
    def batch_log(self) -> str:
        """One row per landed batch (id, stamp, source, records): the commit record."""
        return self._name(self.bronze_db, f"{self.raw_table}_batches")

    @property
    def silver(self) -> str:
        return self._name(self.silver_db, self.entity_table)

    def gold(self, name: str) -> str:
        return self._name(self.gold_db, name)

    @property
    def gold_tables(self) -> dict[str, str]:
        names = [summaries.ENRICHED_NAME] + [s.name for s in summaries.GOLD_SUMMARIES]
        return {n: self.gold(n) for n in names}

    @property
    def all_tables(self) -> list[str]:
        return [self.bronze, self.silver, *self.gold_tables.values()]


# ---- J1 -------------------------------------------------------------------------
def validation_measures(contract: RecordContract, key: str | None = None) -> list[Column]:
    """The document- and record-level contract as aggregate columns over the landing input.

    With ``key``, also ``keyed_rows``: the records refine's key filter will
    keep, recorded in the batch log so the drop gate needs no second pass.
    """
    miss = missing_keys("raw_json", contract)
    has_record = F.col("raw_json").isNotNull()
    keyed = [keyed_count(contract, key).alias("keyed_rows")] if key else []
    return [
        *keyed,
        F.count_if(~F.col("doc_is_array")).alias("non_array_docs"),
        F.count_if(F.col("doc_size") == 0).alias("empty_docs"),
        F.count(F.col("raw_json")).alias("records"),
        F.count_if(has_record).alias("row_count"),
        F.count_if(has_record & (F.size(miss) > 0)).alias("violating_rows"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set(F.when(has_record, miss))))).alias(
            "missing_keys"
        ),
    ]


def validation_metrics(raw: DataFrame, contract: RecordContract, key: str | None = None) -> DataFrame:
    """Document- and record-level contract in ONE aggregate pass over the landing input."""
    return raw.agg(*validation_measures(contract, key))


@dataclass
class IngestResult:
    batch_id: str
    records: int


def ingest(
    spark: SparkSession,
    source: str | list[str],
    layout: Layout = Layout(),
    doc_layout: str = "array",
    source_url: str | None = None,
    batch_id: str | None = None,
    as_of: _dt.datetime | None = None,
    contract: RecordContract = COUNTRY_CONTRACT,
    validate: str = "inline",
    key: str | None = COUNTRY_KEY,
    tolerated: float = 0.0,
) -> IngestResult:
    """Validate the documents, then land every record as one bronze batch.

    Pass a stable ``batch_id`` (e.g. the orchestrator's run id) to make task
    retries idempotent; the default is a fresh UUID per call.

    ``validate="inline"`` (default) reads the input ONCE: the contract metrics
    are observed on the landing write itself, and a failing batch's partition,
    and nothing else, is dropped before it is ever logged — refine only sees
    logged batches, so it never reads it. ``validate="before"`` checks the
    contract in its own pass and writes nothing on failure; inline mode falls
    back to it when the batch id is already logged (a failed retry must not
    replace a committed batch). ``tolerated`` is the share of records that may
    lack required keys (see ``enforce_contract``).

    Either way the batch log records how many records carry ``key``, so
    refine's drop gate reads its counts from the log (None: not recorded).
    """
    url = source_url or (source if isinstance(source, str) else ",".join(source))
    raw = read_json_documents(spark, source, doc_layout)
    return land_records(
        spark, raw, layout, url, batch_id or str(uuid.uuid4()), as_of, contract, validate, key, tolerated
    )


def land_records(
    spark: SparkSession,
    raw: DataFrame,
    layout: Layout,
    url: str,
    bid: str,
    as_of: _dt.datetime | None = None,
    contract: RecordContract = COUNTRY_CONTRACT,
    validate: str = "inline",
    key: str | None = COUNTRY_KEY,
    tolerated: float = 0.0,
) -> IngestResult:
    """Validate and land raw records (``read_json_documents`` output) as batch ``bid``, then log it."""
    if validate not in ("before", "inline"):
        raise ValueError(f"validate must be 'before' or 'inline', got {validate!r}")
    ensure_namespace(spark, layout.namespace(layout.bronze_db))
    if validate == "inline" and not _is_logged(spark, layout, bid):
        return _ingest_inline(spark, raw, layout, url, bid, as_of, contract, key, tolerated)
    m = validation_metrics(raw, contract, key).first()
    enforce_documents(m, url)
    enforce_contract(m, url, tolerated)
    bronze = land_raw(raw.filter(F.col("raw_json").isNotNull()), url, bid, as_of)
    land_batch(bronze, layout.bronze, bid, fmt=layout.fmt)
    record_batch(spark, layout, bid, key, m["keyed_rows"] if key else None)
    return IngestResult(bid, int(m["records"]))


def _is_logged(spark: SparkSession, layout: Layout, batch_id: str) -> bool:
    if not table_exists(spark, layout.batch_log):
        return False
    logged = spark.read.table(layout.batch_log).filter(F.col("batch_id") == batch_id)
    return len(logged.select().take(1)) > 0


def _ingest_inline(
    spark: SparkSession,
    raw: DataFrame,
    layout: Layout,
    url: str,
    bid: str,
    as_of: _dt.datetime | None,
    contract: RecordContract,
    key: str | None,
    tolerated: float,
) -> IngestResult:
    """One read of the input: land with the contract observed, then commit or drop the own batch."""
    obs = Observation()
    # the metrics sit below the NULL-record filter, so rejected documents count
    watched = raw.observe(obs, *validation_measures(contract, key))
    land_batch(land_raw(watched.filter(F.col("raw_json").isNotNull()), url, bid, as_of), layout.bronze, bid, fmt=layout.fmt)
    m = obs.get
    try:
        enforce_documents(m, url)
        enforce_contract(m, url, tolerated)
    except ValueError:
        drop_batch(spark, layout.bronze, bid, fmt=layout.fmt)
        raise
    record_batch(spark, layout, bid, key, m["keyed_rows"] if key else None)
    return IngestResult(bid, int(m["records"]))


def record_batch(
    spark: SparkSession,
    layout: Layout,
    batch_id: str,
    keyed_by: str | None = None,
    keyed_rows: int | None = None,
) -> None:
    """Log a landed batch: id, stamp, source, row count (read back from bronze) and keyed count.

    The read is pruned to the batch's own partition and two narrow columns,
    so the stamp is exactly the one stored. ``keyed_rows`` (records with a
    non-NULL ``keyed_by``, counted while validating) lets refine's drop gate
    skip its own pass. Written with the same per-batch partition overwrite
    as bronze, a retried batch replaces its log row. The row is written
    after the batch lands, so it marks the batch complete.
    """
    landed = spark.read.table(layout.bronze).filter(F.col("batch_id") == batch_id)
    row = landed.groupBy("batch_id").agg(
        F.max("ingested_at").alias("ingested_at"),
        F.max("source_url").alias("source_url"),
        F.count(F.lit(1)).alias("record_count"),
        F.lit(keyed_by).cast("string").alias("keyed_by"),
        F.lit(keyed_rows).cast("long").alias("keyed_count"),
    )
    land_batch(row, live_of(spark, layout.batch_log), batch_id, fmt=layout.fmt)


@dataclass
class CompactResult:
    partitions: int
    batches: int


def compact(spark: SparkSession, layout: Layout = Layout()) -> CompactResult:
    """K5 for what landings leave behind: bronze batches of many small files, and the log's file a batch."""
    return CompactResult(len(compact_partitions(spark, layout.bronze)), compact_log(spark, layout))


def compact_log(spark: SparkSession, layout: Layout = Layout()) -> int:
    """K5: the batch log, one small file a batch, in few files; landings may go on. The batches moved."""
    return fold(spark, layout.batch_log, fmt=layout.fmt)


def unlogged_batches(spark: SparkSession, layout: Layout, at_most: int = 20) -> list[str]:
    """Batches that are in bronze but not in the log: landed by other means, or never committed.

    Refine and the inventory read logged batches only; this is how the others
    are seen. ``batch_id`` is the partition column, so no data column is read.
    """
    if not table_exists(spark, layout.batch_log):
        return []
    landed = spark.read.table(layout.bronze).select("batch_id").distinct()
    logged = spark.read.table(layout.batch_log).select("batch_id")
    return [r.batch_id for r in landed.join(logged, "batch_id", "left_anti").orderBy("batch_id").limit(at_most).collect()]


# ---- J2 -------------------------------------------------------------------------
@dataclass
class RefineResult:
    rows: int
    gate: object
    unlogged: list[str] = field(default_factory=list)  # the first batches that the log does not have


def bronze_to_silver(
    spark: SparkSession,
    layout: Layout = Layout(),
    max_drop: float = MAX_DROP_FRACTION,
    as_of: _dt.datetime | None = None,
    contract: RecordContract = COUNTRY_CONTRACT,
    mapping: Sequence[tuple[str, str]] = COUNTRY_MAPPING,
    key: str = COUNTRY_KEY,
) -> RefineResult:
    """Newest batch → drop gate (raises before writing) → typed, keyed silver."""
    bronze = spark.read.table(layout.bronze)
    log = spark.read.table(layout.batch_log) if table_exists(spark, layout.batch_log) else None
    refined = refine(
        bronze,
        contract,
        mapping,
        key,
        max_drop=max_drop,
        updated_at=load_stamp(as_of),
        batch_log=log,
    )
    unlogged = unlogged_batches(spark, layout)
    if unlogged:
        warnings.warn(f"{layout.bronze} has batches without a log row, which are not read: {unlogged}", stacklevel=2)
    ensure_namespace(spark, layout.namespace(layout.silver_db))
    rows = write_table(refined.silver, layout.silver, summaries.SILVER_COMMENT, fmt=layout.fmt)
    return RefineResult(rows, refined.gate, unlogged)


# ---- J3 -------------------------------------------------------------------------
def silver_to_gold(
    spark: SparkSession,
    layout: Layout = Layout(),
    as_of: _dt.datetime | None = None,
    one_pass: bool | None = None,
    together: bool = False,
) -> dict[str, int]:
    """The enriched table and the five summaries, each a full refresh.

    ``together`` publishes the six as one run behind views
    (``sinks.generations``): until all are written, and for readers at any
    moment, they show the former run; a namespace uses one of both ways.

    ``one_pass`` (default: when ``spark.checkpoint.dir`` is set) computes the
    five summaries in ONE grouping-sets aggregate — one scan of silver
    instead of five — stages its rows (one per group) under the checkpoint
    folder and writes each summary from that copy. Otherwise each summary
    is its own ``groupBy`` over silver.
    """
    ensure_namespace(spark, layout.namespace(layout.gold_db))
    silver = spark.read.table(layout.silver)
    stamp = load_stamp(as_of)
    run = generations.new_run_id() if together else None
    counts = {}

    def put(name: str, df: DataFrame, comment: str, compact: bool = True) -> None:
        table = layout.gold(name)
        if run:
            counts[name] = generations.write_version(df, table, run, comment, compact, layout.fmt)
        else:
            counts[name] = write_table(df, table, comment, compact=compact, fmt=layout.fmt)

    # a narrow projection of a table that is sized already needs no compaction
    put(summaries.ENRICHED_NAME, summaries.enrich(silver, stamp), summaries.ENRICHED_COMMENT, compact=False)
    if one_pass is None:
        one_pass = staging_root(spark) is not None
    if one_pass:
        groups = summaries.summary_groups(silver)
        with staged(groups.rows) as rows:
            copy = groups.with_rows(rows)
            for spec in summaries.GOLD_SUMMARIES:
                put(spec.name, copy.summary(spec.name, stamp), spec.comment)
    else:
        for spec in summaries.GOLD_SUMMARIES:
            put(spec.name, spec.build(silver, stamp), spec.comment)
    if run:
        comments = {layout.gold(spec.name): spec.comment for spec in summaries.GOLD_SUMMARIES} | {layout.gold(summaries.ENRICHED_NAME): summaries.ENRICHED_COMMENT}
        generations.show(spark, list(comments), layout.gold(generations.POINTER), run, comments)
    return counts


# ---- J4 -------------------------------------------------------------------------
def verify_report(
    spark: SparkSession,
    layout: Layout = Layout(),
    count_bounds: tuple[int, int] = (SILVER_COUNT_MIN, SILVER_COUNT_MAX),
    max_null_region_rate: float = MAX_NULL_REGION_RATE,
) -> DataFrame:
    """J4 report: every table's row count, silver rules in one pass, gold↔silver reconciliation.

    ``spark.read.table`` raises at once for a missing table. Row counts come
    from the files' footers (no column is read); the report is lazy.
    """
    tables = {t: spark.read.table(t) for t in layout.all_tables}
    silver = tables[layout.silver]
    reports = [quality.non_empty_report(quality.row_counts({t: df for t, df in tables.items() if t != layout.silver}))]
    # silver's non-empty check joins its other rules: one aggregate, one scan
    reports.append(
        quality.quality_report(
            silver,
            [
                quality.NonEmpty(),
                quality.RowCountBetween(*count_bounds),
                quality.Unique((COUNTRY_KEY,)),
                quality.NullRateAtMost("region", max_null_region_rate),
                quality.NoNulls("population"),
                quality.NoNegatives("population"),
            ],
            layout.silver,
        )
    )
    by_region = layout.gold("countries_by_region")
    reports.append(quality.reconcile_report(tables[by_region], "country_count", silver, by_region))
    return quality.union_reports(reports)


def verify(spark: SparkSession, layout: Layout = Layout(), enforce: bool = True, **kw) -> DataFrame:
    """Run the report once (one row per check) and raise if anything failed."""
    report = verify_report(spark, layout, **kw)
    rows = report.collect()  # one row per rule: bounded
    local = spark.createDataFrame(rows, report.schema)
    if enforce:
        quality.enforce(local)
    return local


# ---- J5 -------------------------------------------------------------------------
@dataclass
class RunResult:
    ingest: IngestResult
    silver_rows: int
    gold_rows: dict[str, int]
    report: DataFrame
    kpis: DataFrame = field(repr=False)
    extremes: DataFrame = field(repr=False)


def run_pipeline(
    spark: SparkSession,
    source: str | list[str],
    layout: Layout = Layout(),
    doc_layout: str = "array",
    source_url: str | None = None,
    batch_id: str | None = None,
    as_of: _dt.datetime | None = None,
    max_drop: float = MAX_DROP_FRACTION,
    count_bounds: tuple[int, int] = (SILVER_COUNT_MIN, SILVER_COUNT_MAX),
    validate: str = "inline",
    together: bool = False,
) -> RunResult:
    """The four steps in order, then the KPI frames over the written tables."""
    ing = ingest(spark, source, layout, doc_layout, source_url, batch_id, as_of, validate=validate)
    ref = bronze_to_silver(spark, layout, max_drop, as_of)
    gold_rows = silver_to_gold(spark, layout, as_of, together=together)
    report = verify(spark, layout, count_bounds=count_bounds)
    silver = spark.read.table(layout.silver)
    kpis = inspect.kpi_at_a_glance(silver)
    extremes = inspect.kpi_extremes(
        spark.read.table(layout.gold(summaries.ENRICHED_NAME)),
        spark.read.table(layout.gold("countries_by_continent")),
    )
    return RunResult(ing, ref.rows, gold_rows, report, kpis, extremes)


def inspect_bronze(spark: SparkSession, layout: Layout = Layout(), k: int = 5) -> dict[str, DataFrame]:
    """The bronze views of the run summary: batch inventory, newest batch, newest payloads.

    Answered from the batch log when there is one (the log's counts, and a
    scan pruned to the batches that can hold the ``k`` newest rows) instead
    of scanning the whole bronze history.
    """
    bronze = spark.read.table(layout.bronze)
    log = spark.read.table(layout.batch_log) if table_exists(spark, layout.batch_log) else None
    return {
        "batch_inventory": inspect.batch_inventory(bronze, log),
        "newest_batch": inspect.newest_batch_meta(bronze, batch_log=log),
        "payload_sample": inspect.payload_sample(bronze, k, batch_log=log),
    }


def documented(spark: SparkSession, layout: Layout = Layout()) -> dict[str, DataFrame]:
    """J6 over the written gold tables."""
    return documented_queries(spark, layout.gold_tables)
