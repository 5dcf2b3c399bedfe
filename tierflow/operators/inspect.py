"""Inspection queries: sorts, top-k, batch inventory, KPIs.

Global sorts carry high-cardinality tie-breakers: they make the order
deterministic and let range partitioning split a hot sort key across tasks
instead of sending every tied row to one partition. ``orderBy().limit(n)``
plans as ``TakeOrderedAndProject`` (a per-task top-n, no full sort).
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import accumulate

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tierflow.functions.expressions import human_number, payload_bytes, truncate_to_long
from tierflow.operators.summaries import distinct_with_null
from tierflow.session import checkpoint_root


def _cols(cols: Sequence[Column | str]) -> list[Column]:
    return [c if isinstance(c, Column) else F.col(c) for c in cols]


def file_row_order() -> list[Column]:
    """A row's place in its parquet file: a last tie-breaker that never ties.

    ``xxhash64(_metadata.file_path)`` and ``_metadata.row_index`` identify a
    stored row whatever the partitioning, so they stay the same when lost
    tasks re-run — unlike a position id assigned after a shuffle. Only
    resolvable on a DataFrame that still sees its file scan (a table read,
    possibly filtered or projected).
    """
    return [F.xxhash64("_metadata.file_path"), F.col("_metadata.row_index")]


def _sees_file_rows(df: DataFrame) -> bool:
    try:
        df.select(*file_row_order()).schema  # analysis only, no job
        return True
    except AnalysisException:  # the metadata columns do not resolve
        return False


def sort_by(
    df: DataFrame,
    keys: Sequence[Column | str],
    tie_breakers: Sequence[Column | str] = (),
    split_copies: bool | None = None,
) -> DataFrame:
    """Global sort with tie-breakers (Spark: ascending puts NULLs first).

    Range partitioning cannot split rows whose whole sort key is equal, so
    exact copies of one key would all land in one task. ``split_copies``
    (default: whenever ``df`` still sees its file scan) appends
    ``file_row_order()`` as the last key: copies then spread over range
    partitions, and the order is total and deterministic. The added keys
    are sort-only; the output columns are ``df``'s.
    """
    extra = []
    if split_copies or (split_copies is None and _sees_file_rows(df)):
        extra = file_row_order()
    return df.orderBy(*_cols(keys), *_cols(tie_breakers), *extra)


def sort_runs(df: DataFrame, keys: Sequence[Column | str], tie_breakers: Sequence[Column | str] = (), partitions: int | None = None) -> DataFrame:
    """T1 for rows that repeat, wherever ``df`` comes from: a run-length global sort.

    Equal rows are counted first and sorted as one. Each run then has its
    positions in the whole order, which are cut into ``partitions`` equal
    ranges (default: the shuffle partitions); a run over several ranges is
    dealt to each with its share, and its copies are made only there. So
    copies are never moved, no partition is larger than another, and a row
    that is a third of all fills a third of the partitions. Partitions come
    in order, as after ``orderBy``; lost tasks give the same rows again.

    It moves the distinct rows four times and keeps them once under
    ``spark.checkpoint.dir`` while the result is built, so it is for inputs
    with many copies; ``sort_by`` moves all rows once.
    """
    parts = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = [*_cols(keys), *_cols(tie_breakers), *[F.col(f"`{c}`") for c in df.columns]]
    runs = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_n"))
    checkpoint_root(df.sparkSession)
    # kept, for another run of the same plan could draw other ranges
    ranged = runs.repartitionByRange(parts, *order).withColumn("_range", F.spark_partition_id()).checkpoint()
    sizes = {r["_range"]: r["_size"] for r in ranged.groupBy("_range").agg(F.sum("_n").alias("_size")).collect()}  # a row a range
    starts = list(accumulate((sizes.get(i, 0) for i in range(parts)), initial=0))
    inside = Window.partitionBy("_range").orderBy(*order)
    at = F.sum("_n").over(inside) - F.col("_n") + F.element_at(F.lit(starts), F.col("_range") + 1)
    placed = ranged.withColumn("_at", at).withColumn("_total", F.lit(starts[-1]).cast("long"))
    last = F.expr(f"(_at + _n - 1) * {parts} div _total")
    cut = placed.withColumn("_part", F.explode(F.sequence(F.expr(f"_at * {parts} div _total"), last)))
    begin = lambda part: F.expr(f"({part} * _total + {parts - 1}) div {parts}")
    copies = F.least(F.col("_at") + F.col("_n"), begin("(_part + 1)")) - F.greatest(F.col("_at"), begin("_part"))
    dealt = cut.select(*df.columns, "_part", copies.alias("_copies")).repartitionById(parts, F.col("_part").cast("int")).sortWithinPartitions(*order)
    return dealt.select(*df.columns, F.explode(F.expr("sequence(1L, _copies)")).alias("_copy")).drop("_copy")


def top_n(
    df: DataFrame,
    n: int,
    by: Column | str,
    columns: Sequence[str] | None = None,
    tie_breakers: Sequence[Column | str] = (),
) -> DataFrame:
    """T4: the ``n`` largest rows by ``by`` (NULLs last), projected to ``columns``."""
    measure = by if isinstance(by, Column) else F.col(by)
    out = df.select(*columns) if columns else df
    return out.orderBy(measure.desc_nulls_last(), *_cols(tie_breakers)).limit(n)


def newest_batch_meta(
    bronze: DataFrame, stamp: str = "ingested_at", batch_log: DataFrame | None = None
) -> DataFrame:
    """T5: metadata of the newest batch, one row.

    With ``batch_log`` (one row per batch: ``batch_id``, stamp, ``source_url``)
    the answer comes from that small table instead of a top-1 over bronze.
    """
    source = bronze if batch_log is None else batch_log
    return (
        source.orderBy(F.col(stamp).desc_nulls_last(), F.col("batch_id"))
        .select("batch_id", stamp, "source_url")
        .limit(1)
    )


def newest_rows_cutoff(batch_log: DataFrame, k: int, stamp: str = "ingested_at") -> Column:
    """A stamp at or after which the ``k`` newest rows lie (from the batch log), NULL if there is none.

    Each logged batch holds at least one row, so the ``k`` newest batches
    suffice: a top-k of the log, then its smallest stamp. Fewer than ``k``
    stamped batches give no bound.
    """
    newest = batch_log.select(stamp).orderBy(F.col(stamp).desc_nulls_last()).limit(k)
    return newest.agg(F.when(F.count(stamp) >= k, F.min(stamp))).scalar()


def payload_sample(
    bronze: DataFrame,
    k: int = 5,
    stamp: str = "ingested_at",
    batch_log: DataFrame | None = None,
) -> DataFrame:
    """T6 + E4: the newest ``k`` raw rows with their payload size (ties broken by payload text).

    A per-task top-``k`` (``TakeOrderedAndProject``). With ``batch_log`` the
    scan is first cut to the batches that can hold those rows
    (``newest_rows_cutoff``): a partition filter on a bronze table partitioned
    by ``batch_id``, so the payload column of older batches is never read. Rows with a NULL stamp sort last and are only reached
    when fewer than ``k`` stamped rows exist — then every batch is read.
    """
    if batch_log is not None:
        cutoff = newest_rows_cutoff(batch_log, k, stamp)
        # k ids and their ties at most; without a cut-off every batch is read and no id is gathered
        ids = batch_log.filter(F.col(stamp) >= cutoff).agg(F.collect_set("batch_id")).scalar()
        bronze = bronze.filter(cutoff.isNull() | F.array_contains(ids, F.col("batch_id")))
    return (
        bronze.withColumn("payload_bytes", payload_bytes("raw_json"))
        .select(stamp, "batch_id", "payload_bytes", "raw_json")
        .orderBy(F.col(stamp).desc_nulls_last(), F.col("raw_json"))
        .limit(k)
    )


def batch_inventory(bronze: DataFrame, batch_log: DataFrame | None = None) -> DataFrame:
    """A13 + P4 + T2: rows per batch, newest first.

    With ``batch_log`` the counts recorded at landing are read instead of
    grouping the whole bronze history.
    """
    if batch_log is not None:
        counts = batch_log.select("batch_id", "ingested_at", F.col("record_count").alias("row_count"))
    else:
        counts = bronze.groupBy("batch_id", "ingested_at").count().withColumnRenamed("count", "row_count")
    return counts.orderBy(F.col("ingested_at").desc_nulls_last(), F.col("batch_id"))


def count_per_key(df: DataFrame, key: str = "region", alias: str = "country_count") -> DataFrame:
    """A13 + P4 + T2: rows per key, largest first."""
    return (
        df.groupBy(key)
        .count()
        .withColumnRenamed("count", alias)
        .orderBy(F.col(alias).desc(), F.col(key).asc_nulls_first())
    )


def kpi_at_a_glance(silver: DataFrame) -> DataFrame:
    """A14 + A11 + F5: entities, distinct regions (NULL counts), UN members, landlocked — one pass."""
    return silver.agg(
        F.count(F.lit(1)).alias("total_countries"),
        distinct_with_null("region").alias("regions"),
        F.count_if(F.col("un_member")).alias("un_members"),
        F.count_if(F.col("landlocked")).alias("landlocked"),
    )


def _arg_max(name: str, key: str) -> Column:
    """Row with the largest non-NULL ``key``; equal keys → the greatest ``name``.

    ``max_by`` ignores NULL ordering keys, so the key struct is NULL unless
    ``key`` is set (F6); one aggregate computes every arg-max in one pass.
    """
    k = F.col(key)
    return F.max_by(F.struct(F.col(name), k), F.when(k.isNotNull(), F.struct(k, F.col(name))))


def kpi_extremes(enriched: DataFrame, by_continent: DataFrame) -> DataFrame:
    """J5 summary (T7, A12, A14): totals and the largest / most populous / densest entity."""
    continents = by_continent.agg(F.count(F.lit(1))).scalar()
    agg = enriched.agg(
        F.count(F.lit(1)).alias("total_countries"),
        F.sum("population").alias("total_population"),
        _arg_max("name_common", "area").alias("_largest"),
        _arg_max("name_common", "population").alias("_populous"),
        _arg_max("name_common", "population_density").alias("_densest"),
    )
    return agg.select(
        "total_countries",
        "total_population",
        continents.alias("num_continents"),
        F.col("_largest.name_common").alias("largest_name"),
        F.col("_largest.area").alias("largest_area"),
        F.col("_populous.name_common").alias("most_populous_name"),
        F.col("_populous.population").alias("most_populous_population"),
        F.col("_densest.name_common").alias("densest_name"),
        F.col("_densest.population_density").alias("densest_density"),
    )


def human_numbers(enriched: DataFrame) -> DataFrame:
    """E5 per entity: population, whole km² and whole people/km² as short text."""
    return enriched.select(
        "cca2",
        "name_common",
        human_number("population").alias("population_text"),
        human_number(truncate_to_long("area")).alias("area_text"),
        human_number(truncate_to_long("population_density")).alias("density_text"),
    )


def kpi_text(extremes: DataFrame) -> DataFrame:
    """The KPI card values formatted like the dashboard (one row)."""
    return extremes.select(
        F.col("total_countries").cast("string").alias("total_countries"),
        human_number("total_population").alias("world_population"),
        F.col("num_continents").cast("string").alias("continents"),
        F.col("largest_name"),
        human_number(truncate_to_long("largest_area")).alias("largest_area"),
        F.col("most_populous_name"),
        human_number(truncate_to_long("most_populous_population")).alias("most_populous_population"),
        F.col("densest_name"),
        human_number(truncate_to_long("densest_density")).alias("densest_density"),
    )
