"""Registered queries over the driver's test tables, with their DuckDB oracles.

Every query reads whole tables (``events``, ``orders``, ``lineitem``) and
runs the library operators on all rows; the only limits are the top-k and
sample operators, where the limit is the feature. Oracles are written
directly on the flat columns with the same adapter expressions.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierflow.operators import inspect, quality, refine, summaries
from tierflow.operators.quality import (
    NonEmpty,
    NoNegatives,
    NoNulls,
    NullRateAtMost,
    RowCountBetween,
    Unique,
)
from tierflow.plans.adapters import damaged_payloads, event_array_lines, event_documents, events_bronze
from tierflow.plans.documented import DOCUMENTED_SQL, documented_query
from tierflow.session import checkpoint_root
from tierflow.sources.contract import COUNTRY_CONTRACT, contract_metrics
from tierflow.sinks.tables import staged_files
from tierflow.sources.landing import explode_documents, read_json_documents

Query = Callable[[SparkSession, str], DataFrame]

# --- fixed values: the entity-table checks run by verify ---
SILVER_COUNT_MIN = 220
SILVER_COUNT_MAX = 260
MAX_NULL_REGION_RATE = 0.05
# ------------------------------------------------------------


def silver_rules() -> list[quality.Rule]:
    return [
        NonEmpty(),
        RowCountBetween(SILVER_COUNT_MIN, SILVER_COUNT_MAX),
        Unique(("cca2",)),
        NullRateAtMost("region", MAX_NULL_REGION_RATE),
        NoNulls("population"),
        NoNegatives("population"),
    ]


def orders_rules() -> list[quality.Rule]:
    return [
        NonEmpty(),
        Unique(("o_orderkey",)),
        NullRateAtMost("o_orderpriority", 0.05),
        NoNulls("o_custkey"),
        NoNegatives("o_totalprice"),
    ]


def lineitem_rules() -> list[quality.Rule]:
    return [
        NonEmpty(),
        Unique(("l_orderkey", "l_linenumber")),
        NullRateAtMost("l_shipdate", 0.05),
        NoNulls("l_partkey"),
        NoNegatives("l_quantity"),
        NoNegatives("l_discount"),
    ]


# ---- derived layers over the test tables -------------------------------------
def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events_bronze(_table(spark, sf_dir, "events"))


def silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every batch parsed and keyed (the registered summaries run over all of them)."""
    return refine.parse_keyed(bronze(spark, sf_dir))


def batch_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The batch log ingest would have written for the adapter's daily batches.

    One row per batch with its stamp, source, row count and the rows whose
    key parses (``refine.keyed_count``) — derived here by Spark from the
    whole bronze, as the landing does per batch.
    """
    return bronze(spark, sf_dir).groupBy("batch_id").agg(
        F.max("ingested_at").alias("ingested_at"),
        F.max("source_url").alias("source_url"),
        F.count(F.lit(1)).alias("record_count"),
        F.lit(refine.COUNTRY_KEY).alias("keyed_by"),
        refine.keyed_count().alias("keyed_count"),
    )


def gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summaries.enrich(silver(spark, sf_dir))


def gold_summary(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return summaries.SUMMARY_BY_NAME[name].build(silver(spark, sf_dir))


def _gold_view(spark: SparkSession, sf_dir: str, table: str) -> str:
    """Register one derived gold table as a temp view; return its name.

    The name carries the input folder, so views built from different inputs
    never replace each other; ``spark.sql`` resolves the view when called.
    """
    tag = hashlib.sha1(sf_dir.encode()).hexdigest()[:10]
    view = f"tf_gold_{table}_{tag}"
    df = gold(spark, sf_dir) if table == summaries.ENRICHED_NAME else gold_summary(spark, sf_dir, table)
    df.createOrReplaceTempView(view)
    return view


def _documented(name: str) -> Query:
    table = DOCUMENTED_SQL[name].split("{")[1].split("}")[0]

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return documented_query(spark, name, {table: _gold_view(spark, sf_dir, table)})

    return run


# ---- queries -------------------------------------------------------------------
def q_land_raw(spark, sf_dir):
    return bronze(spark, sf_dir)


def q_explode_documents(spark, sf_dir):
    return explode_documents(event_documents(_table(spark, sf_dir, "events")))


def q_land_large_array(spark, sf_dir):
    """``events`` written as array files, read back by byte ranges; the files are gone when this returns."""
    checkpoint_root(spark)
    with staged_files(event_array_lines(_table(spark, sf_dir, "events")), "text", ["doc"]) as folder:
        raw = read_json_documents(spark, folder, "large_array")
        doc = F.regexp_extract("path", "doc=([0-9]+)/", 1).cast("long").alias("doc")
        return raw.select(doc, "doc_is_array", "doc_size", "raw_json").checkpoint()


def q_latest_batch(spark, sf_dir):
    return refine.latest_batch(bronze(spark, sf_dir))


def q_latest_batch_meta(spark, sf_dir):
    return inspect.newest_batch_meta(bronze(spark, sf_dir))


def q_batch_inventory(spark, sf_dir):
    return inspect.batch_inventory(bronze(spark, sf_dir))


def q_payload_sample(spark, sf_dir):
    return inspect.payload_sample(bronze(spark, sf_dir), 5)


def q_batch_log(spark, sf_dir):
    return batch_log(spark, sf_dir)


def q_latest_batch_logged(spark, sf_dir):
    return refine.latest_batch(bronze(spark, sf_dir), batch_log=batch_log(spark, sf_dir))


def q_drop_rate_logged(spark, sf_dir):
    return refine.logged_gate(batch_log(spark, sf_dir), refine.COUNTRY_KEY).drop("unusable")


def q_payload_sample_logged(spark, sf_dir):
    return inspect.payload_sample(bronze(spark, sf_dir), 5, batch_log=batch_log(spark, sf_dir))


def q_batch_inventory_logged(spark, sf_dir):
    return inspect.batch_inventory(bronze(spark, sf_dir), batch_log(spark, sf_dir))


def q_parse_json(spark, sf_dir):
    return refine.parse_keyed(refine.latest_batch(bronze(spark, sf_dir)))


def q_parse_damaged(spark, sf_dir):
    return refine.parse_keyed(damaged_payloads(bronze(spark, sf_dir)))


def q_drop_rate_damaged(spark, sf_dir):
    return refine.drop_gate(damaged_payloads(bronze(spark, sf_dir)))


def q_drop_rate(spark, sf_dir):
    return refine.drop_gate(refine.latest_batch(bronze(spark, sf_dir)))


def q_contract_violations(spark, sf_dir):
    # NULL fields are left out of these payloads, so records do lack keys
    payloads = events_bronze(_table(spark, sf_dir, "events"), keep_null_fields=False)
    m = contract_metrics(payloads, COUNTRY_CONTRACT, by=["batch_id"])
    return m.select(
        "batch_id", "row_count", "violating_rows", F.size("missing_keys").alias("missing_key_count")
    )


def q_enrich(spark, sf_dir):
    return gold(spark, sf_dir)


def q_sorted_runs(spark, sf_dir):
    """Every event as its type and day only: a few rows with very many copies."""
    events = _table(spark, sf_dir, "events").select("event_type", F.to_date("ts").alias("day"))
    return inspect.sort_runs(events, ["day"], ["event_type"])


def q_sorted_entities(spark, sf_dir):
    return inspect.sort_by(silver(spark, sf_dir), ["name_common"], ["cca2"])


def q_top_n(spark, sf_dir):
    cols = [
        "name_common",
        "cca2",
        "region",
        "population",
        "area",
        "population_density",
        "size_category",
        "landlocked",
        "un_member",
    ]
    return inspect.top_n(gold(spark, sf_dir), 20, "population", cols, ["name_common"])


def q_human_numbers(spark, sf_dir):
    return inspect.human_numbers(gold(spark, sf_dir))


def _summary(name: str) -> Query:
    return lambda spark, sf_dir: gold_summary(spark, sf_dir, name)


def q_summary_groups(spark, sf_dir):
    return summaries.summary_groups(silver(spark, sf_dir)).long_form()


def q_count_per_key(spark, sf_dir):
    return inspect.count_per_key(silver(spark, sf_dir), "region", "country_count")


def q_kpi_at_a_glance(spark, sf_dir):
    return inspect.kpi_at_a_glance(silver(spark, sf_dir))


def q_kpi_extremes(spark, sf_dir):
    return inspect.kpi_extremes(gold(spark, sf_dir), gold_summary(spark, sf_dir, "countries_by_continent"))


def q_kpi_cards(spark, sf_dir):
    return inspect.kpi_text(q_kpi_extremes(spark, sf_dir))


def q_dq_nonempty(spark, sf_dir):
    # the layers are derived here, not stored: the summaries' groups are counted from one
    # grouping-sets pass, and the enriched table has a row for each silver row
    s = silver(spark, sf_dir)
    stored = quality.row_counts({"bronze.countries_raw": bronze(spark, sf_dir)})
    both = F.explode(F.array(F.lit("silver.countries"), F.lit(f"gold.{summaries.ENRICHED_NAME}"))).alias("table_name")
    entities = s.agg(F.count(F.lit(1)).alias("rows")).select(both, "rows")
    names = [spec.name for spec in summaries.GOLD_SUMMARIES]
    counts = summaries.summary_groups(s).long_form().agg(*[F.count_if(F.col("summary") == n).alias(n) for n in names])
    groups = counts.select(F.inline(F.array(*[F.struct(F.lit(f"gold.{n}").alias("table_name"), F.col(n).alias("rows")) for n in names])))
    return quality.non_empty_report(quality.union_reports([stored, entities, groups]))


def q_dq_report(spark, sf_dir):
    return quality.quality_report(silver(spark, sf_dir), silver_rules(), "silver.countries")


def q_dq_reconcile(spark, sf_dir):
    return quality.reconcile_report(
        gold_summary(spark, sf_dir, "countries_by_region"),
        "country_count",
        silver(spark, sf_dir),
        "gold.countries_by_region",
    )


def q_lineitem_summary(spark, sf_dir):
    li = _table(spark, sf_dir, "lineitem")
    return summaries.summarize(
        li,
        ["l_returnflag", "l_linestatus"],
        [
            summaries.row_count("row_count"),
            F.round(F.sum("l_quantity"), 2).alias("sum_qty"),
            F.round(F.sum("l_extendedprice"), 2).alias("sum_base_price"),
            summaries.latest("l_shipdate", "max_shipdate"),
        ],
    )


def q_orders_dq(spark, sf_dir):
    return quality.quality_report(_table(spark, sf_dir, "orders"), orders_rules(), "orders")


def q_lineitem_dq(spark, sf_dir):
    return quality.quality_report(_table(spark, sf_dir, "lineitem"), lineitem_rules(), "lineitem")


def q_duplicate_rows(spark, sf_dir):
    """Duplicates of a wide key that has none, of one that has many, and of whole rows."""
    lines, orders = _table(spark, sf_dir, "lineitem"), _table(spark, sf_dir, "orders")
    keys = [("lineitem", lines, ["l_orderkey", "l_linenumber"]), ("lineitem", lines, ["l_orderkey", "l_partkey", "l_shipdate"]), ("orders", orders, orders.columns)]
    found = [quality.duplicate_rows(df, columns).select(F.lit(name).alias("table_name"), F.lit(len(columns)).alias("columns"), "rows", "duplicates") for name, df, columns in keys]
    return found[0].unionByName(found[1]).unionByName(found[2])


def queries() -> dict[str, Query]:
    q: dict[str, Query] = {
        "land_raw": q_land_raw,
        "explode_documents": q_explode_documents,
        "land_large_array": q_land_large_array,
        "latest_batch": q_latest_batch,
        "latest_batch_meta": q_latest_batch_meta,
        "batch_inventory": q_batch_inventory,
        "payload_sample": q_payload_sample,
        "parse_json": q_parse_json,
        "drop_rate": q_drop_rate,
        "parse_damaged": q_parse_damaged,
        "drop_rate_damaged": q_drop_rate_damaged,
        "contract_violations": q_contract_violations,
        "batch_log": q_batch_log,
        "latest_batch_logged": q_latest_batch_logged,
        "drop_rate_logged": q_drop_rate_logged,
        "payload_sample_logged": q_payload_sample_logged,
        "batch_inventory_logged": q_batch_inventory_logged,
        "enrich": q_enrich,
        "sorted_entities": q_sorted_entities,
        "sorted_runs": q_sorted_runs,
        "top_n": q_top_n,
        "human_numbers": q_human_numbers,
        "by_two_keys": _summary("countries_by_region"),
        "by_one_key": _summary("countries_by_continent"),
        "tiers": _summary("population_tiers"),
        "by_key_flag": _summary("landlocked_vs_coastal"),
        "by_key_flag2": _summary("un_membership_summary"),
        "count_per_key": q_count_per_key,
        "summary_groups": q_summary_groups,
    }
    for name in DOCUMENTED_SQL:
        q[name] = _documented(name)
    q.update(
        {
            "kpi_at_a_glance": q_kpi_at_a_glance,
            "kpi_extremes": q_kpi_extremes,
            "kpi_cards": q_kpi_cards,
            "dq_nonempty": q_dq_nonempty,
            "dq_report": q_dq_report,
            "dq_reconcile": q_dq_reconcile,
            "lineitem_summary": q_lineitem_summary,
            "orders_dq": q_orders_dq,
            "lineitem_dq": q_lineitem_dq,
            "duplicate_rows": q_duplicate_rows,
        }
    )
    from tierflow.plans import runs  # which needs the jobs, and they this module

    return q | runs.QUERIES
