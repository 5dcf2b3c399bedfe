"""tierflow — layered (bronze → silver → gold) batch analytics on Spark DataFrames.

Every operator takes and returns a DataFrame (or a Column) and leaves the
physical plan to Catalyst and AQE. Only ``tierflow.sinks`` and
``tierflow.plans.medallion`` touch the catalog.
"""

from tierflow.functions.expressions import (
    bucketize,
    guarded_ratio,
    human_number,
    payload_bytes,
    population_tier,
    size_category,
)
from tierflow.operators.quality import enforce, non_empty_report, quality_report, reconcile_report
from tierflow.operators.refine import drop_gate, latest_batch, logged_gate, parse_records, refine
from tierflow.operators.summaries import enrich, summarize, summary_groups
from tierflow.sources.contract import COUNTRY_CONTRACT, RecordContract
from tierflow.sources.landing import land_raw, read_json_documents

__all__ = [
    "COUNTRY_CONTRACT",
    "RecordContract",
    "bucketize",
    "drop_gate",
    "enforce",
    "enrich",
    "guarded_ratio",
    "human_number",
    "land_raw",
    "latest_batch",
    "logged_gate",
    "non_empty_report",
    "parse_records",
    "payload_bytes",
    "population_tier",
    "quality_report",
    "read_json_documents",
    "reconcile_report",
    "refine",
    "size_category",
    "summarize",
    "summary_groups",
]
