"""Deterministic adapter: the driver's ``events`` table as country-like bronze.

The test tables hold no country records, so each event becomes one entity
record built by P10 (``to_json`` of a contract-shaped struct) and read back
by P1. Batches are calendar days of ``ts``. NULLs are injected at fixed
event-id residues so every NULL rule, the key filter and the drop gate are
exercised; every row is kept — nothing is filtered or sampled here.

The same expressions, written directly on the flat columns, are the DuckDB
oracle (``tierflow.plans.catalog``), so the oracle also proves the JSON
round trip.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tierflow.functions.stamps import to_payload
from tierflow.sources.landing import land_raw

SOURCE_URL = "table:events"

# --- fixed values: NULL-injection residues on event_id (rule exercised) ---
NULL_KEY_EVERY = 97  # cca2 → key filter and drop gate (~1 %)
NULL_REGION_EVERY = 50  # region → NULL group, null-rate rule (2 %)
NULL_POPULATION_EVERY = 83  # population → NULL tier (Micro), null-count rule
NULL_AREA_EVERY = 40  # area → "Unknown" size, NULL density
NULL_LANDLOCKED_EVERY = 31  # landlocked → NULL boolean group
# ---------------------------------------------------------------------------


def _unless(residue: int, value: str) -> str:
    return f"CASE WHEN event_id % {residue} <> 0 THEN {value} END"


# The record as one SQL expression: parsed once on the JVM side (a Column tree
# of ~50 nodes costs as many Python→JVM calls to build).
_NAME = "concat(event_type, '-', event_id)"
ENTITY_RECORD_SQL = f"""named_struct(
    'name', named_struct('common', {_NAME}, 'official', upper({_NAME})),
    'cca2', {_unless(NULL_KEY_EVERY, "CAST(event_id AS STRING)")},
    'cca3', concat('E', event_id),
    'region', {_unless(NULL_REGION_EVERY, "event_type")},
    'subregion', concat('u', user_id % 7),
    'population', {_unless(NULL_POPULATION_EVERY, "CAST(round(value * 100) AS BIGINT) * 10000")},
    'area', {_unless(NULL_AREA_EVERY, "user_id * 10000")},
    'landlocked', {_unless(NULL_LANDLOCKED_EVERY, "user_id % 3 = 0")},
    'unMember', event_type <> 'error')"""


def entity_record() -> Column:
    """The contract-shaped struct for one event (area as a whole number)."""
    return F.expr(ENTITY_RECORD_SQL)


def events_bronze(events: DataFrame, source_url: str = SOURCE_URL, keep_null_fields: bool = True) -> DataFrame:
    """``events`` → ``DataFrame[raw_json, source_url, batch_id, ingested_at]`` (one batch per day).

    Without ``keep_null_fields`` a NULL field's key is left out of the payload,
    so that records break the contract.
    """
    day = F.col("ts").cast("date")
    raw = events.select(to_payload(entity_record(), keep_null_fields).alias("raw_json"), day.alias("day"))
    return land_raw(raw, source_url, F.col("day").cast("string"), F.col("day").cast("timestamp_ntz"))


# The document of one event: no array for every 11th, else 0-3 elements, some of them null.
DOCUMENT_SQL = """CASE WHEN event_id % 11 = 0 THEN concat('{"id":', event_id, '}')
    ELSE concat('[', array_join(transform(slice(array(0, 1, 2), 1, CAST(event_id % 4 AS INT)),
        i -> CASE WHEN (event_id + i) % 5 = 0 THEN 'null' ELSE concat('{"id":', event_id, ',"i":', i, '}') END), ','), ']') END"""


def event_documents(events: DataFrame) -> DataFrame:
    """``events`` → JSON documents ``DataFrame[path, value]``, one per event."""
    return events.select(F.col("event_id").cast("string").alias("path"), F.expr(DOCUMENT_SQL).alias("value"))


#: Events in one array file.
ARRAY_ROWS = 25_000


def event_array_lines(events: DataFrame) -> DataFrame:
    """``events`` as the lines of array files (``line``, ``doc``), in order within a file.

    Every line is an element or, after each thirteenth event, two; the records
    hold brackets, quotes and escapes in strings and nest.
    """
    doc = F.expr(f"event_id div {ARRAY_ROWS}")
    note = F.when(F.col("event_id") % 5 == 1, "}],[{").when(F.col("event_id") % 5 == 2, '\\"}').when(F.col("event_id") % 5 == 3, "a\\\\").otherwise("")
    text = F.col("event_id").cast("string")
    record = F.concat(F.lit('{"id":'), text, F.lit(',"kind":"'), "event_type", F.lit('","note":"'), note, F.lit('","in":{"n":['), text, F.lit(',{"m":"}"}]}}'))
    record = F.concat(record, F.when(F.col("event_id") % 13 == 0, ", null").otherwise(""))
    inside = Window.partitionBy("doc").orderBy("event_id")
    rows = events.select("event_id", doc.alias("doc"), record.alias("record"))
    rows = rows.withColumn("first", F.row_number().over(inside) == 1).withColumn("last", F.lead("event_id").over(inside).isNull())
    line = F.concat(F.when(F.col("first"), "[").otherwise(""), "record", F.when(F.col("last"), "]").otherwise(","))
    return rows.repartition("doc").sortWithinPartitions("doc", "event_id").select(line.alias("line"), "doc")


def damaged_payloads(bronze: DataFrame) -> DataFrame:
    """``events_bronze`` with malformed payloads at fixed residues of the record's number.

    Of 20: 1 is cut off, 2 has text after the record, 3 a text for the
    population, 4 an array around the record, 5 no JSON, 6 a text for a boolean.
    """
    kind = F.expr("cast(substring(get_json_object(raw_json, '$.cca3'), 2) as long) % 20")
    raw = F.col("raw_json")
    text = (
        F.when(F.col("kind") == 1, F.expr("substring(raw_json, 1, length(raw_json) - 5)"))
        .when(F.col("kind") == 2, F.concat(raw, F.lit(" and more")))
        .when(F.col("kind") == 3, F.regexp_replace(raw, '"population":(null|-?[0-9]+)', '"population":"many"'))
        .when(F.col("kind") == 4, F.concat(F.lit("["), raw, F.lit("]")))
        .when(F.col("kind") == 5, F.lit("no record"))
        .when(F.col("kind") == 6, F.regexp_replace(raw, '"landlocked":(null|true|false)', '"landlocked":"no"'))
        .otherwise(raw)
    )
    return bronze.withColumn("kind", kind).withColumn("raw_json", text).drop("kind")
