"""Raw landing (S1, P6–P8): JSON documents → one raw-JSON row per record, stamped.

Three layouts:

* ``"array"`` — each file holds one JSON array of objects (an API dump). A
  file is one task and one string, so many files spread over many tasks.
* ``"large_array"`` — the same files and rows, but a file is read by byte
  ranges in many tasks (``large_arrays``): for arrays that no task can hold.
* ``"lines"`` — one JSON object per line; splittable, the layout to use at scale.

Elements are kept as JSON text exactly as Spark re-serialises them
(parsed as ``array<string>``): numbers keep their spelling
(``1.0`` stays ``1.0``), insignificant whitespace is dropped.
"""

from __future__ import annotations

import datetime as _dt
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tierflow.functions.stamps import load_stamp

BRONZE_COLUMNS = ("raw_json", "source_url", "batch_id", "ingested_at")


def read_documents(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """One row per file: ``path``, ``value`` (the whole text)."""
    paths = [path] if isinstance(path, str) else list(path)
    return (
        spark.read.text(paths, wholetext=True)
        .select(F.col("_metadata.file_path").alias("path"), F.col("value"))
    )


def explode_documents(docs: DataFrame, text_col: str = "value") -> DataFrame:
    """Split JSON-array documents into elements (``raw_json``), one row each.

    Carries ``doc_is_array``/``doc_size`` so a validation aggregate can be
    computed in the same pass: documents that are not one array and nothing
    else yield one row with NULL ``raw_json``; empty arrays yield one row with
    size 0. A ``null`` element is a record with the text ``null``, which the
    contract and the drop gate then judge.

    Spark's parser stops at the end of the first value and ignores what
    follows. So the text is parsed as one member of an object whose other
    member is a hash of that text: more than one array, trailing text, or text
    that closes the object itself all lose that member or add another.
    """
    mark = F.xxhash64(text_col).cast("string")
    wrapped = F.concat(F.lit('{"document":'), F.col(text_col), F.lit(',"mark":["'), mark, F.lit('"]}'))
    # a select of its own keeps it to one parse a document
    parsed = docs.select("path", mark.alias("_mark"), F.from_json(wrapped, "map<string,array<string>>").alias("_doc"))
    whole = (F.size("_doc") == 2) & (F.col("_doc")["mark"][0] == F.col("_mark"))
    arr = parsed.select("path", F.when(whole, F.col("_doc")["document"]).alias("_arr"))
    exploded = arr.select(
        "path",
        F.col("_arr").isNotNull().alias("doc_is_array"),
        F.coalesce(F.size("_arr"), F.lit(-1)).alias("doc_size"),
        F.explode_outer("_arr").alias("_element"),
    )
    record = F.when(F.col("doc_size") > 0, F.coalesce("_element", F.lit("null")))
    return exploded.select("path", "doc_is_array", "doc_size", record.alias("raw_json"))


def read_json_documents(
    spark: SparkSession, path: str | list[str], layout: str = "array"
) -> DataFrame:
    """Raw records from JSON files → ``DataFrame[path, doc_is_array, doc_size, raw_json]``."""
    if layout == "array":
        return explode_documents(read_documents(spark, path))
    if layout == "lines":
        paths = [path] if isinstance(path, str) else list(path)
        lines = spark.read.text(paths).select(
            F.col("_metadata.file_path").alias("path"), F.trim("value").alias("raw_json")
        )
        return lines.filter(F.col("raw_json") != "").select(
            "path", F.lit(True).alias("doc_is_array"), F.lit(1).alias("doc_size"), "raw_json"
        )
    if layout == "large_array":
        from tierflow.sources.large_arrays import read_large_arrays

        return read_large_arrays(spark, path)
    raise ValueError(f"unknown layout {layout!r}: expected 'array', 'large_array' or 'lines'")


def enforce_documents(metrics_row, source: str) -> None:
    """Raise like the ingest contract: not an array, or an empty array."""
    if metrics_row["non_array_docs"] > 0:
        raise ValueError(
            f"{source}: {metrics_row['non_array_docs']} document(s) are not a single JSON array"
        )
    if metrics_row["empty_docs"] > 0 or metrics_row["records"] == 0:
        raise ValueError(f"{source}: no records (empty array)")


def land_raw(
    raw: DataFrame,
    source_url: str,
    batch_id: str | Column | None = None,
    as_of: _dt.datetime | Column | None = None,
) -> DataFrame:
    """Stamp raw records as bronze rows: ``raw_json, source_url, batch_id, ingested_at``.

    ``batch_id`` is chosen once per run on the driver (default: a random
    UUID), never per row; a Column names the batch of rows that already belong
    to several. ``ingested_at`` is ``as_of`` if given, else the query's start
    time — one value for the whole query, so a batch has a single stamp.
    """
    bid = batch_id if isinstance(batch_id, Column) else F.lit(batch_id or str(uuid.uuid4()))
    return raw.select(
        F.col("raw_json"),
        F.lit(source_url).alias("source_url"),
        bid.alias("batch_id"),
        load_stamp(as_of).alias("ingested_at"),
    )
