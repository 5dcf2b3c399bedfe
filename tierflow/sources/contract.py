"""Versioned record contracts (S6) and the payload contract check (Q1).

A contract is a ``StructType`` with a version number; records are parsed
against it as declared, whatever the data at hand looks like. Its top-level
names are the keys a record must have.

The check is re-aimed from "inspect the first element on the driver" to a
per-row column expression, so it runs inside the scan on every row and is
aggregated like any other metric.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BooleanType,
    DoubleType,
    LongType,
    StringType,
    StructField,
    StructType,
)


@dataclass(frozen=True)
class RecordContract:
    """An explicit, versioned schema for one JSON record."""

    name: str
    version: int
    schema: StructType

    @property
    def required_keys(self) -> frozenset[str]:
        return frozenset(self.schema.fieldNames())

    def narrowed(self, *fields: str) -> RecordContract:
        """The same contract restricted to ``fields`` (e.g. only the key for a gate).

        from_json keeps or drops a record identically whether it parses one
        field or all of them, so a gate can parse just the key.
        """
        kept = [f for f in self.schema.fields if f.name in fields]
        missing = set(fields) - {f.name for f in kept}
        if missing:
            raise KeyError(f"fields not in contract {self.name}: {sorted(missing)}")
        return RecordContract(self.name, self.version, StructType(kept))

    def evolve(self, *new_fields: StructField) -> RecordContract:
        """A new version with extra (nullable) fields appended."""
        return RecordContract(
            self.name, self.version + 1, StructType(list(self.schema.fields) + list(new_fields))
        )


# --- fixed values: the country record contract, version 1 -------------------
# Field names and types must equal the upstream API payload:
#   name {common, official} string, cca2, cca3, region, subregion string,
#   population long, area double, landlocked, unMember boolean.
COUNTRY_SCHEMA_VERSION = 1
COUNTRY_CONTRACT = RecordContract(
    name="country",
    version=COUNTRY_SCHEMA_VERSION,
    schema=StructType(
        [
            StructField(
                "name",
                StructType(
                    [
                        StructField("common", StringType(), True),
                        StructField("official", StringType(), True),
                    ]
                ),
                True,
            ),
            StructField("cca2", StringType(), True),
            StructField("cca3", StringType(), True),
            StructField("region", StringType(), True),
            StructField("subregion", StringType(), True),
            StructField("population", LongType(), True),
            StructField("area", DoubleType(), True),
            StructField("landlocked", BooleanType(), True),
            StructField("unMember", BooleanType(), True),
        ]
    ),
)
# -----------------------------------------------------------------------------


def missing_keys(json_col: Column | str, contract: RecordContract) -> Column:
    """Required top-level keys absent from each JSON object, as ``array<string>``.

    A key present with a ``null`` value counts as present; extra keys are
    ignored. Text that is not a JSON object (invalid JSON, an array, a
    scalar) lacks every key.
    """
    required = F.array(*[F.lit(k) for k in sorted(contract.required_keys)])
    keys = F.json_object_keys(json_col if isinstance(json_col, Column) else F.col(json_col))
    return F.coalesce(F.array_except(required, keys), required)


def contract_metrics(
    raw: DataFrame,
    contract: RecordContract,
    json_col: str = "raw_json",
    by: list[str] | None = None,
) -> DataFrame:
    """One aggregate pass: rows, violating rows and the set of missing keys.

    ``missing_keys`` is bounded by the contract width, so collecting it is safe
    at any row count. Grouping ``by`` (e.g. batch) is a partial+final hash
    aggregate; a hot batch is pre-aggregated map-side.
    """
    miss = missing_keys(json_col, contract)
    aggs = [
        F.count(F.lit(1)).alias("row_count"),
        F.count_if(F.size(miss) > 0).alias("violating_rows"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set(miss)))).alias("missing_keys"),
    ]
    return raw.groupBy(*(by or [])).agg(*aggs)


def enforce_contract(metrics_row, source: str, tolerated: float = 0.0) -> None:
    """Raise ``ValueError`` when more than the ``tolerated`` share of records lack a key.

    The default of 0 is the strict choice: one incomplete record among any
    number refuses the batch. With a tolerance, incomplete records are landed
    and left to the drop gate.
    """
    if metrics_row["row_count"] == 0:
        raise ValueError(f"{source}: no records (empty array)")
    if metrics_row["violating_rows"] > tolerated * metrics_row["row_count"]:
        missing = sorted(metrics_row["missing_keys"])
        raise ValueError(
            f"{source}: {metrics_row['violating_rows']} of {metrics_row['row_count']} records "
            f"lack required keys, among them {missing}"
        )
