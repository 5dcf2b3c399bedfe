"""Fixture readers (S4, S5): a JSON array file or a headered CSV → DataFrame.

JSON is read with ``multiLine`` (a file is one document); pass the contract
schema so nested records stay structs instead of inferred maps. CSV is read
with a header and no inference, so every column is a string.
"""

from __future__ import annotations

import pathlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def load_fixture(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    suffix = pathlib.PurePath(path).suffix.lower()
    if suffix == ".json":
        reader = spark.read.option("multiLine", True)
        if schema is not None:
            reader = reader.schema(schema)
        return reader.json(path)
    if suffix == ".csv":
        reader = spark.read.option("header", True).option("inferSchema", False)
        if schema is not None:
            reader = reader.schema(schema)
        return reader.csv(path)
    raise ValueError(f"no reader for fixture {path}: expected .json or .csv")
