import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tierflow.sources.contract import (
    COUNTRY_CONTRACT,
    contract_metrics,
    enforce_contract,
    missing_keys,
)

SAMPLE = {
    "name": {"common": "Aldor", "official": "Free Lands of Aldor"},
    "cca2": "QA",
    "cca3": "QAL",
    "region": "North",
    "subregion": "Inner North",
    "population": 4100250,
    "area": 31250.0,
    "landlocked": True,
    "unMember": False,
}
REQUIRED = set(COUNTRY_CONTRACT.schema.fieldNames())


def test_contract_fields_and_version():
    assert COUNTRY_CONTRACT.version == 1
    assert COUNTRY_CONTRACT.required_keys == frozenset(REQUIRED)
    name = COUNTRY_CONTRACT.schema["name"].dataType
    assert isinstance(name, StructType)
    assert {f.name for f in name.fields} == {"common", "official"}
    assert all(f.nullable for f in COUNTRY_CONTRACT.schema.fields)


def test_narrow_and_evolve():
    narrow = COUNTRY_CONTRACT.narrowed("cca2")
    assert narrow.schema.fieldNames() == ["cca2"]
    with pytest.raises(KeyError):
        COUNTRY_CONTRACT.narrowed("nope")
    v2 = COUNTRY_CONTRACT.evolve(StructField("capital", StringType()))
    assert v2.version == 2 and "capital" in v2.required_keys


def _missing(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "raw_json string")
    return [sorted(r[0]) for r in df.select(missing_keys("raw_json", COUNTRY_CONTRACT)).collect()]


def test_missing_keys_shapes(spark):
    with_null = dict(SAMPLE, cca2=None)
    extra = dict(SAMPLE, extra=1)
    lacking = {k: v for k, v in SAMPLE.items() if k != "area"}
    out = _missing(
        spark,
        [json.dumps(SAMPLE), json.dumps(with_null), json.dumps(extra), json.dumps(lacking),
         "not json", "[1, 2]", json.dumps({"name": "test"})],
    )
    assert out[0] == [] and out[1] == [] and out[2] == []  # null value and extra keys pass
    assert out[3] == ["area"]
    assert out[4] == sorted(REQUIRED) and out[5] == sorted(REQUIRED)
    assert out[6] == sorted(REQUIRED - {"name"})


def test_contract_metrics_and_enforce(spark):
    good = spark.createDataFrame([(json.dumps(SAMPLE),)] * 3, "raw_json string")
    row = contract_metrics(good, COUNTRY_CONTRACT).first()
    assert (row.row_count, row.violating_rows, row.missing_keys) == (3, 0, [])
    enforce_contract(row, "src")
    bad = spark.createDataFrame([(json.dumps(SAMPLE),), (json.dumps({"name": "test"}),)], "raw_json string")
    row = contract_metrics(bad, COUNTRY_CONTRACT).first()
    assert row.violating_rows == 1
    with pytest.raises(ValueError, match="lack required keys"):
        enforce_contract(row, "src")
    enforce_contract(row, "src", tolerated=0.5)
    empty = spark.createDataFrame([], "raw_json string")
    with pytest.raises(ValueError, match="no records"):
        enforce_contract(contract_metrics(empty, COUNTRY_CONTRACT).first(), "src")


def test_contract_metrics_by_batch(spark):
    df = spark.createDataFrame(
        [(json.dumps(SAMPLE), "a"), ("{}", "a"), (json.dumps(SAMPLE), "b")], "raw_json string, batch_id string"
    )
    rows = {r.batch_id: r for r in contract_metrics(df, COUNTRY_CONTRACT, by=["batch_id"]).collect()}
    assert rows["a"].violating_rows == 1 and rows["b"].violating_rows == 0
    assert len(rows["a"].missing_keys) == len(REQUIRED)
