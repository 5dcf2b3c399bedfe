import datetime as dt
import json
import os

import pytest

from tierflow.plans.medallion import validation_metrics
from tierflow.sources.contract import COUNTRY_CONTRACT, enforce_contract
from tierflow.sources.fixtures import load_fixture
from tierflow.sources.landing import enforce_documents, explode_documents, land_raw, read_json_documents
from tests.test_contract import SAMPLE


def _write(path, text):
    with open(path, "w") as f:
        f.write(text)
    return path


def test_array_documents_one_row_per_element(spark, tmp_dir):
    de = dict(SAMPLE, cca2="DE", area=357114.0)
    _write(os.path.join(tmp_dir, "a.json"), json.dumps([SAMPLE, de], indent=2))
    raw = read_json_documents(spark, tmp_dir, "array")
    rows = raw.collect()
    assert len(rows) == 2
    texts = sorted(r.raw_json for r in rows)
    assert all("\n" not in t for t in texts)
    assert '"area":31250.0' in texts[1] or '"area":31250.0' in texts[0]  # number spelling kept
    m = validation_metrics(raw, COUNTRY_CONTRACT).first()
    assert (m.non_array_docs, m.empty_docs, m.records, m.violating_rows) == (0, 0, 2, 0)


@pytest.mark.parametrize(
    "payload, message",
    [({"error": "message"}, "not a single JSON array"), ([], "no records"), ([{"name": "test"}], "lack required keys")],
)
def test_document_contract_cases(spark, tmp_dir, payload, message):
    _write(os.path.join(tmp_dir, "doc.json"), json.dumps(payload))
    raw = read_json_documents(spark, tmp_dir, "array")
    m = validation_metrics(raw, COUNTRY_CONTRACT).first()
    with pytest.raises(ValueError, match=message):
        enforce_documents(m, "src")
        enforce_contract(m, "src")


def test_null_elements_are_records(spark, tmp_dir):
    _write(os.path.join(tmp_dir, "doc.json"), json.dumps([SAMPLE, None, SAMPLE, None, None, SAMPLE]))
    raw = read_json_documents(spark, tmp_dir, "array")
    assert sorted(r.raw_json == "null" for r in raw.collect()) == [False] * 3 + [True] * 3
    m = validation_metrics(raw, COUNTRY_CONTRACT, "cca2").first()
    assert (m.records, m.row_count, m.violating_rows, m.keyed_rows) == (6, 6, 3, 3)
    with pytest.raises(ValueError, match="3 of 6"):
        enforce_contract(m, "src")


@pytest.mark.parametrize("text", ["[1][2]", "[1],[2]", "[1]\n[2]", "[1] xx", "[1]] xx", '[1],"mark":["k"]},{"z":[2]', '[1],"x":[2]', '[1],"document":[2]', '[1]},{"document":[2]', "null", "5", "", "[1,]"])
def test_anything_but_one_array_is_refused(spark, text):
    row = explode_documents(spark.createDataFrame([("p", text)], "path string, value string")).first()
    assert (row.doc_is_array, row.doc_size, row.raw_json) == (False, -1, None)


def test_one_parse_a_document(spark):
    docs = spark.createDataFrame([("p", "[1]")], "path string, value string")
    plan = explode_documents(docs)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json(") == 1


def test_valid_document_accepted(spark, tmp_dir):
    _write(os.path.join(tmp_dir, "doc.json"), json.dumps([SAMPLE]))
    m = validation_metrics(read_json_documents(spark, tmp_dir, "array"), COUNTRY_CONTRACT).first()
    enforce_documents(m, "src")
    enforce_contract(m, "src")


def test_json_lines_layout(spark, tmp_dir):
    _write(os.path.join(tmp_dir, "x.jsonl"), "\n".join(json.dumps(dict(SAMPLE, cca2=str(i))) for i in range(5)) + "\n\n")
    raw = read_json_documents(spark, tmp_dir, "lines")
    assert raw.count() == 5


def test_land_raw_stamps(spark):
    raw = spark.createDataFrame([(json.dumps(SAMPLE),)] * 3, "raw_json string")
    at = dt.datetime(2024, 5, 6, 12, 0)
    out = land_raw(raw, "http://x", "b-1", at)
    assert out.columns == ["raw_json", "source_url", "batch_id", "ingested_at"]
    rows = out.collect()
    assert {(r.source_url, r.batch_id, r.ingested_at) for r in rows} == {("http://x", "b-1", at)}
    live = land_raw(raw, "http://x").collect()
    assert len({r.batch_id for r in live}) == 1 and len({r.ingested_at for r in live}) == 1


def test_fixture_readers(spark, tmp_dir):
    p = _write(os.path.join(tmp_dir, "countries.json"), json.dumps([SAMPLE, dict(SAMPLE, cca2="DE")]))
    df = load_fixture(spark, p, COUNTRY_CONTRACT.schema)
    assert df.count() == 2 and df.schema["name"].dataType.fieldNames() == ["common", "official"]
    c = _write(os.path.join(tmp_dir, "x.csv"), "a,b\n1,2\n3,4\n")
    cdf = load_fixture(spark, c)
    assert [f.dataType.simpleString() for f in cdf.schema.fields] == ["string", "string"]
    with pytest.raises(ValueError, match="no reader for fixture"):
        load_fixture(spark, os.path.join(tmp_dir, "x.txt"))
