"""The four steps (and the whole run) through the job entry point."""

import os

import pytest

from tierflow.jobs import main, parse_args
from tests.test_pipeline import _countries, _doc


def test_steps_one_by_one(spark, tmp_dir, capsys):
    src = _doc(os.path.join(tmp_dir, "jobs"), "a.json", _countries(240))
    common = ["--bronze-db", "jb", "--silver-db", "js", "--gold-db", "jg"]
    assert main(["ingest", "--source", src, "--batch-id", "job-1", *common], spark) == 0
    assert main(["refine", *common], spark) == 0
    assert main(["publish", *common], spark) == 0
    assert main(["verify", *common], spark) == 0
    out = capsys.readouterr().out
    assert "landed batch job-1: 240 records into jb.countries_raw" in out
    assert "wrote 240 rows to js.countries" in out
    assert "wrote 240 rows to jg.countries" in out
    assert "all data quality checks passed" in out
    assert spark.table("jg.countries_by_continent").count() == 3


def test_run_and_gate_option(spark, tmp_dir, capsys):
    src = _doc(os.path.join(tmp_dir, "jobrun"), "a.json", _countries(230, null_keys=5))
    common = ["--bronze-db", "jrb", "--silver-db", "jrs", "--gold-db", "jrg"]
    with pytest.raises(ValueError, match="drop gate"):
        main(["run", "--source", src, *common], spark)
    # 5/230 = 2.2 %: passes a looser gate (the row count bounds still hold: 225 rows)
    assert main(["run", "--source", src, "--max-drop", "0.03", "--validate", "inline", *common], spark) == 0
    assert "225 silver rows" in capsys.readouterr().out


def test_arguments():
    a = parse_args(["ingest", "--source", "/x", "/y", "--catalog", "main", "--validate", "inline"])
    assert (a.catalog, a.source, a.validate, a.doc_layout) == ("main", ["/x", "/y"], "inline", "array")
    with pytest.raises(SystemExit):
        parse_args(["ingest"])  # needs --source
    with pytest.raises(SystemExit):
        parse_args(["transform"])
    assert parse_args(["verify", "--row-bounds", "1", "9"]).row_bounds == [1, 9]


def test_verify_row_bounds(spark, tmp_dir, capsys):
    src = _doc(os.path.join(tmp_dir, "jobsmall"), "a.json", _countries(12))
    common = ["--bronze-db", "jsb", "--silver-db", "jss", "--gold-db", "jsg"]
    with pytest.raises(AssertionError, match="row_count_in_range"):
        main(["run", "--source", src, *common], spark)
    assert main(["verify", "--row-bounds", "10", "20", *common], spark) == 0


def test_large_array_published_together_and_compacted(spark, tmp_dir, capsys):
    src = _doc(os.path.join(tmp_dir, "joblarge"), "a.json", _countries(240))
    common = ["--bronze-db", "jlb", "--silver-db", "jls", "--gold-db", "jlg"]
    for batch in ("one", "two"):
        assert main(["run", "--source", src, "--doc-layout", "large_array", "--batch-id", batch, "--together", "--row-bounds", "240", "480", *common], spark) == 0
    assert main(["compact", *common], spark) == 0
    assert "folded 2 batches of jlb.countries_raw_batches" in capsys.readouterr().out
    assert spark.table("jlb.countries_raw_batches").count() == 2 and spark.catalog.getTable("jlg.countries").tableType == "VIEW"
    assert main(["run", "--source", src, "--batch-id", "three", "--together", *common], spark) == 0
    assert spark.table("jlg.countries").count() == 240
