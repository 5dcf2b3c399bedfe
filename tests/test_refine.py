import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from tierflow.operators.refine import (
    drop_gate,
    enforce_drop_gate,
    keep_keyed,
    latest_batch,
    parse_records,
    refine,
)
from tierflow.plans.catalog import bronze as events_bronze
from tests.test_contract import SAMPLE

T1 = dt.datetime(2024, 1, 1)
T2 = dt.datetime(2024, 1, 2)
SCHEMA = "raw_json string, source_url string, batch_id string, ingested_at timestamp"


def _bronze(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def _rec(**kw):
    return json.dumps(dict(SAMPLE, **kw))


def test_latest_batch_keeps_newest_and_ties(spark):
    rows = [
        (_rec(cca2="A"), "u", "b1", T1),
        (_rec(cca2="B"), "u", "b2", T2),
        (_rec(cca2="C"), "u", "b3", T2),  # same stamp: both newest batches kept
        (_rec(cca2="D"), "u", "b0", None),  # NULL stamp never matches
    ]
    out = latest_batch(_bronze(spark, rows)).select("batch_id").collect()
    assert sorted(r.batch_id for r in out) == ["b2", "b3"]


def test_latest_batch_pushes_filter_into_scan(spark, tmp_dir):
    path = f"{tmp_dir}/bronze"
    _bronze(spark, [(_rec(), "u", "b1", T1), (_rec(), "u", "b2", T2)]).write.parquet(path)
    plan = latest_batch(spark.read.parquet(path))._jdf.queryExecution().executedPlan().toString()
    assert "ScalarSubquery" in plan and "PushedFilters" in plan


def _scan_metrics(df, table):
    """Metrics of the executed scan of ``table`` (walks into AQE query stages).

    Call on a DataFrame that has not run yet: a re-run reports zeros.
    """
    qe = df._jdf.queryExecution()
    df.collect()

    def walk(p):
        yield p
        if p.nodeName().endswith("QueryStage") or p.nodeName() == "AdaptiveSparkPlan":
            for attr in ("plan", "executedPlan"):
                try:
                    yield from walk(getattr(p, attr)())
                    break
                except Exception:
                    pass
        kids = p.children()
        for i in range(kids.size()):
            yield from walk(kids.apply(i))

    for node in walk(qe.executedPlan()):
        if node.nodeName().startswith("Scan parquet") and node.nodeName().endswith(table):
            m = node.metrics()
            return {k: m.apply(k).value() for k in ("numPartitions", "numFiles") if m.contains(k)}
    raise AssertionError(f"no scan of {table}")


def test_latest_batch_from_log_prunes_partitions(spark, tmp_dir):
    spark.sql("CREATE SCHEMA IF NOT EXISTS lg")
    rows = [(_rec(cca2=f"K{i}"), "u", f"b{i % 4}", [T1, T1, T2, T2][i % 4]) for i in range(40)]
    rows.append((_rec(cca2="N"), "u", "b9", None))
    bronze = _bronze(spark, rows)
    bronze.write.partitionBy("batch_id").saveAsTable("lg.raw")
    # b9 (NULL stamp) is logged too; an unlogged batch would not be "committed"
    bronze.groupBy("batch_id").agg(F.max("ingested_at").alias("ingested_at")).write.saveAsTable("lg.raw_batches")
    table, log = spark.table("lg.raw"), spark.table("lg.raw_batches")
    with_log = latest_batch(table, batch_log=log)
    plain = latest_batch(table)
    key = lambda df: sorted((r.batch_id, r.raw_json) for r in df.collect())
    assert key(with_log) == key(plain)
    assert {b for b, _ in key(with_log)} == {"b2", "b3"}
    # only the two newest partitions (of five) are read (metrics: first run of a fresh plan)
    assert _scan_metrics(latest_batch(table, batch_log=log), "lg.raw")["numPartitions"] == 2
    assert _scan_metrics(latest_batch(table), "lg.raw")["numPartitions"] == 5


def test_latest_batch_from_empty_log_keeps_nothing(spark):
    rows = [(_rec(cca2="A"), "u", "b1", T1)]
    log = spark.createDataFrame([], "batch_id string, ingested_at timestamp")
    assert latest_batch(_bronze(spark, rows), batch_log=log).count() == 0


def test_parse_records_malformed_shapes(spark):
    shapes = [
        _rec(),
        "not json",
        "null",
        "[1,2]",
        "",
        _rec(population="oops"),
        _rec(population=1.7),
        _rec(area="4"),
        _rec(landlocked="true"),
        _rec(cca2=5),
        _rec(area=2),
        json.dumps(SAMPLE)[:-5],  # truncated → whole record NULL
        json.dumps(SAMPLE) + "garbage",
        json.dumps({k.upper(): v for k, v in SAMPLE.items()}),  # keys are case-sensitive
    ]
    df = _bronze(spark, [(s, "u", "b", T1) for s in shapes])
    rows = parse_records(df).collect()
    assert rows[0].cca2 == "QA" and rows[0].un_member is False and rows[0].name_common == "Aldor"
    for i in (1, 2, 3, 4, 11, 13):
        assert rows[i].cca2 is None, i
    assert rows[5].population is None and rows[5].cca2 == "QA"
    assert rows[6].population is None
    assert rows[7].area is None
    assert rows[8].landlocked is None
    assert rows[9].cca2 == "5"
    assert rows[10].area == 2.0
    assert rows[12].cca2 == "QA"
    assert rows[0].source_ingested_at == T1
    kept = keep_keyed(parse_records(df)).count()
    assert kept == len(shapes) - 6


def test_empty_string_key_is_kept(spark):
    df = _bronze(spark, [(_rec(cca2=""), "u", "b", T1)])
    assert keep_keyed(parse_records(df)).count() == 1


@pytest.mark.parametrize(
    "total, dropped, passed", [(50, 0, True), (50, 1, True), (100, 2, True), (100, 3, False), (50, 2, False)]
)
def test_drop_gate_threshold(spark, total, dropped, passed):
    rows = [(_rec(cca2=None if i < dropped else str(i)), "u", "b", T1) for i in range(total)]
    g = drop_gate(_bronze(spark, rows)).first()
    assert (g.total_rows, g.kept_rows, g.dropped_rows) == (total, total - dropped, dropped)
    assert g.passed is passed
    if passed:
        enforce_drop_gate(g)
    else:
        with pytest.raises(ValueError, match="at most 0.0200 may go"):
            enforce_drop_gate(g)


def test_drop_gate_skipped_on_empty(spark):
    g = drop_gate(_bronze(spark, [])).first()
    assert g.total_rows == 0 and g.passed and g.drop_fraction is None
    enforce_drop_gate(g)


def test_refine_empty_bronze_gives_empty_silver(spark):
    r = refine(_bronze(spark, []), updated_at=F.current_timestamp())
    assert r.silver.count() == 0


def test_smallest_scale_newest_batch_fails_gate(spark):
    """sf0.001's newest batch drops 1 of 40 rows (2.5 %) — the gate's failing case."""
    b = events_bronze(spark, "/root/testdata/sf0.001")
    with pytest.raises(ValueError, match="dropped 1/40"):
        refine(b)
    ok = refine(events_bronze(spark, "/root/testdata/sf0.01"))
    assert ok.gate.total_rows == 329 and ok.gate.passed
    assert ok.silver.count() == 325


def test_refine_output_columns(spark):
    df = _bronze(spark, [(_rec(), "u", "b", T1)])
    cols = refine(df, updated_at=F.current_timestamp()).silver.columns
    assert cols == [
        "name_common", "name_official", "cca2", "cca3", "region", "subregion", "population",
        "area", "landlocked", "un_member", "source_ingested_at", "updated_at",
    ]


def test_gate_from_the_batch_log(spark):
    from tierflow.operators.refine import logged_gate

    rows = [(_rec(cca2=None if i < 3 else f"K{i}"), "u", "b2", T2) for i in range(100)]
    rows += [(_rec(cca2="OLD"), "u", "b1", T1)]
    bronze = _bronze(spark, rows)
    schema = "batch_id string, ingested_at timestamp, record_count long, keyed_by string, keyed_count long"
    log = spark.createDataFrame([("b2", T2, 100, "cca2", 97), ("b1", T1, 1, "cca2", 1)], schema)
    from_log = logged_gate(log, "cca2").first()
    from_data = drop_gate(latest_batch(bronze)).first()
    assert tuple(from_log) == (*tuple(from_data), 0)
    assert (from_log.total_rows, from_log.kept_rows, from_log.passed) == (100, 97, False)
    # counts recorded for another key, missing counts, or an old log shape: not usable
    assert logged_gate(log, "cca3").first().unusable > 0
    assert logged_gate(spark.createDataFrame([("b2", T2, 100, "cca2", None)], schema), "cca2").first().unusable == 1
    assert logged_gate(log.drop("keyed_by", "keyed_count"), "cca2").first().unusable > 0
    # refine takes the log's counts (here they disagree with the data on purpose)
    lying = spark.createDataFrame([("b2", T2, 100, "cca2", 100)], schema)
    assert refine(bronze, batch_log=lying).gate.dropped_rows == 0
    with pytest.raises(ValueError, match="dropped 3/100"):
        refine(bronze, batch_log=log.filter("batch_id = 'b2'").withColumn("keyed_by", F.lit("x")))
