"""Published views: refreshes without a gap, several names as one run."""

import threading

import pytest
from pyspark.sql import functions as F

from tierflow.operators import summaries
from tierflow.plans.medallion import Layout, silver_to_gold
from tierflow.sinks import generations as gen
from tierflow.sinks.tables import ensure_namespace, table_comment, write_table


def shapes(spark, i):
    """Contents of refresh ``i``, each with other columns than the one before."""
    rows = spark.range(i + 1)
    return [rows, rows.select(F.col("id").cast("string").alias("id"), F.lit(i).alias("n")), rows.select(F.lit(i).alias("n")), rows.select(F.struct("id").alias("id"))][i % 4]


def test_a_reader_never_misses_the_table(spark):
    ensure_namespace(spark, "gen_one")
    name = "gen_one.t"
    gen.publish(shapes(spark, 0), name, "v0")
    seen, lost, stop = set(), [], threading.Event()

    def read():
        while not stop.is_set():
            try:
                seen.add(spark.table(name).count())
            except Exception as e:  # whatever it is, the test reports it
                lost.append(e)

    reader = threading.Thread(target=read)
    reader.start()
    for i in range(1, 21):
        assert gen.publish(shapes(spark, i), name, f"v{i}") == i + 1
    stop.set()
    reader.join()
    assert not lost and len(seen) > 1 and seen <= set(range(1, 22))
    assert spark.table(name).count() == 21 and table_comment(spark, name) == "v20"
    assert gen.remove_old_versions(spark, name, set()) == 21


def failing_at(monkeypatch, spark, k):
    """Fail the ``k``-th SQL statement from now on, and all after it; counts them."""
    sql, count = type(spark).sql, [0]

    def run(self, query, *a, **kw):
        count[0] += 1
        if count[0] >= k:
            raise RuntimeError("lost")
        return sql(self, query, *a, **kw)

    monkeypatch.setattr(type(spark), "sql", run)
    return count


@pytest.mark.parametrize("k", range(1, 4))
def test_failing_between_statements_keeps_the_old_contents(spark, monkeypatch, k):
    ensure_namespace(spark, "gen_fail")
    name = f"gen_fail.t{k}"
    gen.publish(spark.range(5), name, "old")
    failing_at(monkeypatch, spark, k)
    with pytest.raises(RuntimeError, match="lost"):
        gen.publish(spark.range(9).select(F.lit("x").alias("y")), name, "new")
    monkeypatch.undo()
    # statements: the version's comment, the view's query, the view's comment
    assert spark.table(name).count() == (9 if k > 2 else 5)
    assert gen.publish(spark.range(2), name) == 2 and spark.table(name).count() == 2


def test_a_table_is_not_replaced_unasked(spark):
    ensure_namespace(spark, "gen_adopt")
    write_table(spark.range(4), "gen_adopt.t", "plain")
    with pytest.raises(ValueError, match="adopt"):
        gen.publish(spark.range(2), "gen_adopt.t")
    gen.adopt(spark, "gen_adopt.t")
    assert spark.table("gen_adopt.t").count() == 4
    assert gen.publish(spark.range(2), "gen_adopt.t") == 2 and spark.table("gen_adopt.t").count() == 2
    with pytest.raises(ValueError, match="letters and digits"):
        gen.version_name("t", "a-b")


def silver(spark, n):
    return spark.range(n).select(
        F.concat(F.lit("C"), "id").alias("name_common"), F.lit("x").alias("name_official"), F.col("id").cast("string").alias("cca2"), F.lit("c").alias("cca3"),
        F.when(F.col("id") % 2 == 0, "Europe").otherwise("Asia").alias("region"), F.lit("s").alias("subregion"), F.col("id").alias("population"), F.lit(2.0).alias("area"),
        F.lit(True).alias("landlocked"), F.lit(False).alias("un_member"), F.lit("2024-01-01").cast("timestamp").alias("source_ingested_at"), F.lit("2024-01-01").cast("timestamp").alias("updated_at"),
    )


def totals(spark, lay):
    return {t: (spark.table(lay.gold(t)).count() if t == "countries" else spark.table(lay.gold(t)).agg(F.sum("country_count")).first()[0]) for t in [summaries.ENRICHED_NAME, *summaries.SUMMARY_BY_NAME]}


def test_six_tables_change_together(spark, monkeypatch):
    lay = Layout(silver_db="gen_silver", gold_db="gen_gold")
    ensure_namespace(spark, lay.silver_db)
    write_table(silver(spark, 10), lay.silver)
    silver_to_gold(spark, lay, together=True)
    assert set(totals(spark, lay).values()) == {10}
    assert table_comment(spark, lay.gold("countries")) == summaries.ENRICHED_COMMENT
    write_table(silver(spark, 30), lay.silver)
    sql, statements = type(spark).sql, []
    # count the statements of a whole run, then fail at each of them
    monkeypatch.setattr(type(spark), "sql", lambda self, q, *a, **k: (statements.append(q), sql(self, q, *a, **k))[1])
    run = gen.current_run(spark, lay.gold(gen.POINTER))
    with monkeypatch.context() as m:
        m.setattr(gen, "_put_view", lambda *a, **k: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            silver_to_gold(spark, lay, together=True)
    monkeypatch.undo()
    assert set(totals(spark, lay).values()) == {10}
    put, calls = gen._put_view, []
    for k in range(1, 8):  # six views, then the pointer
        with monkeypatch.context() as m:
            calls.clear()
            m.setattr(gen, "_put_view", lambda *a, **kw: put(*a, **kw) if not calls.append(1) and len(calls) < k else (_ for _ in ()).throw(RuntimeError("lost")))
            with pytest.raises(RuntimeError):
                silver_to_gold(spark, lay, together=True, one_pass=False) if k == 7 else gen.show(spark, [lay.gold(t) for t in totals(spark, lay)], lay.gold(gen.POINTER), run)
        assert set(totals(spark, lay).values()) == {10}
    silver_to_gold(spark, lay, together=True)
    assert set(totals(spark, lay).values()) == {30}
    now = gen.current_run(spark, lay.gold(gen.POINTER))
    assert now != run and gen.remove_old_versions(spark, lay.gold("countries"), {now}) >= 2
    plan = spark.table(lay.gold("countries_by_region"))._jdf.queryExecution().optimizedPlan().toString()
    assert "Union" not in plan and "scalar-subquery" not in plan and "run_" not in plan.lower().replace(f"__run_{now}", "")


def test_other_columns_together(spark):
    ensure_namespace(spark, "gen_set")
    pointer, a, b = "gen_set.current_run", "gen_set.a", "gen_set.b"
    gen.publish_together(spark, {a: (spark.range(3), "A"), b: (spark.range(4).select(F.lit("7").alias("x"), F.struct("id").alias("s")), None)}, pointer)
    df = spark.range(5).select(F.col("id").cast("int").alias("x"), F.lit(1).alias("s"), F.lit(2.5).alias("more"))
    for name, frame in ((a, spark.range(6)), (b, df)):
        write_table(frame, gen.version_name(name, "next"))
    with pytest.MonkeyPatch.context() as m:
        put = gen._put_view
        m.setattr(gen, "_put_view", lambda s, n, *r: put(s, n, *r) if n != pointer else (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            gen.show(spark, [a, b], pointer, "next")
    assert spark.table(a).count() == 3
    assert [tuple(r) for r in spark.table(b).collect()] == [(7, None, None)] * 4
    gen.show(spark, [a, b], pointer, "next")
    assert spark.table(a).count() == 6 and sorted(r.x for r in spark.table(b).collect()) == [0, 1, 2, 3, 4]
