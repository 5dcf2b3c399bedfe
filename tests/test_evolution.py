"""Schema merges of batches: nested, widened, reordered, spelt otherwise, refused."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tierflow.sinks import evolution as ev
from tierflow.sinks.tables import ensure_namespace


def schema(spark, ddl):
    return spark.createDataFrame([], ddl).schema


@pytest.mark.parametrize(
    "old, new, want",
    [
        ("a int", "a bigint", "a bigint"),
        ("a bigint", "a tinyint", "a bigint"),
        ("a int", "a double", "a double"),
        ("a float", "a double", "a double"),
        ("a int, b string", "B string, A int", "a int, b string"),
        ("a struct<x:int>", "a struct<y:string,X:bigint>", "a struct<x:bigint,y:string>"),
        ("a array<struct<x:int>>", "a array<struct<x:smallint,y:array<int>>>", "a array<struct<x:int,y:array<int>>>"),
        ("a map<string,struct<x:int>>", "a map<string,struct<x:bigint,z:int>>", "a map<string,struct<x:bigint,z:int>>"),
        ("a decimal(10,2)", "a decimal(8,4)", "a decimal(12,4)"),
        ("a decimal(4,1)", "a int", "a decimal(11,1)"),
        ("a int", "b int", "a int, b int"),
        ("a void", "a struct<x:int>", "a struct<x:int>"),
        ("a timestamp_ntz", "a date", "a timestamp_ntz"),
    ],
)
def test_merges(spark, old, new, want):
    assert ev.merge(schema(spark, old), schema(spark, new)) == schema(spark, want)


@pytest.mark.parametrize(
    "old, new, where",
    [
        ("a string", "a int", "a"), ("a bigint", "a double", "a"), ("a struct<x:int>", "a int", "a"), ("a struct<x:struct<y:int>>", "a struct<x:struct<y:string>>", "a.x.y"),
        ("a array<int>", "a array<string>", r"a\[\]"), ("a map<string,int>", "a map<string,boolean>", "a value"), ("a decimal(38,2)", "a decimal(38,10)", "a"), ("a boolean", "a int", "a"),
    ],
)
def test_refusals(spark, old, new, where):
    with pytest.raises(ev.IncompatibleChange, match=f"^{where}: stored as"):
        ev.merge(schema(spark, old), schema(spark, new))


def test_batches_land_and_read_back(spark):
    ensure_namespace(spark, "evo")
    t = "evo.raw"

    def land(batch, ddl, rows):
        ev.land_evolving(spark.createDataFrame(rows, ddl), t, batch)

    land("b1", "id int, name struct<common:string>, tags array<struct<k:string>>, amount decimal(4,1)", [(1, ("one",), [("x",), None], Decimal("1.5")), (2, None, None, None)])
    land("b2", "NAME struct<official:string,Common:string>, ID int", [(("II", "two"), 3)])
    land("b3", "id bigint, tags array<struct<n:int,k:string>>, amount decimal(6,3), more date", [(2**40, [(7, "y")], Decimal("2.125"), dt.date(2024, 1, 1))])
    land("b4", "id smallint, batch_id string", [(9, "ignored")])
    assert len(ev.stores(spark, t)) == 3  # b4 needs nothing new
    rows = {(r.batch_id, r.id): r for r in spark.table(t).collect()}
    assert spark.table(t).columns == ["id", "name", "tags", "amount", "more", "batch_id"]
    first = rows["b1", 1]
    assert (first.name.common, first.name.official, first.tags[0].k, first.tags[0].n, first.tags[1], first.amount) == ("one", None, "x", None, None, Decimal("1.500"))
    assert (rows["b1", 2].name, rows["b1", 2].tags) == (None, None)
    assert (rows["b2", 3].name.common, rows["b2", 3].name.official) == ("two", "II")
    assert (rows["b3", 2**40].tags[0].n, rows["b3", 2**40].more, rows["b4", 9].amount) == (7, dt.date(2024, 1, 1), None)
    assert spark.table(t).schema["id"].dataType.simpleString() == "bigint"

    # a retried batch replaces its rows wherever they are
    land("b1", "id int", [(5,)])
    land("b1", "id int", [(5,)])
    assert [r.id for r in spark.table(t).filter("batch_id = 'b1'").collect()] == [5]
    assert spark.table(t).count() == 4

    # what cannot be merged changes nothing
    before = sorted(map(str, spark.table(t).collect()))
    for ddl, rows in (("id string", [("x",)]), ("name struct<common:int>", [((1,),)]), ("id int, ID int", [(1, 2)]), ("fresh void", [(None,)])):
        with pytest.raises(ev.IncompatibleChange):
            land("bad", ddl, rows)
    assert sorted(map(str, spark.table(t).collect())) == before and len(ev.stores(spark, t)) == 3


def test_only_the_batch_asked_for_is_read(spark):
    ensure_namespace(spark, "evo_prune")
    t = "evo_prune.raw"
    for i in range(4):
        ev.land_evolving(spark.range(3).select(F.col("id").cast("int" if i < 2 else "long").alias("id")), t, f"b{i}")
    plan = spark.table(t).filter("batch_id = 'b3'")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("PartitionFilters: [isnotnull(batch_id") == 2
