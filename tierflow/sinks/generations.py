"""K2 and J3 without a gap: contents in versions, published by views.

``publish`` refreshes one name, whatever its columns: the new contents become
a table of their own, then one ``ALTER VIEW … AS`` points the view at it. (That
is one change in the catalog; ``CREATE OR REPLACE VIEW`` drops and creates.)

``publish_together`` refreshes several names at once. A pointer view holds the
current run's id, and each name's view reads its version of that run:

1. all versions are written (a failure here changes nothing that is read);
2. each view is altered to hold the former run's version and the new one, each
   under the condition that the pointer names its run, so it still shows the
   former rows;
3. one ``ALTER VIEW`` of the pointer shows all new versions.

The pointer is a view of a constant, which the optimizer folds, so a reader's
plan has the version it reads and not the other. Versions stay for readers that
have begun; ``remove_old_versions`` drops them.

A view takes the columns of the new version in step 2: until step 3 former rows
show their columns of the same name, cast where the type is another, and NULL
for the rest.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import ArrayType, DataType, MapType, StructType

from tierflow.sinks.tables import _literal, quote, table_exists, write_table

#: The name of the pointer view in a namespace.
POINTER = "current_run"
_MARK = "__run_"


def new_run_id() -> str:
    return uuid.uuid4().hex


def version_name(name: str, run_id: str) -> str:
    """The table that holds a name's contents of one run."""
    if not run_id.isalnum():
        raise ValueError(f"a run id is letters and digits, got {run_id!r}")
    return f"{name}{_MARK}{run_id}"


def _put_view(spark: SparkSession, name: str, query: str, comment: str | None = None) -> None:
    if not table_exists(spark, name):
        spark.sql(f"CREATE VIEW IF NOT EXISTS {quote(name)} AS {query}")
    else:
        if spark.catalog.getTable(name).tableType != "VIEW":
            raise ValueError(f"{name} is a table, not a published view: see adopt()")
        spark.sql(f"ALTER VIEW {quote(name)} AS {query}")
    if comment:
        spark.sql(f"ALTER VIEW {quote(name)} SET TBLPROPERTIES ('comment' = {_literal(comment)})")


def adopt(spark: SparkSession, table: str) -> None:
    """Make an existing table the first version of a published view (once; there is a gap between rename and view)."""
    version = version_name(table, new_run_id())
    spark.sql(f"ALTER TABLE {quote(table)} RENAME TO {quote('.'.join(version.split('.')[-2:]))}")
    _put_view(spark, table, f"SELECT * FROM {quote(version)}")


def write_version(df: DataFrame, name: str, run_id: str, comment: str | None = None, compact: bool = True, fmt: str = "parquet") -> int:
    """Step 1 for one name. Nobody reads the version yet, so it is written in place (no rename, which copies on object stores)."""
    return write_table(df, version_name(name, run_id), comment, compact=compact, fmt=fmt, replace="in_place")


def publish(df: DataFrame, name: str, comment: str | None = None, fmt: str = "parquet", compact: bool = True, run_id: str | None = None) -> int:
    """K2: refresh one published name, with these or other columns; the rows written."""
    spark = df.sparkSession
    run = run_id or new_run_id()
    rows = write_version(df, name, run, comment, compact, fmt)
    _put_view(spark, name, f"SELECT * FROM {quote(version_name(name, run))}", comment)
    return rows


def current_run(spark: SparkSession, pointer: str) -> str | None:
    """The run that a pointer shows."""
    return spark.table(pointer).first()["run_id"] if table_exists(spark, pointer) else None


def _plain(kind: DataType) -> bool:
    return not isinstance(kind, (StructType, ArrayType, MapType))


def _former(old: StructType, new: StructType) -> str:
    """The former version's columns as the new one has them."""
    have = {f.name: f.dataType for f in old.fields}
    out = []
    for f in new.fields:
        kind, name = f.dataType.simpleString(), f"`{f.name}`"
        was = have.get(f.name)
        if was == f.dataType:
            out.append(name)
        elif was is not None and _plain(was) and _plain(f.dataType):
            out.append(f"try_cast({name} AS {kind}) AS {name}")
        else:
            out.append(f"CAST(NULL AS {kind}) AS {name}")
    return ", ".join(out)


def publish_together(spark: SparkSession, contents: Mapping[str, tuple[DataFrame, str | None]], pointer: str, run_id: str | None = None, fmt: str = "parquet", compact: bool = True) -> dict[str, int]:
    """Refresh several published names as one run; the rows written by name."""
    run = run_id or new_run_id()
    rows = {name: write_version(df, name, run, comment, compact, fmt) for name, (df, comment) in contents.items()}
    show(spark, list(contents), pointer, run, {name: comment for name, (_, comment) in contents.items()})
    return rows


def show(spark: SparkSession, names: list[str], pointer: str, run: str, comments: Mapping[str, str | None] | None = None) -> None:
    """Steps 2 and 3 for versions that are written."""
    former = current_run(spark, pointer)
    if former is None:
        _put_view(spark, pointer, "SELECT '' AS run_id")
    is_run = lambda r: f"(SELECT run_id FROM {quote(pointer)}) = {_literal(r)}"
    for name in names:
        new = version_name(name, run)
        query = f"SELECT * FROM {quote(new)} WHERE {is_run(run)}"
        old = version_name(name, former) if former else None
        if old and former != run and table_exists(spark, old):
            columns = _former(spark.table(old).schema, spark.table(new).schema)
            query += f" UNION ALL SELECT {columns} FROM {quote(old)} WHERE {is_run(former)}"
        _put_view(spark, name, query, (comments or {}).get(name))
    _put_view(spark, pointer, f"SELECT {_literal(run)} AS run_id")


def remove_old_versions(spark: SparkSession, name: str, keep: set[str]) -> int:
    """Drop a name's versions of other runs than ``keep``; for when no reader of them is left."""
    namespace, base = name.rsplit(".", 1)
    found = [t.name for t in spark.catalog.listTables(namespace) if not t.isTemporary and t.name.startswith(base + _MARK)]
    old = [t for t in found if t[len(base + _MARK) :] not in keep]
    for t in old:
        spark.sql(f"DROP TABLE {quote(f'{namespace}.{t}')}")
    return len(old)
