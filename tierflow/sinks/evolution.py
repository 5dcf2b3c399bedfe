"""K1 beyond new columns: batches with nested, widened, reordered or otherwise spelt fields.

``merge`` gives the schema that two batches have in common: fields are matched
by name whatever their case, nested fields are merged likewise, numbers take
the wider type, new fields come last. A change that would lose values is
refused by name, before anything is written.

``land_evolving`` appends batches under such merges. Files keep the schema they
were written with: a batch that needs another schema than the newest *store*
(a table partitioned by batch) opens a new one, and the published view reads
all stores, each by the expressions that make its fields the common ones. The
view is altered in one statement, so readers see the table before or after.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tierflow.sinks.tables import _literal, drop_batch, quote, table_exists

_STORE = "__store_"
# Number types from narrow to wide; each reads into the later ones without loss.
_WHOLE = (T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType())
_DIGITS = {"tinyint": 3, "smallint": 5, "int": 10, "bigint": 20}


class IncompatibleChange(ValueError):
    """A batch's field cannot share a column with the stored one."""


def _merge_type(old: T.DataType, new: T.DataType, path: str) -> T.DataType:
    if old == new or isinstance(new, T.NullType):
        return old
    if isinstance(old, T.NullType):
        return new
    if isinstance(old, T.StructType) and isinstance(new, T.StructType):
        return merge(old, new, path)
    if isinstance(old, T.ArrayType) and isinstance(new, T.ArrayType):
        return T.ArrayType(_merge_type(old.elementType, new.elementType, f"{path}[]"), True)
    if isinstance(old, T.MapType) and isinstance(new, T.MapType):
        return T.MapType(_merge_type(old.keyType, new.keyType, f"{path} key"), _merge_type(old.valueType, new.valueType, f"{path} value"), True)
    if old in _WHOLE and new in _WHOLE:
        return _WHOLE[max(_WHOLE.index(old), _WHOLE.index(new))]
    floats = (T.FloatType(), T.DoubleType())
    if old in floats and new in floats:
        return T.DoubleType()
    for a, b in ((old, new), (new, old)):
        if isinstance(a, T.DoubleType) and b in _WHOLE[:3]:  # a long may not be a double without loss
            return a
        if isinstance(a, T.DecimalType) and (b in _WHOLE or isinstance(b, T.DecimalType)):
            scale = b.scale if isinstance(b, T.DecimalType) else 0
            whole = b.precision - b.scale if isinstance(b, T.DecimalType) else _DIGITS[b.simpleString()]
            precision = max(a.precision - a.scale, whole) + max(a.scale, scale)
            if precision <= 38:
                return T.DecimalType(precision, max(a.scale, scale))
        if isinstance(a, T.TimestampNTZType) and isinstance(b, T.DateType):
            return a
    raise IncompatibleChange(f"{path}: stored as {old.simpleString()}, the batch has {new.simpleString()}")


def merge(old: T.StructType, new: T.StructType, path: str = "") -> T.StructType:
    """The common schema: the old fields in their order and spelling, then the new ones."""
    dot = f"{path}." if path else ""
    for schema in (old, new):
        names = [f.name.lower() for f in schema.fields]
        twice = {n for n in names if names.count(n) > 1}
        if twice:
            raise IncompatibleChange(f"{dot}{min(twice)}: two fields that differ in case alone")
    theirs = {f.name.lower(): f for f in new.fields}
    fields = []
    for f in old.fields:
        g = theirs.pop(f.name.lower(), None)
        fields.append(T.StructField(f.name, f.dataType if g is None else _merge_type(f.dataType, g.dataType, f"{dot}{f.name}"), True))
    return T.StructType(fields + [T.StructField(g.name, g.dataType, True) for g in new.fields if g.name.lower() in theirs])


def _plain(kind: T.DataType) -> T.DataType:
    """The type with every part nullable, as files have it."""
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(f.name, _plain(f.dataType), True) for f in kind.fields])
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(_plain(kind.elementType), True)
    if isinstance(kind, T.MapType):
        return T.MapType(_plain(kind.keyType), _plain(kind.valueType), True)
    return kind


def _as(value: str, have: T.DataType, want: T.DataType, depth: int = 0) -> str:
    """SQL for a value of one type as another that it merges into."""
    have, want = _plain(have), _plain(want)
    if have == want:
        return value
    if isinstance(want, T.StructType) and isinstance(have, T.StructType):
        inner = {f.name.lower(): f for f in have.fields}
        parts = []
        for f in want.fields:
            g = inner.get(f.name.lower())
            parts.append(f"{_literal(f.name)}, " + (f"CAST(NULL AS {f.dataType.simpleString()})" if g is None else _as(f"{value}.`{g.name}`", g.dataType, f.dataType, depth)))
        return f"CASE WHEN {value} IS NOT NULL THEN named_struct({', '.join(parts)}) END"
    x, y = f"x{depth}", f"y{depth}"
    if isinstance(want, T.ArrayType) and isinstance(have, T.ArrayType):
        return f"transform({value}, {x} -> {_as(x, have.elementType, want.elementType, depth + 1)})"
    if isinstance(want, T.MapType) and isinstance(have, T.MapType):
        keys = value if have.keyType == want.keyType else f"transform_keys({value}, ({x}, {y}) -> {_as(x, have.keyType, want.keyType, depth + 1)})"
        return f"transform_values({keys}, ({x}, {y}) -> {_as(y, have.valueType, want.valueType, depth + 1)})"
    return f"CAST({value} AS {want.simpleString()})"


def conform(have: T.StructType, want: T.StructType) -> list[str]:
    """SQL expressions that give a batch's or store's columns as the merged schema has them."""
    mine = {f.name.lower(): f for f in have.fields}
    out = []
    for f in want.fields:
        g = mine.get(f.name.lower())
        out.append((f"CAST(NULL AS {f.dataType.simpleString()})" if g is None else _as(f"`{g.name}`", g.dataType, f.dataType)) + f" AS `{f.name}`")
    return out


def _schema(spark: SparkSession, table: str) -> T.StructType:
    return _plain(spark.table(table).schema)


def stores(spark: SparkSession, name: str) -> list[str]:
    """The tables behind a published name, oldest first."""
    namespace, base = name.rsplit(".", 1)
    if not spark.catalog.databaseExists(namespace):
        return []
    found = [t.name for t in spark.catalog.listTables(namespace) if not t.isTemporary and t.name.startswith((base + _STORE).lower())]
    return [f"{namespace}.{t}" for t in sorted(found, key=lambda t: int(t.rsplit("_", 1)[1]))]


def _write(df: DataFrame, store: str, batch_id: str, column: str) -> None:
    spark = df.sparkSession
    view = f"tierflow_batch_{uuid.uuid4().hex}"
    df.createOrReplaceTempView(view)
    try:
        spark.sql(f"INSERT OVERWRITE TABLE {quote(store)} PARTITION (`{column}` = {_literal(batch_id)}) SELECT * FROM {view}")
    finally:
        spark.catalog.dropTempView(view)


def land_evolving(df: DataFrame, name: str, batch_id: str, column: str = "batch_id", fmt: str = "parquet") -> None:
    """Append a batch to a published name, whatever merge its schema needs; idempotent per batch.

    ``df`` may leave ``column`` out. A retried batch replaces its rows, also
    those in an older store, which go before the new ones come.
    """
    spark = df.sparkSession
    batch = df.drop(*[c for c in df.columns if c.lower() == column.lower()])
    have = stores(spark, name)
    data = lambda s: T.StructType([f for f in _schema(spark, s).fields if f.name.lower() != column.lower()])
    common = _plain(batch.schema)
    if have:
        for s in have:  # the newest store has all fields: it was opened by the last change
            known = data(s)
        common = merge(known, common)
    void = [f.name for f in common.fields if "void" in f.dataType.simpleString()]
    if void:
        raise IncompatibleChange(f"{void[0]}: a field of NULLs only has no type yet")
    fresh = not have or common != known
    if fresh:
        store = f"{name}{_STORE}{len(have) + 1}".lower()
        fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in common.fields)
        spark.sql(f"CREATE TABLE IF NOT EXISTS {quote(store)} ({fields}, `{column}` STRING) USING {fmt} PARTITIONED BY (`{column}`)")
    else:
        store = have[-1]
    for older in have if fresh else have[:-1]:
        drop_batch(spark, older, batch_id, column, fmt)
    _write(batch.selectExpr(*conform(_plain(batch.schema), common)), store, batch_id, column)
    if fresh or not table_exists(spark, name):
        parts = [f"SELECT {', '.join(conform(data(s), common))}, `{column}` FROM {quote(s)}" for s in [*have, *([store] if fresh else [])]]
        verb = f"ALTER VIEW {quote(name)} AS" if table_exists(spark, name) else f"CREATE VIEW {quote(name)} AS"
        spark.sql(f"{verb} {' UNION ALL '.join(parts)}")
