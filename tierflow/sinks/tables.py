"""Catalog tables (K1–K7) on plain Spark data sources (parquet by default).

* ``land_batch`` (K1): add a batch to an append-only table partitioned by
  ``batch_id``. New columns are added with ``ALTER TABLE … ADD COLUMNS``
  (older rows read NULL), columns the batch lacks are written as NULL.
  A retried run with the same ``batch_id`` replaces its partition instead of
  duplicating it, and no other batch is touched.
* ``write_table`` (K2, K4–K7): full refresh that replaces data and schema,
  re-applies the table comment, sizes output files with a ``rebalance`` hint
  (AQE coalesces/splits to ``advisoryPartitionSizeInBytes``) and returns the
  written row count from an ``Observation`` — no second job. The observed
  aggregate sits above the rebalance exchange, i.e. in the result stage,
  where Spark applies each task's metric update exactly once even when
  lost executors force re-computation.

With ``fmt="delta"`` (when the Delta jar is on the classpath) the native
``mergeSchema`` / ``overwriteSchema`` options and ``OPTIMIZE`` are used instead.
"""

from __future__ import annotations

import contextlib
import os
import uuid
from collections.abc import Iterator, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


#: Writer options of Delta tables: schema merge on landing, schema replacement on refresh.
DELTA_LANDING = {"mergeSchema": "true"}
DELTA_REFRESH = {"overwriteSchema": "true"}


def quote(name: str) -> str:
    """Back-quote each part of a dotted table name (``a.b`` → ```a`.`b```)."""
    return ".".join(p if p.startswith("`") else f"`{p}`" for p in name.split("."))


def ensure_namespace(spark: SparkSession, namespace: str) -> None:
    """K3: ``CREATE SCHEMA IF NOT EXISTS``."""
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {quote(namespace)}")


def set_comment(spark: SparkSession, table: str, comment: str) -> None:
    """K4: table comment (re-apply after every overwrite: parquet tables lose it)."""
    escaped = comment.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(f"COMMENT ON TABLE {quote(table)} IS '{escaped}'")


def table_exists(spark: SparkSession, table: str) -> bool:
    return spark.catalog.tableExists(table.replace("`", ""))


def _evolve(spark: SparkSession, table: str, df: DataFrame) -> list[str]:
    """Add the batch's new columns to the table; return the table's column order."""
    current = spark.table(table).schema
    names = set(current.fieldNames())
    new = [f for f in df.schema.fields if f.name not in names]
    if new:
        cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in new)
        spark.sql(f"ALTER TABLE {quote(table)} ADD COLUMNS ({cols})")
        current = spark.table(table).schema
    have = set(df.columns)
    return [
        F.col(f.name) if f.name in have else F.lit(None).cast(f.dataType).alias(f.name)
        for f in current.fields
    ]


def _literal(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def land_batch(
    df: DataFrame,
    table: str,
    batch_id: str,
    column: str = "batch_id",
    fmt: str = "parquet",
) -> None:
    """K1: append a batch with schema evolution; idempotent per batch.

    The table is created if absent (``IF NOT EXISTS``: two first writers do not
    collide) and the batch's own partition is written with a static
    ``INSERT OVERWRITE … PARTITION``, which replaces that partition alone
    whatever the session's overwrite mode. A Delta table gets the same effect
    from ``replaceWhere`` on the batch.
    """
    spark = df.sparkSession
    if fmt == "delta":
        writer = df.write.format("delta").mode("overwrite").partitionBy(column)
        for key, value in DELTA_LANDING.items():
            writer = writer.option(key, value)
        writer.option("replaceWhere", f"{column} = {_literal(batch_id)}").saveAsTable(table)
        return
    if not table_exists(spark, table):
        others = [f for f in df.schema.fields if f.name != column]
        cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in [*others, df.schema[column]])
        spark.sql(f"CREATE TABLE IF NOT EXISTS {quote(table)} ({cols}) USING {fmt} PARTITIONED BY (`{column}`)")
    aligned = df.select(*_evolve(spark, table, df)).drop(column)
    view = f"tierflow_batch_{uuid.uuid4().hex}"
    aligned.createOrReplaceTempView(view)
    try:
        spark.sql(f"INSERT OVERWRITE TABLE {quote(table)} PARTITION (`{column}` = {_literal(batch_id)}) SELECT * FROM {view}")
    finally:
        spark.catalog.dropTempView(view)


def drop_batch(spark: SparkSession, table: str, batch_id: str, column: str = "batch_id", fmt: str = "parquet") -> None:
    """Remove one batch and nothing else."""
    if fmt == "delta":
        spark.sql(f"DELETE FROM {quote(table)} WHERE `{column}` = {_literal(batch_id)}")
    else:
        spark.sql(f"ALTER TABLE {quote(table)} DROP IF EXISTS PARTITION (`{column}` = {_literal(batch_id)})")


def write_table(
    df: DataFrame,
    table: str,
    comment: str | None = None,
    compact: bool = True,
    fmt: str = "parquet",
    partition_by: Sequence[str] = (),
    replace: str = "swap",
) -> int:
    """K7 = K2 + K4 + K5 + K6: overwrite (schema too), comment, rebalance, observed count.

    ``replace="swap"`` (parquet default) writes the new contents to a folder
    of this run beside the old one. When that job has succeeded, a table with
    the same columns is pointed at it by one ``ALTER TABLE … SET LOCATION``:
    there is no moment without a table, a failure before it leaves the old
    contents, and no data is copied. With other columns (or for a partitioned
    table) the new contents become a table of this run's own name first, which
    then takes the old one's place by drop and rename. A table may be refreshed from
    itself. The folder that was replaced stays until ``remove_old_versions``.
    ``replace="in_place"`` is Spark's plain overwrite, which drops the table
    before writing and refuses a plan that reads it. Delta overwrites
    atomically by itself (and is compacted by ``OPTIMIZE``), so
    ``fmt="delta"`` always writes in place.
    """
    if replace not in ("swap", "in_place"):
        raise ValueError(f"replace must be 'swap' or 'in_place', got {replace!r}")
    spark = df.sparkSession
    obs = Observation()
    out = df.hint("rebalance") if compact else df
    out = out.observe(obs, F.count(F.lit(1)).alias("rows"))
    if replace == "in_place" or fmt == "delta":
        writer = out.write.format(fmt).mode("overwrite").partitionBy(*partition_by)
        for key, value in (DELTA_REFRESH if fmt == "delta" else {}).items():
            writer = writer.option(key, value)
        writer.saveAsTable(table)
        if fmt == "delta" and compact:
            spark.sql(f"OPTIMIZE {quote(table)}")
    elif not partition_by and _same_columns(spark, table, df):
        path = f"{_location(spark, table).rstrip('/')}__{uuid.uuid4().hex}"
        if "__" in os.path.basename(_location(spark, table)):  # a version already: replace its suffix
            path = f"{_location(spark, table).rsplit('__', 1)[0]}__{uuid.uuid4().hex}"
        out.write.format(fmt).save(path)
        spark.sql(f"ALTER TABLE {quote(table)} SET LOCATION {_literal(path)}")
        spark.catalog.refreshTable(table.replace("`", ""))
    else:
        target = _beside(table)
        out.write.format(fmt).mode("overwrite").partitionBy(*partition_by).saveAsTable(target)
        spark.sql(f"DROP TABLE IF EXISTS {quote(table)}")
        # the new name stays in the same namespace: give RENAME TO [db.]name only
        spark.sql(f"ALTER TABLE {quote(target)} RENAME TO {quote('.'.join(_parts(table)[-2:]))}")
        if partition_by:
            # some catalogs move the folder but keep the old partition paths
            spark.sql(f"ALTER TABLE {quote(table)} RECOVER PARTITIONS")
    if comment:
        set_comment(spark, table, comment)
    return int(obs.get["rows"])


def _same_columns(spark: SparkSession, table: str, df: DataFrame) -> bool:
    if not table_exists(spark, table):
        return False
    have = [(f.name, f.dataType) for f in spark.table(table).schema.fields]
    return have == [(f.name, f.dataType) for f in df.schema.fields] and not any(c.isPartition for c in spark.catalog.listColumns(table.replace("`", "")))


def _location(spark: SparkSession, table: str) -> str:
    """Where a table's files are."""
    return spark.sql(f"DESCRIBE TABLE EXTENDED {quote(table)}").filter("col_name = 'Location'").first()["data_type"]


def remove_old_versions(spark: SparkSession, table: str) -> int:
    """Delete the folders of earlier refreshes of a table; for when no reader of them is left."""
    current = _location(spark, table)
    base = current.rsplit("__", 1)[0] if "__" in os.path.basename(current) else current
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(base)
    files = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = files.globStatus(jvm.org.apache.hadoop.fs.Path(base + "{,__" + "[0-9a-f]" * 32 + "}")) or []
    now = jvm.org.apache.hadoop.fs.Path(current)
    old = [f.getPath() for f in found if f.getPath().toUri().getPath() != now.toUri().getPath()]
    for path in old:
        files.delete(path, True)
    return len(old)


def _parts(name: str) -> list[str]:
    return [p.strip("`") for p in name.split(".")]


def _beside(table: str) -> str:
    """``[catalog.]db.name`` → a name of this run's own in the same namespace."""
    parts = _parts(table)
    return ".".join(parts[:-1] + [f"{parts[-1]}_next_{uuid.uuid4().hex}"])


def table_comment(spark: SparkSession, table: str) -> str | None:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {quote(table)}").filter("col_name = 'Comment'").collect()
    return rows[0]["data_type"] if rows else None


def staging_root(spark: SparkSession) -> str | None:
    """The shared folder named by ``spark.checkpoint.dir`` (None when unset).

    Falls back to the SparkContext's checkpoint folder when a test set only that.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root
    return spark.sparkContext.getCheckpointDir() or None


STAGING_NAMESPACE = "tierflow_staging"


@contextlib.contextmanager
def _staged_table(df: DataFrame, fmt: str, partition_by: Sequence[str] = ()) -> Iterator[str]:
    spark = df.sparkSession
    root = staging_root(spark)
    if not root:
        raise RuntimeError("spark.checkpoint.dir is not set; staging needs a shared folder")
    folder = f"{root.rstrip('/')}/tierflow-staging-db"
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {STAGING_NAMESPACE} LOCATION '{folder}'")
    name = f"{STAGING_NAMESPACE}.stage_{uuid.uuid4().hex}"
    df.write.format(fmt).partitionBy(*partition_by).saveAsTable(name)
    try:
        yield name
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


@contextlib.contextmanager
def staged(df: DataFrame, fmt: str = "parquet") -> Iterator[DataFrame]:
    """Write ``df`` once as a managed table under ``spark.checkpoint.dir``; drop it on exit.

    The staging namespace is created with its location inside the
    checkpoint folder, so the copy lives on the shared storage the cluster
    names, and ``DROP TABLE`` on exit removes its files — for intermediates
    consumed by several writes inside the ``with`` block.
    """
    with _staged_table(df, fmt) as name:
        yield df.sparkSession.read.table(name)


@contextlib.contextmanager
def staged_files(df: DataFrame, fmt: str, partition_by: Sequence[str] = ()) -> Iterator[str]:
    """Like ``staged``, for readers of files: yields the folder."""
    with _staged_table(df, fmt, partition_by) as name:
        yield _location(df.sparkSession, name)
