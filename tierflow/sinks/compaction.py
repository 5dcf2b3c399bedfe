"""K5 for tables that exist: small files of stored batches become few.

``compact_partitions`` rewrites partitions that hold many small files. The
files of a partition are packed first-fit by size into files of about
``target`` bytes, whole partitions are packed likewise into rewrite jobs, and
each rewritten partition is switched by ``ALTER TABLE … PARTITION … SET
LOCATION``: a reader's plan has the old files or the new ones.

``fold`` is for tables whose batches are small themselves (the batch log: one
row a batch), where a partition cannot hold less than a file. It keeps the
table as two: ``<name>__live``, partitioned by batch, takes landings;
``<name>__folded_<run>`` holds folded batches in few files. A view of the old
name shows the live batches and the folded ones that are not live, so a batch
is never seen twice nor missed while its rows are in both, and a batch that is
landed again after it was folded shows its new rows.

Landings may go on meanwhile. A partition whose files are not those that were
read is left as it is.
"""

from __future__ import annotations

import contextlib
import uuid
from collections.abc import Iterator
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierflow.sinks.tables import _literal, _location, _parts, quote, table_exists

TARGET = 128 << 20
#: Bytes that one rewrite job reads (a larger partition is a job of its own).
JOB_BYTES = 64 << 30
#: Partitions that a task of a write may have open: with any, Spark does not sort a task's rows by partition first.
WRITERS = "spark.sql.maxConcurrentOutputFileWriters"
_LIVE, _FOLDED = "__live", "__folded_"


def first_fit(sizes: dict[str, int], room: int) -> list[list[str]]:
    """Names packed into bins of ``room``, largest first; a larger one stands alone."""
    bins: list[tuple[int, list[str]]] = []
    for name, size in sorted(sizes.items(), key=lambda x: (-x[1], x[0])):
        for i, (used, names) in enumerate(bins):
            if used + size <= room:
                bins[i] = (used + size, [*names, name])
                break
        else:
            bins.append((size, [name]))
    return [names for _, names in bins]


def files_of(rows: DataFrame, column: str) -> DataFrame:
    """(batch, file, size, changed) of a table's files; reads no data column."""
    return rows.select(
        F.col(column).cast("string").alias("batch"), F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("size"), F.col("_metadata.file_modification_time").alias("changed")
    ).distinct()


def _listing(spark: SparkSession, table: str, column: str, batches: list[str] | None = None) -> dict[str, dict[str, int]]:
    rows = spark.table(table)
    if batches is not None:
        rows = rows.filter(F.col(column).isin(batches))
    found: dict[str, dict[str, int]] = {}
    for r in files_of(rows, column).collect():  # a row a file, as the driver's own file index has
        found.setdefault(r.batch, {})[f"{r.file}@{r.changed}"] = r["size"]
    return found


@contextlib.contextmanager
def _unsorted(spark: SparkSession) -> Iterator[None]:
    """For writes whose tasks have the rows of one partition each: these go to its file as they come."""
    before = spark.conf.get(WRITERS, None)
    spark.conf.set(WRITERS, "1")
    try:
        yield
    finally:
        spark.conf.unset(WRITERS) if before is None else spark.conf.set(WRITERS, before)


def compact_partitions(spark: SparkSession, table: str, column: str = "batch_id", target: int = TARGET, job_bytes: int = JOB_BYTES) -> list[str]:
    """Rewrite the partitions that first-fit packing gives fewer files; their values. Parquet tables."""
    listed = _listing(spark, table, column)
    bins = {batch: first_fit(files, target) for batch, files in listed.items() if batch is not None}
    worth = {batch: sum(listed[batch].values()) for batch, packed in bins.items() if len(packed) < len(listed[batch])}
    done = []
    for job in first_fit(worth, job_bytes):
        spark.catalog.refreshTable(table.replace("`", ""))
        place = [(file.rsplit("@", 1)[0], n) for n, names in enumerate(x for batch in job for x in bins[batch]) for file in names]
        packed = spark.createDataFrame(place, "_file string, _bin int")
        rows = spark.table(table).filter(F.col(column).isin(job)).withColumn("_file", F.col("_metadata.file_path")).join(F.broadcast(packed), "_file")
        many = 1 + max(n for _, n in place)
        root = f"{_location(spark, table).rstrip('/')}__packed_{uuid.uuid4().hex}"
        with _unsorted(spark):  # a bin is of one batch
            rows.repartitionById(many, F.col("_bin")).drop("_file", "_bin").write.partitionBy(column).parquet(root)
        # a reader of all columns tells which folder has which batch
        written = spark.read.schema(spark.table(table).schema).parquet(root)
        folders = {r.batch: unquote(r.file.rsplit("/", 1)[0]) for r in files_of(written, column).collect()}
        now = _listing(spark, table, column, job)
        for batch in job:
            if batch in folders and now.get(batch) == listed[batch]:
                spark.sql(f"ALTER TABLE {quote(table)} PARTITION (`{column}` = {_literal(batch)}) SET LOCATION {_literal(folders[batch])}")
                done.append(batch)
    spark.catalog.refreshTable(table.replace("`", ""))
    return sorted(done)


def live_of(spark: SparkSession, name: str) -> str:
    """The table that takes a name's landings."""
    return name + _LIVE if table_exists(spark, name + _LIVE) else name


def _folded(spark: SparkSession, name: str) -> list[str]:
    namespace, base = name.rsplit(".", 1)
    return [f"{namespace}.{t.name}" for t in spark.catalog.listTables(namespace) if not t.isTemporary and t.name.startswith((base + _FOLDED).lower())]


def _show(spark: SparkSession, name: str, folded: str | None, columns: list[str], column: str) -> None:
    names = ", ".join(f"`{c}`" for c in columns)
    live = quote(name + _LIVE)
    query = f"SELECT {names} FROM {live}"
    if folded:
        query += f" UNION ALL SELECT {names} FROM {quote(folded)} f LEFT ANTI JOIN (SELECT DISTINCT `{column}` AS here FROM {live}) l ON f.`{column}` = l.here"
    spark.sql(f"{'ALTER' if table_exists(spark, name) else 'CREATE'} VIEW {quote(name)} AS {query}")


def fold(spark: SparkSession, name: str, column: str = "batch_id", fmt: str = "parquet") -> int:
    """Move the live batches of a table into few files; the number of batches moved.

    The first call makes the table the live one and its name a view (between
    these two statements the name is missing; later calls have no such gap).
    """
    if not table_exists(spark, name + _LIVE):
        spark.sql(f"ALTER TABLE {quote(name)} RENAME TO {quote('.'.join(_parts(name + _LIVE)[-2:]))}")
        spark.sql(f"ALTER TABLE {quote(name + _LIVE)} RECOVER PARTITIONS")  # some catalogs keep the old paths
        _show(spark, name, None, spark.table(name + _LIVE).columns, column)
    live = name + _LIVE
    spark.catalog.refreshTable(live)
    before = _listing(spark, live, column)
    batches = [b for b in before if b is not None]
    if not batches:
        return 0
    former = _folded(spark, name)
    folded = f"{name}{_FOLDED}{uuid.uuid4().hex}".lower()
    columns = spark.table(live).columns
    # what the name shows is what must be kept: the newest rows of live and folded batches
    held = spark.table(name).select(*columns).join(spark.table(live).select(F.col(column).alias("_b")).filter(~F.col("_b").isin(batches)).distinct(), F.col(column) == F.col("_b"), "left_anti")
    held.hint("rebalance").write.format(fmt).saveAsTable(folded)
    _show(spark, name, folded, columns, column)
    spark.catalog.refreshTable(live)
    now = _listing(spark, live, column)
    moved = [b for b in batches if now.get(b) == before[b]]
    for i in range(0, len(moved), 100):  # shown from the folded table from here on
        spec = ", ".join(f"PARTITION (`{column}` = {_literal(b)})" for b in moved[i : i + 100])
        spark.sql(f"ALTER TABLE {quote(live)} DROP IF EXISTS {spec}")
    for table in former:
        spark.sql(f"DROP TABLE IF EXISTS {quote(table)}")
    return len(moved)
