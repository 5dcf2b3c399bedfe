"""Session helpers: a local session for tests/bench and the shared checkpoint folder.

Library operators never create or look up a session themselves; they take
DataFrames. These helpers are for entry points (tests, bench, jobs).
"""

from __future__ import annotations

import os

from pyspark.sql import SparkSession

# Settings that matter for the plans we build: AQE re-plans shuffles at run time
# (coalescing small partitions, splitting skewed ones) and rebalance hints size
# output files; UTC makes day boundaries and timestamp text reproducible.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(
    cpus: int | str = "*",
    shuffle_partitions: int = 8,
    warehouse: str | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """A local-mode session configured like the cluster jobs (tests and bench only)."""
    builder = SparkSession.builder.master(f"local[{cpus}]").appName("tierflow")
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.setdefault("spark.driver.memory", os.environ.get("TIERFLOW_DRIVER_MEMORY", "8g"))
    if warehouse:
        conf["spark.sql.warehouse.dir"] = warehouse
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession, fallback: str | None = None) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this must be set to shared storage; we only fill it in from
    ``fallback`` when it is unset (local tests), never with a machine-local
    default.
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    if current:
        return current
    # a folder set earlier on the SparkContext (e.g. a test's fallback)
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    if fallback is None:
        raise RuntimeError(
            "spark.checkpoint.dir is not set; configure a shared folder for the cluster"
        )
    # ``spark.checkpoint.dir`` is a static setting (it cannot change on a
    # running session), so the fallback goes to the SparkContext instead.
    spark.sparkContext.setCheckpointDir(fallback)
    return fallback
