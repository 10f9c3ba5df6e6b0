"""Spark session and cluster-level settings.

Library code never creates its own session when one exists: it reads the
session it is given.  ``build_session`` is for tests, the benchmark and local
runs only.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every session of ours wants.  AQE re-plans joins and coalesces
# small shuffle partitions at runtime; skew-join splits hot partitions.
DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # keep compiled whole-stage code for the ~40 query shapes instead of recompiling
    "spark.sql.codegen.cache.maxEntries": "2000",
}


# Partitions that scans of the driver's tables are spread over; unset: as the scan makes them.
SCAN_PARTITIONS = "spark.sentimill.scanPartitions"


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app_name: str = "sentimill", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for written intermediate tables.

    A cluster names it in ``spark.checkpoint.dir``; we read that.  Where none is set, a local session
    (as in tests) uses a folder of the warehouse; on a cluster that folder may be one machine's own, so we raise.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not configured and not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir is not set: name a folder that all executors share")
    return configured or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/sentimill-checkpoints"


def folder(spark: SparkSession, name: str) -> str:
    """A new folder of its own in the shared checkpoint folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/sentimill-{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: computed once, lineage cut.

    A checkpoint would compute the last stage twice and keep uncompressed rows.
    """
    path = folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
