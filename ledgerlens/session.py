"""Spark session settings and the shared working folder.

Everything the library writes between steps (zones, tables, stream
checkpoints) lives under one root taken from ``spark.checkpoint.dir``, the
shared folder a cluster names for lineage cuts. Only a local session with
no such setting gets a private folder of its own.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import SparkSession

# Settings every session of the library relies on. AQE re-plans joins from
# runtime sizes, merges small shuffle partitions and splits skewed ones; UTC
# keeps date derivation independent of the machine.
SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "static",
    "spark.sql.parquet.compression.codec": "zstd",
}

# Further settings of the bank queries. Their rows are some hundred bytes in memory
# for about twenty in Parquet or gzip, so scans and shuffles are cut so that what one
# task sorts stays in its share of memory; AQE joins shuffle partitions that are small. A
# batch has many steps, so what a step shuffled goes when it ends, not when the driver's
# memory happens to be collected.
BANK_CONF = {
    "spark.sql.files.maxPartitionBytes": "16m",
    "spark.sql.files.openCostInBytes": "1m",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "32m",
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "600",
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
}
_CALLERS: dict[tuple[str, str], str | None] = {}


def build_session(master: str = "local[*]", shuffle_partitions: int | None = None,
                  app_name: str = "ledgerlens", extra: dict | None = None) -> SparkSession:
    """Session for local runs and tests; on a cluster pass the cluster's master.

    The number of shuffle partitions stays Spark's own unless it is given.
    """
    builder = (SparkSession.builder.master(master).appName(app_name)
               .config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false")
               .config("spark.driver.memory", os.environ.get("LEDGERLENS_DRIVER_MEMORY", "8g")))
    if shuffle_partitions is not None:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in {**SESSION_CONF, **(extra or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def apply_session_conf(spark: SparkSession, bank: bool = False) -> None:
    """Apply the runtime SQL settings to a session the caller created.

    ``bank`` adds ``BANK_CONF``; without it the caller's own values of those stand again.
    """
    for key, value in BANK_CONF.items():
        was = (spark.sparkContext.applicationId, key)
        if bank:
            _CALLERS.setdefault(was, spark.conf.get(key, None))
            spark.conf.set(key, value)
        elif was in _CALLERS:
            spark.conf.unset(key) if _CALLERS[was] is None else spark.conf.set(key, _CALLERS[was])
    for key, value in SESSION_CONF.items():
        try:
            spark.conf.set(key, value)
        except AnalysisException as err:  # a static conf on a running session: keep the caller's value
            if not (err.getCondition() or "").startswith("CANNOT_MODIFY"):
                raise


def work_root(spark: SparkSession) -> str:
    """The shared folder for everything the library writes.

    Reads ``spark.checkpoint.dir`` from the session. When it is unset and the
    master is local (tests, single machine), a private folder is created and
    registered as the checkpoint folder. On a cluster an unset value is an
    error: a machine-local folder would not be visible to other executors.
    """
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if root:
        return root.rstrip("/")
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a shared folder (HDFS, S3, ...) "
                           "before running ledgerlens on a cluster")
    root = tempfile.mkdtemp(prefix="ledgerlens-")
    sc.setCheckpointDir(root)
    # setCheckpointDir adds a random sub-folder; use what Spark reports.
    return (sc.getCheckpointDir() or root).rstrip("/")


def fresh_dir(spark: SparkSession, purpose: str) -> str:
    """A new, unused folder under the work root."""
    return f"{work_root(spark)}/{purpose}-{uuid.uuid4().hex[:12]}"


def drop_dir(spark: SparkSession, path: str) -> None:
    """Remove a folder of the work root that was written for one step and is read no more."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)
