"""Session helpers.

Cluster settings (checkpoint/scratch folders, shuffle sizing) are read from
the session.  Local defaults are applied only where a setting is unset, as
in tests and the local benchmark.
"""

from __future__ import annotations

import os
import tempfile
from contextlib import contextmanager

from pyspark.sql import SparkSession

LOCAL_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


# SQL settings the jobs rely on.
#
# The wide stages here (60-200 measure columns) generate methods past the
# JVM's 8000-byte JIT limit; with this limit Spark gives up whole-stage codegen
# for such a stage (its expressions are still compiled one by one) instead of
# running a method that the JVM only interprets (measured 2-4x on the daily
# aggregate).
#
# Dynamic partition pruning is off: the last-year read is already pruned by
# literal PERIOD ranges, and DPP would re-run the whole spine-and-components
# side of the join as a pruning subquery (measured ~25% of the ops job).
JOB_CONF = {
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.optimizer.dynamicPartitionPruning.enabled": "false",
}


@contextmanager
def job_settings(spark: SparkSession):
    """The job settings for the time of a load; the caller's come back afterwards."""
    before = {k: spark.conf.get(k, None) for k in JOB_CONF}
    for k, v in JOB_CONF.items():
        spark.conf.set(k, v)
    try:
        yield spark
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "daybook") -> SparkSession:
    b = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for k, v in {**LOCAL_CONF, **JOB_CONF}.items():
        b = b.config(k, v)
    b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    b = b.config("spark.driver.memory", os.environ.get("DAYBOOK_DRIVER_MEMORY", "8g"))
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def is_local(spark: SparkSession) -> bool:
    """One machine: a local folder is visible to every task."""
    master = spark.sparkContext.master
    return master.startswith("local") and not master.startswith("local-cluster")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder that the session names.  A temporary local folder stands in
    for it on a local master only; anywhere else executors would not see each other's files."""
    d = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not d:
        if not is_local(spark):
            raise RuntimeError("spark.checkpoint.dir is not set: a folder shared by all executors is needed")
        d = tempfile.mkdtemp(prefix="daybook-ckpt-")
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(d)
    return d


def scratch_dir(spark: SparkSession) -> str:
    """Staging area on the shared file system (next to the checkpoints)."""
    return ensure_checkpoint_dir(spark).rstrip("/") + "/daybook-staging"
