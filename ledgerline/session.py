"""Session settings the library relies on.

Business days are dates and load times are instants; both are computed in UTC.
The checkpoint folder comes from the cluster (``spark.checkpoint.dir``); a
private folder is created only when the session has none (local tests).
"""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

_REQUIRED = {
    "spark.sql.session.timeZone": "UTC",
    # bad ids, amounts and dates raise instead of turning NULL
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # day tables are replaced partition by partition, never the whole table
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # No broadcast from size *estimates*: the library broadcasts explicitly behind a proven row
    # bound; at runtime AQE may still switch a join to broadcast from *measured* stage sizes.
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "32MB",
}


def get_session(master: str = "local[*]", shuffle_partitions: int = 8, app: str = "ledgerline") -> SparkSession:
    builder = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for k, v in _REQUIRED.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return ensure_session(spark)


def ensure_session(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings the models need and make sure a checkpoint folder exists."""
    for k, v in _REQUIRED.items():
        if spark.conf.get(k, None) != v:
            spark.conf.set(k, v)
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by the cluster; a private one only when unset."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if sc.master.split("[")[0] != "local":
            raise RuntimeError("spark.checkpoint.dir is not set: the cluster must name a shared checkpoint folder")
        # local runs and tests only (one machine); a cluster always names a shared folder
        configured = tempfile.mkdtemp(prefix="ledgerline-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured
