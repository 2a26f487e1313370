"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Needed for right results: times are rendered in UTC and a partition value such as
# day=20240105 stays a string.
CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    # Top-N is cut before the shuffle for any n: the limit keeps a counter per key, not rows.
    "spark.sql.optimizer.windowGroupLimitThreshold": str(2 ** 31 - 1),
}

# Start points for a large cluster. AQE merges the many initial shuffle partitions back to the
# advisory size, splits skewed joins, and splits skewed partitions of a rebalance before a write.
CLUSTER_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings results depend on to an existing session."""
    for key, value in CONF.items():
        spark.conf.set(key, value)
    return spark


INITIAL_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"


def build_session(app_name: str, master: str | None = None,
                  conf: dict[str, str] | None = None) -> SparkSession:
    """A session with the settings above; ``conf`` wins over them.

    Shuffles start with four partitions per core of the cluster unless ``conf`` says otherwise.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**CLUSTER_CONF, **CONF, **(conf or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    if spark.conf.get(INITIAL_PARTITIONS, None) is None:
        cores = spark.sparkContext.defaultParallelism
        spark.conf.set(INITIAL_PARTITIONS, max(200, 4 * cores))
    return spark


def scratch_dir(spark: SparkSession, label: str = "run") -> str:
    """A new path in the folder every executor can reach.

    The cluster names that folder in ``spark.checkpoint.dir``; only a local session may fall back
    on a temporary folder of this machine.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="weblens-")
    return f"{base.rstrip('/')}/weblens/{label}-{uuid.uuid4().hex}"
