"""Session helpers: the settings the library relies on, and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings the operators are written against.  AQE stays on so shuffle partitions are
# coalesced at runtime and skewed sort-merge partitions are split as a second line of
# defence behind the explicit hot-key salting in ``operators.joins``.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime SQL settings above to an existing session."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "dimloom") -> SparkSession:
    """A local session for tests and the bench (the UI stays off: no server is opened)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.sql.warehouse.dir",
                tempfile.mkdtemp(prefix="dimloom-warehouse-", dir=os.environ.get("TMPDIR", "/tmp")))
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "8g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for key, value in RUNTIME_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster that setting names a shared folder and is used as is.  Only on a local
    master, and when it is unset, do we create a private folder for this run: on a cluster
    each executor would write to its own disk, so a missing setting is an error there.
    """
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(configured)
        return configured
    current = sc.getCheckpointDir()
    if current:
        return current
    if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise RuntimeError(f"spark.checkpoint.dir must name a shared folder on master {sc.master}")
    path = tempfile.mkdtemp(prefix="dimloom-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(path)
    return path


def cluster_conf(input_bytes: int, target_partition_bytes: int = 128 << 20) -> dict[str, str]:
    """Partition sizing for a cluster run over ``input_bytes`` of source data.

    Shuffle partitions start at one per ``target_partition_bytes`` of input (at least
    200) and AQE coalesces the small ones at runtime, so the widest shuffle (the
    attribution fan-out and the component joins are a few times the input) still lands
    near the advisory size per task and sorts/aggregates spill rarely.  Skewed partitions
    over 4x the median and 256 MB are split by AQE behind the explicit salting.
    """
    partitions = max(200, int(input_bytes // target_partition_bytes))
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(256 << 20),
        # Catalyst broadcasts a side only when its estimated size is below this bound
        "spark.sql.autoBroadcastJoinThreshold": str(64 << 20),
    }
