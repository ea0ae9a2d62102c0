"""Session builder and shared-folder helpers."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job relies on.  AQE re-plans joins from runtime sizes
# (small sides become broadcasts only after their size is measured), splits
# skewed shuffle partitions and coalesces tiny ones.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.compression.codec": "zstd",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, app_name: str = "ledgerline",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the engine's defaults.

    On a cluster ``master`` is left to spark-submit; tests pass ``local[*]``.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by the cluster.

    The cluster names it in ``spark.checkpoint.dir``; only when that is unset
    (local runs and tests) do we set our own.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if not configured:
        # A folder of this machine serves local runs only: on a cluster the
        # executors could not see it.
        if not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="ledgerline-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_dir(spark: SparkSession, name: str = "scratch") -> str:
    """A fresh folder under the shared checkpoint folder (never machine-local
    on a cluster)."""
    base = ensure_checkpoint_dir(spark)
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


def cluster_conf(total_cores: int, shuffle_target: str = "256m") -> dict[str, str]:
    """Settings for a large cluster (pass as ``extra`` or spark-submit --conf).

    Shuffle partitions start at 3x the cores and AQE coalesces them toward
    ``shuffle_target`` bytes each (size over parallelism), so a 100 TB merge
    gets tens of thousands of reducers while small stages shrink.  Scan
    splits of 256 MB; a runtime broadcast only below 64 MB as measured by
    AQE; partitions over 512 MB and 5x the median are split for skewed joins.
    """
    return {
        "spark.sql.shuffle.partitions": str(max(200, 3 * total_cores)),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": shuffle_target,
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
        "spark.sql.files.maxPartitionBytes": "256m",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512m",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
    }
