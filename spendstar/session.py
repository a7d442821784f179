"""Session construction and lineage-cut location.

The library never relies on session-wide settings for correctness: every
operator uses ``try_divide`` and explicit casts, so it gives the same rows with
ANSI mode on or off and in any session time zone (all business dates are
``DateType``). The settings below are for throughput.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings that matter at scale. AQE re-plans joins from measured shuffle
# sizes (a dimension that turns out small is broadcast at runtime, a large one
# stays a sort-merge join) and splits skewed shuffle partitions.
SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "3",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    # Plan-time broadcast only below this estimated size; AQE uses the same
    # bound on measured sizes. Anything larger is shuffled.
    "spark.sql.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.sql.files.maxPartitionBytes": str(128 * 1024 * 1024),
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.filterPushdown": "true",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "spendstar", extra: dict | None = None) -> SparkSession:
    """Local or cluster session with the settings above and the UI off."""
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    conf = dict(SCALE_CONF)
    conf["spark.ui.enabled"] = "false"
    conf["spark.ui.showConsoleProgress"] = "false"
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder of the cluster.

    On a cluster ``spark.checkpoint.dir`` names a shared (HDFS/object store)
    folder and is used as is; if it is unset there, this raises rather than
    fall back to a machine-local folder. Only for a ``local`` master (tests)
    is a fresh scratch folder created and set.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        d = spark.sparkContext._jsc.getCheckpointDir()
        d = d.get() if d.isPresent() else None
    if not d:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir is not set: set it to a folder shared by all executors")
        d = tempfile.mkdtemp(prefix="spendstar-ckpt-", dir=os.environ.get("SPENDSTAR_SCRATCH", "/tmp"))
        spark.conf.set("spark.checkpoint.dir", d)
    spark.sparkContext.setCheckpointDir(d)
    return d
