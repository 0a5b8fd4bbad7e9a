"""Session helpers.

The library never creates a session inside a data product; these helpers are
for scripts, tests and the benchmark.  Cluster settings (checkpoint folder,
shuffle partitions) are read from the session when present and only filled in
where they are unset, as in local tests.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every ledgerloom job relies on.  UTC keeps epoch -> date
# conversions stable across drivers; AQE re-plans joins and coalesces
# partitions from runtime statistics.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(cores: int = 8, shuffle_partitions: int | None = None,
                  app_name: str = "ledgerloom") -> SparkSession:
    """A local session for tests and benchmarks."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or cores))
        .config("spark.driver.memory", os.environ.get("LEDGERLOOM_DRIVER_MEMORY", "16g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for key, value in DEFAULT_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and stored tables; the same on every call.

    ``spark.checkpoint.dir`` names it on a cluster.  Only a ``local`` master may
    do without: there a scratch folder of this machine is taken once, since
    driver and executors are one process.  Anywhere else an unset folder is an
    error, because executors do not share a machine's own disk.
    """
    sc = spark.sparkContext
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(configured)
        return configured.rstrip("/")
    if not sc.getCheckpointDir():
        if not sc.master.split("[")[0] == "local":
            raise RuntimeError("spark.checkpoint.dir is not set: name a folder that driver and executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="ledgerloom-ckpt-"))
    return sc.getCheckpointDir()
