"""Session settings the operators are planned for.

Only settings a user would set on any cluster: AQE (runtime coalescing,
broadcast conversion from measured sizes, skew-join splitting) and a
reliable checkpoint folder taken from the cluster. Results do not depend on
the session time zone (dates come from time-zone-free timestamps).
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings applied by :func:`tune`; safe defaults for 1 to 1000 executors.
TUNING = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply :data:`TUNING` to a running session (idempotent)."""
    for k, v in TUNING.items():
        spark.conf.set(k, v)
    return spark


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "roundbook") -> SparkSession:
    """A local session for tests and benchmarks; the Spark UI stays off."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.driver.bindAddress", "127.0.0.1")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.session.timeZone", os.environ.get("ROUNDBOOK_TZ", "UTC"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return tune(spark)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The reliable checkpoint folder of the session.

    Uses the folder already set on the context, else ``spark.checkpoint.dir``
    from the cluster configuration. Only a ``local[...]`` session without
    either (tests) gets a fresh temporary folder; on a cluster a missing
    setting is an error, since a machine-local folder would not survive the
    loss of that machine.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = sc.getConf().get("spark.checkpoint.dir", None)
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
    elif sc.master.startswith("local"):
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="roundbook-ckpt-", dir=os.environ.get("TMPDIR", "/tmp")))
    else:
        raise ValueError("set spark.checkpoint.dir to a folder on shared storage")
    return sc.getCheckpointDir()


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new, unused folder beside the session's checkpoints, on storage all machines share."""
    return f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"
