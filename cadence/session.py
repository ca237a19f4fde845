"""Session contract.

The library never owns the session: callers pass one in. Two things are
checked or read from it: the session time zone must be UTC (every
timestamp is an instant and the local clock is derived exactly once), and
the shared scratch folder comes from ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession


def ensure_utc(spark: SparkSession) -> None:
    tz = spark.conf.get("spark.sql.session.timeZone")
    if tz not in ("UTC", "Etc/UTC", "GMT", "Z", "+00:00"):
        raise ValueError(f"spark.sql.session.timeZone must be UTC, got {tz!r}")


def scratch_dir(spark: SparkSession) -> str:
    """Shared folder for staged tables and checkpoints.

    Taken from ``spark.checkpoint.dir`` (the cluster's shared folder). On a
    cluster it is an error to have none: a machine-local folder would not
    survive the loss of the executor that wrote it. A session of one machine
    (tests) gets a temporary one.
    """
    path = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not path and spark.sparkContext.master.split("[")[0] == "local":
        path = tempfile.mkdtemp(prefix="cadence-ckpt-")
        spark.conf.set("spark.checkpoint.dir", path)
    if not path:
        raise RuntimeError("spark.checkpoint.dir is not set; point it at a shared folder")
    return path


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "cadence") -> SparkSession:
    """Session for tests and the local benchmark only (never used by the library)."""
    active = SparkSession.getActiveSession()
    builder = SparkSession.builder
    if active is None or not active.conf.get("spark.checkpoint.dir", None):
        # Only here, where nothing is set (tests, local bench): a private scratch folder.
        builder = builder.config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="cadence-ckpt-"))
    builder = (
        builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # broadcast only what AQE has measured (a real size, not an estimate)
        .config("spark.sql.autoBroadcastJoinThreshold", "-1")
        .config("spark.sql.adaptive.autoBroadcastJoinThreshold", "32MB")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(spark.conf.get("spark.checkpoint.dir"))
    return spark
