"""Session helpers: a local session for tests and bench, and the shared
folder that stream checkpoints and side tables live in."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cores: int = 8, app: str = "ferry", event_log_dir: str | None = None) -> SparkSession:
    """Session for tests and the bench. A cluster job gets its session from
    ``spark-submit`` instead and only relies on ``spark.checkpoint.dir``.
    ``event_log_dir`` turns on Spark's event log there (stage and task times)."""
    builder = SparkSession.builder
    if event_log_dir:
        builder = builder.config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", event_log_dir)
    spark = (
        builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The cluster-wide folder named by ``spark.checkpoint.dir``.

    Only a local-mode session without one (a test run) gets a fresh
    temporary folder; on a cluster a machine-local folder would not be
    shared, so the setting is required there.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster (e.g. on HDFS or S3)")
    local = tempfile.mkdtemp(prefix="ferry-")
    spark.sparkContext.setCheckpointDir(local)
    return local


def fresh_dir(spark: SparkSession, name: str) -> str:
    """A new, unused folder under the shared folder, e.g. for one stream's
    checkpoint and output. Paths are only handed to Spark, so any Hadoop
    file system URI works."""
    return f"{shared_dir(spark)}/ferry/{name}/{uuid.uuid4().hex}"
