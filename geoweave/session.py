"""Session helpers: a tuned local/test session and checkpoint-directory resolution."""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import SparkSession


def build_session(
    master: str | None = None,
    shuffle_partitions: int = 8,
    app_name: str = "geoweave",
    extra_conf: dict[str, str] | None = None,
) -> SparkSession:
    """Session for tests and benchmarks.

    On a cluster the same settings are supplied through ``spark-submit``; the important ones are
    AQE with skew-join handling (hub nodes) and a shuffle partition count sized to the data.
    """
    builder = (
        SparkSession.builder.master(master or os.environ.get("SPARK_MASTER", "local[*]"))
        .appName(app_name)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.default.parallelism", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("GEOWEAVE_DRIVER_MEMORY", "16g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for key, value in (extra_conf or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint directory, setting it from the session when needed.

    Order: a directory already set on the SparkContext, then ``spark.checkpoint.dir`` from the
    session configuration (the shared folder a cluster names). Only a local-mode session with
    neither (tests, the single-node bench) gets a private temporary folder; a cluster session
    without a shared folder is an error, because a machine-local folder would not survive the
    loss of an executor.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None
    )
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir() or configured
    if re.fullmatch(r"local(\[[^]]*\])?", sc.master):  # one JVM; not local-cluster, whose workers have own folders
        path = tempfile.mkdtemp(prefix="geoweave-ckpt-")
        sc.setCheckpointDir(path)
        return sc.getCheckpointDir() or path
    raise RuntimeError(
        "spark.checkpoint.dir is not set: iterative operators need a shared, reliable folder"
    )
