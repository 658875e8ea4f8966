"""Session helpers: a local session for tests/bench and the checkpoint folder."""

from __future__ import annotations

from pyspark.sql import SparkSession


def local_session(cores: str = "8", shuffle_partitions: int = 8, app: str = "sackcast") -> SparkSession:
    """Session used by tests and the bench; a cluster job brings its own."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.parallelismFirst", "false")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the checkpoint folder, taking ``spark.checkpoint.dir`` from the session;
    only where that is unset, a folder beside the session's warehouse."""
    sc = spark.sparkContext
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(spark.conf.get("spark.checkpoint.dir", None)
                            or spark.conf.get("spark.sql.warehouse.dir") + "/_checkpoints")
    return sc.getCheckpointDir()
