"""Session helpers (the caller owns the session; these only read or fill settings)."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession


def build_local_session(cores: int | str = "*", app: str = "tripflow", shuffle_partitions: int = 8,
                        **conf: str) -> SparkSession:
    """A local session for tests and benches: UTC, AQE on, no UI, Arrow on."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "16g")
    )
    for k, v in conf.items():
        builder = builder.config(k.replace("__", "."), v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The shared checkpoint folder the cluster names in ``spark.checkpoint.dir``."""
    sc = spark.sparkContext
    d = sc.getCheckpointDir()
    if d:
        return d
    d = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if d:
        sc.setCheckpointDir(d)
        return sc.getCheckpointDir()
    return None


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the checkpoint folder.  Where none is set, a local master (tests, bench), whose tasks
    all run on this machine, gets one of its own; a cluster has to name a shared one."""
    d = checkpoint_dir(spark)
    if d:
        return d
    if spark.sparkContext.master.split("[")[0] != "local":
        raise RuntimeError(
            "spark.checkpoint.dir is not set; iterative operators cut lineage with checkpoint() "
            "and need a shared folder (HDFS/S3/ABFS) named there"
        )
    d = tempfile.mkdtemp(prefix="tripflow-ckpt-")
    spark.sparkContext.setCheckpointDir(d)
    return spark.sparkContext.getCheckpointDir()
