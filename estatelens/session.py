"""Session helpers."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"


def local_session(cores: int | str = "*", name: str = "estatelens", **conf: str) -> SparkSession:
    """A local session for tests and benchmarks; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", "8g")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can read, as the cluster names it; a local one only where unset."""
    context = spark.sparkContext
    folder = spark.conf.get(CHECKPOINT_DIR, None) or context.getConf().get(CHECKPOINT_DIR) or context.getCheckpointDir()
    if not folder:
        if not context.master.startswith("local["):
            raise ValueError(f"{CHECKPOINT_DIR} must name a shared folder")
        folder = tempfile.mkdtemp(prefix="estatelens-")
        spark.conf.set(CHECKPOINT_DIR, folder)
    if not context.getCheckpointDir():
        context.setCheckpointDir(folder)
    return folder.rstrip("/")
