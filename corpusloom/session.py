"""Session defaults and the folder of intermediate results."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession


def local_session(cpus: str | int = "*", partitions: int = 8) -> SparkSession:
    """Session for tests and the bench; a cluster brings its own."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("corpusloom")
        .config("spark.sql.shuffle.partitions", partitions)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )


def checkpoint_folder(spark: SparkSession) -> str:
    """The session's checkpoint folder; on a local master that names none, one of its own."""
    if spark.sparkContext.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder:
            if not spark.sparkContext.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a shared folder")
            folder = tempfile.mkdtemp(prefix="corpusloom-")
        spark.sparkContext.setCheckpointDir(folder)
    return spark.sparkContext.getCheckpointDir()
