"""Session helpers: a local test session and the shared working folder."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cores: int | str = 8, **conf: str) -> SparkSession:
    """A session for tests and the bench; a cluster brings its own session."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("opinara")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "8g")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def is_local(spark: SparkSession) -> bool:
    """Driver and executors are one process, so a local folder is shared."""
    return re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master) is not None


def shared_dir(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``.

    Only in local mode (tests, a laptop) may that setting be absent; then a fresh
    local folder is made and recorded, so every later call in the session sees the same
    one, and it goes when the process ends. On a cluster its absence is an error, as
    each machine would write to a disk of its own.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        folder = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not folder:
        if not is_local(spark):
            raise ValueError("spark.checkpoint.dir must name a folder that all machines share")
        folder = tempfile.mkdtemp(prefix="run-", dir="/tmp")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        spark.conf.set("spark.checkpoint.dir", folder)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder)
    return folder


def work_path(spark: SparkSession, label: str) -> str:
    """A new path for a table written mid-job, in this application's part of the shared folder."""
    return f"{work_dir(spark)}/{label}-{uuid.uuid4().hex}"


def work_dir(spark: SparkSession) -> str:
    return f"{shared_dir(spark).rstrip('/')}/work-{spark.sparkContext.applicationId}"


def clear_path(spark: SparkSession, path: str) -> None:
    """Deletes a table written mid-job; its readers must be done."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def clear_work(spark: SparkSession) -> None:
    """Deletes every table that this application wrote mid-job; their readers must be done."""
    clear_path(spark, work_dir(spark))
