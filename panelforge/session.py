"""Session construction and the shared checkpoint folder.

Cluster jobs read ``spark.checkpoint.dir`` from the session (a shared
filesystem path configured by the cluster).  Only local runs and tests set one
themselves, and only when it is unset.
"""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import zipfile

from pyspark.sql import SparkSession


def build_session(master: str | None = None, app: str = "panelforge",
                  shuffle_partitions: int | None = None) -> SparkSession:
    """Local / test session with AQE on and the UI off."""
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    builder = (
        SparkSession.builder.master(master or f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or cpus))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("PANELFORGE_DRIVER_MEMORY", "16g"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_root(spark)
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint folder; set a scratch one only when the session has none."""
    current = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if current:
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(current)
        return current
    if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    scratch = tempfile.mkdtemp(prefix="panelforge-ckpt-")  # local runs and tests only
    atexit.register(shutil.rmtree, scratch, ignore_errors=True)
    spark.sparkContext.setCheckpointDir(scratch)
    return scratch


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors, once per session, so that Python tasks find it wherever they start."""
    context = spark.sparkContext
    if getattr(context, "_panelforge_package", None):
        return
    root = os.path.dirname(os.path.abspath(__file__))
    target = os.path.join(tempfile.mkdtemp(prefix="panelforge-pkg-"), "panelforge_code.zip")  # the driver's copy; Spark sends it
    with zipfile.ZipFile(target, "w") as z:
        for folder, _, names in os.walk(root):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    z.write(path, os.path.relpath(path, os.path.dirname(root)))
    context.addPyFile(target)
    context._panelforge_package = target
    atexit.register(shutil.rmtree, os.path.dirname(target), ignore_errors=True)
