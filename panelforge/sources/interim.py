"""The interim panel, landed once and read by every later stage.

The reference writes the cleaned panel to an interim file after validation and
all later stages read that file.  Here the derived panel is written as Parquet
under the session's shared checkpoint root, keyed by a fingerprint of its
source files (path, length, modification time from the Hadoop FileSystem API),
and read back; a changed source gives a new key and a rebuild.  Within a
process the key -> path map avoids re-deriving the panel for every query.
"""

from __future__ import annotations

import hashlib
import threading
import uuid
from collections.abc import Callable
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from panelforge.session import checkpoint_root

_PATHS: dict[str, str] = {}
_LOCK = threading.Lock()
BYTES_PER_PARTITION = 8 << 20  # of compressed source files
TASK_BYTES = 16 << 20  # of shuffled rows read by one task of a larger build
INITIAL = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
ADVISORY = "spark.sql.adaptive.advisoryPartitionSizeInBytes"


def source_fingerprint(spark: SparkSession, paths: list[str]) -> str:
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    h = hashlib.sha256()
    for p in sorted(paths):
        path = jvm.org.apache.hadoop.fs.Path(p)
        fs = path.getFileSystem(conf)
        for st in sorted(fs.globStatus(path) or [], key=lambda s: s.getPath().toString()):
            h.update(f"{st.getPath().toString()}|{st.getLen()}|{st.getModificationTime()}\n".encode())
    return h.hexdigest()[:20]


def source_bytes(spark: SparkSession, paths: list[str]) -> int:
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    total = 0
    for p in paths:
        path = jvm.org.apache.hadoop.fs.Path(p)
        fs = path.getFileSystem(conf)
        total += sum(fs.getContentSummary(st.getPath()).getLength() for st in fs.globStatus(path) or [])
    return total


@contextmanager
def shuffles_for(spark: SparkSession, size: int):
    """Shuffles start with a partition for each BYTES_PER_PARTITION of the sources, so that a task's sorts and
    aggregates don't grow with the tables; adaptive execution joins the small ones again, up to TASK_BYTES."""
    wanted = -(-size // BYTES_PER_PARTITION)
    if wanted <= int(spark.conf.get(INITIAL, None) or spark.conf.get("spark.sql.shuffle.partitions")):
        yield
        return
    before = {name: spark.conf.get(name, None) for name in (INITIAL, ADVISORY)}
    spark.conf.set(INITIAL, str(wanted))
    spark.conf.set(ADVISORY, str(TASK_BYTES))
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def materialized(spark: SparkSession, name: str, sources: list[str],
                 build: Callable[[], DataFrame]) -> DataFrame:
    key = f"{spark.sparkContext.applicationId}:{name}:{source_fingerprint(spark, sources)}"
    with _LOCK:
        path = _PATHS.get(key)
        if path is None:
            path = f"{checkpoint_root(spark).rstrip('/')}/panelforge-interim/{name}-{uuid.uuid4().hex[:12]}"
            with shuffles_for(spark, source_bytes(spark, sources)):
                build().write.mode("overwrite").parquet(path)
            _PATHS[key] = path
    return spark.read.parquet(path)
