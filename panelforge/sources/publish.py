"""Atomic publication of a table: versions beside each other and one small pointer file, swapped last.

A writer fills a fresh version folder and then moves a new pointer over the old one (one rename on the
table's own file system). Readers follow the pointer, so they see the old version or the new one, never
a half-written folder; a writer that dies before the swap leaves the old version in place.
"""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

POINTER = "_CURRENT"


def _context(spark: SparkSession, path: str):
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    folder = jvm.org.apache.hadoop.fs.Path(path.rstrip("/"))
    folder = folder.getFileSystem(conf).makeQualified(folder)
    return jvm, folder, folder.getFileSystem(conf), jvm.org.apache.hadoop.fs.FileContext.getFileContext(folder.toUri(), conf)


def new_version() -> str:
    return f"v-{uuid.uuid4().hex[:12]}"


def publish(spark: SparkSession, path: str, version: str) -> None:
    """Make ``version`` (a folder below ``path`` that is written in full) the current one."""
    jvm, folder, fs, context = _context(spark, path)
    fresh, pointer = (jvm.org.apache.hadoop.fs.Path(folder, n) for n in (f".{POINTER}-{version}", POINTER))
    out = fs.create(fresh, True)
    out.write(bytearray(version.encode()))
    out.close()
    rename = jvm.org.apache.hadoop.fs.Options.Rename
    kinds = spark.sparkContext._gateway.new_array(rename, 1)
    kinds[0] = rename.OVERWRITE
    context.rename(fresh, pointer, kinds)


def current_version(spark: SparkSession, path: str) -> str:
    jvm, folder, fs, _ = _context(spark, path)
    pointer = jvm.org.apache.hadoop.fs.Path(folder, POINTER)
    if not fs.exists(pointer):
        raise FileNotFoundError(f"nothing is published in {path}")
    stream = fs.open(pointer)
    try:
        return bytes(jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
    finally:
        stream.close()
