"""Helpers shared by the operators: reading tables, cutting lineage, Arrow rows."""

from __future__ import annotations

import ctypes
import os
import uuid
import zipfile

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelforge.session import checkpoint_root

#: the characters [\x20\x09-\x0D]; bytes.split() without an argument splits on exactly these
SPACE = b" \t\n\x0b\x0c\r"


CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
ARROW_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small(stored: DataFrame, most_bytes: int = 8 << 20) -> DataFrame:
    """A stored table, marked for broadcast if its files are small; else Spark joins it by shuffling."""
    path = stored.inputFiles()
    if not path:
        return stored
    spark = stored.sparkSession
    folder = spark._jvm.org.apache.hadoop.fs.Path(path[0]).getParent()
    size = folder.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(folder).getLength()
    return F.broadcast(stored) if size <= most_bytes else stored


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared checkpoint folder."""
    return f"{checkpoint_root(spark).rstrip('/')}/llm-{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write df to the shared folder and read it back: a short lineage that survives lost executors.

    The write's shuffle files go as soon as it has ended, not when the driver next collects garbage."""
    spark, path = df.sparkSession, scratch_path(df.sparkSession, name)
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once per session, and bound Arrow batches by bytes where the session doesn't."""
    if spark.conf.get(ARROW_BYTES, None) is None:
        spark.conf.set(ARROW_BYTES, str(4 << 20))
    if getattr(spark.sparkContext, "_panelforge_shipped", False):
        return
    import tempfile

    import panelforge
    root = os.path.dirname(os.path.abspath(panelforge.__file__))
    target = os.path.join(tempfile.mkdtemp(prefix="panelforge-zip-"), "panelforge_pkg.zip")  # the driver's copy; Spark sends it
    with zipfile.ZipFile(target, "w") as z:
        for folder, _, names in os.walk(root):
            for n in names:
                if n.endswith(".py"):
                    full = os.path.join(folder, n)
                    z.write(full, os.path.relpath(full, os.path.dirname(root)))
    spark.sparkContext.addPyFile(target)
    spark.sparkContext._panelforge_shipped = True


_SOLID = np.ones(256, dtype=bool)
_SOLID[list(SPACE)] = False


def cut_words(column: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a string column without nulls, in one pass over its bytes.

    Returns the words (binary), their first bytes' places, the column's bytes and its rows' bounds in them."""
    column = column.cast(pa.large_binary()) if not pa.types.is_large_binary(column.type) else column
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset:column.offset + len(column) + 1]
    raw = column.buffers()[2]
    data = np.frombuffer(raw, dtype=np.uint8)[offsets[0]:offsets[-1]] if raw is not None else np.zeros(0, dtype=np.uint8)
    offsets = offsets - offsets[0]
    solid = _SOLID[data]
    first = solid.copy()
    first[1:] &= ~solid[:-1]
    edges = offsets[:-1][offsets[:-1] < len(data)]
    first[edges] = solid[edges]  # a word ends with its row
    at = np.flatnonzero(first)
    letters = data[solid]
    bounds = np.append(np.cumsum(solid, dtype=np.int32)[at] - 1, len(letters)).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(at), [None, pa.py_buffer(bounds), pa.py_buffer(letters)]), at, data, offsets


def words_of(column: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]:
    """Words of a string column without nulls, and for each its row, its line within the row, and a number that tells
    lines of the whole column apart (ascending)."""
    words, at, data, offsets = cut_words(column)
    return words, *places(at, data, offsets)


def places(at: np.ndarray, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of words by their first bytes' places: row, line within the row, and a number that tells lines of the whole column apart (ascending)."""
    feeds = np.flatnonzero(data == 10)
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(np.searchsorted(at, offsets)))
    ahead = np.cumsum(np.bincount(np.searchsorted(at, feeds), minlength=len(at) + 1))[:-1]  # line feeds before each word
    return row, ahead - np.searchsorted(feeds, offsets[:-1])[row], ahead + row


def word_spans(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The words of cut_words where they stand, not copied: first bytes' places, lengths, the column's bytes and its rows' bounds in them."""
    column = column.cast(pa.large_binary()) if not pa.types.is_large_binary(column.type) else column
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset:column.offset + len(column) + 1]
    raw = column.buffers()[2]
    data = np.frombuffer(raw, dtype=np.uint8)[offsets[0]:offsets[-1]] if raw is not None else np.zeros(0, dtype=np.uint8)
    offsets = offsets - offsets[0]
    solid = (data - np.uint8(9) > 4) & (data != 32)
    first, last = solid.copy(), solid.copy()
    first[1:] &= ~solid[:-1]
    last[:-1] &= ~solid[1:]
    edges = offsets[1:-1][(offsets[1:-1] > 0) & (offsets[1:-1] < len(data))]  # a word ends with its row
    first[edges], last[edges - 1] = solid[edges], solid[edges - 1]
    at = np.flatnonzero(first)
    return at, np.flatnonzero(last) + 1 - at, data, offsets


_LOW_BYTES = np.array([(1 << 8 * n) - 1 for n in range(9)], dtype=np.uint64)


def _scattered(x: np.ndarray) -> np.ndarray:
    """A one-to-one mixing of 64-bit numbers, in their place."""
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x ^= x >> np.uint64(shift)
        x *= np.uint64(factor)
    x ^= x >> np.uint64(31)
    return x


def span_hashes(at: np.ndarray, n: np.ndarray, data: np.ndarray) -> np.ndarray:
    """64-bit hashes of the words of n > 0 bytes at these places of data: eight bytes at a time, each eight mixed with their place and added up."""
    eights = np.ndarray((len(data) + 1,), dtype="<u8", buffer=np.concatenate([data, np.zeros(8, dtype=np.uint8)]), strides=(1,))  # from any byte on

    def part(at, left, k):
        return _scattered((eights[at] & _LOW_BYTES[np.minimum(left, 8)]) + k.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))

    h = part(at, n, n)  # the first eight bytes go with the length
    more = np.flatnonzero(n > 8)
    if len(more):
        parts = (n[more] - 1) // 8
        starts = np.cumsum(parts) - parts
        k = np.arange(starts[-1] + parts[-1]) - np.repeat(starts - 1, parts)
        word = np.repeat(more, parts)
        h[more] += np.add.reduceat(part(at[word] + 8 * k, n[word] - 8 * k, ~k), starts)
        h[more] = _scattered(h[more])
    return h


_TABLE = np.random.default_rng(11).integers(0, 1 << 64, (64, 256), dtype=np.uint64)


def hash_words(words: pa.Array) -> np.ndarray:
    """64-bit tabulation hashes of a binary array without nulls and empty words."""
    if not len(words):
        return np.zeros(0, dtype=np.uint64)
    offsets = np.frombuffer(words.buffers()[1], dtype=np.int32)[words.offset:words.offset + len(words) + 1].astype(np.int64)
    data = np.frombuffer(words.buffers()[2], dtype=np.uint8)[offsets[0]:offsets[-1]]
    starts = offsets[:-1] - offsets[0]
    place = np.arange(len(data)) - np.repeat(starts, np.diff(offsets))
    part = _TABLE[place & 63, data]
    if (place >= 64).any():
        part = part * (2 * (place >> 6).astype(np.uint64) + np.uint64(1))
    h = np.add.reduceat(part, starts)
    h ^= h >> np.uint64(31)
    return h * np.uint64(0x9E3779B97F4A7C15)


def text_bytes(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of a string column; null counts as empty."""
    return [b or b"" for b in column.cast(pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()).to_pylist()]


def release() -> None:
    """Give memory that numpy and Arrow have freed back to the system."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # not glibc
        pass


def slices(batches, most_bytes: int = 4 << 20):
    """Cut Arrow batches into pieces of about most_bytes, so that long rows never pile up in Python."""
    for batch in batches:
        rows = batch.num_rows
        if not rows:
            continue
        step = max(1, int(rows * most_bytes / max(batch.nbytes, 1)))
        for at in range(0, rows, step):
            yield batch.slice(at, step)
    release()  # workers live on after their task


def pick(df: DataFrame, **columns: str) -> DataFrame:
    """Select columns under fixed names; extra columns of the input can't clash with the operator's own."""
    return df.select(*[df[source].alias(name) for name, source in columns.items()])


def shield(docs: DataFrame, *keys: str, **more: Column) -> tuple[DataFrame, list[str]]:
    """docs under neutral column names, and the new names of ``keys``: whatever a table's columns are called, none can clash
    with an operator's own. ``more`` are further columns, from expressions over docs. Undo with toDF(*docs.columns)."""
    names = docs.columns
    own = [docs[f"`{c}`"].alias(f"own{i}") for i, c in enumerate(names)]
    return docs.select(*own, *[v.alias(k) for k, v in more.items()]), [f"own{names.index(k)}" for k in keys]


def free_name(name: str, taken: list[str]) -> str:
    while name in taken:
        name = f"_{name}"
    return name


def partitions_for(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
