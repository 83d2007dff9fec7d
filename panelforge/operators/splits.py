"""Splits and folds.

C1 random_split        the ceil(share * n) smallest key hashes (md5 or xxhash64), independent of partitioning
C2 chronological_split train / val / test / prospective by target month
C3 walk_forward_folds  expanding windows; each row carries the (fold, role) pairs it belongs to
C4 kfold               contiguous folds in key order, scikit-learn fold sizes, on a dense index
   dense_index         0-based position in key order without a single-partition window
"""

from __future__ import annotations

import math
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelforge.session import checkpoint_root

# The reference's split months, shifted back 25 years to the test data's calendar.
TRAIN_END, VAL_END, TEST_END = 199912, 200012, 200112
WALK_FORWARD_FOLDS = [  # (train limit, validation start, validation end)
    (199612, 199701, 199706),
    (199706, 199707, 199712),
    (199712, 199801, 199806),
    (199806, 199807, 199812),
    (199812, 199901, 199912),
]


def _key_string(keys: list[str], seed: int) -> Column:
    return F.concat_ws("|", F.lit(str(seed)), *[F.col(k).cast("string") for k in keys])


HASH_BITS, STEP_BITS = 52, 13


def key_hash(keys: list[str], seed: int = 42, method: str = "md5") -> Column:
    """HASH_BITS of a hash of the keys, as a LONG."""
    if method == "md5":
        return F.conv(F.substring(F.md5(_key_string(keys, seed)), 1, HASH_BITS // 4), 16, 10).cast("long")
    return F.shiftrightunsigned(F.xxhash64(F.lit(seed), *[F.col(k) for k in keys]), 64 - HASH_BITS)


def _smallest(df: DataFrame, h: Column, share: float) -> tuple[int, int]:
    """(t, r): the ceil(share * n) smallest hashes are those below t and r of those equal to t.

    Each round counts the hashes of one bracket by their next STEP_BITS bits and goes into the bracket that holds
    the rank: at most four rounds for any number of rows, 2^STEP_BITS counts on the driver."""
    prefix, left, rank = 0, HASH_BITS, None
    hashed = df.select(h.alias("_h"))
    while True:
        shift = left - STEP_BITS
        inside = hashed.where(F.shiftright("_h", left) == prefix) if left < HASH_BITS else hashed
        counts = sorted(inside.groupBy(F.shiftright("_h", shift).alias("b")).count().collect())
        if rank is None:
            rank = math.ceil(share * sum(c for _, c in counts))
        if rank == 0:
            return prefix << left, 0
        for bracket, n in counts:
            if rank <= n:
                break
            rank -= n
        if rank == n:  # the whole bracket: everything below its end
            return (bracket + 1) << shift, 0
        prefix, left = bracket, shift
        if not shift:
            return bracket, rank


def random_split(df: DataFrame, keys: list[str], *, test_share: float = 0.2, seed: int = 42,
                 method: str = "md5", out: str = "split") -> DataFrame:
    """Exactly ceil(test_share * n) test rows, those with the smallest hash of their key (ties in key order): the same
    rows for every partitioning, no sort, no shuffle of rows.  Keys are unique (V3); rows that repeat a key stay on one
    side, so repeats of the last key taken come on top.  Reads df's keys once a round of the search."""
    h = key_hash(keys, seed, method)
    t, r = _smallest(df, h, test_share)
    test = h < t
    if r:  # different keys of equal hash: a handful
        for row in df.where(h == t).groupBy(*keys).count().orderBy(*keys).collect():
            if r <= 0:
                break
            test = test | ((h == t) & reduce(and_, [F.col(k).eqNullSafe(F.lit(row[k])) for k in keys]))
            r -= row["count"]
    return df.withColumn(out, F.when(test, "test").otherwise("train"))


def chronological_split(df: DataFrame, *, col: str = "target_month", train_end: int = TRAIN_END,
                        val_end: int | None = VAL_END, test_end: int | None = TEST_END,
                        out: str = "split") -> DataFrame:
    """By target month.  Months after ``test_end`` are 'prospective', never 'test'."""
    c = F.col(col)
    label = F.when(c <= train_end, "train")
    if val_end is not None:
        label = label.when(c <= val_end, "val")
    if test_end is not None:
        label = label.when(c <= test_end, "test").otherwise("prospective")
    else:
        label = label.otherwise("test")
    return df.withColumn(out, label)


def walk_forward_folds(df: DataFrame, *, col: str = "target_month",
                       folds: list[tuple[int, int, int]] = WALK_FORWARD_FOLDS) -> DataFrame:
    """One output row per (input row, fold) in which the row is used, with role
    'train' (month <= limit) or 'val' (start <= month <= end).  A per-row
    generator over the fixed fold list: no join, no sort."""
    for limit, start, end in folds:
        if not limit < start <= end:
            raise ValueError(f"fold ({limit}, {start}, {end}): train must end before validation")
    m = F.col(col)
    tags = F.array(*[
        F.struct(F.lit(i + 1).alias("fold"),
                 F.when(m <= limit, F.lit("train"))
                 .when((m >= start) & (m <= end), F.lit("val")).alias("role"))
        for i, (limit, start, end) in enumerate(folds)])
    kept = F.filter(tags, lambda t: t["role"].isNotNull())
    return (df.withColumn("_fold", F.explode(kept))
            .withColumn("fold", F.col("_fold.fold")).withColumn("role", F.col("_fold.role"))
            .drop("_fold"))


def fold_bounds(assigned: DataFrame, *, col: str = "target_month") -> DataFrame:
    """Check of C3: per fold, train max must precede validation min."""
    return (assigned.groupBy("fold")
            .agg(F.count(F.when(F.col("role") == "train", 1)).cast("long").alias("n_train"),
                 F.count(F.when(F.col("role") == "val", 1)).cast("long").alias("n_val"),
                 F.max(F.when(F.col("role") == "train", F.col(col))).alias("train_max"),
                 F.min(F.when(F.col("role") == "val", F.col(col))).alias("val_min"),
                 F.max(F.when(F.col("role") == "val", F.col(col))).alias("val_max"))
            .withColumn("ordered", F.col("train_max") < F.col("val_min")))


def dense_index(df: DataFrame, order: list[str], *, out: str = "row_index",
                num_partitions: int | None = None) -> DataFrame:
    """0-based position of each row in ``order`` (keys must be unique).

    Range-partition by the keys and sort within partitions; the position inside
    a partition comes from ``monotonically_increasing_id`` (partition id in the
    upper bits, record number below), and each partition's offset from one small
    count per partition.  The ranged data is checkpointed so both passes see the
    same partitioning.  The offsets are joined, one row per partition; nothing reaches the driver.
    """
    spark = df.sparkSession
    checkpoint_root(spark)
    # without an explicit count AQE sizes the range partitions from runtime statistics;
    # the checkpoint below freezes them, so ids and offsets refer to the same partitions
    ranged = (df.repartitionByRange(num_partitions, *order) if num_partitions else df.repartitionByRange(*order))
    ranged = ranged.sortWithinPartitions(*order).withColumn("_mid", F.monotonically_increasing_id())
    ranged = ranged.checkpoint(eager=True)
    ranged = ranged.withColumn("_pid", F.shiftright(F.col("_mid"), 33))
    counts = ranged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = F.broadcast(counts.select("_pid", before.alias("_before")))  # one row of 16 bytes per partition
    local = F.col("_mid") - F.shiftleft(F.col("_pid"), 33)
    return ranged.join(offsets, "_pid").withColumn(out, (F.col("_before") + local).cast("long")).drop("_mid", "_pid", "_before")


def kfold_of_index(index: Column, n: int, k: int = 5) -> Column:
    """Fold of a 0-based position under scikit-learn's KFold sizes (first n % k folds one larger)."""
    q, r = divmod(n, k)
    big = r * (q + 1)
    return F.when(index < big, F.floor(index / (q + 1))).otherwise(
        F.lit(r) + F.floor((index - big) / max(q, 1))).cast("int")


def kfold(df: DataFrame, order: list[str], *, k: int = 5, out: str = "fold") -> DataFrame:
    """C4: contiguous, unshuffled folds in key order (0-based fold ids)."""
    indexed = dense_index(df, order)
    n = indexed.count()
    return indexed.withColumn(out, kfold_of_index(F.col("row_index"), n, k))


def hash_fold(df: DataFrame, keys: list[str], *, k: int = 5, seed: int = 42, out: str = "fold") -> DataFrame:
    """C4 at scale when contiguity is not needed: fold = key hash mod k."""
    return df.withColumn(out, F.pmod(F.xxhash64(F.lit(seed), *[F.col(c) for c in keys]), F.lit(k)).cast("int"))
