"""Validation and ingestion guards.

All column checks over a frame run as ONE grouping-free aggregate (a single
scan), then a tiny unpivot to one row per column.  Guards raise
``ValidationError`` on violation and never skip on empty input.
"""

from __future__ import annotations

import hashlib
import os
import re
from urllib.parse import unquote

import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelforge.functions.periods import month_ordinal
from panelforge.session import ship_package

# Name fragments of the reference's value-range rules (lower-case substring tests).
PROBABILITY_TERMS = ("probability", "prob")
RISK_TERMS = ("risk", "deviation", "error", "variance", "volatility", "std")

NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)


class ValidationError(AssertionError):
    pass


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NUMERIC)]


def _lit_name(c: str) -> str:
    return c.replace("'", "''")


def missing_counts(df: DataFrame) -> DataFrame:
    """V1: NULL count per column, one aggregate, long form (column_name, n_missing)."""
    cols = df.columns
    row = df.agg(*[F.sum(F.col(f"`{c}`").isNull().cast("long")).alias(f"m{i}") for i, c in enumerate(cols)])
    pairs = ", ".join(f"'{_lit_name(c)}', m{i}" for i, c in enumerate(cols))
    return row.selectExpr(f"stack({len(cols)}, {pairs}) AS (column_name, n_missing)") \
        .select("column_name", F.coalesce(F.col("n_missing"), F.lit(0)).cast("long").alias("n_missing"))


def duplicate_count(df: DataFrame, subset: list[str] | None = None) -> DataFrame:
    """V2: rows that repeat an earlier row (all columns or ``subset``); NULLs compare equal.
    rows - groups: partial aggregation per group, no distinct counting of wide tuples."""
    cols = subset or df.columns
    groups = df.groupBy(*cols).agg(F.count(F.lit(1)).alias("n"))
    return groups.agg(F.sum("n").cast("long").alias("n_rows"),
                      F.count(F.lit(1)).cast("long").alias("n_distinct"),
                      (F.sum("n") - F.count(F.lit(1))).cast("long").alias("n_duplicates"))


def panel_key_duplicates(df: DataFrame, keys: list[str] = ("entity", "period")) -> DataFrame:
    """V3: keys present more than once (must be empty)."""
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).cast("long").alias("n_rows"))
            .where(F.col("n_rows") > 1))


def assert_panel_key_unique(df: DataFrame, keys: list[str] = ("entity", "period")) -> None:
    n = panel_key_duplicates(df, list(keys)).limit(1).count()
    if n:
        raise ValidationError(f"panel key {tuple(keys)} is not unique")


def schema_check(spark: SparkSession, df: DataFrame, required: list[str], target: str) -> DataFrame:
    """V4: required columns and target present.  Plan-time (schema only)."""
    present = set(df.columns)
    rows = [(c, "feature", c in present) for c in required] + [(target, "target", target in present)]
    return spark.createDataFrame(rows, "column_name string, role string, present boolean")


def schema_valid(df: DataFrame, required: list[str], target: str) -> dict:
    missing = [c for c in required if c not in df.columns]
    return {"valid": not missing and target in df.columns, "missing_features": missing,
            "target_exists": target in df.columns}


def value_range_checks(df: DataFrame) -> DataFrame:
    """V5 infinite values, V6 probability range, V7 negative risk, V9 constant columns --
    for every numeric column in one aggregate."""
    cols = numeric_columns(df)
    aggs = []
    for i, c in enumerate(cols):
        x = F.col(f"`{c}`").cast("double")
        aggs += [F.max(F.when(F.isnan(x), F.lit(False)).otherwise(
                    (x == float("inf")) | (x == float("-inf")))).alias(f"inf{i}"),
                 F.min(x).alias(f"lo{i}"), F.max(x).alias(f"hi{i}")]
    row = df.agg(*aggs)
    fields = []
    for i, c in enumerate(cols):
        name = c.lower()
        is_prob = any(t in name for t in PROBABILITY_TERMS)
        is_risk = any(t in name for t in RISK_TERMS)
        lo, hi = F.col(f"lo{i}"), F.col(f"hi{i}")
        bad_prob = (lo < 0) | ((hi > 1.05) & (hi < 5)) | (hi > 105)
        fields.append(F.struct(
            F.lit(c).alias("column_name"),
            F.coalesce(F.col(f"inf{i}"), F.lit(False)).alias("has_infinite"),
            F.lit(is_prob).alias("is_probability"),
            (F.coalesce(bad_prob, F.lit(False)) if is_prob else F.lit(False)).alias("invalid_probability"),
            F.lit(is_risk).alias("is_risk"),
            (F.coalesce(lo < 0, F.lit(False)) if is_risk else F.lit(False)).alias("negative_risk"),
            F.coalesce(lo == hi, F.lit(True)).alias("is_constant")))
    return row.select(F.explode(F.array(*fields)).alias("r")).select("r.*")


def dedup_rows(df: DataFrame) -> DataFrame:
    """V8: drop exact duplicate rows (NULLs compare equal)."""
    return df.dropDuplicates()


def leakage_columns(spark: SparkSession, df: DataFrame, prohibited: list[str]) -> DataFrame:
    """Prohibited columns present in a design table (must be empty)."""
    bad = [(c,) for c in prohibited if c in df.columns]
    return spark.createDataFrame(bad, "column_name string")


def split_disjoint(df: DataFrame, keys: list[str], split: str = "split") -> DataFrame:
    """Keys that occur in more than one split (must be empty).  One shuffle."""
    return (df.groupBy(*keys).agg(F.countDistinct(split).cast("long").alias("n_splits"))
            .where(F.col("n_splits") > 1))


def split_order(df: DataFrame, *, month: str = "target_month", split: str = "split",
                train_end: int, val_end: int, test_end: int | None = None) -> DataFrame:
    """Per split month range and whether it respects the boundaries."""
    g = df.groupBy(split).agg(F.min(month).cast("int").alias("min_month"),
                              F.max(month).cast("int").alias("max_month"),
                              F.count(F.lit(1)).cast("long").alias("n_rows"))
    s, lo, hi = F.col(split), F.col("min_month"), F.col("max_month")
    upper = F.lit(True) if test_end is None else hi <= test_end
    ok = (F.when(s == "train", hi <= train_end)
          .when(s == "val", (lo > train_end) & (hi <= val_end))
          .when(s == "test", (lo > val_end) & upper)
          .when(s == "prospective", lo > (test_end if test_end is not None else val_end))
          .otherwise(F.lit(False)))
    return g.withColumn("ordered", ok)


def adjacent_months(df: DataFrame, *, period: str = "period", target_month: str = "target_month") -> DataFrame:
    """Rows whose target month is not exactly feature month + 1."""
    bad = (month_ordinal(target_month) - month_ordinal(period)) != 1
    return df.agg(F.count(F.lit(1)).cast("long").alias("n_rows"),
                  F.sum(bad.cast("long")).cast("long").alias("n_violations"))


def holdout_guard(fit_rows: DataFrame, holdout_rows: DataFrame, *, keys: list[str] = ("entity", "period"),
                  month: str = "target_month", limit: int) -> DataFrame:
    """A fit must not see holdout rows.  One row: fit rows, the latest fit target
    month, holdout keys found among the fit rows (left semi join) and a verdict."""
    overlap = fit_rows.select(*keys).join(holdout_rows.select(*keys).distinct(), list(keys), "left_semi")
    stats = fit_rows.agg(F.count(F.lit(1)).cast("long").alias("n_fit_rows"),
                         F.max(month).cast("int").alias("max_fit_month"))
    ov = overlap.agg(F.count(F.lit(1)).cast("long").alias("n_overlap"))
    one = stats.unionByName(ov, allowMissingColumns=True).agg(
        F.max("n_fit_rows").alias("n_fit_rows"), F.max("max_fit_month").alias("max_fit_month"),
        F.max("n_overlap").alias("n_overlap"))
    return one.withColumn("ok", (F.col("n_overlap") == 0) & (F.col("max_fit_month") <= limit))


class FitGuard:
    """V14 inside a pass that runs anyway: watch ``rows`` (use these in place of df), run an action over them, ``check``.

    The latest ``month`` of the rows where ``fit`` holds is collected by the action itself; no extra job."""

    def __init__(self, df: DataFrame, fit, *, month: str = "target_month", limit: int):
        self.month, self.limit, self.seen = month, limit, Observation("fit rows")
        self.rows = df.observe(self.seen, F.max(F.when(fit, F.col(month))).alias("latest"))

    def check(self) -> None:
        latest = self.seen.get["latest"]
        if latest is not None and latest > self.limit:
            raise ValidationError(f"fit rows reach {self.month}={latest} beyond {self.limit}: holdout leak")


DIGEST_CHUNK = 8 << 20


def _open(path: str):
    """A landed file for range reads, wherever it lies."""
    if not path.startswith("file:") and "://" in path:
        fs, local = pafs.FileSystem.from_uri(path)
        return fs.open_input_file(local)
    local = re.sub("^file:(//)?", "", path)
    return pafs.LocalFileSystem().open_input_file(local if os.path.exists(local) else unquote(local))


def _digest(path: str) -> tuple[str, int, list[str]]:
    """(SHA-256, bytes, columns of the footer) of one Parquet file, DIGEST_CHUNK bytes in memory at a time."""
    with _open(path) as f:
        sha, size = hashlib.sha256(), f.size()
        while chunk := f.read(DIGEST_CHUNK):
            sha.update(chunk)
        return sha.hexdigest(), size, pq.read_schema(f).names


def _digests(batches):
    for batch in batches:
        sha, size, names = zip(*map(_digest, batch.column(0).to_pylist())) if batch.num_rows else ((), (), ())
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sha, pa.string()), pa.array(size, pa.int64()),
                                          pa.array(names, pa.list_(pa.string()))], names=["file_path", "sha256", "n_bytes", "columns"])


def file_digests(files: DataFrame) -> DataFrame:
    """(file_path, sha256, n_bytes, columns) of the Parquet files listed in the first column; files of any size are read in
    chunks inside the tasks, spread over the cluster's cores."""
    ship_package(files.sparkSession)
    spread = files.toDF("file_path").repartition(files.sparkSession.sparkContext.defaultParallelism, "file_path")
    return spread.mapInArrow(_digests, "file_path string, sha256 string, n_bytes long, columns array<string>")


def same_file(path: str) -> Column:
    """A file's path without the scheme, which Spark's sources write in two ways for local files."""
    return F.regexp_replace(path, "^file:(//)?", "")


def drop_profile(spark: SparkSession, path: str, *, entity: str | None = None,
                 period=None) -> DataFrame:
    """Per landed Parquet file: SHA-256, bytes, columns of its own footer, rows, distinct
    entities, distinct periods.  Digests and footers are read file by file in the tasks, counts come from one
    aggregate grouped by the file path."""
    listed = spark.read.format("binaryFile").load(path).select("path")  # names only: the contents are not read here
    files = file_digests(listed).select("file_path", "sha256", "n_bytes", F.size("columns").cast("long").alias("n_columns"))
    data = spark.read.option("mergeSchema", "true").parquet(path)
    aggs = [F.count(F.lit(1)).cast("long").alias("n_rows")]
    if entity is not None:
        aggs.append(F.countDistinct(entity).cast("long").alias("n_entities"))
    if period is not None:
        aggs.append(F.countDistinct(period).cast("long").alias("n_periods"))
    counts = data.select("*", F.col("_metadata.file_path").alias("_counted")).groupBy("_counted").agg(*aggs)
    return (files.withColumn("_p", same_file("file_path")).join(counts.withColumn("_p", same_file("_counted")).drop("_counted"), "_p", "left")
            .drop("_p").withColumn("n_rows", F.coalesce("n_rows", F.lit(0)).cast("long")))


def raw_immutable(before: DataFrame, after: DataFrame) -> DataFrame:
    """Files whose hash changed, appeared or vanished between two profiles (full outer join)."""
    b = before.select("file_path", F.col("sha256").alias("sha_before"))
    a = after.select("file_path", F.col("sha256").alias("sha_after"))
    j = b.join(a, "file_path", "full_outer")
    status = (F.when(F.col("sha_before").isNull(), "added").when(F.col("sha_after").isNull(), "removed")
              .when(F.col("sha_before") != F.col("sha_after"), "changed"))
    return j.withColumn("status", status).where(F.col("status").isNotNull())


def column_profile(df: DataFrame) -> DataFrame:
    """(column_name, data_type, null_rate) of a drop in one aggregate."""
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    cols = df.columns
    row = df.agg(F.count(F.lit(1)).alias("_n"),
                 *[F.sum(F.col(f"`{c}`").isNull().cast("long")).alias(f"m{i}") for i, c in enumerate(cols)])
    pairs = ", ".join(f"'{_lit_name(c)}', '{types[c]}', m{i}" for i, c in enumerate(cols))
    return row.selectExpr("_n", f"stack({len(cols)}, {pairs}) AS (column_name, data_type, n_null)") \
        .select("column_name", "data_type",
                F.when(F.col("_n") > 0, F.col("n_null") / F.col("_n")).otherwise(F.lit(0.0)).alias("null_rate"))


def schema_drift(active: DataFrame, new: DataFrame, *, null_rate_shift: float = 0.05) -> DataFrame:
    """Added / removed columns, type changes and null-rate shifts between the
    active drop and a new one (full outer join of two column profiles)."""
    a = column_profile(active).select("column_name", F.col("data_type").alias("active_type"),
                                      F.col("null_rate").alias("active_null_rate"))
    n = column_profile(new).select("column_name", F.col("data_type").alias("new_type"),
                                   F.col("null_rate").alias("new_null_rate"))
    j = a.join(n, "column_name", "full_outer")
    status = (F.when(F.col("active_type").isNull(), "added")
              .when(F.col("new_type").isNull(), "removed")
              .when(F.col("active_type") != F.col("new_type"), "type_changed")
              .when(F.abs(F.col("new_null_rate") - F.col("active_null_rate")) > null_rate_shift, "null_rate_shift")
              .otherwise("unchanged"))
    return j.withColumn("status", status)


# The declared roles of a landed drop.
DROP_ROLES = ("descriptive", "explanatory", "prospective")


#: One row per landed file, whoever writes it
LEDGER = ("drop_id string, drop_time timestamp, sha256 string, n_bytes long, n_columns long, n_rows long, n_entities long, n_periods long, "
          "n_duplicate_keys long, schema_ok boolean, role string, recorded_at timestamp")


def ledger_rows(entries: DataFrame) -> DataFrame:
    """Entries in the ledger's columns; what they lack is null, the time of recording is now."""
    have = {**{c: F.col(c) for c in entries.columns}, "recorded_at": F.current_timestamp()}
    return entries.select(*[have.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in T.StructType.fromDDL(LEDGER)])


def check_role(role: str) -> None:
    if role not in DROP_ROLES:
        raise ValidationError(f"unknown drop role {role!r}")


def append_ledger(spark: SparkSession, ledger_path: str, entries: list[tuple[str, str, str, int]]) -> DataFrame:
    """Append (drop_id, sha256, role, n_rows) entries to an append-only Parquet ledger."""
    for _, _, role, _ in entries:
        check_role(role)
    df = spark.createDataFrame(entries, "drop_id string, sha256 string, role string, n_rows long")
    ledger_rows(df).write.mode("append").parquet(ledger_path)
    return spark.read.parquet(ledger_path)


def fit_eligible(rows: DataFrame, ledger: DataFrame, *, drop_col: str = "drop_id",
                 roles: tuple[str, ...] = ("explanatory",)) -> DataFrame:
    """Keep only rows of drops whose declared role allows a fit (semi join on the ledger)."""
    allowed = ledger.where(F.col("role").isin(*roles)).select(drop_col).distinct()
    return rows.join(allowed, drop_col, "left_semi")
