"""Scans (S1-S3) with declared schemas.  NaN becomes NULL once, here."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelforge.functions.safe import nan_to_null
from panelforge.sources.publish import current_version


def _nan_free(df: DataFrame) -> DataFrame:
    return df.select(*[nan_to_null(f.name).alias(f.name) if isinstance(f.dataType, (T.DoubleType, T.FloatType))
                       else F.col(f.name) for f in df.schema.fields])


CORRUPT = "_corrupt_line"


def landed_columns(spark: SparkSession, path: str, fmt: str = "parquet") -> list[str]:
    """The columns that the drop itself has (CSV header or Parquet footer), for V4."""
    reader = spark.read.format(fmt)
    return (reader.option("header", "true") if fmt == "csv" else reader).load(path).columns


def scan_panel(spark: SparkSession, path: str, schema: T.StructType | str | None = None,
               fmt: str = "parquet") -> DataFrame:
    """A landed panel drop (Parquet or CSV with header); Excel is converted upstream.

    A CSV line that doesn't fit the declared schema is not in the result; ``scan_rejects`` has it."""
    return _nan_free(_declared(spark, path, schema, fmt, False))


def scan_rejects(spark: SparkSession, path: str, schema: T.StructType | str, fmt: str = "csv") -> DataFrame:
    """Lines of a CSV drop that don't fit the declared schema: (file_path, line)."""
    if fmt != "csv":
        return spark.createDataFrame([], "file_path string, line string")
    return _declared(spark, path, schema, fmt, True).select(F.col("_file").alias("file_path"), F.col(CORRUPT).alias("line"))


def _declared(spark: SparkSession, path: str, schema, fmt: str, rejects: bool) -> DataFrame:
    reader = spark.read.format(fmt)
    if fmt != "csv":
        return (reader.schema(schema) if schema is not None else reader).load(path)
    reader = reader.option("header", "true")
    if schema is None:
        return reader.load(path)
    kind = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    wide = T.StructType([*kind.fields, T.StructField(CORRUPT, T.StringType())])
    rows = reader.schema(wide).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT).option(
        "enforceSchema", "false").load(path).select("*", F.col("_metadata.file_path").alias("_file"))
    # the second condition always holds: it reads every declared column, since Spark parses only what a plan reads
    # and would otherwise pass lines whose fault lies in a column that nobody selects
    bad = F.col(CORRUPT).isNotNull() & (F.hash(*[f.name for f in kind.fields]) >= F.lit(-(1 << 31)))
    return rows.where(bad) if rejects else rows.where(~bad).drop(CORRUPT, "_file")


def scan_interim(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """The cleaned panel that S4 published last."""
    return scan_panel(spark, f"{path.rstrip('/')}/{current_version(spark, path)}", schema)


def scan_processed(spark: SparkSession, path: str, mode: str, split: str | None = None) -> DataFrame:
    """S3: the design table of a mode; ``split`` prunes the partition folders."""
    df = spark.read.parquet(f"{path.rstrip('/')}/mode={mode}")
    return df.where(F.col("split") == split) if split else df
