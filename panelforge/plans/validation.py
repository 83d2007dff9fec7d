"""The validation stage as one run: S1 -> V1-V7, V9, V4, V10 -> V8 -> S4 -> S2.

A landed drop is scanned under its declared schema; lines that don't fit go to a rejects table. The
checks report, they don't stop the run (as the reference warns); a panel key that is not unique after
exact duplicates are gone does, since every later stage relies on it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelforge.operators import validate as va
from panelforge.sources.scan import landed_columns, scan_interim, scan_panel, scan_rejects
from panelforge.sources.sinks import sink_interim
from panelforge.session import checkpoint_root


def run_validation(spark: SparkSession, drop: str, schema: str, interim: str, *, required: list[str], target: str,
                   prohibited: list[str] = (), keys: tuple[str, ...] = ("entity", "period"), fmt: str = "csv") -> dict[str, DataFrame]:
    """Tables of the run: report (check_name, n), missing, ranges, schema, prohibited, rejects, panel (read back from S4)."""
    checkpoint_root(spark)
    rows = scan_panel(spark, drop, schema, fmt).checkpoint(eager=True)  # the text is parsed once
    rejects = scan_rejects(spark, drop, schema, fmt)
    present = spark.createDataFrame([], ", ".join(f"`{c}` string" for c in landed_columns(spark, drop, fmt)))
    schema_rows = va.schema_check(spark, present, required, target)
    leaks = va.leakage_columns(spark, present, list(prohibited))
    missing, ranges = va.missing_counts(rows), va.value_range_checks(rows)
    clean = va.dedup_rows(rows).checkpoint(eager=True)
    va.assert_panel_key_unique(clean, list(keys))
    sink_interim(clean, interim, keys=keys)
    panel = scan_interim(spark, interim)
    counts = [
        ("rejected_lines", rejects.agg(F.count(F.lit(1)).alias("n"))),
        ("rows", rows.agg(F.count(F.lit(1)).alias("n"))),
        ("missing_values", missing.agg(F.sum("n_missing").alias("n"))),
        ("duplicate_rows", va.duplicate_count(rows).select(F.col("n_duplicates").alias("n"))),
        ("infinite_columns", ranges.agg(F.count_if("has_infinite").alias("n"))),
        ("invalid_probability_columns", ranges.agg(F.count_if("invalid_probability").alias("n"))),
        ("negative_risk_columns", ranges.agg(F.count_if("negative_risk").alias("n"))),
        ("constant_columns", ranges.agg(F.count_if("is_constant").alias("n"))),
        ("absent_columns", schema_rows.agg(F.count_if(~F.col("present")).alias("n"))),
        ("prohibited_columns", leaks.agg(F.count(F.lit(1)).alias("n"))),
        ("interim_rows", panel.agg(F.count(F.lit(1)).alias("n"))),
    ]
    report = None
    for name, one in counts:
        row = one.select(F.lit(name).alias("check_name"), F.coalesce(F.col("n"), F.lit(0)).cast("long").alias("n"))
        report = row if report is None else report.unionByName(row)
    return {"report": report, "missing": missing, "ranges": ranges, "schema": schema_rows, "prohibited": leaks, "rejects": rejects, "panel": panel}
