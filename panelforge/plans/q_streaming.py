"""G1 streaming ingestion and the sinks, as registered queries."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from panelforge.plans.catalog import register
from panelforge.plans.frames import panel
from panelforge.plans.oracle_sql import DENSE_CTE, SPARSE_CTE, with_ctes
from panelforge.session import checkpoint_root
from panelforge.sources.panels import DENSE_COLUMNS, SPARSE_COLUMNS
from panelforge.streaming.ingest import current_panel, ingest_drops


def scratch(spark, name: str) -> str:
    """A fresh folder under the session's shared checkpoint root (never a machine-local temp dir)."""
    return f"{checkpoint_root(spark).rstrip('/')}/panelforge-{name}-{uuid.uuid4().hex[:12]}"


@register("ingest_drops", with_ctes(f"SELECT {', '.join(DENSE_COLUMNS)} FROM panel_dense", DENSE_CTE))
def ingest_drops_q(spark, sf_dir):
    """G1: two overlapping monthly drops of the dense panel are landed, ingested by a
    Structured Streaming job (availableNow, one file per micro-batch, idempotent
    foreachBatch) and merged by period to the latest drop per key -- which must give back the
    panel exactly."""
    root = scratch(spark, "ingest")
    p = panel(spark, sf_dir, "dense")
    p.filter(F.col("period") <= 200012).write.parquet(f"{root}/landing/drop=0001")
    p.filter(F.col("period") >= 200001).write.parquet(f"{root}/landing/drop=0002")
    ingest_drops(spark, f"{root}/landing", f"{root}/store", f"{root}/ledger", f"{root}/checkpoint",
                 p.schema, required=tuple(DENSE_COLUMNS))
    return current_panel(spark, f"{root}/store", f"{root}/ledger").select(*DENSE_COLUMNS)


YEARS = "CAST(period // 100 AS INTEGER) AS year, "
LEDGER_SQL = with_ctes(f"""
SELECT {YEARS}CAST(count(*) AS BIGINT) AS n_rows, CAST(count(DISTINCT entity) AS BIGINT) AS n_entities,
       CAST(count(DISTINCT period) AS BIGINT) AS n_periods, CAST(0 AS BIGINT) AS n_duplicate_keys,
       CAST({len(SPARSE_COLUMNS)} AS BIGINT) AS n_columns, true AS schema_ok, 'explanatory' AS role
FROM panel_sparse GROUP BY year""", SPARSE_CTE)


def _land_years(p, landing: str) -> None:
    """One file a year, as a yearly drop lands."""
    year = F.floor(F.col("period") / 100).cast("int")
    p.withColumn("year", year).repartition(32, "year").write.partitionBy("year").parquet(landing)


@register("drop_ledger", LEDGER_SQL)
def drop_ledger_q(spark, sf_dir):
    """V18 via G1: the ledger of yearly files of the sparse panel (rows, entities, periods, duplicate keys, columns of the footer)."""
    root = scratch(spark, "ledger")
    p = panel(spark, sf_dir, "sparse")
    _land_years(p, f"{root}/landing")
    ingest_drops(spark, f"{root}/landing", f"{root}/store", f"{root}/ledger", f"{root}/checkpoint", p.schema, required=tuple(SPARSE_COLUMNS))
    entries = spark.read.parquet(f"{root}/ledger")
    return entries.select(F.regexp_extract("drop_id", "year=([0-9]+)", 1).cast("int").alias("year"), "n_rows", "n_entities", "n_periods",
                          "n_duplicate_keys", "n_columns", "schema_ok", "role")


@register("late_correction", with_ctes("""
SELECT entity, period, category, n_orders, aum, sd_price, CASE WHEN period = 199706 THEN round(ret + 1, 9) ELSE ret END AS ret
FROM panel_sparse""", SPARSE_CTE))
def late_correction_q(spark, sf_dir):
    """G1: the sparse panel lands by years and is ingested; then a corrected month lands, is merged into its own period alone,
    and the current panel shows it."""
    root = scratch(spark, "late")
    p = panel(spark, sf_dir, "sparse")
    where = (f"{root}/landing", f"{root}/store", f"{root}/ledger", f"{root}/checkpoint", p.schema)
    _land_years(p, f"{root}/landing/yearly")
    ingest_drops(spark, *where)
    p.where("period = 199706").withColumn("ret", F.round(F.col("ret") + 1, 9)).write.parquet(f"{root}/landing/correction")
    ingest_drops(spark, *where)
    return current_panel(spark, f"{root}/store", f"{root}/ledger").select(*SPARSE_COLUMNS)
