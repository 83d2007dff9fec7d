"""Shared frames of the registered queries: panel -> W1 -> C2."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelforge.operators.panel import next_month_target
from panelforge.operators.splits import TEST_END, TRAIN_END, VAL_END, chronological_split
from panelforge.sources.interim import materialized
from panelforge.sources.panels import panel_dense, panel_sparse

PANELS = {"dense": panel_dense, "sparse": panel_sparse}
SOURCES = {"dense": ["lineitem", "part", "supplier", "nation", "region"], "sparse": ["orders", "customer"]}


def panel(spark: SparkSession, sf_dir: str, which: str = "dense") -> DataFrame:
    """The interim panel (S4 -> S2): derived from the star schema once per source version."""
    sources = [f"{sf_dir.rstrip('/')}/{t}.parquet" for t in SOURCES[which]]
    return materialized(spark, f"panel_{which}", sources, lambda: PANELS[which](spark, sf_dir))


def labelled(spark: SparkSession, sf_dir: str, which: str = "dense") -> DataFrame:
    """Forecasting frame: next-month target, target month, split label."""
    p = panel(spark, sf_dir, which)
    lab = next_month_target(p, entity="entity", period="period", target="ret")
    return chronological_split(lab, col="target_month", train_end=TRAIN_END, val_end=VAL_END,
                               test_end=TEST_END)


def development_and_holdout(lab: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Development = train + val rows; holdout = test rows (prospective rows are never used)."""
    return (lab.where(F.col("split").isin("train", "val")), lab.where(F.col("split") == "test"))
