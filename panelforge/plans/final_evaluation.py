"""The final holdout evaluation as one Spark job graph.

labelled panel -> development (train + val) / holdout (test) -> preprocessor
refit on development -> ridge (alpha = 100) and the fixed forest -> baselines
-> ONE long prediction table -> comparison (M7 + P9 + O3), monthly (M8),
seen / unseen (M12), errors (M9, O4), percentiles (M10), categories (M11).
Every table is a single aggregate over the long predictions; the labelled
panel is checkpointed once because the fits read it several times.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelforge.operators import evaluate as ev
from panelforge.operators import linear as lin
from panelforge.operators import trees as tr
from panelforge.plans.design import forecasting_design
from panelforge.sources.sinks import sink_final_tables

MODELS = ["persistence", "ridge", "random_forest", "zero_return", "category_mean", "development_mean"]


def final_predictions(spark: SparkSession, sf_dir: str, which: str = "dense") -> DataFrame:
    design, feats, _ = forecasting_design(spark, sf_dir, which, fit_splits=("train", "val"))
    dev = design.where(F.col("split").isin("train", "val"))
    hold = design.where(F.col("split") == "test")
    ridge = lin.ridge(dev, feats, "target", 100.0)
    forest = tr.rf_final(dev, feats)
    scored = forest.predict(hold.withColumn("pred_ridge", ridge.predict_col()), out="pred_random_forest")
    # persistence uses the raw current return, not the scaled feature
    base = ev.add_baselines(scored.withColumn("ret", F.col("ret_raw")), dev.withColumn("ret", F.col("ret_raw")),
                            models=(ev.ZERO, ev.PERSISTENCE, ev.CATEGORY_MEAN, ev.DEV_MEAN))
    flagged = ev.seen_flag(base, dev)
    return ev.long_predictions(flagged, ["entity", "target_month", "category", "seen"])


def final_tables(spark: SparkSession, sf_dir: str, which: str = "dense") -> dict[str, DataFrame]:
    lp = final_predictions(spark, sf_dir, which).persist()
    errors = ev.residuals(lp)
    return {
        "comparison": ev.comparison_table(lp),
        "monthly": ev.monthly_metrics(lp, MODELS),
        "seen_unseen": ev.seen_unseen_metrics(lp),
        "percentiles": ev.error_percentiles(lp),
        "categories": ev.category_errors(lp, MODELS),
        "top_errors": ev.top_errors(errors.where(F.col("model") == "random_forest"), by="abs_error",
                                    keys=["entity", "target_month"]).drop("entity"),
        "error_rows": errors,
    }


def run_final_evaluation(spark: SparkSession, sf_dir: str, out_dir: str, which: str = "dense") -> dict:
    tables = final_tables(spark, sf_dir, which)
    sink_final_tables(tables, out_dir)
    return tables


def comparison_table_of(spark: SparkSession, sf_dir: str, which: str = "dense") -> DataFrame:
    return ev.comparison_table(final_predictions(spark, sf_dir, which))
