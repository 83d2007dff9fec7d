"""Forecasting run: next-month target, chronological split, train-only preprocessing,
walk-forward CV for ridge / elastic net / tree, baselines, validation comparison and
seen / unseen breakdown.  Takes any panel with canonical column names."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelforge.operators import evaluate as ev
from panelforge.operators import linear as lin
from panelforge.operators import trees as tr
from panelforge.operators.panel import next_month_target
from panelforge.operators.splits import TEST_END, TRAIN_END, VAL_END, chronological_split, fold_bounds, \
    walk_forward_folds
from panelforge.plans.design import design_from_labelled, walk_forward_keys
from panelforge.sources import sinks
from panelforge.sources.models import ModelStore


def run_forecasting(panel: DataFrame, numeric: list[str], *, out_dir: str | None = None,
                    train_end: int = TRAIN_END, val_end: int = VAL_END, test_end: int = TEST_END) -> dict:
    spark = panel.sparkSession
    lab = chronological_split(next_month_target(panel), train_end=train_end, val_end=val_end, test_end=test_end)
    design, feats, pre = design_from_labelled(lab, [*numeric, "ret"], limit=train_end)
    train = design.where(F.col("split") == "train")
    val = design.where(F.col("split") == "val")
    bounds = fold_bounds(walk_forward_folds(train))
    if bounds.where(~F.col("ordered")).count():
        raise AssertionError("walk-forward fold overlap")
    months = sorted(r[0] for r in train.select("target_month").distinct().collect())
    folds = walk_forward_keys(months)
    ridge, ridge_cv = lin.ridge_cv(train, feats, "target", fold_col="target_month", folds=folds)
    enet, enet_cv = lin.elasticnet_cv(train, feats, "target", fold_col="target_month", folds=folds)
    tree, tree_cv = tr.tuned(train, feats, "tree", tr.TREE_GRID, tr.walk_forward())
    scored = tree.predict(val.withColumn("pred_ridge", ridge.predict_col())
                          .withColumn("pred_elastic_net", enet.predict_col()), out="pred_decision_tree")
    scored = scored.withColumn("pred_mean_baseline", F.lit(ev.fit_mean(train, "target")))
    base = ev.add_baselines(scored.withColumn("ret", F.col("ret_raw")), train,
                            models=(ev.ZERO, ev.PERSISTENCE, ev.ENTITY_MEAN, ev.CATEGORY_MEAN))
    long = ev.long_predictions(ev.seen_flag(base, train), ["entity", "target_month", "category", "seen"]).persist()
    out = {"comparison": ev.comparison_table(long), "seen_unseen": ev.seen_unseen_metrics(long),
           "ridge_cv": ridge_cv, "elastic_net_cv": enet_cv, "tree_cv": tree_cv, "fold_bounds": bounds,
           "ridge_coefficients": ridge.coefficients(spark)}
    if out_dir:
        sinks.sink_processed(design, f"{out_dir}/processed", "forecasting")
        sinks.sink_comparison(out["comparison"], f"{out_dir}/comparison/forecasting")
        sinks.sink_predictions(ev.residuals(long), f"{out_dir}/predictions", "forecasting_validation")
        out["model_version"] = ModelStore(spark, f"{out_dir}/models").save(
            "forecasting", {"ridge": ridge, "elastic_net": enet, "decision_tree": tree}, train, preprocessor=pre, note={"train_end": train_end})
    out["preprocessor"] = pre
    return out
