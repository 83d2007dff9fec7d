"""Ensemble validation: random searches for the forest and boosted trees over the
walk-forward folds, fold-level metrics of the winners, validation metrics against
persistence, train / validation gap, seen / unseen breakdown and importances."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelforge.operators import evaluate as ev
from panelforge.operators import trees as tr


def run_ensemble_validation(design: DataFrame, feats: list[str], *, draws: int = 15) -> dict:
    spark = design.sparkSession
    train = design.where(F.col("split") == "train")
    val = design.where(F.col("split") == "val")
    folds = tr.walk_forward()
    rf, rf_search = tr.tuned(train, feats, "forest", tr.RF_SEARCH, folds, random_draws=draws)
    gb, gb_search = tr.tuned(train, feats, "gbt", tr.GBT_SEARCH, folds, random_draws=draws)
    fold_rows = (tr.fold_metrics(train, feats, "forest", rf.params, folds).withColumn("model", F.lit("random_forest"))
                 .unionByName(tr.fold_metrics(train, feats, "gbt", gb.params, folds)
                              .withColumn("model", F.lit("gradient_boosting"))))
    both = design.where(F.col("split").isin("train", "val"))
    scored = gb.predict(rf.predict(both, out="pred_random_forest"), out="pred_gradient_boosting")
    scored = ev.add_baselines(scored.withColumn("ret", F.col("ret_raw")), train, models=(ev.PERSISTENCE,))
    long = ev.long_predictions(ev.seen_flag(scored, train), ["entity", "target_month", "category", "seen", "split"])
    val_long = long.where(F.col("split") == "val")
    val_metrics = ev.beats_baseline(ev.model_metrics(val_long, digits=None))
    gap = ev.train_val_gap(long.where(F.col("model") != ev.PERSISTENCE))
    return {"rf_search": rf_search, "gb_search": gb_search, "fold_metrics": fold_rows, "val_metrics": val_metrics,
            "train_val_gap": gap, "seen_unseen": ev.seen_unseen_metrics(val_long),
            "rf_importance": rf.impurity_importance(spark),
            "rf_permutation": tr.permutation_importance(rf, val, keys=["entity", "period"], n_repeats=5),
            "gb_permutation": tr.permutation_importance(gb, val, keys=["entity", "period"], n_repeats=5)}
