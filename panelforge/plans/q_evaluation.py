"""Evaluation-table queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelforge.operators import evaluate as ev
from panelforge.operators import splits as sp
from panelforge.plans.catalog import register
from panelforge.plans.frames import development_and_holdout, labelled, panel
from panelforge.plans.oracle_sql import DENSE_CTE, SPARSE_CTE, labelled_cte, preds_cte, split_cte, with_ctes

MODELS = [ev.PERSISTENCE, ev.ZERO, ev.CATEGORY_MEAN, ev.ENTITY_MEAN, ev.DEV_MEAN]
IDS = ["entity", "period", "target_month", "category", "split"]


def long_preds(spark, sf_dir, which="dense", fit_splits=("train", "val"), eval_splits=("test",)):
    lab = labelled(spark, sf_dir, which)
    fit = lab.where(F.col("split").isin(*fit_splits))
    rows = lab.where(F.col("split").isin(*eval_splits))
    return ev.long_predictions(ev.add_baselines(rows, fit, models=tuple(MODELS)), IDS)


def _sql(which: str, body: str, **kw) -> str:
    cte, name = (DENSE_CTE, "panel_dense") if which == "dense" else (SPARSE_CTE, "panel_sparse")
    return with_ctes(body, cte, labelled_cte(name), preds_cte(**kw))


@register("long_predictions", _sql("dense", """
SELECT entity, period, target_month, category, split, actual, model, round(pred, 6) AS pred FROM preds"""))
def long_predictions_q(spark, sf_dir):
    """(key, actual, model, prediction) rows for five baselines on the dense holdout."""
    lp = long_preds(spark, sf_dir)
    return lp.withColumn("pred", F.round("pred", 6))


@register("entity_mean_baseline", _sql("sparse", """
SELECT entity, target_month, round(pred, 6) AS pred FROM preds WHERE model = 'entity_mean'"""))
def entity_mean_baseline_q(spark, sf_dir):
    """Development mean per entity, overall development mean for unseen entities."""
    lab = labelled(spark, sf_dir, "sparse")
    dev, hold = development_and_holdout(lab)
    r = ev.add_baselines(hold, dev, models=(ev.ENTITY_MEAN,))
    return r.select("entity", "target_month", F.round(f"pred_{ev.ENTITY_MEAN}", 6).alias("pred"))


@register("category_mean_baseline", _sql("sparse", """
SELECT entity, target_month, round(pred, 6) AS pred FROM preds WHERE model = 'category_mean'"""))
def category_mean_baseline_q(spark, sf_dir):
    """J2 / M5."""
    lab = labelled(spark, sf_dir, "sparse")
    dev, hold = development_and_holdout(lab)
    r = ev.add_baselines(hold, dev, models=(ev.CATEGORY_MEAN,))
    return r.select("entity", "target_month", F.round(f"pred_{ev.CATEGORY_MEAN}", 6).alias("pred"))


SEEN_SQL = """
SELECT entity, period, target_month FROM hold h
WHERE {neg} EXISTS (SELECT 1 FROM fit f WHERE f.entity = h.entity)"""


@register("seen_entities", _sql("sparse", SEEN_SQL.format(neg="")))
def seen_entities_q(spark, sf_dir):
    """Holdout rows of entities present in development (left semi join)."""
    dev, hold = development_and_holdout(labelled(spark, sf_dir, "sparse"))
    return ev.seen_rows(hold, dev).select("entity", "period", "target_month")


@register("unseen_entities", _sql("sparse", SEEN_SQL.format(neg="NOT")))
def unseen_entities_q(spark, sf_dir):
    """The complement (left anti join)."""
    dev, hold = development_and_holdout(labelled(spark, sf_dir, "sparse"))
    return ev.unseen_rows(hold, dev).select("entity", "period", "target_month")


@register("align_by_key", with_ctes("""
SELECT l.entity, l.period, l.target, p.split AS random_split
FROM labelled l JOIN parts p ON l.entity = p.entity AND l.period = p.period""",
                                    SPARSE_CTE, labelled_cte("panel_sparse"), split_cte("panel_sparse")))
def align_by_key_q(spark, sf_dir):
    """Labels computed on the panel attached to the labelled rows by key, not position."""
    labels = sp.random_split(panel(spark, sf_dir, "sparse"), ["entity", "period"], out="random_split")
    lab = labelled(spark, sf_dir, "sparse").select("entity", "period", "target")
    return ev.align_by_key(lab, labels, ["entity", "period"], ["random_split"])


def _monthly_sql() -> str:
    cols = ",\n       ".join(
        f"round(avg(CASE WHEN model = '{m}' THEN abs(actual - pred) END), 6) AS {m}_mae,\n       "
        f"round(sqrt(avg(CASE WHEN model = '{m}' THEN (actual - pred) * (actual - pred) END)), 6) AS {m}_rmse"
        for m in MODELS)
    return _sql("dense", f"""
SELECT target_month, CAST(count(*) FILTER (WHERE model = '{MODELS[0]}') AS BIGINT) AS n_rows,
       round(avg(actual) FILTER (WHERE model = '{MODELS[0]}'), 6) AS actual_mean,
       round(stddev_pop(actual) FILTER (WHERE model = '{MODELS[0]}'), 6) AS actual_std,
       {cols}
FROM preds GROUP BY target_month""")


@register("monthly_metrics", _monthly_sql())
def monthly_metrics_q(spark, sf_dir):
    """M8: per target month, actual mean / std and MAE, RMSE of every model (explicit pivot list)."""
    return ev.monthly_metrics(long_preds(spark, sf_dir), MODELS)


@register("error_percentiles", _sql("dense", """
SELECT model, round(quantile_cont(abs(actual - pred), 0.5), 6) AS p50,
       round(quantile_cont(abs(actual - pred), 0.75), 6) AS p75,
       round(quantile_cont(abs(actual - pred), 0.9), 6) AS p90,
       round(quantile_cont(abs(actual - pred), 0.95), 6) AS p95
FROM preds GROUP BY model"""))
def error_percentiles_q(spark, sf_dir):
    """Exact percentiles of the absolute error per model."""
    return ev.error_percentiles(long_preds(spark, sf_dir))


def _category_sql() -> str:
    cols = ",\n       ".join(f"round(avg(CASE WHEN model = '{m}' THEN abs(actual - pred) END), 6) AS {m}_mae"
                             for m in MODELS)
    return _sql("dense", f"""
SELECT category, CAST(count(*) FILTER (WHERE model = '{MODELS[0]}') AS BIGINT) AS n_rows,
       {cols}
FROM preds GROUP BY category""")


@register("category_errors", _category_sql())
def category_errors_q(spark, sf_dir):
    """Rows and MAE per category and model."""
    return ev.category_errors(long_preds(spark, sf_dir), MODELS)


@register("top_errors", _sql("dense", """
SELECT CAST(row_number() OVER (ORDER BY abs_error DESC, entity, target_month) AS INTEGER) AS error_id,
       target_month, category, actual, pred, abs_error
FROM (SELECT entity, target_month, category, actual, pred, round(abs(actual - pred), 6) AS abs_error
      FROM preds WHERE model = 'persistence'
      ORDER BY abs(actual - pred) DESC, entity, target_month LIMIT 10)"""))
def top_errors_q(spark, sf_dir):
    """M9 + O4: the ten largest persistence errors, anonymized (no entity column)."""
    lp = ev.residuals(long_preds(spark, sf_dir).where(F.col("model") == ev.PERSISTENCE))
    top = ev.top_errors(lp, by="abs_error", keys=["entity", "target_month"], n=10)
    return top.select("error_id", "target_month", "category", "actual", "pred",
                      F.round("abs_error", 6).alias("abs_error"))


@register("residuals", _sql("dense", """
SELECT entity, target_month, model, round(actual - pred, 6) AS residual, round(abs(actual - pred), 6) AS abs_error
FROM preds"""))
def residuals_q(spark, sf_dir):
    """P8 for every model on the dense holdout."""
    r = ev.residuals(long_preds(spark, sf_dir))
    return r.select("entity", "target_month", "model", F.round("residual", 6).alias("residual"),
                    F.round("abs_error", 6).alias("abs_error"))


def _metrics_body(src: str = "preds", extra_group: str = "") -> str:
    g = f", {extra_group}" if extra_group else ""
    return f"""
c AS (SELECT *, actual - avg(actual) OVER (PARTITION BY model{g}) AS centered FROM {src}),
met AS (
  SELECT model{g}, count(*) AS n_rows, avg(abs(actual - pred)) AS mae,
         sqrt(avg((actual - pred) * (actual - pred))) AS rmse,
         CASE WHEN sum(centered * centered) > 0
              THEN 1 - sum((actual - pred) * (actual - pred)) / sum(centered * centered)
              WHEN sum((actual - pred) * (actual - pred)) = 0 THEN 1 ELSE 0 END AS r2
  FROM c GROUP BY model{g})"""


@register("beats_baseline", _sql("dense", "," + _metrics_body() + """
SELECT m.model, m.mae < p.mae AS beats_mae, m.rmse < p.rmse AS beats_rmse, m.r2 > p.r2 AS beats_r2
FROM met m, (SELECT * FROM met WHERE model = 'persistence') p""").replace("WITH ", "WITH ", 1))
def beats_baseline_q(spark, sf_dir):
    """P10: does each model beat persistence on MAE, RMSE and R^2?"""
    m = ev.model_metrics(long_preds(spark, sf_dir), digits=None)
    return ev.beats_baseline(m).select("model", "beats_mae", "beats_rmse", "beats_r2")


@register("train_val_gap", _sql("dense", "," + _metrics_body(extra_group="split") + """
SELECT t.model, round(t.mae, 6) AS train_mae, round(v.mae, 6) AS val_mae, round(v.mae - t.mae, 6) AS mae_gap,
       round(t.r2, 6) AS train_r2, round(v.r2, 6) AS val_r2, round(t.r2 - v.r2, 6) AS r2_gap
FROM met t JOIN met v ON t.model = v.model AND t.split = 'train' AND v.split = 'val'""",
                                 fit_splits="'train'", eval_split="'train', 'val'"))
def train_val_gap_q(spark, sf_dir):
    """Baselines fitted on train, scored on train and val, with the gap."""
    lp = long_preds(spark, sf_dir, fit_splits=("train",), eval_splits=("train", "val"))
    return ev.train_val_gap(lp)


@register("seen_unseen_metrics", _sql("sparse", """,
flagged AS (SELECT p.*, EXISTS (SELECT 1 FROM fit f WHERE f.entity = p.entity) AS seen FROM preds p),
grid AS (SELECT g.seen, m.model FROM (VALUES (true), (false)) g(seen),
         (SELECT DISTINCT model FROM preds) m),
c AS (SELECT *, actual - avg(actual) OVER (PARTITION BY model, seen) AS centered FROM flagged),
met AS (
  SELECT seen, model, count(*) AS n_rows, count(DISTINCT entity) AS n_entities, avg(actual) AS target_mean,
         stddev_pop(actual) AS target_std, avg(abs(actual - pred)) AS mae,
         sqrt(avg((actual - pred) * (actual - pred))) AS rmse,
         CASE WHEN sum(centered * centered) > 0
              THEN 1 - sum((actual - pred) * (actual - pred)) / sum(centered * centered)
              WHEN sum((actual - pred) * (actual - pred)) = 0 THEN 1 ELSE 0 END AS r2
  FROM c GROUP BY seen, model)
SELECT CASE WHEN g.seen THEN 'seen' ELSE 'unseen' END AS entity_group, g.model,
       CAST(coalesce(m.n_rows, 0) AS BIGINT) AS n_rows, CAST(coalesce(m.n_entities, 0) AS BIGINT) AS n_entities,
       round(coalesce(m.target_mean, 0), 6) AS target_mean, round(coalesce(m.target_std, 0), 6) AS target_std,
       round(coalesce(m.mae, 0), 6) AS mae, round(coalesce(m.rmse, 0), 6) AS rmse, round(coalesce(m.r2, 0), 6) AS r2
FROM grid g LEFT JOIN met m ON g.seen = m.seen AND g.model = m.model"""))
def seen_unseen_metrics_q(spark, sf_dir):
    """M12 on the sparse holdout (both groups non-empty), with zero rows for an empty group."""
    lab = labelled(spark, sf_dir, "sparse")
    dev, hold = development_and_holdout(lab)
    rows = ev.seen_flag(hold, dev)
    lp = ev.long_predictions(ev.add_baselines(rows, dev, models=tuple(MODELS)), [*IDS, "seen"])
    return ev.seen_unseen_metrics(lp)


@register("residual_fitted_data", _sql("dense", """
SELECT entity, target_month, model, round(pred, 6) AS fitted, round(actual - pred, 6) AS residual FROM preds"""))
def residual_fitted_data_q(spark, sf_dir):
    """The table behind the residual-versus-fitted figure, every model on the dense holdout."""
    r = ev.residuals(long_preds(spark, sf_dir))
    return r.select("entity", "target_month", "model", F.round("pred", 6).alias("fitted"),
                    F.round("residual", 6).alias("residual"))
