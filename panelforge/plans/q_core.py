"""Minimum slice: panel -> W1 -> C2 -> baselines -> M1 -> M7 (+P9, O3)."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelforge.operators import evaluate as ev
from panelforge.plans.catalog import register
from panelforge.plans.frames import PANELS, development_and_holdout, labelled
from panelforge.plans.oracle_sql import DENSE_CTE, SPARSE_CTE, labelled_cte, with_ctes
from panelforge.sources.panels import DENSE_COLUMNS, SPARSE_COLUMNS

LABELLED_COLUMNS = ["entity", "period", "category", "ret", "target", "target_month", "split"]


@register("scan_panel_dense", with_ctes(f"SELECT {', '.join(DENSE_COLUMNS)} FROM panel_dense", DENSE_CTE))
def scan_panel_dense(spark, sf_dir):
    """Derivation of the dense entity x month panel (supplier x ship month) from the star schema."""
    return PANELS["dense"](spark, sf_dir)


@register("scan_panel_sparse", with_ctes(f"SELECT {', '.join(SPARSE_COLUMNS)} FROM panel_sparse", SPARSE_CTE))
def scan_panel_sparse(spark, sf_dir):
    """Derivation of the sparse panel (customer x order month)."""
    return PANELS["sparse"](spark, sf_dir)


@register("next_month_target", with_ctes(
    f"SELECT {', '.join(LABELLED_COLUMNS)} FROM labelled", DENSE_CTE, labelled_cte("panel_dense")))
def next_month_target_q(spark, sf_dir):
    """W1 + P4 + C2 on the dense panel."""
    return labelled(spark, sf_dir, "dense").select(*LABELLED_COLUMNS)


@register("next_month_target_sparse", with_ctes(
    f"SELECT {', '.join(LABELLED_COLUMNS)} FROM labelled", SPARSE_CTE, labelled_cte("panel_sparse")))
def next_month_target_sparse_q(spark, sf_dir):
    """W1 on the sparse panel: most months have no adjacent next month."""
    return labelled(spark, sf_dir, "sparse").select(*LABELLED_COLUMNS)


@register("chronological_split", with_ctes(
    """SELECT split, CAST(count(*) AS BIGINT) AS n_rows, CAST(min(target_month) AS INTEGER) AS min_target_month,
              CAST(max(target_month) AS INTEGER) AS max_target_month, CAST(count(DISTINCT entity) AS BIGINT) AS n_entities
       FROM labelled GROUP BY split""", DENSE_CTE, labelled_cte("panel_dense")))
def chronological_split_q(spark, sf_dir):
    """C2 summary: rows, month range and entities per split label."""
    lab = labelled(spark, sf_dir, "dense")
    return lab.groupBy("split").agg(
        F.count(F.lit(1)).cast("long").alias("n_rows"),
        F.min("target_month").cast("int").alias("min_target_month"),
        F.max("target_month").cast("int").alias("max_target_month"),
        F.countDistinct("entity").cast("long").alias("n_entities"))


def holdout_predictions(spark, sf_dir, which="dense", models=None):
    lab = labelled(spark, sf_dir, which)
    dev, hold = development_and_holdout(lab)
    models = models or (ev.ZERO, ev.PERSISTENCE, ev.CATEGORY_MEAN, ev.DEV_MEAN)
    rows = ev.add_baselines(hold, dev, models=models)
    return ev.long_predictions(rows, ["entity", "target_month", "category"])


def _baseline_sql(panel_cte: str, panel_name: str) -> str:
    body = """,
dev AS (SELECT * FROM labelled WHERE split IN ('train', 'val')),
hold AS (SELECT * FROM labelled WHERE split = 'test'),
dev_mean AS (SELECT avg(target) AS m FROM dev),
cat_mean AS (SELECT category, avg(target) AS cm FROM dev GROUP BY category),
preds AS (
  SELECT target AS actual, 'zero_return' AS model, CAST(0 AS DOUBLE) AS pred FROM hold
  UNION ALL SELECT target, 'persistence', ret FROM hold
  UNION ALL SELECT h.target, 'category_mean', coalesce(c.cm, (SELECT m FROM dev_mean))
            FROM hold h LEFT JOIN cat_mean c ON h.category = c.category
  UNION ALL SELECT target, 'development_mean', (SELECT m FROM dev_mean) FROM hold
),
dev2 AS (SELECT *, actual - avg(actual) OVER (PARTITION BY model) AS centered FROM preds),
met AS (
  SELECT model, count(*) AS n_rows,
         avg(abs(actual - pred)) AS mae,
         sqrt(avg((actual - pred) * (actual - pred))) AS rmse,
         CASE WHEN sum(centered * centered) > 0
              THEN 1 - sum((actual - pred) * (actual - pred)) / sum(centered * centered)
              WHEN sum((actual - pred) * (actual - pred)) = 0 THEN 1 ELSE 0 END AS r2,
         avg(CASE WHEN actual <> 0 THEN abs((actual - pred) / actual) END) * 100 AS mape,
         avg(pred) AS mean_prediction, avg(actual) AS mean_actual, stddev_pop(actual) AS std_actual
  FROM dev2 GROUP BY model
)
SELECT m.model, CAST(m.n_rows AS BIGINT) AS n_rows, round(m.mae, 6) AS mae, round(m.rmse, 6) AS rmse,
       round(m.r2, 6) AS r2, round(m.mape, 6) AS mape, round(m.mean_prediction, 6) AS mean_prediction,
       round(m.mean_actual, 6) AS mean_actual, round(m.std_actual, 6) AS std_actual,
       round((p.mae - m.mae) / p.mae, 6) AS rel_mae_vs_persistence,
       round((p.rmse - m.rmse) / p.rmse, 6) AS rel_rmse_vs_persistence,
       round((z.mae - m.mae) / z.mae, 6) AS rel_mae_vs_zero_return,
       round((z.rmse - m.rmse) / z.rmse, 6) AS rel_rmse_vs_zero_return,
       CAST(row_number() OVER (ORDER BY m.rmse, m.model) AS INTEGER) AS rank
FROM met m, (SELECT mae, rmse FROM met WHERE model = 'persistence') p,
     (SELECT mae, rmse FROM met WHERE model = 'zero_return') z"""
    ctes = "WITH " + ",".join([panel_cte, labelled_cte(panel_name)])
    return ctes + body


BASELINE_SQL_DENSE = _baseline_sql(DENSE_CTE, "panel_dense")


@register("baseline_comparison", BASELINE_SQL_DENSE)
def baseline_comparison(spark, sf_dir):
    """Flagship (M2, M3, M5, M6 -> M1 -> M7 + P9 + O3): which simple baseline predicts
    next month best on the dense holdout?"""
    return ev.comparison_table(holdout_predictions(spark, sf_dir, "dense"))


@register("baseline_comparison_sparse", _baseline_sql(SPARSE_CTE, "panel_sparse"))
def baseline_comparison_sparse(spark, sf_dir):
    """The same comparison on the sparse panel (customer x order month)."""
    return ev.comparison_table(holdout_predictions(spark, sf_dir, "sparse"))
