"""Panel diagnostics, projections and split queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelforge.operators import panel as pn
from panelforge.operators import splits as sp
from panelforge.plans.catalog import register
from panelforge.plans.frames import development_and_holdout, labelled, panel
from panelforge.plans.oracle_sql import DENSE_CTE, SPARSE_CTE, labelled_cte, split_cte, with_ctes
from panelforge.sources.panels import DENSE_FEATURES


@register("panel_shape", with_ctes("""
SELECT CAST(count(DISTINCT entity) AS BIGINT) AS n_entities, CAST(count(DISTINCT period) AS BIGINT) AS n_periods,
       CAST(count(*) AS BIGINT) AS n_obs FROM panel_dense""", DENSE_CTE))
def panel_shape_q(spark, sf_dir):
    """A1."""
    return pn.panel_shape(panel(spark, sf_dir, "dense"))


@register("panel_balance", with_ctes("""
SELECT CAST(min(n) AS BIGINT) AS min_obs, CAST(max(n) AS BIGINT) AS max_obs,
       CAST((SELECT count(DISTINCT period) FROM panel_sparse) AS BIGINT) AS n_periods,
       (min(n) = max(n) AND max(n) = (SELECT count(DISTINCT period) FROM panel_sparse)) AS balanced
FROM (SELECT entity, count(*) AS n FROM panel_sparse GROUP BY entity)""", SPARSE_CTE))
def panel_balance_q(spark, sf_dir):
    """A2 on the (unbalanced) sparse panel."""
    return pn.panel_balance(panel(spark, sf_dir, "sparse"))


@register("obs_per_entity", with_ctes("""
SELECT CAST(count(*) AS BIGINT) AS n_entities, round(avg(n), 6) AS obs_mean, round(stddev_samp(n), 6) AS obs_std,
       CAST(min(n) AS DOUBLE) AS obs_min, round(quantile_cont(n, 0.25), 6) AS obs_p25,
       round(quantile_cont(n, 0.5), 6) AS obs_p50, round(quantile_cont(n, 0.75), 6) AS obs_p75,
       CAST(max(n) AS DOUBLE) AS obs_max
FROM (SELECT entity, count(*) AS n FROM panel_sparse GROUP BY entity)""", SPARSE_CTE))
def obs_per_entity_q(spark, sf_dir):
    """A3 on the sparse panel."""
    return pn.obs_per_entity(panel(spark, sf_dir, "sparse"))


VARDEC_SQL = """,
em AS (SELECT entity, avg(ret) AS m FROM panel_dense GROUP BY entity),
dm AS (SELECT p.ret - em.m AS d FROM panel_dense p JOIN em ON p.entity = em.entity),
mm AS (SELECT period, avg(ret) AS m FROM panel_dense GROUP BY period),
cm AS (SELECT category, avg(ret) AS m FROM panel_dense GROUP BY category),
vd AS (
  SELECT avg(ret) AS overall_mean, stddev_samp(ret) AS overall_std, var_samp(ret) AS overall_variance,
         (SELECT stddev_samp(m) FROM em) AS between_std, (SELECT var_samp(m) FROM em) AS between_variance,
         (SELECT stddev_samp(d) FROM dm) AS within_std,
         (SELECT var_samp(m) FROM mm) AS month_variance, (SELECT var_samp(m) FROM cm) AS category_variance
  FROM panel_dense)"""


@register("variance_decomposition", "WITH " + DENSE_CTE + VARDEC_SQL + """
SELECT round(overall_mean, 6) AS overall_mean, round(overall_std, 6) AS overall_std,
       round(between_std, 6) AS between_std, round(within_std, 6) AS within_std,
       round(month_variance, 6) AS month_variance, round(category_variance, 6) AS category_variance,
       round(between_variance, 6) AS between_variance, round(overall_variance, 6) AS overall_variance
FROM vd""")
def variance_decomposition_q(spark, sf_dir):
    """A4 + A5: overall, between, within, month and category variation (one scan, GROUPING SETS)."""
    return pn.variance_decomposition(panel(spark, sf_dir, "dense"))


@register("variance_share", "WITH " + DENSE_CTE + VARDEC_SQL + """
SELECT round(overall_variance, 6) AS overall_variance,
       round(month_variance / overall_variance * 100, 6) AS month_share_pct,
       round(between_variance / overall_variance * 100, 6) AS between_share_pct,
       round(category_variance / overall_variance * 100, 6) AS category_share_pct,
       round(within_std * within_std / overall_variance * 100, 6) AS within_share_pct
FROM vd""")
def variance_share_q(spark, sf_dir):
    """Components as percent of the overall variance."""
    return pn.variance_share(panel(spark, sf_dir, "dense"))


@register("demean_entity", with_ctes("""
SELECT entity, period, round(ret - avg(ret) OVER (PARTITION BY entity), 6) AS ret_demeaned
FROM panel_dense""", DENSE_CTE))
def demean_entity_q(spark, sf_dir):
    """Within-entity deviation by window."""
    d = pn.demean(panel(spark, sf_dir, "dense"), "ret", out="ret_demeaned")
    return d.select("entity", "period", F.round("ret_demeaned", 6).alias("ret_demeaned"))


@register("category_distribution", with_ctes("""
SELECT split, string_agg(category || ': ' || CAST(n AS VARCHAR), '; ' ORDER BY n DESC, category)
         AS category_distribution
FROM (SELECT split, category, count(*) AS n FROM labelled GROUP BY split, category) GROUP BY split""",
                                             SPARSE_CTE, labelled_cte("panel_sparse")))
def category_distribution_q(spark, sf_dir):
    """A9 per split of the sparse labelled panel."""
    return pn.category_distribution(labelled(spark, sf_dir, "sparse"), group="split")


@register("monthly_counts", with_ctes("""
SELECT split, target_month, CAST(count(*) AS BIGINT) AS n_rows FROM labelled GROUP BY split, target_month""",
                                      SPARSE_CTE, labelled_cte("panel_sparse")))
def monthly_counts_q(spark, sf_dir):
    """A10."""
    return pn.monthly_counts(labelled(spark, sf_dir, "sparse"), group="split")


@register("target_stats", with_ctes("""
SELECT split, CAST(count(*) AS BIGINT) AS n_rows, CAST(count(DISTINCT entity) AS BIGINT) AS n_entities,
       round(avg(target), 6) AS target_mean, round(stddev_pop(target), 6) AS target_std
FROM labelled GROUP BY split""", SPARSE_CTE, labelled_cte("panel_sparse")))
def target_stats_q(spark, sf_dir):
    """A11."""
    return pn.target_stats(labelled(spark, sf_dir, "sparse"), group="split")


def _corr_sql(cols: list[str]) -> str:
    parts = [f"SELECT '{a}' AS feature_a, '{b}' AS feature_b, round(corr({a}, {b}), 6) AS corr FROM panel_dense"
             for i, a in enumerate(cols) for b in cols[:i]]
    return with_ctes("\nUNION ALL ".join(parts), DENSE_CTE)


@register("correlation_matrix", _corr_sql(DENSE_FEATURES))
def correlation_matrix_q(spark, sf_dir):
    """Lower-triangle Pearson correlations of the dense features, one aggregate pass."""
    return pn.correlation_long(panel(spark, sf_dir, "dense"), DENSE_FEATURES)


@register("log_aum", with_ctes("""
SELECT entity, period, round(CASE WHEN aum >= 0 THEN ln(1 + aum) END, 6) AS log_aum FROM panel_sparse""",
                               SPARSE_CTE))
def log_aum_q(spark, sf_dir):
    """P1 row by row."""
    p = pn.log_aum(panel(spark, sf_dir, "sparse"))
    return p.select("entity", "period", F.round("log_aum", 6).alias("log_aum"))


@register("complete_cases", with_ctes("""
SELECT entity, period, ret, sd_qty FROM panel_dense WHERE ret IS NOT NULL AND sd_qty IS NOT NULL""", DENSE_CTE))
def complete_cases_q(spark, sf_dir):
    """P5."""
    return pn.complete_cases(panel(spark, sf_dir, "dense"), ["ret", "sd_qty"]).select("entity", "period", "ret",
                                                                                       "sd_qty")


@register("standardize_panel", with_ctes("""
SELECT entity, period,
       round(coalesce((ret - avg(ret) OVER ()) / stddev_samp(ret) OVER (), 0), 6) AS ret_z,
       round(coalesce((sd_price - avg(sd_price) OVER ()) / stddev_samp(sd_price) OVER (), 0), 6) AS sd_price_z,
       round(coalesce((aum - avg(aum) OVER ()) / stddev_samp(aum) OVER (), 0), 6) AS aum_z
FROM panel_sparse""", SPARSE_CTE))
def standardize_panel_q(spark, sf_dir):
    """Whole-panel z-scores (ddof 1), missing -> 0, on the sparse panel."""
    cols = ["ret", "sd_price", "aum"]
    z = pn.standardize_panel(panel(spark, sf_dir, "sparse"), cols, suffix="_z")
    return z.select("entity", "period", *[F.round(f"{c}_z", 6).alias(f"{c}_z") for c in cols])


@register("dummies", with_ctes("""
SELECT entity, period, 'category_' || category AS dummy, CAST(1 AS DOUBLE) AS value
FROM panel_dense WHERE category > (SELECT min(category) FROM panel_dense)
UNION ALL
SELECT entity, period, 'period_' || CAST(period AS VARCHAR), CAST(1 AS DOUBLE)
FROM panel_dense WHERE period > (SELECT min(period) FROM panel_dense)""", DENSE_CTE))
def dummies_q(spark, sf_dir):
    """P7 in sparse long form: category and month indicators, first level dropped."""
    return pn.dummies_long(panel(spark, sf_dir, "dense"), ["category", "period"], ["entity", "period"])


@register("random_split", with_ctes("SELECT entity, period, split FROM parts", DENSE_CTE, split_cte("panel_dense")))
def random_split_q(spark, sf_dir):
    """Exact 80/20 split by key hash, seed 42."""
    return sp.random_split(panel(spark, sf_dir, "dense"), ["entity", "period"]).select("entity", "period", "split")


FOLDS_VALUES = ", ".join(f"({i + 1}, {a}, {b}, {c})" for i, (a, b, c) in enumerate(sp.WALK_FORWARD_FOLDS))


@register("walk_forward_folds", with_ctes(f"""
SELECT f.fold, CASE WHEN l.target_month <= f.train_limit THEN 'train' ELSE 'val' END AS role,
       CAST(count(*) AS BIGINT) AS n_rows, CAST(min(l.target_month) AS INTEGER) AS min_month,
       CAST(max(l.target_month) AS INTEGER) AS max_month
FROM labelled l JOIN (VALUES {FOLDS_VALUES}) f(fold, train_limit, val_start, val_end)
  ON l.target_month <= f.train_limit OR l.target_month BETWEEN f.val_start AND f.val_end
WHERE l.split IN ('train', 'val')
GROUP BY 1, 2""", DENSE_CTE, labelled_cte("panel_dense")))
def walk_forward_folds_q(spark, sf_dir):
    """Rows per (fold, role) over the development rows."""
    dev, _ = development_and_holdout(labelled(spark, sf_dir, "dense"))
    a = sp.walk_forward_folds(dev)
    return a.groupBy("fold", "role").agg(F.count(F.lit(1)).cast("long").alias("n_rows"),
                                         F.min("target_month").cast("int").alias("min_month"),
                                         F.max("target_month").cast("int").alias("max_month")) \
        .select(F.col("fold").cast("int").alias("fold"), "role", "n_rows", "min_month", "max_month")


@register("kfold", with_ctes("""
SELECT entity, period,
       CAST(CASE WHEN i < r * (q + 1) THEN i // (q + 1) ELSE r + (i - r * (q + 1)) // q END AS INTEGER) AS fold
FROM (SELECT entity, period, row_number() OVER (ORDER BY target_month, entity) - 1 AS i,
             count(*) OVER () // 5 AS q, count(*) OVER () % 5 AS r
      FROM labelled WHERE split = 'train')""", DENSE_CTE, labelled_cte("panel_dense")))
def kfold_q(spark, sf_dir):
    """C4: five contiguous folds of the training rows in (target month, entity) order."""
    lab = labelled(spark, sf_dir, "dense").where(F.col("split") == "train")
    return sp.kfold(lab, ["target_month", "entity"]).select("entity", "period", "fold")
