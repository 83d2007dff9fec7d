"""Validation queries (V1-V3, V5-V9, V11-V14) on the raw drops and the labelled panel."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelforge.operators import validate as va
from panelforge.plans.catalog import register
from panelforge.plans.frames import development_and_holdout, labelled, panel
from panelforge.plans.oracle_sql import DENSE_CTE, SPARSE_CTE, labelled_cte, with_ctes
from panelforge.operators.splits import TEST_END, TRAIN_END, VAL_END
from panelforge.sources.panels import raw_drops

RAW_DROPS_CTE = """
raw_drops AS (
  SELECT * FROM panel_dense WHERE period <= 200012
  UNION ALL
  SELECT * FROM panel_dense WHERE period >= 200001
)"""


@register("missing_counts", with_ctes("""
SELECT column_name, CAST(n_missing AS BIGINT) AS n_missing FROM (
  SELECT 'entity' AS column_name, count(*) - count(entity) AS n_missing FROM panel_sparse
  UNION ALL SELECT 'period', count(*) - count(period) FROM panel_sparse
  UNION ALL SELECT 'category', count(*) - count(category) FROM panel_sparse
  UNION ALL SELECT 'n_orders', count(*) - count(n_orders) FROM panel_sparse
  UNION ALL SELECT 'aum', count(*) - count(aum) FROM panel_sparse
  UNION ALL SELECT 'sd_price', count(*) - count(sd_price) FROM panel_sparse
  UNION ALL SELECT 'ret', count(*) - count(ret) FROM panel_sparse)""", SPARSE_CTE))
def missing_counts_q(spark, sf_dir):
    """V1 on the sparse panel (sd_price is missing for single-order months)."""
    return va.missing_counts(panel(spark, sf_dir, "sparse"))


@register("duplicate_count", with_ctes("""
SELECT CAST(count(*) AS BIGINT) AS n_rows,
       CAST((SELECT count(*) FROM (SELECT DISTINCT * FROM raw_drops)) AS BIGINT) AS n_distinct,
       CAST(count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM raw_drops)) AS BIGINT) AS n_duplicates
FROM raw_drops""", DENSE_CTE, RAW_DROPS_CTE))
def duplicate_count_q(spark, sf_dir):
    """V2 over all columns of the stacked raw drops."""
    return va.duplicate_count(raw_drops(panel(spark, sf_dir, "dense")))


@register("panel_key_duplicates", with_ctes("""
SELECT entity, period, CAST(count(*) AS BIGINT) AS n_rows
FROM raw_drops GROUP BY entity, period HAVING count(*) > 1""", DENSE_CTE, RAW_DROPS_CTE))
def panel_key_duplicates_q(spark, sf_dir):
    """V3: (entity, period) keys landed more than once."""
    return va.panel_key_duplicates(raw_drops(panel(spark, sf_dir, "dense")), ["entity", "period"])


@register("dedup_rows", with_ctes("SELECT DISTINCT * FROM raw_drops", DENSE_CTE, RAW_DROPS_CTE))
def dedup_rows_q(spark, sf_dir):
    """V8: exact duplicates removed from the raw drops."""
    return va.dedup_rows(raw_drops(panel(spark, sf_dir, "dense")))


def range_input(spark, sf_dir):
    """Dense panel plus derived columns whose names trigger the value-range rules."""
    p = panel(spark, sf_dir, "dense")
    return p.select(
        *[c for c in p.columns if c != "category"],
        (F.col("small_pct") / 100).alias("small_prob"),
        F.col("large_pct").alias("large_prob_pct"),
        (F.col("top3_pct") / 20).alias("top3_probability"),
        F.col("sd_qty").alias("qty_volatility"),
        F.col("ret").alias("ret_error"),
        F.when(F.col("n_lines") == 1, F.lit(float("inf"))).otherwise(F.col("aum")).alias("aum_inf"),
        (F.col("n_brands") * 0).alias("zero_brands"))


@register("value_range_checks", with_ctes("""
SELECT column_name,
       coalesce(bool_or(isinf(v)), false) AS has_infinite,
       (lower(column_name) LIKE '%prob%') AS is_probability,
       CASE WHEN lower(column_name) LIKE '%prob%'
            THEN coalesce(min(v) < 0 OR (max(v) > 1.05 AND max(v) < 5) OR max(v) > 105, false)
            ELSE false END AS invalid_probability,
       (lower(column_name) LIKE '%risk%' OR lower(column_name) LIKE '%deviation%'
        OR lower(column_name) LIKE '%error%' OR lower(column_name) LIKE '%variance%'
        OR lower(column_name) LIKE '%volatility%' OR lower(column_name) LIKE '%std%') AS is_risk,
       CASE WHEN (lower(column_name) LIKE '%risk%' OR lower(column_name) LIKE '%deviation%'
        OR lower(column_name) LIKE '%error%' OR lower(column_name) LIKE '%variance%'
        OR lower(column_name) LIKE '%volatility%' OR lower(column_name) LIKE '%std%')
            THEN coalesce(min(v) < 0, false) ELSE false END AS negative_risk,
       coalesce(min(v) = max(v), true) AS is_constant
FROM (
    SELECT CAST(entity AS DOUBLE) AS entity, CAST(period AS DOUBLE) AS period, ret,
           CAST(n_lines AS DOUBLE) AS n_lines, CAST(n_brands AS DOUBLE) AS n_brands, aum, hhi,
           top1_pct, top3_pct, small_pct, large_pct, avg_qty, avg_retail, sd_qty,
           small_pct / 100 AS small_prob, large_pct AS large_prob_pct, top3_pct / 20 AS top3_probability,
           sd_qty AS qty_volatility, ret AS ret_error,
           CASE WHEN n_lines = 1 THEN CAST('inf' AS DOUBLE) ELSE aum END AS aum_inf,
           CAST(n_brands * 0 AS DOUBLE) AS zero_brands
    FROM panel_dense) t
  UNPIVOT INCLUDE NULLS (v FOR column_name IN (entity, period, ret, n_lines, n_brands, aum, hhi, top1_pct,
    top3_pct, small_pct, large_pct, avg_qty, avg_retail, sd_qty, small_prob, large_prob_pct, top3_probability,
    qty_volatility, ret_error, aum_inf, zero_brands))
GROUP BY column_name""", DENSE_CTE))
def value_range_checks_q(spark, sf_dir):
    """V5 + V6 + V7 + V9 in one scan."""
    return va.value_range_checks(range_input(spark, sf_dir))


@register("split_disjoint", with_ctes("""
SELECT entity, period, CAST(count(DISTINCT split) AS BIGINT) AS n_splits
FROM labelled GROUP BY entity, period HAVING count(DISTINCT split) > 1""", DENSE_CTE, labelled_cte("panel_dense")))
def split_disjoint_q(spark, sf_dir):
    """No panel row in two splits (empty result)."""
    return va.split_disjoint(labelled(spark, sf_dir, "dense"), ["entity", "period"])


@register("split_order", with_ctes(f"""
SELECT split, CAST(min(target_month) AS INTEGER) AS min_month, CAST(max(target_month) AS INTEGER) AS max_month,
       CAST(count(*) AS BIGINT) AS n_rows,
       CASE split WHEN 'train' THEN max(target_month) <= {TRAIN_END}
                  WHEN 'val' THEN min(target_month) > {TRAIN_END} AND max(target_month) <= {VAL_END}
                  WHEN 'test' THEN min(target_month) > {VAL_END} AND max(target_month) <= {TEST_END}
                  WHEN 'prospective' THEN min(target_month) > {TEST_END}
                  ELSE false END AS ordered
FROM labelled GROUP BY split""", SPARSE_CTE, labelled_cte("panel_sparse")))
def split_order_q(spark, sf_dir):
    """V12 on the sparse panel."""
    return va.split_order(labelled(spark, sf_dir, "sparse"), train_end=TRAIN_END, val_end=VAL_END,
                          test_end=TEST_END)


@register("adjacent_months", with_ctes("""
SELECT CAST(count(*) AS BIGINT) AS n_rows,
       CAST(sum(CASE WHEN ((target_month // 100) * 12 + target_month % 100)
                        - ((period // 100) * 12 + period % 100) <> 1 THEN 1 ELSE 0 END) AS BIGINT) AS n_violations
FROM labelled""", DENSE_CTE, labelled_cte("panel_dense")))
def adjacent_months_q(spark, sf_dir):
    """Every target month is the feature month + 1."""
    return va.adjacent_months(labelled(spark, sf_dir, "dense"))


@register("holdout_guard", with_ctes(f"""
SELECT CAST(count(*) AS BIGINT) AS n_fit_rows, CAST(max(target_month) AS INTEGER) AS max_fit_month,
       CAST((SELECT count(*) FROM labelled f WHERE f.split IN ('train', 'val')
             AND EXISTS (SELECT 1 FROM labelled h WHERE h.split = 'test'
                         AND h.entity = f.entity AND h.period = f.period)) AS BIGINT) AS n_overlap,
       (SELECT count(*) FROM labelled f WHERE f.split IN ('train', 'val')
             AND EXISTS (SELECT 1 FROM labelled h WHERE h.split = 'test'
                         AND h.entity = f.entity AND h.period = f.period)) = 0
         AND max(target_month) <= {VAL_END} AS ok
FROM labelled WHERE split IN ('train', 'val')""", DENSE_CTE, labelled_cte("panel_dense")))
def holdout_guard_q(spark, sf_dir):
    """Development rows never include a holdout key nor a month past val_end."""
    dev, hold = development_and_holdout(labelled(spark, sf_dir, "dense"))
    return va.holdout_guard(dev, hold, keys=["entity", "period"], limit=VAL_END)
