"""Preprocessing and model queries (A12, T1, L0-L8, D1-D3, K*, R*)."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from panelforge.operators import preprocess as pp
from panelforge.session import checkpoint_root
from panelforge.sources.models import ModelStore
from panelforge.plans.catalog import register
from panelforge.plans.frames import labelled
from panelforge.plans.oracle_sql import SPARSE_CTE, labelled_cte, with_ctes
from panelforge.sources.panels import SPARSE_FEATURES

SPARSE_NUMERIC = sorted([*SPARSE_FEATURES, "ret"])  # current return is a feature for next month (W2)
# The TPC-H market segments, i.e. the category levels of the sparse panel.
SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]


@register("median_mode_fit", with_ctes("""
SELECT 'aum' AS column_name, 'median' AS kind, median(aum) AS median, CAST(NULL AS VARCHAR) AS mode
FROM labelled WHERE split = 'train'
UNION ALL SELECT 'n_orders', 'median', median(CAST(n_orders AS DOUBLE)), NULL FROM labelled WHERE split = 'train'
UNION ALL SELECT 'ret', 'median', median(ret), NULL FROM labelled WHERE split = 'train'
UNION ALL SELECT 'sd_price', 'median', median(sd_price), NULL FROM labelled WHERE split = 'train'
UNION ALL SELECT 'category', 'mode', NULL,
  (SELECT category FROM labelled WHERE split = 'train' GROUP BY category ORDER BY count(*) DESC, category LIMIT 1)
""", SPARSE_CTE, labelled_cte("panel_sparse")))
def median_mode_fit_q(spark, sf_dir):
    """Exact medians and most frequent level on the training rows."""
    lab = labelled(spark, sf_dir, "sparse").where(F.col("split") == "train")
    return pp.median_mode_fit(lab, SPARSE_NUMERIC, ["category"])


def _preprocess_sql() -> str:
    num = SPARSE_NUMERIC
    med = ", ".join(f"median(CAST({c} AS DOUBLE)) AS {c}" for c in num)
    imp = ", ".join(f"coalesce(CAST(l.{c} AS DOUBLE), med.{c}) AS {c}" for c in num)
    st = ", ".join(f"avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}" for c in num)
    scaled = ", ".join(f"round((i.{c} - st.m_{c}) / CASE WHEN st.s_{c} = 0 THEN 1 ELSE st.s_{c} END, 6) AS {c}"
                       for c in num)
    onehot = ", ".join(f"CASE WHEN coalesce(i.category, (SELECT category FROM mode_cat)) = '{lv}' "
                       f"THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS category_{lv}" for lv in SEGMENTS)
    return with_ctes(f"""
SELECT i.entity, i.period, i.split, {scaled}, {onehot}
FROM imp i, st""", SPARSE_CTE, labelled_cte("panel_sparse"), f"""
med AS (SELECT {med} FROM labelled WHERE split = 'train'),
imp AS (SELECT l.entity, l.period, l.split, l.category, {imp} FROM labelled l, med),
st AS (SELECT {st} FROM imp WHERE split = 'train'),
mode_cat AS (SELECT category FROM labelled WHERE split = 'train' GROUP BY category
             ORDER BY count(*) DESC, category LIMIT 1)""")


@register("preprocess", _preprocess_sql())
def preprocess_q(spark, sf_dir):
    """Fit on train only (median impute + ddof-0 scale; mode impute + one-hot), transform every split."""
    lab = labelled(spark, sf_dir, "sparse")
    model = pp.fit_preprocess(lab.where(F.col("split") == "train"), SPARSE_NUMERIC, ["category"])
    out = model.transform(lab, keep=["entity", "period", "split"])
    return out.select(*[F.round(c, 6).alias(c) if c in SPARSE_NUMERIC else F.col(c) for c in out.columns])


@register("level_index", with_ctes("""
SELECT 'category' AS column_name, category AS level, CAST(row_number() OVER (ORDER BY category) - 1 AS BIGINT) AS index, n
FROM (SELECT category, CAST(count(*) AS BIGINT) AS n FROM labelled WHERE split = 'train' GROUP BY category)""", SPARSE_CTE,
                                  labelled_cte("panel_sparse")))
def level_index_q(spark, sf_dir):
    """The level table of the training rows."""
    train = labelled(spark, sf_dir, "sparse").where(F.col("split") == "train")
    return pp.level_table(train, ["category"]).withColumnRenamed("column", "column_name")


@register("preprocess_sparse", with_ctes(f"""
SELECT entity, period, CAST({len(SPARSE_NUMERIC)} + (SELECT count(DISTINCT category) FROM labelled WHERE split = 'train') AS INTEGER) AS size,
       CAST({len(SPARSE_NUMERIC)} + (SELECT count(*) FROM lv WHERE lv.category < l.category) AS INTEGER) AS hot,
       round((l.aum - (SELECT avg(aum) FROM tr)) / (SELECT stddev_pop(aum) FROM tr), 6) AS first_value
FROM labelled l WHERE l.category IN (SELECT category FROM lv)""", SPARSE_CTE, labelled_cte("panel_sparse"),
    "tr AS (SELECT * FROM labelled WHERE split = 'train')", "lv AS (SELECT DISTINCT category FROM tr)"))
def preprocess_sparse_q(spark, sf_dir):
    """T1 as sparse vectors: their size, the place of the row's level, and the first scaled numeric."""
    lab = labelled(spark, sf_dir, "sparse")
    model = pp.fit_preprocess(lab.where(F.col("split") == "train"), SPARSE_NUMERIC, ["category"])
    rows = model.transform_sparse(lab, keep=["entity", "period"])
    return rows.where(F.size("features.indices") > len(SPARSE_NUMERIC)).select(
        "entity", "period", F.col("features.size").alias("size"), F.element_at("features.indices", -1).alias("hot"),
        F.round(F.element_at("features.values", 1), 6).alias("first_value"))


# ---------------------------------------------------------------- linear models and PCA

from panelforge.operators import linear as lin  # noqa: E402
from panelforge.operators import pca as pc  # noqa: E402
from panelforge.operators.evaluate import fit_mean  # noqa: E402
from panelforge.plans.design import MODEL_NUMERIC, component_entity_means, forecasting_design, walk_forward_keys, with_log_size  # noqa: E402
from panelforge.plans.frames import development_and_holdout, panel  # noqa: E402
from panelforge.plans.oracle_sql import DENSE_CTE  # noqa: E402
from panelforge.sources.panels import DENSE_FEATURES  # noqa: E402

def _round6(df):
    """Round DOUBLE columns in Spark (half-up on the decimal form, like the oracle engine)."""
    from panelforge.operators.evaluate import round_doubles
    return round_doubles(df, 6)


DEV_DENSE = with_ctes("{body}", DENSE_CTE, labelled_cte("panel_dense"),
                      "dev AS (SELECT * FROM labelled WHERE split IN ('train', 'val'))")


def _dev(spark, sf_dir):
    return development_and_holdout(labelled(spark, sf_dir, "dense"))[0]


@register("mean_baseline", DEV_DENSE.format(body="SELECT round(avg(target), 6) AS mean_prediction FROM dev"))
def mean_baseline_q(spark, sf_dir):
    """The development mean as a one-number model."""
    one = spark.createDataFrame([(fit_mean(_dev(spark, sf_dir), "target"),)], "mean_prediction double")
    return _round6(one)


@register("ols_single", DEV_DENSE.format(body="""
SELECT CAST(regr_count(target, ret) AS BIGINT) AS n_rows, round(regr_intercept(target, ret), 6) AS intercept,
       round(regr_slope(target, ret), 6) AS slope, round(regr_r2(target, ret), 6) AS r2 FROM dev"""))
def ols_single_q(spark, sf_dir):
    """L1 with one regressor (AR(1) of the return) on development rows."""
    model, coef, stats = lin.ols(_dev(spark, sf_dir), ["ret"], "target")
    st = stats.first()
    return _round6(spark.createDataFrame([(int(st["n"]), float(model.intercept), float(model.coef[0]), float(st["r2"]))],
                                         "n_rows bigint, intercept double, slope double, r2 double"))


@register("ridge_fixed", DEV_DENSE.format(body="""
SELECT round(regr_avgy(target, ret) - regr_sxy(target, ret) / (regr_sxx(target, ret) + 100) * regr_avgx(target, ret), 6)
         AS intercept,
       round(regr_sxy(target, ret) / (regr_sxx(target, ret) + 100), 6) AS slope FROM dev"""))
def ridge_fixed_q(spark, sf_dir):
    """L4 at the final evaluation's alpha = 100, one regressor (closed form)."""
    m = lin.ridge(_dev(spark, sf_dir), ["ret"], "target", 100.0)
    return _round6(spark.createDataFrame([(float(m.intercept), float(m.coef[0]))], "intercept double, slope double"))


@register("stored_model_scores", DEV_DENSE.format(body="""
SELECT entity, period, round(regr_avgy(target, ret) OVER () + regr_sxy(target, ret) OVER () / (regr_sxx(target, ret) OVER () + 100)
                             * (ret - regr_avgx(target, ret) OVER ()), 6) AS pred FROM dev"""))
def stored_model_scores_q(spark, sf_dir):
    """Ridge in one regressor saved as a new version; the latest version is loaded and scores the development rows."""
    dev = _dev(spark, sf_dir)
    store = ModelStore(spark, f"{checkpoint_root(spark).rstrip('/')}/panelforge-models-{uuid.uuid4().hex[:12]}")
    store.save("returns", {"ridge": lin.ridge(dev, ["ret"], "target", 100.0)}, dev)
    scored = store.load("returns", "ridge", dev).predict(dev)
    return scored.select("entity", "period", F.round("pred", 6).alias("pred"))


@register("vif_pair", with_ctes("""
SELECT 'hhi' AS feature, round(1 / (1 - corr(hhi, top1_pct) * corr(hhi, top1_pct)), 6) AS vif FROM panel_dense
UNION ALL
SELECT 'top1_pct', round(1 / (1 - corr(hhi, top1_pct) * corr(hhi, top1_pct)), 6) FROM panel_dense""", DENSE_CTE))
def vif_pair_q(spark, sf_dir):
    """L3 with two features: 1 / (1 - r^2)."""
    v = lin.vif(panel(spark, sf_dir, "dense"), ["hhi", "top1_pct"])
    return v.select("feature", F.round("vif", 6).alias("vif"))


PCA_PAIR_CTE = """
pst AS (SELECT avg(hhi) AS mx, avg(top1_pct) AS my, var_samp(hhi) AS a, var_samp(top1_pct) AS c,
               covar_samp(hhi, top1_pct) AS b FROM panel_dense),
pev AS (SELECT *, (a + c) / 2 + sqrt(((a - c) / 2) * ((a - c) / 2) + b * b) AS l1,
                  (a + c) / 2 - sqrt(((a - c) / 2) * ((a - c) / 2) + b * b) AS l2 FROM pst),
pvec AS (SELECT *, b / sqrt(b * b + (l1 - a) * (l1 - a)) AS u1x, (l1 - a) / sqrt(b * b + (l1 - a) * (l1 - a)) AS u1y,
                   b / sqrt(b * b + (l2 - a) * (l2 - a)) AS u2x, (l2 - a) / sqrt(b * b + (l2 - a) * (l2 - a)) AS u2y
         FROM pev),
psign AS (SELECT *, CASE WHEN (CASE WHEN abs(u1x) >= abs(u1y) THEN u1x ELSE u1y END) < 0 THEN -1 ELSE 1 END AS s1,
                    CASE WHEN (CASE WHEN abs(u2x) >= abs(u2y) THEN u2x ELSE u2y END) < 0 THEN -1 ELSE 1 END AS s2
          FROM pvec)"""


@register("pca_pair", with_ctes("""
SELECT 'PC1' AS component, 1 AS component_index, round(l1, 6) AS eigenvalue,
       round(l1 / (a + c) * 100, 6) AS variance_explained_pct, round(l1 / (a + c) * 100, 6) AS cumulative_variance_pct
FROM pev
UNION ALL
SELECT 'PC2', 2, round(l2, 6), round(l2 / (a + c) * 100, 6), round((l1 + l2) / (a + c) * 100, 6) FROM pev""",
                                DENSE_CTE, PCA_PAIR_CTE))
def pca_pair_q(spark, sf_dir):
    """D1 + D2 on two features: eigenvalues of the 2 x 2 sample covariance (closed form)."""
    m = pc.pca_fit(panel(spark, sf_dir, "dense"), ["hhi", "top1_pct"])
    ev = m.explained_variance(spark)
    return ev.select("component", F.col("component_index").cast("int").alias("component_index"),
                     *[F.round(c, 6).alias(c) for c in ("eigenvalue", "variance_explained_pct",
                                                        "cumulative_variance_pct")])


@register("pca_scores_pair", with_ctes("""
SELECT p.entity, p.period,
       round(((p.hhi - s.mx) * s.u1x + (p.top1_pct - s.my) * s.u1y) * s.s1, 6) AS PC1,
       round(((p.hhi - s.mx) * s.u2x + (p.top1_pct - s.my) * s.u2y) * s.s2, 6) AS PC2
FROM panel_dense p, psign s""", DENSE_CTE, PCA_PAIR_CTE))
def pca_scores_pair_q(spark, sf_dir):
    """D3 on two features: centered projection on the sign-fixed eigenvectors."""
    p = panel(spark, sf_dir, "dense")
    m = pc.pca_fit(p, ["hhi", "top1_pct"])
    s = m.transform(p, keep=["entity", "period"])
    return s.select("entity", "period", F.round("PC1", 6).alias("PC1"), F.round("PC2", 6).alias("PC2"))


# ---- full-width fits: checked by invariant tests (tests/test_linear.py, tests/test_pca.py)

def _train_design(spark, sf_dir):
    design, feats, _ = forecasting_design(spark, sf_dir, "dense")
    return design, design.where(F.col("split") == "train"), feats


@register("ridge_cv_walk_forward")
def ridge_cv_q(spark, sf_dir):
    """L4: alpha grid scored by mean R^2 over the five walk-forward folds (one moments pass)."""
    _, train, feats = _train_design(spark, sf_dir)
    months = sorted(r[0] for r in train.select("target_month").distinct().collect())
    _, table = lin.ridge_cv(train, feats, "target", fold_col="target_month", folds=walk_forward_keys(months))
    return table


@register("elasticnet_cv_walk_forward")
def elasticnet_cv_q(spark, sf_dir):
    """Alpha x l1_ratio grid by mean fold MSE (coordinate descent on fold moments)."""
    _, train, feats = _train_design(spark, sf_dir)
    months = sorted(r[0] for r in train.select("target_month").distinct().collect())
    _, table = lin.elasticnet_cv(train, feats, "target", fold_col="target_month", folds=walk_forward_keys(months))
    return table


@register("lasso_cv")
def lasso_cv_q(spark, sf_dir):
    """Lasso alpha by mean MSE over five hash folds of the training rows."""
    from panelforge.operators.splits import hash_fold
    _, train, feats = _train_design(spark, sf_dir)
    _, table = lin.lasso_cv(hash_fold(train, ["entity", "period"]), feats, "target", fold_col="fold")
    return table


@register("linear_coefficients")
def linear_coefficients_q(spark, sf_dir):
    """Ridge (alpha = 100, fitted on development rows) coefficients ordered by magnitude."""
    design, feats, _ = forecasting_design(spark, sf_dir, "dense", fit_splits=("train", "val"))
    m = lin.ridge(design.where(F.col("split").isin("train", "val")), feats, "target", 100.0)
    return m.coefficients(spark)


@register("vif_table")
def vif_table_q(spark, sf_dir):
    """L3 + O6: VIF of every dense feature, descending."""
    return lin.vif(panel(spark, sf_dir, "dense"), DENSE_FEATURES)


@register("pca_explained_variance")
def pca_explained_variance_q(spark, sf_dir):
    """D1 + D2 on the scaled training features (k = all)."""
    _, train, _ = _train_design(spark, sf_dir)
    numeric = MODEL_NUMERIC["dense"]
    return pc.pca_fit(train, numeric).explained_variance(spark)


@register("pca_loadings")
def pca_loadings_q(spark, sf_dir):
    """D1 loadings (eigenvector x sqrt(eigenvalue)) of the first five components."""
    _, train, _ = _train_design(spark, sf_dir)
    numeric = MODEL_NUMERIC["dense"]
    return pc.pca_fit(train, numeric, 5).loadings(spark)


@register("ols_on_components")
def ols_on_components_q(spark, sf_dir):
    """L1 on principal components (PCR): coefficients with t statistics and p-values."""
    _, train, _ = _train_design(spark, sf_dir)
    numeric = MODEL_NUMERIC["dense"]
    m = pc.pca_fit(train, numeric, 5)
    scores = m.transform(train, keep=["target"])
    _, coef, _ = lin.ols(scores, [f"PC{i + 1}" for i in range(5)], "target")
    return coef


from panelforge.operators import absorb as ab  # noqa: E402


@register("fe_ols_clustered")
def fe_ols_clustered_q(spark, sf_dir):
    """L2: all dense features with category and month effects absorbed, errors clustered by entity."""
    return ab.fe_ols_absorbed(*with_log_size(panel(spark, sf_dir, "dense"), DENSE_FEATURES), "ret")[0]


@register("fe_effects")
def fe_effects_q(spark, sf_dir):
    """P7 in L2: the category and month effects of the same fit, relative to the lowest level."""
    return ab.fe_ols_absorbed(*with_log_size(panel(spark, sf_dir, "dense"), DENSE_FEATURES), "ret")[1]


@register("fe_ols_dummies")
def fe_ols_dummies_q(spark, sf_dir):
    """L2 as dummy columns, for errors of the level terms too; as wide as the levels are many."""
    return lin.fe_ols_clustered(*with_log_size(panel(spark, sf_dir, "dense"), DENSE_FEATURES), "ret")[0]


@register("fe_ols_single", with_ctes("""
SELECT 'hhi' AS term, round(beta, 6) AS coef, round(sqrt(v), 6) AS std_err, round(beta / sqrt(v), 6) AS z,
       CAST(n AS BIGINT) AS n_rows, CAST(g AS BIGINT) AS n_groups
FROM (SELECT any_value(beta) AS beta, sum(s * s) / (any_value(sxx) * any_value(sxx)) * (count(*) / (count(*) - 1.0))
             * ((any_value(n) - 1.0) / (any_value(n) - 2 - any_value(levels))) AS v, any_value(n) AS n, count(*) AS g
      FROM (SELECT entity, sum(x * (y - beta * x)) AS s, any_value(beta) AS beta, any_value(sxx) AS sxx, any_value(n) AS n,
                   any_value(levels) AS levels FROM fit GROUP BY entity))""", DENSE_CTE, """
dm AS (SELECT entity, category, hhi - avg(hhi) OVER (PARTITION BY category) AS x, ret - avg(ret) OVER (PARTITION BY category) AS y
       FROM panel_dense WHERE hhi IS NOT NULL AND ret IS NOT NULL),
fit AS (SELECT *, sum(x * y) OVER () / sum(x * x) OVER () AS beta, sum(x * x) OVER () AS sxx, count(*) OVER () AS n,
               (SELECT count(DISTINCT category) - 1 FROM dm) AS levels FROM dm)"""))
def fe_ols_single_q(spark, sf_dir):
    """L2 with one regressor and one absorbed factor: closed form of the coefficient and its clustered error."""
    coef, _, info = ab.fe_ols_absorbed(panel(spark, sf_dir, "dense"), ["hhi"], "ret", factors=("category",))
    return coef.select("term", *[F.round(c, 6).alias(c) for c in ("coef", "std_err", "z")],
                       F.lit(int(info["n"])).cast("long").alias("n_rows"), F.lit(info["groups"]).cast("long").alias("n_groups"))


# ---------------------------------------------------------------- clustering

import numpy as np  # noqa: E402

from panelforge.operators import cluster as cl  # noqa: E402
from panelforge.operators import kmeans as km  # noqa: E402

CLUSTER_COLS = ["hhi", "top1_pct"]
ENTITY_MEANS_CTE = """
ent AS (SELECT entity, category, avg(hhi) AS hhi, avg(top1_pct) AS top1_pct FROM panel_dense GROUP BY entity, category)"""


def _entity_table(spark, sf_dir):
    """Entity means of two dense features; the supplier's region is a deterministic label."""
    p = panel(spark, sf_dir, "dense")
    return p.groupBy("entity", "category").agg(*[F.avg(c).alias(c) for c in CLUSTER_COLS])


@register("entity_mean_scores", with_ctes("""
SELECT p.entity, round(avg(((p.hhi - s.mx) * s.u1x + (p.top1_pct - s.my) * s.u1y) * s.s1), 6) AS PC1,
       round(avg(((p.hhi - s.mx) * s.u2x + (p.top1_pct - s.my) * s.u2y) * s.s2), 6) AS PC2
FROM panel_dense p, psign s GROUP BY p.entity""", DENSE_CTE, PCA_PAIR_CTE))
def entity_mean_scores_q(spark, sf_dir):
    """Entity means of the component scores."""
    p = panel(spark, sf_dir, "dense")
    scores = pc.pca_fit(p, CLUSTER_COLS).transform(p, keep=["entity"])
    em = cl.entity_means(scores, ["PC1", "PC2"])
    return em.select("entity", F.round("PC1", 6).alias("PC1"), F.round("PC2", 6).alias("PC2"))


@register("cluster_profiles", with_ctes("""
SELECT category AS cluster, round(avg(hhi), 6) AS hhi, round(avg(top1_pct), 6) AS top1_pct,
       CAST(count(*) AS BIGINT) AS n_members FROM ent GROUP BY category""", DENSE_CTE, ENTITY_MEANS_CTE))
def cluster_profiles_q(spark, sf_dir):
    """A8 with the region as the cluster label."""
    prof = cl.cluster_profiles(_entity_table(spark, sf_dir).withColumnRenamed("category", "cluster"), CLUSTER_COLS)
    return prof.select("cluster", *[F.round(c, 6).alias(c) for c in CLUSTER_COLS], "n_members")


CLUSTER_METRIC_SQL = with_ctes("""
SELECT CAST((SELECT count(*) FROM ent) AS BIGINT) AS n, CAST((SELECT count(*) FROM cs) AS INTEGER) AS k,
       round((SELECT sum(d2) FROM own), 6) AS inertia,
       round((SELECT avg(CASE WHEN n_own > 1 THEN (b - a) / greatest(a, b) ELSE 0 END) FROM sil), 6)
         AS silhouette_sqeuclidean,
       round((SELECT avg(r) FROM (SELECT i.category, max((si.s + sj.s) / sqrt((i.mx - j.mx) * (i.mx - j.mx)
                                       + (i.my - j.my) * (i.my - j.my))) AS r
                                  FROM cs i JOIN cs j ON i.category <> j.category
                                  JOIN spread si ON si.category = i.category JOIN spread sj ON sj.category = j.category
                                  GROUP BY i.category)), 6) AS davies_bouldin,
       round(((SELECT sum(n * ((mx - (SELECT avg(hhi) FROM ent)) * (mx - (SELECT avg(hhi) FROM ent))
                              + (my - (SELECT avg(top1_pct) FROM ent)) * (my - (SELECT avg(top1_pct) FROM ent))))
               FROM cs) / ((SELECT count(*) FROM cs) - 1))
             / ((SELECT sum(d2) FROM own) / ((SELECT count(*) FROM ent) - (SELECT count(*) FROM cs))), 6)
         AS calinski_harabasz""", DENSE_CTE, ENTITY_MEANS_CTE, """
cs AS (SELECT category, count(*) AS n, avg(hhi) AS mx, avg(top1_pct) AS my FROM ent GROUP BY category),
own AS (SELECT e.entity, e.category, (e.hhi - c.mx) * (e.hhi - c.mx) + (e.top1_pct - c.my) * (e.top1_pct - c.my) AS d2
        FROM ent e JOIN cs c ON e.category = c.category),
spread AS (SELECT category, avg(sqrt(d2)) AS s FROM own GROUP BY category),
pair AS (SELECT e.entity, e.category AS own_c, c.category AS other_c,
                avg((e.hhi - f.hhi) * (e.hhi - f.hhi) + (e.top1_pct - f.top1_pct) * (e.top1_pct - f.top1_pct)) AS md,
                count(*) AS cnt
         FROM ent e JOIN ent f ON true JOIN cs c ON f.category = c.category
         GROUP BY e.entity, e.category, c.category),
sil AS (SELECT entity, max(CASE WHEN own_c = other_c THEN md * cnt / greatest(cnt - 1, 1) END) AS a,
               min(CASE WHEN own_c <> other_c THEN md END) AS b,
               max(CASE WHEN own_c = other_c THEN cnt END) AS n_own
        FROM pair GROUP BY entity)""")


@register("cluster_metrics", CLUSTER_METRIC_SQL)
def cluster_metrics_q(spark, sf_dir):
    """K2 (squared Euclidean, exact from cluster sums) + K3 + K4 + inertia with the region as label.
    The oracle computes the silhouette from explicit point pairs (a brute-force check on this
    small entity table); the Spark side never forms pairs."""
    ent = _entity_table(spark, sf_dir).withColumnRenamed("category", "cluster")
    m = cl.cluster_metrics(ent, CLUSTER_COLS, label="cluster")
    return _round6(cl.metrics_frame(spark, m))


@register("kmeans_clusters")
def kmeans_clusters_q(spark, sf_dir):
    """K1 + K7: k = 3 on entity means of all component scores; label 1..3 by descending first-component centre."""
    ent, cols = component_entity_means(panel(spark, sf_dir, "dense"), DENSE_FEATURES)
    ent = ent.checkpoint(eager=True)
    return cl.kmeans(ent, cols, 3, key="entity").transform(ent, "kmeans_cluster").select("entity", "kmeans_cluster")


@register("k_candidates")
def k_candidates_q(spark, sf_dir):
    """K8: inertia and quality indices for k = 2..5 on entity means of all component scores."""
    ent, cols = component_entity_means(panel(spark, sf_dir, "dense"), DENSE_FEATURES)
    return cl.k_candidates(ent, cols, key="entity")


@register("score_profiles")
def score_profiles_q(spark, sf_dir):
    """A8 of K1: mean of every component score per cluster."""
    ent, cols = component_entity_means(panel(spark, sf_dir, "dense"), DENSE_FEATURES)
    ent = ent.checkpoint(eager=True)
    labelled_ = cl.kmeans(ent, cols, 3, key="entity").transform(ent, "cluster")
    return cl.cluster_profiles(labelled_, cols)


LLOYD_CTE = """
cs AS (SELECT category, avg(hhi) AS mx, avg(top1_pct) AS my FROM ent GROUP BY category),
near AS (SELECT e.entity, e.hhi, e.top1_pct, arg_min(c.category, (e.hhi - c.mx) * (e.hhi - c.mx)
                                                     + (e.top1_pct - c.my) * (e.top1_pct - c.my)) AS cluster
         FROM ent e JOIN cs c ON true GROUP BY e.entity, e.hhi, e.top1_pct)"""


def _region_centres(spark, sf_dir):
    ent = _entity_table(spark, sf_dir)
    rows = ent.groupBy("category").agg(*[F.avg(c).alias(c) for c in CLUSTER_COLS]).orderBy("category").collect()
    return ent, [r["category"] for r in rows], np.array([[r[c] for c in CLUSTER_COLS] for r in rows])


@register("nearest_centre", with_ctes("SELECT entity, cluster FROM near", DENSE_CTE, ENTITY_MEANS_CTE, LLOYD_CTE))
def nearest_centre_q(spark, sf_dir):
    """K7 given the centres (the regions' means): label of the nearest one."""
    ent, names, centres = _region_centres(spark, sf_dir)
    return ent.select("entity", cl.nearest_label(CLUSTER_COLS, centres, list(range(len(names)))).alias("_i")).select(
        "entity", F.element_at(F.array(*[F.lit(c) for c in names]), F.col("_i") + 1).alias("cluster"))


@register("lloyd_step", with_ctes("""
SELECT cluster, CAST(count(*) AS BIGINT) AS n_members, round(avg(hhi), 6) AS hhi, round(avg(top1_pct), 6) AS top1_pct
FROM near GROUP BY cluster""", DENSE_CTE, ENTITY_MEANS_CTE, LLOYD_CTE))
def lloyd_step_q(spark, sf_dir):
    """K1: one step from given centres (the regions' means) by the aggregate that all restarts share."""
    ent, names, centres = _region_centres(spark, sf_dir)
    points, means, _ = km.stored_points(ent, CLUSTER_COLS, "entity")
    n, s, _ = km.lloyd_step(points, {len(names): (centres - means)[None]})[len(names)]
    rows = [(c, int(m), *(float(v) for v in t / m + means)) for c, m, t in zip(names, n[0], s[0]) if m]
    return _round6(spark.createDataFrame(rows, "cluster string, n_members long, hhi double, top1_pct double"))


# ---------------------------------------------------------------- trees

from panelforge.operators import trees as tr  # noqa: E402


def _tree_inputs(spark, sf_dir):
    design, feats, _ = forecasting_design(spark, sf_dir, "dense")
    return design, design.where(F.col("split") == "train"), design.where(F.col("split") == "val"), feats


@register("decision_tree_cv")
def decision_tree_cv_q(spark, sf_dir):
    """Depth x leaf-size grid over the walk-forward folds, MAE; per (candidate, fold) scores."""
    _, train, _, feats = _tree_inputs(spark, sf_dir)
    _, table = tr.tuned(train, feats, "tree", tr.TREE_GRID, tr.walk_forward())
    return table


@register("rf_random_search")
def rf_random_search_q(spark, sf_dir):
    """15 seeded draws of the forest space over the walk-forward folds."""
    _, train, _, feats = _tree_inputs(spark, sf_dir)
    _, table = tr.tuned(train, feats, "forest", tr.RF_SEARCH, tr.walk_forward(), random_draws=15)
    return table


@register("hist_gradient_boosting")
def hist_gradient_boosting_q(spark, sf_dir):
    """15 seeded draws of the boosting space (histogram trees, maxBins 255) over the walk-forward folds."""
    _, train, _, feats = _tree_inputs(spark, sf_dir)
    _, table = tr.tuned(train, feats, "gbt", tr.GBT_SEARCH, tr.walk_forward(), random_draws=15)
    return table


@register("random_forest_cv")
def random_forest_cv_q(spark, sf_dir):
    """R2: forest grid over the walk-forward folds."""
    _, train, _, feats = _tree_inputs(spark, sf_dir)
    _, table = tr.tuned(train, feats, "forest", tr.FOREST_GRID, tr.walk_forward())
    return table


@register("gradient_boosting_cv")
def gradient_boosting_cv_q(spark, sf_dir):
    """Boosting grid over the walk-forward folds."""
    _, train, _, feats = _tree_inputs(spark, sf_dir)
    _, table = tr.tuned(train, feats, "gbt", tr.GBT_GRID, tr.walk_forward())
    return table


@register("rf_final_predictions")
def rf_final_q(spark, sf_dir):
    """The fixed forest fitted on development rows, predictions on the holdout."""
    design, feats, _ = forecasting_design(spark, sf_dir, "dense", fit_splits=("train", "val"))
    dev = design.where(F.col("split").isin("train", "val"))
    model = tr.rf_final(dev, feats)
    return model.predict(design.where(F.col("split") == "test")).select("entity", "target_month", "target", "pred")


@register("fold_metrics")
def fold_metrics_q(spark, sf_dir):
    """The fixed forest refitted per walk-forward fold; per-fold and mean / std rows."""
    _, train, _, feats = _tree_inputs(spark, sf_dir)
    return tr.fold_metrics(train, feats, "forest", tr.RF_FINAL, tr.walk_forward())


@register("impurity_importance")
def impurity_importance_q(spark, sf_dir):
    """R8."""
    _, train, _, feats = _tree_inputs(spark, sf_dir)
    return tr.rf_final(train, feats).impurity_importance(spark)


@register("permutation_importance")
def permutation_importance_q(spark, sf_dir):
    """R^2 drop over 5 permutations of each feature on the validation rows."""
    _, train, val, feats = _tree_inputs(spark, sf_dir)
    model = tr.rf_final(train, feats)
    return tr.permutation_importance(model, val, keys=["entity", "period"], n_repeats=5)


@register("top_features")
def top_features_q(spark, sf_dir):
    """The ten largest impurity importances."""
    _, train, _, feats = _tree_inputs(spark, sf_dir)
    return tr.rf_final(train, feats).impurity_importance(spark).limit(10)


# ---------------------------------------------------------------- end-to-end final evaluation

from panelforge.plans import final_evaluation as fe  # noqa: E402


@register("final_evaluation")
def final_evaluation_q(spark, sf_dir):
    """M7 on the dense holdout: ridge (alpha 100) and the fixed forest refitted on development
    rows, against the four baselines, with relative improvements and RMSE rank."""
    return fe.comparison_table_of(spark, sf_dir)


@register("final_monthly_metrics")
def final_monthly_q(spark, sf_dir):
    """M8 with the fitted models."""
    return fe.ev.monthly_metrics(fe.final_predictions(spark, sf_dir), fe.MODELS)


@register("final_seen_unseen")
def final_seen_unseen_q(spark, sf_dir):
    """M12 with the fitted models."""
    return fe.ev.seen_unseen_metrics(fe.final_predictions(spark, sf_dir))


@register("cluster_map_data", with_ctes("""
SELECT p.entity, p.category, round(avg(((p.hhi - s.mx) * s.u1x + (p.top1_pct - s.my) * s.u1y) * s.s1), 6) AS PC1,
       round(avg(((p.hhi - s.mx) * s.u2x + (p.top1_pct - s.my) * s.u2y) * s.s2), 6) AS PC2
FROM panel_dense p, psign s GROUP BY p.entity, p.category""", DENSE_CTE, PCA_PAIR_CTE))
def cluster_map_data_q(spark, sf_dir):
    """The table behind the two-component cluster map (entity means of PC1 / PC2, coloured
    by a label; here the supplier's region)."""
    p = panel(spark, sf_dir, "dense")
    scores = pc.pca_fit(p, CLUSTER_COLS).transform(p, keep=["entity", "category"])
    em = scores.groupBy("entity", "category").agg(F.avg("PC1").alias("PC1"), F.avg("PC2").alias("PC2"))
    return em.select("entity", "category", F.round("PC1", 6).alias("PC1"), F.round("PC2", 6).alias("PC2"))
