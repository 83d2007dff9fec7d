"""Linear models from L0 moments (driver solves p x p systems only).

L1 ols                    OLS with intercept: coefficients, std errors, t, p, CI, R^2, adj R^2, F
L2 fe_ols_clustered       pooled OLS with category + month dummies as columns, entity-clustered covariance
                          (the absorbed form is in operators/absorb.py)
L3 vif                    diagonal of the inverse correlation matrix
L4 ridge / ridge_cv       intercept unpenalized; CV over any fold design from per-group moments
L5 lasso_cv, L6 elasticnet_cv  coordinate descent on the covariance (Gram) form
L7 mean baseline          see evaluate.fit_mean
L8 linear_coefficients    (feature, coefficient, |coefficient|) ordered by |coefficient|
Predictions are column expressions (intercept + sum beta_j x_j), so scoring
stays in whole-stage codegen.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelforge.functions.distributions import f_sf, norm_ppf, norm_sf2, t_ppf, t_sf2
from panelforge.operators.gram import Moments, merge_all, moments
from panelforge.session import checkpoint_root

# The reference's penalty grids.
ALPHAS = [0.01, 0.1, 1.0, 10.0, 100.0]
L1_RATIOS = [0.1, 0.5, 0.7, 0.9]


@dataclass
class LinearModel:
    features: list[str]
    coef: np.ndarray
    intercept: float
    params: dict = field(default_factory=dict)

    def predict_col(self) -> Column:
        expr = F.lit(float(self.intercept))
        for c, b in zip(self.features, self.coef):
            expr = expr + F.col(c).cast("double") * F.lit(float(b))
        return expr

    def predict(self, df: DataFrame, out: str = "pred") -> DataFrame:
        return df.withColumn(out, self.predict_col())

    def coefficients(self, spark: SparkSession) -> DataFrame:
        """L8."""
        rows = [(f, float(b), float(abs(b))) for f, b in zip(self.features, self.coef)]
        df = spark.createDataFrame(rows, "feature string, coefficient double, abs_coefficient double")
        return df.orderBy(F.col("abs_coefficient").desc(), "feature")


def scaled_pinv(A: np.ndarray) -> tuple[np.ndarray, int]:
    """Pseudo-inverse and rank of a symmetric moment matrix, taken at unit diagonal: columns of very different
    size (an amount beside a share) must not push one another below the cut-off."""
    d = np.sqrt(np.diag(A))
    d = np.where(d > 0, d, 1.0)
    R = A / np.outer(d, d)
    return np.linalg.pinv(R) / np.outer(d, d), int(np.linalg.matrix_rank(R)) if len(d) else 0


# ------------------------------------------------------------------- L1 OLS

def ols_from_moments(m: Moments, features: list[str]) -> tuple[LinearModel, dict, list[tuple]]:
    Cxx, Cxy = m.Cxx, m.Cxy
    inv, rank = scaled_pinv(Cxx)
    beta = inv @ Cxy
    b0 = m.ybar - m.xbar @ beta
    sse = max(m.Cyy - 2 * beta @ Cxy + beta @ Cxx @ beta, 0.0)
    df_resid = m.n - rank - 1
    sigma2 = sse / df_resid if df_resid > 0 else float("nan")
    cov_b = sigma2 * inv
    var_b0 = sigma2 * (1.0 / m.n + m.xbar @ inv @ m.xbar)
    r2 = 1 - sse / m.Cyy if m.Cyy > 0 else float("nan")
    adj = 1 - (1 - r2) * (m.n - 1) / df_resid if df_resid > 0 else float("nan")
    ssr = m.Cyy - sse
    f = (ssr / rank) / sigma2 if rank and sigma2 > 0 else float("nan")
    tq = t_ppf(0.975, df_resid) if df_resid > 0 else float("nan")
    terms = [("const", b0, math.sqrt(max(var_b0, 0)))] + [
        (name, beta[i], math.sqrt(max(cov_b[i, i], 0))) for i, name in enumerate(features)]
    table = []
    for name, c, se in terms:
        t = c / se if se > 0 else float("nan")
        pv = t_sf2(t, df_resid) if se > 0 else float("nan")
        table.append((name, float(c), float(se), float(t), float(pv), float(c - tq * se), float(c + tq * se)))
    stats = {"n": m.n, "df_resid": df_resid, "r2": r2, "adj_r2": adj, "f_stat": f,
             "f_pvalue": f_sf(f, rank, df_resid) if not math.isnan(f) else float("nan"),
             "sigma": math.sqrt(sigma2) if sigma2 == sigma2 else float("nan"), "sse": sse}
    return LinearModel(list(features), beta, float(b0), stats), stats, table


COEF_SCHEMA = "term string, coef double, std_err double, t double, p_value double, ci_low double, ci_high double"


def ols(df: DataFrame, features: list[str], label: str) -> tuple[LinearModel, DataFrame, DataFrame]:
    """L1: returns (model, coefficient table, one-row fit statistics)."""
    m = moments(df, [*features, label])[()]
    model, stats, table = ols_from_moments(m, features)
    spark = df.sparkSession
    return (model, spark.createDataFrame(table, COEF_SCHEMA),
            spark.createDataFrame([tuple(float(stats[k]) for k in ("n", "df_resid", "r2", "adj_r2", "f_stat",
                                                                     "f_pvalue", "sigma"))],
                                  "n double, df_resid double, r2 double, adj_r2 double, f_stat double, "
                                  "f_pvalue double, sigma double"))


# ------------------------------------------------------------------- L3 VIF

def vif(df: DataFrame, features: list[str]) -> DataFrame:
    """L3 (+O6): VIF_j = [R^-1]_jj with R the correlation matrix of complete rows;
    equal to 1 / (1 - R^2_j) of the auxiliary regression with a constant."""
    m = moments(df, [*features, features[0]])[()]
    C = m.C[:-1, :-1]
    d = np.sqrt(np.diag(C))
    with np.errstate(divide="ignore", invalid="ignore"):
        R = C / np.outer(d, d)
    inv = np.linalg.pinv(R)
    rows = [(f, float(inv[i, i])) for i, f in enumerate(features)]
    return df.sparkSession.createDataFrame(rows, "feature string, vif double").orderBy(F.col("vif").desc(), "feature")


# ------------------------------------------------------------------- L4 ridge

def ridge_from_moments(m: Moments, alpha: float) -> tuple[np.ndarray, float]:
    p = len(m.xbar)
    beta = np.linalg.solve(m.Cxx + alpha * np.eye(p), m.Cxy) if p else np.zeros(0)
    return beta, float(m.ybar - m.xbar @ beta)


def r2_on(m_val: Moments, beta: np.ndarray, b0: float) -> float:
    """R^2 of (b0, beta) on a validation set given only its moments."""
    resid_mean = m_val.ybar - b0 - m_val.xbar @ beta
    sse = m_val.Cyy - 2 * beta @ m_val.Cxy + beta @ m_val.Cxx @ beta + m_val.n * resid_mean ** 2
    if m_val.Cyy > 0:
        return 1 - sse / m_val.Cyy
    return 1.0 if sse == 0 else 0.0


def mse_on(m_val: Moments, beta: np.ndarray, b0: float) -> float:
    resid_mean = m_val.ybar - b0 - m_val.xbar @ beta
    sse = m_val.Cyy - 2 * beta @ m_val.Cxy + beta @ m_val.Cxx @ beta + m_val.n * resid_mean ** 2
    return sse / m_val.n


def cv_splits(by_group: dict, folds) -> list[tuple[Moments, Moments]]:
    """``folds``: list of (train_keys, val_keys) over the group keys of ``by_group``."""
    out = []
    for tr, va in folds:
        out.append((merge_all(by_group[k] for k in tr if k in by_group),
                    merge_all(by_group[k] for k in va if k in by_group)))
    return out


def ridge_cv(df: DataFrame, features: list[str], label: str, *, fold_col: str, alphas=ALPHAS,
             folds=None) -> tuple[LinearModel, DataFrame]:
    """L4: one pass of per-fold moments; every (fold, alpha) solved on the driver.
    ``folds`` defaults to k-fold over the values of ``fold_col`` (train = others, val = that fold);
    pass explicit (train_keys, val_keys) lists for walk-forward designs.  Selection by mean R^2."""
    by = moments(df, [*features, label], [fold_col])
    keys = sorted(by)
    folds = folds or [([k2 for k2 in keys if k2 != k], [k]) for k in keys]
    splits = cv_splits(by, folds)
    scores = []
    for a in alphas:
        r2s = [r2_on(va, *ridge_from_moments(tr, a)) for tr, va in splits]
        scores.append((float(a), float(np.mean(r2s)), float(np.std(r2s))))
    best = max(scores, key=lambda s: (s[1], -s[0]))[0]
    full = merge_all(by.values())
    beta, b0 = ridge_from_moments(full, best)
    model = LinearModel(list(features), beta, b0, {"alpha": best})
    table = df.sparkSession.createDataFrame(scores, "alpha double, mean_r2 double, std_r2 double")
    return model, table


def ridge(df: DataFrame, features: list[str], label: str, alpha: float) -> LinearModel:
    m = moments(df, [*features, label])[()]
    beta, b0 = ridge_from_moments(m, alpha)
    return LinearModel(list(features), beta, b0, {"alpha": alpha})


# ------------------------------------------------------------------- L5 / L6 elastic net

def enet_from_moments(m: Moments, alpha: float, l1_ratio: float, *, max_iter: int = 10_000,
                      tol: float = 1e-4, warm: np.ndarray | None = None) -> tuple[np.ndarray, float]:
    """Coordinate descent for (1/2n)||y - b - Xw||^2 + alpha*l1*||w||_1 + alpha*(1-l1)/2*||w||^2
    on the centered Gram form (the intercept is unpenalized)."""
    n = m.n
    G, q = m.Cxx / n, m.Cxy / n
    p = len(q)
    w = np.zeros(p) if warm is None else warm.copy()
    l1, l2 = alpha * l1_ratio, alpha * (1 - l1_ratio)
    for _ in range(max_iter):
        w_max, d_max = 0.0, 0.0
        for j in range(p):
            if G[j, j] == 0:
                continue
            old = w[j]
            rho = q[j] - G[j] @ w + G[j, j] * old
            new = math.copysign(max(abs(rho) - l1, 0.0), rho) / (G[j, j] + l2)
            w[j] = new
            d_max = max(d_max, abs(new - old))
            w_max = max(w_max, abs(new))
        if w_max == 0 or d_max / w_max < tol:
            break
    return w, float(m.ybar - m.xbar @ w)


def elasticnet_cv(df: DataFrame, features: list[str], label: str, *, fold_col: str, alphas=ALPHAS,
                  l1_ratios=L1_RATIOS, folds=None) -> tuple[LinearModel, DataFrame]:
    """L6 (L5 with l1_ratios=[1.0]): best (alpha, l1_ratio) by mean fold MSE."""
    by = moments(df, [*features, label], [fold_col])
    keys = sorted(by)
    folds = folds or [([k2 for k2 in keys if k2 != k], [k]) for k in keys]
    splits = cv_splits(by, folds)
    scores = []
    for r in l1_ratios:
        for a in sorted(alphas, reverse=True):
            mses = [mse_on(va, *enet_from_moments(tr, a, r)) for tr, va in splits]
            scores.append((float(r), float(a), float(np.mean(mses))))
    best_r, best_a, _ = min(scores, key=lambda s: (s[2], s[0], -s[1]))
    full = merge_all(by.values())
    w, b0 = enet_from_moments(full, best_a, best_r)
    model = LinearModel(list(features), w, b0, {"alpha": best_a, "l1_ratio": best_r})
    table = df.sparkSession.createDataFrame(scores, "l1_ratio double, alpha double, mean_mse double")
    return model, table


def lasso_cv(df: DataFrame, features: list[str], label: str, *, fold_col: str, alphas=ALPHAS, folds=None):
    """L5."""
    return elasticnet_cv(df, features, label, fold_col=fold_col, alphas=alphas, l1_ratios=[1.0], folds=folds)


# ------------------------------------------------------------------- L2 pooled OLS, clustered errors

def _levels(df: DataFrame, col: str, most: int) -> list:
    found = df.select(col).distinct().limit(most + 1).collect()
    if len(found) > most:
        raise ValueError(f"{col} has over {most} levels, too many for a column each; absorb them (operators/absorb.py)")
    return sorted(r[0] for r in found)


def fe_ols_clustered(df: DataFrame, features: list[str], label: str, *, entity: str = "entity",
                     category: str = "category", period: str = "period",
                     max_levels: int = 10_000) -> tuple[DataFrame, dict]:
    """L2 with a column per level, where errors of the level terms are wanted (any number of levels: absorb.fe_ols_absorbed):
    y on features + category and month dummies (first level dropped) + const, covariance clustered by entity (statsmodels' small-sample factor
    G/(G-1) * (n-1)/(n-k)), z statistics.

    Pass 1: moments of the full design (wide route).  Pass 2: residuals as a
    column expression (dummy coefficients looked up from literal maps), score
    sums s_g = sum_i x_i e_i per entity, and their outer-product sum (a second
    wide moment pass over the entity table).  Only k x k numbers reach the driver.
    """
    checkpoint_root(df.sparkSession)  # several passes follow: cut lineage once in the shared folder
    data = df.dropna(subset=[*features, label, category, period, entity]).checkpoint(eager=True)
    cats, pers = (_levels(data, c, max_levels) for c in (category, period))
    dummy_cols = [(category, v, f"{category}_{v}") for v in cats[1:]] + [(period, v, f"{period}_{v}")
                                                                         for v in pers[1:]]
    design = data.select(entity, category, period, *[F.col(c).cast("double").alias(c) for c in features],
                         *[F.when(F.col(src) == F.lit(v), 1.0).otherwise(0.0).alias(name)
                           for src, v, name in dummy_cols],
                         F.col(label).cast("double").alias("_y"))
    xcols = [*features, *[d[2] for d in dummy_cols]]
    m = moments(design, [*xcols, "_y"])[()]
    beta = scaled_pinv(m.Cxx)[0] @ m.Cxy
    b0 = m.ybar - m.xbar @ beta
    k = len(xcols) + 1
    n = m.n
    # residual expression: b0 + features + looked-up dummy coefficients
    coef = dict(zip(xcols, beta))
    cat_map = F.create_map(*[x for v in cats[1:] for x in (F.lit(v), F.lit(float(coef[f"{category}_{v}"])))]) \
        if len(cats) > 1 else None
    per_map = F.create_map(*[x for v in pers[1:] for x in (F.lit(v), F.lit(float(coef[f"{period}_{v}"])))]) \
        if len(pers) > 1 else None
    fit = F.lit(float(b0))
    for c in features:
        fit = fit + F.col(c) * F.lit(float(coef[c]))
    if cat_map is not None:
        fit = fit + F.coalesce(F.element_at(cat_map, F.col(category)), F.lit(0.0))
    if per_map is not None:
        fit = fit + F.coalesce(F.element_at(per_map, F.col(period)), F.lit(0.0))
    resid = design.withColumn("_e", F.col("_y") - fit)
    scores = resid.groupBy(entity).agg(
        F.sum("_e").alias("s_const"), *[F.sum(F.col(c) * F.col("_e")).alias(f"s_{c}") for c in xcols])
    s_cols = ["s_const", *[f"s_{c}" for c in xcols]]
    G = scores.count()
    # sum_g s_g s_g^T = C + G * mean mean^T from the moments of the entity table
    ms = moments(scores, [*s_cols, s_cols[0]])[()]
    meat = ms.C[:-1, :-1] + G * np.outer(ms.mean[:-1], ms.mean[:-1])
    # bread: inverse of X^T X with the constant first, rebuilt from the moments
    XtX = np.zeros((k, k))
    XtX[0, 0] = n
    XtX[0, 1:] = XtX[1:, 0] = n * m.xbar
    XtX[1:, 1:] = m.Cxx + n * np.outer(m.xbar, m.xbar)
    bread = scaled_pinv(XtX)[0]
    factor = (G / (G - 1)) * ((n - 1) / (n - k)) if G > 1 and n > k else float("nan")
    cov = factor * bread @ meat @ bread
    names = ["const", *xcols]
    params = np.concatenate([[b0], beta])
    zq = norm_ppf(0.975)
    rows = []
    for i, name in enumerate(names):
        se = math.sqrt(max(cov[i, i], 0.0))
        z = params[i] / se if se > 0 else float("nan")
        rows.append((name, float(params[i]), float(se), float(z), float(norm_sf2(z)) if se > 0 else float("nan"),
                     float(params[i] - zq * se), float(params[i] + zq * se)))
    sse = max(m.Cyy - 2 * beta @ m.Cxy + beta @ m.Cxx @ beta, 0.0)
    info = {"n": n, "groups": G, "k": k, "r2": 1 - sse / m.Cyy if m.Cyy > 0 else float("nan")}
    return df.sparkSession.createDataFrame(rows, COEF_SCHEMA.replace(" t double", " z double")), info
