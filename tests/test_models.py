"""Linear models, PCA, clustering and trees: the reference's model smoke test plus invariants."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from panelforge.operators import cluster as cl
from panelforge.operators import linear as lin
from panelforge.operators import pca as pc
from panelforge.operators import trees as tr
from panelforge.operators.evaluate import fit_mean

FEATS = ["f0", "f1", "f2", "f3", "f4"]


@pytest.fixture(scope="module")
def reg_df(spark):
    rng = np.random.default_rng(42)
    X = rng.normal(size=(50, 5))
    y = X @ np.array([1.5, -2.0, 0.0, 0.5, 1.0]) + rng.normal(scale=0.1, size=50)
    pdf = pd.DataFrame(X, columns=FEATS)
    pdf["target"] = y
    pdf["fold"] = np.arange(50) * 5 // 50
    pdf["entity"] = np.arange(50) % 7
    pdf["period"] = np.arange(50)
    return spark.createDataFrame(pdf), X, y


def _r2(y, p):
    return 1 - ((y - p) ** 2).sum() / ((y - y.mean()) ** 2).sum()


def test_reference_models_smoke(spark, reg_df):
    df, X, y = reg_df
    assert abs(fit_mean(df, "target") - y.mean()) < 1e-12
    ridge, _ = lin.ridge_cv(df, FEATS, "target", fold_col="fold")
    p = ridge.predict(df).select("pred").toPandas()["pred"].to_numpy()
    assert _r2(y, p) > 0.5
    tree, _ = tr.tuned(df, FEATS, "tree", {"maxDepth": [3, 4], "minInstancesPerNode": [1]},
                       [(F.col("fold") != k, F.col("fold") == k) for k in range(5)])
    pt = tree.predict(df).select("pred").toPandas()["pred"].to_numpy()
    assert _r2(y, pt) > 0.5


def test_ols_normal_equations_and_inference(spark, reg_df):
    df, X, y = reg_df
    model, coef, stats = lin.ols(df, FEATS, "target")
    Xc = np.c_[np.ones(50), X]
    b = np.linalg.lstsq(Xc, y, rcond=None)[0]
    assert np.allclose(np.r_[model.intercept, model.coef], b)
    e = y - Xc @ b
    assert np.allclose(Xc.T @ e, 0, atol=1e-8)
    s2 = e @ e / (50 - 6)
    se = np.sqrt(np.diag(s2 * np.linalg.inv(Xc.T @ Xc)))
    got = {r["term"]: r["std_err"] for r in coef.collect()}
    assert np.allclose([got["const"], *[got[f] for f in FEATS]], se)


def test_elastic_net_kkt(spark, reg_df):
    df, X, y = reg_df
    from panelforge.operators.gram import moments
    m = moments(df, [*FEATS, "target"])[()]
    alpha, l1 = 0.1, 0.5
    w, b0 = lin.enet_from_moments(m, alpha, l1, tol=1e-12, max_iter=100000)
    Xc, yc = X - X.mean(0), y - y.mean()
    grad = Xc.T @ (yc - Xc @ w) / 50 - alpha * (1 - l1) * w
    for j in range(5):
        if w[j] != 0:
            assert abs(grad[j] - alpha * l1 * np.sign(w[j])) < 1e-6
        else:
            assert abs(grad[j]) <= alpha * l1 + 1e-6


def test_vif_collinear_is_large(spark):
    rng = np.random.default_rng(2)
    a = rng.normal(size=200)
    pdf = pd.DataFrame({"a": a, "b": a + rng.normal(scale=0.01, size=200), "c": rng.normal(size=200)})
    v = {r["feature"]: r["vif"] for r in lin.vif(spark.createDataFrame(pdf), ["a", "b", "c"]).collect()}
    assert v["a"] > 100 and v["b"] > 100 and v["c"] < 1.2


def test_clustered_ols_matches_sandwich(spark):
    rng = np.random.default_rng(7)
    n = 300
    pdf = pd.DataFrame({"entity": rng.integers(0, 25, n), "period": rng.integers(0, 4, n) + 202001,
                        "category": rng.choice(["p", "q", "r"], n), "x": rng.normal(size=n)})
    pdf["y"] = 0.5 * pdf["x"] + rng.normal(size=n) + pdf["entity"] * 0.05
    coef, info = lin.fe_ols_clustered(spark.createDataFrame(pdf), ["x"], "y")
    X = pd.get_dummies(pdf[["x", "category", "period"]].astype({"period": str}), columns=["category", "period"],
                       drop_first=True, dtype=float)
    X.insert(0, "const", 1.0)
    Xv, yv = X.to_numpy(), pdf["y"].to_numpy()
    b = np.linalg.lstsq(Xv, yv, rcond=None)[0]
    e = yv - Xv @ b
    bread = np.linalg.inv(Xv.T @ Xv)
    meat = sum(np.outer(Xv[g].T @ e[g], Xv[g].T @ e[g]) for g in
               [pdf["entity"].to_numpy() == k for k in np.unique(pdf["entity"])])
    G, k = len(np.unique(pdf["entity"])), Xv.shape[1]
    cov = G / (G - 1) * (n - 1) / (n - k) * bread @ meat @ bread
    got = {r["term"]: (r["coef"], r["std_err"]) for r in coef.collect()}
    assert abs(got["x"][0] - b[1]) < 1e-10 and abs(got["x"][1] - np.sqrt(cov[1, 1])) < 1e-10
    assert abs(got["const"][1] - np.sqrt(cov[0, 0])) < 1e-10


def test_pca_invariants(spark, reg_df):
    df, X, _ = reg_df
    m = pc.pca_fit(df, FEATS)
    W = m.components
    assert np.allclose(W @ W.T, np.eye(5), atol=1e-10)
    assert abs(m.eigenvalues.sum() - np.trace(np.cov(X.T))) < 1e-10
    for row in W:
        assert row[np.argmax(np.abs(row))] > 0
    ev = m.explained_variance(spark).orderBy("component_index").collect()
    assert abs(ev[-1]["cumulative_variance_pct"] - 100) < 1e-9


def _brute_metrics(P, lab):
    ks = sorted(set(lab))
    mu = {k: P[lab == k].mean(0) for k in ks}
    d2 = ((P[:, None, :] - P[None, :, :]) ** 2).sum(-1)
    s = []
    for i in range(len(P)):
        own = lab == lab[i]
        if own.sum() == 1:
            s.append(0.0)
            continue
        a = d2[i, own].sum() / (own.sum() - 1)
        b = min(d2[i, lab == k].mean() for k in ks if k != lab[i])
        s.append((b - a) / max(a, b))
    S = {k: np.sqrt(((P[lab == k] - mu[k]) ** 2).sum(1)).mean() for k in ks}
    db = np.mean([max((S[i] + S[j]) / np.linalg.norm(mu[i] - mu[j]) for j in ks if j != i) for i in ks])
    W = sum(((P[lab == k] - mu[k]) ** 2).sum() for k in ks)
    g = P.mean(0)
    B = sum((lab == k).sum() * ((mu[k] - g) ** 2).sum() for k in ks)
    ch = (B / (len(ks) - 1)) / (W / (len(P) - len(ks)))
    return np.mean(s), db, ch, W


def test_cluster_metrics_match_brute_force(spark):
    rng = np.random.default_rng(4)
    P = np.r_[rng.normal(0, 1, (30, 2)), rng.normal(4, 1, (25, 2)), rng.normal((0, 5), 1, (1, 2))]
    lab = np.r_[np.ones(30), np.full(25, 2), [3]].astype(int)
    pdf = pd.DataFrame(P, columns=["x", "y"])
    pdf["cluster"] = lab
    m = cl.cluster_metrics(spark.createDataFrame(pdf), ["x", "y"], label="cluster")
    sil, db, ch, w = _brute_metrics(P, lab)
    assert abs(m["silhouette_sqeuclidean"] - sil) < 1e-10
    assert abs(m["davies_bouldin"] - db) < 1e-10
    assert abs(m["calinski_harabasz"] - ch) < 1e-8 and abs(m["inertia"] - w) < 1e-9


def test_kmeans_nearest_centre_and_stable_labels(spark):
    rng = np.random.default_rng(8)
    P = np.r_[rng.normal(0, 0.3, (40, 2)), rng.normal(5, 0.3, (40, 2)), rng.normal(10, 0.3, (40, 2))]
    df = spark.createDataFrame(pd.DataFrame(P, columns=["x", "y"]))
    km = cl.kmeans(df, ["x", "y"], 3, restarts=3)
    lab = km.transform(df, "c").toPandas()
    d = ((P[:, None, :] - km.centres[None]) ** 2).sum(-1)
    assert (lab["c"].to_numpy() == d.argmin(1) + 1).all()
    assert km.centres[0, 0] > km.centres[1, 0] > km.centres[2, 0]
    assert abs(km.cost - d.min(1).sum()) < 1e-6


def test_tree_importances(spark, reg_df):
    df, _, _ = reg_df
    model = tr.fit(df, FEATS, "forest", {"numTrees": 20, "maxDepth": 4, "minInstancesPerNode": 2})
    imp = model.impurity_importance(spark).toPandas()
    assert abs(imp["importance"].sum() - 1) < 1e-9
    perm = {r["feature"]: r["importance_mean"] for r in
            tr.permutation_importance(model, df, keys=["period"], n_repeats=3).collect()}
    assert perm["f1"] > perm["f2"] and abs(perm["f2"]) < 0.05


def test_boosting_prefix_scores_equal_separate_fits(spark, reg_df):
    """Candidates that differ only in maxIter share one fit; their scores must equal separate fits."""
    import json
    df, _, _ = reg_df
    folds = [(F.col("fold") != k, F.col("fold") == k) for k in range(2)]
    cands = [{"maxIter": 5, "stepSize": 0.1, "maxDepth": 2}, {"maxIter": 12, "stepSize": 0.1, "maxDepth": 2}]
    _, table = tr.cross_validate(df, FEATS, "gbt", cands, folds)
    shared = {(r["params"], r["fold"]): (r["mae"], r["rmse"], r["r2"]) for r in table.collect()}
    data = tr.assemble(df, FEATS)
    for c in cands:
        for fi, (a, b) in enumerate(folds):
            sc = tr._score(tr.estimator("gbt", dict(c)).fit(data.where(a)).transform(data.where(b)), "target")
            got = shared[(json.dumps(c, sort_keys=True), fi + 1)]
            assert np.allclose(got, (sc["mae"], sc["rmse"], sc["r2"]), atol=1e-9)


def _fits_of(monkeypatch):
    """The (kind, parameters, partitions of the training rows) of every fit from here on."""
    seen, build = [], tr.estimator

    def spied(kind, params, **kw):
        est = build(kind, params, **kw)
        fit = est.fit
        est.fit = lambda rows: seen.append((kind, params, rows.rdd.getNumPartitions())) or fit(rows)
        return est

    monkeypatch.setattr(tr, "estimator", spied)
    return seen


@pytest.mark.parametrize("kind, fixed", [("tree", {}), ("forest", {"numTrees": 7})])
def test_depths_share_one_fit_and_score_as_separate_fits(spark, reg_df, monkeypatch, kind, fixed):
    import json
    df, _, _ = reg_df
    folds = [(F.col("fold") != k, F.col("fold") == k) for k in range(2)]
    cands = [{**fixed, "maxDepth": d, "minInstancesPerNode": m} for d in (1, 2, 4) for m in (1, 3)]
    fits = _fits_of(monkeypatch)
    _, table = tr.cross_validate(df, FEATS, kind, cands, folds)
    assert len(fits) == 4  # 2 leaf sizes, 2 folds
    shared = {(r["params"], r["fold"]): (r["mae"], r["rmse"], r["r2"]) for r in table.collect()}
    assert len(shared) == 12
    data = tr.assemble(df, FEATS).persist()  # as stored, the rows lie in the same partitions for the same bootstrap draws
    for c in cands:
        for fi, (a, b) in enumerate(folds):
            sc = tr._score(tr.estimator(kind, dict(c)).fit(data.where(a)).transform(data.where(b)), "target")
            assert np.allclose(shared[(json.dumps(c, sort_keys=True), fi + 1)], (sc["mae"], sc["rmse"], sc["r2"]), atol=1e-9)
    data.unpersist()


def test_boosting_on_few_rows_runs_in_few_tasks(spark, reg_df, monkeypatch):
    df, _, _ = reg_df
    fits = _fits_of(monkeypatch)
    cand = [{"maxIter": 2, "maxDepth": 2}]
    _, table = tr.cross_validate(df.repartition(9), FEATS, "gbt", cand, [(F.col("fold") != 0, F.col("fold") == 0)])
    assert [n for _, _, n in fits] == [1] and table.count() == 1


def test_permuted_index_passes_the_range_of_long(spark):
    from panelforge.operators.trees import permuted_index
    n, a, i, b = 5_000_000_000, 4_999_999_997, 4_999_999_999, 12_345
    got = spark.createDataFrame([(a, i, b)], "a long, i long, b long").select(permuted_index("a", "i", "b", n)).first()[0]
    assert got == (a * i + b) % n


def test_wide_moments_shuffle_one_triangle_per_partition_and_group(spark):
    import numpy as np
    from pyspark.sql import functions as F

    from panelforge.operators import gram
    cols = [f"c{i}" for i in range(8)]
    df = spark.range(0, 30_000, 1, 3).select((F.col("id") % 4).alias("g"), *[F.sin(F.col("id") * (i + 1)).alias(c) for i, c in enumerate(cols)])
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "500")
    try:
        got = gram.moments(df, cols, ["g"])
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    pdf = df.toPandas()
    for key, part in pdf.groupby("g"):
        z = part[cols].to_numpy()
        assert np.allclose(got[(key,)].C, (z - z.mean(0)).T @ (z - z.mean(0)))
