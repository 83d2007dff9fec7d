"""Explanatory run: same-month target, key-hash 80/20 split, diagnostics, PCA on the
training numerics, entity clustering of component scores, OLS on components,
pooled OLS with fixed effects and clustered errors, VIF, penalized and tree
models, comparison on the test split."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelforge.operators import absorb as ab
from panelforge.operators import cluster as cl
from panelforge.operators import evaluate as ev
from panelforge.operators import linear as lin
from panelforge.operators import panel as pn
from panelforge.operators import pca as pc
from panelforge.operators import trees as tr
from panelforge.operators.preprocess import fit_preprocess
from panelforge.operators.splits import hash_fold, random_split
from panelforge.plans.design import with_log_size
from panelforge.session import checkpoint_root
from panelforge.sources import sinks


def run_explanatory(panel: DataFrame, numeric: list[str], *, n_components: int = 11, k: int = 3,
                    out_dir: str | None = None, score_scope: str = "train") -> dict:
    spark = panel.sparkSession
    checkpoint_root(spark)
    panel, numeric = with_log_size(panel, numeric)
    base = random_split(panel.withColumn("target", F.col("ret")), ["entity", "period"]).checkpoint(eager=True)
    train = base.where(F.col("split") == "train")
    pre = fit_preprocess(train, numeric, ["category"])
    design = pre.transform(base, keep=["entity", "period", "split", "target"]).checkpoint(eager=True)
    feats = pre.output_columns()
    d_train = design.where(F.col("split") == "train")
    d_test = design.where(F.col("split") == "test")
    diagnostics = pn.variance_decomposition(panel)
    shape = pn.panel_shape(panel)
    # PCA on the scaled training numerics; scores either with the training scaling (default)
    # or, as the descriptive path of the reference, with whole-panel z-scores (ddof 1, missing -> 0)
    pca = pc.pca_fit(d_train, numeric, min(n_components, len(numeric)))
    scored_input = design if score_scope == "train" else pn.standardize_panel(panel, numeric)
    pcs = [f"PC{i + 1}" for i in range(len(pca.eigenvalues))]
    scores = pca.transform(scored_input, keep=["entity"])
    ent = cl.entity_means(scores, pcs).checkpoint(eager=True)
    km = cl.kmeans(ent, pcs, k, key="entity")
    assign = km.transform(ent, "kmeans_cluster").select("entity", "kmeans_cluster")
    metrics = cl.cluster_metrics(km.transform(ent, "cluster"), pcs, label="cluster")
    profiles = cl.cluster_profiles(km.transform(ent, "cluster"), pcs)
    ols_pc, ols_pc_coef, ols_pc_stats = lin.ols(pca.transform(d_train, keep=["target"]), pcs, "target")
    fe_coef, fe_effects, _ = ab.fe_ols_absorbed(panel, numeric, "ret")
    vif = lin.vif(pn.complete_cases(panel, numeric), numeric)
    folded = hash_fold(d_train, ["entity", "period"])
    ridge, _ = lin.ridge_cv(folded, feats, "target", fold_col="fold")
    enet, _ = lin.elasticnet_cv(folded, feats, "target", fold_col="fold")
    tree, _ = tr.tuned(folded, feats, "tree", tr.TREE_GRID, [(F.col("fold") != f, F.col("fold") == f) for f in range(5)])
    mean = ev.fit_mean(d_train, "target")
    scored = tree.predict(design.withColumn("pred_ridge", ridge.predict_col())
                          .withColumn("pred_elastic_net", enet.predict_col())
                          .withColumn("pred_ols_on_components",
                                      F.lit(ols_pc.intercept) + sum((c * float(b) for c, b in zip(
                                          pca.score_columns(), ols_pc.coef)), F.lit(0.0)))
                          .withColumn("pred_mean_baseline", F.lit(mean)), out="pred_decision_tree")
    long = ev.long_predictions(scored, ["entity", "period", "split"])
    comparison = ev.comparison_table(long, ["split"])
    out = {"shape": shape, "diagnostics": diagnostics, "explained_variance": pca.explained_variance(spark),
           "loadings": pca.loadings(spark), "assignments": assign, "profiles": profiles,
           "cluster_metrics": cl.metrics_frame(spark, metrics), "ols_on_components": ols_pc_coef,
           "ols_on_components_fit": ols_pc_stats, "fe_ols_clustered": fe_coef, "fe_effects": fe_effects, "vif": vif,
           "comparison": comparison}
    if out_dir:
        sinks.sink_processed(design, f"{out_dir}/processed", "explanatory")
        sinks.sink_pca(spark, pca, scores, out_dir, "explanatory")
        sinks.sink_clusters(assign, profiles, out["cluster_metrics"], out_dir, "explanatory")
        sinks.sink_comparison(comparison, f"{out_dir}/comparison/explanatory")
    return out
