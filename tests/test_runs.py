"""End-to-end forecasting run on the smallest driver tables: invariants of its outputs."""

from pyspark.sql import functions as F

from panelforge.plans.forecasting import run_forecasting
from panelforge.plans.frames import panel
from panelforge.sources.panels import DENSE_FEATURES


def test_forecasting_run(spark, sf_small, tmp_path):
    out = run_forecasting(panel(spark, sf_small, "dense"), DENSE_FEATURES, out_dir=str(tmp_path))
    cmp_ = {r["model"]: r for r in out["comparison"].collect()}
    assert {"ridge", "elastic_net", "decision_tree", "mean_baseline", "zero_return", "persistence",
            "entity_mean", "category_mean"} <= set(cmp_)
    assert sorted(r["rank"] for r in cmp_.values()) == list(range(1, len(cmp_) + 1))
    assert len({r["n_rows"] for r in cmp_.values()}) == 1          # every model scored on the same rows
    assert all(r["ordered"] for r in out["fold_bounds"].collect())
    assert out["ridge_cv"].count() == 5
    groups = {r["entity_group"] for r in out["seen_unseen"].collect()}
    assert groups == {"seen", "unseen"}
    written = spark.read.parquet(str(tmp_path / "processed/mode=forecasting"))
    assert written.select("split").distinct().count() >= 3
    assert spark.read.parquet(str(tmp_path / "predictions")).where(F.col("stage") == "forecasting_validation").count() > 0


def test_explanatory_run(spark, sf_small, tmp_path):
    from panelforge.plans.explanatory import run_explanatory
    out = run_explanatory(panel(spark, sf_small, "dense"), DENSE_FEATURES, out_dir=str(tmp_path))
    cmp_ = out["comparison"].collect()
    assert {r["split"] for r in cmp_} == {"train", "test"}
    assert {r["model"] for r in cmp_} == {"ridge", "elastic_net", "ols_on_components", "mean_baseline",
                                          "decision_tree"}
    ev = out["explained_variance"].orderBy("component_index").collect()
    assert abs(ev[-1]["cumulative_variance_pct"] - 100) < 1e-6          # k = p components
    labels = out["assignments"].collect()
    assert {r["kmeans_cluster"] for r in labels} == {1, 2, 3}
    assert {r["factor"] for r in out["fe_effects"].collect()} == {"category", "period"}
    assert out["cluster_metrics"].first()["k"] == 3
    assert spark.read.parquet(str(tmp_path / "pca/mode=explanatory/loadings")).count() == 11 * 11
    assert spark.read.parquet(str(tmp_path / "clustering/mode=explanatory/assignments")).count() == len(labels)
