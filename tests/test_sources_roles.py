"""Roles (P2), scans (S1-S3), sinks (S4-S11) and the model store."""

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from panelforge.operators import linear as lin
from panelforge.operators import pca as pc
from panelforge.roles import REFERENCE_ROLES, DENSE_ROLES, canonical, select_features
from panelforge.sources import models as store
from panelforge.sources import sinks
from panelforge.sources.scan import scan_panel, scan_processed


def test_reference_roles_contract():
    feats = REFERENCE_ROLES.active_features()
    assert len(feats) == 25 and feats == sorted(feats)
    assert "log_AUM" in feats and "AUMT_AUM" not in feats and "Sharpe" not in feats
    assert REFERENCE_ROLES.active_features(with_target=True).count("Average") == 1


def test_select_features_and_canonical(spark):
    cols = ["entity", "period", "category", "ret", *DENSE_ROLES.numeric, "log_aum"]
    df = spark.createDataFrame([tuple(float(i) for i in range(len(cols)))], ", ".join(f"`{c}` double" for c in cols))
    out = select_features(df, DENSE_ROLES)
    assert out.columns == ["entity", "period", "category", *DENSE_ROLES.active_features()]
    with pytest.raises(ValueError):
        select_features(df.drop("hhi"), DENSE_ROLES)
    raw = spark.createDataFrame([("s", 202001, "c", 1.5)], "`Scheme Name` string, `TS_Month End` int, "
                                                        "Category string, Average double")
    assert canonical(raw, REFERENCE_ROLES).columns == ["entity", "period", "category", "ret"]


def test_scan_turns_nan_into_null(spark, tmp_path):
    pdf = pd.DataFrame({"entity": [1, 2], "x": [np.nan, 1.0]})
    spark.createDataFrame(pdf).write.parquet(str(tmp_path / "raw"))
    got = {r["entity"]: r["x"] for r in scan_panel(spark, str(tmp_path / "raw")).collect()}
    assert got == {1: None, 2: 1.0}
    pdf.to_csv(tmp_path / "raw.csv", index=False)
    got = scan_panel(spark, str(tmp_path / "raw.csv"), "entity long, x double", fmt="csv").collect()
    assert sorted((r["entity"], r["x"]) for r in got) == [(1, None), (2, 1.0)]


def test_processed_sink_prunes_by_split(spark, tmp_path):
    df = spark.createDataFrame([(1, "train", 1.0), (2, "test", 2.0)], "entity long, split string, v double")
    sinks.sink_processed(df, str(tmp_path / "proc"), "forecasting")
    got = scan_processed(spark, str(tmp_path / "proc"), "forecasting", split="test")
    assert [r["entity"] for r in got.collect()] == [2]


def test_pca_sink_guards(spark, tmp_path):
    df = spark.createDataFrame(pd.DataFrame(np.random.default_rng(0).normal(size=(20, 2)), columns=["a", "b"]))
    m = pc.pca_fit(df, ["a", "b"])
    sinks.sink_pca(spark, m, m.transform(df), str(tmp_path), "explanatory")
    assert spark.read.parquet(str(tmp_path / "pca/mode=explanatory/explained_variance")).count() == 2
    m.features = ["b", "a"]
    with pytest.raises(AssertionError):
        sinks.sink_pca(spark, m, m.transform(df), str(tmp_path), "explanatory")


def test_final_tables_keep_entity_private(spark, tmp_path):
    rows = spark.createDataFrame([(1, 0.5)], "entity long, abs_error double")
    sinks.sink_final_tables({"error_rows": rows, "comparison": rows.drop("entity")}, str(tmp_path))
    assert "entity" not in spark.read.parquet(str(tmp_path / "public/error_rows")).columns
    assert "entity" in spark.read.parquet(str(tmp_path / "private/error_rows")).columns
    sinks.sink_comparison(rows, str(tmp_path / "cmp"))
    assert spark.read.option("header", "true").csv(str(tmp_path / "cmp/csv")).count() == 1
    sinks.sink_predictions(rows, str(tmp_path / "pred"), "holdout")
    assert spark.read.parquet(str(tmp_path / "pred")).where(F.col("stage") == "holdout").count() == 1


def test_model_store_roundtrip(spark, tmp_path):
    df = spark.createDataFrame(pd.DataFrame(np.random.default_rng(1).normal(size=(30, 3)), columns=["a", "b", "y"]))
    m = lin.ridge(df, ["a", "b"], "y", 1.0)
    store.save_linear(spark, m, str(tmp_path / "ridge"))
    back = store.load_linear(spark, str(tmp_path / "ridge"))
    assert np.allclose(back.coef, m.coef) and math.isclose(back.intercept, m.intercept)
    p = pc.pca_fit(df, ["a", "b"])
    store.save_pca(spark, p, str(tmp_path / "pca"))
    q = store.load_pca(spark, str(tmp_path / "pca"))
    assert np.allclose(q.components, p.components) and q.features == p.features


def test_versions_of_models_and_refusals(spark, tmp_path):
    from panelforge.operators import trees as tr
    from panelforge.operators.preprocess import fit_preprocess
    df = spark.createDataFrame(pd.DataFrame(np.random.default_rng(2).normal(size=(60, 3)), columns=["a", "b", "y"])).withColumn("c", F.lit("x"))
    kept = store.ModelStore(spark, str(tmp_path / "models"))
    with pytest.raises(FileNotFoundError):
        kept.load("m", "ridge", df)
    pre = fit_preprocess(df, ["a", "b"], ["c"])
    first, tree = lin.ridge(df, ["a", "b"], "y", 1.0), tr.fit(df, ["a", "b"], "tree", {"maxDepth": 3}, label="y")
    v1 = kept.save("m", {"ridge": first, "tree": tree, "pca": pc.pca_fit(df, ["a", "b"])}, df, preprocessor=pre, note={"until": 199912})
    v2 = kept.save("m", {"ridge": lin.ridge(df, ["a", "b"], "y", 50.0)}, df)
    assert kept.manifest("m")["version"] == v2 and kept.manifest("m", v1)["note"] == {"until": 199912}
    assert not np.allclose(kept.load("m", "ridge", df).coef, first.coef)
    assert np.allclose(kept.load("m", "ridge", df, version=v1).coef, first.coef)
    again = kept.load("m", "tree", df, version=v1).predict(df).orderBy("a")
    assert [r.pred for r in again.collect()] == [r.pred for r in tree.predict(df).orderBy("a").collect()]
    assert kept.load("m", "pca", df, version=v1).features == ["a", "b"]
    assert kept.preprocessor("m", version=v1).medians == pre.medians
    for rows, key, version in ((df.drop("b"), "ridge", v2), (df.withColumn("a", F.col("a").cast("string")), "ridge", v2), (df, "tree", v2)):
        with pytest.raises(store.ModelMismatch):
            kept.load("m", key, rows, version=version)
    with pytest.raises(store.ModelMismatch):
        kept.preprocessor("m")


def test_panel_build_starts_with_more_partitions_on_larger_sources(spark, tmp_path, monkeypatch):
    from panelforge.sources import interim
    src = str(tmp_path / "t.parquet")
    spark.range(20_000).selectExpr("id", "hash(id) AS v").write.parquet(src)
    monkeypatch.setattr(interim, "BYTES_PER_PARTITION", 4096)
    seen = []

    def build():
        df = spark.read.parquet(src).groupBy("id").count()
        seen.append(spark.conf.get(interim.INITIAL, None))
        return df

    before = spark.conf.get(interim.INITIAL, None)
    assert interim.materialized(spark, "t", [src], build).count() == 20_000
    assert int(seen[0]) >= 20 and spark.conf.get(interim.INITIAL, None) == before


def test_dense_panel_deals_its_lines_once(spark, tmp_path):
    """One exchange by (entity, period) serves the brand aggregate, the ranking and the cells; values by brute force."""
    from panelforge.sources.panels import panel_dense
    rng = np.random.default_rng(0)
    n = 400
    li = pd.DataFrame({"l_suppkey": rng.integers(1, 4, n), "l_partkey": rng.integers(1, 13, n), "l_quantity": rng.integers(1, 51, n).astype(float),
                       "l_extendedprice": rng.integers(1, 500, n).astype(float), "l_discount": rng.integers(0, 11, n) / 100,
                       "l_tax": rng.integers(0, 9, n) / 100, "l_shipdate": pd.to_datetime(rng.choice(["1995-01-05", "1995-01-31", "1995-02-01"], n)).date})
    part = pd.DataFrame({"p_partkey": np.arange(1, 12), "p_brand": [f"b{i % 5}" for i in range(11)], "p_size": np.arange(11) * 5, "p_retailprice": 900.0 + np.arange(11)})
    tables = {"lineitem": li, "part": part, "supplier": pd.DataFrame({"s_suppkey": [1, 2, 3], "s_nationkey": [0, 1, 0]}),
              "nation": pd.DataFrame({"n_nationkey": [0, 1], "n_regionkey": [0, 1]}), "region": pd.DataFrame({"r_regionkey": [0, 1], "r_name": ["A", "B"]})}
    for name, pdf in tables.items():
        spark.createDataFrame(pdf).write.parquet(str(tmp_path / f"{name}.parquet"))
    panel = panel_dense(spark, str(tmp_path))
    plan = panel._jdf.queryExecution().executedPlan().toString()
    dealt = [line for line in plan.splitlines() if "Exchange hashpartitioning(entity" in line and "period" in line]
    assert len(dealt) == 1 and "brand" not in dealt[0].split("hashpartitioning(")[1].split(")")[0]
    got = {(r["entity"], r["period"]): r for r in panel.collect()}
    both = li.merge(part, left_on="l_partkey", right_on="p_partkey")
    both["period"] = [d.year * 100 + d.month for d in both.l_shipdate]
    groups = both.groupby(["l_suppkey", "period"])
    assert set(got) == set(groups.indices)
    for key, g in groups:
        r, brands = got[key], g.groupby("p_brand").l_extendedprice.sum().sort_values(ascending=False)
        total = brands.sum()
        want = {"n_lines": len(g), "n_brands": len(brands), "aum": total, "ret": ((g.l_discount - g.l_tax).mean() * 100), "hhi": (brands ** 2).sum() / total ** 2,
                "top1_pct": brands.iloc[0] / total * 100, "top3_pct": brands.iloc[:3].sum() / total * 100, "small_pct": (g.p_size <= 15).mean() * 100,
                "large_pct": (g.p_size > 35).mean() * 100, "avg_qty": g.l_quantity.mean(), "avg_retail": g.p_retailprice.mean(), "sd_qty": g.l_quantity.std()}
        assert all(abs(r[c] - v) < 2e-6 for c, v in want.items()) and r["category"] == ("B" if key[0] == 2 else "A")


def test_larger_builds_bound_the_bytes_a_task_reads(spark):
    from panelforge.sources import interim
    before = spark.conf.get(interim.ADVISORY, None)
    with interim.shuffles_for(spark, 1 << 34):
        assert spark.conf.get(interim.ADVISORY) == str(interim.TASK_BYTES) and spark.conf.get(interim.INITIAL) == "2048"
    assert spark.conf.get(interim.ADVISORY, None) == before
