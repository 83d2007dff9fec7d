"""Absorbed fixed effects against dense dummy regressions."""
import numpy as np
import pandas as pd
import pytest

from panelforge.operators import absorb as ab
from panelforge.operators import linear as lin


def frame(n=600, entities=40, seed=0, levels=(5, 30)):
    rng = np.random.default_rng(seed)
    e = rng.integers(0, entities, n)
    c = np.array([f"c{i}" for i in range(levels[0])])[e % levels[0]] if seed % 2 else rng.choice([f"c{i}" for i in range(levels[0])], n)
    t = 200001 + rng.integers(0, levels[1], n)
    x = rng.normal(size=(n, 3)) * [1.0, 1e6, 1e-3] + [0, 5e7, 0] + np.array([t % 7]).T * [0.1, 1e5, 1e-4]
    y = x @ [0.5, 1e-6, 200.0] + np.array([len(s) + int(s[1:]) for s in c]) + (t % 5) + rng.normal(size=n) + 0.3 * (e % 3)
    return pd.DataFrame({"entity": e.astype("int64"), "category": c, "period": t.astype("int64"), "x0": x[:, 0], "x1": x[:, 1], "x2": x[:, 2], "y": y})


def dense(pdf, feats, factors):
    X = pd.get_dummies(pdf[feats + factors], columns=factors, drop_first=True, dtype=float)
    X.insert(0, "const", 1.0)
    y = pdf.y.to_numpy()
    scale = X.std().replace(0, 1).to_numpy()
    Z = X.to_numpy() / scale
    b = np.linalg.lstsq(Z, y, rcond=None)[0]
    res, bread = y - Z @ b, np.linalg.pinv(Z.T @ Z)
    meat = sum(np.outer(v, v) for v in (Z[ix].T @ res[ix] for ix in pdf.groupby("entity").indices.values()))
    n, k = Z.shape
    g = pdf.entity.nunique()
    cov = bread @ meat @ bread * g / (g - 1) * (n - 1) / (n - k)
    return pd.DataFrame({"coef": b / scale, "std_err": np.sqrt(np.diag(cov)) / scale}, index=X.columns), k


@pytest.mark.parametrize("seed", [0, 1])
def test_absorbed_equals_dummies(spark, seed):
    """Coefficients, clustered errors and level effects; columns of very different size, unbalanced cells."""
    pdf, feats = frame(seed=seed), ["x0", "x1", "x2"]
    coef, effects, info = ab.fe_ols_absorbed(spark.createDataFrame(pdf), feats, "y")
    want, k = dense(pdf, feats, ["category", "period"])
    got = coef.toPandas().set_index("term")
    assert info["n"] == len(pdf) and info["groups"] == pdf.entity.nunique() and info["k"] == k
    for c in ("coef", "std_err"):
        assert np.allclose(got[c], want.loc[feats, c], rtol=1e-8, atol=0)
    for f, level, v in effects.collect():
        name = f"{f}_{level}"
        assert abs(v - (want.coef[name] if name in want.index else 0.0)) < 1e-8


def test_dummy_form_agrees(spark):
    pdf, feats = frame(), ["x0", "x1", "x2"]
    got = lin.fe_ols_clustered(spark.createDataFrame(pdf), feats, "y")[0].toPandas().set_index("term")
    want, _ = dense(pdf, feats, ["category", "period"])
    assert np.allclose(got.loc[want.index, "coef"], want.coef, rtol=1e-6, atol=1e-9)
    assert np.allclose(got.loc[feats, "std_err"], want.loc[feats, "std_err"], rtol=1e-6)


def test_weakly_linked_levels_converge(spark):
    """A chain of levels that share one row each: projections move slowly, but end at the dummy form."""
    rng = np.random.default_rng(3)
    a = np.repeat(np.arange(6), 2)[:-1]
    b = np.concatenate([[0], np.repeat(np.arange(1, 6), 2)])
    pdf = pd.DataFrame({"entity": np.arange(44) % 9, "category": np.tile([f"c{i}" for i in a], 4), "period": np.tile(b, 4).astype("int64"),
                        "x": rng.normal(size=44), "y": rng.normal(size=44)})
    coef, _, info = ab.fe_ols_absorbed(spark.createDataFrame(pdf), ["x"], "y")
    want, _ = dense(pdf.rename(columns={"x": "x0"}), ["x0"], ["category", "period"])
    assert info["rounds"] > 5
    assert abs(coef.first()["coef"] - want.coef["x0"]) < 1e-8


def test_many_levels_and_missing_values(spark):
    """More levels than a plan could hold as columns; rows with a missing value in any column go."""
    n = 30_000
    rng = np.random.default_rng(1)
    pdf = pd.DataFrame({"entity": (np.arange(n) % 50).astype("int64"), "category": [f"k{i // 2}" for i in range(n)], "y": rng.normal(size=n)})
    pdf["x"] = rng.normal(size=n)
    pdf.loc[::1000, "x"] = None
    pdf.loc[1::1000, "category"] = None
    coef, effects, info = ab.fe_ols_absorbed(spark.createDataFrame(pdf).replace(float("nan"), None), ["x"], "y", factors=("category",))
    kept = pdf.dropna()
    d = kept[["x", "y"]] - kept.groupby("category")[["x", "y"]].transform("mean")
    assert info["n"] == len(kept) and info["rounds"] == 1
    assert abs(coef.first()["coef"] - (d.x * d.y).sum() / (d.x ** 2).sum()) < 1e-9
    assert effects.count() == kept.category.nunique()


def test_plan_reads_each_step_once(spark):
    """A projection joins two reads of the stored cells; nothing doubles from step to step."""
    cells = spark.range(10).selectExpr("id % 3 as f", "cast(0 as int) _j", "1D _n", "1D _m", "1D _r", "0D _e0", "0D _moved").checkpoint()
    plan = ab._project(cells, 0, "f")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LogicalRDD") == 2


def test_rows_take_the_effects_of_few_cells_without_a_shuffle(spark, monkeypatch):
    """Few cells are broadcast to the rows, which are then neither shuffled nor copied; many are joined, with the same results."""
    pdf, feats = frame(), ["x0", "x1", "x2"]
    df = spark.createDataFrame(pdf)
    plan = ab.absorb(df, [*feats, "y"], ["category", "period"], keys=["entity"]).rows._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    few = ab.fe_ols_absorbed(df, feats, "y")
    monkeypatch.setattr(ab, "BROADCAST_NUMBERS", 0)
    assert ab.absorb(df, [*feats, "y"], ["category", "period"]).shuffled
    many = ab.fe_ols_absorbed(df, feats, "y")
    assert np.allclose(few[0].toPandas().iloc[:, 1:], many[0].toPandas().iloc[:, 1:], rtol=1e-9)
    by = [x.toPandas().set_index(["factor", "level"]).effect.sort_index() for x in (few[1], many[1])]
    assert by[0].index.equals(by[1].index) and np.allclose(by[0], by[1], atol=1e-9)
