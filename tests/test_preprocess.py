"""Train-only preprocessing, including the reference's inline frames."""

import numpy as np
import pandas as pd

from panelforge.functions.quantiles import exact_quantiles, group_quantiles
from panelforge.operators import preprocess as pp
from panelforge.operators.pca import pca_fit


def test_reference_preprocessor_shape_and_no_missing(spark):
    df = spark.createDataFrame([(1.0, 10.0, "a"), (2.0, None, "b"), (3.0, 30.0, "a")],
                               "num1 double, num2 double, cat1 string")
    m = pp.fit_preprocess(df, ["num1", "num2"], ["cat1"])
    out = m.transform(df).toPandas()
    assert out.shape == (3, 4)
    assert not out.isna().any().any()
    assert list(out.columns) == ["num1", "num2", "cat1_a", "cat1_b"]
    # median impute (20), then ddof-0 scaling
    x = np.array([10.0, 20.0, 30.0])
    assert np.allclose(out["num2"], (x - x.mean()) / x.std())


def test_unknown_level_all_zero_and_null_gets_mode(spark):
    train = spark.createDataFrame([("a",), ("b",), ("b",)], "c string")
    m = pp.fit_preprocess(train, [], ["c"])
    test = spark.createDataFrame([("z",), (None,)], "c string")
    got = [tuple(r) for r in m.transform(test).collect()]
    assert got == [(0.0, 0.0), (0.0, 1.0)]


def test_mode_lowest_on_tie_and_constant_scale(spark):
    df = spark.createDataFrame([("b", 5.0), ("a", 5.0)], "c string, x double")
    m = pp.fit_preprocess(df, ["x"], ["c"])
    assert m.modes["c"] == "a" and m.scales["x"] == 1.0


def test_imputed_moments_equal_two_pass(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=301)
    x[::7] = np.nan
    df = spark.createDataFrame(pd.DataFrame({"x": x})).selectExpr("CASE WHEN isnan(x) THEN NULL ELSE x END AS x")
    m = pp.fit_preprocess(df, ["x"], [])
    imp = np.where(np.isnan(x), np.nanmedian(x), x)
    assert abs(m.means["x"] - imp.mean()) < 1e-12 and abs(m.scales["x"] - imp.std()) < 1e-12


def test_save_load_roundtrip(spark, tmp_path):
    df = spark.createDataFrame([(1.0, "a"), (3.0, "b")], "x double, c string")
    m = pp.fit_preprocess(df, ["x"], ["c"])
    m.save(spark, str(tmp_path / "pre"))
    again = pp.PreprocessModel.load(spark, str(tmp_path / "pre"))
    assert again == m
    assert again.level_table.collect() == m.level_table.collect()
    rows = spark.createDataFrame([(None, "b"), (9.0, "zz")], "x double, c string")
    assert again.transform_sparse(rows).collect() == m.transform_sparse(rows).collect()


def test_sparse_rows_equal_the_wide_form(spark):
    df = spark.createDataFrame([(1, 1.0, "b", 7), (2, None, "a", 7), (3, 4.0, None, 9), (4, 2.0, "b", None)], "id long, x double, c string, d int")
    m = pp.fit_preprocess(df, ["x"], ["c", "d"])
    rows = spark.createDataFrame([(1, 1.0, "b", 7), (2, None, "new", 9), (3, 5.0, None, None)], "id long, x double, c string, d int")
    assert m.output_columns() == ["x", "c_a", "c_b", "d_7", "d_9"]
    wide = {r["id"]: [r[c] for c in m.output_columns()] for r in m.transform(rows, keep=["id"]).collect()}
    for r in m.transform_sparse(rows, keep=["id"]).collect():
        dense = [0.0] * r["features"]["size"]
        for i, v in zip(r["features"]["indices"], r["features"]["values"]):
            dense[i] = v
        assert dense == wide[r["id"]]


def test_fifty_thousand_levels(spark):
    """Levels stay a table: no list, no limit, no column for each."""
    n = 50_000
    df = spark.range(0, 2 * n, 1, 4).selectExpr("id", f"concat('k', lpad(id % {n}, 6, '0')) c", "cast(id as double) x").unionByName(
        spark.range(3).selectExpr("id", "'k000123' c", "cast(id as double) x"))
    m = pp.fit_preprocess(df, ["x"], ["c"])
    assert m.n_levels == n and m.modes["c"] == "k000123"
    got = m.transform_sparse(df.where("id % 10007 = 0"), keep=["id"]).selectExpr("id", "features.size s", "element_at(features.indices, -1) i").collect()
    assert len(got) == 11 and all(r["s"] == n + 1 and (r["i"] == 1 + r["id"] % n or r["i"] == 124 and r["id"] < 3) for r in got)


def test_column_order_does_not_change_projection(spark):
    """Reference metamorphic test: scores identical whatever the input column order."""
    rng = np.random.default_rng(1)
    pdf = pd.DataFrame(rng.normal(size=(4, 3)), columns=["A", "B", "C"])
    df = spark.createDataFrame(pdf)
    model = pca_fit(df, ["A", "B", "C"], 2)
    s1 = model.transform(df).toPandas()
    s2 = model.transform(spark.createDataFrame(pdf[["C", "A", "B"]])).toPandas()
    assert np.allclose(s1.values, s2.values)


def test_exact_quantiles_match_numpy(spark):
    rng = np.random.default_rng(5)
    v = np.concatenate([rng.standard_cauchy(3000), np.full(500, 1.0)])
    df = spark.createDataFrame(pd.DataFrame({"v": v})).repartition(6)
    probs = [0.0, 0.1, 0.5, 0.9, 1.0]
    assert exact_quantiles(df, ["v"], probs)["v"] == {p: _linear(v, p) for p in probs}


def _linear(v, p):
    s, h = np.sort(v), p * (len(v) - 1)
    k = int(h)
    return float(s[k]) if h == k else float(s[k] + (h - k) * (s[k + 1] - s[k]))


def test_quantiles_of_any_distribution(spark, monkeypatch):
    """Heavy tails, denormals, infinities, missing values, a NULL key; no job returns more than brackets x 1,026 rows."""
    rng = np.random.default_rng(6)
    wide = np.concatenate([10.0 ** rng.uniform(-300, 300, 500) * rng.choice([-1, 1], 500), [0.0] * 9, [5e-324, -5e-324, 1e-323, np.inf]])
    groups = {"wide": wide, "same": np.full(400, 2.5), "one": np.array([7.0]), None: rng.normal(size=300)}
    rows = [(k, float(x)) for k, v in groups.items() for x in v] + [("none", None), ("none", float("nan")), ("one", None)]
    df = spark.createDataFrame(rows, "k string, x double").repartition(5)
    sizes, collect = [], type(df).collect
    monkeypatch.setattr(type(df), "collect", lambda self: (sizes.append(len(out := collect(self))), out)[1])
    probs = [0.25, 0.5, 0.93]
    got = group_quantiles(df, "k", "x", probs)
    monkeypatch.undo()
    assert got.pop("none") is None
    assert got == {k: {p: _linear(v, p) for p in probs} for k, v in groups.items()}
    assert max(sizes) <= 2 * len(probs) * len(groups) * 1026 and len(sizes) <= 20
    assert group_quantiles(df.limit(0), "k", "x", probs) == {}
