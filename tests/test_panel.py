"""Panel construction, next-month target and diagnostics."""

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from panelforge.operators import panel as pn


def test_next_month_target_year_boundary_gap_and_last_row(spark):
    rows = [(1, 202011, 1.0), (1, 202012, 2.0), (1, 202101, 3.0), (1, 202103, 4.0)]
    df = spark.createDataFrame(rows, "entity long, period int, ret double")
    got = sorted((r["period"], r["target"], r["target_month"])
                 for r in pn.next_month_target(df).collect())
    assert got == [(202011, 2.0, 202012), (202012, 3.0, 202101)]


def test_next_month_target_null_target_and_duplicate_key(spark):
    rows = [(1, 202001, 1.0), (1, 202002, None), (1, 202003, 5.0), (2, 202001, 1.0), (2, 202001, 1.5),
            (2, 202002, 7.0)]
    df = spark.createDataFrame(rows, "entity long, period int, ret double")
    got = pn.next_month_target(df).collect()
    # entity 1: 202001 -> NULL target dropped; 202002 -> 5.0 kept.  entity 2: the gap-0 row is dropped.
    assert sorted((r["entity"], r["period"], r["target"]) for r in got if r["entity"] == 1) == [(1, 202002, 5.0)]
    e2 = [r for r in got if r["entity"] == 2]
    assert len(e2) == 1 and e2[0]["target"] == 7.0


def test_log_aum_per_row(spark):
    df = spark.createDataFrame([(0.0,), (-1.0,), (None,), (np.e - 1,)], "aum double")
    got = [r["log_aum"] for r in pn.log_aum(df).collect()]
    assert got[0] == 0.0 and got[1] is None and got[2] is None and abs(got[3] - 1.0) < 1e-12


def test_standardize_scale_missing_to_zero(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (None,)], "x double")
    z = [r["x"] for r in pn.standardize_panel(df, ["x"]).collect()]
    assert z == [-1.0, 0.0, 1.0, 0.0]
    const = spark.createDataFrame([(2.0,), (2.0,)], "x double")
    assert [r["x"] for r in pn.standardize_panel(const, ["x"]).collect()] == [0.0, 0.0]


def test_dummies_first_level_dropped(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c"), (4, "b"), (5, None)], "id long, cat string")
    got = sorted((r["id"], r["dummy"], r["value"]) for r in pn.dummies_long(df, ["cat"], ["id"]).collect())
    assert got == [(2, "cat_b", 1.0), (3, "cat_c", 1.0), (4, "cat_b", 1.0)]


def test_masked_correlations_equal_pandas(spark):
    """Pairwise-complete rows; 300 pairs in one pass over the rows; no value without variance."""
    rng = np.random.default_rng(6)
    x = rng.normal(size=(400, 25)) * 10.0 ** rng.integers(-6, 7, 25) + 10.0 ** rng.integers(0, 6, 25)
    x[rng.random(x.shape) < 0.2] = np.nan
    pdf = pd.DataFrame(x, columns=[f"c{i:02d}" for i in range(25)])
    pdf["const"] = 3.3
    df = spark.createDataFrame(pdf).repartition(5)
    out = pn.correlation_long(df, list(pdf.columns))
    want = pdf.corr().to_numpy()
    rows = out.collect()
    assert len(rows) == 26 * 25 // 2
    for a, b, c in rows:
        w = want[pdf.columns.get_loc(a), pdf.columns.get_loc(b)]
        assert c is None if np.isnan(w) else abs(c - w) < 2e-6
    assert out._jdf.queryExecution().optimizedPlan().toString().count("MapInArrow") == 1


def test_variance_decomposition_matches_pandas(spark):
    rng = np.random.default_rng(3)
    pdf = pd.DataFrame({"entity": rng.integers(0, 20, 400), "period": rng.integers(0, 30, 400),
                        "category": rng.choice(list("xyz"), 400), "ret": rng.normal(size=400)})
    pdf.loc[::17, "ret"] = np.nan
    df = spark.createDataFrame(pdf).withColumn("ret", F.when(F.isnan("ret"), None).otherwise(F.col("ret")))
    r = pn.variance_decomposition(df, digits=None).first()
    em = pdf.groupby("entity")["ret"].mean()
    within = (pdf["ret"] - pdf["entity"].map(em)).std(ddof=1)
    assert abs(r["overall_std"] - pdf["ret"].std(ddof=1)) < 1e-12
    assert abs(r["between_std"] - em.std(ddof=1)) < 1e-12
    assert abs(r["within_std"] - within) < 1e-12
    assert abs(r["month_variance"] - pdf.groupby("period")["ret"].mean().var(ddof=1)) < 1e-12
    assert abs(r["category_variance"] - pdf.groupby("category")["ret"].mean().var(ddof=1)) < 1e-12


def test_obs_per_entity_matches_describe(spark):
    pdf = pd.DataFrame({"entity": [1, 1, 1, 2, 2, 3, 4, 4, 4, 4], "period": range(10)})
    r = pn.obs_per_entity(spark.createDataFrame(pdf)).first()
    d = pdf["entity"].value_counts().describe()
    assert (r["obs_mean"], r["obs_p25"], r["obs_p50"], r["obs_p75"]) == (
        round(d["mean"], 6), round(d["25%"], 6), round(d["50%"], 6), round(d["75%"], 6))
    bal = pn.panel_balance(spark.createDataFrame(pdf)).first()
    assert not bal["balanced"] and bal["n_periods"] == 10


def test_category_distribution_string(spark):
    df = spark.createDataFrame([("g", "b"), ("g", "a"), ("g", "b"), ("h", "c")], "grp string, category string")
    got = {r["grp"]: r["category_distribution"] for r in pn.category_distribution(df, group="grp").collect()}
    assert got == {"g": "b: 2; a: 1", "h": "c: 1"}
