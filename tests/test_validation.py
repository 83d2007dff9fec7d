"""Validation and ingestion guards, including the reference's own inline frames."""

import hashlib

import pytest
from panelforge.operators import validate as va


def test_missing_counts_reference_frame(spark):
    df = spark.createDataFrame([(1.0, None), (None, 2.0), (3.0, 3.0)], "A double, B double")
    got = {r["column_name"]: r["n_missing"] for r in va.missing_counts(df).collect()}
    assert got == {"A": 1, "B": 1}


def test_duplicates_reference_frame(spark):
    df = spark.createDataFrame([(1, 2), (3, 4), (3, 4)], "A int, B int")
    r = va.duplicate_count(df).first()
    assert (r["n_rows"], r["n_duplicates"]) == (3, 1)


def test_duplicates_nulls_compare_equal(spark):
    df = spark.createDataFrame([(1, None), (1, None), (2, None)], "A int, B int")
    assert va.duplicate_count(df).first()["n_duplicates"] == 1
    assert va.dedup_rows(df).count() == 2


def test_value_ranges_reference_frame(spark):
    df = spark.createDataFrame([(-0.05, 1.2, float("inf")), (0.1, 0.5, 1.0), (0.2, 0.3, 1.1)],
                               "Volatility double, `Downside Probability` double, Beta double")
    rows = {r["column_name"]: r for r in va.value_range_checks(df).collect()}
    assert rows["Volatility"]["negative_risk"] and not rows["Volatility"]["has_infinite"]
    assert rows["Downside Probability"]["invalid_probability"]
    assert rows["Beta"]["has_infinite"]
    assert not rows["Beta"]["invalid_probability"] and not rows["Beta"]["negative_risk"]


def test_constant_and_all_null_columns(spark):
    df = spark.createDataFrame([(1.0, None, 2.0), (1.0, None, 3.0)], "c double, n double, v double")
    rows = {r["column_name"]: r["is_constant"] for r in va.value_range_checks(df).collect()}
    assert rows == {"c": True, "n": True, "v": False}


def test_panel_key_guard_fails_not_skips(spark):
    ok = spark.createDataFrame([(1, 202001), (1, 202002)], "entity long, period int")
    va.assert_panel_key_unique(ok)
    bad = ok.unionByName(ok.limit(1))
    with pytest.raises(va.ValidationError):
        va.assert_panel_key_unique(bad)
    assert va.panel_key_duplicates(bad).count() == 1


def test_schema_check_and_leakage(spark):
    df = spark.createDataFrame([(1.0, 2.0)], "a double, target double")
    res = va.schema_valid(df, ["a", "b"], "target")
    assert res == {"valid": False, "missing_features": ["b"], "target_exists": True}
    assert va.schema_check(spark, df, ["a", "b"], "target").where("not present").count() == 1
    assert va.leakage_columns(spark, df, ["target", "Sharpe"]).count() == 1


def test_split_guards(spark):
    rows = [(1, 199911, 199912, "train"), (1, 199912, 200001, "val"), (2, 200012, 200101, "test")]
    df = spark.createDataFrame(rows, "entity long, period int, target_month int, split string")
    assert va.split_disjoint(df, ["entity", "period"]).count() == 0
    order = {r["split"]: r["ordered"] for r in va.split_order(df, train_end=199912, val_end=200012,
                                                               test_end=200112).collect()}
    assert all(order.values())
    assert va.adjacent_months(df).first()["n_violations"] == 0
    bad = df.unionByName(spark.createDataFrame([(3, 200001, 200003, "val")], df.schema))
    assert va.adjacent_months(bad).first()["n_violations"] == 1


def test_holdout_guard(spark):
    fit = spark.createDataFrame([(1, 199901, 199902)], "entity long, period int, target_month int")
    hold = spark.createDataFrame([(1, 200101, 200102)], "entity long, period int, target_month int")
    assert va.holdout_guard(fit, hold, limit=200012).first()["ok"]
    guard = va.FitGuard(hold, hold["target_month"] > 0, limit=200012)
    guard.rows.collect()
    with pytest.raises(va.ValidationError):
        guard.check()
    leak = fit.unionByName(hold)
    r = va.holdout_guard(leak, hold, limit=200012).first()
    assert r["n_overlap"] == 1 and not r["ok"]


def test_drop_profile_hash_matches_hashlib(spark, tmp_path):
    path = str(tmp_path / "drop")
    spark.createDataFrame([(1, 202001), (1, 202002), (2, 202001)], "entity long, period int") \
        .coalesce(1).write.parquet(path)
    prof = va.drop_profile(spark, f"{path}/*.parquet", entity="entity", period="period").collect()
    assert len(prof) == 1
    r = prof[0]
    local = r["file_path"].replace("file:", "")
    with open(local, "rb") as fh:
        assert r["sha256"] == hashlib.sha256(fh.read()).hexdigest()
    assert (r["n_rows"], r["n_entities"], r["n_periods"], r["n_columns"]) == (3, 2, 2, 2)
    again = va.drop_profile(spark, f"{path}/*.parquet")
    assert va.raw_immutable(again, again).count() == 0


def test_schema_drift(spark):
    old = spark.createDataFrame([(1, 1.0, "x")], "a long, b double, c string")
    new = spark.createDataFrame([(1, "1.0", None, 2.0)], "a long, b string, c string, d double")
    st = {r["column_name"]: r["status"] for r in va.schema_drift(old, new).collect()}
    assert st == {"a": "unchanged", "b": "type_changed", "c": "null_rate_shift", "d": "added"}


def test_ledger_roles(spark, tmp_path):
    ledger = va.append_ledger(spark, str(tmp_path / "ledger"), [("d1", "abc", "explanatory", 10),
                                                               ("d2", "def", "prospective", 5)])
    rows = spark.createDataFrame([("d1", 1.0), ("d2", 2.0)], "drop_id string, v double")
    assert [r["drop_id"] for r in va.fit_eligible(rows, ledger).collect()] == ["d1"]
    with pytest.raises(va.ValidationError):
        va.append_ledger(spark, str(tmp_path / "ledger"), [("d3", "x", "unknown", 1)])
