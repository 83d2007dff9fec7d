"""Metrics conventions, evaluation tables, streaming ingestion, driver contract."""

import hashlib
import math

from pyspark.sql import functions as F

from panelforge.functions.metrics import regression_metric_columns
from panelforge.operators import evaluate as ev
from panelforge.operators import validate as va
from panelforge.streaming.ingest import current_panel, ingest_drops


def _m(spark, rows):
    df = spark.createDataFrame(rows, "actual double, pred double")
    return df.agg(*regression_metric_columns("actual", "pred", digits=None)).first()


def test_r2_and_mape_conventions(spark):
    r = _m(spark, [(2.0, 2.0), (2.0, 2.0)])
    assert r["r2"] == 1.0
    r = _m(spark, [(2.0, 1.0), (2.0, 3.0)])
    assert r["r2"] == 0.0
    r = _m(spark, [(0.0, 1.0), (0.0, 3.0)])
    assert r["mape"] is None and r["mae"] == 2.0 and math.isclose(r["rmse"], math.sqrt(5))
    r = _m(spark, [(0.0, 1.0), (2.0, 1.0)])
    assert r["mape"] == 50.0


def test_seen_unseen_empty_group_gives_zero_row(spark):
    fit = spark.createDataFrame([(1, 1.0)], "entity long, target double")
    rows = spark.createDataFrame([(1, 2.0, 0.5)], "entity long, target double, ret double")
    flagged = ev.seen_flag(rows, fit)
    lp = ev.long_predictions(ev.add_baselines(flagged, fit, models=(ev.ZERO,)).drop("ret"),
                             ["entity", "seen"])
    out = {r["entity_group"]: r for r in ev.seen_unseen_metrics(lp).collect()}
    assert out["seen"]["n_rows"] == 1 and out["unseen"]["n_rows"] == 0 and out["unseen"]["mae"] == 0.0


def test_category_mean_falls_back_to_overall(spark):
    fit = spark.createDataFrame([("a", 1.0), ("a", 3.0), ("b", 5.0)], "category string, target double")
    rows = spark.createDataFrame([("a",), ("z",), (None,)], "category string")
    got = [r["pred_category_mean"] for r in ev.add_baselines(
        rows.withColumn("entity", F.lit(1)), fit.withColumn("entity", F.lit(1)),
        models=(ev.CATEGORY_MEAN,)).orderBy("category").collect()]
    assert sorted(got) == [2.0, 3.0, 3.0]


def test_streaming_latest_drop_wins_and_replay_is_idempotent(spark, tmp_path):
    schema = "entity long, period int, ret double"
    spark.createDataFrame([(1, 202001, 1.0), (1, 202002, 2.0)], schema).coalesce(1).write.parquet(str(tmp_path / "land/d1"))
    n1 = ingest_drops(spark, str(tmp_path / "land"), str(tmp_path / "store"), str(tmp_path / "ledger"),
                      str(tmp_path / "ckpt"), schema, files_per_batch=1)
    spark.createDataFrame([(1, 202002, 9.0), (1, 202003, 3.0)], schema).coalesce(1).write.parquet(str(tmp_path / "land/d2"))
    n2 = ingest_drops(spark, str(tmp_path / "land"), str(tmp_path / "store"), str(tmp_path / "ledger"),
                      str(tmp_path / "ckpt"), schema, files_per_batch=1)
    n3 = ingest_drops(spark, str(tmp_path / "land"), str(tmp_path / "store"), str(tmp_path / "ledger"),
                      str(tmp_path / "ckpt"), schema, files_per_batch=1)
    assert (n1, n2, n3) == (1, 1, 0)
    cur = {(r["period"]): r["ret"] for r in current_panel(spark, str(tmp_path / "store"), str(tmp_path / "ledger")).collect()}
    assert cur == {202001: 1.0, 202002: 9.0, 202003: 3.0}
    assert spark.read.parquet(str(tmp_path / "ledger")).count() == 2


def test_entry_contract(spark):
    import __spark_entry__ as entry
    df = entry.entry(spark)
    rows = df.collect()
    assert len(rows) == 4 and {r["model"] for r in rows} == {"zero_return", "persistence", "category_mean",
                                                              "development_mean"}
    q, o = entry.queries(), entry.oracle_sql()
    assert set(o) <= set(q) and len(q) >= 60


def test_error_percentiles_exact_per_model(spark):
    import numpy as np
    import pandas as pd
    rng = np.random.default_rng(11)
    pdf = pd.DataFrame({"model": rng.choice(["a", "b", "c"], 3000), "actual": rng.standard_cauchy(3000),
                        "pred": rng.normal(size=3000)})
    got = {r["model"]: r for r in ev.error_percentiles(spark.createDataFrame(pdf)).collect()}
    for m, g in pdf.groupby("model"):
        err = np.abs(g["actual"] - g["pred"]).to_numpy()
        for p, name in ((0.5, "p50"), (0.75, "p75"), (0.9, "p90"), (0.95, "p95")):
            assert abs(got[m][name] - float(np.quantile(err, p))) < 5e-7


def test_replayed_batch_leaves_one_ledger_row_and_faulty_file_stays_out(spark, tmp_path):
    land, store, ledger = (str(tmp_path / n) for n in ("land", "store", "ledger"))
    good = spark.createDataFrame([(1, 202001, 0.5), (2, 202001, 0.1)], "entity long, period int, ret double")
    good.coalesce(1).write.parquet(f"{land}/drop1")
    good.drop("ret").coalesce(1).write.parquet(f"{land}/drop2")
    for attempt in range(2):  # a fresh checkpoint replays batch 0
        ingest_drops(spark, land, store, ledger, str(tmp_path / f"ckpt{attempt}"), good.schema, required=("ret",))
    rows = spark.read.parquet(ledger).collect()
    assert sorted(r.schema_ok for r in rows) == [False, True]
    kept = current_panel(spark, store, ledger).collect()
    assert sorted((r.entity, r.ret) for r in kept) == [(1, 0.5), (2, 0.1)]


def test_a_correction_writes_its_period_alone_and_unfinished_batches_stay_unseen(spark, tmp_path):
    land, store, ledger, drift = (str(tmp_path / n) for n in ("land", "store", "ledger", "drift"))
    schema = "entity long, period int, ret double"
    where = (spark, land, store, ledger, str(tmp_path / "ckpt"), schema)
    first = [(e, 202000 + m, float(e + m)) for e in range(20) for m in range(1, 13)]
    spark.createDataFrame(first, schema).coalesce(1).write.parquet(f"{land}/d1")
    ingest_drops(*where, drift=drift)

    def files():
        return {str(f.relative_to(store)): f.read_bytes() for f in (tmp_path / "store").rglob("*.parquet")}

    before = files()
    spark.createDataFrame([(3, 202005, -1.0), (99, 202005, 7.0)], schema).coalesce(1).write.parquet(f"{land}/d2")
    ingest_drops(*where, drift=drift, role="prospective")
    after = files()
    assert all(after[n] == b for n, b in before.items())
    assert {n.split("/")[0] for n in set(after) - set(before)} == {"part=202005"}
    want = {(e, p): r for e, p, r in first} | {(3, 202005): -1.0, (99, 202005): 7.0}
    rows = current_panel(spark, store, ledger)
    assert rows.columns == ["entity", "period", "ret"] and {(r.entity, r.period): r.ret for r in rows.collect()} == want
    assert rows.count() == len(want)
    # the roles of the drops decide which rows may be fitted
    entries = spark.read.parquet(ledger)
    fit = va.fit_eligible(current_panel(spark, store, ledger, provenance=True), entries)
    assert fit.count() == len(first) - 1
    assert {(r.n_rows, r.n_columns, r.schema_ok, len(r.sha256)) for r in entries.collect()} == {(240, 3, True, 64), (2, 3, True, 64)}
    assert {r.column_name for r in spark.read.parquet(drift).collect()} == {"entity", "period", "ret"}
    # a batch that died before its ledger entry
    spark.createDataFrame([(3, 202005, 0.0)], schema).selectExpr("*", "'x' drop_id", "current_timestamp() drop_time", "'202005' part", "9L epoch") \
        .write.mode("append").partitionBy("part", "epoch").parquet(store)
    assert {(r.entity, r.period): r.ret for r in current_panel(spark, store, ledger).collect()} == want


def test_digests_in_chunks_are_the_files(spark, tmp_path, monkeypatch):
    path = tmp_path / "a b%20c"
    spark.range(5000).write.parquet(str(path))
    monkeypatch.setattr(va, "DIGEST_CHUNK", 1000)
    for f in path.glob("*.parquet"):
        assert va._digest(f"file:{f}") == va._digest(f"file://{f}") == (hashlib.sha256(f.read_bytes()).hexdigest(), f.stat().st_size, ["id"])
    got = {r.sha256 for r in va.file_digests(spark.createDataFrame([(f"file:{f}",) for f in path.glob("*.parquet")], "p string")).collect()}
    assert got == {hashlib.sha256(f.read_bytes()).hexdigest() for f in path.glob("*.parquet")}
