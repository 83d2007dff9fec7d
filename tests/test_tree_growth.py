"""The searches' trees: Spark's own, with fewer jobs and passes."""

import json

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from panelforge.operators import tree_growth as tg
from panelforge.operators import trees as tr

FEATS = ["a", "b", "c", "d"]


def _folds():
    return [(F.col("fold") != k, F.col("fold") == k) for k in range(2)]


def _rows(spark, n, parts):
    rng = np.random.default_rng(11)
    X = np.c_[rng.normal(size=(n, 2)), rng.integers(0, 5, n), rng.random(n) < 0.3]  # zeros and repeated values too
    y = X @ np.array([1.0, -2.0, 0.5, 1.5]) + np.sin(3 * X[:, 0]) + rng.normal(size=n)
    pdf = pd.DataFrame(X, columns=FEATS).assign(target=y, fold=np.arange(n) % 3)
    return spark.createDataFrame(pdf).repartition(parts).persist()


def _searched(df, kind, cands):
    _, table = tr.cross_validate(df, FEATS, kind, cands, _folds())
    return {(r["params"], r["fold"]): (r["mae"], r["rmse"], r["r2"]) for r in table.collect()}


def _fitted(data, kind, cands):
    """The same scores from Spark's estimators, one fit each."""
    out = {}
    for c in cands:
        for fi, (a, b) in enumerate(_folds()):
            sc = tr._score(tr.estimator(kind, dict(c)).fit(data.where(a)).transform(data.where(b)), "target")
            out[json.dumps(c, sort_keys=True), fi + 1] = (sc["mae"], sc["rmse"], sc["r2"])
    return out


def _close(got, want):
    return got.keys() == want.keys() and all(np.allclose(got[k], want[k], rtol=0, atol=1e-9) for k in want)


def _jobs(spark):
    return max(spark.sparkContext.statusTracker().getJobIdsForGroup(None), default=0)


GBT = [{"maxIter": m, "maxDepth": d, "stepSize": 0.2, "minInstancesPerNode": 20} for m, d in ((4, 3), (8, 3), (6, 4))]


def test_boosting_in_one_partition_takes_few_jobs_and_scores_as_spark(spark):
    df = _rows(spark, 1500, 3)
    before = _jobs(spark)
    got = _searched(df, "gbt", GBT)
    assert _jobs(spark) - before < 60  # each of Spark's fits takes a job for each level of each round: 8 * 3 + 6 * 4 on both folds
    assert _close(got, _fitted(tr.packed(tr.assemble(df, FEATS).persist()), "gbt", GBT))


def test_boosting_over_partitions_takes_a_job_for_a_level_of_all_candidates(spark, monkeypatch):
    monkeypatch.setattr(tr, "ROWS_PER_TASK", 400)
    monkeypatch.setattr(tg, "JOBS_PER_CHECKPOINT", 4)
    monkeypatch.setattr(tg, "BLOCK", 100)
    df = _rows(spark, 1500, 6)
    before = _jobs(spark)
    got = _searched(df, "gbt", GBT)
    assert _jobs(spark) - before < 95  # 24 levels of the longest candidate with their checkpoints; Spark's fits take 96 and their own
    assert _close(got, _fitted(tr.assemble(df, FEATS), "gbt", GBT))


@pytest.mark.parametrize("kind, fixed", [("tree", {}), ("forest", {"numTrees": 5}), ("forest", {"numTrees": 9})])
def test_leaf_minima_share_rows_and_trees_and_score_as_spark(spark, monkeypatch, kind, fixed):
    monkeypatch.setattr(tg, "BLOCK", 100)
    df = _rows(spark, 1500, 3)
    stored = []
    store = tg.Forest._store
    monkeypatch.setattr(tg.Forest, "_store", lambda self, rows: stored.append(1) or store(self, rows))
    cands = [{**fixed, "maxDepth": d, "minInstancesPerNode": m} for d, m in ((2, 40), (6, 1), (6, 12), (3, 1))]
    got = _searched(df, kind, cands)
    assert len(stored) == 2  # once a fold
    assert _close(got, _fitted(tr.assemble(df, FEATS).persist(), kind, cands))


def test_forest_over_more_rows_than_spark_takes_for_its_bins(spark):
    cands = [{"numTrees": 3, "maxDepth": 4, "minInstancesPerNode": 5}]
    df = _rows(spark, 40_000, 3)
    assert _close(_searched(df, "forest", cands), _fitted(tr.assemble(df, FEATS).persist(), "forest", cands))


def test_a_larger_minimum_regrows_only_below_forbidden_splits():
    tree = tg.Tree()
    tree.take((np.array([0]), np.array([3]), np.array([1.0]), [(10, 5.0, 9.0)], [(7, 1.0, 5.0)], [(3, 4.0, 9.0)]), 3)
    tree.take((np.array([1, 1]), np.array([0, 0]), np.array([0.5, 0.5]), [(7, 1.0, 5.0), (3, 4.0, 9.0)], [(6, 1.0, 5.0), (2, 1.0, 4.0)],
               [(1, 0.0, 0.0), (1, 3.0, 9.0)]), 3)
    same = tree.allowing(1)
    assert not same.open and same.feature == tree.feature and same.left == tree.left
    some = tree.allowing(2)
    assert [some.level[i] for i in some.open] == [1, 1] and some.feature == [0, -1, -1]
    assert tree.allowing(4).open == [0]


def test_thresholds_as_spark_sets_them():
    assert tg.thresholds(np.zeros(9), 9, 4).tolist() == []
    assert tg.thresholds(np.array([1.0, 2.0, 2.0, 4.0]), 4, 32).tolist() == [1.5, 3.0]
    assert tg.thresholds(np.array([-1.0, 3.0, 0.0]), 3, 32).tolist() == [-0.5, 1.5]
    assert tg.thresholds(np.arange(1.0, 101.0), 100, 4).tolist() == [25.5, 50.5, 75.5]


def test_refused_values_are_refused(spark):
    df = spark.createDataFrame([(1.0, None, 1), (2.0, 1.0, 1)], "a double, target double, fold int")
    with pytest.raises(ValueError, match="target"):
        tg.sizes(df, ["a"], "target")
    with pytest.raises(ValueError, match="minInfoGain"):
        tr.cross_validate(df, ["a"], "gbt", [{"minInfoGain": 0.5}], [(F.col("fold") == 1, F.col("fold") == 1)])
