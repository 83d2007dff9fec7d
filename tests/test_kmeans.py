"""All restarts in one pass: against plain Lloyd, and the k-means++ draw against its probabilities."""
import inspect

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from panelforge.operators import cluster as cl
from panelforge.operators import kmeans as km


def points(spark, x, parts=3):
    pdf = pd.DataFrame(x, columns=[f"c{j}" for j in range(x.shape[1])])
    pdf["entity"] = range(len(pdf))
    return spark.createDataFrame(pdf).repartition(parts), list(pdf.columns[:-1])


def plain(x, centres, variance, tol=1e-4, max_iter=300):
    """One restart on its own."""
    c = centres.copy()
    for _ in range(max_iter):
        label = ((x[:, None] - c[None]) ** 2).sum(-1).argmin(1)
        new = np.array([x[label == i].mean(0) if (label == i).any() else c[i] for i in range(len(c))])
        moved, c = ((new - c) ** 2).sum(), new
        if moved <= tol * variance:
            break
    return c, ((x[:, None] - c[None]) ** 2).sum(-1).min(1).sum()


def test_all_runs_equal_runs_on_their_own(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(500, 4)) + rng.integers(0, 4, (500, 1)) * 1.5
    df, cols = points(spark, x)
    stored, means, variance = km.stored_points(df, cols, "entity")
    seeds = km.seeded(stored, 4, [2, 3, 5], 6, 42)
    got = km.best_runs(df, cols, [2, 3, 5], restarts=6, key="entity")
    for k in (2, 3, 5):
        runs = [plain(x - means, seeds[k][r], variance) for r in range(6)]
        best = min(range(6), key=lambda r: runs[r][1])
        assert abs(got[k][1] - runs[best][1]) < 1e-8 * runs[best][1]
        assert np.allclose(np.sort(got[k][0], 0), np.sort(runs[best][0] + means, 0))


def test_result_does_not_depend_on_the_layout(spark):
    x = np.random.default_rng(1).normal(size=(300, 3))
    a, cols = points(spark, x, 1)
    b, _ = points(spark, x, 7)
    one, two = (km.best_runs(d, cols, [4], restarts=5, key="entity")[4] for d in (a, b))
    assert np.allclose(one[0], two[0]) and one[2] == two[2]


def test_seeding_draws_by_squared_distance(spark):
    """Three points at 0, 1 and 3: after the first at 0, the others come with odds 1 to 9."""
    x = np.array([[0.0], [1.0], [3.0]])
    df, cols = points(spark, x, 2)
    stored, means, _ = km.stored_points(df, cols, "entity")
    pairs = (km.seeded(stored, 1, [2], 3000, 7)[2][:, :, 0] + means[0]).round().astype(int)
    assert np.abs(np.bincount(pairs[:, 0], minlength=4)[[0, 1, 3]] / 3000 - 1 / 3).max() < 0.04
    after = pairs[pairs[:, 0] == 0, 1]
    assert abs((after == 3).mean() - 0.9) < 0.04 and (after != 0).all()


def test_one_job_serves_every_run(spark):
    df, cols = points(spark, np.random.default_rng(2).normal(size=(200, 2)))
    stored, means, _ = km.stored_points(df, cols, "entity")
    calls, step = [], km.lloyd_step
    try:
        km.lloyd_step = lambda p, c: calls.append({k: len(v) for k, v in c.items()}) or step(p, c)
        km.best_runs(df, cols, [2, 3, 4, 5], restarts=50, key="entity")
    finally:
        km.lloyd_step = step
    assert calls[0] == {k: 50 for k in (2, 3, 4, 5)} and len(calls) < 60
    assert all(sum(a.values()) >= sum(b.values()) for a, b in zip(calls[:-1], calls[1:-1]))  # settled runs drop out


def test_defaults_missing_values_and_few_points(spark):
    assert inspect.signature(km.best_runs).parameters["restarts"].default == 50
    df, cols = points(spark, np.array([[0.0, 1.0], [0.0, 1.0], [2.0, 2.0]]))
    got = cl.kmeans(df, cols, 2, restarts=3)
    assert abs(got.cost) < 1e-12 and got.centres[0, 0] == 2.0
    assert cl.kmeans(df, cols, 5, restarts=2).cost < 1e-12  # more clusters than points
    for bad in (None, float("nan")):
        with pytest.raises(ValueError):
            cl.k_candidates(df.withColumn("c0", F.when(F.col("entity") == 1, F.lit(bad)).otherwise(F.col("c0"))), cols)
    with pytest.raises(ValueError):
        cl.kmeans(df.limit(0), cols, 2)


def test_k_candidates_indices(spark):
    rng = np.random.default_rng(5)
    x = np.r_[rng.normal(0, 0.2, (30, 2)), rng.normal(4, 0.2, (30, 2)), rng.normal((0, 6), 0.2, (30, 2))]
    df, cols = points(spark, x)
    rows = {r["k"]: r for r in cl.k_candidates(df, cols, restarts=10, key="entity").collect()}
    assert sorted(rows) == [2, 3, 4, 5]
    assert max(rows, key=lambda k: rows[k]["calinski_harabasz"]) == 3 and min(rows, key=lambda k: rows[k]["davies_bouldin"]) == 3
    assert all(rows[k]["inertia"] > rows[k + 1]["inertia"] for k in (2, 3, 4))
