"""K-means with all restarts of all k in one pass (K1, K8).

A run is one (k, restart). Every job serves all runs that are still moving:

* seeding is k-means++: the next centre of a run is a point drawn with probability in
  proportion to its squared distance from the run's centres so far. The draw is a weighted
  reservoir of size one: each point gets the key -ln(u) / weight, u from a hash of the point's
  key, the run and the step, and the smallest key wins; tasks send their best point per run.
* a Lloyd step adds up, per run and cluster, the number of members and the sums of their
  coordinates, and per run the cost. Tasks hold these sums, Spark adds them entry by entry, and
  only (runs x k x columns) numbers reach the driver, however many points there are.

Centres travel in the task's closure (the same size). A run ends when its centres' squared
movement is at most ``tol`` times the mean variance of the columns, as all restarts do on
their own; a cluster that loses all members keeps its centre.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelforge.session import checkpoint_root, ship_package

ROWS = 2048  # points a task compares with all centres at once


def stored_points(df: DataFrame, cols: list[str], key: str | None = None) -> tuple[DataFrame, np.ndarray, float]:
    """(_h, _x) once in the shared folder: a hash for the draws and the centred coordinates; with the means and the mean
    variance of the columns. A missing coordinate is an error, never a row silently left out.

    Without ``key`` the hash is that of the coordinates, so that equal points count once in a draw."""
    checkpoint_root(df.sparkSession)
    ship_package(df.sparkSession)
    xs = [F.col(c).cast("double") for c in cols]
    bad = F.lit(False)
    for x in xs:
        bad = bad | x.isNull() | F.isnan(x)
    stats = df.agg(F.sum(bad.cast("long")).alias("bad"), F.count(F.lit(1)).alias("n"), *[F.avg(x).alias(f"m{j}") for j, x in enumerate(xs)],
                   *[F.var_pop(x).alias(f"v{j}") for j, x in enumerate(xs)]).first()
    if not stats["n"]:
        raise ValueError("no points to cluster")
    if stats["bad"]:
        raise ValueError(f"{stats['bad']} rows have a missing value in the clustered columns")
    means = np.array([stats[f"m{j}"] for j in range(len(cols))], dtype=float)
    points = df.select((F.xxhash64(key) if key else F.xxhash64(*cols)).alias("_h"), F.array(*[x - F.lit(float(m)) for x, m in zip(xs, means)]).alias("_x"))
    return points.checkpoint(eager=True), means, float(np.mean([stats[f"v{j}"] for j in range(len(cols))]))


def _blocks(batches, p: int):
    for batch in batches:
        h = batch.column(0).to_numpy().astype(np.uint64)
        x = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, p)
        for at in range(0, len(x), ROWS):
            yield h[at:at + ROWS], x[at:at + ROWS]


def distances(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Squared distances (rows, runs, k) to centres (runs, k, p)."""
    flat = centres.reshape(-1, centres.shape[-1])
    d = (x * x).sum(1)[:, None] - 2.0 * (x @ flat.T) + (flat * flat).sum(1)[None]
    return np.maximum(d, 0.0).reshape(len(x), *centres.shape[:2])


def lloyd_step(points: DataFrame, centres: dict[int, np.ndarray]) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """One step of all runs: for each k, from centres (runs, k, p): members (runs, k), sums (runs, k, p), costs (runs)."""
    ks = sorted(k for k in centres if len(centres[k]))
    p = centres[ks[0]].shape[2]

    def run(batches):
        totals = {k: (np.zeros(len(centres[k]) * k), np.zeros((len(centres[k]) * k, p)), np.zeros(len(centres[k]))) for k in ks}
        for _, x in _blocks(batches, p):
            for k in ks:
                n, s, cost = totals[k]
                d = distances(x, centres[k])
                label = d.argmin(2)
                cost += np.take_along_axis(d, label[:, :, None], 2)[:, :, 0].sum(0)
                at = (label + np.arange(len(centres[k])) * k).ravel()
                n += np.bincount(at, minlength=len(n))
                for j in range(p):
                    s[:, j] += np.bincount(at, np.repeat(x[:, j], len(centres[k])), len(n))
        v = np.concatenate([part.ravel() for k in ks for part in totals[k]])
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(v), dtype=np.int32)), pa.array(v)], names=["i", "v"])

    size = sum(len(centres[k]) * (k * (p + 1) + 1) for k in ks)
    v = np.zeros(size)
    for i, value in points.mapInArrow(run, "i int, v double").groupBy("i").agg(F.sum("v").alias("v")).collect():
        v[i] = value
    out, at = {}, 0
    for k in ks:
        runs = len(centres[k])
        cuts = np.cumsum([at, runs * k, runs * k * p, runs])
        n, s, cost = (v[a:b] for a, b in zip(cuts, cuts[1:]))
        out[k], at = (n.reshape(runs, k), s.reshape(runs, k, p), cost), cuts[-1]
    return out


def _uniform(h: np.ndarray, salt: int) -> np.ndarray:
    """Numbers in (0, 1) from 64-bit keys (the finalizer of splitmix64)."""
    z = h + np.uint64((salt * 0x9E3779B97F4A7C15) & ((1 << 64) - 1))
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return ((z ^ (z >> np.uint64(31))) >> np.uint64(11)).astype(np.float64) / (1 << 53) + 2.0 ** -54


def seeded(points: DataFrame, p: int, ks: list[int], restarts: int, seed: int) -> dict[int, np.ndarray]:
    """k-means++ centres (restarts, k, p) of every k, one job for each centre."""
    chosen = {k: np.zeros((restarts, 0, p)) for k in ks}
    for step in range(max(ks)):
        open_ks = [k for k in ks if k > step]

        def run(batches, open_ks=open_ks, step=step):
            best = {(k, r): (np.inf, None) for k in open_ks for r in range(restarts)}
            for h, x in _blocks(batches, p):
                for k in open_ks:
                    w = distances(x, chosen[k]).min(2) if step else np.ones((len(x), restarts))
                    u = np.stack([_uniform(h, ((seed * 1009 + k) * 1009 + r) * 1009 + step) for r in range(restarts)], 1)
                    race = -np.log(u) / np.maximum(w, 1e-300)
                    first = race.argmin(0)
                    for r, i in enumerate(first.tolist()):
                        if race[i, r] < best[k, r][0] or best[k, r][1] is None:
                            best[k, r] = (race[i, r], x[i])
            rows = [(k, r, key, x) for (k, r), (key, x) in best.items() if x is not None]
            yield pa.RecordBatch.from_arrays(
                [pa.array([t[0] for t in rows], pa.int32()), pa.array([t[1] for t in rows], pa.int32()), pa.array([float(t[2]) for t in rows], pa.float64()),
                 pa.array([t[3].tolist() for t in rows], pa.list_(pa.float64()))], names=["k", "r", "key", "x"])

        won = points.mapInArrow(run, "k int, r int, key double, x array<double>").groupBy("k", "r").agg(F.min_by("x", "key").alias("x")).collect()
        fresh = {k: np.zeros((restarts, 1, p)) for k in open_ks}
        for row in won:
            fresh[row["k"]][row["r"], 0] = row["x"]
        for k in open_ks:
            chosen[k] = np.concatenate([chosen[k], fresh[k]], 1)
    return chosen


def best_runs(df: DataFrame, cols: list[str], ks, *, restarts: int = 50, seed: int = 42, max_iter: int = 300, tol: float = 1e-4,
              key: str | None = None) -> dict[int, tuple[np.ndarray, float, int]]:
    """For each k the centres, cost and number of the restart with the lowest cost."""
    points, means, variance = stored_points(df, cols, key)
    ks = sorted(set(ks))
    centres = seeded(points, len(cols), ks, restarts, seed)
    moving = {k: np.arange(restarts) for k in ks}
    for _ in range(max_iter):
        found = lloyd_step(points, {k: centres[k][moving[k]] for k in ks if len(moving[k])})
        for k, (n, s, _) in found.items():
            old = centres[k][moving[k]]
            new = np.where(n[:, :, None] > 0, s / np.maximum(n, 1)[:, :, None], old)
            centres[k][moving[k]] = new
            moving[k] = moving[k][((new - old) ** 2).sum((1, 2)) > tol * variance]
        if not any(len(m) for m in moving.values()):
            break
    out = {}
    for k, (_, _, cost) in lloyd_step(points, centres).items():
        r = int(cost.argmin())
        out[k] = (centres[k][r] + means, float(cost[r]), r)
    return out
