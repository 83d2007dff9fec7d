"""L0: sufficient statistics of a linear model, per group, in one pass.

For columns z = (x_1..x_p, y) and each group g the job returns n_g, the means
and the centered co-moment matrix C_g = sum (z - mean)(z - mean)^T.  Groups
merge exactly on the driver (parallel formula), so a fold's training set, a
walk-forward window or the whole table is a merge of per-group moments: one
Spark pass feeds every fit of a cross-validation.

Narrow designs (q <= ``EXPR_LIMIT`` columns) use Spark's numerically stable
``covar_pop`` aggregates.  Wide designs (many dummies) use two passes: group
means, then ``mapInPandas`` partial sums of mean-centered products per
partition, reduced by a ``groupBy(group, i, j).sum`` on the executors; only
groups x q^2 numbers reach the driver.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelforge.session import ship_package

EXPR_LIMIT = 6  # above this, hundreds of covar aggregates overwhelm whole-stage codegen


@dataclass
class Moments:
    n: float
    mean: np.ndarray          # (q,)
    C: np.ndarray             # (q, q) centered co-moment sums

    @staticmethod
    def empty(q: int) -> "Moments":
        return Moments(0.0, np.zeros(q), np.zeros((q, q)))

    def merge(self, other: "Moments") -> "Moments":
        if self.n == 0:
            return other
        if other.n == 0:
            return self
        n = self.n + other.n
        d = other.mean - self.mean
        mean = self.mean + d * (other.n / n)
        C = self.C + other.C + np.outer(d, d) * (self.n * other.n / n)
        return Moments(n, mean, C)

    # views for a design whose LAST column is the label
    @property
    def Cxx(self) -> np.ndarray:
        return self.C[:-1, :-1]

    @property
    def Cxy(self) -> np.ndarray:
        return self.C[:-1, -1]

    @property
    def Cyy(self) -> float:
        return float(self.C[-1, -1])

    @property
    def xbar(self) -> np.ndarray:
        return self.mean[:-1]

    @property
    def ybar(self) -> float:
        return float(self.mean[-1])


def merge_all(parts) -> Moments:
    parts = list(parts)
    out = Moments.empty(len(parts[0].mean)) if parts else None
    for p in parts:
        out = out.merge(p)
    return out


def moments(df: DataFrame, cols: list[str], group_cols: list[str] | None = None,
            *, complete_cases: bool = True) -> dict[tuple, Moments]:
    """Per-group moments of ``cols`` (rows with a NULL in ``cols`` are dropped first)."""
    g = list(group_cols or [])
    src = df.dropna(subset=cols) if complete_cases else df
    src = src.select(*g, *[F.col(c).cast("double").alias(f"z{i}") for i, c in enumerate(cols)])
    q = len(cols)
    if q <= EXPR_LIMIT:
        return _moments_expr(src, q, g)
    return _moments_wide(src, q, g)


def _key(row, g) -> tuple:
    return tuple(row[k] for k in g)


def _jkey(values) -> str:
    return json.dumps([v.item() if hasattr(v, "item") else v for v in values], default=str)


def _moments_expr(src: DataFrame, q: int, g: list[str]) -> dict[tuple, Moments]:
    aggs = [F.count(F.lit(1)).alias("_n")] + [F.avg(f"z{i}").alias(f"m{i}") for i in range(q)]
    aggs += [F.covar_pop(f"z{i}", f"z{j}").alias(f"c{i}_{j}") for i in range(q) for j in range(i, q)]
    rows = (src.groupBy(*g).agg(*aggs) if g else src.agg(*aggs)).collect()
    out = {}
    for r in rows:
        n = float(r["_n"])
        if n == 0:
            continue
        mean = np.array([r[f"m{i}"] for i in range(q)], dtype=float)
        C = np.zeros((q, q))
        for i in range(q):
            for j in range(i, q):
                C[i, j] = C[j, i] = (r[f"c{i}_{j}"] or 0.0) * n
        out[_key(r, g)] = Moments(n, mean, C)
    return out


def _moments_wide(src: DataFrame, q: int, g: list[str]) -> dict[tuple, Moments]:
    first = (src.groupBy(*g) if g else src.groupBy()).agg(
        F.count(F.lit(1)).alias("_n"), *[F.avg(f"z{i}").alias(f"m{i}") for i in range(q)]).collect()
    means = {_jkey(_key(r, g)): [r[f"m{i}"] for i in range(q)] for r in first}
    counts = {_jkey(_key(r, g)): float(r["_n"]) for r in first}
    zc = [f"z{i}" for i in range(q)]
    iu, ju = np.triu_indices(q)

    def partial(batches):
        """One upper triangle per group of the partition, yielded once at its end."""
        sums: dict[str, np.ndarray] = {}
        for pdf in batches:
            for key, part in (pdf.groupby(g, dropna=False, sort=False) if g else [((), pdf)]):
                name = _jkey([None if v is None or v != v else v for v in key])
                Z = part[zc].to_numpy(dtype=float) - np.asarray(means[name])
                sums[name] = sums.get(name, 0.0) + (Z.T @ Z)[iu, ju]
        for name, v in sums.items():
            yield pd.DataFrame({"gkey": name, "i": iu.astype("int32"), "j": ju.astype("int32"), "v": v})

    ship_package(src.sparkSession)
    sums = (src.mapInPandas(partial, "gkey string, i int, j int, v double")
            .groupBy("gkey", "i", "j").agg(F.sum("v").alias("v")).collect())
    out: dict[tuple, Moments] = {}
    for key, mean in means.items():
        out[tuple(json.loads(key))] = Moments(counts[key], np.asarray(mean, dtype=float), np.zeros((q, q)))
    for r in sums:
        M = out[tuple(json.loads(r["gkey"]))].C
        M[r["i"], r["j"]] = M[r["j"], r["i"]] = r["v"]
    return out
