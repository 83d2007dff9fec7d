"""Whitening of embeddings by a distributed Jacobi-Davidson eigensolver.

The covariance matrix V of the distinct vectors is never formed. Every product V B of a
block of vectors is one Spark job over the stored fit list: tasks add up c (c . B) over
their centred rows c, and the partial blocks are summed entry by entry on the executors,
so that d x k numbers reach the driver, however many rows there are. Centring comes first:
c = (n*x - S) / n with an exact integer numerator, relative to a whole number near the mean.

The solver keeps a search space and its products. Rayleigh-Ritz gives the wanted pairs;
pairs whose residual |V u - t u| is at double precision (RESIDUAL of the largest value) are
locked. For the others the projected correction equation

    (I - Z Z') (V - t I) (I - Z Z') s = -r,   Z = locked and current vectors

is solved by a few steps of MINRES, all of them in lockstep, one distributed product a step,
and s enters the search space. A full space restarts from its best vectors. It ends when all
wanted pairs are locked.

Defined results: rows whose vector is null or empty, or holds null, non-finite or out of
range entries (2^40 and beyond) are left out. Vectors of other lengths than the most common
one (of equally common ones the longest) are left out too. Components with no variance
(a value of at most 1e-12 of the trace) can't be whitened and give no rows; so do an empty
table, a single distinct vector and equal vectors. Repeated rows and null ids give rows each.
A deviation that doesn't fit a long is null. Extra columns are ignored whatever their names.
"""

from __future__ import annotations

from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelforge.llm.common import materialize, pick, ship, slices

SCALE, ZERO = 64, 1_000_000
RESIDUAL = 64 * np.finfo(float).eps
INNER = 4  # MINRES steps of a correction
OUTER = 200
NO_VARIANCE = 1e-12


def scaled_rows(vectors: DataFrame) -> DataFrame:
    """(id, vec) -> id, x: whole-number vectors of the rows that remain, all of one length."""
    c = F.transform("vec", lambda e: e.cast("double"))
    fine = F.forall(c, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < float(1 << 40)))
    kept = vectors.where(F.col("vec").isNotNull() & (F.size("vec") > 0)).where(fine)
    kept = kept.select("id", F.transform("vec", lambda e: F.floor(e.cast("double") * SCALE).cast("long") + ZERO).alias("x"))
    kept = materialize(kept, "scaled")
    length = kept.groupBy(F.size("x").alias("d")).count().orderBy(F.col("count").desc(), F.col("d").desc()).first()
    return kept.where(F.size("x") == (length["d"] if length else 0))


class FitList:
    """The distinct vectors in the shared folder, with n, S and products of their covariance."""

    def __init__(self, rows: DataFrame):
        ship(rows.sparkSession)
        self.df = materialize(rows.select("x").distinct(), "fit-list")
        first = self.df.first()
        self.d = len(first["x"]) if first else 0
        self.n, self.sums = self._totals() if first else (0, [])
        self.base = np.array([s // self.n for s in self.sums], dtype=np.int64)
        self.rest = np.array([s - self.n * (s // self.n) for s in self.sums], dtype=np.int64)
        self.passes = 0

    def _totals(self) -> tuple[int, list[int]]:
        d = self.d

        def run(batches):
            n, total = 0, [0] * d
            for batch in slices(batches):
                x = matrix(batch.column(0), d)
                n += len(x)
                total = [t + s for t, s in zip(total, x.sum(0).tolist())]
            yield pa.RecordBatch.from_arrays([pa.array(range(d + 1), pa.int32()), pa.array([Decimal(t) for t in [*total, n]], pa.decimal128(38, 0))],
                                             names=["i", "v"])

        got = dict(self.df.mapInArrow(run, "i int, v decimal(38,0)").groupBy("i").agg(F.sum("v").alias("v")).collect())
        return int(got[d]), [int(got[i]) for i in range(d)]

    def centre(self):
        """A function from rows x to (n*x - S) / n, to be sent to tasks."""
        n, base, rest = self.n, self.base, self.rest
        return lambda x: ((x - base).astype(np.float64) * n - rest) / n

    def summed(self, of, size: int) -> np.ndarray:
        """Sum over the list of of(centred rows), an array of `size` numbers; partial sums are added on the executors."""
        d, centre = self.d, self.centre()

        def run(batches):
            total = np.zeros(size)
            for batch in slices(batches):
                total += of(centre(matrix(batch.column(0), d))).ravel()
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(size, dtype=np.int32)), pa.array(total)], names=["i", "v"])

        self.passes += 1
        out = np.zeros(size)
        for i, v in self.df.mapInArrow(run, "i int, v double").groupBy("i").agg(F.sum("v").alias("v")).collect():
            out[i] = v
        return out

    def product(self, block: np.ndarray) -> np.ndarray:
        """V block."""
        return self.summed(lambda c: c.T @ (c @ block), block.size).reshape(block.shape) / self.n

    def trace(self) -> float:
        return float(self.summed(lambda c: np.array([(c * c).sum()]), 1)[0]) / self.n


def matrix(column: pa.Array, d: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, d)


def orthonormal(block: np.ndarray, *against: np.ndarray) -> np.ndarray:
    """The part of block that is orthogonal to the given orthonormal columns, as orthonormal columns; dependent ones go."""
    kept: list[np.ndarray] = []
    for v in block.T:
        size = np.linalg.norm(v)
        if not size > 0:
            continue
        v = v / size
        for _ in range(3):
            for q in against:
                v = v - q @ (q.T @ v)
            for q in kept:
                v = v - q * (q @ v)
        left = np.linalg.norm(v)
        if left > 1e-10:
            v = v / left
            for q in [*against, *(k[:, None] for k in kept)]:
                v = v - q @ (q.T @ v)
            kept.append(v / np.linalg.norm(v))
    return np.array(kept).T if kept else np.zeros((block.shape[0], 0))


def minres(product, z: np.ndarray, theta: np.ndarray, rhs: np.ndarray, steps: int) -> np.ndarray:
    """Steps of MINRES on (I - zz')(V - theta_j I)(I - zz') s_j = rhs_j for all columns j in lockstep."""
    def outside(b):
        b = b - z @ (z.T @ b)
        return b - z @ (z.T @ b)

    def safe(a):
        return np.where(np.abs(a) > 1e-300, a, 1.0)

    r = outside(rhs)
    beta = np.linalg.norm(r, axis=0)
    live = beta > 0
    v_old, v = np.zeros_like(r), r / safe(beta)
    w_old, w = np.zeros_like(r), np.zeros_like(r)
    s, eta = np.zeros_like(r), beta.copy()
    c_old = c = np.ones(r.shape[1])
    sn_old = sn = np.zeros(r.shape[1])
    beta_v = np.zeros(r.shape[1])  # couples v with the vector before it
    for _ in range(steps):
        if not live.any():
            break
        p = outside(product(v) - v * theta)
        alpha = (v * p).sum(0)
        p = p - v * alpha - v_old * beta_v
        beta_new = np.linalg.norm(p, axis=0)
        delta = c * alpha - c_old * sn * beta_v
        rho1 = np.hypot(delta, beta_new)
        rho2 = sn * alpha + c_old * c * beta_v
        rho3 = sn_old * beta_v
        live &= rho1 > 1e-300
        c_old, sn_old = c, sn
        c, sn = delta / safe(rho1), beta_new / safe(rho1)
        w_old, w = w, (v - w_old * rho3 - w * rho2) / safe(rho1)
        s = s + np.where(live, w * (c * eta), 0.0)
        eta = -sn * eta
        v_old, v, beta_v = v, p / safe(beta_new), beta_new
        live &= beta_new > 1e-300
    return s


def settled_first(theta: np.ndarray, u: np.ndarray, au: np.ndarray, equal: float) -> tuple[np.ndarray, np.ndarray]:
    """Turn vectors of equal values among themselves so that those with the smallest residuals come first."""
    edges = [0, *(np.flatnonzero(-np.diff(theta) > equal) + 1).tolist(), len(theta)]
    for a, b in zip(edges, edges[1:]):
        if b - a > 1:
            turn = np.linalg.svd(au[:, a:b] - u[:, a:b] * theta[a:b], full_matrices=False)[2][::-1].T
            u[:, a:b], au[:, a:b] = u[:, a:b] @ turn, au[:, a:b] @ turn
    return u, au


def jacobi_davidson(product, d: int, wanted: int, seed: int = 7, inner: int = INNER) -> tuple[np.ndarray, np.ndarray, float]:
    """The `wanted` largest eigenpairs of a symmetric positive operator given by its block products.

    Returns values (falling), unit vectors as columns, and the largest residual relative to the largest value."""
    wanted = min(wanted, d)
    most = min(d, max(4 * wanted, wanted + 8))  # columns of the search space
    locked, values = np.zeros((d, 0)), []
    space = orthonormal(np.random.default_rng(seed).standard_normal((d, wanted)))
    image = product(space)
    top = worst = 0.0
    stuck = 0
    for _ in range(OUTER):
        h = space.T @ image
        theta, y = np.linalg.eigh((h + h.T) / 2)
        order = np.argsort(-theta)
        theta, u, au = theta[order], space @ y[:, order], image @ y[:, order]
        top = max(top, theta[0], *values[:1])
        if top <= 0:
            return np.zeros(0), np.zeros((d, 0)), 0.0
        u, au = settled_first(theta, u, au, 32 * np.finfo(float).eps * top)
        theta = (u * au).sum(0)
        k = min(wanted - len(values), u.shape[1])
        r = au[:, :k] - u[:, :k] * theta[:k]
        r = r - locked @ (locked.T @ r)
        size = np.linalg.norm(r, axis=0) / top
        whole = len(values) + space.shape[1] == d
        done = 0
        while done < k and size[done] <= RESIDUAL:  # lock in order, largest first
            done += 1
        if done:
            worst = max(worst, size[:done].max())
            locked = np.hstack([locked, u[:, :done]])
            values += theta[:done].tolist()
            if len(values) == wanted:
                break
        space, image = u[:, done:], au[:, done:]
        theta, r = theta[done:], r[:, done:]
        k = min(wanted - len(values), space.shape[1])
        if whole:  # nothing can be added: products anew from orthonormal vectors
            stuck += 1
            if stuck > 5:
                raise ArithmeticError(f"residuals stay at {size.max():.1e}")
            space = orthonormal(space, locked)
            image = product(space)
            continue
        if space.shape[1] + k > most - len(values) and space.shape[1] > 2 * k:
            space, image = space[:, :2 * k], image[:, :2 * k]
        z = np.hstack([locked, space[:, :k]])
        correction = minres(product, z, theta[:k], -r[:, :k], inner) if k else np.zeros((d, 0))
        fresh = orthonormal(correction, locked, space)
        if fresh.shape[1] < max(k, 1):  # also open the space where corrections vanish
            more = np.random.default_rng(seed + len(values) + space.shape[1]).standard_normal((d, max(k, 1) - fresh.shape[1]))
            fresh = np.hstack([fresh, orthonormal(more, locked, space, fresh)])
        fresh = fresh[:, :d - len(values) - space.shape[1]]
        space, image = np.hstack([space, fresh]), np.hstack([image, product(fresh)])
    else:
        raise ArithmeticError("Jacobi-Davidson did not converge")
    order = np.argsort(-np.array(values), kind="stable")
    q = locked[:, order]
    q = q * np.sign(q[np.abs(q).argmax(0), np.arange(q.shape[1])])
    return np.array(values)[order], q, float(worst)


def whiten(vectors: DataFrame, components: int = 16, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """One row per remaining row and component: id, component, n, deviation, whitened, explained, identity_error, residual."""
    src = pick(vectors, id=id_col, vec=vec_col)
    rows = scaled_rows(src)
    fit = FitList(rows)
    kind = src.schema["id"].dataType.simpleString()
    schema = f"id {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double, residual double"
    trace = fit.trace() if fit.n > 1 else 0.0
    e, q, residual = jacobi_davidson(fit.product, fit.d, components) if trace > 0 else (np.zeros(0), np.zeros((fit.d, 0)), 0.0)
    live = e > NO_VARIANCE * trace
    e, q = e[live], q[:, live]
    k = len(e)
    if not k:
        return vectors.sparkSession.createDataFrame([], schema).withColumnRenamed("id", id_col)
    w = q / np.sqrt(e)
    got = fit.summed(lambda c: np.vstack([(c @ w).T @ (c @ w), (c @ w).sum(0)]), (k + 1) * k).reshape(k + 1, k) / fit.n
    error = float(np.abs(got[:k] - np.outer(got[k], got[k]) - np.eye(k)).max())
    n, d, base, rest, centre, share = fit.n, fit.d, fit.base, fit.rest, fit.centre(), e / trace

    def run(batches):
        for batch in slices(batches):
            x = matrix(batch.column(1), d)
            m = len(x)
            near = ((x - base).astype(np.float64) * n - rest)
            if m and np.abs(near).max() < 2.0 ** 62 and (near * near).sum(1).max() < 2.0 ** 62:
                dev = ((x - base) * n - rest)
                deviation = (dev * dev).sum(1).tolist()
            else:  # exact beyond 64 bits
                deviation = [sum((int(a) * n - int(b)) ** 2 for a, b in zip(row, rest)) for row in (x - base)]
                deviation = [v if v < 1 << 63 else None for v in deviation]
            which = pa.array(np.repeat(np.arange(m), k))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(which), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)), pa.array(np.full(m * k, n)),
                 pa.array(deviation, pa.int64()).take(which), pa.array((centre(x) @ w).ravel()), pa.array(np.tile(share, m)),
                 pa.array(np.full(m * k, error)), pa.array(np.full(m * k, residual))],
                names=["id", "component", "n", "deviation", "whitened", "explained", "identity_error", "residual"])

    return rows.mapInArrow(run, schema).withColumnRenamed("id", id_col)
