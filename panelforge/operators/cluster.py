"""Clustering of entities.

A7 entity_means            mean of each score per entity (one groupBy)
A8 cluster_profiles        mean of each feature per cluster + member count
K1 kmeans                  50 restarts of k-means++ in shared passes (operators/kmeans.py), lowest cost
                           kept; relabelled 1..k by descending first-feature centroid and assigned by
                           nearest-centre column expressions (K7)
K2 silhouette_sqeuclidean  exact mean silhouette for SQUARED Euclidean distance,
                           from per-cluster sums (no point pairs).  The Euclidean
                           silhouette of the reference needs all n^2 point pairs and
                           is deliberately not built (see README).
K3 davies_bouldin          centroid pass + distance pass, k x k on the driver
K4 calinski_harabasz       per-cluster moments
K8 k_candidates            K1-K4 for k = 2..5, all restarts of all k in the same passes
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelforge.operators.kmeans import best_runs


def entity_means(df: DataFrame, cols: list[str], *, entity: str = "entity") -> DataFrame:
    """A7."""
    return df.groupBy(entity).agg(*[F.avg(c).alias(c) for c in cols])


def cluster_profiles(df: DataFrame, cols: list[str], *, label: str = "cluster") -> DataFrame:
    """A8."""
    return df.groupBy(label).agg(*[F.avg(c).alias(c) for c in cols], F.count(F.lit(1)).cast("long").alias("n_members"))


# ---------------------------------------------------------------- nearest-centre assignment

def _sqdist(cols: list[str], centre) -> Column:
    e = F.lit(0.0)
    for c, m in zip(cols, centre):
        d = F.col(c).cast("double") - F.lit(float(m))
        e = e + d * d
    return e


def nearest_label(cols: list[str], centres: np.ndarray, labels: list[int]) -> Column:
    """Label of the nearest centre (first on ties), as a pure column expression."""
    d = F.array(*[_sqdist(cols, c) for c in centres])
    return F.element_at(F.array(*[F.lit(v) for v in labels]), F.array_position(d, F.array_min(d)).cast("int")).cast("int")


@dataclass
class KMeansResult:
    cols: list[str]
    centres: np.ndarray     # (k, p) ordered by label 1..k
    cost: float
    restart: int

    def label_col(self) -> Column:
        return nearest_label(self.cols, self.centres, list(range(1, len(self.centres) + 1)))

    def transform(self, df: DataFrame, out: str = "kmeans_cluster") -> DataFrame:
        return df.withColumn(out, self.label_col())


def _ordered(cols: list[str], found: tuple[np.ndarray, float, int]) -> KMeansResult:
    centres, cost, restart = found
    order = np.lexsort(tuple(-centres[:, j] for j in reversed(range(centres.shape[1]))))
    return KMeansResult(list(cols), centres[order], cost, restart)


def kmeans(df: DataFrame, cols: list[str], k: int = 3, *, key: str | None = None, **settings) -> KMeansResult:
    """K1: k-means++ with 50 restarts, lowest cost kept.  A NULL or NaN in ``cols`` is an error, never a
    row silently left out: impute or drop such rows first."""
    return _ordered(cols, best_runs(df, cols, [k], key=key, **settings)[k])


# ---------------------------------------------------------------- quality indices

def cluster_metrics(df: DataFrame, cols: list[str], *, label: str = "cluster") -> dict:
    """K2 (squared Euclidean), K3, K4 and inertia in two passes over the labelled points."""
    data = df.dropna(subset=[*cols, label])
    sq = sum((F.col(c).cast("double") * F.col(c).cast("double") for c in cols), F.lit(0.0))
    rows = data.groupBy(label).agg(F.count(F.lit(1)).alias("n"), *[F.avg(c).alias(f"m{i}") for i, c in enumerate(cols)],
                                   F.avg(sq).alias("q")).collect()
    rows = sorted(rows, key=lambda r: r[label])
    labels = [r[label] for r in rows]
    k = len(labels)
    n_c = np.array([r["n"] for r in rows], dtype=float)
    mu = np.array([[r[f"m{i}"] for i in range(len(cols))] for r in rows], dtype=float)
    q = np.array([r["q"] for r in rows], dtype=float)
    n = n_c.sum()
    # mean squared distance to the members of cluster c = ||x - mu_c||^2 + (q_c - ||mu_c||^2)
    spread = F.array(*[F.lit(float(q[i] - mu[i] @ mu[i])) for i in range(k)])
    sizes = F.array(*[F.lit(float(v)) for v in n_c])
    # per point: its squared distance to every centre, computed once
    at = F.array_position(F.array(*[F.lit(v) for v in labels]), F.col(label)).cast("int")
    points = data.select(F.col(label), at.alias("_i"), F.array(*[_sqdist(cols, m) for m in mu]).alias("_d"))
    own, size = F.element_at("_d", F.col("_i")), F.element_at(sizes, F.col("_i"))
    a = (own + F.element_at(spread, F.col("_i"))) * size / F.greatest(size - 1, F.lit(1.0))
    b = F.array_min(F.transform("_d", lambda d, j: F.when(j + 1 != F.col("_i"), d + F.element_at(spread, j + 1))))
    s = F.when(size > 1, (b - a) / F.greatest(a, b)).otherwise(F.lit(0.0))
    agg = points.select(F.col(label), own.alias("_d2"), s.alias("_s")).groupBy(label).agg(
        F.sum("_d2").alias("w"), F.avg(F.sqrt(F.greatest(F.col("_d2"), F.lit(0.0)))).alias("spread"),
        F.sum("_s").alias("s")).collect()
    by = {r[label]: r for r in agg}
    inertia = float(sum(by[lab]["w"] for lab in labels))
    sil = float(sum(by[lab]["s"] for lab in labels) / n) if k > 1 else float("nan")
    S = np.array([by[lab]["spread"] for lab in labels])
    db_terms = []
    for i in range(k):
        ratios = [(S[i] + S[j]) / np.linalg.norm(mu[i] - mu[j]) for j in range(k) if j != i]
        db_terms.append(max(ratios) if ratios else 0.0)
    db = float(np.mean(db_terms)) if k > 1 else float("nan")
    grand = (n_c[:, None] * mu).sum(0) / n
    between = float((n_c * ((mu - grand) ** 2).sum(1)).sum())
    ch = (between / (k - 1)) / (inertia / (n - k)) if k > 1 and n > k and inertia > 0 else float("nan")
    return {"n": int(n), "k": k, "inertia": inertia, "silhouette_sqeuclidean": sil, "davies_bouldin": db,
            "calinski_harabasz": float(ch)}


def metrics_frame(spark: SparkSession, metrics: dict) -> DataFrame:
    cols = ["n", "k", "inertia", "silhouette_sqeuclidean", "davies_bouldin", "calinski_harabasz"]
    return spark.createDataFrame([tuple(metrics[c] for c in cols)],
                                 "n long, k int, inertia double, silhouette_sqeuclidean double, "
                                 "davies_bouldin double, calinski_harabasz double")


# ---------------------------------------------------------------- number of clusters

def k_candidates(df: DataFrame, cols: list[str], ks=(2, 3, 4, 5), *, key: str | None = None, **settings) -> DataFrame:
    """K8: K1-K4 for each candidate k; all restarts of all k share their passes.  A NULL or NaN in ``cols`` is an error."""
    spark = df.sparkSession
    data = df.select(*dict.fromkeys([*cols, *([key] if key else [])])).checkpoint(eager=True)
    rows = []
    for k, found in sorted(best_runs(data, cols, ks, key=key, **settings).items()):
        met = cluster_metrics(_ordered(cols, found).transform(data, "cluster"), cols, label="cluster")
        rows.append((k, met["inertia"], met["silhouette_sqeuclidean"], met["davies_bouldin"], met["calinski_harabasz"]))
    return spark.createDataFrame(rows, "k int, inertia double, silhouette_sqeuclidean double, davies_bouldin double, "
                                       "calinski_harabasz double")
