"""Principal components.

D1 pca_fit             sample covariance (n-1) from L0 moments, p x p eigh on the driver;
                       loadings = eigenvector * sqrt(eigenvalue); each component's sign
                       makes its largest |entry| positive (stable across runs)
D2 explained_variance  eigenvalue, percent, cumulative percent
D3 pca_project         scores = (x - training mean) . W as column expressions; input
                       column order does not matter (features addressed by name)
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelforge.operators.gram import moments


@dataclass
class PCAModel:
    features: list[str]
    mean: np.ndarray
    components: np.ndarray      # (k, p) rows are unit eigenvectors
    eigenvalues: np.ndarray     # (k,)
    total_variance: float

    def score_columns(self, prefix: str = "PC") -> list:
        cols = []
        for i, w in enumerate(self.components):
            expr = F.lit(0.0)
            for f, mu, wj in zip(self.features, self.mean, w):
                expr = expr + (F.col(f).cast("double") - F.lit(float(mu))) * F.lit(float(wj))
            cols.append(expr.alias(f"{prefix}{i + 1}"))
        return cols

    def transform(self, df: DataFrame, keep: list[str] | None = None, prefix: str = "PC") -> DataFrame:
        """D3."""
        return df.select(*(keep or []), *self.score_columns(prefix))

    def loadings(self, spark: SparkSession) -> DataFrame:
        rows = [(f, f"PC{i + 1}", float(self.components[i, j] * np.sqrt(max(self.eigenvalues[i], 0.0))))
                for i in range(len(self.eigenvalues)) for j, f in enumerate(self.features)]
        return spark.createDataFrame(rows, "feature string, component string, loading double")

    def explained_variance(self, spark: SparkSession) -> DataFrame:
        """D2."""
        pct = self.eigenvalues / self.total_variance * 100 if self.total_variance > 0 else self.eigenvalues * 0
        cum = np.cumsum(pct)
        rows = [(f"PC{i + 1}", i + 1, float(self.eigenvalues[i]), float(pct[i]), float(cum[i]))
                for i in range(len(self.eigenvalues))]
        return spark.createDataFrame(rows, "component string, component_index int, eigenvalue double, "
                                           "variance_explained_pct double, cumulative_variance_pct double")


def pca_fit(df: DataFrame, features: list[str], k: int | None = None) -> PCAModel:
    """D1 on complete rows of ``features``."""
    feats = list(features)
    if feats != sorted(feats):
        raise ValueError("feature list must be sorted (contract of the design table)")
    m = moments(df, [*feats, feats[0]])[()]
    n = m.n
    cov = m.C[:-1, :-1] / (n - 1)
    vals, vecs = np.linalg.eigh(cov)
    order = np.argsort(vals)[::-1]
    vals, vecs = vals[order], vecs[:, order]
    k = min(k or len(feats), len(feats))
    comps = vecs[:, :k].T.copy()
    for i in range(k):
        j = int(np.argmax(np.abs(comps[i])))
        if comps[i, j] < 0:
            comps[i] = -comps[i]
    return PCAModel(feats, m.xbar.copy(), comps, vals[:k].copy(), float(np.trace(cov)))
