"""Design tables for the model stages: labelled panel -> train-only preprocessing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelforge.operators.cluster import entity_means
from panelforge.operators.panel import log_aum, standardize_panel
from panelforge.operators.pca import pca_fit
from panelforge.operators.preprocess import PreprocessModel, fit_preprocess
from panelforge.operators.splits import TEST_END, TRAIN_END, VAL_END, WALK_FORWARD_FOLDS, random_split
from panelforge.operators.validate import FitGuard
from panelforge.plans.frames import labelled
from panelforge.session import checkpoint_root
from panelforge.sources.panels import DENSE_FEATURES, SPARSE_FEATURES

FEATURES = {"dense": DENSE_FEATURES, "sparse": SPARSE_FEATURES}
MODEL_NUMERIC = {w: sorted("log_aum" if c == "aum" else c for c in [*f, "ret"]) for w, f in FEATURES.items()}
KEEP = ["entity", "period", "category", "target_month", "split", "target", "ret_raw"]


def with_log_size(df: DataFrame, numeric: list[str]) -> tuple[DataFrame, list[str]]:
    """P1 + P2 as every model takes them: raw size is replaced by its logarithm."""
    if "aum" not in numeric:
        return df, sorted(numeric)
    return log_aum(df), sorted("log_aum" if c == "aum" else c for c in numeric)


def design_from_labelled(lab: DataFrame, numeric: list[str], *, categorical: tuple[str, ...] = ("category",),
                         fit_splits=("train",), keep: list[str] | None = None, limit: int | None = None
                         ) -> tuple[DataFrame, list[str], PreprocessModel]:
    """Checkpoint the labelled frame once (the fit reads it several times), fit the
    preprocessor on ``fit_splits`` rows only and transform every row.  Every fit of the plans takes
    its rows from here, so the pass that stores them also holds the guard (V14): a fit row whose target
    month lies beyond ``limit`` (default: the end of the last fit split) stops the run."""
    checkpoint_root(lab.sparkSession)
    lab, numeric = with_log_size(lab, numeric)
    if limit is None:
        limit = max({"train": TRAIN_END, "val": VAL_END}.get(s, TEST_END) for s in fit_splits)
    guard = FitGuard(lab.withColumn("ret_raw", F.col("ret")), F.col("split").isin(*fit_splits), limit=limit)
    lab = guard.rows.checkpoint(eager=True)
    guard.check()
    model = fit_preprocess(lab.where(F.col("split").isin(*fit_splits)), sorted(numeric), list(categorical))
    keep = [c for c in (keep or KEEP) if c in lab.columns]
    renamed = {c: f"_k_{c}" for c in keep if c in categorical}
    src = lab
    for c, k in renamed.items():
        src = src.withColumn(k, F.col(c))
    design = model.transform(src, keep=[renamed.get(c, c) for c in keep])
    for c, k in renamed.items():
        design = design.withColumnRenamed(k, c)
    return design, model.output_columns(), model


def forecasting_design(spark: SparkSession, sf_dir: str, which: str = "dense",
                       fit_splits=("train",)) -> tuple[DataFrame, list[str], PreprocessModel]:
    """Numerics (features + current return, sorted) median-imputed and scaled, category one-hot;
    the preprocessor is fitted on ``fit_splits`` only."""
    return design_from_labelled(labelled(spark, sf_dir, which), [*FEATURES[which], "ret"], fit_splits=fit_splits)


def component_entity_means(panel: DataFrame, numeric: list[str], n_components: int = 11) -> tuple[DataFrame, list[str]]:
    """Entity means of all component scores, as the clustering takes them: components of the scaled training
    numerics (key-hash 80/20 split), scores of the whole panel's z-scores (missing -> 0)."""
    panel, numeric = with_log_size(panel, numeric)
    train = random_split(panel, ["entity", "period"]).where(F.col("split") == "train")
    scaled = fit_preprocess(train, numeric, []).transform(train)
    pca = pca_fit(scaled, numeric, min(n_components, len(numeric)))
    scores = pca.transform(standardize_panel(panel, numeric), keep=["entity"])
    names = [f"PC{i + 1}" for i in range(len(pca.eigenvalues))]
    return entity_means(scores, names), names


def walk_forward_keys(months: list[int]) -> list[tuple[list, list]]:
    """Fold definitions over target-month group keys (train <= limit, val in [start, end])."""
    out = []
    for limit, start, end in WALK_FORWARD_FOLDS:
        out.append(([(m,) for m in months if m <= limit], [(m,) for m in months if start <= m <= end]))
    return out
