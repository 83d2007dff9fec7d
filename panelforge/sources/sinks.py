"""Sinks (S4-S11).  Everything is Parquet written by the executors; tiny report
tables may additionally be written as a single CSV file."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelforge.sources.publish import new_version, publish


def sort_panel(df: DataFrame, keys: tuple[str, ...] = ("entity", "period")) -> DataFrame:
    """O1: key order within and across files (range partitions), without one task that sorts everything."""
    return df.repartitionByRange(*keys).sortWithinPartitions(*keys)


def sink_interim(df: DataFrame, path: str, *, keys: tuple[str, ...] = ("entity", "period")) -> str:
    """The cleaned panel in key order, as a new version; readers see it only when it is complete."""
    version = new_version()
    sort_panel(df, keys).write.parquet(f"{path.rstrip('/')}/{version}")
    publish(df.sparkSession, path, version)
    return version


def sink_processed(df: DataFrame, path: str, mode: str) -> None:
    """One design table per mode, partitioned by split (partition pruning on read)."""
    df.write.mode("overwrite").partitionBy("split").parquet(f"{path.rstrip('/')}/mode={mode}")


def sink_pca(spark: SparkSession, model, scores: DataFrame, path: str, mode: str) -> None:
    """Loadings, variance table, scores and the feature list, namespaced by mode.
    Keeps the reference's two guards: feature count and sorted feature names."""
    feats = list(model.features)
    if len(feats) != model.components.shape[1]:
        raise AssertionError("feature count mismatch with PCA model inputs")
    if feats != sorted(feats):
        raise AssertionError("feature list is not deterministically sorted")
    base = f"{path.rstrip('/')}/pca/mode={mode}"
    model.loadings(spark).write.mode("overwrite").parquet(f"{base}/loadings")
    model.explained_variance(spark).write.mode("overwrite").parquet(f"{base}/explained_variance")
    scores.write.mode("overwrite").parquet(f"{base}/scores")
    spark.createDataFrame([(i, f, float(m)) for i, (f, m) in enumerate(zip(feats, model.mean))],
                          "position int, feature string, mean double").write.mode("overwrite").parquet(f"{base}/features")


def sink_clusters(assignments: DataFrame, profiles: DataFrame, metrics: DataFrame, path: str, mode: str) -> None:
    """Namespaced by mode (the reference's cluster outputs collide between modes)."""
    base = f"{path.rstrip('/')}/clustering/mode={mode}"
    assignments.write.mode("overwrite").parquet(f"{base}/assignments")
    profiles.write.mode("overwrite").parquet(f"{base}/profiles")
    metrics.write.mode("overwrite").parquet(f"{base}/metrics")


def sink_comparison(df: DataFrame, path: str, *, csv: bool = True) -> None:
    """Model comparison (one row per model)."""
    df.write.mode("overwrite").parquet(f"{path.rstrip('/')}/parquet")
    if csv:
        df.coalesce(1).write.mode("overwrite").option("header", "true").csv(f"{path.rstrip('/')}/csv")


def sink_predictions(df: DataFrame, path: str, stage: str) -> None:
    """Predictions and residuals, partitioned by stage."""
    df.withColumn("stage", F.lit(stage)).write.mode("overwrite") \
        .option("partitionOverwriteMode", "dynamic").partitionBy("stage").parquet(path)


def sink_final_tables(tables: dict[str, DataFrame], path: str, *, private: tuple[str, ...] = ("error_rows",)) -> None:
    """Every final table as Parquet; row-level tables that carry entity names go to a
    separate ``private`` folder, public copies never include the entity column."""
    for name, df in tables.items():
        if name in private:
            df.write.mode("overwrite").parquet(f"{path.rstrip('/')}/private/{name}")
            df.drop("entity").write.mode("overwrite").parquet(f"{path.rstrip('/')}/public/{name}")
        else:
            df.write.mode("overwrite").parquet(f"{path.rstrip('/')}/public/{name}")
