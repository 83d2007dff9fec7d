"""Baselines, joins by key, metrics and evaluation tables.

U2  long_predictions      wide prediction columns -> (keys, actual, model, pred) rows
M1  model_metrics         MAE, RMSE, R^2, MAPE per model (and any grouping) in one aggregate
M2-M6 add_baselines       zero, persistence, entity mean, category mean, development mean
J1/J2 map_group_mean      left join of group means + fallback
J4/J5 seen_flag           one left join against distinct training entities
J6  align_by_key          inner join on the panel key
M7  comparison_table      metrics + mean prediction / actual + P9 + O3 rank
M8  monthly_metrics       per target month, models pivoted with an explicit list
M9  error_table / O4 top_errors
M10 error_percentiles     exact linear-interpolation percentiles of |error|
M11 category_errors
M12 seen_unseen_metrics   zero-filled rows for an empty group
P8  residuals, P10 beats_baseline, P11 train_val_gap
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelforge.functions.metrics import regression_metric_columns
from panelforge.functions.safe import safe_div

# Model names of the comparison tables.
ZERO, PERSISTENCE, CATEGORY_MEAN, ENTITY_MEAN, DEV_MEAN = (
    "zero_return", "persistence", "category_mean", "entity_mean", "development_mean")


def fit_mean(df: DataFrame, col: str) -> float | None:
    """L7 / M6 fit: the mean of the fit rows (a one-number model)."""
    return df.agg(F.avg(col).alias("m")).first()["m"]


def group_means(df: DataFrame, key: str, target: str, out: str) -> DataFrame:
    return df.where(F.col(key).isNotNull()).groupBy(key).agg(F.avg(target).alias(out))


def map_group_mean(rows: DataFrame, means: DataFrame, key: str, out: str, fallback: float | None) -> DataFrame:
    """Attach each row's group mean; rows of an unseen group get ``fallback``.
    Spark picks the join from the sizes that it measures at run time."""
    joined = rows.join(means, key, "left")
    return joined.withColumn(out, F.coalesce(F.col(out), F.lit(fallback).cast("double")))


def add_baselines(rows: DataFrame, fit_rows: DataFrame, *, entity: str = "entity",
                  category: str = "category", target: str = "target", current: str = "ret",
                  models: tuple[str, ...] = (ZERO, PERSISTENCE, CATEGORY_MEAN, DEV_MEAN)) -> DataFrame:
    """M2-M6 as prediction columns ``pred_<model>`` on ``rows``; means are fitted on ``fit_rows``."""
    dev_mean = fit_mean(fit_rows, target)
    out = rows
    if ZERO in models:
        out = out.withColumn(f"pred_{ZERO}", F.lit(0.0))
    if PERSISTENCE in models:
        out = out.withColumn(f"pred_{PERSISTENCE}", F.col(current).cast("double"))
    if CATEGORY_MEAN in models:
        out = map_group_mean(out, group_means(fit_rows, category, target, f"pred_{CATEGORY_MEAN}"),
                             category, f"pred_{CATEGORY_MEAN}", dev_mean)
    if ENTITY_MEAN in models:
        out = map_group_mean(out, group_means(fit_rows, entity, target, f"pred_{ENTITY_MEAN}"),
                             entity, f"pred_{ENTITY_MEAN}", dev_mean)
    if DEV_MEAN in models:
        out = out.withColumn(f"pred_{DEV_MEAN}", F.lit(dev_mean).cast("double"))
    return out


def long_predictions(df: DataFrame, ids: list[str], *, actual: str = "target",
                     prefix: str = "pred_") -> DataFrame:
    """Every ``pred_<model>`` column becomes a (model, pred) row next to ``actual``."""
    preds = [c for c in df.columns if c.startswith(prefix)]
    base = df.select(*ids, F.col(actual).alias("actual"),
                     *[F.col(c).cast("double").alias(c[len(prefix):]) for c in preds])
    return base.unpivot([*ids, "actual"], [c[len(prefix):] for c in preds], "model", "pred")


def model_metrics(long: DataFrame, group_cols: list[str] | None = None, *, digits: int | None = 6) -> DataFrame:
    """M1 for every (model, group) in one aggregate."""
    g = ["model", *(group_cols or [])]

    def r(c: Column) -> Column:
        return F.round(c, digits) if digits is not None else c
    return long.groupBy(*g).agg(
        F.count(F.lit(1)).cast("long").alias("n_rows"),
        *regression_metric_columns("actual", "pred", digits=digits),
        r(F.avg("pred")).alias("mean_prediction"),
        r(F.avg("actual")).alias("mean_actual"),
        r(F.stddev_pop("actual")).alias("std_actual"))


def relative_improvement(metrics: DataFrame, *, against: tuple[str, ...] = (PERSISTENCE, ZERO),
                         scope: list[str] | None = None, digits: int | None = 6) -> DataFrame:
    """(baseline - metric) / baseline for MAE and RMSE, per scope.

    The metrics table has one row per model and scope, so the window partitions
    hold a handful of rows."""
    sc = scope or []
    w = Window.partitionBy(*sc) if sc else Window.partitionBy(F.lit(0))
    out = metrics
    for base in against:
        for m in ("mae", "rmse"):
            ref = F.max(F.when(F.col("model") == base, F.col(m))).over(w)
            rel = safe_div(ref - F.col(m), ref)
            out = out.withColumn(f"rel_{m}_vs_{base}", F.round(rel, digits) if digits is not None else rel)
    return out


def beats_baseline(metrics: DataFrame, *, baseline: str = PERSISTENCE, scope: list[str] | None = None) -> DataFrame:
    """P10: lower MAE / RMSE and higher R^2 than the baseline."""
    sc = scope or []
    w = Window.partitionBy(*sc) if sc else Window.partitionBy(F.lit(0))
    out = metrics
    for m, better in (("mae", "lt"), ("rmse", "lt"), ("r2", "gt")):
        ref = F.max(F.when(F.col("model") == baseline, F.col(m))).over(w)
        cond = F.col(m) < ref if better == "lt" else F.col(m) > ref
        out = out.withColumn(f"beats_{m}", cond)
    return out


def rank_models(metrics: DataFrame, *, by: str = "rmse", scope: list[str] | None = None) -> DataFrame:
    """O3: rank by ``by`` ascending (ties by model name)."""
    sc = scope or []
    w = (Window.partitionBy(*sc) if sc else Window.partitionBy(F.lit(0))).orderBy(F.col(by), F.col("model"))
    return metrics.withColumn("rank", F.row_number().over(w).cast("int"))


def round_doubles(df: DataFrame, digits: int = 6) -> DataFrame:
    return df.select(*[F.round(F.col(f.name), digits).alias(f.name) if f.dataType.typeName() == "double"
                       else F.col(f.name) for f in df.schema.fields])


def comparison_table(long: DataFrame, group_cols: list[str] | None = None) -> DataFrame:
    """M7: one row per model (per group): metrics, means, P9 improvements and O3 rank.
    Ratios and ranks use unrounded metrics; everything is rounded once at the end."""
    m = model_metrics(long, group_cols, digits=None)
    m = relative_improvement(m, scope=group_cols, digits=None)
    return round_doubles(rank_models(m, scope=group_cols))


def seen_flag(rows: DataFrame, fit_rows: DataFrame, *, entity: str = "entity", out: str = "seen") -> DataFrame:
    """J4 / J5 as one left join: ``seen`` is true when the entity occurs among the fit rows."""
    known = fit_rows.select(entity).where(F.col(entity).isNotNull()).distinct().withColumn("_known", F.lit(True))
    return (rows.join(known, entity, "left")
            .withColumn(out, F.coalesce(F.col("_known"), F.lit(False))).drop("_known"))


def seen_rows(rows: DataFrame, fit_rows: DataFrame, *, entity: str = "entity") -> DataFrame:
    """Rows whose entity occurs in the fit rows (left semi join)."""
    return rows.join(fit_rows.select(entity).distinct(), entity, "left_semi")


def unseen_rows(rows: DataFrame, fit_rows: DataFrame, *, entity: str = "entity") -> DataFrame:
    """The complement (left anti join)."""
    return rows.join(fit_rows.select(entity).distinct(), entity, "left_anti")


def align_by_key(left: DataFrame, right: DataFrame, keys: list[str], cols: list[str]) -> DataFrame:
    """Bring ``cols`` of ``right`` onto ``left`` by key, never by position."""
    return left.join(right.select(*keys, *cols), keys, "inner")


def residuals(long: DataFrame) -> DataFrame:
    """P8."""
    return (long.withColumn("residual", F.col("actual") - F.col("pred"))
            .withColumn("abs_error", F.abs(F.col("residual"))))


def monthly_metrics(long: DataFrame, models: list[str], *, month: str = "target_month") -> DataFrame:
    """M8: per target month rows, actual mean / std and MAE, RMSE per model -- one
    conditional aggregate over the explicit model list (a single exchange)."""
    e = F.col("actual") - F.col("pred")
    first = F.col("model") == models[0]
    per_model = []
    for m in models:
        is_m = F.col("model") == m
        per_model += [F.round(F.avg(F.when(is_m, F.abs(e))), 6).alias(f"{m}_mae"),
                      F.round(F.sqrt(F.avg(F.when(is_m, e * e))), 6).alias(f"{m}_rmse")]
    return long.groupBy(month).agg(
        F.count(F.when(first, 1)).cast("long").alias("n_rows"),
        F.round(F.avg(F.when(first, F.col("actual"))), 6).alias("actual_mean"),
        F.round(F.stddev_pop(F.when(first, F.col("actual"))), 6).alias("actual_std"),
        *per_model)


def error_percentiles(long: DataFrame, *, probs: tuple[float, ...] = (0.5, 0.75, 0.9, 0.95)) -> DataFrame:
    """Exact percentiles of |error| per model (linear interpolation), searched on the
    long (model, error) table, so neither a model's errors nor the models are gathered."""
    from panelforge.functions.quantiles import group_quantiles
    # the table is read by a few small jobs and the result lands on the driver: persist for their duration
    errors = long.select("model", F.abs(F.col("actual") - F.col("pred")).alias("e")).persist()
    try:
        q = group_quantiles(errors, "model", "e", list(probs))
    finally:
        errors.unpersist()
    names = {0.5: "p50", 0.75: "p75", 0.9: "p90", 0.95: "p95"}
    cols = [names.get(p, f"p{int(p * 100)}") for p in probs]
    rows = [(m, *[None if found is None else float(found[p]) for p in probs]) for m, found in sorted(q.items(), key=lambda x: str(x[0]))]
    table = long.sparkSession.createDataFrame(rows, "model string, " + ", ".join(f"{c} double" for c in cols))
    # round in Spark (half-up on the decimal form), as every other table does
    return table.select("model", *[F.round(c, 6).alias(c) for c in cols])


def category_errors(long: DataFrame, models: list[str], *, category: str = "category") -> DataFrame:
    """Rows and MAE per category per model (one conditional aggregate)."""
    err = F.abs(F.col("actual") - F.col("pred"))
    return long.groupBy(category).agg(
        F.count(F.when(F.col("model") == models[0], 1)).cast("long").alias("n_rows"),
        *[F.round(F.avg(F.when(F.col("model") == m, err)), 6).alias(f"{m}_mae") for m in models])


def top_errors(errors: DataFrame, *, by: str, keys: list[str], n: int = 10) -> DataFrame:
    """The n largest absolute errors (ties by key), numbered 1..n after the limit."""
    ordered = errors.orderBy(F.col(by).desc(), *[F.col(k) for k in keys]).limit(n)
    return ordered.withColumn(
        "error_id", F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(F.col(by).desc(), *keys)).cast("int"))


def seen_unseen_metrics(long: DataFrame, *, flag: str = "seen", entity: str = "entity") -> DataFrame:
    """Per seen / unseen group and model: rows, distinct entities, target mean and
    population std, MAE / RMSE / R^2.  The pivot over the explicit list [True, False]
    keeps a group that has no rows; its figures are zero, as in the reference."""
    e = F.col("actual") - F.col("pred")
    aggs = [F.count(F.lit(1)).alias("n_rows"), F.countDistinct(entity).alias("n_entities"),
            F.avg("actual").alias("target_mean"), F.stddev_pop("actual").alias("target_std"),
            *regression_metric_columns("actual", "pred", with_mape=False, digits=None)]
    stats = ["n_rows", "n_entities", "target_mean", "target_std", "mae", "rmse", "r2"]
    wide = long.groupBy("model").pivot(flag, [True, False]).agg(*aggs)

    def group_row(value: bool, label: str) -> Column:
        fields = [F.lit(label).alias("entity_group")]
        for s_ in stats:
            c = F.coalesce(F.col(f"{str(value).lower()}_{s_}"), F.lit(0))
            fields.append((c.cast("long") if s_ in ("n_rows", "n_entities") else F.round(c.cast("double"), 6)).alias(s_))
        return F.struct(*fields)

    rows = wide.select("model", F.explode(F.array(group_row(True, "seen"), group_row(False, "unseen"))).alias("g"))
    return rows.select("g.entity_group", "model", *[f"g.{s_}" for s_ in stats])


def train_val_gap(long: DataFrame, *, split: str = "split") -> DataFrame:
    """MAE and R^2 on train and val per model, and their gaps (val - train MAE, train - val R^2)."""
    m = long.groupBy("model").pivot(split, ["train", "val"]).agg(
        *regression_metric_columns("actual", "pred", with_mape=False, digits=None))
    return m.select(
        "model", F.round("train_mae", 6).alias("train_mae"), F.round("val_mae", 6).alias("val_mae"),
        F.round(F.col("val_mae") - F.col("train_mae"), 6).alias("mae_gap"),
        F.round("train_r2", 6).alias("train_r2"), F.round("val_r2", 6).alias("val_r2"),
        F.round(F.col("train_r2") - F.col("val_r2"), 6).alias("r2_gap"))
