"""Panel construction and diagnostics.

W1  next_month_target   lead over (entity ordered by period), gap must be one month
P1  log_aum             log1p per row, NULL where the value is negative or missing
P3  month ordinal       see functions.periods
P4  (inside W1)         target set to NULL at a gap, rows without a target dropped
P5  complete_cases      drop rows with a NULL in the given columns
P6  standardize_panel   (x - mean) / stddev_samp over a scope, then NULL -> 0
P7  dummies_long        first-level-dropped indicators in long form (absorbed: operators/absorb.py)
J3  demean              x - entity mean through a window (no join)
A1-A6 panel_diagnostics shape, balance, obs per entity, variance decomposition
A9-A11, A13             category distribution, monthly counts, target stats, correlations

The W1 window is partitioned by entity: after the key check (V3) an entity
holds at most one row per period, so a window partition is bounded by the
number of periods, never by the number of rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelforge.functions.periods import month_ordinal
from panelforge.functions.safe import safe_div


# ---------------------------------------------------------------- projections

def log_aum(df: DataFrame, col: str = "aum", out: str = "log_aum") -> DataFrame:
    """log1p of a size column, row by row; NULL where the value is < 0 or missing."""
    c = F.col(col)
    return df.withColumn(out, F.when(c >= 0, F.log1p(c)))


def add_month_ordinal(df: DataFrame, period: str = "period", out: str = "month_ord") -> DataFrame:
    """P3."""
    return df.withColumn(out, month_ordinal(period))


def next_month_target(df: DataFrame, *, entity: str = "entity", period: str = "period",
                      target: str = "ret", out: str = "target", out_period: str = "target_month",
                      keep_gap: bool = False) -> DataFrame:
    """W1 + P4: next period's target within each entity, kept only when the next
    row is exactly one calendar month later; rows without a target are dropped."""
    w = Window.partitionBy(entity).orderBy(period)
    nxt_t = F.lead(F.col(target)).over(w)
    nxt_p = F.lead(F.col(period)).over(w)
    gap = month_ordinal(nxt_p) - month_ordinal(period)
    res = (df.withColumn("_gap", gap)
           .withColumn(out, F.when(F.col("_gap") == 1, nxt_t))
           .withColumn(out_period, F.when(F.col("_gap") == 1, nxt_p).cast("int"))
           .filter(F.col(out).isNotNull()))
    return res if keep_gap else res.drop("_gap")


def complete_cases(df: DataFrame, cols: list[str]) -> DataFrame:
    """P5."""
    return df.dropna(how="any", subset=cols)


def standardize_panel(df: DataFrame, cols: list[str], *, scope: DataFrame | None = None,
                      suffix: str = "") -> DataFrame:
    """(x - mean) / stddev_samp with statistics from ``scope`` (default: the
    whole panel), then NULL -> 0.  The statistics are one grouping-free
    aggregate (two numbers per column) collected as fit parameters."""
    src = scope if scope is not None else df
    stats = src.agg(*[F.avg(c).alias(f"m_{i}") for i, c in enumerate(cols)],
                    *[F.stddev_samp(c).alias(f"s_{i}") for i, c in enumerate(cols)]).first()
    out = df
    for i, c in enumerate(cols):
        m, s = stats[f"m_{i}"], stats[f"s_{i}"]
        z = safe_div(F.col(c) - F.lit(m), F.lit(s)) if m is not None and s else F.lit(None)
        out = out.withColumn(c + suffix, F.coalesce(z.cast("double"), F.lit(0.0)))
    return out


def dummies_long(df: DataFrame, cols: list[str], keys: list[str]) -> DataFrame:
    """P7 (long, sparse): one row per (key, dummy) whose value is 1; the first level
    of each column (its minimum) is dropped.  Only that one level reaches the driver."""
    out = None
    for c in cols:
        first = df.agg(F.min(c).alias("_lo")).first()["_lo"]
        part = (df.where(F.col(c).isNotNull() & (F.col(c) != F.lit(first)))
                .select(*keys, F.concat(F.lit(c + "_"), F.col(c).cast("string")).alias("dummy"),
                        F.lit(1.0).alias("value")))
        out = part if out is None else out.unionByName(part)
    return out


def demean(df: DataFrame, col: str, *, entity: str = "entity", out: str | None = None) -> DataFrame:
    """X minus the entity's mean (window, no join)."""
    return df.withColumn(out or f"{col}_demeaned",
                         F.col(col) - F.avg(col).over(Window.partitionBy(entity)))


# ---------------------------------------------------------------- diagnostics

def panel_shape(df: DataFrame, *, entity: str = "entity", period: str = "period") -> DataFrame:
    """A1: distinct entities, distinct periods, rows."""
    return df.agg(F.countDistinct(entity).cast("long").alias("n_entities"),
                  F.countDistinct(period).cast("long").alias("n_periods"),
                  F.count(F.lit(1)).cast("long").alias("n_obs"))


def _entity_counts(df: DataFrame, entity: str) -> DataFrame:
    return df.where(F.col(entity).isNotNull()).groupBy(entity).agg(F.count(F.lit(1)).alias("n"))


def panel_balance(df: DataFrame, *, entity: str = "entity", period: str = "period") -> DataFrame:
    """A2: balanced iff every entity has the same count and it equals the number of periods.
    The two one-row aggregates are stacked and folded with max (no join)."""
    counts = _entity_counts(df, entity).agg(F.min("n").cast("long").alias("min_obs"),
                                            F.max("n").cast("long").alias("max_obs"))
    periods = df.agg(F.countDistinct(period).cast("long").alias("n_periods"))
    one = counts.unionByName(periods, allowMissingColumns=True).agg(
        F.max("min_obs").alias("min_obs"), F.max("max_obs").alias("max_obs"),
        F.max("n_periods").alias("n_periods"))
    return one.withColumn("balanced", F.coalesce((F.col("min_obs") == F.col("max_obs"))
                                                 & (F.col("max_obs") == F.col("n_periods")), F.lit(False)))


def obs_per_entity(df: DataFrame, *, entity: str = "entity") -> DataFrame:
    """A3: mean, std (ddof 1), min, quartiles (linear interpolation), max of rows per entity."""
    c = _entity_counts(df, entity)
    return c.agg(
        F.count(F.lit(1)).cast("long").alias("n_entities"),
        F.round(F.avg("n"), 6).alias("obs_mean"),
        F.round(F.stddev_samp("n"), 6).alias("obs_std"),
        F.min("n").cast("double").alias("obs_min"),
        F.round(F.percentile("n", 0.25), 6).alias("obs_p25"),
        F.round(F.percentile("n", 0.5), 6).alias("obs_p50"),
        F.round(F.percentile("n", 0.75), 6).alias("obs_p75"),
        F.max("n").cast("double").alias("obs_max"))


def _group_moments(df: DataFrame, target: str, keys: list[str]) -> DataFrame:
    """One pass with GROUPING SETS ((k1), (k2), ..., ()) -> per group n, mean, m2."""
    y = F.col(target)
    sets = [[k] for k in keys] + [[]]
    g = df.groupingSets(sets, *keys).agg(
        F.count(y).alias("n"), F.avg(y).alias("mean"),
        (F.var_pop(y) * F.count(y)).alias("m2"),
        F.grouping_id(*keys).alias("gid"))
    return g


def variance_decomposition(df: DataFrame, *, entity: str = "entity", period: str = "period",
                           category: str = "category", target: str = "ret", digits: int | None = 6) -> DataFrame:
    """A4 + A5 + A6 in one scan of the panel (GROUPING SETS over entity, period,
    category and the grand total), then a tiny aggregate over the group rows.

    overall std (ddof 1), between std = std of entity means (ddof 1),
    within std = std of the entity-demeaned values (ddof 1) = sqrt(sum m2_e / (N - 1)),
    month / category variance = var_samp of the group means.  Groups whose
    key is NULL or whose target is all missing are skipped, as pandas does.
    """
    keys = [entity, period, category]
    g = _group_moments(df, target, keys)
    n_keys = len(keys)
    # grouping_id bit i (from the left, most significant first) is 1 when key i is aggregated away
    gid_of = {k: sum(1 << (n_keys - 1 - j) for j in range(n_keys) if j != i) for i, k in enumerate(keys)}
    total_gid = (1 << n_keys) - 1
    is_e = (F.col("gid") == gid_of[entity]) & F.col(entity).isNotNull() & (F.col("n") > 0)
    is_p = (F.col("gid") == gid_of[period]) & F.col(period).isNotNull() & (F.col("n") > 0)
    is_c = (F.col("gid") == gid_of[category]) & F.col(category).isNotNull() & (F.col("n") > 0)
    is_t = F.col("gid") == total_gid
    n_tot = F.max(F.when(is_t, F.col("n")))

    def r(c):
        return F.round(c, digits) if digits is not None else c
    return g.agg(
        r(F.max(F.when(is_t, F.col("mean")))).alias("overall_mean"),
        r(F.sqrt(F.max(F.when(is_t, F.col("m2"))) / (n_tot - 1))).alias("overall_std"),
        r(F.sqrt(F.var_samp(F.when(is_e, F.col("mean"))))).alias("between_std"),
        r(F.sqrt(F.sum(F.when(is_e, F.col("m2"))) / (n_tot - 1))).alias("within_std"),
        r(F.var_samp(F.when(is_p, F.col("mean")))).alias("month_variance"),
        r(F.var_samp(F.when(is_c, F.col("mean")))).alias("category_variance"),
        r(F.var_samp(F.when(is_e, F.col("mean")))).alias("between_variance"),
        r(F.max(F.when(is_t, F.col("m2"))) / (n_tot - 1)).alias("overall_variance"),
    )


def variance_share(df: DataFrame, **kw) -> DataFrame:
    """Each variance component as a share of the overall variance (percent)."""
    vd = variance_decomposition(df, digits=None, **kw)
    ov = F.col("overall_variance")
    return vd.select(
        F.round(ov, 6).alias("overall_variance"),
        F.round(safe_div(F.col("month_variance"), ov) * 100, 6).alias("month_share_pct"),
        F.round(safe_div(F.col("between_variance"), ov) * 100, 6).alias("between_share_pct"),
        F.round(safe_div(F.col("category_variance"), ov) * 100, 6).alias("category_share_pct"),
        F.round(safe_div(F.col("within_std") * F.col("within_std"), ov) * 100, 6).alias("within_share_pct"))


def category_distribution(df: DataFrame, *, group: str, category: str = "category") -> DataFrame:
    """Per group, 'level: count; ...' ordered by count desc then level."""
    counts = df.groupBy(group, category).agg(F.count(F.lit(1)).alias("n"))
    return counts.groupBy(group).agg(
        F.array_join(
            F.transform(F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("k"), F.col(category).alias("c"),
                                                             F.col("n").alias("n")))),
                        lambda s: F.concat(s["c"], F.lit(": "), s["n"].cast("string"))),
            "; ").alias("category_distribution"))


def monthly_counts(df: DataFrame, *, group: str, period: str = "target_month") -> DataFrame:
    """A10."""
    return df.groupBy(group, period).agg(F.count(F.lit(1)).cast("long").alias("n_rows"))


def target_stats(df: DataFrame, *, group: str, target: str = "target", entity: str = "entity") -> DataFrame:
    """Rows, distinct entities, mean and population std of the target per group."""
    return df.groupBy(group).agg(
        F.count(F.lit(1)).cast("long").alias("n_rows"),
        F.countDistinct(entity).cast("long").alias("n_entities"),
        F.round(F.avg(target), 6).alias("target_mean"),
        F.round(F.stddev_pop(target), 6).alias("target_std"))


def correlation_long(df: DataFrame, cols: list[str]) -> DataFrame:
    """Pairwise Pearson correlation (pairwise-complete rows), lower triangle, long form (feature_a, feature_b, corr).

    One masked Gram pass for all pairs: with x centred and 0 where missing and m the 0/1 mask, a task adds up m'm, x'm,
    (x*x)'m and x'x of its rows and sends one row per pair; the sums are added on the executors.  NaN counts as missing;
    a pair without variance has NULL."""
    p = len(cols)
    src = df.select(*[F.nanvl(F.col(c).cast("double"), F.lit(None)).alias(f"z{i}") for i, c in enumerate(cols)])
    centre = np.array([v or 0.0 for v in src.agg(*[F.avg(c) for c in src.columns]).first()])  # keeps the sums small
    ia, ib = np.tril_indices(p, -1)

    def partial(batches):
        total = np.zeros((6, len(ia)))
        for batch in batches:
            z = np.column_stack([c.to_numpy(zero_copy_only=False) for c in batch.columns]).astype(float) - centre
            mask = np.isfinite(z).astype(float)
            x = np.where(mask > 0, z, 0.0)
            one, two = x.T @ mask, (x * x).T @ mask
            total += np.stack([(mask.T @ mask)[ia, ib], one[ia, ib], one[ib, ia], two[ia, ib], two[ib, ia], (x.T @ x)[ia, ib]])
        yield pa.RecordBatch.from_arrays([pa.array(ia.astype(np.int32)), pa.array(ib.astype(np.int32)), *[pa.array(t) for t in total]],
                                         names=["a", "b", "n", "sa", "sb", "saa", "sbb", "sab"])

    sums = src.mapInArrow(partial, "a int, b int, n double, sa double, sb double, saa double, sbb double, sab double").groupBy("a", "b").agg(
        *[F.sum(c).alias(c) for c in ("n", "sa", "sb", "saa", "sbb", "sab")])
    va, vb = (F.col("n") * F.col(f"s{v}{v}") - F.col(f"s{v}") * F.col(f"s{v}") for v in "ab")
    some = (va > 1e-12 * F.col("n") * F.col("saa")) & (vb > 1e-12 * F.col("n") * F.col("sbb"))  # beyond rounding
    corr = F.when(some, (F.col("n") * F.col("sab") - F.col("sa") * F.col("sb")) / (F.sqrt(va) * F.sqrt(vb)))
    name = F.array(*[F.lit(c) for c in cols])
    return sums.select(F.element_at(name, F.col("a") + 1).alias("feature_a"), F.element_at(name, F.col("b") + 1).alias("feature_b"),
                       F.round(corr, 6).alias("corr"))
