"""Absorbed fixed effects (L2, P7): regressions without dummy columns.

Frisch-Waugh: the coefficients of y on X and level dummies of some factors equal those of y
on X after every column has been demeaned by all factors at once. A column's part that the
dummies explain is constant within a cell (one combination of levels), so the rows are
aggregated once to cell means, and alternating projections run on the cell table: a round
subtracts, factor by factor, the weighted average of the cells' remainders per level (one
grouped average and one join each) until the largest level change of a round is below
``bound`` standard deviations of its column. Levels stay rows of a table from beginning to
end; no number of levels is collected, listed or limited.

The demeaned rows then give ordinary moments: coefficients, and with scores summed per entity
the clustered sandwich. Both equal the dummy form's for the regressors. The level effects,
relative to each factor's lowest level, come out as a (factor, level, effect) table.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelforge.functions.distributions import norm_ppf, norm_sf2
from panelforge.operators.gram import moments
from panelforge.operators.linear import COEF_SCHEMA, scaled_pinv
from panelforge.session import checkpoint_root


#: numbers (cells x columns) up to which the cells' level effects are broadcast to the rows: some 8 MB
BROADCAST_NUMBERS = 500_000


@dataclass
class Absorbed:
    """``rows``: keys and the demeaned columns under their own names; ``cells``: one row per cell and column
    (``_j``, its place in ``columns``) with the cell's level effect ``_e{i}`` of factor i."""
    rows: DataFrame
    cells: DataFrame
    columns: list[str]
    factors: list[str]
    rounds: int
    shuffled: bool  # the cells were too many to broadcast: computing ``rows`` shuffles the source

    def level_effects(self, weights: dict[str, float]) -> DataFrame:
        """(factor, level, effect) of the combination sum_c weights[c] * column c; each factor's lowest level is 0."""
        weight = F.element_at(F.array(*[F.lit(float(weights.get(c, 0.0))) for c in self.columns]), F.col("_j") + 1)
        parts = []
        for i, f in enumerate(self.factors):
            one = self.cells.groupBy(f, "_j").agg(F.first(f"_e{i}").alias("_e"))  # equal in all cells of a level
            levels = one.groupBy(f).agg(F.sum(F.col("_e") * weight).alias("_v"))
            low = levels.agg(F.min_by("_v", f).alias("_low"))  # one row
            parts.append(levels.crossJoin(F.broadcast(low)).select(
                F.lit(f).alias("factor"), F.col(f).cast("string").alias("level"), (F.col("_v") - F.col("_low")).alias("effect")))
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
        return out


def absorb(df: DataFrame, columns: list[str], factors: list[str], *, keys: list[str] = (), bound: float = 1e-12,
           max_rounds: int = 10_000) -> Absorbed:
    """Demean ``columns`` by the levels of all ``factors`` at once. Rows with a NULL in any of them are dropped."""
    checkpoint_root(df.sparkSession)
    q, names = len(columns), [f"_x{j}" for j in range(len(columns))]
    kept = list(dict.fromkeys([*keys, *factors]))
    src = df.dropna(subset=[*columns, *factors]).select(*kept, *[F.col(c).cast("double").alias(x) for c, x in zip(columns, names)])
    first = src.agg(*[F.avg(x).alias(f"m{j}") for j, x in enumerate(names)],
                    *[F.stddev_pop(x).alias(f"s{j}") for j, x in enumerate(names)]).first()
    scale = [(first[f"m{j}"] or 0.0, first[f"s{j}"] or 1.0) for j in range(q)]  # centred and scaled: sums stay exact enough
    scaled = src.select(*kept, *[((F.col(x) - F.lit(m)) / F.lit(s)).alias(x) for x, (m, s) in zip(names, scale)])
    wide = scaled.groupBy(*factors).agg(F.count(F.lit(1)).cast("double").alias("_n"), *[F.avg(x).alias(x) for x in names])
    cells = wide.select(*factors, "_n", F.posexplode(F.array(*names)).alias("_j", "_m")).select(
        *factors, "_n", "_j", "_m", F.col("_m").alias("_r"), *[F.lit(0.0).alias(f"_e{i}") for i in range(len(factors))], F.lit(0.0).alias("_moved"))
    cells, done = cells.checkpoint(eager=True), 0
    while True:
        for i, f in enumerate(factors):  # cells are read twice in a step, so each step is stored
            cells = _project(cells, i, f).checkpoint(eager=True)
        done += 1
        moved = cells.agg(F.max("_moved")).first()[0] or 0.0
        if len(factors) == 1 or moved <= bound:
            break
        if done >= max_rounds:
            raise ArithmeticError(f"level effects still move by {moved:.1e} after {done} rounds")
    shift = cells.groupBy(*factors).pivot("_j", list(range(q))).agg(F.first(F.col("_m") - F.col("_r")))
    shift = shift.select(*factors, *[F.col(str(j)).alias(f"_f{j}") for j in range(q)])
    shuffled = cells.count() > BROADCAST_NUMBERS
    rows = scaled.join(shift if shuffled else F.broadcast(shift), factors).select(
        *kept, *[((F.col(x) - F.col(f"_f{j}")) * F.lit(scale[j][1])).alias(columns[j]) for j, x in enumerate(names)])
    unit = F.element_at(F.array(*[F.lit(float(s)) for _, s in scale]), F.col("_j") + 1)
    cells = cells.select(*factors, "_j", *[(F.col(f"_e{i}") * unit).alias(f"_e{i}") for i in range(len(factors))])
    return Absorbed(rows, cells, list(columns), list(factors), done, shuffled)


def _project(cells: DataFrame, i: int, factor: str) -> DataFrame:
    """Subtract from the cells' remainders their average per level of factor i; ``_moved`` is the largest one of the round."""
    level = cells.groupBy(factor, "_j").agg((F.sum(F.col("_n") * F.col("_r")) / F.sum("_n")).alias("_g"))
    new = {"_r": F.col("_r") - F.col("_g"), f"_e{i}": F.col(f"_e{i}") + F.col("_g"),
           "_moved": F.abs("_g") if i == 0 else F.greatest("_moved", F.abs("_g"))}
    return cells.join(level, [factor, "_j"]).select(*[new.get(c, F.col(c)).alias(c) for c in cells.columns])


def fe_ols_absorbed(df: DataFrame, features: list[str], label: str, *, entity: str = "entity",
                    factors: tuple[str, ...] = ("category", "period")) -> tuple[DataFrame, DataFrame, dict]:
    """L2: y on features and the levels of ``factors``, covariance clustered by entity.

    Returns (coefficient table of the features, level effects, info). The small-sample factor is
    G/(G-1) * (n-1)/(n-k) with k as in the dummy form (features, constant, levels less one per factor).
    """
    columns = [*features, label]
    found = absorb(df.dropna(subset=[entity]), columns, list(factors), keys=[entity])
    p = len(features)
    rows = found.rows.select(entity, *[F.col(c).alias(f"_d{j}") for j, c in enumerate(columns)])
    if found.shuffled:
        rows = rows.checkpoint(eager=True)  # read three times; without a shuffle that is cheaper than a copy of the source
    d = [f"_d{j}" for j in range(p + 1)]
    m = moments(rows, d)[()]
    bread = scaled_pinv(m.Cxx)[0]
    beta = bread @ m.Cxy
    resid = F.col(d[p])
    for c, b in zip(d, beta):
        resid = resid - F.col(c) * F.lit(float(b))
    scores = rows.withColumn("_res", resid).groupBy(entity).agg(*[F.sum(F.col(c) * F.col("_res")).alias(f"_s{j}") for j, c in enumerate(d[:p])],
                                                                 F.sum(F.col("_res") * F.col("_res")).alias("_sse")).checkpoint(eager=True)
    s_cols = [f"_s{j}" for j in range(p)]
    ms = moments(scores, [*s_cols, "_sse"])[()]
    meat = ms.C[:-1, :-1] + ms.n * np.outer(ms.mean[:-1], ms.mean[:-1])
    n, groups, sse = m.n, ms.n, ms.n * ms.mean[-1]
    levels = found.cells.agg(*[F.countDistinct(f) for f in factors]).first()
    k = p + 1 + sum(v - 1 for v in levels)
    factor = (groups / (groups - 1)) * ((n - 1) / (n - k)) if groups > 1 and n > k else float("nan")
    cov = factor * bread @ meat @ bread
    zq = norm_ppf(0.975)
    table = []
    for j, name in enumerate(features):
        b, se = float(beta[j]), math.sqrt(max(cov[j, j], 0.0))
        z = b / se if se > 0 else float("nan")
        table.append((name, b, float(se), float(z), float(norm_sf2(z)) if se > 0 else float("nan"), float(b - zq * se), float(b + zq * se)))
    effects = found.level_effects({label: 1.0, **{c: -float(b) for c, b in zip(features, beta)}})
    info = {"n": n, "groups": int(groups), "k": int(k), "sse": float(sse), "rounds": found.rounds,
            "r2_within": 1 - float(sse) / m.Cyy if m.Cyy > 0 else float("nan")}
    return df.sparkSession.createDataFrame(table, COEF_SCHEMA.replace(" t double", " z double")), effects, info
