"""Tree models with Spark ML.

Spark's trees are histogram based (``maxBins`` candidate splits) and have no
``min_samples_split``; ``minInstancesPerNode`` is a *leaf* minimum.  Parameters
are exposed under Spark's names; trees are not claimed equal to scikit-learn's,
only metrics and invariants are checked.

R1 decision_tree_cv / R2 random_forest_cv / R3 gradient_boosting_cv   grid search
R4 hist_gradient_boosting / R5 rf_random_search                         seeded random search
R6 rf_final                                                             fixed forest
R7 fold_metrics                                                         refit per fold, MAE / RMSE / R^2
R8 impurity_importance, R9 permutation_importance
Folds are (train predicate, validation predicate) pairs over the design table;
fold data is cached once and the small fit jobs run on a thread pool so several
Spark jobs overlap.
"""

from __future__ import annotations

import itertools
import json
import math
import random
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import DecisionTreeRegressor, GBTRegressor, RandomForestRegressor
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelforge.functions.metrics import regression_metric_columns
from panelforge.operators.splits import WALK_FORWARD_FOLDS, dense_index
from panelforge.operators.tree_growth import Boosting, Forest, moved
from panelforge.session import ship_package

VEC = "_features"
ROWS_PER_TASK = 500_000  # a boosted fit is hundreds of rounds: on few rows more tasks only cost scheduling

# The reference's search spaces, under Spark's parameter names.
TREE_GRID = {"maxDepth": [3, 4, 5, 6, 8], "minInstancesPerNode": [1, 3, 5]}
FOREST_GRID = {"numTrees": [50, 100], "maxDepth": [4, 5, 6], "minInstancesPerNode": [3, 5]}
GBT_GRID = {"maxIter": [50, 100], "stepSize": [0.05, 0.1], "maxDepth": [3, 4]}
RF_SEARCH = {"numTrees": [50, 100, 150], "maxDepth": [4, 5, 6, 8], "minInstancesPerNode": [2, 4, 8]}
GBT_SEARCH = {"maxIter": [50, 100, 150], "maxDepth": [3, 4, 5, 6], "stepSize": [0.01, 0.05, 0.1],
              "minInstancesPerNode": [5, 10, 20]}
RF_FINAL = {"numTrees": 50, "maxDepth": 4, "minInstancesPerNode": 8}


def assemble(df: DataFrame, features: list[str]) -> DataFrame:
    return VectorAssembler(inputCols=features, outputCol=VEC, handleInvalid="keep").transform(df)


def _settled(kind: str, params: dict) -> dict:
    """``params`` with Spark's defaults for the others that the searches know."""
    known = {"maxDepth": 5, "minInstancesPerNode": 1, **({"maxIter": 20, "stepSize": 0.1, "maxBins": 255} if kind == "gbt" else {"maxBins": 32}),
             **({"numTrees": 20} if kind == "forest" else {})}
    if unknown := sorted(set(params) - set(known)):
        raise ValueError(f"a search of {kind} has no parameters {unknown}")
    return {**known, **({"numTrees": 1} if kind == "tree" else {}), **params}


@dataclass
class SearchedEstimator:
    """A candidate of a search: ``fit`` grows its trees on what the candidates share."""
    params: dict
    search: Callable

    def fit(self, rows: DataFrame):
        return self.search(rows, self.params)


def estimator(kind: str, params: dict, *, label: str = "target", seed: int = 42, search: Callable | None = None):
    """Spark's estimator, or the same candidate fitted by ``search`` (rows, parameters)."""
    if search is not None:
        return SearchedEstimator(_settled(kind, params), search)
    common = {"featuresCol": VEC, "labelCol": label, "predictionCol": "pred", "seed": seed}
    if kind == "tree":
        return DecisionTreeRegressor(**common, **params)
    if kind == "forest":
        return RandomForestRegressor(**common, featureSubsetStrategy="all", bootstrap=True, **params)
    if kind == "gbt":
        return GBTRegressor(**common, lossType="squared", **{"maxBins": 255, **params})
    raise ValueError(kind)


def grid(space: dict) -> list[dict]:
    keys = list(space)
    return [dict(zip(keys, vals)) for vals in itertools.product(*[space[k] for k in keys])]


def sample_grid(space: dict, n_iter: int = 15, seed: int = 42) -> list[dict]:
    """Seeded draw without replacement from the parameter grid."""
    full = grid(space)
    return random.Random(seed).sample(full, min(n_iter, len(full)))


def walk_forward(month: str = "target_month", folds=WALK_FORWARD_FOLDS) -> list[tuple[Column, Column]]:
    return [(F.col(month) <= limit, (F.col(month) >= start) & (F.col(month) <= end)) for limit, start, end in folds]


def _score(pred: DataFrame, label: str) -> dict:
    r = pred.agg(*regression_metric_columns(label, "pred", digits=None, with_mape=False)).first()
    return {"mae": r["mae"], "rmse": r["rmse"], "r2": r["r2"]}


def packed(data: DataFrame) -> DataFrame:
    """The same rows in at most one partition for each ROWS_PER_TASK of them."""
    parts = max(1, math.ceil(data.count() / ROWS_PER_TASK))
    return data.repartition(parts) if parts < data.rdd.getNumPartitions() else data


def groups_without(candidates: list[dict], name: str) -> list[list[int]]:
    """Numbers of the candidates that differ only in ``name``."""
    groups: dict[str, list[int]] = {}
    for ci, c in enumerate(candidates):
        groups.setdefault(json.dumps({k: v for k, v in c.items() if k != name}, sort_keys=True), []).append(ci)
    return list(groups.values())


def predict_by_depth(trees: list[tuple[np.ndarray, ...]], x: np.ndarray, depths: list[int]) -> np.ndarray:
    """(depths, rows): predictions of the trees cut off below each depth, their mean for a forest."""
    out, rows = np.zeros((len(depths), len(x))), np.arange(len(x))
    for prediction, feature, threshold, left, right in trees:
        at = np.zeros(len(x), dtype=np.int64)
        for level in range(max(depths) + 1):
            for i, d in enumerate(depths):
                if d == level:
                    out[i] += prediction[at]
            f = feature[at]
            at = np.where(f < 0, at, np.where(x[rows, f] <= threshold[at], left[at], right[at]))
    return out / len(trees)


def predict_by_round(trees: list[tuple[np.ndarray, ...]], step: float, x: np.ndarray, rounds: list[int]) -> np.ndarray:
    """(rounds, rows): predictions of the boosted trees after each of the rounds."""
    columns, out, pred = np.ascontiguousarray(x.T), [], np.zeros(len(x))
    for i, (prediction, *table) in enumerate(trees):
        at = moved(columns, np.zeros(len(x), dtype=np.int64), table, len(prediction) // 2)
        pred = pred + prediction[at] * (step if i else 1.0)
        if i + 1 in rounds:
            out.append(pred)
    return np.stack(out)


def _scores(val: DataFrame, features: list[str], label: str, predict, models: list[tuple], cuts: list[list[int]]) -> list[list[dict]]:
    """The scores of each model at each of its ``cuts`` (depths or rounds), all in one pass over the rows."""
    held = val.sparkSession.sparkContext.broadcast((models, cuts))
    names = [[f"p{i}_{d}" for d in of] for i, of in enumerate(cuts)]
    flat = [n for of in names for n in of]

    def run(batches):
        for batch in batches:
            x = np.column_stack([c.to_numpy(zero_copy_only=False) for c in batch.columns[1:]])
            found = [p for model, of in zip(*held.value) for p in predict(*model, x, of)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *map(pa.array, found)], names=["y", *flat])

    pred = val.select(F.col(label).cast("double"), *[F.col(f).cast("double") for f in features]).mapInArrow(
        run, "y double, " + ", ".join(f"{n} double" for n in flat))
    found = pred.agg(*[F.struct(*regression_metric_columns("y", n, digits=None, with_mape=False)).alias(n) for n in flat]).first()
    held.unpersist()
    return [[{m: found[n][m] for m in ("mae", "rmse", "r2")} for n in of] for of in names]


def _boosted_scores(data: DataFrame, features: list[str], candidates: list[dict], folds, label: str, seed: int, parallelism: int) -> list[tuple]:
    """(candidate, fold, scores); all candidates and folds are grown together."""
    groups = groups_without(candidates, "maxIter")
    longest = [max(members, key=lambda ci: _settled("gbt", candidates[ci])["maxIter"]) for members in groups]
    rounds = [sorted({_settled("gbt", candidates[ci])["maxIter"] for ci in members}) for members in groups]
    results = []
    for bins in sorted({_settled("gbt", c)["maxBins"] for c in candidates}):
        own = [g for g, ci in enumerate(longest) if _settled("gbt", candidates[ci])["maxBins"] == bins]
        boosting = Boosting(features, label, bins, seed)
        try:
            def begin(fi):
                rows = data.where(folds[fi][0])
                return [estimator("gbt", dict(candidates[longest[g]]), label=label, seed=seed,
                                  search=lambda rows, p, g=g: boosting.fit(rows, fi, g, p)).fit(rows) for g in own]

            with ThreadPoolExecutor(max_workers=parallelism) as pool:
                lanes = list(pool.map(begin, range(len(folds))))
                boosting.grow()
                scored = list(pool.map(lambda fi: _scores(
                    data.where(folds[fi][1]), features, label, predict_by_round,
                    [([t.arrays(boosting.folds[fi][0].cuts) for t in lane.finish()], lane.step) for lane in lanes[fi]],
                    [rounds[g] for g in own]), range(len(folds))))
        finally:
            boosting.close()
        results += [(ci, fi, scored[fi][k][rounds[g].index(_settled("gbt", candidates[ci])["maxIter"])])
                    for fi in range(len(folds)) for k, g in enumerate(own) for ci in groups[g]]
    return results


def _grown_scores(data: DataFrame, features: list[str], kind: str, candidates: list[dict], folds, label: str, seed: int, parallelism: int) -> list[tuple]:
    """(candidate, fold, scores) of trees or forests. What differs in depth alone is one fit, cut off at each depth; what
    differs in the leaf minimum as well is fitted one after the other on the same stored rows, the smallest minimum first."""
    groups = groups_without(candidates, "maxDepth")
    settled = [_settled(kind, c) for c in candidates]
    cut = [sorted({settled[ci]["maxDepth"] for ci in members}) for members in groups]
    families: dict[str, list[int]] = {}
    for g, members in enumerate(groups):
        families.setdefault(json.dumps({k: v for k, v in settled[members[0]].items() if k not in ("maxDepth", "minInstancesPerNode")},
                                       sort_keys=True), []).append(g)

    def grow(fi, own):
        of = settled[groups[own[0]][0]]
        forest = Forest(features, label, of["numTrees"], max(d for g in own for d in cut[g]), of["maxBins"], seed, sampled=kind == "forest")
        try:
            rows = data.where(folds[fi][0])
            return {g: estimator(kind, {**candidates[groups[g][0]], "maxDepth": forest.max_depth}, label=label, seed=seed,
                                 search=lambda rows, p: forest.fit(rows, p["minInstancesPerNode"])).fit(rows)
                    for g in sorted(own, key=lambda g: settled[groups[g][0]]["minInstancesPerNode"])}
        finally:
            forest.close()

    results = []
    # a forest's jobs have a task for each partition: with many of these, fewer forests at a time keep the cores busy and less in store
    at_once = max(1, min(parallelism, 2 * data.sparkSession.sparkContext.defaultParallelism // max(1, data.rdd.getNumPartitions())))
    with ThreadPoolExecutor(max_workers=at_once) as pool:
        grown = [[pool.submit(grow, fi, own) for own in families.values()] for fi in range(len(folds))]
        for fi, of in enumerate(grown):  # a fold is scored while the next ones are fitted
            trees = {g: t for f in of for g, t in f.result().items()}
            scores = _scores(data.where(folds[fi][1]), features, label, predict_by_depth, [(trees[g],) for g in range(len(groups))], cut)
            results += [(ci, fi, scores[g][cut[g].index(settled[ci]["maxDepth"])]) for g, members in enumerate(groups) for ci in members]
            of.clear()
    return results


def cross_validate(df: DataFrame, features: list[str], kind: str, candidates: list[dict],
                   folds: list[tuple[Column, Column]], *, label: str = "target", seed: int = 42,
                   parallelism: int = 16) -> tuple[dict, DataFrame]:
    """Every (candidate, fold) scored on cached data; best = lowest mean MAE.  Boosted candidates
    that differ only in ``maxIter`` share one fit per fold (boosting is deterministic without
    subsampling, so a shorter run is a prefix of the longest) and are scored per prefix.  Trees and
    forests whose candidates differ only in ``maxDepth`` share one fit as well: nodes are split
    level by level, each by its own rows alone, so a shallower tree is the deepest one cut off.
    The fits are ``tree_growth``'s: Spark's trees on rows that are binned once for each fold."""
    ship_package(df.sparkSession)
    data = df.select(*features, label, *[c for c in ("target_month", "fold") if c in df.columns]).persist()
    rows = data
    try:
        if kind == "gbt":
            rows = packed(data).persist()
            results = _boosted_scores(rows, features, candidates, folds, label, seed, parallelism)
        else:
            results = _grown_scores(rows, features, kind, candidates, folds, label, seed, parallelism)
    finally:
        rows.unpersist()
        data.unpersist()
    results.sort(key=lambda r: (r[0], r[1]))
    rows = [(json.dumps(candidates[ci], sort_keys=True), fi + 1, m["mae"], m["rmse"], m["r2"]) for ci, fi, m in results]
    mean_mae = {}
    for ci, _, m in results:
        mean_mae.setdefault(ci, []).append(m["mae"])
    best = min(mean_mae, key=lambda c: (np.mean(mean_mae[c]), c))
    table = df.sparkSession.createDataFrame(rows, "params string, fold int, mae double, rmse double, r2 double")
    return dict(candidates[best]), table


@dataclass
class TreeModel:
    kind: str
    features: list[str]
    params: dict
    model: object

    def predict(self, df: DataFrame, out: str = "pred") -> DataFrame:
        res = self.model.transform(assemble(df, self.features))
        if out != "pred":
            res = res.withColumnRenamed("pred", out)
        return res.drop(VEC)

    def impurity_importance(self, spark) -> DataFrame:
        """Normalised impurity importances (sum to 1), descending."""
        imp = self.model.featureImportances.toArray()
        rows = [(f, float(v)) for f, v in zip(self.features, imp)]
        return spark.createDataFrame(rows, "feature string, importance double").orderBy(F.col("importance").desc(),
                                                                                       "feature")


def fit(df: DataFrame, features: list[str], kind: str, params: dict, *, label: str = "target",
        seed: int = 42) -> TreeModel:
    model = estimator(kind, dict(params), label=label, seed=seed).fit(assemble(df, features))
    return TreeModel(kind, list(features), dict(params), model)


def tuned(df, features, kind, space, folds, *, random_draws: int | None = None, label="target", seed=42):
    """Search then refit the best candidate on all rows of ``df``."""
    cands = sample_grid(space, random_draws, seed) if random_draws else grid(space)
    best, table = cross_validate(df, features, kind, cands, folds, label=label, seed=seed)
    return fit(df, features, kind, best, label=label, seed=seed), table


def rf_final(df: DataFrame, features: list[str], *, label: str = "target") -> TreeModel:
    """R6."""
    return fit(df, features, "forest", RF_FINAL, label=label, seed=42)


def fold_metrics(df: DataFrame, features: list[str], kind: str, params: dict, folds, *, label: str = "target",
                 seed: int = 42) -> DataFrame:
    """Refit per fold; MAE / RMSE / R^2 per fold plus mean and population std rows."""
    _, table = cross_validate(df, features, kind, [params], folds, label=label, seed=seed)
    per = table.select(F.col("fold").cast("string").alias("fold"), "mae", "rmse", "r2")
    summary = table.agg(*[F.avg(c).alias(c) for c in ("mae", "rmse", "r2")]).select(F.lit("mean").alias("fold"), "*")
    spread = table.agg(*[F.stddev_pop(c).alias(c) for c in ("mae", "rmse", "r2")]).select(F.lit("std").alias("fold"),
                                                                                         "*")
    return per.unionByName(summary).unionByName(spread)


def _coprime_multiplier(n: int, rng: random.Random) -> int:
    if n <= 2:
        return 1
    while True:
        a = rng.randrange(max(2, n // 3), max(3, 2 * n // 3 + 1))
        if math.gcd(a, n) == 1:
            return a


def permuted_index(a: str, i: str, b: str, n: int):
    """(a * i + b) mod n without overflow."""
    wide = [F.col(c).cast("decimal(19,0)") for c in (a, i, b)]
    return F.pmod(wide[0] * wide[1] + wide[2], F.lit(max(n, 1)).cast("decimal(19,0)")).cast("long")


def permutation_importance(model: TreeModel, df: DataFrame, *, label: str = "target", keys: list[str],
                           n_repeats: int = 5, seed: int = 42, scoring: str = "r2") -> DataFrame:
    """Score drop when one feature's values are permuted across the rows.

    The rows get a dense index once; each repeat's permutation is the bijection
    i -> (a * i + b) mod n with a coprime to n (a, b seeded), shared by all features, so the
    permuted value of row i is row ((a * i + b) mod n)'s value: one equi-join on the index
    per repeat, no sort and no group. Features fan out after the join, so the
    shuffle carries one copy of the rows for each repeat. The index arithmetic is DECIMAL(38):
    a * i passes the range of LONG beyond some 3e9 rows. All variants are scored in one
    table and one ``groupBy``.  (Permutations are pseudo-random bijections, not numpy's
    generator; importances agree in distribution, not digit for digit.)
    """
    feats = model.features
    base = dense_index(df.select(*keys, *feats, label), keys, out="_i")
    n = base.count()
    rng = random.Random(seed)
    repeats = F.array(*[F.struct(F.lit(r).alias("_repeat"), F.lit(_coprime_multiplier(n, rng)).cast("long").alias("_a"),
                                 F.lit(rng.randrange(n) if n else 0).cast("long").alias("_b")) for r in range(n_repeats)])
    expanded = base.select("*", F.explode(repeats).alias("_v")).select(
        "*", "_v._repeat", permuted_index("_v._a", "_i", "_v._b", n).alias("_src")).drop("_v")
    donors = base.select(F.col("_i").alias("_src"), *[F.col(f).alias(f"_d_{f}") for f in feats])
    joined = expanded.join(donors, "_src").withColumn("_feature", F.explode(F.array(*[F.lit(f) for f in feats])))
    permuted = joined.select(
        "_feature", "_repeat", F.col(label),
        *[F.when(F.col("_feature") == F.lit(f), F.col(f"_d_{f}")).otherwise(F.col(f)).alias(f) for f in feats])
    scored = model.predict(permuted)
    metric = "mae" if scoring == "mae" else "r2"
    per = scored.groupBy("_feature", "_repeat").agg(
        *regression_metric_columns(label, "pred", digits=None, with_mape=False))
    ref = _score(model.predict(base), label)[metric]
    drop = (F.lit(ref) - F.col(metric)) if metric == "r2" else (F.col(metric) - F.lit(ref))
    return (per.select(F.col("_feature").alias("feature"), drop.alias("d"))
            .groupBy("feature").agg(F.avg("d").alias("importance_mean"), F.stddev_pop("d").alias("importance_std"))
            .orderBy(F.col("importance_mean").desc(), "feature"))
