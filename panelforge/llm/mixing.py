"""Mixing sources to target weights by hierarchical budgeting.

Documents hang in a tree of levels (domain, language, source). A token budget is handed down:
the children of a node share its budget by their weights, but none gets more than its subtree
holds (tokens times ``max_epochs``). What a child can't take goes to its siblings, by their weights;
only what a whole subtree can't take goes to the siblings one level up. At each node this is
water filling: with children ordered by capacity / weight, a child is full while that ratio is at
most the level that the rest could be filled to. Windows run over nodes of the tree, whose
number depends on the categories, never over documents.

A leaf takes its documents in seeded epochs: in epoch e documents are ordered by
md5(seed:e:doc_id), whole epochs first, then the prefix of the next epoch whose total is nearest to what is left of the budget.
For the prefix each leaf's order is cut into 4096 buckets (the first three hex digits);
totals of buckets tell which lie before the cut, and only documents of the one bucket that
holds it are put in order, so a leaf with a third of all rows is never sorted in one task.

Defined results: null text counts as empty; documents without words need no budget, so they
are in the prefix if they come before its end; null categories are a category of their own; nodes without a weight
share with weight 1; a weight of 0 or less gets nothing; rows that repeat an id, a text and a leaf share
their place (all or none); an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelforge.llm.common import materialize, shield, ship, slices, text_bytes

NONE = "∅"  # the category of nulls
DIGITS = 3
SALT = 16  # a hot leaf's documents find its budget in so many places


def count_words(docs: DataFrame, id_col: str, text_col: str, levels: Mapping[str, Column]) -> DataFrame:
    """id, tk (hash of the text), one column l0, l1, .. per level, n_tokens (words)."""
    ship(docs.sparkSession)
    names = [f"l{i}" for i in range(len(levels))]
    src = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.xxhash64(text_col).alias("tk"),
                      *[F.coalesce(c.cast("string"), F.lit(NONE)).alias(n) for c, n in zip(levels.values(), names)])

    def run(batches):
        for batch in slices(batches):
            sizes = [len(t.split()) for t in text_bytes(batch.column(1))]
            yield pa.RecordBatch.from_arrays([batch.column(0), *batch.columns[2:], pa.array(sizes, pa.int64())], names=["id", "tk", *names, "n_tokens"])

    kind = src.schema["id"].dataType.simpleString()
    return src.mapInArrow(run, f"id {kind}, tk long, " + ", ".join(f"{n} string" for n in names) + ", n_tokens long")


def allocate(leaves: DataFrame, names: Sequence[str], budget: float, weights: Sequence[Mapping[str, float]], max_epochs: int) -> DataFrame:
    """(names.., tokens) -> (names.., tokens, budget): budgets handed down level by level."""
    barred = F.lit(False)  # below a weight of 0: no capacity at any level
    for name, given in zip(names, weights):
        for key in (k for k, w in given.items() if w <= 0):
            barred = barred | (F.col(name) == key)
    nodes = leaves.groupBy(*names).agg(F.sum("tokens").alias("tokens")).withColumn("cap", F.when(barred, 0.0).otherwise(F.col("tokens").cast("double") * max_epochs))
    share = None
    for depth, name in enumerate(names):
        parent, path = list(names[:depth]), list(names[:depth + 1])
        given = F.lit(1.0)
        for key, w in sorted(weights[depth].items()):
            given = F.when(F.col(name) == key, F.lit(float(w))).otherwise(given)
        level = nodes.groupBy(*path).agg(F.sum("cap").alias("cap")).withColumn("w", F.greatest(given, F.lit(0.0))).where("w > 0 and cap > 0")
        level = level.withColumn("budget", F.lit(float(budget))) if share is None else level.join(share, parent)
        order = [(F.col("cap") / F.col("w")), F.col(name)]
        above = Window.partitionBy(*(parent or [F.lit(0)])).orderBy(*order)  # children of one node
        full = level.select("*", F.coalesce(F.sum("cap").over(above.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)).alias("caps_before"),
                            F.sum("w").over(above.rowsBetween(0, Window.unboundedFollowing)).alias("w_left"))
        full = full.withColumn("line", (F.col("budget") - F.col("caps_before")) / F.col("w_left")).withColumn("is_full", F.col("cap") / F.col("w") <= F.col("line"))
        water = F.min(F.when(~F.col("is_full"), F.struct(F.col("cap") / F.col("w"), F.col(name), F.col("line").alias("line")))).over(Window.partitionBy(*(parent or [F.lit(0)])))
        share = full.select(*path, F.when(F.col("is_full"), F.col("cap")).otherwise(F.col("w") * F.greatest(water["line"], F.lit(0.0))).alias("budget"))
    return nodes.join(share, list(names), "left").select(*names, "tokens", F.coalesce("budget", F.lit(0.0)).alias("budget"))


def mix(docs: DataFrame, levels: Mapping[str, Column], budget_share: float = 0.5, weights: Sequence[Mapping[str, float]] | None = None,
        max_epochs: int = 2, seed: str = "mix-1", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, tk, the levels, n_tokens, leaf_tokens, leaf_budget, copies (0: not taken).

    budget_share: the budget as a share of all tokens."""
    names = [f"l{i}" for i in range(len(levels))]
    weights = weights or [{}] * len(names)
    counted = materialize(count_words(docs, id_col, text_col, levels), "counted")
    leaves = materialize(counted.groupBy(*names).agg(F.sum("n_tokens").alias("tokens")), "leaves")
    total = leaves.agg(F.coalesce(F.sum("tokens"), F.lit(0))).first()[0]
    budgets = allocate(leaves, names, total * budget_share, weights, max_epochs)
    plan = materialize(budgets.withColumn("whole", F.when(F.col("tokens") > 0, F.least(F.floor(F.round(F.col("budget") / F.col("tokens"), 9)), F.lit(max_epochs))).otherwise(0).cast("int"))
                       .withColumn("rest", F.greatest(F.round(F.col("budget") - F.col("whole") * F.col("tokens"), 6), F.lit(0.0))), "budgets")
    # the order of the epoch that is cut depends on the leaf's whole epochs; there are max_epochs possible orders
    marks = F.array(*[F.md5(F.concat_ws(":", F.lit(seed), F.lit(str(e)), F.coalesce(F.col("id").cast("string"), F.lit(NONE)))) for e in range(max_epochs + 1)])
    keys = counted.withColumn("marks", F.transform(marks, lambda m: F.substring(m, 1, DIGITS)))
    sums = (keys.groupBy(*names, *[F.col("marks")[e].alias(f"m{e}") for e in range(1)]).agg(F.sum("n_tokens").alias("s"))
            .select(*names, F.lit(0).alias("epoch"), F.col("m0").alias("bucket"), "s"))
    for e in range(1, max_epochs + 1):
        sums = sums.union(keys.groupBy(*names, F.col("marks")[e].alias("bucket")).agg(F.sum("n_tokens").alias("s")).select(*names, F.lit(e).alias("epoch"), "bucket", "s"))
    own = sums.join(plan.select(*names, "whole", "rest"), names).where("epoch = whole")
    over = Window.partitionBy(*names).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)  # at most 4096 rows a leaf
    buckets = own.withColumn("before", F.coalesce(F.sum("s").over(over), F.lit(0))).select(*names, "bucket", "whole", "rest", "before", "s")
    state = F.when(F.col("before") >= F.col("rest"), 0).when(F.col("before") + F.col("s") < F.col("rest"), 1).otherwise(2)  # out, in, cut here
    buckets = materialize(buckets.withColumn("state", state), "buckets")
    # join on leaf and bucket: a hot leaf is spread over its buckets
    placed = materialize(
        keys.withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(SALT)).cast("int"))
        .join(plan.select(*names, F.col("whole").alias("w"), "tokens", "budget", F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))).alias("salt")), [*names, "salt"])
        .withColumn("bucket", F.element_at("marks", F.col("w") + 1)).drop("marks")
        .join(buckets.select(*names, "bucket", "whole", "rest", "before", "state"), [*names, "bucket"], "left"), "placed")
    mark = F.md5(F.concat_ws(":", F.lit(seed), F.col("whole").cast("string"), F.coalesce(F.col("id").cast("string"), F.lit(NONE))))
    inside = Window.partitionBy(*names, "bucket").orderBy("mark", "n_tokens", "tk").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    same = Window.partitionBy(*names, "bucket", "mark", "n_tokens", "tk")
    cut = (placed.where("state = 2").withColumn("mark", mark)
           .withColumn("reached", F.col("before") + F.sum("n_tokens").over(inside) - F.sum("n_tokens").over(same))
           .withColumn("taken", (2 * F.col("reached") + F.col("n_tokens") < 2 * F.col("rest")).cast("int")).drop("mark", "reached"))
    rest = placed.where("state <> 2").withColumn("taken", (F.col("state") == 1).cast("int"))
    out = rest.unionByName(cut)
    return out.select(F.col("id").alias(id_col), "tk", *[F.col(n).alias(level) for n, level in zip(names, levels)], "n_tokens", F.col("tokens").alias("leaf_tokens"),
                      F.round("budget", 3).alias("leaf_budget"), F.least(F.col("w") + F.col("taken"), F.lit(max_epochs)).cast("long").alias("copies"))


def take(docs: DataFrame, levels: Mapping[str, Column], budget_share: float = 0.5, weights: Sequence[Mapping[str, float]] | None = None,
         max_epochs: int = 2, seed: str = "mix-1", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents that the mix takes, as often as it takes them, with their own columns, whatever their names."""
    names, columns = [f"__l{i}" for i in range(len(levels))], docs.columns
    docs, (id_col, text_col) = shield(docs, id_col, text_col, **{f"__v{i}": c for i, c in enumerate(levels.values())})
    levels = {k: F.col(f"__v{i}") for i, k in enumerate(levels)}
    plan = mix(docs, levels, budget_share, weights, max_epochs, seed, id_col, text_col).where("copies > 0")
    plan = plan.select(F.col(id_col).alias("__id"), F.coalesce("tk", F.lit(0)).alias("__tk"), *[F.col(k).alias(n) for k, n in zip(levels, names)], F.col("copies").alias("__copies")).distinct()
    keyed = docs.select("*", F.coalesce(F.xxhash64(text_col), F.lit(0)).alias("__tk"), *[F.coalesce(c.cast("string"), F.lit(NONE)).alias(n) for c, n in zip(levels.values(), names)])
    met = keyed.join(plan, keyed[id_col].eqNullSafe(plan["__id"]) & (keyed["__tk"] == plan["__tk"]) & _all(keyed[n] == plan[n] for n in names))
    out = met.select(*[keyed[f"own{i}"] for i in range(len(columns))], F.explode(F.sequence(F.lit(1), F.col("__copies").cast("int"))).alias("__copy"))
    return out.drop("__copy").toDF(*columns)


def _all(conditions) -> Column:
    out = None
    for c in conditions:
        out = c if out is None else out & c
    return out
