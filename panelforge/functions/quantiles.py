"""Exact quantiles with linear interpolation (numpy / pandas / DuckDB ``quantile_cont``)
without gathering values anywhere.

Spark's exact ``percentile`` keeps a value->count map of the whole column in the
final aggregation task.  Here every rank that is asked for is narrowed to one value:

* one ``groupBy(key)`` gives, per key, the non-missing count, the number of -inf /
  +inf values and the finite min / max (the first bracket of each rank);
* each round is ONE job: the rows join the open brackets of their key, fall into one of
  1,026 buckets (the bracket's two ends alone, 1,024 between them) and a
  ``groupBy(bracket, bucket)`` returns count, min and max.  The bucket is monotonic
  in the value, so the bucket that holds a rank holds exactly the values between
  its min and max: the next bracket.

A bracket is done when its ends are equal.  Both ends leave it in every round, so the search
ends for any distribution, whatever its size.  Buckets are equally wide in even rounds; in odd rounds
they are equally wide on a signed logarithm until the bracket lies within one
octave, which bounds the rounds for heavy tails.  At most brackets x 1,026 rows of
counts reach the driver in a round, and nothing else does.
"""

from __future__ import annotations

import math

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKETS = 1024
INF = float("inf")


def exact_quantiles(df: DataFrame, cols: list[str], prob) -> dict:
    """Linear-interpolation quantile(s) of each column's non-missing values (NULL and NaN are missing).

    ``prob`` a float -> {column: value}; a list of floats -> {column: {prob: value}}.
    An all-missing column gives None."""
    if not cols:
        return {}
    probs = list(prob) if isinstance(prob, (list, tuple)) else [prob]
    cells = F.array(*[F.struct(F.lit(i).alias("k"), F.col(c).cast("double").alias("x")) for i, c in enumerate(cols)])
    found = group_quantiles(df.select(F.explode(cells).alias("e")).select("e.k", "e.x"), "k", "x", probs)
    out = {c: found.get(i) for i, c in enumerate(cols)}
    if isinstance(prob, (list, tuple)):
        return out
    return {c: (None if v is None else v[probs[0]]) for c, v in out.items()}


def group_quantiles(df: DataFrame, key: str, value: str, probs: list[float]) -> dict:
    """{key: {prob: quantile}} over a long table, one entry per key (a NULL key is a key);
    None for a key without values."""
    spark = df.sparkSession
    rows = df.select(F.col(key).alias("k"), F.col(value).cast("double").alias("x"))
    rows = rows.withColumn("x", F.when(~F.isnan("x"), F.col("x")))
    finite = F.when(F.abs("x") != INF, F.col("x"))
    stats = rows.groupBy("k").agg(
        F.count("x").alias("n"), F.count(F.when(F.col("x") == -INF, 1)).alias("low"), F.count(F.when(F.col("x") == INF, 1)).alias("high"),
        F.min(finite).alias("lo"), F.max(finite).alias("hi")).collect()
    key_type = rows.schema["k"].dataType.simpleString()
    inside = rows.where(finite.isNotNull())

    n_of = {s["k"]: s["n"] for s in stats}
    values: dict = {}   # (key, rank) -> value
    open_: dict = {}    # (key, rank) -> (lo, hi, rank within the bracket)
    for s in stats:
        for r in {r for p in probs for r in _ranks(p, s["n"])}:
            if r < s["low"]:
                values[s["k"], r] = -INF
            elif r >= s["n"] - s["high"]:
                values[s["k"], r] = INF
            else:
                open_[s["k"], r] = (s["lo"], s["hi"], r - s["low"])

    step = 0
    while True:
        for t in [t for t, (lo, hi, _) in open_.items() if lo == hi]:
            values[t] = open_.pop(t)[0]
        if not open_:
            break
        spans = sorted({(k, lo, hi) for (k, _), (lo, hi, _) in open_.items()}, key=lambda s: (str(s[0]), s[1], s[2]))
        at = {s: i for i, s in enumerate(spans)}
        table = pa.table({"bk": [k for k, _, _ in spans], "bid": pa.array(range(len(spans)), pa.int32()),
                          "lo": [lo for _, lo, _ in spans], "hi": [hi for _, _, hi in spans],
                          "by_log": [step % 2 == 1 and not _one_octave(lo, hi) for _, lo, hi in spans]})
        brackets = spark.createDataFrame(table).withColumn("bk", F.col("bk").cast(key_type))
        met = inside.join(F.broadcast(brackets), F.col("k").eqNullSafe(F.col("bk")) & F.col("x").between(F.col("lo"), F.col("hi")))
        counts = (met.select("bid", _bucket().alias("b"), "x").groupBy("bid", "b")
                  .agg(F.count(F.lit(1)).alias("c"), F.min("x").alias("mn"), F.max("x").alias("mx")).collect())
        per: dict[int, list] = {}
        for r in sorted(counts, key=lambda r: (r["bid"], r["b"])):
            per.setdefault(r["bid"], []).append(r)
        for (k, rank), (lo, hi, within) in list(open_.items()):
            for r in per[at[k, lo, hi]]:
                if within < r["c"]:
                    open_[k, rank] = (r["mn"], r["mx"], within)
                    break
                within -= r["c"]
        step += 1

    out: dict = {}
    for k, n in n_of.items():
        out[k] = {} if n else None
        for p in probs if n else ():
            ranks = _ranks(p, n)
            v = values[k, ranks[0]]
            out[k][p] = v if len(ranks) == 1 else v + (p * (n - 1) - ranks[0]) * (values[k, ranks[1]] - v)
    return out


def _ranks(p: float, n: int) -> list[int]:
    if not n:
        return []
    h = p * (n - 1)
    k = int(math.floor(h))
    return [k] if h == k or k + 1 >= n else [k, k + 1]


def _one_octave(lo: float, hi: float) -> bool:
    small, large = sorted((abs(lo), abs(hi)))
    return lo * hi > 0 and large / 2 <= small


def _bucket() -> Column:
    """0 and BUCKETS + 1 for the bracket's ends, 1..BUCKETS between them; monotonic in x."""
    x, lo, hi = F.col("x"), F.col("lo"), F.col("hi")

    def log(c: Column) -> Column:  # ln of the smallest double is about -745
        return F.when(c == 0, F.lit(0.0)).otherwise(F.signum(c) * (F.log(F.abs(c)) + 750.0))

    def share(at: Column, low: Column, high: Column) -> Column:
        return F.when(high > low, (at - low) / F.when(high > low, high - low)).otherwise(F.lit(0.0))

    part = F.when(F.col("by_log"), share(log(x), log(lo), log(hi))).otherwise(share(x / 2, lo / 2, hi / 2))
    middle = F.least(F.lit(BUCKETS), F.floor(part * BUCKETS).cast("int") + 1)
    return F.when(x == lo, F.lit(0)).when(x == hi, F.lit(BUCKETS + 1)).otherwise(middle)
