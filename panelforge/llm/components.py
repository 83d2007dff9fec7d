"""Connected components of an edge table, by alternating large-star and small-star steps.

Each step is a map-side minimum per node and one join on the node; a hub's edges are
summed up before they are shuffled and its join side can be split, as the other side has one row
per node. Every round is stored in the shared folder. Only two numbers per round reach
the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelforge.llm.common import materialize


def _state(edges: DataFrame) -> tuple:
    r = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
    return r["n"], r["h"]


def connected_components(edges: DataFrame) -> DataFrame:
    """(a, b) long, in any order and with repeats -> (node, root): every node's smallest reachable node."""
    now = materialize(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    state = _state(now)
    while state[0]:
        both = now.select(F.col("a").alias("u"), F.col("b").alias("v")).union(now.select(F.col("b").alias("u"), F.col("a").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").where("v <> m").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()
        first = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (large.join(first, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
                 .union(first.select("a", F.col("m").alias("b"))).distinct())
        now = materialize(small, "edges")
        after = _state(now)
        if after == state:
            break
        state = after
    roots = now.groupBy("a").agg(F.min("b").alias("root")).select(F.col("a").alias("node"), "root")
    return roots.union(roots.select(F.col("root").alias("node"), "root").distinct())
