"""Production parameters that queries and the pipeline share."""

from __future__ import annotations

from pyspark.sql import functions as F

#: target weights of the mix, level by level; a category without a weight has weight 1
MIX_WEIGHTS = [{"d0": 0.4, "d1": 0.3, "d2": 0.2, "d3": 0.1}, {"en": 0.4, "de": 0.2, "fr": 0.2, "es": 0.2}, {}]


def mixing_tree():
    """The tree of the mix: four domains of sources, languages, sources."""
    number = F.coalesce(F.regexp_extract("source", "([0-9]+)$", 1).try_cast("int"), F.lit(0))
    return {"domain": F.concat(F.lit("d"), F.pmod(number, F.lit(4)).cast("string")), "language": F.col("lang"), "origin": F.col("source")}
