"""Registered queries: name -> (spark, sf_dir) -> DataFrame, and their DuckDB oracles.

Every query reads the driver's tables (through the panels) and runs over them
whole.  Oracles are written from the operator definitions.  Queries without an
honest SQL form (iterative fits, random draws) have no oracle and are checked by
invariant tests in ``tests/``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}
# Tree-model searches: many small Spark ML fits (boosting pays a fixed job cost per
# iteration), so at tiny scale factors they dominate wall time.  Listed last.
SLOW = ("decision_tree_cv", "rf_random_search", "random_forest_cv", "gradient_boosting_cv",
        "hist_gradient_boosting", "forecasting_comparison", "explanatory_comparison")


def ordered_queries() -> dict:
    fast = {k: v for k, v in QUERIES.items() if k not in SLOW}
    return {**fast, **{k: QUERIES[k] for k in SLOW if k in QUERIES}}


def register(name: str, oracle: str | None = None):
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if oracle is not None:
            ORACLE[name] = oracle
        return fn
    return deco


def load_all() -> None:
    """Import the modules that register queries."""
    from panelforge.plans import (  # noqa: F401
        q_core, q_validate, q_diagnostics, q_evaluation, q_models, q_streaming, q_runs,
    )
