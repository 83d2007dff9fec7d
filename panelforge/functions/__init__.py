"""Column-expression helpers: all built-in Spark expressions, no Python UDFs."""

from panelforge.functions.periods import month_ordinal, ordinal_to_period, yyyymm
from panelforge.functions.safe import nan_to_null, safe_div, rounded
from panelforge.functions.metrics import regression_metric_columns
from panelforge.functions.joins import one_row

__all__ = [
    "month_ordinal", "ordinal_to_period", "yyyymm", "nan_to_null", "safe_div", "rounded",
    "regression_metric_columns", "one_row",
]
