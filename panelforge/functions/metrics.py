"""Aggregate expressions for regression metrics (M1), usable in any ``groupBy``.

R^2 = 1 - SSE / SST with SST = n * var_pop(y) (numerically stable merge), and
the scikit-learn convention for constant y: 1 if SSE == 0 else 0.
MAPE averages |e / y| over rows with y != 0; NULL when there are none.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def regression_metric_columns(y: str = "actual", yhat: str = "pred", *, digits: int | None = 6,
                              with_mape: bool = True, prefix: str = "") -> list[Column]:
    e = F.col(y) - F.col(yhat)
    sse = F.sum(e * e)
    sst = F.var_pop(F.col(y)) * F.count(F.col(y))
    r2 = (F.when(sst > 0, F.lit(1.0) - sse / sst)
          .when(sse == 0, F.lit(1.0)).otherwise(F.lit(0.0)))
    cols = {
        "mae": F.avg(F.abs(e)),
        "rmse": F.sqrt(F.avg(e * e)),
        "r2": r2,
    }
    if with_mape:
        cols["mape"] = F.avg(F.when(F.col(y) != 0, F.abs(e / F.col(y)))) * 100
    out = []
    for name, c in cols.items():
        c = c.cast("double")
        if digits is not None:
            c = F.round(c, digits)
        out.append(c.alias(prefix + name))
    return out
