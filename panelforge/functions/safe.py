"""NULL-safe arithmetic.  NaN is turned into NULL once at the scan and never created again."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def nan_to_null(col) -> Column:
    c = _c(col)
    return F.when(F.isnan(c), F.lit(None).cast("double")).otherwise(c)


def safe_div(num, den) -> Column:
    """num / den, NULL when den is 0 or NULL (never NaN / inf)."""
    n, d = _c(num), _c(den)
    return F.when(d != 0, n / d)


def rounded(col, digits: int = 6) -> Column:
    return F.round(_c(col).cast("double"), digits)
