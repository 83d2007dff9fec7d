"""Integer YYYYMM periods."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def yyyymm(ts) -> Column:
    """YYYYMM of a date / timestamp column as INT."""
    c = _c(ts)
    return (F.year(c) * 100 + F.month(c)).cast("int")


def month_ordinal(period) -> Column:
    """YYYYMM -> year * 12 + month, in integer arithmetic (``div``, not ``/``)."""
    p = _c(period).cast("int")
    return (F.floor(p / 100).cast("int") * 12 + p % 100).cast("int")


def ordinal_to_period(ordinal) -> Column:
    """Inverse of :func:`month_ordinal`."""
    o = _c(ordinal).cast("int") - 1
    return (F.floor(o / 12).cast("int") * 100 + o % 12 + 1).cast("int")
