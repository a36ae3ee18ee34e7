"""Exact decimal averages, ratios and counts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def count_where(cond: Column) -> Column:
    return F.count(F.when(cond, F.lit(1)))


def sum_where(cond: Column, value: Column | str) -> Column:
    return F.coalesce(F.sum(F.when(cond, _col(value))), F.lit(0))


def pct(num: Column, den: Column, kind: str = "decimal(5,2)") -> Column:
    """100 * num / den, NULL on an empty denominator."""
    scaled = num.cast("decimal(30,2)") * F.lit(100)
    return F.try_divide(scaled, den.cast("decimal(30,2)")).cast(kind)


def ratio(num: Column, den: Column, kind: str = "decimal(9,4)") -> Column:
    return F.try_divide(num.cast("decimal(30,2)"), den.cast("decimal(30,2)")).cast(kind)


def mean(value: Column | str, kind: str) -> Column:
    """sum / count in decimal arithmetic: the result does not depend on row order."""
    v = _col(value)
    return F.try_divide(F.sum(v), F.count(v).cast("decimal(20,0)")).cast(kind)


def money(value: Column | str) -> Column:
    return F.sum(_col(value)).cast("decimal(14,2)")


def rows() -> Column:
    return F.count(F.lit(1))
