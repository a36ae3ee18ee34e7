"""As-of date windows and local display time."""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def shift(asof: date | datetime, n: int, unit: str) -> date | datetime:
    """``asof`` moved back by n units; month steps clamp to the end of the month."""
    if unit == "hour":
        return asof - timedelta(hours=n)
    if unit == "day":
        return asof - timedelta(days=n)
    if unit == "month":
        month = asof.year * 12 + asof.month - 1 - n
        year, month0 = divmod(month, 12)
        last = (date(year + (month0 == 11), (month0 + 1) % 12 + 1, 1) - timedelta(days=1)).day
        return asof.replace(year=year, month=month0 + 1, day=min(asof.day, last))
    if unit == "year":
        return shift(asof, 12 * n, "month")
    raise ValueError(f"unknown unit {unit}")


def trailing(col: Column | str, n: int, unit: str, asof: date | datetime) -> Column:
    """Rows at or after ``asof`` minus n units. The bound is a literal, so it pushes down."""
    target = F.col(col) if isinstance(col, str) else col
    return target >= F.lit(shift(asof, n, unit))


def sk_of(day: date) -> int:
    return day.year * 10000 + day.month * 100 + day.day


def trailing_sk(col: str, n: int, unit: str, asof: date) -> Column:
    """The same window on a ``yyyyMMdd`` key."""
    return F.col(col) >= F.lit(sk_of(shift(asof, n, unit)))


def since_year_sk(col: str, year: int) -> Column:
    return F.col(col) >= F.lit(year * 10000 + 101)


def in_year_sk(col: str, year: int) -> Column:
    return F.col(col).between(year * 10000 + 101, year * 10000 + 1231)


MONTH = "month_sk"


def month_of(sk: Column | str) -> Column:
    """``yyyyMM`` of a ``yyyyMMdd`` key: the partition column of the Gold facts."""
    key = F.col(sk) if isinstance(sk, str) else sk
    return F.floor(key / 100).cast("int")


def in_days(df: DataFrame, col: str, lo: date, hi: date | None = None) -> DataFrame:
    """Rows whose ``yyyyMMdd`` key lies in the days ``lo`` to ``hi``, or from ``lo`` on.

    The bounds are literals. In a table partitioned by the key's month they name its partitions too, so
    the scan opens only those.
    """
    held = F.col(col) >= sk_of(lo)
    months = F.col(MONTH) >= sk_of(lo) // 100
    if hi is not None:
        held, months = held & (F.col(col) <= sk_of(hi)), months & (F.col(MONTH) <= sk_of(hi) // 100)
    return df.where(held & months if MONTH in df.columns else held)


def trailing_days(df: DataFrame, col: str, n: int, unit: str, asof: date) -> DataFrame:
    return in_days(df, col, shift(asof, n, unit))


def in_year(df: DataFrame, col: str, year: int) -> DataFrame:
    return in_days(df, col, date(year, 1, 1), date(year, 12, 31))


def to_local(col: Column | str, tz: str = "Africa/Cairo") -> Column:
    """UTC instant as wall-clock time of ``tz`` for display."""
    return F.from_utc_timestamp(col, tz)
