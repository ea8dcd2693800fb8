"""Date helpers: integer yyyymmdd keys, US week numbers, month keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def date_from_key(c) -> Column:
    """yyyymmdd integer -> DATE; invalid keys -> NULL (ANSI-safe)."""
    return F.try_to_date(_col(c).cast("string"), "yyyyMMdd")


def date_key(c) -> Column:
    """DATE -> yyyymmdd integer."""
    d = _col(c)
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def month_key(c) -> Column:
    """DATE -> yyyymm integer."""
    d = _col(c)
    return (F.year(d) * 100 + F.month(d)).cast("int")


def us_week_of_year(c) -> Column:
    """Week number with weeks starting Sunday and Jan 1 always in week 1.

    Not ISO ``weekofyear``: 2017-01-01 is week 1 here, 52 in ISO.
    """
    d = _col(c)
    jan1_dow = F.dayofweek(F.trunc(d, "year"))  # Sunday = 1
    return (F.floor((F.dayofyear(d) + jan1_dow - 2) / 7) + 1).cast("int")
