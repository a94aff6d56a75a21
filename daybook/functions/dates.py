"""Day-key helpers.

Periods travel as ``int`` yyyymmdd keys (the partition key of every target
table); dates are derived only where date arithmetic is needed.  Comparing the
raw key with literals keeps filters pushable to the Parquet scan, while
``to_date(period)`` on the column side would not be.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def day_key(d: dt.date) -> int:
    """Python date -> yyyymmdd int (driver-side literal)."""
    return d.year * 10000 + d.month * 100 + d.day


def key_day(k: int) -> dt.date:
    return dt.date(k // 10000, (k // 100) % 100, k % 100)


def yyyymmdd(c: Column | str) -> Column:
    """Date/timestamp column -> yyyymmdd int column."""
    c = F.col(c) if isinstance(c, str) else c
    return (F.year(c) * 10000 + F.month(c) * 100 + F.dayofmonth(c)).cast("int")


def period_to_date(c: Column | str) -> Column:
    """yyyymmdd key (int or string) -> date."""
    c = F.col(c) if isinstance(c, str) else c
    return F.to_date(c.cast("string"), "yyyyMMdd")


def month_start(d: dt.date) -> dt.date:
    return d.replace(day=1)


def add_months(d: dt.date, n: int) -> dt.date:
    """Calendar month shift with end-of-month clamping (Spark ``add_months``)."""
    m = d.month - 1 + n
    y, m = d.year + m // 12, m % 12 + 1
    return dt.date(y, m, min(d.day, last_day(dt.date(y, m, 1)).day))


def last_day(d: dt.date) -> dt.date:
    nxt = dt.date(d.year + (d.month == 12), d.month % 12 + 1, 1)
    return nxt - dt.timedelta(days=1)
