"""Two-regime year-over-year alignment.

Closed month (day < anchor): last year is the same calendar date
(``add_months(day, -12)``; 28 and 29 Feb both read 28 Feb).  Open month
(day >= anchor): last year is the same weekday (``day - 364``).

Instead of two joins unioned, one left join on a conditional key: the two
regimes are disjoint by construction, so the result is identical and the
history side is shuffled once.  History is read only on the two key ranges
the key can reach, as literal ``PERIOD`` ranges that prune partitions and
push to the scan.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybook.functions.dates import yyyymmdd
from daybook.operators.window import period_in_ranges

LY_KEY = "_LY_PERIOD"


def calendar_key(day: Column) -> Column:
    return F.add_months(day, -12)


def weekday_key(day: Column) -> Column:
    return F.date_sub(day, 364)


def last_year_key(day: Column, anchor: dt.date) -> Column:
    return F.when(day < F.lit(anchor), calendar_key(day)).otherwise(weekday_key(day))


def with_last_year(
    df: DataFrame,
    history: DataFrame,
    columns: dict[str, str],
    key: Column,
    ranges: list[tuple[int, int]] | None = None,
    keys: tuple[str, ...] = ("CENTER",),
) -> DataFrame:
    """Left-join ``history`` columns onto ``df`` at the last-year day ``key``.

    ``columns`` maps output name -> history column.  ``ranges`` (day-key
    spans) restricts the history read; pass ``RunClock.last_year_ranges()``.
    """
    hist = history
    if ranges:
        hist = hist.where(period_in_ranges(hist, ranges))
    hist = hist.selectExpr(*[f"`{k}`" for k in keys], f"CAST(PERIOD AS INT) AS {LY_KEY}",
                           *[f"`{src}` AS `{dst}`" for dst, src in columns.items()])
    keyed = df.withColumn(LY_KEY, yyyymmdd(key))
    return keyed.join(hist, [*keys, LY_KEY], "left").drop(LY_KEY)


def with_last_year_two_regime(df, history, columns, clock, day_col: str = "DAY") -> DataFrame:
    return with_last_year(df, history, columns, last_year_key(F.col(day_col), clock.anchor),
                          ranges=clock.last_year_ranges())
