"""Run clock: every date bound a daily reload needs, resolved once.

``as_of`` is the run's "today" and ``etl_date`` the calendar id of the extract
(by contract ``as_of - 1``).  Both are explicit; nothing reads the wall clock.

Rules
-----
* window end   = as_of - 2 on day 1-2 of a month (grace rule), else as_of - 1
* anchor       = month start of (as_of - 2): first day of the *open* month
* window start = anchor - 1 month: first day of the *closed* month
* plan end     = as_of - 2 on day 1-2, else last day of the month of as_of - 1
* month end    = last day of the month of the window end
* expiration   = calendar row at month start of (extract - 1 day - 1 month);
  the reload deletes target rows with ``period >= expiration_id``
* goal end id  = extract_id - 1 on day 1-2, else extract_id (integer bound on
  the day key; ``YYYYMM01 - 1`` is a valid bound though not a date)

``RunClock`` folds these into driver-side literals (one tiny calendar lookup);
``clock_columns`` states the same rules as Column expressions so a whole table
of ``as_of`` days can be resolved in one distributed pass.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybook.functions.dates import add_months, day_key, last_day, month_start

ONE = dt.timedelta(days=1)


def _grace(as_of: dt.date) -> bool:
    return as_of.day <= 2


@dataclass(frozen=True)
class RunClock:
    as_of: dt.date
    extract_date: dt.date
    extract_id: int
    expiration_date: dt.date
    expiration_id: int
    start: dt.date
    anchor: dt.date
    end: dt.date
    plan_end: dt.date
    month_end: dt.date
    goal_end_id: int

    # -- construction -----------------------------------------------------
    @classmethod
    def from_dates(cls, as_of: dt.date, etl_date: dt.date | None = None) -> "RunClock":
        """Resolve without a calendar table (ids are yyyymmdd day keys)."""
        extract = etl_date if etl_date is not None else as_of - ONE
        expiration = month_start(add_months(extract - ONE, -1))
        return cls._build(as_of, extract, day_key(extract), expiration, day_key(expiration))

    @classmethod
    def resolve(cls, calendar: DataFrame, etl_date_id: int, as_of: dt.date) -> "RunClock":
        """Resolve against a calendar dimension ``(CALENDAR_DATE_ID, CALENDAR_DATE)``.

        Raises when either calendar row is missing: the silent alternative is a
        reload that deletes nothing and inserts nothing.
        """
        extract_rows = (
            calendar.where(F.col("CALENDAR_DATE_ID") == F.lit(etl_date_id))
            .select("CALENDAR_DATE").limit(2).collect()
        )
        if len(extract_rows) != 1:
            raise ValueError(f"etl date id {etl_date_id}: {len(extract_rows)} calendar rows, expected 1")
        extract = extract_rows[0][0]
        expiration = month_start(add_months(extract - ONE, -1))
        exp_rows = (
            calendar.where(F.col("CALENDAR_DATE") == F.lit(expiration))
            .select("CALENDAR_DATE_ID").limit(2).collect()
        )
        if len(exp_rows) != 1:
            raise ValueError(f"expiration date {expiration}: {len(exp_rows)} calendar rows, expected 1")
        return cls._build(as_of, extract, etl_date_id, expiration, exp_rows[0][0])

    @classmethod
    def _build(cls, as_of, extract, extract_id, expiration, expiration_id) -> "RunClock":
        grace = _grace(as_of)
        end = as_of - 2 * ONE if grace else as_of - ONE
        anchor = month_start(as_of - 2 * ONE)
        return cls(
            as_of=as_of,
            extract_date=extract,
            extract_id=int(extract_id),
            expiration_date=expiration,
            expiration_id=int(expiration_id),
            start=add_months(anchor, -1),
            anchor=anchor,
            end=end,
            plan_end=as_of - 2 * ONE if grace else last_day(as_of - ONE),
            month_end=last_day(end),
            goal_end_id=int(extract_id) - 1 if grace else int(extract_id),
        )

    # -- integer day-key views --------------------------------------------
    @property
    def start_id(self) -> int:
        return day_key(self.start)

    @property
    def end_id(self) -> int:
        return day_key(self.end)

    @property
    def anchor_id(self) -> int:
        return day_key(self.anchor)

    @property
    def plan_end_id(self) -> int:
        return day_key(self.plan_end)

    @property
    def month_end_id(self) -> int:
        return day_key(self.month_end)

    @property
    def lag_cutoff(self) -> dt.date:
        """Open-month days strictly before this are complete (one-day lag)."""
        return self.as_of - ONE

    def last_year_ranges(self) -> list[tuple[int, int]]:
        """History key ranges the last-year join can touch (two disjoint spans)."""
        spans = []
        if self.start < self.anchor:
            spans.append((day_key(add_months(self.start, -12)),
                          day_key(add_months(self.anchor - ONE, -12))))
        if self.anchor <= self.end:
            spans.append((day_key(self.anchor - 364 * ONE), day_key(self.end - 364 * ONE)))
        return spans


def clock_columns(as_of: Column) -> dict[str, Column]:
    """The date rules as Column expressions over an ``as_of`` date column."""
    grace = F.dayofmonth(as_of) <= 2
    end = F.when(grace, F.date_sub(as_of, 2)).otherwise(F.date_sub(as_of, 1))
    anchor = F.trunc(F.date_sub(as_of, 2), "MM")
    return {
        "WINDOW_START": F.add_months(anchor, -1),
        "ANCHOR": anchor,
        "WINDOW_END": end,
        "PLAN_END": F.when(grace, F.date_sub(as_of, 2)).otherwise(F.last_day(F.date_sub(as_of, 1))),
        "MONTH_END": F.last_day(end),
    }


def expiration_of(extract_date: Column) -> Column:
    """Month start of (extract - 1 day - 1 month)."""
    return F.trunc(F.add_months(F.date_sub(extract_date, 1), -1), "MM")


def goal_end_id(as_of: Column, extract_id: Column) -> Column:
    return F.when(F.dayofmonth(as_of) <= 2, extract_id - 1).otherwise(extract_id)
