"""Run clock: every day 2019-2025 against a plain-datetime statement of the rules."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from daybook.functions.clock import RunClock, clock_columns
from daybook.functions.dates import add_months, day_key, last_day

ONE = dt.timedelta(days=1)


def expected(as_of: dt.date) -> dict:
    grace = as_of.day <= 2
    end = as_of - 2 * ONE if grace else as_of - ONE
    two_back = as_of - 2 * ONE
    anchor = dt.date(two_back.year, two_back.month, 1)
    prev = anchor - ONE
    start = dt.date(prev.year, prev.month, 1)
    nxt = dt.date(end.year + (end.month == 12), end.month % 12 + 1, 1)
    plan_end = two_back if grace else dt.date((as_of - ONE).year + ((as_of - ONE).month == 12),
                                               (as_of - ONE).month % 12 + 1, 1) - ONE
    return {"start": start, "anchor": anchor, "end": end, "plan_end": plan_end, "month_end": nxt - ONE}


def all_days():
    d = dt.date(2019, 1, 1)
    while d <= dt.date(2025, 12, 31):
        yield d
        d += ONE


def test_clock_matches_rules_every_day():
    for as_of in all_days():
        c = RunClock.from_dates(as_of)
        exp = expected(as_of)
        assert (c.start, c.anchor, c.end, c.plan_end, c.month_end) == tuple(exp.values()), as_of
        # consistency under etl_date = as_of - 1: expiration == window start
        assert c.expiration_date == c.start, as_of
        # goal bound agrees with the window end (day 2: YYYYMM00 covers the previous month)
        if as_of.day != 2:
            assert c.goal_end_id == day_key(c.end)
        else:  # YYYYMM00: every day of the previous month, nothing of this one
            assert day_key(c.end) < c.goal_end_id < day_key(as_of.replace(day=1))
        assert c.start <= c.anchor <= c.end <= c.month_end


@pytest.mark.parametrize("as_of,anchor,start,end,plan_end", [
    ("2000-03-15", "2000-03-01", "2000-02-01", "2000-03-14", "2000-03-31"),
    ("2001-06-15", "2001-06-01", "2001-05-01", "2001-06-14", "2001-06-30"),
    ("2001-03-01", "2001-02-01", "2001-01-01", "2001-02-27", "2001-02-27"),
    ("2001-03-02", "2001-02-01", "2001-01-01", "2001-02-28", "2001-02-28"),
    ("2000-11-20", "2000-11-01", "2000-10-01", "2000-11-19", "2000-11-30"),
    ("2001-01-10", "2001-01-01", "2000-12-01", "2001-01-09", "2001-01-31"),
    ("2024-01-20", "2024-01-01", "2023-12-01", "2024-01-19", "2024-01-31"),
])
def test_clock_table(as_of, anchor, start, end, plan_end):
    c = RunClock.from_dates(dt.date.fromisoformat(as_of))
    assert (c.anchor, c.start, c.end, c.plan_end) == tuple(dt.date.fromisoformat(x) for x in (anchor, start, end, plan_end))


def test_etl_date_disagreement_on_day_two():
    # etl_date = as_of: the expiration moves one month later than the spine start
    c = RunClock.from_dates(dt.date(2001, 3, 2), etl_date=dt.date(2001, 3, 2))
    assert c.expiration_date == dt.date(2001, 2, 1) and c.start == dt.date(2001, 1, 1)


def test_last_year_ranges_leap():
    c = RunClock.from_dates(dt.date(2000, 3, 15))
    assert c.last_year_ranges() == [(19990201, 19990228), (19990303, 19990316)]


def test_column_clock_equals_driver_clock(spark):
    days = [dt.date(2019, 1, 1) + dt.timedelta(days=i) for i in range(0, 2557, 3)]
    df = spark.createDataFrame([(d,) for d in days], "AS_OF date")
    rows = df.select("AS_OF", *[v.alias(k) for k, v in clock_columns(F.col("AS_OF")).items()]).collect()
    for r in rows:
        c = RunClock.from_dates(r.AS_OF)
        assert (r.WINDOW_START, r.ANCHOR, r.WINDOW_END, r.PLAN_END, r.MONTH_END) == \
               (c.start, c.anchor, c.end, c.plan_end, c.month_end)


def test_resolve_uses_calendar_and_raises_when_missing(spark):
    cal = spark.createDataFrame([(20000314, dt.date(2000, 3, 14)), (20000201, dt.date(2000, 2, 1))],
                                "CALENDAR_DATE_ID int, CALENDAR_DATE date")
    c = RunClock.resolve(cal, 20000314, dt.date(2000, 3, 15))
    assert c.expiration_id == 20000201 and c.extract_id == 20000314
    with pytest.raises(ValueError):
        RunClock.resolve(cal, 20000315, dt.date(2000, 3, 16))
    with pytest.raises(ValueError):
        RunClock.resolve(cal.where("CALENDAR_DATE_ID = 20000314"), 20000314, dt.date(2000, 3, 15))


def test_python_date_helpers():
    assert add_months(dt.date(2000, 2, 29), -12) == dt.date(1999, 2, 28)
    assert add_months(dt.date(2001, 1, 31), 1) == dt.date(2001, 2, 28)
    assert last_day(dt.date(2000, 2, 3)) == dt.date(2000, 2, 29)
