"""Many run dates of the revenue job in one plan (D9 as a join on days).

A single run compares days with the literal bounds of its window.  Here each run's window is exploded into its days (at most 62),
and day and run are plain join keys: feeds are read and summed once for the days that any
run needs, however many runs share a day, and the sums are joined to the runs by day.  No range or nested-loop join is
left.  Rows are those of as many single runs on the same history, told apart by AS_OF.

The history is read as it is.  Runs in sequence would read what earlier ones restated, so run dates whose
last-year days fall into the windows of others are refused unless ``fixed_history`` says that the given
frame stands for all of them.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.functions.clock import RunClock
from daybook.functions.dates import yyyymmdd
from daybook.functions.measures import REVENUE_MEASURES, has_plan, ly_name, q
from daybook.functions.predicates import is_operating_center
from daybook.operators.merge import merge_actual_plan
from daybook.operators.yoy import last_year_key, with_last_year
from daybook.plans.revenue import RevenueParams, RevenueSources, card_totals, daily_revenue, revenue_triples

RUN = "AS_OF date, WINDOW_START date, ANCHOR date, WINDOW_END date, PLAN_END date, MONTH_END date, EXPIRATION_ID int, EXTRACT_ID int"
KEYS = ("AS_OF", "CENTER", "PERIOD")


@dataclass(frozen=True)
class Backfill:
    """The clocks of the runs, one a run date."""
    clocks: tuple[RunClock, ...]

    @classmethod
    def of(cls, as_of: list[dt.date], fixed_history: bool = False) -> "Backfill":
        if not as_of:
            raise ValueError("no run dates")
        clocks = tuple(RunClock.from_dates(x) for x in sorted(set(as_of)))
        last_year, first_window = max(hi for c in clocks for _, hi in c.last_year_ranges()), min(c.expiration_id for c in clocks)
        if last_year >= first_window and not fixed_history:
            raise ValueError(f"last-year days up to {last_year} fall into the window from {first_window}: run in parts, or on a fixed history")
        return cls(clocks)

    def runs(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame([(c.as_of, c.start, c.anchor, c.end, c.plan_end, c.month_end, c.expiration_id, c.extract_id)
                                      for c in self.clocks], RUN)

    def run_days(self, spark: SparkSession, end: str) -> DataFrame:
        """(AS_OF, PERIOD) for each day from the window's start to its ``end``."""
        day = F.explode(F.sequence("WINDOW_START", end)).alias("DAY")
        return self.runs(spark).select("AS_OF", day).select("AS_OF", yyyymmdd("DAY").alias("PERIOD"))

    def bounds(self, end: str) -> tuple[int, int]:
        return min(c.start_id for c in self.clocks), max(getattr(c, end) for c in self.clocks)

    def last_year_ranges(self) -> list[tuple[int, int]]:
        """The runs' last-year ranges, overlapping ones joined."""
        out: list[tuple[int, int]] = []
        for lo, hi in sorted(r for c in self.clocks for r in c.last_year_ranges()):
            if out and lo <= out[-1][1] + 1:
                out[-1] = (out[-1][0], max(hi, out[-1][1]))
            else:
                out.append((lo, hi))
        return out

    def spine(self, hierarchy: DataFrame) -> DataFrame:
        """(AS_OF, ANCHOR, CENTER, PERIOD, DAY): every operating center on every day of every run's window."""
        centers = hierarchy.where(is_operating_center("CENTER")).select(F.col("CENTER").cast("int").alias("CENTER")).distinct()
        each = [F.struct(F.lit(c.as_of).alias("AS_OF"), F.lit(c.anchor).alias("ANCHOR"), F.lit(c.start).alias("START"), F.lit(c.end).alias("END"))
                for c in self.clocks]
        rows = centers.select("CENTER", F.explode(F.array(*each)).alias("r")).select("CENTER", "r.*")
        rows = rows.select("AS_OF", "ANCHOR", "CENTER", F.explode(F.sequence("START", "END")).alias("DAY"))
        return rows.select("AS_OF", "ANCHOR", "CENTER", yyyymmdd("DAY").alias("PERIOD"), "DAY")


def backfill_revenue(src: RevenueSources, as_of: list[dt.date], params: RevenueParams = RevenueParams(), *,
                     fixed_history: bool = False) -> DataFrame:
    """AS_OF and the columns of ``run_revenue``, for every run date."""
    spark, runs = src.actual.sparkSession, Backfill.of(as_of, fixed_history)

    def daily(feed: DataFrame, end: str, last: str, actual: bool) -> DataFrame:
        days = runs.run_days(spark, end).select("PERIOD").distinct()
        return daily_revenue(feed, *runs.bounds(last), actual=actual, days=days, places=params.places)

    actual = daily(src.actual, "WINDOW_END", "end_id", True).selectExpr("CENTER", "PERIOD", *map(q, REVENUE_MEASURES))
    rows = runs.spine(src.hierarchy).join(actual, ["CENTER", "PERIOD"], "left")
    rows = with_last_year(rows, src.history, {ly_name(m): m for m in REVENUE_MEASURES}, last_year_key(F.col("DAY"), F.col("ANCHOR")),
                          ranges=runs.last_year_ranges())
    plan = daily(src.plan, "PLAN_END", "plan_end_id", False).join(runs.run_days(spark, "PLAN_END"), "PERIOD")
    merged = merge_actual_plan(rows.drop("DAY", "ANCHOR"), plan, [m for m in REVENUE_MEASURES if has_plan(m)], KEYS)
    bounds = runs.runs(spark).select("AS_OF", "EXPIRATION_ID", "EXTRACT_ID", "MONTH_END")
    merged = merged.join(bounds, "AS_OF")
    out = revenue_triples(merged, "AS_OF", params, ("AS_OF", "EXPIRATION_ID", "EXTRACT_ID", "MONTH_END"))
    out = out.where("PERIOD >= EXPIRATION_ID AND DATES <= MONTH_END")
    return card_totals(out, "EXTRACT_ID", ("AS_OF",))
