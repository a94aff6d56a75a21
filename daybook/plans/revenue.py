"""Daily revenue tracker: actual / last year / plan per center and day.

Plan shape (all stages lazy, one action at the write):
  feed scan (window + center rule pushed to Parquet) -> partial/final
  aggregate on (CENTER, PERIOD) -> left join onto the spine -> one
  conditional-key last-year join against the target's two history ranges
  -> full outer join with the plan aggregate -> zero fill, per-center plan
  override, accrual, card roll-ups.
Everything after the first aggregate is at most centers x 62 days wide.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, DoubleType, IntegerType, StructField, StructType

from daybook.functions.clock import RunClock
from daybook.functions.measures import (
    CARD_ROLLUPS, REVENUE_MEASURES, card_rollup_sql, derive_check_loan_card, has_plan, ly_name, plan_name, q,
    revenue_daily_aggregates, revenue_output_columns, sql_c0, total_card_revenue_sql,
)
from daybook.functions.predicates import is_fact_center
from daybook.operators.audit import AuditLog
from daybook.operators.load import load_window
from daybook.operators.merge import merge_actual_plan
from daybook.operators.quarantine import Quarantine, watcher
from daybook.operators.spine import build_spine
from daybook.operators.window import clip_to_run_window
from daybook.operators.yoy import with_last_year_two_regime
from daybook.sources.feeds import window_feed

KEYS = ["CENTER", "PERIOD"]


@dataclass
class RevenueParams:
    # The center whose loan plan totals are forced to 0, and
    # the five plan totals concerned (their component plan columns are not).
    override_centers: tuple[int, ...] = (1544,)
    override_measures: tuple[str, ...] = ("TOTAL_INTEREST_INCOME", "LOAN_FIRST_RETURNS",
                                          "NET_LOAN_COLLECTIONS", "NET_LOAN_REVENUE", "LOAN_LOSS")
    # The measure whose actual is accrued from plan, and the
    # period after which the accrual applies.
    accrual_measure: str = "OTHER_PREPAID_CARD_REVENUE"
    accrual_since: int = 20191231
    # Decimal places of order-free sums of DOUBLE feeds; None: plain sums, for feeds whose sums are exact.
    places: int | None = None


@dataclass
class RevenueSources:
    hierarchy: DataFrame   # CENTER, REGNAME
    actual: DataFrame      # raw daily actual feed
    plan: DataFrame        # raw daily plan feed
    history: DataFrame     # the target itself (CENTER, PERIOD, actual measures)
    extra: dict = field(default_factory=dict)


def daily_revenue(feed: DataFrame, lo: int, hi: int, actual: bool = True, watch=None, days: DataFrame | None = None,
                  places: int | None = None) -> DataFrame:
    """E1 + F1-F3 over [lo, hi] for fact centers; with ``days`` (PERIOD, distinct) over these days only; with ``places``
    sums that do not depend on the order of rows."""
    df = window_feed(feed, lo, hi, center_rule=is_fact_center, watch=watch)
    df = df if days is None else df.join(days, "PERIOD", "left_semi")
    return derive_check_loan_card(df.groupBy(*KEYS).agg(*revenue_daily_aggregates(actual, places)))


def revenue_actuals(spine: DataFrame, actual_daily: DataFrame, history: DataFrame, clock: RunClock) -> DataFrame:
    """Spine-dense actuals with last-year columns (prevmonth + open-month regimes)."""
    cur = spine.join(actual_daily.selectExpr(*KEYS, *map(q, REVENUE_MEASURES)), KEYS, "left")
    return with_last_year_two_regime(cur, history, {ly_name(m): m for m in REVENUE_MEASURES}, clock)


def revenue_merged(actuals: DataFrame, plan_daily: DataFrame, clock: RunClock,
                   params: RevenueParams = RevenueParams()) -> DataFrame:
    """D7 + F4-F6 + C8: zero-filled actual/LY/plan triples on the run window."""
    plan_measures = [m for m in REVENUE_MEASURES if has_plan(m)]
    merged = merge_actual_plan(actuals.drop("DAY"), plan_daily, plan_measures)
    out = revenue_triples(merged, f"DATE'{clock.as_of}'", params)
    return clip_to_run_window(out, clock.expiration_id).where(F.col("DATES") <= F.lit(clock.month_end))


def revenue_triples(merged: DataFrame, as_of: str, params: RevenueParams, more: tuple[str, ...] = ()) -> DataFrame:
    """F4-F6 on merged actual and plan rows; ``as_of``: the run day as SQL; columns ``more`` are kept."""
    day = "to_date(CAST(PERIOD AS STRING), 'yyyyMMdd')"
    centers = ", ".join(str(int(c)) for c in params.override_centers)
    cols = [*more, "CENTER", "PERIOD", f"{day} AS DATES"]
    for m in REVENUE_MEASURES:
        if m == params.accrual_measure:
            cols.append(f"CASE WHEN PERIOD > {int(params.accrual_since)} AND {day} < {as_of} "
                        f"THEN {sql_c0(plan_name(m))} ELSE 0 END AS {q(m)}")
        else:
            cols.append(f"{sql_c0(m)} AS {q(m)}")
        cols.append(f"{sql_c0(ly_name(m))} AS {q(ly_name(m))}")
        if has_plan(m):
            plan = sql_c0(plan_name(m))
            if m in params.override_measures and centers:
                plan = f"CASE WHEN CENTER IN ({centers}) THEN 0 ELSE {plan} END"
            cols.append(f"{plan} AS {q(plan_name(m))}")
    return merged.selectExpr(*cols)


def revenue_output(merged: DataFrame, clock: RunClock) -> DataFrame:
    """F7/F8 card roll-ups and the target column order (without load stamp)."""
    return card_totals(merged, str(int(clock.extract_id)))


def card_totals(merged: DataFrame, extract_id: str, more: tuple[str, ...] = ()) -> DataFrame:
    sfx = ("", "_LY", "_PLAN")
    out = merged.selectExpr("*", *[e for s in sfx for e in card_rollup_sql(s)])
    out = out.selectExpr("*", *[total_card_revenue_sql(s) for s in sfx],
                         f"{extract_id} AS EXTRACT_DATE_ID")
    return out.selectExpr(*more, *[q(c) for c in revenue_output_columns()])


def revenue_target_schema() -> StructType:
    """Columns of the revenue target (without the load stamp): for an empty target on a first run."""
    kinds = {"CENTER": IntegerType(), "PERIOD": IntegerType(), "DATES": DateType(), "EXTRACT_DATE_ID": IntegerType()}
    return StructType([StructField(c, kinds.get(c, DoubleType())) for c in revenue_output_columns()])


def run_revenue(src: RevenueSources, clock: RunClock, params: RevenueParams = RevenueParams(),
                audit: AuditLog | None = None, quarantine: Quarantine | None = None) -> DataFrame:
    stage = audit.stage if audit else (lambda name, df: df)
    spine = stage("spine", build_spine(src.hierarchy, clock.start, clock.end))
    actual_daily = daily_revenue(src.actual, clock.start_id, clock.end_id, actual=True, watch=watcher(quarantine, "actual", src.actual),
                                 places=params.places)
    actuals = stage("actuals", revenue_actuals(spine, actual_daily, src.history, clock))
    plan_daily = stage("plan", daily_revenue(src.plan, clock.start_id, clock.plan_end_id, actual=False, watch=watcher(quarantine, "plan", src.plan),
                                            places=params.places))
    merged = stage("data", revenue_merged(actuals, plan_daily, clock, params))
    return stage("insert", revenue_output(merged, clock))



def load_revenue(src, clock: RunClock, target: str, audit: AuditLog, params: RevenueParams = RevenueParams(), *,
                 quarantine: Quarantine | None = None, restatement: bool = False, lineage_user: str | None = None) -> int:
    """Job entry (I5): audit start, stage counts, stamped reload of the run
    window into ``target`` (partitioned by PERIOD), audit end; returns 0.
    Any failure is audited with its message and re-raised.  Unusable feed values are counted (``quarantine`` with a sink keeps
    them); ``restatement`` adds how the window differs from the old one; ``lineage_user`` stamps rows with their first and last run."""
    quarantine = quarantine or Quarantine(clock.extract_id)
    return load_window(src.actual.sparkSession, "revenue", audit, target, clock, restatement, quarantine,
                       lambda: run_revenue(src, clock, params, audit=audit, quarantine=quarantine), lineage_user)


__all__ = ["load_revenue", "RevenueParams", "RevenueSources", "daily_revenue", "revenue_actuals", "revenue_merged",
           "revenue_output", "run_revenue", "CARD_ROLLUPS"]
