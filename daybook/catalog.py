"""Registered queries: one per operator of the blueprint, plus both jobs.

Each callable takes ``(spark, sf_dir)``, derives its inputs from the whole
driver tables (``daybook.sources.fixtures``) and returns a lazy DataFrame.
Money measures are whole cents in DOUBLE (exact, order-independent sums);
``finalize`` casts every remaining numeric measure to DOUBLE so results
compare bit-for-bit with the DuckDB oracle.

The scenario clock is 2000-03-15 (closed month = leap February 2000); the
event-stream snapshots cover all days.
Fixture parameters replace warehouse constants that the derived data cannot
hit (override center 1525 instead of 1544, accrual after 2000-02-15 instead
of 2019-12-31, account names drawn from the derived account values).
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import partial, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, FloatType, LongType

from daybook.functions.clock import RunClock, clock_columns, expiration_of, goal_end_id
from daybook.functions.measures import REVENUE_MEASURES, SHOP_DEN, SHOP_NUM, derive_card_sales, derive_shop_totals, ly_name
from daybook.functions.predicates import is_fact_center, is_rollup_member
from daybook.operators.audit import AuditLog, run_job
from daybook.operators.lineage import CREATED_AT, CREATED_BY, MODIFIED_AT, stamp_lineage
from daybook.operators.merge import merge_metrics
from daybook.operators.pivot import pivot_accounts
from daybook.operators.quarantine import reject_rows
from daybook.operators.reload import reload_window
from daybook.operators.restatement import STATES, window_changes
from daybook.operators.snapshot import latest_snapshot, newest_sums
from daybook.operators.snapshot_state import SnapshotState, in_steps, month_of
from daybook.operators.spine import build_spine
from daybook.operators.yoy import (calendar_key, last_year_key, weekday_key, with_last_year,
                                   with_last_year_two_regime)
from daybook.plans import ops_goals as og
from daybook.plans.backfill import backfill_revenue
from daybook.plans.revenue import (RevenueParams, RevenueSources, daily_revenue, revenue_actuals,
                                   revenue_merged, revenue_output, revenue_target_schema, run_revenue)
from daybook.sources.feeds import normalise_keys, reject_counts
from daybook.sources.fixtures import CENTER_TEXT_COLUMNS, fixture

AS_OF = dt.date(2000, 3, 15)
ALL_DAYS = (0, 99991231)
KEY_COLUMNS = {"CENTER", "PERIOD", "EXTRACT_DATE_ID", "CALENDAR_DATE_ID", "EXPIRATION_DATE_ID",
               "GOAL_END_ID", "N_ROWS", "N_ADDED", "N_CHANGED", "N_GONE", "N_SAME", "MONTH", "ROW_COUNT", "SEVERITY"}
FIXTURE_PARAMS = RevenueParams(override_centers=(1525,), accrual_since=20000215)
FIXTURE_ACCOUNTS = og.OpsAccounts(
    nps={"DBACHECKS": ["AF1"], "PROMOTERS_NPS": ["NO1"], "DETRACTORS_NPS": ["RF1"],
         "PASSIVE_NPS": ["AO1", "NF1"]},
    dds=["NO2", "NO3", "RF2"],
    goals={"FTDD_GOAL_MTD": ["1-URGENT"], "CARDSALES_GOAL_MTD": ["2-HIGH"], "DAYS_MTD": ["3-MEDIUM"],
           "BBK_ITEMS_GOAL_MTD": ["4-NOT SPECIFIED", "5-LOW"], "BBK_ITEMS_OPPS_GOAL_MTD": ["5-LOW", "1-URGENT"]},
    dda={"DDAUPGRADES": ["NO4"], "DDANEWCARD": ["NF4", "RF4"]},
    prepaid=["NO5", "AF5", "RO5"],
    nc4s={"NC4S_SALES_CY": ["NO6"], "NC4S_OPPS_CY": ["NF6", "AO6"]},
    employees={"ACTIVEEMPLOYEE": ["NO7"], "TERMINATEDEMPLOYEE": ["RF7"]},
    shops={"EXPERIENCESHOPDENOMINATOR": ["AF2"], "EXPERIENCESHOPNUMERATOR": ["AO2"],
           "LOANSHOPDENOMINATOR": ["NF2"], "LOANSHOPNUMERATOR": ["RO2"],
           "PHONESHOPDENOMINATOR": ["AF3"], "PHONESHOPNUMERATOR": ["AO3"]},
)
EVENT_PIVOT = {"DBACHECKS": ["click"], "PROMOTERS_NPS": ["purchase"], "DETRACTORS_NPS": ["error"],
               "PASSIVE_NPS": ["view"]}
EVENT_ACCOUNTS = ["click", "purchase", "view"]
TEXT_CAST = "double"
#: Decimal places of the order-free sums.
GRID_PLACES = 6


# Further run dates of the jobs: first and second of a month, November (a closed month
# of 31 days, an open one of 30), a window over the turn of the year; and an extract of the
# run day itself.
RUN_DATES = {
    "day1": (dt.date(2001, 3, 1), None),
    "day2": (dt.date(2001, 3, 2), None),
    "november": (dt.date(2000, 11, 20), None),
    "new_year": (dt.date(2001, 1, 10), None),
    "same_day": (dt.date(2000, 3, 15), dt.date(2000, 3, 15)),
}
# More run dates of the backfill, and the columns that its query returns.
BACKFILL_DATES = {"april": dt.date(2000, 4, 1), "may": dt.date(2000, 5, 31), "august": dt.date(2000, 8, 15), "december": dt.date(2000, 12, 2),
                  "january": dt.date(2001, 1, 20)}
BACKFILL_COLUMNS = [m + s for m in ("TOTALCARDREV", "ELITE", "TOTALCOMM") for s in ("", "_LY", "_PLAN")] + [
    FIXTURE_PARAMS.accrual_measure, *[m + "_PLAN" for m in FIXTURE_PARAMS.override_measures], "ATM_FEE", "ATM_FEE_LY", "ATM_FEE_PLAN"]


def clock(run: str | None = None) -> RunClock:
    return RunClock.from_dates(*(RUN_DATES[run] if run else (AS_OF,)))


def finalize(df: DataFrame) -> DataFrame:
    """Cast measures to DOUBLE (exact decimal -> correctly rounded double)."""
    cols = []
    for f in df.schema.fields:
        numeric = isinstance(f.dataType, (DecimalType, FloatType, LongType))
        if numeric and f.name not in KEY_COLUMNS:
            cols.append(f"CAST(`{f.name}` AS DOUBLE) AS `{f.name}`")
        else:
            cols.append(f"`{f.name}`")
    return df.selectExpr(*cols)


# ---- shared inputs ------------------------------------------------------------

def revenue_history(spark, d) -> DataFrame:
    """Stand-in for the revenue target: the actual daily stage over all days."""
    return daily_revenue(fixture(spark, d, "daily_actual"), *ALL_DAYS, actual=True)


def revenue_sources(spark, d) -> RevenueSources:
    return RevenueSources(hierarchy=fixture(spark, d, "hierarchy"), actual=fixture(spark, d, "daily_actual"),
                          plan=fixture(spark, d, "daily_plan"), history=revenue_history(spark, d))


def ops_sources(spark, d, history: DataFrame | None = None, c: RunClock | None = None) -> og.OpsSources:
    acct = fixture(spark, d, "account_feed")
    src = og.OpsSources(hierarchy=fixture(spark, d, "hierarchy"), nps=acct, staff=fixture(spark, d, "staff_metrics"),
                        dds=acct, goals=fixture(spark, d, "goals"), dda=acct, prepaid=acct,
                        visit=fixture(spark, d, "visit_metrics"), cash=acct,
                        center=fixture(spark, d, "center_metrics"), employees=acct, shops=acct,
                        history=history)
    if history is None:
        src.history = ops_history(src, c or clock())
    return src


def ops_history(src: og.OpsSources, c: RunClock) -> DataFrame:
    """Stand-in for the ops target over the last-year key ranges."""
    spans = c.last_year_ranges()
    lo, hi = min(s[0] for s in spans), max(s[1] for s in spans)
    return og.ops_metrics(src, lo, hi, FIXTURE_ACCOUNTS, TEXT_CAST)


def spine(spark, d) -> DataFrame:
    c = clock()
    return build_spine(fixture(spark, d, "hierarchy"), c.start, c.end)


# ---- queries ------------------------------------------------------------------

def q_run_clock(spark, d):
    cal = fixture(spark, d, "calendar")
    ext = cal.select(F.col("CALENDAR_DATE_ID").alias("EXTRACT_DATE_ID"),
                     F.col("CALENDAR_DATE").alias("EXTRACT_DATE"))
    ext = ext.withColumns({"AS_OF": F.date_add("EXTRACT_DATE", 1), "EXPIRATION_DATE": expiration_of(F.col("EXTRACT_DATE"))})
    exp = cal.select(F.col("CALENDAR_DATE").alias("EXPIRATION_DATE"),
                     F.col("CALENDAR_DATE_ID").alias("EXPIRATION_DATE_ID"))
    out = ext.join(exp, "EXPIRATION_DATE", "inner")
    return out.select("AS_OF", "EXTRACT_DATE_ID", "EXPIRATION_DATE_ID", "EXPIRATION_DATE",
                      *[v.alias(k) for k, v in clock_columns(F.col("AS_OF")).items()],
                      goal_end_id(F.col("AS_OF"), F.col("EXTRACT_DATE_ID")).alias("GOAL_END_ID"))


def q_center_day_spine(spark, d):
    return spine(spark, d).select("CENTER", "PERIOD", F.col("DAY").alias("DATES"))


def q_fact_center_filter(spark, d):
    feed = fixture(spark, d, "daily_actual")
    return (feed.where(is_fact_center("CENTER")).groupBy("CENTER")
            .agg(F.count(F.lit(1)).alias("N_ROWS"), F.sum("ATM_FEE").alias("ATM_FEE")))


def q_rollup_member_filter(spark, d):
    goals = fixture(spark, d, "goals")
    kept = normalise_keys(goals.where(~is_rollup_member("CENTER"))).where("CENTER IS NOT NULL")
    return kept.groupBy("CENTER").agg(F.count(F.lit(1)).alias("N_ROWS"), F.sum("GOAL_VALUE").alias("GOAL_VALUE"))


def q_daily_actual_measures(spark, d):
    daily = revenue_history(spark, d)
    return daily.drop("NET_CHECK_COLLECTIONS", "CHECKLOSS", "NET_CHECK_REVENUE", "NET_LOAN_REVENUE",
                      "LOAN_LOSS", "PPLOADFEESANDCARDSALES", "DDLOADFEESANDCARDSALES")


def q_order_free_actual_measures(spark, d):
    return daily_revenue(fixture(spark, d, "daily_actual_thirds"), *ALL_DAYS, actual=True, places=GRID_PLACES)


def q_order_free_plan_measures(spark, d):
    c = clock()
    return daily_revenue(fixture(spark, d, "daily_plan_thirds"), c.start_id, c.plan_end_id, actual=False, places=GRID_PLACES)


def q_order_free_newest_sums(spark, d):
    feed = normalise_keys(fixture(spark, d, "account_feed_thirds"))
    return newest_sums(feed, ["CENTER", "PERIOD", "ACCOUNT"], {"DATA_VALUE": None}, places=GRID_PLACES)


def q_run_lineage(spark, d):
    """A rerun of the window: rows of even orders' days were there before, some of them without a first stamp."""
    c = clock()
    rows = normalise_keys(fixture(spark, d, "daily_actual").select("CENTER", "PERIOD")).where(F.col("PERIOD") >= c.expiration_id)
    fresh = rows.groupBy("CENTER", "PERIOD").agg(F.count(F.lit(1)).alias("N_ROWS"))
    stamp = F.timestamp_seconds(F.lit(951868800) + F.col("CENTER"))
    old = rows.where("CENTER % 2 = 0").withColumns({
        CREATED_AT: F.when(F.col("PERIOD") % 3 != 0, stamp), CREATED_BY: F.when(F.col("PERIOD") % 3 != 0, F.lit("first")),
        MODIFIED_AT: F.timestamp_seconds(F.lit(952000000) + F.col("CENTER"))})
    out = stamp_lineage(fresh, old, "second", now=F.timestamp_seconds(F.lit(953000000)))
    return out.withColumns({t: F.unix_timestamp(t).cast("string") for t in (CREATED_AT, MODIFIED_AT)})


def q_check_loan_card_derivations(spark, d):
    return revenue_history(spark, d).select(
        "CENTER", "PERIOD", "NET_CHECK_COLLECTIONS", "CHECKLOSS", "NET_CHECK_REVENUE", "NET_LOAN_REVENUE",
        "LOAN_LOSS", "PPLOADFEESANDCARDSALES", "DDLOADFEESANDCARDSALES")


def q_daily_plan_to_month_end(spark, d):
    c = clock()
    return daily_revenue(fixture(spark, d, "daily_plan"), c.start_id, c.plan_end_id, actual=False)


def _yoy(spark, d, regime: str):
    c = clock()
    sp = spine(spark, d)
    hist = revenue_history(spark, d)
    cols = {ly_name(m): m for m in REVENUE_MEASURES}
    if regime == "calendar":
        sp = sp.where(F.col("DAY") < F.lit(c.anchor))
        out = with_last_year(sp, hist, cols, calendar_key(F.col("DAY")), ranges=c.last_year_ranges())
    elif regime == "weekday":
        sp = sp.where(F.col("DAY") >= F.lit(c.anchor))
        out = with_last_year(sp, hist, cols, weekday_key(F.col("DAY")), ranges=c.last_year_ranges())
    else:
        out = with_last_year(sp, hist, cols, last_year_key(F.col("DAY"), c.anchor), ranges=c.last_year_ranges())
    return out.select("CENTER", "PERIOD", *cols)


def q_yoy_calendar_regime(spark, d):
    return _yoy(spark, d, "calendar")


def q_yoy_weekday_regime(spark, d):
    return _yoy(spark, d, "weekday")


def q_yoy_two_regime(spark, d):
    return _yoy(spark, d, "both")


def q_snapshot_center_period_account(spark, d):
    feed = normalise_keys(fixture(spark, d, "events_feed"))
    return latest_snapshot(feed, ["CENTER", "PERIOD", "ACCOUNT"])


def q_snapshot_center_period(spark, d):
    feed = normalise_keys(fixture(spark, d, "events_feed"))
    return latest_snapshot(feed.where(F.col("ACCOUNT").isin(EVENT_ACCOUNTS)), ["CENTER", "PERIOD"])


def q_snapshot_center_month_account(spark, d):
    feed = normalise_keys(fixture(spark, d, "account_feed")).withColumn("MONTH", F.expr("CAST(PERIOD div 100 AS INT)"))
    return latest_snapshot(feed, ["CENTER", "MONTH", "ACCOUNT"])


def q_account_pivot(spark, d):
    feed = normalise_keys(fixture(spark, d, "events_feed"))
    return pivot_accounts(latest_snapshot(feed, ["CENTER", "PERIOD", "ACCOUNT"]), EVENT_PIVOT)


def q_goal_pivot_cutoff(spark, d):
    return og.goal_component(fixture(spark, d, "goals"), clock(), FIXTURE_ACCOUNTS)


def q_text_metric_sums(spark, d):
    return og.checks_component(fixture(spark, d, "center_metrics"), *ALL_DAYS, cast_to=TEXT_CAST)


def q_staffing_hours(spark, d):
    return og.hours_component(fixture(spark, d, "staff_metrics"), *ALL_DAYS, cast_to=TEXT_CAST)


def q_buyback_rollup(spark, d):
    return og.bbk_component(fixture(spark, d, "visit_metrics"), *ALL_DAYS)


def _component_history(spark, d, build) -> DataFrame:
    """The last-year stand-in of one component only."""
    spans = clock().last_year_ranges()
    return build(min(s[0] for s in spans), max(s[1] for s in spans))


def q_lagged_open_month(spark, d):
    c = clock()
    feed = fixture(spark, d, "account_feed")
    dds = lambda lo, hi: og.dds_component(feed, lo, hi, FIXTURE_ACCOUNTS)
    cur = spine(spark, d).join(dds(c.start_id, c.end_id), ["CENTER", "PERIOD"], "left")
    cur = with_last_year_two_regime(cur, _component_history(spark, d, dds), {"FIRSTTIME_DDS_LY": "FIRSTTIME_DDS_CY"}, c)
    cols = ["FIRSTTIME_DDS_CY", "FIRSTTIME_DDS_LY"]
    return og.lag_open_month(cur, cols, c, drop_rows=True).select("CENTER", "PERIOD", *cols)


def q_distinct_zero_fill_union(spark, d):
    """Rows are unique by center and day, so the two branches' DISTINCT needs no work."""
    c = clock()
    feed = fixture(spark, d, "account_feed")
    dda = lambda lo, hi: og.dda_feed_component(feed, lo, hi, FIXTURE_ACCOUNTS).select(
        "CENTER", "PERIOD", "DDAUPGRADES", "DDANEWCARD")
    cur = spine(spark, d).join(dda(c.start_id, c.end_id), ["CENTER", "PERIOD"], "left")
    cur = with_last_year_two_regime(cur, _component_history(spark, d, dda), {"DDAUPGRADES_LY": "DDAUPGRADES",
                                                                            "DDANEWCARD_LY": "DDANEWCARD"}, c)
    cols = ["DDAUPGRADES", "DDAUPGRADES_LY", "DDANEWCARD", "DDANEWCARD_LY"]
    return og.zero_fill(cur, cols).select("CENTER", "PERIOD", *cols)


def q_newest_sums_day_account(spark, d):
    feed = normalise_keys(fixture(spark, d, "account_feed"))
    return newest_sums(feed, ["CENTER", "PERIOD", "ACCOUNT"], {"DATA_VALUE": None})


def q_newest_sums_day(spark, d):
    feed = normalise_keys(fixture(spark, d, "account_feed"))
    accounts = [a for v in FIXTURE_ACCOUNTS.dda.values() for a in v]
    return newest_sums(feed.where(F.col("ACCOUNT").isin(accounts)), ["CENTER", "PERIOD"], og.account_sums(FIXTURE_ACCOUNTS.dda))


def q_text_center_feed(spark, d):
    return og.checks_component(fixture(spark, d, "text_center_metrics"), *ALL_DAYS, cast_to=TEXT_CAST)


def q_reject_counts(spark, d):
    """What key and number normalisation cannot use, by feed and field."""
    feeds = {"goals": (fixture(spark, d, "goals").where(~is_rollup_member("CENTER")), []),
             "text_center_metrics": (fixture(spark, d, "text_center_metrics"), CENTER_TEXT_COLUMNS)}
    parts = [reject_counts(f, n).select(F.lit(k).alias("FEED"), "FIELD", "N_ROWS") for k, (f, n) in feeds.items()]
    return reduce(DataFrame.unionByName, parts)


def q_rejects_quarantine(spark, d):
    """The unusable values that a quarantine keeps, by feed, field and value."""
    feeds = {"goals": (fixture(spark, d, "goals").where(~is_rollup_member("CENTER")), []),
             "text_center_metrics": (fixture(spark, d, "text_center_metrics"), CENTER_TEXT_COLUMNS),
             "plan": (fixture(spark, d, "daily_plan_odd_keys"), [])}
    rows = reduce(DataFrame.unionByName, [reject_rows(f, k, n) for k, (f, n) in feeds.items()])
    return rows.groupBy("FEED", "FIELD", "VALUE").agg(F.count(F.lit(1)).alias("N_ROWS"))


def q_revenue_odd_plan_keys(spark, d):
    """The revenue tracker on a plan feed with centers that are no whole number and days that are none."""
    src = revenue_sources(spark, d)
    src.plan = fixture(spark, d, "daily_plan_odd_keys")
    return run_revenue(src, clock(), FIXTURE_PARAMS)


def q_window_restatement(spark, d):
    """How the revenue job's window differs by day from a stand-in target of its actual measures."""
    c = clock()
    cols = ["CENTER", "PERIOD", *REVENUE_MEASURES]
    old = revenue_history(spark, d).select(*cols).where(F.col("PERIOD") >= c.expiration_id)
    new = run_revenue(revenue_sources(spark, d), c, FIXTURE_PARAMS).select(*cols)
    days = window_changes(old, new)
    return days.select("PERIOD", *[F.col(s).alias(f"N_{s}") for s in STATES])


def q_backfill_windows(spark, d):
    """Ten run dates of the revenue job in one plan."""
    days = [clock().as_of, *[x for x, _ in RUN_DATES.values()], *BACKFILL_DATES.values()]
    out = backfill_revenue(revenue_sources(spark, d), days, FIXTURE_PARAMS, fixed_history=True)
    return out.select("AS_OF", "CENTER", "PERIOD", "DATES", "EXTRACT_DATE_ID", *BACKFILL_COLUMNS)


def _three_extracts(spark, d) -> DataFrame:
    """The account feed as three extracts of all its days."""
    feed = normalise_keys(fixture(spark, d, "account_feed"))
    return feed.withColumn("EXTRACT_DATE_ID", F.col("EXTRACT_DATE_ID") - F.col("PERIOD") + 1)


def q_snapshot_state_steps(spark, d):
    """Newest sums by center, day and account, from one extract after the other."""
    spec = SnapshotState(("CENTER", "PERIOD", "ACCOUNT"), ("DATA_VALUE",))
    return in_steps(spec, _three_extracts(spark, d), [1, 2, 3])


def q_snapshot_state_month_steps(spark, d):
    """Day sums of the newest extract of a center, month and account, from one extract after the other."""
    spec = SnapshotState(("CENTER", "MONTH", "ACCOUNT"), ("DATA_VALUE",), detail=("PERIOD",))
    return in_steps(spec, _three_extracts(spark, d), [1, 2, 3], lambda rows: rows.withColumn("MONTH", month_of()))


def _revenue_merged(spark, d):
    c = clock()
    src = revenue_sources(spark, d)
    sp = build_spine(src.hierarchy, c.start, c.end)
    actuals = revenue_actuals(sp, daily_revenue(src.actual, c.start_id, c.end_id, True), src.history, c)
    plan = daily_revenue(src.plan, c.start_id, c.plan_end_id, actual=False)
    return revenue_merged(actuals, plan, c, FIXTURE_PARAMS)


def q_actual_plan_full_outer(spark, d):
    return _revenue_merged(spark, d)


def q_plan_center_override(spark, d):
    return _revenue_merged(spark, d).select("CENTER", "PERIOD", *[m + "_PLAN" for m in FIXTURE_PARAMS.override_measures])


def q_accrual_from_plan(spark, d):
    m = FIXTURE_PARAMS.accrual_measure
    return _revenue_merged(spark, d).select("CENTER", "PERIOD", m, ly_name(m), m + "_PLAN")


def q_card_rollups(spark, d):
    out = revenue_output(_revenue_merged(spark, d), clock())
    return out.select("CENTER", "PERIOD", *[r + s for r in ("OTHERREVENUE", "ELITE", "DDA", "TOTALCOMM", "TOTALCARDREV")
                                            for s in ("", "_LY", "_PLAN")])


def q_metric_merge_12way(spark, d):
    c = clock()
    src = ops_sources(spark, d)
    parts = og.spine_components(src, c.start_id, c.end_id, FIXTURE_ACCOUNTS, TEXT_CAST)
    out = merge_metrics([*parts, og.goal_component(src.goals, c, FIXTURE_ACCOUNTS)])
    return derive_card_sales(derive_shop_totals(out, ("",)), ("",))


def q_shop_card_totals(spark, d):
    """The four shop totals and both card sales on the spine, last year by the two regimes."""
    c = clock()
    feed = fixture(spark, d, "account_feed")

    def parts(lo, hi):
        return merge_metrics([og.shops_component(feed, lo, hi, FIXTURE_ACCOUNTS), og.dda_feed_component(feed, lo, hi, FIXTURE_ACCOUNTS),
                              og.prepaid_component(feed, lo, hi, FIXTURE_ACCOUNTS)])
    ly = {f"{x}_LY": x for x in [*SHOP_DEN, *SHOP_NUM, "DDANEWCARD", "PREPAIDCARDSALEITEMS"]}
    cur = spine(spark, d).join(parts(c.start_id, c.end_id), ["CENTER", "PERIOD"], "left")
    cur = with_last_year_two_regime(cur, _component_history(spark, d, parts), ly, c)
    out = derive_card_sales(derive_shop_totals(cur))
    return out.select("CENTER", "PERIOD", *[f"TOTALSHOPS{k}{y}" for k in ("DEN", "NUM") for y in ("", "_LY")], "CARDSALES_CY", "CARDSALES_LY")


def q_window_reload(spark, d):
    """The revenue job's own window into a stand-in target of its actual measures."""
    c = clock()
    cols = ["CENTER", "PERIOD", *REVENUE_MEASURES]
    history = revenue_history(spark, d).select(*cols)
    return reload_window(history, run_revenue(revenue_sources(spark, d), c, FIXTURE_PARAMS), c.expiration_id)


def q_stage_audit_counts(spark, d):
    """Runs the revenue job's plan once (an action) and returns its seven audit rows."""
    audit = AuditLog(etl_date=clock().extract_id, job_id=1, sp_name="revenue", package_name="daybook")
    out = run_revenue(revenue_sources(spark, d), clock(), FIXTURE_PARAMS, audit=audit)

    def body():
        out.write.format("noop").mode("overwrite").save()
        audit.collect_stages()
    run_job(audit, "revenue", body)
    return audit.to_df(spark).select("MESSAGE", "ROW_COUNT", "SEVERITY")


def q_revenue_tracker(spark, d, run: str | None = None):
    return run_revenue(revenue_sources(spark, d), clock(run), FIXTURE_PARAMS)


def q_ops_goals(spark, d, run: str | None = None):
    c = clock(run)
    return og.run_ops_goals(ops_sources(spark, d, c=c), c, FIXTURE_ACCOUNTS, cast_to=TEXT_CAST)


def q_revenue_first_run(spark, d):
    """The target doesn't exist yet: last year is 0."""
    src = revenue_sources(spark, d)
    src.history = spark.createDataFrame([], revenue_target_schema())
    return run_revenue(src, clock(), FIXTURE_PARAMS)


def q_ops_first_run(spark, d):
    """The target doesn't exist yet: last year is NULL, or 0 where it is zero-filled."""
    src = ops_sources(spark, d, history=spark.createDataFrame([], og.ops_target_schema()))
    return og.run_ops_goals(src, clock(), FIXTURE_ACCOUNTS, cast_to=TEXT_CAST)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "run_clock": q_run_clock,
    "center_day_spine": q_center_day_spine,
    "fact_center_filter": q_fact_center_filter,
    "rollup_member_filter": q_rollup_member_filter,
    "daily_actual_measures": q_daily_actual_measures,
    "order_free_actual_measures": q_order_free_actual_measures,
    "order_free_plan_measures": q_order_free_plan_measures,
    "order_free_newest_sums": q_order_free_newest_sums,
    "run_lineage": q_run_lineage,
    "check_loan_card_derivations": q_check_loan_card_derivations,
    "daily_plan_to_month_end": q_daily_plan_to_month_end,
    "yoy_calendar_regime": q_yoy_calendar_regime,
    "yoy_weekday_regime": q_yoy_weekday_regime,
    "yoy_two_regime": q_yoy_two_regime,
    "snapshot_center_period_account": q_snapshot_center_period_account,
    "snapshot_center_period": q_snapshot_center_period,
    "snapshot_center_month_account": q_snapshot_center_month_account,
    "account_pivot": q_account_pivot,
    "goal_pivot_cutoff": q_goal_pivot_cutoff,
    "text_metric_sums": q_text_metric_sums,
    "staffing_hours": q_staffing_hours,
    "buyback_rollup": q_buyback_rollup,
    "lagged_open_month": q_lagged_open_month,
    "distinct_zero_fill_union": q_distinct_zero_fill_union,
    "actual_plan_full_outer": q_actual_plan_full_outer,
    "plan_center_override": q_plan_center_override,
    "accrual_from_plan": q_accrual_from_plan,
    "card_rollups": q_card_rollups,
    "metric_merge_12way": q_metric_merge_12way,
    "window_reload": q_window_reload,
    "stage_audit_counts": q_stage_audit_counts,
    "revenue_tracker": q_revenue_tracker,
    "ops_goals": q_ops_goals,
    "newest_sums_day_account": q_newest_sums_day_account,
    "newest_sums_day": q_newest_sums_day,
    "shop_card_totals": q_shop_card_totals,
    "text_center_feed": q_text_center_feed,
    "reject_counts": q_reject_counts,
    "rejects_quarantine": q_rejects_quarantine,
    "revenue_odd_plan_keys": q_revenue_odd_plan_keys,
    "window_restatement": q_window_restatement,
    "backfill_windows": q_backfill_windows,
    "snapshot_state_steps": q_snapshot_state_steps,
    "snapshot_state_month_steps": q_snapshot_state_month_steps,
    "revenue_first_run": q_revenue_first_run,
    "ops_first_run": q_ops_first_run,
    **{f"revenue_{r}": partial(q_revenue_tracker, run=r) for r in RUN_DATES},
    **{f"ops_{r}": partial(q_ops_goals, run=r) for r in RUN_DATES},
}


def registered() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: (lambda f: (lambda spark, d: finalize(f(spark, d))))(f) for k, f in QUERIES.items()}


__all__ = ["QUERIES", "registered", "finalize", "clock"]
