"""Operational goals: twelve metric components per center and day.

Each component is filter -> (latest snapshot) -> aggregate, unique on
(CENTER, PERIOD).  The eleven components that hang off the spine are merged
with one ``unionByName`` + aggregate (no join chain), attached to the spine
with one left join, get all their last-year columns from one conditional-key
join against the target, and finally meet the goals (not spine-bound) in the
only full outer join.  Row set and values equal the component-by-component
form (spine join, two-regime union, 12-way full outer chain) that the oracle
SQL spells out.

Snapshot components pre-aggregate to (keys, extract) before selecting the
newest extract, so a hot center never funnels raw rows into one task.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, DoubleType, IntegerType, StructField, StructType

from daybook.functions.clock import RunClock
from daybook.functions.dates import day_key, key_day, last_day, month_start
from daybook.functions.exact import total_sql
from daybook.functions.measures import c0, derive_card_sales, derive_shop_totals
from daybook.functions.predicates import is_fact_center, is_operating_center, is_rollup_member
from daybook.operators.audit import AuditLog
from daybook.operators.load import load_window
from daybook.operators.merge import merge_metrics
from daybook.operators.pivot import pivot_accounts, sql_list
from daybook.operators.quarantine import Quarantine, watcher
from daybook.operators.snapshot import newest_sums, preaggregate
from daybook.operators.spine import build_spine
from daybook.operators.window import clip_to_run_window, period_between
from daybook.operators.yoy import with_last_year_two_regime
from daybook.sources.feeds import is_day_sql, whole_number_sql, window_feed

KEYS = ["CENTER", "PERIOD"]
V = "DATA_VALUE"


@dataclass
class OpsAccounts:
    """Account names per output column.  Fixed values: the warehouse's names."""
    nps: dict = field(default_factory=lambda: {
        "DBACHECKS": ["CTUITM"], "PROMOTERS_NPS": ["Promoters"],
        "DETRACTORS_NPS": ["Detractors"], "PASSIVE_NPS": ["Passive"]})
    dds: list = field(default_factory=lambda: [
        "Netspend First Time Direct Deposit Items - OTH",
        "Netspend First Time Direct Deposit Items - BNF",
        "Netspend First Time Direct Deposit Items - TAX"])
    goals: dict = field(default_factory=lambda: {
        "FTDD_GOAL_MTD": ["Netspend First Time Direct Deposit Items BUD"],
        "CARDSALES_GOAL_MTD": ["FAP Personal Card Sale Items"],
        "DAYS_MTD": ["#Days"],
        "BBK_ITEMS_GOAL_MTD": ["Net Payday Buy Backs BUD", "Net Installment Buy Backs BUD",
                               "Net Title Buy Backs BUD"],
        "BBK_ITEMS_OPPS_GOAL_MTD": ["Net Installment Buy Back Opportunities BUD",
                                    "Net Payday Buy Back Opportunities BUD",
                                    "Net Title Buy Back Opportunities BUD"]})
    dda: dict = field(default_factory=lambda: {
        "DDAUPGRADES": ["DDA Upgrade Card Sale Items"], "DDANEWCARD": ["DDA New Card Sale Items"]})
    prepaid: list = field(default_factory=lambda: [
        "Business Card Sale Items", "FAP Personal Card Sale Items", "PG Personal Card Sale Items"])
    nc4s: dict = field(default_factory=lambda: {
        "NC4S_SALES_CY": ["New Check Cashing Customer Debit Card Sales"],
        "NC4S_OPPS_CY": ["New Check Cashing Opportunities"]})
    employees: dict = field(default_factory=lambda: {
        "ACTIVEEMPLOYEE": ["Active Employee Items"], "TERMINATEDEMPLOYEE": ["Terminated Employee Items"]})
    shops: dict = field(default_factory=lambda: {
        "EXPERIENCESHOPDENOMINATOR": ["Experience Shop Score Denominator"],
        "EXPERIENCESHOPNUMERATOR": ["Experience Shop Score Numerator"],
        "LOANSHOPDENOMINATOR": ["Loan Shop Score Denominator"],
        "LOANSHOPNUMERATOR": ["Loan Shop Score Numerator"],
        "PHONESHOPDENOMINATOR": ["Phone Shop Score Denominator"],
        "PHONESHOPNUMERATOR": ["Phone Shop Score Numerator"]})


# Staffing feed column -> output column.
STAFF_MAP = {"HOURSOVERSTAFFED": "HOURSOVERSTAFFED", "HOURSUNDERSTAFFED": "HOURSUNDERSTAFFED",
             "SCHEDULEDHOURS": "SCHEDULEDHOURS", "CM_OT": "TOTALCMOT", "SA_OT": "TOTALSAOT",
             "PAYDATE_DAYS": "PAYDATEDAYS", "CORP_SCORE_DEN": "CORPORATEAUDITSCOREDENOMINATOR",
             "CORP_SCORE_NUM": "CORPORATEAUDITSCORENUMERATOR", "CHECKITEMS": "CHECKITEMS"}
# Buy-back parts (payday, installment, title).
BUY_BACKS = ["STOREFRONT_PAYDAY_BUY_BACKS", "STOREFRONT_INSTALLMENT_BUY_BACKS", "STOREFRONT_TITLE_BUY_BACKS"]
BUY_BACK_OPPS = ["STOREFRONT_PAYDAY_BUY_BACK_OPPORTUNITIES", "STOREFRONT_INSTALLMENT_BUY_BACK_OPPORTUNITIES",
                 "STOREFRONT_TITLE_BUY_BACK_OPPORTUNITIES"]


# Text measures of the center feed.
CHECK_TEXTS = ["FORGERYRETURNEDVOLUME", "FORGERYCOLLECTVOLUME", "CHECKCASHINGVOLUME", "OPENLATE", "CLOSEEARLY"]


def _text_sum(c: str, to: str, places: int | None) -> Column:
    return F.expr(total_sql(f"try_cast({c} AS {to})", places))


# ---- components -------------------------------------------------------------

def snapshot_pivot(feed: DataFrame, lo: int, hi: int, columns: dict, center_rule=None,
                   account_filter: bool = False, places: int | None = None) -> DataFrame:
    """Newest extract per (center, day, account), then account pivot (D6a + E3)."""
    raw = feed
    if account_filter:
        raw = raw.where(F.col("ACCOUNT").isin([a for accts in columns.values() for a in accts]))
    df = window_feed(raw, lo, hi, center_rule=center_rule)
    latest = newest_sums(df, [*KEYS, "ACCOUNT"], {V: None}, places=places)
    return pivot_accounts(latest, columns, value=V, places=places)


def account_sums(columns: dict) -> dict:
    """Conditional sums per output column (the pivot inside a D6b snapshot)."""
    return {name: F.when(F.col("ACCOUNT").isin(list(accts)), F.col(V)).otherwise(F.lit(0))
            for name, accts in columns.items()}


def snapshot_sum(feed: DataFrame, lo: int, hi: int, accounts: list, out: str, places: int | None = None) -> DataFrame:
    """Newest extract per (center, day) over an account set, summed (D6b + E9)."""
    df = window_feed(feed.where(F.col("ACCOUNT").isin(accounts)), lo, hi)
    return newest_sums(df, KEYS, {out: F.col(V)}, places=places)


def nps_component(feed, lo, hi, acc: OpsAccounts, places=None):
    return snapshot_pivot(feed, lo, hi, acc.nps, center_rule=is_operating_center, account_filter=True, places=places)


def hours_component(feed, lo, hi, cast_to="double", watch=None, places=None):
    df = window_feed(feed, lo, hi, center_rule=is_fact_center, watch=watch)
    return df.groupBy(*KEYS).agg(*[_text_sum(src, cast_to, places).alias(dst) for dst, src in STAFF_MAP.items()])


def dds_component(feed, lo, hi, acc: OpsAccounts, places=None):
    return snapshot_sum(feed, lo, hi, acc.dds, "FIRSTTIME_DDS_CY", places)


def dda_feed_component(feed, lo, hi, acc: OpsAccounts, places: int | None = None) -> DataFrame:
    """DDA cards (newest extract over an account set, D6b) and NC4S (newest extract of each
    account, D6a) from one read of the DDA feed, one row per (center, day).

    Account sums per extract are dealt by (center, day) once; there the sums of an extract, and per
    key those of the newest extract that has the account or set, are plain aggregations.  An NC4S column
    is NULL, as a sum would be, only where nothing but NULLs of its own accounts add up.
    """
    version = "EXTRACT_DATE_ID"
    own = sorted({a for v in acc.nc4s.values() for a in v})
    cards = [a for v in acc.dda.values() for a in v]
    df = window_feed(feed, lo, hi).na.drop(subset=[*KEYS, "ACCOUNT", version])
    pre = preaggregate(df, [*KEYS, "ACCOUNT"], V, version, places).repartition(*KEYS)
    card_sql = f"ACCOUNT IN ({sql_list(cards)})"
    is_card = F.col("ACCOUNT").isin(cards)
    extracts = pre.groupBy(*KEYS, version).agg(
        *[F.expr(total_sql(f"CASE WHEN {card_sql} THEN CASE WHEN ACCOUNT IN ({sql_list(a)}) THEN `{V}` ELSE 0 END END", places)).alias(n)
          for n, a in acc.dda.items()],
        F.max(F.when(is_card, F.col(version))).alias("_cards"),
        F.max(~F.col("ACCOUNT").isin(own)).alias("_others"),
        *[F.sum(F.when(F.col("ACCOUNT") == a, F.col(V))).alias(f"_v{i}") for i, a in enumerate(own)],
        *[F.max(F.when(F.col("ACCOUNT") == a, F.col(version))).alias(f"_x{i}") for i, a in enumerate(own)],
    )
    # which own accounts the key has at all: one that a column doesn't list adds 0 to it
    newest = extracts.groupBy(*KEYS).agg(
        *[F.max_by(n, "_cards").alias(n) for n in acc.dda],
        F.max("_cards").alias("_cards"), F.max("_others").alias("_others"),
        *[F.max_by(f"_v{i}", f"_x{i}").alias(f"_v{i}") for i in range(len(own))],
        *[F.max(f"_x{i}").alias(f"_x{i}") for i in range(len(own))],
    )

    def column(accounts: list) -> Column:
        mine = [i for i, a in enumerate(own) if a in accounts]
        other = reduce(lambda x, y: x | y, [F.col(f"_x{i}").isNotNull() for i in range(len(own)) if i not in mine], F.col("_others"))
        some = reduce(lambda x, y: x | y, [F.col(f"_v{i}").isNotNull() for i in mine], other)
        return F.when(some & is_fact_center("CENTER"), reduce(lambda x, y: x + y, [c0(f"_v{i}") for i in mine], F.lit(0.0)))

    return newest.where(F.col("_cards").isNotNull() | is_fact_center("CENTER")).select(
        *KEYS, *acc.dda, *[column(v).alias(n) for n, v in acc.nc4s.items()])


def prepaid_component(feed, lo, hi, acc: OpsAccounts, places=None):
    return snapshot_sum(feed, lo, hi, acc.prepaid, "PREPAIDCARDSALEITEMS", places)


def bbk_component(feed, lo, hi, watch=None, places=None):
    df = window_feed(feed, lo, hi, center_rule=is_fact_center, watch=watch)
    sums = df.groupBy(*KEYS).agg(*[F.expr(total_sql(f"`{c}`", places)).alias(c)
                                   for c in [*BUY_BACKS, *BUY_BACK_OPPS, "CASH_SHORTS_PSD", "INTERNAL_AUDIT"]])
    return sums.select(*KEYS,
                       (c0(BUY_BACKS[0]) + c0(BUY_BACKS[1]) + c0(BUY_BACKS[2])).alias("BBK_ITEMS_CY"),
                       (c0(BUY_BACK_OPPS[0]) + c0(BUY_BACK_OPPS[1]) + c0(BUY_BACK_OPPS[2])).alias("BBK_OPP_ITEMS_CY"),
                       "CASH_SHORTS_PSD", "INTERNAL_AUDIT")


def cash_component(feed, lo, hi, places: int | None = None):
    """Newest extract per (center, *month*, account) (D6c).  The month is read
    whole before the snapshot (a later day of the month may carry the newest
    extract); the exact window applies after it."""
    lo_m = day_key(month_start(key_day(lo)))
    hi_m = day_key(last_day(key_day(hi)))
    df = window_feed(feed, lo_m, hi_m, center_rule=is_fact_center)
    version = "EXTRACT_DATE_ID"
    df = df.na.drop(subset=[*KEYS, "ACCOUNT", version])
    # per (center, month, account) at most ~31 days x a few extracts remain after
    # the pre-aggregation, so the window partitions are small whatever the skew
    pre = preaggregate(df, [*KEYS, "ACCOUNT"], V, version, places).withColumn("MONTH", F.expr("PERIOD div 100"))
    newest = F.max(version).over(Window.partitionBy("CENTER", "MONTH", "ACCOUNT"))
    latest = pre.withColumn("_NEWEST", newest).where(F.col(version) == F.col("_NEWEST"))
    return (latest.where(F.col("PERIOD").between(lo, hi))
            .groupBy(*KEYS).agg(F.expr(total_sql(f"`{V}`", places)).alias("AUDCASHSHORTS")))


def checks_component(feed, lo, hi, cast_to="double", watch=None, places=None):
    df = window_feed(feed, lo, hi, center_rule=is_fact_center, watch=watch)
    s = lambda c: _text_sum(c, cast_to, places)
    return df.groupBy(*KEYS).agg(
        (s("FORGERYRETURNEDVOLUME") - s("FORGERYCOLLECTVOLUME")).alias("FORGERIES_VOL"),
        s("CHECKCASHINGVOLUME").alias("CHECK_CASHING_VOL"),
        s("OPENLATE").alias("OPEN_LATE"),
        s("CLOSEEARLY").alias("CLOSE_EARLY"),
        F.sum("NO_OF_DAYS").alias("NO_DAYS_CY"))


def employees_component(feed, lo, hi, acc: OpsAccounts, places=None):
    return snapshot_pivot(feed, lo, hi, acc.employees, center_rule=is_fact_center, places=places)


def shops_component(feed, lo, hi, acc: OpsAccounts, places=None):
    return snapshot_pivot(feed, lo, hi, acc.shops, center_rule=is_fact_center, places=places)


def goal_rows(goals: DataFrame, clock: RunClock) -> DataFrame:
    """Goal cube rows of the run window, without the named roll-up members."""
    return goals.where(period_between(goals, clock.expiration_id, clock.goal_end_id) & ~is_rollup_member(F.col("CENTER")))


def goal_component(goals: DataFrame, clock: RunClock, acc: OpsAccounts, quarantine: Quarantine | None = None,
                   places: int | None = None) -> DataFrame:
    """Goal cube (D6a over all accounts, E4 cut-off, C3 roll-up exclusion).
    Snapshot on the raw text center; grouped on the *cast* center so '25' and
    '025' land in one row.  Members that name no center are left out
    (``reject_counts`` of the filtered feed counts them)."""
    rows = goal_rows(goals, clock)
    if quarantine is not None:
        rows = quarantine.watch("goals", rows, raw=goals.where(~is_rollup_member(F.col("CENTER"))))
    raw = rows.where(is_day_sql("try_cast(PERIOD AS INT)")).selectExpr(f"{whole_number_sql('CENTER')} AS _CENTER", "CENTER", "try_cast(PERIOD AS INT) AS PERIOD",
                                             "ACCOUNT", "GOAL_VALUE", "EXTRACT_DATE_ID").where("_CENTER IS NOT NULL")
    latest = newest_sums(raw, [*KEYS, "ACCOUNT"], {"GOAL_VALUE": None}, place=("_CENTER", "PERIOD"), places=places)
    latest = latest.selectExpr("_CENTER AS CENTER", "PERIOD", "ACCOUNT", "GOAL_VALUE")
    cutoff = {"FTDD_GOAL_MTD": f"PERIOD < {int(clock.end_id)}"}
    return pivot_accounts(latest, acc.goals, value="GOAL_VALUE", conditions=cutoff, places=places)


def lag_open_month(df: DataFrame, columns: list[str], clock: RunClock, drop_rows: bool = False) -> DataFrame:
    """One-day lag of the open month (the closed month is complete): late values become NULL, or
    their rows go."""
    late = (F.col("DAY") >= F.lit(clock.anchor)) & (F.col("DAY") >= F.lit(clock.lag_cutoff))
    if drop_rows:
        return df.where(~late)
    return df.withColumns({c: F.when(late, F.lit(None)).otherwise(F.col(c)) for c in columns})


def zero_fill(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.withColumns({c: c0(c) for c in columns})


# ---- last-year names ----------------------------------------------------------

# Last-year column -> the target column it reads.
LY_MAP = {
    **{f"{c}_LY": c for c in ["DBACHECKS", "PROMOTERS_NPS", "DETRACTORS_NPS", "PASSIVE_NPS"]},
    **{f"{c}_LY": c for c in STAFF_MAP},
    "FIRSTTIME_DDS_LY": "FIRSTTIME_DDS_CY",
    "DDAUPGRADES_LY": "DDAUPGRADES", "DDANEWCARD_LY": "DDANEWCARD",
    "PREPAIDCARDSALEITEMS_LY": "PREPAIDCARDSALEITEMS",
    "BBK_ITEMS_LY": "BBK_ITEMS_CY", "BBK_OPP_ITEMS_LY": "BBK_OPP_ITEMS_CY",
    "CASH_SHORTS_PSD_LY": "CASH_SHORTS_PSD", "INTERNAL_AUDIT_LY": "INTERNAL_AUDIT",
    "AUDCASHSHORTS_LY": "AUDCASHSHORTS",
    "FORGERIES_VOL_LY": "FORGERIES_VOL", "CHECK_CASHING_VOL_LY": "CHECK_CASHING_VOL",
    "OPEN_LATE_LY": "OPEN_LATE", "CLOSE_EARLY_LY": "CLOSE_EARLY", "NO_DAYS_LY": "NO_DAYS_CY",
    "NC4S_SALES_LY": "NC4S_SALES_CY", "NC4S_OPPS_LY": "NC4S_OPPS_CY",
    "ACTIVEEMPLOYEE_LY": "ACTIVEEMPLOYEE", "TERMINATEDEMPLOYEE_LY": "TERMINATEDEMPLOYEE",
    **{f"{c}_LY": c for c in ["EXPERIENCESHOPDENOMINATOR", "EXPERIENCESHOPNUMERATOR", "LOANSHOPDENOMINATOR",
                              "LOANSHOPNUMERATOR", "PHONESHOPDENOMINATOR", "PHONESHOPNUMERATOR"]},
}
# Columns whose missing values are 0.
ZERO_FILLED = ["DDAUPGRADES", "DDAUPGRADES_LY", "DDANEWCARD", "DDANEWCARD_LY",
               "PREPAIDCARDSALEITEMS", "PREPAIDCARDSALEITEMS_LY"]

# Target column order (without the load stamp).
OPS_OUTPUT_COLUMNS = [
    "CENTER", "PERIOD", "DATES",
    "DBACHECKS", "PROMOTERS_NPS", "DETRACTORS_NPS", "PASSIVE_NPS",
    "DBACHECKS_LY", "PROMOTERS_NPS_LY", "DETRACTORS_NPS_LY", "PASSIVE_NPS_LY",
    *STAFF_MAP, *[f"{c}_LY" for c in STAFF_MAP],
    "FIRSTTIME_DDS_CY", "FIRSTTIME_DDS_LY",
    "FTDD_GOAL_MTD", "CARDSALES_GOAL_MTD", "DAYS_MTD", "BBK_ITEMS_GOAL_MTD", "BBK_ITEMS_OPPS_GOAL_MTD",
    "DDAUPGRADES", "DDAUPGRADES_LY", "DDANEWCARD", "DDANEWCARD_LY",
    "PREPAIDCARDSALEITEMS_LY", "PREPAIDCARDSALEITEMS", "CARDSALES_CY", "CARDSALES_LY",
    "BBK_ITEMS_CY", "BBK_OPP_ITEMS_CY", "BBK_ITEMS_LY", "BBK_OPP_ITEMS_LY",
    "CASH_SHORTS_PSD", "INTERNAL_AUDIT", "CASH_SHORTS_PSD_LY", "INTERNAL_AUDIT_LY",
    "AUDCASHSHORTS", "AUDCASHSHORTS_LY",
    "FORGERIES_VOL", "FORGERIES_VOL_LY", "CHECK_CASHING_VOL", "NO_DAYS_CY", "OPEN_LATE", "CLOSE_EARLY",
    "CHECK_CASHING_VOL_LY", "NO_DAYS_LY", "OPEN_LATE_LY", "CLOSE_EARLY_LY",
    "NC4S_OPPS_CY", "NC4S_SALES_CY", "NC4S_OPPS_LY", "NC4S_SALES_LY",
    "ACTIVEEMPLOYEE", "ACTIVEEMPLOYEE_LY", "TERMINATEDEMPLOYEE", "TERMINATEDEMPLOYEE_LY",
    "EXPERIENCESHOPDENOMINATOR", "EXPERIENCESHOPNUMERATOR", "LOANSHOPDENOMINATOR", "LOANSHOPNUMERATOR",
    "PHONESHOPDENOMINATOR", "PHONESHOPNUMERATOR",
    "EXPERIENCESHOPDENOMINATOR_LY", "EXPERIENCESHOPNUMERATOR_LY", "LOANSHOPDENOMINATOR_LY",
    "LOANSHOPNUMERATOR_LY", "PHONESHOPDENOMINATOR_LY", "PHONESHOPNUMERATOR_LY",
    "TOTALSHOPSDEN", "TOTALSHOPSNUM", "TOTALSHOPSDEN_LY", "TOTALSHOPSNUM_LY",
    "EXTRACT_DATE_ID",
]


@dataclass
class OpsSources:
    hierarchy: DataFrame
    nps: DataFrame          # check-type / NPS account feed
    staff: DataFrame        # wide staffing metrics (text)
    dds: DataFrame          # direct-deposit account feed
    goals: DataFrame        # goal cube (text centers)
    dda: DataFrame          # DDA account feed (also NC4S)
    prepaid: DataFrame      # prepaid account feed
    visit: DataFrame        # wide visit metrics
    cash: DataFrame         # audit-cash account feed
    center: DataFrame       # wide center metrics (text)
    employees: DataFrame    # employee account feed
    shops: DataFrame        # mystery-shop account feed
    history: DataFrame      # the target itself


def spine_components(src: OpsSources, lo: int, hi: int, acc: OpsAccounts, cast_to: str = "double",
                     quarantine: Quarantine | None = None, places: int | None = None) -> list[DataFrame]:
    """The ten components on the spine; ``quarantine`` watches the three wide feeds; with ``places`` sums are order-free."""
    watch = lambda name, feed, numbers=(): watcher(quarantine, name, feed, numbers)
    return [
        nps_component(src.nps, lo, hi, acc, places),
        hours_component(src.staff, lo, hi, cast_to, watch("staff", src.staff, list(STAFF_MAP.values())), places),
        dds_component(src.dds, lo, hi, acc, places),
        dda_feed_component(src.dda, lo, hi, acc, places),
        prepaid_component(src.prepaid, lo, hi, acc, places),
        bbk_component(src.visit, lo, hi, watch("visit", src.visit), places),
        cash_component(src.cash, lo, hi, places),
        checks_component(src.center, lo, hi, cast_to, watch("center", src.center, CHECK_TEXTS), places),
        employees_component(src.employees, lo, hi, acc, places),
        shops_component(src.shops, lo, hi, acc, places),
    ]


def ops_target_schema() -> StructType:
    """Columns of the ops target (without the load stamp): for an empty target on a first run."""
    kinds = {"CENTER": IntegerType(), "PERIOD": IntegerType(), "DATES": DateType(), "EXTRACT_DATE_ID": IntegerType()}
    return StructType([StructField(c, kinds.get(c, DoubleType())) for c in OPS_OUTPUT_COLUMNS])


def ops_metrics(src: OpsSources, lo: int, hi: int, acc: OpsAccounts = OpsAccounts(),
                cast_to: str = "double", quarantine: Quarantine | None = None, places: int | None = None) -> DataFrame:
    """All spine components over [lo, hi], merged on (CENTER, PERIOD)."""
    return merge_metrics(spine_components(src, lo, hi, acc, cast_to, quarantine, places))


def run_ops_goals(src: OpsSources, clock: RunClock, acc: OpsAccounts = OpsAccounts(),
                  cast_to: str = "double", audit: AuditLog | None = None, quarantine: Quarantine | None = None,
                  places: int | None = None) -> DataFrame:
    """The job's output rows; with ``places`` the sums of DOUBLE feeds do not depend on the order of rows."""
    stage = audit.stage if audit else (lambda name, df: df)
    spine = stage("spine", build_spine(src.hierarchy, clock.start, clock.end))
    metrics = ops_metrics(src, clock.start_id, clock.end_id, acc, cast_to, quarantine, places)
    cur = spine.join(metrics, KEYS, "left")
    cur = with_last_year_two_regime(cur, src.history, LY_MAP, clock)
    cur = lag_open_month(cur, ["FIRSTTIME_DDS_CY", "FIRSTTIME_DDS_LY"], clock)
    cur = zero_fill(cur, ZERO_FILLED).drop("DAY")
    cur = stage("components", cur)
    goals = stage("goal", goal_component(src.goals, clock, acc, quarantine, places))
    merged = cur.join(goals, KEYS, "full")
    merged = derive_card_sales(derive_shop_totals(merged))
    out = clip_to_run_window(merged, clock.expiration_id, clock.goal_end_id)
    out = out.withColumns({"DATES": F.to_date(F.col("PERIOD").cast("string"), "yyyyMMdd"),
                           "EXTRACT_DATE_ID": F.lit(clock.extract_id)})
    return stage("insert", out.selectExpr(*[f"`{c}`" for c in OPS_OUTPUT_COLUMNS]))



def load_ops_goals(src, clock: RunClock, target: str, audit: AuditLog, acc: OpsAccounts = OpsAccounts(), cast_to: str = "double", *,
                   quarantine: Quarantine | None = None, restatement: bool = False, places: int | None = None,
                   lineage_user: str | None = None) -> int:
    """Job entry (I5): audit start, stage counts, stamped reload of the run
    window into ``target`` (partitioned by PERIOD), audit end; returns 0.
    Any failure is audited with its message and re-raised.  Unusable feed values are counted (``quarantine`` with a sink keeps
    them); ``restatement`` adds how the window differs from the old one; ``places``: order-free sums; ``lineage_user`` stamps rows with
    their first and last run."""
    quarantine = quarantine or Quarantine(clock.extract_id)
    return load_window(src.hierarchy.sparkSession, "ops_goals", audit, target, clock, restatement, quarantine,
                       lambda: run_ops_goals(src, clock, acc, cast_to, audit=audit, quarantine=quarantine, places=places), lineage_user)


__all__ = ["load_ops_goals", "OpsAccounts", "OpsSources", "run_ops_goals", "ops_metrics", "spine_components",
           "goal_component", "OPS_OUTPUT_COLUMNS", "LY_MAP"]
