"""DuckDB oracle SQL for every registered query.

Written in the warehouse's own shape on purpose, so it checks the Spark
plans rather than restating them: last year as two regime branches joined
with UNION ALL, snapshots as an inner join to the group max, the ops merge
as a 12-way FULL OUTER JOIN chain on coalesced keys, the reload as a
delete-then-insert expressed as a union.  Inputs are the same fixture
recipes (``daybook.sources.fixtures``) over the pre-registered views.
"""

from __future__ import annotations

import datetime as dt
from contextlib import contextmanager
from dataclasses import dataclass

from daybook import oracle_lists as M
from daybook.catalog import ALL_DAYS, BACKFILL_COLUMNS, EVENT_ACCOUNTS, EVENT_PIVOT, FIXTURE_ACCOUNTS, FIXTURE_PARAMS, KEY_COLUMNS
from daybook.sources.fixtures import CENTER_TEXT_COLUMNS, fixture_sql

ONE = dt.timedelta(days=1)


@dataclass
class Bounds:
    """Dates of one run, each written out (yyyymmdd)."""
    as_of_id: int
    extract_id: int
    expiration_id: int
    start_id: int
    anchor_id: int
    end_id: int
    plan_end_id: int
    month_end_id: int
    goal_end_id: int
    last_year: tuple

    def __getattr__(self, name: str) -> dt.date:
        return dt.datetime.strptime(str(self.__dict__[f"{name}_id"]), "%Y%m%d").date()


# The run dates by hand, not by the clock under test.
RUNS = {
    None: Bounds(20000315, 20000314, 20000201, 20000201, 20000301, 20000314, 20000331, 20000331, 20000314,
                 ((19990201, 19990228), (19990303, 19990316))),
    "day1": Bounds(20010301, 20010228, 20010101, 20010101, 20010201, 20010227, 20010227, 20010228, 20010227,
                   ((20000101, 20000131), (20000203, 20000229))),
    "day2": Bounds(20010302, 20010301, 20010101, 20010101, 20010201, 20010228, 20010228, 20010228, 20010300,
                   ((20000101, 20000131), (20000203, 20000301))),
    "november": Bounds(20001120, 20001119, 20001001, 20001001, 20001101, 20001119, 20001130, 20001130, 20001119,
                       ((19991001, 19991031), (19991103, 19991121))),
    "new_year": Bounds(20010110, 20010109, 20001201, 20001201, 20010101, 20010109, 20010131, 20010131, 20010109,
                       ((19991201, 19991231), (20000103, 20000111))),
    "same_day": Bounds(20000315, 20000315, 20000201, 20000201, 20000301, 20000314, 20000331, 20000331, 20000315,
                       ((19990201, 19990228), (19990303, 19990316))),
}
# Further run dates of the backfill.
BACKFILL_RUNS = {
    "april": Bounds(20000401, 20000331, 20000201, 20000201, 20000301, 20000330, 20000330, 20000331, 20000330,
                    ((19990201, 19990228), (19990303, 19990401))),
    "may": Bounds(20000531, 20000530, 20000401, 20000401, 20000501, 20000530, 20000531, 20000531, 20000530,
                  ((19990401, 19990430), (19990503, 19990601))),
    "august": Bounds(20000815, 20000814, 20000701, 20000701, 20000801, 20000814, 20000831, 20000831, 20000814,
                     ((19990701, 19990731), (19990803, 19990816))),
    "december": Bounds(20001202, 20001201, 20001001, 20001001, 20001101, 20001130, 20001130, 20001130, 20001200,
                       ((19991001, 19991031), (19991103, 19991202))),
    "january": Bounds(20010120, 20010119, 20001201, 20001201, 20010101, 20010119, 20010131, 20010131, 20010119,
                      ((19991201, 19991231), (20000103, 20000121))),
}
C = RUNS[None]


@contextmanager
def at(run: str | None):
    """Build SQL for another run date."""
    global C
    before, C = C, {**RUNS, **BACKFILL_RUNS}[run]
    try:
        yield
    finally:
        C = before


def d(x: dt.date) -> str:
    return f"DATE '{x.isoformat()}'"


def q(names) -> str:
    return ", ".join("'" + n.replace("'", "''") + "'" for n in names)


def hday(col: str) -> str:
    """yyyymmdd int column -> DATE."""
    return f"CAST(strptime(CAST({col} AS VARCHAR), '%Y%m%d') AS DATE)"


def dkey(expr: str) -> str:
    """DATE expression -> yyyymmdd int."""
    return f"CAST(strftime(CAST({expr} AS DATE), '%Y%m%d') AS INTEGER)"


def out(col: str) -> str:
    """Final projection: measures to DOUBLE, keys as they are."""
    return f'"{col}"' if col in KEY_COLUMNS or col in ("DATES", "ACCOUNT", "MESSAGE") else f'CAST("{col}" AS DOUBLE) AS "{col}"'


def final(cols: list[str], frm: str) -> str:
    return f"SELECT {', '.join(out(c) for c in cols)} FROM {frm}"


def with_(**ctes) -> str:
    return "WITH " + ",\n".join(f"{k} AS ({v})" for k, v in ctes.items()) + "\n"


FACT_RULE = "{c} >= 25 AND {c} NOT BETWEEN 5000 AND 5100"
OPER_RULE = "{c} >= 25 AND ({c} < 5000 OR {c} > 5999)"


# ---- revenue pieces -----------------------------------------------------------------

def rev_agg_cols(actual: bool) -> list[str]:
    names = ["NET_CHECK_FEES", "STORE_CHECK_COLLECTIONS", "STORE_CHECK_RETURNS", "TOTAL_INTEREST_INCOME",
             "LOAN_FIRST_RETURNS", "NET_LOAN_COLLECTIONS", "TOTAL_MONEY_SERVICES", *M.PLAIN_SUMS]
    return names + (M.ACTUAL_ONLY if actual else [])


DERIVED = ["NET_CHECK_COLLECTIONS", "CHECKLOSS", "NET_CHECK_REVENUE", "NET_LOAN_REVENUE", "LOAN_LOSS",
           "PPLOADFEESANDCARDSALES", "DDLOADFEESANDCARDSALES"]


def plain_sum(x: str) -> str:
    return f"SUM({x})"


def grid_sum(x: str) -> str:
    """Sum of the values as written out, to six decimals, in exact decimals; the double nearest to it."""
    return f"CAST(CAST(SUM(CAST(CAST(CAST({x} AS DOUBLE) AS VARCHAR) AS DECIMAL(38,6))) AS VARCHAR) AS DOUBLE)"


def rev_daily(feed: str, lo: int, hi: int, actual: bool, total=plain_sum) -> str:
    """Daily aggregate + check/loan/card derivations, warehouse shape."""
    s0 = lambda x: total(f"COALESCE({x},0)")
    aggs = [
        f"{s0('NET_CHECK_FEES')} + {s0('MOBILE_CHECK_ACE_FEES')} AS NET_CHECK_FEES",
        total("COALESCE(REGULAR_CHECK_COLLECT_VOLUME,0) + COALESCE(FORGERY_COLLECT_VOLUME,0)") + " AS STORE_CHECK_COLLECTIONS",
        total("(COALESCE(FORGERY_RETURNED_VOLUME,0) + COALESCE(REGULAR_CHECK_RETURNED_VOLUME,0)) * -1") + " AS STORE_CHECK_RETURNS",
        " + ".join(s0(x) for x in M.INTEREST_PARTS) + " AS TOTAL_INTEREST_INCOME",
        " + ".join(s0(x) for x in M.FIRST_RETURN_PARTS) + " AS LOAN_FIRST_RETURNS",
        " + ".join(s0(x) for x in M.COLLECTION_PARTS) + " AS NET_LOAN_COLLECTIONS",
        " + ".join(total(x) for x in ("MONEY_ORDER_FEES", "MONEY_GRAM_FEES", "BILL_PAYMENT_FEES")) + " AS TOTAL_MONEY_SERVICES",
        *[f"{total(x)} AS {x}" for x in M.PLAIN_SUMS + (M.ACTUAL_ONLY if actual else [])],
    ]
    inner = (f"SELECT CENTER, CAST(PERIOD AS INTEGER) AS PERIOD, {', '.join(aggs)} FROM {feed} "
             f"WHERE CAST(PERIOD AS INTEGER) BETWEEN {lo} AND {hi} AND {FACT_RULE.format(c='CENTER')} "
             f"GROUP BY CENTER, PERIOD")
    r, k, qq = ("COALESCE(REGULAR_CHECK_1ST_TIME_RETURNED_VOLUME,0)", "COALESCE(STORE_CHECK_COLLECTIONS,0)",
                "COALESCE(STORE_CHECK_RETURNS,0)")
    loss = "(COALESCE(LOAN_FIRST_RETURNS,0) - COALESCE(NET_LOAN_COLLECTIONS,0))"
    return (f"SELECT a.*, ({r} + {k} + {qq}) AS NET_CHECK_COLLECTIONS, "
            f"(({r} - ({r} + {k} + {qq})) * -1) AS CHECKLOSS, "
            f"COALESCE(NET_CHECK_FEES,0) + COALESCE(NET_TAX_FEES,0) + (({r} - ({r} + {k} + {qq})) * -1) AS NET_CHECK_REVENUE, "
            f"COALESCE(TOTAL_INTEREST_INCOME,0) - {loss} AS NET_LOAN_REVENUE, {loss} AS LOAN_LOSS, "
            f"(COALESCE(PREPAID_CARD_SALE_REVENUE,0) + COALESCE(PREPAID_STORE_LOAD_REVENUE,0)) AS PPLOADFEESANDCARDSALES, "
            f"(COALESCE(DDA_CARD_SALE_REVENUE,0) + COALESCE(DDA_STORE_LOAD_REVENUE,0)) AS DDLOADFEESANDCARDSALES "
            f"FROM ({inner}) a")


def spine_sql(hier: str = "hier") -> str:
    return (f"SELECT DISTINCT h.CENTER, {dkey('g.d')} AS PERIOD, CAST(g.d AS DATE) AS DAY "
            f"FROM {hier} h, generate_series({d(C.start)}, {d(C.end)}, INTERVAL 1 DAY) AS g(d) "
            f"WHERE {OPER_RULE.format(c='h.CENTER')}")


def two_regime(cur_cols: list[str], ly: dict[str, str], comp: str, hist: str, extra_open: str = "",
               spine: str = "spine") -> str:
    """Spine LEFT JOIN component LEFT JOIN history, closed month UNION ALL open month."""
    sel = ", ".join(["s.CENTER", "s.PERIOD", "s.DAY"] + [f"a.{c} AS {c}" for c in cur_cols]
                    + [f"b.{src} AS {dst}" for dst, src in ly.items()])
    base = (f"SELECT {sel} FROM {spine} s LEFT JOIN {comp} a ON s.CENTER = a.CENTER AND s.PERIOD = a.PERIOD "
            f"LEFT JOIN {hist} b ON s.CENTER = b.CENTER AND ")
    closed = base + f"CAST(s.DAY - INTERVAL 12 MONTH AS DATE) = {hday('b.PERIOD')} WHERE s.DAY < {d(C.anchor)}"
    opened = base + f"CAST(s.DAY - 364 AS DATE) = {hday('b.PERIOD')} WHERE s.DAY >= {d(C.anchor)}{extra_open}"
    return f"{closed} UNION ALL {opened}"


def revenue_ctes(plan: str | None = None) -> dict[str, str]:
    return {
        "feed_a": fixture_sql("daily_actual"),
        "feed_p": plan or fixture_sql("daily_plan"),
        "hier": fixture_sql("hierarchy"),
        "spine": spine_sql(),
        "checks": rev_daily("feed_a", C.start_id, C.end_id, True),
        "hist": rev_daily("feed_a", *ALL_DAYS, True),
        "actuals": two_regime(M.REVENUE_MEASURES, {M.ly_name(m): m for m in M.REVENUE_MEASURES}, "checks", "hist"),
        "plan": rev_daily("feed_p", C.start_id, C.plan_end_id, False),
    }


def revenue_data_sql() -> str:
    p = FIXTURE_PARAMS
    cols = ["COALESCE(a.CENTER, b.CENTER) AS CENTER", "COALESCE(a.PERIOD, b.PERIOD) AS PERIOD",
            f"{hday('COALESCE(a.PERIOD, b.PERIOD)')} AS DATES"]
    for m in M.REVENUE_MEASURES:
        if m == p.accrual_measure:
            cols.append(f"CASE WHEN COALESCE(a.PERIOD, b.PERIOD) > {p.accrual_since} AND "
                        f"{hday('COALESCE(a.PERIOD, b.PERIOD)')} < {d(C.as_of)} THEN COALESCE(b.{m},0) ELSE 0 END AS {m}")
        else:
            cols.append(f"COALESCE(a.{m},0) AS {m}")
        cols.append(f"COALESCE(a.{M.ly_name(m)},0) AS {M.ly_name(m)}")
        if M.has_plan(m):
            if m in p.override_measures:
                cols.append(f"CASE WHEN COALESCE(a.CENTER, b.CENTER) IN ({', '.join(map(str, p.override_centers))}) "
                            f"THEN 0 ELSE COALESCE(b.{m},0) END AS {m}_PLAN")
            else:
                cols.append(f"COALESCE(b.{m},0) AS {m}_PLAN")
    return (f"SELECT {', '.join(cols)} FROM actuals a FULL OUTER JOIN plan b "
            f"ON a.CENTER = b.CENTER AND a.PERIOD = b.PERIOD "
            f"WHERE COALESCE(a.PERIOD, b.PERIOD) >= {C.expiration_id} "
            f"AND {hday('COALESCE(a.PERIOD, b.PERIOD)')} <= {d(C.month_end)}")


def revenue_data_columns() -> list[str]:
    cols = ["CENTER", "PERIOD", "DATES"]
    for m in M.REVENUE_MEASURES:
        cols += [m, M.ly_name(m)] + ([m + "_PLAN"] if M.has_plan(m) else [])
    return cols


def card_rollup_sql() -> str:
    def nm(m, sfx):
        return M.ly_name(m) if sfx == "_LY" else m + sfx

    parts = []
    for sfx in ("", "_LY", "_PLAN"):
        x = "" if sfx == "_LY" else f" + COALESCE({nm(M.PREPAID_EXTRA[0], sfx)},0) + COALESCE({nm(M.PREPAID_EXTRA[1], sfx)},0)"
        elite = " + ".join(nm(m, sfx) for m in ["PPLOADFEESANDCARDSALES", "PREPAID_WITHDRAWAL_REVENUE"] + M.PREPAID_COMMISSIONS) + x
        dda = " + ".join(nm(m, sfx) for m in ["DDLOADFEESANDCARDSALES", "DDA_WITHDRAWAL_REVENUE"] + M.DDA_COMMISSIONS)
        comm = " + ".join(nm(m, sfx) for m in M.PREPAID_COMMISSIONS + M.DDA_COMMISSIONS) + x
        parts += [f"({nm('GREEN_DOT_LOAD_FEES', sfx)} + {nm('ATM_FEE', sfx)}) AS OTHERREVENUE{sfx}",
                  f"({elite}) AS ELITE{sfx}", f"({dda}) AS DDA{sfx}", f"({comm}) AS TOTALCOMM{sfx}"]
    inner = f"SELECT x.*, {', '.join(parts)} FROM data x"
    tot = ", ".join(f"ELITE{s} + DDA{s} + {nm('GREEN_DOT_LOAD_FEES', s)} + {nm('ATM_FEE', s)} AS TOTALCARDREV{s}"
                    for s in ("", "_LY", "_PLAN"))
    return f"SELECT y.*, {tot}, {C.extract_id} AS EXTRACT_DATE_ID FROM ({inner}) y WHERE y.PERIOD >= {C.expiration_id}"


# ---- ops pieces ---------------------------------------------------------------------

A = FIXTURE_ACCOUNTS


def snap_pivot(feed: str, lo: int, hi: int, cols: dict, rule: str, filter_accounts: bool,
               value: str = "DATA_VALUE") -> str:
    allacc = [a for v in cols.values() for a in v]
    where_b = f"WHERE ACCOUNT IN ({q(allacc)}) " if filter_accounts else ""
    piv = ", ".join(f"SUM(CASE WHEN a.ACCOUNT IN ({q(v)}) THEN a.{value} ELSE 0 END) AS {k}" for k, v in cols.items())
    return (f"SELECT a.CENTER, CAST(a.PERIOD AS INTEGER) AS PERIOD, {piv} FROM {feed} a JOIN "
            f"(SELECT PERIOD, CENTER, ACCOUNT, MAX(EXTRACT_DATE_ID) AS MAXID FROM {feed} {where_b}"
            f"GROUP BY PERIOD, CENTER, ACCOUNT) b ON a.PERIOD = b.PERIOD AND a.CENTER = b.CENTER "
            f"AND a.ACCOUNT = b.ACCOUNT AND a.EXTRACT_DATE_ID = b.MAXID "
            f"WHERE CAST(a.PERIOD AS INTEGER) BETWEEN {lo} AND {hi}" + (f" AND {rule.format(c='a.CENTER')}" if rule else "")
            + " GROUP BY a.CENTER, a.PERIOD")


def snap_set(feed: str, lo: int, hi: int, accounts: list, select: str) -> str:
    """Newest extract per (center, period) over an account set."""
    return (f"SELECT a.CENTER, CAST(a.PERIOD AS INTEGER) AS PERIOD, {select} FROM {feed} a JOIN "
            f"(SELECT CENTER, PERIOD, MAX(EXTRACT_DATE_ID) AS MAXID FROM {feed} WHERE ACCOUNT IN ({q(accounts)}) "
            f"AND CAST(PERIOD AS INTEGER) BETWEEN {lo} AND {hi} GROUP BY CENTER, PERIOD) b "
            f"ON a.CENTER = b.CENTER AND a.PERIOD = b.PERIOD AND a.EXTRACT_DATE_ID = b.MAXID "
            f"WHERE a.ACCOUNT IN ({q(accounts)}) AND CAST(a.PERIOD AS INTEGER) BETWEEN {lo} AND {hi} "
            f"GROUP BY a.CENTER, a.PERIOD")


STAFF = [("HOURSOVERSTAFFED", "HOURSOVERSTAFFED"), ("HOURSUNDERSTAFFED", "HOURSUNDERSTAFFED"),
         ("SCHEDULEDHOURS", "SCHEDULEDHOURS"), ("TOTALCMOT", "CM_OT"), ("TOTALSAOT", "SA_OT"),
         ("PAYDATEDAYS", "PAYDATE_DAYS"), ("CORPORATEAUDITSCOREDENOMINATOR", "CORP_SCORE_DEN"),
         ("CORPORATEAUDITSCORENUMERATOR", "CORP_SCORE_NUM"), ("CHECKITEMS", "CHECKITEMS")]
CAST_T = "DOUBLE"


def fl(x: str) -> str:
    return f"TRY_CAST({x} AS {CAST_T})"


def ops_components(lo: int, hi: int) -> dict[str, tuple[str, list[str]]]:
    """name -> (sql, value columns); window [lo, hi]."""
    win = f"CAST(PERIOD AS INTEGER) BETWEEN {lo} AND {hi}"
    fact = FACT_RULE.format(c="CENTER")
    dda_acc = [a for v in A.dda.values() for a in v]
    bb = ["STOREFRONT_PAYDAY_BUY_BACKS", "STOREFRONT_INSTALLMENT_BUY_BACKS", "STOREFRONT_TITLE_BUY_BACKS"]
    bo = ["STOREFRONT_PAYDAY_BUY_BACK_OPPORTUNITIES", "STOREFRONT_INSTALLMENT_BUY_BACK_OPPORTUNITIES",
          "STOREFRONT_TITLE_BUY_BACK_OPPORTUNITIES"]
    bbk_inner = (f"SELECT CENTER, CAST(PERIOD AS INTEGER) AS PERIOD, "
                 + ", ".join(f"SUM({x}) AS {x}" for x in bb + bo + ["CASH_SHORTS_PSD", "INTERNAL_AUDIT"])
                 + f" FROM visit WHERE {win} AND {fact} GROUP BY CENTER, PERIOD")
    cash = (f"SELECT a.CENTER, CAST(a.PERIOD AS INTEGER) AS PERIOD, SUM(a.DATA_VALUE) AS AUDCASHSHORTS FROM acct a JOIN "
            f"(SELECT CENTER, substring(PERIOD, 1, 6) AS MONTH, ACCOUNT, MAX(EXTRACT_DATE_ID) AS MAXID FROM acct "
            f"GROUP BY CENTER, ACCOUNT, substring(PERIOD, 1, 6)) b ON a.CENTER = b.CENTER "
            f"AND substring(a.PERIOD, 1, 6) = b.MONTH AND a.ACCOUNT = b.ACCOUNT AND a.EXTRACT_DATE_ID = b.MAXID "
            f"WHERE CAST(a.PERIOD AS INTEGER) BETWEEN {lo} AND {hi} AND {FACT_RULE.format(c='a.CENTER')} "
            f"GROUP BY a.CENTER, a.PERIOD")
    return {
        "nps": (snap_pivot("acct", lo, hi, A.nps, OPER_RULE, True), list(A.nps)),
        "hours": (f"SELECT CENTER, CAST(PERIOD AS INTEGER) AS PERIOD, "
                  + ", ".join(f"SUM({fl(s)}) AS {o}" for s, o in STAFF)
                  + f" FROM staff WHERE {win} AND {fact} GROUP BY CENTER, PERIOD", [o for _, o in STAFF]),
        "dds": (snap_set("acct", lo, hi, A.dds, "SUM(a.DATA_VALUE) AS FIRSTTIME_DDS_CY"), ["FIRSTTIME_DDS_CY"]),
        "dda": (snap_set("acct", lo, hi, dda_acc, ", ".join(
            f"SUM(CASE WHEN a.ACCOUNT IN ({q(v)}) THEN a.DATA_VALUE ELSE 0 END) AS {k}" for k, v in A.dda.items())),
            list(A.dda)),
        "prepaid": (snap_set("acct", lo, hi, A.prepaid, "SUM(a.DATA_VALUE) AS PREPAIDCARDSALEITEMS"),
                    ["PREPAIDCARDSALEITEMS"]),
        "bbk": (f"SELECT CENTER, PERIOD, "
                + " + ".join(f"COALESCE({x},0)" for x in bb) + " AS BBK_ITEMS_CY, "
                + " + ".join(f"COALESCE({x},0)" for x in bo) + " AS BBK_OPP_ITEMS_CY, "
                + f"CASH_SHORTS_PSD, INTERNAL_AUDIT FROM ({bbk_inner}) z",
                ["BBK_ITEMS_CY", "BBK_OPP_ITEMS_CY", "CASH_SHORTS_PSD", "INTERNAL_AUDIT"]),
        "cash": (cash, ["AUDCASHSHORTS"]),
        "checks": (f"SELECT CENTER, CAST(PERIOD AS INTEGER) AS PERIOD, "
                   f"SUM({fl('FORGERYRETURNEDVOLUME')}) - SUM({fl('FORGERYCOLLECTVOLUME')}) AS FORGERIES_VOL, "
                   f"SUM({fl('CHECKCASHINGVOLUME')}) AS CHECK_CASHING_VOL, SUM({fl('OPENLATE')}) AS OPEN_LATE, "
                   f"SUM({fl('CLOSEEARLY')}) AS CLOSE_EARLY, SUM(NO_OF_DAYS) AS NO_DAYS_CY "
                   f"FROM centerm WHERE {win} AND {fact} GROUP BY CENTER, PERIOD",
                   ["FORGERIES_VOL", "CHECK_CASHING_VOL", "OPEN_LATE", "CLOSE_EARLY", "NO_DAYS_CY"]),
        "nc4s": (snap_pivot("acct", lo, hi, A.nc4s, FACT_RULE, False), list(A.nc4s)),
        "employees": (snap_pivot("acct", lo, hi, A.employees, FACT_RULE, False), list(A.employees)),
        "shops": (snap_pivot("acct", lo, hi, A.shops, FACT_RULE, False), list(A.shops)),
    }


def whole(col: str) -> str:
    """Text center as an int, NULL where it is no whole number."""
    n = f"TRY_CAST({col} AS DOUBLE)"
    return f"CASE WHEN {n} = floor({n}) THEN CAST({n} AS INTEGER) END"


def goal_sql() -> str:
    cols = []
    for k, v in A.goals.items():
        cond = f"a.ACCOUNT IN ({q(v)})"
        if k == "FTDD_GOAL_MTD":
            cond = f"{hday('a.PERIOD')} < {d(C.end)} AND " + cond
        cols.append(f"SUM(CASE WHEN {cond} THEN a.GOAL_VALUE ELSE 0 END) AS {k}")
    return (f"SELECT {whole('a.CENTER')} AS CENTER, CAST(a.PERIOD AS INTEGER) AS PERIOD, {', '.join(cols)} "
            f"FROM goals a JOIN (SELECT PERIOD, CENTER, ACCOUNT, MAX(EXTRACT_DATE_ID) AS MAXID FROM goals "
            f"GROUP BY PERIOD, CENTER, ACCOUNT) b ON a.CENTER = b.CENTER AND a.PERIOD = b.PERIOD "
            f"AND a.ACCOUNT = b.ACCOUNT AND a.EXTRACT_DATE_ID = b.MAXID "
            f"WHERE CAST(a.PERIOD AS INTEGER) >= {C.expiration_id} AND CAST(a.PERIOD AS INTEGER) <= {C.goal_end_id} "
            f"AND a.CENTER NOT LIKE '%Centers' AND a.CENTER NOT LIKE 'D%' AND {whole('a.CENTER')} IS NOT NULL "
            f"GROUP BY {whole('a.CENTER')}, CAST(a.PERIOD AS INTEGER)")


def foj_chain(names: list[str], cols: dict[str, list[str]]) -> str:
    """FULL OUTER JOIN chain with progressively coalesced keys."""
    sel_keys = [f"COALESCE({', '.join(n + '.CENTER' for n in names)}) AS CENTER",
                f"COALESCE({', '.join(n + '.PERIOD' for n in names)}) AS PERIOD"]
    sel = sel_keys + [f"{n}.{c} AS {c}" for n in names for c in cols[n]]
    frm = names[0]
    for i, n in enumerate(names[1:], 1):
        prev = names[:i]
        ck = f"COALESCE({', '.join(p + '.CENTER' for p in prev)})" if len(prev) > 1 else f"{prev[0]}.CENTER"
        pk = f"COALESCE({', '.join(p + '.PERIOD' for p in prev)})" if len(prev) > 1 else f"{prev[0]}.PERIOD"
        frm += f" FULL OUTER JOIN {n} ON {ck} = {n}.CENTER AND {pk} = {n}.PERIOD"
    return f"SELECT {', '.join(sel)} FROM {frm}"


OPS_LY = {
    "nps": {f"{c}_LY": c for c in A.nps},
    "hours": {f"{o}_LY": o for _, o in STAFF},
    "dds": {"FIRSTTIME_DDS_LY": "FIRSTTIME_DDS_CY"},
    "dda": {"DDAUPGRADES_LY": "DDAUPGRADES", "DDANEWCARD_LY": "DDANEWCARD"},
    "prepaid": {"PREPAIDCARDSALEITEMS_LY": "PREPAIDCARDSALEITEMS"},
    "bbk": {"BBK_ITEMS_LY": "BBK_ITEMS_CY", "BBK_OPP_ITEMS_LY": "BBK_OPP_ITEMS_CY",
            "CASH_SHORTS_PSD_LY": "CASH_SHORTS_PSD", "INTERNAL_AUDIT_LY": "INTERNAL_AUDIT"},
    "cash": {"AUDCASHSHORTS_LY": "AUDCASHSHORTS"},
    "checks": {"FORGERIES_VOL_LY": "FORGERIES_VOL", "CHECK_CASHING_VOL_LY": "CHECK_CASHING_VOL",
               "OPEN_LATE_LY": "OPEN_LATE", "CLOSE_EARLY_LY": "CLOSE_EARLY", "NO_DAYS_LY": "NO_DAYS_CY"},
    "nc4s": {"NC4S_SALES_LY": "NC4S_SALES_CY", "NC4S_OPPS_LY": "NC4S_OPPS_CY"},
    "employees": {f"{c}_LY": c for c in A.employees},
    "shops": {f"{c}_LY": c for c in A.shops},
}
ORDER = ["nps", "hours", "dds", "dda", "prepaid", "bbk", "cash", "checks", "nc4s", "employees", "shops"]


def ops_base_ctes() -> dict[str, str]:
    return {"acct": fixture_sql("account_feed"), "staff": fixture_sql("staff_metrics"),
            "visit": fixture_sql("visit_metrics"), "centerm": fixture_sql("center_metrics"),
            "goals": fixture_sql("goals"), "hier": fixture_sql("hierarchy")}


def ops_history_ctes() -> dict[str, str]:
    spans = C.last_year
    lo, hi = min(s[0] for s in spans), max(s[1] for s in spans)
    comps = ops_components(lo, hi)
    ctes = {f"h_{n}": sql for n, (sql, _) in comps.items()}
    ctes["hist"] = foj_chain([f"h_{n}" for n in ORDER], {f"h_{n}": comps[n][1] for n in ORDER})
    return ctes


def ops_stage(n: str, cols: list[str]) -> str:
    """One component on the spine with last-year columns (warehouse shape)."""
    lag = f" AND s.DAY < {d(C.as_of - ONE)}" if n == "dds" else ""
    body = two_regime(cols, OPS_LY[n], f"c_{n}", "hist", extra_open=lag)
    if n in ("dda", "prepaid"):
        allc = cols + list(OPS_LY[n])
        sel = ", ".join(["CENTER", "PERIOD"] + [f"COALESCE({c},0) AS {c}" for c in allc])
        closed, opened = body.split(" UNION ALL ")
        return f"SELECT DISTINCT {sel} FROM ({closed}) x UNION ALL SELECT DISTINCT {sel} FROM ({opened}) y"
    return f"SELECT CENTER, PERIOD, {', '.join(cols + list(OPS_LY[n]))} FROM ({body}) z"


def ops_goals_sql(first_run: bool = False) -> str:
    comps = ops_components(C.start_id, C.end_id)
    ctes = {**ops_base_ctes(), **ops_history_ctes(), "spine": spine_sql()}
    if first_run:
        ctes["hist"] += " WHERE 1 = 0"
    ctes.update({f"c_{n}": comps[n][0] for n in ORDER})
    ctes.update({f"s_{n}": ops_stage(n, comps[n][1]) for n in ORDER})
    ctes["s_goal"] = goal_sql()
    chain_order = ["nps", "hours", "dds", "goal", "dda", "prepaid", "bbk", "cash", "checks", "nc4s", "employees", "shops"]
    cols = {f"s_{n}": (comps[n][1] + list(OPS_LY[n]) if n != "goal" else list(A.goals)) for n in chain_order}
    ctes["findata"] = foj_chain([f"s_{n}" for n in chain_order], cols)
    den = ["EXPERIENCESHOPDENOMINATOR", "LOANSHOPDENOMINATOR", "PHONESHOPDENOMINATOR"]
    num = ["EXPERIENCESHOPNUMERATOR", "LOANSHOPNUMERATOR", "PHONESHOPNUMERATOR"]

    def tot(xs):
        return " + ".join(f"COALESCE({x},0)" for x in xs)
    ctes["ins"] = (f"SELECT f.*, {hday('PERIOD')} AS DATES, {tot(den)} AS TOTALSHOPSDEN, {tot(num)} AS TOTALSHOPSNUM, "
                   f"{tot([x + '_LY' for x in den])} AS TOTALSHOPSDEN_LY, {tot([x + '_LY' for x in num])} AS TOTALSHOPSNUM_LY, "
                   f"DDANEWCARD + PREPAIDCARDSALEITEMS AS CARDSALES_CY, DDANEWCARD_LY + PREPAIDCARDSALEITEMS_LY AS CARDSALES_LY, "
                   f"{C.extract_id} AS EXTRACT_DATE_ID FROM findata f "
                   f"WHERE PERIOD >= {C.expiration_id} AND PERIOD <= {C.goal_end_id}")
    return with_(**ctes) + final(M.OPS_OUTPUT_COLUMNS, "ins")


# ---- per-query SQL --------------------------------------------------------------------

def sql_run_clock() -> str:
    ae = "e.AS_OF"
    end = f"CASE WHEN day({ae}) <= 2 THEN CAST({ae} - 2 AS DATE) ELSE CAST({ae} - 1 AS DATE) END"
    return with_(cal=fixture_sql("calendar"),
                 ext="SELECT CALENDAR_DATE_ID AS EXTRACT_DATE_ID, CALENDAR_DATE AS EXTRACT_DATE, "
                     "CAST(CALENDAR_DATE + 1 AS DATE) AS AS_OF FROM cal") + (
        f"SELECT e.AS_OF, e.EXTRACT_DATE_ID, x.CALENDAR_DATE_ID AS EXPIRATION_DATE_ID, x.CALENDAR_DATE AS EXPIRATION_DATE, "
        f"CAST(date_trunc('month', CAST({ae} - 2 AS DATE)) - INTERVAL 1 MONTH AS DATE) AS WINDOW_START, "
        f"CAST(date_trunc('month', CAST({ae} - 2 AS DATE)) AS DATE) AS ANCHOR, {end} AS WINDOW_END, "
        f"CASE WHEN day({ae}) <= 2 THEN CAST({ae} - 2 AS DATE) ELSE CAST(last_day(CAST({ae} - 1 AS DATE)) AS DATE) END AS PLAN_END, "
        f"CAST(last_day({end}) AS DATE) AS MONTH_END, "
        f"CASE WHEN day({ae}) <= 2 THEN e.EXTRACT_DATE_ID - 1 ELSE e.EXTRACT_DATE_ID END AS GOAL_END_ID "
        f"FROM ext e JOIN cal x ON x.CALENDAR_DATE = "
        f"CAST(date_trunc('month', CAST(e.EXTRACT_DATE - 1 - INTERVAL 1 MONTH AS DATE)) AS DATE)")


def sql_center_day_spine() -> str:
    return with_(hier=fixture_sql("hierarchy"), spine=spine_sql()) + "SELECT CENTER, PERIOD, DAY AS DATES FROM spine"


def sql_fact_center_filter() -> str:
    return with_(f=fixture_sql("daily_actual")) + (
        f"SELECT CENTER, COUNT(*) AS N_ROWS, CAST(SUM(ATM_FEE) AS DOUBLE) AS ATM_FEE FROM f "
        f"WHERE {FACT_RULE.format(c='CENTER')} GROUP BY CENTER")


def sql_rollup_member_filter() -> str:
    return with_(g=fixture_sql("goals")) + (
        f"SELECT {whole('CENTER')} AS CENTER, COUNT(*) AS N_ROWS, CAST(SUM(GOAL_VALUE) AS DOUBLE) AS GOAL_VALUE FROM g "
        f"WHERE CENTER NOT LIKE '%Centers' AND CENTER NOT LIKE 'D%' AND {whole('CENTER')} IS NOT NULL GROUP BY {whole('CENTER')}")


def sql_daily_actual_measures() -> str:
    return with_(feed_a=fixture_sql("daily_actual"), h=rev_daily("feed_a", *ALL_DAYS, True)) + final(
        ["CENTER", "PERIOD"] + rev_agg_cols(True), "h")


def sql_order_free(feed: str, lo: int, hi: int, actual: bool) -> str:
    return with_(feed=fixture_sql(feed), h=rev_daily("feed", lo, hi, actual, total=grid_sum)) + final(
        ["CENTER", "PERIOD"] + rev_agg_cols(actual) + DERIVED, "h")


def sql_order_free_newest_sums() -> str:
    keys = "CENTER, PERIOD, ACCOUNT"
    return with_(f=f"SELECT CENTER, CAST(PERIOD AS INTEGER) AS PERIOD, ACCOUNT, DATA_VALUE, EXTRACT_DATE_ID FROM ({fixture_sql('account_feed_thirds')}) a",
                 m=f"SELECT {keys}, MAX(EXTRACT_DATE_ID) AS EXTRACT_DATE_ID FROM f GROUP BY {keys}",
                 t=f"SELECT {keys}, {grid_sum('DATA_VALUE')} AS DATA_VALUE FROM f JOIN m USING ({keys}, EXTRACT_DATE_ID) GROUP BY {keys}",
                 ) + final(["CENTER", "PERIOD", "ACCOUNT", "DATA_VALUE"], "t")


def sql_run_lineage() -> str:
    return with_(f=f"SELECT CENTER, CAST(PERIOD AS INTEGER) AS PERIOD, COUNT(*) AS N_ROWS FROM ({fixture_sql('daily_actual')}) a "
                   f"WHERE CAST(PERIOD AS INTEGER) >= {C.expiration_id} GROUP BY CENTER, PERIOD") + (
        "SELECT CENTER, PERIOD, N_ROWS, "
        "CAST(CASE WHEN CENTER % 2 <> 0 THEN 953000000 WHEN PERIOD % 3 <> 0 THEN 951868800 + CENTER ELSE 952000000 + CENTER END AS VARCHAR) "
        "AS DW_CREATED_DATETIME, CASE WHEN CENTER % 2 <> 0 THEN 'second' WHEN PERIOD % 3 <> 0 THEN 'first' END AS DW_CREATED_BY, "
        "'953000000' AS DW_MOD_DATETIME, 'second' AS DW_MOD_BY FROM f")


def sql_check_loan_card_derivations() -> str:
    return with_(feed_a=fixture_sql("daily_actual"), h=rev_daily("feed_a", *ALL_DAYS, True)) + final(
        ["CENTER", "PERIOD"] + DERIVED, "h")


def sql_daily_plan_to_month_end() -> str:
    return with_(feed_p=fixture_sql("daily_plan"), p=rev_daily("feed_p", C.start_id, C.plan_end_id, False)) + final(
        ["CENTER", "PERIOD"] + rev_agg_cols(False) + DERIVED, "p")


def _sql_yoy(which: str) -> str:
    ly = {M.ly_name(m): m for m in M.REVENUE_MEASURES}
    ctes = {"feed_a": fixture_sql("daily_actual"), "hier": fixture_sql("hierarchy"), "spine": spine_sql(),
            "hist": rev_daily("feed_a", *ALL_DAYS, True), "nocomp": "SELECT 0 AS CENTER, 0 AS PERIOD WHERE 1 = 0"}
    body = two_regime([], ly, "nocomp", "hist")
    closed, opened = body.split(" UNION ALL ")
    pick = {"calendar": closed, "weekday": opened, "both": body}[which]
    return with_(**ctes) + final(["CENTER", "PERIOD", *ly], f"({pick}) t")


def sql_snapshot(grain: str) -> str:
    if grain == "cpa":
        f = ("SELECT TRY_CAST(CENTER AS INTEGER) AS CENTER, CAST(PERIOD AS INTEGER) AS PERIOD, ACCOUNT, DATA_VALUE, "
             "EXTRACT_DATE_ID FROM ev")
        return with_(ev=fixture_sql("events_feed"), f=f) + final(
            ["CENTER", "PERIOD", "ACCOUNT", "DATA_VALUE", "EXTRACT_DATE_ID"],
            "(SELECT a.* FROM f a JOIN (SELECT PERIOD, CENTER, ACCOUNT, MAX(EXTRACT_DATE_ID) AS MAXID FROM f "
            "GROUP BY PERIOD, CENTER, ACCOUNT) b ON a.PERIOD = b.PERIOD AND a.CENTER = b.CENTER "
            "AND a.ACCOUNT = b.ACCOUNT AND a.EXTRACT_DATE_ID = b.MAXID) t")
    if grain == "cp":
        f = ("SELECT TRY_CAST(CENTER AS INTEGER) AS CENTER, CAST(PERIOD AS INTEGER) AS PERIOD, ACCOUNT, DATA_VALUE, "
             f"EXTRACT_DATE_ID FROM ev WHERE ACCOUNT IN ({q(EVENT_ACCOUNTS)})")
        return with_(ev=fixture_sql("events_feed"), f=f) + final(
            ["CENTER", "PERIOD", "ACCOUNT", "DATA_VALUE", "EXTRACT_DATE_ID"],
            "(SELECT a.* FROM f a JOIN (SELECT CENTER, PERIOD, MAX(EXTRACT_DATE_ID) AS MAXID FROM f "
            "GROUP BY CENTER, PERIOD) b ON a.CENTER = b.CENTER AND a.PERIOD = b.PERIOD "
            "AND a.EXTRACT_DATE_ID = b.MAXID) t")
    f = ("SELECT CENTER, PERIOD AS RAW_PERIOD, CAST(PERIOD AS INTEGER) AS PERIOD, ACCOUNT, DATA_VALUE, EXTRACT_DATE_ID, "
         "CAST(substring(PERIOD, 1, 6) AS INTEGER) AS MONTH FROM acct")
    return with_(acct=fixture_sql("account_feed"), f=f) + final(
        ["CENTER", "PERIOD", "ACCOUNT", "DATA_VALUE", "EXTRACT_DATE_ID", "MONTH"],
        "(SELECT a.* FROM f a JOIN (SELECT CENTER, substring(RAW_PERIOD, 1, 6) AS M6, ACCOUNT, "
        "MAX(EXTRACT_DATE_ID) AS MAXID FROM f GROUP BY CENTER, ACCOUNT, substring(RAW_PERIOD, 1, 6)) b "
        "ON a.CENTER = b.CENTER AND substring(a.RAW_PERIOD, 1, 6) = b.M6 AND a.ACCOUNT = b.ACCOUNT "
        "AND a.EXTRACT_DATE_ID = b.MAXID) t")


def sql_account_pivot() -> str:
    f = ("SELECT TRY_CAST(CENTER AS INTEGER) AS CENTER, CAST(PERIOD AS INTEGER) AS PERIOD, ACCOUNT, DATA_VALUE, "
         "EXTRACT_DATE_ID FROM ev")
    return with_(ev=fixture_sql("events_feed"), f=f, p=snap_pivot("f", *ALL_DAYS, EVENT_PIVOT, "", False)) + final(
        ["CENTER", "PERIOD", *EVENT_PIVOT], "p")


def sql_goal_pivot_cutoff() -> str:
    return with_(goals=fixture_sql("goals"), g=goal_sql()) + final(["CENTER", "PERIOD", *A.goals], "g")


def _sql_component(name: str, base: dict) -> str:
    comps = ops_components(*ALL_DAYS)
    sql, cols = comps[name]
    return with_(**base, c=sql) + final(["CENTER", "PERIOD", *cols], "c")


def sql_lagged_open_month() -> str:
    comps = ops_components(C.start_id, C.end_id)
    ctes = {**ops_base_ctes(), **ops_history_ctes(), "spine": spine_sql(), "c_dds": comps["dds"][0],
            "s_dds": ops_stage("dds", comps["dds"][1])}
    return with_(**ctes) + final(["CENTER", "PERIOD", "FIRSTTIME_DDS_CY", "FIRSTTIME_DDS_LY"], "s_dds")


def sql_distinct_zero_fill_union() -> str:
    comps = ops_components(C.start_id, C.end_id)
    ctes = {**ops_base_ctes(), **ops_history_ctes(), "spine": spine_sql(), "c_dda": comps["dda"][0],
            "s_dda": ops_stage("dda", comps["dda"][1])}
    return with_(**ctes) + final(["CENTER", "PERIOD", "DDAUPGRADES", "DDAUPGRADES_LY", "DDANEWCARD",
                                  "DDANEWCARD_LY"], "s_dda")


def _sql_revenue(select_cols: list[str], with_rollups: bool, first_run: bool = False) -> str:
    ctes = {**revenue_ctes(), "data": revenue_data_sql()}
    if first_run:
        ctes["hist"] = f"SELECT * FROM ({ctes['hist']}) h WHERE 1 = 0"
    if with_rollups:
        ctes["ins"] = card_rollup_sql()
        return with_(**ctes) + final(select_cols, "ins")
    return with_(**ctes) + final(select_cols, "data")


def sql_metric_merge_12way() -> str:
    comps = ops_components(C.start_id, C.end_id)
    ctes = {**ops_base_ctes(), **{f"c_{n}": comps[n][0] for n in ORDER}, "c_goal": goal_sql()}
    names = ["c_nps", "c_hours", "c_dds", "c_goal"] + [f"c_{n}" for n in ORDER[3:]]
    cols = {f"c_{n}": comps[n][1] for n in ORDER}
    cols["c_goal"] = list(A.goals)
    ctes["m"] = foj_chain(names, cols)
    allc = [c for n in names for c in cols[n]]
    ctes["t"] = f"SELECT m.*, {shop_totals([''])}, DDANEWCARD + PREPAIDCARDSALEITEMS AS CARDSALES_CY FROM m"
    return with_(**ctes) + final(["CENTER", "PERIOD", *allc, "TOTALSHOPSDEN", "TOTALSHOPSNUM", "CARDSALES_CY"], "t")


def shop_totals(years) -> str:
    return ", ".join(" + ".join(f"COALESCE({x}SHOP{kind}{y},0)" for x in ("EXPERIENCE", "LOAN", "PHONE")) + f" AS TOTALSHOPS{short}{y}"
                     for y in years for kind, short in (("DENOMINATOR", "DEN"), ("NUMERATOR", "NUM")))


def sql_shop_card_totals() -> str:
    comps = ops_components(C.start_id, C.end_id)
    names = ["shops", "dda", "prepaid"]
    ctes = {**ops_base_ctes(), **ops_history_ctes(), "spine": spine_sql(), **{f"c_{n}": comps[n][0] for n in names}}
    ctes["now"] = foj_chain([f"c_{n}" for n in names], {f"c_{n}": comps[n][1] for n in names})
    cols = [c for n in names for c in comps[n][1]]
    ctes["cur"] = two_regime(cols, {k: v for n in names for k, v in OPS_LY[n].items()}, "now", "hist")
    ctes["t"] = (f"SELECT *, {shop_totals(['', '_LY'])}, DDANEWCARD + PREPAIDCARDSALEITEMS AS CARDSALES_CY, "
                 "DDANEWCARD_LY + PREPAIDCARDSALEITEMS_LY AS CARDSALES_LY FROM cur")
    return with_(**ctes) + final(["CENTER", "PERIOD", *[f"TOTALSHOPS{k}{y}" for k in ("DEN", "NUM") for y in ("", "_LY")],
                                  "CARDSALES_CY", "CARDSALES_LY"], "t")


def sql_window_reload() -> str:
    cols = ["CENTER", "PERIOD", *M.REVENUE_MEASURES]
    ctes = {**revenue_ctes(), "data": revenue_data_sql(), "ins": card_rollup_sql(),
            "r": (f"SELECT {', '.join(cols)} FROM hist WHERE PERIOD < {C.expiration_id} "
                  f"UNION ALL SELECT {', '.join(cols)} FROM ins")}
    return with_(**ctes) + final(cols, "r")


def sql_newest_sums_day_account() -> str:
    f = ("SELECT CENTER, CAST(PERIOD AS INTEGER) AS PERIOD, ACCOUNT, DATA_VALUE, EXTRACT_DATE_ID FROM acct")
    t = ("SELECT a.CENTER, a.PERIOD, a.ACCOUNT, SUM(a.DATA_VALUE) AS DATA_VALUE FROM f a JOIN (SELECT CENTER, PERIOD, ACCOUNT, "
         "MAX(EXTRACT_DATE_ID) AS MAXID FROM f GROUP BY CENTER, PERIOD, ACCOUNT) b ON a.CENTER = b.CENTER AND a.PERIOD = b.PERIOD "
         "AND a.ACCOUNT = b.ACCOUNT AND a.EXTRACT_DATE_ID = b.MAXID GROUP BY a.CENTER, a.PERIOD, a.ACCOUNT")
    return with_(acct=fixture_sql("account_feed"), f=f, t=t) + final(["CENTER", "PERIOD", "ACCOUNT", "DATA_VALUE"], "t")


def sql_newest_sums_day() -> str:
    sql, cols = ops_components(*ALL_DAYS)["dda"]
    return with_(acct=fixture_sql("account_feed"), t=sql) + final(["CENTER", "PERIOD", *cols], "t")


def sql_text_center_feed() -> str:
    keyed = (f"SELECT {whole('CENTER')} AS CENTER, TRY_CAST(PERIOD AS INTEGER) AS PERIOD, "
             + ", ".join([*CENTER_TEXT_COLUMNS, "NO_OF_DAYS"]) + " FROM tc")
    sql, cols = ops_components(*ALL_DAYS)["checks"]
    return with_(tc=fixture_sql("text_center_metrics"), centerm=keyed, c=sql) + final(["CENTER", "PERIOD", *cols], "c")


def sql_reject_counts() -> str:
    g = "goals WHERE CENTER NOT LIKE '%Centers' AND CENTER NOT LIKE 'D%'"
    fields = [("goals", "CENTER", whole("CENTER"), g), ("goals", "PERIOD", "TRY_CAST(PERIOD AS INTEGER)", g)]
    fields += [("text_center_metrics", "CENTER", whole("CENTER"), "tc"),
               ("text_center_metrics", "PERIOD", "TRY_CAST(PERIOD AS INTEGER)", "tc")]
    fields += [("text_center_metrics", c, f"TRY_CAST({c} AS DOUBLE)", "tc") for c in CENTER_TEXT_COLUMNS]
    body = " UNION ALL ".join(f"SELECT '{feed}' AS FEED, '{c}' AS FIELD, COUNT(*) FILTER (WHERE {c} IS NOT NULL AND ({e}) IS NULL) AS N_ROWS "
                              f"FROM {frm}" for feed, c, e, frm in fields)
    return with_(goals=fixture_sql("goals"), tc=fixture_sql("text_center_metrics"), r=body) + "SELECT * FROM r WHERE N_ROWS > 0"


def sql_rejects_quarantine() -> str:
    day = lambda c: f"CASE WHEN length(CAST({c} AS VARCHAR)) = 8 THEN try_strptime(CAST({c} AS VARCHAR), '%Y%m%d') END"
    g = "goals WHERE CENTER NOT LIKE '%Centers' AND CENTER NOT LIKE 'D%'"
    fields = [(feed, c, e, frm) for feed, frm in (("goals", g), ("text_center_metrics", "tc"), ("plan", "plan"))
              for c, e in (("CENTER", "CASE WHEN TRY_CAST(CENTER AS DOUBLE) = floor(TRY_CAST(CENTER AS DOUBLE)) THEN 1 END"), ("PERIOD", day("PERIOD")))]
    fields += [("text_center_metrics", c, f"TRY_CAST({c} AS DOUBLE)", "tc") for c in CENTER_TEXT_COLUMNS]
    body = " UNION ALL ".join(f"SELECT '{feed}' AS FEED, '{c}' AS FIELD, CAST({c} AS VARCHAR) AS VALUE, COUNT(*) AS N_ROWS FROM (SELECT * FROM {frm}) x "
                              f"WHERE {c} IS NOT NULL AND ({e}) IS NULL GROUP BY 3" for feed, c, e, frm in fields)
    return with_(goals=fixture_sql("goals"), tc=fixture_sql("text_center_metrics"), plan=fixture_sql("daily_plan_odd_keys"), r=body) + "SELECT * FROM r"


def sql_revenue_odd_plan_keys() -> str:
    """Usable rows only: whole centers, days of the calendar."""
    usable = (f"SELECT * REPLACE (CAST(CENTER AS INTEGER) AS CENTER) FROM ({fixture_sql('daily_plan_odd_keys')}) x WHERE CENTER = floor(CENTER) "
              "AND try_strptime(CAST(PERIOD AS VARCHAR), '%Y%m%d') IS NOT NULL")
    ctes = {**revenue_ctes(plan=usable), "data": revenue_data_sql(), "ins": card_rollup_sql()}
    return with_(**ctes) + final(M.revenue_output_columns(), "ins")


def sql_window_restatement() -> str:
    """By a full outer join of old and new window, column by column."""
    cols = ", ".join(f'"{m}"' for m in M.REVENUE_MEASURES)
    differs = " OR ".join(f'CAST(o."{m}" AS DOUBLE) IS DISTINCT FROM CAST(n."{m}" AS DOUBLE)' for m in M.REVENUE_MEASURES)
    ctes = {**revenue_ctes(), "data": revenue_data_sql(), "ins": card_rollup_sql(),
            "o": f"SELECT CENTER, PERIOD, {cols} FROM hist WHERE PERIOD >= {C.expiration_id}", "n": f"SELECT CENTER, PERIOD, {cols} FROM ins"}
    return with_(**ctes) + (
        "SELECT COALESCE(o.PERIOD, n.PERIOD) AS PERIOD, COUNT(*) FILTER (WHERE o.CENTER IS NULL) AS N_ADDED, "
        f"COUNT(*) FILTER (WHERE o.CENTER IS NOT NULL AND n.CENTER IS NOT NULL AND ({differs})) AS N_CHANGED, "
        "COUNT(*) FILTER (WHERE n.CENTER IS NULL) AS N_GONE, "
        f"COUNT(*) FILTER (WHERE o.CENTER IS NOT NULL AND n.CENTER IS NOT NULL AND NOT ({differs})) AS N_SAME "
        "FROM o FULL OUTER JOIN n ON o.CENTER = n.CENTER AND o.PERIOD = n.PERIOD GROUP BY 1")


def sql_backfill_windows() -> str:
    """One run after the other, each as its own statement (the run of 2000-03-15 once, with the extract of the day before)."""
    parts = []
    for run in [r for r in {**RUNS, **BACKFILL_RUNS} if r != "same_day"]:
        with at(run):
            one = _sql_revenue(["CENTER", "PERIOD", "DATES", "EXTRACT_DATE_ID", *BACKFILL_COLUMNS], True)
            parts.append(f"SELECT {d(C.as_of)} AS AS_OF, r.* FROM ({one}) r")
    return " UNION ALL ".join(parts)


def sql_snapshot_state_steps() -> str:
    """All extracts at once, by an inner join with the newest."""
    f = "SELECT * REPLACE (CAST(PERIOD AS INTEGER) AS PERIOD, EXTRACT_DATE_ID - CAST(PERIOD AS INTEGER) + 1 AS EXTRACT_DATE_ID) FROM acct"
    t = ("SELECT f.CENTER, f.PERIOD, f.ACCOUNT, f.EXTRACT_DATE_ID, SUM(f.DATA_VALUE) AS DATA_VALUE FROM f JOIN (SELECT CENTER, PERIOD, ACCOUNT, "
         "MAX(EXTRACT_DATE_ID) AS m FROM f GROUP BY ALL) b ON f.CENTER = b.CENTER AND f.PERIOD = b.PERIOD AND f.ACCOUNT = b.ACCOUNT "
         "AND f.EXTRACT_DATE_ID = b.m GROUP BY ALL")
    return with_(acct=fixture_sql("account_feed"), f=f, t=t) + final(["CENTER", "PERIOD", "ACCOUNT", "EXTRACT_DATE_ID", "DATA_VALUE"], "t")


def sql_snapshot_state_month_steps() -> str:
    f = ("SELECT * REPLACE (CAST(PERIOD AS INTEGER) AS PERIOD, EXTRACT_DATE_ID - CAST(PERIOD AS INTEGER) + 1 AS EXTRACT_DATE_ID), "
         "CAST(PERIOD AS INTEGER) // 100 AS MONTH FROM acct")
    t = ("SELECT f.CENTER, f.MONTH, f.ACCOUNT, f.PERIOD, f.EXTRACT_DATE_ID, SUM(f.DATA_VALUE) AS DATA_VALUE FROM f JOIN (SELECT CENTER, MONTH, "
         "ACCOUNT, MAX(EXTRACT_DATE_ID) AS m FROM f GROUP BY ALL) b ON f.CENTER = b.CENTER AND f.MONTH = b.MONTH AND f.ACCOUNT = b.ACCOUNT "
         "AND f.EXTRACT_DATE_ID = b.m GROUP BY ALL")
    return with_(acct=fixture_sql("account_feed"), f=f, t=t) + final(["CENTER", "MONTH", "ACCOUNT", "PERIOD", "EXTRACT_DATE_ID", "DATA_VALUE"], "t")


def sql_stage_audit_counts() -> str:
    """Audit rows of one revenue run: start, each stage's row count, end."""
    ctes = {**revenue_ctes(), "data": revenue_data_sql(), "ins": card_rollup_sql()}
    stages = [("Start of revenue", "0"), ("spine", "(SELECT COUNT(*) FROM spine)"),
              ("actuals", "(SELECT COUNT(*) FROM actuals)"), ("plan", "(SELECT COUNT(*) FROM plan)"),
              ("data", "(SELECT COUNT(*) FROM data)"), ("insert", "(SELECT COUNT(*) FROM ins)"),
              ("Procedure Completed Successfully", "0")]
    body = " UNION ALL ".join(f"SELECT '{m}' AS MESSAGE, CAST({n} AS BIGINT) AS ROW_COUNT, 0 AS SEVERITY"
                              for m, n in stages)
    return with_(**ctes) + body


def build() -> dict[str, str]:
    ov = FIXTURE_PARAMS.override_measures
    acc = FIXTURE_PARAMS.accrual_measure
    roll = [r + s for r in ("OTHERREVENUE", "ELITE", "DDA", "TOTALCOMM", "TOTALCARDREV") for s in ("", "_LY", "_PLAN")]
    revenue = lambda **o: _sql_revenue(M.revenue_output_columns(), True, **o)
    runs = {}
    for run in [r for r in RUNS if r]:
        with at(run):
            runs[f"revenue_{run}"], runs[f"ops_{run}"] = revenue(), ops_goals_sql()
    base_staff = {"staff": fixture_sql("staff_metrics")}
    return {
        "run_clock": sql_run_clock(),
        "center_day_spine": sql_center_day_spine(),
        "fact_center_filter": sql_fact_center_filter(),
        "rollup_member_filter": sql_rollup_member_filter(),
        "daily_actual_measures": sql_daily_actual_measures(),
        "order_free_actual_measures": sql_order_free("daily_actual_thirds", *ALL_DAYS, True),
        "order_free_plan_measures": sql_order_free("daily_plan_thirds", C.start_id, C.plan_end_id, False),
        "order_free_newest_sums": sql_order_free_newest_sums(),
        "run_lineage": sql_run_lineage(),
        "check_loan_card_derivations": sql_check_loan_card_derivations(),
        "daily_plan_to_month_end": sql_daily_plan_to_month_end(),
        "yoy_calendar_regime": _sql_yoy("calendar"),
        "yoy_weekday_regime": _sql_yoy("weekday"),
        "yoy_two_regime": _sql_yoy("both"),
        "snapshot_center_period_account": sql_snapshot("cpa"),
        "snapshot_center_period": sql_snapshot("cp"),
        "snapshot_center_month_account": sql_snapshot("cma"),
        "account_pivot": sql_account_pivot(),
        "goal_pivot_cutoff": sql_goal_pivot_cutoff(),
        "text_metric_sums": _sql_component("checks", {"centerm": fixture_sql("center_metrics")}),
        "staffing_hours": _sql_component("hours", base_staff),
        "buyback_rollup": _sql_component("bbk", {"visit": fixture_sql("visit_metrics")}),
        "lagged_open_month": sql_lagged_open_month(),
        "distinct_zero_fill_union": sql_distinct_zero_fill_union(),
        "actual_plan_full_outer": _sql_revenue(revenue_data_columns(), False),
        "plan_center_override": _sql_revenue(["CENTER", "PERIOD", *[m + "_PLAN" for m in ov]], False),
        "accrual_from_plan": _sql_revenue(["CENTER", "PERIOD", acc, M.ly_name(acc), acc + "_PLAN"], False),
        "card_rollups": _sql_revenue(["CENTER", "PERIOD", *roll], True),
        "metric_merge_12way": sql_metric_merge_12way(),
        "window_reload": sql_window_reload(),
        "stage_audit_counts": sql_stage_audit_counts(),
        "revenue_tracker": revenue(),
        "ops_goals": ops_goals_sql(),
        "newest_sums_day_account": sql_newest_sums_day_account(),
        "newest_sums_day": sql_newest_sums_day(),
        "shop_card_totals": sql_shop_card_totals(),
        "text_center_feed": sql_text_center_feed(),
        "reject_counts": sql_reject_counts(),
        "rejects_quarantine": sql_rejects_quarantine(),
        "revenue_odd_plan_keys": sql_revenue_odd_plan_keys(),
        "window_restatement": sql_window_restatement(),
        "backfill_windows": sql_backfill_windows(),
        "snapshot_state_steps": sql_snapshot_state_steps(),
        "snapshot_state_month_steps": sql_snapshot_state_month_steps(),
        "revenue_first_run": revenue(first_run=True),
        "ops_first_run": ops_goals_sql(first_run=True),
        **runs,
    }


ORACLE = build()
