"""Measure registry for the revenue tracker and derived roll-ups.

Aggregates are declared once (as SQL expression strings for the wide
registries) so the daily stage is a single ``groupBy(CENTER, PERIOD).agg``
(partial + final hash aggregation; skew on a hot center is absorbed by the
map-side combine).

Two sum flavours are kept per measure because they differ on all-NULL groups:
``s(x)`` = SUM(x) (NULL when every x is NULL) and ``s0(x)`` = SUM(coalesce(x,0)).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybook.functions.exact import total_sql


def s(c: str) -> Column:
    return F.sum(F.col(c))


def s0(c: str) -> Column:
    return F.sum(F.coalesce(F.col(c), F.lit(0)))


def c0(c: str | Column) -> Column:
    return F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit(0))


# Feed measures summed plainly (SUM(x)), in feed order.
PLAIN_SUMS = [
    "NET_TAX_FEES", "REGULAR_CHECK_1ST_TIME_RETURNED_VOLUME",
    "MONEY_ORDER_FEES", "MONEY_GRAM_FEES", "BILL_PAYMENT_FEES", "ELECTRONIC_TAX_FEES",
    "NEW_CUSTOMER_FEES", "OTHER_REVENUE",
    "PREPAID_CARD_SALE_REVENUE", "PREPAID_STORE_LOAD_REVENUE", "PREPAID_WITHDRAWAL_REVENUE",
    "GREEN_DOT_LOAD_FEES", "ATM_FEE",
    "PREPAID_STORE_LOAD_COMMISSION", "PREPAID_DD_LOAD_COMMISSION", "PREPAID_WITHDRAWAL_COMMISSION",
    "PREPAID_OVERDRAFT_COMMISSION", "PREPAID_SUBSCRIPTION_COMMISSION", "PREPAID_TRANSACTION_COMMISSION",
    "OTHER_PREPAID_CARD_REVENUE", "PREPAID_OUT_OF_ACE_ATM_COMMISSION",
    "DDA_CARD_SALE_REVENUE", "DDA_STORE_LOAD_REVENUE", "DDA_WITHDRAWAL_REVENUE",
    "DDA_INTERCHANGE_COMMISSION", "DDA_WITHDRAWAL_COMMISSION", "DDA_OVERDRAFT_COMMISSION",
    "DDA_OUT_OF_ACE_ATM_COMMISSION", "DDA_SUBSCRIPTION_COMMISSION", "DDA_TRANSACTION_COMMISSION",
    "OTHER_DDA_CARD_REVENUE", "DDA_STORE_LOAD_COMMISSION", "DDA_DD_LOAD_COMMISSION",
    "INTERNET_1ST_TIME_RETURNED_VOLUME", "INTERNET_INTEREST_INCOME", "INTERNET_NET_COLLECTIONS",
    "MOBILE_CHECK_ACE_FEES",
    "STOREFRONT_PAYDAY_INTEREST_INCOME", "STOREFRONT_INSTALLMENT_INTEREST_INCOME",
    "STOREFRONT_TITLE_INTEREST_INCOME",
    "STOREFRONT_PAYDAY_1ST_TIME_RETURNED_VOLUME", "STOREFRONT_INSTALLMENT_1ST_TIME_RETURNED_VOLUME",
    "STOREFRONT_TITLE_1ST_TIME_RETURNED_VOLUME",
    "STOREFRONT_PAYDAY_COLLECTIONS", "STOREFRONT_INSTALLMENT_NET_COLLECTIONS",
    "STOREFRONT_TITLE_NET_COLLECTIONS", "PREPAID_INTERCHANGE_COMMISSION",
]
# Check-count measures present in the actual feed only.
ACTUAL_ONLY = ["DENIED_CHECKS", "CHECKS_CASHED", "CHECK_FEE_ADJUSTMENT"]
# The four loan lines behind interest, first returns and collections.
INTEREST_PARTS = ["STOREFRONT_PAYDAY_INTEREST_INCOME", "STOREFRONT_INSTALLMENT_INTEREST_INCOME",
                  "STOREFRONT_TITLE_INTEREST_INCOME", "INTERNET_INTEREST_INCOME"]
FIRST_RETURN_PARTS = ["STOREFRONT_PAYDAY_1ST_TIME_RETURNED_VOLUME",
                      "STOREFRONT_INSTALLMENT_1ST_TIME_RETURNED_VOLUME",
                      "STOREFRONT_TITLE_1ST_TIME_RETURNED_VOLUME", "INTERNET_1ST_TIME_RETURNED_VOLUME"]
COLLECTION_PARTS = ["STOREFRONT_PAYDAY_COLLECTIONS", "STOREFRONT_INSTALLMENT_NET_COLLECTIONS",
                    "STOREFRONT_TITLE_NET_COLLECTIONS", "INTERNET_NET_COLLECTIONS"]
# Raw check volumes folded into store-check collections / returns.
COLLECT_PARTS = ["REGULAR_CHECK_COLLECT_VOLUME", "FORGERY_COLLECT_VOLUME"]
RETURN_PARTS = ["FORGERY_RETURNED_VOLUME", "REGULAR_CHECK_RETURNED_VOLUME"]


def revenue_feed_columns(actual: bool = True) -> list[str]:
    """Columns a daily revenue feed must carry (besides CENTER, PERIOD)."""
    cols = ["NET_CHECK_FEES"] + PLAIN_SUMS + COLLECT_PARTS + RETURN_PARTS
    cols += [c for c in INTEREST_PARTS + FIRST_RETURN_PARTS + COLLECTION_PARTS if c not in cols]
    return cols + (ACTUAL_ONLY if actual else [])


def q(c: str) -> str:
    """Quoted identifier for SQL-expression strings."""
    return f"`{c}`"


def sql_s0(c: str, places: int | None = None) -> str:
    return total_sql(sql_c0(c), places)


def sql_c0(c: str) -> str:
    return f"COALESCE({q(c)}, 0)"


def revenue_daily_aggregate_sql(actual: bool = True, places: int | None = None) -> list[str]:
    """E1/E2 as SQL expressions (the actual feed adds the 3 check counts); with ``places``
    sums do not depend on the order of rows (``functions.exact``).

    Wide registries are handed to Spark as expression strings: one parse in
    the JVM instead of several driver round trips per Column object."""
    total = lambda value: total_sql(value, places)
    added = lambda parts: " + ".join(sql_s0(c, places) for c in parts)
    aggs = [
        f"{added(['NET_CHECK_FEES', 'MOBILE_CHECK_ACE_FEES'])} AS NET_CHECK_FEES",
        total(f"({sql_c0(COLLECT_PARTS[0])} + {sql_c0(COLLECT_PARTS[1])})") + " AS STORE_CHECK_COLLECTIONS",
        total(f"(({sql_c0(RETURN_PARTS[0])} + {sql_c0(RETURN_PARTS[1])}) * -1)") + " AS STORE_CHECK_RETURNS",
        f"{added(INTEREST_PARTS)} AS TOTAL_INTEREST_INCOME",
        f"{added(FIRST_RETURN_PARTS)} AS LOAN_FIRST_RETURNS",
        f"{added(COLLECTION_PARTS)} AS NET_LOAN_COLLECTIONS",
        " + ".join(total(q(c)) for c in ["MONEY_ORDER_FEES", "MONEY_GRAM_FEES", "BILL_PAYMENT_FEES"]) + " AS TOTAL_MONEY_SERVICES",
    ]
    aggs += [f"{total(q(c))} AS {q(c)}" for c in PLAIN_SUMS + (ACTUAL_ONLY if actual else [])]
    return aggs


def revenue_daily_aggregates(actual: bool = True, places: int | None = None) -> list[Column]:
    return [F.expr(e) for e in revenue_daily_aggregate_sql(actual, places)]


def derive_check_loan_card(df: DataFrame) -> DataFrame:
    """Check, loan and card-load roll-ups on the daily aggregate."""
    r = sql_c0("REGULAR_CHECK_1ST_TIME_RETURNED_VOLUME")
    net_coll = f"({r} + {sql_c0('STORE_CHECK_COLLECTIONS')} + {sql_c0('STORE_CHECK_RETURNS')})"
    checkloss = f"(({r} - {net_coll}) * -1)"
    loan_loss = f"({sql_c0('LOAN_FIRST_RETURNS')} - {sql_c0('NET_LOAN_COLLECTIONS')})"
    return df.selectExpr(
        "*",
        f"{net_coll} AS NET_CHECK_COLLECTIONS",
        f"{checkloss} AS CHECKLOSS",
        f"{sql_c0('NET_CHECK_FEES')} + {sql_c0('NET_TAX_FEES')} + {checkloss} AS NET_CHECK_REVENUE",
        f"{sql_c0('TOTAL_INTEREST_INCOME')} - {loan_loss} AS NET_LOAN_REVENUE",
        f"{loan_loss} AS LOAN_LOSS",
        f"{sql_c0('PREPAID_CARD_SALE_REVENUE')} + {sql_c0('PREPAID_STORE_LOAD_REVENUE')} AS PPLOADFEESANDCARDSALES",
        f"{sql_c0('DDA_CARD_SALE_REVENUE')} + {sql_c0('DDA_STORE_LOAD_REVENUE')} AS DDLOADFEESANDCARDSALES",
    )


# Revenue measures in target column order.  Each is output as
# actual, last year and plan; the three check counts have no plan column.
REVENUE_MEASURES = [
    "NET_CHECK_FEES", "NET_TAX_FEES", "REGULAR_CHECK_1ST_TIME_RETURNED_VOLUME",
    "NET_CHECK_COLLECTIONS", "CHECKLOSS", "NET_CHECK_REVENUE", "TOTAL_INTEREST_INCOME",
    "LOAN_FIRST_RETURNS", "NET_LOAN_COLLECTIONS", "NET_LOAN_REVENUE", "LOAN_LOSS",
    "MONEY_ORDER_FEES", "MONEY_GRAM_FEES", "BILL_PAYMENT_FEES", "ELECTRONIC_TAX_FEES",
    "NEW_CUSTOMER_FEES", "OTHER_REVENUE", "TOTAL_MONEY_SERVICES",
    "DENIED_CHECKS", "CHECKS_CASHED", "CHECK_FEE_ADJUSTMENT",
    "PREPAID_CARD_SALE_REVENUE", "PREPAID_STORE_LOAD_REVENUE", "PREPAID_WITHDRAWAL_REVENUE",
    "GREEN_DOT_LOAD_FEES", "ATM_FEE",
    "PREPAID_STORE_LOAD_COMMISSION", "PREPAID_DD_LOAD_COMMISSION", "PREPAID_WITHDRAWAL_COMMISSION",
    "PREPAID_OVERDRAFT_COMMISSION", "PREPAID_SUBSCRIPTION_COMMISSION", "PREPAID_TRANSACTION_COMMISSION",
    "OTHER_PREPAID_CARD_REVENUE", "PREPAID_OUT_OF_ACE_ATM_COMMISSION",
    "DDA_CARD_SALE_REVENUE", "DDA_STORE_LOAD_REVENUE", "DDA_WITHDRAWAL_REVENUE",
    "DDA_INTERCHANGE_COMMISSION", "DDA_WITHDRAWAL_COMMISSION", "DDA_OVERDRAFT_COMMISSION",
    "DDA_OUT_OF_ACE_ATM_COMMISSION", "DDA_SUBSCRIPTION_COMMISSION", "DDA_TRANSACTION_COMMISSION",
    "OTHER_DDA_CARD_REVENUE", "DDA_STORE_LOAD_COMMISSION", "DDA_DD_LOAD_COMMISSION",
    "PPLOADFEESANDCARDSALES", "DDLOADFEESANDCARDSALES",
    # card roll-ups (derived after the merge) sit here in the output order
    "INTERNET_1ST_TIME_RETURNED_VOLUME", "INTERNET_INTEREST_INCOME", "INTERNET_NET_COLLECTIONS",
    "MOBILE_CHECK_ACE_FEES",
    "STOREFRONT_PAYDAY_INTEREST_INCOME", "STOREFRONT_INSTALLMENT_INTEREST_INCOME",
    "STOREFRONT_TITLE_INTEREST_INCOME",
    "STOREFRONT_PAYDAY_1ST_TIME_RETURNED_VOLUME", "STOREFRONT_INSTALLMENT_1ST_TIME_RETURNED_VOLUME",
    "STOREFRONT_TITLE_1ST_TIME_RETURNED_VOLUME",
    "STOREFRONT_PAYDAY_COLLECTIONS", "STOREFRONT_INSTALLMENT_NET_COLLECTIONS",
    "STOREFRONT_TITLE_NET_COLLECTIONS", "PREPAID_INTERCHANGE_COMMISSION",
]
# Card roll-ups, and the measure that they follow in the output order.
CARD_ROLLUPS_AFTER = "DDLOADFEESANDCARDSALES"
CARD_ROLLUPS = ["OTHERREVENUE", "ELITE", "DDA", "TOTALCOMM"]
# The two measures whose last-year column is named irregularly.
IRREGULAR_LY = {"NET_CHECK_FEES": "NET_CHK_FEE_LY", "NET_TAX_FEES": "NET_TAX_FEE_LY"}


def ly_name(m: str) -> str:
    return IRREGULAR_LY.get(m, m + "_LY")


def plan_name(m: str) -> str:
    return m + "_PLAN"


def has_plan(m: str) -> bool:
    return m not in ACTUAL_ONLY


# Components of the card-revenue roll-ups.
PREPAID_COMMISSIONS = ["PREPAID_STORE_LOAD_COMMISSION", "PREPAID_DD_LOAD_COMMISSION",
                       "PREPAID_WITHDRAWAL_COMMISSION", "PREPAID_OVERDRAFT_COMMISSION",
                       "PREPAID_SUBSCRIPTION_COMMISSION", "PREPAID_TRANSACTION_COMMISSION",
                       "OTHER_PREPAID_CARD_REVENUE"]
PREPAID_EXTRA = ["PREPAID_OUT_OF_ACE_ATM_COMMISSION", "PREPAID_INTERCHANGE_COMMISSION"]
DDA_COMMISSIONS = ["DDA_INTERCHANGE_COMMISSION", "DDA_WITHDRAWAL_COMMISSION", "DDA_OVERDRAFT_COMMISSION",
                   "DDA_OUT_OF_ACE_ATM_COMMISSION", "DDA_SUBSCRIPTION_COMMISSION",
                   "DDA_TRANSACTION_COMMISSION", "OTHER_DDA_CARD_REVENUE"]


def _named(m: str, suffix: str) -> str:
    return q(ly_name(m) if suffix == "_LY" else m + suffix)


def card_rollup_sql(suffix: str) -> list[str]:
    """F7 for one of actual (''), last year ('_LY') or plan ('_PLAN').

    The last-year ELITE and TOTALCOMM omit the out-of-network ATM and
    interchange commissions that the actual and plan versions include; this
    asymmetry is part of the report's definition and is kept.
    """
    def total(names):
        return " + ".join(_named(n, suffix) for n in names)

    extra = "" if suffix == "_LY" else "".join(f" + COALESCE({_named(m, suffix)}, 0)" for m in PREPAID_EXTRA)
    elite = total(["PPLOADFEESANDCARDSALES", "PREPAID_WITHDRAWAL_REVENUE"] + PREPAID_COMMISSIONS) + extra
    dda = total(["DDLOADFEESANDCARDSALES", "DDA_WITHDRAWAL_REVENUE"] + DDA_COMMISSIONS)
    comm = total(PREPAID_COMMISSIONS + DDA_COMMISSIONS) + extra
    return [
        f"{_named('GREEN_DOT_LOAD_FEES', suffix)} + {_named('ATM_FEE', suffix)} AS OTHERREVENUE{suffix}",
        f"{elite} AS ELITE{suffix}",
        f"{dda} AS DDA{suffix}",
        f"{comm} AS TOTALCOMM{suffix}",
    ]


def total_card_revenue_sql(suffix: str) -> str:
    """F8: ELITE + DDA + green-dot loads + ATM fee."""
    return (f"ELITE{suffix} + DDA{suffix} + {_named('GREEN_DOT_LOAD_FEES', suffix)} + "
            f"{_named('ATM_FEE', suffix)} AS TOTALCARDREV{suffix}")


def revenue_output_columns() -> list[str]:
    """The 202 columns of the revenue target (its 203rd is the load stamp)."""
    cols = ["CENTER", "PERIOD", "DATES"]
    for m in REVENUE_MEASURES:
        cols += [m, ly_name(m)] + ([plan_name(m)] if has_plan(m) else [])
        if m == CARD_ROLLUPS_AFTER:
            for r in CARD_ROLLUPS:
                cols += [r, r + "_LY", r + "_PLAN"]
    cols += ["TOTALCARDREV", "TOTALCARDREV_LY", "TOTALCARDREV_PLAN", "EXTRACT_DATE_ID"]
    return cols


# ---- ops-goal derivations ------------------------------------------------

# Mystery-shop score parts.
SHOP_DEN = ["EXPERIENCESHOPDENOMINATOR", "LOANSHOPDENOMINATOR", "PHONESHOPDENOMINATOR"]
SHOP_NUM = ["EXPERIENCESHOPNUMERATOR", "LOANSHOPNUMERATOR", "PHONESHOPNUMERATOR"]


def derive_shop_totals(df: DataFrame, years: tuple[str, ...] = ("", "_LY")) -> DataFrame:
    """coalesced totals of the three shop scores (never NULL), this year and last."""
    def tot(names, y):
        return c0(names[0] + y) + c0(names[1] + y) + c0(names[2] + y)
    return df.withColumns({f"TOTALSHOPS{k}{y}": tot(names, y) for y in years for k, names in (("DEN", SHOP_DEN), ("NUM", SHOP_NUM))})


def derive_card_sales(df: DataFrame, years: tuple[str, ...] = ("", "_LY")) -> DataFrame:
    """card sales = new DDA cards + prepaid card sales (NULL-propagating), this year and last."""
    return df.withColumns({f"CARDSALES{y or '_CY'}": F.col("DDANEWCARD" + y) + F.col("PREPAIDCARDSALEITEMS" + y) for y in years})
