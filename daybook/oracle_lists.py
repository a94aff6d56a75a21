"""Column lists of the oracle, written out on their own so that a slip in the lists of the
code under test does not pass on both sides."""

# Feed measures summed plainly.
PLAIN_SUMS = """
    NET_TAX_FEES REGULAR_CHECK_1ST_TIME_RETURNED_VOLUME MONEY_ORDER_FEES MONEY_GRAM_FEES BILL_PAYMENT_FEES
    ELECTRONIC_TAX_FEES NEW_CUSTOMER_FEES OTHER_REVENUE PREPAID_CARD_SALE_REVENUE PREPAID_STORE_LOAD_REVENUE
    PREPAID_WITHDRAWAL_REVENUE GREEN_DOT_LOAD_FEES ATM_FEE PREPAID_STORE_LOAD_COMMISSION
    PREPAID_DD_LOAD_COMMISSION PREPAID_WITHDRAWAL_COMMISSION PREPAID_OVERDRAFT_COMMISSION
    PREPAID_SUBSCRIPTION_COMMISSION PREPAID_TRANSACTION_COMMISSION OTHER_PREPAID_CARD_REVENUE
    PREPAID_OUT_OF_ACE_ATM_COMMISSION DDA_CARD_SALE_REVENUE DDA_STORE_LOAD_REVENUE DDA_WITHDRAWAL_REVENUE
    DDA_INTERCHANGE_COMMISSION DDA_WITHDRAWAL_COMMISSION DDA_OVERDRAFT_COMMISSION DDA_OUT_OF_ACE_ATM_COMMISSION
    DDA_SUBSCRIPTION_COMMISSION DDA_TRANSACTION_COMMISSION OTHER_DDA_CARD_REVENUE DDA_STORE_LOAD_COMMISSION
    DDA_DD_LOAD_COMMISSION INTERNET_1ST_TIME_RETURNED_VOLUME INTERNET_INTEREST_INCOME INTERNET_NET_COLLECTIONS
    MOBILE_CHECK_ACE_FEES STOREFRONT_PAYDAY_INTEREST_INCOME STOREFRONT_INSTALLMENT_INTEREST_INCOME
    STOREFRONT_TITLE_INTEREST_INCOME STOREFRONT_PAYDAY_1ST_TIME_RETURNED_VOLUME
    STOREFRONT_INSTALLMENT_1ST_TIME_RETURNED_VOLUME STOREFRONT_TITLE_1ST_TIME_RETURNED_VOLUME
    STOREFRONT_PAYDAY_COLLECTIONS STOREFRONT_INSTALLMENT_NET_COLLECTIONS STOREFRONT_TITLE_NET_COLLECTIONS
    PREPAID_INTERCHANGE_COMMISSION
""".split()

# Measures of the actual feed only.
ACTUAL_ONLY = """
    DENIED_CHECKS CHECKS_CASHED CHECK_FEE_ADJUSTMENT
""".split()

# The loan lines behind interest.
INTEREST_PARTS = """
    STOREFRONT_PAYDAY_INTEREST_INCOME STOREFRONT_INSTALLMENT_INTEREST_INCOME STOREFRONT_TITLE_INTEREST_INCOME
    INTERNET_INTEREST_INCOME
""".split()

# The loan lines behind first returns.
FIRST_RETURN_PARTS = """
    STOREFRONT_PAYDAY_1ST_TIME_RETURNED_VOLUME STOREFRONT_INSTALLMENT_1ST_TIME_RETURNED_VOLUME
    STOREFRONT_TITLE_1ST_TIME_RETURNED_VOLUME INTERNET_1ST_TIME_RETURNED_VOLUME
""".split()

# The loan lines behind collections.
COLLECTION_PARTS = """
    STOREFRONT_PAYDAY_COLLECTIONS STOREFRONT_INSTALLMENT_NET_COLLECTIONS STOREFRONT_TITLE_NET_COLLECTIONS
    INTERNET_NET_COLLECTIONS
""".split()

# Revenue measures in target order.
REVENUE_MEASURES = """
    NET_CHECK_FEES NET_TAX_FEES REGULAR_CHECK_1ST_TIME_RETURNED_VOLUME NET_CHECK_COLLECTIONS CHECKLOSS
    NET_CHECK_REVENUE TOTAL_INTEREST_INCOME LOAN_FIRST_RETURNS NET_LOAN_COLLECTIONS NET_LOAN_REVENUE LOAN_LOSS
    MONEY_ORDER_FEES MONEY_GRAM_FEES BILL_PAYMENT_FEES ELECTRONIC_TAX_FEES NEW_CUSTOMER_FEES OTHER_REVENUE
    TOTAL_MONEY_SERVICES DENIED_CHECKS CHECKS_CASHED CHECK_FEE_ADJUSTMENT PREPAID_CARD_SALE_REVENUE
    PREPAID_STORE_LOAD_REVENUE PREPAID_WITHDRAWAL_REVENUE GREEN_DOT_LOAD_FEES ATM_FEE
    PREPAID_STORE_LOAD_COMMISSION PREPAID_DD_LOAD_COMMISSION PREPAID_WITHDRAWAL_COMMISSION
    PREPAID_OVERDRAFT_COMMISSION PREPAID_SUBSCRIPTION_COMMISSION PREPAID_TRANSACTION_COMMISSION
    OTHER_PREPAID_CARD_REVENUE PREPAID_OUT_OF_ACE_ATM_COMMISSION DDA_CARD_SALE_REVENUE DDA_STORE_LOAD_REVENUE
    DDA_WITHDRAWAL_REVENUE DDA_INTERCHANGE_COMMISSION DDA_WITHDRAWAL_COMMISSION DDA_OVERDRAFT_COMMISSION
    DDA_OUT_OF_ACE_ATM_COMMISSION DDA_SUBSCRIPTION_COMMISSION DDA_TRANSACTION_COMMISSION OTHER_DDA_CARD_REVENUE
    DDA_STORE_LOAD_COMMISSION DDA_DD_LOAD_COMMISSION PPLOADFEESANDCARDSALES DDLOADFEESANDCARDSALES
    INTERNET_1ST_TIME_RETURNED_VOLUME INTERNET_INTEREST_INCOME INTERNET_NET_COLLECTIONS MOBILE_CHECK_ACE_FEES
    STOREFRONT_PAYDAY_INTEREST_INCOME STOREFRONT_INSTALLMENT_INTEREST_INCOME STOREFRONT_TITLE_INTEREST_INCOME
    STOREFRONT_PAYDAY_1ST_TIME_RETURNED_VOLUME STOREFRONT_INSTALLMENT_1ST_TIME_RETURNED_VOLUME
    STOREFRONT_TITLE_1ST_TIME_RETURNED_VOLUME STOREFRONT_PAYDAY_COLLECTIONS STOREFRONT_INSTALLMENT_NET_COLLECTIONS
    STOREFRONT_TITLE_NET_COLLECTIONS PREPAID_INTERCHANGE_COMMISSION
""".split()

# Card roll-ups, after the last card-load measure.
CARD_ROLLUPS = """
    OTHERREVENUE ELITE DDA TOTALCOMM
""".split()

# Prepaid parts of the card roll-ups.
PREPAID_COMMISSIONS = """
    PREPAID_STORE_LOAD_COMMISSION PREPAID_DD_LOAD_COMMISSION PREPAID_WITHDRAWAL_COMMISSION
    PREPAID_OVERDRAFT_COMMISSION PREPAID_SUBSCRIPTION_COMMISSION PREPAID_TRANSACTION_COMMISSION
    OTHER_PREPAID_CARD_REVENUE
""".split()

# Prepaid parts that last year leaves out.
PREPAID_EXTRA = """
    PREPAID_OUT_OF_ACE_ATM_COMMISSION PREPAID_INTERCHANGE_COMMISSION
""".split()

# DDA parts of the card roll-ups.
DDA_COMMISSIONS = """
    DDA_INTERCHANGE_COMMISSION DDA_WITHDRAWAL_COMMISSION DDA_OVERDRAFT_COMMISSION DDA_OUT_OF_ACE_ATM_COMMISSION
    DDA_SUBSCRIPTION_COMMISSION DDA_TRANSACTION_COMMISSION OTHER_DDA_CARD_REVENUE
""".split()

# Ops target in column order.
OPS_OUTPUT_COLUMNS = """
    CENTER PERIOD DATES DBACHECKS PROMOTERS_NPS DETRACTORS_NPS PASSIVE_NPS DBACHECKS_LY PROMOTERS_NPS_LY
    DETRACTORS_NPS_LY PASSIVE_NPS_LY HOURSOVERSTAFFED HOURSUNDERSTAFFED SCHEDULEDHOURS CM_OT SA_OT PAYDATE_DAYS
    CORP_SCORE_DEN CORP_SCORE_NUM CHECKITEMS HOURSOVERSTAFFED_LY HOURSUNDERSTAFFED_LY SCHEDULEDHOURS_LY CM_OT_LY
    SA_OT_LY PAYDATE_DAYS_LY CORP_SCORE_DEN_LY CORP_SCORE_NUM_LY CHECKITEMS_LY FIRSTTIME_DDS_CY FIRSTTIME_DDS_LY
    FTDD_GOAL_MTD CARDSALES_GOAL_MTD DAYS_MTD BBK_ITEMS_GOAL_MTD BBK_ITEMS_OPPS_GOAL_MTD DDAUPGRADES
    DDAUPGRADES_LY DDANEWCARD DDANEWCARD_LY PREPAIDCARDSALEITEMS_LY PREPAIDCARDSALEITEMS CARDSALES_CY CARDSALES_LY
    BBK_ITEMS_CY BBK_OPP_ITEMS_CY BBK_ITEMS_LY BBK_OPP_ITEMS_LY CASH_SHORTS_PSD INTERNAL_AUDIT CASH_SHORTS_PSD_LY
    INTERNAL_AUDIT_LY AUDCASHSHORTS AUDCASHSHORTS_LY FORGERIES_VOL FORGERIES_VOL_LY CHECK_CASHING_VOL NO_DAYS_CY
    OPEN_LATE CLOSE_EARLY CHECK_CASHING_VOL_LY NO_DAYS_LY OPEN_LATE_LY CLOSE_EARLY_LY NC4S_OPPS_CY NC4S_SALES_CY
    NC4S_OPPS_LY NC4S_SALES_LY ACTIVEEMPLOYEE ACTIVEEMPLOYEE_LY TERMINATEDEMPLOYEE TERMINATEDEMPLOYEE_LY
    EXPERIENCESHOPDENOMINATOR EXPERIENCESHOPNUMERATOR LOANSHOPDENOMINATOR LOANSHOPNUMERATOR PHONESHOPDENOMINATOR
    PHONESHOPNUMERATOR EXPERIENCESHOPDENOMINATOR_LY EXPERIENCESHOPNUMERATOR_LY LOANSHOPDENOMINATOR_LY
    LOANSHOPNUMERATOR_LY PHONESHOPDENOMINATOR_LY PHONESHOPNUMERATOR_LY TOTALSHOPSDEN TOTALSHOPSNUM
    TOTALSHOPSDEN_LY TOTALSHOPSNUM_LY EXTRACT_DATE_ID
""".split()

IRREGULAR_LY = {"NET_CHECK_FEES": "NET_CHK_FEE_LY", "NET_TAX_FEES": "NET_TAX_FEE_LY"}


def ly_name(m: str) -> str:
    return IRREGULAR_LY.get(m, f"{m}_LY")


def has_plan(m: str) -> bool:
    return m not in ACTUAL_ONLY


def revenue_output_columns() -> list[str]:
    out = ["CENTER", "PERIOD", "DATES"]
    for m in REVENUE_MEASURES:
        out += [m, ly_name(m), *([f"{m}_PLAN"] if has_plan(m) else [])]
        if m == "DDLOADFEESANDCARDSALES":
            out += [f"{r}{s}" for r in CARD_ROLLUPS for s in ("", "_LY", "_PLAN")]
    return [*out, "TOTALCARDREV", "TOTALCARDREV_LY", "TOTALCARDREV_PLAN", "EXTRACT_DATE_ID"]
