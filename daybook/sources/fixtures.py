"""Test inputs derived from the driver's TPC-H-style tables.

The warehouse feeds (daily wide views, account snapshots, goal cube, center
hierarchy, calendar) are not public, so every input is derived from the
given tables by a SQL recipe.  Recipes use only syntax that Spark SQL and
DuckDB read alike, so both engines see identical inputs and the comparison
tests the operators, not the derivation.  Money measures are whole cents held
in DOUBLE: every value and every partial sum is an integer below 2**53, so
sums are exact and independent of the order in which partitions combine.

``table`` maps a base-table name to an SQL table reference: Spark reads
``parquet.`<dir>/<name>.parquet```, DuckDB uses its pre-registered views.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from daybook.functions.measures import revenue_feed_columns

TableRef = Callable[[str], str]

# Column names of the three wide HR feeds (staffing, district-manager visit,
# center metrics); fixed values that the ops-goal components read.
STAFF_COLUMNS = ["HOURSOVERSTAFFED", "HOURSUNDERSTAFFED", "SCHEDULEDHOURS", "TOTALCMOT", "TOTALSAOT",
                 "PAYDATEDAYS", "CORPORATEAUDITSCOREDENOMINATOR", "CORPORATEAUDITSCORENUMERATOR",
                 "CHECKITEMS"]
VISIT_COLUMNS = ["STOREFRONT_PAYDAY_BUY_BACKS", "STOREFRONT_PAYDAY_BUY_BACK_OPPORTUNITIES",
                 "STOREFRONT_INSTALLMENT_BUY_BACKS", "STOREFRONT_INSTALLMENT_BUY_BACK_OPPORTUNITIES",
                 "STOREFRONT_TITLE_BUY_BACKS", "STOREFRONT_TITLE_BUY_BACK_OPPORTUNITIES",
                 "CASH_SHORTS_PSD", "INTERNAL_AUDIT"]
CENTER_TEXT_COLUMNS = ["FORGERYRETURNEDVOLUME", "FORGERYCOLLECTVOLUME", "CHECKCASHINGVOLUME",
                       "OPENLATE", "CLOSEEARLY"]


def day_key_sql(ts: str) -> str:
    return f"CAST(year({ts}) * 10000 + month({ts}) * 100 + day({ts}) AS INT)"


def cents(x: str) -> str:
    """A 2-decimal double as whole cents (same IEEE ops in both engines)."""
    return f"floor({x} * 100 + 0.5)"


def _li_decimal(j: int) -> str:
    base = [cents("l_tax"), cents("l_discount"), "floor(l_quantity)"][j % 3]
    return (f"CASE WHEN (l_orderkey + {j}) % 7 = 0 THEN NULL ELSE "
            f"CAST({cents('l_extendedprice')} * {base} * {j % 4 + 1} AS DOUBLE) END")


def _li_text(j: int) -> str:
    return (f"CASE WHEN (l_orderkey + {j}) % 13 = 0 THEN 'n/a' "
            f"WHEN (l_orderkey + {j}) % 7 = 0 THEN NULL "
            f"ELSE CAST(CAST(floor(l_quantity) * {j % 4 + 1} AS DECIMAL(18,2)) AS STRING) END")


def _orders_decimal(j: int) -> str:
    return (f"CASE WHEN (o_orderkey + {j}) % 7 = 0 THEN NULL ELSE "
            f"CAST({cents('o_totalprice')} * {j % 5 + 1} AS DOUBLE) END")


LI_CENTER = "CAST((l_suppkey % 100) * 61 AS INT)"
LI_ACCOUNT_CENTER = "CAST((l_suppkey % 10) * 610 AS INT)"
LI_DAY = day_key_sql("l_shipdate")
O_DAY = day_key_sql("o_orderdate")


def calendar_sql(t: TableRef) -> str:
    """Calendar dimension: one row per day that occurs in lineitem."""
    return (f"SELECT DISTINCT {LI_DAY} AS CALENDAR_DATE_ID, CAST(l_shipdate AS DATE) AS CALENDAR_DATE "
            f"FROM {t('lineitem')}")


def hierarchy_sql(t: TableRef) -> str:
    """Center -> region; centers come from suppliers and customers, so most
    centers sit under several regions (duplicate-region quirk)."""
    return (
        f"SELECT {LI_CENTER.replace('l_suppkey', 's_suppkey')} AS CENTER, r_name AS REGNAME "
        f"FROM {t('supplier')} JOIN {t('nation')} ON s_nationkey = n_nationkey "
        f"JOIN {t('region')} ON n_regionkey = r_regionkey "
        f"UNION ALL "
        f"SELECT {LI_CENTER.replace('l_suppkey', 'c_custkey')} AS CENTER, r_name AS REGNAME "
        f"FROM {t('customer')} JOIN {t('nation')} ON c_nationkey = n_nationkey "
        f"JOIN {t('region')} ON n_regionkey = r_regionkey"
    )


def daily_actual_sql(t: TableRef) -> str:
    cols = ", ".join(f"{_li_decimal(j)} AS {c}" for j, c in enumerate(revenue_feed_columns(actual=True)))
    return (f"SELECT {LI_CENTER} AS CENTER, CAST({LI_DAY} AS STRING) AS PERIOD, {cols} "
            f"FROM {t('lineitem')}")


def daily_plan_sql(t: TableRef) -> str:
    cols = ", ".join(f"{_orders_decimal(j)} AS {c}" for j, c in enumerate(revenue_feed_columns(actual=False)))
    return (f"SELECT CAST((o_custkey % 100) * 61 AS INT) AS CENTER, CAST({O_DAY} AS STRING) AS PERIOD, "
            f"{cols} FROM {t('orders')}")


def daily_plan_odd_keys_sql(t: TableRef) -> str:
    """The plan feed with numeric centers that are no whole number now and then, and days that no calendar has."""
    cols = ", ".join(f"{_orders_decimal(j)} AS {c}" for j, c in enumerate(revenue_feed_columns(actual=False)))
    return (f"SELECT CAST((o_custkey % 100) * 61 AS DOUBLE) + CASE WHEN o_orderkey % 9 = 0 THEN 0.5 ELSE 0 END AS CENTER, "
            f"CASE WHEN o_orderkey % 23 = 0 THEN 20000200 + 30 + o_orderkey % 2 ELSE {O_DAY} END AS PERIOD, {cols} FROM {t('orders')}")


def daily_actual_thirds_sql(t: TableRef) -> str:
    """The actual feed in thirds of a cent's multiples: doubles whose sums depend on the order of rows."""
    cols = ", ".join(f"{c} / CAST(3 AS DOUBLE) AS {c}" for c in revenue_feed_columns(actual=True))
    return f"SELECT CENTER, PERIOD, {cols} FROM ({daily_actual_sql(t)}) d"


def daily_plan_thirds_sql(t: TableRef) -> str:
    cols = ", ".join(f"{c} / CAST(3 AS DOUBLE) AS {c}" for c in revenue_feed_columns(actual=False))
    return f"SELECT CENTER, PERIOD, {cols} FROM ({daily_plan_sql(t)}) d"


def account_feed_thirds_sql(t: TableRef) -> str:
    return f"SELECT CENTER, PERIOD, ACCOUNT, DATA_VALUE / CAST(3 AS DOUBLE) AS DATA_VALUE, EXTRACT_DATE_ID FROM ({account_feed_sql(t)}) d"


def account_feed_sql(t: TableRef) -> str:
    """Snapshot feed: account = return flag + line status + line number; three
    extract versions per day; value = quantity."""
    return (
        f"SELECT {LI_ACCOUNT_CENTER} AS CENTER, CAST({LI_DAY} AS STRING) AS PERIOD, "
        f"l_returnflag || l_linestatus || CAST(l_linenumber AS STRING) AS ACCOUNT, "
        f"CAST(floor(l_quantity) AS DOUBLE) AS DATA_VALUE, "
        f"CAST({LI_DAY} + l_orderkey % 3 AS INT) AS EXTRACT_DATE_ID "
        f"FROM {t('lineitem')}"
    )


def events_feed_sql(t: TableRef) -> str:
    """Snapshot feed from the event stream (account = event type)."""
    d = day_key_sql("ts")
    return (
        f"SELECT CAST((user_id % 10) * 610 AS INT) AS CENTER, CAST({d} AS STRING) AS PERIOD, "
        f"event_type AS ACCOUNT, CAST({cents('value')} AS DOUBLE) AS DATA_VALUE, "
        f"CAST({d} + event_id % 3 AS INT) AS EXTRACT_DATE_ID FROM {t('events')}"
    )


def goals_sql(t: TableRef) -> str:
    """Goal cube: text centers incl. roll-up members (some that no pattern names), zero-padded ids
    and ids written as decimals."""
    c = "CAST((o_custkey % 10) * 610 AS STRING)"
    return (
        f"SELECT CASE WHEN o_orderkey % 17 = 0 THEN 'All Centers' "
        f"WHEN o_orderkey % 17 = 1 THEN 'D' || CAST(o_custkey % 10 AS STRING) "
        f"WHEN o_orderkey % 17 = 2 THEN '0' || {c} WHEN o_orderkey % 17 = 3 THEN {c} || '.0' "
        f"WHEN o_orderkey % 17 = 4 THEN 'Region ' || CAST(o_custkey % 10 AS STRING) ELSE {c} END AS CENTER, "
        f"CAST({O_DAY} AS STRING) AS PERIOD, o_orderpriority AS ACCOUNT, "
        f"CAST({cents('o_totalprice')} AS DOUBLE) AS GOAL_VALUE, "
        f"CAST({O_DAY} + o_custkey % 3 AS INT) AS EXTRACT_DATE_ID FROM {t('orders')}"
    )


def staff_metrics_sql(t: TableRef) -> str:
    cols = ", ".join(f"{_li_text(j)} AS {c}" for j, c in enumerate(STAFF_COLUMNS))
    return f"SELECT {LI_CENTER} AS CENTER, CAST({LI_DAY} AS STRING) AS PERIOD, {cols} FROM {t('lineitem')}"


def visit_metrics_sql(t: TableRef) -> str:
    cols = ", ".join(f"{_li_decimal(j + 3)} AS {c}" for j, c in enumerate(VISIT_COLUMNS))
    return f"SELECT {LI_CENTER} AS CENTER, CAST({LI_DAY} AS STRING) AS PERIOD, {cols} FROM {t('lineitem')}"


def center_metrics_sql(t: TableRef) -> str:
    cols = ", ".join(f"{_li_text(j + 5)} AS {c}" for j, c in enumerate(CENTER_TEXT_COLUMNS))
    return (f"SELECT {LI_CENTER} AS CENTER, CAST({LI_DAY} AS STRING) AS PERIOD, {cols}, "
            f"CASE WHEN l_orderkey % 5 = 0 THEN NULL ELSE l_linenumber % 2 END AS NO_OF_DAYS "
            f"FROM {t('lineitem')}")


def text_center_metrics_sql(t: TableRef) -> str:
    """Center metrics keyed by text: ids, ids written as decimals, a name now and then, a bad day key."""
    c = "CAST((l_suppkey % 100) * 61 AS STRING)"
    cols = ", ".join(f"{_li_text(j + 5)} AS {x}" for j, x in enumerate(CENTER_TEXT_COLUMNS))
    return (f"SELECT CASE WHEN l_orderkey % 11 = 0 THEN {c} || '.0' WHEN l_orderkey % 11 = 1 THEN 'West Zone' "
            f"WHEN l_orderkey % 11 = 2 THEN {c} || '.5' ELSE {c} END AS CENTER, "
            f"CASE WHEN l_orderkey % 19 = 0 THEN 'unknown' ELSE CAST({LI_DAY} AS STRING) END AS PERIOD, {cols}, "
            f"CASE WHEN l_orderkey % 5 = 0 THEN NULL ELSE l_linenumber % 2 END AS NO_OF_DAYS FROM {t('lineitem')}")


RECIPES = {
    "calendar": calendar_sql,
    "hierarchy": hierarchy_sql,
    "daily_actual": daily_actual_sql,
    "daily_plan": daily_plan_sql,
    "daily_plan_odd_keys": daily_plan_odd_keys_sql,
    "account_feed": account_feed_sql,
    "daily_actual_thirds": daily_actual_thirds_sql,
    "daily_plan_thirds": daily_plan_thirds_sql,
    "account_feed_thirds": account_feed_thirds_sql,
    "events_feed": events_feed_sql,
    "goals": goals_sql,
    "staff_metrics": staff_metrics_sql,
    "visit_metrics": visit_metrics_sql,
    "center_metrics": center_metrics_sql,
    "text_center_metrics": text_center_metrics_sql,
}


def spark_table_ref(sf_dir: str) -> TableRef:
    """Parquet table reference (a plain scan, whatever the size of the table)."""
    return lambda name: f"parquet.`{sf_dir.rstrip('/')}/{name}.parquet`"


def duckdb_table_ref(name: str) -> str:
    return name


def fixture(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Derive fixture ``name`` from the tables under ``sf_dir`` (lazy)."""
    return spark.sql(RECIPES[name](spark_table_ref(sf_dir)))


def fixture_sql(name: str) -> str:
    """The same recipe for DuckDB (base tables as pre-registered views)."""
    return RECIPES[name](duckdb_table_ref)


def materialize(spark: SparkSession, sf_dir: str, out_dir: str, names: list[str] | None = None) -> dict[str, str]:
    """Write each recipe's output as a Parquet table under ``out_dir``
    (production-shaped inputs for benchmarks); returns name -> path."""
    paths = {}
    for name in names or list(RECIPES):
        path = f"{out_dir.rstrip('/')}/{name}"
        fixture(spark, sf_dir, name).write.mode("overwrite").parquet(path)
        paths[name] = path
    return paths
