"""Account -> column pivot by conditional sums.

``SUM(CASE WHEN account IN (...) THEN value ELSE 0 END)`` per column, not
``DataFrame.pivot``: a column may take several accounts, and a (key) group
with only other accounts must yield 0, not NULL.  Optional per-column extra
conditions express date cut-offs (E4).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybook.functions.exact import total_sql


def sql_list(values: list[str]) -> str:
    """Literals for IN; of no values one that nothing equals."""
    return ", ".join("'" + str(v).replace("'", "''") + "'" for v in values) or "NULL"


def pivot_accounts(
    df: DataFrame,
    columns: dict[str, list[str]],
    value: str = "DATA_VALUE",
    keys: tuple[str, ...] = ("CENTER", "PERIOD"),
    account: str = "ACCOUNT",
    conditions: dict[str, Column | str] | None = None,
    places: int | None = None,
) -> DataFrame:
    """``conditions`` may be Columns or SQL predicate strings; with ``places`` sums are order-free
    (``functions.exact``), which needs SQL strings."""
    conditions = conditions or {}
    aggs = []
    for name, accounts in columns.items():
        cond = conditions.get(name)
        if cond is None or isinstance(cond, str):
            hit = f"`{account}` IN ({sql_list(list(accounts))})" + (f" AND ({cond})" if cond else "")
            aggs.append(F.expr(total_sql(f"CASE WHEN {hit} THEN `{value}` ELSE 0 END", places)).alias(name))
        elif places is not None:
            raise TypeError(f"condition of {name}: order-free sums need it as an SQL string")
        else:
            hit = F.col(account).isin(list(accounts)) & cond
            aggs.append(F.sum(F.when(hit, F.col(value)).otherwise(F.lit(0))).alias(name))
    return df.groupBy(*keys).agg(*aggs)
