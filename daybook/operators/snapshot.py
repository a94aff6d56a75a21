"""Latest-snapshot selection (D6a/b/c).

Feeds are re-extracted daily; for each key the rows of the newest extract
win, and *all* rows of that extract survive (ties are kept, so this is a
semi join on the group max, never ``row_number``).  Rows with a NULL key or
version are dropped, as an inner join to the group max would.

Plan shape: ``groupBy(keys).max(version)`` is a partial+final aggregate (a hot
key collapses map-side), and the semi join back lets AQE broadcast the
newest-version table or split a skewed partition at run time.  Callers that
only sum values afterwards use ``newest_sums``: hash aggregations and no join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybook.functions.exact import total_sql


def latest_snapshot(df: DataFrame, keys: list[str], version: str = "EXTRACT_DATE_ID") -> DataFrame:
    clean = df.na.drop(subset=[*keys, version])
    newest = clean.groupBy(*keys).agg(F.max(version).alias(version))
    return clean.join(newest, [*keys, version], "left_semi").select(*df.columns)


def preaggregate(df: DataFrame, keys: list[str], value: str, version: str = "EXTRACT_DATE_ID", places: int | None = None) -> DataFrame:
    """Sum ``value`` per (keys, version), for any later sum over latest rows; order-free with ``places``."""
    return df.groupBy(*keys, version).agg(F.expr(total_sql(f"`{value}`", places)).alias(value))


def newest_sums(df: DataFrame, keys: list[str], columns: dict[str, Column | None],
                version: str = "EXTRACT_DATE_ID", place: tuple[str, ...] = ("CENTER", "PERIOD"), places: int | None = None) -> DataFrame:
    """Per key, sums over the rows of the newest ``version`` only (no join).

    ``columns`` maps output name -> value Column (``None``: the column of the
    same name).  Step 1 sums per (keys, version), so rows tied on the newest
    version are already added up and a hot center collapses map-side.  The sums
    are then dealt by ``place``, a part of the keys: step 2 (per key, each
    column's sum at the greatest version) and a later grouping by ``place`` need no
    further shuffle.  ``max_by`` over single columns stays a hash aggregate.  With ``places``
    the sums do not depend on the order of rows (``functions.exact``).
    """
    clean = df.na.drop(subset=[*keys, version])
    extra = [c for c in place if c not in keys]
    clean = clean.select(*keys, *extra, version, *[(v if v is not None else F.col(n)).alias(f"_sum_{n}") for n, v in columns.items()])
    sums = clean.groupBy(*keys, *extra, version).agg(
        *[F.expr(total_sql(f"`_sum_{n}`", places)).alias(n) for n in columns])
    newest = sums.repartition(*place).groupBy(*keys, *extra).agg(
        *[F.max_by(F.col(n), F.col(version)).alias(n) for n in columns])
    return newest
