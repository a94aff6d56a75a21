"""Run-window filters on the raw period key.

Feeds keep ``PERIOD`` as they arrive (int or 'yyyymmdd' text).  Bounds are
compared with literals of the column's own type, so the predicate reaches the
Parquet scan as ``PushedFilters`` (a fixed-width yyyymmdd string orders like
the date it spells).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType


def _typed(df: DataFrame, col: str, key: int):
    return str(key) if isinstance(df.schema[col].dataType, StringType) else key


def period_between(df: DataFrame, lo: int, hi: int, col: str = "PERIOD") -> Column:
    return F.col(col).between(F.lit(_typed(df, col, lo)), F.lit(_typed(df, col, hi)))


def in_window(df: DataFrame, lo: int, hi: int, col: str = "PERIOD") -> DataFrame:
    """Rows with lo <= period <= hi (inclusive day keys)."""
    return df.where(period_between(df, lo, hi, col))


def period_in_ranges(df: DataFrame, ranges: list[tuple[int, int]], col: str = "PERIOD") -> Column:
    cond = F.lit(False)
    for lo, hi in ranges:
        cond = cond | period_between(df, lo, hi, col)
    return cond


def clip_to_run_window(df: DataFrame, lo_id: int, hi_id: int | None = None, col: str = "PERIOD") -> DataFrame:
    """Keep period >= expiration id (and <= an upper id when given)."""
    cond = F.col(col) >= F.lit(lo_id)
    if hi_id is not None:
        cond = cond & (F.col(col) <= F.lit(hi_id))
    return df.where(cond)
