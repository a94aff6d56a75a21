"""Run lineage of target rows (I2): when and by whom a row was first made, and last.

A reload replaces whole rows, so the first stamp has to be carried over: the old window is read with its keys and stamps only,
cut to one row a key, and joined to the fresh rows.  Defined cases: a row that the old window does not have is created by this run;
one that has no first stamp (made before lineage was kept) takes its last load stamp, and its creator stays NULL; a row
that leaves the window and returns later is a new one; of repeated old keys the earliest stamp counts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

KEYS = ("CENTER", "PERIOD")
CREATED_AT, CREATED_BY, MODIFIED_AT, MODIFIED_BY = "DW_CREATED_DATETIME", "DW_CREATED_BY", "DW_MOD_DATETIME", "DW_MOD_BY"
LINEAGE_COLUMNS = (CREATED_AT, CREATED_BY, MODIFIED_AT, MODIFIED_BY)
WINDOW_SCHEMA = f"CENTER int, PERIOD int, {CREATED_AT} timestamp, {CREATED_BY} string, {MODIFIED_AT} timestamp"
LAST_KEY = 99991231


def read_window_stamps(spark: SparkSession, target: str, expiration_id: int) -> DataFrame:
    """Keys and stamps of the window that a reload will replace; columns that its files do not have are NULL."""
    from daybook.sources.feeds import read_partitions
    window = [(expiration_id, LAST_KEY)]
    return read_partitions(spark, target, window, schema=WINDOW_SCHEMA)


def stamp_lineage(fresh: DataFrame, old: DataFrame, user: str, now: Column | None = None, keys: tuple[str, ...] = KEYS) -> DataFrame:
    """``fresh`` (without stamps) with the four ``LINEAGE_COLUMNS``; ``old``: rows of ``read_window_stamps``."""
    now = F.current_timestamp() if now is None else now
    first_at = F.coalesce(CREATED_AT, MODIFIED_AT)
    known = old.groupBy(*keys).agg(
        F.min(F.struct(first_at.isNull(), first_at.alias("at"), F.col(CREATED_BY).alias("by"))).alias("_first"))
    joined = fresh.join(known, list(keys), "left")
    new = F.col("_first").isNull()
    return joined.select(
        *[F.col(f"`{c}`") for c in fresh.columns],
        F.coalesce("_first.at", now).alias(CREATED_AT),
        F.when(new, F.lit(user)).otherwise(F.col("_first.by")).alias(CREATED_BY),
        now.alias(MODIFIED_AT), F.lit(user).alias(MODIFIED_BY))
