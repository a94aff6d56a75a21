"""What a reload restates: rows added, changed, gone and unchanged, by day.

Each side is cut to its keys and one hash of all values (null-safe: which values are NULL goes into the hash), so what is
shuffled is keys and 8 bytes a row, whatever the width of the table.  One aggregation by key tells the state.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

STATES = ("ADDED", "CHANGED", "GONE", "SAME")


def value_hash(df: DataFrame, columns: list[str]):
    """Equal for rows that agree in all columns, NULL being equal to NULL only."""
    flags = F.concat_ws("", *[F.col(f"`{c}`").isNull().cast("int").cast("string") for c in columns])
    return F.xxhash64(flags, *[F.col(f"`{c}`") for c in columns])


def window_changes(old: DataFrame, new: DataFrame, keys: tuple[str, ...] = ("CENTER", "PERIOD"), ignore: tuple[str, ...] = ()) -> DataFrame:
    """One row per PERIOD: N_ADDED ... as ``STATES``.  Both sides are unique on ``keys``; columns that only one side has, or in
    ``ignore``, are not compared.  A column's type is that of the new side."""
    values = [c for c in new.columns if c in old.columns and c not in keys and c not in ignore]
    kinds = dict(new.dtypes)
    old = old.select(*keys, *[F.col(f"`{c}`").cast(kinds[c]).alias(c) for c in values])
    side = lambda df, name: df.select(*keys, value_hash(df, values).alias(name))
    both = side(old, "_old").unionByName(side(new, "_new"), allowMissingColumns=True)
    rows = both.groupBy(*keys).agg(F.max("_old").alias("_old"), F.max("_new").alias("_new"))
    state = (F.when(F.col("_old").isNull(), "ADDED").when(F.col("_new").isNull(), "GONE")
             .when(F.col("_old") != F.col("_new"), "CHANGED").otherwise("SAME"))
    return rows.groupBy("PERIOD").agg(*[F.count_if(state == s).alias(s) for s in STATES])
