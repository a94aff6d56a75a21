"""Dense center x day spine.

Built as a generator, not a join: the distinct operating centers are each
expanded with ``explode(sequence(start, end))``.  The day list is bounded by
the run window (at most 62 days), so the spine is ``centers x <= 62`` rows,
unique on (CENTER, PERIOD) by construction, and needs one small shuffle
(the center ``distinct``).  A center listed under several regions appears
once: region names are not carried (they are never used downstream).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.functions.dates import yyyymmdd
from daybook.functions.predicates import is_operating_center


def build_spine(hierarchy: DataFrame, start: dt.date, end: dt.date, center_rule=is_operating_center) -> DataFrame:
    """(CENTER int, PERIOD int yyyymmdd, DAY date) for every operating center and day."""
    if end < start:
        raise ValueError(f"empty window {start}..{end}")
    centers = (
        hierarchy.where(center_rule(F.col("CENTER")))
        .select(F.col("CENTER").cast("int").alias("CENTER"))
        .distinct()
    )
    days = F.explode(F.sequence(F.lit(start), F.lit(end))).alias("DAY")
    return centers.select("CENTER", days).select("CENTER", yyyymmdd("DAY").alias("PERIOD"), "DAY")
