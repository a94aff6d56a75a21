"""Metric merges on (CENTER, PERIOD).

``merge_metrics`` replaces an n-way FULL OUTER JOIN chain by one
``unionByName`` + ``groupBy(keys).max``: each input is an aggregate already
hash-partitioned on the keys, so the union needs no further shuffle and the
whole merge costs one aggregation instead of n-1 sort-merge joins.  It is
exact when every input is unique on the keys and no value column is shared; an
input with two rows for one key raises at run time (a marker per input is
counted in the same aggregation).  ``merge_metrics_chain`` is the join form, kept
as the reference semantics.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KEYS = ("CENTER", "PERIOD")


def merge_actual_plan(actual: DataFrame, plan: DataFrame, measures: list[str], keys=KEYS,
                      plan_suffix: str = "_PLAN") -> DataFrame:
    """Full outer join; plan measures renamed ``<m>_PLAN``; keys coalesced."""
    plan = plan.selectExpr(*keys, *[f"`{m}` AS `{m}{plan_suffix}`" for m in measures])
    return actual.join(plan, list(keys), "full")


def merge_metrics(frames: list[DataFrame], keys=KEYS) -> DataFrame:
    values = [c for f in frames for c in f.columns if c not in keys]
    if len(values) != len(set(values)):
        raise ValueError("merge_metrics: value columns must be disjoint across inputs")
    marked = [f.withColumn(f"_from_{i}", F.lit(1)) for i, f in enumerate(frames)]
    union = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), marked)
    most = F.greatest(*(F.count(f"_from_{i}") for i in range(len(frames))), F.lit(0))
    merged = union.groupBy(*keys).agg(*[F.expr(f"max(`{c}`) AS `{c}`") for c in values], most.alias("_most"))
    twice = F.lit("merge_metrics: an input has two rows for one key")
    key, *rest = keys
    checked = F.when(F.col("_most") > 1, F.raise_error(twice).cast(merged.schema[key].dataType)).otherwise(F.col(key))
    return merged.select(checked.alias(key), *rest, *[F.col(f"`{c}`") for c in values])


def merge_metrics_chain(frames: list[DataFrame], keys=KEYS) -> DataFrame:
    return reduce(lambda a, b: a.join(b, list(keys), "full"), frames)
