"""Sums that do not depend on the order of rows."""

import math
import random
from dataclasses import replace
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from daybook import catalog as cat
from daybook.functions.exact import exact_sum_sql, total_sql
from daybook.operators.snapshot_state import SnapshotState
from daybook.plans import ops_goals as og
from daybook.plans.revenue import daily_revenue, run_revenue
from daybook.sources.fixtures import fixture


def on_grid(values, places):
    """The defined result, in rationals."""
    total = Fraction(0)
    for v in values:
        whole = math.trunc(v)
        total += whole + Fraction(round((v - whole) * float(f"1e{places}")), 10**places)
    return float(total)


def total_of(spark, values, places, parts=1):
    df = spark.createDataFrame([(v,) for v in values], "x double").repartition(parts)
    return df.agg(F.expr(exact_sum_sql("x", places)).alias("s")).first().s


@pytest.mark.parametrize("places", [1, 2, 6, 9])
def test_against_rationals(spark, places):
    rng = random.Random(places)
    values = [rng.uniform(-1, 1) * 10 ** rng.randint(-9, 9) for _ in range(2000)] + [0.1] * 10 + [-0.0, 1e17, -1e17, 2.0**53 + 2]
    want = on_grid(values, places)
    rng.shuffle(values)
    assert {total_of(spark, values, places, n) for n in (1, 7, 200)} == {want}


def test_decimal_values_add_up_as_decimals(spark):
    assert total_of(spark, [0.1, 0.2], 6) == 0.3 and total_of(spark, [0.1] * 10, 6) == 1.0
    assert total_of(spark, [1e16, 0.25, -1e16], 6) == 0.25  # lost by a plain sum


def test_nulls_nan_and_infinities(spark):
    inf, nan = float("inf"), float("nan")
    assert total_of(spark, [None, None], 6) is None and total_of(spark, [], 6) is None
    assert total_of(spark, [None, 1.5], 6) == 1.5
    assert total_of(spark, [1.0, inf], 6) == inf and total_of(spark, [1.0, -inf], 6) == -inf
    assert math.isnan(total_of(spark, [1.0, nan], 6)) and math.isnan(total_of(spark, [inf, -inf], 6))


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_too_large_values_and_sums_raise(spark, ansi):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        with pytest.raises(Exception, match="1e18 or more"):
            total_of(spark, [1e18], 6)
        with pytest.raises(Exception, match="beyond BIGINT"):
            total_of(spark, [9e17] * 20, 6, 3)
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)


def test_places_are_bounded():
    for places in (0, 10):
        with pytest.raises(ValueError):
            exact_sum_sql("x", places)
    assert total_sql("x") == "SUM(x)"


def shuffled(df, parts, seed):
    return df.orderBy(F.rand(seed)).repartition(parts)


def bits(df, keys):
    return {tuple(r[k] for k in keys): tuple(v if v is None or not isinstance(v, float) else v.hex() for v in r)
            for r in df.collect()}


def test_same_bits_at_1_and_200_partitions(spark, sf_dir):
    """Plain sums of this feed differ between the two, order-free ones don't."""
    feed = fixture(spark, sf_dir, "daily_actual_thirds").withColumn("CENTER", F.col("CENTER") % 3 + 100)
    feed = feed.withColumn("PERIOD", F.lit("20000301")).cache()
    seen = {}
    for places in (None, 6):
        runs = [bits(daily_revenue(shuffled(feed, n, n), 20000301, 20000301, places=places), ["CENTER"]) for n in (1, 200)]
        assert len(runs[0]) == 3
        seen[places] = runs[0] == runs[1]
    assert seen == {None: False, 6: True}


def test_snapshot_state_with_places(spark):
    rows = [("a", 20000301, 0.1)] * 10 + [("a", 20000302, 0.1), ("a", 20000302, 0.2), ("b", 20000301, 1 / 3)]
    df = spark.createDataFrame(rows, "K string, EXTRACT_DATE_ID int, V double")
    state = SnapshotState(("K",), ("V",), places=6).advance(None, df.where("EXTRACT_DATE_ID = 20000301"))
    assert {r.K: r.V for r in state.collect()} == {"a": 1.0, "b": 0.333333}
    state = SnapshotState(("K",), ("V",), places=6).advance(state, df.where("EXTRACT_DATE_ID = 20000302"))
    assert {r.K: r.V for r in state.collect()} == {"a": 0.3, "b": 0.333333}


def same_numbers(a, b, keys):
    as_bits = lambda df: {tuple(r[k] for k in keys): {c: float(v).hex() if isinstance(v, (int, float)) else v
                                                       for c, v in r.asDict().items()} for r in df.collect()}
    assert as_bits(a) == as_bits(b)


def test_jobs_on_whole_cents_give_the_same_with_places(spark, sf_dir):
    """On values whose plain sums are exact, both forms of either job agree to the bit."""
    src, c = cat.revenue_sources(spark, sf_dir), cat.clock()
    plain = run_revenue(src, c, cat.FIXTURE_PARAMS)
    same_numbers(plain, run_revenue(src, c, replace(cat.FIXTURE_PARAMS, places=2)), ["CENTER", "PERIOD"])
    ops = cat.ops_sources(spark, sf_dir)
    run = lambda places: og.run_ops_goals(ops, c, cat.FIXTURE_ACCOUNTS, cat.TEXT_CAST, places=places)
    same_numbers(run(None), run(2), ["CENTER", "PERIOD"])


def test_plan_stays_a_hash_aggregate(spark, sf_dir):
    df = daily_revenue(fixture(spark, sf_dir, "daily_actual_thirds"), 20000301, 20000331, places=6)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "ObjectHashAggregate" not in plan and plan.count("Exchange") == 1
