"""Operators on hand-made frames: the edge cases the warehouse logic depends on."""

import datetime as dt
import random

from pyspark.sql import functions as F

from daybook.functions.clock import RunClock
from daybook.functions.predicates import is_fact_center, is_operating_center, is_rollup_member
from daybook.operators.merge import merge_actual_plan, merge_metrics, merge_metrics_chain
from daybook.operators.pivot import pivot_accounts
from daybook.operators.snapshot import latest_snapshot, preaggregate
from daybook.operators.spine import build_spine
from daybook.operators.window import in_window
from daybook.operators.yoy import last_year_key, with_last_year, with_last_year_two_regime

FEED = "CENTER int, PERIOD int, ACCOUNT string, DATA_VALUE double, EXTRACT_DATE_ID int"


def rows(df, *cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


def test_center_rules(spark):
    df = spark.createDataFrame([(c,) for c in [0, 24, 25, 4999, 5000, 5050, 5100, 5101, 5999, 6000]], "CENTER int")
    assert rows(df.where(is_operating_center()), "CENTER") == [(25,), (4999,), (6000,)]
    assert rows(df.where(is_fact_center()), "CENTER") == [(25,), (4999,), (5101,), (5999,), (6000,)]
    for rule in (is_operating_center, is_fact_center):  # Column and SQL forms agree
        assert rows(df.where(rule()), "CENTER") == rows(df.where(rule.sql("CENTER")), "CENTER")
    g = spark.createDataFrame([("All Centers",), ("D12",), ("025",), ("61",), (None,)], "CENTER string")
    assert rows(g.where(~is_rollup_member()), "CENTER") == [("025",), ("61",)]


def test_snapshot_keeps_ties_drops_null_keys(spark):
    df = spark.createDataFrame([
        (1, 20000101, "a", 1.0, 5), (1, 20000101, "a", 2.0, 5), (1, 20000101, "a", 9.0, 4),
        (1, 20000101, "b", 3.0, 3), (None, 20000101, "a", 7.0, 9), (1, 20000101, "a", 8.0, None),
    ], FEED)
    got = rows(latest_snapshot(df, ["CENTER", "PERIOD", "ACCOUNT"]), "ACCOUNT", "DATA_VALUE")
    assert got == [("a", 1.0), ("a", 2.0), ("b", 3.0)]


def test_snapshot_center_period_drops_account_missing_from_newest(spark):
    df = spark.createDataFrame([
        (1, 20000101, "a", 1.0, 5), (1, 20000101, "b", 2.0, 4),  # b only in an older extract
    ], FEED)
    assert rows(latest_snapshot(df, ["CENTER", "PERIOD"]), "ACCOUNT") == [("a",)]


def test_preaggregate_then_snapshot_equals_raw(spark):
    rnd = random.Random(7)
    data = [(rnd.randint(1, 3), 20000100 + rnd.randint(1, 4), rnd.choice("abc"), float(rnd.randint(0, 9)),
             rnd.randint(1, 3)) for _ in range(400)]
    df = spark.createDataFrame(data, FEED)
    keys = ["CENTER", "PERIOD", "ACCOUNT"]
    raw = latest_snapshot(df, keys).groupBy(*keys).agg(F.sum("DATA_VALUE").alias("V"))
    pre = latest_snapshot(preaggregate(df, keys, "DATA_VALUE"), keys).groupBy(*keys).agg(F.sum("DATA_VALUE").alias("V"))
    assert rows(raw, *keys, "V") == rows(pre, *keys, "V")


def test_pivot_zero_not_null_and_multi_account(spark):
    df = spark.createDataFrame([(1, 20000101, "a", 1.0, 1), (1, 20000101, "b", 2.0, 1), (2, 20000101, "c", 4.0, 1),
                                (3, 20000101, "a", None, 1)], FEED)
    out = pivot_accounts(df, {"A": ["a"], "AB": ["a", "b"]},
                         conditions={"A": F.col("PERIOD") < 20000102})
    assert rows(out, "CENTER", "A", "AB") == [(1, 1.0, 3.0), (2, 0.0, 0.0), (3, None, None)]


def test_spine_dense_unique_and_distinct_over_regions(spark):
    h = spark.createDataFrame([(61, "EAST"), (61, "WEST"), (0, "X"), (5063, "Y"), (6039, "Z")], "CENTER int, REGNAME string")
    sp = build_spine(h, dt.date(2000, 2, 1), dt.date(2000, 3, 14))
    assert sp.count() == 2 * 43
    assert sp.select("CENTER", "PERIOD").distinct().count() == sp.count()
    assert rows(sp.select("CENTER").distinct(), "CENTER") == [(61,), (6039,)]
    assert sp.agg(F.min("PERIOD"), F.max("PERIOD")).first() == (20000201, 20000314)


def test_last_year_key_regimes(spark):
    c = RunClock.from_dates(dt.date(2000, 3, 15))
    days = [dt.date(2000, 2, 28), dt.date(2000, 2, 29), dt.date(2000, 3, 1), dt.date(2000, 3, 14)]
    df = spark.createDataFrame([(d,) for d in days], "DAY date")
    got = [r[0] for r in df.select(last_year_key(F.col("DAY"), c.anchor)).collect()]
    assert got == [dt.date(1999, 2, 28), dt.date(1999, 2, 28), dt.date(1999, 3, 3), dt.date(1999, 3, 16)]


def test_two_regime_join_equals_two_branch_union(spark):
    c = RunClock.from_dates(dt.date(2000, 3, 15))
    h = spark.createDataFrame([(61, "E")], "CENTER int, REGNAME string")
    sp = build_spine(h, c.start, c.end)
    hist_rows = [(61, int((dt.date(1999, 1, 20) + dt.timedelta(days=i)).strftime("%Y%m%d")), float(i))
                 for i in range(90)]
    hist = spark.createDataFrame(hist_rows, "CENTER int, PERIOD int, M double")
    one = with_last_year_two_regime(sp, hist, {"M_LY": "M"}, c)
    closed = with_last_year(sp.where(F.col("DAY") < F.lit(c.anchor)), hist, {"M_LY": "M"},
                            F.add_months("DAY", -12))
    opened = with_last_year(sp.where(F.col("DAY") >= F.lit(c.anchor)), hist, {"M_LY": "M"},
                            F.date_sub("DAY", 364))
    assert rows(one, "PERIOD", "M_LY") == rows(closed.unionByName(opened), "PERIOD", "M_LY")
    assert one.count() == sp.count()
    # 28 and 29 Feb 2000 both read 28 Feb 1999
    feb = dict(rows(one.where("PERIOD IN (20000228, 20000229)"), "PERIOD", "M_LY"))
    assert feb[20000228] == feb[20000229]


def test_merge_metrics_equals_join_chain(spark):
    rnd = random.Random(3)
    frames = []
    for i in range(5):
        keys = {(rnd.randint(1, 4), 20000100 + rnd.randint(1, 5)) for _ in range(8)}
        frames.append(spark.createDataFrame([(c, p, float(rnd.randint(0, 9)) if rnd.random() > .2 else None)
                                             for c, p in keys], f"CENTER int, PERIOD int, V{i} double"))
    cols = ["CENTER", "PERIOD"] + [f"V{i}" for i in range(5)]
    assert rows(merge_metrics(frames), *cols) == rows(merge_metrics_chain(frames), *cols)


def test_merge_actual_plan_full_outer(spark):
    a = spark.createDataFrame([(1, 1, 1.0), (2, 1, 2.0)], "CENTER int, PERIOD int, M double")
    p = spark.createDataFrame([(2, 1, 5.0), (3, 1, 6.0)], "CENTER int, PERIOD int, M double")
    assert rows(merge_actual_plan(a, p, ["M"]), "CENTER", "M", "M_PLAN") == [(1, 1.0, None), (2, 2.0, 5.0), (3, None, 6.0)]


def test_in_window_string_and_int_keys(spark):
    s = spark.createDataFrame([("20000131",), ("20000201",), ("20000314",), ("20000315",)], "PERIOD string")
    assert in_window(s, 20000201, 20000314).count() == 2
    i = spark.createDataFrame([(20000131,), (20000201,), (20000314,), (20000315,)], "PERIOD int")
    assert in_window(i, 20000201, 20000314).count() == 2


def test_merge_metrics_refuses_two_rows_for_a_key(spark):
    import pytest
    one = spark.createDataFrame([(1, 1, 5.0), (1, 1, 7.0)], "CENTER int, PERIOD int, A double")
    two = spark.createDataFrame([(1, 1, 5.0), (1, 2, 7.0)], "CENTER int, PERIOD int, B double")
    with pytest.raises(Exception, match="two rows for one key"):
        merge_metrics([one, two]).collect()
    assert merge_metrics([two]).count() == 2


def test_text_centers_and_rejects(spark):
    from daybook.sources.feeds import normalise_keys, reject_counts, window_feed
    df = spark.createDataFrame([("61", "20000201", "1"), ("61.0", "20000201", "x"), ("061", "20000202", None), ("61.5", "20000202", "2"),
                                ("West Zone", "20000202", "3"), ("5050", "20000202", "3"), (None, "bad", "4")], "CENTER string, PERIOD string, M string")
    assert [r.CENTER for r in normalise_keys(df).collect()] == [61, 61, 61, None, None, 5050, None]
    got = window_feed(df, 20000201, 20000202, center_rule=is_fact_center)
    assert rows(got, "CENTER", "PERIOD") == [(61, 20000201), (61, 20000201), (61, 20000202)]
    assert rows(reject_counts(df, ["M"]), "FIELD", "N_ROWS") == [("CENTER", 2), ("M", 1), ("PERIOD", 1)]


def test_dda_component_equals_its_two_halves(spark):
    """Against the plain snapshot operators, with NULLs, ties and accounts missing from the newest extract."""
    from daybook.plans import ops_goals as og
    acc = og.OpsAccounts(dda={"DDAUPGRADES": ["a"], "DDANEWCARD": ["b", "c"]}, nc4s={"NC4S_SALES_CY": ["d"], "NC4S_OPPS_CY": ["e", "a"]})
    rnd = random.Random(11)
    data = [(rnd.choice([1, 61, 62, 5050]), 20000200 + rnd.randint(1, 6), rnd.choice("abcdef"),
             None if rnd.random() < .3 else float(rnd.randint(0, 9)), rnd.choice([None, 1, 2, 3])) for _ in range(150)]
    feed = spark.createDataFrame(data, FEED)
    got = og.dda_feed_component(feed, 20000201, 20000206, acc)
    latest = latest_snapshot(feed.where(F.col("ACCOUNT").isin("a", "b", "c")), ["CENTER", "PERIOD"])
    dda = pivot_accounts(latest, acc.dda)
    nc4s = pivot_accounts(latest_snapshot(feed.where(is_fact_center()), ["CENTER", "PERIOD", "ACCOUNT"]), acc.nc4s)
    cols = ["CENTER", "PERIOD", "DDAUPGRADES", "DDANEWCARD", "NC4S_SALES_CY", "NC4S_OPPS_CY"]
    key = lambda df: sorted((tuple(r) for r in df.select(*cols).collect()), key=str)
    assert key(got) == key(dda.join(nc4s, ["CENTER", "PERIOD"], "full"))


def test_source_readers_check_their_columns(spark, tmp_path):
    import pytest
    from daybook.sources import feeds
    path = str(tmp_path / "f")
    spark.createDataFrame([(1, "20000201", "a", 1.0, 5, "x")], "CENTER int, PERIOD string, ACCOUNT string, DATA_VALUE double, EXTRACT_DATE_ID int, EXTRA string").write.parquet(path)
    assert feeds.read_account_feed(spark, path).columns == ["CENTER", "PERIOD", "ACCOUNT", "DATA_VALUE", "EXTRACT_DATE_ID"]
    with pytest.raises(ValueError, match="GOAL_VALUE"):
        feeds.read_account_feed(spark, path, value="GOAL_VALUE")
    with pytest.raises(ValueError, match="ACCOUNT is string"):
        feeds.read_daily(spark, path, ["ACCOUNT"])
    assert feeds.read_daily(spark, path, ["ACCOUNT"], text=True).count() == 1
    for read in (feeds.read_hierarchy, feeds.read_calendar):
        with pytest.raises(ValueError):
            read(spark, path)


def test_default_parameters_are_the_warehouse_names():
    from daybook.plans.ops_goals import OpsAccounts
    from daybook.plans.revenue import RevenueParams
    acc, par = OpsAccounts(), RevenueParams()
    assert (par.override_centers, par.accrual_since) == ((1544,), 20191231)
    names = [a for v in (acc.nps, acc.goals, acc.dda, acc.nc4s, acc.employees, acc.shops) for x in v.values() for a in x] + acc.dds + acc.prepaid
    assert len(names) == 30 + 0 or len(names) == 31
    assert "Netspend First Time Direct Deposit Items - BNF" in acc.dds and acc.goals["DAYS_MTD"] == ["#Days"]
