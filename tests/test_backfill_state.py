"""Many run dates in one plan, and newest-extract sums from new extracts alone."""

import datetime as dt
import os
import random

import pytest
from pyspark.sql import functions as F

from daybook import catalog as cat
from daybook.operators.snapshot import latest_snapshot
from daybook.operators.snapshot_state import SnapshotState, month_of
from daybook.plans.backfill import Backfill, backfill_revenue
from daybook.plans.revenue import run_revenue


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_backfill_equals_single_runs_without_range_joins(spark, sf_dir):
    src = cat.revenue_sources(spark, sf_dir)
    days = [dt.date(2000, 3, 1), dt.date(2000, 3, 15), dt.date(2000, 4, 2)]
    out = backfill_revenue(src, days, cat.FIXTURE_PARAMS)
    text = plan(out)
    assert "NestedLoop" not in text and "Cartesian" not in text
    got = {}
    for r in out.collect():
        got.setdefault(r.AS_OF, []).append(tuple(r)[1:])
    for day in days:
        one = run_revenue(src, cat.RunClock.from_dates(day), cat.FIXTURE_PARAMS)
        assert one.columns == out.columns[1:]
        assert sorted(got.pop(day)) == sorted(map(tuple, one.collect()))
    assert not got


def test_backfill_bounds():
    year = [dt.date(2000, 3, 15), dt.date(2001, 3, 15)]
    with pytest.raises(ValueError, match="last-year days"):
        Backfill.of(year)
    with pytest.raises(ValueError, match="no run dates"):
        Backfill.of([])
    runs = Backfill.of([*year, year[0]], fixed_history=True)
    assert [c.as_of for c in runs.clocks] == year
    near = Backfill.of([dt.date(2000, 3, 10), dt.date(2000, 3, 20)])
    assert near.last_year_ranges() == [(19990201, 19990228), (19990303, 19990321)]
    assert near.bounds("plan_end_id") == (20000201, 20000331)


SCHEMA = "CENTER int, PERIOD int, ACCOUNT string, DATA_VALUE double, EXTRACT_DATE_ID int"


def feed_rows(n=400):
    rng = random.Random(4)
    rows = [(rng.randint(1, 4), 20000100 + rng.randint(1, 3) + 100 * rng.randint(0, 1), rng.choice("abc"), float(rng.randint(1, 9)), rng.randint(1, 9))
            for _ in range(n)]
    return [*rows, (None, 20000101, "a", 1.0, 9), (1, 20000101, None, 1.0, 9), (1, 20000101, "a", 1.0, None), (1, 20000101, "z", None, 9)]


@pytest.mark.parametrize("spec, prepare", [
    (SnapshotState(("CENTER", "PERIOD", "ACCOUNT"), ("DATA_VALUE",)), None),
    (SnapshotState(("CENTER", "MONTH", "ACCOUNT"), ("DATA_VALUE",), ("PERIOD",)), lambda d: d.withColumn("MONTH", month_of()))])
def test_stored_state_reads_new_extracts_only_and_equals_the_whole(spark, tmp_path, spec, prepare):
    stored, path = str(tmp_path / "feed"), str(tmp_path / "state")
    raw = spark.createDataFrame(feed_rows(), SCHEMA)
    raw.where("EXTRACT_DATE_ID IS NOT NULL").write.partitionBy("EXTRACT_DATE_ID").parquet(stored)
    feed = spark.read.parquet(stored)

    def whole(upto):
        rows = feed.where(F.col("EXTRACT_DATE_ID") <= upto)
        rows = rows if prepare is None else prepare(rows)
        sums = latest_snapshot(rows, list(spec.keys)).groupBy(*spec.keys, *spec.detail, spec.version).agg(F.sum("DATA_VALUE").alias("DATA_VALUE"))
        return sorted(map(tuple, sums.select(*spec.columns).collect()), key=str)

    def state():
        return sorted(map(tuple, spec.read(spark, path)[0].select(*spec.columns).collect()), key=str)

    since = 0
    for upto in (3, 5, 9):
        scan = plan(spec.new_rows(feed, since, upto))
        assert "PartitionFilters: [isnotnull(EXTRACT_DATE_ID" in scan and f"> {since})" in scan and f"<= {upto})" in scan
        assert spec.update(spark, path, feed, upto, prepare=prepare) == {"since": since, "upto": upto, "advanced": True}
        assert state() == whole(upto)
        since = upto
    assert spec.update(spark, path, feed, 9, prepare=prepare)["advanced"] is False
    assert sorted(os.listdir(path)) == ["upto=5", "upto=9"]
    # a state that was not written to its end does not count
    os.rename(f"{path}/upto=9/_SUCCESS", f"{tmp_path}/gone")
    assert spec.read(spark, path)[1] == 5 and state() == whole(5)
    assert spec.update(spark, path, feed, 9, prepare=prepare)["since"] == 5 and state() == whole(9)
