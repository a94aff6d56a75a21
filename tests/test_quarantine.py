"""Unusable feed values: left out, counted in the job's own pass, kept with the reason."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from daybook import catalog as cat
from daybook.functions.predicates import is_fact_center
from daybook.operators.audit import AuditLog
from daybook.operators.quarantine import Quarantine, reject_rows
from daybook.plans import ops_goals as og
from daybook.plans.revenue import load_revenue
from daybook.sources.feeds import day_sql, is_day_sql, reject_counts, window_feed
from daybook.sources.fixtures import fixture


def test_day_keys(spark):
    keys = [20000229, 19990229, 20000230, 20001301, 20000100, 20000131, 20000431, 20000430, 0, -20000101, 200001, 120000101, 99991231]
    df = spark.createDataFrame([(k, str(k)) for k in keys] + [(None, "2000-02-01"), (None, "unknown"), (None, " 20000201"), (None, None)],
                               "K long, T string")
    got = df.selectExpr(f"{is_day_sql('K')} AS A", f"{day_sql('K')} AS B", f"{day_sql('T')} AS C").collect()

    def real(k):
        try:
            return dt.datetime.strptime(str(k), "%Y%m%d").date() if len(str(k)) == 8 and str(k).isdigit() else None
        except ValueError:
            return None
    assert [(r.A, r.B, r.C) for r in got[: len(keys)]] == [(real(k) is not None, real(k), real(k)) for k in keys]
    assert [r.C for r in got[len(keys):]] == [None] * 4


@pytest.mark.parametrize("kind", ["double", "decimal(10,2)", "string", "bigint"])
def test_centers_that_are_no_whole_number_never_become_null(spark, kind):
    raw = spark.createDataFrame([("3050.5", 1.0), ("3050", 2.0), ("61", 4.0), ("12", 8.0), (None, 16.0)], "CENTER string, M double")
    feed = raw.selectExpr(f"try_cast(CENTER AS {kind}) AS CENTER", "20000201 AS PERIOD", "M")
    got = sorted((r.CENTER, r.M) for r in window_feed(feed, 20000201, 20000229, is_fact_center).collect())
    assert got in ([(61, 4.0), (3050, 2.0)], [(61, 4.0), (3050, 1.0), (3050, 2.0)])
    assert kind == "bigint" or len(got) == 2


def test_the_revenue_load_counts_and_keeps_rejects(spark, sf_dir, tmp_path):
    c = cat.clock()
    src = cat.revenue_sources(spark, sf_dir)
    src.plan = fixture(spark, sf_dir, "daily_plan_odd_keys")
    window = src.plan.where(F.col("PERIOD").between(c.start_id, c.plan_end_id))
    want = {r.FIELD: r.N for r in reject_rows(window, "plan").groupBy("FIELD").agg(F.count(F.lit(1)).alias("N")).collect()}
    assert set(want) == {"CENTER", "PERIOD"}
    assert {r.FIELD: r.N_ROWS for r in reject_counts(window).collect()} == {"CENTER": want["CENTER"]}
    target, sink = str(tmp_path / "t"), str(tmp_path / "rejects")
    for _ in range(2):  # a rerun replaces its own rejects
        audit = AuditLog(etl_date=c.extract_id)
        assert load_revenue(src, c, target, audit, cat.FIXTURE_PARAMS, quarantine=Quarantine(c.extract_id, sink), restatement=True) == 0
        told = {e.MESSAGE: e.ROW_COUNT for e in audit.events}
        assert {k: told[f"Rejects of plan: {k}"] for k in want} == want
        assert not [m for m in told if m.startswith("Rejects of actual")]
        kept = spark.read.parquet(sink)
        assert {r.FIELD: r.N for r in kept.where(f"EXTRACT_DATE_ID = {c.extract_id}").groupBy("FIELD").agg(F.count(F.lit(1)).alias("N")).collect()} == want
    out = spark.read.parquet(target)
    assert out.where("CENTER IS NULL OR PERIOD IS NULL OR DATES IS NULL").count() == 0
    n = out.count()
    assert told[f"Delete from target where PERIOD >= {c.expiration_id}"] == n and told["insert"] == n
    assert [told[f"Restatement: {x}"] for x in ("added", "changed", "gone", "same")] == [0, 0, 0, n]
    src.plan = fixture(spark, sf_dir, "daily_plan")  # nothing to reject any more
    load_revenue(src, c, target, AuditLog(etl_date=c.extract_id), cat.FIXTURE_PARAMS, quarantine=Quarantine(c.extract_id, sink))
    assert not [p for p in (tmp_path / "rejects").iterdir() if "=" in p.name]


def test_the_ops_load_counts_texts_and_day_keys_of_text_feeds(spark, sf_dir, tmp_path):
    c = cat.clock()
    src = cat.ops_sources(spark, sf_dir)
    src.center = fixture(spark, sf_dir, "text_center_metrics")
    audit = AuditLog(etl_date=c.extract_id)
    q = Quarantine(c.extract_id, str(tmp_path / "rejects"))
    assert og.load_ops_goals(src, c, str(tmp_path / "t"), audit, cat.FIXTURE_ACCOUNTS, cat.TEXT_CAST, quarantine=q) == 0
    in_window = F.col("PERIOD").between(str(c.start_id), str(c.end_id))
    want = {("center", r.FIELD): r.N_ROWS for r in reject_counts(src.center.where(in_window), og.CHECK_TEXTS).collect()}
    want |= {("staff", r.FIELD): r.N_ROWS for r in reject_counts(src.staff.where(in_window), list(og.STAFF_MAP.values())).collect()}
    want["center", "PERIOD"] = src.center.where("PERIOD = 'unknown'").count()
    goals = reject_rows(og.goal_rows(src.goals, c), "goals").groupBy("FIELD").agg(F.count(F.lit(1)).alias("N")).collect()
    want |= {("goals", r.FIELD): r.N for r in goals}
    assert want["goals", "CENTER"] and want["center", "CENTER"]
    assert q.counts == want
    assert {e.MESSAGE: e.ROW_COUNT for e in audit.events if e.MESSAGE.startswith("Rejects")} == {f"Rejects of {f}: {x}": n for (f, x), n in want.items()}
    kept = spark.read.parquet(str(tmp_path / "rejects")).groupBy("FEED", "FIELD").agg(F.count(F.lit(1)).alias("N")).collect()
    assert {(r.FEED, r.FIELD): r.N for r in kept} == want
    assert spark.read.parquet(str(tmp_path / "t")).where("CENTER IS NULL").count() == 0
