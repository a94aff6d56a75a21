"""Job entry points: stamped, audited reload into a PERIOD-partitioned target."""

import os
import tempfile

from pyspark.sql import functions as F

from daybook import catalog as cat
from daybook.functions.measures import REVENUE_MEASURES, revenue_output_columns
from daybook.operators.audit import AuditLog
from daybook.plans import ops_goals as og
from daybook.plans.revenue import load_revenue


def test_load_revenue_first_run_then_rerun(spark, sf_dir):
    target = os.path.join(tempfile.mkdtemp(prefix="daybook-job-"), "revenue")
    c = cat.clock()
    src = cat.revenue_sources(spark, sf_dir)
    src.history = src.history.where(F.lit(False)).selectExpr("CENTER", "PERIOD", *REVENUE_MEASURES)  # first run
    audit = AuditLog(etl_date=c.extract_id, job_id=1, sp_name="revenue", package_name="daybook")
    assert load_revenue(src, c, target, audit, cat.FIXTURE_PARAMS) == 0
    out = spark.read.parquet(target)
    assert set(out.columns) == set(revenue_output_columns()) | {"DW_MOD_DATETIME"}
    first = sorted(out.drop("DW_MOD_DATETIME").selectExpr("CENTER", "PERIOD", "TOTALCARDREV_PLAN").collect())
    assert first and min(r.PERIOD for r in first) >= c.expiration_id
    msgs = [e.MESSAGE for e in audit.events]
    assert msgs[0] == "Start of revenue" and msgs[-1] == "Procedure Completed Successfully"
    assert "insert" in msgs
    # rerun reading its own target as history: same rows (idempotent)
    src.history = spark.read.parquet(target)
    assert load_revenue(src, c, target, AuditLog(etl_date=c.extract_id), cat.FIXTURE_PARAMS) == 0
    again = sorted(spark.read.parquet(target).selectExpr("CENTER", "PERIOD", "TOTALCARDREV_PLAN").collect())
    assert again == first


def test_load_ops_goals_writes_90_columns(spark, sf_dir):
    target = os.path.join(tempfile.mkdtemp(prefix="daybook-job-"), "ops")
    c = cat.clock()
    src = cat.ops_sources(spark, sf_dir)
    audit = AuditLog(etl_date=c.extract_id)
    assert og.load_ops_goals(src, c, target, audit, cat.FIXTURE_ACCOUNTS, cat.TEXT_CAST) == 0
    out = spark.read.parquet(target)
    assert len(out.columns) == 90
    assert out.count() == cat.QUERIES["ops_goals"](spark, sf_dir).count()


def test_first_run_reads_an_empty_target(spark, sf_dir, tmp_path):
    from daybook.plans.revenue import revenue_target_schema
    from daybook.sources.feeds import read_partitions
    c = cat.clock()
    src = cat.revenue_sources(spark, sf_dir)
    src.history = read_partitions(spark, str(tmp_path / "none"), c.last_year_ranges(), schema=revenue_target_schema())
    assert load_revenue(src, c, str(tmp_path / "t"), AuditLog(etl_date=c.extract_id, sink=str(tmp_path / "a")), cat.FIXTURE_PARAMS) == 0
    assert spark.read.parquet(str(tmp_path / "t")).agg(F.sum("ATM_FEE_LY")).first()[0] == 0
    assert "Procedure Completed Successfully" in {r.MESSAGE for r in spark.read.parquet(str(tmp_path / "a")).collect()}


def test_target_schemas_are_the_jobs_columns(spark, sf_dir):
    from daybook.plans.revenue import revenue_target_schema, run_revenue
    c = cat.clock()
    rev = run_revenue(cat.revenue_sources(spark, sf_dir), c, cat.FIXTURE_PARAMS)
    assert [(f.name, f.dataType) for f in rev.schema] == [(f.name, f.dataType) for f in revenue_target_schema()]
    ops = og.run_ops_goals(cat.ops_sources(spark, sf_dir), c, cat.FIXTURE_ACCOUNTS, cat.TEXT_CAST)
    assert ops.columns == og.ops_target_schema().fieldNames()


def test_decimal_feeds_give_the_same_revenue(spark, sf_dir):
    """DECIMAL(18,2) measures against the oracle-checked DOUBLE form (whole cents, so exact in both)."""
    from daybook.plans.revenue import run_revenue
    c = cat.clock()
    src, dec = cat.revenue_sources(spark, sf_dir), cat.revenue_sources(spark, sf_dir)
    as_decimal = lambda df: df.select("CENTER", "PERIOD", *[F.col(x).cast("decimal(18,2)").alias(x) for x in df.columns[2:]])
    dec.actual, dec.plan = as_decimal(dec.actual), as_decimal(dec.plan)
    a = cat.finalize(run_revenue(src, c, cat.FIXTURE_PARAMS))
    b = cat.finalize(run_revenue(dec, c, cat.FIXTURE_PARAMS))
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))
