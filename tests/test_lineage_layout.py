"""Lineage stamps across reloads, and the layout of clustered feeds."""

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from daybook import catalog as cat
from daybook.operators.audit import AuditLog
from daybook.operators.lineage import LINEAGE_COLUMNS, WINDOW_SCHEMA, read_window_stamps, stamp_lineage
from daybook.operators.reload import stamp_run, write_reload
from daybook.plans.revenue import load_revenue, revenue_target_schema
from daybook.sources.feeds import window_feed, write_clustered
from daybook.sources.fixtures import fixture

FRESH = "CENTER int, PERIOD int, M double"
FULL = FRESH + ", DW_CREATED_DATETIME timestamp, DW_CREATED_BY string, DW_MOD_DATETIME timestamp, DW_MOD_BY string"


def reload(spark, target, rows, user):
    fresh = spark.createDataFrame(rows, FRESH)
    return write_reload(spark, stamp_lineage(fresh, read_window_stamps(spark, target, 20000201), user), target, 20000201)


def table(spark, target):
    return {(r.CENTER, r.PERIOD): r for r in spark.read.schema(FULL).parquet(target).collect()}


def test_rerun_keeps_created_and_moves_modified(spark, tmp_path):
    target = f"{tmp_path}/t"
    reload(spark, target, [(1, 20000201, 1.0), (2, 20000201, 2.0)], "ann")
    first = table(spark, target)
    assert all(r.DW_CREATED_DATETIME == r.DW_MOD_DATETIME and (r.DW_CREATED_BY, r.DW_MOD_BY) == ("ann", "ann") for r in first.values())
    reload(spark, target, [(1, 20000201, 5.0), (3, 20000202, 3.0)], "bob")
    second = table(spark, target)
    assert set(second) == {(1, 20000201), (3, 20000202)}
    kept, new = second[1, 20000201], second[3, 20000202]
    assert kept.M == 5.0 and kept.DW_CREATED_DATETIME == first[1, 20000201].DW_CREATED_DATETIME and kept.DW_CREATED_BY == "ann"
    assert kept.DW_MOD_DATETIME > kept.DW_CREATED_DATETIME and kept.DW_MOD_BY == "bob"
    assert new.DW_CREATED_BY == "bob" and new.DW_CREATED_DATETIME == new.DW_MOD_DATETIME == kept.DW_MOD_DATETIME


def test_rows_from_before_lineage_take_their_load_stamp(spark, tmp_path):
    target = f"{tmp_path}/t"
    write_reload(spark, stamp_run(spark.createDataFrame([(1, 20000201, 1.0)], FRESH)), target, 20000201)
    loaded = spark.read.parquet(target).first().DW_MOD_DATETIME
    reload(spark, target, [(1, 20000201, 2.0)], "bob")
    row = table(spark, target)[1, 20000201]
    assert row.DW_CREATED_DATETIME == loaded and row.DW_CREATED_BY is None and row.DW_MOD_BY == "bob"


def test_repeated_old_keys_do_not_multiply_rows(spark):
    old = spark.createDataFrame([(1, 20000201, None, "x", None)] * 3, WINDOW_SCHEMA)
    fresh = spark.createDataFrame([(1, 20000201, 1.0), (None, 20000201, 2.0)], FRESH)
    out = stamp_lineage(fresh, old, "ann").collect()
    assert len(out) == 2 and {(r.CENTER, r.DW_CREATED_BY) for r in out} == {(1, "x"), (None, "ann")}
    assert all(r.DW_CREATED_DATETIME is not None for r in out)


def test_job_with_lineage(spark, sf_dir, tmp_path):
    target, c = f"{tmp_path}/revenue", cat.clock()
    src = cat.revenue_sources(spark, sf_dir)
    src.history = spark.createDataFrame([], revenue_target_schema())
    for user in ("ann", "bob"):
        audit = AuditLog(etl_date=c.extract_id)
        assert load_revenue(src, c, target, audit, cat.FIXTURE_PARAMS, restatement=True, lineage_user=user) == 0
    out = spark.read.parquet(target)
    assert set(LINEAGE_COLUMNS) <= set(out.columns)
    assert [tuple(r) for r in out.select("DW_CREATED_BY", "DW_MOD_BY").distinct().collect()] == [("ann", "bob")]
    assert out.where("DW_CREATED_DATETIME >= DW_MOD_DATETIME").count() == 0
    counts = {e.MESSAGE: e.ROW_COUNT for e in audit.events}
    assert counts["Restatement: same"] == out.count() > 0 and counts["Restatement: changed"] == 0


def scanned_rows(df):
    """Rows that left the Parquet scan, by its own metric."""
    df.collect()
    node = df._jdf.queryExecution().executedPlan()
    while not node.nodeName().startswith("Scan parquet"):
        node = node.children().head()
    return node.metrics().get("numOutputRows").get().value()


@pytest.fixture()
def fixed_plans(spark):
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield
    spark.conf.set("spark.sql.adaptive.enabled", before)


def test_clustered_feed_skips_row_groups(spark, sf_dir, tmp_path, fixed_plans):
    feed = fixture(spark, sf_dir, "daily_actual").select("CENTER", "PERIOD", "ATM_FEE")
    feed.repartition(4, "ATM_FEE").write.option("parquet.block.size", 4096).parquet(f"{tmp_path}/raw")
    write_clustered(feed, f"{tmp_path}/clustered", row_group_bytes=4096)
    seen = {}
    for name in ("raw", "clustered"):
        rows = spark.read.parquet(f"{tmp_path}/{name}")
        out = window_feed(rows, 20000201, 20000315)
        seen[name] = (sorted(map(tuple, out.collect()), key=str), scanned_rows(window_feed(rows, 20000201, 20000315)))
    assert seen["raw"][0] == seen["clustered"][0] and seen["raw"][0]
    total = feed.count()
    assert seen["raw"][1] > 0.9 * total and seen["clustered"][1] < 0.2 * total


def test_hot_day_and_center_are_split(spark, tmp_path, fixed_plans):  # adaptive execution would join small parts
    rows = spark.range(8000).selectExpr("7 AS CENTER", "'20000301' AS PERIOD", "CAST(id AS DOUBLE) AS M")
    write_clustered(rows, f"{tmp_path}/hot")
    files = spark.read.parquet(f"{tmp_path}/hot").groupBy(F.input_file_name()).count().collect()
    assert len(files) > 1 and max(r["count"] for r in files) < 4000 and sum(r["count"] for r in files) == 8000


def test_target_files_are_sorted_by_center(spark, tmp_path):
    target = f"{tmp_path}/t"
    fresh = spark.range(4000).selectExpr("CAST(id * 7919 % 4000 AS INT) AS CENTER", "20000201 AS PERIOD", "CAST(id AS DOUBLE) AS M")
    write_reload(spark, fresh, target, 20000201)
    files = [pq.read_table(f, columns=["CENTER"], partitioning=None).column(0).to_pylist()
             for f in (tmp_path / "t" / "PERIOD=20000201").glob("*.parquet")]
    assert files and all(f == sorted(f) for f in files) and sorted(c for f in files for c in f) == list(range(4000))
