"""Rolling-window reload (pure form and Parquet writer) and stage audit."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from daybook.operators.audit import AuditLog, run_job
from daybook.operators.reload import reload_window, write_reload

SCHEMA = "CENTER int, PERIOD int, M double"


def rows(df):
    return sorted(tuple(r) for r in df.select("CENTER", "PERIOD", "M").collect())


def test_reload_window_deletes_everything_from_expiration(spark):
    hist = spark.createDataFrame([(1, 20000131, 1.0), (1, 20000201, 2.0), (1, 20000420, 3.0)], SCHEMA)
    fresh = spark.createDataFrame([(1, 20000201, 9.0), (1, 20000202, 8.0)], SCHEMA)
    out = reload_window(hist, fresh, 20000201)
    assert rows(out) == [(1, 20000131, 1.0), (1, 20000201, 9.0), (1, 20000202, 8.0)]
    assert rows(reload_window(out, fresh, 20000201)) == rows(out)  # idempotent


def test_write_reload_replaces_window_and_drops_stale_partitions(spark):
    target = os.path.join(tempfile.mkdtemp(prefix="daybook-test-"), "target")
    hist = spark.createDataFrame([(1, 20000131, 1.0), (1, 20000201, 2.0), (2, 20000420, 3.0)], SCHEMA)
    hist.write.partitionBy("PERIOD").parquet(target)
    fresh = spark.createDataFrame([(1, 20000201, 9.0), (1, 20000202, 8.0)], SCHEMA)
    stats = write_reload(spark, fresh, target, 20000201)
    assert stats == {"written": 2, "dropped": 1, "rows": 2, "deleted": 2}
    assert len(os.listdir(os.path.join(target, "PERIOD=20000201"))) == 2  # one file and its checksum
    got = rows(spark.read.parquet(target))
    assert got == [(1, 20000131, 1.0), (1, 20000201, 9.0), (1, 20000202, 8.0)]
    write_reload(spark, fresh, target, 20000201)  # rerun-safe
    assert rows(spark.read.parquet(target)) == got


def test_write_reload_reading_its_own_target(spark):
    """The fresh window may be computed from the target itself (last-year reads)."""
    target = os.path.join(tempfile.mkdtemp(prefix="daybook-test-"), "target")
    spark.createDataFrame([(1, 19990201, 5.0), (1, 20000201, 2.0)], SCHEMA).write.partitionBy("PERIOD").parquet(target)
    cur = spark.read.parquet(target)
    fresh = (cur.where("PERIOD = 19990201").select("CENTER", (F.col("PERIOD") + 10000).alias("PERIOD"),
                                                    (F.col("M") * 2).alias("M")))
    write_reload(spark, fresh, target, 20000201)
    assert rows(spark.read.parquet(target)) == [(1, 19990201, 5.0), (1, 20000201, 10.0)]


def test_audit_counts_stages_and_failure_path(spark):
    audit = AuditLog(etl_date=20000314, job_id=7, sp_name="job", package_name="pkg")
    df = audit.stage("numbers", spark.range(10).where("id % 2 = 0"))

    def body():
        df.write.format("noop").mode("overwrite").save()
        audit.collect_stages()
    run_job(audit, "job", body)
    msgs = [(e.MESSAGE, e.ROW_COUNT) for e in audit.events]
    assert msgs == [("Start of job", 0), ("numbers", 5), ("Procedure Completed Successfully", 0)]

    failing = AuditLog(etl_date=20000314)
    with pytest.raises(ZeroDivisionError):
        run_job(failing, "job", lambda: 1 / 0)
    assert failing.events[-1].SEVERITY == 1 and "division" in failing.events[-1].MESSAGE
    assert failing.to_df(spark).count() == 2


def test_audit_rows_append_to_table(spark):
    path = os.path.join(tempfile.mkdtemp(prefix="daybook-audit-"), "audit")
    for run in range(2):
        log = AuditLog(etl_date=20000314 + run, job_id=run)
        log.log("start")
        log.append_to(spark, path)
    got = sorted((r.ETL_DATE, r.MESSAGE) for r in spark.read.parquet(path).collect())
    assert got == [(20000314, "start"), (20000315, "start")]


def test_read_partitions_ranges_and_first_run(spark):
    from daybook.sources.feeds import read_partitions
    root = tempfile.mkdtemp(prefix="daybook-parts-")
    target = os.path.join(root, "t")
    spark.createDataFrame([(1, p, 1.0) for p in (19990201, 19990215, 19990301, 20000101)], SCHEMA) \
        .write.partitionBy("PERIOD").parquet(target)
    got = read_partitions(spark, target, [(19990201, 19990228), (20000101, 20000101)])
    assert sorted(r.PERIOD for r in got.collect()) == [19990201, 19990215, 20000101]
    assert read_partitions(spark, target, [(18000101, 18000102)]).count() == 0
    empty = read_partitions(spark, os.path.join(root, "missing"), [(1, 2)], schema=SCHEMA)
    assert empty.count() == 0 and empty.columns == ["CENTER", "PERIOD", "M"]
    with pytest.raises(ValueError):
        read_partitions(spark, os.path.join(root, "missing"), [(1, 2)])


def files(path):
    return {os.path.join(d, f): open(os.path.join(d, f), "rb").read() for d, _, fs in os.walk(path) for f in fs}


def test_reload_leaves_the_target_alone_when_something_is_missing(spark, tmp_path, monkeypatch):
    from daybook.operators import reload as r
    target = str(tmp_path / "target")
    spark.createDataFrame([(1, 20000131, 1.0), (1, 20000201, 2.0)], SCHEMA).write.partitionBy("PERIOD").parquet(target)
    before = files(target)
    fresh = spark.createDataFrame([(1, 20000201, 9.0)], SCHEMA)
    with pytest.raises(RuntimeError, match="empty"):
        write_reload(spark, fresh.where("false"), target, 20000201)
    # staged files that cannot be listed, as with executors that write to folders of their own
    real = r.partition_dirs
    monkeypatch.setattr(r, "partition_dirs", lambda s, path, col="PERIOD": {} if "staging" in path else real(s, path, col))
    with pytest.raises(RuntimeError, match="1 rows made, 0 staged"):
        write_reload(spark, fresh, target, 20000201)
    monkeypatch.undo()
    bad = fresh.select("CENTER", "PERIOD", F.raise_error(F.lit("no")).cast("double").alias("M"))
    with pytest.raises(Exception):
        write_reload(spark, bad, target, 20000201)
    assert files(target) == before
    assert write_reload(spark, fresh.where("false"), target, 20000201, allow_empty=True) == {"written": 0, "dropped": 1, "rows": 0, "deleted": 1}


def test_staging_needs_a_shared_folder_off_local_masters():
    from types import SimpleNamespace
    from daybook import session
    context = SimpleNamespace(master="spark://host:7077", getCheckpointDir=lambda: None)
    cluster = SimpleNamespace(sparkContext=context, conf=SimpleNamespace(get=lambda key, default: default))
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.scratch_dir(cluster)
    context.master = "local-cluster[2,1,1024]"
    assert not session.is_local(cluster)


def test_odd_paths_and_partition_names(spark, tmp_path):
    from daybook.operators.reload import partition_dirs
    target = str(tmp_path / "Foo, Inc" / "t")
    df = spark.createDataFrame([(1, 20000131, 1.0), (1, None, 2.0)], SCHEMA)
    df.write.partitionBy("PERIOD").parquet(target)
    parts = partition_dirs(spark, target)
    assert set(parts) == {20000131} and spark.read.parquet(parts[20000131]).count() == 1


def test_failure_row_is_stored_before_the_error_goes_on(spark, tmp_path):
    sink = str(tmp_path / "audit")
    audit = AuditLog(etl_date=20000314, job_id=3, sp_name="job", sink=sink)
    with pytest.raises(ZeroDivisionError):
        run_job(audit, "job", lambda: 1 / 0, spark)
    got = sorted((r.SEVERITY, r.MESSAGE) for r in spark.read.parquet(sink).collect())
    assert got == [(0, "Start of job"), (1, "job failed: division by zero")]
    run_job(AuditLog(etl_date=20000315, sink=sink), "job", lambda: 0, spark)
    assert spark.read.parquet(sink).count() == 4


def test_job_settings_come_back(spark):
    from daybook.session import JOB_CONF, job_settings
    key = next(iter(JOB_CONF))
    spark.conf.set(key, "123")
    with job_settings(spark):
        assert spark.conf.get(key) == JOB_CONF[key]
    assert spark.conf.get(key) == "123"
    spark.conf.set(key, JOB_CONF[key])


# ---- crashes, counts, leases ----------------------------------------------------------

HIST = [(1, 20000131, 1.0), (1, 20000201, 2.0), (2, 20000201, 2.5), (2, 20000420, 3.0)]
FRESH = [(1, 20000201, 9.0), (1, 20000202, 8.0), (2, 20000203, 7.0)]
AFTER = [(1, 20000131, 1.0), *FRESH]


@pytest.fixture
def target(spark, tmp_path):
    path = str(tmp_path / "target")
    spark.createDataFrame(HIST, SCHEMA).write.partitionBy("PERIOD").parquet(path)
    return path


def crash_after(monkeypatch, step):
    """The process dies in the middle of a reload that is decided."""
    from daybook.operators import reload as r
    real_apply, real_remove = r._apply, r.remove

    def apply(spark, target, record):
        if step == "record":
            raise SystemExit("killed")
        if step == "one partition":
            part = r.read_staged(spark, {**record, "keys": record["keys"][:1]})
            part.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("PERIOD").parquet(target)
            raise SystemExit("killed")

        def remove(s, path):
            if step == "overwrite" or step == "stale days" and path.endswith("commit.json"):
                raise SystemExit("killed")
            real_remove(s, path)
        monkeypatch.setattr(r, "remove", remove)
        real_apply(spark, target, record)
    monkeypatch.setattr(r, "_apply", apply)


@pytest.mark.parametrize("step", ["record", "one partition", "overwrite", "stale days"])
def test_a_reload_that_was_killed_halfway_is_finished_by_the_next_run(spark, target, monkeypatch, step):
    from daybook.operators.reload import record_path, recover_reload
    fresh = spark.createDataFrame(FRESH, SCHEMA)
    with monkeypatch.context() as m:
        crash_after(m, step)
        with pytest.raises(SystemExit):
            write_reload(spark, fresh, target, 20000201)
    assert os.path.exists(record_path(target))
    if step == "one partition":  # a mixed target: what the record is for
        assert rows(spark.read.parquet(target)) == [(1, 20000131, 1.0), (1, 20000201, 9.0), (2, 20000420, 3.0)]
    assert recover_reload(spark, target)
    assert rows(spark.read.parquet(target)) == AFTER
    assert not recover_reload(spark, target) and os.listdir(os.path.join(target, "_reload")) == []
    # or the next run does so itself, whatever its own window
    with monkeypatch.context() as m:
        crash_after(m, step)
        with pytest.raises(SystemExit):
            write_reload(spark, spark.createDataFrame([(5, 20000201, 5.0)], SCHEMA), target, 20000201)
    stats = write_reload(spark, spark.createDataFrame([(6, 20000301, 6.0)], SCHEMA), target, 20000301)
    assert rows(spark.read.parquet(target)) == [(1, 20000131, 1.0), (5, 20000201, 5.0), (6, 20000301, 6.0)]
    assert stats["deleted"] == 0


def test_a_failure_before_the_record_leaves_no_trace(spark, target, monkeypatch):
    from daybook.operators import reload as r
    before = files(target)
    monkeypatch.setattr(r, "count_rows", lambda *a: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        write_reload(spark, spark.createDataFrame(FRESH, SCHEMA), target, 20000201)
    assert files(target) == before and not r.recover_reload(spark, target)


def test_a_record_whose_staged_rows_are_gone_is_kept_and_told(spark, target, monkeypatch):
    from daybook.operators import reload as r
    with monkeypatch.context() as m:
        crash_after(m, "record")
        with pytest.raises(SystemExit):
            write_reload(spark, spark.createDataFrame(FRESH, SCHEMA), target, 20000201)
    import json
    import shutil
    record = json.loads(open(r.record_path(target)).read())
    shutil.move(f"{record['staging']}/PERIOD=20000203", os.path.join(os.path.dirname(target), "lost"))
    with pytest.raises(Exception):
        r.recover_reload(spark, target)
    assert os.path.exists(r.record_path(target)) and rows(spark.read.parquet(target)) == HIST


def test_rows_without_a_day_stop_the_reload(spark, target):
    fresh = spark.createDataFrame([*FRESH, (3, None, 1.0)], SCHEMA)
    with pytest.raises(RuntimeError, match="1 of 4 rows have no PERIOD"):
        write_reload(spark, fresh, target, 20000201)
    assert rows(spark.read.parquet(target)) == HIST


def test_deleted_rows_come_from_the_footers(spark, target):
    from daybook.operators.reload import count_rows, footer_scan, partition_dirs
    doomed = [p for k, p in partition_dirs(spark, target).items() if k >= 20000201]
    assert count_rows(spark, doomed) == 3 and count_rows(spark, []) == 0
    plan = footer_scan(spark, doomed).groupBy().count()._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<>" in plan
    assert write_reload(spark, spark.createDataFrame(FRESH, SCHEMA), target, 20000201)["deleted"] == 3


def test_restatement_counts(spark, target):
    from daybook.operators.restatement import window_changes
    fresh = spark.createDataFrame([(1, 20000201, 2.0), (2, 20000201, None), (3, 20000201, 1.0)], SCHEMA)
    stats = write_reload(spark, fresh, target, 20000201, restatement=())
    assert {k: stats[k] for k in ("added", "changed", "gone", "same")} == {"added": 1, "changed": 1, "gone": 1, "same": 1}
    two = "CENTER int, PERIOD int, A int, B int"
    old = spark.createDataFrame([(1, 1, None, 5), (2, 1, None, None)], two)
    new = spark.createDataFrame([(1, 1, 5, None), (2, 1, None, None)], two)
    assert [tuple(r) for r in window_changes(old, new).collect()] == [(1, 0, 1, 0, 1)]
    assert write_reload(spark, fresh, str(target) + "-first", 20000201, restatement=())["added"] == 3


def test_one_run_at_a_time(spark, target):
    from daybook.operators.reload import TargetBusy, lease
    before = files(target)
    with lease(spark, target, "first"):
        with pytest.raises(TargetBusy, match="first"):
            with lease(spark, target, "second"):
                raise AssertionError
        assert {k: v for k, v in files(target).items() if "lease" not in k} == before
    assert files(target) == before
    with lease(spark, target, "first", seconds=-1):  # it ran out
        with lease(spark, target, "second"):
            with pytest.raises(TargetBusy, match="second"):
                with lease(spark, target, "third"):
                    raise AssertionError
        assert files(target) == before
    with pytest.raises(ZeroDivisionError):
        with lease(spark, target, "failing"):
            1 / 0
    with lease(spark, target, "after"):
        pass
