"""Rolling-window reload of a target partitioned by PERIOD.

Semantics: every target row with ``period >= expiration_id`` is replaced by
the freshly computed window (no upper bound: later stale rows go too).
``reload_window`` states this as a pure DataFrame expression (the tested
core); ``write_reload`` applies it to a Parquet table directory.

A reload goes through these steps, and survives a crash in each:
1. The fresh window is staged beside the target (``<target>/_reload``, which readers of the table skip): it may read the
   target itself (last-year columns), so it cannot be written in place.
2. The staged rows are counted against the rows the plan produced; with a
   difference, with none at all (unless ``allow_empty``) or with rows without a day, the writer
   raises.  Until here the target is as it was, and a failure removes the staged files.
3. A commit record (staged path, day keys, row count, stale days) is put down in one step: written aside and renamed.  From here on
   the reload is decided.
4. The staged rows replace their partitions (dynamic partition overwrite: other partitions untouched, task retries
   idempotent); partitions ``>= expiration_id`` that the run did not produce are dropped.
5. The record goes, then the staged files.

A crash in 4 or 5 leaves the record and the staged files; ``recover_reload``, which also starts every
``write_reload``, does step 4 and 5 again, from the staged files alone.  Step 4 may be repeated at any point: it ends in the same table.

The rows that the reload replaces are counted first, from the Parquet footers of their partitions (a
scan without columns).  Both writes are rebalanced by day: adaptive execution makes one file per small
day and splits a large one; within a file rows are sorted by center.
Reruns are safe: last-year keys lie >= 364 days back, outside the window.
"""

from __future__ import annotations

import json
import time
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType



def stamp_run(df: DataFrame, column: str = "DW_MOD_DATETIME") -> DataFrame:
    """Load stamp (I2), added at write time so value comparisons stay stable."""
    return df.withColumn(column, F.current_timestamp())


def reload_window(history: DataFrame, fresh: DataFrame, expiration_id: int) -> DataFrame:
    """History before the expiration key + the fresh rows from it on (the
    insert is clipped to the window like the delete, so reruns are idempotent)."""
    kept = history.where(F.col("PERIOD") < F.lit(expiration_id))
    return kept.unionByName(fresh.where(F.col("PERIOD") >= F.lit(expiration_id)).select(*history.columns))


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p, jvm


def list_children(spark: SparkSession, path: str) -> list[str]:
    """Child paths of a directory, fetched as one string (one round trip
    however many partitions the table has); no path holds a NUL."""
    fs, p, jvm = _fs(spark, path)
    if not fs.exists(p):
        return []
    paths = jvm.org.apache.hadoop.fs.FileUtil.stat2Paths(fs.listStatus(p))
    objects = spark.sparkContext._gateway.new_array(jvm.java.lang.Object, len(paths))
    jvm.java.lang.System.arraycopy(paths, 0, objects, 0, len(paths))
    return [x for x in jvm.org.apache.commons.lang3.StringUtils.join(objects, "\0").split("\0") if x]


def partition_dirs(spark: SparkSession, path: str, col: str = "PERIOD") -> dict[int, str]:
    """``{key: path}`` for the ``col=<int>`` partition directories of a table
    (others, such as the one of null keys, are left out)."""
    out = {}
    for child in list_children(spark, path):
        name, _, key = child.rstrip("/").rsplit("/", 1)[-1].partition("=")
        if name == col and key.isascii() and key.isdigit():
            out[int(key)] = child
    return out


def remove(spark: SparkSession, path: str) -> None:
    fs, p, _ = _fs(spark, path)
    if fs.exists(p):
        fs.delete(p, True)


def _read_text(spark: SparkSession, path: str) -> str | None:
    fs, p, jvm = _fs(spark, path)
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        return jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def _create(spark: SparkSession, path: str, text: str) -> bool:
    """A file that was not there before, with this text; False if there is one."""
    fs, p, jvm = _fs(spark, path)
    fs.mkdirs(p.getParent())
    try:
        stream = fs.create(p, False)
    except Exception:
        if fs.exists(p):
            return False
        raise
    try:
        stream.write(bytearray(text, "utf-8"))
    finally:
        stream.close()
    return True


def _rename(spark: SparkSession, path: str, to: str) -> bool:
    fs, p, jvm = _fs(spark, path)
    try:
        return fs.rename(p, jvm.org.apache.hadoop.fs.Path(to))
    except Exception:  # gone meanwhile
        return False


def _area(target: str) -> str:
    return f"{target.rstrip('/')}/_reload"


def record_path(target: str) -> str:
    return f"{_area(target)}/commit.json"


def count_rows(spark: SparkSession, paths: list[str]) -> int:
    """Rows of Parquet directories by their footers: a scan that reads no column."""
    return footer_scan(spark, paths).count() if paths else 0


def footer_scan(spark: SparkSession, paths: list[str]) -> DataFrame:
    return spark.read.schema(StructType([])).parquet(*paths)


def _apply(spark: SparkSession, target: str, record: dict) -> None:
    """Steps 4 and 5: the staged rows into the table, stale days out of it, then the record and the staged files."""
    if record["keys"]:
        staged = read_staged(spark, record)
        n = staged.count()
        if n != record["rows"]:
            raise RuntimeError(f"reload of {target}: {record['rows']} rows recorded, {n} staged in {record['staging']}; record kept")
        (staged.hint("rebalance", "PERIOD").sortWithinPartitions("PERIOD", *[c for c in staged.columns if c == "CENTER"])
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("PERIOD").parquet(target))
    for k in record["stale"]:
        remove(spark, f"{target.rstrip('/')}/PERIOD={k}")
    remove(spark, record_path(target))
    remove(spark, record["staging"])


def read_staged(spark: SparkSession, record: dict) -> DataFrame:
    staging = record["staging"]
    return spark.read.schema(record["schema"]).option("basePath", staging).parquet(*[f"{staging}/PERIOD={k}" for k in record["keys"]])


def recover_reload(spark: SparkSession, target: str) -> bool:
    """Finishes a reload that was decided and broke off; whether there was one."""
    text = _read_text(spark, record_path(target))
    if text is None:
        return False
    _apply(spark, target, json.loads(text))
    return True


def stage_window(spark: SparkSession, fresh: DataFrame, target: str, expiration_id: int, allow_empty: bool = False) -> dict:
    """Steps 1 and 2: the record of a reload, not put down yet."""
    counted = Observation("reload_rows")
    day = F.col("PERIOD")
    fresh = fresh.where(day.isNull() | (day >= F.lit(expiration_id))).observe(
        counted, F.count(F.lit(1)).alias("rows"), F.count_if(day.isNull()).alias("dayless"))
    staging = f"{_area(target)}/staging-{uuid.uuid4().hex}"
    try:
        fresh.hint("rebalance", "PERIOD").write.partitionBy("PERIOD").parquet(staging)
        made, keys = counted.get["rows"], sorted(partition_dirs(spark, staging))
        if dayless := counted.get["dayless"]:
            raise RuntimeError(f"reload of {target}: {dayless} of {made} rows have no PERIOD; target not touched")
        old = partition_dirs(spark, target)
        record = {"staging": staging, "keys": keys, "rows": made, "stale": sorted(k for k in old if k >= expiration_id and k not in set(keys)),
                  "schema": ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fresh.schema.fields)}
        n = read_staged(spark, record).count() if keys else 0
        if n != made:
            raise RuntimeError(f"reload of {target}: {made} rows made, {n} staged in {staging}; target not touched")
        if not n and not allow_empty:
            raise RuntimeError(f"reload of {target}: the new window is empty; target not touched")
        return record
    except BaseException:
        remove(spark, staging)
        raise


def write_reload(spark: SparkSession, fresh: DataFrame, target: str, expiration_id: int,
                 allow_empty: bool = False, restatement: tuple[str, ...] | None = None) -> dict:
    """Replace the target's window with ``fresh``.  Returns partitions ``written`` and ``dropped``, ``rows`` in and rows ``deleted``;
    with ``restatement`` (columns to leave out of the comparison) also the rows ``added``, ``changed``, ``gone`` and ``same``."""
    recover_reload(spark, target)
    record = stage_window(spark, fresh, target, expiration_id, allow_empty)
    try:
        doomed = {k: p for k, p in partition_dirs(spark, target).items() if k >= expiration_id}
        stats = {"written": len(record["keys"]), "dropped": len(record["stale"]), "rows": record["rows"],
                 "deleted": count_rows(spark, list(doomed.values()))}
        if restatement is not None:
            stats |= _restated(spark, target, record, doomed, restatement)
        aside = f"{record['staging']}.json"
        _create(spark, aside, json.dumps(record))
        if not _rename(spark, aside, record_path(target)):
            raise RuntimeError(f"reload of {target}: the commit record could not be put down; target not touched")
    except BaseException:
        remove(spark, f"{record['staging']}.json")
        remove(spark, record["staging"])
        raise
    _apply(spark, target, record)
    return stats


def _restated(spark: SparkSession, target: str, record: dict, doomed: dict, ignore: tuple[str, ...]) -> dict:
    from daybook.operators.restatement import STATES, window_changes
    schema = record["schema"]
    read = lambda base, paths: (spark.read.schema(schema).option("basePath", base).parquet(*paths) if paths
                                else spark.createDataFrame([], schema))
    new = read(record["staging"], [f"{record['staging']}/PERIOD={k}" for k in record["keys"]])
    days = window_changes(read(target, list(doomed.values())), new, ignore=ignore)
    total = days.agg(*[F.coalesce(F.sum(s), F.lit(0)).alias(s) for s in STATES]).first()
    return {s.lower(): total[s] for s in STATES}


class TargetBusy(RuntimeError):
    """Another run holds the target."""


@contextmanager
def lease(spark: SparkSession, target: str, owner: str, seconds: int = 6 * 3600):
    """One run at a time on a target: a file that only one run can create, with owner and expiry, gone at the end.

    A lease past its expiry is taken over: it is renamed away, which only one of several runs can do, before a
    new one is made.  On stores without an atomic create, keep runs apart by the scheduler."""
    path = f"{_area(target)}/lease.json"
    mine = json.dumps({"owner": owner, "run": uuid.uuid4().hex, "until": time.time() + seconds})
    if not _create(spark, path, mine):
        held = json.loads(_read_text(spark, path) or "{}")
        if held.get("until", 0) > time.time():
            raise TargetBusy(f"{target} is held by {held.get('owner')} until {time.ctime(held['until'])}; target not touched")
        old = f"{_area(target)}/lease-{uuid.uuid4().hex}.old"
        taken = _rename(spark, path, old)
        remove(spark, old)
        if not taken or not _create(spark, path, mine):
            raise TargetBusy(f"{target}: another run took over its lease; target not touched")
    try:
        yield
    finally:
        if _read_text(spark, path) == mine:
            remove(spark, path)
