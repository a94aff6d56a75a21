"""Unusable feed values: counted in the job's own pass, kept in a sink with the reason.

A value that is there but cannot be used is one of
* ``CENTER``: no whole number (a name, 3050.5); the row is left out of the job;
* ``PERIOD``: no calendar day as yyyymmdd; the row is left out of the job;
* a text measure that is no number; the row stays, with NULL for that measure.
A missing (NULL) value is none of these: the center and window rules leave such rows out, as ever.

``Quarantine.watch`` hangs an observation on a feed, so the counts come with the scan that the job makes anyway.
Only when it has counted something does ``store`` read that feed again, for the unusable values alone, and writes them
as rows of (FEED, FIELD, VALUE, CENTER, PERIOD, EXTRACT_DATE_ID) to the sink, one partition a run: a
rerun replaces its own.

Day keys as text: a key in another form (2024-02-01) compares outside any window, so the scan of the job, whose
window bounds are pushed down, need not read it.  For such feeds the period check reads the two key columns alone.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from daybook.sources.feeds import day_sql, whole_number_sql

SINK_SCHEMA = "FEED string, FIELD string, VALUE string, CENTER string, PERIOD string, EXTRACT_DATE_ID int"


def unusable_sql(df: DataFrame, numbers: list[str] = ()) -> dict[str, str]:
    """Field -> condition under which its value is unusable; fields whose type allows no such value are left out."""
    kinds = {f.name.upper(): f.dataType.typeName() for f in df.schema.fields}
    out = {}
    if kinds["CENTER"] not in ("integer", "short", "byte"):
        out["CENTER"] = f"CENTER IS NOT NULL AND ({whole_number_sql('CENTER')}) IS NULL"
    out["PERIOD"] = f"PERIOD IS NOT NULL AND ({day_sql()}) IS NULL"
    out |= {c: f"`{c}` IS NOT NULL AND try_cast(`{c}` AS DOUBLE) IS NULL" for c in numbers if kinds[c.upper()] == "string"}
    return out


def reject_rows(df: DataFrame, feed: str, numbers: list[str] = (), fields: list[str] | None = None) -> DataFrame:
    """One row (FEED, FIELD, VALUE, CENTER, PERIOD) per unusable value of ``df``."""
    bad = {c: e for c, e in unusable_sql(df, numbers).items() if fields is None or c in fields}
    name = feed.replace("'", "''")
    told = ", ".join(f"CASE WHEN {e} THEN struct('{c}' AS FIELD, CAST(`{c}` AS STRING) AS VALUE) END" for c, e in bad.items())
    rows = df.selectExpr("CAST(CENTER AS STRING) AS CENTER", "CAST(PERIOD AS STRING) AS PERIOD",
                         f"explode(filter(array({told}), x -> x IS NOT NULL)) AS bad")
    return rows.selectExpr(f"'{name}' AS FEED", "bad.FIELD", "bad.VALUE", "CENTER", "PERIOD")


@dataclass
class Watched:
    feed: str
    rows: DataFrame
    numbers: list[str]
    fields: list[str]
    seen: Observation | None


@dataclass
class Quarantine:
    """Rejects of one run, by feed.  Without a sink they are counted only."""
    extract_id: int
    sink: str | None = None
    counts: dict[tuple[str, str], int] = field(default_factory=dict)
    _watched: list[Watched] = field(default_factory=list)

    def watch(self, feed: str, window: DataFrame, numbers: list[str] = (), raw: DataFrame | None = None) -> DataFrame:
        """``window`` (raw rows of the job's window), counted when the job runs.  With ``raw`` the day keys of a text feed
        are checked on the whole of it."""
        bad = unusable_sql(window, numbers)
        if raw is not None and isinstance(raw.schema["PERIOD"].dataType, StringType):
            bad.pop("PERIOD")
            self._watched.append(Watched(feed, raw.select("CENTER", "PERIOD"), [], ["PERIOD"], None))
        if not bad:
            return window
        seen = Observation(f"rejects_{len(self._watched)}_{feed}")
        self._watched.append(Watched(feed, window, list(numbers), list(bad), seen))
        return window.observe(seen, *[F.expr(f"count_if({e})").alias(c) for c, e in bad.items()])

    def collect(self) -> dict[tuple[str, str], int]:
        """(feed, field) -> unusable values, after the job's action."""
        self.counts = {}
        for w in self._watched:
            got = w.seen.get if w.seen is not None else {"PERIOD": w.rows.where(unusable_sql(w.rows)["PERIOD"]).count()}
            for c in w.fields:
                if got.get(c):
                    self.counts[w.feed, c] = self.counts.get((w.feed, c), 0) + got[c]
        return self.counts

    def store(self, spark: SparkSession) -> int:
        """Writes the counted values to the sink, in the partition of this run, which is replaced (also by none); their number."""
        from daybook.operators.reload import partition_dirs, remove
        if not self.sink:
            return 0
        parts = [reject_rows(w.rows, w.feed, w.numbers, use) for w in self._watched
                 if (use := [c for c in w.fields if (w.feed, c) in self.counts])]
        if parts:
            rows = reduce(DataFrame.unionByName, parts).withColumn("EXTRACT_DATE_ID", F.lit(self.extract_id))
            (rows.hint("rebalance").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
             .partitionBy("EXTRACT_DATE_ID").parquet(self.sink))
        elif old := partition_dirs(spark, self.sink, "EXTRACT_DATE_ID").get(self.extract_id):
            remove(spark, old)
        return sum(self.counts.values())


def watcher(quarantine: Quarantine | None, feed: str, raw: DataFrame, numbers: list[str] = ()):
    """The ``watch`` argument of ``window_feed`` for a feed; None without a quarantine."""
    return None if quarantine is None else lambda window: quarantine.watch(feed, window, numbers, raw)
