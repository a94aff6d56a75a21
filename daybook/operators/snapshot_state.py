"""Newest-extract sums kept up to date by the new extracts alone (D6a-c, A6).

Feeds are extracted anew each day, and a key's newest extract counts.  The whole feed says so by one aggregation over all
extracts ever made; the state (one row per key with its newest extract and that extract's sums) says the same and takes only
the extracts that came since: ``advance`` of state and new rows is the newest of both.

``keys`` decide which extract is newest; ``detail`` columns are kept apart below it (the month-grain snapshot: keys center,
month, account, detail the day).  A feed stored in partitions by extract is read from the last extract in the state on, as a
partition filter.

States are directories ``upto=<extract>``, written whole and valid from their ``_SUCCESS`` file on: a crash leaves the former
state valid, and the next run repeats the step.  An old extract that is delivered again is not seen; start a new state then.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.functions.exact import total_sql
from daybook.operators.reload import list_children, partition_dirs, remove
from daybook.operators.snapshot import latest_snapshot

VERSION = "EXTRACT_DATE_ID"


@dataclass(frozen=True)
class SnapshotState:
    keys: tuple[str, ...]
    sums: tuple[str, ...]
    detail: tuple[str, ...] = ()
    version: str = VERSION
    places: int | None = None  # decimals of order-free sums (``functions.exact``); None: plain sums

    @property
    def columns(self) -> list[str]:
        return [*self.keys, *self.detail, self.version, *self.sums]

    def advance(self, state: DataFrame | None, rows: DataFrame) -> DataFrame:
        """The state after ``rows``, whose extracts are newer than all in ``state`` (None: an empty one).  Rows without a
        key or extract are left out."""
        by = [*self.keys, *self.detail, self.version]
        fresh = rows.na.drop(subset=[*self.keys, self.version]).groupBy(*by).agg(
            *[F.expr(total_sql(f"`{c}`", self.places)).alias(c) for c in self.sums])
        fresh = fresh.select(*self.columns)
        both = fresh if state is None else state.select(*self.columns).unionByName(fresh)
        return self._newest(both)

    def _newest(self, rows: DataFrame) -> DataFrame:
        if self.detail:  # several rows of the newest extract
            return latest_snapshot(rows, list(self.keys), self.version)
        values = [F.max_by(c, self.version).alias(c) for c in self.sums]
        return rows.groupBy(*self.keys).agg(F.max(self.version).alias(self.version), *values).select(*self.columns)

    # -- stored ------------------------------------------------------------
    def stored(self, spark: SparkSession, path: str) -> dict[int, str]:
        """The valid states by their last extract."""
        done = lambda p: any(x.rstrip("/").endswith("/_SUCCESS") for x in list_children(spark, p))
        return {k: p for k, p in partition_dirs(spark, path, "upto").items() if done(p)}

    def read(self, spark: SparkSession, path: str) -> tuple[DataFrame | None, int]:
        """The last valid state and its last extract (None, 0: none yet)."""
        have = self.stored(spark, path)
        return (spark.read.parquet(have[max(have)]), max(have)) if have else (None, 0)

    def new_rows(self, feed: DataFrame, since: int, upto: int) -> DataFrame:
        return feed.where((F.col(self.version) > F.lit(since)) & (F.col(self.version) <= F.lit(upto)))

    def update(self, spark: SparkSession, path: str, feed: DataFrame, upto: int, keep: int = 2, prepare=None) -> dict:
        """Takes the extracts of ``feed`` up to ``upto`` into the state under ``path``; the ``keep`` last states stay.  ``prepare``
        makes the state's columns of the new rows."""
        state, since = self.read(spark, path)
        if upto <= since:
            return {"since": since, "upto": since, "advanced": False}
        rows = self.new_rows(feed, since, upto)
        new = self.advance(state, rows if prepare is None else prepare(rows))
        new.write.mode("overwrite").parquet(f"{path.rstrip('/')}/upto={int(upto)}")
        have = self.stored(spark, path)
        for k in sorted(have)[:-keep]:
            remove(spark, have[k])
        return {"since": since, "upto": int(upto), "advanced": True}


def in_steps(spec: SnapshotState, feed: DataFrame, upto: list[int], prepare=None) -> DataFrame:
    """The state after successive updates, without storing it in between."""
    bounds = [0, *upto]
    parts = [spec.new_rows(feed, a, b) for a, b in zip(bounds, bounds[1:])]
    return reduce(lambda state, rows: spec.advance(state, rows if prepare is None else prepare(rows)), parts, None)


def month_of(period: str = "PERIOD") -> Column:
    return F.expr(f"CAST({period} div 100 AS INT)")
