"""Helpers shared by the training-data operators."""

from __future__ import annotations

import ctypes
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.session import ensure_checkpoint_dir

#: ASCII white space, as used by every word definition here.
SPACE_CHARS = " \t\n\x0b\x0c\r"
SPACE = r"[\x20\x09-\x0D]"
#: Ids (8 bytes each) that may be broadcast.
GONE_ROWS = 500_000
WORD = r"[^\x20\x09-\x0D]+"
#: Rows of a few numbers that make a task.
TASK_ROWS = 50_000


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def cut(df: DataFrame) -> DataFrame:
    """``df`` materialised in the shared checkpoint folder: computed once, lineage cut,
    and readable by every executor after others are lost."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def release() -> None:
    """Gives what this process has freed back to the system.  A Python worker outlives its tasks and stages beside
    the executor's heap, and Arrow and the C library would keep the room of the largest batch that it has seen."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of glibc; others give back by themselves
    if trim:
        trim(0)


def fold(doc_id: Column, n: int) -> Column:
    """crc32 of the id's decimal text modulo ``n`` (a null id counts as empty text)."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % n


def text_of(col: Column) -> Column:
    return F.coalesce(col.cast("string"), F.lit(""))


def words_of(text: Column) -> Column:
    """Array of the words of a non-null text; empty for a text without words."""
    t = F.trim(text, F.lit(SPACE_CHARS))
    return F.when(t == "", F.array().cast("array<string>")).otherwise(F.split(t, SPACE + "+"))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` applied to ``value``, evaluated once even where ``body`` names it inside
    nested lambdas (a lambda variable is bound, never re-expanded)."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def broadcast_if_small(df: DataFrame, rows: int = 20_000) -> DataFrame:
    """``df`` (materialised, narrow rows) with a broadcast hint when it has at most ``rows`` rows;
    beyond that it is joined by shuffle."""
    return F.broadcast(df) if df.count() <= rows else df


def narrow(df: DataFrame, rows: int) -> DataFrame:
    """``df``, at most ``rows`` rows of a few numbers, in as many tasks as these rows call for, and one for each core at
    least: the session's shuffle partitions would leave them in as many tiny tasks, stage after stage."""
    return df.coalesce(max(df.sparkSession.sparkContext.defaultParallelism, -(-rows // TASK_ROWS)))


def without_ids(docs: DataFrame, gone: DataFrame, id_col: str) -> DataFrame:
    """``docs`` without the rows of the ids ``gone`` (one column, distinct).  At most ``GONE_ROWS`` ids are
    broadcast, which spares a shuffle of the texts; more are joined by shuffle."""
    ids = cut(gone.select(F.col(gone.columns[0]).alias("__llm_gone")))
    return docs.join(broadcast_if_small(ids, GONE_ROWS), F.col(f"`{id_col}`").eqNullSafe(F.col("__llm_gone")), "left_anti")
