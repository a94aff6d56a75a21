"""Exact dedup by content sort, in DataFrame operations only.

Texts are normalised by deleting ASCII white space.  ``repartitionByRange``
samples splitters over (first characters, hash of the whole, salt), which keeps the
samples that the driver sees small, and deals the rows into ranges; each range is
sorted by these and the whole text with Spark's spilling external sort, so that
equal texts are adjacent, and the grouping over the sorted run compares
neighbouring texts in full.  The salt cuts a large group of equal texts into as many runs as there are
shuffle partitions, so no task needs a whole group; the runs of one text, one
small row each, are then merged by content digest.

Defined cases: a null text counts as empty; empty texts form one group; of a
group the row with the longest original text (code points), then the smallest
id (a null id comes last) stays; rows repeated with their id are members of
their own and, when the longest, all of them count as the row that stays in
``content_groups``, while ``drop_copies`` keeps one of them; other columns are never read
but to order such rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from daybook.llm.common import GONE_ROWS, SPACE, broadcast_if_small, cut, shuffle_partitions, text_of, without_ids

#: Characters of a text in a splitter; texts that agree in them are told apart by hash.
SPLITTER_CHARS = 32


def normalised(text: Column) -> Column:
    return F.regexp_replace(text_of(text), SPACE + "+", "")


def content_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256."""
    spark = docs.sparkSession
    n = shuffle_partitions(spark)
    doc_id, text = F.col(f"`{id_col}`"), F.col(f"`{text_col}`")
    rows = docs.select(
        doc_id.alias("doc_id"),
        normalised(text).alias("norm"),
        F.length(text_of(text)).cast("long").alias("chars"),
        F.pmod(F.xxhash64(doc_id), F.lit(n)).cast("int").alias("salt"),
    )
    # max over (chars, -id) is the row that stays; a null id ranks last
    rank = F.struct(F.col("chars"), F.col("doc_id").isNotNull().alias("known"), (-F.col("doc_id")).alias("neg"))
    rows = rows.withColumn("head", F.substring("norm", 1, SPLITTER_CHARS)).withColumn("hash", F.xxhash64("norm"))
    run = Window.partitionBy("head", "hash", "salt", "norm")
    in_run = (
        rows.repartitionByRange(n, "head", "hash", "salt")
        .select(
            "doc_id",
            "salt",
            F.sha2(F.col("norm").cast("binary"), 256).alias("text_sha256"),
            F.count(F.lit(1)).over(run).alias("run_size"),
            F.max(rank).over(run).alias("run_best"),
        )
    )
    in_run = cut(in_run)
    runs = in_run.groupBy("text_sha256", "salt").agg(
        F.first("run_size").alias("run_size"), F.first("run_best").alias("run_best")
    )
    text_group = Window.partitionBy("text_sha256")  # at most one row per salt
    totals = runs.select(
        "text_sha256",
        "salt",
        F.sum("run_size").over(text_group).alias("group_size"),
        F.max("run_best").over(text_group).alias("best"),
    )
    return in_run.join(totals, ["text_sha256", "salt"]).select(
        "doc_id",
        (-F.col("best.neg")).alias("keep_id"),
        "group_size",
        F.col("doc_id").eqNullSafe(-F.col("best.neg")).alias("kept"),
        "text_sha256",
    )


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each group of equal texts, with all columns as given: the row that stays; where rows share
    its id (or have none) and its length, the first by original text and then by all columns."""
    doc_id, text = F.col(f"`{id_col}`"), F.col(f"`{text_col}`")
    groups = content_groups(docs, id_col, text_col)
    ids = cut(groups.groupBy("doc_id").agg(F.max("kept").alias("kept"), F.count(F.lit(1)).alias("rows")))
    alone = without_ids(docs, ids.where("NOT kept OR rows > 1").select("doc_id"), id_col)
    shared = cut(ids.where("kept AND rows > 1").select(F.col("doc_id").alias("__llm_shared")))
    if shared.isEmpty():
        return alone
    small = broadcast_if_small(shared, GONE_ROWS)
    # the texts whose row that stays is one of several with its id
    wins = groups.where("kept").join(small, F.col("doc_id").eqNullSafe(F.col("__llm_shared")), "left_semi")
    wins = cut(wins.select(F.col("text_sha256").alias("__llm_sha"), F.col("keep_id").alias("__llm_keep")).distinct())
    first = Window.partitionBy("__llm_sha").orderBy(
        F.length(text_of(text)).desc(), text.asc_nulls_last(), F.to_json(F.struct(*(F.col(f"`{c}`") for c in docs.columns))))
    several = docs.join(small, doc_id.eqNullSafe(F.col("__llm_shared")), "left_semi").withColumn(
        "__llm_digest", F.sha2(normalised(text).cast("binary"), 256))
    several = several.join(broadcast_if_small(wins), (F.col("__llm_digest") == F.col("__llm_sha")) & doc_id.eqNullSafe(F.col("__llm_keep")))
    several = several.withColumn("__llm_at", F.row_number().over(first)).where("__llm_at = 1")
    return alone.unionByName(several.select(*(F.col(f"`{c}`") for c in docs.columns)))
