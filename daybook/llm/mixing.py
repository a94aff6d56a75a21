"""Mixing sources to target weights by Sainte-Lague apportionment.

1. Targets: sources in code-point order (null last) weigh 3, 1, 2, repeating, and
   share 150 % of all words.  A target stops at twice its source's size; the excess
   is reshared by weight until none is above.  That limit is the water level at
   which capped sources sit at their cap: one cumulative sum over the sources in
   order of cap per weight.
2. Quotas: the mix is cut into blocks of ``QUOTA_WORDS`` words, one by default, so that the smallest source gets its
   share.  Blocks go to the sources, then each source's blocks to its shards, by highest quotients
   votes / (2 k + 1).  Only the seats that a bound on the divisor leaves open are
   ranked (at most about three per party), never all of them.
3. Selection: a shard is a seeded hash class of a source's documents of about
   ``SHARD_WORDS`` words.  In seeded document order the shard's words form a line, cut into
   stretches of ``BLOCK_WORDS`` words; a quota beyond the line's length takes whole passes, and the rest is a run of
   consecutive words from the start of a seeded stretch, wrapping round.

So every document takes at most 2 x its words, large sources are dealt over many
shards, and only one small row per source and per shard is ever gathered.

Defined cases: a null text has size 0; documents without words take 0; a source of
size 0 has target 0; null is a source of its own, the last; a null id hashes as a
constant; equal ids are ordered by size; rows repeated count as rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from daybook.llm.common import SPACE, SPACE_CHARS, WORD, broadcast_if_small, cut, text_of, words_of

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MAX_PASSES = 2
QUOTA_WORDS = 1
BLOCK_WORDS = 64
SHARD_WORDS = 200_000
SEED = 20240229
#: Decisions (id, size, passes, spans; about 100 bytes each) that may be broadcast to the texts.
BROADCAST_ROWS = 200_000


def source_targets(sized: DataFrame, weights=WEIGHTS, share: float = SHARE, cap: int = MAX_PASSES) -> DataFrame:
    """One row per source: source, source_size, weight, target (double)."""
    sources = sized.groupBy("source").agg(F.sum("size").cast("long").alias("source_size"))
    order = Window.orderBy(F.col("source").cast("binary").asc_nulls_last())
    k = F.row_number().over(order) - 1
    weight = F.element_at(F.array(*(F.lit(float(w)) for w in weights)), (k % len(weights) + 1).cast("int"))
    s = sources.select("source", "source_size", k.alias("rank"), weight.alias("weight"))
    s = s.withColumn("limit", F.col("source_size").cast("double") * cap)
    by_level = Window.orderBy(F.col("limit") / F.col("weight"), "rank")
    whole = Window.partitionBy()
    s = s.select(
        "*",
        F.coalesce(F.sum("limit").over(by_level.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)).alias("below"),
        F.sum("weight").over(by_level.rowsBetween(0, Window.unboundedFollowing)).alias("open"),
        (F.sum("source_size").over(whole) * share).alias("total"),
    )
    # the level if this source and all after it are uncapped; the first source that
    # such a level does not cap, and all after it, get it
    s = s.withColumn("level", F.greatest((F.col("total") - F.col("below")) / F.col("open"), F.lit(0.0)))
    s = s.withColumn("free", F.col("level") * F.col("weight") <= F.col("limit"))
    level = F.min(F.when(F.col("free"), F.struct("rank_by_level", "level"))).over(whole)
    s = s.withColumn("rank_by_level", F.row_number().over(by_level))
    s = s.withColumn("at", level)
    return s.select(
        "source",
        "source_size",
        "rank",
        "weight",
        F.when(F.col("at").isNotNull() & (F.col("rank_by_level") >= F.col("at.rank_by_level")),
               F.col("at.level") * F.col("weight")).otherwise(F.col("limit")).alias("target"),
    )


def highest_quotients(parties: DataFrame, group: list[str], votes: str, seats: str, order: list[str]) -> DataFrame:
    """``parties`` with column ``quota``: within each ``group``, ``seats`` (equal on all rows of
    the group) dealt by the largest votes / (2 k + 1).

    Rounding votes * x / V to the nearest integer moves a total of x seats by at most
    n / 2, so x = seats - n/2 bounds each quota from below and seats + n/2 from above.
    """
    g = Window.partitionBy(*group)
    p = parties.select(
        "*",
        F.sum(votes).over(g).cast("double").alias("__v"),
        F.count(F.lit(1)).over(g).alias("__n"),
    )
    at = lambda x: F.floor(F.col(votes) * x / F.col("__v") + 0.5)
    has = F.col(votes) > 0
    p = p.withColumn("__low", F.when(has, at(F.greatest(F.lit(0.0), F.col(seats) - F.col("__n") / 2))).otherwise(F.lit(0)))
    p = p.withColumn("__high", F.when(has, at(F.col(seats) + F.col("__n") / 2) + 1).otherwise(F.lit(0)))
    p = p.withColumn("__left", F.col(seats) - F.sum("__low").over(g))
    cand = p.where("__high > __low").withColumn("__k", F.explode(F.sequence(F.col("__low"), F.col("__high") - 1)))
    best = Window.partitionBy(*group).orderBy((F.col(votes) / (2 * F.col("__k") + 1)).desc(), *order, "__k")
    won = cand.withColumn("__r", F.row_number().over(best)).where(F.col("__r") <= F.col("__left"))
    keys = list(dict.fromkeys(group + order))
    won = won.groupBy(*(F.col(c).alias(f"__w_{c}") for c in keys)).agg(F.count(F.lit(1)).alias("__won"))
    same = [F.col(c).eqNullSafe(F.col(f"__w_{c}")) for c in keys]
    return p.join(won, same, "left").select(
        *parties.columns, (F.col("__low") + F.coalesce(F.col("__won"), F.lit(0))).cast("long").alias("quota")
    )


def within(start: Column, size: Column, a: Column, b: Column) -> Column:
    """The part of [a, b) in [start, start + size), from the latter's start."""
    return F.struct(F.greatest(F.lit(0), a - start).cast("long").alias("from"), F.least(size, b - start).cast("long").alias("to"))


def mix_sources(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    *,
    block: int = QUOTA_WORDS,
    stretch: int = BLOCK_WORDS,
    shard_words: int = SHARD_WORDS,
    seed: int = SEED,
) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, taken, and how it is taken:
    ``passes`` times whole, then the word ranges ``spans`` (from, to)."""
    col = lambda c: F.col(f"`{c}`")
    sized = cut(docs.select(
        col(id_col).alias("doc_id"),
        col(source_col).cast("string").alias("source"),
        F.size(words_of(text_of(col(text_col)))).cast("long").alias("size"),
    ))
    targets = source_targets(sized)
    blocks = F.floor(F.sum("target").over(Window.partitionBy()) / block + 0.5)
    targets = targets.withColumn("blocks", blocks).withColumn("all", F.lit(0))
    targets = cut(highest_quotients(targets, ["all"], "target", "blocks", ["rank"]).select(
        F.col("source").alias("t_source"), "rank", "source_size", "target", F.col("quota").alias("source_quota"),
        F.greatest(F.lit(1), F.ceil(F.col("source_size") / shard_words)).alias("shards"),
    ))
    dealt = sized.join(broadcast_if_small(targets), F.col("source").eqNullSafe(F.col("t_source")))
    dealt = dealt.withColumn("draw", F.xxhash64(F.lit(seed), F.col("doc_id")))
    dealt = dealt.withColumn("shard", F.pmod(F.xxhash64(F.col("draw"), F.lit("shard")), F.col("shards")))
    cells = dealt.groupBy("rank", "shard").agg(
        F.sum("size").alias("cell_size"), F.first("source_quota").alias("source_quota")
    )
    cells = highest_quotients(cells, ["rank"], "cell_size", "source_quota", ["shard"])
    cells = cells.select("rank", "shard", "cell_size", "quota")
    line = Window.partitionBy("rank", "shard").orderBy("draw", "doc_id", "size")
    rows = dealt.withColumn("end", F.sum("size").over(line.rowsBetween(Window.unboundedPreceding, 0)))
    rows = rows.join(cells, ["rank", "shard"])
    want = F.least(F.col("quota") * block, F.col("cell_size") * MAX_PASSES)
    stretches = F.greatest(F.lit(1), F.floor(F.col("cell_size") / stretch))
    first = F.pmod(F.xxhash64(F.lit(seed), F.col("source"), F.col("shard")), stretches) * stretch
    rows = rows.select(
        "*",
        (F.col("end") - F.col("size")).alias("start"),
        F.when(F.col("cell_size") > 0, F.floor(want / F.col("cell_size"))).otherwise(0).alias("passes"),
        want.alias("want"),
        first.alias("first"),
    )
    rest = F.col("want") - F.col("passes") * F.col("cell_size")
    stop = F.col("first") + rest
    ranges = F.array(
        within(F.col("start"), F.col("size"), F.col("first"), stop),
        within(F.col("start") + F.col("cell_size"), F.col("size"), F.col("first"), stop),
    )
    rows = rows.withColumn("spans", F.filter(ranges, lambda x: x["from"] < x["to"]))
    part = F.aggregate("spans", F.lit(0).cast("long"), lambda a, x: a + x["to"] - x["from"])
    taken = F.col("passes") * F.col("size") + part
    return rows.select("doc_id", "source", "size", "source_size", "target", taken.cast("long").alias("taken"), "passes", "spans")


def take(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **options) -> DataFrame:
    """The mix itself: each document's row once per pass, and once per range with its text cut to
    those words, white space between them as it is.  Columns as given.  Rows that share id and size are taken alike,
    as the most taken of them."""
    how = mix_sources(docs, id_col, text_col, source_col, **options)
    how = how.where("taken > 0").groupBy(F.col("doc_id").alias("__m_id"), F.col("size").alias("__m_size")).agg(
        F.max_by(F.struct("passes", "spans"), "taken").alias("__m_how"))
    how = broadcast_if_small(cut(how), BROADCAST_ROWS)
    text = F.col(f"`{text_col}`")
    words = words_of(text_of(text))
    rows = docs.join(how, F.col(f"`{id_col}`").eqNullSafe(F.col("__m_id")) & (F.size(words) == F.col("__m_size")))
    whole = F.array_repeat(F.struct(F.lit(-1).cast("long").alias("from"), F.lit(-1).cast("long").alias("to")), F.col("__m_how.passes").cast("int"))
    rows = rows.withColumn("__m_part", F.explode(F.concat(whole, F.col("__m_how.spans"))))
    part = F.col("__m_part")
    # each word with the white space before it; that of the first goes
    pieces = F.regexp_extract_all(text_of(text), F.lit(f"{SPACE}*{WORD}"), F.lit(0))
    run = F.array_join(F.slice(pieces, (part["from"] + 1).cast("int"), (part["to"] - part["from"]).cast("int")), "")
    cut_text = F.ltrim(run, F.lit(SPACE_CHARS))
    new = F.when((part["from"] < 0) | ((part["from"] == 0) & (part["to"] == F.col("__m_size"))), text).otherwise(cut_text)
    return rows.withColumn(text_col, new).select(*(F.col(f"`{c}`") for c in docs.columns))
