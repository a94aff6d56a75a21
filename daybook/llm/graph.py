"""Connected components of an edge table, by alternating stars.

Large star: every node's larger neighbours are tied to its smallest neighbour; small star: its
smaller neighbours are.  Repeated until nothing changes, every node is tied to the smallest of its
component.  Rounds grow with the logarithm of a component's width; a hub's edges are reduced to
minima before the shuffle and joined back, a join that adaptive execution splits where skewed.
No round has more edges than there were at first: where the caller knows that these are few, they stay in as
many tasks as they call for, and their minima are broadcast.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.llm.common import cut, narrow

#: Edges (16 bytes each, as their minima, which may be broadcast) that are few.
FEW = 500_000


def _star(edges: DataFrame, large: bool, rows: int | None = None) -> DataFrame:
    if large:
        near = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        near = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    low = near.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
    low = low if rows is None else F.broadcast(narrow(low, rows))
    out = near.join(low, "a")
    if large:
        out = out.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        out = out.select(F.col("b").alias("a"), F.col("m").alias("b")).union(low.select("a", F.col("m").alias("b")))
    out = out.where("a != b").distinct()
    return out if rows is None else narrow(out, rows)


def components(edges: DataFrame, rows: int | None = None) -> DataFrame:
    """``edges`` (a, b: long; ``rows`` of them at most) -> one row per node that has an edge to another: node, root (the
    smallest)."""
    rows = rows if rows is not None and rows <= FEW else None
    edges = edges.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    edges = cut(edges if rows is None else narrow(edges, rows))
    told = None
    while True:
        edges = cut(_star(_star(edges, True, rows), False, rows))
        now = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first()
        if now == told or not now[0]:
            break
        told = now
    nodes = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    roots = nodes.select(F.col("root").alias("node"), "root").distinct()
    return nodes.union(roots if rows is None else narrow(roots, rows))
