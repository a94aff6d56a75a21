"""Similarity join of documents on their word shingles, by signature trees.

A document is its set of distinct word shingles, as 64-bit hashes; two documents link at
``100 * intersection >= percent * union``.  Its signature is a bitmap of the shingles, about two bits to each, with
their number.  A signature tree over a group of documents has nodes of ``FAN`` neighbours that hold the bitwise OR of
their signatures and the range of their sizes.  Two trees (or a tree and itself) are walked downwards together: no pair
below two nodes shares more than the bits common to both, plus the shingles that fell on bits already set; where
this is less than the least overlap that their smallest sizes ask for, or the sizes are too far apart, or all documents
below are linked already, the pair of nodes goes with all below it.

Groups: of a linked pair, the first ``n - ceil(percent n / 100) + 1`` shingles of each, in one order of all shingles, have one in
common.  So the join is exact within the groups of documents that share a shingle there.  The order puts
frequent shingles behind all others, so that common passages make no large groups; any order gives the same links.
Frequent are those that come again within a task's rows, and more than ``FREQUENT`` times in all such.

1. Documents of one and the same set are one node, however many copies there are.
2. Groups of the same members are one group.
3. Rounds: each node goes to the largest of its groups that is not linked through yet, once; the links found
   are reduced to components.  What is not linked through after ``ROUNDS`` rounds, or after one that closed fewer
   members of groups than it compared, is compared in all its groups, a pair in the first that it has in common.
4. A comparison walks trees of signatures first, folded to half their bits for the way there; only the documents that may have a partner in their group then
   send their full sets there, where the walk is repeated and its pairs are decided on the sets.  A task
   gives back a spanning forest of the links.  Groups over ``BLOCK`` documents are cut into blocks, and pairs of
   blocks go to tasks of their own.

Defined cases: null, empty and blank texts have no shingles and are linked with nothing; texts of
fewer words than a shingle have one, the whole sequence; documents that share an id are one document; a
null id belongs to no component (null); equal sets link whatever the text; other columns are ignored, clashing names
included.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial, reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from daybook.llm.common import broadcast_if_small, cut, narrow, shuffle_partitions
from daybook.llm.graph import components
from daybook.llm.minmax_dedup import WordHashes, shingle_set

FAN = 8
FREQUENT = 64
#: Times at most that frequent shingles are looked for, as prefixes change; those left only make larger groups.
REORDERS = 3
#: First shingles kept of each set, as a multiple of its prefix: what takes the place of frequent ones.
RESERVE = 1.6
#: Frequent shingles (8 bytes each) that go with the tasks at most; beyond that ``FREQUENT`` is doubled.
FREQUENT_ROWS = 1_000_000
ROUNDS = 2
BLOCK = 1024
BROADCAST_ROWS = 100_000
#: Of rows of two numbers.
NARROW_ROWS = 500_000
LEAST_BITS, MOST_BITS = 64, 2**17
CHUNK = 1 << 15
#: Shingles of a task's window in which repeated ones are counted.
WINDOW = 20_000_000


def bits_of(n: int) -> int:
    """Bits of the signature of ``n`` shingles."""
    return min(max(LEAST_BITS, 1 << (2 * n - 1).bit_length()), MOST_BITS)


def signature(shingles: np.ndarray) -> np.ndarray:
    bits = bits_of(len(shingles))
    marks = np.zeros(bits, np.bool_)
    marks[(shingles & np.uint64(bits - 1)).astype(np.int64)] = True
    return np.packbits(marks).view(np.uint64)


def folded(sig: np.ndarray, words: int) -> np.ndarray:
    """A signature in ``words`` 64-bit words, at most its own."""
    while len(sig) > words:
        sig = sig[: len(sig) // 2] | sig[len(sig) // 2 :]
    return sig


def sent(sig: np.ndarray) -> bytes:
    """A signature as it is sent to the groups."""
    return folded(sig, max(1, len(sig) // 2)).tobytes()


def least_overlap(sizes: np.ndarray, percent: int) -> np.ndarray:
    """Shingles that two linked sets of together ``sizes`` have in common at least."""
    return -(-percent * sizes // (100 + percent))


def prefix_length(n: int, percent: int) -> int:
    return n - -(-percent * n // 100) + 1


def prefix(first: np.ndarray, n: int, percent: int, frequent: np.ndarray) -> np.ndarray | None:
    """The prefix of a set of ``n`` shingles, from its ``first`` ones in order; those of ``frequent`` (sorted) come last.
    None if it takes more than these."""
    want = prefix_length(n, percent)
    if not len(frequent):
        return first[:want]
    late = frequent[np.minimum(np.searchsorted(frequent, first), len(frequent) - 1)] == first
    early = first[~late]
    if len(early) >= want:
        return early[:want]
    return np.concatenate((early, first[late]))[:want] if len(first) == n else None


class Tree:
    """Signature tree over documents in a given order.  ``label`` (documents of one label are linked already) may change
    during a walk; ``closed`` too: pairs of closed documents are not looked for."""

    def __init__(self, sigs: list[np.ndarray], sizes: np.ndarray, label: np.ndarray, side: np.ndarray, percent: int):
        words = min(len(s) for s in sigs)
        self.percent, self.label, self.side = percent, label, side
        self.closed = np.zeros(len(sigs), np.bool_)
        marks = np.stack([folded(s, words) for s in sigs])
        spare = sizes - np.bitwise_count(marks).sum(axis=1, dtype=np.int64)
        self.starts, self.levels = [np.arange(len(sigs))], [(marks, sizes, sizes, spare)]
        while len(self.starts[-1]) > FAN:
            at = np.arange(0, len(self.starts[-1]), FAN)
            marks, low, high, spare = self.levels[-1]
            self.levels.append((np.bitwise_or.reduceat(marks, at, axis=0), np.minimum.reduceat(low, at),
                                np.maximum.reduceat(high, at), np.maximum.reduceat(spare, at)))
            self.starts.append(self.starts[-1][at])

    def possible(self, level: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Which node pairs may have a link below them that is not known."""
        marks, low, high, spare = self.levels[level]
        at = self.starts[level]
        keep = (100 * high[i] >= self.percent * low[j]) & (100 * high[j] >= self.percent * low[i])
        first, last = np.minimum.reduceat(self.label, at), np.maximum.reduceat(self.label, at)
        keep &= (first[i] != last[j]) | (last[i] != first[j])
        first, last = np.minimum.reduceat(self.side, at), np.maximum.reduceat(self.side, at)
        keep &= (first[i] != last[j]) | (last[i] != first[j]) | (first[i] < 0)
        closed = np.logical_and.reduceat(self.closed, at)
        keep &= ~(closed[i] & closed[j])
        left = np.flatnonzero(keep)
        i, j = i[left], j[left]
        common = np.bitwise_count(marks[i] & marks[j]).sum(axis=1, dtype=np.int64) + np.minimum(spare[i], spare[j])
        keep[left] = common >= least_overlap(low[i] + low[j], self.percent)
        return keep

    def pairs(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Dual walk of the tree with itself: the pairs of documents that it can't rule out."""
        top = len(self.levels) - 1
        stack = [(top, *np.triu_indices(len(self.starts[top]), 0 if top else 1))]
        children = np.arange(FAN)
        while stack:
            level, i, j = stack.pop()
            if len(i) > CHUNK:
                stack.append((level, i[CHUNK:], j[CHUNK:]))
                i, j = i[:CHUNK], j[:CHUNK]
            keep = self.possible(level, i, j)
            i, j = i[keep], j[keep]
            if not len(i):
                continue
            if not level:
                yield i, j
                continue
            a, b = np.broadcast_arrays((i[:, None] * FAN + children)[:, :, None], (j[:, None] * FAN + children)[:, None, :])
            a, b = a.ravel(), b.ravel()
            n = len(self.starts[level - 1])
            there = (a < n) & (b < n) & ((a < b) if level == 1 else (a <= b))
            stack.append((level - 1, a[there], b[there]))


def trees(sizes: np.ndarray, sigs: list[np.ndarray], label: np.ndarray, side: np.ndarray, percent: int) -> Iterator[tuple[np.ndarray, Tree]]:
    """Trees, with the places of their documents, that together have every pair of documents near in size: one for each
    width of signature, and one for each two neighbouring widths."""
    width = np.array([len(s) for s in sigs])
    order = np.lexsort((sizes, label, side))
    widths = np.unique(width).tolist()
    for k, w in enumerate(widths):
        same = order[width[order] == w]
        if len(same) > 1:
            yield same, Tree([sigs[x] for x in same], sizes[same], label[same], side[same], percent)
        for wider in widths[k + 1 :]:
            large = order[width[order] == wider]
            large = large[percent * sizes[large] <= 100 * sizes[same].max()]
            small = same[100 * sizes[same] >= percent * sizes[large].min()] if len(large) else same[:0]
            if len(small):
                both = np.concatenate((small, large))
                # here the sides are the widths: pairs of one width are in the trees above
                yield both, Tree([sigs[x] for x in both], sizes[both], label[both], np.repeat([0, 1], [len(small), len(large)]), percent)


def may_link(sizes: np.ndarray, sigs: list[np.ndarray], label: np.ndarray, side: np.ndarray, percent: int,
             earlier: list[frozenset] | None = None) -> np.ndarray:
    """Which documents have a partner that their signatures allow (``side`` -1: any; else one of the other side).
    ``earlier``: by document the groups before this one; pairs that share one of them are left to it."""
    found = np.zeros(len(sizes), np.bool_)
    for at, tree in trees(sizes, sigs, label, side, percent):
        for i, j in tree.pairs():
            ok = (side[at[i]] < 0) | (side[at[i]] != side[at[j]])
            i, j = i[ok], j[ok]
            if earlier is None:
                tree.closed[i] = tree.closed[j] = True
                continue
            for x, y in zip(i.tolist(), j.tolist()):
                if not (tree.closed[x] and tree.closed[y]) and earlier[at[x]].isdisjoint(earlier[at[y]]):
                    tree.closed[x] = tree.closed[y] = True
        found[at[tree.closed]] = True
    return found


def similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    if len(a) > len(b):
        a, b = b, a
    both = int((b[np.minimum(np.searchsorted(b, a), len(b) - 1)] == a).sum())
    return 100 * both >= percent * (len(a) + len(b) - both)


def forest(sets: list[np.ndarray], label: np.ndarray, side: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """A spanning forest of the links between documents of different labels, decided on the sets."""
    sizes, sigs, label = np.array([len(s) for s in sets]), [signature(s) for s in sets], label.copy()
    out = []
    for at, tree in trees(sizes, sigs, label, side, percent):
        for i, j in tree.pairs():
            ok = (side[at[i]] < 0) | (side[at[i]] != side[at[j]])
            i, j = i[ok], j[ok]
            while len(i):
                open_pairs = tree.label[i] != tree.label[j]
                i, j = i[open_pairs], j[open_pairs]
                for k in range(len(i)):
                    a, b = int(at[i[k]]), int(at[j[k]])
                    if similar(sets[a], sets[b], percent):
                        out.append((a, b))
                        for known, x, y in ((label, a, b), (tree.label, i[k], j[k])):
                            known[known == known[y]] = known[x]
                        i, j = i[k + 1 :], j[k + 1 :]
                        break
                else:
                    break
    return out


_DESCRIBED = "doc_id long, n_shingles long, digest binary, first array<long>, sig binary"


def _describe(n: int, percent: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    words = WordHashes()
    for b in batches:
        cols = [[], [], [], []]
        for s in (shingle_set(x.as_py(), n, words) for x in b.column(1)):
            keep = int(RESERVE * prefix_length(len(s), percent)) + 1
            row = (len(s), xxhash.xxh3_128_digest(s.tobytes()), s[:keep].view(np.int64), sent(signature(s))) if len(s) else (0, None, None, None)
            for c, v in zip(cols, row):
                c.append(v)
        kinds = (pa.int64(), pa.binary(), pa.list_(pa.int64()), pa.binary())
        yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(c, k) for c, k in zip(cols, kinds))],
                                         names=["doc_id", "n_shingles", "digest", "first", "sig"])


def _prefixes(percent: int, frequent: np.ndarray, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (node, n_shingles, first): (node, size, prefix), the prefix null where the first shingles do not reach."""
    for b in batches:
        lists = b.column(2)
        flat, at = lists.flatten().to_numpy().view(np.uint64), lists.offsets.to_numpy() - lists.offsets[0].as_py()
        out = [prefix(flat[x:y], n, percent, frequent) for x, y, n in zip(at[:-1], at[1:], b.column(1).to_pylist())]
        out = pa.array([None if p is None else p.view(np.int64) for p in out], pa.list_(pa.int64()))
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), out], names=["node", "size", "prefix"])


def _repeated(percent: int, frequent: np.ndarray, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Shingles that come again in the prefixes of a window of rows: token, n."""
    held, size = [], 0

    def told():
        token, n = np.unique(np.concatenate(held), return_counts=True) if held else (np.zeros(0, np.int64), np.zeros(0, np.int64))
        again = n > 1
        return pa.RecordBatch.from_arrays([pa.array(token[again], pa.int64()), pa.array(n[again], pa.int64())], names=["token", "n"])

    for b in _prefixes(percent, frequent, batches):
        held.append(b.column(2).flatten().to_numpy())
        size += len(held[-1])
        if size > WINDOW:
            yield told()
            held, size = [], 0
    yield told()


def _whole_prefixes(n: int, percent: int, frequent: np.ndarray, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    words = WordHashes()
    for b in batches:
        sizes, out = [], []
        for s in (shingle_set(x.as_py(), n, words) for x in b.column(1)):
            sizes.append(len(s))
            out.append(prefix(s, len(s), percent, frequent).view(np.int64))
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(sizes, pa.int64()), pa.array(out, pa.list_(pa.int64()))], names=["node", "size", "prefix"])


def _sets(n: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    words = WordHashes()
    for b in batches:
        sets = pa.array([shingle_set(x.as_py(), n, words).tobytes() for x in b.column(1)], pa.binary())
        yield pa.RecordBatch.from_arrays([b.column(0), sets, b.column(2)], names=["node", "blob", "places"])


def _by_group(batches: Iterator[pa.RecordBatch], kind: type) -> Iterator[tuple]:
    """Rows (token, ti, tj, side, node, label, blob, ...) sorted by the first three, group by group: (key, rows)."""
    key, rows = None, []
    for b in batches:
        for row in zip(*(c.to_pylist() for c in b.columns)):
            if row[:3] != key:
                if len(rows) > 1:
                    yield key, rows
                key, rows = row[:3], []
            rows.append((*row[3:6], np.frombuffer(row[6], kind), *row[7:]))
    if len(rows) > 1:
        yield key, rows


def _arrays(rows: list[tuple]) -> tuple[np.ndarray, np.ndarray]:
    """Labels as small numbers, and sides."""
    return np.unique([r[2] for r in rows], return_inverse=True)[1], np.array([r[0] for r in rows])


def _coarse(percent: int, once: bool, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for (token, _, _), rows in _by_group(batches, np.uint64):
        label, side = _arrays(rows)
        earlier = [frozenset(r[5]) for r in rows] if once else None
        found = may_link(np.array([r[4] for r in rows]), [r[3] for r in rows], label, side, percent, earlier)
        if found.any():
            at = np.flatnonzero(found)
            yield pa.RecordBatch.from_arrays([pa.array([token] * len(at), pa.int64()), pa.array([rows[k][1] for k in at], pa.int64()),
                                              pa.array([rows[k][2] for k in at], pa.int64())], names=["token", "node", "label"])


def _exact(percent: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for _, rows in _by_group(batches, np.uint64):
        links = forest([r[3] for r in rows], *_arrays(rows), percent)
        if links:
            yield pa.RecordBatch.from_arrays([pa.array([rows[p[k]][1] for p in links], pa.int64()) for k in (0, 1)], names=["a", "b"])


def _in_blocks(members: DataFrame, *more: str) -> DataFrame:
    """Rows (token, node, label, n, ...) of groups of ``n`` members, dealt to pairs of blocks and sorted."""
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    block = F.pmod(F.xxhash64("node"), blocks).cast("int")
    dealt = members.select("*", block.alias("mine"), F.explode(F.sequence(F.lit(0), blocks - 1)).alias("other"))
    ti, tj = F.least("mine", "other").alias("ti"), F.greatest("mine", "other").alias("tj")
    side = F.when(F.col("mine") == F.col("other"), -1).otherwise((F.col("mine") > F.col("other")).cast("int")).alias("side")
    rows = dealt.select("token", ti, tj, side, "node", "label", *more)
    n = shuffle_partitions(members.sparkSession)
    return rows.repartition(n, "token", "ti", "tj").sortWithinPartitions("token", "ti", "tj", "side", "node")


def _compare(source: DataFrame, signed: DataFrame, members: DataFrame, words: int, percent: int, once: bool) -> DataFrame:
    """Links (a, b) found in the groups ``members`` (token, node, label, n); ``once``: a pair in the first group that it shares."""
    more = ["sig", "n_shingles"]
    if once:
        told = members.groupBy("node").agg(F.collect_list(F.struct("token", "label", "n")).alias("all"))
        members = signed.join(told, "node").select("*", F.explode("all").alias("p")).select(
            "p.*", "node", *more, F.expr("filter(all.token, t -> t < p.token)").alias("tokens"))  # only groups before this one matter
        more.append("tokens")
    else:
        members = members.join(signed, "node")
    rows = _in_blocks(members, *more)
    found = cut(rows.mapInArrow(partial(_coarse, percent, once), "token long, node long, label long").distinct())
    n = found.count()
    found = narrow(found, n)
    left = narrow(found.groupBy("token").agg(F.count(F.lit(1)).alias("n")), n)
    places = found.join(F.broadcast(left) if n <= NARROW_ROWS else left, "token").groupBy("node").agg(
        F.collect_list(F.struct("token", "label", "n")).alias("places"))
    places = narrow(places, n)
    texts = source.join(broadcast_if_small(cut(places), BROADCAST_ROWS), F.col("doc_id") == F.col("node"))
    sets = texts.select("node", "text", "places").mapInArrow(
        partial(_sets, words), "node long, blob binary, places array<struct<token:bigint,label:bigint,n:bigint>>")
    dealt = sets.select("node", "blob", F.explode("places").alias("p")).select("node", "blob", "p.*")
    return cut(_in_blocks(dealt, "blob").mapInArrow(partial(_exact, percent), "a long, b long"))


def _frequent(firsts: DataFrame, percent: int) -> np.ndarray:
    """Frequent shingles, sorted; bounded in number by a larger limit where need be."""
    known, limit = np.zeros(0, np.uint64), FREQUENT
    for _ in range(REORDERS):
        often = firsts.mapInArrow(partial(_repeated, percent, known), "token long, n long").groupBy("token").agg(F.sum("n").alias("n"))
        often = cut(often.where(F.col("n") > limit))
        while often.where(F.col("n") > limit).count() > FREQUENT_ROWS:
            limit *= 2
        now = np.array([r.token for r in often.where(F.col("n") > limit).select("token").collect()], np.int64).view(np.uint64)
        new = np.setdiff1d(now, known)
        if not len(new):
            break
        known = np.union1d(known, new)
    return known


def _keyed(source: DataFrame, firsts: DataFrame, words: int, percent: int) -> DataFrame:
    """(node, size, token) by prefix."""
    frequent = _frequent(firsts, percent)
    prefixes = firsts.mapInArrow(partial(_prefixes, percent, frequent), "node long, size long, prefix array<long>")
    short = cut(prefixes.where("prefix IS NULL").select("node").distinct())
    texts = source.join(broadcast_if_small(short, BROADCAST_ROWS), F.col("doc_id") == F.col("node"), "left_semi")
    anew = cut(texts.mapInArrow(partial(_whole_prefixes, words, percent, frequent), "node long, size long, prefix array<long>"))
    return prefixes.where("prefix IS NOT NULL").union(anew).select("node", "size", F.explode("prefix").alias("token"))


def _groups(keyed: DataFrame, percent: int) -> DataFrame:
    """Groups of different members: (token, node, n).  Members of groups of at most ``FREQUENT`` stay with a partner near in size only."""
    tokens = keyed.groupBy("token").agg(
        F.count(F.lit(1)).alias("n"), F.min("node").alias("low"), F.max("node").alias("high"), F.bit_xor("node").alias("all"),
        F.min("size").alias("small"), F.max("size").alias("large"))
    tokens = cut(tokens.where(f"low < high AND (n > 2 OR {int(percent)} * large <= 100 * small)"))
    # up to three members are told by these numbers, more by digests over the members
    few = tokens.where("n <= 3").groupBy("n", "low", "high", "all").agg(F.min("token").alias("token")).select("token", "n")
    members = cut(keyed.join(broadcast_if_small(cut(few.union(tokens.where("n > 3").select("token", "n"))), NARROW_ROWS), "token"))
    h = F.xxhash64("node")
    many = members.where("n > 3").groupBy("token", "n").agg(F.bit_xor(h).alias("x"), F.bit_xor(F.xxhash64(h, F.lit(1))).alias("y"), F.min("node").alias("low"))
    one = many.groupBy("n", "x", "y", "low").agg(F.min("token").alias("token")).select("token")
    kept = members.where("n > 3").join(broadcast_if_small(cut(one), NARROW_ROWS), "token", "left_semi").select(*members.columns)
    by_size = Window.partitionBy("token").orderBy("size", "node")
    near = (percent * F.col("size") <= 100 * F.lag("size").over(by_size)) | (percent * F.lead("size").over(by_size) <= 100 * F.col("size"))
    small = members.where("n = 3").union(kept.where(F.col("n") <= FREQUENT)).withColumn("near", near).where("near").drop("near")
    pairs = members.where("n = 2").union(kept.where(F.col("n") > FREQUENT))
    return cut(pairs.union(small.select(*pairs.columns)).select("token", "node", "n").distinct())


def _open_groups(members: DataFrame, found: DataFrame | None, few: bool) -> DataFrame:
    """The groups not linked through yet: (token, node, label, n).  ``few``: ``found`` may be broadcast."""
    if found is None:
        return members.select("token", "node", F.col("node").alias("label"), "n")
    labelled = members.join(F.broadcast(found) if few else found, "node", "left").select(
        "token", "node", F.coalesce("root", "node").alias("label"), "n")
    labelled = labelled if few else cut(labelled)
    still = labelled.groupBy("token").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low < high")
    return cut(labelled.join(broadcast_if_small(cut(still.select("token")), NARROW_ROWS), "token", "left_semi"))


def _largest(members: DataFrame) -> DataFrame:
    """Each node in the largest of its groups, with the numbers of members that are left."""
    best = members.groupBy("node").agg(F.max(F.struct("n", "token", "label")).alias("best"))
    best = best.select("best.token", "node", "best.label")
    sizes = best.groupBy("token").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return best.join(sizes, "token")


def join_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, words: int = 5, percent: int = 80) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id."""
    source = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("binary").alias("text"))
    base = source.mapInArrow(partial(_describe, words, percent), _DESCRIBED)
    base = cut(base.withColumn("place", F.monotonically_increasing_id()))
    # the row of the smallest id stands for all documents of a set
    chosen = cut(base.where("digest IS NOT NULL AND doc_id IS NOT NULL").groupBy("digest").agg(F.min(F.struct("doc_id", "place")).alias("x")))
    n_sets = chosen.count()
    chosen, few = narrow(chosen, n_sets), n_sets <= NARROW_ROWS
    places = chosen.select(F.col("x.place").alias("place"))
    nodes = base.join(F.broadcast(places) if few else places, "place", "left_semi").withColumnRenamed("doc_id", "node")
    nodes = nodes if few else cut(nodes)

    members = _groups(_keyed(source, nodes.select("node", "n_shingles", "first"), words, percent), percent)
    signed = cut(nodes.select("node", "n_shingles", "sig").join(members.select("node").distinct(), "node", "left_semi"))

    links, n_links, found, compared, was = [], 0, None, signed.count(), None
    for turn in range(ROUNDS + 1):
        still = _open_groups(members, found, 2 * n_links <= NARROW_ROWS)
        now = still.count()
        # a round compares each node once, the rest every member: another one must be worth it
        last = turn == ROUNDS or was is not None and was - now < compared
        was = now
        new = _compare(source, signed, still if last else _largest(still), words, percent, last)
        n_new = new.count()
        if not (n_new or last):
            new, last = _compare(source, signed, still, words, percent, True), True
            n_new = new.count()
        links.append(narrow(new, n_new))
        n_links += n_new
        found = cut(narrow(components(reduce(DataFrame.union, links), n_links), 2 * n_links))
        if last:
            break
    roots = chosen.select(F.col("digest").alias("d"), F.col("x.doc_id").alias("node")).join(found, "node", "left")
    roots = roots.select("d", F.coalesce("root", "node").alias("component_id"))
    same_set = F.when(F.col("doc_id").isNotNull(), F.col("digest")) == F.col("d")
    out = base.select("doc_id", "n_shingles", "digest").join(roots, same_set, "left")
    return out.select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))
