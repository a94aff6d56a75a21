"""Near-duplicate groups by min-max hashing.

A document is its set of distinct word shingles, as 64-bit hashes.  ``PERMUTATIONS`` multiplicative
hash functions are evaluated once each, and both the minimum and the maximum are kept, which gives
twice as many unbiased matches (each agrees for two sets with probability equal to their Jaccard
similarity) with less variance than as many minima.  The signature is cut into ``BANDS`` bands of
``ROWS`` values: a pair at similarity 0.85 shares none with probability 1e-6, at 0.8 2e-4.

1. Documents with one and the same set are one node (partial aggregation by a 128-bit digest of the
   sorted set), however many copies there are.
2. Nodes of a band value are tied to the smallest of them; the components of these ties are the
   candidate groups.  No pairs are listed.
3. Within a candidate group every pair is compared on the full sets, in blocks of at most ``BLOCK``
   nodes against each other: a block pair is one group of rows, and gives back only a spanning forest
   of the pairs that reach the threshold.  So links are exact, and no task holds more than two blocks.
4. Components of the links.

Defined cases: null, empty and blank texts have no shingles and are linked with nothing; texts of
fewer words than a shingle have one, the whole sequence; in ``near_groups`` documents that share an id are one
document, and a null id belongs to no group (``drop_near`` tells such rows apart by their texts); equal sets link
whatever the text; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from daybook.llm.common import broadcast_if_small, cut, release, shuffle_partitions, without_ids
from daybook.llm.graph import components

PERMUTATIONS = 126
ROWS = 7
BANDS = 2 * PERMUTATIONS // ROWS
BLOCK = 2048
#: Documents whose sets leave a Python worker at once.
SET_ROWS = 1000
CACHE_WORDS = 400_000
BROADCAST_ROWS = 500_000
_RNG = np.random.default_rng(20240611)
_A = _RNG.integers(1, 2**63, PERMUTATIONS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_MIX = _RNG.integers(1, 2**63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


class WordHashes(dict):
    """64-bit hash by word, kept for frequent use."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE_WORDS:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def shingle_set(text: bytes | None, n: int, words: WordHashes) -> np.ndarray:
    """Sorted distinct hashes of the ``n``-word shingles of a lower-cased (A-Z) text."""
    tokens = text.lower().split() if text else []
    if not tokens:
        return np.zeros(0, np.uint64)
    if len(tokens) < n:
        return np.array([xxhash.xxh3_64_intdigest(b" ".join(tokens), seed=n)], np.uint64)
    w = words.of(tokens)
    m = len(w) - n + 1
    h = np.zeros(m, np.uint64)
    for k in range(n):
        h += w[k : k + m] * _MIX[k]
    return np.unique(mix(h))


def bands(shingles: np.ndarray) -> np.ndarray:
    low, high = np.full(PERMUTATIONS, 2**64 - 1, np.uint64), np.zeros(PERMUTATIONS, np.uint64)
    for at in range(0, len(shingles), 2048):
        p = shingles[at : at + 2048, None] * _A
        np.minimum(low, p.min(axis=0), out=low)
        np.maximum(high, p.max(axis=0), out=high)
    sig = np.stack([low, high], axis=1).reshape(BANDS, ROWS)
    return mix((mix(sig) * _MIX[:ROWS]).sum(axis=1) + np.arange(1, BANDS + 1, dtype=np.uint64) * _MIX[ROWS]).view(np.int64)


def _signatures(n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = WordHashes()
        for b in batches:
            sizes, digests, keys = [], [], []
            for text in (x.as_py() for x in b.column(1)):  # one at a time: no second copy of the batch
                s = shingle_set(text, n, words)
                sizes.append(len(s))
                digests.append(xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None)
                keys.append(bands(s) if len(s) else None)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()), pa.array(keys, pa.list_(pa.int64()))],
                names=["doc_id", "n_shingles", "digest", "bands"],
            )
            release()

    return run


def _sets(n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = WordHashes()
        for b in batches:
            for at in range(0, b.num_rows, SET_ROWS):
                some = b.slice(at, SET_ROWS)
                sets = pa.array((shingle_set(x.as_py(), n, words).tobytes() for x in some.column(1)), pa.binary())
                yield pa.RecordBatch.from_arrays([*(some.column(i) for i in (0, 2, 3, 4)), sets],
                                                 names=["node", "grp", "blk", "blocks", "shingles"])
            release()

    return run


def forest(nodes: list[int], side: list[bool], sets: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """A spanning forest of the links among ``sets``; with both sides present, of those across them."""
    root = list(range(len(nodes)))

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    sizes = np.array([len(s) for s in sets])
    _, ids = np.unique(np.concatenate(sets), return_inverse=True)
    begins = np.concatenate(([0], np.cumsum(sizes)))
    marked = np.zeros(ids.max() + 1, np.int32)
    side = np.array(side)
    across = side.any() and not side.all()
    out = []
    for i in range(len(nodes) - 1):
        if across and side[i]:
            continue
        mine = ids[begins[i] : begins[i + 1]]
        marked[mine] = 1
        first = int(np.argmax(side)) if across else i + 1
        both = np.add.reduceat(marked[ids[begins[first] :]], begins[first:-1] - begins[first])
        marked[mine] = 0
        linked = np.flatnonzero(100 * both >= percent * (sizes[i] + sizes[first:] - both)) + first
        for j in linked.tolist():
            a, b = find(i), find(j)
            if a != b:
                root[max(a, b)] = min(a, b)
                if nodes[i] != nodes[j]:
                    out.append((nodes[i], nodes[j]))
    return out


def _links(percent: int):
    """Rows sorted by (grp, ti, tj, side): block pairs one after the other."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, nodes, side, sets = None, [], [], []

        def flush():
            if len(nodes) > 1:
                pairs = forest(nodes, side, sets, percent)
                if pairs:
                    yield pa.RecordBatch.from_arrays([pa.array([p[k] for p in pairs], pa.int64()) for k in (0, 1)], names=["a", "b"])

        for b in batches:
            for k, node, s, blob in zip(zip(*(b.column(i).to_pylist() for i in range(3))), b.column(3).to_pylist(), b.column(4).to_pylist(),
                                        (x.as_py() for x in b.column(5))):  # one set at a time: no second copy of the batch
                if k != key:
                    yield from flush()
                    key, nodes, side, sets = k, [], [], []
                nodes.append(node)
                side.append(s)
                sets.append(np.frombuffer(blob, np.uint64))
            release()
        yield from flush()

    return run


def near_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, words: int = 5, percent: int = 80) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept."""
    spark = docs.sparkSession
    source = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("binary").alias("text"))
    base = cut(source.mapInArrow(_signatures(words), "doc_id long, n_shingles long, digest binary, bands array<long>"))
    # the row of the smallest id stands for all documents of a set
    nodes = base.where("digest IS NOT NULL AND doc_id IS NOT NULL").groupBy("digest").agg(
        F.min(F.struct("doc_id", "bands")).alias("first"))
    nodes = cut(nodes.select("digest", F.col("first.doc_id").alias("node"), F.col("first.bands").alias("bands")))
    keyed = nodes.select("node", F.explode("bands").alias("key"))
    smallest = keyed.groupBy("key").agg(F.min("node").alias("b"), F.max("node").alias("most")).where("b < most").drop("most")
    ties = keyed.join(smallest, "key").select(F.col("node").alias("a"), "b")
    groups = cut(components(ties))
    sizes = groups.groupBy("root").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"))
    # most groups are one block; only the numbers of larger ones are joined back
    large = sizes.where("blocks > 1")
    member = groups.join(large, "root", "left").select(
        "node", F.col("root").alias("grp"), F.coalesce("blocks", F.lit(1)).alias("blocks"))
    member = cut(member.withColumn("blk", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")))
    texts = source.join(broadcast_if_small(member, BROADCAST_ROWS), F.col("doc_id") == F.col("node"))
    sets = texts.select("node", "text", "grp", "blk", "blocks").mapInArrow(
        _sets(words), "node long, grp long, blk int, blocks int, shingles binary")
    other = F.sequence(F.lit(0), F.col("blocks") - 1)
    dealt = sets.withColumn("other", F.explode(other)).select(
        "grp", F.least("blk", "other").alias("ti"), F.greatest("blk", "other").alias("tj"), "node",
        (F.col("blk") > F.col("other")).alias("side"), "shingles")
    links = (
        dealt.repartition(shuffle_partitions(spark), "grp", "ti", "tj")
        .sortWithinPartitions("grp", "ti", "tj", "side", "node")
        .mapInArrow(_links(percent), "a long, b long")
    )
    found = components(links)
    roots = cut(nodes.select("digest", "node").join(found, "node", "left").select(
        F.col("digest").alias("d"), F.coalesce("root", "node").alias("component_id")))
    same_set = F.when(F.col("doc_id").isNotNull(), F.col("digest")) == F.col("d")
    component = F.coalesce("component_id", "doc_id")
    return base.drop("bands").join(roots, same_set, "left").select(
        "doc_id", "n_shingles", component.alias("component_id"), component.eqNullSafe(F.col("doc_id")).alias("kept"))


def drop_near(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One document of each near-duplicate group, with all columns as given.

    Rows that share an id, or have none, are told apart by a 62-bit hash of id and text in place of the id, behind
    all usual ids; of rows equal in both, the first by all columns stays."""
    doc_id = F.col(f"`{id_col}`").cast("long")
    ids = docs.groupBy(doc_id.alias("__llm_shared")).count()
    shared = cut(ids.where("count > 1 OR __llm_shared IS NULL").select("__llm_shared"))
    if shared.isEmpty():
        gone = near_groups(docs, id_col, text_col, **options).where("NOT kept").select("doc_id").distinct()
        return without_ids(docs, gone, id_col)
    marked = docs.join(broadcast_if_small(shared.withColumn("__llm_several", F.lit(True)), BROADCAST_ROWS),
                       doc_id.eqNullSafe(F.col("__llm_shared")), "left")
    own = F.lit(2**62) + F.pmod(F.xxhash64(doc_id, F.col(f"`{text_col}`")), F.lit(2**62))
    marked = marked.withColumn("__llm_key", F.when(F.col("__llm_several"), own).otherwise(doc_id))
    gone = near_groups(marked, "__llm_key", text_col, **options).where("NOT kept").select("doc_id").distinct()
    left = without_ids(marked, gone, "__llm_key")
    columns = [F.col(f"`{c}`") for c in docs.columns]
    first = Window.partitionBy("__llm_key").orderBy(F.to_json(F.struct(*columns)))
    several = left.where("__llm_several").withColumn("__llm_at", F.row_number().over(first)).where("__llm_at = 1")
    return left.where("__llm_several IS NULL").select(*columns).unionByName(several.select(*columns))
