"""Documents drawn by importance towards a target text collection.

Features are runs of 1 to ``ngrams`` words, hashed into ``BUCKETS`` buckets.  A bucket's gain is the log ratio
of its share in the target texts to its share in the documents; a document's weight is the mean gain of its
features, and seeded Gumbel noise on the weights makes the highest scores a draw without replacement.

1. Counts: each task adds its features up in an array of buckets and sends the buckets that it met, so a
   round of sums over at most ``BUCKETS`` rows a task is all that is shuffled.
2. Weights: the gains, one array of ``BUCKETS`` numbers, go with the task; a document's weight is one look-up per
   feature.  Scores are written to the checkpoint folder, one narrow row a document.
3. Selection by quickselect: of the rows that may still be the last one drawn, up to ``PIVOTS`` random ones are
   pivot keys.  Exact counts of the rows before, at and after every pivot tell between which two (or at which)
   the k-th key lies.  Each round leaves about a ``PIVOTS``-th of the rows, and the last finds the key itself.
4. The drawn rows alone are sorted, by ranges, and ranked: position in the range plus the sizes of those before.

Keys are (score down, doc_id up, null last, n_features up, place), where place numbers the rows of the score table, so
all keys differ, however many rows share an id.

Defined cases: null and empty texts have no features and weight 0; a null id is drawn with the noise of the text
``<seed>:``; rows that share an id are rows of their own with one and the same noise, which repeated rows
tie in; only documents of ``min_words`` words or more are drawn; with no target text, or no document, the formula holds
with zero counts; other columns are ignored, clashing names included.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybook.llm.common import cut, shuffle_partitions

BUCKETS = 10_000
MIN_WORDS = 20
PERCENT = 10
SEED = 2024
PIVOTS = 15
CACHE_WORDS = 400_000
#: Lower-cases A-Z; every other ASCII character than a digit or a letter becomes a blank.
_WORD_BYTES = bytes(b if chr(b).isalnum() or b > 127 else 32 for b in bytes(range(256)).lower())
_NEG_LOG_RANGE = float(2**32)


class Buckets(dict):
    """Bucket by word, kept for frequent use."""

    def __init__(self, buckets: int):
        self.buckets = buckets

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE_WORDS:
            self.clear()
        b = self[word] = zlib.crc32(word) % self.buckets
        return b


def feature_buckets(text: bytes | None, known: Buckets, ngrams: int) -> tuple[np.ndarray, int]:
    """The buckets of a text's features, and its number of words."""
    words = text.translate(_WORD_BYTES).split() if text else []
    runs = [np.fromiter(map(known.__getitem__, words), np.int64, len(words))]
    for n in range(2, ngrams + 1):
        grams = [b" ".join(words[i : i + n]) for i in range(len(words) - n + 1)]
        runs.append(np.fromiter((zlib.crc32(g) % known.buckets for g in grams), np.int64, len(grams)))
    return np.concatenate(runs), len(words)


def _count(ngrams: int, buckets: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    known, total = Buckets(buckets), np.zeros(buckets, np.int64)
    for b in batches:
        for text in (x.as_py() for x in b.column(0)):
            total += np.bincount(feature_buckets(text, known, ngrams)[0], minlength=buckets)
    met = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(met, pa.int32()), pa.array(total[met], pa.int64())], names=["bucket", "n"])


def bucket_counts(texts: DataFrame, ngrams: int, buckets: int) -> np.ndarray:
    """Features of the one column of ``texts`` by bucket: at most ``buckets`` rows come to the driver."""
    met = texts.mapInArrow(partial(_count, ngrams, buckets), "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(buckets, np.int64)
    for r in met.collect():
        out[r.bucket] = r.n
    return out


def gains(in_documents: np.ndarray, in_target: np.ndarray) -> np.ndarray:
    """floor(1000 * ln of the smoothed ratio of shares), by bucket."""
    n = len(in_documents)
    all_docs, all_target = float(in_documents.sum() + n), float(in_target.sum() + n)
    return np.array([math.floor(1000 * math.log((t + 1.0) * all_docs / ((s + 1.0) * all_target)))
                     for s, t in zip(in_documents.tolist(), in_target.tolist())], np.int64)


def noise(hashed: int) -> int:
    """Seeded standard Gumbel noise in thousandths, from 32 bits."""
    return math.floor(-1000 * math.log(-math.log((hashed + 0.5) / _NEG_LOG_RANGE)))


def _score(gain: np.ndarray, ngrams: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    known = Buckets(len(gain))
    for b in batches:
        n_words, n_features, weights, scores = [], [], [], []
        for text, h in zip((x.as_py() for x in b.column(1)), b.column(2).to_pylist()):
            at, words = feature_buckets(text, known, ngrams)
            w = int(gain[at].sum()) // len(at) if len(at) else 0
            n_words.append(words)
            n_features.append(len(at))
            weights.append(w)
            scores.append(w + noise(h))
        yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(x, pa.int64()) for x in (n_words, n_features, weights, scores))],
                                         names=["doc_id", "n_words", "n_features", "weight", "score"])


def key_of() -> Column:
    """The composite key, in ascending order of the draw."""
    return F.struct((-F.col("score")).alias("down"), F.col("doc_id").isNull().alias("no_id"),
                    F.coalesce("doc_id", F.lit(0)).alias("id"), F.col("n_features").alias("n"), F.col("place").alias("place"))


_KEY = ("down", "no_id", "id", "n", "place")
_KEY_TYPES = ("bigint", "boolean", "bigint", "bigint", "bigint")


def _literal(key: tuple) -> Column:
    return F.struct(*(F.lit(v).cast(t).alias(c) for c, v, t in zip(_KEY, key, _KEY_TYPES)))


def kth_key(keys: DataFrame, k: int, seed: int = SEED, pivots: int = PIVOTS) -> tuple:
    """The k-th smallest (from 1) of the differing structs ``key`` in ``keys``; k is at most their number.

    A round reads the rows between the two bounds, counts them at and between its pivots, and narrows the bounds;
    it ends at the latest when all rows between them are pivots."""
    low = high = None
    turn = 0
    while True:
        open_rows = keys
        if low is not None:
            open_rows = open_rows.where(F.col("key") > _literal(low))
        if high is not None:
            open_rows = open_rows.where(F.col("key") < _literal(high))
        draw = F.xxhash64(F.lit(seed), F.lit(turn), "key.id", "key.place")
        at = sorted(tuple(r.key) for r in open_rows.orderBy(draw, "key").limit(pivots).collect())
        # part 2 i: before pivot i (and after the one before it); 2 i + 1: at pivot i
        part = F.lit(2 * len(at))
        for i in reversed(range(len(at))):
            part = F.when(F.col("key") < _literal(at[i]), 2 * i).when(F.col("key") == _literal(at[i]), 2 * i + 1).otherwise(part)
        counts = dict(open_rows.groupBy(part.alias("part")).count().collect())
        for i in range(2 * len(at) + 1):
            n = counts.get(i, 0)
            if k <= n:
                if i % 2:
                    return at[i // 2]
                low, high = (at[i // 2 - 1] if i else low), (at[i // 2] if i < 2 * len(at) else high)
                break
            k -= n
        else:
            raise ValueError("k is larger than the number of keys")
        turn += 1


def ranked(rows: DataFrame) -> DataFrame:
    """``rows`` with ``rank`` (1, 2, 3, ...) in order of ``key``: ranges sorted side by side, and one small row a range."""
    n = shuffle_partitions(rows.sparkSession)
    ranges = rows.repartitionByRange(n, "key").sortWithinPartitions("key")
    # the high bits of this number are the range, the low 33 bits the position in it
    placed = cut(ranges.withColumn("at", F.monotonically_increasing_id()))
    of_range = F.shiftright("at", 33)
    sizes = placed.groupBy(of_range.alias("part")).count().collect()
    before, start = 0, {}
    for part, size in sorted(sizes):
        start[part], before = before, before + size
    starts = rows.sparkSession.createDataFrame(sorted(start.items()), "part long, start long")
    position = F.col("at").bitwiseAND(F.lit(2**33 - 1))
    return placed.join(F.broadcast(starts), of_range == F.col("part")).withColumn("rank", F.col("start") + position + 1).drop("at", "part", "start")


def resample(
    docs: DataFrame,
    target: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    target_col: str = "text",
    *,
    ngrams: int = 1,
    buckets: int = BUCKETS,
    min_words: int = MIN_WORDS,
    percent: int = PERCENT,
    seed: int = SEED,
) -> DataFrame:
    """One row per document: doc_id, n_words, n_features, weight, score, rank (null: not drawn)."""
    doc_id = F.col(f"`{id_col}`").cast("long")
    text = F.col(f"`{text_col}`").cast("binary")
    gain = gains(bucket_counts(docs.select(text.alias("text")), ngrams, buckets),
                 bucket_counts(target.select(F.col(f"`{target_col}`").cast("binary").alias("text")), ngrams, buckets))
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"), 256)
    hashed = F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")
    scored = docs.select(doc_id.alias("doc_id"), text.alias("text"), hashed.alias("h")).mapInArrow(
        partial(_score, gain, ngrams), "doc_id long, n_words long, n_features long, weight long, score long")
    scored = cut(scored.withColumn("place", F.monotonically_increasing_id()))
    may = scored.where(F.col("n_words") >= min_words)
    k = may.count() * percent // 100
    plain = scored.columns[:-1]
    if not k:
        return scored.select(*plain, F.lit(None).cast("long").alias("rank"))
    keyed = scored.withColumn("key", key_of())
    last = kth_key(keyed.where(F.col("n_words") >= min_words).select("key"), k, seed)
    drawn = (F.col("n_words") >= min_words) & (F.col("key") <= _literal(last))
    winners = ranked(keyed.where(drawn)).select(*plain, "rank")
    return winners.unionByName(keyed.where(~drawn).select(*plain, F.lit(None).cast("long").alias("rank")))
