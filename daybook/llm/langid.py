"""Language identification by nearest centroid.

A text is a vector of hashed UTF-8 byte n-grams (2 and 3 bytes, ASCII lower-cased, letters and
other non-ASCII bytes only, runs of anything else being one blank): sqrt(count) * idf, scaled to
length 1.  Each language has ``CENTROIDS`` unit centroids from spherical k-means; a text gets the
language of the centroid with the largest cosine, and is rejected when the cosine is below that
centroid's own limit, ``LIMIT_SHARE`` of a low quantile of its training members' cosines (of all of
its language's where the centroid has few members).  A text of fewer than ``FULL_GRAMS`` n-grams
cannot come as near, so its limit shrinks with the square root of their number.

The classifier is fitted on a bounded sample of labelled rows, ``SAMPLE_PER_LANG`` rows of each
language (smallest seeded hash of the id, then of the text); only their vectors reach the driver, however
many rows share an id.  Prediction reads
every whole text in one scan without a shuffle; the broadcast model has at most ``MAX_CENTROIDS``
rows of ``DIM`` floats.

Defined cases: null text, empty text and text without a letter give ``und`` with score 0 and are
rejected; rows without a language are never learned from; with no labelled row at all everything is
``und``; equal cosines go to the first language in code-point order; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from daybook.llm.common import release

DIM = 4096
CENTROIDS = 3
SAMPLE_PER_LANG = 400
MAX_CENTROIDS = 6000
ROUNDS = 8
LIMIT_QUANTILE = 0.02
LIMIT_SHARE = 0.6
#: Centroids with fewer training members take their language's quantile.
LIMIT_MEMBERS = 20
FULL_GRAMS = 200
SEED = 7
UND = "und"

_FOLD = np.zeros(256, np.int64)
_FOLD[97:123] = np.arange(1, 27)
_FOLD[65:91] = np.arange(1, 27)
_FOLD[128:] = np.arange(27, 155)


def features(text: bytes) -> np.ndarray:
    """sqrt counts of hashed n-grams."""
    c = _FOLD[np.frombuffer(text, np.uint8)]
    if len(c) > 1:
        c = c[np.append(True, (c[1:] != 0) | (c[:-1] != 0))]
    c = np.concatenate(([0], c, [0]))
    two = c[:-1] * 155 + c[1:]
    three = two[:-1] * 155 + c[2:]
    h = np.concatenate([two + 1000, three + 100_000]).astype(np.uint32)
    h *= np.uint32(2654435761)
    h >>= np.uint32(20)
    return np.sqrt(np.bincount(h, minlength=DIM)).astype(np.float32)


def has_letter(text: bytes) -> bool:
    if not text.isascii():
        return any(ch.isalpha() for ch in text.decode("utf-8", "replace"))
    return text.lower().islower()


def unit(m: np.ndarray) -> np.ndarray:
    return m / np.maximum(np.linalg.norm(m, axis=-1, keepdims=True), 1e-12)


def _vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        yield pa.RecordBatch.from_arrays(
            [b.column(0), pa.array([features(t).tobytes() for t in b.column(1).to_pylist()], pa.binary())],
            names=["lang", "v"],
        )


def _kmeans(v: np.ndarray, k: int, rounds: int) -> tuple[np.ndarray, np.ndarray]:
    """Spherical k-means from far-apart seeds (deterministic); centroids and each row's cosine."""
    c = unit(v.mean(axis=0, keepdims=True))
    while len(c) < min(k, len(v)):
        c = np.vstack([c, v[np.argmin((v @ c.T).max(axis=1))]])
    for _ in range(rounds):
        near = (v @ c.T).argmax(axis=1)
        c = np.vstack([unit(v[near == i].mean(axis=0)) if (near == i).any() else c[i] for i in range(len(c))])
    return c, v @ c.T


class CentroidModel:
    def __init__(self, langs: list[str], lang_of: np.ndarray, centroids: np.ndarray, idf: np.ndarray, limit: np.ndarray):
        self.langs, self.lang_of, self.centroids, self.idf, self.limit = langs, lang_of, centroids, idf, limit

    def score(self, texts: list[bytes]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Per text: language, cosine, rejected."""
        lang, best, out = [UND] * len(texts), np.zeros(len(texts)), np.ones(len(texts), bool)
        todo = [i for i, t in enumerate(texts) if t is not None and has_letter(t)] if len(self.langs) else []
        for at in range(0, len(todo), 256):
            some = todo[at : at + 256]
            v = np.stack([features(texts[i]) for i in some])
            full = np.sqrt(np.minimum(1.0, (v * v).sum(axis=1) / FULL_GRAMS))
            cos = unit(v * self.idf) @ self.centroids.T
            top = cos.argmax(axis=1)
            for i, t, f, row in zip(some, top, full, cos):
                lang[i], best[i] = self.langs[self.lang_of[t]], min(1.0, max(0.0, float(row[t])))
                out[i] = row[t] < self.limit[t] * f
        return lang, best, out


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
        *, train=None, per_lang: int = SAMPLE_PER_LANG, centroids: int = CENTROIDS) -> CentroidModel:
    """Fit on ``docs`` where ``train`` (a Column; all rows if None) and lang and text are not null."""
    col = lambda c: F.col(f"`{c}`")
    rows = docs.where(col(lang_col).isNotNull() & col(text_col).isNotNull())
    rows = rows.where(train) if train is not None else rows
    rows = rows.select(col(id_col).alias("id"), col(lang_col).cast("string").alias("lang"), col(text_col).alias("text"),
                       F.xxhash64(F.lit(SEED), col(id_col)).alias("draw"))
    # ids first, from narrow columns; texts only of the rows drawn
    drawn = rows.select("id", "lang", "draw").withColumn(
        "k", F.row_number().over(Window.partitionBy("lang").orderBy("draw", "id"))
    ).where(F.col("k") <= per_lang)
    most = MAX_CENTROIDS // centroids
    langs = [r[0] for r in drawn.select("lang").distinct().orderBy("lang").limit(most + 1).collect()]
    if len(langs) > most:
        raise ValueError(f"more than {most} languages; the broadcast model is bounded by MAX_CENTROIDS")
    # the hash bound of each language's sample, as a small predicate pushed into the second scan
    bounds = drawn.groupBy("lang").agg(F.max("draw").alias("most")).withColumnRenamed("lang", "l")
    picked = rows.join(F.broadcast(bounds), (F.col("lang") == F.col("l")) & (F.col("draw") <= F.col("most")))
    # rows that share an id share a draw: of more rows at a bound than the sample holds, the first by hash of text
    order = Window.partitionBy("lang").orderBy("draw", "id", F.xxhash64(F.lit(SEED), "text"), "text")
    picked = picked.select("lang", "draw", "id", F.col("text").cast("binary").alias("text"))
    picked = picked.withColumn("k", F.row_number().over(order)).where(F.col("k") <= per_lang)
    got = picked.select("lang", "text").mapInArrow(_vectors, "lang string, v binary").collect()
    if not got:
        return CentroidModel([], np.zeros(0, int), np.zeros((0, DIM)), np.ones(DIM), np.zeros(0))
    got.sort(key=lambda r: (r[0], r[1]))
    v = np.stack([np.frombuffer(r[1], np.float32) for r in got])
    idf = (np.log((1 + len(v)) / (1 + (v > 0).sum(axis=0))) + 1).astype(np.float32)
    v = unit(v * idf)
    names = np.array([r[0] for r in got], object)
    cents, owner, limits = [], [], []
    for i, lang in enumerate(langs):
        c, cos = _kmeans(v[names == lang], centroids, ROUNDS)
        near = cos.argmax(axis=1)
        for j in range(len(c)):
            mine = cos[near == j, j]
            mine = mine if len(mine) >= LIMIT_MEMBERS else cos.max(axis=1)
            limits.append(LIMIT_SHARE * float(np.quantile(mine, LIMIT_QUANTILE)))
            cents.append(c[j])
            owner.append(i)
    return CentroidModel(langs, np.array(owner), np.stack(cents).astype(np.float32), idf, np.array(limits))


def identify(docs: DataFrame, model: CentroidModel, text_col: str = "text") -> DataFrame:
    """``docs`` with lang_pred, lang_score and lang_rejected.  Only the texts go to Python, and no
    text comes back."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("lang string, score double, rejected boolean")
    def judged(text: pd.Series) -> pd.DataFrame:
        lang, score, out = shared.value.score(text.tolist())
        release()
        return pd.DataFrame({"lang": lang, "score": score, "rejected": out})

    # evaluated once, however often its fields are used
    verdict = judged.asNondeterministic()(F.col(f"`{text_col}`").cast("binary"))
    return docs.select("*", verdict.alias("__lang")).select(
        *(F.col(f"`{c}`") for c in docs.columns), F.col("__lang.lang").alias("lang_pred"),
        F.col("__lang.score").alias("lang_score"), F.col("__lang.rejected").alias("lang_rejected"))
