import hashlib
import math
import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from daybook.llm import resampling as rs

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def features(text, ngrams=1):
    w = WORD.findall((text or "").translate(LOWER))
    return [zlib.crc32(" ".join(w[i : i + n]).encode()) % 10000 for n in range(1, ngrams + 1) for i in range(len(w) - n + 1)], len(w)


def brute(docs, target, ngrams=1, percent=10):
    s = Counter(b for _, t in docs for b in features(t, ngrams)[0])
    t = Counter(b for x in target for b in features(x, ngrams)[0])
    ns, nt = sum(s.values()) + 10000, sum(t.values()) + 10000
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * ns / ((s[b] + 1) * nt)))
    out = []
    for i, text in docs:
        f, n_words = features(text, ngrams)
        w = sum(map(gain, f)) // len(f) if f else 0
        h = int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append([i, n_words, len(f), w, w + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None])
    may = sorted((r for r in out if r[1] >= 20), key=lambda r: (-r[4], r[0] is None, r[0] or 0, r[2]))
    for k, r in enumerate(may[: len(may) * percent // 100], 1):
        r[5] = k
    return sorted(map(tuple, out), key=str)


def texts(df, *cols):
    return [tuple(r) if len(cols) > 1 else r[0] for r in df.select(*cols).collect()]


@pytest.mark.parametrize("ngrams, percent", [(1, 10), (2, 35)])
def test_whole_table_matches_brute_force(spark, sf_dir, ngrams, percent):
    docs, target = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "benchmark"))
    got = rs.resample(docs, target, ngrams=ngrams, percent=percent).collect()
    assert sorted(map(tuple, got), key=str) == brute(texts(docs, "doc_id", "text"), texts(target, "text"), ngrams, percent)


def test_edges(spark, edge_docs, no_docs):
    target = spark.createDataFrame([("Alpha beta GAMMA", 1), (None, 2), ("", 3)], "text string, doc_id int")
    rows, wanted = texts(edge_docs, "doc_id", "text"), texts(target, "text")
    assert sorted(map(tuple, rs.resample(edge_docs, target, percent=60).collect()), key=str) == brute(rows, wanted, 1, 60)
    assert sorted(map(tuple, rs.resample(edge_docs, target.limit(0)).collect()), key=str) == brute(rows, [])
    empty = rs.resample(no_docs, target)
    assert empty.count() == 0 and empty.columns == ["doc_id", "n_words", "n_features", "weight", "score", "rank"]
    clash = edge_docs.selectExpr("doc_id AS id", "text AS body", "1 AS doc_id", "2 AS score", "3 AS place", "4 AS key", "5 AS text")
    assert sorted(map(tuple, rs.resample(clash, target, "id", "body", percent=60).collect()), key=str) == brute(rows, wanted, 1, 60)


def test_repeated_rows_tie_and_exactly_k_are_drawn(spark):
    text = " ".join(f"w{i}" for i in range(25))
    docs = spark.createDataFrame([(7, text)] * 300 + [(None, text)] * 300 + [(i, text + " x") for i in range(100)], "doc_id long, text string")
    got = rs.resample(docs.repartition(7), docs.select("text").limit(1), percent=50).collect()
    ranks = sorted(r["rank"] for r in got if r["rank"] is not None)
    assert len(got) == 700 and ranks == list(range(1, 351))
    by_rank = sorted((r for r in got if r["rank"] is not None), key=lambda r: r["rank"])
    order = [(-r.score, r.doc_id is None, r.doc_id or 0, r.n_features) for r in by_rank]
    rest = [(-r.score, r.doc_id is None, r.doc_id or 0, r.n_features) for r in got if r["rank"] is None]
    assert order == sorted(order) and order[-1] <= min(rest)


@pytest.mark.parametrize("pivots", [1, 4, 15])
def test_quickselect_against_sorting(spark, pivots):
    rng = random.Random(pivots)
    rows = [(rng.randint(-5, 5), rng.choice([None, 1, 2, 3]), rng.randint(0, 2), i) for i in range(120)]
    keys = spark.createDataFrame(rows, "score long, doc_id long, n_features long, place long").select(rs.key_of().alias("key")).cache()
    ordered = sorted((-s, d is None, d or 0, n, p) for s, d, n, p in rows)
    for k in (1, 2, 61, 119, 120):
        assert rs.kth_key(keys, k, pivots=pivots) == ordered[k - 1]
    with pytest.raises(ValueError):
        rs.kth_key(keys, 121, pivots=pivots)
    placed = rs.ranked(keys).orderBy("rank").collect()
    assert [tuple(r.key) for r in placed] == ordered and [r["rank"] for r in placed] == list(range(1, 121))
    assert keys.where(F.col("key.place") < 0).count() == 0
