import hashlib
import random

import numpy as np
import pytest
import xxhash

from daybook.llm import phrase_dedup as pd
from daybook.llm.chunks import deal, words_in
from daybook.llm.common import documents


def brute(rows):
    key = lambda d: (d is None, d or 0)
    first, split = {}, [(d, (t or "").encode().split()) for d, t in rows]
    for d, w in split:
        for i in range(len(w) - 19):
            k = tuple(w[i : i + 20])
            first[k] = min(first.get(k, ((True, 2**70), 0)), (key(d), i))
    out = []
    for d, w in split:
        gone = set()
        for i in range(len(w) - 19):
            if first[tuple(w[i : i + 20])] < (key(d), i):
                gone.update(range(i, i + 20))
        kept = b" ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((d, len(w), len(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def run(docs, **options):
    rows = pd.remove_repeats(docs, **options).collect()
    assert all(hashlib.sha256(r.kept_text.encode()).hexdigest() == r.kept_sha256 for r in rows if r.kept_text is not None)
    return sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in rows), key=str)


def test_whole_table_matches_brute_force(spark, sf_dir):
    docs = documents(spark, sf_dir)
    assert run(docs) == brute([(r.doc_id, r.text) for r in docs.collect()])


@pytest.mark.parametrize("phrases", [3, 40_000])
def test_passages_within_and_across_documents(spark, monkeypatch, phrases):
    monkeypatch.setattr(pd, "AUTOMATON_PHRASES", phrases)
    rng = random.Random(2)
    words = [f"v{i}" for i in range(60)]
    passages = [[rng.choice(words) for _ in range(rng.randint(15, 70))] for _ in range(6)]
    rows = []
    for d in range(60):
        w = []
        for _ in range(rng.randint(0, 6)):
            p = rng.choice(passages)
            a = rng.randint(0, 8)
            w += p[a:] if rng.random() < 0.6 else [rng.choice(words) for _ in range(rng.randint(1, 30))]
        rows.append((rng.randrange(10**6), " ".join(w)))
    rows += [(10**7, "same " * 90), (10**7 + 1, "same " * 25), (10**7 + 2, "a b " * 30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert run(docs, with_text=False) == brute(rows)


def test_edges(edge_docs, no_docs):
    assert run(edge_docs) == brute([(r.doc_id, r.text) for r in edge_docs.collect()])
    assert pd.remove_repeats(no_docs).count() == 0


def test_words_are_the_ascii_ones():
    texts = [b"  a b\x0bc\x1cd ", b"", b" \n", b"\xff x\xc2\xa0y", "é\u2003é b".encode()]
    sizes, codes, known = words_in(texts)
    assert sizes.tolist() == [len(t.split()) for t in texts]
    flat = [w for t in texts for w in t.split()]
    assert [known[c] for c in codes] == [xxhash.xxh3_64_intdigest(w) for w in flat]


def test_rows_of_one_id_spread_over_chunks(spark):
    docs = spark.range(4000).selectExpr("CAST(NULL AS LONG) AS doc_id", "concat('text ', id) AS text")
    dealt, _ = deal(docs, "doc_id", "text", chunk_bytes=2000)
    sizes = [r["count"] for r in dealt.groupBy("chunk").count().collect()]
    assert len(sizes) > 10 and max(sizes) < 3 * 4000 / len(sizes)


def test_rolling_and_sliding():
    a = np.random.default_rng(0).integers(0, 2**63, 50, dtype=np.uint64)
    for n in (1, 2, 7, 10, 20):
        h = pd.rolling(a, n, pd._C)
        assert len(h) == 51 - n
        b = np.concatenate([a[13:], a])
        assert (pd.rolling(b, n, pd._C)[: 51 - n - 13] == h[13:]).all()
    for n in (1, 3, 11):
        assert (pd.sliding_min(a, n) == [a[i : i + n].min() for i in range(51 - n)]).all()
