import math
import mmap
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from daybook.llm import lm_scoring as lm
from daybook.llm.common import documents
from daybook.llm.elias_fano import BigramTrie, EliasFano

END = b" "


def brute(rows):
    docs = []
    for d, t in rows:
        held = zlib.crc32(b"" if d is None else str(d).encode()) % 7 == 2
        docs.append((d, held, [*(t or "").encode().lower().split(), END]))
    one, two = Counter(), Counter()
    for _, held, w in docs:
        if not held:
            one.update(w)
            two.update(zip([END, *w], w))
    n, v = sum(one.values()), len(one)
    n1, n2 = sum(c == 1 for c in one.values()), sum(c == 2 for c in one.values())
    off = n1 / (n1 + 2 * n2) if n1 and n2 else 0.5
    out = {}
    for d, held, w in docs:
        base = sum(math.log10((one[x] + 1) / (n + v + 1)) for x in w)
        score = 0.0
        for h, x in zip([END, *w], w):
            p = ((one[x] - off) if one[x] else off * v) / n if n else 1.0
            score += math.log10((two[h, x] + lm.MU * p) / (one[h] + lm.MU))
        out[d, tuple(w)] = (held, len(w), sum(one[x] > 0 for x in w), n, base, score)
    return out


def check(docs, **options):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    want, got = brute(rows), lm.score(docs, **options).collect()
    assert len(got) == len(rows)
    by_id = {}
    for (d, _), x in want.items():
        by_id.setdefault(d, []).append(x)
    for r in got:
        fits = [x for x in by_id[r.doc_id] if x[:4] == tuple(r)[1:5] and x[4] == pytest.approx(r.base_score, abs=1e-6)]
        assert fits, r
        # probabilities are quantised to steps of 14 / 4095 decades
        assert any(abs(x[5] - r.score) <= 0.0018 * r.n_tokens + 1e-9 for x in fits), (r, fits)
    return got


def test_whole_table_matches_brute_force_and_beats_the_base(spark, sf_dir):
    got = check(documents(spark, sf_dir), chunk_bytes=100_000)
    held = [r for r in got if r.held_out]
    assert held and sum(r.score for r in held) > sum(r.base_score for r in held)


def test_edges(edge_docs, no_docs, spark):
    check(edge_docs)
    assert lm.score(no_docs).count() == 0
    untrained = spark.createDataFrame([(d, "a b") for d in range(40) if lm.is_held_out(d)], "doc_id long, text string")
    assert {(r.train_tokens, r.n_known, r.score) for r in lm.score(untrained).collect()} == {(0, 0, 0.0)}


def test_probabilities_of_a_context_add_up_to_one(spark):
    rng = np.random.default_rng(4)
    rows = [(d, " ".join(f"w{x}" for x in rng.zipf(1.4, 30) if x < 300)) for d in range(80)]
    train = [w for d, t in rows if not lm.is_held_out(d) for w in [t.split()]]
    vocab = sorted({w for ws in train for w in ws})
    held = iter(d for d in range(10**6, 10**7) if lm.is_held_out(d))
    ask = {next(held): w for w in [*vocab, "neverseen"]}
    docs = spark.createDataFrame([*rows, *((d, f"w1 {w}") for d, w in ask.items()), (next(held), "w1")], "doc_id long, text string")
    scores = {r.doc_id: r.score for r in lm.score(docs).collect()}
    ends = {d: s for d, s in scores.items() if d in ask}
    # p(w1|start) p(w|w1) p(end|w): divide the known factors away by the brute-force model
    want = brute([(r.doc_id, r.text) for r in docs.collect()])
    total = 0.0
    one, two = Counter(), Counter()
    for w in train:
        one.update([*w, " "])
        two.update(zip([" ", *w], [*w, " "]))
    for (d, w), x in want.items():
        if d in ends:
            total += 10 ** (x[5] - math.log10(self_p(one, two, " ", "w1")) - math.log10(self_p(one, two, w[1].decode(), " ")))
            assert abs(x[5] - ends[d]) < 0.006
    assert total + self_p(one, two, "w1", " ") == pytest.approx(1.0)


def self_p(one, two, h, x):
    n, v = sum(one.values()), len(one)
    n1, n2 = sum(c == 1 for c in one.values()), sum(c == 2 for c in one.values())
    off = n1 / (n1 + 2 * n2)
    p = ((one[x] - off) if one[x] else off * v) / n
    return (two[h, x] + lm.MU * p) / (one[h] + lm.MU)


def test_elias_fano_with_dense_stretches():
    v = np.unique(np.concatenate([np.arange(5000, 9000), np.arange(10**9, 10**9 + 3000, 3), np.arange(0, 10**12, 10**9)]))
    s = EliasFano.encode(v)
    x = np.concatenate([v, v + 1, v - 1])
    assert (s.find(x) >= 0).sum() == np.isin(x, v).sum() and (s.next_geq(x)[0] == np.searchsorted(v, x)).all()


@pytest.mark.parametrize("top", [1, 50, 10**4, 10**12])
def test_elias_fano(top):
    rng = np.random.default_rng(top % 97)
    for n in (0, 1, 2, 63, 64, 700, 5000):
        v = np.sort(rng.integers(0, top, n))
        s = EliasFano.encode(v)
        assert (s.access(np.arange(n)) == v).all()
        x = np.concatenate([rng.integers(0, top + 2, 300), v[:300], v[-5:] + 1])
        i, value = s.next_geq(x)
        assert (i == np.searchsorted(v, x)).all()
        assert (value == np.append(v, -1)[i]).all()
        found = s.find(x)
        assert (found == np.where(value == x, i, -1)).all()


def test_trie_from_a_memory_map(tmp_path):
    rng = np.random.default_rng(8)
    pairs = sorted({(int(a), int(b)) for a, b in zip(rng.zipf(1.3, 20000) % 5000, rng.integers(0, 10**6, 20000))})
    c, w = (np.array(x, np.int64) for x in zip(*pairs))
    codes = rng.integers(1, 4097, len(c)).astype(np.uint16)
    path = tmp_path / "trie"
    path.write_bytes(BigramTrie.build(c, w, codes).to_bytes())
    with open(path, "rb") as f:
        trie = BigramTrie.from_buffer(mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ))
    assert (trie.lookup(c, w) == codes).all()
    absent = [(a, b) for a, b in zip(rng.integers(0, 6000, 3000).tolist(), rng.integers(0, 10**6, 3000).tolist()) if (a, b) not in set(pairs)]
    a, b = (np.array(x, np.int64) for x in zip(*absent))
    assert not trie.lookup(a, b).any()
    assert path.stat().st_size < 0.75 * 16 * len(c)


def test_integers_round_trip_and_codes():
    arrays = [np.array(x, np.uint64) for x in ([], [0], [255, 256, 1], [2**40, 3], [2**64 - 1])]
    assert all((a == b).all() for a, b in zip(arrays, lm.unpack_ints(lm.pack_ints(*arrays))))
    p = 10.0 ** np.linspace(-13, 0, 999)
    assert np.abs(np.log10(lm.restore(lm.quantise(p)) / p)).max() < 0.0018
    assert lm.restore(np.zeros(1, np.uint16))[0] == 0


def test_hot_context_is_spread():
    follower = np.arange(1000, dtype=np.uint64)
    hot = lm._context_shard(np.full(1000, 7, np.uint64), follower, np.full(1000, 500, np.uint64), 1000, 16)
    cold = lm._context_shard(np.full(1000, 7, np.uint64), follower, np.full(1000, 5, np.uint64), 10**6, 16)
    assert len(set((hot % np.uint64(16)).tolist())) > 8 and len(set(cold.tolist())) == 1


def test_messages_go_to_shards_with_words_only():
    """However many shards there are, a chunk asks at most one per distinct word."""
    texts = [b"a b a", b"", b"b c d"]
    table = pa.table({"chunk": pa.array([3] * 3, pa.int32()), "doc_id": [1, 2, 9], "text": pa.array(texts, pa.binary())})
    for shards in (1, 10, 5000):
        asked = lm._send_words(shards)(table)
        assert asked.num_rows <= min(shards, 5)  # a b c d and the end
        assert sum(len(lm.unpack_ints(b)[0]) for b in asked.column("blob").to_pylist()) == 5
