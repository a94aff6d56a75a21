import random

import numpy as np

from daybook.llm import minmax_dedup as mm
from daybook.llm.common import documents
from daybook.llm.graph import components


def shingles(text, n):
    w = (text or "").encode().lower().split()
    return frozenset(tuple(w[i : i + n]) for i in range(len(w) - n + 1)) if len(w) >= n else frozenset([tuple(w)]) if w else frozenset()


def brute(rows, n, percent):
    """All pairs that share a shingle; documents that share an id are one."""
    sets = [(d, shingles(t, n)) for d, t in rows]
    root = {d: d for d, _ in rows if d is not None}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    by, seen = {}, set()
    for i, (d, s) in enumerate(sets):
        if d is None:
            continue
        for j in {j for x in s for j in by.get(x, ())}:
            e, t = sets[j]
            if (i, j) not in seen and 100 * len(s & t) >= percent * len(s | t):
                a, b = sorted((find(d), find(e)))
                root[b] = a
        for x in s:
            by.setdefault(x, []).append(i)
    return sorted(((d, len(s), find(d) if d is not None else None, d is None or find(d) == d) for d, s in sets), key=str)


def test_whole_table_matches_brute_force(spark, sf_dir):
    docs = documents(spark, sf_dir)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    for n, percent in ((3, 85), (5, 80)):
        got = mm.near_groups(docs, words=n, percent=percent).collect()
        assert sorted(map(tuple, got), key=str) == brute(rows, n, percent)


def test_one_large_group_in_blocks(spark, monkeypatch):
    rng = random.Random(5)
    vocab = [f"w{i}" for i in range(3000)]
    base = [rng.choice(vocab) for _ in range(150)]
    rows = []
    for i in range(300):
        w = list(base)
        for _ in range(rng.randint(0, 9)):
            w[rng.randrange(len(w))] = rng.choice(vocab)
        rows.append((i, " ".join(w)))
    rows += [(300 + i, " ".join(rng.choice(vocab) for _ in range(80))) for i in range(50)]
    monkeypatch.setattr(mm, "BLOCK", 40)
    got = mm.near_groups(spark.createDataFrame(rows, "doc_id long, text string"), words=3, percent=85).collect()
    assert sorted(map(tuple, got), key=str) == brute(rows, 3, 85)


def test_edges(edge_docs, no_docs):
    rows = [(r.doc_id, r.text) for r in edge_docs.collect()]
    got = mm.near_groups(edge_docs, words=3, percent=85).collect()
    assert sorted(map(tuple, got), key=str) == brute(rows, 3, 85)
    assert mm.near_groups(no_docs).count() == 0
    kept = mm.drop_near(edge_docs)
    assert kept.columns == edge_docs.columns
    # the row without an id has the text of 1
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["1", "3", "4", "5", "6", "8", "9"]


def test_min_and_max_estimate_the_similarity():
    rng = np.random.default_rng(1)
    errors = []
    for share in (0.2, 0.5, 0.85):
        for _ in range(20):
            a = rng.integers(0, 2**63, 400, dtype=np.uint64)
            n = int(2 * 400 * share / (1 + share))
            b = np.concatenate([a[:n], rng.integers(0, 2**63, 400 - n, dtype=np.uint64)])
            pa, pb = a[:, None] * mm._A, b[:, None] * mm._A
            match = np.concatenate([pa.min(0) == pb.min(0), pa.max(0) == pb.max(0)]).mean()
            errors.append(match - n / (800 - n))
    assert abs(np.mean(errors)) < 0.015 and np.std(errors) < 0.04


def test_components_of_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(100, 140)] + [(7, i) for i in range(200, 260)] + [(5, 5), (300, 299), (301, 300), (299, 301)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = {i: 100 for i in range(100, 141)} | {i: 7 for i in [7, *range(200, 260)]} | {i: 299 for i in (299, 300, 301)}
    assert got == want
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_drop_near_on_rows_that_share_an_id_or_have_none(spark):
    long = [" ".join(f"{c}{i}" for i in range(60)) for c in "abcd"]
    near = long[0].replace("a59", "z")
    rows = [(1, long[0], "p"), (1, long[0], "p"), (1, long[1], "p"), (None, near, "p"), (None, long[2], "p"),
            (None, long[2], "o"), (5, long[3], "p"), (None, "", "p"), (6, None, "p")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, grp string")
    left = mm.drop_near(docs)
    assert left.columns == docs.columns
    got = [(r.doc_id, r.text, r.grp) for r in left.collect()]
    texts = [t for _, t, _ in got]
    assert sorted(t for t in texts if t and t != near and t != long[0]) == sorted(long[1:])
    assert sum(t in (long[0], near) for t in texts) == 1
    assert (None, long[2], "o") in got and (None, "", "p") in got and (6, None, "p") in got and len(got) == 6


def test_sets_leave_a_worker_in_slices():
    """Sets of a batch of texts are never held all at once."""
    import pyarrow as pa

    from daybook.llm import minmax_dedup as m

    n = 2 * m.SET_ROWS + 7
    texts = pa.array([b"" if i % 5 == 0 else b"a b c d e f %d" % i for i in range(n)], pa.binary())
    ids, one = pa.array(range(n), pa.int64()), pa.array([1] * n, pa.int32())
    batch = pa.RecordBatch.from_arrays([ids, texts, ids, one, one], names=["node", "text", "grp", "blk", "blocks"])
    got = list(m._sets(5)(iter([batch])))
    assert [b.num_rows for b in got] == [m.SET_ROWS, m.SET_ROWS, 7]
    assert pa.Table.from_batches(got)["node"].to_pylist() == list(range(n))
    words = m.WordHashes()
    assert pa.Table.from_batches(got)["shingles"].to_pylist() == [m.shingle_set(t, 5, words).tobytes() for t in texts.to_pylist()]
