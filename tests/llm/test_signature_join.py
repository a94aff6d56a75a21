import random

import numpy as np
import pytest

from daybook.llm import signature_join as sj
from daybook.llm.common import documents
from daybook.llm.graph import components
from test_minmax_dedup import brute


def want(rows, n, percent):
    return sorted([(d, size, root) for d, size, root, _ in brute(rows, n, percent)], key=str)


def got(docs, n, percent):
    return sorted(map(tuple, sj.join_components(docs, words=n, percent=percent).collect()), key=str)


@pytest.mark.parametrize("n, percent", [(4, 85), (5, 80)])
def test_whole_table_matches_brute_force(spark, sf_dir, n, percent):
    docs = documents(spark, sf_dir)
    assert got(docs, n, percent) == want([(r.doc_id, r.text) for r in docs.collect()], n, percent)


def chained_rows(rng):
    """A chain of near copies, families of copies, and a passage that half of all texts share."""
    vocab = [f"w{i}" for i in range(3000)]
    passage = [rng.choice(vocab) for _ in range(60)]
    rows, at = [], [rng.choice(vocab) for _ in range(150)]
    for _ in range(120):
        at = list(at)
        at[rng.randrange(len(at))] = rng.choice(vocab)
        rows.append(" ".join(at))
    for _ in range(120):
        own = [rng.choice(vocab) for _ in range(rng.randint(5, 90))]
        rows.append(" ".join(own + passage))
    rows += [" ".join(passage + [rng.choice(vocab)] * k) for k in range(6)]
    return list(enumerate(rows))


def test_chains_and_common_passages_in_blocks(spark, monkeypatch):
    rows = chained_rows(random.Random(7))
    monkeypatch.setattr(sj, "BLOCK", 16)
    monkeypatch.setattr(sj, "FREQUENT", 8)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert got(docs, 4, 85) == want(rows, 4, 85)
    monkeypatch.setattr(sj, "RESERVE", 1.0)
    monkeypatch.setattr(sj, "FREQUENT_ROWS", 20)  # the limit is doubled until so many are left
    monkeypatch.setattr(sj, "ROUNDS", 0)
    assert got(docs, 4, 60) == want(rows, 4, 60)


def test_edges(spark, edge_docs, no_docs):
    rows = [(r.doc_id, r.text) for r in edge_docs.collect()]
    assert got(edge_docs, 4, 85) == want(rows, 4, 85)
    assert sj.join_components(no_docs).count() == 0
    clash = edge_docs.selectExpr("doc_id AS id", "text AS body", "0 AS node", "'t' AS token", "1 AS n", "2 AS label", "3 AS doc_id")
    assert sorted(map(tuple, sj.join_components(clash, "id", "body", words=4, percent=85).collect()), key=str) == want(rows, 4, 85)


def test_trees_rule_out_no_pair_and_most_strangers():
    rng = np.random.default_rng(3)
    sets = []
    for _ in range(40):
        base = rng.integers(0, 2**63, rng.integers(3, 600), dtype=np.uint64)
        for share in (1.0, 0.97, 0.9, 0.8, 0.6):
            own = base[: max(1, int(share * len(base)))]
            sets.append(np.unique(np.concatenate([own, rng.integers(0, 2**63, len(base) - len(own), dtype=np.uint64)])))
    sizes, sigs = np.array([len(s) for s in sets]), [sj.signature(s) for s in sets]
    none = np.full(len(sets), -1)
    for percent in (85, 60, 40):
        linked = {(a, b) for a in range(len(sets)) for b in range(a) if sj.similar(sets[a], sets[b], percent)}
        seen, walked = set(), 0
        for at, tree in sj.trees(sizes, sigs, np.arange(len(sets)), none, percent):
            for i, j in tree.pairs():
                pairs = {(int(max(at[x], at[y])), int(min(at[x], at[y]))) for x, y in zip(i, j)}
                assert not pairs & seen
                seen |= pairs
                walked += len(i)
        assert linked <= seen
        if percent == 85:
            assert walked < 3 * len(linked)
        # the forest joins exactly what the links join
        root = list(range(len(sets)))
        find = lambda x: x if root[x] == x else find(root[x])
        for a, b in linked:
            root[find(a)] = find(b)
        links = sj.forest(sets, np.arange(len(sets)), none, percent)
        assert len(links) == len(sets) - len({find(x) for x in range(len(sets))}) and all(find(a) == find(b) for a, b in links)


def test_rounds_end_where_they_close_little(spark, monkeypatch):
    """Texts that share passages, few of them linked: the second round had as many members to compare as the first."""
    rng = random.Random(11)
    passages = [[f"p{i}x{k}" for k in range(12)] for i in range(8)]
    rows = []
    for _ in range(60):
        text = [w for p in rng.sample(passages, 4) for w in p] + [f"w{rng.randrange(5000)}" for _ in range(40)]
        rows.append(" ".join(text))
    rows += [rows[k] + " more" for k in range(3)]
    rows = list(enumerate(rows))
    monkeypatch.setattr(sj, "RESERVE", 1.0)
    calls, compare = [], sj._compare
    monkeypatch.setattr(sj, "_compare", lambda *a: calls.append(a[-1]) or compare(*a))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert got(docs, 4, 85) == want(rows, 4, 85)
    assert calls == [False, True]


def test_few_edges_make_few_tasks(spark):
    """Many shuffle partitions leave no tiny tasks in every stage of the rounds; known and unknown counts agree."""
    rng = random.Random(5)
    pairs = [(k, k + 1) for k in range(40)] + [(100, 100 + k) for k in range(1, 30)] + [(rng.randrange(200, 400), rng.randrange(200, 400)) for _ in range(90)]
    held = {"spark.sql.shuffle.partitions": "96", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in held}
    for k, v in held.items():
        spark.conf.set(k, v)
    try:
        edges, sc = spark.createDataFrame(pairs, "a long, b long"), spark.sparkContext
        sc.setJobGroup("few edges", "components")
        known = sorted(map(tuple, components(edges, len(pairs)).collect()))
        tracker = sc.statusTracker()
        stages = {s for j in tracker.getJobIdsForGroup("few edges") for s in tracker.getJobInfo(j).stageIds}
        tasks = [s.numTasks for s in map(tracker.getStageInfo, stages) if s and s.numCompletedTasks]
        assert tasks and max(tasks) <= 3 * sc.defaultParallelism
        sc.setLocalProperty("spark.jobGroup.id", None)
        assert known == sorted(map(tuple, components(edges).collect()))
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    root = {x: x for p in pairs for x in p if p[0] != p[1]}
    find = lambda x: x if root[x] == x else find(root[x])
    for a, b in pairs:
        if a != b:
            a, b = sorted((find(a), find(b)))
            root[b] = a
    assert known == sorted((x, find(x)) for x in root)
