from collections import Counter, defaultdict

from daybook.llm import mixing
from daybook.llm.common import documents


def fair_targets(sizes):
    """Reshare the excess over twice the size by weight until none is above."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + ([None] if None in sizes else [])
    w = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    left, fixed, free = 1.5 * sum(sizes.values()), {}, set(names)
    while free:
        level = left / sum(w[s] for s in free)
        over = [s for s in free if level * w[s] > 2 * sizes[s]]
        if not over:
            return fixed | {s: level * w[s] for s in free}
        for s in over:
            fixed[s] = 2.0 * sizes[s]
            left -= fixed[s]
            free.discard(s)
    return fixed


def highest(votes, seats):
    got = Counter()
    for _ in range(seats):
        k = max(votes, key=lambda s: (votes[s] / (2 * got[s] + 1), -list(votes).index(s)))
        got[k] += 1
    return got


def check(rows, tolerance):
    sizes, taken, target = defaultdict(int), defaultdict(int), {}
    for r in rows:
        sizes[r.source] += r["size"]
        taken[r.source] += r.taken
        target[r.source] = r.target
        assert 0 <= r.taken <= 2 * r["size"]
    want = fair_targets(sizes)
    for s in sizes:
        assert abs(target[s] - want[s]) < 1e-6 * max(1, want[s])
        assert abs(taken[s] - want[s]) <= tolerance
    assert all(r.source_size == sizes[r.source] for r in rows)


def test_whole_table_near_targets_and_reruns_agree(spark, sf_dir):
    docs = documents(spark, sf_dir)
    rows = mixing.mix_sources(docs).collect()
    assert len(rows) == docs.count()
    assert {r.doc_id: r["size"] for r in rows} == {r.doc_id: len(r.text.encode().split()) if r.text else 0 for r in docs.collect()}
    check(rows, 2 * mixing.BLOCK_WORDS)
    again = mixing.mix_sources(docs.repartition(5)).collect()
    assert sorted(map(tuple, rows), key=str) == sorted(map(tuple, again), key=str)


def test_many_shards(spark):
    docs = spark.range(3000).selectExpr(
        "id AS doc_id", "if(id % 3 = 0, 'hot', concat('s', id % 5)) AS source", "repeat('w ', int(id % 40)) AS text")
    rows = mixing.mix_sources(docs, block=16, shard_words=1000).collect()
    check(rows, 600)


def test_edges(edge_docs, no_docs):
    rows = mixing.mix_sources(edge_docs).collect()
    assert len(rows) == edge_docs.count()
    check(rows, 200)
    assert mixing.mix_sources(no_docs).count() == 0
    assert mixing.take(no_docs).columns == no_docs.columns and mixing.take(no_docs).count() == 0


def test_take_gives_the_words_taken(spark, sf_dir):
    docs = documents(spark, sf_dir)
    want = {r.doc_id: r.taken for r in mixing.mix_sources(docs).collect() if r.taken}
    got, texts = Counter(), {r.doc_id: r.text for r in docs.collect()}
    for r in mixing.take(docs).collect():
        got[r.doc_id] += len(r.text.encode().split())
        assert " ".join(r.text.split()) in " ".join(texts[r.doc_id].split())
    assert got == want


def test_highest_quotients_match_seat_by_seat(spark):
    votes = {"a": 5300, "b": 2400, "c": 2300, "d": 7, "e": 0, "f": 2300}
    for seats in (0, 1, 7, 100, 113):
        df = spark.createDataFrame([(k, v, seats, 0) for k, v in votes.items()], "p string, v long, seats long, g int")
        got = {r.p: r.quota for r in mixing.highest_quotients(df, ["g"], "v", "seats", ["p"]).collect()}
        assert got == {k: highest(votes, seats)[k] for k in votes}, seats


def test_many_tiny_sources_take_their_targets(spark):
    """3,000 sources of ten words, each far below a stretch of the selection."""
    docs = spark.range(3000).selectExpr("id AS doc_id", "concat('s', id) AS source", "repeat('w ', 10) AS text")
    rows = mixing.mix_sources(docs).collect()
    check(rows, 1)
    assert abs(sum(r.taken for r in rows) - 45_000) <= 1


def test_partial_texts_are_stretches_of_the_original(spark):
    lines = "\n".join(f"w{i}\t  x{i}" for i in range(700))
    docs = spark.createDataFrame([(i, f"  {lines}\n{i} \n", "s%d" % (i % 3)) for i in range(6)], "doc_id long, text string, source string")
    texts = {r.doc_id: r.text for r in docs.collect()}
    parts = [r for r in mixing.take(docs).collect() if r.text != texts[r.doc_id]]
    assert parts
    for r in parts:
        assert r.text in texts[r.doc_id] and r.text == r.text.strip() and "\t  x" in r.text


def test_selection_against_a_walk_over_the_line(spark, sf_dir):
    """Each shard's words laid end to end: whole passes, then a run that wraps round; its size is the shard's quota."""
    docs = documents(spark, sf_dir)
    rows = mixing.mix_sources(docs, shard_words=3000).collect()
    by_source = defaultdict(list)
    for r in rows:
        by_source[r.source].append(r)
    hashed = {r.doc_id: (r.draw, r.shard) for r in docs.selectExpr(
        "doc_id", f"xxhash64(int({mixing.SEED}), doc_id) AS draw",
        f"xxhash64(xxhash64(int({mixing.SEED}), doc_id), 'shard') AS shard").collect()}
    for source, own in by_source.items():
        n = max(1, -(-own[0].source_size // 3000))
        cells = defaultdict(list)
        for r in own:
            cells[hashed[r.doc_id][1] % n].append(r)
        sizes = {k: sum(r["size"] for r in v) for k, v in cells.items()}
        quota = highest({k: sizes[k] for k in sorted(sizes)}, sum(r.taken for r in own)) if sum(sizes.values()) < 3000 else None
        for k, cell in cells.items():
            cell.sort(key=lambda r: (hashed[r.doc_id][0], r.doc_id, r["size"]))
            counts = [r.passes + sum(s["from"] <= w < s["to"] for s in r.spans) for r in cell for w in range(r["size"])]
            assert [sum(counts)] == [sum(r.taken for r in cell)] and (quota is None or sum(counts) == quota[k])
            if counts:
                more = [c - min(counts) for c in counts]
                turns = sum(a != b for a, b in zip(more, more[1:] + more[:1]))
                assert max(more) <= 1 and turns in (0, 2)
                begin = [i for i in range(len(more)) if more[i] and not more[i - 1]]
                assert not begin or begin[0] % mixing.BLOCK_WORDS == 0
