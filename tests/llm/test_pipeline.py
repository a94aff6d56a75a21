from collections import Counter

import pytest

import corpus_pipeline as cp
from daybook.llm.common import documents
from test_minmax_dedup import brute as near_brute


@pytest.fixture(scope="module")
def stages(spark, sf_dir, tmp_path_factory):
    """Input and output of each stage, written and read again."""
    at, docs, out = tmp_path_factory.mktemp("stages"), documents(spark, sf_dir), []
    for i, (name, f) in enumerate(cp.STAGES):
        f(spark, docs, sf_dir).write.parquet(f"{at}/{i}")
        after = spark.read.parquet(f"{at}/{i}")
        out.append((name, docs, after))
        docs = after
    return {name: (a, b) for name, a, b in out}


def test_order_and_columns(stages, spark, sf_dir):
    assert [n for n, _ in cp.STAGES] == ["language_id", "exact_dedup", "near_dedup", "mixing", "packing"]
    cols = documents(spark, sf_dir).columns
    assert all(stages[n][1].columns == cols for n, _ in cp.STAGES[:-1])


def test_language_stage_keeps_clean_documents(stages, spark, sf_dir):
    before, after = (d.count() for d in stages["language_id"])
    assert 0.97 * before <= after <= before


def test_exact_stage(stages):
    before, after = stages["exact_dedup"]
    groups = {}
    for r in before.collect():
        key = b"".join((r.text or "").encode().split())
        groups.setdefault(key, []).append((-len(r.text or ""), r.doc_id))
    assert sorted(r.doc_id for r in after.collect()) == sorted(min(g)[1] for g in groups.values())


def test_near_stage(stages):
    before, after = stages["near_dedup"]
    want = near_brute([(r.doc_id, r.text) for r in before.collect()], 5, 80)
    assert sorted(r.doc_id for r in after.collect()) == sorted(d for d, _, _, kept in want if kept)


def test_mixing_stage(stages):
    before, after = stages["mixing"]
    size = Counter({r.doc_id: len((r.text or "").encode().split()) for r in before.collect()})
    taken = Counter()
    for r in after.collect():
        taken[r.doc_id] += len((r.text or "").encode().split())
    assert all(taken[d] <= 2 * size[d] for d in taken) and abs(taken.total() - 1.5 * size.total()) < 0.02 * size.total()


def test_packing_stage(stages):
    before, after = stages["packing"]
    rows = after.collect()
    assert sum(r.start == 0 for r in rows) == before.count()
    fill = Counter()
    for r in rows:
        fill[r.sequence_id] += r.length
    assert max(fill.values()) <= 1024 and sum(fill.values()) == sum(r.doc_tokens for r in rows if r.start == 0)


def test_run_gives_the_last_stage(stages, spark, sf_dir):
    assert cp.run(spark, sf_dir).count() == stages["packing"][1].count()


def test_empty_input(spark, tmp_path, sf_dir):
    documents(spark, sf_dir).where("false").write.parquet(str(tmp_path / "documents.parquet"))
    assert cp.run(spark, str(tmp_path)).count() == 0


def test_edge_rows_pass(edge_docs, spark, sf_dir, tmp_path):
    docs = edge_docs
    for i, (_, f) in enumerate(cp.STAGES):
        out = f(spark, docs, sf_dir)
        out.write.parquet(f"{tmp_path}/{i}")
        docs = spark.read.parquet(f"{tmp_path}/{i}")
    assert docs.count() > 0
