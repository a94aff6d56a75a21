import hashlib
import re
from collections import defaultdict

from daybook.llm import exact_dedup


def brute(rows):
    groups = defaultdict(list)
    for doc_id, text in rows:
        groups[re.sub(r"[\x20\x09-\x0D]", "", text or "")].append((doc_id, text or ""))
    out = []
    for norm, members in groups.items():
        best = max(members, key=lambda m: (len(m[1]), m[0] is not None, -(m[0] or 0)))[0]
        out += [(d, best, len(members), d == best, hashlib.sha256(norm.encode()).hexdigest()) for d, _ in members]
    return sorted(out, key=str)


def test_edge_rows_match_brute_force(edge_docs):
    want = brute([(r.doc_id, r.text) for r in edge_docs.collect()])
    assert sorted((tuple(r) for r in exact_dedup.content_groups(edge_docs).collect()), key=str) == want


def test_empty_table(no_docs):
    assert exact_dedup.content_groups(no_docs).count() == 0
    assert exact_dedup.drop_copies(no_docs).columns == no_docs.columns


def test_large_group_is_cut_into_runs(spark):
    docs = spark.range(4000).selectExpr("id AS doc_id", "if(id % 3 = 0, 'same text', concat('t', id % 900)) AS text")
    got = exact_dedup.content_groups(docs)
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute([(r.doc_id, r.text) for r in docs.collect()])


def test_drop_copies_keeps_columns_and_one_per_group(edge_docs):
    kept = exact_dedup.drop_copies(edge_docs)
    assert kept.columns == edge_docs.columns
    # one row of 2 (longest of its group, a repeated row), 5 of the blank texts, and the single ones
    assert sorted(r.doc_id for r in kept.collect()) == [2, 5, 6, 7, 8, 9]


def test_rows_that_share_an_id_or_have_none(spark):
    rows = [
        (1, "a b c", "x"), (1, "a b c", "x"),  # a row read twice
        (2, "a bc", "x"), (2, "own text", "y"),  # one id, two texts: the first is a copy of 1's
        (None, "lone", "n"), (None, "lo ne", "n"), (None, "lo ne", "m"),  # no id: the longest, then by columns
        (None, "abc", "n"), (3, "l o n e", "z"), (4, "one", "q"), (None, None, "e"), (None, "", "e"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, salt string")
    kept = exact_dedup.drop_copies(docs)
    assert kept.columns == docs.columns
    texts = sorted((r.doc_id or 0, r.text or "", r.salt) for r in kept.collect())
    assert texts == [(0, "", "e"), (1, "a b c", "x"), (2, "own text", "y"), (3, "l o n e", "z"), (4, "one", "q")]
    without = docs.where("doc_id IS NULL")
    assert sorted((r.text or "", r.salt) for r in exact_dedup.drop_copies(without).collect()) == [("", "e"), ("abc", "n"), ("lo ne", "m")]
