import itertools
import random
import re

import pytest

from daybook.llm import filter_audit as fa

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def fails(text):
    words = WORD.findall(text)
    return "".join(c for c, bad in (("A", len(words) < 200), ("B", 100 * len(set(words)) < 50 * len(words)),
                                    ("C", 100 * len(re.findall("[A-Z]", text)) > 3 * len(text)), ("D", re.search("[#$%&*|]", text))) if bad)


def brute(docs, labels):
    """docs: (doc_id, text, lang); every order applied document by document."""
    rows = [(d, t or "", p or "") for d, t, p in docs]
    no_id = lambda d: float("inf") if d is None else d
    first = {}
    for d, t, _ in rows:
        first[t] = min(first.get(t, float("inf")), no_id(d))
    good, bad = ({d for d, *v in labels if v[k] == 1} for k in (0, 1))
    fail = [(d, p, fails(t) + "E" * (no_id(d) > first[t])) for d, t, p in rows]
    out = {}
    for part in {p for _, p, _ in fail}:
        mine = [(d, f) for d, p, f in fail if p == part]
        removed = dict.fromkeys("ABCDE", 0)
        for order in itertools.permutations("ABCDE"):
            left = mine
            for step, c in enumerate(order, 1):
                gone = [d for d, f in left if c in f]
                seen = len([1 for _, f in mine if c in f])
                left = [x for x in left if c not in x[1]]
                removed[c] += len(gone)
                out[part, "".join(order), step] = [len(left), len(gone), seen - len(gone), len([1 for _, f in mine if f == c]),
                                                   len([d for d in gone if d in good]), len([d for d in gone if d in bad]), None, c]
        for key, v in out.items():
            if key[0] == part:
                v[6] = removed[v[7]]
    return {k: tuple(v) for k, v in out.items()}


def audit(docs, labels):
    rows = fa.interaction_audit(docs, labels)
    assert rows.columns[:3] == ["part", "filter_order", "step"]
    got = {tuple(r)[:3]: tuple(r)[3:] for r in rows.collect()}
    assert len(got) == rows.count()
    return got


LABELS = "doc_id long, quality int, toxic int, n string"


def test_whole_table_matches_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    want = brute([(r.doc_id, r.text, r.lang) for r in docs.collect()], [tuple(r) for r in labels.collect()])
    assert audit(docs, labels) == want


def test_edges(spark, edge_docs, no_docs):
    labels = spark.createDataFrame([(1, 1, 0, "x"), (2, 0, 1, "x"), (2, 1, 0, "x"), (None, 1, 1, "x"), (99, 1, 1, "x"), (4, None, None, None)], LABELS)
    want = brute([(r.doc_id, r.text, r.lang) for r in edge_docs.collect()], [tuple(r)[:3] for r in labels.where("doc_id IS NOT NULL").collect()])
    assert audit(edge_docs, labels) == want
    assert audit(no_docs, labels) == {}
    assert len(audit(edge_docs, labels.limit(0))) == len(want)


@pytest.mark.parametrize("window, ranges", [(200, 5000), (10**7, 3)])
def test_copies_under_common_prefixes(spark, monkeypatch, window, ranges):
    """Texts that share very long prefixes, a third of the rows in one group of copies, few or many ranges."""
    monkeypatch.setattr(fa, "WINDOW_BYTES", window)
    monkeypatch.setattr(fa, "RANGES", ranges)
    rng = random.Random(2)
    head = "a common head of many texts, longer than every prefix "
    texts = [head + str(rng.randint(0, 60)) for _ in range(200)] + ["hot"] * 200 + [f"{rng.randint(0, 99)} x#" for _ in range(200)] + ["", None, "\0", "\0\0"]
    rng.shuffle(texts)
    rows = [(i if rng.random() < 0.9 else None, t, rng.choice(["en", "de", None])) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(5)
    labels = spark.createDataFrame([(i, i % 2, i % 3, "") for i in range(0, 600, 2)], LABELS)
    assert audit(docs, labels) == brute(rows, [(i, i % 2, i % 3) for i in range(0, 600, 2)])


def test_boundaries_grow_with_the_data(spark):
    texts = [(f"same beginning of all, then {i:04d}".encode(),) for i in range(500)] + [(b"z%d" % i,) for i in range(10)]
    bounds = fa.boundaries(spark.createDataFrame(texts, "text binary"), 16)
    assert bounds == sorted(bounds) and max(map(len, bounds)) == fa.LONGEST
    slots = [fa.slot_of(t, bounds, 1) for t, in texts]
    counts = [slots.count(s) for s in set(slots)]
    assert len(counts) >= 8 and max(counts) <= 150
    assert fa.boundaries(spark.createDataFrame([], "text binary"), 16) == []


def test_trie_against_a_dictionary():
    rng = random.Random(1)
    trie, least = fa.Trie(), {}
    for _ in range(5000):
        text = bytes(rng.choice(b"ab") for _ in range(rng.randint(0, 9))) * rng.randint(0, 30)
        i = rng.randint(0, 10**6)
        list(trie.add(trie.place(text), i, "", 1))
        least[text] = min(i, least.get(text, i))
    assert {t: n.least for t, n in trie.walk()} == least
