import math
import re
from collections import Counter, defaultdict

import pytest

from daybook.llm import quality
from daybook.llm.common import documents
from daybook.llm.queries import op6_divergence


def base(text):
    text = text or ""
    words = [w.decode() for w in text.encode().split()]
    seen, dup = set(), 0
    for line in text.split("\n"):
        if line.encode().split():
            dup += line in seen
            seen.add(line)
    at = defaultdict(list)
    for i in range(len(words) - 4):
        at[tuple(words[i : i + 5])].append(i)
    covered = {i + k for v in at.values() if len(v) > 1 for i in v for k in range(5)}
    n = len(words)
    return (n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered), n < 10 or 100 * len(covered) > 20 * n)


def histograms(text):
    text = text or ""
    c = Counter()
    for ch in text:
        c["a" if "a" <= ch <= "z" else " " if ch in " \t\n\v\f\r" else "A" if "A" <= ch <= "Z" else "0" if "0" <= ch <= "9" else "." if ch in ".,;:!?'\"()-"
          else "#" if ch in "#*$%&|<>" else "l" if ch.isalpha() else "o"] += 1
    w = Counter(x.decode().lower() for x in text.encode().split())
    return [c[k] for k in "a A0.#ol"], [w[k] for k in quality.common_words()]


def distance(p, q):
    if not sum(p) or not sum(q):
        return None
    p, q = [x / sum(p) for x in p], [x / sum(q) for x in q]
    kl = lambda a: sum(x * math.log2(2 * x / (x + y)) for x, y in a if x)
    return math.sqrt(max(0, kl(zip(p, q)) + kl(zip(q, p))) / 2)


def brute(rows):
    refs = defaultdict(lambda: ([0] * 8, [0] * len(quality.common_words())))
    hists = [histograms(t) for _, t, _ in rows]
    for (_, _, lang), h in zip(rows, hists):
        for key in {lang, None}:
            for i in (0, 1):
                refs[key][i][:] = [a + b for a, b in zip(refs[key][i], h[i])]
    out = []
    for (d, t, lang), h in zip(rows, hists):
        b = base(t)
        c = distance(h[0], refs[lang][0]) if sum(h[0]) >= quality.MIN_CHARS else None
        w = distance(h[1], refs[lang][1]) if sum(h[1]) >= quality.MIN_COMMON else None
        fine = (c or 0) <= quality.MAX_CLASS_DISTANCE and (w or 0) <= quality.MAX_WORD_DISTANCE
        out.append((d, *b[:5], b[5], c, w, not b[5] and fine))
    return out


def same(got, rows):
    got, want = sorted(map(tuple, got), key=str), sorted(brute(rows), key=str)
    assert len(got) == len(want)
    for a, b in zip(got, want):
        assert a[:7] == b[:7] and a[9] == b[9], (a, b)
        assert a[7:9] == pytest.approx(b[7:9], abs=1e-9)


def test_whole_table_matches_brute_force(spark, sf_dir):
    docs = documents(spark, sf_dir)
    same(quality.judge(docs).collect(), [(r.doc_id, r.text, r.lang) for r in docs.collect()])


def test_edges(edge_docs, no_docs, spark):
    docs = edge_docs.drop("kept").unionByName(spark.createDataFrame(
        [(20, "a b c d e a b c d e f\n\na b\na b\n \n x", "en", "s", 0, "n", 1, 2)], edge_docs.drop("kept").schema))
    same(quality.judge(docs).collect(), [(r.doc_id, r.text, r.lang) for r in docs.collect()])
    assert quality.judge(no_docs).count() == 0


def test_clean_documents_stay_and_noise_goes(spark):
    docs = documents(spark, "/root/testdata/sf0.01")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    rows = quality.judge(docs).join(labels, "doc_id").collect()
    clean = [r for r in rows if r.quality == 1]
    assert sum(r.kept or r.base_failed for r in clean) >= 0.99 * len(clean)


def test_labelled_noise_goes_and_clean_documents_stay(spark):
    sf = "/root/testdata/sf0.1"
    rows = op6_divergence(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").collect()
    judged = [r for r in rows if not r.base_failed and r.n_words >= quality.MIN_JUDGED]
    noise, clean = [r for r in judged if r.quality == 0], [r for r in judged if r.quality == 1]
    assert len(noise) > 250 and len(clean) > 2500
    assert sum(r.kept for r in noise) <= 0.02 * len(noise)
    assert sum(r.kept for r in clean) >= 0.99 * len(clean)
    assert all(r.word_distance is not None for r in judged)


def test_words_come_from_the_corpus_and_others_count(spark):
    ours = "ja on ei se että hän oli mutta kun niin".split()
    text = lambda i: " ".join(w for k in range(30) for w in (ours[(i + k) % 10], f"sana{i}x{k}"))
    rows = [(i, text(i), lang) for i in range(60) for lang in ("fi", None)]
    rows += [(100, " ".join(f"zq{k}" for k in range(300)), "fi"), (101, " ".join(f"zq{k}" for k in range(300)), None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    top = {r.top_lang: r.top for r in quality.top_words(docs).collect()}
    assert set(top) == {"fi", None} and set(top["fi"][:10]) == set(top[None][:10]) == set(ours)
    got = quality.judge(docs, corpus_words=True).collect()
    assert len(got) == 122 and {r.doc_id for r in got if not r.kept} == {100, 101}


def test_edges_with_corpus_words(edge_docs, no_docs):
    got = quality.judge(edge_docs, corpus_words=True)
    assert got.columns == quality.judge(edge_docs).columns
    assert got.count() == edge_docs.count() and quality.judge(no_docs, corpus_words=True).count() == 0
