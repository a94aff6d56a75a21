import base64
import math
import random
import string
import zlib

import numpy as np
from pyspark.sql import functions as F

from daybook.llm import langid
from daybook.llm.common import documents
from daybook.llm.queries import op10_language_id


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    truth = {r.doc_id: r.lang for r in documents(spark, sf).select("doc_id", "lang").collect()}
    rows = op10_language_id(spark, sf).collect()
    held = [r for r in rows if r.held_out and r.lang_pred != langid.UND]
    assert len(rows) == len(truth) and len(held) > 100
    assert sum(truth[r.doc_id] == r.lang_pred for r in held) / len(held) > 0.95
    assert sum(r.rejected for r in rows) < 0.02 * len(rows)
    assert all(0 <= r.score <= 1 for r in rows)


def test_edges(edge_docs, no_docs, spark):
    model = langid.fit(edge_docs)
    got = {(r.doc_id, r.text): r for r in langid.identify(edge_docs, model).collect()}
    for (_, text), r in got.items():
        letters = any(ch.isalpha() for ch in text or "")
        assert (r.lang_pred == "und") == (not letters)
        assert letters or r.lang_rejected and r.lang_score == 0
    out = langid.identify(no_docs, model)
    assert out.count() == 0 and out.columns == [*no_docs.columns, "lang_pred", "lang_score", "lang_rejected"]
    nothing = langid.fit(no_docs)
    assert {r.lang_pred for r in langid.identify(edge_docs, nothing).collect()} == {"und"}


def test_text_far_from_every_centroid_is_rejected(spark):
    rows = [(i, "the quick brown fox jumps over the lazy dog and then some more words " * 3, "en") for i in range(30)]
    model = langid.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    docs = spark.createDataFrame([(1, "the quick fox"), (2, "中文字符串测试")], "doc_id long, text string")
    got = {r.doc_id: r.lang_rejected for r in langid.identify(docs, model).collect()}
    assert got == {1: False, 2: True}


def test_training_never_sees_held_out_rows(spark, sf_dir):
    docs = documents(spark, sf_dir)
    changed = docs.withColumn("lang", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, "zz").otherwise(F.col("lang")))
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    assert "zz" not in langid.fit(changed, train=~held).langs


# Latin-script texts that no centroid is learned from
FINNISH = "kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan heille on annettu järki ja omatunto ja heidän on toimittava toisiaan kohtaan veljeyden hengessä"
POLISH = "wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw są oni obdarzeni rozumem i sumieniem i powinni postępować wobec innych w duchu braterstwa"
CODE = "for (int i = 0; i < size; i++) { if (buffer[i] == NULL) return malloc(sizeof(struct node)); fprintf(stderr, ptr->next); } static void init(const char *argv) { while (queue.empty()) pop(); }"


def test_unlearned_latin_texts_are_rejected_and_held_out_clean_ones_stay(spark):
    sf = "/root/testdata/sf0.1"
    rng = random.Random(5)
    letters = ["".join(rng.choice(string.ascii_lowercase + "   ") for _ in range(n)) for n in (40, 100, 400, 4000)]
    junk = [FINNISH, POLISH, CODE, FINNISH[:50], POLISH[:50], base64.b64encode(rng.randbytes(600)).decode(), *letters]
    docs = documents(spark, sf)
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    model = langid.fit(docs, train=~held)
    bad = langid.identify(spark.createDataFrame(list(enumerate(junk)), "doc_id long, text string"), model).collect()
    assert [r.text for r in bad if not r.lang_rejected] == []
    clean = docs.where(held).join(spark.read.parquet(f"{sf}/labels.parquet").where("quality = 1"), "doc_id").select(*docs.columns)
    rows = langid.identify(clean, model).collect()
    assert len(rows) > 500 and sum(r.lang_rejected for r in rows) <= 0.01 * len(rows)


def test_rows_of_one_id_do_not_widen_the_sample(spark):
    texts = [f"number {i} of the many rows that share one id and one language with each other" for i in range(900)]
    rows = [(7, t, "en") for t in texts] + [(i, f"un texte numero {i} en langue claire pour apprendre", "fr") for i in range(30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(5)
    fits = [langid.fit(d, per_lang=50) for d in (docs, docs.repartition(2, "text"))]
    for model in fits:
        learned = np.exp(model.idf.max() - 1) - 1  # a bucket that no text has
        assert round(float(learned)) == 50 + 30
    assert np.array_equal(fits[0].centroids, fits[1].centroids)


def brute_vector(text):
    """Sparse sqrt counts, from the text's bytes one by one."""
    codes = []
    for byte in text.encode():
        letter = chr(byte).lower() if byte < 128 else ""
        code = ord(letter) - 96 if letter and "a" <= letter <= "z" else byte - 128 + 27 if byte >= 128 else 0
        if code or not codes or codes[-1]:
            codes.append(code)
    codes = [0, *codes, 0]
    counts = {}
    for at in range(len(codes) - 1):
        grams = [codes[at] * 155 + codes[at + 1] + 1000]
        if at + 2 < len(codes):
            grams.append((codes[at] * 155 + codes[at + 1]) * 155 + codes[at + 2] + 100_000)
        for g in grams:
            bucket = (g % 2**32 * 2654435761 % 2**32) >> 20
            counts[bucket] = counts.get(bucket, 0) + 1
    return {b: n**0.5 for b, n in counts.items()}


def scaled(vector):
    length = sum(x * x for x in vector.values()) ** 0.5
    return {b: x / length for b, x in vector.items()}


def cosine(a, b):
    return sum(x * b[k] for k, x in a.items() if k in b)


def middle(vectors):
    total = {}
    for v in vectors:
        for b, x in v.items():
            total[b] = total.get(b, 0) + x
    return scaled(total)


def brute_centroids(vectors):
    cents = [middle(vectors)]
    while len(cents) < min(langid.CENTROIDS, len(vectors)):
        cents.append(min(vectors, key=lambda v: max(cosine(v, c) for c in cents)))
    for _ in range(langid.ROUNDS):
        near = [max(range(len(cents)), key=lambda j: cosine(v, cents[j])) for v in vectors]
        cents = [middle([v for v, j in zip(vectors, near) if j == i]) if i in near else c for i, c in enumerate(cents)]
    return cents


def test_query_against_brute_force_centroids(spark, tmp_path):
    """The registered query on a small whole table: every language and score computed again without numpy."""
    rows = documents(spark, "/root/testdata/sf0.001").orderBy("doc_id").limit(150).collect()
    docs = spark.createDataFrame(rows, documents(spark, "/root/testdata/sf0.001").schema)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    train = [r for r in rows if r.lang is not None and r.text is not None and zlib.crc32(str(r.doc_id).encode()) % 5]
    raw = [(r.lang, brute_vector(r.text)) for r in train]
    seen = {}
    for _, v in raw:
        for b in v:
            seen[b] = seen.get(b, 0) + 1
    idf = lambda b: math.log((1 + len(raw)) / (1 + seen.get(b, 0))) + 1
    weigh = lambda v: scaled({b: x * idf(b) for b, x in v.items()})
    cents = {lang: brute_centroids([weigh(v) for name, v in sorted(raw, key=lambda t: t[0]) if name == lang]) for lang in {n for n, _ in raw}}
    texts = {r.doc_id: r.text for r in rows}
    for r in op10_language_id(spark, str(tmp_path)).collect():
        v = weigh(brute_vector(texts[r.doc_id]))
        near = {lang: max(cosine(v, c) for c in cs) for lang, cs in cents.items()}
        best = max(near.values())
        # the seeds of the clusters follow the order of the rows, so single scores may differ by a cluster
        assert near[r.lang_pred] >= best - 0.02 and abs(r.score - best) < 0.05, (r, near)
