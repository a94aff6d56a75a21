import itertools
import zlib

import numpy as np
import pytest

from daybook.llm import packing
from daybook.llm.common import documents


@pytest.fixture(scope="module")
def public_tokenizer():
    import public_tokenizers as public
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public.path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    return t


def check(rows, docs, tokenizer):
    """Every id in exactly one piece, sequences gapless; returns the padding share."""
    want = {}
    for d, t in docs:
        ids = [*tokenizer.encode(t or "", add_special_tokens=False).ids, packing.END_ID]
        want.setdefault(d, []).append(np.array(ids, "<u4"))
    spans, seqs = {}, {}
    for r in rows:
        spans.setdefault(r.doc_id, []).append(r)
        seqs.setdefault(r.sequence_id, []).append((r.offset, r.length))
        assert r.length > 0
    assert set(spans) == set(want)
    for d, texts in want.items():
        for ids in {t.tobytes(): t for t in texts}.values():
            copies = sum(t.tobytes() == ids.tobytes() for t in texts)
            own = [r for r in spans[d] if r.doc_tokens == len(ids)]
            assert sum(r.length for r in own) >= copies * len(ids)
            for r in own:
                if len(texts) == copies:
                    assert zlib.crc32(ids[r.start : r.start + r.length].tobytes()) == r.ids_crc32
        if len(texts) == 1:
            at = 0
            for r in sorted(spans[d], key=lambda r: r.start):
                assert r.start == at
                at += r.length
            assert at == len(texts[0])
    padding = total = 0
    for parts in seqs.values():
        at = 0
        for o, n in sorted(parts):
            assert o == at
            at += n
        assert at <= packing.SEQ_LEN
        total += at
        padding += 0 if at & (at - 1) == 0 else packing.SEQ_LEN - at
    return padding / total


def test_whole_table(spark, sf_dir, public_tokenizer):
    docs = documents(spark, sf_dir)
    rows = packing.pack(docs, with_ids=True).collect()
    assert check(rows, [(r.doc_id, r.text) for r in docs.collect()], public_tokenizer) < 0.02
    assert all(zlib.crc32(r.ids) == r.ids_crc32 and len(r.ids) == 4 * r.length for r in rows)


def test_edges(edge_docs, no_docs, public_tokenizer):
    rows = packing.pack(edge_docs).collect()
    check(rows, [(r.doc_id, r.text) for r in edge_docs.collect()], public_tokenizer)
    assert packing.pack(no_docs).count() == 0


@pytest.mark.parametrize("text", [
    "", " ", "a", " a", "a ", "a  b", "a \n b", "\n\na b\n", "it's we'll  x", "1 234,5 .. !", "café  x", "a\x1cb c \x1d",
    "tab\t b", "a　b c", "<|endoftext|> x", "é ‍ z", "a   b c",
])
def test_piece_cache_gives_the_public_ids(text, public_tokenizer):
    got = np.frombuffer(packing.tokenizer("byte_bpe_50k.tiktoken").ids(text), "<u4").tolist()
    assert got == public_tokenizer.encode(text, add_special_tokens=False).ids


def test_cuts_are_the_cheapest(spark):
    rng = np.random.default_rng(3)
    for _ in range(60):
        n, seq_len = int(rng.integers(5, 12)), 10
        places = np.cumsum(rng.integers(1, 7, n))
        pens = rng.integers(0, 6, n)
        pens[-1] = 0

        def cost(cuts):
            c, at = 0, 0
            for i in cuts:
                size = places[i] - at
                if size > seq_len:
                    return None
                c, at = c + seq_len - size + pens[i], places[i]
            return c

        best = min(c for k in range(n) for x in itertools.combinations(range(n - 1), k) if (c := cost([*x, n - 1])) is not None)
        got = packing.best_cuts(places, pens, seq_len)
        assert cost([int(np.flatnonzero(places == p)[0]) for p in got]) == best


def test_order_is_kept(spark):
    docs = spark.createDataFrame([(i, "some words. " * (i % 50)) for i in range(300)], "doc_id long, text string").coalesce(1)
    rows = sorted(packing.pack(docs).collect(), key=lambda r: (r.sequence_id, r.offset))
    assert [r.doc_id for r in rows] == sorted(r.doc_id for r in rows)


def test_added_tokens_are_one_id_as_in_the_tokenizer_file(spark):
    import public_tokenizers as public
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public.path("byte_bpe_50k.json"))
    texts = ["a <|endoftext|> b", "<|endoftext|>", "<|endoftext|><|endoftext|>x", "one.\n\n<|endoftext|>\ntwo  <|endoftext|>", "a <|endoftext| > b",
             "long text. " * 900 + "<|endoftext|> more words here " * 50]
    rows = packing.pack(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    for i, text in enumerate(texts):
        own = sorted((r for r in rows if r.doc_id == i), key=lambda r: r.start)
        got = np.frombuffer(b"".join(r.ids for r in own), "<u4").tolist()
        assert got == [*t.encode(text, add_special_tokens=False).ids, packing.END_ID] and own[0].doc_tokens == len(got)
    assert t.encode(texts[0], add_special_tokens=False).ids == [64, 220, 50256, 275]


def test_pieces_point_into_the_stream(monkeypatch):
    """The ids of a run are handed on without a copy, and a worker gives back what it has freed."""
    import pyarrow as pa

    ids = [np.arange(1, n, dtype="<u4") for n in (1500, 3, 2, 700)]
    whole = np.concatenate(ids)
    cols, _ = packing.pack_run([1, 2, 3, 4], ids, np.zeros(2000, bool), 0, True)
    assert not ids and isinstance(cols[-1], pa.Array)
    data = cols[-1].buffers()[2]
    assert data.size == whole.nbytes and data.to_pybytes() == whole.tobytes()
    assert [zlib.crc32(x) for x in cols[-1].to_pylist()] == cols[3]
    assert [len(x) // 4 for x in cols[-1].to_pylist()] == cols[2].tolist()
    at = np.zeros(4, "<u4")
    first, second = packing.binary_pieces(at, np.array([1, 4])).to_pylist()
    assert (first, second) == (bytes(4), bytes(12))
    assert packing.pack_run([1], [at], np.zeros(2, bool), 0, False)[0][-1].null_count == 1


def test_freed_memory_is_given_back():
    """Small blocks freed under one that stays: the C library keeps them until asked."""
    import subprocess
    import sys

    code = """
import re
from daybook.llm.common import release
rss = lambda: int(re.search(r"RssAnon:\\s+(\\d+)", open("/proc/self/status").read())[1]) / 1024
some = [bytes(5000) for _ in range(30_000)]
last = bytes(5000)
del some
before = rss()
release()
print(before - rss())
"""
    got = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, check=True, env=_with_repo())
    assert float(got.stdout.split()[-1]) > 100


def _with_repo():
    import os

    return os.environ | {"PYTHONPATH": os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))}
