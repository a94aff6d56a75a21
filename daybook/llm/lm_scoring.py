"""Language-model scores from a distributed Elias-Fano bigram trie.

Tokens: lower-cased (A-Z) words, and one end per document, which is also the context of the first
word.  The model interpolates with a Dirichlet prior,

    p(w | h) = (c(h, w) + MU * p(w)) / (c(h) + MU),

where p(w) is the unigram level: (c(w) - D) / N for a known word and D * V / N for any unknown one,
D = n1 / (n1 + 2 n2) from the numbers of words seen once and twice.  Both sum to 1 over the known words
and "unknown".

1. Each chunk sends its distinct words with training counts to word shards, which number them (in each
   shard by descending count) and answer with number and count; every answer also holds the shard's
   share of N, V, n1, n2.
2. Each chunk sends its distinct word pairs with training counts to context shards.  A context shard adds
   them up, builds the trie of its contexts (monotone pointers, successors as context-relative ascending
   sequences, smoothed probabilities c(h, w) / (c(h) + MU) quantised to ``LEVELS`` steps), and answers
   every pair by successor search.  A context with a large share of all tokens is spread over several
   shards by its successors, since c(h) comes with the question.
3. Each chunk adds up its documents.

All counts are over all training documents; the model is never gathered or broadcast, and grows with
the corpus in the shards.  Words are identified by 64-bit hash.

Defined cases: null and empty texts are one token, the end; a null id counts as training (remainder 0);
without training documents every score is 0; repeated rows count as rows; other columns are ignored.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.llm.chunks import CHUNK_BYTES, MESSAGE, TO_SHARD, answers, by_shard, deal, in_order, messages, words_in
from daybook.llm.elias_fano import BigramTrie
from daybook.llm.minmax_dedup import mix

MU = 30.0
FOLDS, HELD_OUT = 7, 2
LEVELS = 4096
DECADES = 14.0
END = np.uint64(xxhash.xxh3_64_intdigest(b" "))


def pack_ints(*arrays: np.ndarray) -> bytes:
    """Non-negative integers in their least width, bytes of one significance together, compressed."""
    raw = [np.array([len(arrays), *(len(a) for a in arrays)], "<i8").tobytes()]
    for a in arrays:
        top = int(a.max()) if len(a) else 0
        width = next(w for w in (1, 2, 4, 8) if top < 1 << 8 * w)
        raw.append(bytes([width]) + np.ascontiguousarray(a.astype(f"<u{width}").view(np.uint8).reshape(-1, width).T).tobytes())
    return zstandard.ZstdCompressor(level=1).compress(b"".join(raw))


def unpack_ints(blob: bytes) -> list[np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(blob)
    k = int(np.frombuffer(raw, "<i8", 1)[0])
    sizes, at, out = np.frombuffer(raw, "<i8", k, 8).tolist(), 8 + 8 * k, []
    for n in sizes:
        width = raw[at]
        planes = np.frombuffer(raw, np.uint8, n * width, at + 1).reshape(width, n)
        out.append(np.ascontiguousarray(planes.T).view(f"<u{width}").reshape(-1).astype(np.uint64))
        at += 1 + n * width
    return out


def quantise(p: np.ndarray) -> np.ndarray:
    """1 .. LEVELS for probabilities; 0 stands for none."""
    return (1 + np.clip(np.round(-np.log10(p) * ((LEVELS - 1) / DECADES)), 0, LEVELS - 1)).astype(np.uint16)


def restore(codes: np.ndarray) -> np.ndarray:
    return np.where(codes > 0, 10.0 ** (-(codes.astype(np.float64) - 1) * (DECADES / (LEVELS - 1))), 0.0)


def is_held_out(doc_id: int | None) -> bool:
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % FOLDS == HELD_OUT


class Tokens:
    """A chunk's tokens, end to end: ``word`` is each token's place among the distinct ``hashes``."""

    def __init__(self, table: pa.Table):
        self.ids, texts = in_order(table)
        sizes, codes, known = words_in([t.lower() for t in texts])
        self.sizes = sizes + 1
        self.begins = np.cumsum(self.sizes) - self.sizes
        inner = np.ones(int(self.sizes.sum()), bool)
        inner[self.begins + self.sizes - 1] = False
        # the end comes after the vocabulary
        self.hashes, place = np.unique(np.append(known, END), return_inverse=True)
        self.word = np.full(len(inner), place[-1])
        self.word[inner] = place[codes]
        self.held_out = np.array([is_held_out(i) for i in self.ids], bool)
        self.train = np.repeat(~self.held_out, self.sizes)
        self.counts = np.bincount(self.word, self.train, len(self.hashes)).astype(np.uint64)

    def pairs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Distinct (context, word) by place; training counts; each token's pair."""
        before = np.empty_like(self.word)
        before[1:] = self.word[:-1]
        before[self.begins] = np.searchsorted(self.hashes, END)
        n = len(self.hashes)
        key, pair = np.unique(before * n + self.word, return_inverse=True)
        return key // n, key % n, np.bincount(pair, self.train, len(key)).astype(np.uint64), pair


class Told:
    """What the word shards answered: number and count per distinct word; and the totals N, V, n1, n2."""

    def __init__(self, by: dict[int, bytes], order: np.ndarray, bounds: np.ndarray, totals: np.ndarray):
        self.number, self.count = np.zeros(len(order), np.uint64), np.zeros(len(order), np.uint64)
        self.totals = totals
        for s, blob in by.items():  # empty for a chunk that has them already
            number, count = unpack_ints(blob)
            o = order[bounds[s] : bounds[s + 1]]
            self.number[o], self.count[o] = number, count


def _send_words(n: int):
    def run(table: pa.Table) -> pa.Table:
        t, chunk = Tokens(table), table.column("chunk")[0].as_py()
        order, bounds = by_shard(t.hashes, n)
        # only shards that hold one of the words, so that messages grow with the words
        asked = np.flatnonzero(np.diff(bounds)).tolist()
        return messages([(chunk, s, pack_ints(t.hashes[o], t.counts[o])) for s in asked for o in (order[bounds[s] : bounds[s + 1]],)])

    return run


def _counted(table: pa.Table) -> tuple[list[int], np.ndarray, np.ndarray, np.ndarray]:
    """Of a word shard: words per message, its distinct words, each question's place among them, their counts."""
    parts = [unpack_ints(b) for b in table.column("blob").to_pylist()]
    words, at = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
    counts = np.zeros(len(words), np.uint64)
    np.add.at(counts, at, np.concatenate([p[1] for p in parts]))
    return [len(p[0]) for p in parts], words, at, counts


def _number(n: int):
    def run(table: pa.Table) -> pa.Table:
        chunks, shard = table.column("chunk").to_pylist(), table.column("shard")[0].as_py()
        sizes, words, at, counts = _counted(table)
        rank = np.empty(len(words), np.uint64)
        rank[np.lexsort((words, -counts.astype(np.int64)))] = np.arange(len(words), dtype=np.uint64)
        number, count = (rank * np.uint64(n) + np.uint64(shard))[at], counts[at]
        ends = np.cumsum(sizes)
        return messages([(c, shard, pack_ints(number[e - k : e], count[e - k : e])) for c, k, e in zip(chunks, sizes, ends)])

    return run


TOTALS = ("total", "known", "once", "twice")


def _totals(table: pa.Table) -> pa.Table:
    """A word shard's share of N, V, n1, n2."""
    *_, counts = _counted(table)
    share = (counts.sum(), (counts > 0).sum(), (counts == 1).sum(), (counts == 2).sum())
    return pa.table({name: pa.array([int(v)], pa.int64()) for name, v in zip(TOTALS, share)})


def _context_shard(number: np.ndarray, follower: np.ndarray, count: np.ndarray, total: int, n: int) -> np.ndarray:
    """Hash of the context, and for one that holds over half a shard's share of a part of its successors."""
    parts = np.uint64(1) + (np.uint64(2 * n) * count) // np.uint64(max(1, total))
    return mix(number * np.uint64(2 * n + 2) + mix(follower) % parts)


def _ask(t: Tokens, told: Told, n: int):
    """Distinct pairs in the order in which they are asked: by shard, context number, word number."""
    context, word, count, pair = t.pairs()
    a, b, c = told.number[context], told.number[word], told.count[context]
    key = _context_shard(a, b, c, int(told.totals[0]), n)
    shard = (key % np.uint64(n)).astype(np.int64)
    order = np.lexsort((b, a, shard))
    return order, np.searchsorted(shard[order], np.arange(n + 1)), a, b, c, count, context, word, pair


def _send_pairs(n: int):
    def run(docs: pa.Table, table: pa.Table) -> pa.Table:
        if not docs.num_rows:
            return messages([])
        t, chunk = Tokens(docs), docs.column("chunk")[0].as_py()
        told = Told(answers(table), *by_shard(t.hashes, n), np.array(table.column("totals")[0].as_py(), np.uint64))
        order, bounds, a, b, c, count, *_ = _ask(t, told, n)
        rows = [(chunk, -1 - chunk % n, pack_ints(told.number, told.count, told.totals))]  # comes back with the answers
        for s in range(n):
            o = order[bounds[s] : bounds[s + 1]]
            if len(o):
                new = np.ones(len(o), bool)
                new[1:] = a[o][1:] != a[o][:-1]
                at = np.flatnonzero(new)
                rows.append((chunk, s, pack_ints(np.diff(a[o][at], prepend=np.uint64(0)), np.diff(np.append(at, len(o))), c[o][at], b[o], count[o])))
        return messages(rows)

    return run


def build_trie(context: np.ndarray, word: np.ndarray, count: np.ndarray, context_count: np.ndarray) -> BigramTrie:
    """Of training pairs, which may repeat (their counts add up)."""
    order = np.lexsort((word, context))
    c, w = context[order].astype(np.int64), word[order].astype(np.int64)
    new = np.ones(len(c), bool)
    new[1:] = (c[1:] != c[:-1]) | (w[1:] != w[:-1])
    begins = np.flatnonzero(new)
    total = np.add.reduceat(count[order], begins).astype(np.float64) if len(begins) else np.zeros(0)
    seen = total > 0
    at = begins[seen]
    return BigramTrie.build(c[at], w[at], quantise(total[seen] / (context_count[order][at].astype(np.float64) + MU)))


def _answer_pairs(table: pa.Table) -> pa.Table:
    chunks, shards, blobs = (table.column(c).to_pylist() for c in ("chunk", "shard", "blob"))
    out = [(c, -1, b) for c, s, b in zip(chunks, shards, blobs) if s < 0]
    asked = []
    for c, s, b in zip(chunks, shards, blobs):
        if s >= 0:
            gaps, runs, held, word, count = unpack_ints(b)
            runs = runs.astype(np.int64)
            asked.append((c, s, np.repeat(np.cumsum(gaps), runs), word, count, np.repeat(held, runs)))
    if asked:
        train = [a[4] > 0 for a in asked]
        trie = build_trie(*(np.concatenate([a[k][m] for a, m in zip(asked, train)]) for k in (2, 3, 4, 5)))
        trie = BigramTrie.from_buffer(trie.to_bytes())
        for c, s, context, word, *_ in asked:
            out.append((c, s, pack_ints(trie.lookup(context.astype(np.int64), word.astype(np.int64)))))
    return messages(out)


RESULT = ("doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")


def _score(n: int):
    schema = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()),
                        ("train_tokens", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64())])

    def run(docs: pa.Table, table: pa.Table) -> pa.Table:
        if not docs.num_rows:
            return schema.empty_table()
        t, by = Tokens(docs), answers(table)
        number, count, totals = unpack_ints(by.pop(-1))
        told = Told({}, *by_shard(t.hashes, n), totals)
        told.number, told.count = number, count
        tokens, known, distinct, once, twice = t.word, told.count > 0, int(told.totals[1]), int(told.totals[2]), int(told.totals[3])
        total, count = int(told.totals[0]), told.count.astype(np.float64)
        off = once / (once + 2 * twice) if once and twice else 0.5
        single = np.where(known, count - off, off * distinct) / total if total else np.ones(len(count))
        order, bounds, _, _, _, _, context, word, pair = _ask(t, told, n)
        codes = np.zeros(len(order), np.uint16)
        for s, blob in by.items():
            codes[order[bounds[s] : bounds[s + 1]]] = unpack_ints(blob)[0]
        log_p = np.log10(restore(codes) + MU / (count[context] + MU) * single[word])
        base = np.log10((count + 1) / (total + 1 * (distinct + 1)))
        add = lambda x: np.add.reduceat(x, t.begins)
        return pa.table([
            pa.array(t.ids, pa.int64()), pa.array(t.held_out), pa.array(t.sizes), pa.array(add(known[tokens].astype(np.int64))),
            pa.array(np.full(len(t.ids), total, np.int64)), pa.array(add(base[tokens])), pa.array(add(log_p[pair]))], schema=schema)

    return run


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """One row per document: held_out, n_tokens, n_known, train_tokens, base_score, score (log10)."""
    dealt, n = deal(docs, id_col, text_col, chunk_bytes)
    by_chunk = dealt.groupBy("chunk")
    by_word_shard = by_chunk.applyInArrow(_send_words(n), MESSAGE).groupBy("shard")
    shares = by_word_shard.applyInArrow(_totals, ", ".join(f"{name} long" for name in TOTALS))
    # one row of four numbers, as a scalar subquery over the same exchange
    totals = shares.agg(F.array(*(F.coalesce(F.sum(name), F.lit(0)) for name in TOTALS)).alias("totals"))
    words = by_word_shard.applyInArrow(_number(n), MESSAGE).withColumn("totals", totals.scalar())
    asked = by_chunk.cogroup(words.groupBy("chunk")).applyInArrow(_send_pairs(n), MESSAGE)
    told = asked.selectExpr("*", TO_SHARD).groupBy("to_shard").applyInArrow(_answer_pairs, MESSAGE)
    return dealt.groupBy("chunk").cogroup(told.groupBy("chunk")).applyInArrow(_score(n), RESULT)
