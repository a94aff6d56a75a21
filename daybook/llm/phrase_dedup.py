"""Removal of repeated passages with phrase automata.

A window is ``WINDOW`` consecutive words.  A word goes when a window over it has its word sequence
also starting earlier (smaller id, or the same document and an earlier start).

1. Anchors: in each window the ``ANCHOR``-word phrase with the smallest hash.  Equal windows have equal
   anchors, and neighbouring windows mostly share theirs, so a sixth of the phrases is sent.  Shards
   confirm which anchors recur anywhere.
2. Each chunk compiles the phrases that recur into Aho-Corasick automata over words (shards of
   at most ``AUTOMATON_PHRASES`` phrases) and streams all its documents through them.  Every place
   of a recurring phrase is found by its words, and the windows around these places are candidates.
3. Candidates go to shards by a 96-bit digest, one row per distinct window and chunk with its first place
   there; the shard tells each chunk whether that place is the first of all.  All other places
   of the window are repeats, and the words that they cover are removed.

Defined cases: null and empty texts have no words; texts shorter than a window keep all words; a null id
counts as later than any other; rows with the same id and start are equally early, so neither removes
the other; other columns are ignored.
"""

from __future__ import annotations

import hashlib

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from daybook.llm.chunks import CHUNK_BYTES, MESSAGE, TO_SHARD, answers, by_shard, deal, in_order, messages, words_in
from daybook.llm.minmax_dedup import mix

WINDOW = 20
ANCHOR = 10
AUTOMATON_PHRASES = 40_000
RADIX = 64
FIRST_LETTER = 0x100
SEPARATOR = " "
NULL_ID = 2**63 - 1
_C = np.uint64(0x9E3779B97F4A7C15)
_C2 = np.uint64(0xD6E8FEB86659FD93)
_NO = np.uint64(2**64 - 1)


def rolling(a: np.ndarray, n: int, c: np.uint64) -> np.ndarray:
    """Hash of every run of ``n``: runs of powers of two by doubling, then joined."""
    out, have, run, size = None, 0, a, 1
    while True:
        if n & size:
            out = run if out is None else out[: len(a) - have - size + 1] * _power(c, size) + run[have : len(a) - size + 1]
            have += size
        if have == n:
            return mix(out)
        run = run[: len(a) - 2 * size + 1] * _power(c, size) + run[size : len(a) - size + 1]
        size *= 2


def _power(c: np.uint64, n: int) -> np.uint64:
    return np.uint64(pow(int(c), n, 2**64))


def sliding_min(v: np.ndarray, n: int) -> np.ndarray:
    size, run = 1, v
    while 2 * size <= n:
        run = np.minimum(run[: len(run) - size], run[size:])
        size *= 2
    return np.minimum(run[: len(v) - n + 1], run[n - size : len(v) - size + 1])


def spell(codes: np.ndarray, n_words: int, doc: np.ndarray, n_docs: int) -> tuple[str, int]:
    """All words, end to end, as a text of so many letters a word, with one separator after each document.

    Each place in a word has an alphabet of its own: nodes of an automaton over such words have few
    children, and a match begins with a word.
    """
    letters = 1
    while RADIX**letters < n_words:
        letters += 1
    text = np.full(len(codes) * letters + n_docs, ord(SEPARATOR), "<u2")
    at = np.arange(len(codes)) * letters + doc
    for i in range(letters):
        text[at + i] = FIRST_LETTER + i * RADIX + codes // RADIX ** (letters - 1 - i) % RADIX
    return text.tobytes().decode("utf-16-le"), letters


class Chunk:
    """The words of a chunk in order of (id, start), laid end to end."""

    def __init__(self, table: pa.Table):
        self.ids, self.texts = in_order(table)
        self.sizes, self.codes, known = words_in(self.texts)
        self.begins = np.cumsum(self.sizes) - self.sizes
        self.hashes, self.n_words = known[self.codes], len(known)
        self.n = len(self.codes)

    def starts_within(self, n: int) -> np.ndarray:
        """Flags of the places where ``n`` words of one document begin."""
        ok = np.zeros(max(0, self.n - n + 1), bool)
        edge = np.zeros(self.n + 1, np.int64)
        long = self.sizes >= n
        np.add.at(edge, self.begins[long], 1)
        np.add.at(edge, (self.begins + self.sizes - n + 1)[long], -1)
        ok[:] = np.cumsum(edge[: len(ok)]) > 0
        return ok

    def anchors(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Distinct anchor hashes, whether each occurs twice here, a place of each."""
        phrase = rolling(self.hashes, ANCHOR, _C)
        phrase[~self.starts_within(ANCHOR)] = _NO
        window = self.starts_within(WINDOW)
        least = np.unique(sliding_min(phrase, WINDOW - ANCHOR + 1)[window])
        value, place, count = np.unique(phrase, return_index=True, return_counts=True)
        at = np.searchsorted(value, least)
        return least, count[at] > 1, place[at]

    def located(self, places: np.ndarray) -> np.ndarray:
        """Flags of the windows that hold one of the phrases at ``places``, by automata over words."""
        doc = np.repeat(np.arange(len(self.sizes)), self.sizes)
        text, letters = spell(self.codes, self.n_words, doc, len(self.sizes))
        starts, long = places * letters + doc[places], ANCHOR * letters
        found: list[int] = []
        for at in range(0, len(places), AUTOMATON_PHRASES):
            automaton = ahocorasick.Automaton(ahocorasick.STORE_LENGTH)
            for p in starts[at : at + AUTOMATON_PHRASES].tolist():
                automaton.add_word(text[p : p + long])
            automaton.make_automaton()
            found.extend([end for end, _ in automaton.iter(text)])
        # back to words: one separator follows each document
        ends = np.cumsum(self.sizes * letters + 1)
        end = np.array(found, np.int64)
        end -= np.searchsorted(ends, end, side="right")
        begin = (end + 1) // letters - ANCHOR
        edge = np.zeros(self.n + 2, np.int64)
        np.add.at(edge, np.maximum(0, begin - (WINDOW - ANCHOR)), 1)
        np.add.at(edge, begin + 1, -1)
        window = self.starts_within(WINDOW)
        return (np.cumsum(edge)[: len(window)] > 0) & window

    def candidates(self, flags: np.ndarray):
        """Places of the flagged windows; their digests; for each its number among the distinct ones
        (numbered by first place); ids and starts."""
        at = np.flatnonzero(flags)
        one, two = rolling(self.hashes, WINDOW, _C)[at], (rolling(mix(self.hashes), WINDOW, _C2)[at] >> np.uint64(32)).astype(np.uint32)
        order = np.argsort(one, kind="stable")
        new = np.ones(len(at), bool)
        new[1:] = np.diff(one[order]) != 0
        if (np.diff(two[order].astype(np.int64))[~new[1:]] != 0).any():  # 64 bits don't tell all apart
            order = np.lexsort((at, two, one))
            new[1:] = (np.diff(one[order]) != 0) | (np.diff(two[order].astype(np.int64)) != 0)
        first = order[new]
        group = np.empty(len(at), np.int64)
        group[order] = np.cumsum(new) - 1
        rank = np.argsort(first, kind="stable")
        number = np.empty(len(first), np.int64)
        number[rank] = np.arange(len(first))
        doc = np.searchsorted(self.begins + self.sizes, at, side="right")
        ids = np.array([NULL_ID if i is None else i for i in self.ids], np.int64)
        return at, one, two, first[rank], number[group], ids[doc] if len(at) else np.zeros(0, np.int64), at - self.begins[doc] if len(at) else at


def _send_anchors(n: int):
    def run(table: pa.Table) -> pa.Table:
        c, chunk = Chunk(table), table.column("chunk")[0].as_py()
        if c.n < WINDOW:
            return messages([])
        value, twice, _ = c.anchors()
        order, bounds = by_shard(value, n)
        return messages([(chunk, s, value[o].tobytes() + twice[o].tobytes())
                         for s in range(n) if len(o := order[bounds[s] : bounds[s + 1]])])

    return run


def _confirm(table: pa.Table) -> pa.Table:
    """Per chunk and anchor: does it recur anywhere?"""
    chunks, shard, blobs = table.column("chunk").to_pylist(), table.column("shard")[0].as_py(), table.column("blob").to_pylist()
    sizes = [len(b) // 9 for b in blobs]
    value = np.concatenate([np.frombuffer(b, np.uint64, k) for b, k in zip(blobs, sizes)])
    twice = np.concatenate([np.frombuffer(b, bool, k, 8 * k) for b, k in zip(blobs, sizes)])
    _, at, count = np.unique(value, return_inverse=True, return_counts=True)
    recurs = ((count > 1) | (np.bincount(at, twice) > 0))[at]
    ends = np.cumsum(sizes)
    return messages([(c, shard, np.packbits(recurs[e - k : e]).tobytes()) for c, k, e in zip(chunks, sizes, ends)])


def _bits(told: dict[int, bytes], order: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Answers of all shards in the order of the keys asked for."""
    out = np.zeros(len(order), bool)
    for s in range(len(bounds) - 1):
        k = bounds[s + 1] - bounds[s]
        if k:
            out[order[bounds[s] : bounds[s + 1]]] = np.unpackbits(np.frombuffer(told[s], np.uint8), count=k)
    return out


def _send_windows(n: int):
    def run(docs: pa.Table, told: pa.Table) -> pa.Table:
        if not told.num_rows or not docs.num_rows:
            return messages([])
        c, chunk = Chunk(docs), docs.column("chunk")[0].as_py()
        value, _, place = c.anchors()
        flags = c.located(place[_bits(answers(told), *by_shard(value, n))])
        at, one, two, first, _, ids, starts = c.candidates(flags)
        order, bounds = by_shard(one[first], n)
        rows = [(chunk, s, b"".join(x[first[o]].tobytes() for x in (one, ids, starts.astype(np.int32), two)))
                for s in range(n) if len(o := order[bounds[s] : bounds[s + 1]])]
        # the flags come back with the answers
        return messages([*rows, (chunk, -1 - chunk % n, np.packbits(flags).tobytes())])

    return run


def _first(table: pa.Table) -> pa.Table:
    """Per chunk and window: is the chunk's first place the first of all?"""
    chunks, shards, blobs = (table.column(c).to_pylist() for c in ("chunk", "shard", "blob"))
    out = [(c, -1, b) for c, s, b in zip(chunks, shards, blobs) if s < 0]
    asked = [(c, s, b) for c, s, b in zip(chunks, shards, blobs) if s >= 0]
    if asked:
        sizes = [len(b) // 24 for _, _, b in asked]
        part = lambda kind, at: np.concatenate([np.frombuffer(b, kind, k, at * k) for (_, _, b), k in zip(asked, sizes)])
        one, ids, starts, two = part(np.uint64, 0), part(np.int64, 8), part(np.int32, 16), part(np.uint32, 20)
        order = np.lexsort((starts, ids, two, one))
        o, t, i, s = one[order], two[order], ids[order], starts[order]
        new = np.ones(len(o), bool)
        new[1:] = (o[1:] != o[:-1]) | (t[1:] != t[:-1])
        head = np.flatnonzero(new)[np.cumsum(new) - 1]
        wins = np.empty(len(o), bool)
        wins[order] = (i == i[head]) & (s == s[head])
        ends = np.cumsum(sizes)
        out += [(c, s, np.packbits(wins[e - k : e]).tobytes()) for (c, s, _), k, e in zip(asked, sizes, ends)]
    return messages(out)


RESULT = "doc_id long, n_words long, n_removed long, kept_text string, kept_sha256 string"


def _remove(n: int, with_text: bool):
    def run(docs: pa.Table, told: pa.Table) -> pa.Table:
        if not docs.num_rows:
            return pa.table({k: [] for k in ("doc_id", "n_words", "n_removed", "kept_text", "kept_sha256")}, schema=_result_schema())
        c, told = Chunk(docs), answers(told)
        gone = np.zeros(c.n, bool)
        if told:
            flags = np.unpackbits(np.frombuffer(told.pop(-1), np.uint8), count=max(0, c.n - WINDOW + 1)).astype(bool)
            at, one, _, first, number, ids, starts = c.candidates(flags)
            wins = _bits(told, *by_shard(one[first], n))
            home = first[number]
            repeat = at[~(wins[number] & (ids == ids[home]) & (starts == starts[home]))]
            edge = np.zeros(c.n + 1, np.int64)
            np.add.at(edge, repeat, 1)
            np.add.at(edge, repeat + WINDOW, -1)
            gone = np.cumsum(edge)[: c.n] > 0
        removed = [int(gone[b : b + k].sum()) for b, k in zip(c.begins.tolist(), c.sizes.tolist())]
        kept = [b" ".join(ws if not r else [w for w, g in zip(ws, gone[b : b + len(ws)].tolist()) if not g])
                for ws, b, r in zip((t.split() for t in c.texts), c.begins.tolist(), removed)]
        return pa.table([
            pa.array(c.ids, pa.int64()), pa.array(c.sizes), pa.array(removed, pa.int64()),
            pa.array([k.decode("utf-8", "replace") if with_text else None for k in kept], pa.string()),
            pa.array([hashlib.sha256(k).hexdigest() for k in kept], pa.string())], schema=_result_schema())

    return run


def _result_schema() -> pa.Schema:
    return pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_text", pa.string()), ("kept_sha256", pa.string())])


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, with_text: bool = True,
                   chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """One row per document: n_words, n_removed, the kept words joined by one blank and their digest."""
    dealt, n = deal(docs, id_col, text_col, chunk_bytes)
    by_chunk = dealt.groupBy("chunk")
    recurring = by_chunk.applyInArrow(_send_anchors(n), MESSAGE).groupBy("shard").applyInArrow(_confirm, MESSAGE)
    asked = by_chunk.cogroup(recurring.groupBy("chunk")).applyInArrow(_send_windows(n), MESSAGE)
    told = asked.selectExpr("*", TO_SHARD).groupBy("to_shard").applyInArrow(_first, MESSAGE)
    return dealt.groupBy("chunk").cogroup(told.groupBy("chunk")).applyInArrow(_remove(n, with_text), RESULT)
