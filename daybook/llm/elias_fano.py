"""Elias-Fano sequences and an n-gram trie of two levels over them.

A monotone sequence of n values below u takes n * (2 + log2(u / n)) bits: the low bits packed, the high
bits as unary gaps in a bit vector with a sampled directory of ones and zeros.  ``select``,
``find`` and ``next_geq`` work on whole arrays of queries.  All parts are views of one buffer, so a trie
can be read from a memory-mapped file without copying.
"""

from __future__ import annotations

import numpy as np

_BLOCK = 8  # 64-bit words per directory entry
_HALVES = [(np.uint64(w), np.uint64((1 << w) - 1)) for w in (32, 16, 8, 4, 2, 1)]


def _select(words: np.ndarray, directory: np.ndarray, k: np.ndarray, flip: bool) -> np.ndarray:
    """Position of the k-th set bit (of the flipped words with ``flip``), k from 0."""
    block = np.searchsorted(directory, k, side="right") - 1
    left = k - directory[block]
    at = block * _BLOCK
    for _ in range(_BLOCK - 1):
        n = np.bitwise_count(~words[at] if flip else words[at]).astype(np.int64)
        go = left >= n
        left -= np.where(go, n, 0)
        at += go
    word = ~words[at] if flip else words[at].copy()
    pos = at * 64
    for width, mask in _HALVES:
        n = np.bitwise_count(word & mask).astype(np.int64)
        go = left >= n
        left -= np.where(go, n, 0)
        word = np.where(go, word >> width, word)
        pos += np.where(go, int(width), 0)
    return pos


class EliasFano:
    def __init__(self, n: int, low_bits: int, low: np.ndarray, high: np.ndarray, ones: np.ndarray, zeros: np.ndarray):
        self.n, self.low_bits, self.low, self.high, self.ones, self.zeros = n, low_bits, low, high, ones, zeros

    @classmethod
    def encode(cls, values: np.ndarray) -> EliasFano:
        """Of ascending values (repeats allowed) below 2**62."""
        v = np.asarray(values, np.int64)
        n = len(v)
        top = int(v[-1]) + 1 if n else 1
        bits = max(0, (top // max(n, 1)).bit_length() - 1)
        high = (v >> bits) + np.arange(n)
        n_words = -(-(n + (top >> bits) + 2) // (64 * _BLOCK)) * _BLOCK
        flags = np.zeros(n_words * 64, np.uint8)
        flags[high] = 1
        words = np.packbits(flags, bitorder="little").view("<u8")
        count = np.bitwise_count(words).astype(np.int64).reshape(-1, _BLOCK).sum(axis=1)
        ones = np.concatenate(([0], np.cumsum(count)))[:-1]
        zeros = np.arange(len(ones)) * 64 * _BLOCK - ones
        low = np.zeros(-(-n * bits // 64) + 1, np.uint64)
        if bits and n:
            part = (v & ((1 << bits) - 1)).astype(np.uint64)
            at = np.arange(n) * bits
            word, shift = at >> 6, (at & 63).astype(np.uint64)
            np.bitwise_or.at(low, word, part << shift)
            over = (shift.astype(np.int64) + bits) > 64
            np.bitwise_or.at(low, word[over] + 1, part[over] >> (np.uint64(64) - shift[over]))
        return cls(n, bits, low, words, ones.astype(np.int64), zeros.astype(np.int64))

    def parts(self) -> list[np.ndarray]:
        return [np.array([self.n, self.low_bits], np.int64), self.low, self.high, self.ones, self.zeros]

    @classmethod
    def of_parts(cls, head, low, high, ones, zeros) -> EliasFano:
        return cls(int(head.view(np.int64)[0]), int(head.view(np.int64)[1]), low.view("<u8"), high.view("<u8"), ones.view(np.int64), zeros.view(np.int64))

    def _low(self, i: np.ndarray) -> np.ndarray:
        if not self.low_bits:
            return np.zeros(len(i), np.int64)
        at = i * self.low_bits
        word, shift = at >> 6, (at & 63).astype(np.uint64)
        value = self.low[word] >> shift
        over = shift.astype(np.int64) + self.low_bits > 64
        value[over] |= self.low[word[over] + 1] << (np.uint64(64) - shift[over])
        return (value & np.uint64((1 << self.low_bits) - 1)).astype(np.int64)

    def access(self, i: np.ndarray) -> np.ndarray:
        i = np.asarray(i, np.int64)
        return ((_select(self.high, self.ones, i, False) - i) << self.low_bits) | self._low(i)

    def _before(self, high: np.ndarray) -> np.ndarray:
        """Number of elements whose high part is below ``high``: the ones before that many zeros."""
        return np.where(high > 0, _select(self.high, self.zeros, np.maximum(high - 1, 0), True) - np.maximum(high - 1, 0), 0)

    def _search(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For x up to the last element: index of the first element >= x, whether it shares x's high
        part, and whether it equals x.  A binary search over the low bits of that high part."""
        high, low = x >> self.low_bits, x & ((1 << self.low_bits) - 1)
        i, end = self._before(high), self._before(high + 1)
        stop = end.copy()
        todo = np.flatnonzero(i < stop)
        while len(todo):
            mid = (i[todo] + stop[todo]) >> 1
            less = self._low(mid) < low[todo]
            i[todo[less]] = mid[less] + 1
            stop[todo[~less]] = mid[~less]
            todo = todo[i[todo] < stop[todo]]
        inside = i < end
        equal = inside.copy()
        equal[inside] = self._low(i[inside]) == low[inside]
        return i, inside, equal

    def _last(self) -> int:
        return int(self.access(np.array([self.n - 1]))[0]) if self.n else -1

    def find(self, x: np.ndarray) -> np.ndarray:
        """Index of the first element equal to x; -1 where there is none."""
        x = np.asarray(x, np.int64)
        out = np.full(len(x), -1, np.int64)
        at = np.flatnonzero((x <= self._last()) & (x >= 0))
        if len(at):
            i, _, equal = self._search(x[at])
            out[at[equal]] = i[equal]
        return out

    def next_geq(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index and value of the first element >= x (index n and value -1 beyond the last)."""
        x = np.asarray(x, np.int64)
        out, value = np.full(len(x), self.n, np.int64), np.full(len(x), -1, np.int64)
        at = np.flatnonzero(x <= self._last())
        if len(at):
            i, _, _ = self._search(x[at])
            out[at], value[at] = i, self.access(i)
        return out, value


class BigramTrie:
    """Contexts (level 1), monotone pointers to their successors, successors (level 2) with codes.

    A successor w of a context is kept as w + 1 + the last value of the context before, which makes
    the level one ascending sequence; a search is relative to that last value.
    """

    def __init__(self, contexts: EliasFano, pointers: EliasFano, successors: EliasFano, codes: np.ndarray):
        self.contexts, self.pointers, self.successors, self.codes = contexts, pointers, successors, codes

    @classmethod
    def build(cls, context: np.ndarray, word: np.ndarray, codes: np.ndarray) -> BigramTrie:
        """Of distinct pairs sorted by (context, word)."""
        first = np.ones(len(context), bool)
        first[1:] = context[1:] != context[:-1]
        begins = np.flatnonzero(first)
        ends = np.append(begins[1:], len(context))
        group = np.cumsum(first) - 1
        last = np.cumsum(word[ends - 1] + 1) if len(word) else np.zeros(0, np.int64)
        base = np.concatenate(([0], last[:-1])) if len(word) else last
        return cls(EliasFano.encode(context[begins]), EliasFano.encode(np.append(begins, len(context))),
                   EliasFano.encode(word + 1 + base[group]), np.asarray(codes, np.uint16))

    def lookup(self, context: np.ndarray, word: np.ndarray) -> np.ndarray:
        """Codes; 0 for a pair that is not there."""
        out = np.zeros(len(context), np.uint16)
        if not len(self.codes) or not len(context):
            return out
        # equal contexts lie together in the queries of a batch: search each once
        new = np.ones(len(context), bool)
        new[1:] = context[1:] != context[:-1]
        i = self.contexts.find(context[new])
        known = i >= 0
        i = np.where(known, i, 0)
        begin, end = self.pointers.access(i), self.pointers.access(i + 1)
        base = np.where(begin > 0, self.successors.access(np.maximum(begin - 1, 0)), 0)
        g = np.cumsum(new) - 1
        at = np.flatnonzero(known[g])
        g = g[at]
        j = self.successors.find(base[g] + word[at] + 1)
        hit = (j >= 0) & (j < end[g])
        out[at[hit]] = self.codes[j[hit]]
        return out

    def to_bytes(self) -> bytes:
        parts = [p for s in (self.contexts, self.pointers, self.successors) for p in s.parts()] + [self.codes]
        sizes = np.array([p.nbytes for p in parts], np.int64)
        pad = lambda b: b + bytes(-len(b) % 8)
        return np.array([len(parts)], np.int64).tobytes() + sizes.tobytes() + b"".join(pad(p.tobytes()) for p in parts)

    @classmethod
    def from_buffer(cls, buffer) -> BigramTrie:
        """Views into ``buffer`` (bytes or a memory map); nothing is copied."""
        n = int(np.frombuffer(buffer, np.int64, 1)[0])
        sizes = np.frombuffer(buffer, np.int64, n, 8).tolist()
        parts, at = [], 8 + 8 * n
        for size in sizes:
            parts.append(np.frombuffer(buffer, np.uint8, size, at))
            at += size + -size % 8
        return cls(*(EliasFano.of_parts(*parts[k : k + 5]) for k in (0, 5, 10)), parts[15].view(np.uint16))
