"""How filters on documents overlap: what each removes, in every order of applying them.

Each document gets a mask of the filters that it fails; all that the audit needs is the number of documents by part
and mask.  One filter, duplicates, asks whether a document's text is identical to that of a smaller id anywhere in the
table, and is answered by radix tries of whole texts:

1. Boundaries: approximate quantiles of the texts' first ``STEP_BYTES`` bytes.  Where one prefix spans several
   quantiles, the texts under it are cut by their next bytes, and so on for ``LEVELS`` steps: prefixes are as long as the
   data makes them.  Texts that agree in the longest prefix, and are still too many, are dealt by a hash of the whole text.
2. Where it is read, a text goes into a compressed trie of the task's current window of ``WINDOW_BYTES``.  A terminal holds
   the smallest id; a row with a larger id is a duplicate already and moves on without its text.  So a window sends
   one text for each group of copies, however large the group.
3. The rest goes to its range, where a trie of whole texts settles the smallest id of all.  Walking the trie
   gives the rows that stay, all others carry the flag.
4. Masks are counted by document, joined with the labels, and reduced to (part, mask); every order and step is
   read from these at most 2^filters counts a part.

A row with a text is sent to one range by its text alone, so a lost task is repeated with the same result.

Defined cases: a null text is empty, and empty texts are texts like any other; a null part value is the empty string;
a null id is larger than any other, and rows that share the smallest id of a text are all first; labels of a repeated id
hold where any of its rows says 1, and for every document of that id; without documents there are no rows; other
columns are ignored, clashing names included.
"""

from __future__ import annotations

import bisect
import itertools
import math
import re
import zlib
from collections.abc import Callable, Iterator
from functools import partial

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybook.llm.common import shuffle_partitions, text_of

#: As many bytes as a double, in which quantiles are taken, holds as a whole number.
STEP_BYTES = 6
LEVELS = 4
LONGEST = STEP_BYTES * LEVELS
#: Quantile points of a prefix that is cut further.
POINTS = 64
#: Boundaries at most; beyond them a range is dealt by hash of the text.
RANGES = 5_000
RANGE_BYTES = 32_000_000
WINDOW_BYTES = 32_000_000
NULL_ID = 2**63 - 1

_UPPER = bytes(range(ord("A"), ord("Z") + 1))
_CONTINUATION = bytes(range(0x80, 0xC0))
_MARKS = re.compile(rb"[#$%&*|]")


def few_words(text: bytes, words: list[bytes]) -> bool:
    return len(words) < 200


def few_distinct(text: bytes, words: list[bytes]) -> bool:
    return 100 * len(set(words)) < 50 * len(words)


def many_capitals(text: bytes, words: list[bytes]) -> bool:
    capitals = len(text) - len(text.translate(None, _UPPER))
    return 100 * capitals > 3 * len(text.translate(None, _CONTINUATION))


def has_marks(text: bytes, words: list[bytes]) -> bool:
    return _MARKS.search(text) is not None


#: Filters by letter: whether a text with these words fails.  The duplicate filter is the letter after them.
FILTERS: dict[str, Callable[[bytes, list[bytes]], bool]] = {
    "A": few_words, "B": few_distinct, "C": many_capitals, "D": has_marks}
DUPLICATES = "E"


class Node:
    """An edge label ``text[start:end]`` and what lies below; ``least`` and ``held`` where a text ends here."""

    __slots__ = ("text", "start", "end", "below", "least", "mask", "held")

    def __init__(self, text: bytes, start: int, end: int):
        self.text, self.start, self.end = text, start, end
        self.below: dict[int, Node] = {}
        self.least: int | None = None
        self.mask = 0
        self.held: dict[str, int] | None = None


def agree(a: bytes, i: int, b: bytes, j: int, n: int) -> int:
    """How many of the next ``n`` bytes agree."""
    if a[i : i + n] == b[j : j + n]:
        return n
    low, step = 0, 16  # the first ``low`` bytes agree; grow the step until a piece differs, then halve it
    while a[i + low : i + low + step] == b[j + low : j + low + step]:
        low, step = low + step, 2 * step
    while step > 1:
        step //= 2
        if a[i + low : i + low + step] == b[j + low : j + low + step]:
            low += step
    return low


class Trie:
    """A compressed trie of whole texts; terminals hold the smallest id and its rows, counted by part."""

    def __init__(self):
        self.root = Node(b"", 0, 0)
        self.size = 0

    def place(self, text: bytes) -> Node:
        """The node at which ``text`` ends, made if there is none."""
        node, at = self.root, 0
        while at < len(text):
            child = node.below.get(text[at])
            if child is None:
                child = node.below[text[at]] = Node(text, at, len(text))
                self.size += len(text)
                return child
            span = child.end - child.start
            n = agree(text, at, child.text, child.start, min(span, len(text) - at))
            if n < span:
                fork = Node(child.text, child.start, child.start + n)
                child.start += n
                fork.below[child.text[child.start]] = child
                node.below[text[at]] = child = fork
            node, at = child, at + n
        return node

    def add(self, node: Node, doc_id: int, part: str, n: int) -> Iterator[tuple[int, str, int]]:
        """A row of a text that ends at ``node``; gives the rows (doc_id, part, n) that are known as duplicates by it."""
        if node.held is None or doc_id < node.least:
            if node.held is not None:
                yield from ((node.least, p, k) for p, k in node.held.items())
            node.least, node.held = doc_id, {part: n}
        elif doc_id == node.least:
            node.held[part] = node.held.get(part, 0) + n
        else:
            yield doc_id, part, n

    def walk(self) -> Iterator[tuple[bytes, Node]]:
        """All texts with their terminals."""
        stack = [self.root]
        while stack:
            node = stack.pop()
            if node.held is not None:
                yield node.text[: node.end], node
            stack.extend(node.below.values())


_SENT = "slot int, text binary, doc_id long, part string, mask int, n long"


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int32(), pa.binary(), pa.int64(), pa.string(), pa.int32(), pa.int64())
    names = ("slot", "text", "doc_id", "part", "mask", "n")
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=names)


def slot_of(text: bytes, bounds: list[bytes], fan: int) -> int:
    """The range of a text among the boundaries; repeated boundaries share the texts of that very prefix by hash."""
    key = text[:LONGEST]
    low, high = bisect.bisect_left(bounds, key), bisect.bisect_right(bounds, key)
    at = low + 1 + zlib.crc32(text) % (high - low) if high - low > 1 else high
    return at * fan + (zlib.crc32(text, 1) % fan if fan > 1 else 0)


def _read(filters: dict, bounds: list[bytes], fan: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (doc_id, part, text): masks, and the texts that may be first, once a window."""
    slots, spread = (len(bounds) + 1) * fan, itertools.count()
    duplicate = 1 << len(filters)

    def rest(trie):
        for text, node in trie.walk():
            for p, n in node.held.items():
                yield slot_of(text, bounds, fan), text, None if node.least == NULL_ID else node.least, p, node.mask, n

    trie = Trie()
    for b in batches:
        out = []
        for doc_id, part, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), (x.as_py() for x in b.column(2))):
            node = trie.place(text)
            if node.held is None:
                words = text.split()
                node.mask = sum(1 << i for i, fails in enumerate(filters.values()) if fails(text, words))
            for i, p, n in trie.add(node, NULL_ID if doc_id is None else doc_id, part, 1):
                out.append((next(spread) % slots, None, None if i == NULL_ID else i, p, node.mask | duplicate, n))
            if trie.size >= WINDOW_BYTES:
                yield _batch(out)
                for rows in itertools.batched(rest(trie), 100):
                    yield _batch(list(rows))
                trie, out = Trie(), []
        yield _batch(out)
    for rows in itertools.batched(rest(trie), 100):
        yield _batch(list(rows))


def _settle(duplicate: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of a range: those without text pass, the others go into its trie."""
    names, kinds = ["doc_id", "part", "mask", "n"], (pa.int64(), pa.string(), pa.int32(), pa.int64())

    def table(rows):
        rows = [(None if r[0] == NULL_ID else r[0], *r[1:]) for r in rows]
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=names)

    trie = Trie()
    for b in batches:
        out = []
        cols = [b.column(i).to_pylist() for i in range(2, 6)]
        for text, doc_id, part, mask, n in zip((x.as_py() for x in b.column(1)), *cols):
            if text is None:
                out.append((doc_id, part, mask, n))
                continue
            node = trie.place(text)
            node.mask = mask
            out.extend((i, p, mask | duplicate, k) for i, p, k in trie.add(node, NULL_ID if doc_id is None else doc_id, part, n))
        yield table(out)
    for rows in itertools.batched(((node.least, p, node.mask, n) for _, node in trie.walk() for p, n in node.held.items()), 5000):
        yield table(rows)


def _number(text: Column, step: int) -> Column:
    """Bytes ``step * STEP_BYTES`` and on as a number of the same order; a text that ends sooner counts as ended by zeros."""
    piece = F.rpad(F.hex(F.substring(text, step * STEP_BYTES + 1, STEP_BYTES)), 2 * STEP_BYTES, "0")
    return F.conv(piece, 16, 10).cast("long")


def boundaries(texts: DataFrame, ranges: int) -> list[bytes]:
    """Adaptive prefixes in order (``texts``: one binary column ``text``, no nulls), at most ``ranges`` - 1."""
    def again(values):  # each distinct value, and how often it comes
        return [(v, len(list(g))) for v, g in itertools.groupby(values)]

    points = [k / ranges for k in range(1, ranges)]
    found = texts.agg(F.percentile_approx(_number(F.col("text"), 0), points, 20 * ranges)).first()[0] if points else None
    heavy, done = [], []
    for v, n in again(found or []):
        (heavy if n > 1 else done).append((v.to_bytes(STEP_BYTES, "big"), n))
    for step in range(1, LEVELS):
        if not heavy:
            break
        share = dict(heavy)
        # a text that ends within a prefix counts as ended by zeros, as in its number
        prefix = F.rpad(F.hex(F.substring("text", 1, step * STEP_BYTES)), 2 * step * STEP_BYTES, "0")
        under = texts.where(prefix.isin([p.hex().upper() for p in share]))
        cut = under.groupBy(prefix.alias("prefix")).agg(
            F.percentile_approx(_number(F.col("text"), step), [k / POINTS for k in range(1, POINTS)], 20 * POINTS).alias("at"))
        heavy = []
        for p, at in ((bytes.fromhex(r.prefix), r["at"]) for r in cut.collect()):
            picks = [at[max(0, math.ceil(POINTS * k / (share[p] + 1)) - 1)] for k in range(1, share[p] + 1)]
            done.append((p, 1))
            for v, n in again(picks):
                (heavy if n > 1 else done).append((p + v.to_bytes(STEP_BYTES, "big"), n))
    return sorted(b for p, n in done + heavy for b in [p] * n)


def filter_masks(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang", *,
                 filters: dict[str, Callable] = FILTERS) -> DataFrame:
    """Rows (doc_id, part, mask, n): n documents of that id and part fail the filters in mask (bit i: i-th
    filter; the bit after them: the text is identical to that of a smaller id)."""
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), text_of(F.col(f"`{part_col}`")).alias("part"),
                       text_of(F.col(f"`{text_col}`")).cast("binary").alias("text"))
    volume = rows.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    slots = max(shuffle_partitions(docs.sparkSession), math.ceil(volume / RANGE_BYTES))
    fan = math.ceil(slots / RANGES)
    bounds = boundaries(rows.select("text"), math.ceil(slots / fan))
    sent = rows.mapInArrow(partial(_read, filters, bounds, fan), _SENT)
    dealt = sent.repartitionById((len(bounds) + 1) * fan, "slot")
    return dealt.mapInArrow(partial(_settle, 1 << len(filters)), "doc_id long, part string, mask int, n long")


def interaction_audit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang", *,
                      filters: dict[str, Callable] = FILTERS) -> DataFrame:
    """One row per part, order of all filters and step: part, filter_order, step, kept, removed, redundant, unique_fails,
    good_lost, toxic_lost, shapley, filter."""
    letters = "".join(filters) + DUPLICATES
    masks = filter_masks(docs, id_col, text_col, part_col, filters=filters)
    masks = masks.groupBy("doc_id", "part", "mask").agg(F.sum("n").alias("n"))
    said = labels.where(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").cast("long").alias("l_id")).agg(
        F.max(F.when(F.col("quality") == 1, 1).otherwise(0)).alias("good"), F.max(F.when(F.col("toxic") == 1, 1).otherwise(0)).alias("bad"))
    cells = masks.join(said, F.col("doc_id") == F.col("l_id"), "left").groupBy("part", "mask").agg(
        F.sum("n").alias("n"), F.sum(F.col("n") * F.coalesce("good", F.lit(0))).alias("good"),
        F.sum(F.col("n") * F.coalesce("bad", F.lit(0))).alias("bad"))
    parts = cells.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "bad")).alias("cells"))

    orders = ["".join(o) for o in itertools.permutations(letters)]
    rows = parts.withColumn("filter_order", F.explode(F.array(*map(F.lit, orders))))
    rows = rows.withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(len(letters)))))
    rows = rows.withColumn("filter", F.substring("filter_order", F.col("step"), F.lit(1)))
    own = F.expr(f"shiftleft(1, locate(filter, '{letters}') - 1)")
    before = F.expr(f"aggregate(sequence(1, {len(letters)}), 0, (a, i) -> a + IF(i < step,"
                    f" shiftleft(1, locate(substring(filter_order, i, 1), '{letters}') - 1), 0))")
    rows = rows.withColumn("own", own).withColumn("before", before)

    def total(value: str, having: str) -> Column:
        return F.expr(f"aggregate(filter(cells, x -> {having}), 0L, (a, x) -> a + {value})")

    reached, fails = "x.mask & before = 0", "x.mask & own != 0"
    return rows.select(
        "part", "filter_order", "step",
        total("x.n", f"{reached} AND x.mask & own = 0").alias("kept"),
        total("x.n", f"{reached} AND {fails}").alias("removed"),
        total("x.n", f"{fails} AND x.mask & before != 0").alias("redundant"),
        total("x.n", "x.mask = own").alias("unique_fails"),
        total("x.good", f"{reached} AND {fails}").alias("good_lost"),
        total("x.bad", f"{reached} AND {fails}").alias("toxic_lost"),
        # of all orders, a failing document is removed by each of its filters in an equal share
        total(f"x.n * CAST({len(orders)} / bit_count(x.mask) AS BIGINT)", fails).alias("shapley"),
        "filter",
    )
