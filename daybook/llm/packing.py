"""Order-preserving packing by dynamic programming.

The token stream of a scan partition (documents in their order, each closed by the
end id) is cut into windows of at most ``SEQ_LEN`` tokens.  Cut places are document
ends (free), sentence ends (penalty ``SENTENCE_CUT``) and, inside sentences longer
than ``GRID`` tokens, every ``GRID`` tokens (penalty ``MID_CUT``).  With p the
places, the cheapest packing up to place j is

    f[j] = pen[j] + min over p[j] - p[i] <= SEQ_LEN of (f[i] + SEQ_LEN - (p[j] - p[i]))

With g[j] = f[j] + p[j] the minimum is over g[i] alone, in a window that only
moves forward: a monotone queue finds it in constant amortised time.  The last
window of a run is cut into powers of two where that costs less than its padding.

A run is at most ``RUN_TOKENS`` tokens (whole documents), which bounds memory for
any partition size.  There is no shuffle: sequence ids are the partition number and
a counter, and a lost task gives the same pieces when it runs again.

Tokens come from the byte-level BPE ranks; a dictionary from white-space separated
pieces to ids saves encoding a frequent piece again.  A lone blank between two
non-blank characters always opens a token, so texts are split exactly there.  The added tokens of the
tokenizer file (``<|endoftext|>``) are one id each wherever a text holds their string, and the parts
between them are encoded by themselves.

Defined cases: null and empty texts are one token (the end id); texts of any length
are cut; repeated rows are packed as rows; a null id stays null; columns other than
id and text are never read.
"""

from __future__ import annotations

import base64
import json
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.llm.common import release

SEQ_LEN = 1024
SENTENCE_CUT = 3
MID_CUT = 8
GRID = 32
RUN_TOKENS = 2_000_000
CACHE_PIECES = 400_000
END_ID = 0
SCHEMA = ("doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, "
          "`offset` bigint, ids binary")

_LONE_BLANK = re.compile(r"(?<=\S) (?=\S)")
_TWO_SPACES = re.compile(r"\s\s|[\x1c-\x1f]")
_ODD = re.compile(r"[\x1c-\x1f]")  # white space to Python, not to the tokenizer


class PieceTokenizer(dict):
    """ids (little-endian uint32 bytes) by piece; pieces other than a text's first carry their blank."""

    def __init__(self, ranks_path: str, pattern: str, most: int = CACHE_PIECES):
        import tiktoken

        with open(ranks_path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.encoding = tiktoken.Encoding("bytes", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.most = most

    def encode(self, text: str) -> bytes:
        return np.array(self.encoding.encode_ordinary(text), "<u4").tobytes()

    def __missing__(self, piece: str) -> bytes:
        if len(self) >= self.most:
            self.clear()
        ids = self.encode(" " + piece)
        if len(piece) < 40:
            self[piece] = ids
        return ids

    def ids(self, text: str) -> bytes:
        if not text:
            return b""
        if _TWO_SPACES.search(text) or text[0].isspace() or text[-1].isspace():
            if _ODD.search(text):
                return self.encode(text)
            pieces = _LONE_BLANK.split(text)
        else:
            pieces = text.split(" ")
        return self.encode(pieces[0]) + b"".join(map(self.__getitem__, pieces[1:]))

    def ids_with_added(self, text: str, added: dict[str, int]) -> bytes:
        """``ids``, with the strings of added tokens as their own ids."""
        if not any(a in text for a in added):
            return self.ids(text)
        strings = "|".join(map(re.escape, sorted(added, key=len, reverse=True)))
        return b"".join(np.array([added[p]], "<u4").tobytes() if i % 2 else self.ids(p)
                        for i, p in enumerate(re.split(f"({strings})", text)))


_TOKENIZERS: dict[str, PieceTokenizer] = {}


def tokenizer(name: str) -> PieceTokenizer:
    """One per worker process."""
    if name not in _TOKENIZERS:
        import public_tokenizers as public

        _TOKENIZERS[name] = PieceTokenizer(public.path(name), public.PATTERN)
    return _TOKENIZERS[name]


def added_tokens(name: str) -> dict[str, int]:
    """Ids by string, from the tokenizer file beside the ranks; read once, on the driver."""
    import public_tokenizers as public

    with open(public.path(name).removesuffix(".tiktoken") + ".json", encoding="utf-8") as f:
        return {t["content"]: t["id"] for t in json.load(f)["added_tokens"]}


def sentence_end_ids(tok: PieceTokenizer, added: dict[str, int]) -> np.ndarray:
    """Flags by id: the token ends a sentence or a line (an added token ends a text)."""
    e = tok.encoding
    flags = np.zeros(max([e.n_vocab, *(i + 1 for i in added.values())]), bool)
    flags[: e.n_vocab] = [e.decode_single_token_bytes(i)[-1:] in (b".", b"!", b"?", b"\n") for i in range(e.n_vocab)]
    flags[list(added.values())] = True
    return flags


def cut_places(ends: np.ndarray, sentence: np.ndarray, grid: int = GRID) -> tuple[np.ndarray, np.ndarray]:
    """Places (ascending, from 0) and penalties: document ends, sentence ends, grid."""
    firm = np.union1d(ends, sentence)
    edges = np.concatenate(([0], firm))
    gaps = np.diff(edges)
    extra = np.maximum(0, (gaps - 1) // grid)
    base = np.repeat(edges[:-1], extra)
    nth = np.arange(extra.sum()) - np.repeat(np.cumsum(extra) - extra, extra) + 1
    places = np.concatenate([firm, base + nth * grid])
    pens = np.concatenate([np.where(np.isin(firm, ends), 0, SENTENCE_CUT), np.full(len(base), MID_CUT)])
    order = np.argsort(places, kind="stable")
    return places[order], pens[order]


def best_cuts(places: np.ndarray, pens: np.ndarray, seq_len: int = SEQ_LEN) -> list[int]:
    """Window ends of the cheapest cutting; neighbouring places are at most ``seq_len`` apart."""
    p, pen = [0, *places.tolist()], [0, *pens.tolist()]
    n = len(p)
    g, back = [0] * n, [0] * n
    queue, head = [0], 0
    for j in range(1, n):
        low = p[j] - seq_len
        while p[queue[head]] < low:
            head += 1
        i = queue[head]
        back[j] = i
        g[j] = cost = g[i] + pen[j] + seq_len
        while len(queue) > head and g[queue[-1]] > cost:
            queue.pop()
        queue.append(j)
        if head > 50_000:
            del queue[:head]
            head = 0
    cuts, j = [], n - 1
    while j:
        cuts.append(p[j])
        j = back[j]
    return cuts[::-1]


def split_tail(start: int, end: int, seq_len: int = SEQ_LEN) -> list[int]:
    """Ends of power-of-two windows over the run's last window, if cheaper than its padding."""
    n = end - start
    bits = [1 << k for k in range(n.bit_length() - 1, -1, -1) if n >> k & 1]
    if len(bits) == 1 or MID_CUT * (len(bits) - 1) >= seq_len - n:
        return [end]
    return (start + np.cumsum(bits)).tolist()


def binary_pieces(stream: np.ndarray, to: np.ndarray) -> pa.Array:
    """The stream's bytes up to each of the places ``to`` (ascending, the last is its end), as one binary value
    each that points into the stream: no copy."""
    at = np.concatenate(([0], to * stream.itemsize))
    if at[-1] >= 2**31:
        raise ValueError("a run of tokens is beyond the 2 GB of a binary column")
    return pa.Array.from_buffers(pa.binary(), len(to), [None, pa.py_buffer(at.astype(np.int32)), pa.py_buffer(stream)])


def pack_run(doc_ids: list, ids: list[np.ndarray], is_end: np.ndarray, first_sequence: int, with_ids: bool) -> tuple[list, int]:
    """Columns of the pieces of one run, and the number of sequences.  ``ids`` is emptied."""
    stream = np.ascontiguousarray(np.concatenate(ids), "<u4")
    sizes = np.array([len(x) for x in ids])
    ids.clear()  # the stream holds them now
    ends = np.cumsum(sizes)
    cuts = best_cuts(*cut_places(ends, np.flatnonzero(is_end[stream]) + 1))
    cuts = [*cuts[:-1], *split_tail(cuts[-2] if len(cuts) > 1 else 0, cuts[-1])]
    cuts = np.array(cuts)
    begins = ends - sizes
    to = np.union1d(ends, cuts)
    frm = np.concatenate(([0], to[:-1]))
    doc = np.searchsorted(ends, frm, side="right")
    seq = np.searchsorted(cuts, frm, side="right")
    seq_begin = np.concatenate(([0], cuts))[seq]
    raw = memoryview(stream).cast("B")
    a, b = (frm * 4).tolist(), (to * 4).tolist()
    return [
        [doc_ids[i] for i in doc.tolist()],
        frm - begins[doc],
        to - frm,
        [zlib.crc32(raw[x:y]) for x, y in zip(a, b)],
        sizes[doc],
        first_sequence + seq,
        frm - seq_begin,
        binary_pieces(stream, to) if with_ids else pa.nulls(len(a), pa.binary()),
    ], len(cuts)


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, tokenizer_file: str = "byte_bpe_50k.tiktoken",
         with_ids: bool = True) -> DataFrame:
    """One row per piece: its document, place, sequence and (``with_ids``) its token ids."""
    added = added_tokens(tokenizer_file)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = tokenizer(tokenizer_file)
        is_end = sentence_end_ids(tok, added)
        base, done = TaskContext.get().partitionId() << 40, 0
        names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "ids"]
        end = np.array([END_ID], "<u4").tobytes()
        doc_ids, ids, held = [], [], 0

        def flush() -> pa.RecordBatch:
            nonlocal doc_ids, ids, held, done
            cols, n = pack_run(doc_ids, ids, is_end, base + done, with_ids)
            doc_ids, ids, held, done = [], [], 0, done + n
            return pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in cols[:-1]), cols[-1]], names=names)

        for b in batches:
            for doc_id, text in zip(b.column(0).to_pylist(), (x.as_py() for x in b.column(1))):
                x = np.frombuffer(tok.ids_with_added(text or "", added) + end, "<u4")
                doc_ids.append(doc_id)
                ids.append(x)
                held += len(x)
                if held >= RUN_TOKENS:
                    yield flush()
                    release()
        if ids:
            yield flush()
        release()

    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    return rows.mapInArrow(run, SCHEMA)
