"""Documents dealt into chunks of bounded text, and messages between chunks and shards.

Operators that compare every word run with all others (phrase dedup, language model) work on
chunks: a task takes a chunk's documents whole, reduces its runs to distinct keys, and sends each
shard one blob of keys; a shard answers each chunk with one blob in the same order.  So what is
shuffled is distinct keys per chunk, not one row per word, and neither side holds more than a chunk or
a shard.  The same exchange of documents by chunk serves every pass of a query.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.llm.common import shuffle_partitions

CHUNK_BYTES = 8_000_000
MESSAGE = "chunk int, shard int, blob binary"
#: A row with shard -1 - k is a chunk's own note, which passes through shard k and comes back.
TO_SHARD = "CASE WHEN shard < 0 THEN -1 - shard ELSE shard END AS to_shard"
#: Chunks per shard, so that messages stay large when there are many chunks.
CHUNKS_PER_SHARD = 4


def deal(docs: DataFrame, id_col: str, text_col: str, chunk_bytes: int = CHUNK_BYTES) -> tuple[DataFrame, int]:
    """(chunk, doc_id, text as bytes), and the number of shards; both counts follow the volume of text.

    Chunks are dealt by id and text, so that rows with one id, or none, spread over all chunks."""
    text = F.col(f"`{text_col}`").cast("binary")
    volume = docs.agg(F.sum(F.octet_length(text).cast("long"))).first()[0] or 0
    n = max(math.ceil(volume / chunk_bytes), shuffle_partitions(docs.sparkSession))
    doc_id = F.col(f"`{id_col}`").cast("long")
    dealt = docs.select(F.pmod(F.xxhash64(doc_id, text), F.lit(n)).cast("int").alias("chunk"), doc_id.alias("doc_id"), text.alias("text"))
    return dealt, max(math.ceil(n / CHUNKS_PER_SHARD), min(n, shuffle_partitions(docs.sparkSession)))


def messages(rows: list[tuple[int, int, bytes]]) -> pa.Table:
    return pa.table({
        "chunk": pa.array([r[0] for r in rows], pa.int32()),
        "shard": pa.array([r[1] for r in rows], pa.int32()),
        "blob": pa.array([r[2] for r in rows], pa.binary()),
    })


def by_shard(keys: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """An order that puts the keys of each shard together (stable), and the shards' bounds in it."""
    shard = (keys % np.uint64(n)).astype(np.int64)
    order = np.argsort(shard, kind="stable")
    return order, np.searchsorted(shard[order], np.arange(n + 1))


def answers(table: pa.Table) -> dict[int, bytes]:
    return dict(zip(table.column("shard").to_pylist(), table.column("blob").to_pylist()))


def in_order(table: pa.Table) -> tuple[list, list[bytes]]:
    """A chunk's ids (null last) and texts, sorted by id and then text."""
    ids, texts = table.column("doc_id").to_pylist(), table.column("text").to_pylist()
    order = sorted(range(len(ids)), key=lambda i: (ids[i] is None, ids[i] or 0, texts[i] or b""))
    return [ids[i] for i in order], [texts[i] or b"" for i in order]


def words_in(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words per text; the words of all texts end to end, as places in a vocabulary; 64-bit hashes of the vocabulary."""
    raw = pa.array(texts, pa.binary())
    lists = pc.ascii_split_whitespace(pa.Array.from_buffers(pa.string(), len(raw), raw.buffers()))
    flat, parent = lists.flatten(), pc.list_parent_indices(lists)
    word = pc.greater(pc.binary_length(flat), 0)  # a blank at an end of a text leaves an empty string
    coded = flat.filter(word).dictionary_encode()
    sizes = np.bincount(parent.filter(word).to_numpy(zero_copy_only=False), minlength=len(texts)).astype(np.int64)
    known = pa.Array.from_buffers(pa.binary(), len(coded.dictionary), coded.dictionary.buffers()).to_numpy(zero_copy_only=False)
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, known), np.uint64, len(known))
    return sizes, coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), hashes
