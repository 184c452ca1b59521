"""Documents in blocks: compressed runs of whole texts, dealt by a hash of the id.

Operators that must see the same texts in two of their steps shuffle them once
as blocks; both steps read that one exchange. A block holds about
``BLOCK_BYTES`` of text, so the number of blocks follows the input.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltlake.llm.arrays import utf8_column

BLOCK_BYTES = 16 << 20
NULL_ID = -(1 << 63)


def pack_arrays(*arrays: np.ndarray, level: int = 1) -> bytes:
    """Arrays as one compressed value; ``unpack_arrays`` needs their types."""
    import zstandard
    sizes = np.array([a.nbytes for a in arrays], dtype=np.int64)
    return zstandard.ZstdCompressor(level=level).compress(b"".join([sizes.tobytes(), *(np.ascontiguousarray(a).tobytes() for a in arrays)]))


def unpack_arrays(value: bytes, *types: str) -> list[np.ndarray]:
    import zstandard
    flat = zstandard.ZstdDecompressor().decompress(value)
    sizes = np.frombuffer(flat, dtype=np.int64, count=len(types))
    ends = np.cumsum(sizes) + 8 * len(types)
    return [np.frombuffer(flat, dtype=t, count=n // np.dtype(t).itemsize, offset=e - n)
            for t, n, e in zip(types, sizes.tolist(), ends.tolist())]


def freed(result):
    """``result``, after the memory that its making used has gone back to the
    system: a worker goes on to other tasks beside the executor's own memory."""
    import ctypes
    pa.default_memory_pool().release_unused()
    libc = ctypes.CDLL(None)
    if hasattr(libc, "malloc_trim"):
        libc.malloc_trim(0)
    return result


def block_count(docs: DataFrame, text_col: str = "text", block_bytes: int = BLOCK_BYTES) -> int:
    total = docs.agg(F.sum(F.octet_length(F.col(text_col).cast("binary")))).first()[0] or 0
    return int(total // block_bytes) + 1


def block_of(id_col: str, n: int):
    return F.pmod(F.xxhash64(id_col), F.lit(n)).cast("int")


def to_blocks(docs: DataFrame, n: int, id_col: str = "doc_id", text_col: str = "text", flag=None, spread_null_ids: bool = False,
              level: int = 1) -> DataFrame:
    """``(block, payload)``: several rows a block, each with the ids, flags,
    text offsets and text bytes of some documents (null ids as ``NULL_ID``,
    marked in the flags by 2; flag 1 is the given boolean column). With
    ``spread_null_ids`` documents without an id are dealt by their text;
    ``level`` is that of the compression."""
    block = block_of(id_col, n)
    if spread_null_ids:
        block = F.when(F.col(id_col).isNull(), block_of(text_col, n)).otherwise(block)
    flags = F.when(flag, 1).otherwise(0) if flag is not None else F.lit(0)
    narrow = docs.select(block.alias("block"), F.coalesce(F.col(id_col).cast("long"), F.lit(NULL_ID)).alias("id"),
                         (flags + F.when(F.col(id_col).isNull(), 2).otherwise(0)).cast("byte").alias("flags"),
                         F.col(text_col).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            block, ids, marks = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(3))
            data, at = utf8_column(batch.column(3))
            order = np.argsort(block, kind="stable")
            edges = np.flatnonzero(np.diff(block[order], prepend=-1, append=-1))
            blocks, payloads = [], []
            for i, j in zip(edges, edges[1:]):
                own = order[i:j]
                text = np.concatenate([data[at[k]:at[k + 1]] for k in own])
                lengths = at[own + 1] - at[own]
                blocks.append(block[own[0]])
                payloads.append(pack_arrays(ids[own], marks[own], lengths, text, level=level))
            yield pa.RecordBatch.from_arrays([pa.array(blocks, pa.int32()), pa.array(payloads, pa.binary())], names=["block", "payload"])

    return narrow.mapInArrow(run, "block int, payload binary")


def open_block(payloads) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """ids, flags, text bytes and the n + 1 offsets of a block's documents, in
    an order that does not depend on how the payloads arrived: by id, and by
    text where ids are equal."""
    parts = [unpack_arrays(p, "<i8", "i1", "<i8", "u1") for p in payloads]
    if not parts:
        return np.empty(0, np.int64), np.empty(0, np.int8), np.empty(0, np.uint8), np.zeros(1, np.int64)
    ids, flags, lengths, data = (np.concatenate(x) for x in zip(*parts))
    at = np.concatenate([[0], np.cumsum(lengths)])
    order = np.argsort(ids, kind="stable")
    same = np.flatnonzero(np.diff(ids[order]) == 0)
    if len(same):
        shared = set(ids[order][same].tolist())
        order = np.array(sorted(order.tolist(), key=lambda k: (ids[k], data[at[k]:at[k + 1]].tobytes() if ids[k] in shared else b"")))
    data = np.concatenate([data[at[k]:at[k + 1]] for k in order])
    return ids[order], flags[order], data, np.concatenate([[0], np.cumsum(lengths[order])])
