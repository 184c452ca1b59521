"""SimHash near-duplicates, found by pigeonring filtering.

A fingerprint is cut into a ring of ``limit + 1`` segments. If two differ in
at most ``limit`` bits, then by the pigeonring principle some segment starts a
chain in which, for every length l, the first l segments differ in at most
``l * limit / segments`` bits together. The first link of such a chain is an
equal segment, which is the join key; the following links are checked on
packed bits, and only pairs whose whole chain holds reach the full distance.

Equal fingerprints are one class before any pair is formed. A task compares
the rows of one tile of a key (see ``groups``) and hands on a spanning forest
of the links it found, so a dense group leaves as many rows as it has members,
not its square.

Defined results: null, empty and white-space texts have fingerprint zero,
which links like any other; repeated rows are linked; an empty table gives no
rows; other columns are ignored (``near_duplicates``) or kept (``keep_first``).
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltlake.llm.blocks import freed
from siltlake.llm.components import components
from siltlake.llm.groups import map_runs, merge, tiles
from siltlake.session import checkpoint_dir

SHINGLE, LIMIT, BITS, SEED = 4, 4, 64, 42
_SLICE = 1 << 16


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """Bit b is 1 if it is set in over half the shingles' XXH64 values."""
    from xxhash import xxh64_intdigest
    words = (text or "").encode().lower().split()  # bytes: A-Z and ASCII white space only
    if not words:
        return 0
    joined = b" ".join(words)
    n = max(1, len(words) - shingle + 1)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1  # of each word in the joined text
    first = np.concatenate([[0], ends[:-1] + 1])[:n].tolist()
    last = ends[min(shingle, len(words)) - 1:].tolist()
    ones = np.zeros(BITS, dtype=np.int64)
    for at in range(0, n, _SLICE):
        pairs = zip(first[at:at + _SLICE], last[at:at + _SLICE])
        h = np.fromiter((xxh64_intdigest(joined[a:b], SEED) for a, b in pairs), dtype="<u8")
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and the fingerprint as a signed 64-bit number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            h = np.array([fingerprint(t, shingle) for t in batch.column(1).to_pylist()], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(h.view(np.int64))], names=["doc_id", "fp"])
        freed(None)

    narrow = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return narrow.mapInArrow(run, "doc_id long, fp long")


def segment_masks(limit: int, bits: int = BITS) -> list[int]:
    """``limit + 1`` segments of nearly equal width, as bit masks."""
    edges = [round(i * bits / (limit + 1)) for i in range(limit + 2)]
    return [(1 << b) - (1 << a) for a, b in pairwise(edges)]


def chain_links(x: np.ndarray, start: int, masks: list[int], limit: int) -> np.ndarray:
    """Indexes of the differences ``x`` (XORed pairs) whose chain from segment
    ``start`` stays within its budgets; a whole chain is the full distance."""
    alive, mask = np.arange(len(x)), 0
    for length in range(1, len(masks) + 1):
        mask |= masks[(start + length - 1) % len(masks)]
        near = np.bitwise_count(x[alive] & np.uint64(mask)) <= length * limit // len(masks)
        alive = alive[near]
    return alive


def links(classes: DataFrame, limit: int = LIMIT, most: int = 2048) -> DataFrame:
    """A spanning set of links ``(u, v)`` between the ids of ``classes(id,
    fp)`` whose fingerprints differ in at most ``limit`` bits."""
    masks = segment_masks(limit)

    def signed(m: int) -> int:
        return m - (1 << 64) if m >> 63 else m

    segments = F.array(*(F.struct(F.lit(i).alias("i"), F.col("fp").bitwiseAND(F.lit(signed(m))).alias("s")) for i, m in enumerate(masks)))
    rows = classes.select("id", "fp", F.explode(segments).alias("x")).select(
        "id", "fp", F.col("x.i").alias("seg"), F.struct("x.i", "x.s").alias("key"))

    def compare(batch: pa.RecordBatch, starts: np.ndarray) -> Iterator[pa.RecordBatch]:
        ids, seg, own, a, b = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("id", "seg", "_own", "_a", "_b"))
        fps = batch.column("fp").to_numpy(zero_copy_only=False).view(np.uint64)
        u, v = [], []
        for s, e in pairwise(starts):
            label, inside = np.arange(e - s), a[s] == b[s]
            left = np.arange(e - s) if inside else np.flatnonzero(own[s:e] == a[s])
            right = left if inside else np.flatnonzero(own[s:e] == b[s])
            if not len(left) or not len(right):
                continue
            for at in range(0, len(left), 256):
                part = left[at:at + 256]
                x = (fps[s:e][part][:, None] ^ fps[s:e][right][None, :]).ravel()
                i, j = np.divmod(chain_links(x, int(seg[s]), masks, limit), len(right))
                i, j = part[i], right[j]
                if len(ok := np.flatnonzero(i < j) if inside else np.arange(len(i))):
                    label = merge(label, i[ok], j[ok])
            far = np.flatnonzero(label != np.arange(e - s))
            u.append(ids[s:e][far])
            v.append(ids[s:e][label[far]])
        empty = np.empty(0, np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([empty, *u])), pa.array(np.concatenate([empty, *v]))], names=["u", "v"])

    tiled = tiles(rows, "key", "id", most).select("id", "fp", "seg", "_own", "_a", "_b", F.col("key.s").alias("s"))
    return map_runs(tiled, ["seg", "s", "_a", "_b"], compare, "u long, v long")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, limit: int = LIMIT,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id (the smallest id that
    links of at most ``limit`` bits reach)."""
    checkpoint_dir(docs.sparkSession)
    own = fingerprints(docs, shingle, id_col, text_col).checkpoint()
    classes = own.groupBy("fp").agg(F.min("doc_id").alias("id")).checkpoint()
    found = components(links(classes, limit))
    reached = classes.join(found, classes["id"] == found["node"], "left").select(
        "fp", F.coalesce("component", "id").alias("component_id"))
    return own.join(reached, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
