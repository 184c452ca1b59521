"""Benchmark decontamination with lossless spaced seeds.

A passage of ``WINDOW`` tokens that agrees with a benchmark item in all but
``WINDOW - MATCHES`` places, wherever those are, agrees in all sampled places
of at least one of the fixed ``MASKS`` at some shift inside the passage. So
the masked hashes of both sides, joined, find every such passage; each hit is
then verified token by token along its diagonal, and what counts is every
window with enough equal tokens.

The text side is scanned once, where it lies, for each block of the benchmark;
a block holds ``BLOCK_BYTES`` of items (and one item more at most), so what a
task gets is bounded however large the benchmark is. Only what is found is shuffled.

Tokens are runs of letters and digits, A-Z lowered. Items of 8 to 12 tokens
count where all of them occur in a row; shorter items are no evidence and
never match.

Defined results: null and empty texts have no tokens and match nothing; items
that repeat give a row each; documents that share an id are joined in one row
per item (the longest overlap); empty tables give no rows; other columns, also
of clashing names, are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltlake.llm.arrays import mix64, utf8_column, word_hashes, word_table
from siltlake.llm.blocks import freed
from siltlake.session import checkpoint_dir

WINDOW, MATCHES, LEAST = 13, 11, 8
#: 1: the token counts. Any two mismatches in 13 places are avoided by one of
#: them at some shift (tests check all 78 pairs).
MASKS = ("11101111", "1111010011", "100100110111")
BLOCK_BYTES = 16 << 20
_BITS = 24


def masked_hashes(tokens: np.ndarray, mask: str) -> np.ndarray:
    """A hash of the sampled tokens for each start that has room for the mask."""
    n = max(0, len(tokens) - len(mask) + 1)
    h = np.full(n, len(mask), dtype=np.uint64)
    factors = mix64(np.arange(1, len(mask) + 1, dtype=np.uint64) + np.uint64(int(mask, 2)))
    for k, (bit, factor) in enumerate(zip(mask, factors)):
        if bit == "1":
            h += tokens[k:k + n] * (factor | np.uint64(1))
    return h


class _Index:
    """The masked hashes of a block of items: sorted, with item and place."""

    def __init__(self, item_ids: list[int | None], texts: list[str], masks=MASKS):
        data, offsets = utf8_column(pa.array(texts, pa.string()))
        self.tokens, self.begin = word_hashes(data, offsets, word_table())
        self.ids = item_ids
        size = np.diff(self.begin)
        self.masks = []  # mask, sorted hashes, place of each, bitmap
        short = [("1" * n, size == n) for n in range(LEAST, WINDOW) if (size == n).any()]
        for mask, items in [(m, size >= WINDOW) for m in masks] + short:
            h = masked_hashes(self.tokens, mask)
            item = np.repeat(np.arange(len(size)), size)[:len(h)]
            at = np.arange(len(h))
            keep = items[item] & (at + len(mask) <= self.begin[item + 1])
            h, at = h[keep], at[keep]
            order = np.argsort(h, kind="stable")
            bits = np.zeros(1 << _BITS - 3, dtype=np.uint8)
            top = h >> np.uint64(64 - _BITS)
            np.bitwise_or.at(bits, top >> np.uint64(3), np.uint8(1) << (top & np.uint64(7)).astype(np.uint8))
            self.masks.append((mask, h[order], at[order], bits))

    def hits(self, tokens: np.ndarray, begin: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """Each ``(row, item, diagonal)`` once; the diagonal is the place in
        the row minus the place in the item."""
        seen: set[tuple[int, int, int]] = set()
        for mask, hashes, places, bits in self.masks:
            h = masked_hashes(tokens, mask)
            top = h >> np.uint64(64 - _BITS)
            at = np.flatnonzero((bits[top >> np.uint64(3)] >> (top & np.uint64(7)).astype(np.uint8)) & 1)
            row = np.searchsorted(begin, at, side="right") - 1
            inside = at + len(mask) <= begin[row + 1]
            at, row = at[inside], row[inside]
            lo, hi = (np.searchsorted(hashes, h[at], side=s) for s in ("left", "right"))
            for i in range(0, len(at), 4096):  # bounded work space for items that repeat
                n = (hi - lo)[i:i + 4096]
                own = np.repeat(np.arange(i, i + len(n)), n)
                q = places[np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(lo[i:i + 4096], n)]
                item = np.searchsorted(self.begin, q, side="right") - 1
                diagonal = (at[own] - begin[row[own]]) - (q - self.begin[item])
                seen.update(zip(row[own].tolist(), item.tolist(), diagonal.tolist()))
        return iter(sorted(seen))

    def verify(self, tokens: np.ndarray, item: int, diagonal: int) -> tuple[int, int, int] | None:
        """Along a diagonal of a row's tokens: first token, tokens in passing
        windows, equal tokens there; None if no window passes."""
        own = self.tokens[self.begin[item]:self.begin[item + 1]]
        first = max(0, diagonal)
        last = min(len(tokens), diagonal + len(own))
        width, least = (WINDOW, MATCHES) if len(own) >= WINDOW else (len(own), len(own))
        if last - first < width:
            return None
        equal = tokens[first:last] == own[first - diagonal:last - diagonal]
        total = np.concatenate([[0], np.cumsum(equal)])
        good = np.flatnonzero(total[width:] - total[:-width] >= least)
        if not len(good):
            return None
        covered = np.zeros(len(equal) + 1, dtype=np.int64)
        np.add.at(covered, good, 1)
        np.add.at(covered, good + width, -1)
        covered = np.cumsum(covered)[:-1] > 0
        return first + int(good[0]), int(covered.sum()), int((equal & covered).sum())


def _blocks(benchmark: DataFrame) -> Iterator[tuple[list[int | None], list[str]]]:
    """The items, in blocks of about ``BLOCK_BYTES``, read block by block."""
    size = F.octet_length("text")
    total = benchmark.agg(F.sum(size)).first()[0] or 0
    n = int(total // BLOCK_BYTES) + 1
    for b in range(n):
        own = benchmark if n == 1 else benchmark.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == b)
        rows = own.collect()
        yield [r["item_id"] for r in rows], [r["text"] for r in rows]


def find_overlaps(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_id_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """One row per document and item that share a passing window: doc_id,
    item_id, start_token, n_tokens (in passing windows of the best diagonal),
    n_equal (of these, how many agree)."""
    spark = docs.sparkSession
    checkpoint_dir(spark)
    narrow = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    items = benchmark.select(F.col(item_id_col).cast("long").alias("item_id"),
                             F.col(item_text_col).cast("string").alias("text")).where("text IS NOT NULL")
    schema = "doc_id long, item_id long, start_token long, n_tokens long, n_equal long"

    def scan(ids: list[int], texts: list[str]) -> tuple:
        shared = spark.sparkContext.broadcast((ids, texts))  # at most BLOCK_BYTES and one item

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            index, table = _Index(*shared.value), word_table()
            for batch in batches:
                tokens, begin = word_hashes(*utf8_column(batch.column(1)), table)
                doc_ids, out = batch.column(0).to_pylist(), []
                best: dict[tuple[int, int], tuple[int, int, int]] = {}
                for row, item, diagonal in index.hits(tokens, begin):
                    found = index.verify(tokens[begin[row]:begin[row + 1]], item, diagonal)
                    known = best.get((row, item), (0, 0, 0))
                    if found and (found[2], -found[0]) > (known[2], -known[0]):
                        best[row, item] = found
                for (row, item), found in best.items():
                    out.append((doc_ids[row], index.ids[item], *found))
                columns = list(zip(*out)) or [()] * 5
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns],
                                                 names=["doc_id", "item_id", "start_token", "n_tokens", "n_equal"])
            freed(None)

        return narrow.mapInArrow(run, schema), shared

    parts, last = [], None
    for block in _blocks(items):
        if last is not None:  # one block is done with before the next is sent out
            parts.append(last[0].checkpoint())
            last[1].destroy()
        last = scan(*block)
    found = reduce(DataFrame.union, [*parts, last[0]])
    best = F.max(F.struct("n_equal", (-F.col("start_token")).alias("s"), "n_tokens")).alias("b")
    return found.groupBy("doc_id", "item_id").agg(best).select(
        "doc_id", "item_id", (-F.col("b.s")).alias("start_token"), "b.n_tokens", "b.n_equal")
