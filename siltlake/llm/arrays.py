"""Whole Arrow text columns as numpy arrays: bytes, and hashed words.

Nothing here loops over words in Python; work arrays are a few times the size
of one chunk of text, whatever the size of a document or a batch.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK = 1 << 21
_ODD = np.uint64(0x9E3779B97F4A7C15)


def utf8_column(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a text column one after another, and the n + 1 offsets of
    its rows among them; a null is empty."""
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = pc.fill_null(column, b"")
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, dtype=np.int64)[column.offset:column.offset + len(column) + 1]
    flat = np.frombuffer(data, dtype=np.uint8) if data is not None else np.empty(0, np.uint8)
    return flat[at[0]:at[-1]], at - at[0]


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective mix of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_VALUES = mix64(np.arange(1, 257, dtype=np.uint64) * _ODD)


def word_table(separators: bytes | None = None) -> np.ndarray:
    """For each byte, what it is in a word: 0 where it separates words, A-Z
    lowered. Words are runs of bytes not in ``separators``; without it, runs
    of ASCII letters, digits and bytes of non-ASCII characters."""
    table = np.arange(256, dtype=np.uint8)
    table[65:91] += 32
    if separators is not None:
        table[list(separators)] = 0
    else:
        word = np.zeros(256, dtype=bool)
        for a, b in ((48, 58), (65, 91), (97, 123), (128, 256)):
            word[a:b] = True
        table[~word] = 0
    return table


def _powers(n: int) -> np.ndarray:
    p = np.full(n, _ODD, dtype=np.uint64)
    p[0] = 1
    return np.cumprod(p)


def hash_runs(chars: np.ndarray, first: np.ndarray) -> np.ndarray:
    """The 64-bit hash of each run of bytes; a run begins at each ``first``
    (ascending, from 0) and goes on to the next."""
    lengths = np.diff(first, append=len(chars))
    powers = _powers(int(lengths.max()))
    place = np.arange(len(chars)) - np.repeat(first, lengths)
    return mix64(np.add.reduceat(_VALUES[chars] * powers[place], first))


def word_hashes(data: np.ndarray, offsets: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The 64-bit hash of every word of every row, in order, and the n + 1
    positions at which the rows' words begin. No word crosses a row."""
    n, at = len(data), 0
    hashes, starts = [np.empty(0, np.uint64)], [np.empty(0, np.int64)]
    row_starts = np.unique(offsets[:-1])
    row_starts = row_starts[row_starts < n]
    while at < n:
        end = min(at + CHUNK, n)
        while end < n and table[data[end]] and table[data[end - 1]]:  # not inside a word
            gap = np.flatnonzero(table[data[end:end + 4096]] == 0)
            end += int(gap[0]) if len(gap) else min(4096, n - end)
        x = table[data[at:end]]
        word = x != 0
        begins = word.copy()
        begins[1:] &= ~word[:-1]
        lo, hi = np.searchsorted(row_starts, (at, end))
        own = row_starts[lo:hi] - at
        begins[own] |= word[own]
        where = np.flatnonzero(begins)
        if len(where):
            chars = x[word]
            first = np.cumsum(word)[where] - 1
            hashes.append(hash_runs(chars, first))
            starts.append(where + at)
        at = end
    starts = np.concatenate(starts)
    return np.concatenate(hashes), np.searchsorted(starts, offsets)
