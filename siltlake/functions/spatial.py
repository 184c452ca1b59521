"""Spatial values: WKB (optionally with a leading 4-byte SRID) -> WKT text.

Spark 4.1 has no ``st_astext``; this is the one vectorised Python step of the
library. It runs per Arrow batch inside the executors: points, lines, polygons
and lists of them, in either byte order and with or without SRID, are decoded
by column; only collections, empty geometries, further dimensions and bad bytes
are read value by value. Bad bytes give NULL (the caller rescues the raw hex).
"""

from __future__ import annotations

import struct

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

try:  # ship this module's code with the UDF, so Python workers need no install
    import sys as _sys

    from pyspark import cloudpickle as _cloudpickle
    _cloudpickle.register_pickle_by_value(_sys.modules[__name__])
except Exception:  # pragma: no cover - older cloudpickle: workers import the package
    pass

# WKB geometry type codes and their WKT names.
WKB_TYPES = {
    1: "POINT",
    2: "LINESTRING",
    3: "POLYGON",
    4: "MULTIPOINT",
    5: "MULTILINESTRING",
    6: "MULTIPOLYGON",
    7: "GEOMETRYCOLLECTION",
}


class _Bad(Exception):
    pass


# A collection nested deeper than this is taken as bad bytes.
MAX_DEPTH = 32


def _num(v: float) -> str:
    if v != v or v in (float("inf"), float("-inf")):
        raise _Bad()
    if v == int(v) and abs(v) < 1e15:
        return str(int(v))
    return repr(v)


class _Reader:
    __slots__ = ("b", "i", "depth")

    def __init__(self, b: bytes, i: int = 0):
        self.b, self.i, self.depth = b, i, 0

    def take(self, fmt: str):
        size = struct.calcsize(fmt)
        if self.i + size > len(self.b):
            raise _Bad()
        out = struct.unpack_from(fmt, self.b, self.i)
        self.i += size
        return out

    def geometry(self) -> tuple[str, str]:
        self.depth += 1
        if self.depth > MAX_DEPTH:
            raise _Bad()
        try:
            return self._geometry()
        finally:
            self.depth -= 1

    def _geometry(self) -> tuple[str, str]:
        (order,) = self.take("B")
        if order not in (0, 1):
            raise _Bad()
        e = "<" if order == 1 else ">"
        (code,) = self.take(e + "I")
        dims = 2
        if code > 1000:  # ISO Z / M / ZM codes
            dims = 3 if (code // 1000) in (1, 2) else 4
            code %= 1000
        if code not in WKB_TYPES:
            raise _Bad()
        name = WKB_TYPES[code]
        return name, self.body(code, e, dims)

    def points(self, e: str, dims: int) -> list[str]:
        (n,) = self.take(e + "I")
        if n > (len(self.b) - self.i) // (8 * dims):
            raise _Bad()
        return [" ".join(_num(v) for v in self.take(e + "d" * dims)) for _ in range(n)]

    def body(self, code: int, e: str, dims: int) -> str:
        if code == 1:
            vals = self.take(e + "d" * dims)
            if any(v != v for v in vals):
                return "EMPTY"
            return "(" + " ".join(_num(v) for v in vals) + ")"
        if code == 2:
            pts = self.points(e, dims)
            return "(" + ",".join(pts) + ")" if pts else "EMPTY"
        if code == 3:
            (rings,) = self.take(e + "I")
            parts = ["(" + ",".join(self.points(e, dims)) + ")" for _ in range(rings)]
            return "(" + ",".join(parts) + ")" if parts else "EMPTY"
        (n,) = self.take(e + "I")
        subs = []
        for _ in range(n):
            name, body = self.geometry()
            subs.append(name + body if code == 7 else body)
        return "(" + ",".join(subs) + ")" if subs else "EMPTY"


def wkb_to_wkt_value(b: bytes | None) -> str | None:
    """Plain WKB, or the SRID-prefixed form some sources store; else None."""
    if b is None:
        return None
    b = bytes(b)
    for start in (0, 4):
        try:
            r = _Reader(b, start)
            name, body = r.geometry()
            if r.i != len(b):
                raise _Bad()
            return name + (" EMPTY" if body == "EMPTY" else body)
        except (_Bad, struct.error):
            continue
    return None


# --------------------------------------------------------------------------
# a batch at once: all kinds but collections, both byte orders, SRID or not
# --------------------------------------------------------------------------

class _Batch:
    """The bytes of many values, read at many places at once."""

    def __init__(self, column: pa.Array):
        column = pc.fill_null(column.cast(pa.large_binary()), b"")
        _, offsets, data = column.buffers()
        self.at = np.frombuffer(offsets, dtype=np.int64)[column.offset:column.offset + len(column) + 1]
        flat = np.frombuffer(data, dtype=np.uint8) if data is not None else np.empty(0, np.uint8)
        self.data = np.concatenate([flat, np.zeros(16, np.uint8)])  # room to read behind the last value

    def uints(self, places: np.ndarray, little: np.ndarray) -> np.ndarray:
        raw = self.data[places[:, None] + np.arange(4)]
        small = np.ascontiguousarray(raw).view("<u4").ravel()
        return np.where(little, small, small.byteswap()).astype(np.int64)

    def doubles(self, places: np.ndarray, little: np.ndarray) -> np.ndarray:
        raw = np.ascontiguousarray(self.data[places[:, None] + np.arange(8)])
        return np.where(little, raw.view("<f8").ravel(), raw.view(">f8").ravel())


def _numbers(values: np.ndarray) -> pa.Array:
    """Numbers as ``_num`` writes them; each different one is written once."""
    distinct, number = np.unique(values, return_inverse=True)
    return pa.array([_num(v) for v in distinct.tolist()], pa.string()).take(pa.array(number))


def _joined(parts: pa.Array, sizes: np.ndarray) -> pa.Array:
    """Runs of ``sizes`` parts, joined by commas, in parentheses."""
    offsets = pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32())
    inside = pc.binary_join(pa.ListArray.from_arrays(offsets, parts), ",")
    return pc.binary_join_element_wise("(", inside, ")", "")


def _spread(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each item of runs of ``sizes``: its run, and its place in the run."""
    run = np.repeat(np.arange(len(sizes)), sizes)
    return run, np.arange(len(run)) - np.repeat(np.cumsum(sizes) - sizes, sizes)


class _Walk:
    """A cursor in each of some values of one kind; a value that does not read
    as declared, to its last byte, is not ``good``."""

    def __init__(self, batch: _Batch, rows: np.ndarray, start: np.ndarray, little: np.ndarray):
        self.batch, self.rows, self.little = batch, rows, little
        self.cursor, self.end = start.copy(), batch.at[rows + 1]
        self.good = np.ones(len(rows), dtype=bool)

    def fits(self, who: np.ndarray, size) -> np.ndarray:
        """Of ``who`` those with ``size`` bytes left; the others are bad."""
        enough = self.end[who] - self.cursor[who] >= size
        self.good[who[~enough]] = False
        return enough

    def counts(self, who: np.ndarray, least: int) -> np.ndarray:
        """A count at each cursor, of items of at least ``least`` bytes; 0 where it cannot be."""
        out, ok = np.zeros(len(who), np.int64), self.fits(who, 4)
        out[ok] = self.batch.uints(self.cursor[who[ok]], self.little[who[ok]])
        self.cursor[who[ok]] += 4
        possible = out <= (self.end[who] - self.cursor[who]) // least
        self.good[who[~possible]] = False
        return np.where(ok & possible, out, 0)

    def heads(self, who: np.ndarray, code: int) -> None:
        """The head of a member, of the value's own byte order and this kind."""
        ok = self.fits(who, 5)
        mine = who[ok]
        same = (self.batch.data[self.cursor[mine]] == self.little[mine]) & (self.batch.uints(self.cursor[mine] + 1, self.little[mine]) == code)
        self.good[mine[~same]] = False
        self.cursor[mine] += 5

    def skip_points(self, who: np.ndarray, n: np.ndarray) -> np.ndarray:
        """Where ``n`` points begin, and past them."""
        start = self.cursor[who].copy()
        self.cursor[who] += 16 * np.where(self.fits(who, 16 * n), n, 0)
        return start


def _levels(walk: _Walk, code: int) -> tuple[list[np.ndarray], np.ndarray, np.ndarray, np.ndarray]:
    """Sizes of the lists from the outer to the inner one, in order, then for
    each innermost list its value, where its points begin and how many they are."""
    every = np.arange(len(walk.rows))
    one = np.ones(len(every), np.int64)
    if code == 1:
        return [], every, walk.skip_points(every, one), one
    if code == 2:
        n = walk.counts(every, 16)
        return [], every, walk.skip_points(every, n), n
    outer = walk.counts(every, {3: 4, 4: 21, 5: 9, 6: 9}[code])
    found = []  # (value, member, ring, start, points)
    rings_of = []  # (value, member, rings), of polygons in a list
    for member in range(int(outer.max(initial=0))):
        who = np.flatnonzero((outer > member) & walk.good)
        if not len(who):
            break
        if code != 3:
            walk.heads(who, code - 3)
        if code == 4:
            found.append((who, member, 0, walk.skip_points(who, np.ones(len(who), np.int64)), np.ones(len(who), np.int64)))
        elif code in (3, 5):
            n = walk.counts(who, 16)
            found.append((who, member, 0, walk.skip_points(who, n), n))
        else:
            rings = walk.counts(who, 4)
            rings_of.append((who, member, rings))
            for ring in range(int(rings.max(initial=0))):
                mine = who[(rings > ring) & walk.good[who]]
                n = walk.counts(mine, 16)
                found.append((mine, member, ring, walk.skip_points(mine, n), n))

    def stacked(rows: list[tuple], width: int) -> list[np.ndarray]:
        full = [np.concatenate([np.broadcast_to(r[k], len(r[0])) for r in rows] or [np.empty(0, np.int64)]) for k in range(width)]
        order = np.lexsort(full[:2][::-1] if width == 3 else full[:3][::-1])
        return [x[order] for x in full]

    value, _, _, start, n = stacked(found, 5)
    return ([outer] if code != 6 else [outer, stacked(rings_of, 3)]), value, start, n


def columnar_wkt(column: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """``(done, text)``: the values that are read here, all finite geometries
    of two dimensions without collections, and their texts in that order."""
    batch = _Batch(column)
    size = np.diff(batch.at)
    rows, texts = [], []
    left = size >= 9
    for skip in (0, 4):  # a plain value is not taken for one with an SRID
        head = batch.at[:-1] + skip
        readable = np.flatnonzero(left & (size >= 9 + skip))
        order = batch.data[head[readable]]
        readable, order = readable[order < 2], order[order < 2]
        codes = batch.uints(head[readable] + 1, order == 1)
        for code in range(1, 7):
            own = np.flatnonzero(codes == code)
            if len(own):
                done, text = _kind(batch, readable[own], head[readable[own]] + 5, order[own] == 1, code)
                rows.append(done)
                texts.append(text)
                left[done] = False
    if not rows:
        return np.empty(0, np.int64), pa.array([], pa.string())
    return np.concatenate(rows), pa.concat_arrays(texts)


def _kind(batch: _Batch, rows: np.ndarray, start: np.ndarray, little: np.ndarray, code: int) -> tuple[np.ndarray, pa.Array]:
    walk = _Walk(batch, rows, start, little)
    sizes, value, begin, n = _levels(walk, code)
    walk.good &= walk.cursor == walk.end
    for level in sizes:  # lists of nothing are written in a way of their own
        who, many = (level[0], level[2]) if isinstance(level, list) else (np.arange(len(rows)), level)
        walk.good[who[many == 0]] = False
    walk.good[value[n == 0]] = False
    keep = walk.good[value]
    value, begin, n = value[keep], begin[keep], n[keep]
    run, place = _spread(n)
    at, order = begin[run] + 16 * place, little[value[run]]
    x, y = batch.doubles(at, order), batch.doubles(at + 8, order)
    walk.good[value[run[~(np.isfinite(x) & np.isfinite(y))]]] = False
    fine = walk.good[value]
    inside = fine[run]
    n, x, y = n[fine], x[inside], y[inside]
    text = _joined(pc.binary_join_element_wise(_numbers(x), _numbers(y), " "), n)
    for level in reversed(sizes):
        if isinstance(level, list):
            text = _joined(text, level[2][walk.good[level[0]]])
        else:
            text = _joined(text, level[walk.good])
    return rows[walk.good], pc.binary_join_element_wise(WKB_TYPES[code], text, "")


@F.pandas_udf(T.StringType())
def _wkb_to_wkt(s: pd.Series) -> pd.Series:
    out = pd.Series([None] * len(s), index=s.index, dtype=object)
    done, text = columnar_wkt(pa.array(s, pa.binary(), from_pandas=True))
    out.iloc[done] = text.to_numpy(zero_copy_only=False)
    rest = s.notna().to_numpy()
    rest[done] = False  # collections, empty ones, more dimensions, bad bytes
    if rest.any():
        out[rest] = s[rest].map(wkb_to_wkt_value)
    return out


def wkb_to_wkt(c: str | Column) -> Column:
    """Column of WKB bytes -> WKT text (NULL for undecodable bytes)."""
    return _wkb_to_wkt(F.col(c) if isinstance(c, str) else c)
