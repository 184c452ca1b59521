"""Embedding near-duplicates: Euclidean p-stable hashing, then exact cosine.

On unit vectors a cosine of at least c is a distance of at most sqrt(2 - 2c).
Each of several tables quantises Gaussian projections of the unit vector into
cells and uses the cell numbers together as a bucket key. The number of
projections follows the number of vectors (so that unrelated vectors seldom
meet), the number of tables follows from the wanted recall at the threshold
itself; closer pairs are found with higher probability.

Equal vectors are one class before any pair is formed. A task compares the
vectors of one tile of a bucket (see ``groups``) by cosine in double
precision, counts a pair only in the first table where the two meet, and hands
on counts and a spanning forest of the links, never the pairs.

Defined results: vectors that are null, empty, zero or hold null or non-finite
components link with nothing, and neither do vectors of different length;
repeated rows are linked; an empty table gives no rows; other columns are
ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltlake.llm.arrays import mix64
from siltlake.llm.components import components
from siltlake.llm.groups import map_runs, merge, tiles
from siltlake.session import checkpoint_dir

COSINE, RECALL, WIDTH = 0.95, 0.998, 1.5
_SEED = 20240601


def cell_probability(distance: float, width: float) -> float:
    """That one projection puts two vectors of this distance in one cell."""
    r = width / distance
    normal = 0.5 * math.erfc(r / math.sqrt(2))
    return 1 - 2 * normal - 2 / (math.sqrt(2 * math.pi) * r) * (1 - math.exp(-r * r / 2))


def table_sizes(n: int, cosine: float = COSINE, recall: float = RECALL, width: float = WIDTH) -> tuple[int, int]:
    """``(projections a table, tables)`` for n vectors: about 16 unrelated
    vectors a bucket, and the recall at the threshold."""
    near = cell_probability(math.sqrt(2 - 2 * cosine), width)
    far = cell_probability(math.sqrt(2), width)
    k = max(6, math.ceil(math.log(max(n, 32) / 16) / -math.log(far)))
    return k, math.ceil(math.log(1 - recall) / math.log(1 - near ** k))


class _Tables:
    """Bucket keys of unit vectors, the same in every task."""

    def __init__(self, k: int, tables: int, width: float):
        self.k, self.tables, self.width, self.drawn = k, tables, width, {}

    def keys(self, unit: np.ndarray) -> np.ndarray:
        dim = unit.shape[1]
        if dim not in self.drawn:
            rng = np.random.default_rng([_SEED, dim])
            self.drawn[dim] = (rng.standard_normal((dim, self.k * self.tables)), rng.random(self.k * self.tables) * self.width)
        directions, shifts = self.drawn[dim]
        out = np.empty((len(unit), self.tables), dtype=np.uint64)
        for at in range(0, len(unit), 4096):
            cells = np.floor((unit[at:at + 4096] @ directions + shifts) / self.width).astype(np.int64).view(np.uint64)
            h = np.broadcast_to(mix64(np.arange(1, self.tables + 1, dtype=np.uint64) + np.uint64(dim << 20)), (len(cells), self.tables)).copy()
            for j in range(self.k):
                h = mix64(h ^ (cells[:, j::self.k] + np.uint64(j + 1)))
            out[at:at + 4096] = h
        return out


def _units(vectors: list[bytes]) -> np.ndarray:
    x = np.frombuffer(b"".join(vectors), dtype="<f8").reshape(len(vectors), -1)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def vector_table(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """vec_id and the components as little-endian doubles, scaled by a power of
    two so that squares neither vanish nor overflow; null where the vector
    links with nothing."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for v in batch.column(1):
                x = None
                if v.is_valid and len(v.values) and not v.values.null_count:
                    x = v.values.to_numpy(zero_copy_only=False).astype("<f8") + 0.0  # no -0.0
                    if not np.isfinite(x).all() or not x.any():
                        x = None
                    else:
                        x = np.ldexp(x, -int(np.frexp(np.abs(x).max())[1])) + 0.0
                out.append(None if x is None else x.tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.binary())], names=["vec_id", "vector"])

    narrow = rows.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v"))
    return narrow.mapInArrow(run, "vec_id long, vector binary")


def cosine_links(classes: DataFrame, n: int, cosine: float = COSINE, recall: float = RECALL, width: float = WIDTH,
                 most: int = 1024) -> DataFrame:
    """From ``classes(id, n, vector)``: ``(u, v, n_links)`` rows, several per
    u: rows of other classes linked with class u, and u's root in its tile."""
    k, tables = table_sizes(n, cosine, recall, width)

    def bucket(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashing = _Tables(k, tables, width)
        for batch in batches:
            ids, vectors = batch.column(0).to_numpy(zero_copy_only=False), batch.column(1).to_pylist()
            sizes = np.array([len(v) for v in vectors])
            for size in np.unique(sizes):
                own = np.flatnonzero(sizes == size)
                keys = hashing.keys(_units([vectors[i] for i in own]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat(ids[own], tables)), pa.array(np.tile(np.arange(tables, dtype=np.int32), len(own))),
                     pa.array(keys.ravel().view(np.int64))], names=["id", "tab", "key"])

    def compare(batch: pa.RecordBatch, starts: np.ndarray) -> Iterator[pa.RecordBatch]:
        hashing = _Tables(k, tables, width)
        ids, number, table, own, a, b = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("id", "n", "tab", "_own", "_a", "_b"))
        vectors = batch.column("vector").to_pylist()
        us, vs, counts = [], [], []
        for s, e in pairwise(starts):
            if len({len(v) for v in vectors[s:e]}) > 1:
                continue  # a chance meeting of keys: vectors of different length never link
            unit, t = _units(vectors[s:e]), int(table[s])
            inside = a[s] == b[s]
            left = np.arange(e - s) if inside else np.flatnonzero(own[s:e] == a[s])
            right = left if inside else np.flatnonzero(own[s:e] == b[s])
            i, j = np.nonzero(unit[left] @ unit[right].T >= cosine)
            i, j = left[i], right[j]
            if inside:
                i, j = i[i < j], j[i < j]
            if not len(i):
                continue
            if t:  # a pair that has met in an earlier table is counted there
                members = np.unique(np.concatenate([i, j]))
                keys = np.zeros((e - s, t), dtype=np.uint64)
                keys[members] = hashing.keys(unit[members])[:, :t]
                new = np.ones(len(i), dtype=bool)
                for c in range(t):
                    new &= keys[i, c] != keys[j, c]
                i, j = i[new], j[new]
            links, weight = np.zeros(e - s, dtype=np.int64), number[s:e]
            np.add.at(links, i, weight[j])
            np.add.at(links, j, weight[i])
            label = merge(np.arange(e - s), i, j)
            linked = np.flatnonzero(links)
            us.append(ids[s:e][linked])
            vs.append(ids[s:e][label[linked]])
            counts.append(links[linked])
        empty = np.empty(0, np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([empty, *x])) for x in (us, vs, counts)], names=["u", "v", "n_links"])

    keys = classes.select("id", "vector").mapInArrow(bucket, "id long, tab int, key long")
    tiled = tiles(keys, "key", "id", most).join(classes, "id")
    return map_runs(tiled.select("id", "n", "vector", "tab", "key", "_own", "_a", "_b"), ["tab", "key", "_a", "_b"], compare,
                    "u long, v long, n_links long")


def near_vectors(rows: DataFrame, cosine: float = COSINE, recall: float = RECALL, width: float = WIDTH,
                 id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """vec_id, n_links, component_id, kept; one row per vector."""
    checkpoint_dir(rows.sparkSession)
    own = vector_table(rows, id_col, vector_col).checkpoint()
    classes = own.where("vector IS NOT NULL").groupBy("vector").agg(F.min("vec_id").alias("id"), F.count("*").alias("n")).checkpoint()
    found = cosine_links(classes.where("id IS NOT NULL"), classes.count(), cosine, recall, width).checkpoint()
    joined = components(found.select("u", "v"))
    totals = found.groupBy("u").agg(F.sum("n_links").alias("more"))
    reached = (classes.join(totals, classes["id"] == totals["u"], "left").join(joined, classes["id"] == joined["node"], "left")
               .select("vector", (F.coalesce("more", F.lit(0)) + F.col("n") - 1).alias("n_links"),
                       F.coalesce("component", "id").alias("component_id")))
    out = own.join(reached, "vector", "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component_id", "vec_id").alias("component_id"))
    return out.withColumn("kept", F.col("vec_id") == F.col("component_id"))
