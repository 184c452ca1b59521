"""Exact top-k inner products by norm-bucketed retrieval.

Vectors are quantised to integers, ``floor(scale * x)``. The candidates are
sorted by length and cut into buckets of similar length; queries are dealt
into blocks. A block first meets the bucket of the longest vectors, which
gives each query a k-th score to beat. With theta that score, |q| the query's
length and l the longest vector of a bucket, ``theta / (|q| l)`` is the
query's local cosine threshold in the bucket:

* above 1 the bucket holds nothing for the query; blocks are formed anew by
  ``theta / |q|``, so whole buckets are left out for whole blocks;
* from ``COORDINATE_FROM`` on the bucket is pruned by coordinates: the unit
  vectors within that cosine of the query lie within an angle of it in every
  coordinate, which is a range of a list sorted by that coordinate; of the
  query's largest coordinates the list with the shortest range is read, and
  the others are checked;
* below, by length: a vector shorter than ``theta / |q|`` cannot reach theta,
  and the rest is a prefix of the bucket.

What is left is verified by exact integer products. A cell, one block and one
bucket, is one group of bounded size, and hands on at most k rows a query,
which one window a query merges. The work is that of the cells which are left;
both sizes may grow with the executors' memory, so that fewer, larger cells
are shuffled.

Defined results: vectors that are null, empty, hold null or non-finite
components, or a component beyond doubles once scaled, take no part; only
vectors of one dimension are compared; rows equal in id and quantised vector
are one row, other rows that share an id are rows of their own (as a query,
each gets its list), and none of them is a candidate of that id's queries; a
candidate without an id comes last among equal scores; scores beyond 64 bits
are compared and given as the nearest 64-bit number; an empty table gives no
rows; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from siltlake.llm.blocks import freed, pack_arrays, unpack_arrays
from siltlake.session import checkpoint_dir

TOP, SCALE = 20, 64
BUCKET_ROWS, BLOCK_ROWS = 16384, 8192
#: local cosine threshold from which coordinates prune more than they cost
COORDINATE_FROM = 0.8
_FOCUS = 6
_QUERIES_AT_ONCE = 256
_SLACK = 1e-9
_LOW, _HIGH = -(1 << 63), (1 << 63) - 1


def quantised(rows: DataFrame, scale: int, id_col: str, vector_col: str, is_query: Column) -> DataFrame:
    """``(id, dim, norm, v, query)``; v: 16-bit integers if they fit, else doubles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, dims, norms, values = [], [], [], []
            for i, v in enumerate(batch.column(1)):
                if not v.is_valid or not len(v.values) or v.values.null_count:
                    continue
                with np.errstate(over="ignore"):
                    x = np.floor(scale * v.values.to_numpy(zero_copy_only=False).astype("<f8")) + 0.0
                if not np.isfinite(x).all():
                    continue
                most = float(np.abs(x).max())
                at.append(i)
                dims.append(len(x))
                norms.append(min(most * float(np.sqrt(((x / most) ** 2).sum())), 1e300) if most else 0.0)
                values.append((x.astype("<i2") if most < 1 << 15 else x).tobytes())
            kept = pa.array(at, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(kept), pa.array(dims, pa.int32()), pa.array(norms, pa.float64()), pa.array(values, pa.binary()),
                 batch.column(2).take(kept)], names=["id", "dim", "norm", "v", "query"])

    narrow = rows.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("x"),
                         F.coalesce(is_query, F.lit(False)).alias("query"))
    return narrow.mapInArrow(run, "id long, dim int, norm double, v binary, query boolean")


def _matrix(values: list[bytes], dim: int) -> np.ndarray:
    if all(len(v) == 2 * dim for v in values):
        return np.frombuffer(b"".join(values), dtype="<i2").reshape(len(values), dim)
    wide = [np.frombuffer(v, dtype="<i2").astype("<f8") if len(v) == 2 * dim else np.frombuffer(v, dtype="<f8") for v in values]
    return np.vstack(wide)


def packed(rows: DataFrame, order: list[Column], most: int, parts: int) -> DataFrame:
    """``rows(id, dim, norm, v, qid, theta)`` in the given order, in packs of
    up to ``most`` rows of one dimension: ``(pack, dim, longest, need,
    payload)``; longest: the largest norm, need: the least ``theta / norm``.
    Rows equal in all columns are neighbours, and one row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        first, made = TaskContext.get().partitionId() << 32, 0
        open_packs: dict[int, list] = {}
        last = None

        def closed(dim: int) -> pa.RecordBatch:
            nonlocal made
            own = open_packs.pop(dim)
            ids, norms, values, qids, thetas = zip(*own)
            null = np.array([i is None for i in ids], dtype=np.int8)
            matrix = _matrix(list(values), dim)
            norms, thetas = np.array(norms), np.array(thetas)
            need = np.where((norms > 0) & np.isfinite(thetas), thetas / np.maximum(norms, 1e-300), -np.inf).min()
            payload = pack_arrays(np.array([i or 0 for i in ids], dtype=np.int64), null, norms, np.array(qids, dtype=np.int64), thetas,
                                  np.frombuffer(matrix.dtype.str.encode(), dtype=np.uint8), matrix.ravel())
            made += 1
            return pa.RecordBatch.from_arrays(
                [pa.array([first + made]), pa.array([dim], pa.int32()), pa.array([norms.max()]), pa.array([need]), pa.array([payload])],
                names=["pack", "dim", "longest", "need", "payload"])

        for batch in batches:
            for row in zip(*(batch.column(i).to_pylist() for i in range(6))):
                if row == last:
                    continue
                last, (i, dim, norm, v, qid, theta) = row, row
                own = open_packs.setdefault(dim, [])
                own.append((i, norm, v, qid, -np.inf if theta is None else theta))
                if len(own) >= most:
                    yield closed(dim)
        for dim in list(open_packs):
            yield closed(dim)

    columns = ["id", "dim", "norm", "v", "qid", "theta"]
    return (rows.select(*columns).repartitionByRange(parts, *order).sortWithinPartitions(*order)
            .mapInArrow(run, "pack long, dim int, longest double, need double, payload binary"))


class Pack:
    """The rows of a pack."""

    def __init__(self, payload: bytes, dim: int):
        self.ids, self.null, self.norms, self.qids, self.thetas, kind, values = unpack_arrays(payload, "<i8", "i1", "<f8", "<i8", "<f8", "u1", "u1")
        self.values = values.view(kind.tobytes().decode()).reshape(-1, dim).astype("<f8")


def lowered(x: np.ndarray) -> np.ndarray:
    """Bounds with room for the rounding of doubles."""
    return x - np.abs(x) * _SLACK


class Bucket:
    """Candidates by falling length, and their lists by coordinate."""

    def __init__(self, pack: Pack):
        order = np.argsort(-pack.norms, kind="stable")
        self.ids, self.null, self.norms, self.values = pack.ids[order], pack.null[order], pack.norms[order], pack.values[order]
        self.units = self.values / np.maximum(self.norms, 1e-300)[:, None]
        self.lists: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def coordinate(self, f: int) -> tuple[np.ndarray, np.ndarray]:
        if f not in self.lists:
            order = np.argsort(self.units[:, f], kind="stable")
            self.lists[f] = order, self.units[order, f]
        return self.lists[f]

    def within(self, unit: np.ndarray, cosine: float) -> np.ndarray:
        """Candidates whose coordinates allow that cosine with ``unit``."""
        focus = np.argsort(-np.abs(unit))[:_FOCUS]
        angle, own = math.acos(min(1.0, cosine)) + 1e-7, np.arccos(np.clip(unit[focus], -1, 1))
        low = np.where(own + angle >= math.pi, -1.0, np.cos(np.minimum(own + angle, math.pi))) - 1e-7
        high = np.where(own <= angle, 1.0, np.cos(np.maximum(own - angle, 0))) + 1e-7
        ranges = []
        for f, a, b in zip(focus.tolist(), low, high):
            values = self.coordinate(f)[1]
            ranges.append((np.searchsorted(values, a), np.searchsorted(values, b, side="right")))
        best = min(range(len(ranges)), key=lambda k: ranges[k][1] - ranges[k][0])
        some = self.coordinate(int(focus[best]))[0][ranges[best][0]:ranges[best][1]]
        for k, f in enumerate(focus.tolist()):
            if k != best:
                x = self.units[some, f]
                some = some[(x >= low[k]) & (x <= high[k])]
        return some


def products(queries: np.ndarray, candidates: np.ndarray, bound: float) -> np.ndarray:
    """All inner products, exact; ``bound``: the largest product of lengths."""
    if bound < 1 << 52:
        return (queries @ candidates.T).astype(np.int64)
    theirs = [[int(x) for x in row] for row in candidates]
    out = np.empty((len(queries), len(theirs)), dtype=np.int64)
    for i, row in enumerate(queries):
        own = [int(x) for x in row]
        out[i] = [min(_HIGH, max(_LOW, sum(a * b for a, b in zip(own, other)))) for other in theirs]
    return out


def cell(queries: Pack, bucket: Bucket, top: int, counts: dict[str, int] | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(query row, candidate row, score)`` of at most ``top`` candidates for each
    query, every one that may be among its best. ``counts`` gets what was done."""
    longest = float(bucket.norms[0])
    theta = lowered(queries.thetas)
    reach = np.where((queries.norms > 0) & np.isfinite(theta), theta / np.maximum(queries.norms, 1e-300), -np.inf)
    local = reach / longest if longest else np.where(reach > 0, 2.0, -1.0)
    by_coordinate = np.flatnonzero((local >= COORDINATE_FROM) & (local <= 1 + _SLACK))
    by_length = np.flatnonzero(local < COORDINATE_FROM)
    out: list[tuple] = []

    def best(rows: np.ndarray, some: np.ndarray, scores: np.ndarray) -> None:
        """Of the scores (query, candidate) those that may be among the best."""
        own = (queries.ids[rows][:, None] == bucket.ids[some][None, :]) & ((queries.null[rows][:, None] | bucket.null[some][None, :]) == 0)
        some_theta = np.ceil(np.clip(theta[rows], -9.2e18, 9.2e18)).astype(np.int64)
        least = np.where(theta[rows] > -9.2e18, some_theta, _LOW)
        ranked = np.where(own, _LOW, scores)
        if len(some) > top:
            least = np.maximum(least, np.partition(ranked, len(some) - top, axis=1)[:, len(some) - top])
        i, j = np.nonzero(~own & (scores >= least[:, None]))
        order = np.lexsort((bucket.ids[some][j], bucket.null[some][j], ~scores[i, j], i))  # ~x falls as x rises, without overflow
        i, j = i[order], j[order]
        starts = np.flatnonzero(np.diff(i, prepend=-1))
        place = np.arange(len(i)) - np.repeat(starts, np.diff(np.append(starts, len(i))))
        i, j = i[place < top], j[place < top]
        out.append((rows[i], some[j], scores[i, j]))

    pairs = 0
    for q in by_coordinate.tolist():
        some = bucket.within(queries.values[q] / queries.norms[q], float(local[q]))
        some = some[bucket.norms[some] >= reach[q]]
        pairs += len(some)
        if len(some):
            own = queries.values[q:q + 1]
            best(np.array([q]), some, products(own, bucket.values[some], float(queries.norms[q]) * longest))
    prefix = np.searchsorted(-bucket.norms, -reach[by_length], side="right")
    order = np.argsort(prefix, kind="stable")
    for at in range(0, len(order), _QUERIES_AT_ONCE):
        rows, most = by_length[order[at:at + _QUERIES_AT_ONCE]], int(prefix[order[at:at + _QUERIES_AT_ONCE]].max())
        pairs += len(rows) * most
        if most:
            bound = float(queries.norms[rows].max()) * longest
            best(rows, np.arange(most), products(queries.values[rows], bucket.values[:most], bound))
    if counts is not None:
        for name, n in (("skipped", len(local) - len(by_coordinate) - len(by_length)), ("coordinate", len(by_coordinate)),
                        ("length", len(by_length)), ("products", pairs)):
            counts[name] = counts.get(name, 0) + n
    if not out:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64)
    return tuple(np.concatenate(x) for x in zip(*out))


def _met(cells: DataFrame, blocks: DataFrame, buckets: DataFrame, top: int) -> DataFrame:
    """``(qid, query_id, vec_id, score)`` of the cells ``(block, bucket)``."""

    def run(table: pa.Table) -> pa.Table:
        parts = []
        for i in range(table.num_rows):
            dim = table.column("dim")[i].as_py()
            queries = Pack(table.column("queries")[i].as_buffer(), dim)
            bucket = Bucket(Pack(table.column("candidates")[i].as_buffer(), dim))
            q, c, scores = cell(queries, bucket, top)
            parts.append(pa.table([pa.array(queries.qids[q]), pa.array(queries.ids[q], mask=queries.null[q].astype(bool)),
                                   pa.array(bucket.ids[c], mask=bucket.null[c].astype(bool)), pa.array(scores)],
                                  names=["qid", "query_id", "vec_id", "score"]))
        return freed(pa.concat_tables(parts))

    whole = (cells.join(blocks.select(F.col("pack").alias("block"), "dim", F.col("payload").alias("queries")), "block")
             .join(buckets.select(F.col("pack").alias("bucket"), F.col("payload").alias("candidates")), "bucket"))
    return whole.groupBy("block", "bucket").applyInArrow(run, "qid long, query_id long, vec_id long, score long")


def top_products(rows: DataFrame, is_query: Column, top: int = TOP, scale: int = SCALE, id_col: str = "vec_id",
                 vector_col: str = "embedding", bucket_rows: int = BUCKET_ROWS, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: for each row that ``is_query``
    selects, the ``top`` other rows of the largest inner product."""
    checkpoint_dir(rows.sparkSession)
    none = F.lit(None).cast("double")
    vectors = quantised(rows, scale, id_col, vector_col, is_query).checkpoint()
    n = vectors.count()
    order = [F.desc("norm"), F.xxhash64("id"), F.col("id"), F.col("v")]
    candidates = vectors.select("id", "dim", "norm", "v", F.lit(0).cast("long").alias("qid"), none.alias("theta"))
    buckets = packed(candidates, order, bucket_rows, max(1, math.ceil(n / bucket_rows))).checkpoint()
    queries = (vectors.where("query").select("id", "dim", "norm", "v").distinct()
               .withColumn("qid", F.monotonically_increasing_id()).checkpoint())  # numbered once, then read
    parts = max(1, math.ceil(queries.count() / block_rows))

    blocks = packed(queries.withColumn("theta", none), [F.col("qid")], block_rows, parts).checkpoint()
    longest = buckets.groupBy("dim").agg(F.max_by("pack", F.struct("longest", "pack")).alias("bucket"))
    first = blocks.select(F.col("pack").alias("block"), "dim").join(longest, "dim").select("block", "bucket")
    found = _met(first, blocks, buckets, top).checkpoint()

    reached = found.groupBy(F.col("qid").alias("_q")).agg(F.count("*").alias("_n"), F.min("score").alias("_least"))
    beat = queries.join(reached, F.col("qid") == F.col("_q"), "left").withColumn("theta", F.when(F.col("_n") >= top, F.col("_least").cast("double")))
    need = F.when(F.col("norm") > 0, F.col("theta") / F.col("norm"))
    blocks = packed(beat, [F.desc_nulls_last(need), F.col("qid")], block_rows, parts).checkpoint()
    slack = F.col("need") - F.abs("need") * _SLACK
    left = (blocks.select(F.col("pack").alias("block"), "dim", slack.alias("need"))
            .join(buckets.select(F.col("pack").alias("bucket"), F.col("dim"), "longest"), "dim")
            .where((F.col("longest") >= F.col("need")) | F.isnan("need")).join(longest, ["dim", "bucket"], "left_anti"))
    found = found.union(_met(left.select("block", "bucket"), blocks, buckets, top))
    best = Window.partitionBy("qid").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"))
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top).select("query_id", "rank", "vec_id", "score")


def top_sql(modulus: int = 20, top: int = TOP, scale: int = SCALE) -> str:
    """The same in DuckDB SQL over ``embeddings``, queries by ``vec_id % modulus``."""
    return f"""
WITH v AS (SELECT DISTINCT vec_id, list_transform(embedding, lambda x: floor({scale} * CAST(x AS DOUBLE))) AS q FROM embeddings
           WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS query_id, b.vec_id, CAST(list_dot_product(a.q, b.q) AS BIGINT) AS score
      FROM v a JOIN v b ON len(a.q) = len(b.q) AND a.vec_id <> b.vec_id WHERE a.vec_id % {modulus} = 0),
k AS (SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM s)
SELECT query_id, rank, vec_id, score FROM k WHERE rank <= {top}"""
