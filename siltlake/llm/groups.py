"""Comparing all rows that share a key, without a task that grows with a key.

``tiles`` cuts a key with more than ``most`` rows into blocks; a tile is a pair
of blocks, so every pair of rows of the key meets in exactly one tile and no
tile holds more than about ``2 * most`` rows. ``map_runs`` hands whole tiles to
a numpy function, many per call, and keeps only unfinished tiles in memory.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def tiles(rows: DataFrame, key: str, item: str, most: int = 2048) -> DataFrame:
    """``rows`` of keys with at least two rows, once per tile: ``_a``, ``_b``
    name the tile (``_a <= _b``) and ``_own`` is the row's own block."""
    sizes = rows.groupBy(key).agg(F.count("*").alias("_n")).where("_n > 1")
    blocks = F.ceil(F.col("_n") / most).cast("int")
    own = rows.join(sizes, key).withColumn("_blocks", blocks).drop("_n")
    own = own.withColumn("_own", F.when(F.col("_blocks") > 1, F.pmod(F.xxhash64(item), F.col("_blocks"))).otherwise(0).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)).alias("_j")
    return own.select("*", other).select(
        *rows.columns, "_own", F.least("_own", "_j").alias("_a"), F.greatest("_own", "_j").alias("_b"))


def map_runs(rows: DataFrame, keys: list[str], fn: Callable[[pa.RecordBatch, np.ndarray], Iterator[pa.RecordBatch]],
             schema: str) -> DataFrame:
    """``fn(batch, starts)`` over whole runs of rows with equal numeric
    ``keys``; ``starts`` are the first rows of the runs and the row count."""

    def changes(batch: pa.RecordBatch) -> np.ndarray:
        new = np.zeros(batch.num_rows, dtype=bool)
        new[:1] = True
        for k in keys:
            x = batch.column(k).to_numpy(zero_copy_only=False)
            new[1:] |= x[1:] != x[:-1]
        return np.flatnonzero(new)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            if kept and all(kept[-1].column(k)[-1] == batch.column(k)[0] for k in keys) and len(changes(batch)) == 1:
                kept.append(batch)  # the run goes on
                continue
            whole = pa.concat_batches([*kept, batch])
            starts = changes(whole)
            if len(starts) > 1:
                yield from fn(whole.slice(0, int(starts[-1])), starts)
            kept = [whole.slice(int(starts[-1]))]
        if kept:
            whole = pa.concat_batches(kept)
            yield from fn(whole, np.array([0, whole.num_rows]))

    return rows.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(run, schema)


def merge(label: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Component labels (smallest index reached) after linking i with j."""
    while True:
        a, b = label[i], label[j]
        low = np.minimum(a, b)
        new = label.copy()
        for at in (i, j, a, b):
            np.minimum.at(new, at, low)
        new = new[new]
        if (new == label).all():
            return label
        label = new
