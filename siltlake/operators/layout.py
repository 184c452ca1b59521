"""Declared partitioning -> label columns -> partitioned / clustered writes
(L1-L7, O5).

Labels are plain expressions (codegen, no shuffle). Writes shuffle once with
a rebalance on the labels, so one big label is split over several tasks and
files instead of landing in one task.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltlake import spec as S
from siltlake.functions.columns import (
    hash_label, key_label, key_part_col, linear_hash_label, range_label,
)

LABEL = "_part"
SUBLABEL = "_subpart"


def _exprs(p: S.PartitionSpec) -> list[Column]:
    if p.columns:
        return [F.col(c) for c in p.columns]
    return [F.expr(p.expr)]


def partition_hash(df: DataFrame, expr: str | Column, n: int, linear: bool = False, label: str = LABEL) -> DataFrame:
    """``PARTITION BY [LINEAR] HASH(expr) PARTITIONS n`` (L1, L2)."""
    lab = linear_hash_label(expr, n) if linear else hash_label(expr, n)
    return df.withColumn(label, lab.cast("int"))


def partition_key(df: DataFrame, cols: list[str], n: int, linear: bool = False, label: str = LABEL) -> DataFrame:
    """``PARTITION BY [LINEAR] KEY(cols) PARTITIONS n`` (L3), md5-based so any
    engine can reproduce the label."""
    return df.withColumn(label, key_label(cols, n, linear).cast("int"))


def partition_range(df: DataFrame, values: str | list[str] | Column, bounds: list, names: list[str] | None = None,
                    label: str = LABEL) -> DataFrame:
    """``PARTITION BY RANGE(expr)`` or ``RANGE COLUMNS(c1, c2…)`` (L4): first
    partition whose ``VALUES LESS THAN`` bound is strictly greater; None is
    MAXVALUE; tuples compare lexicographically; unrouted / NULL -> NULL."""
    if isinstance(values, Column):
        vals = [values]
    elif isinstance(values, str):
        vals = [F.expr(values)]
    else:
        vals = [F.col(c) if isinstance(c, str) else c for c in values]
    return df.withColumn(label, range_label(vals, bounds, names))


def partition_list(df: DataFrame, values: str | list[str] | Column, lists: list, names: list[str] | None = None,
                   label: str = LABEL) -> DataFrame:
    """``PARTITION BY LIST(expr)`` / ``LIST COLUMNS`` (L5): membership; none -> NULL.

    One path for any number of members: a left join with the (member -> label)
    table of the declaration, typed like the values; a value that is declared
    twice, in one spelling or in two, has the label declared first. The table is
    as small as the declaration, so Spark broadcasts it by its size."""
    if isinstance(values, Column):
        vals = [values]
    elif isinstance(values, str):
        vals = [F.expr(values)]
    else:
        vals = [F.col(c) if isinstance(c, str) else c for c in values]
    names = names or [f"p{i}" for i in range(len(lists))]
    keys = [f"_lv{i}" for i in range(len(vals))]
    tagged = df.select("*", *[v.alias(k) for v, k in zip(vals, keys)])
    types = [tagged.schema[k].dataType for k in keys]
    labels: dict[tuple, str] = {}
    for name, members in zip(names, lists):
        for m in members:
            member = tuple(None if x is None else str(x) for x in (m if isinstance(m, tuple) else (m,)))
            labels.setdefault(member, name)
    members = df.sparkSession.createDataFrame([(*m, name, k) for k, (m, name) in enumerate(labels.items())],
                                              ", ".join(f"_lm{i} string" for i in range(len(keys))) + f", `{label}` string, _at int")
    # two spellings of one value ('1', '1.0') meet after the cast: the first declared counts
    members = members.select(*[F.col(f"_lm{i}").try_cast(t).alias(f"_lm{i}") for i, t in enumerate(types)], label, "_at")
    members = members.groupBy(*[f"_lm{i}" for i in range(len(keys))]).agg(F.min_by(label, "_at").alias(label))
    cond = reduce(lambda x, y: x & y, [F.col(k) == F.col(f"_lm{i}") for i, k in enumerate(keys)])
    return tagged.join(members, cond, "left").select(*[F.col(f"`{c}`") for c in df.columns], label)


def apply_partitioning(df: DataFrame, p: S.PartitionSpec, label: str = LABEL) -> DataFrame:
    """Label rows per a declared :class:`PartitionSpec` (and its sub-level, L6)."""
    kind = p.kind.lower()
    if kind == "hash":
        out = partition_hash(df, _exprs(p)[0], p.count or 1, p.linear, label)
    elif kind == "key":
        out = partition_key(df, list(p.columns), p.count or 1, p.linear, label)
    elif kind == "range":
        out = partition_range(df, _exprs(p) if p.columns else _exprs(p)[0], list(p.bounds), list(p.names) or None, label)
    elif kind == "list":
        out = partition_list(df, _exprs(p) if p.columns else _exprs(p)[0], list(p.lists), list(p.names) or None, label)
    else:
        raise ValueError(p.kind)
    if p.sub is not None:
        out = subpartition(out, p.sub, SUBLABEL)
    return out


def subpartition(df: DataFrame, sub: S.PartitionSpec, label: str = SUBLABEL) -> DataFrame:
    """``SUBPARTITION BY [LINEAR] HASH | KEY … SUBPARTITIONS n`` (L6): a
    second label computed inside each first-level partition."""
    kind = sub.kind.lower()
    if kind == "hash":
        return partition_hash(df, _exprs(sub)[0], sub.count or 1, sub.linear, label)
    if kind == "key":
        return partition_key(df, list(sub.columns), sub.count or 1, sub.linear, label)
    raise ValueError("subpartitions are HASH or KEY")


def write_partitioned(df: DataFrame, path: str, labels: list[str] = (LABEL,), mode: str = "overwrite",
                      unrouted_path: str | None = None, max_records_per_file: int | None = None) -> None:
    """Labelled write (L7): readers prune on the label directories.

    Rows go through a ``REBALANCE(labels)`` shuffle: adaptive execution
    coalesces small labels into few files and splits a skewed label (say, one
    holding a third of the table) into partitions of the advisory size, so no
    task writes a whole hot label. Unrouted rows (NULL label) go to
    ``unrouted_path`` (quarantine) when given."""
    labels = list(labels)
    routed = df
    if unrouted_path is not None:
        cond = None
        for lab in labels:
            c = F.col(lab).isNull()
            cond = c if cond is None else cond | c
        df.where(cond).write.mode(mode).parquet(unrouted_path)
        routed = df.where(~cond)
    w = routed.hint("rebalance", *labels).write.mode(mode).partitionBy(*labels)
    if max_records_per_file:
        w = w.option("maxRecordsPerFile", max_records_per_file)
    w.parquet(path)


def cluster_exprs(key_parts) -> list[Column]:
    out = []
    for p in S.key_columns(key_parts):
        c = key_part_col(p)
        out.append(c.desc() if p.descending else c.asc())
    return out


def clustered(df: DataFrame, key_parts, num_partitions: int | None = None) -> DataFrame:
    """Range-partition and sort by the declared key-part order (O5):
    ASC/DESC, column prefixes and expressions. Each output file then covers a
    narrow key range, so Parquet min/max statistics prune scans."""
    order = cluster_exprs(key_parts)
    # without an explicit count, adaptive execution sizes the range partitions
    ranged = df.repartitionByRange(num_partitions, *order) if num_partitions else df.repartitionByRange(*order)
    return ranged.sortWithinPartitions(*order)


def write_clustered(df: DataFrame, path: str, key_parts, num_partitions: int | None = None,
                    mode: str = "overwrite") -> None:
    clustered(df, key_parts, num_partitions).write.mode(mode).parquet(path)
