"""A predicate on partition keys as label sets (L7): readers of a labelled
write skip the folders that cannot hold a row.

Spark prunes on the label column, not on the key that the label was made
from. ``with_pruning`` adds the label condition beside the predicate itself,
which stays as it is, so the result never depends on the pruning:

* a predicate that leaves finitely many key values is judged by the declared
  partitioning itself, run on those values (any kind, any expression);
* a range on RANGE keys is compared with the bounds, tuples column by column
  as far as the columns are fixed;
* a range on LIST keys is compared with the members.

Rows that no partition takes have a NULL label; it is kept in the condition
where the predicate could reach such rows. Only the declaration and the
predicate's own values are handled on the driver.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from itertools import product
from typing import Any

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltlake import spec as S
from siltlake.operators.layout import LABEL, SUBLABEL, apply_partitioning

#: a predicate on more combinations of values than this is not judged value by value
MAX_VALUES = 4096


@dataclass(frozen=True)
class KeyRange:
    """What a predicate says of one key (a column, or the declared expression):
    one of some values, or from ``lo`` to ``hi``, both included; None is open."""

    values: tuple | None = None
    lo: Any = None
    hi: Any = None

    def condition(self, key: Column) -> Column:
        if self.values is not None:
            return key.isin(*self.values)
        parts = ([key >= F.lit(self.lo)] if self.lo is not None else []) + ([key <= F.lit(self.hi)] if self.hi is not None else [])
        return reduce(lambda a, b: a & b, parts, key.isNotNull())


def equal(value: Any) -> KeyRange:
    return KeyRange(values=(value,))


def among(*values: Any) -> KeyRange:
    return KeyRange(values=tuple(values))


def between(lo: Any = None, hi: Any = None) -> KeyRange:
    return KeyRange(lo=lo, hi=hi)


@dataclass(frozen=True)
class LabelSet:
    """The labels that can hold rows; None: all of them. ``unrouted``: rows
    without a label may match too."""

    labels: frozenset | None = None
    unrouted: bool = True

    def condition(self, label: str) -> Column | None:
        if self.labels is None:
            return None
        c = F.col(label).isin(*sorted(self.labels)) if self.labels else F.lit(False)
        return c | F.col(label).isNull() if self.unrouted else c


def _typed(spark: SparkSession, values: list, dtype: T.DataType) -> list:
    """Values as Spark casts them to the key's type; null where it cannot."""
    rows = spark.createDataFrame([(i, None if v is None else str(v)) for i, v in enumerate(values)], "i int, v string")
    return [r["v"] for r in sorted(rows.select("i", F.col("v").try_cast(dtype).alias("v")).collect(), key=lambda r: r["i"])]


def _finite(spark: SparkSession, key: KeyRange, dtype: T.DataType) -> list | None:
    """The values that the range leaves, if they can be listed."""
    if key.values is not None:
        return [v for v in _typed(spark, list(key.values), dtype) if v is not None]
    if isinstance(dtype, T.IntegralType) and key.lo is not None and key.hi is not None:
        lo, hi = _typed(spark, [key.lo, key.hi], dtype)
        return list(range(lo, hi + 1)) if None not in (lo, hi) and hi - lo < MAX_VALUES else None
    return None


def _judged(df: DataFrame, p: S.PartitionSpec, listed: dict[str, list], dtypes: dict[str, T.DataType]) -> LabelSet | None:
    """The labels of all combinations of listed values, by the declaration;
    None if it needs a column that is not listed."""
    names = [c for c in listed if c in dtypes]
    size = reduce(lambda n, c: n * len(listed[c]), names, 1)
    if not names or size > MAX_VALUES:
        return None
    rows = df.sparkSession.createDataFrame(list(product(*[listed[c] for c in names])), T.StructType([T.StructField(c, dtypes[c]) for c in names]))
    try:
        found = [r[0] for r in apply_partitioning(rows, p, "_found").select("_found").distinct().collect()]
    except AnalysisException as e:
        if not (e.getCondition() or "").startswith("UNRESOLVED_COLUMN"):
            raise
        return None
    return LabelSet(frozenset(v for v in found if v is not None), None in found)


_LOW, _HIGH = "low", "high"


def _below(point: tuple, bound: tuple) -> bool:
    """Lexicographic ``point < bound``; a bound's None is above everything."""
    for x, b in zip(point, bound):
        if b is None or x == _LOW:
            return True
        if x == _HIGH or x > b:
            return False
        if x < b:
            return True
    return False


def _range_labels(p: S.PartitionSpec, names: list[str], corners: list[tuple[tuple, tuple]], bounds: list[tuple]) -> LabelSet:
    found, unrouted = set(), False
    for low, high in corners:
        first = next((i for i, b in enumerate(bounds) if _below(low, b)), len(bounds))
        last = next((i for i, b in enumerate(bounds) if _below(high, b)), len(bounds))
        found |= set(names[first:last + 1])
        unrouted |= last == len(bounds)
    return LabelSet(frozenset(found), unrouted)


def label_set(df: DataFrame, p: S.PartitionSpec, where: dict[str, KeyRange]) -> LabelSet:
    """The labels of ``p`` whose rows can satisfy ``where``. ``df`` gives the
    types of its key columns."""
    spark = df.sparkSession
    flat = S.PartitionSpec(p.kind, p.expr, p.columns, p.count, p.linear, p.bounds, p.lists, p.names)
    keys = list(p.columns) or [p.expr]
    dtypes = {f.name: f.dataType for f in df.schema.fields}
    listed = {c: v for c, r in where.items() if c in dtypes and (v := _finite(spark, r, dtypes[c])) is not None}
    found = _judged(df, flat, listed, dtypes)
    if found is not None or p.kind.lower() in ("hash", "key") or not any(k in where for k in keys):
        return found or LabelSet()

    types = [df.select(F.col(k) if p.columns else F.expr(k)).schema[0].dataType for k in keys]
    names = list(p.names) or [f"p{i}" for i in range(len(p.bounds or p.lists))]
    ranges = []
    for k, t in zip(keys, types):
        r = where.get(k, KeyRange())
        values = None if r.values is None else [v for v in _typed(spark, list(r.values), t) if v is not None]
        lo, hi = _typed(spark, [r.lo, r.hi], t)
        if (r.lo is not None and lo is None) or (r.hi is not None and hi is None):
            return LabelSet()  # the predicate's value is not one of the key's type
        ranges.append((values, lo, hi))

    def columns_of(rows: list) -> list[tuple]:
        rows = [x if isinstance(x, tuple) else (x,) for x in rows]
        typed = [_typed(spark, [x[i] for x in rows], t) for i, t in enumerate(types)]
        return list(zip(*typed)) if rows else []

    if p.kind.lower() == "list":
        members = [(m, name) for name, own in zip(names, p.lists) for m in own]
        label_of: dict[tuple, str] = {}
        for member, (_, name) in zip(columns_of([m for m, _ in members]), members):
            label_of.setdefault(member, name)

        def allowed(member: tuple) -> bool:
            return all(x is not None and (v is None or x in v) and (lo is None or x >= lo) and (hi is None or x <= hi)
                       for x, (v, lo, hi) in zip(member, ranges))

        return LabelSet(frozenset(name for m, name in label_of.items() if allowed(m)), True)

    corners: list[tuple[tuple, tuple]] = [((), ())]
    rest = len(keys)
    for values, lo, hi in ranges:  # columns count as long as those before are fixed
        rest -= 1
        if values is not None and len(corners) * len(values) <= MAX_VALUES:
            corners = [(a + (v,), b + (v,)) for a, b in corners for v in values]
            continue
        if values:
            lo, hi = min(values), max(values)
        corners = [(a + (_LOW if lo is None else lo,) + (_LOW,) * rest, b + (_HIGH if hi is None else hi,) + (_HIGH,) * rest) for a, b in corners]
        break
    found = _range_labels(p, names, corners, columns_of(list(p.bounds)))
    # a row whose other key columns are NULL has no label
    return LabelSet(found.labels, found.unrouted or any(k not in where for k in keys))


def with_pruning(df: DataFrame, p: S.PartitionSpec, where: dict[str, KeyRange], label: str = LABEL, sublabel: str = SUBLABEL) -> DataFrame:
    """``df`` (a labelled table read back) where all of ``where`` hold, with
    the label conditions that let Spark skip folders, of both levels."""
    keys = {c: F.col(c) if c in df.columns else F.expr(c) for c in where}
    out = df.where(reduce(lambda a, b: a & b, [r.condition(keys[c]) for c, r in where.items()]))
    for part, name in ((p, label), (p.sub, sublabel)):
        condition = label_set(df.drop(label, sublabel), part, where).condition(name) if part is not None and name in df.columns else None
        if condition is not None:
            out = out.where(condition)
    return out
