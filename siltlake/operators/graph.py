"""Referential actions over a graph of tables.

``delete_over_graph`` takes the foreign keys of several table specs and finds
the fixed point of a delete: CASCADE reaches children, their children and so
on, over any mixture of actions, shared children, self references and cycles.
Rows are told apart by their primary keys. A round joins only the rows that
the round before reached, so its work follows the frontier; there are as many
rounds as the longest chain of cascades is deep, and each is written to the
shared checkpoint folder. A parent with many children is a hot key on the
probing side only, which adaptive execution splits; only whether a frontier is
empty reaches the driver.

The set is one statement: RESTRICT and NO ACTION are judged when the fixed
point is reached, and a child that stays and refers to a row that goes rejects
all of it. SET NULL and SET DEFAULT apply to the children that stay.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltlake import spec as S
from siltlake.session import checkpoint_dir


@dataclass(frozen=True)
class GraphResult:
    """``tables`` after the statement (as they were if it was rejected);
    ``rejected``: (constraint, child, parent, n_children) of the foreign keys
    that reject it; ``deleted``: the primary keys that go, per table."""

    tables: dict[str, DataFrame]
    rejected: DataFrame
    deleted: dict[str, DataFrame]


def _names(parts) -> list[str]:
    return [p.column for p in parts]


def _same(left: DataFrame, columns: list[str], right: DataFrame, names: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [left[c] == right[n] for c, n in zip(columns, names)])


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), parts)


def delete_over_graph(tables: dict[str, DataFrame], specs: dict[str, S.TableSpec], deleted: dict[str, DataFrame],
                      defaults: dict[str, dict] | None = None) -> GraphResult:
    """Delete rows of any tables and follow every foreign key between them.

    ``deleted``: per table the primary keys to delete (columns in key order).
    ``defaults``: per table the values of SET DEFAULT columns, where the spec
    has none. A foreign key with a NULL part refers to nothing. A column that
    SET NULL or SET DEFAULT changes must not be part of the table's primary
    key or be referred to by another foreign key (ValueError)."""
    spark = next(iter(tables.values())).sparkSession
    checkpoint_dir(spark)
    keys = {name: _names(specs[name].primary_key) for name in tables}
    links = [(name, fk) for name in tables for fk in specs[name].foreign_keys if fk.parent in tables]
    referred = {name: {c for _, fk in links if fk.parent == name for c in _names(fk.parent_columns)} for name in tables}
    for name in tables:
        if not keys[name]:
            raise ValueError(f"{name} has no primary key")
    for name, fk in links:
        if fk.on_delete.upper() in ("SET NULL", "SET DEFAULT") and set(fk.columns) & (referred[name] | set(keys[name])):
            raise ValueError(f"{fk.name} changes columns of {name} that are keys themselves")
    carried = {name: sorted(referred[name] | set(keys[name])) for name in tables}

    def rows_of(name: str, gone: DataFrame) -> DataFrame:
        """The carried columns of the rows whose primary keys are in ``gone``."""
        k = gone.toDF(*[f"_k{i}" for i in range(len(keys[name]))]).distinct()
        t = tables[name]
        return t.join(k, _same(t, keys[name], k, k.columns), "left_semi").select(*carried[name]).distinct()

    reached = {name: [rows_of(name, keys_).checkpoint()] for name, keys_ in deleted.items()}
    frontier = {name: parts[0] for name, parts in reached.items() if not parts[0].isEmpty()}
    while frontier:
        new: dict[str, list[DataFrame]] = {}
        for name, fk in links:
            if fk.parent in frontier and fk.on_delete.upper() == "CASCADE":
                parents = frontier[fk.parent].select(*[F.col(c).alias(f"_p{i}") for i, c in enumerate(_names(fk.parent_columns))]).distinct()
                child = tables[name]
                new.setdefault(name, []).append(child.join(parents, _same(child, list(fk.columns), parents, parents.columns), "left_semi").select(*carried[name]))
        frontier = {}
        for name, parts in new.items():
            rows = _union(parts).distinct()
            if name in reached:
                seen = _union(reached[name]).select(*[F.col(c).alias(f"_s{i}") for i, c in enumerate(keys[name])])
                rows = rows.join(seen, _same(rows, keys[name], seen, seen.columns), "left_anti")
            rows = rows.checkpoint()
            if not rows.isEmpty():
                frontier[name] = rows
                reached.setdefault(name, []).append(rows)

    gone = {name: _union(parts).distinct() for name, parts in reached.items()}
    left, changes, rejected = dict(tables), {}, []
    for name, rows in gone.items():
        k = rows.select(*[F.col(c).alias(f"_g{i}") for i, c in enumerate(keys[name])])
        left[name] = tables[name].join(k, _same(tables[name], keys[name], k, k.columns), "left_anti")
    for name, fk in links:
        if fk.parent not in gone or fk.on_delete.upper() == "CASCADE":
            continue
        parents = gone[fk.parent].select(*[F.col(c).alias(f"_p{i}") for i, c in enumerate(_names(fk.parent_columns))]).distinct()
        if fk.on_delete.upper() in ("RESTRICT", "NO ACTION"):
            held = left[name].join(parents, _same(left[name], list(fk.columns), parents, parents.columns), "left_semi")
            rejected.append(held.agg(F.count("*").alias("n_children")).where("n_children > 0").select(
                F.lit(fk.name).alias("constraint"), F.lit(name).alias("child"), F.lit(fk.parent).alias("parent"), "n_children"))
        elif fk.on_delete.upper() in ("SET NULL", "SET DEFAULT"):
            changes.setdefault(name, []).append((fk, parents))
        else:
            raise ValueError(fk.on_delete)
    schema = "constraint string, child string, parent string, n_children long"
    refused = _union(rejected).checkpoint() if rejected else spark.createDataFrame([], schema)
    keys_gone = {name: rows.select(*keys[name]) for name, rows in gone.items()}
    if not refused.isEmpty():
        return GraphResult(dict(tables), refused, {name: rows.limit(0) for name, rows in keys_gone.items()})

    for name, parts in changes.items():
        out = left[name]
        hit = "_hit"
        for fk, parents in parts:
            joined = out.join(parents.withColumn(hit, F.lit(True)), _same(out, list(fk.columns), parents, parents.columns), "left")
            new_value = {}
            for c in fk.columns:
                value = None
                if fk.on_delete.upper() == "SET DEFAULT":
                    declared = specs[name].column(c).default
                    value = (defaults or {}).get(name, {}).get(c, None if declared is S.NO_DEFAULT else declared)
                new_value[c] = F.when(F.col(hit), F.lit(value).cast(out.schema[c].dataType)).otherwise(out[c])
            out = joined.select(*[new_value.get(c, out[c]).alias(c) for c in out.columns])
        left[name] = out
    return GraphResult(left, refused, keys_gone)
