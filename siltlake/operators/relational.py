"""Relational operators Spark SQL cannot spell directly.

* ``op ALL / ANY / SOME (subquery)`` does not parse in Spark SQL, and the
  naive ``NOT EXISTS (… IS NOT TRUE)`` rewrite plans a nested-loop join.
  Here the set is reduced to four numbers (min, max, size, NULL count) in
  one aggregate — a scalar subquery, so no join at all — except equality
  forms, which are semi/anti hash joins on the value.
* Referential actions (ON DELETE / ON UPDATE) are applied in bulk with
  joins on keys; a self reference cascades by pointer jumping (log2 of the
  depth rounds), with lineage cut by reliable checkpoints.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltlake.session import checkpoint_dir

_OPS = (">", ">=", "<", "<=", "=", "<>", "!=")


def _stats(sub: DataFrame, sub_col: str | Column) -> Column:
    c = F.col(sub_col) if isinstance(sub_col, str) else sub_col
    one = sub.select(F.struct(F.min(c).alias("lo"), F.max(c).alias("hi"), F.count(F.lit(1)).alias("n"),
                              (F.count(F.lit(1)) - F.count(c)).alias("k")))
    return one.scalar()


def _cmp(x: Column, op: str, y: Column) -> Column:
    return {">": x > y, ">=": x >= y, "<": x < y, "<=": x <= y, "=": x == y, "<>": x != y, "!=": x != y}[op]


def compare_all(df: DataFrame, col: str | Column, op: str, sub: DataFrame, sub_col: str | Column) -> DataFrame:
    """Rows where ``col op ALL (SELECT sub_col FROM sub)`` is TRUE.

    Over the set S (m = min, M = max of non-null values, n = size, k = NULLs):
    ``> ALL``: n = 0 or (k = 0 and x > M); ``< ALL`` likewise with m;
    ``= ALL``: n = 0 or (k = 0 and m = M = x); ``<> ALL`` is NOT IN:
    n = 0, or k = 0 and x not null and x not in S (hash anti join)."""
    assert op in _OPS, op
    x = F.col(col) if isinstance(col, str) else col
    st = _stats(sub, sub_col)
    empty = st["n"] == 0
    no_null = st["k"] == 0
    if op in ("<>", "!="):
        s = sub.select((F.col(sub_col) if isinstance(sub_col, str) else sub_col).alias("_s")).where(
            F.col("_s").isNotNull()).distinct()
        keep = df.where(empty)
        rest = df.where(~empty & no_null & x.isNotNull()).join(s, x == s["_s"], "left_anti")
        return keep.unionByName(rest)
    if op == "=":
        cond = empty | (no_null & (st["lo"] == st["hi"]) & (x == st["lo"]))
    else:
        bound = st["hi"] if op in (">", ">=") else st["lo"]
        cond = empty | (no_null & _cmp(x, op, bound))
    return df.where(F.coalesce(cond, F.lit(False)))


def compare_any(df: DataFrame, col: str | Column, op: str, sub: DataFrame, sub_col: str | Column) -> DataFrame:
    """Rows where ``col op ANY (SELECT …)`` (= SOME) is TRUE.

    ``> ANY``: x > m; ``< ANY``: x < M; ``= ANY`` is IN (hash semi join);
    ``<> ANY``: some non-null element differs from x, i.e. n > k and
    (x <> m or x <> M). With an empty set ANY is false."""
    assert op in _OPS, op
    x = F.col(col) if isinstance(col, str) else col
    if op == "=":
        s = sub.select((F.col(sub_col) if isinstance(sub_col, str) else sub_col).alias("_s")).where(
            F.col("_s").isNotNull()).distinct()
        return df.join(s, x == s["_s"], "left_semi")
    st = _stats(sub, sub_col)
    if op in ("<>", "!="):
        cond = (st["n"] > st["k"]) & ((x != st["lo"]) | (x != st["hi"]))
    else:
        bound = st["lo"] if op in (">", ">=") else st["hi"]
        cond = _cmp(x, op, bound)
    return df.where(F.coalesce(cond, F.lit(False)))


compare_some = compare_any


# --------------------------------------------------------------------------
# J7 referential actions in bulk
# --------------------------------------------------------------------------

def _key_join_cond(child: DataFrame, columns: list[str], keys: DataFrame, key_names: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [child[c] == keys[k] for c, k in zip(columns, key_names)])


def apply_parent_changes(child: DataFrame, columns: list[str] | tuple, deleted: DataFrame | None = None,
                         rekeyed: DataFrame | None = None, on_delete: str = "RESTRICT",
                         on_update: str = "RESTRICT", defaults: dict | None = None,
                         self_parent: list[str] | None = None) -> tuple[DataFrame, DataFrame | None]:
    """Propagate parent deletes / key changes to a child table.

    ``deleted``: parent key tuples (one column per FK column, any names, in
    order). ``rekeyed``: old key columns then new key columns (2 × k).
    Returns ``(child_after, rejected_parents)``; RESTRICT / NO ACTION leave the
    child unchanged and return the parents that still have children.
    ``self_parent``: for a self reference, the child's own key columns; a
    CASCADE delete reaches every descendant (see :func:`cascade_self_delete`)."""
    cols = list(columns)
    k = len(cols)
    out, rejected = child, None
    if deleted is not None:
        dnames = [f"_d{i}" for i in range(k)]
        d = deleted.toDF(*dnames).where(~reduce(lambda a, b: a | b, [F.col(n).isNull() for n in dnames])).distinct()
        action = on_delete.upper()
        if action in ("RESTRICT", "NO ACTION"):
            refs = out.select(*cols).distinct()
            rejected = d.join(refs, reduce(lambda a, b: a & b, [d[n] == refs[c] for n, c in zip(dnames, cols)]),
                              "left_semi")
        elif action == "CASCADE":
            if self_parent:
                out = cascade_self_delete(out, cols, list(self_parent), d)
            else:
                out = out.join(d, _key_join_cond(out, cols, d, dnames), "left_anti")
        elif action in ("SET NULL", "SET DEFAULT"):
            hit = out.join(d.withColumn("_hit", F.lit(True)), _key_join_cond(out, cols, d, dnames), "left")
            repl = {}
            for c in cols:
                v = (defaults or {}).get(c) if action == "SET DEFAULT" else None
                repl[c] = F.when(F.col("_hit"), F.lit(v).cast(child.schema[c].dataType)).otherwise(out[c])
            out = hit.select(*[repl.get(c, out[c]).alias(c) for c in child.columns])
        else:
            raise ValueError(on_delete)
    if rekeyed is not None:
        onames = [f"_o{i}" for i in range(k)]
        nnames = [f"_n{i}" for i in range(k)]
        r = rekeyed.toDF(*onames, *nnames).distinct()
        if not r.groupBy(*onames).count().where("count > 1").isEmpty():
            raise ValueError("one old parent key has two new ones")
        action = on_update.upper()
        if action in ("RESTRICT", "NO ACTION"):
            rej = r.join(out.select(*cols).distinct(),
                         reduce(lambda a, b: a & b, [r[n] == F.col(c) for n, c in zip(onames, cols)]), "left_semi")
            rejected = rej if rejected is None else rejected.unionByName(rej, allowMissingColumns=True)
        else:
            j = out.join(r, _key_join_cond(out, cols, r, onames), "left")
            hit = F.col(onames[0]).isNotNull()
            repl = {}
            for i, c in enumerate(cols):
                if action == "CASCADE":
                    new = F.col(nnames[i])
                elif action == "SET NULL":
                    new = F.lit(None)
                else:
                    new = F.lit((defaults or {}).get(c))
                repl[c] = F.when(hit, new.cast(child.schema[c].dataType)).otherwise(out[c])
            out = j.select(*[repl.get(c, out[c]).alias(c) for c in child.columns])
    return out, rejected


def cascade_self_delete(table: DataFrame, parent_cols: list[str], key_cols: list[str], deleted: DataFrame) -> DataFrame:
    """ON DELETE CASCADE on a self reference: a row goes when it, or any of
    its ancestors, is deleted (or when its parent is a deleted key).

    Pointer jumping: every row carries (key, ancestor pointer, hit). One
    self-join per round replaces the pointer by the pointer's pointer and ORs
    in the ancestor's hit flag, so after ``r`` rounds the first ``2^r``
    ancestors have been seen: ``log2(depth)`` rounds, not one per level, and
    no more than ``log2(rows) + 1`` even for a cyclic reference. A row that
    is hit stops jumping, and a row whose pointer has run out joins no more, so
    no round joins on a NULL pointer. Each round is written to the shared checkpoint
    folder, so lineage stays one round long and a lost executor recomputes
    one round. Only a row count and one "anything left?" flag per round reach
    the driver. A root with many descendants is a skewed join key on the
    probing side only; adaptive execution splits it."""
    import math

    spark = table.sparkSession
    checkpoint_dir(spark)
    k = len(key_cols)
    kn = [f"_k{i}" for i in range(k)]
    an = [f"_a{i}" for i in range(k)]
    dn = [f"_d{i}" for i in range(k)]
    d = deleted.toDF(*dn).distinct().withColumn("_seed", F.lit(True))
    nodes = table.select(*[F.col(c).alias(n) for c, n in zip(key_cols, kn)],
                         *[F.col(c).alias(n) for c, n in zip(parent_cols, an)]).distinct()
    no_parent = reduce(lambda a, b: a | b, [F.col(n).isNull() for n in an])
    nodes = nodes.select(*kn, *[F.when(no_parent, F.lit(None)).otherwise(F.col(n)).alias(n) for n in an])
    own = d.select(*[F.col(x).alias(y) for x, y in zip(dn, kn)], F.col("_seed").alias("_own"))
    par = d.select(*[F.col(x).alias(y) for x, y in zip(dn, an)], F.col("_seed").alias("_par"))
    nodes = nodes.join(own, kn, "left").join(par, an, "left")
    nodes = nodes.select(*kn, *an, (F.coalesce("_own", F.lit(False)) | F.coalesce("_par", F.lit(False))).alias("_hit"))
    nodes = nodes.select(*kn, *[F.when(F.col("_hit"), F.lit(None)).otherwise(F.col(n)).alias(n) for n in an],
                         "_hit").checkpoint(eager=True)
    rounds = math.ceil(math.log2(max(nodes.count(), 2))) + 1
    # a node without a pointer is settled: it is looked up, but jumps and is written no more
    done, active = nodes.where(F.col(an[0]).isNull()), nodes.where(F.col(an[0]).isNotNull())
    for _ in range(rounds):
        if active.isEmpty():
            break
        look = done.unionByName(active).select(*[F.col(x).alias(f"_l{x}") for x in kn], *[F.col(x).alias(f"_l{x}") for x in an],
                                               F.col("_hit").alias("_lhit"))
        cond = reduce(lambda a, b: a & b, [active[a] == look[f"_l{kk}"] for a, kk in zip(an, kn)])
        hit = F.col("_hit") | F.coalesce(F.col("_lhit"), F.lit(False))
        jumped = active.join(look, cond, "left").select(
            *kn, *[F.when(hit, F.lit(None)).otherwise(F.col(f"_l{a}")).alias(a) for a in an], hit.alias("_hit")).checkpoint(eager=True)
        done = done.unionByName(jumped.where(F.col(an[0]).isNull()))
        active = jumped.where(F.col(an[0]).isNotNull())
    gone = done.where(F.col("_hit")).select(*kn)
    cond = reduce(lambda a, b: a & b, [table[c] == gone[n] for c, n in zip(key_cols, kn)])
    return table.join(gone, cond, "left_anti")
