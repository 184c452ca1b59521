"""Reproducible synthetic rows and change logs for a spec.

Every value is a pure function of ``(id, column position, seed)`` — an
integer mixing step ``(x * 1103515245 + 12345) mod 2^31`` — so the same rows
come out at any parallelism, on any engine: the per-column expressions are
SQL text that Spark (``F.expr``) and DuckDB both evaluate.

Ids come from a DataFrame (keys of an existing table, or ``spark.range``),
so generation is as parallel as that DataFrame.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltlake import spec as S

M = 2147483648  # 2^31
A = 1103515245
C = 12345

# A small vocabulary for generated text.
WORDS = ("alpha", "bravo", "delta", "echo", "gamma", "kilo", "lima", "oscar",
         "sierra", "tango", "ultra", "vector", "whiskey", "yankee", "zulu", "nova")


def _mix(x: str) -> str:
    return f"((({x}) * {A} + {C}) % {M})"


def _seed_expr(id_col: str, i: int, seed: int) -> str:
    """First mixed value for column ``i``; ids beyond 2^31 fold in their high part."""
    salt = (i + 1) * 7919 + seed * 104729
    return (f"((({id_col} % {M}) * {A} + CAST(FLOOR({id_col} / {M}) AS BIGINT) * {C} + {C} + {salt}) % {M})")


def _pick(values, h: str, engine: str) -> str:
    """The ``h mod len``-th of a constant list (1-based lookup in both engines).

    A constant array keeps the generated code small — a CASE per value would
    make the fused whole-stage method too big for the JIT to compile."""
    lit = ", ".join("'" + v.replace("'", "''") + "'" for v in values)
    idx = f"CAST(({h}) % {len(values)} + 1 AS INTEGER)"
    if engine == "spark":
        return f"element_at(array({lit}), {idx})"
    return f"([{lit}])[{idx}]"


def value_sql(c: S.ColumnSpec, a: str, b: str, engine: str = "spark") -> str:
    """SQL text of a generated value from two mixed integers ``a`` and ``b``."""
    k = c.kind
    if k in S.INTEGER_TYPES:
        mod = 100 if k == "tinyint" else 1000
        t = "TINYINT" if k == "tinyint" else ("SMALLINT" if k == "smallint" else
                                               "BIGINT" if k == "bigint" else "INTEGER")
        if c.unsigned and k == "tinyint":
            t = "SMALLINT"
        return f"CAST({a} % {mod} AS {t})"
    if k in S.DECIMAL_TYPES:
        p, s = c.precision or 10, c.scale or 0
        return f"CAST(CAST({a} % 1000000 AS DOUBLE) / CAST(100 AS DOUBLE) AS DECIMAL({p},{s}))"
    if k in S.FLOAT_TYPES + S.DOUBLE_TYPES:
        return f"CAST({a} % 1000000 AS DOUBLE) / CAST(1000 AS DOUBLE)"
    if k in S.BOOL_TYPES:
        return f"({a} % 2 = 1)"
    if k == "date":
        return f"(DATE '2000-01-01' + CAST({a} % 9000 AS INTEGER))"
    if k in ("datetime", "timestamp"):
        secs = f"({a} % 631152000)"
        if engine == "spark":
            return f"timestampadd(SECOND, {secs}, TIMESTAMP_NTZ '2000-01-01 00:00:00')"
        return f"(TIMESTAMP '2000-01-01 00:00:00' + to_seconds({secs}))"
    if k == "year":
        return f"CAST(1901 + {a} % 255 AS SMALLINT)"
    if k == "bit":
        width = min(c.length or 1, 30)
        return f"CAST({a} % {2 ** width} AS BIGINT)"
    if k in S.BINARY_TYPES:
        return f"unhex(lpad(hex({a}), 8, '0'))"
    if k == "enum" and c.members:
        return _pick(c.members, a, engine)
    if k == "set" and c.members:
        n = len(c.members)
        # one member, or two neighbouring members: 2n choices
        choices = list(c.members) + [f"{m},{c.members[(j + 1) % n]}" for j, m in enumerate(c.members)]
        return _pick(choices, f"{a} % {n} + {n} * ({b} % 2)", engine)
    text = f"({_pick(WORDS, a, engine)} || ' ' || {_pick(WORDS, b, engine)})"
    if c.length:
        return f"substr({text}, 1, {c.length})"
    return text


def hash_sql(spec: S.TableSpec, id_col: str = "id", seed: int = 0) -> list[tuple[str, str]]:
    """Three mixed integers per column, computed once: ``_a{i}``, ``_b{i}``, ``_c{i}``."""
    out = []
    for i, _ in enumerate(spec.columns):
        out += [(f"_a{i}", _seed_expr(id_col, i, seed)), (f"_b{i}", _mix(f"_a{i}")), (f"_c{i}", _mix(f"_b{i}"))]
    return out


def column_sql(spec: S.TableSpec, id_col: str = "id", engine: str = "spark") -> list[tuple[str, str]]:
    """(name, SQL over the hash columns) per declared column; NULL for about
    1 in 10 rows of a nullable column; an ``auto_increment`` / single
    primary-key column is the id itself."""
    out = []
    pk = [p.column for p in spec.primary_key]
    for i, c in enumerate(spec.columns):
        if c.auto_increment or (pk == [c.name]):
            out.append((c.name, f"CAST({id_col} AS BIGINT)"))
            continue
        v = value_sql(c, f"_a{i}", f"_c{i}", engine)
        if c.nullable:
            v = f"(CASE WHEN _b{i} % 10 = 0 THEN NULL ELSE {v} END)"
        out.append((c.name, v))
    return out


def synth_table(ids: DataFrame, spec: S.TableSpec, seed: int = 0, id_col: str = "id") -> DataFrame:
    """Rows for ``spec``, one per id of ``ids`` (G1). Two narrow projections
    (hashes, then values): as parallel as ``ids``, nothing shuffled."""
    h = ids.select(F.col(id_col), *[F.expr(sql).alias(name) for name, sql in hash_sql(spec, id_col, seed)])
    return h.select(*[F.expr(sql).alias(name) for name, sql in column_sql(spec, id_col)])


def synth_table_sql(spec: S.TableSpec, source: str, seed: int = 0, id_col: str = "id") -> str:
    """The same generator as DuckDB SQL over ``source`` (a relation with ``id_col``)."""
    hashes = ", ".join(f"{sql} AS {name}" for name, sql in hash_sql(spec, id_col, seed))
    cols = ", ".join(f"{sql} AS {name}" for name, sql in column_sql(spec, id_col, engine="duckdb"))
    return f"SELECT {cols} FROM (SELECT {id_col}, {hashes} FROM {source}) h"


def _changes_parts(key: str, seed: int, max_events: int) -> dict[str, str]:
    h = _seed_expr(key, 0, seed)
    n = f"(1 + {h} % {max_events})"
    hv = _mix(f"({_mix(h)} + _i)")
    op = (f"(CASE WHEN _i = 0 THEN 'insert' WHEN _i = {n} - 1 AND {_mix(h)} % 3 = 0 THEN 'delete' "
          f"ELSE 'update' END)")
    return {"n": n, "op": op, "seq": f"CAST({key} * {max_events} + _i AS BIGINT)",
            "value": f"CAST({hv} % 100000 AS DOUBLE) / CAST(100 AS DOUBLE)"}


def synth_changes(keys: DataFrame, key: str = "id", seed: int = 0, max_events: int = 8) -> DataFrame:
    """A consistent change log over ``keys`` (G2): per key 1..max_events
    events, the first an insert, then updates, and for about a third of keys
    a final delete — updates and deletes only ever hit live keys.
    Columns ``(pk, seq, op, value)``; ``seq`` orders events within a key."""
    p = _changes_parts(key, seed, max_events)
    x = keys.select(F.col(key), F.explode(F.sequence(F.lit(0), F.expr(p["n"]).cast("int") - 1)).alias("_i"))
    return x.select(F.col(key).cast("bigint").alias("pk"), F.expr(p["seq"]).alias("seq"), F.expr(p["op"]).alias("op"),
                    F.expr(p["value"]).alias("value"))


def synth_changes_sql(source: str, key: str = "id", seed: int = 0, max_events: int = 8) -> str:
    p = _changes_parts(key, seed, max_events)
    return (f"SELECT CAST({key} AS BIGINT) AS pk, {p['seq']} AS seq, {p['op']} AS op, {p['value']} AS value "
            f"FROM (SELECT {key}, unnest(range(0, CAST({p['n']} AS INTEGER))) AS _i FROM {source}) x")
