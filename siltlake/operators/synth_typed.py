"""Synthetic rows over the whole declared range of every type (G1).

Each value is a pure function of ``(id, column position, seed)``. A column's
first number is mixed from the id; its further ones are steps of the same
linear congruence, of which the upper 16 bits are used. Integers and bit
strings are put together from as many of these limbs as their width needs, so
all of 64 bits are reached; decimals from groups of four digits, up to 38. One
row in 32 takes the low end of the declared range, another the high end, and
one in ten of a nullable column is NULL. The columns have the types, metadata
and nullability of ``struct_type(spec)``.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltlake import spec as S
from siltlake.operators.synth import A, C, M, WORDS, _seed_expr

# The ranges of the source's dates and times.
DATES = (dt.date(1000, 1, 1), dt.date(9999, 12, 31))
TIMESTAMP_SECONDS = (1, 2147483647)
TIME_SECONDS = 838 * 3600 + 59 * 60 + 59
YEARS = (1901, 2155)
FLOAT_MAX, DOUBLE_MAX = 3.4028234663852886e38, 1.7976931348623157e308


def _limb(base: str, j: int) -> str:
    """16 bits of the j-th number after ``base``, by the step's closed form."""
    factor, offset = 1, 0
    for _ in range(j):
        factor, offset = factor * A % M, (offset * A + C) % M
    return f"((({base} * {factor}L + {offset}L) % {M}L) div 32768L)"


def _bits(base: str, n: int) -> str:
    """An unsigned whole number of ``n`` bits (up to 64), as DECIMAL(20,0) above 62 bits."""
    limbs = [_limb(base, 2 + j) for j in range((n + 15) // 16)]
    if n % 16:
        limbs[-1] = f"({limbs[-1]} % {1 << n % 16}L)"
    if n <= 62:
        return "(" + " + ".join(f"{x} * {1 << 16 * j}L" for j, x in enumerate(limbs)) + ")"
    low, high = f"({limbs[0]} + {limbs[1]} * 65536L)", f"({limbs[2]} + {limbs[3]} * 65536L)"
    return f"CAST(CAST({high} AS DECIMAL(10,0)) * CAST(4294967296 AS DECIMAL(10,0)) + CAST({low} AS DECIMAL(10,0)) AS DECIMAL(20,0))"


def _between(base: str, low: int, high: int) -> str:
    """A whole number of a range of up to 2^46 values."""
    return f"({low}L + {_bits(base, 62)} % {high - low + 1}L)"


def _digits(base: str, n: int) -> str:
    groups = ", ".join(f"lpad(CAST({_limb(base, 2 + j)} % 10000L AS STRING), 4, '0')" for j in range((n + 3) // 4))
    return f"right(concat({groups}), {n})"


def _power(base: str, j: int, reach: int) -> str:
    return f"power(2D, {_limb(base, j)} % {2 * reach + 1}L - {reach}L)"


def _range(c: S.ColumnSpec, base: str, max_text: int) -> tuple[str, str, str]:
    """SQL of the low end, the high end and a value between, before the cast to the column's type."""
    k = c.kind
    if k in S.INTEGER_TYPES:
        low, high = (0, S.UNSIGNED_MAX[k]) if c.unsigned else S.SIGNED_RANGE[k]
        width = (high - low).bit_length()
        return (f"CAST('{low}' AS DECIMAL(20,0))", f"CAST('{high}' AS DECIMAL(20,0))",
                f"(CAST({_bits(base, width)} AS DECIMAL(21,0)) + CAST('{low}' AS DECIMAL(20,0)))")
    if k == "bit":
        n = c.length or 1
        return "0", f"CAST('{(1 << n) - 1}' AS DECIMAL(20,0))", _bits(base, n)
    if k in S.DECIMAL_TYPES:
        p, s = c.precision or 10, c.scale or 0
        top = "9" * (p - s) + ("." + "9" * s if s else "")
        digits = _digits(base, p)
        shown = f"concat(left({digits}, {p - s}), '.', right({digits}, {s}))" if 0 < s < p else f"concat('0.', {digits})" if s else digits
        sign = "" if c.unsigned else f"CASE WHEN {_limb(base, 13)} < 32768 THEN '-' ELSE '' END"
        top = top if p > s else "0" + top
        return ("'0'" if c.unsigned else f"'-{top}'"), f"'{top}'", f"concat({sign}, {shown})" if sign else shown
    if k in S.FLOAT_TYPES:
        return f"-{FLOAT_MAX}D", f"{FLOAT_MAX}D", f"(({_bits(base, 24)} - {1 << 23}L) * {_power(base, 13, 40)})"
    if k in S.DOUBLE_TYPES:
        return f"-{DOUBLE_MAX}D", f"{DOUBLE_MAX}D", f"(({_bits(base, 53)} - {1 << 52}L) * {_power(base, 13, 300)})"
    if k in S.BOOL_TYPES:
        return "false", "true", f"({_limb(base, 2)} >= 32768)"
    if k in S.DATE_TYPES + S.DATETIME_TYPES:
        days = (DATES[1] - DATES[0]).days
        if k in S.DATE_TYPES:
            return f"DATE'{DATES[0]}'", f"DATE'{DATES[1]}'", f"date_add(DATE'{DATES[0]}', CAST({_between(base, 0, days)} AS INT))"
        first, last = f"TIMESTAMP_NTZ'{DATES[0]} 00:00:00'", f"TIMESTAMP_NTZ'{DATES[1]} 23:59:59'"
        return first, last, f"timestampadd(SECOND, {_between(base, 0, days * 86400 + 86399)}, {first})"
    if k in S.TIMESTAMP_TYPES:
        low, high = TIMESTAMP_SECONDS
        return f"timestamp_seconds({low}L)", f"timestamp_seconds({high}L)", f"timestamp_seconds({_between(base, low, high)})"
    if k == "time":
        interval = "make_dt_interval(0, 0, 0, CAST({} AS DECIMAL(18,6)))"
        return interval.format(-TIME_SECONDS), interval.format(TIME_SECONDS), interval.format(_between(base, -TIME_SECONDS, TIME_SECONDS))
    if k == "year":
        return str(YEARS[0]), str(YEARS[1]), _between(base, *YEARS)
    if k in S.BINARY_TYPES:
        n = c.length or 16
        word = "".join(f"lpad(hex({_limb(base, 2 + j)}), 4, '0'), " for j in range(4))
        low = "00" * n if k == "binary" else ""
        size = n if k == "binary" else f"CAST({_limb(base, 13)} % {n + 1}L AS INT)"
        return f"unhex('{low}')", f"unhex('{'FF' * n}')", f"unhex(left(repeat(concat({word}''), {n // 8 + 1}), 2 * {size}))"
    if k in ("enum", "set") and c.members:
        listed = ", ".join("'" + m.replace("'", "''") + "'" for m in c.members)
        if k == "enum":
            return f"element_at(array({listed}), 1)", f"element_at(array({listed}), -1)", \
                f"element_at(array({listed}), CAST({_limb(base, 2)} % {len(c.members)}L + 1 AS INT))"
        mask = _bits(base, min(62, len(c.members)))
        return "CAST(array() AS ARRAY<STRING>)", f"array({listed})", f"filter(array({listed}), (x, i) -> shiftright({mask}, i) % 2 = 1)"
    if k in S.TEXT_TYPES:
        n = min(c.length or max_text, max_text)
        words = "array(" + ", ".join(f"'{w}'" for w in WORDS) + ")"
        some = ", ".join(f"element_at({words}, CAST({_limb(base, 2 + j)} % {len(WORDS)}L + 1 AS INT))" for j in range(4))
        return "''", f"repeat('z', {n})", f"left(repeat(concat(concat_ws(' ', {some}), ' '), {n // 16 + 1}), CAST({_limb(base, 13)} % {n + 1}L AS INT))"
    raise ValueError(f"no generator for {c.name} {c.data_type}")


def _constant(c: S.ColumnSpec, kind) -> Column:
    """A constant that Spark knows not to be NULL, where it can't tell of the low end."""
    if c.kind in S.BINARY_TYPES:
        return F.lit(b"")
    if kind.typeName() == "decimal":
        return F.expr(f"0.{'0' * kind.scale}BD" if kind.scale else "0BD").cast(kind)
    return F.lit(0).cast(kind) if c.kind in S.INTEGER_TYPES else F.lit(None).cast(kind)


def _value(c: S.ColumnSpec, i: int, spec: S.TableSpec, parents: dict[str, tuple[int, int]], id_col: str, max_text: int) -> Column:
    base, kind = f"_x{i}", S.spark_type(c)
    parent = next((k.parent for k in spec.foreign_keys if k.columns == (c.name,) and k.parent in parents), None)
    if c.auto_increment or [p.column for p in spec.primary_key] == [c.name]:
        # an id that the declared type can't hold is an error, not another row's id
        return F.coalesce(F.col(id_col).cast(kind), F.lit(0).cast(kind))
    if parent is not None:
        first, count = parents[parent]
        low = F.expr(f"{first}L").cast(kind)
        value = F.expr(_between(base, first, first + count - 1)).cast(kind)
    else:
        low, high, between = (F.expr(x).cast(kind) for x in _range(c, base, max_text))
        end = F.expr(f"{_limb(base, 0)} div 2048L")
        value = F.when(end == 0, low).when(end == 1, high).otherwise(between)
    if c.nullable:
        return F.when(F.expr(f"{_limb(base, 1)} % 10 <> 0"), value)
    return F.coalesce(value, low, _constant(c, kind))


def synth_typed(ids: DataFrame, spec: S.TableSpec, seed: int = 0, id_col: str = "id",
                parents: dict[str, tuple[int, int]] | None = None, max_text: int = 255) -> DataFrame:
    """Rows of ``struct_type(spec)``, one per id of ``ids``; nothing is shuffled.

    ``parents`` names the id space, ``(first id, number of ids)``, of tables
    that one-column foreign keys refer to: their values are drawn from it.
    Texts are as long as declared, ``max_text`` at most; of a SET the first 62
    members are drawn. Empty ``ids`` give no rows; a type without a generator
    (spatial, JSON) is a ValueError when the plan is made."""
    mixed = ids.select(F.col(id_col), *[F.expr(_seed_expr(id_col, i, seed)).alias(f"_x{i}") for i in range(len(spec.columns))])
    return mixed.select(*[_value(c, i, spec, parents or {}, id_col, max_text).alias(c.name, metadata=S.column_metadata(c))
                          for i, c in enumerate(spec.columns)])
