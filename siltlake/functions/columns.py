"""Column-level building blocks (all JVM-side built-ins, inside codegen).

These are the per-value rules of the loose contract: how a binary, bit,
zero date or arbitrary value is spelled on export, how a CSV line is built,
how a key part or a partition label is computed.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from siltlake.spec import KeyPart

# The spellings of "no date" a loose source may hold.
ZERO_DATE_TEXTS = ("0000-00-00", "0000-00-00 00:00:00")


def int_lit(v: int, precision: int = 38) -> Column:
    """An exact integer literal of any size (Python ints beyond BIGINT, such
    as the BIGINT UNSIGNED maximum, cannot go through ``F.lit`` directly)."""
    return F.lit(str(int(v))).cast(f"decimal({precision},0)")


def col_of(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def binary_hex(c: str | Column) -> Column:
    """Binary -> upper-case hexadecimal text."""
    return F.hex(col_of(c))


def bit_unsigned(c: str | Column, from_binary: bool = True) -> Column:
    """Big-endian bit string -> unsigned integer, full 64 bits."""
    c = col_of(c)
    if from_binary:
        return F.conv(F.hex(c), 16, 10).cast("decimal(20,0)")
    return c.cast("decimal(20,0)")


def is_zero_date(c: str | Column) -> Column:
    """True for the zero-date spellings (also with a fractional part)."""
    s = F.trim(col_of(c).cast("string"))
    return s.isin(*ZERO_DATE_TEXTS) | s.startswith("0000-00-00 00:00:00.")


def zero_date_null(c: str | Column, to: str = "timestamp_ntz") -> Column:
    """Zero date -> NULL, anything else parsed loosely (P3). Never throws:
    ANSI casts would, so the parse is a ``try_cast`` on text."""
    c = col_of(c)
    return F.when(is_zero_date(c), F.lit(None).cast(to)).otherwise(c.cast("string").try_cast(to))


def to_text(c: str | Column) -> Column:
    """Anything else -> text (P5)."""
    return col_of(c).cast("string")


def zerofill(c: str | Column, width: int) -> Column:
    """Left-pad the decimal text of a number to ``width``; never truncate."""
    s = col_of(c).cast("string")
    return F.when(F.length(s) < width, F.lpad(s, width, "0")).otherwise(s)


def csv_field(c: str | Column) -> Column:
    """One CSV field: quoted, inner quotes doubled; a real NULL is the bare word NULL.

    Null is decided per field, before joining, so a value that *is* the text
    ``NULL`` stays quoted and distinguishable (X3)."""
    s = col_of(c).cast("string")
    return F.coalesce(F.concat(F.lit('"'), F.replace(s, F.lit('"'), F.lit('""')), F.lit('"')), F.lit("NULL"))


def csv_line(*cols: str | Column) -> Column:
    """One CSV text line per row."""
    return F.concat_ws(",", *[csv_field(c) for c in cols])


def key_part_col(part: KeyPart | str) -> Column:
    """A key part as a Column: column, column prefix, or SQL expression."""
    if isinstance(part, str):
        return F.col(part)
    if part.expr is not None:
        return F.expr(part.expr)
    c = F.col(part.column)
    if part.prefix:
        return F.substring(c.cast("string"), 1, part.prefix)
    return c


def key_part_name(part: KeyPart | str, i: int = 0) -> str:
    if isinstance(part, str):
        return part
    if part.expr is not None:
        return f"_k{i}"
    return f"{part.column}_{part.prefix}" if part.prefix else part.column


def any_null(cols: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, [c.isNull() for c in cols])


def all_null(cols: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, [c.isNull() for c in cols])


# --------------------------------------------------------------------------
# Partition labels
# --------------------------------------------------------------------------

def hash_label(expr: str | Column, n: int) -> Column:
    """HASH(expr) PARTITIONS n: ``expr mod n`` (non-negative)."""
    e = F.expr(expr) if isinstance(expr, str) else expr
    return F.pmod(e.cast("bigint"), F.lit(n).cast("bigint"))


def linear_hash_label(expr: str | Column, n: int) -> Column:
    """LINEAR HASH: powers-of-two mask, folded once when the bucket is >= n.

    With m = 2^ceil(log2 n) - 1, ``k & m`` is below 2n, so a single fold by
    ``m >> 1`` always lands below n; adding a bucket moves few rows."""
    e = F.expr(expr) if isinstance(expr, str) else expr
    e = e.cast("bigint")
    m = 1
    while m < n:
        m <<= 1
    m -= 1
    b = e.bitwiseAND(F.lit(m).cast("bigint"))
    return F.when(b >= n, e.bitwiseAND(F.lit(m >> 1).cast("bigint"))).otherwise(b)


def key_hash(cols: list[str | Column]) -> Column:
    """Engine-neutral hash of a column list: the first 32 bits of md5 over
    the ``|``-joined text of the values, as a non-negative BIGINT; NULL if any
    value is (such a row has no partition)."""
    txt = F.concat_ws("|", *[col_of(c).cast("string") for c in cols])
    h = F.conv(F.substring(F.md5(txt), 1, 8), 16, 10).cast("bigint")
    return F.when(~any_null([col_of(c) for c in cols]), h)


def key_label(cols: list[str | Column], n: int, linear: bool = False) -> Column:
    h = key_hash(cols)
    return linear_hash_label(h, n) if linear else F.pmod(h, F.lit(n).cast("bigint"))


def _lt_tuple(values: list[Column], bound: tuple) -> Column:
    """Lexicographic ``values < bound``; a None part of the bound is MAXVALUE."""
    head, rest = values[0], values[1:]
    b0 = bound[0]
    if b0 is None:  # MAXVALUE: strictly greater than any value
        return F.lit(True)
    lt = head < F.lit(b0)
    if not rest:
        return lt
    return lt | ((head == F.lit(b0)) & _lt_tuple(rest, bound[1:]))


def range_label(values: list[Column], bounds: list, names: list[str] | None = None) -> Column:
    """First partition whose bound is strictly greater than the value
    (``VALUES LESS THAN``); None = MAXVALUE; unrouted and NULL -> NULL."""
    names = names or [f"p{i}" for i in range(len(bounds))]
    below = [_lt_tuple(values, b if isinstance(b, tuple) else (b,)) for b in bounds]

    def search(lo: int, hi: int) -> Column:
        """Among partitions lo..hi-1 (bounds ascend), by halving: a row
        evaluates about log2 of the bounds, not all of them."""
        if hi - lo == 1:
            return F.when(below[lo], F.lit(names[lo]))
        mid = (lo + hi) // 2
        return F.when(below[mid - 1], search(lo, mid)).otherwise(search(mid, hi))

    return F.when(~any_null(values), search(0, len(bounds))) if bounds else F.lit(None).cast("string")
