"""Projections of the loose contract: dirty in, typed (or export text) out.

All are single ``select`` projections (narrow, no shuffle) except
:func:`assign_ids`, which needs one sort.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltlake import spec as S
from siltlake.functions.columns import bit_unsigned, int_lit, is_zero_date, zero_date_null
from siltlake.functions.spatial import wkb_to_wkt
from siltlake.session import checkpoint_dir


def _is_binary(df: DataFrame, name: str) -> bool:
    return isinstance(df.schema[name].dataType, T.BinaryType)


def _is_string(df: DataFrame, name: str) -> bool:
    return isinstance(df.schema[name].dataType, T.StringType)


def export_expr(df: DataFrame, c: S.ColumnSpec) -> Column:
    """The export spelling of one column."""
    k, col = c.kind, F.col(c.name)
    if k in S.BINARY_TYPES:
        return F.hex(col) if _is_binary(df, c.name) else col.cast("string")
    if k == "bit":
        return bit_unsigned(col, from_binary=_is_binary(df, c.name))
    if k in S.ZERO_DATE_TYPES:
        target = S.spark_type(c).simpleString()
        if _is_string(df, c.name):
            return zero_date_null(col, target)
        return col
    if k in S.SPATIAL_TYPES:
        return wkb_to_wkt(col) if _is_binary(df, c.name) else col.cast("string")
    return col.cast("string")


def normalize(df: DataFrame, spec: S.TableSpec, rescued: str | None = None) -> DataFrame:
    """Every declared column in declared order, in its export spelling.

    With ``rescued`` set, a value whose conversion failed (undecodable
    spatial bytes) is kept as hex text in that ``MAP<STRING,STRING>`` column."""
    cols = [export_expr(df, c).alias(c.name) for c in spec.columns]
    if rescued is None:
        return df.select(*cols)
    out = df.select(*cols, *[F.col(c.name).alias(f"_raw_{c.name}") for c in spec.columns
                             if c.kind in S.SPATIAL_TYPES and _is_binary(df, c.name)])
    empty = F.create_map().cast("map<string,string>")
    pieces = [F.when(F.col(f"_raw_{c.name}").isNotNull() & F.col(c.name).isNull(),
                     F.create_map(F.lit(c.name), F.hex(F.col(f"_raw_{c.name}")))).otherwise(empty)
              for c in spec.columns if f"_raw_{c.name}" in out.columns]
    return out.select(*[c.name for c in spec.columns],
                      (F.map_concat(*pieces) if pieces else empty).alias(rescued))


# --------------------------------------------------------------------------
# P7 loosen: typed landing that never fails
# --------------------------------------------------------------------------

def _time_interval(raw: Column) -> Column:
    """'[-]HHH:MM:SS[.ffffff]' -> DAY TO SECOND interval, NULL if malformed."""
    pat = r"^\s*(-?)(\d{1,3}):(\d{1,2}):(\d{1,2}(?:\.\d{1,6})?)\s*$"
    sign = F.regexp_extract(raw, pat, 1)
    h = F.regexp_extract(raw, pat, 2).try_cast("int")
    m = F.regexp_extract(raw, pat, 3).try_cast("int")
    s = F.regexp_extract(raw, pat, 4).try_cast("decimal(8,6)")
    ok = raw.rlike(pat) & (m < 60) & (s < 60) & (h <= 838)
    iv = F.make_dt_interval(F.lit(0), h, m, s)
    return F.when(ok, F.when(sign == "-", -iv).otherwise(iv))


# The value ranges of the source date/time types (TIMESTAMP in UTC).
DATE_RANGE = {
    "date": ("1000-01-01", "9999-12-31"),
    "datetime": ("1000-01-01 00:00:00", "9999-12-31 23:59:59.999999"),
    "timestamp": ("1970-01-01 00:00:01", "2038-01-19 03:14:07.999999"),
}

_INTEGRAL_RANGE = {"byte": (-128, 127), "short": (-32768, 32767), "integer": (-2 ** 31, 2 ** 31 - 1),
                   "long": (-2 ** 63, 2 ** 63 - 1)}


def _integral_fits(src: T.DataType, lo: int, hi: int) -> bool:
    a, b = _INTEGRAL_RANGE[src.typeName()]
    return lo <= a and b <= hi


def typed_expr(df: DataFrame, c: S.ColumnSpec) -> tuple[Column, Column]:
    """(typed value, 'was a zero date') for one declared column."""
    k, name = c.kind, c.name
    target = S.spark_type(c)
    col = F.col(name)
    raw = col.cast("string")
    zero = F.lit(False)
    if k == "bit":
        if _is_binary(df, name):
            v = bit_unsigned(col)
        else:
            v = raw.try_cast("decimal(20,0)")
        width = c.length or 1
        v = F.when((v >= 0) & (v <= int_lit(2 ** width - 1, 20)), v)
        out = v if isinstance(target, T.DecimalType) else v.cast(target)
    elif k in S.INTEGER_TYPES:
        lo, hi = (0, S.UNSIGNED_MAX[k]) if c.unsigned else S.SIGNED_RANGE[k]
        src = df.schema[name].dataType
        if isinstance(src, T.IntegralType):
            # already a whole number: only the range can be wrong
            fits = _integral_fits(src, lo, hi)
            out = col.cast(target) if fits else F.when(col.between(max(lo, -2 ** 63), min(hi, 2 ** 63 - 1)),
                                                        col.cast(target))
        elif hi <= 2 ** 63 - 1:
            # BIGINT parse first (cheap); text like '12.0' falls back to DECIMAL
            as_dec = raw.try_cast("decimal(38,4)")
            v = F.coalesce(raw.try_cast("bigint"),
                           F.when(as_dec == F.floor(as_dec), as_dec).cast("decimal(38,0)").try_cast("bigint"))
            out = F.when(v.between(lo, hi), v.cast(target))
        else:  # BIGINT UNSIGNED needs DECIMAL(20,0)
            v = raw.try_cast("decimal(38,4)")
            ok = (v >= 0) & (v <= int_lit(hi, 20)) & (v == F.floor(v))
            out = F.when(ok, v.cast(target))
    elif k == "year":
        v = raw.try_cast("int")
        out = F.when((v == 0) | v.between(1901, 2155), v.cast("short"))
    elif k in S.ZERO_DATE_TYPES:
        zero = is_zero_date(col)
        if _is_string(df, name):
            out = F.when(zero, F.lit(None).cast(target)).otherwise(raw.try_cast(target))
        else:
            out = col.try_cast(target)
        lo, hi = DATE_RANGE[k]
        out = F.when(out.between(F.lit(lo).cast(target), F.lit(hi).cast(target)), out)
    elif k == "time":
        out = _time_interval(raw)
    elif k in S.BINARY_TYPES or k in S.SPATIAL_TYPES:
        out = col if _is_binary(df, name) else raw.cast("binary")
    elif k == "set":
        out = F.when(raw == "", F.array().cast("array<string>")).otherwise(F.split(raw, ","))
    elif k in S.BOOL_TYPES:
        out = F.when(raw.isin("1", "true", "TRUE", "t"), F.lit(True)).when(
            raw.isin("0", "false", "FALSE", "f"), F.lit(False))
        num = raw.try_cast("decimal(20,0)")
        out = F.coalesce(out, F.when(num.isNotNull(), num != 0))
    elif isinstance(target, T.StringType):
        out = raw
    else:
        out = raw.try_cast(target)
    return out, zero


def loosen(df: DataFrame, spec: S.TableSpec, rescued: str = "_rescued") -> DataFrame:
    """Cast each declared column to its landing type without
    ever failing: a value that does not fit becomes NULL and its raw text is
    kept in ``_rescued MAP<STRING,STRING>`` (zero dates are a known spelling
    of NULL and are not rescued). Other input columns pass through."""
    typed, entries = [], []
    for c in spec.columns:
        if c.name not in df.columns:
            continue
        out, zero = typed_expr(df, c)
        raw = F.col(c.name).cast("string") if not _is_binary(df, c.name) else F.hex(F.col(c.name))
        lost = raw.isNotNull() & out.isNull() & ~F.coalesce(zero, F.lit(False))
        typed.append(out.alias(c.name, metadata=S.column_metadata(c)))
        entries += [F.lit(c.name), F.when(lost, raw)]
    declared = {c.name for c in spec.columns}
    extra = [F.col(n) for n in df.columns if n not in declared]
    # one conditional single-entry map per column, concatenated: no lambda,
    # so the whole projection stays inside generated code
    empty = F.create_map().cast("map<string,string>")
    pieces = [F.when(v.isNotNull(), F.create_map(k, v)).otherwise(empty) for k, v in zip(entries[::2], entries[1::2])]
    rmap = F.map_concat(*pieces) if pieces else empty
    return df.select(*typed, *extra, rmap.alias(rescued))


# --------------------------------------------------------------------------
# Defaults, generated, visibility, zerofill, add, collation
# --------------------------------------------------------------------------

def default_value(c: S.ColumnSpec) -> Column:
    if not c.has_default() or c.default is None:
        return F.lit(None).cast(S.spark_type(c))
    d = c.default
    if c.kind in ("date", "datetime", "timestamp", "time") and isinstance(d, str) and d.lower() in ("current_timestamp", "now()", "current_timestamp()"):
        return F.current_timestamp().cast(S.spark_type(c))
    if c.kind == "set" and isinstance(d, str):
        return F.split(F.lit(d), ",")
    if c.kind == "bit" and isinstance(d, str) and d.lower().startswith("b'") and d.endswith("'"):
        return F.lit(str(int(d[2:-1] or "0", 2))).cast(S.spark_type(c))  # catalog spelling b'0101'
    if isinstance(d, str) and len(d) >= 2 and d[0] == d[-1] == "'":
        d = d[1:-1].replace("''", "'")  # a quoted literal as some catalogs spell it
    if isinstance(d, (list, tuple)):
        return F.array(*[F.lit(x) for x in d]).cast(S.spark_type(c))
    return F.lit(d).cast("string").try_cast(S.spark_type(c)) if isinstance(d, str) else F.lit(d).cast(S.spark_type(c))


def fill_defaults(df: DataFrame, spec: S.TableSpec) -> DataFrame:
    """A declared column missing from the input gets its default; a present
    column keeps its values, explicit NULLs included (P8). Declared order,
    then any undeclared input columns."""
    present = set(df.columns)
    cols = [F.col(c.name) if c.name in present else default_value(c).alias(c.name) for c in spec.columns]
    declared = {c.name for c in spec.columns}
    return df.select(*cols, *[F.col(n) for n in df.columns if n not in declared])


def add_generated(df: DataFrame, spec: S.TableSpec, include_virtual: bool = True) -> DataFrame:
    """Generated columns as projections (P9). STORED ones are written with the
    table; VIRTUAL ones are added only when ``include_virtual`` (the view)."""
    out = df
    for c in spec.columns:
        if c.generated and (c.stored or include_virtual):
            out = out.withColumn(c.name, F.expr(c.generated).cast(S.spark_type(c)))
    return out


def visible_columns(df: DataFrame, spec: S.TableSpec) -> DataFrame:
    """``SELECT *`` semantics: INVISIBLE columns are left out (P10)."""
    hidden = {c.name for c in spec.columns if not c.visible}
    return df.select(*[n for n in df.columns if n not in hidden])


def apply_zerofill(df: DataFrame, spec: S.TableSpec, suffix: str = "_display") -> DataFrame:
    """For each ZEROFILL column add a padded display column."""
    from siltlake.functions.columns import zerofill
    out = df
    for c in spec.columns:
        if c.zerofill and c.name in df.columns:
            out = out.withColumn(c.name + suffix, zerofill(c.name, c.length or 10))
    return out


def add_columns(df: DataFrame, cols: list[S.ColumnSpec], first: bool = False, after: str | None = None) -> DataFrame:
    """``ADD COLUMN … [FIRST | AFTER c]`` (P13): old rows get the default."""
    new = [default_value(c).alias(c.name) for c in cols if c.name not in df.columns]
    names = [F.col(n) for n in df.columns]
    if first:
        return df.select(*new, *names)
    if after is not None:
        i = df.columns.index(after) + 1
        return df.select(*names[:i], *new, *names[i:])
    return df.select(*names, *new)


def with_collation(df: DataFrame, spec: S.TableSpec) -> DataFrame:
    """Apply the declared column (else table) collation to text columns (P14),
    so equality, ordering and LIKE follow it."""
    out = []
    for n in df.columns:
        coll = None
        try:
            c = spec.column(n)
            coll = c.collation or (spec.collation if isinstance(df.schema[n].dataType, T.StringType) else None)
        except KeyError:
            pass
        if coll and isinstance(df.schema[n].dataType, T.StringType):
            out.append(F.collate(F.col(n), coll).alias(n))
        else:
            out.append(F.col(n))
    return df.select(*out)


# --------------------------------------------------------------------------
# P12 dense ids in declared order without a single-partition window
# --------------------------------------------------------------------------

def assign_ids(df: DataFrame, order_by: list[str | Column], start: int = 1, id_col: str = "id",
               tiebreak: list[str] | None = None) -> DataFrame:
    """Dense increasing ids from ``start`` in ``order_by`` order.

    A global ``row_number() OVER (ORDER BY …)`` pulls every row into one task.
    Instead: one distributed sort (its range partitioner samples the full
    composite key, so even one hot value is split across tasks), materialised
    into the shared checkpoint folder so partition boundaries are stable, then
    per-partition counts (one row per partition) give each partition its
    offset and rows get ``offset + position``. ``tiebreak`` columns make the
    order total (pass a unique key)."""
    spark = df.sparkSession
    checkpoint_dir(spark)
    keys = [F.col(c) if isinstance(c, str) else c for c in order_by] + [F.col(c) for c in (tiebreak or [])]
    ordered = df.sort(*keys).checkpoint(eager=True)
    tagged = ordered.withColumn("_pid", F.spark_partition_id()).withColumn(
        "_mid", F.monotonically_increasing_id())
    # monotonically_increasing_id = (partition << 33) + position in partition
    # one count per partition (what zipWithIndex gathers too): bounded by the
    # partition count, so the prefix sums and their broadcast are small
    counts = sorted((r["_pid"], r["_n"]) for r in
                    tagged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n")).collect())
    rows, acc = [], 0
    for pid, n in counts:
        rows.append((pid, acc))
        acc += n
    offsets = spark.createDataFrame(rows, "_pid int, _off long")
    out = tagged.join(F.broadcast(offsets), "_pid")
    pos = F.col("_mid") - F.shiftleft(F.col("_pid").cast("bigint"), 33)
    return out.withColumn(id_col, (F.col("_off") + pos + F.lit(start)).cast("bigint")).drop("_pid", "_mid", "_off")


def assign_auto_increment(df: DataFrame, spec: S.TableSpec, order_by: list[str | Column],
                          tiebreak: list[str] | None = None) -> DataFrame:
    """Fill the spec's AUTO_INCREMENT column with dense ids from the table's
    ``AUTO_INCREMENT=`` start value, in ``order_by`` order (P12)."""
    col = next(c for c in spec.columns if c.auto_increment)
    base = df.drop(col.name) if col.name in df.columns else df
    return assign_ids(base, order_by, start=spec.auto_increment_start, id_col=col.name, tiebreak=tiebreak)
