"""Declared table shape: columns, keys, checks, references and partitioning.

A ``TableSpec`` is plain data the user writes (or derives from a catalog
columns DataFrame with :func:`spec_from_columns`). Operators read it to decide
which Spark expressions to build; it never holds data rows.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, replace
from typing import Any

from pyspark.sql import types as T

# Sentinel: a column with no declared default (distinct from DEFAULT NULL).
NO_DEFAULT = object()

# Source type families (source type names, lower case).
INTEGER_TYPES = ("tinyint", "smallint", "mediumint", "int", "integer", "bigint")
DECIMAL_TYPES = ("decimal", "numeric", "dec", "fixed")
FLOAT_TYPES = ("float",)
DOUBLE_TYPES = ("double", "real", "double precision")
BOOL_TYPES = ("bool", "boolean")
DATE_TYPES = ("date",)
DATETIME_TYPES = ("datetime",)
TIMESTAMP_TYPES = ("timestamp",)
ZERO_DATE_TYPES = ("datetime", "timestamp", "date")
TEXT_TYPES = ("char", "varchar", "text", "tinytext", "mediumtext", "longtext", "nchar", "nvarchar")
BINARY_TYPES = ("blob", "tinyblob", "mediumblob", "longblob", "binary", "varbinary")
SPATIAL_TYPES = (
    "point", "geometry", "linestring", "polygon", "multipoint",
    "multilinestring", "multipolygon", "geometrycollection",
)

# Signed ranges of the integer types, and their unsigned maxima.
SIGNED_RANGE = {
    "tinyint": (-128, 127),
    "smallint": (-32768, 32767),
    "mediumint": (-8388608, 8388607),
    "int": (-2147483648, 2147483647),
    "integer": (-2147483648, 2147483647),
    "bigint": (-9223372036854775808, 9223372036854775807),
}
UNSIGNED_MAX = {
    "tinyint": 255,
    "smallint": 65535,
    "mediumint": 16777215,
    "int": 4294967295,
    "integer": 4294967295,
    "bigint": 18446744073709551615,
}


@dataclass(frozen=True)
class ColumnSpec:
    name: str
    data_type: str = "varchar"
    length: int | None = None          # char/binary length, bit width, display width
    precision: int | None = None
    scale: int | None = None
    unsigned: bool = False
    zerofill: bool = False
    nullable: bool = True
    default: Any = NO_DEFAULT
    members: tuple[str, ...] = ()      # ENUM / SET domain
    generated: str | None = None       # Spark SQL expression
    stored: bool = True                # STORED vs VIRTUAL generated column
    visible: bool = True
    auto_increment: bool = False
    unique: bool = False
    primary: bool = False
    collation: str | None = None       # Spark collation name, e.g. UTF8_LCASE
    on_update_now: bool = False        # "ON UPDATE CURRENT_TIMESTAMP"
    comment: str | None = None

    @property
    def kind(self) -> str:
        return self.data_type.lower()

    def has_default(self) -> bool:
        return self.default is not NO_DEFAULT


@dataclass(frozen=True)
class KeyPart:
    """One part of a key: a column (optionally only its first ``prefix``
    characters) or a Spark SQL expression, with a sort direction."""

    column: str | None = None
    expr: str | None = None
    prefix: int | None = None
    descending: bool = False

    @property
    def label(self) -> str:
        if self.expr is not None:
            return self.expr
        return f"{self.column}({self.prefix})" if self.prefix else str(self.column)


@dataclass(frozen=True)
class Check:
    name: str
    rule: str                 # Spark SQL boolean expression
    enforced: bool = True


@dataclass(frozen=True)
class ForeignKey:
    name: str
    columns: tuple[str, ...]
    parent: str
    parent_columns: tuple[KeyPart, ...]
    match: str = "SIMPLE"             # SIMPLE | FULL | PARTIAL
    on_delete: str = "RESTRICT"       # RESTRICT | CASCADE | SET NULL | NO ACTION | SET DEFAULT
    on_update: str = "RESTRICT"


@dataclass(frozen=True)
class PartitionSpec:
    """HASH(expr) / KEY(cols) / RANGE(expr|COLUMNS) / LIST(expr|COLUMNS) with optional sub-level."""

    kind: str                                   # hash | key | range | list
    expr: str | None = None
    columns: tuple[str, ...] = ()
    count: int | None = None
    linear: bool = False
    bounds: tuple[Any, ...] = ()                # range: one value or tuple per partition, None = MAXVALUE
    lists: tuple[tuple[Any, ...], ...] = ()     # list: members per partition
    names: tuple[str, ...] = ()
    sub: "PartitionSpec | None" = None


@dataclass(frozen=True)
class TableSpec:
    name: str
    columns: tuple[ColumnSpec, ...]
    primary_key: tuple[KeyPart, ...] = ()
    unique_keys: tuple[tuple[KeyPart, ...], ...] = ()
    foreign_keys: tuple[ForeignKey, ...] = ()
    checks: tuple[Check, ...] = ()
    partitioning: PartitionSpec | None = None
    auto_increment_start: int = 1
    collation: str | None = None
    union_members: tuple[str, ...] = ()

    def column(self, name: str) -> ColumnSpec:
        for c in self.columns:
            if c.name == name:
                return c
        raise KeyError(name)

    @property
    def column_names(self) -> list[str]:
        return [c.name for c in self.columns]

    def with_columns(self, *cols: ColumnSpec) -> "TableSpec":
        return replace(self, columns=tuple(self.columns) + tuple(cols))


# --------------------------------------------------------------------------
# Type map: the loose typing contract (source type -> Spark landing type)
# --------------------------------------------------------------------------

_WIDER_UNSIGNED = {
    "tinyint": T.ShortType(),
    "smallint": T.IntegerType(),
    "mediumint": T.IntegerType(),
    "int": T.LongType(),
    "integer": T.LongType(),
    "bigint": T.DecimalType(20, 0),
}
_SIGNED = {
    "tinyint": T.ByteType(),
    "smallint": T.ShortType(),
    "mediumint": T.IntegerType(),
    "int": T.IntegerType(),
    "integer": T.IntegerType(),
    "bigint": T.LongType(),
}


def spark_type(col: ColumnSpec) -> T.DataType:
    k = col.kind
    if k == "bit":
        return T.DecimalType(20, 0) if (col.length or 1) == 64 else T.LongType()
    if k in INTEGER_TYPES:
        return _WIDER_UNSIGNED[k] if col.unsigned else _SIGNED[k]
    if k in BOOL_TYPES:
        return T.BooleanType()
    if k in DECIMAL_TYPES:
        p = col.precision if col.precision is not None else 10
        s = col.scale if col.scale is not None else 0
        return T.StringType() if p > 38 else T.DecimalType(p, s)
    if k in FLOAT_TYPES:
        return T.FloatType()
    if k in DOUBLE_TYPES:
        return T.DoubleType()
    if k in DATE_TYPES:
        return T.DateType()
    if k in DATETIME_TYPES:
        return T.TimestampNTZType()
    if k in TIMESTAMP_TYPES:
        return T.TimestampType()
    if k == "time":
        return T.DayTimeIntervalType(T.DayTimeIntervalType.DAY, T.DayTimeIntervalType.SECOND)
    if k == "year":
        return T.ShortType()
    if k in BINARY_TYPES or k in SPATIAL_TYPES:
        return T.BinaryType()
    if k == "set":
        return T.ArrayType(T.StringType())
    return T.StringType()


def column_metadata(c: ColumnSpec) -> dict:
    """What the Spark type loses about the source column (unsigned, length,
    domain, collation), kept as field metadata of the landed column."""
    meta = {"source_type": c.kind}
    if c.length is not None:
        meta["length"] = c.length
    if c.unsigned:
        meta["unsigned"] = True
    if c.members:
        meta["members"] = list(c.members)
    if c.collation:
        meta["collation"] = c.collation
    return meta


def struct_type(spec: TableSpec) -> T.StructType:
    """Spark schema of the landed table; what Spark types lose rides in metadata."""
    return T.StructType([T.StructField(c.name, spark_type(c), c.nullable, column_metadata(c)) for c in spec.columns])


# --------------------------------------------------------------------------
# From catalog metadata rows to a spec
# --------------------------------------------------------------------------

_MEMBER_RE = re.compile(r"'((?:[^']|'')*)'")


def parse_members(enum_list: str | None) -> tuple[str, ...]:
    """``('a','b''c')`` -> ('a', "b'c")."""
    if not enum_list:
        return ()
    return tuple(m.replace("''", "'") for m in _MEMBER_RE.findall(enum_list))


def column_from_metadata(row: dict) -> ColumnSpec:
    """One ``information_schema.columns``-shaped row -> ColumnSpec."""
    declared = row.get("column_type") or ""
    column_type = declared.lower()
    modifiers = column_type.rpartition(")")[2] if "(" in column_type else column_type  # members may hold any word
    data_type = (row.get("data_type") or "varchar").lower()
    length = row.get("character_maximum_length")
    m = re.match(r"^\w+\s*\((\d+)", column_type)
    if length is None and m and data_type in ("bit",) + INTEGER_TYPES:
        length = int(m.group(1))
    members = ()
    if data_type in ("enum", "set"):
        members = parse_members(row.get("enum_list") or declared[len(data_type):])
    extra = (row.get("extra") or "").lower()
    default = row.get("column_default")
    return ColumnSpec(
        name=row["column_name"],
        data_type=data_type,
        length=length,
        precision=row.get("numeric_precision"),
        scale=row.get("numeric_scale"),
        unsigned="unsigned" in modifiers,
        zerofill="zerofill" in modifiers,
        nullable=(row.get("is_nullable") or "YES").upper() == "YES",
        default=NO_DEFAULT if default is None else default,
        members=members,
        auto_increment="auto_increment" in extra,
        visible="invisible" not in extra,
        primary=(row.get("column_key") or "") == "PRI",
        unique=(row.get("column_key") or "") == "UNI",
        on_update_now="on update current_timestamp" in extra,
    )


def spec_from_columns(name: str, column_rows: list) -> TableSpec:
    """Build a TableSpec from the (small, per-table) metadata rows of S2.

    Only catalog metadata (one row per column) reaches the driver here.
    """
    rows = [r.asDict() if hasattr(r, "asDict") else dict(r) for r in column_rows]
    rows.sort(key=lambda r: r.get("ordinal_position") or 0)
    cols = tuple(column_from_metadata(r) for r in rows)
    pk = tuple(KeyPart(c.name) for c in cols if c.primary)
    uks = tuple((KeyPart(c.name),) for c in cols if c.unique)
    return TableSpec(name=name, columns=cols, primary_key=pk, unique_keys=uks)


def key_columns(parts: tuple[KeyPart, ...] | list) -> list[KeyPart]:
    return [p if isinstance(p, KeyPart) else KeyPart(p) for p in parts]


__all__ = [
    "NO_DEFAULT", "ColumnSpec", "KeyPart", "Check", "ForeignKey", "PartitionSpec", "TableSpec",
    "spark_type", "struct_type", "spec_from_columns", "column_from_metadata", "parse_members",
    "key_columns",
]
