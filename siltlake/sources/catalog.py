"""Catalog dumps as DataFrames.

The catalog side takes ``information_schema``-shaped DataFrames of many
databases at once (a JDBC read of the source catalog, or a dump file), so the
same code serves one schema or ten thousand tenants.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltlake import spec as S

# The twelve column-metadata fields, in the order the source reads them.
COLUMN_FIELDS = (
    "column_name", "column_default", "ordinal_position", "data_type", "column_type",
    "character_maximum_length", "extra", "column_key", "is_nullable", "numeric_precision",
    "numeric_scale", "enum_list",
)


def select_tables(tables_df: DataFrame, database: str | None = None, limit: list[str] | None = None,
                  skip: list[str] | None = None) -> DataFrame:
    """Base tables of one schema (or all, ``database=None``).

    ``skip`` is tested first, so a name in both lists is skipped; an empty
    ``limit`` means every table. All predicates reach the source scan."""
    cond = F.upper(F.col("table_type")) == "BASE TABLE"
    if database is not None:
        cond = cond & (F.col("table_schema") == database)
    if skip:
        cond = cond & ~F.col("table_name").isin(*skip)
    if limit:
        cond = cond & F.col("table_name").isin(*limit)
    return tables_df.where(cond).select("table_schema", "table_name")


def enum_members(columns_df: DataFrame) -> DataFrame:
    """Add ``enum_list`` (the ``('a','b')`` text after the type word) and
    ``members ARRAY<STRING>`` for ENUM and SET columns (P6); quotes doubled
    inside a member are undoubled."""
    dt = F.lower(F.col("data_type"))
    ct = F.col("column_type")
    enum_list = (F.when(dt == "enum", F.substring(ct, 5, 1 << 20))
                 .when(dt == "set", F.substring(ct, 4, 1 << 20)))
    members = F.transform(F.regexp_extract_all(enum_list, F.lit("'((?:[^']|'')*)'"), 1),
                          lambda m: F.replace(m, F.lit("''"), F.lit("'")))
    out = columns_df.withColumn("enum_list", F.coalesce(F.col("enum_list"), enum_list)) \
        if "enum_list" in columns_df.columns else columns_df.withColumn("enum_list", enum_list)
    return out.withColumn("members", F.when(dt.isin("enum", "set"), members))


def specs_from_catalog(tables_df: DataFrame, columns_df: DataFrame, database: str | None = None,
                       limit: list[str] | None = None, skip: list[str] | None = None) -> dict[tuple[str, str], S.TableSpec]:
    """A spec for every selected table, ``{(schema, table): spec}``: the whole
    loop from a catalog dump to the snapshot jobs. Only metadata of the
    selected tables reaches the driver, one row per column."""
    chosen = select_tables(tables_df, database, limit, skip)
    rows = table_columns(columns_df.join(chosen, ["table_schema", "table_name"], "left_semi"), database).toLocalIterator()
    by_table: dict[tuple[str, str], list] = {}
    for r in rows:
        by_table.setdefault((r["table_schema"], r["table_name"]), []).append(r)
    return {k: S.spec_from_columns(k[1], v) for k, v in by_table.items()}


def table_columns(columns_df: DataFrame, database: str | None = None, table: str | None = None) -> DataFrame:
    """Column metadata of one table (or of every table when unset), with the
    twelve fields, ordered by ``ordinal_position`` (S2)."""
    cond = F.lit(True)
    if database is not None:
        cond = cond & (F.col("table_schema") == database)
    if table is not None:
        cond = cond & (F.col("table_name") == table)
    df = enum_members(columns_df.where(cond))
    keep = [c for c in ("table_schema", "table_name") if c in df.columns]
    cols = keep + [c if c in df.columns else F.lit(None).alias(c) for c in COLUMN_FIELDS] + ["members"]
    out = df.select(*cols)
    return out.orderBy(*keep, "ordinal_position") if keep else out.orderBy("ordinal_position")
