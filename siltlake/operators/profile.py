"""Column profiles (A4) and the catalog type census (A3).

A profile is one aggregate pass over the table (partial + final hash
aggregate), then a narrow explode into one row per column.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _long(one, cols, fields):
    """One-row aggregate -> one row per column (narrow explode of a tiny row)."""
    items = F.array(*[F.struct(F.lit(c).alias("column_name"),
                               *[F.col(f"{f}{i}").cast(t).alias(name) for f, name, t in fields])
                      for i, c in enumerate(cols)])
    return one.select(F.explode(items).alias("_p")).select("_p.*")


_FIELDS = [("_rows", "n_rows", "bigint"), ("_nul", "n_null", "bigint"), ("_dis", "n_distinct", "bigint"),
           ("_min", "min_value", "string"), ("_max", "max_value", "string"), ("_len", "max_length", "bigint")]


def profile(df: DataFrame, columns: list[str] | None = None, exact: bool = False) -> DataFrame:
    """Per column: rows, nulls, distinct values, min, max (as text) and the
    longest text form — what is needed to choose a loose landing type.

    ``exact=False`` (default) is one pass with HyperLogLog++
    (``approx_count_distinct``), fixed-size state per column. ``exact=True``
    runs the plain statistics in one pass and counts each column's distinct
    values by itself (a scan of that column, partly aggregated before its
    shuffle), so no row is expanded once a column, and merges the results by
    column name."""
    cols = columns or df.columns

    def stats(with_approx: bool):
        aggs = []
        for i, c in enumerate(cols):
            x = F.col(c)
            aggs += [F.count(F.lit(1)).alias(f"_rows{i}"), F.sum(x.isNull().cast("bigint")).alias(f"_nul{i}"),
                     (F.approx_count_distinct(x) if with_approx else F.lit(None)).alias(f"_dis{i}"),
                     F.min(x).cast("string").alias(f"_min{i}"), F.max(x).cast("string").alias(f"_max{i}"),
                     F.max(F.length(x.cast("string"))).alias(f"_len{i}")]
        return _long(df.agg(*aggs), cols, _FIELDS)

    if not exact:
        return stats(True)
    # one narrow count a column: a count of all of them at once would read each row once a column
    counts = [df.select(F.col(c).alias("_v")).where("_v IS NOT NULL").distinct().agg(F.count("*").alias("_n"))
              .select(F.lit(c).alias("column_name"), *[(F.col("_n") if n == "n_distinct" else F.lit(None)).cast(t).alias(n) for _, n, t in _FIELDS])
              for c in cols]
    dist_long = reduce(lambda x, y: x.unionByName(y), counts)
    both = stats(False).unionByName(dist_long)
    # at most two rows per column: merge them
    return both.groupBy("column_name").agg(*[F.max(n).alias(n) for _, n, _ in _FIELDS])


def type_census(columns_df: DataFrame) -> DataFrame:
    """"See which types we get": per source ``data_type`` the number of
    columns and of distinct (schema, table) pairs, across every database in
    the catalog dump."""
    return columns_df.groupBy("data_type").agg(
        F.count(F.lit(1)).alias("n_columns"),
        F.count_distinct("table_schema", "table_name").alias("n_tables"))
