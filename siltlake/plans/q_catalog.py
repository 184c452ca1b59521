"""Catalog queries (S1, S2, P6, A3, F13, O1) over dumps derived from given rows:
each ``part`` is a column of some tenant's table, each ``supplier`` a table."""

from __future__ import annotations

from pyspark.sql import functions as F

from siltlake.operators.profile import type_census
from siltlake.plans import fixtures as X
from siltlake.plans.registry import register
from siltlake.sources import catalog as K

_LIMIT, _SKIP = ["t1", "t2", "t3", "t5"], ["t2", "t9"]


def tables_dump(spark, sf_dir):
    k = F.col("s_suppkey")
    return X.table(spark, sf_dir, "supplier").select(
        F.concat(F.lit("tenant"), (k % 7).cast("string")).alias("table_schema"),
        F.concat(F.lit("t"), F.floor(k / 7).cast("string")).alias("table_name"),
        F.when(k % 11 == 0, "VIEW").otherwise("BASE TABLE").alias("table_type"))


TABLES_SQL = """tables_dump AS (
  SELECT 'tenant' || CAST(s_suppkey % 7 AS VARCHAR) AS table_schema,
    't' || CAST(CAST(FLOOR(s_suppkey / 7) AS BIGINT) AS VARCHAR) AS table_name,
    CASE WHEN s_suppkey % 11 = 0 THEN 'VIEW' ELSE 'BASE TABLE' END AS table_type FROM supplier)"""


def columns_dump(spark, sf_dir):
    k = F.col("p_partkey")
    kind = k % 4
    members = F.concat(F.lit("('"), F.col("p_brand"), F.lit("','It''s New','unsigned')"))
    return X.table(spark, sf_dir, "part").select(
        F.concat(F.lit("tenant"), (k % 7).cast("string")).alias("table_schema"),
        F.concat(F.lit("t"), F.floor(k / 70).cast("string")).alias("table_name"),
        F.concat(F.lit("c"), k.cast("string")).alias("column_name"),
        F.when(kind == 1, F.col("p_brand")).alias("column_default"),
        (F.floor(k / 7) % 10 + 1).cast("int").alias("ordinal_position"),
        F.when(kind == 0, "int").when(kind == 1, "enum").when(kind == 2, "set").otherwise("varchar").alias("data_type"),
        F.when(kind == 0, "int(10) unsigned").when(kind == 1, F.concat(F.lit("enum"), members))
        .when(kind == 2, F.concat(F.lit("set"), members)).otherwise("varchar(25)").alias("column_type"),
        F.when(kind == 3, 25).alias("character_maximum_length"),
        F.lit("").alias("extra"), F.when(F.floor(k / 7) % 10 == 0, "PRI").otherwise("").alias("column_key"),
        F.when(k % 3 == 0, "YES").otherwise("NO").alias("is_nullable"),
        F.when(kind == 0, 10).alias("numeric_precision"), F.when(kind == 0, 0).alias("numeric_scale"))


COLUMNS_SQL = """columns_dump AS (
  SELECT 'tenant' || CAST(p_partkey % 7 AS VARCHAR) AS table_schema,
    't' || CAST(CAST(FLOOR(p_partkey / 70) AS BIGINT) AS VARCHAR) AS table_name,
    'c' || CAST(p_partkey AS VARCHAR) AS column_name,
    CASE WHEN p_partkey % 4 = 1 THEN p_brand END AS column_default,
    CAST(CAST(FLOOR(p_partkey / 7) AS BIGINT) % 10 + 1 AS INTEGER) AS ordinal_position,
    CASE p_partkey % 4 WHEN 0 THEN 'int' WHEN 1 THEN 'enum' WHEN 2 THEN 'set' ELSE 'varchar' END AS data_type,
    CASE p_partkey % 4 WHEN 0 THEN 'int(10) unsigned' WHEN 3 THEN 'varchar(25)' ELSE
      CASE p_partkey % 4 WHEN 1 THEN 'enum' ELSE 'set' END || '(''' || p_brand || ''',''It''''s New'',''unsigned'')' END AS column_type,
    CASE WHEN p_partkey % 4 = 3 THEN 25 END AS character_maximum_length, '' AS extra,
    CASE WHEN CAST(FLOOR(p_partkey / 7) AS BIGINT) % 10 = 0 THEN 'PRI' ELSE '' END AS column_key,
    CASE WHEN p_partkey % 3 = 0 THEN 'YES' ELSE 'NO' END AS is_nullable,
    CASE WHEN p_partkey % 4 = 0 THEN 10 END AS numeric_precision, CASE WHEN p_partkey % 4 = 0 THEN 0 END AS numeric_scale,
    p_brand FROM part)"""


@register("select_tables", f"""
WITH {TABLES_SQL}
SELECT table_schema, table_name FROM tables_dump WHERE table_type = 'BASE TABLE' AND table_name NOT IN ('t2', 't9')
  AND table_name IN ('t1', 't2', 't3', 't5')
""")
def q_select_tables(spark, sf_dir):
    return K.select_tables(tables_dump(spark, sf_dir), limit=_LIMIT, skip=_SKIP)


@register("table_columns", f"""
WITH {COLUMNS_SQL}
SELECT table_schema, table_name, column_name, column_default, ordinal_position, data_type, column_type,
  character_maximum_length, extra, column_key, is_nullable, numeric_precision, numeric_scale,
  CASE data_type WHEN 'enum' THEN substr(column_type, 5) WHEN 'set' THEN substr(column_type, 4) END AS enum_list,
  CASE WHEN data_type IN ('enum', 'set') THEN [p_brand, 'It''s New', 'unsigned'] END AS members
FROM columns_dump WHERE table_schema = 'tenant3'
""")
def q_table_columns(spark, sf_dir):
    return K.table_columns(columns_dump(spark, sf_dir), database="tenant3")


@register("enum_members", f"""
WITH {COLUMNS_SQL}
SELECT table_schema, column_name, member FROM (
  SELECT table_schema, column_name, unnest([p_brand, 'It''s New', 'unsigned']) AS member
  FROM columns_dump WHERE data_type IN ('enum', 'set')) m
""")
def q_enum_members(spark, sf_dir):
    return K.enum_members(columns_dump(spark, sf_dir)).select("table_schema", "column_name", F.explode("members").alias("member"))


@register("type_census", f"""
WITH {COLUMNS_SQL}
SELECT data_type, COUNT(*) AS n_columns, COUNT(DISTINCT (table_schema, table_name)) AS n_tables FROM columns_dump GROUP BY data_type
""")
def q_type_census(spark, sf_dir):
    return type_census(columns_dump(spark, sf_dir))
