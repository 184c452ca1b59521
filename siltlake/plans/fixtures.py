"""Dirty and change-data tables derived by Spark from the given tables.

Each derivation exists twice: as a DataFrame (what our queries read) and as
an SQL common table expression (what the DuckDB oracle reads). They are
whole-table projections, so the work grows with the input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# --------------------------------------------------------------------------
# dirty_orders
# --------------------------------------------------------------------------

def dirty_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    return o.select(
        k,
        F.when(k % 19 == 0, F.col("o_custkey") + 10000000).otherwise(F.col("o_custkey")).alias("cust_ref"),
        F.when(k % 11 == 0, F.lit("0000-00-00 00:00:00")).otherwise(
            F.col("o_orderdate").cast("string")).alias("order_date"),
        F.when(k % 13 == 0, F.lit("n/a")).otherwise(F.col("o_totalprice").cast("string")).alias("total_price"),
        F.col("o_custkey").cast("string").alias("small_code"),
        F.col("o_orderstatus").alias("status"),
        F.when(k % 5 == 0, F.lit(None).cast("string")).when(
            k % 7 == 0, F.concat(F.lit('say "hi", '), F.col("o_orderpriority"))).otherwise(
            F.col("o_orderpriority")).alias("note"),
    )


DIRTY_ORDERS_SQL = """dirty_orders AS (
  SELECT o_orderkey,
    CASE WHEN o_orderkey % 19 = 0 THEN o_custkey + 10000000 ELSE o_custkey END AS cust_ref,
    CASE WHEN o_orderkey % 11 = 0 THEN '0000-00-00 00:00:00' ELSE CAST(o_orderdate AS VARCHAR) END AS order_date,
    CASE WHEN o_orderkey % 13 = 0 THEN 'n/a' ELSE CAST(o_totalprice AS VARCHAR) END AS total_price,
    CAST(o_custkey AS VARCHAR) AS small_code, o_orderstatus AS status,
    CASE WHEN o_orderkey % 5 = 0 THEN NULL
         WHEN o_orderkey % 7 = 0 THEN 'say "hi", ' || o_orderpriority
         ELSE o_orderpriority END AS note
  FROM orders)"""


# --------------------------------------------------------------------------
# changelog and friends
# --------------------------------------------------------------------------

def changelog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event as a change."""
    i = F.col("event_id")
    return table(spark, sf_dir, "events").select(
        i.alias("seq"), F.col("ts"), F.col("user_id").alias("pk"),
        F.concat(F.lit("srv-"), (i % 3).cast("string")).alias("server_uuid"),
        F.floor(i / 3).cast("bigint").alias("txn_no"),
        F.when(i % 7 == 0, F.lit("delete")).when(F.col("event_type") == "signup", F.lit("insert")).otherwise(
            F.lit("update")).alias("op"),
        "event_type", "value", "props")


CHANGELOG_SQL = """changelog AS (
  SELECT event_id AS seq, ts, user_id AS pk,
    'srv-' || CAST(event_id % 3 AS VARCHAR) AS server_uuid,
    CAST(FLOOR(event_id / 3) AS BIGINT) AS txn_no,
    CASE WHEN event_id % 7 = 0 THEN 'delete' WHEN event_type = 'signup' THEN 'insert' ELSE 'update' END AS op,
    event_type, value, props
  FROM events)"""


def gapped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log with numbers missing: the input of what looks for gaps."""
    return changelog(spark, sf_dir).where(F.col("seq") % 17 != 0)


GAPPED_SQL = CHANGELOG_SQL.replace("FROM events)", "FROM events WHERE event_id % 17 <> 0)")


def changelog_replayed(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = changelog(spark, sf_dir)
    return c.unionByName(c.where(F.col("seq") % 10 == 3))


REPLAYED_SQL = CHANGELOG_SQL + """,
changelog_replayed AS (SELECT * FROM changelog UNION ALL SELECT * FROM changelog WHERE seq % 10 = 3)"""


def changelog_images(spark: SparkSession, sf_dir: str, source: DataFrame | None = None) -> DataFrame:
    """Full row images: the before image that a real log carries is the key's
    previous row, found without a window over a whole key."""
    from siltlake.operators.changes import with_previous
    c = with_previous(source if source is not None else changelog(spark, sf_dir), {"event_type": "before_type", "value": "before_value"})
    dele = F.col("op") == "delete"
    return c.select(
        "seq", "ts", "pk", "server_uuid", "txn_no", "op", "before_type", "before_value",
        F.when(dele, F.lit(None).cast("string")).otherwise(F.col("event_type")).alias("after_type"),
        F.when(dele, F.lit(None).cast("double")).otherwise(F.col("value")).alias("after_value"))


_IMAGES = """,
changelog_images AS (
  SELECT seq, ts, pk, server_uuid, txn_no, op,
    LAG(event_type) OVER (PARTITION BY pk ORDER BY seq) AS before_type,
    LAG(value) OVER (PARTITION BY pk ORDER BY seq) AS before_value,
    CASE WHEN op = 'delete' THEN NULL ELSE event_type END AS after_type,
    CASE WHEN op = 'delete' THEN NULL ELSE value END AS after_value
  FROM changelog)"""
IMAGES_SQL = CHANGELOG_SQL + _IMAGES
GAPPED_IMAGES_SQL = GAPPED_SQL + _IMAGES


def base_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    return e.select((F.col("user_id") + 20).alias("pk")).distinct().select(
        "pk", F.lit(-1).cast("bigint").alias("seq"), F.lit(0.0).cast("double").alias("value"))


BASE_USERS_SQL = """base_users AS (
  SELECT pk, CAST(-1 AS BIGINT) AS seq, CAST(0.0 AS DOUBLE) AS value
  FROM (SELECT DISTINCT user_id + 20 AS pk FROM events) z)"""


# --------------------------------------------------------------------------
# line_refs, tag_sets
# --------------------------------------------------------------------------

def line_refs(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    k = F.col("l_orderkey")
    return li.select(
        "l_orderkey", "l_linenumber", "l_linestatus",
        F.when(k % 23 == 0, F.lit(None).cast("bigint")).when(k % 29 == 0, F.lit(-1).cast("bigint")).otherwise(
            k).alias("ref_key"),
        F.when(F.col("l_partkey") % 31 == 0, F.lit(None).cast("string")).otherwise(
            F.col("l_linestatus")).alias("ref_status"))


LINE_REFS_SQL = """line_refs AS (
  SELECT l_orderkey, l_linenumber, l_linestatus,
    CASE WHEN l_orderkey % 23 = 0 THEN NULL WHEN l_orderkey % 29 = 0 THEN -1 ELSE l_orderkey END AS ref_key,
    CASE WHEN l_partkey % 31 = 0 THEN NULL ELSE l_linestatus END AS ref_status
  FROM lineitem)"""


def tag_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    r = F.col("o_orderkey") % 6
    return o.select("o_orderkey", F.when(r == 0, "red,blue").when(r == 1, "green").when(r == 2, "red,pink").when(
        r == 3, F.lit(None).cast("string")).otherwise("blue").alias("tags"))


TAG_SETS_SQL = """tag_sets AS (
  SELECT o_orderkey, CASE WHEN o_orderkey % 6 = 0 THEN 'red,blue' WHEN o_orderkey % 6 = 1 THEN 'green'
    WHEN o_orderkey % 6 = 2 THEN 'red,pink' WHEN o_orderkey % 6 = 3 THEN NULL ELSE 'blue' END AS tags
  FROM orders)"""
