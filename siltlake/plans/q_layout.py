"""Partition labels (L1-L6), partitioned and clustered writes (L7, O5) on orders."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from siltlake import spec as S
from siltlake.operators import layout as L
from siltlake.plans import fixtures as X
from siltlake.plans.registry import register
from siltlake.session import checkpoint_dir


def _orders(spark, sf_dir):
    return X.table(spark, sf_dir, "orders")


@register("part_hash", """
SELECT o_orderkey, CAST(((o_orderkey % 6) + 6) % 6 AS INTEGER) AS _part FROM orders
""")
def q_part_hash(spark, sf_dir):
    return L.partition_hash(_orders(spark, sf_dir).select("o_orderkey"), "o_orderkey", 6)


@register("part_linear_hash", """
SELECT o_orderkey, CAST(CASE WHEN (o_orderkey & 7) >= 6 THEN o_orderkey & 3 ELSE o_orderkey & 7 END AS INTEGER) AS _part
FROM orders
""")
def q_part_linear_hash(spark, sf_dir):
    return L.partition_hash(_orders(spark, sf_dir).select("o_orderkey"), "o_orderkey", 6, linear=True)


_KEY_HASH_SQL = "CAST('0x' || substr(md5(concat_ws('|', CAST(o_custkey AS VARCHAR), o_orderstatus)), 1, 8) AS BIGINT)"


@register("part_key", f"""
SELECT o_orderkey, CAST({_KEY_HASH_SQL} % 8 AS INTEGER) AS _part FROM orders
""")
def q_part_key(spark, sf_dir):
    o = _orders(spark, sf_dir).select("o_orderkey", "o_custkey", "o_orderstatus")
    return L.partition_key(o, ["o_custkey", "o_orderstatus"], 8).select("o_orderkey", "_part")


@register("part_linear_key", f"""
SELECT o_orderkey, CAST(CASE WHEN ({_KEY_HASH_SQL} & 7) >= 5 THEN {_KEY_HASH_SQL} & 3
                             ELSE {_KEY_HASH_SQL} & 7 END AS INTEGER) AS _part FROM orders
""")
def q_part_linear_key(spark, sf_dir):
    o = _orders(spark, sf_dir).select("o_orderkey", "o_custkey", "o_orderstatus")
    return L.partition_key(o, ["o_custkey", "o_orderstatus"], 5, linear=True).select("o_orderkey", "_part")


_RANGE_SQL = """CASE WHEN o_totalprice IS NULL THEN NULL WHEN o_totalprice < 100000 THEN 'p0'
  WHEN o_totalprice < 200000 THEN 'p1' WHEN o_totalprice < 400000 THEN 'p2' END"""


@register("part_range", f"""
SELECT o_orderkey, {_RANGE_SQL} AS _part FROM orders
""")
def q_part_range(spark, sf_dir):
    return L.partition_range(_orders(spark, sf_dir).select("o_orderkey", "o_totalprice"), "o_totalprice",
                             [100000, 200000, 400000]).select("o_orderkey", "_part")


@register("part_range_columns", """
SELECT o_orderkey,
  CASE WHEN o_orderstatus IS NULL OR o_totalprice IS NULL THEN NULL
       WHEN o_orderstatus < 'F' OR (o_orderstatus = 'F' AND o_totalprice < 200000) THEN 'low'
       WHEN o_orderstatus <= 'O' THEN 'mid'
       ELSE 'high' END AS _part
FROM orders
""")
def q_part_range_columns(spark, sf_dir):
    spec = S.PartitionSpec("range", columns=("o_orderstatus", "o_totalprice"),
                           bounds=(("F", 200000), ("O", None), (None, None)), names=("low", "mid", "high"))
    o = _orders(spark, sf_dir).select("o_orderkey", "o_orderstatus", "o_totalprice")
    return L.apply_partitioning(o, spec).select("o_orderkey", "_part")


@register("part_list", """
SELECT o_orderkey, CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'hot'
  WHEN o_orderpriority IN ('3-MEDIUM') THEN 'warm'
  WHEN o_orderpriority IN ('4-NOT SPECIFIED', '5-LOW') THEN 'cold' END AS _part
FROM orders
""")
def q_part_list(spark, sf_dir):
    spec = S.PartitionSpec("list", expr="o_orderpriority",
                           lists=(("1-URGENT", "2-HIGH"), ("3-MEDIUM",), ("4-NOT SPECIFIED", "5-LOW")),
                           names=("hot", "warm", "cold"))
    return L.apply_partitioning(_orders(spark, sf_dir).select("o_orderkey", "o_orderpriority"), spec).select(
        "o_orderkey", "_part")


@register("part_list_join", """
SELECT o_orderkey, CASE WHEN o_custkey >= 0 AND o_custkey < 400 THEN 'p0'
  WHEN o_custkey >= 400 AND o_custkey < 800 THEN 'p1' WHEN o_custkey >= 800 AND o_custkey < 1200 THEN 'p2'
  WHEN o_custkey >= 1200 AND o_custkey < 1600 THEN 'p3' END AS _part
FROM orders
""")
def q_part_list_join(spark, sf_dir):
    # 1,600 declared members: routed by a join with the member table, not a CASE
    lists = [tuple(range(i * 400, (i + 1) * 400)) for i in range(4)]
    o = _orders(spark, sf_dir).select("o_orderkey", "o_custkey")
    return L.partition_list(o, ["o_custkey"], lists).select("o_orderkey", "_part")


@register("subpartition", f"""
SELECT o_orderkey, {_RANGE_SQL} AS _part, CAST(((o_custkey % 4) + 4) % 4 AS INTEGER) AS _subpart FROM orders
""")
def q_subpartition(spark, sf_dir):
    spec = S.PartitionSpec("range", expr="o_totalprice", bounds=(100000, 200000, 400000),
                           sub=S.PartitionSpec("hash", expr="o_custkey", count=4))
    o = _orders(spark, sf_dir).select("o_orderkey", "o_totalprice", "o_custkey")
    return L.apply_partitioning(o, spec).select("o_orderkey", "_part", "_subpart")


def _scratch(spark, name):
    return f"{checkpoint_dir(spark).rstrip('/')}/siltlake-{name}-{uuid.uuid4().hex[:10]}"


@register("partitioned_write", f"""
SELECT o_orderkey, o_totalprice FROM orders WHERE {_RANGE_SQL} = 'p1'
""")
def q_partitioned_write(spark, sf_dir):
    """Write labelled, quarantine unrouted rows, read one label back (pruned)."""
    base = _scratch(spark, "layout")
    o = L.partition_range(_orders(spark, sf_dir).select("o_orderkey", "o_totalprice"), "o_totalprice",
                          [100000, 200000, 400000])
    L.write_partitioned(o, f"{base}/data", [L.LABEL], unrouted_path=f"{base}/unrouted")
    back = spark.read.parquet(f"{base}/data")
    return back.where(F.col(L.LABEL) == "p1").select("o_orderkey", "o_totalprice")


@register("clustered_write", """
SELECT o_orderkey, o_orderdate, o_custkey FROM orders
""")
def q_clustered_write(spark, sf_dir):
    base = _scratch(spark, "cluster")
    o = _orders(spark, sf_dir).select("o_orderkey", "o_orderdate", "o_custkey")
    L.write_clustered(o, base, [S.KeyPart("o_orderdate", descending=True), S.KeyPart("o_custkey")])
    return spark.read.parquet(base)


@register("part_key_null", f"""
SELECT o_orderkey, CASE WHEN o_orderkey % 9 = 0 THEN NULL ELSE CAST({_KEY_HASH_SQL} % 8 AS INTEGER) END AS _part FROM orders
""")
def q_part_key_null(spark, sf_dir):
    """A row with a NULL key part has no partition."""
    o = _orders(spark, sf_dir).withColumn("o_custkey", F.when(F.col("o_orderkey") % 9 != 0, F.col("o_custkey")))
    return L.partition_key(o, ["o_custkey", "o_orderstatus"], 8).select("o_orderkey", "_part")


@register("part_range_many", """
SELECT o_orderkey, CASE WHEN o_totalprice < 700 * 600 THEN 'p' || CAST(CAST(FLOOR(GREATEST(o_totalprice, 0) / 700) AS INTEGER) AS VARCHAR) END AS _part
FROM orders
""")
def q_part_range_many(spark, sf_dir):
    """600 bounds: found by halving, not one by one."""
    o = _orders(spark, sf_dir).select("o_orderkey", "o_totalprice")
    return L.partition_range(o, "o_totalprice", [700 * (i + 1) for i in range(600)]).select("o_orderkey", "_part")
