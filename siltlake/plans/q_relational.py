"""ALL / ANY comparisons (J5) and referential actions."""

from __future__ import annotations

from pyspark.sql import functions as F

from siltlake.operators import relational as R
from siltlake.plans import fixtures as X
from siltlake.plans.registry import register


@register("gt_all", """
SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice > ALL (SELECT s_acctbal * 30 FROM supplier)
""")
def q_gt_all(spark, sf_dir):
    o = X.table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    s = X.table(spark, sf_dir, "supplier")
    return R.compare_all(o, "o_totalprice", ">", s, F.col("s_acctbal") * 30)


@register("ge_all", """
SELECT c_custkey, c_acctbal FROM customer WHERE c_acctbal >= ALL (SELECT s_acctbal FROM supplier)
""")
def q_ge_all(spark, sf_dir):
    c = X.table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal")
    return R.compare_all(c, "c_acctbal", ">=", X.table(spark, sf_dir, "supplier"), "s_acctbal")


@register("lt_all_null", """
SELECT o_orderkey FROM orders
WHERE o_totalprice < ALL (SELECT CASE WHEN s_suppkey % 7 = 0 THEN NULL ELSE s_acctbal END FROM supplier)
""")
def q_lt_all_null(spark, sf_dir):
    s = X.table(spark, sf_dir, "supplier")
    v = F.when(F.col("s_suppkey") % 7 == 0, F.lit(None)).otherwise(F.col("s_acctbal"))
    return R.compare_all(X.table(spark, sf_dir, "orders"), "o_totalprice", "<", s, v).select("o_orderkey")


@register("eq_all", """
SELECT p_partkey, p_size FROM part WHERE p_size = ALL (SELECT p_size FROM part WHERE p_retailprice >= 999.9)
""")
def q_eq_all(spark, sf_dir):
    p = X.table(spark, sf_dir, "part")
    return R.compare_all(p.select("p_partkey", "p_size"), "p_size", "=",
                         p.where(F.col("p_retailprice") >= 999.9), "p_size")


@register("ne_all", """
SELECT c_custkey FROM customer WHERE c_custkey <> ALL (SELECT o_custkey FROM orders)
""")
def q_ne_all(spark, sf_dir):
    c = X.table(spark, sf_dir, "customer").select("c_custkey")
    return R.compare_all(c, "c_custkey", "<>", X.table(spark, sf_dir, "orders"), "o_custkey")


@register("lt_any", """
SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice < ANY (SELECT c_acctbal * 10 FROM customer)
""")
def q_lt_any(spark, sf_dir):
    o = X.table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return R.compare_any(o, "o_totalprice", "<", X.table(spark, sf_dir, "customer"), F.col("c_acctbal") * 10)


@register("gt_any", """
SELECT o_orderkey FROM orders WHERE o_totalprice > ANY (SELECT s_acctbal * 60 FROM supplier)
""")
def q_gt_any(spark, sf_dir):
    o = X.table(spark, sf_dir, "orders")
    return R.compare_any(o, "o_totalprice", ">", X.table(spark, sf_dir, "supplier"),
                         F.col("s_acctbal") * 60).select("o_orderkey")


@register("ne_any", """
SELECT c_custkey FROM customer WHERE c_nationkey <> ANY (SELECT s_nationkey FROM supplier WHERE s_acctbal > 9000)
""")
def q_ne_any(spark, sf_dir):
    c = X.table(spark, sf_dir, "customer")
    s = X.table(spark, sf_dir, "supplier").where(F.col("s_acctbal") > 9000)
    return R.compare_any(c, "c_nationkey", "<>", s, "s_nationkey").select("c_custkey")


@register("eq_any", """
SELECT c_custkey FROM customer WHERE c_custkey = ANY (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F')
""")
def q_eq_any(spark, sf_dir):
    o = X.table(spark, sf_dir, "orders").where(F.col("o_orderstatus") == "F")
    return R.compare_any(X.table(spark, sf_dir, "customer").select("c_custkey"), "c_custkey", "=", o, "o_custkey")


# --------------------------------------------------------------------------
# Orders with status F are deleted; lineitem references orders
# --------------------------------------------------------------------------

def _deleted(spark, sf_dir):
    return X.table(spark, sf_dir, "orders").where(F.col("o_orderstatus") == "F").select("o_orderkey")


def _lines(spark, sf_dir):
    return X.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")


@register("cascade_delete", """
SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem l
WHERE NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_orderstatus = 'F' AND o.o_orderkey = l.l_orderkey)
""")
def q_cascade_delete(spark, sf_dir):
    out, _ = R.apply_parent_changes(_lines(spark, sf_dir), ["l_orderkey"], deleted=_deleted(spark, sf_dir),
                                    on_delete="CASCADE")
    return out


@register("set_null_delete", """
SELECT CASE WHEN EXISTS (SELECT 1 FROM orders o WHERE o.o_orderstatus = 'F' AND o.o_orderkey = l.l_orderkey)
            THEN NULL ELSE l_orderkey END AS l_orderkey, l_linenumber, l_partkey
FROM lineitem l
""")
def q_set_null_delete(spark, sf_dir):
    out, _ = R.apply_parent_changes(_lines(spark, sf_dir), ["l_orderkey"], deleted=_deleted(spark, sf_dir),
                                    on_delete="SET NULL")
    return out


@register("set_default_delete", """
SELECT CASE WHEN EXISTS (SELECT 1 FROM orders o WHERE o.o_orderstatus = 'F' AND o.o_orderkey = l.l_orderkey)
            THEN CAST(-1 AS BIGINT) ELSE l_orderkey END AS l_orderkey, l_linenumber, l_partkey
FROM lineitem l
""")
def q_set_default_delete(spark, sf_dir):
    out, _ = R.apply_parent_changes(_lines(spark, sf_dir), ["l_orderkey"], deleted=_deleted(spark, sf_dir),
                                    on_delete="SET DEFAULT", defaults={"l_orderkey": -1})
    return out


@register("restrict_delete", """
SELECT o_orderkey FROM orders o WHERE o_orderstatus = 'F'
  AND EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey)
""")
def q_restrict_delete(spark, sf_dir):
    _, rejected = R.apply_parent_changes(_lines(spark, sf_dir), ["l_orderkey"], deleted=_deleted(spark, sf_dir),
                                         on_delete="RESTRICT")
    return rejected.withColumnRenamed("_d0", "o_orderkey")


@register("cascade_update", """
SELECT COALESCE(r.new_key, l.l_orderkey) AS l_orderkey, l.l_linenumber, l.l_partkey
FROM lineitem l LEFT JOIN (SELECT o_orderkey AS old_key, o_orderkey + 1000000 AS new_key FROM orders
                           WHERE o_orderstatus = 'P') r ON l.l_orderkey = r.old_key
""")
def q_cascade_update(spark, sf_dir):
    o = X.table(spark, sf_dir, "orders").where(F.col("o_orderstatus") == "P")
    rekey = o.select("o_orderkey", (F.col("o_orderkey") + 1000000).alias("new_key"))
    out, _ = R.apply_parent_changes(_lines(spark, sf_dir), ["l_orderkey"], rekeyed=rekey, on_update="CASCADE")
    return out


@register("cascade_self", """
WITH RECURSIVE t AS (
  SELECT o_orderkey AS k, CASE WHEN o_orderkey >= 4 THEN o_orderkey // 4 END AS parent, o_orderpriority FROM orders),
del(k) AS (SELECT k FROM t WHERE o_orderpriority = '1-URGENT'
           UNION SELECT t.k FROM t JOIN del ON t.parent = del.k)
SELECT k, parent FROM t WHERE NOT EXISTS (SELECT 1 FROM del WHERE del.k = t.k)
""")
def q_cascade_self(spark, sf_dir):
    o = X.table(spark, sf_dir, "orders")
    t = o.select(F.col("o_orderkey").alias("k"),
                 F.when(F.col("o_orderkey") >= 4, F.floor(F.col("o_orderkey") / 4)).cast("bigint").alias("parent"),
                 "o_orderpriority")
    deleted = t.where(F.col("o_orderpriority") == "1-URGENT").select("k")
    out, _ = R.apply_parent_changes(t.select("k", "parent"), ["parent"], deleted=deleted, on_delete="CASCADE",
                                    self_parent=["k"])
    return out


# --------------------------------------------------------------------------
# more actions, and comparisons that some rows pass
# --------------------------------------------------------------------------

def _rekeyed(spark, sf_dir):
    o = X.table(spark, sf_dir, "orders").where(F.col("o_orderstatus") == "P")
    return o.select("o_orderkey", (F.col("o_orderkey") + 1000000).alias("new_key"))


@register("set_null_update", """
SELECT CASE WHEN EXISTS (SELECT 1 FROM orders o WHERE o.o_orderstatus = 'P' AND o.o_orderkey = l.l_orderkey)
            THEN NULL ELSE l_orderkey END AS l_orderkey, l_linenumber, l_partkey
FROM lineitem l
""")
def q_set_null_update(spark, sf_dir):
    out, _ = R.apply_parent_changes(_lines(spark, sf_dir), ["l_orderkey"], rekeyed=_rekeyed(spark, sf_dir), on_update="SET NULL")
    return out


@register("no_action_update", """
SELECT o_orderkey AS old_key, o_orderkey + 1000000 AS new_key FROM orders o WHERE o_orderstatus = 'P'
  AND EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey)
""")
def q_no_action_update(spark, sf_dir):
    _, rejected = R.apply_parent_changes(_lines(spark, sf_dir), ["l_orderkey"], rekeyed=_rekeyed(spark, sf_dir), on_update="NO ACTION")
    return rejected.select(F.col("_o0").alias("old_key"), F.col("_n0").alias("new_key"))


@register("lt_all_rows", """
SELECT o_orderkey FROM orders WHERE o_totalprice < ALL (SELECT s_acctbal * 3 + 60000 FROM supplier WHERE s_acctbal > 0)
""")
def q_lt_all_rows(spark, sf_dir):
    s = X.table(spark, sf_dir, "supplier").where(F.col("s_acctbal") > 0)
    return R.compare_all(X.table(spark, sf_dir, "orders"), "o_totalprice", "<", s, F.col("s_acctbal") * 3 + 60000).select("o_orderkey")


@register("eq_all_rows", """
SELECT p_partkey, p_size FROM part WHERE p_size = ALL (SELECT MAX(p_size) FROM part)
""")
def q_eq_all_rows(spark, sf_dir):
    p = X.table(spark, sf_dir, "part")
    return R.compare_all(p.select("p_partkey", "p_size"), "p_size", "=", p.agg(F.max("p_size").alias("m")), "m")


@register("ne_all_rows", """
SELECT c_custkey FROM customer WHERE c_custkey <> ALL (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT' AND o_orderstatus = 'F')
""")
def q_ne_all_rows(spark, sf_dir):
    o = X.table(spark, sf_dir, "orders").where((F.col("o_orderpriority") == "1-URGENT") & (F.col("o_orderstatus") == "F"))
    return R.compare_all(X.table(spark, sf_dir, "customer").select("c_custkey"), "c_custkey", "<>", o, "o_custkey")
