"""Plain-Spark forms of the expression and SELECT grammar (F1-F12, R1-R5,
J1-J4, A1, A2, A5, O2-O4): nothing to build, one query proves each mapping."""

from __future__ import annotations

from pyspark.sql import functions as F

from siltlake.operators import relational as R
from siltlake.plans import fixtures as X
from siltlake.plans.registry import register


@register("predicates", f"""
WITH {X.DIRTY_ORDERS_SQL}
SELECT o_orderkey,
  cust_ref >= 1000 AS p_cmp,
  cust_ref <> 7 AS p_ne,
  (status = 'F' AND cust_ref > 500) OR NOT (note LIKE '1-%') AS p_bool,
  note LIKE 'say%' AS p_like,
  note NOT LIKE '%URGENT%' AS p_not_like,
  cust_ref BETWEEN 100 AND 600 AS p_between,
  status IN ('F', 'P') AS p_in,
  note IS NULL AS p_is_null,
  note IS NOT NULL AS p_not_null,
  note IS DISTINCT FROM '1-URGENT' AS p_distinct,
  note IS NOT DISTINCT FROM '1-URGENT' AS p_not_distinct,
  note || '!' AS p_concat
FROM dirty_orders
""")
def q_predicates(spark, sf_dir):
    d = X.dirty_orders(spark, sf_dir)
    c, note, st = F.col("cust_ref"), F.col("note"), F.col("status")
    return d.select(
        "o_orderkey",
        (c >= 1000).alias("p_cmp"),
        (c != 7).alias("p_ne"),
        (((st == "F") & (c > 500)) | ~note.like("1-%")).alias("p_bool"),
        note.like("say%").alias("p_like"),
        (~note.like("%URGENT%")).alias("p_not_like"),
        c.between(100, 600).alias("p_between"),
        st.isin("F", "P").alias("p_in"),
        note.isNull().alias("p_is_null"),
        note.isNotNull().alias("p_not_null"),
        (~note.eqNullSafe("1-URGENT")).alias("p_distinct"),
        note.eqNullSafe("1-URGENT").alias("p_not_distinct"),
        F.concat(note, F.lit("!")).alias("p_concat"),
    )


@register("where_filter", """
SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_orderstatus = 'O' AND o_totalprice > 250000
""")
def q_where_filter(spark, sf_dir):
    o = X.table(spark, sf_dir, "orders")
    return o.where((F.col("o_orderstatus") == "O") & (F.col("o_totalprice") > 250000)).select(
        "o_orderkey", "o_custkey", "o_totalprice")


@register("arithmetic", """
SELECT o_orderkey,
  o_orderkey + o_custkey AS a_add, o_orderkey - o_custkey AS a_sub, o_orderkey * 3 AS a_mul,
  o_orderkey / NULLIF(o_custkey % 3, 0) AS a_div, o_orderkey % NULLIF(o_custkey % 3, 0) AS a_mod,
  CAST(o_totalprice * 2 AS DOUBLE) AS a_dbl
FROM orders
""")
def q_arithmetic(spark, sf_dir):
    o = X.table(spark, sf_dir, "orders")
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    return o.select("o_orderkey", (k + c).alias("a_add"), (k - c).alias("a_sub"), (k * 3).alias("a_mul"),
                    F.try_divide(k, c % 3).alias("a_div"), F.try_mod(k, c % 3).alias("a_mod"),
                    (F.col("o_totalprice") * 2).alias("a_dbl"))


@register("distinct", """
SELECT DISTINCT o_orderstatus, o_orderpriority FROM orders
""")
def q_distinct(spark, sf_dir):
    return X.table(spark, sf_dir, "orders").select("o_orderstatus", "o_orderpriority").distinct()


@register("group_by", """
SELECT o_orderpriority, COUNT(*) AS n_orders, CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DECIMAL(28,2)) AS total,
       MIN(o_totalprice) AS min_price, MAX(o_totalprice) AS max_price, COUNT(DISTINCT o_custkey) AS n_customers
FROM orders GROUP BY o_orderpriority
""")
def q_group_by(spark, sf_dir):
    o = X.table(spark, sf_dir, "orders")
    return o.groupBy("o_orderpriority").agg(
        F.count(F.lit(1)).alias("n_orders"), F.sum(F.col("o_totalprice").cast("decimal(18,2)")).alias("total"),
        F.min("o_totalprice").alias("min_price"), F.max("o_totalprice").alias("max_price"),
        F.count_distinct("o_custkey").alias("n_customers"))


@register("limit_offset", """
SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20 OFFSET 10
""")
def q_limit_offset(spark, sf_dir):
    """A top-k report: the limit is the feature (TOP n = LIMIT n)."""
    o = X.table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return o.orderBy(F.col("o_totalprice").desc(), "o_orderkey").offset(10).limit(20)


@register("values_table", """
SELECT v.label, COUNT(*) AS n_orders
FROM orders o JOIN (VALUES ('F', 'finished'), ('O', 'open'), ('P', 'pending')) AS v(status, label)
  ON o.o_orderstatus = v.status
GROUP BY v.label
""")
def q_values_table(spark, sf_dir):
    o = X.table(spark, sf_dir, "orders")
    return spark.sql(
        "SELECT v.label, COUNT(*) AS n_orders FROM {o} o "
        "JOIN (VALUES ('F', 'finished'), ('O', 'open'), ('P', 'pending')) AS v(status, label) "
        "ON o.o_orderstatus = v.status GROUP BY v.label", o=o)


@register("comma_join", """
SELECT o.o_orderkey, c.c_name FROM orders o, customer c
WHERE o.o_custkey = c.c_custkey AND c.c_mktsegment = 'BUILDING'
""")
def q_comma_join(spark, sf_dir):
    """``FROM a, b WHERE a.x = b.y``: Catalyst turns the filter into an equi-join."""
    return spark.sql("SELECT o.o_orderkey, c.c_name FROM {o} o, {c} c "
                     "WHERE o.o_custkey = c.c_custkey AND c.c_mktsegment = 'BUILDING'",
                     o=X.table(spark, sf_dir, "orders"), c=X.table(spark, sf_dir, "customer"))


@register("semi_in", """
SELECT c_custkey, c_name FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_totalprice > 400000)
""")
def q_semi_in(spark, sf_dir):
    big = X.table(spark, sf_dir, "orders").where(F.col("o_totalprice") > 400000)
    c = X.table(spark, sf_dir, "customer")
    return c.join(big, c["c_custkey"] == big["o_custkey"], "left_semi").select("c_custkey", "c_name")


@register("anti_not_in", """
SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F')
""")
def q_anti_not_in(spark, sf_dir):
    """NOT IN is null-aware (a NULL in the set empties the result); as
    ``<> ALL`` it runs as set statistics + a hash anti join."""
    f = X.table(spark, sf_dir, "orders").where(F.col("o_orderstatus") == "F")
    return R.compare_all(X.table(spark, sf_dir, "customer").select("c_custkey"), "c_custkey", "<>", f, "o_custkey")


@register("not_in_null", """
SELECT c_custkey FROM customer
WHERE c_custkey NOT IN (SELECT CASE WHEN o_orderpriority = '1-URGENT' THEN NULL ELSE o_custkey END FROM orders)
""")
def q_not_in_null(spark, sf_dir):
    o = X.table(spark, sf_dir, "orders")
    v = F.when(F.col("o_orderpriority") == "1-URGENT", F.lit(None)).otherwise(F.col("o_custkey"))
    return R.compare_all(X.table(spark, sf_dir, "customer").select("c_custkey"), "c_custkey", "<>", o, v)


@register("exists", """
SELECT o_orderkey FROM orders o
WHERE EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey AND l.l_returnflag = 'R')
  AND NOT EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey AND l.l_quantity > 49)
""")
def q_exists(spark, sf_dir):
    o = X.table(spark, sf_dir, "orders").select("o_orderkey")
    li = X.table(spark, sf_dir, "lineitem")
    r = li.where(F.col("l_returnflag") == "R").select("l_orderkey")
    q = li.where(F.col("l_quantity") > 49).select("l_orderkey")
    return o.join(r, o["o_orderkey"] == r["l_orderkey"], "left_semi").join(
        q, o["o_orderkey"] == q["l_orderkey"], "left_anti")


@register("exists_flag", """
SELECT EXISTS (SELECT 1 FROM orders WHERE o_orderstatus = 'P') AS has_pending,
       EXISTS (SELECT 1 FROM orders WHERE o_totalprice < 0) AS has_negative
""")
def q_exists_flag(spark, sf_dir):
    """Scalar EXISTS -> boolean (A5): a bounded aggregate, no rows collected."""
    o = X.table(spark, sf_dir, "orders")
    return o.agg(F.max((F.col("o_orderstatus") == "P").cast("int")).alias("_p"),
                 F.max((F.col("o_totalprice") < 0).cast("int")).alias("_n")).select(
        F.coalesce(F.col("_p") == 1, F.lit(False)).alias("has_pending"),
        F.coalesce(F.col("_n") == 1, F.lit(False)).alias("has_negative"))


@register("scalar_subquery", """
SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice > (SELECT AVG(o_totalprice) * 1.5 FROM orders)
""")
def q_scalar_subquery(spark, sf_dir):
    o = X.table(spark, sf_dir, "orders")
    avg = o.select(F.avg("o_totalprice") * 1.5).scalar()
    return o.where(F.col("o_totalprice") > avg).select("o_orderkey", "o_totalprice")


@register("derived_table", """
SELECT o_custkey, n FROM (SELECT o_custkey, COUNT(*) AS n FROM orders GROUP BY o_custkey) AS t WHERE n > 15
""")
def q_derived_table(spark, sf_dir):
    t = X.table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"))
    return t.where(F.col("n") > 15)
