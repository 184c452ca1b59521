"""Normalisation queries (P1-P14, X3, A4, S9) over dirty_orders and customer."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from siltlake import spec as S
from siltlake.functions.columns import csv_line
from siltlake.operators import normalize as N
from siltlake.operators.profile import profile
from siltlake.plans import fixtures as X
from siltlake.plans.registry import register
from siltlake.sources.sinks import union_members

DIRTY_SPEC = S.TableSpec(
    name="dirty_orders",
    columns=(
        S.ColumnSpec("o_orderkey", "bigint", nullable=False),
        S.ColumnSpec("cust_ref", "bigint"),
        S.ColumnSpec("order_date", "datetime"),
        S.ColumnSpec("total_price", "decimal", precision=12, scale=2),
        S.ColumnSpec("small_code", "tinyint"),
        S.ColumnSpec("status", "enum", members=("F", "O")),
        S.ColumnSpec("note", "varchar", length=15, nullable=False),
    ),
    primary_key=(S.KeyPart("o_orderkey"),),
)

CUSTOMER_BIN_SPEC = S.TableSpec(
    name="customer_bin",
    columns=(
        S.ColumnSpec("c_custkey", "bigint"),
        S.ColumnSpec("name_bin", "varbinary", length=64),
        S.ColumnSpec("key_bits", "bit", length=64),
        S.ColumnSpec("c_acctbal", "double"),
    ),
)


def customer_bin(spark, sf_dir):
    c = X.table(spark, sf_dir, "customer")
    return c.select("c_custkey", F.encode("c_name", "UTF-8").alias("name_bin"),
                    F.unhex(F.lpad(F.hex("c_custkey"), 16, "0")).alias("key_bits"), "c_acctbal")


@register("normalize_hex", """
SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, hex(encode(c_name)) AS name_bin,
       CAST(c_custkey AS DECIMAL(20,0)) AS key_bits, CAST(c_acctbal AS VARCHAR) AS c_acctbal
FROM customer
""")
def q_normalize_hex(spark, sf_dir):
    return N.normalize(customer_bin(spark, sf_dir), CUSTOMER_BIN_SPEC)


@register("zero_dates", f"""
WITH {X.DIRTY_ORDERS_SQL}
SELECT o_orderkey, TRY_CAST(NULLIF(order_date, '0000-00-00 00:00:00') AS TIMESTAMP) AS order_date FROM dirty_orders
""")
def q_zero_dates(spark, sf_dir):
    n = N.normalize(X.dirty_orders(spark, sf_dir), DIRTY_SPEC)
    return n.select(F.col("o_orderkey").cast("bigint").alias("o_orderkey"), "order_date")


@register("loosen_rescued", f"""
WITH {X.DIRTY_ORDERS_SQL}
SELECT o_orderkey, cust_ref,
  TRY_CAST(NULLIF(order_date, '0000-00-00 00:00:00') AS TIMESTAMP) AS order_date,
  TRY_CAST(total_price AS DECIMAL(12,2)) AS total_price,
  TRY_CAST(small_code AS TINYINT) AS small_code, status, note,
  CONCAT_WS(',',
    CASE WHEN small_code IS NOT NULL AND TRY_CAST(small_code AS TINYINT) IS NULL THEN 'small_code' END,
    CASE WHEN total_price IS NOT NULL AND TRY_CAST(total_price AS DECIMAL(12,2)) IS NULL THEN 'total_price' END
  ) AS rescued_cols,
  CASE WHEN total_price IS NOT NULL AND TRY_CAST(total_price AS DECIMAL(12,2)) IS NULL THEN total_price END
    AS rescued_price
FROM dirty_orders
""")
def q_loosen_rescued(spark, sf_dir):
    t = N.loosen(X.dirty_orders(spark, sf_dir), DIRTY_SPEC)
    return t.select("o_orderkey", "cust_ref", "order_date", "total_price", "small_code", "status", "note",
                    F.array_join(F.array_sort(F.map_keys("_rescued")), ",").alias("rescued_cols"),
                    F.col("_rescued")["total_price"].alias("rescued_price"))


def _csv_sql(cols: list[str]) -> str:
    f = "COALESCE('\"' || REPLACE(CAST({c} AS VARCHAR), '\"', '\"\"') || '\"', 'NULL')"
    return "CONCAT_WS(',', " + ", ".join(f.format(c=c) for c in cols) + ")"


@register("csv_lines", f"""
WITH {X.DIRTY_ORDERS_SQL},
n AS (SELECT o_orderkey, cust_ref, TRY_CAST(NULLIF(order_date, '0000-00-00 00:00:00') AS TIMESTAMP) AS order_date,
        total_price, small_code, status, note FROM dirty_orders)
SELECT o_orderkey, {_csv_sql(['o_orderkey', 'cust_ref', 'order_date', 'total_price', 'small_code', 'status', 'note'])} AS line
FROM n
""")
def q_csv_lines(spark, sf_dir):
    n = N.normalize(X.dirty_orders(spark, sf_dir), DIRTY_SPEC)
    return n.select(F.col("o_orderkey").cast("bigint").alias("o_orderkey"), csv_line(*n.columns).alias("line"))


ZEROFILL_SPEC = S.TableSpec("customer", (S.ColumnSpec("c_custkey", "int", unsigned=True, zerofill=True, length=6),))


@register("zerofill", """
SELECT c_custkey, CASE WHEN length(CAST(c_custkey AS VARCHAR)) < 6 THEN lpad(CAST(c_custkey AS VARCHAR), 6, '0')
                       ELSE CAST(c_custkey AS VARCHAR) END AS c_custkey_display
FROM customer
""")
def q_zerofill(spark, sf_dir):
    c = X.table(spark, sf_dir, "customer").select("c_custkey")
    return N.apply_zerofill(c, ZEROFILL_SPEC)


CUSTOMER_V2 = S.TableSpec(
    name="customer_v2",
    columns=(
        S.ColumnSpec("c_custkey", "bigint"),
        S.ColumnSpec("c_name", "varchar", length=25),
        S.ColumnSpec("c_phone", "varchar", length=15, default="n/a"),
        S.ColumnSpec("c_rating", "int", default=3),
        S.ColumnSpec("c_comment", "text"),
        S.ColumnSpec("c_tags", "set", members=("new", "retail", "vip"), default="new,retail"),
        S.ColumnSpec("c_acctbal", "double"),
    ),
)


@register("fill_defaults", """
SELECT c_custkey, c_name, 'n/a' AS c_phone, 3 AS c_rating, CAST(NULL AS VARCHAR) AS c_comment,
       'new,retail' AS c_tags, c_acctbal, c_mktsegment
FROM customer
""")
def q_fill_defaults(spark, sf_dir):
    c = X.table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal", "c_mktsegment")
    out = N.fill_defaults(c, CUSTOMER_V2)
    return out.withColumn("c_tags", F.array_join("c_tags", ","))


ORDERS_GEN = S.TableSpec(
    name="orders",
    columns=(
        S.ColumnSpec("o_orderkey", "bigint"),
        S.ColumnSpec("o_custkey", "bigint"),
        S.ColumnSpec("o_orderstatus", "char", length=1),
        S.ColumnSpec("o_totalprice", "double"),
        S.ColumnSpec("o_orderdate", "datetime"),
        S.ColumnSpec("o_orderpriority", "varchar", length=15, visible=False),
        S.ColumnSpec("o_tax", "double", generated="o_totalprice * 0.08", stored=True),
        S.ColumnSpec("o_year", "int", generated="year(o_orderdate)", stored=False),
    ),
)


@register("generated_columns", """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate,
       CAST(o_totalprice * 0.08 AS DOUBLE) AS o_tax, CAST(year(o_orderdate) AS INTEGER) AS o_year
FROM orders
""")
def q_generated_columns(spark, sf_dir):
    o = X.table(spark, sf_dir, "orders")
    return N.visible_columns(N.add_generated(o, ORDERS_GEN, include_virtual=True), ORDERS_GEN)


@register("assign_ids", """
SELECT o_orderkey, o_orderdate, CAST(ROW_NUMBER() OVER (ORDER BY o_orderdate, o_orderkey) + 999 AS BIGINT) AS id
FROM orders
""")
def q_assign_ids(spark, sf_dir):
    o = X.table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    return N.assign_ids(o, ["o_orderdate"], start=1000, tiebreak=["o_orderkey"])


@register("add_columns", """
SELECT CAST(0 AS INTEGER) AS c_flag, c_custkey, c_name, 'n/a' AS c_phone, c_nationkey, c_acctbal, c_mktsegment
FROM customer
""")
def q_add_columns(spark, sf_dir):
    c = X.table(spark, sf_dir, "customer")
    c = N.add_columns(c, [S.ColumnSpec("c_phone", "varchar", default="n/a")], after="c_name")
    return N.add_columns(c, [S.ColumnSpec("c_flag", "int", default=0)], first=True)


@register("with_collation", f"""
WITH {X.DIRTY_ORDERS_SQL}
SELECT o_orderkey, status FROM dirty_orders WHERE lower(status) = 'f'
""")
def q_with_collation(spark, sf_dir):
    spec = S.TableSpec("dirty_orders", (S.ColumnSpec("status", "char", collation="UTF8_LCASE"),))
    d = N.with_collation(X.dirty_orders(spark, sf_dir).select("o_orderkey", "status"), spec)
    return d.where(F.col("status") == F.lit("f")).select("o_orderkey", F.col("status").cast("string").alias("status"))


_PROFILE_COLS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]


def _profile_sql(cols: list[str]) -> str:
    parts = [f"""SELECT '{c}' AS column_name, COUNT(*) AS n_rows, CAST(SUM(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS n_null,
  COUNT(DISTINCT {c}) AS n_distinct, CAST(MIN({c}) AS VARCHAR) AS min_value, CAST(MAX({c}) AS VARCHAR) AS max_value,
  CAST(MAX(length(CAST({c} AS VARCHAR))) AS BIGINT) AS max_length FROM orders""" for c in cols]
    return "\nUNION ALL\n".join(parts)


@register("profile", _profile_sql(_PROFILE_COLS))
def q_profile(spark, sf_dir):
    return profile(X.table(spark, sf_dir, "orders"), _PROFILE_COLS, exact=True)


@register("profile_approx", f"""
SELECT column_name, n_rows, n_null, min_value, max_value, max_length, TRUE AS distinct_within_tenth
FROM ({_profile_sql(_PROFILE_COLS)}) p
""")
def q_profile_approx(spark, sf_dir):
    """The one-pass form; its distinct counts are held against the exact ones."""
    o = X.table(spark, sf_dir, "orders")
    exact = profile(o, _PROFILE_COLS, exact=True).select("column_name", F.col("n_distinct").alias("_exact"))
    near = F.abs(F.col("n_distinct") - F.col("_exact")) <= F.col("_exact") * 0.1
    return profile(o, _PROFILE_COLS).join(exact, "column_name").select(
        "column_name", "n_rows", "n_null", "min_value", "max_value", "max_length", near.alias("distinct_within_tenth"))


@register("union_members", """
SELECT 'customer' AS member, c_custkey AS id, c_name AS name, c_nationkey AS nationkey, c_acctbal AS acctbal,
       c_mktsegment AS segment FROM customer
UNION ALL
SELECT 'supplier', s_suppkey, s_name, s_nationkey, s_acctbal, NULL FROM supplier
""")
def q_union_members(spark, sf_dir):
    c = X.table(spark, sf_dir, "customer").select(
        F.lit("customer").alias("member"), F.col("c_custkey").alias("id"), F.col("c_name").alias("name"),
        F.col("c_nationkey").alias("nationkey"), F.col("c_acctbal").alias("acctbal"),
        F.col("c_mktsegment").alias("segment"))
    s = X.table(spark, sf_dir, "supplier").select(
        F.lit("supplier").alias("member"), F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"),
        F.col("s_nationkey").alias("nationkey"), F.col("s_acctbal").alias("acctbal"))
    return union_members([c, s])


# --------------------------------------------------------------------------
# P4 spatial: WKB built from customer columns with Spark built-ins
# --------------------------------------------------------------------------

def _double_hex(x: Column) -> Column:
    """IEEE-754 big-endian hex of a non-negative integer value (exact below 2^52)."""
    x = x.cast("bigint")
    e = (F.length(F.bin(x)) - 1).cast("int")
    shl = lambda a, b: F.call_function("shiftleft", a, b)
    bits = shl((F.lit(1023) + e).cast("bigint"), F.lit(52)).bitwiseOR(
        shl(x - shl(F.lit(1).cast("bigint"), e), F.lit(52) - e))
    return F.when(x == 0, F.lit("0000000000000000")).otherwise(F.lpad(F.hex(bits), 16, "0"))


def customer_points(spark, sf_dir):
    c = X.table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    wkb_hex = F.concat(F.lit("0000000001"), _double_hex(k), _double_hex(F.col("c_nationkey")))
    h = F.when(k % 10 == 7, F.substring(wkb_hex, 1, 20)).when(
        k % 2 == 0, F.concat(F.lit("E6100000"), wkb_hex)).otherwise(wkb_hex)
    return c.select("c_custkey", "c_nationkey", F.unhex(h).alias("geom"))


@register("wkt", """
SELECT c_custkey, CASE WHEN c_custkey % 10 = 7 THEN NULL
       ELSE 'POINT(' || CAST(c_custkey AS VARCHAR) || ' ' || CAST(c_nationkey AS VARCHAR) || ')' END AS geom
FROM customer
""")
def q_wkt(spark, sf_dir):
    spec = S.TableSpec("points", (S.ColumnSpec("c_custkey", "bigint"), S.ColumnSpec("geom", "point")))
    n = N.normalize(customer_points(spark, sf_dir), spec)
    return n.select(F.col("c_custkey").cast("bigint").alias("c_custkey"), "geom")


def order_shapes(spark, sf_dir):
    """A geometry per order, of each kind in turn, from the numbers a, b (key
    and customer) and c (line count of the year): half in either byte order,
    a quarter behind an SRID."""
    o = X.table(spark, sf_dir, "orders").select(
        "o_orderkey", F.col("o_orderkey").alias("a"), F.col("o_custkey").alias("b"), F.dayofyear("o_orderdate").alias("c"))
    little = F.col("b") % 2 == 0

    def swapped(h: Column, size: int) -> Column:
        return F.concat(*[F.substring(h, 2 * i + 1, 2) for i in reversed(range(size))])

    def u32(n: int) -> Column:
        return F.when(little, F.lit(n.to_bytes(4, "little").hex())).otherwise(F.lit(n.to_bytes(4, "big").hex()))

    def head(code: int) -> Column:
        return F.concat(F.when(little, F.lit("01")).otherwise(F.lit("00")), u32(code))

    for c in "abc":  # columns of their own: each is used many times
        o = o.withColumn(f"_{c}", _double_hex(F.col(c)))
    o = o.select("*", *[F.when(little, swapped(F.col(f"_{c}"), 8)).otherwise(F.col(f"_{c}")).alias(f"_n{c}") for c in "abc"])
    num = {c: F.col(f"_n{c}") for c in "abc"}

    def points(*names: str) -> Column:
        return F.concat(u32(len(names)), *[num[x] for p in names for x in p])

    o = o.select("*", points("ab", "bc", "ca", "ab").alias("_ring"), F.concat(head(2), points("ab", "ca")).alias("_line"))
    ring, line = F.col("_ring"), F.col("_line")
    o = o.withColumn("_polygon", F.concat(head(3), u32(2), ring, points("aa", "bb", "aa")))
    polygon, point = F.col("_polygon"), [F.concat(head(1), *[num[x] for x in p]) for p in ("ab", "cc")]
    kinds = [point[0], line, polygon, F.concat(head(4), u32(2), *point), F.concat(head(5), u32(2), line, F.concat(head(2), points("bb", "cc", "ab"))),
             F.concat(head(6), u32(2), polygon, F.concat(head(3), u32(1), ring))]
    h = F.element_at(F.array(*kinds), (F.col("o_orderkey") % 6 + 1).cast("int"))
    return o.select("o_orderkey", F.unhex(F.when(F.col("c") % 4 == 0, F.concat(F.lit("E6100000"), h)).otherwise(h)).alias("geom"))


@register("wkt_kinds", """
WITH o AS (SELECT o_orderkey, CAST(o_orderkey AS VARCHAR) AS a, CAST(o_custkey AS VARCHAR) AS b, CAST(dayofyear(o_orderdate) AS VARCHAR) AS c FROM orders),
t AS (SELECT *, '(' || a || ' ' || b || ',' || b || ' ' || c || ',' || c || ' ' || a || ',' || a || ' ' || b || ')' AS ring,
             '(' || a || ' ' || a || ',' || b || ' ' || b || ',' || a || ' ' || a || ')' AS hole, '(' || a || ' ' || b || ',' || c || ' ' || a || ')' AS line FROM o)
SELECT o_orderkey, CASE o_orderkey % 6
  WHEN 0 THEN 'POINT(' || a || ' ' || b || ')'
  WHEN 1 THEN 'LINESTRING' || line
  WHEN 2 THEN 'POLYGON(' || ring || ',' || hole || ')'
  WHEN 3 THEN 'MULTIPOINT((' || a || ' ' || b || '),(' || c || ' ' || c || '))'
  WHEN 4 THEN 'MULTILINESTRING(' || line || ',(' || b || ' ' || b || ',' || c || ' ' || c || ',' || a || ' ' || b || '))'
  ELSE 'MULTIPOLYGON((' || ring || ',' || hole || '),(' || ring || '))' END AS geom
FROM t
""")
def q_wkt_kinds(spark, sf_dir):
    """Every kind but collections, in both byte orders, with and without SRID."""
    spec = S.TableSpec("shapes", (S.ColumnSpec("o_orderkey", "bigint"), S.ColumnSpec("geom", "geometry")))
    n = N.normalize(order_shapes(spark, sf_dir), spec)
    return n.select(F.col("o_orderkey").cast("bigint").alias("o_orderkey"), "geom")
