"""Deletes over a graph of tables (J7) and label pruning."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from siltlake import spec as S
from siltlake.operators import graph as G
from siltlake.operators import layout as L
from siltlake.operators import pruning as P
from siltlake.plans import fixtures as X
from siltlake.plans.registry import register
from siltlake.session import checkpoint_dir

_KEYS = {"customer": ("c_custkey",), "supplier": ("s_suppkey",), "orders": ("o_orderkey",), "lineitem": ("l_orderkey", "l_linenumber")}


def _shop(to_orders: str) -> dict[str, S.TableSpec]:
    """customer <- orders <- lineitem -> supplier."""
    def fk(name, column, parent, on_delete):
        return S.ForeignKey(name, (column,), parent, (S.KeyPart(_KEYS[parent][0]),), on_delete=on_delete)

    links = {"orders": (fk("orders_customer", "o_custkey", "customer", "CASCADE"),),
             "lineitem": (fk("line_order", "l_orderkey", "orders", to_orders), fk("line_supplier", "l_suppkey", "supplier", "SET NULL"))}
    return {name: S.TableSpec(name, (), primary_key=tuple(S.KeyPart(k) for k in keys), foreign_keys=links.get(name, ()))
            for name, keys in _KEYS.items()}


def _in_debt(spark, sf_dir):
    tables = {name: X.table(spark, sf_dir, name) for name in _KEYS}
    return tables, {"customer": tables["customer"].where("c_acctbal < 0").select("c_custkey"),
                    "supplier": tables["supplier"].where("s_acctbal < 0").select("s_suppkey")}


@register("cascade_graph", """
WITH c AS (SELECT c_custkey FROM customer WHERE NOT c_acctbal < 0),
o AS (SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0)),
gone AS (SELECT o_orderkey FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0)),
l AS (SELECT l_orderkey, l_linenumber, CASE WHEN l_suppkey NOT IN (SELECT s_suppkey FROM supplier WHERE s_acctbal < 0) THEN l_suppkey END AS l_suppkey
      FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM gone))
SELECT 'customer' AS table_name, CAST(c_custkey AS BIGINT) AS key, CAST(NULL AS BIGINT) AS part, CAST(NULL AS BIGINT) AS refers FROM c
UNION ALL SELECT 'supplier', CAST(s_suppkey AS BIGINT), NULL, NULL FROM supplier WHERE NOT s_acctbal < 0
UNION ALL SELECT 'orders', CAST(o_orderkey AS BIGINT), NULL, CAST(o_custkey AS BIGINT) FROM o
UNION ALL SELECT 'lineitem', CAST(l_orderkey AS BIGINT), CAST(l_linenumber AS BIGINT), CAST(l_suppkey AS BIGINT) FROM l
""")
def q_cascade_graph(spark, sf_dir):
    """Customers and suppliers in debt go: orders and their lines cascade, and
    the lines that stay lose a supplier that went."""
    tables, deleted = _in_debt(spark, sf_dir)
    after = G.delete_over_graph(tables, _shop("CASCADE"), deleted).tables
    none = F.lit(None).cast("long")
    shape = {"customer": ("c_custkey", None, None), "supplier": ("s_suppkey", None, None), "orders": ("o_orderkey", None, "o_custkey"),
             "lineitem": ("l_orderkey", "l_linenumber", "l_suppkey")}
    out = None
    for name, columns in shape.items():
        key, part, refers = [none if c is None else F.col(c).cast("long") for c in columns]
        rows = after[name].select(F.lit(name).alias("table_name"), key.alias("key"), part.alias("part"), refers.alias("refers"))
        out = rows if out is None else out.unionByName(rows)
    return out


@register("cascade_graph_restrict", """
WITH gone AS (SELECT o_orderkey FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0)),
held AS (SELECT COUNT(*) AS n FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM gone))
SELECT 'line_order' AS what, n FROM held
UNION ALL SELECT 'customer', COUNT(*) FROM customer UNION ALL SELECT 'supplier', COUNT(*) FROM supplier
UNION ALL SELECT 'orders', COUNT(*) FROM orders UNION ALL SELECT 'lineitem', COUNT(*) FROM lineitem
""")
def q_cascade_graph_restrict(spark, sf_dir):
    """The same with RESTRICT between lines and orders: it rolls the whole set
    back, in every table; the rows that held it are counted."""
    tables, deleted = _in_debt(spark, sf_dir)
    result = G.delete_over_graph(tables, _shop("RESTRICT"), deleted)
    out = result.rejected.select(F.col("constraint").alias("what"), F.col("n_children").alias("n"))
    for name, rows in result.tables.items():
        out = out.unionByName(rows.agg(F.count("*").alias("n")).select(F.lit(name).alias("what"), "n"))
    return out


# --------------------------------------------------------------------------
# label pruning: written by labels, read back by a predicate on the key
# --------------------------------------------------------------------------

RANGE_TUPLES = S.PartitionSpec("range", columns=("o_orderstatus", "o_totalprice"), names=("f1", "f2", "o1", "o2", "p", "z"),
                               bounds=(("F", 100000), ("F", None), ("O", 150000), ("O", None), ("P", None), (None, None)))
LISTS = S.PartitionSpec("list", columns=("o_orderpriority",), names=("high", "low"), lists=(("1-URGENT", "2-HIGH"), ("5-LOW", "4-NOT SPECIFIED")))
HASHED = S.PartitionSpec("hash", expr="o_custkey + 1", count=16)
LINEAR = S.PartitionSpec("hash", expr="o_custkey", count=6, linear=True)
BY_YEAR = S.PartitionSpec("range", expr="year(o_orderdate)", bounds=(1993, 1994, 1995, 1996, 1997, None), sub=S.PartitionSpec("key", columns=("o_custkey",), count=4))

PRUNED = {
    "prune_range_tuple": (RANGE_TUPLES, {"o_orderstatus": P.equal("O"), "o_totalprice": P.between(160000, 200000)},
                          "o_orderstatus = 'O' AND o_totalprice BETWEEN 160000 AND 200000"),
    "prune_list": (LISTS, {"o_orderpriority": P.among("1-URGENT", "3-MEDIUM")}, "o_orderpriority IN ('1-URGENT', '3-MEDIUM')"),
    "prune_hash": (HASHED, {"o_custkey": P.among(1, 4, 7, 17, 20, 33)}, "o_custkey IN (1, 4, 7, 17, 20, 33)"),
    "prune_linear_hash": (LINEAR, {"o_custkey": P.between(16, 18)}, "o_custkey BETWEEN 16 AND 18"),
    "prune_subpartition": (BY_YEAR, {"year(o_orderdate)": P.between(1994, 1995), "o_custkey": P.among(4, 7, 10)},
                           "year(o_orderdate) BETWEEN 1994 AND 1995 AND o_custkey IN (4, 7, 10)"),
}


def pruned_orders(spark, sf_dir, name):
    spec, where, _ = PRUNED[name]
    path = f"{checkpoint_dir(spark).rstrip('/')}/siltlake-{name}-{uuid.uuid4().hex[:10]}"
    orders = X.table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority")
    L.write_partitioned(L.apply_partitioning(orders, spec), path, [L.LABEL] + ([L.SUBLABEL] if spec.sub else []))
    return P.with_pruning(spark.read.parquet(path), spec, where)


def _register_pruned(name: str) -> None:
    @register(name, f"SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE {PRUNED[name][2]}")
    def query(spark, sf_dir):
        return pruned_orders(spark, sf_dir, name).select("o_orderkey", "o_custkey", "o_totalprice")


for _name in PRUNED:
    _register_pruned(_name)
