"""Rules over a history of ALTERs (Q5, Q12, T10), merged profiles (A4), and
reference and rule forms that had no query."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from siltlake import spec as S
from siltlake.operators import history as H
from siltlake.operators import quality as Q
from siltlake.operators import sketches as K
from siltlake.plans import fixtures as X
from siltlake.plans.q_normalize import _PROFILE_COLS, _profile_sql
from siltlake.plans.registry import register
from siltlake.session import checkpoint_dir

LOG_SPEC = S.TableSpec("log", (S.ColumnSpec("pk", "bigint"), S.ColumnSpec("event_type", "varchar"), S.ColumnSpec("value", "double")),
                       primary_key=(S.KeyPart("pk"),), checks=(S.Check("small", "value < 60"),))
LOG_EVENTS = [
    H.Alter(150, "add_check", check=S.Check("no_error", "event_type <> 'error'", enforced=False)),
    H.Alter(300, "alter_check", name="no_error", enforced=True),
    H.Alter(450, "drop_check", name="small"),
    H.Alter(500, "add_column", column=S.ColumnSpec("origin", "varchar", default="web"), after="pk"),
    H.Alter(600, "add_check", check=S.Check("small", "value < 40")),
    H.Alter(600, "add_check", check=S.Check("bought", "event_type = 'purchase' OR value < 50")),
    H.Alter(700, "alter_check", name="bought", enforced=False),
    H.Alter(800, "drop_check", name="no_error"),
]


def _broken(name, rule, severity, span):
    return f"SELECT seq, pk, 'check:{name}' AS rule, '{severity}' AS severity FROM changelog WHERE NOT ({rule}) AND {span}"


@register("alter_history", "\n".join([f"WITH {X.CHANGELOG_SQL}", "\nUNION ALL ".join([
    _broken("small", "value < 60", "error", "seq < 450"),
    _broken("no_error", "event_type <> 'error'", "warning", "seq >= 150 AND seq < 300"),
    _broken("no_error", "event_type <> 'error'", "error", "seq >= 300 AND seq < 800"),
    _broken("small", "value < 40", "error", "seq >= 600"),
    _broken("bought", "event_type = 'purchase' OR value < 50", "error", "seq >= 600 AND seq < 700"),
    _broken("bought", "event_type = 'purchase' OR value < 50", "warning", "seq >= 700")])]))
def q_alter_history(spark, sf_dir):
    """Checks are added, altered, dropped and added anew in the middle of the
    log; each change is judged by those valid at its position."""
    found = H.historic_violations(X.changelog(spark, sf_dir), LOG_SPEC, LOG_EVENTS)
    return found.select("seq", "pk", F.col("_rule").alias("rule"), F.col("_severity").alias("severity"))


@register("alter_history_rows", f"""
WITH {X.CHANGELOG_SQL}
SELECT seq, pk, CASE WHEN seq < 500 THEN 'web' END AS origin, event_type, value FROM changelog
""")
def q_alter_history_rows(spark, sf_dir):
    """The log in its last shape: a column added AFTER another in the middle."""
    return H.historic_rows(X.changelog(spark, sf_dir), LOG_SPEC, LOG_EVENTS)


def _standing(at, rule, name):
    return f"""SELECT {at} AS at, pk, seq, 'check:{name}' AS rule FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY pk ORDER BY seq DESC) AS rn FROM changelog WHERE seq < {at}) z
WHERE rn = 1 AND op <> 'delete' AND NOT ({rule})"""


@register("alter_blocked", "\n".join([f"WITH {X.CHANGELOG_SQL}", "\nUNION ALL ".join([
    _standing(300, "event_type <> 'error'", "no_error"), _standing(600, "value < 40", "small"),
    _standing(600, "event_type = 'purchase' OR value < 50", "bought")])]))
def q_alter_blocked(spark, sf_dir):
    """Rows that stood when a check became enforced, and break it."""
    found = H.blocking_rows(X.changelog(spark, sf_dir), LOG_EVENTS)
    return found.select(F.col("_at").alias("at"), "pk", "seq", F.col("_rule").alias("rule"))


@register("rule_holds_unique", """
SELECT CAST(o_custkey AS BIGINT) AS o_custkey, o_orderstatus, COUNT(*) AS n FROM orders GROUP BY o_custkey, o_orderstatus HAVING COUNT(*) > 1
""")
def q_rule_holds_unique(spark, sf_dir):
    """ALTER … ADD UNIQUE (o_custkey, o_orderstatus): the keys in its way."""
    found = Q.rule_holds(X.table(spark, sf_dir, "orders"), "unique", parts=(S.KeyPart("o_custkey"), S.KeyPart("o_orderstatus")))
    return found.select(F.col("o_custkey").cast("long").alias("o_custkey"), "o_orderstatus", F.col("n_rows").cast("long").alias("n"))


@register("rule_holds_foreign_key", f"""
WITH {X.DIRTY_ORDERS_SQL}
SELECT o_orderkey, cust_ref FROM dirty_orders WHERE cust_ref IS NOT NULL AND cust_ref NOT IN (SELECT c_custkey FROM customer)
""")
def q_rule_holds_foreign_key(spark, sf_dir):
    """ALTER … ADD FOREIGN KEY (cust_ref): the rows in its way."""
    found = Q.rule_holds(X.dirty_orders(spark, sf_dir), "foreign_key", parent=X.table(spark, sf_dir, "customer"), columns=("cust_ref",),
                         parent_parts=(S.KeyPart("c_custkey"),))
    return found.select("o_orderkey", "cust_ref")


@register("rule_holds_check", """
SELECT o_orderkey, 'check:cheap' AS rule FROM orders WHERE COALESCE(NOT (o_totalprice < 300000 OR o_orderstatus = 'F'), false)
""")
def q_rule_holds_check(spark, sf_dir):
    """ALTER … ADD CHECK: the rows in its way."""
    found = Q.rule_holds(X.table(spark, sf_dir, "orders"), "check", name="cheap", rule="o_totalprice < 300000 OR o_orderstatus = 'F'")
    return found.select("o_orderkey", F.col("_rule").alias("rule"))


@register("fk_partial_prefix", """
WITH refs AS (SELECT o_orderkey, CASE WHEN o_orderstatus = 'O' THEN NULL WHEN o_orderpriority = '5-LOW' THEN 99 ELSE o_custkey % 25 END AS nation,
    CASE WHEN o_orderpriority = '1-URGENT' THEN NULL WHEN o_orderpriority = '2-HIGH' THEN 'NOWHERE' ELSE
      (SELECT c_mktsegment FROM customer c WHERE c.c_custkey = o.o_custkey) || ' goods' END AS trade FROM orders o)
SELECT o_orderkey, CAST(nation AS BIGINT) AS nation, trade FROM refs r WHERE NOT (nation IS NULL AND trade IS NULL)
  AND NOT EXISTS (SELECT 1 FROM customer c WHERE (r.nation IS NULL OR c.c_nationkey = r.nation)
                  AND (r.trade IS NULL OR substr(c.c_mktsegment, 1, 5) = substr(r.trade, 1, 5)))
""")
def q_fk_partial_prefix(spark, sf_dir):
    """MATCH PARTIAL against a key of which one part is a prefix of five characters."""
    customer, orders = X.table(spark, sf_dir, "customer"), X.table(spark, sf_dir, "orders")
    segment = customer.select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment")
    refs = orders.join(segment, "o_custkey", "left").select(
        "o_orderkey",
        F.when(F.col("o_orderstatus") == "O", None).when(F.col("o_orderpriority") == "5-LOW", 99).otherwise(F.col("o_custkey") % 25).cast("long").alias("nation"),
        F.when(F.col("o_orderpriority") == "1-URGENT", None).when(F.col("o_orderpriority") == "2-HIGH", "NOWHERE")
        .otherwise(F.concat("c_mktsegment", F.lit(" goods"))).alias("trade"))
    return Q.fk_violations(refs, customer, ("nation", "trade"), (S.KeyPart("c_nationkey"), S.KeyPart("c_mktsegment", prefix=5)), "PARTIAL")


@register("profile_merged", f"""
SELECT column_name, n_rows, n_null, min_value, max_value, max_length, CAST(3 AS BIGINT) AS n_loads, TRUE AS distinct_within, 
  CASE WHEN column_name IN ('o_orderkey', 'o_custkey', 'o_totalprice') THEN TRUE END AS quantiles_within
FROM ({_profile_sql(_PROFILE_COLS)}) p
""")
def q_profile_merged(spark, sf_dir):
    """Three loads of orders (by status) are profiled one by one and merged
    from their sketches; distinct counts within 5 % and quartiles within 2 % of
    rank are held against the data."""
    path = f"{checkpoint_dir(spark).rstrip('/')}/siltlake-profiles-{uuid.uuid4().hex[:10]}"
    orders = X.table(spark, sf_dir, "orders").select(*_PROFILE_COLS)
    for status in ("F", "O", "P"):
        K.save_profile(orders.where(F.col("o_orderstatus") == status), path, status)
    merged = K.merge_profiles(K.read_profiles(spark, path))
    exact = None
    for c in _PROFILE_COLS:  # one small count a column
        n = orders.select(F.col(c).alias("v")).where("v IS NOT NULL").distinct().agg(F.count("*").alias("_exact")).select(F.lit(c).alias("column_name"), "_exact")
        exact = n if exact is None else exact.unionByName(n)
    wanted = merged.where("quantiles IS NOT NULL").select("column_name", "quantiles")
    values = orders.select(F.explode(F.array(*[F.struct(F.lit(c).alias("c"), F.col(c).cast("double").alias("v")) for c in ("o_orderkey", "o_custkey", "o_totalprice")])).alias("x")).select("x.*")
    ranked = values.join(F.broadcast(wanted), values["c"] == wanted["column_name"]).groupBy("column_name").agg(
        *[F.avg((F.col("v") <= F.col("quantiles")[i]).cast("double")).alias(f"_r{i}") for i in range(3)], F.max(F.lit(1)).alias("_one"))
    within = F.lit(True)
    for i, q in enumerate(K.QUANTILES):
        within = within & (F.abs(F.col(f"_r{i}") - q) <= 0.02 + 1 / F.lit(200.0))
    return merged.join(exact, "column_name").join(ranked.select("column_name", within.alias("quantiles_within")), "column_name", "left").select(
        "column_name", "n_rows", "n_null", "min_value", "max_value", "max_length", "n_loads",
        (F.abs(F.col("n_distinct") - F.col("_exact")) <= 0.05 * F.col("_exact")).alias("distinct_within"), "quantiles_within")
