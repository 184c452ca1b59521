"""Data-quality queries (Q1-Q12, J6) over dirty_orders, lineitem, part, line_refs, tag_sets."""

from __future__ import annotations

from pyspark.sql import functions as F

from siltlake import spec as S
from siltlake.operators import quality as Q
from siltlake.plans import fixtures as X
from siltlake.plans.registry import register

QUALITY_SPEC = S.TableSpec(
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
    unique_keys=((S.KeyPart("cust_ref"), S.KeyPart("order_date")),),
    foreign_keys=(S.ForeignKey("fk_cust", ("cust_ref",), "customer", (S.KeyPart("c_custkey"),)),),
    checks=(
        S.Check("chk_status", "status IN ('F', 'O')"),
        S.Check("chk_price", "try_cast(total_price AS DOUBLE) < 450000", enforced=False),
    ),
)

# Row-local rule conditions in DuckDB, same names and order as the spec gives them.
_ROW_RULES_SQL = [
    ("not_null:o_orderkey", "error", "o_orderkey IS NULL"),
    ("not_null:note", "error", "note IS NULL"),
    ("enum:status", "error", "status IS NOT NULL AND status NOT IN ('F', 'O')"),
    ("range:o_orderkey", "error",
     "TRY_CAST(o_orderkey AS DECIMAL(38,0)) < -9223372036854775808 OR "
     "TRY_CAST(o_orderkey AS DECIMAL(38,0)) > 9223372036854775807"),
    ("range:cust_ref", "error",
     "TRY_CAST(cust_ref AS DECIMAL(38,0)) < -9223372036854775808 OR "
     "TRY_CAST(cust_ref AS DECIMAL(38,0)) > 9223372036854775807"),
    ("range:small_code", "error",
     "TRY_CAST(small_code AS DECIMAL(38,0)) IS NOT NULL AND "
     "(TRY_CAST(small_code AS DECIMAL(38,0)) < -128 OR TRY_CAST(small_code AS DECIMAL(38,0)) > 127)"),
    ("length:note", "error", "COALESCE(length(note) > 15, false)"),
    ("check:chk_status", "error", "COALESCE(NOT (status IN ('F', 'O')), false)"),
    ("check:chk_price", "warning", "COALESCE(NOT (TRY_CAST(total_price AS DOUBLE) < 450000), false)"),
]


@register("not_null", f"""
WITH {X.DIRTY_ORDERS_SQL}
SELECT o_orderkey, 'not_null:note' AS rule FROM dirty_orders WHERE note IS NULL
""")
def q_not_null(spark, sf_dir):
    v = Q.not_null_violations(X.dirty_orders(spark, sf_dir), QUALITY_SPEC)
    return v.select("o_orderkey", F.col("_rule").alias("rule"))


@register("unique_keys", """
SELECT l_orderkey, l_linenumber, COUNT(*) AS n_rows FROM lineitem
WHERE l_orderkey IS NOT NULL AND l_linenumber IS NOT NULL
GROUP BY l_orderkey, l_linenumber HAVING COUNT(*) > 1
""")
def q_unique_keys(spark, sf_dir):
    return Q.unique_violations(X.table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@register("unique_rows", """
WITH d AS (SELECT l_orderkey, l_linenumber, COUNT(*) AS n_rows FROM lineitem
           GROUP BY l_orderkey, l_linenumber HAVING COUNT(*) > 1)
SELECT li.l_orderkey, li.l_linenumber, li.l_partkey, li.l_suppkey, d.n_rows
FROM lineitem li JOIN d ON li.l_orderkey = d.l_orderkey AND li.l_linenumber = d.l_linenumber
""")
def q_unique_rows(spark, sf_dir):
    li = X.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    return Q.unique_violations(li, ["l_orderkey", "l_linenumber"], rows=True)


@register("unique_prefix", """
SELECT substr(p_name, 1, 5) AS p_name_5, COUNT(*) AS n_rows FROM part
WHERE p_name IS NOT NULL GROUP BY substr(p_name, 1, 5) HAVING COUNT(*) > 1
""")
def q_unique_prefix(spark, sf_dir):
    return Q.unique_violations(X.table(spark, sf_dir, "part"), [S.KeyPart("p_name", prefix=5)])


@register("primary_key", f"""
WITH {X.LINE_REFS_SQL},
g AS (SELECT ref_key, l_linenumber, COUNT(*) AS n_rows FROM line_refs GROUP BY ref_key, l_linenumber)
SELECT ref_key, l_linenumber,
       CASE WHEN ref_key IS NULL OR l_linenumber IS NULL THEN 'null_part' ELSE 'duplicate' END AS reason, n_rows
FROM g WHERE ref_key IS NULL OR l_linenumber IS NULL OR n_rows > 1
""")
def q_primary_key(spark, sf_dir):
    return Q.primary_key_violations(X.line_refs(spark, sf_dir), ["ref_key", "l_linenumber"])


_FK_PARTS = (S.KeyPart("o_orderkey"), S.KeyPart("o_orderstatus"))


def _fk(match):
    def run(spark, sf_dir):
        v = Q.fk_violations(X.line_refs(spark, sf_dir), X.table(spark, sf_dir, "orders"),
                            ("ref_key", "ref_status"), _FK_PARTS, match)
        return v.select("l_orderkey", "l_linenumber", "ref_key", "ref_status")
    return run


register("fk_simple", f"""
WITH {X.LINE_REFS_SQL}
SELECT l_orderkey, l_linenumber, ref_key, ref_status FROM line_refs r
WHERE ref_key IS NOT NULL AND ref_status IS NOT NULL
  AND NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_orderkey = r.ref_key AND o.o_orderstatus = r.ref_status)
""")(_fk("SIMPLE"))

register("fk_full", f"""
WITH {X.LINE_REFS_SQL}
SELECT l_orderkey, l_linenumber, ref_key, ref_status FROM line_refs r
WHERE (ref_key IS NULL) <> (ref_status IS NULL)
   OR (ref_key IS NOT NULL AND ref_status IS NOT NULL
       AND NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_orderkey = r.ref_key AND o.o_orderstatus = r.ref_status))
""")(_fk("FULL"))

register("fk_partial", f"""
WITH {X.LINE_REFS_SQL}
SELECT l_orderkey, l_linenumber, ref_key, ref_status FROM line_refs r
WHERE NOT (ref_key IS NULL AND ref_status IS NULL)
  AND NOT EXISTS (SELECT 1 FROM orders o
                  WHERE (r.ref_key IS NULL OR o.o_orderkey = r.ref_key)
                    AND (r.ref_status IS NULL OR o.o_orderstatus = r.ref_status))
""")(_fk("PARTIAL"))


@register("check_rules", f"""
WITH {X.DIRTY_ORDERS_SQL}
SELECT o_orderkey, 'check:chk_status' AS rule, 'error' AS severity FROM dirty_orders
WHERE COALESCE(NOT (status IN ('F', 'O')), false)
UNION ALL
SELECT o_orderkey, 'check:chk_price', 'warning' FROM dirty_orders
WHERE COALESCE(NOT (TRY_CAST(total_price AS DOUBLE) < 450000), false)
""")
def q_check_rules(spark, sf_dir):
    v = Q.check_violations(X.dirty_orders(spark, sf_dir), QUALITY_SPEC.checks)
    return v.select("o_orderkey", F.col("_rule").alias("rule"), F.col("_severity").alias("severity"))


@register("enum_domain", f"""
WITH {X.DIRTY_ORDERS_SQL}
SELECT o_orderkey, status FROM dirty_orders WHERE status IS NOT NULL AND status NOT IN ('F', 'O')
""")
def q_enum_domain(spark, sf_dir):
    return Q.domain_violations(X.dirty_orders(spark, sf_dir), QUALITY_SPEC).select("o_orderkey", "status")


SET_SPEC = S.TableSpec("tag_sets", (S.ColumnSpec("tags", "set", members=("red", "green", "blue")),))


@register("set_domain", f"""
WITH {X.TAG_SETS_SQL}
SELECT o_orderkey, tags FROM tag_sets
WHERE tags IS NOT NULL AND len(list_filter(string_split(tags, ','), lambda x: x NOT IN ('red', 'green', 'blue'))) > 0
""")
def q_set_domain(spark, sf_dir):
    return Q.domain_violations(X.tag_sets(spark, sf_dir), SET_SPEC).select("o_orderkey", "tags")


@register("set_domain_join", f"""
WITH {X.TAG_SETS_SQL}
SELECT o_orderkey, tags FROM tag_sets
WHERE tags IS NOT NULL AND len(list_filter(string_split(tags, ','), lambda x: x NOT IN ('red', 'green', 'blue'))) > 0
""")
def q_set_domain_join(spark, sf_dir):
    members = spark.createDataFrame([(m,) for m in SET_SPEC.columns[0].members], "member string")
    return Q.domain_violations_join(X.tag_sets(spark, sf_dir), "tags", members, is_set=True)


@register("int_range", f"""
WITH {X.DIRTY_ORDERS_SQL}
SELECT o_orderkey, small_code FROM dirty_orders
WHERE TRY_CAST(small_code AS DECIMAL(38,0)) < -128 OR TRY_CAST(small_code AS DECIMAL(38,0)) > 127
""")
def q_int_range(spark, sf_dir):
    return Q.range_violations(X.dirty_orders(spark, sf_dir), QUALITY_SPEC).select("o_orderkey", "small_code")


@register("length_limit", f"""
WITH {X.DIRTY_ORDERS_SQL}
SELECT o_orderkey, note FROM dirty_orders WHERE length(note) > 15
""")
def q_length_limit(spark, sf_dir):
    return Q.length_violations(X.dirty_orders(spark, sf_dir), QUALITY_SPEC).select("o_orderkey", "note")


def _report_sql() -> str:
    rows = []
    for name, sev, cond in _ROW_RULES_SQL:
        rows.append(f"""SELECT '{name}' AS rule, '{sev}' AS severity,
  CAST(COALESCE(SUM(CASE WHEN {cond} THEN 1 ELSE 0 END), 0) AS BIGINT) AS violations,
  CAST(COUNT(*) AS BIGINT) AS n_rows, CAST(MIN(CASE WHEN {cond} THEN o_orderkey END) AS VARCHAR) AS sample_key
FROM dirty_orders""")
    rows.append("""SELECT 'primary_key', 'error', CAST(COALESCE(SUM(CASE WHEN o_orderkey IS NULL OR n > 1 THEN n END), 0) AS BIGINT),
  (SELECT COUNT(*) FROM dirty_orders), CAST(MIN(CASE WHEN o_orderkey IS NULL OR n > 1 THEN sk END) AS VARCHAR)
FROM (SELECT o_orderkey, COUNT(*) AS n, MIN(o_orderkey) AS sk FROM dirty_orders GROUP BY o_orderkey) g""")
    rows.append("""SELECT 'unique:cust_ref,order_date', 'error',
  CAST(COALESCE(SUM(CASE WHEN cust_ref IS NOT NULL AND order_date IS NOT NULL AND n > 1 THEN n END), 0) AS BIGINT),
  (SELECT COUNT(*) FROM dirty_orders),
  CAST(MIN(CASE WHEN cust_ref IS NOT NULL AND order_date IS NOT NULL AND n > 1 THEN sk END) AS VARCHAR)
FROM (SELECT cust_ref, order_date, COUNT(*) AS n, MIN(o_orderkey) AS sk
      FROM dirty_orders GROUP BY cust_ref, order_date) g""")
    rows.append("""SELECT 'fk:fk_cust', 'error', CAST(COUNT(*) AS BIGINT), (SELECT COUNT(*) FROM dirty_orders),
  CAST(MIN(o_orderkey) AS VARCHAR)
FROM dirty_orders d WHERE cust_ref IS NOT NULL AND NOT EXISTS (SELECT 1 FROM customer c WHERE c.c_custkey = d.cust_ref)""")
    return f"WITH {X.DIRTY_ORDERS_SQL}\n" + "\nUNION ALL\n".join(rows)


@register("quality_report", _report_sql())
def q_quality_report(spark, sf_dir):
    return Q.quality_report(X.dirty_orders(spark, sf_dir), QUALITY_SPEC,
                            parents={"customer": X.table(spark, sf_dir, "customer")}, sample_key="o_orderkey")


def _quarantine_sql() -> str:
    errs = [(n, c) for n, s, c in _ROW_RULES_SQL if s == "error"]
    cases = ", ".join(f"CASE WHEN {c} THEN '{n}' END" for n, c in errs)
    any_err = " OR ".join(f"({c})" for _, c in errs)
    return f"""WITH {X.DIRTY_ORDERS_SQL}
SELECT o_orderkey, CONCAT_WS(',', {cases}) AS reasons FROM dirty_orders WHERE {any_err}"""


@register("quarantine", _quarantine_sql())
def q_quarantine(spark, sf_dir):
    _, bad = Q.split_clean(X.dirty_orders(spark, sf_dir), QUALITY_SPEC)
    return bad.select("o_orderkey", F.array_join("_reasons", ",").alias("reasons"))


@register("clean_rows", f"""
WITH {X.DIRTY_ORDERS_SQL}
SELECT o_orderkey FROM dirty_orders WHERE NOT ({" OR ".join(f"({c})" for n, s, c in _ROW_RULES_SQL if s == "error")})
""")
def q_clean_rows(spark, sf_dir):
    clean, _ = Q.split_clean(X.dirty_orders(spark, sf_dir), QUALITY_SPEC)
    return clean.select("o_orderkey")


@register("rule_holds", """
SELECT o_orderkey, 'duplicate' AS reason, COUNT(*) AS n_rows FROM orders GROUP BY o_orderkey HAVING COUNT(*) > 1
UNION ALL
SELECT NULL, 'null_part', COUNT(*) FROM orders WHERE o_orderkey IS NULL HAVING COUNT(*) > 0
""")
def q_rule_holds(spark, sf_dir):
    return Q.rule_holds(X.table(spark, sf_dir, "orders"), "primary_key", parts=["o_orderkey"])


@register("rule_broken", """
SELECT l_orderkey, l_linenumber, 'duplicate' AS reason, COUNT(*) AS n_rows FROM lineitem
GROUP BY l_orderkey, l_linenumber HAVING COUNT(*) > 1
""")
def q_rule_broken(spark, sf_dir):
    """A key about to be added that the table does not have."""
    return Q.rule_holds(X.table(spark, sf_dir, "lineitem"), "primary_key", parts=["l_orderkey", "l_linenumber"])


@register("quarantined_landing", f"""
WITH {X.DIRTY_ORDERS_SQL}
SELECT o_orderkey FROM dirty_orders WHERE {" OR ".join(f"({c})" for _, sev, c in _ROW_RULES_SQL if sev == "error")}
""")
def q_quarantined_landing(spark, sf_dir):
    """The other side of the landing split: what goes to quarantine."""
    return Q.split_clean(X.dirty_orders(spark, sf_dir), QUALITY_SPEC)[1].select("o_orderkey")
