"""Quality rules, MATCH semantics, ALL/ANY truth table against DuckDB."""

import itertools

import duckdb
import pytest
from pyspark.sql import functions as F

from table_dirs import SF001
from siltlake import spec as S
from siltlake.operators import quality as Q
from siltlake.operators import relational as R
from siltlake.plans import fixtures as X
from siltlake.plans.q_quality import QUALITY_SPEC


def test_clean_union_quarantine_is_input(spark):
    d = X.dirty_orders(spark, SF001)
    clean, bad = Q.split_clean(d, QUALITY_SPEC)
    assert clean.count() + bad.count() == d.count()
    assert clean.join(bad, "o_orderkey", "inner").count() == 0


def test_warnings_never_quarantine(spark):
    spec = S.TableSpec("t", (S.ColumnSpec("x", "int"),), checks=(S.Check("w", "x < 0", enforced=False),))
    clean, bad = Q.split_clean(spark.createDataFrame([(1,)], "x int"), spec)
    assert clean.count() == 1 and bad.count() == 0


def test_unique_nulls_never_collide(spark):
    df = spark.createDataFrame([(None, 1), (None, 1), (2, 1), (2, 1)], "a int, b int")
    assert [tuple(r) for r in Q.unique_violations(df, ["a", "b"]).collect()] == [(2, 1, 2)]
    pk = sorted((tuple(r) for r in Q.primary_key_violations(df, ["a", "b"]).collect()), key=str)
    assert pk == sorted([(None, 1, "null_part", 2), (2, 1, "duplicate", 2)], key=str)


def test_fk_match_rules(spark):
    parent = spark.createDataFrame([(1, "x"), (2, "y")], "k int, s string")
    child = spark.createDataFrame([(1, "x"), (1, None), (None, None), (3, None), (None, "y"), (2, "x")],
                                  "ck int, cs string")
    parts = (S.KeyPart("k"), S.KeyPart("s"))

    def run(m):
        return sorted((tuple(r) for r in Q.fk_violations(child, parent, ("ck", "cs"), parts, m).collect()), key=str)
    assert run("SIMPLE") == [(2, "x")]
    assert run("FULL") == sorted([(1, None), (3, None), (None, "y"), (2, "x")], key=str)
    assert run("PARTIAL") == sorted([(2, "x"), (3, None)], key=str)


def test_fk_prefix_parts(spark):
    parent = spark.createDataFrame([("abcdef",)], "name string")
    child = spark.createDataFrame([("abcxyz",), ("abd",)], "ref string")
    v = Q.fk_violations(child, parent, ("ref",), (S.KeyPart("name", prefix=3),))
    assert [r[0] for r in v.collect()] == ["abd"]


SETS = [(), (None,), (1,), (1, 1), (1, 2), (1, None), (1, 2, None), (None, None), (2, 3)]
PROBES = [None, 0, 1, 2, 3, 4]
OPS = [">", ">=", "<", "<=", "=", "<>"]


@pytest.mark.parametrize("quant", ["ALL", "ANY"])
def test_all_any_truth_table_matches_duckdb(spark, quant):
    con = duckdb.connect()
    probes = spark.createDataFrame([(i, p) for i, p in enumerate(PROBES)], "i int, x int")
    fn = R.compare_all if quant == "ALL" else R.compare_any
    for si, s in enumerate(SETS):
        sub = spark.createDataFrame([(v,) for v in s], "v int")
        vals = ",".join("(NULL)" if v is None else f"({v})" for v in s)
        src = f"(VALUES {vals}) t(v)" if s else "(SELECT 1 AS v WHERE false) t"
        for op in OPS:
            got = sorted(r["i"] for r in fn(probes, "x", op, sub, "v").collect())
            want = []
            for i, p in enumerate(PROBES):
                x = "NULL" if p is None else str(p)
                r = con.execute(f"SELECT CAST({x} AS INTEGER) {op} {quant} (SELECT v FROM {src})").fetchone()[0]
                if r is True:
                    want.append(i)
            assert got == want, (quant, s, op)


def test_all_plan_has_no_nested_loop_join(spark):
    o = X.table(spark, SF001, "orders")
    s = X.table(spark, SF001, "supplier")
    for df in (R.compare_all(o, "o_totalprice", ">", s, "s_acctbal"),
               R.compare_all(o, "o_custkey", "<>", s, "s_suppkey"),
               R.compare_any(o, "o_totalprice", "<>", s, "s_acctbal")):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "NestedLoopJoin" not in plan and "CartesianProduct" not in plan


def test_quality_report_counts(spark):
    rep = {r["rule"]: r["violations"] for r in Q.quality_report(
        X.dirty_orders(spark, SF001), QUALITY_SPEC, parents={"customer": X.table(spark, SF001, "customer")}).collect()}
    d = X.dirty_orders(spark, SF001)
    assert rep["not_null:note"] == d.where(F.col("note").isNull()).count()
    assert rep["enum:status"] == d.where(~F.col("status").isin("F", "O")).count()


def test_cascade_self_reference_fixed_point(spark):
    t = spark.createDataFrame([(1, None), (2, 1), (3, 2), (4, 3), (5, None), (6, 5)], "k int, parent int")
    out, _ = R.apply_parent_changes(t, ["parent"], deleted=spark.createDataFrame([(2,)], "k int"),
                                    on_delete="CASCADE", self_parent=["k"])
    assert sorted(r["k"] for r in out.collect()) == [1, 5, 6]


def test_cascade_deep_chain_and_cycle(spark):
    # a chain 0 <- 1 <- ... <- 999 plus a parent-less cycle 2000 -> 2001 -> 2002 -> 2000
    rows = [(i, i - 1 if i > 0 else None) for i in range(1000)] + [(2000, 2002), (2001, 2000), (2002, 2001)]
    t = spark.createDataFrame(rows, "k int, parent int")
    out = R.cascade_self_delete(t, ["parent"], ["k"], spark.createDataFrame([(500,)], "k int"))
    assert sorted(r["k"] for r in out.collect()) == list(range(500)) + [2000, 2001, 2002]
    out = R.cascade_self_delete(t, ["parent"], ["k"], spark.createDataFrame([(2001,), (-5,)], "k int"))
    assert out.count() == 1000


def test_set_domain_on_loosened_arrays(spark):
    spec = S.TableSpec("t", (S.ColumnSpec("id", "int"), S.ColumnSpec("tags", "set", members=("red", "blue"))))
    raw = spark.createDataFrame([("1", "red,blue"), ("2", "red,pink"), ("3", ""), ("4", None)], "id string, tags string")
    from siltlake.operators import normalize as N
    typed = N.loosen(raw, spec)
    assert str(typed.schema["tags"].dataType) == "ArrayType(StringType(), True)"
    bad = sorted(r["id"] for r in Q.domain_violations(typed, spec).collect())
    assert bad == [2]
    assert sorted(r["id"] for r in Q.domain_violations(raw, spec).collect()) == ["2"]


def test_set_domain_join_empty_set(spark):
    df = spark.createDataFrame([(1, "red"), (2, "red,pink"), (3, ""), (4, None)], "id int, tags string")
    members = spark.createDataFrame([("red",), ("blue",)], "member string")
    assert [r["id"] for r in Q.domain_violations_join(df, "tags", members, is_set=True).collect()] == [2]
