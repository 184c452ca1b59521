"""ALTER histories against a plain fold, and profiles merged from sketches."""

import random

import pytest
from pyspark.sql import functions as F

from siltlake import spec as S
from siltlake.operators import history as H
from siltlake.operators import sketches as K
from siltlake.operators.profile import profile

SPEC = S.TableSpec("t", (S.ColumnSpec("pk", "bigint"), S.ColumnSpec("v", "int")), checks=(S.Check("c0", "v < 50"),))


def brute(rows, spec, events):
    out = []
    for seq, pk, v in rows:
        current = spec
        for e in sorted(events, key=lambda e: e.at):
            if e.at <= seq:
                current = H._altered(current, e)
        for c in current.checks:
            column, op, number = c.rule.split()
            if v is not None and not (v < int(number) if op == "<" else v > int(number)):
                out.append((seq, f"check:{c.name}", "error" if c.enforced else "warning"))
    return sorted(out)


def test_rows_are_judged_by_the_rules_of_their_position(spark):
    rng = random.Random(3)
    events = [H.Alter(20, "add_check", check=S.Check("c1", "v > 10")), H.Alter(20, "alter_check", name="c0", enforced=False),
              H.Alter(30, "drop_check", name="c0"), H.Alter(60, "add_check", check=S.Check("c0", "v < 50")), H.Alter(70, "alter_check", name="c1", enforced=False),
              H.Alter(75, "drop_check", name="c1"), H.Alter(80, "add_check", check=S.Check("c1", "v > 10", enforced=False))]
    rows = [(i, rng.randint(0, 9), rng.choice([None, *range(100)])) for i in range(100)]
    df = spark.createDataFrame(rows, "seq long, pk long, v int")
    got = sorted((r["seq"], r["_rule"], r["_severity"]) for r in H.historic_violations(df, SPEC, events).collect())
    assert got == brute(rows, SPEC, events)
    spans = [(a, b, [c.name for c in s.checks]) for a, b, s in H.versions(SPEC, events)]
    assert spans[0] == (None, 20, ["c0"]) and spans[1][:2] == (20, 30) and spans[-1] == (80, None, ["c0", "c1"])


@pytest.mark.parametrize("event", [H.Alter(1, "drop_check", name="x"), H.Alter(1, "alter_check", name="x"), H.Alter(1, "add_check", check=S.Check("c0", "v > 1")),
                                   H.Alter(1, "add_column", column=S.ColumnSpec("v")), H.Alter(1, "add_column", column=S.ColumnSpec("w"), after="x"),
                                   H.Alter(1, "drop_column", name="x"), H.Alter(1, "rename")])
def test_impossible_events(event):
    with pytest.raises(ValueError):
        H.versions(SPEC, [event])


def test_columns_first_and_after(spark):
    events = [H.Alter(5, "add_column", column=S.ColumnSpec("z", "varchar", default="old"), first=True),
              H.Alter(7, "add_column", column=S.ColumnSpec("y", "int", default=3), after="pk"), H.Alter(9, "drop_column", name="v")]
    df = spark.createDataFrame([(1, 1, 1, None), (6, 1, 1, None), (8, 1, 1, 8)], "seq long, pk long, v int, y int")
    out = H.historic_rows(df, SPEC, events)
    assert out.columns == ["seq", "z", "pk", "y"]
    assert sorted(map(tuple, out.collect())) == [(1, "old", 1, 3), (6, None, 1, 3), (8, None, 1, 8)]


def test_blocking_rows_look_at_the_state_of_the_moment(spark):
    df = spark.createDataFrame([(1, 1, "insert", 60), (2, 2, "insert", 70), (3, 1, "update", 5), (4, 2, "delete", 70), (9, 3, "insert", 99)], "seq long, pk long, op string, v int")
    events = [H.Alter(3, "add_check", check=S.Check("c1", "v < 10", enforced=False)), H.Alter(4, "alter_check", name="c1", enforced=True), H.Alter(5, "drop_check", name="c1"),
              H.Alter(10, "add_check", check=S.Check("c1", "v < 10"))]
    assert sorted((r["_at"], r["pk"]) for r in H.blocking_rows(df, events).collect()) == [(4, 2), (10, 3)]
    assert H.blocking_rows(df, []).count() == 0


def test_merged_profile_equals_the_whole_one(spark, tmp_path):
    rng = random.Random(5)
    rows = [(rng.choice([None, *range(-50, 3000)]), rng.gauss(0, 5), rng.choice(["a", "bb", None, "Ünï"]), str(rng.randint(0, 10 ** 6) / 100)) for _ in range(6000)]
    df = spark.createDataFrame(rows, "i int, x double, s string, d string").select("i", "x", "s", F.col("d").cast("decimal(12,2)").alias("d"), F.lit(None).cast("int").alias("none"))
    path = str(tmp_path / "p")
    parts = df.randomSplit([1.0, 2.0, 3.0], seed=1)
    for k, part in enumerate(parts):
        K.save_profile(part, path, f"l{k}")
    K.save_profile(parts[0], path, "l0")  # saved again: counted once
    got = {r["column_name"]: r for r in K.merge_profiles(K.read_profiles(spark, path)).collect()}
    want = {r["column_name"]: r for r in profile(df, exact=True).collect()}
    for c, w in want.items():
        g = got[c]
        assert (g["n_rows"], g["n_null"], g["max_length"]) == (w["n_rows"], w["n_null"], w["max_length"])
        assert abs(g["n_distinct"] - w["n_distinct"]) <= 0.05 * w["n_distinct"]
        assert [None if v is None else float(v) if c in "ixd" else v for v in (g["min_value"], g["max_value"])] == \
               [None if v is None else float(v) if c in "ixd" else v for v in (w["min_value"], w["max_value"])]
        assert (g["quantiles"] is None) == (c in ("s", "none"))
        for q, v in zip(K.QUANTILES, g["quantiles"] or []):
            assert abs(df.where(F.col(c).isNotNull() & (F.col(c) <= v)).count() / (w["n_rows"] - w["n_null"]) - q) <= 0.02
