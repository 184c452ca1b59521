"""Deletes over a graph of tables, and label pruning, against plain Python."""

import random
import re

import pytest

from siltlake import spec as S
from siltlake.operators import graph as G
from siltlake.operators import layout as L
from siltlake.operators import pruning as P
from siltlake.plans.q_graph import PRUNED, pruned_orders
from table_dirs import SF001


def spec(name, *links):
    return S.TableSpec(name, (S.ColumnSpec("to", "bigint", default=0), S.ColumnSpec("up", "bigint")), primary_key=(S.KeyPart("id"),),
                       foreign_keys=tuple(S.ForeignKey(f"{name}_{c}", (c,), parent, (S.KeyPart("id"),), on_delete=action) for c, parent, action in links))


def brute(tables, specs, deleted):
    """(rows after, rejecting constraints) by following one row at a time."""
    gone = {n: set() for n in tables}
    todo = [(n, k) for n, ks in deleted.items() for k in ks if k in tables[n]]
    while todo:
        name, key = todo.pop()
        if key in gone[name]:
            continue
        gone[name].add(key)
        for child, sp in specs.items():
            for fk in sp.foreign_keys:
                if fk.parent == name and fk.on_delete == "CASCADE":
                    todo += [(child, k) for k, row in tables[child].items() if row[fk.columns[0]] == key]
    after = {n: {k: dict(r) for k, r in t.items() if k not in gone[n]} for n, t in tables.items()}
    bad = set()
    for child, sp in specs.items():
        for fk in sp.foreign_keys:
            for row in after[child].values():
                if row[fk.columns[0]] in gone[fk.parent]:
                    if fk.on_delete in ("RESTRICT", "NO ACTION"):
                        bad.add(fk.name)
                    elif fk.on_delete == "SET NULL":
                        row[fk.columns[0]] = None
                    elif fk.on_delete == "SET DEFAULT":
                        row[fk.columns[0]] = 0
    return (tables, bad) if bad else (after, bad)


@pytest.mark.parametrize("seed", range(4))
def test_delete_over_graph(spark, seed):
    rng = random.Random(seed)
    names = ["a", "b", "c"]
    actions = ["CASCADE", "CASCADE", "SET NULL", "SET DEFAULT", "NO ACTION" if seed == 3 else "CASCADE"]
    specs = {n: spec(n, ("to", rng.choice(names), rng.choice(actions)), ("up", rng.choice(names), "CASCADE")) for n in names}  # cycles and self references
    tables = {n: {i: {"to": rng.choice([None, *range(60)]), "up": rng.choice([None, None, *range(60)])} for i in range(60)} for n in names}
    deleted = {"a": [1, 2, 999], "c": [5]}
    frames = {n: spark.createDataFrame([(k, r["to"], r["up"]) for k, r in t.items()], "id long, to long, up long") for n, t in tables.items()}
    result = G.delete_over_graph(frames, specs, {n: spark.createDataFrame([(k,) for k in ks], "k long") for n, ks in deleted.items()})
    after, bad = brute(tables, specs, deleted)
    assert {r["constraint"] for r in result.rejected.collect()} == bad
    for n in names:
        assert {r["id"]: {"to": r["to"], "up": r["up"]} for r in result.tables[n].collect()} == after[n]
        if n in result.deleted:
            assert {r["id"] for r in result.deleted[n].collect()} == set(tables[n]) - set(after[n])


def test_long_chain_and_hot_parent(spark):
    specs = {"a": spec("a", ("up", "a", "CASCADE")), "b": spec("b", ("up", "a", "CASCADE"))}
    chain = spark.range(12).selectExpr("id", "0L to", "CASE WHEN id > 0 THEN id - 1 END up")
    many = spark.range(3000).selectExpr("id", "0L to", "CASE WHEN id % 3 = 0 THEN 11L ELSE 100L END up")
    result = G.delete_over_graph({"a": chain, "b": many}, specs, {"a": spark.createDataFrame([(4,)], "k long")})
    assert result.tables["a"].count() == 4 and result.tables["b"].count() == 2000


def test_restrict_looks_at_what_stays(spark):
    specs = {"a": spec("a"), "b": spec("b", ("to", "a", "RESTRICT"), ("up", "a", "CASCADE"))}
    a = spark.createDataFrame([(1, None, None), (2, None, None)], "id long, to long, up long")
    b = spark.createDataFrame([(1, 1, 1)], "id long, to long, up long")
    ok = G.delete_over_graph({"a": a, "b": b}, specs, {"a": spark.createDataFrame([(1,)], "k long")})
    assert ok.tables["b"].count() == 0 and ok.rejected.count() == 0
    with pytest.raises(ValueError):
        G.delete_over_graph({"a": a, "b": b}, {"a": spec("a"), "b": spec("b", ("id", "a", "SET NULL"))}, {})


@pytest.mark.parametrize("name,folders", [("prune_range_tuple", {"o2"}), ("prune_list", {"high", "__HIVE_DEFAULT_PARTITION__"}),
                                          ("prune_hash", {"2", "5", "8"}), ("prune_linear_hash", {"0", "1", "2"}), ("prune_subpartition", {"p2", "p3"})])
def test_only_the_labels_are_read(spark, name, folders):
    df = pruned_orders(spark, SF001, name)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*_part", plan)
    read = {m for f in df.inputFiles() for m in re.findall(r"_part=([^/]+)", f)}
    wanted = {f for f in read if f in folders}
    spec_, where, _ = PRUNED[name]
    got = P.label_set(spark.read.parquet(f"{SF001}/orders.parquet"), spec_, where)
    assert {str(x) for x in got.labels} | ({"__HIVE_DEFAULT_PARTITION__"} if got.unrouted else set()) == folders and wanted


KEYS = "a int, b string, d date"
CASES = [
    (S.PartitionSpec("range", columns=("a",), bounds=(0, 10, 20)), {"a": P.between(3, 12)}, {"p1", "p2"}, False),
    (S.PartitionSpec("range", columns=("a",), bounds=(0, 10, 20)), {"a": P.between(hi=-5)}, {"p0"}, False),
    (S.PartitionSpec("range", columns=("a",), bounds=(0, 10, 20)), {"a": P.between(lo=15)}, {"p2"}, True),
    (S.PartitionSpec("range", columns=("a",), bounds=(0, 10, None)), {"a": P.between(lo=10)}, {"p2"}, False),
    (S.PartitionSpec("range", columns=("d",), bounds=("2024-01-01", "2024-07-01", None)), {"d": P.between("2024-02-01", "2024-06-30")}, {"p1"}, False),
    (S.PartitionSpec("range", columns=("a", "b"), bounds=((5, "g"), (5, None), (7, "a"), (None, None))), {"a": P.equal(5)}, {"p0", "p1"}, True),
    (S.PartitionSpec("range", columns=("a", "b"), bounds=((5, "g"), (5, None), (7, "a"), (None, None))), {"a": P.equal(5), "b": P.between(lo="h")}, {"p1"}, False),
    (S.PartitionSpec("range", columns=("a", "b"), bounds=((5, "g"), (5, None), (7, "a"), (None, None))), {"b": P.equal("z")}, {"p0", "p1", "p2", "p3"}, True),
    (S.PartitionSpec("range", columns=("a", "b"), bounds=((5, "g"), (7, "a"))), {"a": P.among(1, 9)}, {"p0"}, True),
    (S.PartitionSpec("list", columns=("a",), lists=((1, 5), (9,), ("01", 11))), {"a": P.between(5, 10)}, {"p0", "p1"}, True),
    (S.PartitionSpec("list", columns=("a", "b"), lists=(((1, "x"), (2, "y")), ((2, "x"),))), {"a": P.between(2, 5000), "b": P.equal("x")}, {"p1"}, True),
    (S.PartitionSpec("list", columns=("a",), lists=((1, 5), (9,))), {"a": P.equal(9)}, {"p1"}, False),
    (S.PartitionSpec("key", columns=("a", "b"), count=4), {"a": P.equal(1)}, None, True),
    (S.PartitionSpec("hash", expr="a * 2", count=8), {"a": P.between(1, 3)}, {2, 4, 6}, False),
    (S.PartitionSpec("hash", expr="a", count=4), {"b": P.equal("x")}, None, True),
    (S.PartitionSpec("range", columns=("a",), bounds=(0,)), {"a": P.between("x", "y")}, None, True),
    (S.PartitionSpec("hash", expr="a", count=4), {"a": P.among()}, set(), False),
]


@pytest.mark.parametrize("p,where,labels,unrouted", CASES)
def test_label_sets(spark, p, where, labels, unrouted):
    got = P.label_set(spark.createDataFrame([], KEYS), p, where)
    assert (None if got.labels is None else set(got.labels)) == labels and (labels is None or got.unrouted == unrouted)


def test_pruning_never_changes_a_result(spark):
    rng = random.Random(1)
    rows = [(rng.choice([None, *range(-5, 30)]), rng.choice(["a", "g", "x", "z", None])) for _ in range(400)]
    df = spark.createDataFrame(rows, "a int, b string").selectExpr("a", "b", "DATE'2024-03-01' d")
    for p, where, _, _ in CASES:
        labelled = L.apply_partitioning(df, p)
        if any(isinstance(r.lo, str) and c == "a" for c, r in where.items()) or any(r.values == () for r in where.values()):
            continue
        plain = labelled
        for c, r in where.items():
            plain = plain.where(r.condition(plain[c]))
        assert P.with_pruning(labelled, p, where).count() == plain.count(), (p, where)


def test_first_declared_spelling_wins(spark):
    df = spark.createDataFrame([("1.00",), ("2",)], "v string").selectExpr("CAST(v AS DECIMAL(5,2)) v")
    out = L.partition_list(df, ["v"], [["1", "2.0"], ["1.0", "2"]], ["z", "a"])
    assert {r["_part"] for r in out.collect()} == {"z"}
