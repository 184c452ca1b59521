"""The streaming target survives writers that die, and its buckets grow one at a time."""

import glob
import json
import os

import pytest
from pyspark.sql import functions as F

from siltlake.operators import changes as C
from siltlake.session import put_new_file
from siltlake.sources import sinks as K
from siltlake.streaming import apply as A
from siltlake.streaming.apply import CommitContention, VersionedTable

SCHEMA = "pk long, seq long, op string, value double"


def batch(spark, k, n=40):
    return spark.createDataFrame([(i, k * 1000 + i, "update", float(k)) for i in range(n)], SCHEMA)


def rows(t):
    return sorted((r["pk"], r["value"]) for r in t.state().collect())


def entry(path, number):
    return f"{path}/_manifest/batch={number}/entries.json"


def cut(path, number, how):
    """The entry of a commit as a writer that died would leave it."""
    text = open(entry(path, number)).read()
    lines = text.splitlines(keepends=True)
    left = {"nothing": "", "half": text[:len(text) // 2], "all but the last row": "".join(lines[:-1]), "half of the last row": "".join(lines[:-1]) + lines[-1][:9]}[how]
    for crc in glob.glob(f"{os.path.dirname(entry(path, number))}/.entries*"):
        os.unlink(crc)
    with open(entry(path, number), "w") as f:
        f.write(left)
    return text


HOW = ["nothing", "half", "all but the last row", "half of the last row"]


@pytest.mark.parametrize("how", HOW)
def test_torn_commit_of_a_batch(spark, tmp_path, how):
    path = str(tmp_path / "t")
    t = VersionedTable(spark, path, buckets=4, writer="w")
    t.initialize(spark.range(40).selectExpr("id pk", "0L seq", "0.0D value"))
    t.apply_batch(batch(spark, 1), 1)
    whole = cut(path, 0, how)
    fresh = VersionedTable(spark, path, writer="w")
    assert {v for _, v in rows(fresh)} == {0.0} and not fresh.is_committed(1)  # the batch has not happened
    assert fresh.apply_batch(batch(spark, 1), 1) is True and fresh._snapshot()["last"] == 1
    assert {v for _, v in rows(fresh)} == {1.0}
    with open(entry(path, 0), "w") as f:  # should the rest turn up late, it stays passed over
        f.write(whole)
    assert VersionedTable(spark, path)._snapshot()["last"] == 1 and {v for _, v in rows(VersionedTable(spark, path))} == {1.0}
    other = VersionedTable(spark, path, writer="other")
    assert other.apply_batch(batch(spark, 2, 3), 0) is True and rows(t)[:4] == [(0, 2.0), (1, 2.0), (2, 2.0), (3, 1.0)]


@pytest.mark.parametrize("how", HOW)
def test_torn_commit_of_a_column(spark, tmp_path, how):
    path = str(tmp_path / "t")
    t = VersionedTable(spark, path, buckets=2)
    t.initialize(spark.range(5).selectExpr("id pk", "0L seq", "0.0D value"))
    t.add_column("origin", "string", "old")
    cut(path, 0, how)
    fresh = VersionedTable(spark, path)
    assert "origin" not in fresh.state().columns
    fresh.add_column("origin", "string", "again")
    assert {r["origin"] for r in VersionedTable(spark, path).state().collect()} == {"again"}


@pytest.mark.parametrize("how", HOW)
def test_torn_first_commit(spark, tmp_path, how):
    path = str(tmp_path / "t")
    first = spark.range(5).selectExpr("id pk", "0L seq", "0.0D value")
    VersionedTable(spark, path, buckets=2).initialize(first)
    cut(path, -1, how)
    fresh = VersionedTable(spark, path)
    with pytest.raises(ValueError):
        fresh.state()
    fresh.initialize(first)
    assert len(rows(fresh)) == 5


def test_dead_writer_between_folder_and_file(spark, tmp_path):
    path = str(tmp_path / "t")
    t = VersionedTable(spark, path, buckets=2)
    t.apply_batch(batch(spark, 1), 0)
    os.makedirs(f"{path}/_manifest/batch=1")
    open(f"{path}/_manifest/batch=1/.entries.json.dead.tmp", "w").write('{"bucket": 0, "ver')
    assert t.apply_batch(batch(spark, 2), 1) is True and t._snapshot()["last"] == 1
    assert {v for _, v in rows(t)} == {2.0}


def test_retries_are_bounded(spark, tmp_path, monkeypatch):
    t = VersionedTable(spark, str(tmp_path / "t"), buckets=1)
    t.apply_batch(batch(spark, 1, 2), 0)
    tries = []
    monkeypatch.setattr(VersionedTable, "_commit", lambda self, *a: bool(tries.append(a)))
    monkeypatch.setattr(A, "MAX_TRIES", 3)
    with pytest.raises(CommitContention):
        t.apply_batch(batch(spark, 2, 2), 1)
    assert len(tries) == 3


def test_orphans_are_swept_and_history_is_let_go(spark, tmp_path):
    path = str(tmp_path / "t")
    t = VersionedTable(spark, path, buckets=2)
    for k in range(6):
        t.apply_batch(batch(spark, k + 1), k)
        if k in (1, 3, 5):
            t.compact_manifest()
    for name in ("v=2-lostrace", "v=99-inflight"):
        os.makedirs(f"{path}/data/{name}/bucket=0")
    t.vacuum(keep_commits=1)
    left = sorted(os.listdir(f"{path}/data"))
    assert "v=99-inflight" in left and "v=2-lostrace" not in left and len(left) == 4  # those of snapshot 3, commits 4 and 5, and the one in flight
    assert sorted(os.listdir(f"{path}/_manifest")) == ["batch=4", "batch=5"]
    assert {v for _, v in rows(VersionedTable(spark, path))} == {6.0}
    assert t.vacuum(keep_commits=0) >= 0 and {v for _, v in rows(VersionedTable(spark, path))} == {6.0}


def test_new_file_never_replaces_and_is_never_partial(spark, tmp_path):
    path = str(tmp_path / "x" / "f.json")
    assert put_new_file(spark, path, "a\n") is True and put_new_file(spark, path, "b\n") is False
    assert open(path).read() == "a\n" and [n for n in os.listdir(tmp_path / "x") if n.endswith(".tmp")] == []


def test_growth_rewrites_split_buckets_only(spark, tmp_path):
    path = str(tmp_path / "t")
    t = VersionedTable(spark, path, buckets=4)
    t.initialize(spark.range(4000).selectExpr("id pk", "0L seq", "0.0D value"))
    t.apply_batch(batch(spark, 1), 0)
    before = {b: [r["dir"] for r in rows_] for b, rows_ in t._snapshot(refresh=True)["live"].items()}
    assert t.grow(7) == [0, 1, 2, 4, 5, 6]
    after = {b: [r["dir"] for r in rows_] for b, rows_ in t._snapshot(refresh=True)["live"].items()}
    assert after[3] == before[3] and all(after[b] != before[b] for b in (0, 1, 2)) and sorted(after) == list(range(7))
    fresh = VersionedTable(spark, path)
    assert fresh.buckets == 7 and fresh.state().count() == 4000
    for b, held in after.items():  # every row lies where the directory looks for it
        for name in held:
            df = spark.read.parquet(f"{path}/data/{name}/bucket={b}")
            assert df.where(fresh.bucket_of(7) != b).count() == 0
    stale = VersionedTable(spark, path)
    stale._cache = {**stale._snapshot(), "buckets": 4}  # a writer that has not seen the growth
    assert stale.apply_batch(batch(spark, 2), 0) is True and rows(fresh)[:40] == [(i, 2.0) for i in range(40)] and len(rows(fresh)) == 4000
    assert fresh.grow(3) == [] and t.grow(17) and t.state().count() == 4000 and t.buckets == 17


def test_growth_follows_the_rows(spark, tmp_path):
    t = VersionedTable(spark, str(tmp_path / "t"), buckets=2, rows_per_bucket=100)
    t.apply_batch(spark.range(350).selectExpr("id pk", "1L seq", "'insert' op", "1.0D value"), 0)
    assert t.buckets == 4 and t.state().count() == 350
    t.apply_batch(spark.range(300, 900).selectExpr("id pk", "2L seq", "'insert' op", "2.0D value"), 1)
    assert t.buckets >= 8 and t.state().count() == 900


def test_applied_set_reads_touched_blocks_only(spark, tmp_path):
    path, schema = str(tmp_path / "t"), SCHEMA + ", server string, txn long"
    t = VersionedTable(spark, path, buckets=1, track=("server", "txn"), block=10)

    def part(k, pairs):
        return spark.createDataFrame([(i, k * 100 + i, "update", 1.0, s, x) for i, (s, x) in enumerate(pairs)], schema)

    seen, batches = set(), [[("a", x) for x in (*range(1, 25), 30)] + [("b", 5)], [("a", 25), ("a", 3), ("b", 5)], [("a", x) for x in range(26, 30)] + [("b", 6), (None, 1)], [("c", None)]]
    for k, pairs in enumerate(batches):
        t.apply_batch(part(k, pairs), k)
        seen |= {p for p in pairs if p[1] is not None}
        want = sorted(map(tuple, C.applied_set(spark.createDataFrame(list(seen), "server string, txn long"), "server", "txn").collect()), key=str)
        assert sorted(map(tuple, VersionedTable(spark, path).applied().collect()), key=str) == want
    assert "server" not in t.state().columns
    second = [json.loads(x) for x in open(entry(path, 1))]
    assert sum(r["rows"] for r in second if r["bucket"] >= A.APPLIED and r["delta"]) <= 3
    assert t.apply_batch(part(9, [("z", 1)]), 2) is False and t.applied().where("server = 'z'").count() == 0
    with pytest.raises(ValueError):
        VersionedTable(spark, path, track=("other", "txn"))


def test_schema_publishers_do_not_undo_each_other(spark, tmp_path):
    root = str(tmp_path / "s")
    one, two = spark.range(3), spark.range(5)
    assert K.publish_schema({"a": one, "b": one}, root) == 1
    assert K.publish_schema({"c": two}, root) == 2
    with pytest.raises(K.RejectedTables) as e:
        K.publish_schema({"a": two, "b": two}, root, gates={"b": lambda df: False})
    assert e.value.names == ["b"]
    assert {n: t.count() for n, t in K.published_tables(spark, root).items()} == {"a": 3, "b": 3, "c": 5}
    assert K.publish_schema({"a": two}, root, drop=["c"]) == 3
    assert {n: t.count() for n, t in K.published_tables(spark, root).items()} == {"a": 5, "b": 3}
    assert {n: t.count() for n, t in K.published_tables(spark, root, 2).items()} == {"a": 3, "b": 3, "c": 5}
    gone = K.sweep_schema(spark, root, keep=1)
    assert len(gone) >= 3 and {n: t.count() for n, t in K.published_tables(spark, root).items()} == {"a": 5, "b": 3}
    with pytest.raises(ValueError):
        K.published_tables(spark, root, 2)
