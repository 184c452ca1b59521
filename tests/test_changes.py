"""Change-data properties: replay, shuffled arrival, stream = batch, islands."""

import random

from pyspark.sql import functions as F

from table_dirs import SF001
from siltlake.operators import changes as C
from siltlake.plans import fixtures as X


def _state(df):
    return sorted(tuple(r) for r in df.collect())


def test_replay_changes_nothing(spark):
    log = X.changelog(spark, SF001)
    once = C.latest_state(log)
    twice = C.latest_state(log.unionByName(log).unionByName(log.where(F.col("seq") % 2 == 0)))
    assert _state(once) == _state(twice)


def test_apply_is_idempotent_and_order_free(spark):
    base = X.base_users(spark, SF001)
    log = X.changelog(spark, SF001).select("pk", "seq", "op", "value")
    full = C.apply_changes(base, log, keep_tombstones=True)
    # apply in three slices in reverse seq order, re-applying the middle one
    s = [log.where(F.col("seq") % 3 == i) for i in range(3)]
    step = base
    for part in (s[2], s[1], s[0], s[1]):
        step = C.apply_changes(step, part, keep_tombstones=True)
    assert _state(full) == _state(step)


def test_tombstone_blocks_late_insert(spark):
    t = spark.createDataFrame([(1, 5, 1.0)], "pk long, seq long, value double")
    d = spark.createDataFrame([(1, 9, "delete", None)], "pk long, seq long, op string, value double")
    late = spark.createDataFrame([(1, 7, "insert", 2.0)], "pk long, seq long, op string, value double")
    after_delete = C.apply_changes(t, d, keep_tombstones=True)
    out = C.apply_changes(after_delete, late, keep_tombstones=True).collect()
    assert out[0]["_deleted"] is True and out[0]["seq"] == 9
    assert C.apply_changes(after_delete, late).count() == 0


def _brute_islands(pairs):
    out = []
    by = {}
    for s, t in pairs:
        by.setdefault(s, set()).add(t)
    for s, ts in by.items():
        ts = sorted(ts)
        lo = prev = ts[0]
        for t in ts[1:]:
            if t != prev + 1:
                out.append((s, lo, prev, prev - lo + 1))
                lo = t
            prev = t
        out.append((s, lo, prev, prev - lo + 1))
    return sorted(out)


def test_applied_set_matches_brute_force_across_blocks(spark):
    rnd = random.Random(3)
    pairs = [("a", t) for t in range(0, 300) if rnd.random() < 0.8] + [("b", t) for t in range(60, 200)] + \
            [("c", 1000)]
    df = spark.createDataFrame(pairs, "server_uuid string, txn_no long")
    for block in (7, 16, 64, 1 << 20):
        got = sorted(tuple(r) for r in C.applied_set(df, block=block).collect())
        assert got == _brute_islands(pairs), block
        gaps = sorted(tuple(r) for r in C.gaps(C.applied_set(df, block=block), block=block).collect())
        isl = _brute_islands(pairs)
        want = sorted((s, a[2] + 1, b[1] - 1, b[1] - a[2] - 1)
                      for s in "abc" for a, b in zip([i for i in isl if i[0] == s], [i for i in isl if i[0] == s][1:]))
        assert gaps == want, block


def test_interval_text(spark):
    df = spark.createDataFrame([("u", t) for t in (1, 2, 3, 5, 7, 8)], "server_uuid string, txn_no long")
    rows = C.interval_text(C.applied_set(df)).collect()
    assert [(r["server_uuid"], r["chunk"], r["text"]) for r in rows] == [("u", 0, "1-3:5:7-8")]
    chunks = sorted((r["chunk"], r["text"]) for r in C.interval_text(C.applied_set(df, block=4), block=4).collect())
    assert "u:" + ":".join(t for _, t in chunks) == "u:1-3:5:7-8"


def test_row_diff_and_flatten(spark):
    im = spark.createDataFrame([(1, 1, "a", 1.0, "a", 2.0), (2, 1, "a", 1.0, "a", 1.0)],
                               "seq long, pk long, before_t string, before_v double, after_t string, after_v double")
    d = {r["seq"]: (r["changed_columns"], r["_noop"]) for r in C.row_diff(im, ["t", "v"]).collect()}
    assert d == {1: (["v"], False), 2: ([], True)}
    f = C.flatten_changes(im, ["t", "v"]).collect()
    assert [(r["seq"], r["column"], r["before"], r["after"]) for r in f] == [(1, "v", "1.0", "2.0")]


def test_stream_apply_equals_batch(spark):
    from siltlake.plans.q_stream import _stream_state
    streamed = _stream_state(spark, SF001, buckets=4).state().select("pk", "seq", "value")
    batch = C.apply_changes(X.base_users(spark, SF001), X.changelog_replayed(spark, SF001),
                            columns=["value"]).select("pk", "seq", "value")
    assert _state(streamed) == _state(batch)


def test_versioned_table_retry_is_noop(spark, tmp_path):
    from siltlake.streaming.apply import VersionedTable
    t = VersionedTable(spark, str(tmp_path / "t"), buckets=4)
    t.initialize(spark.createDataFrame([(1, 0, 1.0), (2, 0, 2.0)], "pk long, seq long, value double"))
    ch = spark.createDataFrame([(1, 5, "update", 9.0), (2, 6, "delete", None), (3, 7, "insert", 3.0)],
                               "pk long, seq long, op string, value double")
    assert t.apply_batch(ch, 0) is True
    assert t.apply_batch(ch, 0) is False  # retried batch id
    older = spark.createDataFrame([(1, 2, "update", -1.0)], "pk long, seq long, op string, value double")
    t.apply_batch(older, 1)
    assert sorted((r["pk"], r["value"]) for r in t.state().collect()) == [(1, 9.0), (3, 3.0)]
    # schema evolution: a new column in the stream widens the target
    wide = spark.createDataFrame([(3, 8, "update", 4.0, "x")], "pk long, seq long, op string, value double, note string")
    t.apply_batch(wide, 2)
    assert {r["pk"]: r["note"] for r in t.state().collect()} == {1: None, 3: "x"}


def test_audit_counts_duplicates_and_gaps(spark):
    im = spark.createDataFrame([
        ("s", 1, 1, "insert", None, "a"), ("s", 1, 1, "insert", None, "a"),
        ("s", 4, 2, "update", None, "b"), ("s", 5, 3, "delete", "b", None)],
        "server_uuid string, txn_no long, seq long, op string, before_x string, after_x string")
    r = C.change_log_audit(im, ["x"]).first()
    assert (r["n_events"], r["duplicate_events"], r["missing_before_image"], r["missing_after_image"],
            r["missing_txn"]) == (4, 1, 1, 0, 2)


def test_stream_dedup_within_watermark(spark, tmp_path):
    """T8 on a stream: replays of an event identity are dropped; the delay
    covers the files' disorder, so no row is late."""
    log = X.changelog(spark, SF001).select("server_uuid", "txn_no", "seq", "ts", "pk", "op")
    src = str(tmp_path / "log")
    log.unionByName(log.where(F.col("seq") % 4 == 1)).repartition(3).write.parquet(src)
    stream = spark.readStream.schema(log.schema).option("maxFilesPerTrigger", 1).parquet(src)
    q = (C.dedup_changes(stream, watermark=("ts", "36500 days")).writeStream.format("memory")
         .queryName("dedup_out").option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start())
    q.awaitTermination()
    assert spark.table("dedup_out").count() == log.count()


def test_evolve_adds_column_with_default(spark):
    from siltlake import spec as S
    t = spark.createDataFrame([(1, 0, 1.0)], "pk long, seq long, value double")
    w = C.evolve(t, [S.ColumnSpec("note", "varchar", default="n/a")], after="pk")
    assert w.columns == ["pk", "note", "seq", "value"] and w.first()["note"] == "n/a"


def test_on_update_timestamp_and_tombstone_compaction(spark):
    import datetime as dt
    t = spark.createDataFrame([(1, 1, 5.0, dt.datetime(2020, 1, 1))], "pk long, seq long, value double, updated timestamp_ntz")
    ch = spark.createDataFrame([(1, 4, "update", 6.0, dt.datetime(2024, 5, 6, 7, 8, 9)),
                                (2, 3, "delete", None, dt.datetime(2024, 1, 1))],
                               "pk long, seq long, op string, value double, ts timestamp_ntz")
    out = C.apply_changes(t, ch, columns=["value", "updated"], updated_at=("updated", "ts"), keep_tombstones=True)
    rows = {r["pk"]: r for r in out.collect()}
    assert rows[1]["updated"] == dt.datetime(2024, 5, 6, 7, 8, 9) and rows[1]["value"] == 6.0
    assert rows[2]["_deleted"] is True
    assert C.compact_tombstones(out, 10).count() == 1 and C.compact_tombstones(out, 2).count() == 2


def test_flatten_same_code_on_stream(spark, tmp_path):
    im = X.changelog_images(spark, SF001)
    src = str(tmp_path / "im")
    im.write.parquet(src)
    stream = spark.readStream.schema(im.schema).parquet(src)
    q = (C.flatten_changes(stream, ["type", "value"]).writeStream.format("memory").queryName("flat_out")
         .option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start())
    q.awaitTermination()
    assert spark.table("flat_out").count() == C.flatten_changes(im, ["type", "value"]).count()


def test_spec_on_update_column(spark):
    import datetime as dt
    from siltlake import spec as S
    spec = S.TableSpec("t", (S.ColumnSpec("pk", "bigint"), S.ColumnSpec("value", "double"),
                             S.ColumnSpec("modified", "datetime", on_update_now=True)))
    t = spark.createDataFrame([(1, 1, 5.0, dt.datetime(2020, 1, 1))], "pk long, seq long, value double, modified timestamp_ntz")
    ch = spark.createDataFrame([(1, 4, "update", 6.0, dt.datetime(2024, 5, 6))],
                               "pk long, seq long, op string, value double, ts timestamp_ntz")
    r = C.apply_changes(t, ch, spec=spec).first()
    assert r["modified"] == dt.datetime(2024, 5, 6) and r["value"] == 6.0


def test_manifest_compaction(spark, tmp_path):
    from siltlake.streaming.apply import VersionedTable
    t = VersionedTable(spark, str(tmp_path / "t"), buckets=4)
    t.initialize(spark.createDataFrame([(1, 0, 1.0), (2, 0, 2.0)], "pk long, seq long, value double"))
    for b in range(3):
        t.apply_batch(spark.createDataFrame([(b + 1, 10 + b, "update", float(b))],
                                            "pk long, seq long, op string, value double"), b)
    before = sorted(tuple(r) for r in t.state().collect())
    assert t.compact_manifest() == 2
    t.apply_batch(spark.createDataFrame([(9, 50, "insert", 9.0)], "pk long, seq long, op string, value double"), 3)
    reader = VersionedTable(spark, str(tmp_path / "t"), buckets=4)  # a fresh process
    assert reader._manifest().count() <= 4 + 1 + 2  # snapshot rows + one later batch
    assert sorted(tuple(r) for r in reader.state().collect()) == sorted(before + [(9, 50, 9.0)])
    assert reader.is_committed(3) and not reader.is_committed(4)
    from siltlake.streaming.apply import vacuum_plan
    stale = {(r["version"], r["bucket"]) for r in vacuum_plan(reader).collect()}
    assert stale and all(v < 3 for v, _ in stale)


def test_stream_resumes_from_checkpoint(spark, tmp_path):
    """Stop after part of the log, add more files, restart on the same
    checkpoint: each file is applied once and the state equals the batch one."""
    from siltlake.sources.snapshot import read_changes
    from siltlake.streaming.apply import VersionedTable, apply_stream
    log = X.changelog(spark, SF001).select("pk", "seq", "op", "value")
    src = str(tmp_path / "log")
    halves = [log.where(F.col("seq") % 2 == i) for i in (1, 0)]  # second half holds older and newer events
    halves[0].write.parquet(src + "/part=a")
    target = VersionedTable(spark, str(tmp_path / "t"), buckets=4)
    base = X.base_users(spark, SF001)
    target.initialize(base)
    ck = str(tmp_path / "ck")
    schema = "pk long, seq long, op string, value double"
    apply_stream(read_changes(spark, src, schema, stream=True, max_files_per_trigger=2), target, ck).awaitTermination()
    halves[1].write.parquet(src + "/part=b")
    restarted = VersionedTable(spark, str(tmp_path / "t"), buckets=4)  # a new driver process
    apply_stream(read_changes(spark, src, schema, stream=True, max_files_per_trigger=2), restarted, ck).awaitTermination()
    want = C.apply_changes(base, log, columns=["value"]).select("pk", "seq", "value")
    assert _state(restarted.state().select("pk", "seq", "value")) == _state(want)


def test_versioned_tombstone_retention(spark, tmp_path):
    from siltlake.streaming.apply import VersionedTable
    t = VersionedTable(spark, str(tmp_path / "t"), buckets=2, tombstone_retention=100)
    t.initialize(spark.createDataFrame([(1, 0, 1.0), (2, 0, 2.0)], "pk long, seq long, value double"))
    t.apply_batch(spark.createDataFrame([(1, 10, "delete", None)], "pk long, seq long, op string, value double"), 0)
    assert sorted(r["pk"] for r in t.state(with_tombstones=True).collect()) == [1, 2]
    # a much later batch rewrites every bucket: the old tombstone is past retention
    t.apply_batch(spark.createDataFrame([(k, 500, "update", 5.0) for k in range(3, 20)],
                                        "pk long, seq long, op string, value double"), 1)
    tomb = t.state(with_tombstones=True).where("_deleted")
    assert tomb.count() == 0 and t.state().count() == 18


def test_versioned_empty_batch(spark, tmp_path):
    from siltlake.streaming.apply import VersionedTable
    t = VersionedTable(spark, str(tmp_path / "t"), buckets=2, tombstone_retention=10)
    t.initialize(spark.createDataFrame([(1, 0, 1.0)], "pk long, seq long, value double"))
    empty = spark.createDataFrame([], "pk long, seq long, op string, value double")
    assert t.apply_batch(empty, 0) is True and t.is_committed(0)
    assert [tuple(r) for r in t.state().collect()] == [(1, 0, 1.0)]
