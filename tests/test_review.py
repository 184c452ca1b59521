"""Faults that earlier versions had, each on a small input."""

import struct

import pytest
from pyspark.sql import functions as F

from siltlake import spec as S
from siltlake.functions.columns import key_label
from siltlake.functions.spatial import wkb_to_wkt, wkb_to_wkt_value
from siltlake.operators import changes as C
from siltlake.operators import layout as L
from siltlake.operators import normalize as N
from siltlake.operators import quality as Q
from siltlake.operators import relational as R
from siltlake.sources.snapshot import jdbc_query
from siltlake.streaming.apply import VersionedTable, vacuum_plan, wider_type

SCHEMA = "pk long, seq long, op string, value double"


def rows(t):
    return sorted((r["pk"], r["value"]) for r in t.state().collect())


def test_new_writer_with_an_old_batch_id_is_applied(spark, tmp_path):
    path = str(tmp_path / "t")
    t = VersionedTable(spark, path, buckets=4)
    t.apply_batch(spark.createDataFrame([(1, 1, "insert", 1.0)], SCHEMA), 0)
    t.apply_batch(spark.createDataFrame([(2, 2, "insert", 2.0)], SCHEMA), 1)
    other = VersionedTable(spark, path)
    assert other.apply_batch(spark.createDataFrame([(3, 3, "insert", 3.0)], SCHEMA), 0) is True
    assert other.apply_batch(spark.createDataFrame([(3, 9, "insert", 9.0)], SCHEMA), 0) is False
    assert rows(t) == [(1, 1.0), (2, 2.0), (3, 3.0)]


def test_stale_writer_redoes_its_batch(spark, tmp_path):
    """Both handles read the same commit; the later one must not undo the earlier."""
    path = str(tmp_path / "t")
    a, b = VersionedTable(spark, path, buckets=1), VersionedTable(spark, path)
    a.initialize(spark.createDataFrame([(1, 0, 0.0)], "pk long, seq long, value double"))
    seen = b._snapshot(refresh=True)
    a.apply_batch(spark.createDataFrame([(2, 1, "insert", 2.0)], SCHEMA), 0)
    change = C.latest_state(spark.createDataFrame([(3, 1, "insert", 3.0)], SCHEMA), keep_deletes=True).withColumn("_deleted", F.lit(False)).drop("op")
    assert b._apply(change, {0: 1}, None, seen, 0) is False  # its number is taken
    assert b.apply_batch(spark.createDataFrame([(3, 1, "insert", 3.0)], SCHEMA), 0) is True
    assert rows(a) == [(1, 0.0), (2, 2.0), (3, 3.0)]


def test_bucket_count_and_keys_are_stored(spark, tmp_path):
    path = str(tmp_path / "t")
    t = VersionedTable(spark, path, buckets=4)
    t.initialize(spark.range(50).selectExpr("id pk", "0L seq", "0.0D value"))
    with pytest.raises(ValueError):
        VersionedTable(spark, path, buckets=6)
    with pytest.raises(ValueError):
        VersionedTable(spark, path, key="other")
    again = VersionedTable(spark, path)
    again.apply_batch(spark.createDataFrame([(7, 5, "update", 1.0)], SCHEMA), 0)
    assert again.buckets == 4 and again.state().count() == 50


def test_maps_are_carried(spark, tmp_path):
    t = VersionedTable(spark, str(tmp_path / "t"), buckets=2)
    for k in range(2):
        t.apply_batch(spark.createDataFrame([(1, k, "update", {"a": str(k)})], "pk long, seq long, op string, _rescued map<string,string>"), k)
    assert t.state().first()["_rescued"] == {"a": "1"}


def test_types_widen_and_never_narrow(spark, tmp_path):
    path = str(tmp_path / "t")
    t = VersionedTable(spark, path, buckets=2)
    t.apply_batch(spark.createDataFrame([(1, 1, "insert", 5)], "pk long, seq long, op string, n int"), 0)
    t.apply_batch(spark.createDataFrame([(2, 2, "insert", 1 << 40)], "pk long, seq long, op string, n long"), 1)
    fresh = VersionedTable(spark, path)
    assert sorted((r["pk"], r["n"]) for r in fresh.state().collect()) == [(1, 5), (2, 1 << 40)]
    with pytest.raises(ValueError):
        t.apply_batch(spark.createDataFrame([(2, 3, "insert", "x")], "pk long, seq long, op string, n string"), 2)
    t.apply_batch(spark.createDataFrame([(1, 4, "update", 6)], "pk long, seq long, op string, n int"), 2)
    t.add_column("origin", "string", "old")
    assert sorted(map(tuple, VersionedTable(spark, path).state().collect())) == [(1, 4, 6, "old"), (2, 2, 1 << 40, "old")]
    assert wider_type("c", S.T.DecimalType(5, 2), S.T.DecimalType(8, 0)) == S.T.DecimalType(10, 2)


def test_small_batches_write_deltas_that_compact(spark, tmp_path):
    t = VersionedTable(spark, str(tmp_path / "t"), buckets=2)
    t.initialize(spark.range(1000).selectExpr("id pk", "0L seq", "0.0D value"))
    for k in range(12):
        t.apply_batch(spark.createDataFrame([(k, k + 1, "update", float(k))], SCHEMA), k)
    live = t._snapshot(refresh=True)["live"]
    assert any(len(r) > 1 for r in live.values()) and all(len(r) <= 9 for r in live.values())
    t.apply_batch(spark.range(1000).selectExpr("id pk", "100L seq", "'update' op", "1.0D value"), 12)
    assert all(len(r) == 1 for r in t._snapshot(refresh=True)["live"].values())
    assert {v for _, v in rows(t)} == {1.0}
    stale = vacuum_plan(t).count()
    assert stale and t.vacuum(keep_commits=0) == stale and t.state().count() == 1000


def test_on_update_timestamp_in_the_target(spark, tmp_path):
    t = VersionedTable(spark, str(tmp_path / "t"), buckets=1, updated_at=("modified", "ts"))
    t.apply_batch(spark.sql("select 1L pk, 1L seq, 'update' op, timestamp'2024-05-06 00:00:00' ts"), 0)
    assert str(t.state().first()["modified"]) == "2024-05-06 00:00:00"


@pytest.mark.parametrize("n", [12, 602])
def test_list_members_declared_twice(spark, n):
    lists = [list(range(n // 2)), [0, 1, *range(n // 2, n)]]
    out = L.partition_list(spark.createDataFrame([(0,), (1,), (n - 1,), (n,), (None,)], "v int"), "v", lists)
    assert sorted(map(tuple, out.collect()), key=str) == sorted([(0, "p0"), (1, "p0"), (n - 1, "p1"), (n, None), (None, None)], key=str)
    pairs = L.partition_list(spark.createDataFrame([("a", 1), ("b", 2)], "x string, y int"), ["x", "y"], [[("a", 1)], [("a", 1), ("b", 2)]])
    assert sorted(r["_part"] for r in pairs.collect()) == ["p0", "p1"]


def test_null_keys_have_no_partition(spark):
    df = spark.createDataFrame([(None, "a"), ("a", None), ("a", "b")], "x string, y string")
    assert [r[0] is None for r in df.select(key_label(["x", "y"], 4)).collect()] == [True, True, False]


def test_bad_geometry_is_null(spark):
    def line(*v):
        return struct.pack("<BII", 1, 2, len(v) // 2) + struct.pack(f"<{len(v)}d", *v)

    deep = struct.pack("<BI", 1, 1) + struct.pack("<2d", 1, 2)
    for _ in range(3000):
        deep = struct.pack("<BII", 1, 7, 1) + deep
    point = struct.pack("<BI2d", 1, 1, 1.5, 2)
    values = [line(1.0, float("nan")), line(float("inf"), 1.0), deep, struct.pack("<BI2d", 1, 1, float("inf"), 2), point, None, b""]
    df = spark.createDataFrame([(i, None if v is None else bytearray(v)) for i, v in enumerate(values)], "i int, b binary")
    got = [r["w"] for r in df.select("i", wkb_to_wkt("b").alias("w")).orderBy("i").collect()]
    assert got == [None, None, None, None, "POINT(1.5 2)", None, None]
    assert wkb_to_wkt_value(point) == "POINT(1.5 2)"


def test_metadata_keeps_member_case_and_reads_modifiers():
    c = S.column_from_metadata({"column_name": "s", "data_type": "enum", "column_type": "enum('New','Paid','unsigned','zerofill')"})
    assert c.members == ("New", "Paid", "unsigned", "zerofill") and not c.unsigned and not c.zerofill
    assert S.column_from_metadata({"column_name": "n", "data_type": "int", "column_type": "INT(4) UNSIGNED ZEROFILL"}).unsigned


def test_rekeys_given_twice(spark):
    child = spark.createDataFrame([(1, 10), (2, 20)], "id int, ref int")
    twice = spark.createDataFrame([(10, 11), (10, 11)], "a int, b int")
    out, _ = R.apply_parent_changes(child, ["ref"], rekeyed=twice, on_update="CASCADE")
    assert sorted(map(tuple, out.collect())) == [(1, 11), (2, 20)]
    with pytest.raises(ValueError):
        R.apply_parent_changes(child, ["ref"], rekeyed=spark.createDataFrame([(10, 11), (10, 12)], "a int, b int"), on_update="CASCADE")


def test_all_null_image_with_a_presence_flag(spark):
    im = spark.createDataFrame([("s", 1, 1, "insert", None, False, None, True), ("s", 2, 2, "update", None, True, None, True),
                                ("s", 3, 3, "delete", None, False, None, False)],
                               "server_uuid string, txn_no long, seq long, op string, before_x string, before_present boolean, after_x string, after_present boolean")
    r = C.change_log_audit(im, ["x"]).first()
    assert (r["missing_before_image"], r["missing_after_image"]) == (1, 0)


def test_now_is_a_default_of_dates_only():
    assert "now()" in N.default_value(S.ColumnSpec("a", "varchar", default="now()"))._jc.toString()


def test_set_domain_by_text(spark):
    df = spark.createDataFrame([(1, "a,b"), (2, "a,x"), (2, "a,x"), (3, ""), (4, None)], "id int, s string")
    bad = Q.domain_violations_join(df, "s", spark.createDataFrame([("a",), ("b",)], "member string"), is_set=True)
    assert sorted(r["id"] for r in bad.collect()) == [2, 2]


def test_jdbc_text(spark):
    spec = S.TableSpec("t", (S.ColumnSpec("id", "int"), S.ColumnSpec("flags", "bit", length=8), S.ColumnSpec('a"b', "varchar", length=5)))
    sql = jdbc_query(spec, "shop.t", split="id", quote='"')
    assert sql == ('SELECT CAST("id" AS CHAR) AS "id", CAST(CAST("flags" AS UNSIGNED) AS CHAR) AS "flags", '
                   'CAST("a""b" AS CHAR) AS "a""b", "id" AS "_split" FROM shop.t')


@pytest.mark.parametrize("block", [1, 3, 1 << 20])
def test_previous_row_by_blocks(spark, block):
    df = spark.createDataFrame([(k, s, s * 10) for k in (1, 2) for s in (0, 1, 5, 6, 20)], "pk int, seq long, v long")
    got = sorted((r["pk"], r["seq"], r["old"]) for r in C.with_previous(df, {"v": "old"}, block=block).collect())
    assert got == [(k, s, o) for k in (1, 2) for s, o in ((0, None), (1, 0), (5, 10), (6, 50), (20, 60))]


@pytest.mark.parametrize("block", [2, 64])
def test_islands_and_gaps_with_small_blocks(spark, block):
    df = spark.createDataFrame([("a", t) for t in [*range(1, 10), *range(12, 300), 500]], "server_uuid string, txn_no long")
    islands = C.applied_set(df, block=block)
    assert sorted(tuple(r)[1:3] for r in islands.collect()) == [(1, 9), (12, 299), (500, 500)]
    assert sorted(tuple(r)[1:] for r in C.gaps(islands, block=block).collect()) == [(10, 11, 2), (300, 499, 200)]


def test_checkpoint_folder_off_local():
    from siltlake.session import checkpoint_dir

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        class conf:
            @staticmethod
            def get(name, default=None):
                return default

    with pytest.raises(ValueError):
        checkpoint_dir(Session())
