"""Edge values of the loose contract: zero dates, quotes, literal NULL, ranges, bits, WKB."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from siltlake import spec as S
from siltlake.functions import csv_line, wkb_to_wkt_value, zerofill
from siltlake.operators import normalize as N

SPEC = S.TableSpec("t", (
    S.ColumnSpec("d", "date"),
    S.ColumnSpec("ts", "datetime"),
    S.ColumnSpec("i", "tinyint"),
    S.ColumnSpec("u", "tinyint", unsigned=True),
    S.ColumnSpec("m", "mediumint"),
    S.ColumnSpec("b", "bit", length=5),
    S.ColumnSpec("ok", "bool"),
    S.ColumnSpec("p", "decimal", precision=5, scale=2),
    S.ColumnSpec("tm", "time"),
    S.ColumnSpec("y", "year"),
    S.ColumnSpec("tags", "set", members=("a", "b")),
))


def test_loosen_never_fails_and_rescues(spark):
    rows = [
        ("0000-00-00", "0000-00-00 00:00:00", "127", "255", "8388607", "31", "1", "123.45", "-838:59:59", "2155", "a,b"),
        ("2024-02-30", "2024-01-05 10:00:00", "128", "-1", "8388608", "32", "yes?", "12345.6", "12:61:00", "1900", ""),
        (None, None, None, None, None, None, None, None, None, None, None),
    ]
    df = spark.createDataFrame(rows, [c.name for c in SPEC.columns])
    out = N.loosen(df, SPEC).collect()
    a, b, c = out
    assert a["d"] is None and a["ts"] is None and a["_rescued"] == {}  # zero dates are NULL, not rescued
    assert a["i"] == 127 and a["u"] == 255 and a["m"] == 8388607 and a["b"] == 31 and a["ok"] is True
    assert a["p"] == Decimal("123.45") and a["y"] == 2155 and a["tags"] == ["a", "b"]
    assert a["tm"] == -dt.timedelta(hours=838, minutes=59, seconds=59)
    assert b["ts"] == dt.datetime(2024, 1, 5, 10, 0)
    assert b["i"] is None and b["u"] is None and b["m"] is None and b["b"] is None and b["tm"] is None
    assert set(b["_rescued"]) == {"d", "i", "u", "m", "b", "ok", "p", "tm", "y"}
    assert b["_rescued"]["i"] == "128" and b["tags"] == []
    assert c["_rescued"] == {}


def test_csv_line_null_vs_text_null(spark):
    df = spark.createDataFrame([("NULL", None, '"NULL"', "", "a\nb", 'say "hi"')], "a string, b string, c string, d string, e string, f string")
    line = df.select(csv_line(*df.columns).alias("l")).first()["l"]
    assert line == '"NULL",NULL,"""NULL""","","a\nb","say ""hi"""'


def test_bits_and_hex(spark):
    df = spark.createDataFrame([(bytes.fromhex("01FF"), bytes.fromhex("FFFFFFFFFFFFFFFF"), b"\x00\xab")],
                               "b1 binary, b2 binary, h binary")
    spec = S.TableSpec("x", (S.ColumnSpec("b1", "bit", length=9), S.ColumnSpec("b2", "bit", length=64),
                             S.ColumnSpec("h", "varbinary")))
    r = N.normalize(df, spec).first()
    assert r["b1"] == Decimal(511) and r["b2"] == Decimal(18446744073709551615) and r["h"] == "00AB"


def test_wkb_decoder():
    point = bytes.fromhex("010100000000000000000031400000000000001C40")
    assert wkb_to_wkt_value(point) == "POINT(17 7)"
    assert wkb_to_wkt_value(bytes.fromhex("E6100000") + point) == "POINT(17 7)"
    assert wkb_to_wkt_value(point[:-3]) is None
    import struct as st
    line = st.pack("<BII", 1, 2, 2) + st.pack("<dddd", 0, 0, 1, 1.5)
    assert wkb_to_wkt_value(line) == "LINESTRING(0 0,1 1.5)"
    big_endian = st.pack(">BI", 0, 1) + st.pack(">dd", -2.5, 3)
    assert wkb_to_wkt_value(big_endian) == "POINT(-2.5 3)"
    # MULTIPOLYGON with one square (the kind a fixed list once forgot)
    ring = [(0, 0), (1, 0), (1, 1), (0, 0)]
    import struct
    poly = struct.pack("<BII", 1, 3, 1) + struct.pack("<I", len(ring)) + b"".join(struct.pack("<dd", *p) for p in ring)
    mp = struct.pack("<BII", 1, 6, 1) + poly
    assert wkb_to_wkt_value(mp) == "MULTIPOLYGON(((0 0,1 0,1 1,0 0)))"


def test_zerofill_never_truncates(spark):
    df = spark.createDataFrame([(5,), (123456789,)], "x long")
    assert [r[0] for r in df.select(zerofill("x", 4)).collect()] == ["0005", "123456789"]


def test_fill_defaults_keeps_explicit_null(spark):
    spec = S.TableSpec("t", (S.ColumnSpec("a", "int"), S.ColumnSpec("b", "int", default=2),
                             S.ColumnSpec("c", "varchar", default="foo")))
    df = spark.createDataFrame([(1, None)], "a int, b int")
    r = N.fill_defaults(df, spec).first()
    assert r["b"] is None and r["c"] == "foo"


def test_assign_ids_dense_with_hot_key(spark):
    # a third of the rows share one order value: ids stay dense and ordered
    df = spark.range(0, 3000).select(F.when(F.col("id") % 3 == 0, 5).otherwise(F.col("id")).alias("k"),
                                     F.col("id").alias("tb")).repartition(7)
    out = N.assign_ids(df, ["k"], start=1, tiebreak=["tb"]).orderBy("id").collect()
    ids = [r["id"] for r in out]
    assert ids == list(range(1, 3001))
    keys = [(r["k"], r["tb"]) for r in out]
    assert keys == sorted(keys)


def test_add_columns_positions(spark):
    df = spark.createDataFrame([(1, "x")], "a int, b string")
    out = N.add_columns(df, [S.ColumnSpec("z", "int", default=0)], after="a")
    assert out.columns == ["a", "z", "b"]
    assert N.add_columns(df, [S.ColumnSpec("z", "int")], first=True).columns == ["z", "a", "b"]


def test_spatial_rescue(spark):
    good = bytes.fromhex("010100000000000000000031400000000000001C40")
    df = spark.createDataFrame([(1, good), (2, good[:7]), (3, None)], "id int, g binary")
    spec = S.TableSpec("p", (S.ColumnSpec("id", "int"), S.ColumnSpec("g", "point")))
    rows = {r["id"]: (r["g"], r["_rescued"]) for r in N.normalize(df, spec, rescued="_rescued").collect()}
    # normalize spells every non-special column as text, ids included
    assert rows["1"] == ("POINT(17 7)", {}) and rows["2"] == (None, {"g": good[:7].hex().upper()})
    assert rows["3"] == (None, {})


def test_loosen_keeps_source_metadata(spark):
    spec = S.TableSpec("t", (S.ColumnSpec("u", "int", unsigned=True), S.ColumnSpec("e", "enum", members=("a", "b"))))
    out = N.loosen(spark.createDataFrame([("1", "a")], "u string, e string"), spec)
    assert out.schema["u"].metadata == {"source_type": "int", "unsigned": True}
    assert out.schema["e"].metadata["members"] == ["a", "b"]
    assert str(out.schema["u"].dataType) == "LongType()"


def test_assign_auto_increment_from_spec(spark):
    spec = S.TableSpec("t", (S.ColumnSpec("id", "int", auto_increment=True), S.ColumnSpec("name", "varchar")),
                       auto_increment_start=100)
    df = spark.createDataFrame([("b",), ("a",), ("c",)], "name string")
    out = {r["name"]: r["id"] for r in N.assign_auto_increment(df, spec, ["name"]).collect()}
    assert out == {"a": 100, "b": 101, "c": 102}


def test_catalog_default_spellings(spark):
    spec = S.TableSpec("t", (S.ColumnSpec("a", "int"), S.ColumnSpec("flags", "bit", length=5, default="b'0101'"),
                             S.ColumnSpec("name", "varchar", default="'it''s'"), S.ColumnSpec("n", "int", default="7")))
    r = N.fill_defaults(spark.createDataFrame([(1,)], "a int"), spec).first()
    assert r["flags"] == 5 and r["name"] == "it's" and r["n"] == 7
