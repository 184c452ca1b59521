"""Catalog dumps (written as literals): table selection, column metadata, enum members, census."""

from pyspark.sql import Row

from siltlake import spec as S
from siltlake.operators.profile import profile, type_census
from siltlake.sources.catalog import enum_members, select_tables, table_columns


def _tables(spark):
    return spark.createDataFrame([
        ("shop", "orders", "BASE TABLE"), ("shop", "items", "BASE TABLE"), ("shop", "v_orders", "VIEW"),
        ("shop", "logs", "BASE TABLE"), ("blog", "posts", "BASE TABLE"), ("blog", "orders", "BASE TABLE"),
    ], "table_schema string, table_name string, table_type string")


def test_select_tables_skip_beats_limit(spark):
    t = _tables(spark)
    got = sorted(r["table_name"] for r in select_tables(t, "shop", limit=["orders", "logs", "v_orders"],
                                                         skip=["logs"]).collect())
    assert got == ["orders"]
    assert sorted(r["table_name"] for r in select_tables(t, "shop").collect()) == ["items", "logs", "orders"]
    assert select_tables(t, None).count() == 5


COLS = [
    ("shop", "t", "id", None, 1, "int", "int unsigned", None, "auto_increment", "PRI", "NO", 10, 0),
    ("shop", "t", "flags", "b'0'", 2, "bit", "bit(5)", None, "", "", "YES", 5, None),
    ("shop", "t", "kind", "'a'", 3, "enum", "enum('a','b''c')", 3, "", "", "YES", None, None),
    ("shop", "t", "tags", None, 4, "set", "set('x','y')", 3, "", "", "YES", None, None),
    ("shop", "t", "born", None, 5, "date", "date", None, "", "", "YES", None, None),
    ("shop", "t", "price", None, 6, "decimal", "decimal(12,2)", None, "", "", "YES", 12, 2),
    ("shop", "t", "raw", None, 7, "varbinary", "varbinary(16)", 16, "", "", "YES", None, None),
    ("shop", "u", "geo", None, 1, "multipolygon", "multipolygon", None, "", "", "YES", None, None),
    ("blog", "p", "body", None, 1, "text", "text", 65535, "", "", "YES", None, None),
]
COLS_SCHEMA = ("table_schema string, table_name string, column_name string, column_default string, "
               "ordinal_position int, data_type string, column_type string, character_maximum_length int, "
               "extra string, column_key string, is_nullable string, numeric_precision int, numeric_scale int")


def test_table_columns_and_members(spark):
    cols = spark.createDataFrame(COLS[::-1], COLS_SCHEMA)
    rows = table_columns(cols, "shop", "t").collect()
    assert [r["column_name"] for r in rows] == ["id", "flags", "kind", "tags", "born", "price", "raw"]
    kind = rows[2]
    assert kind["enum_list"] == "('a','b''c')" and kind["members"] == ["a", "b'c"]
    assert rows[3]["members"] == ["x", "y"] and rows[0]["members"] is None
    spec = S.spec_from_columns("t", rows)
    assert spec.primary_key[0].column == "id" and spec.column("id").unsigned
    assert spec.column("kind").members == ("a", "b'c") and spec.column("flags").length == 5
    assert str(S.spark_type(spec.column("id"))) == "LongType()"
    assert str(S.spark_type(spec.column("price"))) == "DecimalType(12,2)"


def test_type_census_many_databases(spark):
    cols = spark.createDataFrame(COLS, COLS_SCHEMA)
    got = {r["data_type"]: (r["n_columns"], r["n_tables"]) for r in type_census(cols).collect()}
    assert got["int"] == (1, 1) and got["text"] == (1, 1) and got["multipolygon"] == (1, 1)


def test_enum_members_without_list_column(spark):
    df = spark.createDataFrame([Row(data_type="enum", column_type="enum('p','q')")])
    assert enum_members(df).first()["members"] == ["p", "q"]


def test_profile_approx_and_exact(spark):
    df = spark.createDataFrame([(1, "a"), (2, None), (2, "ccc")], "x int, s string")
    ex = {r["column_name"]: r for r in profile(df, exact=True).collect()}
    assert ex["x"]["n_distinct"] == 2 and ex["s"]["n_null"] == 1 and ex["s"]["max_length"] == 3
    ap = {r["column_name"]: r for r in profile(df).collect()}
    assert ap["x"]["n_distinct"] == 2 and ap["x"]["min_value"] == "1"


def test_type_map_matches_the_loose_contract():
    from pyspark.sql import types as T
    want = {
        ("bit", None, False): T.LongType(), ("bit", 64, False): T.DecimalType(20, 0),
        ("tinyint", None, False): T.ByteType(), ("tinyint", None, True): T.ShortType(),
        ("smallint", None, True): T.IntegerType(), ("mediumint", None, False): T.IntegerType(),
        ("int", None, True): T.LongType(), ("bigint", None, False): T.LongType(),
        ("bigint", None, True): T.DecimalType(20, 0), ("bool", None, False): T.BooleanType(),
        ("float", None, False): T.FloatType(), ("double", None, False): T.DoubleType(),
        ("real", None, False): T.DoubleType(), ("date", None, False): T.DateType(),
        ("datetime", None, False): T.TimestampNTZType(), ("timestamp", None, False): T.TimestampType(),
        ("year", None, False): T.ShortType(), ("varchar", 20, False): T.StringType(),
        ("longblob", None, False): T.BinaryType(), ("multipolygon", None, False): T.BinaryType(),
        ("enum", None, False): T.StringType(), ("set", None, False): T.ArrayType(T.StringType()),
        ("json", None, False): T.StringType(),
    }
    for (kind, length, unsigned), t in want.items():
        assert S.spark_type(S.ColumnSpec("c", kind, length=length, unsigned=unsigned)) == t, kind
    assert S.spark_type(S.ColumnSpec("c", "decimal", precision=12, scale=2)) == T.DecimalType(12, 2)
    assert S.spark_type(S.ColumnSpec("c", "decimal", precision=65, scale=2)) == T.StringType()
    assert isinstance(S.spark_type(S.ColumnSpec("c", "time")), T.DayTimeIntervalType)
