"""Sources and sinks: text snapshots keep dirty values, staged publish, table swap, CSV round trip."""

import pytest
from pyspark.sql import functions as F

from table_dirs import SF001
from siltlake import spec as S
from siltlake.operators import normalize as N
from siltlake.plans import fixtures as X
from siltlake.plans.q_normalize import DIRTY_SPEC
from siltlake.sources import sinks as K
from siltlake.sources.snapshot import jdbc_query, raw_schema, read_snapshot


def test_csv_snapshot_reads_dirty_text_without_inference(spark, tmp_path):
    d = X.dirty_orders(spark, SF001)
    path = str(tmp_path / "csv")
    d.write.option("header", "true").csv(path)
    raw = read_snapshot(spark, path, DIRTY_SPEC, fmt="csv")
    assert raw.schema == raw_schema(DIRTY_SPEC)
    typed = N.loosen(raw, DIRTY_SPEC)
    assert typed.count() == d.count()
    assert typed.where(F.col("order_date").isNull()).count() == d.where(F.col("order_date").startswith("0000")).count()


def test_jdbc_query_reads_everything_as_text():
    spec = S.TableSpec("t", (S.ColumnSpec("d", "date"), S.ColumnSpec("b", "blob"), S.ColumnSpec("g", "point")))
    q = jdbc_query(spec, "shop.t")
    assert q == "SELECT CAST(`d` AS CHAR) AS `d`, `b`, ST_AsBinary(`g`) AS `g` FROM shop.t"


def test_publish_gate_blocks_bad_version(spark, tmp_path):
    target = str(tmp_path / "pub")
    good = spark.range(5)
    K.publish_staged(good, target, version="v1")
    with pytest.raises(ValueError):
        K.publish_staged(spark.range(2), target, gate=lambda df: df.count() >= 5, version="v2")
    assert K.read_published(spark, target).count() == 5  # readers still see v1
    K.publish_staged(spark.range(7), target, gate=lambda df: df.count() >= 5, version="v3")
    assert K.read_published(spark, target).count() == 7


def test_swap_tables(spark, tmp_path):
    spark.range(3).write.mode("overwrite").saveAsTable("siltlake_real")
    spark.range(9).write.mode("overwrite").saveAsTable("siltlake_staged")
    K.swap_tables(spark, "siltlake_staged", "siltlake_real")
    assert spark.table("siltlake_real").count() == 9
    assert not spark.catalog.tableExists("siltlake_staged")
    spark.sql("DROP TABLE siltlake_real")


def test_export_csv_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("NULL", None), ('a "b"', "x,y")], "a string, b string")
    K.export_csv(df, str(tmp_path / "out"))
    lines = sorted(r[0] for r in spark.read.text(str(tmp_path / "out")).collect())
    assert lines == ['"NULL",NULL', '"a ""b""","x,y"']


def test_read_changes_json_batch_and_stream(spark, tmp_path):
    from siltlake.sources.snapshot import read_changes
    log = X.changelog(spark, SF001).select("pk", "seq", "op", "value")
    path = str(tmp_path / "json")
    log.write.json(path)
    schema = "pk long, seq long, op string, value double"
    assert read_changes(spark, path, schema, fmt="json").count() == log.count()
    q = (read_changes(spark, path, schema, stream=True, fmt="json", max_files_per_trigger=1)
         .writeStream.format("memory").queryName("json_changes")
         .option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start())
    q.awaitTermination()
    assert spark.table("json_changes").count() == log.count()
