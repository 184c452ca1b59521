"""Plan properties of every registered query: no nested-loop
join or cartesian product, no window without a partition key, no row-at-a-time
Python UDF; parquet scans read only the columns they need."""

import re

import pytest

from table_dirs import SF001
import __spark_entry__ as E

QUERIES = E.queries()
# a window spec whose first argument is already the ordering (or the frame)
# has no PARTITION BY
UNPARTITIONED_WINDOW = re.compile(
    r"windowspecdefinition\((?:[^,()]+ (?:ASC|DESC) NULLS (?:FIRST|LAST)|specifiedwindowframe)")


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_plan_is_scale_safe(spark, name):
    df = QUERIES[name](spark, SF001)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoopJoin" not in plan
    assert "CartesianProduct" not in plan
    assert not UNPARTITIONED_WINDOW.search(plan), "window without PARTITION BY"
    assert "BatchEvalPython" not in plan


def test_scan_prunes_columns(spark):
    plan = QUERIES["where_filter"](spark, SF001)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(o_orderstatus), IsNotNull(o_totalprice), EqualTo(o_orderstatus,O)" in plan
    schema = re.search(r"ReadSchema: struct<([^>]*)>", plan).group(1)
    assert "o_orderdate" not in schema and "o_orderpriority" not in schema


def test_unpartitioned_window_is_detected(spark):
    from pyspark.sql import Window
    from pyspark.sql import functions as F
    bad = spark.range(10).withColumn("r", F.row_number().over(Window.orderBy("id")))
    ok = spark.range(10).withColumn("r", F.row_number().over(Window.partitionBy(F.col("id") % 2).orderBy("id")))
    assert UNPARTITIONED_WINDOW.search(bad._jdf.queryExecution().executedPlan().toString())
    assert not UNPARTITIONED_WINDOW.search(ok._jdf.queryExecution().executedPlan().toString())
