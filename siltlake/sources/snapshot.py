"""Table snapshots (S3) and change-log sources.

Snapshots come from files (Parquet / CSV / JSON) or from JDBC with a
partitioned read; change logs are Parquet/JSON files read as a batch or as a
Structured Streaming source that resumes from its checkpoint.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from siltlake import spec as S

# Fixed value: the source's connection pool holds ten connections; the default number of readers.
MAX_SOURCE_CONNECTIONS = 10


def raw_schema(spec: S.TableSpec) -> T.StructType:
    """All-text landing schema: dirty values (zero dates, out-of-range
    numbers) survive the read and are typed later by ``loosen``."""
    fields = []
    for c in spec.columns:
        k = c.kind
        dt = T.BinaryType() if (k in S.BINARY_TYPES or k in S.SPATIAL_TYPES) else T.StringType()
        fields.append(T.StructField(c.name, dt, True))
    return T.StructType(fields)


#: the split column under a name of its own, still a number
SPLIT = "_split"


def _quoted(name: str, quote: str) -> str:
    return quote + name.replace(quote, quote * 2) + quote


def jdbc_query(spec: S.TableSpec, table: str, split: str | None = None, quote: str = "`") -> str:
    """Source-side SELECT that returns every column as text (binary and
    spatial as bytes, BIT as the text of an unsigned number), so the JDBC
    driver never rejects a zero date. ``split`` is added once more, as the
    number it is, for a partitioned read."""
    cols = []
    for c in spec.columns:
        if c.kind in S.BINARY_TYPES:
            cols.append(_quoted(c.name, quote))
        elif c.kind in S.SPATIAL_TYPES:
            cols.append(f"ST_AsBinary({_quoted(c.name, quote)}) AS {_quoted(c.name, quote)}")
        elif c.kind == "bit":
            cols.append(f"CAST(CAST({_quoted(c.name, quote)} AS UNSIGNED) AS CHAR) AS {_quoted(c.name, quote)}")
        else:
            cols.append(f"CAST({_quoted(c.name, quote)} AS CHAR) AS {_quoted(c.name, quote)}")
    if split is not None:
        cols.append(f"{_quoted(split, quote)} AS {_quoted(SPLIT, quote)}")
    return f"SELECT {', '.join(cols)} FROM {table}"


def read_snapshot(spark: SparkSession, source: str, spec: S.TableSpec | None = None, fmt: str = "parquet",
                  jdbc: dict | None = None, partition_column: str | None = None, lower_bound: int | None = None,
                  upper_bound: int | None = None, num_partitions: int = MAX_SOURCE_CONNECTIONS,
                  options: dict | None = None) -> DataFrame:
    """Read one table snapshot.

    * files: ``source`` is a path, ``fmt`` parquet/csv/json; with a spec,
      text formats use the all-text schema (no inference pass).
    * JDBC: ``jdbc={'url':…, 'user':…, 'password':…}``, ``source`` the table.
      The read is split on ``partition_column`` (default: a single integer
      primary key of the spec) into ``num_partitions`` ranges (default: the
      source's pool size); missing bounds come from one MIN/MAX query. Columns
      are read as text (see :func:`jdbc_query`) so zero dates survive."""
    if jdbc is not None:
        props = dict(jdbc)
        url, quote, as_text = props.pop("url"), props.pop("quote", "`"), props.pop("as_text", True)
        if partition_column is None and spec is not None and len(spec.primary_key) == 1:
            pk = spec.column(spec.primary_key[0].column)
            if pk.kind in S.INTEGER_TYPES:
                partition_column = pk.name
        textual = spec is not None and as_text
        split = SPLIT if textual and partition_column is not None else partition_column
        dbtable = f"({jdbc_query(spec, source, partition_column, quote)}) AS snap" if textual else source
        if partition_column is not None:
            if lower_bound is None or upper_bound is None:
                # one tiny source-side query for the bounds (a single row)
                at = _quoted(partition_column, quote)
                b = spark.read.jdbc(url, f"(SELECT MIN({at}) AS lo, MAX({at}) AS hi FROM {source}) AS bounds", properties=props).first()
                lower_bound = b["lo"] if lower_bound is None else lower_bound
                upper_bound = b["hi"] if upper_bound is None else upper_bound
            if lower_bound is not None and upper_bound is not None:
                return spark.read.jdbc(url, dbtable, column=split, lowerBound=int(lower_bound), upperBound=int(upper_bound) + 1,
                                       numPartitions=num_partitions, properties=props).drop(SPLIT)
        return spark.read.jdbc(url, dbtable, properties=props).drop(SPLIT)
    reader = spark.read.options(**(options or {}))
    if fmt in ("csv", "json") and spec is not None:
        reader = reader.schema(raw_schema(spec))
    if fmt == "csv":
        reader = reader.option("header", "true")
    return reader.format(fmt).load(source)


def read_changes(spark: SparkSession, path: str, schema: T.StructType | str, stream: bool = False,
                 fmt: str = "parquet", max_files_per_trigger: int | None = None) -> DataFrame:
    """Change-log files as a DataFrame.

    ``stream=True`` gives an unbounded streaming source that starts from the
    beginning of the log and resumes from the query checkpoint
    (at-least-once; apply is idempotent, so replays are harmless)."""
    if stream:
        r = spark.readStream.schema(schema).format(fmt)
        if max_files_per_trigger:
            r = r.option("maxFilesPerTrigger", max_files_per_trigger)
        return r.load(path)
    return spark.read.schema(schema).format(fmt).load(path)
