"""Sinks: CSV text export (S5), staged publish with a swap (S6), JDBC
warehouse sink (S8), and member-table union (S9)."""

from __future__ import annotations

import json
import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltlake.functions.columns import csv_line
from siltlake.session import put_new_file


def union_members(tables: list[DataFrame]) -> DataFrame:
    """``UNION=(t1, t2, …)``: the bag union of member tables by column name;
    a column a member lacks is NULL for its rows (S9)."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)


def csv_lines(df: DataFrame, columns: list[str] | None = None, out: str = "value") -> DataFrame:
    """One quoted CSV line per row, NULL as the bare word."""
    return df.select(csv_line(*(columns or df.columns)).alias(out))


def export_csv(df: DataFrame, path: str, columns: list[str] | None = None, mode: str = "overwrite",
               compression: str | None = None) -> None:
    """Write normalised rows as CSV text files, one part per task.

    Spark's own CSV writer cannot tell a NULL from the text ``NULL`` under
    this spelling, so lines are built per field and written as text."""
    w = csv_lines(df, columns).write.mode(mode)
    if compression:
        w = w.option("compression", compression)
    w.text(path)


# --------------------------------------------------------------------------
# S6 staged publish: write a full copy aside, gate it, then flip a pointer
# --------------------------------------------------------------------------

def _pointer_dir(target: str) -> str:
    return f"{target.rstrip('/')}/_current"


def _pointer_numbers(spark: SparkSession, target: str) -> list[int]:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(_pointer_dir(target))
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    names = [st.getPath().getName() for st in fs.listStatus(p)] if fs.exists(p) else []
    return [int(n[:-len(".json")]) for n in names if n.endswith(".json") and n[:-len(".json")].isdigit()]


def publish_staged(df: DataFrame, target: str, gate=None, version: str | None = None,
                   partition_by: list[str] | None = None) -> str:
    """Publish ``df`` as the new whole version of ``target``.

    The data goes to ``target/v=<version>``; ``gate(staged_df)`` (e.g. a
    row-count or quality check returning bool) runs on the written copy;
    only then is a new pointer file added under ``target/_current``, under the
    next free number (the largest wins). Readers that go
    through :func:`read_published` never see a half-written table, and the
    previous version stays readable until cleaned up."""
    spark = df.sparkSession
    version = version or uuid.uuid4().hex[:12]
    path = f"{target.rstrip('/')}/v={version}"
    w = df.write.mode("errorifexists")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    staged = spark.read.parquet(path)
    if gate is not None and not gate(staged):
        raise ValueError(f"staged version {version} rejected by gate; pointer unchanged")
    # the next free number is taken by creating its file: two publishers never share one, none is rewritten
    number = max(_pointer_numbers(spark, target), default=0) + 1
    while not put_new_file(spark, f"{_pointer_dir(target)}/{number:012d}.json",
                           json.dumps({"number": number, "version": version, "path": path}) + "\n"):
        number += 1
    return path


def read_published(spark: SparkSession, target: str) -> DataFrame:
    """The version published last (pointer files are tiny: one per publish)."""
    ptr = spark.read.schema("number long, version string, path string").json(_pointer_dir(target)) \
        .where("path IS NOT NULL").orderBy(F.col("number").desc()).select("path").first()
    return spark.read.parquet(ptr["path"])


# --------------------------------------------------------------------------
# S6 for a whole schema: every table staged, one pointer that moves them all
# --------------------------------------------------------------------------

#: schema pointers that a publish may lose to other publishers before it gives up
MAX_TRIES = 20


class RejectedTables(ValueError):
    """Tables that their gate rejected; nothing was published."""

    def __init__(self, names: list[str]):
        super().__init__(f"rejected by their gates: {', '.join(names)}; pointer unchanged")
        self.names = names


def _schema_pointer(spark: SparkSession, root: str, number: int | None = None) -> tuple[int, dict[str, str]]:
    """The newest schema pointer (or the one asked for): its number and each table's folder."""
    numbers = _pointer_numbers(spark, root)
    number = max(numbers, default=0) if number is None else number
    if not number:
        return 0, {}
    if number not in numbers:
        raise ValueError(f"{root} has no version {number}")
    text = "\n".join(r["value"] for r in spark.read.text(f"{_pointer_dir(root)}/{number:012d}.json").collect())  # one small file
    return number, json.loads(text)["tables"]


def publish_schema(tables: dict[str, DataFrame], root: str, gates: dict | None = None, drop: list[str] | None = None) -> int:
    """Publish new versions of several tables of one schema at once.

    Each table is written to ``root/<name>/v=<version>`` and its gate runs on
    the written copy. If all pass, one pointer file names the folders of every
    table of the schema (those not published keep theirs, those in ``drop`` go),
    so a reader of :func:`published_tables` sees the whole old schema or the
    whole new one. If any gate rejects, :class:`RejectedTables` is raised and
    nothing moves. Publishers of different tables do not undo each other: one
    that finds its number taken starts from the newer pointer. Returns the
    number of the new pointer."""
    if not tables and not drop:
        raise ValueError("no tables to publish")
    root, version = root.rstrip("/"), uuid.uuid4().hex[:12]
    spark = next(iter(tables.values())).sparkSession if tables else SparkSession.getActiveSession()
    staged, rejected = {}, []
    for name, df in tables.items():
        path = f"{root}/{name}/v={version}"
        df.write.mode("errorifexists").parquet(path)
        gate = (gates or {}).get(name)
        if gate is not None and not gate(spark.read.parquet(path)):
            rejected.append(name)
        staged[name] = path
    if rejected:
        raise RejectedTables(rejected)
    for _ in range(MAX_TRIES):
        number, current = _schema_pointer(spark, root)
        new = {k: v for k, v in {**current, **staged}.items() if k not in (drop or [])}
        if put_new_file(spark, f"{_pointer_dir(root)}/{number + 1:012d}.json", json.dumps({"number": number + 1, "tables": new}) + "\n"):
            return number + 1
    raise RuntimeError(f"{root}: {MAX_TRIES} pointers were taken by other publishers")


def published_tables(spark: SparkSession, root: str, number: int | None = None) -> dict[str, DataFrame]:
    """Every table of a published schema, all from one pointer: the newest, or
    version ``number``."""
    return {name: spark.read.parquet(path) for name, path in _schema_pointer(spark, root, number)[1].items()}


def sweep_schema(spark: SparkSession, root: str, keep: int = 2) -> list[str]:
    """Delete the table folders that the last ``keep`` pointers do not name and
    that are older than the newest pointer (of earlier versions, rejected or
    abandoned publishes), and the pointers before them."""
    jvm = spark.sparkContext._jvm
    root = root.rstrip("/")
    path = jvm.org.apache.hadoop.fs.Path
    fs = path(root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    numbers = sorted(_pointer_numbers(spark, root))
    if not numbers:
        return []
    known = {p.rsplit("/", 2)[1] + "/" + p.rsplit("/", 2)[2] for n in numbers[-keep:] for p in _schema_pointer(spark, root, n)[1].values()}
    newest = fs.getFileStatus(path(f"{_pointer_dir(root)}/{numbers[-1]:012d}.json")).getModificationTime()
    gone = []
    for table in fs.listStatus(path(root)):
        if not table.isDirectory() or table.getPath().getName() == "_current":
            continue
        for copy in fs.listStatus(table.getPath()):
            name = f"{table.getPath().getName()}/{copy.getPath().getName()}"
            if name not in known and copy.getModificationTime() < newest and fs.delete(copy.getPath(), True):
                gone.append(name)
    for n in numbers[:-keep]:
        fs.delete(path(f"{_pointer_dir(root)}/{n:012d}.json"), False)
    return gone


def swap_tables(spark: SparkSession, staged: str, real: str) -> None:
    """Catalog form of the swap: ``real`` is replaced by ``staged`` by renames.
    Between the two renames ``real`` does not exist; readers that must never
    see that go through :func:`publish_staged` or :func:`publish_schema`."""
    old = f"{real}__old_{uuid.uuid4().hex[:6]}"
    if spark.catalog.tableExists(real):
        spark.sql(f"ALTER TABLE {real} RENAME TO {old}")
    spark.sql(f"ALTER TABLE {staged} RENAME TO {real}")
    if spark.catalog.tableExists(old):
        spark.sql(f"DROP TABLE {old}")


# --------------------------------------------------------------------------
# S8 JDBC warehouse sink: staged table, then swap inside the warehouse
# --------------------------------------------------------------------------

def write_jdbc(df: DataFrame, url: str, table: str, schema: str = "datalake", properties: dict | None = None,
               num_partitions: int = 8, batch_size: int = 10000, swap_sql: list[str] | None = None) -> None:
    """Write to ``schema.table`` through a staging table.

    Tasks write ``schema.table__staging`` in parallel (exactly
    ``num_partitions`` connections); the caller's ``swap_sql`` (for example
    ``ALTER TABLE … RENAME``) runs afterwards through the warehouse's own
    session, so readers see the old table or the whole new one."""
    props = dict(properties or {})
    props.setdefault("batchsize", str(batch_size))
    staging = f"{schema}.{table}__staging"
    # repartition (not coalesce): limits the connections without shrinking
    # the parallelism of whatever computes ``df``
    df.repartition(num_partitions).write.mode("overwrite").jdbc(url, staging, properties=props)
    if swap_sql:
        spark = df.sparkSession
        jvm = spark.sparkContext._jvm
        conn = jvm.java.sql.DriverManager.getConnection(url, props.get("user"), props.get("password"))
        try:
            st = conn.createStatement()
            for s in swap_sql:
                st.execute(s)
        finally:
            conn.close()
