"""Streaming apply (S4, S7, T4), staged publish (S6), CSV export (S5) and
file snapshots (S3) — each run end to end in a fresh folder under the
shared checkpoint directory, then read back."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from siltlake.operators import normalize as N
from siltlake.plans import fixtures as X
from siltlake.plans import q_changes  # noqa: F401  (registers apply_changes, whose oracle we reuse)
from siltlake.plans.q_normalize import DIRTY_SPEC
from siltlake.plans.registry import ORACLES, register
from siltlake.session import checkpoint_dir
from siltlake.sources import sinks as K
from siltlake.sources.snapshot import read_changes, read_snapshot
from siltlake.streaming.apply import VersionedTable, apply_stream


def _scratch(spark, name):
    return f"{checkpoint_dir(spark).rstrip('/')}/siltlake-{name}-{uuid.uuid4().hex[:10]}"


def _write_log(log, path):
    """Change files in an order unrelated to seq; as many as the session's shuffle makes."""
    log.repartition(F.xxhash64("seq", F.lit(7))).write.mode("overwrite").parquet(path)


def _stream_state(spark, sf_dir, buckets=None):
    base = _scratch(spark, "stream")
    log = X.changelog_replayed(spark, sf_dir).select(
        "pk", "seq", "op", "value", F.create_map(F.lit("props"), "props").alias("_rescued"))
    _write_log(log, f"{base}/log")
    target = VersionedTable(spark, f"{base}/target", "pk", "seq", buckets=buckets)
    target.initialize(X.base_users(spark, sf_dir))
    changes = read_changes(spark, f"{base}/log", log.schema, stream=True, max_files_per_trigger=4)
    apply_stream(changes, target, f"{base}/checkpoint").awaitTermination()
    return target


@register("stream_apply")
def q_stream_apply(spark, sf_dir):
    """Change files -> readStream (four files per trigger) -> foreachBatch apply
    into the bucketed target -> current live rows. Same answer as the batch
    ``apply_changes``."""
    return _stream_state(spark, sf_dir).state().select("pk", "seq", "value")


ORACLES["stream_apply"] = ORACLES["apply_changes"]


@register("stream_two_writers", ORACLES["apply_changes"])
def q_stream_two_writers(spark, sf_dir):
    """Two streams with their own checkpoints, so with the same batch ids,
    feed one target: neither hides a batch of the other."""
    base = _scratch(spark, "writers")
    log = X.changelog_replayed(spark, sf_dir).select("pk", "seq", "op", "value")
    VersionedTable(spark, f"{base}/target", "pk", "seq", buckets=16).initialize(X.base_users(spark, sf_dir))
    for half in (1, 0):  # the second brings older and newer events
        _write_log(log.where(F.col("seq") % 2 == half), f"{base}/log{half}")
        changes = read_changes(spark, f"{base}/log{half}", log.schema, stream=True, max_files_per_trigger=8)
        apply_stream(changes, VersionedTable(spark, f"{base}/target", "pk", "seq"), f"{base}/checkpoint{half}").awaitTermination()
    return VersionedTable(spark, f"{base}/target", "pk", "seq").state().select("pk", "seq", "value")


@register("stream_evolve", f"""
WITH {X.CHANGELOG_SQL},
b AS (SELECT pk, seq, CAST(seq % 1000 AS BIGINT) AS amount, 'base' AS origin, op FROM changelog WHERE seq % 2 = 0
      UNION ALL SELECT pk, seq, seq * 4000000000, event_type, op FROM changelog WHERE seq % 2 = 1),
l AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY pk ORDER BY seq DESC) AS rn FROM b)
SELECT pk, seq, amount, origin FROM l WHERE rn = 1 AND op <> 'delete'
""")
def q_stream_evolve(spark, sf_dir):
    """A column is added with its default to the live target, and an INT column
    widens to BIGINT with the next batch; a fresh reader sees both."""
    path = f"{_scratch(spark, 'evolve')}/target"
    log = X.changelog(spark, sf_dir)
    t = VersionedTable(spark, path, "pk", "seq", buckets=16)
    t.apply_batch(log.where("seq % 2 = 0").select("pk", "seq", "op", (F.col("seq") % 1000).cast("int").alias("amount")), 0)
    t.add_column("origin", "string", "base")
    t.apply_batch(log.where("seq % 2 = 1").select("pk", "seq", "op", (F.col("seq") * 4000000000).alias("amount"), F.col("event_type").alias("origin")), 1)
    return VersionedTable(spark, path, "pk", "seq").state().select("pk", "seq", "amount", "origin")


@register("published_snapshot", f"""
WITH {X.DIRTY_ORDERS_SQL}
SELECT o_orderkey, TRY_CAST(total_price AS DECIMAL(12,2)) AS total_price,
       TRY_CAST(small_code AS TINYINT) AS small_code FROM dirty_orders
""")
def q_published_snapshot(spark, sf_dir):
    """loosen -> write aside -> gate (row count equals the source's) -> flip pointer -> read."""
    src = X.dirty_orders(spark, sf_dir)
    landed = N.loosen(src, DIRTY_SPEC).select("o_orderkey", "total_price", "small_code")
    target = _scratch(spark, "publish")
    expected = src.count()
    K.publish_staged(landed, target, gate=lambda staged: staged.count() == expected)
    return K.read_published(spark, target)


@register("export_csv", f"""
WITH {X.DIRTY_ORDERS_SQL},
n AS (SELECT o_orderkey, cust_ref, TRY_CAST(NULLIF(order_date, '0000-00-00 00:00:00') AS TIMESTAMP) AS order_date,
        total_price, small_code, status, note FROM dirty_orders)
SELECT CONCAT_WS(',', {", ".join(
    "COALESCE('\"' || REPLACE(CAST(" + c + " AS VARCHAR), '\"', '\"\"') || '\"', 'NULL')"
    for c in ["o_orderkey", "cust_ref", "order_date", "total_price", "small_code", "status", "note"])}) AS value
FROM n
""")
def q_export_csv(spark, sf_dir):
    path = _scratch(spark, "csv")
    K.export_csv(N.normalize(X.dirty_orders(spark, sf_dir), DIRTY_SPEC), path, compression="gzip")
    return spark.read.text(path)


@register("snapshot_files", f"""
WITH {X.DIRTY_ORDERS_SQL}
SELECT o_orderkey, cust_ref, TRY_CAST(NULLIF(order_date, '0000-00-00 00:00:00') AS TIMESTAMP) AS order_date,
       status FROM dirty_orders
""")
def q_snapshot_files(spark, sf_dir):
    """A JSON dump of the source read back with the all-text landing schema
    (no inference pass), then typed by ``loosen``."""
    path = _scratch(spark, "snap")
    X.dirty_orders(spark, sf_dir).write.json(path)
    raw = read_snapshot(spark, path, DIRTY_SPEC, fmt="json")
    return N.loosen(raw, DIRTY_SPEC).select("o_orderkey", "cust_ref", "order_date", "status")


def _landing_sql() -> str:
    from siltlake.plans.q_quality import _ROW_RULES_SQL
    bad = " OR ".join(f"({c})" for _, sev, c in _ROW_RULES_SQL if sev == "error")
    return f"""WITH {X.DIRTY_ORDERS_SQL}
SELECT o_orderkey, cust_ref, TRY_CAST(NULLIF(order_date, '0000-00-00 00:00:00') AS TIMESTAMP) AS order_date,
       TRY_CAST(total_price AS DECIMAL(12,2)) AS total_price, TRY_CAST(small_code AS TINYINT) AS small_code,
       status, note, 'shop' AS source_system
FROM dirty_orders WHERE NOT ({bad})"""


@register("snapshot_landing", _landing_sql())
def q_snapshot_landing(spark, sf_dir):
    """The whole snapshot path: source dump -> all-text read -> row rules
    split off the quarantine -> loosen -> defaults -> staged publish gated on
    having as many rows as the clean part of the source -> read the published
    version."""
    from siltlake import spec as S
    from siltlake.operators import quality as Q
    from siltlake.plans.q_quality import QUALITY_SPEC
    base = _scratch(spark, "landing")
    X.dirty_orders(spark, sf_dir).write.json(f"{base}/source")
    raw = read_snapshot(spark, f"{base}/source", QUALITY_SPEC, fmt="json")
    clean, quarantine = Q.split_clean(raw, QUALITY_SPEC)
    quarantine.write.parquet(f"{base}/quarantine")
    target = QUALITY_SPEC.with_columns(S.ColumnSpec("source_system", "varchar", default="shop"))
    landed = N.fill_defaults(N.loosen(clean, QUALITY_SPEC).drop("_rescued"), target)
    expected = clean.count()
    K.publish_staged(landed, f"{base}/lake", gate=lambda staged: staged.count() == expected)
    return K.read_published(spark, f"{base}/lake")


@register("applied_set_incremental", ORACLES["applied_set"])
def q_applied_set_incremental(spark, sf_dir):
    """The applied set kept with the target's commits: a stream of the gapped
    log, then batches that repeat a tenth of it; each merges the blocks that
    it touches, and the answer reads no log."""
    base = _scratch(spark, "applied")
    log = X.gapped(spark, sf_dir).select("pk", "seq", "op", "value", "server_uuid", "txn_no")
    track = ("server_uuid", "txn_no")
    _write_log(log, f"{base}/log")
    target = VersionedTable(spark, f"{base}/target", "pk", "seq", buckets=8, track=track, block=1024)
    changes = read_changes(spark, f"{base}/log", log.schema, stream=True, max_files_per_trigger=3)
    apply_stream(changes, target, f"{base}/checkpoint").awaitTermination()
    for k, replay in enumerate((log.where("seq % 10 = 3"), log.where("op = 'delete'"))):
        VersionedTable(spark, f"{base}/target", "pk", "seq", track=track, writer="replay").apply_batch(replay, k)
    return VersionedTable(spark, f"{base}/target", "pk", "seq").applied()


@register("bucket_growth", ORACLES["apply_changes"])
def q_bucket_growth(spark, sf_dir):
    """The target grows from 4 to 7 buckets between two batches, one split at a
    time; the state is that of a target of a fixed size."""
    base = _scratch(spark, "growth")
    log = X.changelog_replayed(spark, sf_dir).select("pk", "seq", "op", "value")
    target = VersionedTable(spark, f"{base}/target", "pk", "seq", buckets=4)
    target.initialize(X.base_users(spark, sf_dir))
    target.apply_batch(log.where("seq % 2 = 0"), 0)
    target.grow(7)
    target.apply_batch(log.where("seq % 2 = 1"), 1)
    return VersionedTable(spark, f"{base}/target", "pk", "seq").state().select("pk", "seq", "value")


@register("on_update_changed", f"""
WITH {X.CHANGELOG_SQL},
i AS (SELECT seq, ts, pk, op, event_type, ROW_NUMBER() OVER (PARTITION BY pk ORDER BY seq DESC) AS rn,
        ROW_NUMBER() OVER (PARTITION BY pk ORDER BY seq) = 1 OR LAG(event_type) OVER (PARTITION BY pk ORDER BY seq) IS DISTINCT FROM event_type
          OR (LAG(op) OVER (PARTITION BY pk ORDER BY seq) = 'delete') IS DISTINCT FROM (op = 'delete') AS changed
      FROM changelog),
l AS (SELECT pk, MAX(CASE WHEN changed THEN seq END) AS at FROM i GROUP BY pk)
SELECT n.pk, n.seq, n.event_type, i.ts AS modified FROM i n JOIN l ON n.pk = l.pk JOIN i ON i.pk = l.pk AND i.seq = l.at
WHERE n.rn = 1 AND n.op <> 'delete'
""")
def q_on_update_changed(spark, sf_dir):
    """ON UPDATE CURRENT_TIMESTAMP in three batches of the log: an update that
    changes no other column leaves the timestamp as it was (X6)."""
    log = X.changelog(spark, sf_dir).select("pk", "seq", "op", "event_type", "ts")
    target = VersionedTable(spark, f"{_scratch(spark, 'modified')}/target", "pk", "seq", buckets=8, updated_at=("modified", "ts"))
    bounds = log.agg(F.expr("approx_percentile(seq, array(0.33, 0.66))").alias("b")).first()["b"]
    for k, (lo, hi) in enumerate(zip([None, *bounds], [*bounds, None])):
        part = log if lo is None else log.where(F.col("seq") > lo)
        target.apply_batch(part if hi is None else part.where(F.col("seq") <= hi), k)
    return target.state().select("pk", "seq", "event_type", "modified")


def _schema_rows(tables, label):
    """One row a table and flag: what a reader of the schema sees."""
    from functools import reduce
    keys = {"customer": "c_custkey", "orders": "o_orderkey", "lineitem": "l_orderkey"}
    return reduce(lambda a, b: a.unionByName(b), [
        tables[name].groupBy("flag").agg(F.count("*").alias("n"), F.sum(key).cast("bigint").alias("keys"))
        .select(F.lit(label).alias("seen"), F.lit(name).alias("table_name"), "flag", "n", "keys") for name, key in keys.items()])


_SCHEMA_SQL = """SELECT '{seen}' AS seen, 'customer' AS table_name, '{c}' AS flag, COUNT(*) AS n, CAST(SUM(c_custkey) AS BIGINT) AS keys FROM customer
UNION ALL SELECT '{seen}', 'orders', '{o}', COUNT(*), CAST(SUM(o_orderkey) AS BIGINT) FROM orders
UNION ALL SELECT '{seen}', 'lineitem', '{l}', COUNT(*), CAST(SUM(l_orderkey) AS BIGINT) FROM lineitem"""


@register("schema_swap", "\nUNION ALL ".join(_SCHEMA_SQL.format(seen=s, c=f, o=f, l=l) for s, f, l in (
    ("after reject", "old", "old"), ("after publish", "new", "new"), ("two tables", "newer", "new"))))
def q_schema_swap(spark, sf_dir):
    """Three tables published as one schema; a publish with one rejected table
    moves none; the next moves all; the last moves two and keeps the third."""
    root = _scratch(spark, "schema")

    def version(flag, names=("customer", "orders", "lineitem")):
        return {n: X.table(spark, sf_dir, n).withColumn("flag", F.lit(flag)) for n in names}

    K.publish_schema(version("old"), root)
    try:
        K.publish_schema(version("new"), root, gates={"orders": lambda staged: staged.where("o_orderkey IS NULL").count() > 0})
        raise AssertionError("the gate was passed")
    except K.RejectedTables as e:
        if e.names != ["orders"]:
            raise
    seen = [_schema_rows(K.published_tables(spark, root), "after reject")]
    second = K.publish_schema(version("new"), root, gates={"orders": lambda staged: staged.where("o_orderkey IS NULL").count() == 0})
    third = K.publish_schema(version("newer", ("customer", "orders")), root)
    seen += [_schema_rows(K.published_tables(spark, root, n), label) for n, label in ((second, "after publish"), (third, "two tables"))]
    return seen[0].unionByName(seen[1]).unionByName(seen[2])
