"""Synthetic tables and change logs (G1, G2), driven by keys of the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from siltlake import spec as S
from siltlake.operators import changes as C
from siltlake.operators import synth as G
from siltlake.operators.synth_typed import synth_typed
from siltlake.plans import fixtures as X
from siltlake.plans.registry import register

SYNTH_SPEC = S.TableSpec(
    name="widgets",
    columns=(
        S.ColumnSpec("id", "int", nullable=False, auto_increment=True),
        S.ColumnSpec("stock", "smallint"),
        S.ColumnSpec("net_weight", "decimal", precision=12, scale=2),
        S.ColumnSpec("unit_cost", "double", nullable=False),
        S.ColumnSpec("shelf", "tinyint", unsigned=True),
        S.ColumnSpec("active", "bool"),
        S.ColumnSpec("made_on", "date"),
        S.ColumnSpec("seen_at", "datetime"),
        S.ColumnSpec("start_year", "year"),
        S.ColumnSpec("marking", "varchar", length=12),
        S.ColumnSpec("remarks", "text"),
        S.ColumnSpec("state", "enum", members=("new", "paid", "shipped")),
        S.ColumnSpec("tags", "set", members=("red", "green", "blue")),
        S.ColumnSpec("flags", "bit", length=5),
        S.ColumnSpec("raw", "blob"),
    ),
    primary_key=(S.KeyPart("id"),),
)


_SYNTH_COLS = ", ".join("hex(raw) AS raw" if c.name == "raw" else c.name for c in SYNTH_SPEC.columns)


@register("synth_table", f"""
SELECT {_SYNTH_COLS}
FROM ({G.synth_table_sql(SYNTH_SPEC, "(SELECT o_orderkey AS id FROM orders) ids", seed=42)}) g
""")
def q_synth_table(spark, sf_dir):
    """Generated rows; the blob column is shown as hex text."""
    ids = X.table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"))
    return G.synth_table(ids, SYNTH_SPEC, seed=42).withColumn("raw", F.hex("raw"))


@register("synth_changes", G.synth_changes_sql("(SELECT c_custkey AS id FROM customer) k", seed=7))
def q_synth_changes(spark, sf_dir):
    keys = X.table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"))
    return G.synth_changes(keys, seed=7)


@register("synth_latest", f"""
WITH log AS ({G.synth_changes_sql("(SELECT c_custkey AS id FROM customer) k", seed=7)}),
last AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY pk ORDER BY seq DESC) AS rn FROM log)
SELECT pk, seq, op, value FROM last WHERE rn = 1 AND op <> 'delete'
""")
def q_synth_latest(spark, sf_dir):
    """The generated log collapses to its live keys (G2 feeding T3)."""
    keys = X.table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"))
    return C.latest_state(G.synth_changes(keys, seed=7))


TYPED_SPEC = S.TableSpec(
    name="readings",
    columns=(
        S.ColumnSpec("id", "bigint", nullable=False),
        S.ColumnSpec("device", "int", nullable=False),
        S.ColumnSpec("drift", "tinyint", nullable=False),
        S.ColumnSpec("total", "bigint", nullable=False),
        S.ColumnSpec("raw_total", "bigint", unsigned=True),
        S.ColumnSpec("mask", "bit", length=64, nullable=False),
        S.ColumnSpec("exact", "decimal", precision=38, scale=6, nullable=False),
        S.ColumnSpec("small", "decimal", precision=5, scale=2),
        S.ColumnSpec("ratio", "double", nullable=False),
        S.ColumnSpec("taken_on", "date", nullable=False),
        S.ColumnSpec("taken_at", "datetime", nullable=False),
        S.ColumnSpec("lag", "time", nullable=False),
        S.ColumnSpec("since", "year"),
        S.ColumnSpec("modes", "set", members=("dry", "wet", "hot"), nullable=False),
    ),
    primary_key=(S.KeyPart("id"),),
    foreign_keys=(S.ForeignKey("fk_device", ("device",), "customer", (S.KeyPart("c_custkey"),)),),
)


# every number in full: one row per id and column, the congruence step by step
@register("synth_typed", """
WITH parent AS (SELECT COUNT(*) AS n FROM customer),
first AS (SELECT o_orderkey AS id, c,
    ((o_orderkey % 2147483648) * 1103515245 + (o_orderkey // 2147483648) * 12345 + 12345 + (c + 1) * 7919 + 42 * 104729) % 2147483648 AS x0
  FROM orders, range(14) AS cols(c)),
steps AS (SELECT *, (x0 * 1103515245 + 12345) % 2147483648 AS x1, (x1 * 1103515245 + 12345) % 2147483648 AS x2,
    (x2 * 1103515245 + 12345) % 2147483648 AS x3, (x3 * 1103515245 + 12345) % 2147483648 AS x4, (x4 * 1103515245 + 12345) % 2147483648 AS x5,
    (x5 * 1103515245 + 12345) % 2147483648 AS x6, (x6 * 1103515245 + 12345) % 2147483648 AS x7, (x7 * 1103515245 + 12345) % 2147483648 AS x8,
    (x8 * 1103515245 + 12345) % 2147483648 AS x9, (x9 * 1103515245 + 12345) % 2147483648 AS x10, (x10 * 1103515245 + 12345) % 2147483648 AS x11,
    (x11 * 1103515245 + 12345) % 2147483648 AS x12, (x12 * 1103515245 + 12345) % 2147483648 AS x13 FROM first),
limbs AS (SELECT id, c, x0 // 67108864 AS edge, (x1 // 32768) % 10 = 0 AS gap, x2 // 32768 AS a, x13 // 32768 AS z,
    (x2 // 32768)::HUGEINT + (x3 // 32768)::HUGEINT * 65536 + (x4 // 32768)::HUGEINT * 4294967296 + (x5 // 32768)::HUGEINT * 281474976710656 AS w,
    printf('%04d%04d%04d%04d%04d%04d%04d%04d%04d%04d', (x2 // 32768) % 10000, (x3 // 32768) % 10000, (x4 // 32768) % 10000, (x5 // 32768) % 10000,
      (x6 // 32768) % 10000, (x7 // 32768) % 10000, (x8 // 32768) % 10000, (x9 // 32768) % 10000, (x10 // 32768) % 10000, (x11 // 32768) % 10000) AS d
  FROM steps),
vals AS (SELECT id, c, edge, gap, a, z, w, w % 4611686018427387904 AS u, right(d, 38) AS d38, right(left(d, 8), 5) AS d5 FROM limbs)
SELECT id,
  MAX(CASE WHEN c = 1 THEN 1 + u % (SELECT n FROM parent) END)::BIGINT AS device,
  MAX(CASE WHEN c = 2 THEN CASE edge WHEN 0 THEN -128 WHEN 1 THEN 127 ELSE a % 256 - 128 END END)::BIGINT AS drift,
  MAX(CASE WHEN c = 3 THEN CASE edge WHEN 0 THEN -9223372036854775808 WHEN 1 THEN 9223372036854775807 ELSE w - 9223372036854775808 END END)::BIGINT AS total,
  MAX(CASE WHEN c = 4 AND NOT gap THEN CASE edge WHEN 0 THEN '0' WHEN 1 THEN '18446744073709551615' ELSE w::VARCHAR END END) AS raw_total,
  MAX(CASE WHEN c = 5 THEN CASE edge WHEN 0 THEN '0' WHEN 1 THEN '18446744073709551615' ELSE w::VARCHAR END END) AS mask,
  MAX(CASE WHEN c = 6 THEN CASE edge WHEN 0 THEN '-99999999999999999999999999999999.999999' WHEN 1 THEN '99999999999999999999999999999999.999999'
    ELSE (CASE WHEN z < 32768 THEN '-' ELSE '' END || left(d38, 32) || '.' || right(d38, 6))::DECIMAL(38,6)::VARCHAR END END) AS exact,
  MAX(CASE WHEN c = 7 AND NOT gap THEN CASE edge WHEN 0 THEN '-999.99' WHEN 1 THEN '999.99'
    ELSE (CASE WHEN z < 32768 THEN '-' ELSE '' END || left(d5, 3) || '.' || right(d5, 2))::DECIMAL(5,2)::VARCHAR END END) AS small,
  MAX(CASE WHEN c = 8 THEN CASE edge WHEN 0 THEN -1.7976931348623157e308 WHEN 1 THEN 1.7976931348623157e308
    ELSE (u % 9007199254740992 - 4503599627370496)::DOUBLE * power(2::DOUBLE, (z % 601 - 300)::DOUBLE) END END) AS ratio,
  MAX(CASE WHEN c = 9 THEN CASE edge WHEN 0 THEN '1000-01-01' WHEN 1 THEN '9999-12-31' ELSE (DATE '1000-01-01' + (u % 3287182)::INTEGER)::VARCHAR END END) AS taken_on,
  MAX(CASE WHEN c = 10 THEN CASE edge WHEN 0 THEN '1000-01-01 00:00:00' WHEN 1 THEN '9999-12-31 23:59:59'
    ELSE (TIMESTAMP '1000-01-01 00:00:00' + to_seconds((u % 284012524800)::BIGINT))::VARCHAR END END) AS taken_at,
  MAX(CASE WHEN c = 11 THEN CASE edge WHEN 0 THEN -3020399 WHEN 1 THEN 3020399 ELSE u % 6040799 - 3020399 END END)::BIGINT AS lag,
  MAX(CASE WHEN c = 12 AND NOT gap THEN CASE edge WHEN 0 THEN 1901 WHEN 1 THEN 2155 ELSE 1901 + u % 255 END END)::BIGINT AS since,
  MAX(CASE WHEN c = 13 THEN CASE edge WHEN 0 THEN '' WHEN 1 THEN 'dry,wet,hot' ELSE concat_ws(',', CASE WHEN a % 2 = 1 THEN 'dry' END,
    CASE WHEN a // 2 % 2 = 1 THEN 'wet' END, CASE WHEN a // 4 % 2 = 1 THEN 'hot' END) END END) AS modes
FROM vals GROUP BY id
""")
def q_synth_typed(spark, sf_dir):
    """Rows over the whole range of each declared type; what other engines have no equal type for is shown as text or seconds."""
    ids = X.table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"))
    parents = {"customer": (1, X.table(spark, sf_dir, "customer").count())}
    rows = synth_typed(ids, TYPED_SPEC, seed=42, parents=parents)
    text = [F.col(c).cast("string").alias(c) for c in ("raw_total", "mask", "exact", "small", "taken_on", "taken_at")]
    return rows.select("id", *[F.col(c).cast("long").alias(c) for c in ("device", "drift", "total", "since")], *text, "ratio",
                       F.expr("CAST(extract(DAY FROM lag) * 86400 + extract(HOUR FROM lag) * 3600 + extract(MINUTE FROM lag) * 60 "
                              "+ extract(SECOND FROM lag) AS BIGINT)").alias("lag"), F.concat_ws(",", "modes").alias("modes"))
