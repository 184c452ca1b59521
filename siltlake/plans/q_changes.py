"""Change-data queries (T2-T9, Q11) over the changelog derived from ``events``."""

from __future__ import annotations

from pyspark.sql import functions as F

from siltlake.operators import changes as C
from siltlake.plans import fixtures as X
from siltlake.plans.registry import register


@register("latest_state", f"""
WITH {X.CHANGELOG_SQL},
last AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY pk ORDER BY seq DESC) AS rn FROM changelog)
SELECT pk, seq, ts, server_uuid, txn_no, event_type, value, props FROM last WHERE rn = 1 AND op <> 'delete'
""")
def q_latest_state(spark, sf_dir):
    live = C.latest_state(X.changelog(spark, sf_dir), "pk", "seq", "op")
    return live.select("pk", "seq", "ts", "server_uuid", "txn_no", "event_type", "value", "props")


@register("apply_changes", f"""
WITH {X.REPLAYED_SQL}, {X.BASE_USERS_SQL},
last AS (SELECT pk, seq, op, value, ROW_NUMBER() OVER (PARTITION BY pk ORDER BY seq DESC) AS rn
         FROM changelog_replayed),
l AS (SELECT * FROM last WHERE rn = 1),
j AS (
  SELECT COALESCE(l.pk, b.pk) AS pk,
         (l.pk IS NOT NULL AND (b.pk IS NULL OR l.seq > b.seq)) AS take_change,
         l.seq AS l_seq, l.op AS l_op, l.value AS l_value, b.seq AS b_seq, b.value AS b_value
  FROM l FULL OUTER JOIN base_users b ON l.pk = b.pk)
SELECT pk, CASE WHEN take_change THEN l_seq ELSE b_seq END AS seq,
       CASE WHEN take_change THEN l_value ELSE b_value END AS value
FROM j WHERE NOT (take_change AND l_op = 'delete')
""")
def q_apply_changes(spark, sf_dir):
    return C.apply_changes(X.base_users(spark, sf_dir), X.changelog_replayed(spark, sf_dir),
                           "pk", "seq", "op", columns=["value"]).select("pk", "seq", "value")


@register("row_diff", f"""
WITH {X.IMAGES_SQL}
SELECT seq, pk, op,
  CONCAT_WS(',', CASE WHEN before_type IS DISTINCT FROM after_type THEN 'type' END,
                 CASE WHEN before_value IS DISTINCT FROM after_value THEN 'value' END) AS changed_columns,
  (before_type IS NOT DISTINCT FROM after_type AND before_value IS NOT DISTINCT FROM after_value) AS noop
FROM changelog_images WHERE op = 'update'
""")
def q_row_diff(spark, sf_dir):
    im = X.changelog_images(spark, sf_dir).where(F.col("op") == "update")
    d = C.row_diff(im, ["type", "value"])
    return d.select("seq", "pk", "op", F.array_join("changed_columns", ",").alias("changed_columns"),
                    F.col("_noop").alias("noop"))


@register("flatten_changes", f"""
WITH {X.IMAGES_SQL},
f AS (
  SELECT pk, seq, 'type' AS "column", before_type AS "before", after_type AS "after",
         before_type IS DISTINCT FROM after_type AS changed FROM changelog_images
  UNION ALL
  SELECT pk, seq, 'value', CAST(before_value AS VARCHAR), CAST(after_value AS VARCHAR),
         before_value IS DISTINCT FROM after_value FROM changelog_images)
SELECT pk, seq, "column", "before", "after" FROM f WHERE changed
""")
def q_flatten_changes(spark, sf_dir):
    return C.flatten_changes(X.changelog_images(spark, sf_dir), ["type", "value"])


@register("applied_set", f"""
WITH {X.GAPPED_SQL},
d AS (SELECT DISTINCT server_uuid, txn_no FROM changelog),
g AS (SELECT server_uuid, txn_no, txn_no - ROW_NUMBER() OVER (PARTITION BY server_uuid ORDER BY txn_no) AS grp FROM d)
SELECT server_uuid, MIN(txn_no) AS interval_start, MAX(txn_no) AS interval_end, COUNT(*) AS n_txn
FROM g GROUP BY server_uuid, grp
""")
def q_applied_set(spark, sf_dir):
    return C.applied_set(X.gapped(spark, sf_dir))


@register("applied_set_blocks", f"""
WITH {X.GAPPED_SQL},
d AS (SELECT DISTINCT server_uuid, txn_no FROM changelog),
g AS (SELECT server_uuid, txn_no, txn_no - ROW_NUMBER() OVER (PARTITION BY server_uuid ORDER BY txn_no) AS grp FROM d)
SELECT server_uuid, MIN(txn_no) AS interval_start, MAX(txn_no) AS interval_end, COUNT(*) AS n_txn
FROM g GROUP BY server_uuid, grp
""")
def q_applied_set_blocks(spark, sf_dir):
    """The applied set again, as the blocks of the default size give it (tests use tiny ones)."""
    return C.applied_set(X.gapped(spark, sf_dir))


@register("missing_set", f"""
WITH {X.GAPPED_SQL},
d AS (SELECT DISTINCT server_uuid, txn_no FROM changelog),
g AS (SELECT server_uuid, txn_no, txn_no - ROW_NUMBER() OVER (PARTITION BY server_uuid ORDER BY txn_no) AS grp FROM d),
i AS (SELECT server_uuid, MIN(txn_no) AS lo, MAX(txn_no) AS hi FROM g GROUP BY server_uuid, grp),
n AS (SELECT server_uuid, hi, LEAD(lo) OVER (PARTITION BY server_uuid ORDER BY lo) AS nxt FROM i)
SELECT server_uuid, hi + 1 AS gap_start, nxt - 1 AS gap_end, nxt - hi - 1 AS n_missing FROM n WHERE nxt IS NOT NULL
""")
def q_missing_set(spark, sf_dir):
    islands = C.applied_set(X.gapped(spark, sf_dir))
    return C.gaps(islands)


@register("missing_vs_applied", f"""
WITH {X.GAPPED_SQL},
src AS (SELECT DISTINCT 'srv-' || CAST(event_id % 3 AS VARCHAR) AS server_uuid,
               CAST(FLOOR(event_id / 3) AS BIGINT) AS txn_no FROM events),
d AS (SELECT * FROM src EXCEPT SELECT server_uuid, txn_no FROM changelog),
g AS (SELECT server_uuid, txn_no, txn_no - ROW_NUMBER() OVER (PARTITION BY server_uuid ORDER BY txn_no) AS grp FROM d)
SELECT server_uuid, MIN(txn_no) AS gap_start, MAX(txn_no) AS gap_end, COUNT(*) AS n_missing
FROM g GROUP BY server_uuid, grp
""")
def q_missing_vs_applied(spark, sf_dir):
    ev = X.table(spark, sf_dir, "events")
    source = ev.select(F.concat(F.lit("srv-"), (F.col("event_id") % 3).cast("string")).alias("server_uuid"),
                       F.floor(F.col("event_id") / 3).cast("bigint").alias("txn_no"))
    return C.missing_set(source, X.gapped(spark, sf_dir))


@register("dedup_changes", f"""
WITH {X.REPLAYED_SQL}
SELECT DISTINCT * FROM changelog_replayed
""")
def q_dedup_changes(spark, sf_dir):
    return C.dedup_changes(X.changelog_replayed(spark, sf_dir))


@register("route_tables", f"""
WITH {X.CHANGELOG_SQL}
SELECT seq, pk, op, event_type FROM changelog
WHERE event_type NOT IN ('view') AND event_type IN ('click', 'view', 'signup')
""")
def q_route_tables(spark, sf_dir):
    r = C.route_tables(X.changelog(spark, sf_dir), "event_type", limit=["click", "view", "signup"], skip=["view"])
    return r.select("seq", "pk", "op", "event_type")


_AUDIT_IMAGES = f"""{X.GAPPED_IMAGES_SQL},
audit_input AS (SELECT * FROM changelog_images UNION ALL SELECT * FROM changelog_images WHERE seq % 10 = 3)"""


@register("change_log_audit", f"""
WITH {_AUDIT_IMAGES},
ev AS (SELECT server_uuid, txn_no, seq, COUNT(*) AS n,
         SUM(CASE WHEN op IN ('update','delete') AND before_type IS NULL AND before_value IS NULL THEN 1 ELSE 0 END) AS nb,
         SUM(CASE WHEN op IN ('insert','update') AND after_type IS NULL AND after_value IS NULL THEN 1 ELSE 0 END) AS na
       FROM audit_input GROUP BY server_uuid, txn_no, seq),
tx AS (SELECT server_uuid, txn_no, SUM(n) AS n, SUM(n - 1) AS dup, SUM(nb) AS nb, SUM(na) AS na
       FROM ev GROUP BY server_uuid, txn_no)
SELECT server_uuid, CAST(SUM(n) AS BIGINT) AS n_events, CAST(SUM(nb) AS BIGINT) AS missing_before_image,
       CAST(SUM(na) AS BIGINT) AS missing_after_image, CAST(SUM(dup) AS BIGINT) AS duplicate_events,
       CAST(MAX(txn_no) - MIN(txn_no) + 1 - COUNT(*) AS BIGINT) AS missing_txn
FROM tx GROUP BY server_uuid
""")
def q_change_log_audit(spark, sf_dir):
    im = X.changelog_images(spark, sf_dir, X.gapped(spark, sf_dir))
    return C.change_log_audit(im.unionByName(im.where(F.col("seq") % 10 == 3)), ["type", "value"])


@register("applied_set_text", f"""
WITH {X.GAPPED_SQL},
d AS (SELECT DISTINCT server_uuid, txn_no FROM changelog),
g AS (SELECT server_uuid, txn_no, txn_no - ROW_NUMBER() OVER (PARTITION BY server_uuid ORDER BY txn_no) AS grp FROM d),
i AS (SELECT server_uuid, MIN(txn_no) AS lo, MAX(txn_no) AS hi FROM g GROUP BY server_uuid, grp)
SELECT server_uuid, CAST(FLOOR(lo / 1048576) AS BIGINT) AS chunk,
       string_agg(CASE WHEN lo = hi THEN CAST(lo AS VARCHAR) ELSE CAST(lo AS VARCHAR) || '-' || CAST(hi AS VARCHAR) END,
                  ':' ORDER BY lo) AS text
FROM i GROUP BY server_uuid, CAST(FLOOR(lo / 1048576) AS BIGINT)
""")
def q_applied_set_text(spark, sf_dir):
    """The ``uuid:1-5:7-9`` text of the applied set, in ordered per-block chunks."""
    return C.interval_text(C.applied_set(X.gapped(spark, sf_dir)))


@register("apply_with_tombstones", f"""
WITH {X.REPLAYED_SQL}, {X.BASE_USERS_SQL},
last AS (SELECT pk, seq, op, value, ROW_NUMBER() OVER (PARTITION BY pk ORDER BY seq DESC) AS rn
         FROM changelog_replayed),
l AS (SELECT * FROM last WHERE rn = 1),
j AS (
  SELECT COALESCE(l.pk, b.pk) AS pk,
         (l.pk IS NOT NULL AND (b.pk IS NULL OR l.seq > b.seq)) AS take_change,
         l.seq AS l_seq, l.op AS l_op, l.value AS l_value, b.seq AS b_seq, b.value AS b_value
  FROM l FULL OUTER JOIN base_users b ON l.pk = b.pk)
SELECT pk, CASE WHEN take_change THEN l_seq ELSE b_seq END AS seq,
       CASE WHEN take_change THEN l_value ELSE b_value END AS value,
       COALESCE(take_change AND l_op = 'delete', false) AS _deleted
FROM j WHERE NOT (take_change AND l_op = 'delete' AND l_seq < 2000)
""")
def q_apply_with_tombstones(spark, sf_dir):
    """Apply keeping tombstones, then compact those older than seq 2000 (H5)."""
    state = C.apply_changes(X.base_users(spark, sf_dir), X.changelog_replayed(spark, sf_dir), "pk", "seq", "op",
                            columns=["value"], keep_tombstones=True)
    return C.compact_tombstones(state, 2000).select("pk", "seq", "value", "_deleted")
