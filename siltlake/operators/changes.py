"""Change data as DataFrames: collapse, apply, diff, flatten, applied/missing
transaction sets, dedup, routing, schema evolution, log audit (T2-T10, Q11).

A change log is a DataFrame with a key (``pk`` by default), a total order
``seq``, an ``op`` in (insert, update, delete) and the row's columns.
Order is ``seq`` only, never arrival time, so every function here gives the
same answer for replays and shuffled arrival.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

DELETE = "delete"


def _keys(key: str | list[str]) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def last_rows(rows: DataFrame, key: str | list[str], seq: str) -> DataFrame:
    """The row with the largest ``seq`` of each key, ``key`` columns first.

    ``max_by`` is an ordinary aggregate with a partial (map-side) step: each
    task reduces its own rows to one per key before the shuffle (a struct
    buffer makes it sort-based: tasks sort only their own split, with spill),
    so a hot key costs one row per task, not one task. Columns of any type may
    be carried, maps too; ties on ``seq`` are broken by a hash of the row, so
    the result is deterministic."""
    ks = _keys(key)
    rest = [c for c in rows.columns if c not in ks and c != seq]
    maps = {f.name for f in rows.schema.fields if f.dataType.typeName() == "map"}
    text = [F.to_json(F.struct(c)) if c in maps or rows.schema[c].dataType.typeName() in ("struct", "array") else F.col(c) for c in rest]
    order = F.struct(F.col(seq), F.xxhash64(*text) if text else F.lit(0).cast("long"))
    last = rows.groupBy(*ks).agg(F.max_by(F.struct(F.col(seq), *[F.col(c) for c in rest]), order).alias("_last"))
    return last.select(*ks, F.col("_last." + seq).alias(seq), *[F.col(f"_last.`{c}`").alias(c) for c in rest])


def latest_state(changes: DataFrame, key: str | list[str] = "pk", seq: str = "seq", op: str = "op",
                 keep_deletes: bool = False, deleted_col: str | None = None) -> DataFrame:
    """Last event per key by ``seq`` (T3, see :func:`last_rows`); a delete
    removes the key. With ``keep_deletes`` the tombstones stay (flag in
    ``deleted_col``)."""
    out = last_rows(changes, key, seq)
    if keep_deletes:
        if deleted_col:
            out = out.withColumn(deleted_col, F.col(op) == DELETE)
        return out
    return out.where(F.col(op) != DELETE)


def apply_changes(target: DataFrame, changes: DataFrame, key: str | list[str] = "pk", seq: str = "seq",
                  op: str = "op", columns: list[str] | None = None, keep_tombstones: bool = False,
                  deleted_col: str = "_deleted", updated_at: tuple[str, str] | None = None,
                  spec=None, event_time: str = "ts") -> DataFrame:
    """Upsert / delete ``changes`` into ``target`` by key, guarded by ``seq`` (T4).

    ``target`` holds (key…, seq, columns…[, _deleted]). Instead of a full outer
    join the target is treated as one more event per key and the result is the
    last event per key — one shuffle, partial aggregation, idempotent: a replay
    or an older event cannot win over a newer one. Tombstones keep the ``seq``
    of a delete so a late older insert cannot resurrect the row.
    This rewrites the whole target; for a large target keep it as a
    :class:`siltlake.streaming.apply.VersionedTable` and call its
    ``apply_batch`` (batch jobs too), which rewrites only touched buckets.
    ``updated_at=(column, event_time_column)`` sets an ON UPDATE timestamp from
    the event time of the winning change; with a ``spec`` its
    ``ON UPDATE CURRENT_TIMESTAMP`` column is used, fed from ``event_time``."""
    if updated_at is None and spec is not None:
        on_update = [c.name for c in spec.columns if c.on_update_now and c.name in target.columns]
        if on_update and event_time in changes.columns:
            updated_at = (on_update[0], event_time)
    ks = _keys(key)
    cols = columns or [c for c in target.columns if c not in ks and c not in (seq, deleted_col, op)]
    tgt_del = F.col(deleted_col) if deleted_col in target.columns else F.lit(False)
    t = target.select(*ks, F.col(seq).cast("bigint").alias(seq),
                      F.when(tgt_del, F.lit(DELETE)).otherwise(F.lit("upsert")).alias(op),
                      *[F.col(c) for c in cols])
    ch_cols = []
    for c in cols:
        if updated_at and c == updated_at[0]:
            ch_cols.append(F.col(updated_at[1]).cast(target.schema[c].dataType).alias(c))
        elif c in changes.columns:
            ch_cols.append(F.col(c).cast(target.schema[c].dataType).alias(c))
        else:
            ch_cols.append(F.lit(None).cast(target.schema[c].dataType).alias(c))
    ch = changes.select(*ks, F.col(seq).cast("bigint").alias(seq), F.col(op), *ch_cols)
    merged = latest_state(t.unionByName(ch), ks, seq, op, keep_deletes=True)
    merged = merged.withColumn(deleted_col, F.col(op) == DELETE).drop(op)
    if keep_tombstones:
        return merged
    return merged.where(~F.col(deleted_col)).drop(deleted_col)


def compact_tombstones(state: DataFrame, seq_floor: int | Column, seq: str = "seq",
                       deleted_col: str = "_deleted") -> DataFrame:
    """Drop tombstones older than a retention point (H5)."""
    floor = seq_floor if isinstance(seq_floor, Column) else F.lit(seq_floor)
    return state.where(~(F.col(deleted_col) & (F.col(seq) < floor)))


def row_diff(images: DataFrame, columns: list[str], before: str = "before_", after: str = "after_",
             out: str = "changed_columns") -> DataFrame:
    """Changed columns of each event from full row images (T5): a column is
    changed when ``before IS DISTINCT FROM after``. ``_noop`` flags updates that
    change nothing."""
    flags = [F.when(~F.col(before + c).eqNullSafe(F.col(after + c)), F.lit(c)) for c in columns]
    arr = F.array_compact(F.array(*flags))
    return images.withColumn(out, arr).withColumn("_noop", F.size(arr) == 0)


def flatten_changes(images: DataFrame, columns: list[str], key: str | list[str] = "pk", seq: str = "seq",
                    before: str = "before_", after: str = "after_", only_changed: bool = True) -> DataFrame:
    """One row per (event, column): (key…, seq, column, before, after) as text.
    The same expression works on a batch or a streaming DataFrame."""
    ks = _keys(key)
    items = F.array(*[F.struct(F.lit(c).alias("column"),
                               F.col(before + c).cast("string").alias("before"),
                               F.col(after + c).cast("string").alias("after"),
                               (~F.col(before + c).eqNullSafe(F.col(after + c))).alias("changed"))
                      for c in columns])
    x = images.select(*ks, seq, F.explode(items).alias("_c"))
    if only_changed:
        x = x.where(F.col("_c.changed"))
    return x.select(*ks, seq, "_c.column", "_c.before", "_c.after")


def with_previous(changes: DataFrame, columns: dict[str, str], key: str | list[str] = "pk", seq: str = "seq",
                  block: int = 1 << 20) -> DataFrame:
    """``changes`` with columns of the key's previous event (``{column: new
    name}``; NULL for the first).

    A window per key would put a busy key into one task. Two levels instead:
    LAG inside ``(key, seq // block)``, and the last row of each block carried
    to the key's next block (one row per key and block)."""
    ks = _keys(key)
    c = changes.withColumn("_b", F.floor(F.col(seq) / F.lit(block)).cast("bigint"))
    w = Window.partitionBy(*ks, "_b").orderBy(seq)
    image = F.struct(*[F.col(a).alias(b) for a, b in columns.items()])
    inner = c.withColumn("_p", F.lag(image).over(w))
    last = c.groupBy(*ks, "_b").agg(F.max_by(image, seq).alias("_last"))
    carried = last.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(ks)], F.col("_b").alias("_cb"),
                          F.lag("_last").over(Window.partitionBy(*ks).orderBy("_b")).alias("_carry"))
    cond = reduce(lambda x, y: x & y, [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(ks)]) & (F.col("_b") == F.col("_cb"))
    p = F.coalesce("_p", "_carry")
    return inner.join(carried, cond, "left").select(*[F.col(f"`{x}`") for x in changes.columns], *[p[n].alias(n) for n in columns.values()])


def dedup_changes(changes: DataFrame, ident: tuple[str, ...] = ("server_uuid", "txn_no", "seq"),
                  watermark: tuple[str, str] | None = None) -> DataFrame:
    """One row per event identity (T8). Batch: ``dropDuplicates``; stream:
    ``dropDuplicatesWithinWatermark`` with ``watermark=(event_time, delay)`` so
    the dedup state stays bounded.

    Spark treats rows older than the watermark as late and drops them, so
    ``delay`` must cover the log's largest disorder. The streaming apply does
    not need this operator: its ``seq`` guard makes replays harmless without
    any dedup state."""
    if changes.isStreaming and watermark:
        col, delay = watermark
        # watermarks need TIMESTAMP; change logs often carry TIMESTAMP_NTZ
        if changes.schema[col].dataType.typeName() != "timestamp":
            out = changes.withColumn("_event_time", F.col(col).cast("timestamp"))
            return out.withWatermark("_event_time", delay).dropDuplicatesWithinWatermark(list(ident)).drop(
                "_event_time")
        return changes.withWatermark(col, delay).dropDuplicatesWithinWatermark(list(ident))
    return changes.dropDuplicates(list(ident))


def route_tables(changes: DataFrame, table_col: str = "table", limit: list[str] | None = None,
                 skip: list[str] | None = None) -> DataFrame:
    """Same rule as the snapshot table filter (T9): skip beats limit; empty limit = all."""
    cond = F.lit(True)
    if skip:
        cond = cond & ~F.col(table_col).isin(*skip)
    if limit:
        cond = cond & F.col(table_col).isin(*limit)
    return changes.where(cond)


def evolve(target: DataFrame, added: list, first: bool = False, after: str | None = None) -> DataFrame:
    """Widen a target by ADD COLUMN events before a batch is applied."""
    from siltlake.operators.normalize import add_columns
    return add_columns(target, added, first=first, after=after)


# --------------------------------------------------------------------------
# T6 / T7 applied and missing transaction sets (gaps and islands)
# --------------------------------------------------------------------------

BLOCK = 1 << 20  # transaction numbers per first-level block


def applied_set(changes: DataFrame, server: str = "server_uuid", txn: str = "txn_no",
                block: int = BLOCK) -> DataFrame:
    """Maximal intervals of consecutive transaction numbers per server (T6):
    rows ``(server, interval_start, interval_end, n_txn)``.

    A window per server would put a whole server (few servers, billions of
    transactions) into one task. Two levels instead: islands inside
    ``(server, txn // block)`` (a task sorts at most ``block`` numbers), then
    only islands touching a block edge — at most two per block — are merged
    in a small second pass."""
    d = changes.select(F.col(server).alias("_s"), F.col(txn).cast("bigint").alias("_t")).distinct()
    d = d.withColumn("_b", F.floor(F.col("_t") / F.lit(block)).cast("bigint"))
    w = Window.partitionBy("_s", "_b").orderBy("_t")
    d = d.withColumn("_g", F.col("_t") - F.row_number().over(w))
    local = d.groupBy("_s", "_b", "_g").agg(F.min("_t").alias("_lo"), F.max("_t").alias("_hi"))
    return join_blocks(local.select(F.col("_s").alias("server"), F.col("_b").alias("block"), F.col("_lo").alias("lo"), F.col("_hi").alias("hi")),
                       block).withColumnRenamed("server", server)


def merge_intervals(intervals: DataFrame) -> DataFrame:
    """Maximal intervals of the union of ``(server, block, lo, hi)`` rows,
    which may overlap or repeat; a task sees one block at a time."""
    w = Window.partitionBy("server", "block").orderBy("lo", "hi")
    reach = F.max("hi").over(w.rowsBetween(Window.unboundedPreceding, -1))
    begins = F.coalesce((F.col("lo") > reach + 1).cast("int"), F.lit(1))
    run = F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0))
    return (intervals.withColumn("_new", begins).withColumn("_run", run).groupBy("server", "block", "_run")
            .agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")).drop("_run"))


def join_blocks(local: DataFrame, block: int = BLOCK) -> DataFrame:
    """``(server, interval_start, interval_end, n_txn)`` from the maximal
    intervals ``(server, block, lo, hi)`` of each block: only those at a block
    edge, at most two a block, are joined."""
    # coalesce keeps the two filters free of inferred IS NOT NULL predicates,
    # so both branches share one scan + shuffle (exchange reuse)
    edge = F.coalesce((F.col("lo") == F.col("block") * block) | (F.col("hi") == (F.col("block") + 1) * block - 1), F.lit(False))
    inner, touching = local.where(~edge), local.where(edge)
    w = Window.partitionBy("server").orderBy("lo")
    starts = touching.withColumn("_new", F.coalesce((F.lag("hi").over(w) + 1 != F.col("lo")).cast("int"), F.lit(1)))
    starts = starts.withColumn("_run", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    merged = starts.groupBy("server", "_run").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    out = inner.select("server", "lo", "hi").unionByName(merged.select("server", "lo", "hi"))
    return out.select("server", F.col("lo").alias("interval_start"), F.col("hi").alias("interval_end"),
                      (F.col("hi") - F.col("lo") + 1).cast("bigint").alias("n_txn"))


def interval_text(islands: DataFrame, server: str = "server_uuid", block: int = BLOCK) -> DataFrame:
    """The ``uuid:1-5:7-9`` text form of :func:`applied_set` rows, as ordered
    chunks: one row ``(server, chunk, text)`` per ``interval_start // block``.

    The text of a whole server grows with its number of intervals, so it is
    never built in one group: each chunk holds the intervals starting in one
    block (bounded by the block size), and the full set is
    ``server + ':' + chunk texts joined by ':' in chunk order``."""
    iv = F.when(F.col("interval_start") == F.col("interval_end"), F.col("interval_start").cast("string")).otherwise(
        F.concat(F.col("interval_start").cast("string"), F.lit("-"), F.col("interval_end").cast("string")))
    chunk = F.floor(F.col("interval_start") / F.lit(block)).cast("bigint")
    parts = F.array_sort(F.collect_list(F.struct(F.col("interval_start"), iv.alias("t"))))
    return islands.groupBy(F.col(server), chunk.alias("chunk")).agg(
        F.array_join(F.transform(parts, lambda x: x["t"]), ":").alias("text"))


def gaps(islands: DataFrame, server: str = "server_uuid", block: int = BLOCK) -> DataFrame:
    """Numbers missing between consecutive islands of one server (T7):
    ``(server, gap_start, gap_end, n_missing)``.

    The next island's start is found inside ``(server, start // block)``; the
    last island of a block takes the first start of the next non-empty block
    from a per-block table (one row per block)."""
    isl = islands.select(F.col(server).alias("_s"), F.col("interval_start").alias("_lo"),
                         F.col("interval_end").alias("_hi"))
    isl = isl.withColumn("_b", F.floor(F.col("_lo") / F.lit(block)).cast("bigint"))
    w = Window.partitionBy("_s", "_b").orderBy("_lo")
    isl = isl.withColumn("_next", F.lead("_lo").over(w))
    # the per-block table comes from the same windowed rows: one shared shuffle
    blocks = isl.groupBy("_s", "_b").agg(F.min("_lo").alias("_first"))
    wb = Window.partitionBy("_s").orderBy("_b")
    blocks = blocks.withColumn("_after", F.lead("_first").over(wb)).select("_s", "_b", "_after")
    blocks = blocks.select(F.col("_s").alias("_bs"), F.col("_b").alias("_bb"), "_after")
    # null-safe keys: no inferred IS NOT NULL filters, so the islands below
    # both sides stay identical and their shuffles are reused
    j = isl.join(blocks, isl["_s"].eqNullSafe(blocks["_bs"]) & isl["_b"].eqNullSafe(blocks["_bb"]), "left")
    nxt = F.coalesce(F.col("_next"), F.col("_after"))
    g = j.where(nxt.isNotNull()).select(
        F.col("_s").alias(server), (F.col("_hi") + 1).alias("gap_start"), (nxt - 1).alias("gap_end"),
        (nxt - F.col("_hi") - 1).cast("bigint").alias("n_missing"))
    return g


def missing_set(expected: DataFrame, applied: DataFrame | None = None, server: str = "server_uuid",
                txn: str = "txn_no") -> DataFrame:
    """Transactions present at the source and absent here, as intervals.

    With ``applied``: anti join on (server, txn) — keys only — then islands of
    what is left. Without: the gaps inside ``expected``'s own islands."""
    if applied is None:
        return gaps(applied_set(expected, server, txn), server)
    e = expected.select(server, txn).distinct()
    a = applied.select(server, txn).distinct()
    return applied_set(e.join(a, [server, txn], "left_anti"), server, txn).withColumnRenamed(
        "n_txn", "n_missing").withColumnRenamed("interval_start", "gap_start").withColumnRenamed(
        "interval_end", "gap_end")


# --------------------------------------------------------------------------
# Q11 audit of a change log
# --------------------------------------------------------------------------

def change_log_audit(images: DataFrame, columns: list[str], server: str = "server_uuid", txn: str = "txn_no",
                     seq: str = "seq", op: str = "op", before: str = "before_", after: str = "after_") -> DataFrame:
    """Per server: events, update/delete without a before image,
    insert/update without an after image, duplicated ``(server, txn, seq)``
    and transaction numbers missing between the first and last seen. An image
    is missing where its flag column (``before_present`` / ``after_present``)
    says so; without that column, where all its columns are NULL.

    Three stacked partial aggregates (event -> transaction -> server);
    nothing is collected per group."""
    def missing(prefix: str) -> Column:
        if prefix + "present" in images.columns:  # an all-NULL row is an image too
            return ~F.coalesce(F.col(prefix + "present"), F.lit(False))
        return reduce(lambda a, b: a & b, [F.col(prefix + c).isNull() for c in columns])

    no_before, no_after = missing(before), missing(after)
    ev = images.groupBy(server, txn, seq).agg(
        F.count(F.lit(1)).alias("_n"),
        F.sum((F.col(op).isin("update", DELETE) & no_before).cast("int")).alias("_nb"),
        F.sum((F.col(op).isin("insert", "update") & no_after).cast("int")).alias("_na"))
    tx = ev.groupBy(server, txn).agg(F.sum("_n").alias("_n"), F.sum(F.col("_n") - 1).alias("_dup"),
                                     F.sum("_nb").alias("_nb"), F.sum("_na").alias("_na"))
    sv = tx.groupBy(server).agg(
        F.sum("_n").cast("bigint").alias("n_events"),
        F.sum("_nb").cast("bigint").alias("missing_before_image"),
        F.sum("_na").cast("bigint").alias("missing_after_image"),
        F.sum("_dup").cast("bigint").alias("duplicate_events"),
        (F.max(txn) - F.min(txn) + 1 - F.count(F.lit(1))).cast("bigint").alias("missing_txn"))
    return sv
