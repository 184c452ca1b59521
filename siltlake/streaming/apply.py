"""Keep a lake table current from a change stream (S6, S7, T4 streaming, T10).

The target is stored as hash buckets of the key. Every commit has a number;
its files lie in a folder of their own, and one small manifest file, published
whole under its name only if that is free, makes them part of the table::

    <target>/table.json                             keys, seq column, bucket count
    <target>/_schemas/<id>.json                      a schema (with defaults of added columns)
    <target>/data/v=<commit>-<random>/bucket=<b>/    base or delta rows of a bucket
    <target>/_manifest/batch=<commit>/entries.json   (bucket, version, dir, delta, rows, schema), and
                                                     (-1, version, writer, batch, rows) as the last row,
                                                     rows being the number of buckets
    <target>/_manifest/batch=<commit>/void.json      (-2, version): the number is passed over

A micro-batch collapses its changes per key (last by ``seq``, tombstones
kept). A bucket that gets few changes against its size only gets a delta
beside its base; one whose deltas would exceed ``delta_share`` of its base, or
``MAX_DELTAS`` in number, is rewritten. So a batch of random keys over a large
table writes about its own size, and readers merge a bounded number of deltas.

A batch is skipped only if the same writer has committed the same batch id;
two writers, a new checkpoint or a batch job never hide each other's batches.
A writer that finds its commit number taken reads the manifest again and
redoes its batch. An older event never wins over a newer one, because every
merge is by ``seq``. Nothing is overwritten in place.

A commit counts once its last row is there. A number whose file lacks it (a
writer died on a store that shows files in part) is passed over with a void
entry, which holds even if the rest of the file should turn up; data folders
that no commit refers to are swept by ``vacuum``.

Buckets split one at a time by linear hashing (``grow``): bucket b takes its
rows from the bucket below it by the largest power of two in b, and no other
file is touched. With ``track`` the commit also holds the set of transactions
applied so far, as intervals per server and block of numbers; a batch reads
and writes the blocks that it touches only.
"""

from __future__ import annotations

import json
import uuid
import zlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from siltlake.functions.columns import linear_hash_label
from siltlake.operators.changes import BLOCK, DELETE, join_blocks, last_rows, latest_state, merge_intervals, with_previous
from siltlake.session import put_new_file

DELETED = "_deleted"
BUCKET = "bucket"
MAX_DELTAS = 8
#: commits that a batch may lose to other writers before it gives up
MAX_TRIES = 20
#: bucket numbers from here on hold the applied set
APPLIED, APPLIED_BUCKETS = 1 << 30, 16
_ROWS = ("bucket int, version long, dir string, delta boolean, rows long, schema string, writer string, batch long")
_INTERVALS = T.StructType().add("server", "string").add("block", "long").add("version", "long").add(
    "intervals", T.ArrayType(T.StructType().add("lo", "long").add("hi", "long")))
#: numeric types from narrow to wide; a column may only move to the right
_WIDER = ("tinyint", "smallint", "int", "bigint", "float", "double")


def wider_type(name: str, old: T.DataType, new: T.DataType) -> T.DataType:
    """The type that holds both; an error where none of them does."""
    a, b = old.simpleString(), new.simpleString()
    if a == b or b == "void":
        return old
    if a == "void":
        return new
    if a in _WIDER and b in _WIDER and "float" not in (a, b):
        return old if _WIDER.index(a) >= _WIDER.index(b) else new
    if isinstance(old, T.DecimalType) and isinstance(new, T.DecimalType):
        scale = max(old.scale, new.scale)
        whole = max(old.precision - old.scale, new.precision - new.scale)
        if whole + scale <= 38:
            return T.DecimalType(whole + scale, scale)
    raise ValueError(f"column {name}: {a} and {b} have no common wider type")


class CommitContention(RuntimeError):
    """A batch lost too many commit numbers to other writers."""


class VersionedTable:
    """A keyed table stored as hash buckets (base and deltas) behind a manifest.

    ``rows_per_bucket``: buckets are split after a batch that leaves more rows
    than that in the average bucket. ``updated_at=(column, event_time)``: an ON
    UPDATE timestamp, set to the event time of the last event that changed
    another column of its row (events of a later batch count as later).
    ``track=(server, transaction number)``: columns of the changes, not stored
    with the rows, from which the applied set is kept."""

    MARKER, VOID = -1, -2

    def __init__(self, spark: SparkSession, path: str, key: str | list[str] = "pk", seq: str = "seq",
                 buckets: int | None = None, tombstone_retention: int | None = None, writer: str | None = None,
                 delta_share: float = 0.25, updated_at: tuple[str, str] | None = None,
                 rows_per_bucket: int | None = None, track: tuple[str, str] | None = None, block: int = BLOCK):
        self.spark = spark
        self.path = path.rstrip("/")
        self.keys = [key] if isinstance(key, str) else list(key)
        self.seq = seq
        # H5: a tombstone is dropped once it is this many seq units older than
        # the newest event of the batch that rewrites its bucket (None: keep)
        self.tombstone_retention = tombstone_retention
        self.writer = writer or uuid.uuid4().hex
        self.delta_share = delta_share
        self.updated_at = updated_at  # ON UPDATE timestamp column and the event time it takes
        self.rows_per_bucket = rows_per_bucket
        stored = self._stored()
        if stored is None:
            stored = {"keys": self.keys, "seq": seq, "buckets": buckets or 64, "hashing": "linear",
                      "track": list(track) if track else None, "block": block}
            if not put_new_file(spark, f"{self.path}/table.json", json.dumps(stored)):
                stored = self._stored()
        asked = (("keys", self.keys), ("seq", seq), ("buckets", buckets or stored["buckets"]), ("track", list(track) if track else stored.get("track")))
        for what, value in asked:
            if stored.get(what) != value:
                raise ValueError(f"{self.path} has {what} {stored.get(what)!r}, not {value!r}")
        self.first_buckets = stored["buckets"]
        self.linear = stored.get("hashing") == "linear"  # tables from before have a fixed number of buckets
        self.track, self.block = stored.get("track"), stored.get("block", BLOCK)
        self._cache = None
        self._schemas: dict[str, T.StructType] = {}

    # -- layout -----------------------------------------------------------
    @property
    def manifest_path(self) -> str:
        return f"{self.path}/_manifest"

    @property
    def snapshots_path(self) -> str:
        return f"{self.path}/_snapshots"

    @property
    def buckets(self) -> int:
        """How many buckets the last commit has."""
        return self._snapshot()["buckets"]

    def bucket_of(self, buckets: int | None = None) -> F.Column:
        n, h = buckets or self.buckets, F.xxhash64(*[F.col(k) for k in self.keys])
        return (linear_hash_label(h, n) if self.linear else F.pmod(h, F.lit(n))).cast("int")

    def _applied_bucket(self) -> F.Column:
        return (F.pmod(F.xxhash64("server", "block"), F.lit(APPLIED_BUCKETS)) + APPLIED).cast("int")

    def _fs(self):
        jvm = self.spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(self.path)
        return jvm, p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def _list(self, path: str, prefix: str) -> list[str]:
        """Names under ``path`` starting with ``prefix`` (one listing call)."""
        jvm, fs = self._fs()
        p = jvm.org.apache.hadoop.fs.Path(path)
        if not fs.exists(p):
            return []
        return [st.getPath().getName() for st in fs.listStatus(p) if st.getPath().getName().startswith(prefix)]

    def _delete(self, path: str) -> bool:
        jvm, fs = self._fs()
        return bool(fs.delete(jvm.org.apache.hadoop.fs.Path(path), True))

    def _text(self, path: str) -> str:
        return "\n".join(r["value"] for r in self.spark.read.text(path).collect())  # a metadata file of our own

    def _stored(self) -> dict | None:
        return json.loads(self._text(f"{self.path}/table.json")) if self._list(self.path, "table.json") else None

    # -- schemas ----------------------------------------------------------
    def _schema_id(self, schema: T.StructType) -> str:
        text = schema.json()
        name = f"{zlib.crc32(text.encode()):08x}-{len(text)}"
        put_new_file(self.spark, f"{self.path}/_schemas/{name}.json", text)
        self._schemas[name] = schema
        return name

    def _schema_of(self, name: str) -> T.StructType:
        if name not in self._schemas:
            self._schemas[name] = T.StructType.fromJson(json.loads(self._text(f"{self.path}/_schemas/{name}.json")))
        return self._schemas[name]

    @staticmethod
    def _aligned(df: DataFrame, schema: T.StructType) -> DataFrame:
        """``df`` with the columns and types of ``schema``; a missing column
        gets the default it was added with."""
        have = set(df.columns)
        return df.select(*[
            (F.col(f.name) if f.name in have else F.lit(f.metadata.get("default"))).cast(f.dataType).alias(f.name, metadata=f.metadata)
            for f in schema.fields])

    def _merged_schema(self, current: T.StructType | None, incoming: T.StructType) -> T.StructType:
        if current is None:
            return incoming
        new = {f.name: f for f in incoming.fields}
        fields = [T.StructField(f.name, wider_type(f.name, f.dataType, new[f.name].dataType) if f.name in new else f.dataType, True, f.metadata)
                  for f in current.fields]
        return T.StructType(fields + [T.StructField(f.name, f.dataType, True, f.metadata) for f in incoming.fields if f.name not in current.fieldNames()])

    # -- manifest ---------------------------------------------------------
    def _numbers(self, path: str, prefix: str, suffix: str = "") -> list[int]:
        return sorted(int(n[len(prefix):len(n) - len(suffix)]) for n in self._list(path, prefix) if n.endswith(suffix))

    def _commits(self, numbers: list[int]) -> DataFrame | None:
        """The rows of the commits that are whole and not passed over."""
        paths = [f"{self.manifest_path}/batch={b}" for b in numbers]
        if not paths:
            return None
        of = Window.partitionBy("version")
        whole = F.max((F.col("bucket") == self.MARKER).cast("int")).over(of) - 2 * F.max((F.col("bucket") == self.VOID).cast("int")).over(of)
        return self.spark.read.schema(_ROWS).json(paths).withColumn("_whole", whole).where("_whole = 1").drop("_whole")

    def _manifest(self) -> DataFrame | None:
        """Manifest rows still needed: the latest compacted snapshot (if any)
        plus the commits after it."""
        snaps = self._numbers(self.snapshots_path, "snap-", ".json")
        commits = self._commits([b for b in self._numbers(self.manifest_path, "batch=") if not snaps or b > snaps[-1]])
        if not snaps:
            return commits
        snapshot = self.spark.read.schema(_ROWS).json(f"{self.snapshots_path}/snap-{snaps[-1]}.json")
        return snapshot if commits is None else snapshot.unionByName(commits)

    def _snapshot(self, refresh: bool = False) -> dict:
        """``live``: per bucket its base row and later delta rows; ``writers``:
        last batch of each; ``last``: the last commit; ``schema``: its id;
        ``buckets``: how many. The live rows are at most
        ``(buckets + APPLIED_BUCKETS) * (1 + MAX_DELTAS)``."""
        if self._cache is not None and not refresh:
            return self._cache
        m = self._manifest()
        live: dict[int, list] = {}
        writers: dict[str, int] = {}
        last, schema, buckets = None, None, self.first_buckets
        if m is not None:
            at = Window.partitionBy("bucket")
            base = F.max(F.when(~F.col("delta"), F.col("version"))).over(at)
            rows = m.withColumn("_base", F.coalesce(base, F.lit(-2))).where(
                (F.col("bucket") == self.MARKER) | (F.col("version") >= F.col("_base"))).drop("_base").collect()
            marks = [r for r in rows if r["bucket"] == self.MARKER]
            for r in marks:
                writers[r["writer"]] = max(r["batch"], writers.get(r["writer"], r["batch"]))
            if marks:
                newest = max(marks, key=lambda r: r["version"])
                last, schema, buckets = newest["version"], newest["schema"], newest["rows"] or buckets
            for r in sorted((r for r in rows if r["bucket"] != self.MARKER), key=lambda r: r["version"]):
                live.setdefault(r["bucket"], []).append(r.asDict())
        self._cache = {"live": live, "writers": writers, "last": last, "schema": schema, "buckets": buckets}
        return self._cache

    def _live(self, s: dict, applied: bool = False) -> dict[int, list]:
        return {b: rows for b, rows in s["live"].items() if (b >= APPLIED) == applied}

    def _next_number(self, s: dict, first: int = 0) -> int | None:
        """The number of the commit after ``s``; None if another writer has
        made that commit meanwhile. Numbers with a file that is not whole are
        passed over for good."""
        number = first if s["last"] is None else s["last"] + 1
        while True:
            folder = f"{self.manifest_path}/batch={number}"
            if not self._list(folder, "entries.json"):
                if not self._list(folder, "void.json"):
                    return number
            elif self._commits([number]).count():
                return None
            else:
                put_new_file(self.spark, f"{folder}/void.json", json.dumps({"bucket": self.VOID, "version": number}) + "\n")
            number += 1

    def compact_manifest(self) -> int | None:
        """Write the live rows as a snapshot; readers then skip every commit up
        to it, so restart cost does not grow with the length of the stream.
        Returns the commit it covers."""
        s = self._snapshot(refresh=True)
        if s["last"] is None:
            return None
        entries = [r for rows in s["live"].values() for r in rows]
        entries += [{"bucket": self.MARKER, "version": s["last"], "schema": s["schema"], "writer": w, "batch": b, "rows": s["buckets"]} for w, b in s["writers"].items()]
        put_new_file(self.spark, f"{self.snapshots_path}/snap-{s['last']}.json", "".join(json.dumps(e) + "\n" for e in entries))
        return s["last"]

    def is_committed(self, batch_id: int, writer: str | None = None) -> bool:
        """Whether the writer (any, if not given) has committed the batch."""
        s = self._snapshot()["writers"]
        return any(batch_id <= b for w, b in s.items() if writer in (None, w))

    # -- read -------------------------------------------------------------
    def _read(self, rows: list[dict], schema: T.StructType) -> DataFrame | None:
        by_schema: dict[str, list[str]] = {}
        for r in rows:
            by_schema.setdefault(r["schema"], []).append(f"{self.path}/data/{r['dir']}/bucket={r['bucket']}")
        parts = [self._aligned(self.spark.read.schema(self._schema_of(name)).parquet(*paths), schema) for name, paths in sorted(by_schema.items())]
        out = None
        for p in parts:
            out = p if out is None else out.unionByName(p)
        return out

    def _current(self, live: dict[int, list], schema: T.StructType) -> DataFrame | None:
        """Last row per key; buckets without deltas are read as they are."""
        plain = self._read([rows[0] for rows in live.values() if len(rows) == 1], schema)
        mixed = self._read([r for rows in live.values() if len(rows) > 1 for r in rows], schema)
        if mixed is None:
            return plain
        mixed = last_rows(mixed, self.keys, self.seq).select(*schema.fieldNames())
        return mixed if plain is None else plain.unionByName(mixed)

    def state(self, with_tombstones: bool = False) -> DataFrame:
        """Current rows (live only unless ``with_tombstones``); re-reads the
        manifest, so a long-lived reader sees every commit."""
        s = self._snapshot(refresh=True)
        if s["last"] is None:
            raise ValueError(f"{self.path} has no committed version")
        schema = self._schema_of(s["schema"])
        df = self._current(self._live(s), schema)
        if df is None:
            df = self.spark.createDataFrame([], schema)
        return df if with_tombstones else df.where(~F.col(DELETED)).drop(DELETED)

    def applied(self) -> DataFrame:
        """The transactions applied so far (T6): ``(server, interval_start,
        interval_end, n_txn)``, from the kept intervals alone."""
        if not self.track:
            raise ValueError(f"{self.path} does not track transactions")
        rows = self._intervals(self._live(self._snapshot(refresh=True), applied=True))
        return join_blocks(rows, self.block).withColumnRenamed("server", self.track[0])

    def _intervals(self, live: dict[int, list]) -> DataFrame:
        """``(server, block, lo, hi)`` of the last state of each block."""
        if not live:
            return self.spark.createDataFrame([], "server string, block long, lo long, hi long")
        rows = last_rows(self._read([r for rows in live.values() for r in rows], _INTERVALS), ["server", "block"], "version")
        return rows.select("server", "block", F.inline("intervals"))

    # -- write ------------------------------------------------------------
    def _write(self, rows: DataFrame, bucket: F.Column, version: int, touched: list[int]) -> str:
        """The rows under their buckets, in a new folder; a touched bucket
        without rows gets a (schema-only) file."""
        folder = f"v={version}-{uuid.uuid4().hex[:8]}"
        path = f"{self.path}/data/{folder}"
        rows.withColumn(BUCKET, bucket).hint("rebalance", BUCKET).write.partitionBy(BUCKET).parquet(path)
        written = {int(n.split("=", 1)[1]) for n in self._list(path, f"{BUCKET}=")}
        for b in (b for b in touched if b not in written):
            self.spark.createDataFrame([], rows.schema).write.mode("overwrite").parquet(f"{path}/bucket={b}")
        return folder

    def _commit(self, version: int, entries: list[dict], schema: str, batch: int, buckets: int) -> bool:
        """False if another writer has taken this commit number."""
        entries = [*entries, {"bucket": self.MARKER, "version": version, "schema": schema, "writer": self.writer, "batch": batch, "rows": buckets}]
        done = put_new_file(self.spark, f"{self.manifest_path}/batch={version}/entries.json", "".join(json.dumps(e) + "\n" for e in entries))
        self._cache = None
        return done

    def _commit_over(self, attempt, first: int = 0):
        """``attempt(snapshot, number)`` until it commits (true) or finds that
        there is nothing to do (None); what it returned last."""
        for _ in range(MAX_TRIES):
            s = self._snapshot(refresh=True)
            number = self._next_number(s, first)
            if number is None:
                continue
            done = attempt(s, number)
            if done is None or done:
                return done
        raise CommitContention(f"{self.path}: {MAX_TRIES} commits were lost to other writers")

    def initialize(self, rows: DataFrame, version: int = -1) -> None:
        """Publish an initial snapshot (key…, seq, columns…), unless the table
        has a commit already."""
        if DELETED not in rows.columns:
            rows = rows.withColumn(DELETED, F.lit(False))

        def attempt(s: dict, number: int):
            if s["last"] is not None:
                return None
            schema, n = self._schema_id(rows.schema), s["buckets"]
            folder = self._write(rows, self.bucket_of(n), number, list(range(n)))
            sizes = {r[BUCKET]: r["count"] for r in rows.groupBy(self.bucket_of(n).alias(BUCKET)).count().collect()}
            return self._commit(number, [{"bucket": b, "version": number, "dir": folder, "delta": False, "rows": sizes.get(b, 0), "schema": schema}
                                         for b in range(n)], schema, version, n)

        self._commit_over(attempt, version)

    def add_column(self, name: str, data_type: str, default: str | None = None) -> None:
        """ADD COLUMN on the live table (T10): rows written before get the default."""
        def attempt(s: dict, number: int):
            old = self._schema_of(s["schema"])
            field = T.StructField(name, T._parse_datatype_string(data_type), True, {} if default is None else {"default": default})
            fields = [f for f in old.fields if f.name != DELETED] + [field] + [f for f in old.fields if f.name == DELETED]
            return self._commit(number, [], self._schema_id(T.StructType(fields)), s["writers"].get(self.writer, -1), s["buckets"])

        self._commit_over(attempt)

    def grow(self, buckets: int) -> list[int]:
        """Split buckets, one after the other, until there are ``buckets``.
        Returns those that were rewritten; all others keep their files."""
        if not self.linear:
            raise ValueError(f"{self.path} has a fixed number of buckets")
        touched: list[int] = []

        def attempt(s: dict, number: int):
            n = s["buckets"]
            if buckets <= n or s["last"] is None:
                return None

            def source(b: int) -> int:
                while b >= n:
                    b -= 1 << (b.bit_length() - 1)
                return b

            split = sorted({source(b) for b in range(n, buckets)})
            touched[:] = [*split, *range(n, buckets)]
            schema = self._schema_of(s["schema"])
            rows = self._current({b: s["live"][b] for b in split if b in s["live"]}, schema)
            rows = (rows if rows is not None else self.spark.createDataFrame([], schema)).persist()
            try:
                folder = self._write(rows, self.bucket_of(buckets), number, touched)
                sizes = {r[BUCKET]: r["count"] for r in rows.groupBy(self.bucket_of(buckets).alias(BUCKET)).count().collect()}
            finally:
                rows.unpersist()
            entries = [{"bucket": b, "version": number, "dir": folder, "delta": False, "rows": sizes.get(b, 0), "schema": s["schema"]} for b in touched]
            return self._commit(number, entries, s["schema"], s["writers"].get(self.writer, -1), buckets)

        self._commit_over(attempt)
        return touched

    def apply_batch(self, changes: DataFrame, batch_id: int, op: str = "op") -> bool:
        """Merge one batch of changes; returns False when this writer has
        committed ``batch_id`` (a retry) and nothing was done. The batch ids
        of a writer ascend. A writer that loses its commit number to others
        ``MAX_TRIES`` times raises :class:`CommitContention`."""
        transactions = None
        if self.track:
            server, number = self.track
            transactions = changes.select(F.col(server).cast("string").alias("server"), F.col(number).cast("long").alias("lo")).where("lo IS NOT NULL").distinct()
            changes = changes.drop(*self.track)
        stamped = changes
        if self.updated_at:
            column, event_time = self.updated_at
            changes = changes.withColumn(column, F.col(event_time)).drop(*({event_time} - {column}))
        incoming = latest_state(changes, self.keys, self.seq, op, keep_deletes=True)
        incoming = incoming.withColumn(DELETED, F.col(op) == DELETE).drop(op).persist()
        sizes: dict[int, dict[int, int]] = {}
        try:
            newest = incoming.agg(F.max(self.seq)).first()[0] if self.tombstone_retention is not None else None

            def attempt(s: dict, number: int):
                if batch_id <= s["writers"].get(self.writer, batch_id - 1):
                    return None
                n = s["buckets"]
                if n not in sizes:
                    sizes[n] = {r[BUCKET]: r["count"] for r in incoming.groupBy(self.bucket_of(n).alias(BUCKET)).count().collect()}  # <= n rows
                rows = self._stamped(incoming, stamped, s, sizes[n], op) if self.updated_at else incoming
                return self._apply(rows, sizes[n], newest, s, batch_id, number, transactions)

            done = bool(self._commit_over(attempt))
        finally:
            incoming.unpersist()
        if done and self.rows_per_bucket:
            s = self._snapshot(refresh=True)
            held = sum(r["rows"] for rows in self._live(s).values() for r in rows)
            wanted = min(-(-held // self.rows_per_bucket), 2 * s["buckets"])  # at most each bucket once a batch
            if wanted > s["buckets"]:
                self.grow(wanted)
        return done

    def _stamped(self, incoming: DataFrame, changes: DataFrame, s: dict, sizes: dict[int, int], op: str) -> DataFrame:
        """``incoming`` with its ON UPDATE column: the time of the last event
        that changed a row, against the row stored or the event before it."""
        column, event_time = self.updated_at
        schema = self._schema_of(s["schema"]) if s["schema"] else None
        others = [c for c in incoming.columns if c not in (*self.keys, self.seq, column, DELETED)]
        image = F.struct(*[F.col(c) for c in others], F.col(DELETED)).alias("_image")
        events = (changes.withColumn(DELETED, F.col(op) == DELETE).dropDuplicates([*self.keys, self.seq])
                  .select(*self.keys, self.seq, F.lit(False).alias("_stored"), F.col(event_time).alias("_time"), image))
        stored = self._current({b: s["live"][b] for b in sizes if b in s["live"]}, schema) if schema else None
        if stored is not None:
            wide = self._aligned(stored, self._merged_schema(schema, incoming.schema)).join(incoming.select(*self.keys), self.keys, "left_semi")
            types = {f.name: f.dataType for f in incoming.schema.fields}
            held = F.struct(*[F.col(c).cast(types[c]).alias(c) for c in others], F.col(DELETED)).alias("_image")
            events = events.unionByName(wide.select(*self.keys, self.seq, F.lit(True).alias("_stored"), F.col(column).cast(types[column]).alias("_time"), held))
        seen = with_previous(events, {"_image": "_before"}, self.keys, self.seq)
        # a struct of equal fields is equal, nulls included; no row before: an insert
        times = (seen.where(F.col("_stored") | ~F.col("_image").eqNullSafe(F.col("_before")))
                 .groupBy(*self.keys).agg(F.max_by(F.struct("_time"), self.seq)["_time"].alias("_time")))
        return incoming.drop(column).join(times, self.keys, "left").withColumnRenamed("_time", column).select(*incoming.columns)

    def _placed(self, sizes: dict[int, int], live: dict[int, list]) -> tuple[dict[int, list], list[int]]:
        """Buckets to rewrite (with what they hold) and to append a delta to."""
        rewrite, append = {}, []
        for b, n in sizes.items():
            rows = live.get(b, [])
            later = sum(r["rows"] for r in rows[1:]) + n
            if not rows or len(rows) > MAX_DELTAS or later > self.delta_share * rows[0]["rows"]:
                rewrite[b] = rows
            else:
                append.append(b)
        return rewrite, append

    def _apply(self, incoming: DataFrame, sizes: dict[int, int], newest, s: dict, batch_id: int, version: int | None = None,
               transactions: DataFrame | None = None) -> bool:
        if version is None:
            version = 0 if s["last"] is None else s["last"] + 1
        schema = self._merged_schema(self._schema_of(s["schema"]) if s["schema"] else None, incoming.schema)
        rewrite, append = self._placed(sizes, s["live"])
        aligned, bucket = self._aligned(incoming, schema), self.bucket_of(s["buckets"])
        own = aligned.where(bucket.isin(append)) if append else None
        merged = aligned.where(~bucket.isin(append)) if append else aligned
        old = self._read([r for rows in rewrite.values() for r in rows], schema)
        if old is not None:
            merged = last_rows(old.unionByName(merged), self.keys, self.seq).select(*schema.fieldNames())
        if newest is not None:
            merged = merged.where(~(F.col(DELETED) & (F.col(self.seq) < F.lit(newest - self.tombstone_retention))))
        name = self._schema_id(schema)
        folder = self._write(merged if own is None else merged.unionByName(own), bucket, version, sorted(sizes)) if sizes else None
        entries = [{"bucket": b, "version": version, "dir": folder, "delta": False, "schema": name,
                    "rows": sum(r["rows"] for r in rows) + sizes[b]} for b, rows in rewrite.items()]
        entries += [{"bucket": b, "version": version, "dir": folder, "delta": True, "rows": sizes[b], "schema": name} for b in append]
        if transactions is not None:
            entries += self._apply_transactions(transactions, s, version)
        return self._commit(version, entries, name, batch_id, s["buckets"])

    def _apply_transactions(self, transactions: DataFrame, s: dict, version: int) -> list[dict]:
        """Entries of the applied set with a batch's transactions: the blocks
        that it touches are read, merged and written; no other."""
        new = transactions.select("server", F.floor(F.col("lo") / self.block).cast("long").alias("block"), "lo", F.col("lo").alias("hi"))
        blocks = new.select("server", "block").distinct().persist()
        try:
            sizes = {r[BUCKET]: r["count"] for r in blocks.groupBy(self._applied_bucket().alias(BUCKET)).count().collect()}  # <= APPLIED_BUCKETS rows
            if not sizes:
                return []
            live = self._live(s, applied=True)
            held = self._intervals({b: live[b] for b in sizes if b in live})
            same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in ("server", "block")]
            held = held.join(blocks.select(F.col("server").alias("_server"), F.col("block").alias("_block")), same, "left_semi")
            merged = (merge_intervals(new.unionByName(held)).groupBy("server", "block")
                      .agg(F.array_sort(F.collect_list(F.struct("lo", "hi"))).alias("intervals"))  # at most half a block of them
                      .select("server", "block", F.lit(version).cast("long").alias("version"), "intervals"))
            rewrite, append = self._placed(sizes, live)
            schema = _INTERVALS
            old = self._read([r for rows in rewrite.values() for r in rows], schema)
            if old is not None:
                merged = last_rows(old.unionByName(merged), ["server", "block"], "version").select(*schema.fieldNames())
            name = self._schema_id(schema)
            folder = self._write(merged, self._applied_bucket(), version, [])
        finally:
            blocks.unpersist()
        return [{"bucket": b, "version": version, "dir": folder, "delta": b not in rewrite, "schema": name,
                 "rows": sizes[b] + sum(r["rows"] for r in rewrite.get(b, []))} for b in sizes]

    def vacuum(self, keep_commits: int = 10) -> int:
        """Delete what no reader of the last ``keep_commits`` commits needs:
        bucket folders that a rewrite replaced before them, data folders that
        no commit refers to (of lost races and of writers that died), and
        manifests that an older snapshot covers. Returns how many bucket
        folders went."""
        last = self._snapshot(refresh=True)["last"]
        if last is None:
            return 0
        gone = 0
        for r in vacuum_plan(self).where(F.col("replaced_by") <= last - keep_commits).toLocalIterator():
            path = f"{self.path}/data/{r['dir']}/bucket={r['bucket']}"
            gone += bool(self._list(f"{self.path}/data/{r['dir']}", f"bucket={r['bucket']}")) and self._delete(path)
        old = [n for n in self._numbers(self.snapshots_path, "snap-", ".json") if n <= last - keep_commits]
        for n in old[:-1]:
            self._delete(f"{self.snapshots_path}/snap-{n}.json")
        for n in self._numbers(self.manifest_path, "batch="):
            if old and n <= old[-1]:
                self._delete(f"{self.manifest_path}/batch={n}")
        # a folder is named before its commit, so only numbers that are decided are looked at
        known = {r["dir"] for r in _history(self).select("dir").distinct().toLocalIterator()}
        for name in self._list(f"{self.path}/data", "v="):
            if int(name[2:].rsplit("-", 1)[0]) <= last and name not in known:
                self._delete(f"{self.path}/data/{name}")
        return gone


def apply_stream(changes: DataFrame, target: VersionedTable, checkpoint: str, op: str = "op",
                 available_now: bool = True, processing_time: str | None = None,
                 dedup: tuple[str, ...] | None = None, compact_every: int = 100):
    """Start the streaming apply (S7): ``foreachBatch`` runs
    :meth:`VersionedTable.apply_batch` with the micro-batch id; the source
    position lives in ``checkpoint``. Every ``compact_every`` batches the
    manifest is compacted. The writer is named after the checkpoint, so a
    restart skips what it has committed and other streams do not interfere.
    ``dedup`` is not needed for replays: merging by ``seq`` makes them
    harmless. Returns the ``StreamingQuery``."""
    target.writer = f"stream:{checkpoint.rstrip('/')}"
    src = changes.dropDuplicates(list(dedup)) if dedup and not changes.isStreaming else changes

    def run(batch: DataFrame, batch_id: int) -> None:
        b = batch.dropDuplicates(list(dedup)) if dedup else batch
        if target.apply_batch(b, batch_id, op) and compact_every and batch_id % compact_every == compact_every - 1:
            target.compact_manifest()

    w = src.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
    if processing_time:
        w = w.trigger(processingTime=processing_time)
    elif available_now:
        w = w.trigger(availableNow=True)
    return w.start()


def _history(target: VersionedTable) -> DataFrame:
    """The bucket rows of all commits and snapshots that are kept."""
    rows = target._commits(target._numbers(target.manifest_path, "batch="))
    snaps = [f"{target.snapshots_path}/snap-{n}.json" for n in target._numbers(target.snapshots_path, "snap-", ".json")]
    if snaps:
        snapshot = target.spark.read.schema(_ROWS).json(snaps)
        rows = snapshot if rows is None else rows.unionByName(snapshot)
    if rows is None:
        raise ValueError("nothing committed")
    return rows.where(F.col("bucket") != VersionedTable.MARKER)


def vacuum_plan(target: VersionedTable) -> DataFrame:
    """(version, bucket, dir, replaced_by): folders that a later base of their
    bucket replaced; safe to delete once no reader holds an older manifest."""
    base = F.max(F.when(~F.col("delta"), F.col("version"))).over(Window.partitionBy("bucket"))
    return _history(target).withColumn("replaced_by", base).where(F.col("version") < F.col("replaced_by")).select(
        "version", "bucket", "dir", "replaced_by").distinct()
