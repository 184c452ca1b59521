"""Conversation structure repair over a suffix-shared DAWG of signatures.

A conversation is its rows by turn. Each row has a role initial and at most
one fault: blank (no character but white space), duplicate (its role and text
stand on an earlier row) or truncated (its last character that is not white
space does not end a sentence). The cheapest edits are sought that give role
initials ``(s?(ua)+)?``: Keep 0, Rerole to user or assistant 3, Delete 4 (a
must for blank and duplicate rows), Insert an empty user or assistant row 3;
a truncated row that is not deleted adds 3. Ties go to the audit (the edits'
initials in order) that is least in ASCII.

What the edits depend on is a conversation's signature, one symbol a row, and
of that only what is left of it: the cost-to-go of a suffix and a state of the
grammar is the same in every conversation that ends so. The distinct
signatures of all conversations are therefore sorted from their ends, so that
those with a common suffix are neighbours, and their graph is walked with one
stack: a node (a suffix) is made once, with the cost-to-go and the next edit
of the best audit for each grammar state, and shared by all signatures above
it. A task holds one path of the graph. Nodes with equal futures (the same
costs but for a constant) are one for the making of new nodes. The first
letter decides between audits of equal cost, because no two edits that are
possible in one place have the same letter.

No conversation is collected: signatures, counts and repaired texts are made
while rows stream through a task in order. A signature and an audit take about
a byte a row of their conversation, as the result itself does.

Defined results: a null role or text is one space; rows of one turn stand by
role, then by a hash of the text, so equal rows are neighbours (and all but the
first are duplicates); null turns come first; rows without a conversation id
are one conversation; other roles than s, u, a are never legal where they
stand; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltlake.session import checkpoint_dir

RETAG, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
#: grammar states: at the start, after the system row, after a user row, after an assistant row
START, SYSTEM, USER, ASSISTANT = range(4)
_TURN = (USER, USER, ASSISTANT, USER)  # the state after the row that may come next, if that is a user or assistant
_ROLE_INTO = {USER: "user", ASSISTANT: "assistant"}
#: symbols of a signature: the role initial (o: any other), in capitals if truncated; x must go
_GONE, _OTHER = "x", "o"
_NOT_SPACE = r"[^\x20\x09-\x0D]"

_SIGNED = "conv_id long, sig string, blank long, duplicate long, truncated long, illegal long, gaps long"
_REPAIRED = "conv_id long, position long, role string, text string"


def _kept(state: int, symbol: str) -> int | None:
    """The state after a row that is kept, if it may stand there."""
    role = symbol.lower()
    if role == "s":
        return SYSTEM if state == START else None
    if role in ("u", "a") and _TURN[state] == (USER if role == "u" else ASSISTANT):
        return _TURN[state]
    return None


def _with_inserts(options: list[tuple[int, str]]) -> list[tuple[int, str]]:
    """The best (cost, letter) of each state where a row may be put in first."""
    best = list(options)
    for _ in range(4):
        best = [min(options[q], (best[_TURN[q]][0] + INSERT, "I")) for q in range(4)]
    return best


class SuffixGraph:
    """Nodes with equal futures: their costs-to-go less the least of them, and
    the made transitions ``(node, symbol) -> (node, cost, letters)``."""

    def __init__(self):
        far = 1 << 40
        ends = _with_inserts([(0, ""), (far, ""), (far, ""), (0, "")])
        self.costs: list[tuple[int, ...]] = [tuple(c for c, _ in ends)]
        self.number = {self.costs[0]: 0}
        self.end_letters = "".join(letter or "." for _, letter in ends)
        self.made: dict[tuple[int, str], tuple[int, int, str]] = {}

    def before(self, node: int, symbol: str) -> tuple[int, int, str]:
        """The node of ``symbol`` followed by ``node``'s suffix, what it costs
        more, and the first edit for each state."""
        found = self.made.get((node, symbol))
        if found is None:
            found = self.made[node, symbol] = self._make(node, symbol)
        return found

    def _make(self, node: int, symbol: str) -> tuple[int, int, str]:
        after = self.costs[node]
        options = []
        for state in range(4):
            edits = [(after[state] + DELETE, "D")]
            if symbol != _GONE:
                extra = TRUNCATED if symbol.isupper() else 0
                edits.append((after[_TURN[state]] + RETAG + extra, "R"))
                if (into := _kept(state, symbol)) is not None:
                    edits.append((after[into] + extra, "K"))
            options.append(min(edits))
        best = _with_inserts(options)
        least = min(c for c, _ in best)
        costs = tuple(c - least for c, _ in best)
        if costs not in self.number:
            self.number[costs] = len(self.costs)
            self.costs.append(costs)
        return self.number[costs], least, "".join(letter for _, letter in best)


def best_audits(signatures: Iterator[str], graph: SuffixGraph | None = None) -> Iterator[tuple[int, str]]:
    """``(cost, audit)`` of each signature. They come sorted by their reversed
    text: what a signature shares with the one before it is on the stack."""
    graph = graph or SuffixGraph()
    nodes, bases, letters = [0], [0], [graph.end_letters]
    last = ""
    for signature in signatures:
        back = signature[::-1]
        shared = 0
        most = min(len(back), len(last))
        while shared < most and back[shared:shared + 64] == last[shared:shared + 64] and shared + 64 <= most:
            shared += 64
        while shared < most and back[shared] == last[shared]:
            shared += 1
        del nodes[shared + 1:], bases[shared + 1:], letters[shared + 1:]
        for symbol in back[shared:]:
            node, more, first = graph.before(nodes[-1], symbol)
            nodes.append(node)
            bases.append(bases[-1] + more)
            letters.append(first)
        last = back
        state, depth, audit = START, len(back), []
        while True:
            edit = letters[depth][state]
            if edit == ".":
                break
            audit.append(edit)
            if edit in "IR":
                state = _TURN[state]
            elif edit == "K":
                state = _kept(state, back[depth - 1])
            depth -= edit != "I"
        yield bases[-1] + graph.costs[nodes[-1]][START], "".join(audit)


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Batches with, for each row, whether it begins a new conversation."""
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        ids, null = _numbers(batch.column(0))
        new = np.ones(batch.num_rows, dtype=bool)
        new[1:] = (ids[1:] != ids[:-1]) | (null[1:] != null[:-1])
        new[0] = last is None or last != (ids[0], null[0])
        last = (ids[-1], null[-1])
        yield batch, new


def _numbers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    null = column.is_null().to_numpy(zero_copy_only=False)
    return column.fill_null(0).to_numpy(zero_copy_only=False), null


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row a conversation from its rows in order; columns conv_id, turn,
    _role, _h, _g, _symbol, _blank, _cut, _seen."""
    names = [f.split()[0] for f in _SIGNED.split(", ")]
    own, before = None, None  # the open conversation: id, signature parts, counts; the row before

    def closed(o: dict) -> tuple:
        gaps = o["max"] - o["min"] + 1 - o["turns"] if o["turns"] else 0
        return (o["id"], "".join(o["sig"]), *o["counts"], gaps)

    def table(rows: list[tuple]) -> pa.RecordBatch:
        types = [pa.int64(), pa.string()] + [pa.int64()] * 5
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)

    for batch, new in _runs(batches):
        done = []
        turn, no_turn = _numbers(batch.column(1))
        role, h, g = (batch.column(i).to_numpy(zero_copy_only=False) for i in (2, 3, 4))
        symbol = batch.column(5).to_pylist()
        blank, cut, seen = (batch.column(i).to_numpy(zero_copy_only=False).astype(bool) for i in (6, 7, 8))
        rows = (turn, no_turn, role, h, g)
        previous = [np.concatenate([np.array([b], dtype=x.dtype), x[:-1]]) for x, b in zip(rows, before or [x[0] for x in rows])]
        before = [x[-1] for x in rows]
        same_turn = ~new & (turn == previous[0]) & (no_turn == previous[1])
        duplicate = ~blank & (seen | (same_turn & (role == previous[2]) & (h == previous[3]) & (g == previous[4])))
        cut &= ~blank & ~duplicate
        legal = np.array([a[:1] + b[:1] in ("su", "ua", "au") for a, b in zip(previous[2], role)], dtype=bool)
        illegal = ~new & ~legal
        must_go = blank | duplicate
        signs = "".join(_GONE if m else s.upper() if c else s for m, c, s in zip(must_go.tolist(), cut.tolist(), symbol))
        starts = np.flatnonzero(new)
        edges = np.unique(np.concatenate([[0], starts, [len(new)]]))
        sums = [np.concatenate([[0], np.cumsum(x)]) for x in (blank, duplicate, cut, illegal, ~no_turn & ~same_turn)]
        with_turn = np.flatnonzero(~no_turn)
        ids = batch.column(0).to_pylist()
        for i, j in zip(edges[:-1].tolist(), edges[1:].tolist()):
            if new[i]:
                if own is not None:
                    done.append(closed(own))
                own = {"id": ids[i], "sig": [], "counts": [0] * 4, "turns": 0, "min": None, "max": None}
            own["sig"].append(signs[i:j])
            own["counts"] = [c + int(s[j] - s[i]) for c, s in zip(own["counts"], sums)]
            own["turns"] += int(sums[4][j] - sums[4][i])
            a, b = np.searchsorted(with_turn, (i, j))
            if a < b:  # nulls first, then ascending
                own["min"] = int(turn[with_turn[a]]) if own["min"] is None else own["min"]
                own["max"] = int(turn[with_turn[b - 1]])
        if done:
            yield table(done)
    if own is not None:
        yield table([closed(own)])


def _audit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    graph, last = SuffixGraph(), ""

    for batch in batches:
        signatures = batch.column(0).to_pylist()
        # the last one of the batch before brings its path onto the stack again
        found = list(best_audits(iter([last, *signatures]), graph))[1:]
        last = signatures[-1] if signatures else last
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array([c for c, _ in found], pa.int64()), pa.array([a for _, a in found], pa.string())],
            names=["sig", "cost", "audit"])


def _rows(conversations: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    return conversations.select(F.col(conv_col).cast("long").alias("conv_id"), F.col(turn_col).cast("long").alias("turn"),
                                F.coalesce(F.col(role_col), F.lit(" ")).alias("role"),
                                F.coalesce(F.col(text_col), F.lit(" ")).alias("text"))


def _hashes() -> list:
    return [F.xxhash64("text").alias("_h"), F.xxhash64(F.lit(1), "text").alias("_g")]


def plan_repairs(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                 text_col: str = "text") -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit; one
    row per conversation that has rows."""
    checkpoint_dir(conversations.sparkSession)
    rows = _rows(conversations, conv_col, turn_col, role_col, text_col)
    initial = F.substring("role", 1, 1)
    ending = F.regexp_extract("text", f"({_NOT_SPACE})[\\x20\\x09-\\x0D]*\\z", 1)
    signs = rows.select("conv_id", "turn", F.col("role").alias("_role"), *_hashes(),
                        F.when(initial.isin("s", "u", "a"), initial).otherwise(_OTHER).alias("_symbol"),
                        (ending == "").alias("_blank"), (~ending.isin(".", "!", "?")).alias("_cut"))
    key = ["conv_id", "_role", "_h", "_g"]
    # a struct sorts its nulls first, as turns do
    twice = (signs.groupBy(*key).agg(F.count("*").alias("_n"), F.min(F.struct("turn")).alias("_first")).where("_n > 1")
             .select(*[F.col(k).alias(f"_of_{k}") for k in key], "_first"))
    same = [F.col(k).eqNullSafe(F.col(f"_of_{k}")) for k in key]
    seen = F.coalesce(F.struct("turn") > F.col("_first"), F.lit(False)).alias("_seen")
    placed = signs.join(twice, same, "left").select("conv_id", "turn", "_role", "_h", "_g", "_symbol", "_blank", "_cut", seen)
    order = ["conv_id", "turn", "_role", "_h", "_g"]
    signed = placed.repartition("conv_id").sortWithinPartitions(*order).mapInArrow(_sign, _SIGNED).checkpoint()
    back = F.reverse("sig")
    audits = (signed.select("sig").distinct().repartitionByRange(back).sortWithinPartitions(back)
              .mapInArrow(_audit, "sig string, cost long, audit string"))
    return signed.join(audits, "sig").drop("sig")


class _Repair:
    """The repaired rows of one conversation, as its own rows come by in order."""

    def __init__(self, audit: str):
        self.audit, self.at, self.state = audit, 0, START

    def inserted(self) -> Iterator[tuple[str, str]]:
        while self.at < len(self.audit) and self.audit[self.at] == "I":
            self.at += 1
            self.state = _TURN[self.state]
            yield _ROLE_INTO[self.state], ""

    def row(self, role: str, text: str) -> Iterator[tuple[str, str]]:
        yield from self.inserted()
        edit = self.audit[self.at]
        self.at += 1
        if edit == "R":
            self.state = _TURN[self.state]
            yield _ROLE_INTO[self.state], text
        elif edit == "K":
            self.state = _kept(self.state, role[:1])
            yield role, text


def _repaired(conversations: DataFrame, plan: DataFrame, use: Callable, schema: str, columns: tuple[str, str, str, str]) -> DataFrame:
    """``use`` over the rows of each conversation in order, behind a row that
    holds its audit (``_row`` false)."""
    rows = _rows(conversations, *columns).select("conv_id", "turn", "role", *_hashes(), "text", F.lit(True).alias("_row"))
    heads = plan.select("conv_id", F.lit(None).cast("long").alias("turn"), F.lit("").alias("role"), F.lit(0).cast("long").alias("_h"),
                        F.lit(0).cast("long").alias("_g"), F.col("audit").alias("text"), F.lit(False).alias("_row"))
    order = ["conv_id", "_row", "turn", "role", "_h", "_g"]
    return (rows.unionByName(heads).repartition("conv_id").sortWithinPartitions(*order)
            .select("conv_id", "_row", "role", "text").mapInArrow(use, schema))


def _steps(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """``(conv_id, role, text)`` of repaired rows; role None ends a conversation."""
    ids, repair = None, None
    for batch, new in _runs(batches):
        columns = [batch.column(i).to_pylist() for i in range(4)]
        for begins, conv, is_row, role, text in zip(new.tolist(), *columns):
            if begins:
                if repair is not None:
                    for step in repair.inserted():
                        yield ids, *step
                    yield ids, None, None
                ids, repair = conv, _Repair(text)
            if is_row:
                for step in repair.row(role, text):
                    yield conv, *step
    if repair is not None:
        for step in repair.inserted():
            yield ids, *step
        yield ids, None, None


def repaired_rows(conversations: DataFrame, plan: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn",
                  role_col: str = "role", text_col: str = "text") -> DataFrame:
    """conv_id, position (from 0), role, text of every repaired conversation."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        size = position = 0

        def table() -> pa.RecordBatch:
            types = [pa.int64(), pa.int64(), pa.string(), pa.string()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=["conv_id", "position", "role", "text"])

        for conv, role, text in _steps(batches):
            if role is None:
                position = 0
                continue
            out.append((conv, position, role, text))
            position += 1
            size += len(text)
            if len(out) >= 4096 or size >= 1 << 22:
                yield table()
                out, size = [], 0
        if out:
            yield table()

    return _repaired(conversations, plan, run, _REPAIRED, (conv_col, turn_col, role_col, text_col))


def repaired_hashes(conversations: DataFrame, plan: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn",
                    role_col: str = "role", text_col: str = "text") -> DataFrame:
    """conv_id, repaired_sha256 of the repaired ``role:text``, newline-joined."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        text_hash, first = hashlib.sha256(), True
        for conv, role, text in _steps(batches):
            if role is None:
                out.append((conv, text_hash.hexdigest()))
                text_hash, first = hashlib.sha256(), True
            else:
                text_hash.update((("" if first else "\n") + role + ":" + text).encode())
                first = False
            if len(out) >= 4096:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.string()))], names=["conv_id", "repaired_sha256"])
                out = []
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.string()))], names=["conv_id", "repaired_sha256"])

    return _repaired(conversations, plan, run, "conv_id long, repaired_sha256 string", (conv_col, turn_col, role_col, text_col))


def damaged(conversations: DataFrame) -> DataFrame:
    """``conversations`` with faults put in by crc32 of ``conv_id:turn`` modulo
    20: 0 drops the row, 1 empties its text, 2 removes its sentence ends, 3
    repeats it, 4 makes it a user row. A null stands for one space."""
    def text(c: str):
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))

    rows = conversations.select("conv_id", "turn", text("role").alias("role"), text("text").alias("text"),
                                (F.crc32(F.concat(text("conv_id"), F.lit(":"), text("turn")).cast("binary")) % 20).alias("_fault"))
    kind = F.col("_fault")
    copies = F.when(kind == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return (rows.where(kind != 0).withColumn("_copy", F.explode(copies))
            .select("conv_id", "turn", F.when(kind == 4, "user").otherwise(F.col("role")).alias("role"),
                    F.when(kind == 1, "").when(kind == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")).alias("text")))


def repair_digest(conversations: DataFrame, rows: DataFrame) -> DataFrame:
    """For every conversation of ``conversations`` what its ``rows`` need:
    conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit,
    repaired_sha256; zeros and empty texts where no row is left."""
    checkpoint_dir(rows.sparkSession)
    plan = plan_repairs(rows).checkpoint()
    numbers = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    hashes = repaired_hashes(rows, plan)
    ids = conversations.select(F.col("conv_id").cast("long").alias("conv_id")).distinct()
    of = plan.join(hashes.withColumnRenamed("conv_id", "_of"), F.col("conv_id").eqNullSafe(F.col("_of"))).drop("_of")
    found = ids.join(of.withColumnRenamed("conv_id", "_id"), F.col("conv_id").eqNullSafe(F.col("_id")), "left")
    return found.select("conv_id", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in numbers], F.coalesce("audit", F.lit("")).alias("audit"),
                        F.coalesce("repaired_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256"))
