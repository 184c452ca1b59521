"""Best-fit packing of tokenised documents into fixed-length sequences.

Spark tokenises the texts and cuts long documents into pieces; what has to be
packed is then only a multiset of lengths 1..capacity. Its histogram has at
most ``capacity`` rows whatever the corpus size, so the packing plan is made on
it, by class of equal lengths:

1. Martello-Toth dominance reduction: a small set of lengths that provably
   dominates every other set holding its longest member is fixed for good
   (as often as both lengths last), which shrinks the instance;
2. best fit, longest first, packs what remains.

The plan has O(capacity^2) interval rows at worst, again whatever the corpus
size: "the ranks lo..hi of length L go to the sequences s, s+1, ... at this
offset". Each piece finds its row by its rank among the pieces of its length;
ranks come from per-task counts and their prefix sums, never from one task.

Defined results: a null text is an empty text, an empty text is the end token
alone; documents that share an id are packed separately but share the
``doc_id``/``piece`` numbers; an empty table gives no rows; columns other than
the id and the text are ignored.
"""

from __future__ import annotations

import bisect
import os
import sys
import types
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from siltlake.llm.arrays import hash_runs, utf8_column
from siltlake.llm.blocks import freed
from siltlake.session import checkpoint_dir

CAPACITY = 4096
END_ID = 1
#: about so many bytes of known units are kept in a worker
CACHE_BYTES = 48 << 20
STEP_BYTES = 2 << 20
PIECE_SCHEMA = "doc_id long, piece int, start long, length long, ids_crc32 long, block int, rank long"

_SPACE, _LETTER, _MARK, _OTHER = range(4)


def _byte_kinds() -> np.ndarray:
    kinds = np.full(256, _OTHER, dtype=np.uint8)
    kinds[33:127] = _MARK
    kinds[48:58] = _OTHER
    kinds[65:91] = kinds[97:123] = _LETTER
    kinds[list(b" \n\t\r\v\f")] = _SPACE
    return kinds


_KINDS = _byte_kinds()


def split_units(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Units of the texts: hash, first byte and end of each, and whether it is
    letters alone.

    A chunk (a run without ASCII white space) of letters and then punctuation
    alone is two units, in lower case; any other chunk is one, as it is.
    Letters are a-z and those from U+00C0 to U+00FF, which lower-casing maps one
    to one and no normal form changes."""
    kind = _KINDS[data]
    lead = np.flatnonzero(data[:-1] == 0xC3)
    lead = lead[(data[lead + 1] != 0x97) & (data[lead + 1] != 0xB7)]
    kind[lead] = kind[lead + 1] = _LETTER
    inside = kind != _SPACE
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    rows = at[:-1][at[:-1] < len(data)]
    first[rows] = inside[rows]
    begin = np.flatnonzero(first)
    if not len(begin):
        return np.empty(0, np.uint64), begin, begin, begin > 0
    # what keeps a chunk whole: another kind of byte, a mark in front, a letter after a mark
    odd = kind == _OTHER
    odd[1:] |= (kind[1:] == _LETTER) & (kind[:-1] == _MARK) & ~first[1:]
    odd[begin] |= kind[begin] == _MARK
    plain = ~np.logical_or.reduceat(odd, begin)
    chunk = np.cumsum(first) - 1
    turn = np.zeros(len(data), dtype=bool)
    turn[1:] = (kind[1:] == _MARK) & (kind[:-1] == _LETTER)
    turn = np.flatnonzero(turn)
    first[turn[plain[chunk[turn]]]] = True
    begin = np.flatnonzero(first)
    place = np.cumsum(inside) - 1  # among the bytes of chunks
    chars = data[inside]
    small = plain[chunk[inside]] & (chars >= 65) & (chars <= 90)
    chars = chars + np.where(small, np.uint8(32), np.uint8(0))
    ends = begin + np.diff(place[begin], append=len(chars))
    return hash_runs(chars, place[begin]), begin, ends, plain[chunk[begin]] & (kind[begin] == _LETTER)


class WordEncoder:
    """Ids of whole texts, for a tokenizer that lower-cases, splits at white
    space and between letters and punctuation, and marks the last token of a
    word. The ids of a text are then those of its units, one after another.

    Each unit is encoded once: words many at a time, without the normaliser
    (which would not change them), all others by the full tokenizer as they
    are. Units are told apart by a 64-bit hash, so only one of each becomes a
    string. What is known is emptied when it is full; long units are not kept."""

    def __init__(self, path: str, room: int = CACHE_BYTES):
        from tokenizers import Tokenizer, normalizers, pre_tokenizers
        self.full, self.light = Tokenizer.from_file(path), Tokenizer.from_file(path)
        self.light.normalizer = normalizers.Sequence([])
        self.light.pre_tokenizer = pre_tokenizers.Sequence(
            [pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        vocabulary = self.full.get_vocab()
        self.last = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        self.last[[v for k, v in vocabulary.items() if k.endswith("</w>")]] = True
        self.room, self.held, self.known = room, 0, {}

    def _learn(self, words: list[str], rest: list[str]) -> None:
        for at in range(0, len(words), 256):
            part = words[at:at + 256]
            ids = np.array(self.light.encode_batch_fast([" ".join(part)], add_special_tokens=False)[0].ids, dtype="<u4")
            ends = (4 * (np.flatnonzero(self.last[ids]) + 1)).tolist()
            flat = ids.tobytes()
            self.known.update(zip(part, [flat[i:j] for i, j in zip([0, *ends], ends)], strict=True))
        self.known.update((u, np.array(e.ids, dtype="<u4").tobytes())
                          for u, e in zip(rest, self.full.encode_batch_fast(rest, add_special_tokens=False)))

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts one after another, and the n + 1 places where
        each text's begin."""
        data, at = utf8_column(column)
        hashes, starts, ends, word = split_units(data, at)
        _, one, number = np.unique(hashes, return_index=True, return_inverse=True)
        flat, known = data.tobytes(), self.known
        units = [flat[i:j].decode() for i, j in zip(starts[one].tolist(), ends[one].tolist())]
        word = word[one].tolist()
        units = [u.lower() if w else u for u, w in zip(units, word)]
        if self.held > self.room:
            known.clear()
            self.held = 0
        new = dict((u, w) for u, w in zip(units, word) if u not in known)
        self._learn([u for u, w in new.items() if w], [u for u, w in new.items() if not w])
        ids_of = [known[u] for u in units]
        for u in new:
            if len(u) > 64:  # long units seldom come again
                del known[u]
            else:
                self.held += 200 + len(u)  # two objects and an entry
        each = np.array([len(x) for x in ids_of], dtype=np.int64) // 4
        ids, first = np.frombuffer(b"".join(ids_of), dtype="<u4"), np.cumsum(each) - each
        many = each[number]
        place = np.concatenate([[0], np.cumsum(many)])
        return ids[np.arange(place[-1]) + np.repeat(first[number] - place[:-1], many)], place[np.searchsorted(starts, at)]


def worker_encoder(path: str) -> WordEncoder:
    """One encoder for all tasks of a worker process."""
    kept = sys.modules.setdefault("_siltlake_worker", types.ModuleType("_siltlake_worker")).__dict__
    if path not in kept:
        kept[path] = WordEncoder(path)
    return kept[path]


def steps(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Slices of a batch whose texts (second column) have about ``STEP_BYTES``."""
    at, i = utf8_column(batch.column(1))[1], 0
    while i < batch.num_rows:
        j = max(i + 1, int(np.searchsorted(at, at[i] + STEP_BYTES, side="right")) - 1)
        yield batch.slice(i, j - i)
        i = j


def piece_table(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID,
                id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: where it starts in its document, its length, the CRC
    of its ids, and its rank among the task's pieces of the same length.

    ``tokenizer``: a file of the ``tokenizers`` library, as a path that every
    worker has or a name in the public tokenizer folder."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        path = tokenizer
        if not os.path.isabs(path):
            import public_tokenizers
            path = public_tokenizers.path(path)
        encoder = worker_encoder(path)
        end = np.asarray([end_id], dtype="<u4").tobytes()
        block, used = TaskContext.get().partitionId(), np.zeros(capacity + 1, dtype=np.int64)
        for batch in (part for b in batches for part in steps(b)):
            doc, piece, start, length, crc, rank = [], [], [], [], [], []
            ids, places = encoder.encode(batch.column(1))
            flat, places = ids.astype("<u4").tobytes(), (4 * places).tolist()
            for d, i, j in zip(batch.column(0).to_pylist(), places, places[1:]):
                text = flat[i:j] + end
                for k, at in enumerate(range(0, len(text), 4 * capacity)):
                    part = text[at:at + 4 * capacity]
                    n = len(part) // 4
                    doc.append(d)
                    piece.append(k)
                    start.append(at // 4)
                    length.append(n)
                    crc.append(zlib.crc32(part))
                    rank.append(used[n])
                    used[n] += 1
            yield pa.RecordBatch.from_arrays(
                [pa.array(doc, pa.int64()), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                 pa.array(length, pa.int64()), pa.array(crc, pa.int64()),
                 pa.array(np.full(len(doc), block, dtype=np.int32)), pa.array(np.array(rank, dtype=np.int64))],
                names=["doc_id", "piece", "start", "length", "ids_crc32", "block", "rank"])
        freed(None)

    narrow = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return narrow.mapInArrow(run, PIECE_SCHEMA)


class _Plan:
    """Interval rows ``(length, lo, hi, first sequence, offset)``: the items of
    a length with ranks lo..hi-1 go to consecutive sequences, at the offset."""

    def __init__(self, counts: dict[int, int], capacity: int):
        self.capacity, self.left = capacity, dict(counts)
        self.taken = {w: 0 for w in counts}
        self.rows: list[tuple[int, int, int, int, int]] = []
        self.n_sequences = 0

    def place(self, w: int, n: int, first: int, offset: int) -> None:
        lo = self.taken[w]
        self.rows.append((w, lo, lo + n, first, offset))
        self.taken[w] = lo + n
        self.left[w] -= n
        if not self.left[w]:
            del self.left[w]

    def fix(self, weights: tuple[int, ...], n: int) -> None:
        """``n`` closed sequences, each holding exactly these lengths."""
        first, offset = self.n_sequences, 0
        self.n_sequences += n
        for w in weights:
            self.place(w, n, first, offset)
            offset += w


def _dominating(w: int, sizes: list[int], left: dict[int, int], capacity: int) -> tuple[int, ...] | None:
    """A set of at most two lengths that dominates every feasible set with
    ``w``, or None where no criterion holds. ``sizes``: the lengths left,
    ascending; ``left``: how many there are of each."""
    room = capacity - w
    if left.get(room, 0) > (room == w):
        return (w, room)  # a full sequence: the partner covers any other rest
    low: list[int] = []  # the three shortest that could lie beside it
    for x in sizes:
        low += [x] * min(3 - len(low), left[x] - (x == w))
        if len(low) == 3:
            break
    if not low or low[0] > room:
        return (w,)  # nothing fits beside it
    if len(low) == 3 and sum(low) <= room:
        return None  # sets of four and more are feasible
    at = bisect.bisect_right(sizes, room) - 1
    at -= sizes[at] == w and left[w] == 1
    best = sizes[at]  # the longest partner that fits
    if len(low) == 1 or low[0] + low[1] > room:
        return (w, best)  # only single partners are feasible
    most, i, j = 0, 0, at  # the largest feasible sum of two partners
    while i <= j:
        a, b = sizes[i], sizes[j]
        if a + b > room:
            j -= 1
            continue
        if left[a] - (a == w) - (a == b) >= 1 and left[b] - (b == w) >= 1:
            most = max(most, a + b)
        i += 1
    return (w, best) if best >= most else None


def reduce_by_dominance(plan: _Plan) -> None:
    """Martello-Toth reduction over classes of equal lengths, longest first,
    until a pass over all lengths fixes nothing more. A criterion that holds
    goes on holding while the same lengths last, so it is applied that often."""
    sizes, changed = sorted(plan.left), True
    while changed:
        changed = False
        for w in sizes[::-1]:
            while w in plan.left and (found := _dominating(w, sizes, plan.left, plan.capacity)):
                if len(found) == 1:
                    n = plan.left[w] if 2 * w > plan.capacity else 1
                elif found[0] == found[1]:
                    n = plan.left[w] // 2
                else:
                    n = min(plan.left[x] for x in found)
                plan.fix(found, n)
                for x in set(found) - plan.left.keys():
                    del sizes[bisect.bisect_left(sizes, x)]
                changed = True


def best_fit(plan: _Plan) -> None:
    """Best fit, longest first, over classes: the sequences with the same room
    left are kept as intervals, and a length fills the tightest class."""
    rooms: list[int] = []  # ascending
    open_by_room: dict[int, list[tuple[int, int]]] = {}

    def push(room: int, first: int, n: int) -> None:
        if room and n:
            if room not in open_by_room:
                bisect.insort(rooms, room)
                open_by_room[room] = []
            open_by_room[room].append((first, n))

    for w in sorted(plan.left, reverse=True):
        while plan.left.get(w):
            at = bisect.bisect_left(rooms, w)
            n = plan.left[w]
            if at < len(rooms):
                room = rooms[at]
                first, there = open_by_room[room].pop()
                if not open_by_room[room]:
                    del open_by_room[room], rooms[at]
            else:
                room = plan.capacity
                first, there = plan.n_sequences, -(-n // (room // w))
                plan.n_sequences += there
            each = room // w
            whole = min(there, n // each)
            for k in range(each if whole else 0):
                plan.place(w, whole, first, plan.capacity - room + k * w)
            push(room - each * w, first, whole)
            rest = n - whole * each
            if there > whole:
                if rest:  # fewer than ``each`` items are left: they share one sequence
                    for k in range(rest):
                        plan.place(w, 1, first + whole, plan.capacity - room + k * w)
                    push(room - rest * w, first + whole, 1)
                    whole += 1
                push(room, first + whole, there - whole)


def make_plan(counts: dict[int, int], capacity: int = CAPACITY) -> _Plan:
    """The packing plan of a histogram ``{length: count}``."""
    plan = _Plan({w: n for w, n in counts.items() if n}, capacity)
    reduce_by_dominance(plan)
    best_fit(plan)
    return plan


def pack(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pack all documents into sequences of at most ``capacity`` tokens.

    Returns one row per piece: doc_id, piece, start, length, ids_crc32,
    sequence_id, offset. The pieces of a sequence lie gapless from offset 0."""
    spark = docs.sparkSession
    checkpoint_dir(spark)
    pieces = piece_table(docs, tokenizer, capacity, end_id, id_col, text_col).checkpoint()
    per_task = pieces.groupBy("block", "length").agg(F.count("*").alias("n"))
    counts = {r["length"]: r["n"] for r in per_task.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    rows = sorted(make_plan(counts, capacity).rows)
    length, lo, _, first, offset = (np.array([r[i] for r in rows], dtype=np.int64) for i in range(5))
    begin = np.searchsorted(length, np.arange(capacity + 2))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, r = (batch.column(i).to_numpy(zero_copy_only=False) for i in (3, 5))
            at = np.empty(len(n), dtype=np.int64)
            for w in np.unique(n):  # at most ``capacity`` lengths
                own, b, e = np.flatnonzero(n == w), begin[w], begin[w + 1]
                at[own] = b + np.searchsorted(lo[b:e], r[own], side="right") - 1
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i) for i in range(5)), pa.array(first[at] + r - lo[at]), pa.array(offset[at])],
                names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    before = Window.partitionBy("length").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    base = per_task.select("block", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    ranked = pieces.join(base, ["block", "length"]).select(
        "doc_id", "piece", "start", "length", "ids_crc32", (F.col("base") + F.col("rank")).alias("rank"))
    return ranked.mapInArrow(
        run, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
