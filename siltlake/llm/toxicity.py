"""Toxicity scores from class-conditional Kneser-Ney models.

Each class has a model of its words, given the word before (or the begin of
the text). With n_c(v w) the occurrences of the pair v w in the labelled texts
of class c, n_c(v) their sum over w, H_c(v) the number of words that follow v,
n_c(w) the occurrences of w, and N_c their sum,

    P_c(w | v) = (max(n_c(v w) - D_c, 0) + D_c H_c(v) P_c(w)) / n_c(v)
    P_c(w)     = max(n_c(w) - D, 0) / N_c + D S(w) / (N_0 + N_1)

A class that has not seen v backs off to P_c(w) whole. In P_c(w) the class is
the history and S(w), the number of classes that hold w, the continuation
count: what is discounted from either class goes into one backoff that both
share, so rare expressions are smoothed towards no evidence, and words in
neither class are none. D = n1 / (n1 + 2 n2) from how many counts are 1 and 2:
of pairs for D_c, of words for D.
The log-likelihoods of a text are compared per word, by the whole model and by
the backoff alone; a logistic map of both differences and of their standard
error, 1 / sqrt(words), gives the score. The map is fitted on at most
``CALIBRATION_ROWS`` labelled texts, each scored without its own counts.

Counts cover every labelled text and the pairs and words of every document,
and neither meets in one place: texts are dealt to blocks, each block asks the
pair buckets for the totals of its own distinct pairs, then, with what they
say on which pairs are counted where, the word buckets for the counts of its
distinct words, as a word and as a history. A bucket adds up what the blocks sent, one entry
a block, so a frequent word is no heavy key, and answers each block in the
order it asked. Pairs are known by codes whose length grows with the input, so
that fewer than one in 10,000 shares its code. Nothing is broadcast but the map.

Labels, language, source and ids never enter a score; labels are learned only
from the rows that ``learn`` selects. Defined results: a label of several rows
is 1 if any is; a document without words (null, empty) gets the score of no
evidence; repeated rows each get a score; with no labels, or only one class,
the score is 0.5 for no evidence; empty tables give no rows; other columns are
ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltlake.llm.arrays import mix64, word_hashes, word_table
from siltlake.llm.blocks import BLOCK_BYTES, block_count, block_of, freed, open_block, to_blocks
from siltlake.session import checkpoint_dir

CALIBRATION_ROWS = 50_000
THRESHOLD = 0.3


SLICE = 1 << 19  # words scored at once, and the rest of the last text
BEGIN = np.uint64(0)  # stands before the first word of a text
_ODD = np.uint64(0x9E3779B97F4A7C15)


class _Texts:
    """A block's documents as numbers of its distinct words and pairs."""

    def __init__(self, payloads, bits: int):
        self.ids, self.flags, data, at = open_block(payloads)
        hashes, self.begin = word_hashes(data, at, word_table())
        before = np.concatenate([[BEGIN], hashes[:-1]])[:len(hashes)]
        before[self.begin[:-1][np.diff(self.begin) > 0]] = BEGIN
        short = np.uint64(64 - bits)
        codes = mix64(before * _ODD + hashes) >> short
        self.words = np.unique(np.append(hashes, BEGIN) >> short)
        del data
        # distinct codes, the number of each pair among them, and one place of each, in as few arrays as may be
        order = np.argsort(codes)
        codes = codes[order]
        new = np.concatenate([[True], codes[1:] != codes[:-1]])[:len(codes)]
        self.pairs, some = codes[new], order[new]
        self.pair = np.empty(len(codes), dtype=np.int32)
        self.pair[order] = np.cumsum(new, dtype=np.int32) - 1
        del codes, order, new
        # the first and second word of each pair
        self.first, self.second = (np.searchsorted(self.words, x[some] >> short).astype(np.int32) for x in (before, hashes))

    def label(self, rows: pa.Table) -> np.ndarray:
        return _label_of(self.ids, self.flags, _labels(rows)).astype(np.int8)

    def pair_counts(self, label: np.ndarray) -> list[np.ndarray]:
        """How often each pair stands in the toxic and in the plain texts."""
        label = np.repeat(label, np.diff(self.begin))
        return [np.bincount(self.pair[label == c], minlength=len(self.pairs)) for c in (1, 0)]


def _pack(*arrays: np.ndarray) -> bytes:
    """Whole numbers as one value: of each array the lowest bytes of all its
    numbers, then the next ones, and so on, each run compressed by itself
    (they differ in kind), and nothing for a run of zeros."""
    import zstandard
    packer = zstandard.ZstdCompressor(level=1)
    runs = [run for a in arrays for run in a.astype(np.int64).view(np.uint8).reshape(-1, 8).T]
    runs = [packer.compress(run.tobytes()) if run.any() else b"" for run in runs]
    return b"".join([np.array([*map(len, arrays), *map(len, runs)], dtype=np.int32).tobytes(), *runs])


def _unpack(value: bytes, arrays: int) -> list[np.ndarray]:
    import zstandard
    unpacker = zstandard.ZstdDecompressor()
    head = np.frombuffer(value, dtype=np.int32, count=9 * arrays).tolist()
    out, at = [], 36 * arrays
    for k, n in enumerate(head[:arrays]):
        flat = np.zeros((n, 8), dtype=np.uint8)
        for byte, size in enumerate(head[arrays + 8 * k:arrays + 8 * k + 8]):
            if size:
                flat[:, byte] = np.frombuffer(unpacker.decompress(value[at:at + size]), dtype=np.uint8)
                at += size
        out.append(flat.reshape(-1).view(np.int64))
    return out


def _sent(codes: np.ndarray, *counts: np.ndarray) -> bytes:
    """Ascending codes, as their differences, and counts of each."""
    return _pack(np.diff(codes, prepend=np.uint64(0)), *counts)


def _received(value: bytes, counts: int) -> list[np.ndarray]:
    codes, *rest = _unpack(value, 1 + counts)
    return [np.cumsum(codes.view(np.uint64), dtype=np.uint64), *rest]


def _labels(rows: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Sorted ids with a label, and the label."""
    own = rows.filter(rows.column("toxic").is_valid())
    ids, toxic = (own.column(c).to_numpy() for c in ("id", "toxic"))
    order = np.lexsort((toxic, ids))
    last = np.flatnonzero(np.diff(ids[order], append=-2) != 0) if len(ids) else np.empty(0, np.int64)
    return ids[order][last], toxic[order][last]


def _label_of(ids: np.ndarray, flags: np.ndarray, labels: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """The label of each document, -1 for none."""
    known, toxic = labels
    if not len(known):
        return np.full(len(ids), -1)
    at = np.minimum(np.searchsorted(known, ids), len(known) - 1)
    return np.where((known[at] == ids) & (flags < 2), toxic[at], -1)


def _bounds(codes: np.ndarray, buckets: int, bits: int) -> np.ndarray:
    """Where each bucket's codes begin among the sorted codes."""
    edges = [np.uint64((i << bits) // buckets) for i in range(1, buckets)]
    return np.concatenate([[0], np.searchsorted(codes, np.array(edges, dtype=np.uint64)), [len(codes)]]).astype(np.int64)


def _added(parts: list[list[np.ndarray]]) -> tuple[np.ndarray, list[np.ndarray], np.ndarray]:
    """The counts of each distinct code over all parts, the number of every
    part's code among them, one part after another, and the parts' ends."""
    distinct, number = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
    totals = [np.bincount(number, weights=np.concatenate([p[k] for p in parts]), minlength=len(distinct)).astype(np.int64)
              for k in range(1, len(parts[0]))]
    return number, totals, np.cumsum([len(p[0]) for p in parts])[:-1]


def _slices(begin: np.ndarray) -> list[tuple[int, int]]:
    """Runs of whole documents of about ``SLICE`` words, or of one longer document."""
    cuts = np.unique(np.concatenate([[0], np.searchsorted(begin, np.arange(SLICE, begin[-1], SLICE)), [len(begin) - 1]])).tolist()
    return list(zip(cuts, cuts[1:]))


def _census(counts: np.ndarray) -> list[int]:
    """How many counts are above 0, 1 and 2."""
    return [int((counts > 0).sum()), int((counts == 1).sum()), int((counts == 2).sum())]


def _discount(once: int, twice: int) -> float:
    return once / (once + 2 * twice) if once and twice else 0.5


def _rows(kind: int, to: pa.Array, of: pa.Array, values: list[bytes]) -> pa.Table:
    """Messages ``(to, of, kind, value)`` beside label rows that are null here."""
    n = len(values)
    return pa.table({"block": to, "id": pa.nulls(n, pa.int64()), "toxic": pa.nulls(n, pa.int32()), "of": of,
                     "kind": pa.array(np.full(n, kind, dtype=np.int32)), "value": pa.array(values, pa.binary())})


def _answers(rows: pa.Table, kind: int) -> list[bytes]:
    """The answers of one kind in the order of their buckets."""
    got = rows.filter(pa.compute.equal(rows.column("kind"), kind))
    values = got.column("value").to_pylist()
    return [values[i] for i in np.argsort(got.column("of").to_numpy(), kind="stable")]


def _joined(values: list[bytes], sums: int, counts: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """The sums over all answers and the counts one after another."""
    parts = [_unpack(v, 1 + counts) for v in values]
    return (np.sum([np.zeros(sums, np.int64), *(p[0] for p in parts)], axis=0),
            [np.concatenate([np.empty(0, np.int64), *(p[1 + k] for p in parts)]) for k in range(counts)])


PAIRS, MARKS, WORDS = 1, 2, 3  # kinds of messages
MESSAGE = "block int, id long, toxic int, of int, kind int, value binary"


def word_evidence(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, label, words, evidence, backoff)``: the log-likelihood ratio
    of each text by the whole model and by the backoff alone, for labelled
    texts without their own counts. ``labels(id, toxic)``; documents are kept
    whole in their blocks."""
    n = block_count(docs, text_col)
    bits = min(64, (n * BLOCK_BYTES).bit_length() + 10)
    blocks = to_blocks(docs, n, id_col, text_col, spread_null_ids=True, level=6)  # null ids have no label to meet
    dealt = labels.select(block_of("id", n).alias("block"), F.col("id").cast("long").alias("id"), F.col("toxic").cast("int").alias("toxic"),
                          *[F.lit(None).cast(t).alias(c) for c, t in (("of", "int"), ("kind", "int"), ("value", "binary"))])
    buckets = pa.array(np.arange(n, dtype=np.int32))

    def ask(kind: int, block: tuple, codes: np.ndarray, counts: list[np.ndarray]) -> pa.Table:
        at = _bounds(codes, n, bits)
        return _rows(kind, buckets, pa.array(np.full(n, block[0].as_py(), dtype=np.int32)),
                     [_sent(codes[i:j], *(c[i:j] for c in counts)) for i, j in zip(at, at[1:])])

    def ask_pairs(block: tuple, texts: pa.Table, rows: pa.Table) -> pa.Table:
        own = _Texts(texts.column("payload").to_pylist(), bits)
        return ask(PAIRS, block, own.pairs, own.pair_counts(own.label(rows)))

    def answer(kind: int, rows: pa.Table, sums: list[int], counts: list[np.ndarray], ends: np.ndarray) -> pa.Table:
        return _rows(kind, rows.column("of").combine_chunks(), rows.column("block").combine_chunks(),
                     [_pack(np.array(sums, dtype=np.int64), *e) for e in zip(*(np.split(x, ends) for x in counts))])

    def answer_pairs(bucket: tuple, rows: pa.Table) -> pa.Table:
        number, totals, ends = _added([_received(v, 2) for v in rows.column("value").to_pylist()])
        return answer(PAIRS, rows, [x for t in totals for x in _census(t)], [t[number] for t in totals], ends)

    def mark_pairs(bucket: tuple, rows: pa.Table) -> pa.Table:
        parts = [_received(v, 2) for v in rows.column("value").to_pylist()]
        number, _, ends = _added(parts)
        # of the blocks that hold a pair in a class one is told so: there it counts as a word after its history
        mark = np.zeros(len(number), dtype=np.int64)
        for k in (1, 2):
            has = np.flatnonzero(np.concatenate([p[k] for p in parts]))
            mark[has[np.unique(number[has], return_index=True)[1]]] |= k
        return answer(MARKS, rows, [], [mark], ends)

    def ask_words(block: tuple, texts: pa.Table, rows: pa.Table) -> pa.Table:
        own = _Texts(texts.column("payload").to_pylist(), bits)
        _, (mark,) = _joined(_answers(rows, MARKS), 0, 1)
        size, counts = len(own.words), []
        for k, often in zip((1, 2), own.pair_counts(own.label(rows))):
            marked = mark & k > 0
            stands = np.bincount(own.second, weights=often, minlength=size)
            # as a history a word stands as often, but for the ends of texts
            counts += [np.bincount(own.first[marked], minlength=size), stands - np.bincount(own.first, weights=often, minlength=size), stands]
        return ask(WORDS, block, own.words, counts)

    def answer_words(bucket: tuple, rows: pa.Table) -> pa.Table:
        number, totals, ends = _added([_received(v, 6) for v in rows.column("value").to_pylist()])
        return answer(WORDS, rows, [x for t in (totals[2], totals[5]) for x in (int(t.sum()), *_census(t))], [t[number] for t in totals], ends)

    def score(block: tuple, texts: pa.Table, rows: pa.Table) -> pa.Table:
        own = _Texts(texts.column("payload").to_pylist(), bits)
        label = own.label(rows)
        types, pairs = _joined(_answers(rows, PAIRS), 6, 2)
        census, words = _joined(_answers(rows, WORDS), 8, 6)
        d = _discount(*(census[2:4] + census[6:8]).tolist())
        sizes = [int(census[0]), int(census[4])]
        parts = [ratios(own, lo, hi, label, types, pairs, words, d, sizes) for lo, hi in _slices(own.begin)]
        whole, backoff = (np.concatenate([np.empty(0), *(p[k] for p in parts)]) for k in (0, 1))
        return pa.table({"doc_id": pa.array(own.ids, pa.int64(), mask=own.flags >= 2), "label": pa.array(label.astype(np.int32)),
                         "words": pa.array(np.diff(own.begin), pa.int64()), "evidence": pa.array(whole, pa.float64()), "backoff": pa.array(backoff, pa.float64())})

    def ratios(own: _Texts, lo: int, hi: int, label, types, pairs, words, d: float, sizes: list[int]) -> list[np.ndarray]:
        """Both log-likelihood ratios of the documents ``lo`` to ``hi``."""
        length = np.diff(own.begin[lo:hi + 1])
        # each document's distinct pairs and how often it has them
        many = max(1, len(own.pairs))
        pair, often = np.unique(np.repeat(np.arange(hi - lo), length) * many + own.pair[own.begin[lo]:own.begin[hi]], return_counts=True)
        doc, pair = pair // many, pair % many
        first, second, mine = own.first[pair], own.second[pair], label[lo:hi][doc]
        # what a labelled text's own counts add to its pairs, words and histories is left out
        some = np.flatnonzero(mine >= 0)
        sole = np.where(mine[some] == 1, pairs[0][pair[some]], pairs[1][pair[some]]) == often[some]
        own_word, own_history, own_follow = (np.zeros(len(pair), dtype=np.int32) for _ in range(3))
        _, at = np.unique(doc[some] * len(own.words) + second[some], return_inverse=True)
        own_word[some] = np.bincount(at, weights=often[some])[at]
        _, at = np.unique(doc[some] * len(own.words) + first[some], return_inverse=True)
        own_history[some] = np.bincount(at, weights=often[some])[at]
        own_follow[some] = np.bincount(at, weights=sole)[at]
        n_w = [words[3 * k + 2][second] - own_word * (mine == c) for c, k in ((1, 0), (0, 1))]
        held = (n_w[0] > 0).astype(np.int8) + (n_w[1] > 0)
        found, backoff = [], []
        for c, k in ((1, 0), (0, 1)):
            follow, ends, stands = words[3 * k:3 * k + 3]
            d_c = _discount(*types[3 * k + 1:3 * k + 3].tolist())
            p = np.maximum(n_w[k] - d, 0) / max(1, sizes[k]) + d * held / max(1, sum(sizes))
            n_v = (stands - ends)[first] - own_history * (mine == c)
            # two pairs of one code count as one word after one of their histories, and as both pairs' occurrences:
            # but a history that stands is followed by a word at least, and by none more often than it stands
            h_v = np.maximum(follow[first] - own_follow * (mine == c), n_v > 0)
            n_vw = np.minimum(pairs[k][pair] - often * (mine == c), n_v)
            seen = np.maximum(n_vw - d_c, 0) + d_c * h_v * p
            backoff.append(p)
            found.append(np.where(n_v > 0, seen / np.maximum(n_v, 1), p))
        known = (held > 0) & (min(sizes) > 0)
        sums = []
        for one, none in (found, backoff):
            with np.errstate(divide="ignore", invalid="ignore"):
                ratio = np.where(known, np.log(one / none), 0.0)
            sums.append(np.bincount(doc, weights=ratio * often, minlength=hi - lo))
        return sums

    by_block = blocks.groupBy("block")

    def met(answers: DataFrame, step, schema: str) -> DataFrame:
        """``step`` over each block's texts with its labels and answers."""
        return by_block.cogroup(answers.groupBy("block")).applyInArrow(lambda key, texts, rows: freed(step(key, texts, rows)), schema)

    def summed(asked: DataFrame, step) -> DataFrame:
        return asked.groupBy("block").applyInArrow(lambda key, rows: freed(step(key, rows)), MESSAGE)

    asked = met(dealt, ask_pairs, MESSAGE)
    on_words = summed(met(dealt.union(summed(asked, mark_pairs)), ask_words, MESSAGE), answer_words)
    return met(dealt.union(summed(asked, answer_pairs)).union(on_words), score, "doc_id long, label int, words long, evidence double, backoff double")


def fit_map(x: np.ndarray, y: np.ndarray) -> list[float]:
    """Logistic regression by Newton steps, lightly regularised; the last
    weight is the constant."""
    x = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(x.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(len(w)), x.T @ (y - p) - 1e-3 * w)
        w += np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return w.tolist()


def toxicity(docs: DataFrame, labels: DataFrame, learn: Column | None = None, id_col: str = "doc_id", text_col: str = "text",
             label_col: str = "toxic", calibration_rows: int = CALIBRATION_ROWS) -> DataFrame:
    """doc_id, words, evidence and backoff (log-likelihood ratios per word), score.
    ``learn``: which label rows may be learned from (all, if not given)."""
    checkpoint_dir(docs.sparkSession)
    usable = labels.where(learn) if learn is not None else labels
    usable = usable.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("int").alias("toxic"))
    usable = usable.where("id IS NOT NULL AND toxic IN (0, 1)")
    found = word_evidence(docs, usable, id_col, text_col).checkpoint()
    words = F.greatest("words", F.lit(1))
    scored = found.select("doc_id", "label", "words", (F.col("evidence") / words).alias("evidence"), (F.col("backoff") / words).alias("backoff"),
                          (1 / F.sqrt(words)).alias("error"))
    # a sample by a hash of the id, of about that many rows however many are labelled: the map has four numbers
    labelled = scored.where("label >= 0")
    share = min(1.0, calibration_rows / max(1, labelled.count()))
    rows = labelled.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) <= int(share * (1 << 30))).select("evidence", "backoff", "error", "label").collect()
    y = np.array([r["label"] for r in rows], dtype=float)
    x = np.array([[r["evidence"], r["backoff"], r["error"]] for r in rows], dtype=float).reshape(-1, 3)
    a, b, c, d = fit_map(x, y) if 0 < y.sum() < len(y) else (1.0, 0.0, 0.0, 0.0)
    z = F.col("evidence") * a + F.col("backoff") * b + F.col("error") * c + d
    return scored.select("doc_id", "words", "evidence", "backoff", (1 / (1 + F.exp(-F.least(F.greatest(z, F.lit(-30.0)), F.lit(30.0))))).alias("score"))
