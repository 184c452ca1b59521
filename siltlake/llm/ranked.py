"""Ranked lexical search: the Best Position Algorithm over impact lists.

Terms are runs of ASCII letters, digits and bytes of non-ASCII characters,
A-Z lowered; they are told apart by a 64-bit hash. With N documents that have
terms, L terms in all of them and n in one document, a term in df documents
weighs ``w = floor(1000 ln((2N + 2) / (2 df + 1)))``, and an occurrence count
tf in a document has the impact ``w * (10^9 tf div (1000 tf + 20 m))`` where
``m = 50 + (50 n N) div L``. An item's score of a document is the sum of the
impacts of its terms.

Documents are read once. Each task keeps, in blocks of some documents, the
counts of the items' terms only; N, L and df are sums over all blocks. A block
then has one impact list per term, and every item is searched in it: its lists
are read downwards in parallel, each new document is looked up in the other
lists by direct access, and every position met either way is marked. The best
position of a list is the end of its unbroken run of marks. What no document
still unseen can exceed is the sum of the impacts right behind the best
positions, which is lower than behind the last read ones; an item is done in a
block once its k-th score is strictly above that sum (an equal score could win
by its id). The k best of a task's blocks so far start its next block, and may
rule it out unread. The tasks' best are merged by one window per item.

Nothing is shuffled but a row per term and block, and ``top`` rows per item
and task. Items are taken in parts of about ``PART_TERMS`` term hashes, each
with a scan of its own, so what goes to the tasks is bounded.

Defined results: rows that share an item id, or have none, are one item with
the terms of all; repeated document rows are documents of their own; documents
without an id are last among equal scores; null and empty texts have no terms;
an item without terms, or whose terms no document holds, gives no rows; empty
tables give no rows; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from siltlake.llm.arrays import utf8_column, word_hashes, word_table
from siltlake.llm.blocks import freed, pack_arrays, unpack_arrays
from siltlake.session import checkpoint_dir

TOP = 50
#: term hashes (8 bytes each) of the items that one scan looks for
PART_TERMS = 2_000_000
#: counts that a block holds at most (but for one batch of documents)
BLOCK_COUNTS = 1 << 20
_FIRST_STEP, _LAST_STEP = 16, 4096
_PATTERN = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _terms(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    data, at = utf8_column(column)
    return word_hashes(data, at, word_table())


def item_terms(items: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``(item_id, term)``, each once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes, at = _terms(batch.column(1))
            ids = batch.column(0).take(pa.array(np.repeat(np.arange(batch.num_rows), np.diff(at))))
            yield pa.RecordBatch.from_arrays([ids, pa.array(hashes.view(np.int64))], names=["item_id", "term"])

    narrow = items.select(F.col(id_col).cast("long").alias("item_id"), F.col(text_col).cast("string").alias("text"))
    return narrow.mapInArrow(run, "item_id long, term long").distinct()


def count_blocks(docs: DataFrame, vocabulary: np.ndarray, id_col: str, text_col: str, block_counts: int) -> DataFrame:
    """``(docs, length, terms, dfs, payload)``: documents with terms and their
    terms, how many documents hold each vocabulary term (by its place in the
    sorted ``vocabulary``), and the counts themselves."""

    def block(parts: list[tuple], docs: int, length: int) -> pa.RecordBatch:
        ids, null, n, sizes, term, tf = (np.concatenate(x) for x in zip(*parts))
        terms, dfs = np.unique(term, return_counts=True)
        payload = pack_arrays(ids, null, n, sizes, term, tf)
        ints = pa.list_(pa.int32())
        return pa.RecordBatch.from_arrays(
            [pa.array([docs]), pa.array([length]), pa.array([terms.astype(np.int32)], ints), pa.array([dfs.astype(np.int32)], ints), pa.array([payload])],
            names=["docs", "length", "terms", "dfs", "payload"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, docs, length, held = [], 0, 0, 0
        for batch in batches:
            hashes, at = _terms(batch.column(1))
            n = np.diff(at)
            docs += int((n > 0).sum())
            length += int(n.sum())
            place = np.searchsorted(vocabulary, hashes) if len(vocabulary) else np.zeros(len(hashes), np.int64)
            hit = np.flatnonzero(vocabulary[np.minimum(place, len(vocabulary) - 1)] == hashes) if len(vocabulary) else np.empty(0, np.int64)
            doc = np.searchsorted(at, hit, side="right") - 1
            pairs, tf = np.unique(doc * len(vocabulary) + place[hit], return_counts=True)
            doc, term = np.divmod(pairs, max(1, len(vocabulary)))
            own, sizes = np.unique(doc, return_counts=True)
            ids = batch.column(0)
            null = ids.is_null().to_numpy(zero_copy_only=False)[own]
            parts.append((ids.fill_null(0).to_numpy(zero_copy_only=False)[own].astype(np.int64), null.astype(np.int8), n[own].astype(np.int64),
                          sizes.astype(np.int32), term.astype(np.int32), tf.astype(np.int32)))
            held += len(term)
            if held >= block_counts:
                yield block(parts, docs, length)
                parts, docs, length, held = [], 0, 0, 0
        if docs:
            yield freed(block(parts, docs, length))

    narrow = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return narrow.mapInArrow(run, "docs long, length long, terms array<int>, dfs array<int>, payload binary")


class ImpactBlock:
    """The impact lists of some documents: entries by (term, impact downwards,
    place of the document), and each document's entries."""

    def __init__(self, payload: bytes, weights: np.ndarray, total_docs: int, total_length: int):
        self.ids, self.null, n, sizes, term, tf = unpack_arrays(payload, "<i8", "i1", "<i8", "<i4", "<i4", "<i4")
        self.size = len(self.ids)
        m = 50 + (50 * n * total_docs) // max(1, total_length)
        doc = np.repeat(np.arange(self.size), sizes)
        tf = tf.astype(np.int64)
        impact = weights[term] * ((1_000_000_000 * tf) // (1000 * tf + 20 * m[doc]))
        order = np.lexsort((doc, -impact, term))
        self.list_doc, self.list_impact = doc[order], impact[order]
        self.starts = np.searchsorted(term[order], np.arange(len(weights) + 1))
        position = np.empty(len(order), np.int64)
        position[order] = np.arange(len(order)) - self.starts[term[order]]
        # by document, as they came
        self.term, self.impact, self.position = term, impact, position
        self.doc_at = np.concatenate([[0], np.cumsum(sizes)])
        self.known = np.zeros(self.size, dtype=bool)
        self.slot = np.full(len(weights), -1, dtype=np.int64)

    def entries(self, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The entries of ``docs``, and the place in ``docs`` of each."""
        sizes = self.doc_at[docs + 1] - self.doc_at[docs]
        of = np.repeat(np.arange(len(docs)), sizes)
        ends = np.cumsum(sizes)
        return np.arange(len(of)) - np.repeat(ends - sizes, sizes) + np.repeat(self.doc_at[docs], sizes), of


def best_of(scores: np.ndarray, ids: np.ndarray, null: np.ndarray, top: int) -> np.ndarray:
    """The places of the ``top`` best: by score downwards, then by id, nulls last."""
    if len(scores) > top:
        least = np.partition(scores, len(scores) - top)[len(scores) - top]
        some = np.flatnonzero(scores >= least)
    else:
        some = np.arange(len(scores))
    return some[np.lexsort((ids[some], null[some], -scores[some]))][:top]


def search(block: ImpactBlock, terms: np.ndarray, best: tuple, top: int, read: list[int] | None = None) -> tuple:
    """``best`` (scores, ids, null flags) after ``block``; ``terms`` are an
    item's places in the vocabulary. ``read`` gets the number of documents scored."""
    starts, ends = block.starts[terms], block.starts[terms + 1]
    some = (ends > starts)
    some[some] &= block.list_impact[starts[some]] > 0
    terms, starts, sizes = terms[some], starts[some], (ends - starts)[some]
    if not len(terms):
        return best
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    marks = np.zeros(offsets[-1] + 1, dtype=bool)  # the last one is never set
    best_at = np.zeros(len(terms), dtype=np.int64)
    block.slot[terms] = np.arange(len(terms))
    depth, step, met = 0, _FIRST_STEP, []

    def ceiling() -> int:
        open_lists = best_at < sizes
        return int(block.list_impact[(starts + best_at)[open_lists]].sum())

    while True:
        most = ceiling()
        if most <= 0 or (len(best[0]) >= top and best[0][top - 1] > most):
            break
        rows = [block.list_doc[s + depth:s + min(depth + step, n)] for s, n in zip(starts.tolist(), sizes.tolist()) if depth < n]
        depth, step = depth + step, min(2 * step, _LAST_STEP)
        seen = np.unique(np.concatenate(rows))
        new = seen[~block.known[seen]]
        if len(new):
            block.known[new] = True
            met.append(new)
            entry, of = block.entries(new)
            slot = block.slot[block.term[entry]]
            entry, of, slot = entry[slot >= 0], of[slot >= 0], slot[slot >= 0]
            scores = np.zeros(len(new), dtype=np.int64)
            np.add.at(scores, of, block.impact[entry])
            marks[offsets[slot] + block.position[entry]] = True
            new, scores = new[scores > 0], scores[scores > 0]
            found = [np.concatenate(x) for x in zip(best, (scores, block.ids[new], block.null[new]))]
            keep = best_of(*found, top)
            best = tuple(x[keep] for x in found)
        for k in range(len(terms)):
            at = int(best_at[k])
            gap = marks[offsets[k] + at:offsets[k + 1]]
            if len(gap):
                first = int(gap.argmin())
                best_at[k] = at + (first if not gap[first] else len(gap))
    block.slot[terms] = -1
    for docs in met:
        block.known[docs] = False
    if read is not None:
        read.append(sum(map(len, met)))
    return best


def _search_part(docs: DataFrame, pairs: DataFrame, id_col: str, text_col: str, top: int, block_counts: int) -> DataFrame:
    """The best documents of the items of ``pairs(item_id, term)``."""
    rows = pairs.toArrow()
    terms = rows.column("term").to_numpy().astype(np.int64).view(np.uint64)
    vocabulary, place = np.unique(terms, return_inverse=True)
    ids = rows.column("item_id").combine_chunks()
    null_item = ids.is_null().to_numpy(zero_copy_only=False)
    number = ids.fill_null(0).to_numpy(zero_copy_only=False)
    order = np.lexsort((place, number, null_item))
    number, null_item, place = number[order], null_item[order], place[order]
    edges = np.flatnonzero(np.concatenate([[True], (number[1:] != number[:-1]) | (null_item[1:] != null_item[:-1]), [True]])) if len(order) else np.zeros(1, int)
    items = [place[a:b] for a, b in zip(edges, edges[1:])]
    item_ids = [None if null_item[a] else int(number[a]) for a in edges[:-1]]

    blocks = count_blocks(docs, vocabulary, id_col, text_col, block_counts).checkpoint()
    total_docs, total_length = (int(x or 0) for x in blocks.agg(F.sum("docs"), F.sum("length")).first())
    frequent = (blocks.select(F.explode(F.arrays_zip("terms", "dfs")).alias("x")).groupBy("x.terms").agg(F.sum("x.dfs").alias("df"))
                .toArrow())  # a row a vocabulary term
    df = np.zeros(len(vocabulary), dtype=np.int64)
    df[frequent.column("terms").to_numpy()] = frequent.column("df").to_numpy()
    weights = np.array([math.floor(1000 * math.log((2 * total_docs + 2) / (2 * int(x) + 1))) for x in df], dtype=np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nothing = (np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int8))
        best = [nothing] * len(items)
        for batch in batches:
            for payload in batch.column(0):
                block = ImpactBlock(payload.as_buffer(), weights, total_docs, total_length)
                for i, own in enumerate(items):
                    best[i] = search(block, own, best[i], top)
        for at in range(0, len(best), 4096):
            some = best[at:at + 4096]
            counts = [len(b[0]) for b in some]
            scores, ids, null = (np.concatenate(x) for x in zip(*some))
            yield pa.RecordBatch.from_arrays(
                [pa.array([item_ids[at + i] for i, n in enumerate(counts) for _ in range(n)], pa.int64()),
                 pa.array(ids, mask=null.astype(bool)), pa.array(scores)], names=["item_id", "doc_id", "score"])

    found = blocks.select("payload").mapInArrow(run, "item_id long, doc_id long, score long")
    order = Window.partitionBy("item_id").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top).select("item_id", "rank", "doc_id", "score")


def ranked_search(docs: DataFrame, items: DataFrame, top: int = TOP, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text_col: str = "text", part_terms: int = PART_TERMS,
                  block_counts: int = BLOCK_COUNTS) -> DataFrame:
    """item_id, rank (from 1), doc_id, score: each item's ``top`` documents of
    the highest score above 0."""
    checkpoint_dir(docs.sparkSession)
    pairs = item_terms(items, item_col, item_text_col).checkpoint()
    parts = max(1, math.ceil(pairs.count() / part_terms))
    out = None
    for part in range(parts):
        own = pairs.where(F.pmod(F.xxhash64("item_id"), F.lit(parts)) == part)
        found = _search_part(docs, own, id_col, text_col, top, block_counts)
        out = found if out is None else out.union(found.checkpoint())
    return out


def search_sql(top: int = TOP) -> str:
    """The same in DuckDB SQL over ``documents`` and ``benchmark``."""
    def terms(text: str) -> str:
        return f"regexp_extract_all(translate(COALESCE({text}, ''), '{_UPPER}', '{_LOWER}'), '{_PATTERN}')"

    return f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {terms('text')} AS ts FROM documents),
s AS (SELECT CAST(count(*) AS BIGINT) AS nn, CAST(sum(len(ts)) AS BIGINT) AS ll FROM d WHERE len(ts) > 0),
p AS (SELECT r, any_value(doc_id) AS doc_id, term, CAST(any_value(n) AS BIGINT) AS n, count(*) AS tf
      FROM (SELECT r, doc_id, len(ts) AS n, unnest(ts) AS term FROM d) GROUP BY r, term),
q AS (SELECT DISTINCT item_id, unnest({terms('text')}) AS term FROM benchmark),
w AS (SELECT term, CAST(floor(1000 * ln((2 * nn + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM p, s GROUP BY term, nn),
x AS (SELECT q.item_id, p.r, p.doc_id, CAST(sum(w.w * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + ((50 * n * nn) // ll))))) AS BIGINT) AS score
      FROM q JOIN w USING (term) JOIN p USING (term), s GROUP BY q.item_id, p.r, p.doc_id),
k AS (SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
      FROM x WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM k WHERE rank <= {top}"""
