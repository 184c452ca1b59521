import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from siltlake.llm.ranked import ImpactBlock, ranked_search, search
from siltlake.llm.blocks import pack_arrays

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return TERM.findall((text or "").translate(LOWER))


def brute(docs, items, top=50):
    counts = [(d, Counter(words(t)), len(words(t))) for d, t in docs]
    n_docs, total = sum(n > 0 for _, _, n in counts), sum(n for _, _, n in counts)
    df = Counter(w for _, c, _ in counts for w in c)
    merged = {}
    for i, t in items:
        merged.setdefault(i, set()).update(words(t))
    out = []
    for i, terms in merged.items():
        found = []
        for d, c, n in counts:
            score = 0
            for w in terms:
                if c[w]:
                    m = 100 - 50 + (50 * n * n_docs) // total
                    score += math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[w] + 1))) * ((10 ** 9 * c[w]) // (1000 * c[w] + 20 * m))
            if score > 0:
                found.append((-score, d is None, d or 0, d))
        out += [(i, r + 1, x[3], -x[0]) for r, x in enumerate(sorted(found, key=lambda x: x[:3])[:top])]
    return Counter(out)


def corpus(seed, n=300):
    rng = random.Random(seed)
    vocab = [f"w{k}" for k in range(200)] + ["Ünï", "日本", "ABC"]
    weights = [1 / (k + 1) for k in range(len(vocab))]
    docs = [(i, rng.choice([" ", ", ", "\n"]).join(rng.choices(vocab, weights, k=rng.choice([1, 5, 30, 200])))) for i in range(n)]
    docs += [(n + i, docs[7][1]) for i in range(80)]  # ties beyond the top
    docs += [(3, docs[3][1]), (None, docs[7][1]), (n + 100, None), (n + 101, ""), (n + 102, "--")]
    items = [(i, " ".join(rng.choices(vocab, k=12))) for i in range(20)] + [(20, docs[7][1]), (21, "nowhere"), (22, None), (22, "w1 w2"), (None, "w3"), (23, "!")]
    return docs, items


def frames(spark, docs, items):
    return (spark.createDataFrame(docs, "doc_id long, text string").repartition(3), spark.createDataFrame(items, "item_id long, text string"))


def rows(df):
    return Counter((r["item_id"], r["rank"], r["doc_id"], r["score"]) for r in df.collect())


@pytest.mark.parametrize("top,part_terms,block_counts", [(50, 10 ** 6, 1 << 20), (3, 40, 64)])
def test_against_brute_force(spark, top, part_terms, block_counts):
    docs, items = corpus(1)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "31")
    try:
        got = rows(ranked_search(*frames(spark, docs, items), top, part_terms=part_terms, block_counts=block_counts))
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert got == brute(docs, items, top)


def make_block(lists, n_docs):
    """A block whose impacts are 1000 * w: tf and m are the same for all."""
    per = [[t for t, l in enumerate(lists) if d in l] for d in range(n_docs)]
    return pack_arrays(np.arange(n_docs), np.zeros(n_docs, np.int8), np.full(n_docs, 10), np.array([len(p) for p in per], np.int32),
                       np.array([t for p in per for t in p], np.int32), np.array([1 + (d * 7 + t) % 50 for d, p in enumerate(per) for t in p], np.int32))


def test_stops_strictly_below_the_kth_and_reads_less():
    rng = random.Random(4)
    n = 4000
    lists = [set(rng.sample(range(n), n // 2)) for _ in range(3)]
    block = ImpactBlock(make_block(lists, n), np.array([900, 5, 3]), n, 10 * n)
    empty = (np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int8))
    read = []
    scores, ids, _ = search(block, np.arange(3), empty, 10, read)
    totals = np.zeros(n, np.int64)
    np.add.at(totals, np.repeat(np.arange(n), np.diff(block.doc_at)), block.impact)
    want = np.lexsort((np.arange(n), -totals))[:10]
    assert ids.tolist() == want.tolist() and scores.tolist() == totals[want].tolist()
    assert read[0] < n / 2 and not block.known.any() and (block.slot == -1).all()


def test_equal_scores_are_all_weighed(spark):
    """More equal documents than places: the smallest ids win wherever they lie."""
    docs = [(1000 - i, "same words here") for i in range(900)] + [(5000 + i, "other thing") for i in range(900)]
    items = [(1, "same words")]
    got = rows(ranked_search(*frames(spark, docs, items), block_counts=128))
    assert got == brute(docs, items)
    assert {d for _, _, d, _ in got} == set(range(101, 151))


def test_edge_rows(spark, edge_docs, no_docs):
    items = spark.createDataFrame([(1, "word1 tail3 lines", 1), (None, None, 2)], "item_id long, text string, doc_id long")
    got = rows(ranked_search(edge_docs, items))
    docs = [(r["doc_id"], r["text"]) for r in edge_docs.collect()]
    assert got == brute(docs, [(1, "word1 tail3 lines"), (None, None)])
    assert ranked_search(no_docs, items).collect() == []
    assert ranked_search(edge_docs, items.where("false")).collect() == []
