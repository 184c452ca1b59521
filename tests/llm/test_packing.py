import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from siltlake.llm import packing as P

NAME = "word_bpe_49k.json"
PATH = public_tokenizers.path(NAME)


def sequences(plan, counts):
    got, seqs = Counter(), defaultdict(list)
    for w, lo, hi, first, offset in plan.rows:
        assert lo == got[w]
        got[w] = hi
        for k in range(hi - lo):
            seqs[first + k].append((offset, w))
    assert got == Counter({k: v for k, v in counts.items() if v})
    for items in seqs.values():
        at = 0
        for offset, w in sorted(items):
            assert offset == at
            at += w
        assert at <= plan.capacity
    return seqs


def fewest(items, capacity):
    items, best = sorted(items, reverse=True), [len(items)]

    def go(i, bins):
        if len(bins) >= best[0]:
            return
        if i == len(items):
            best[0] = len(bins)
            return
        for k in {b: k for k, b in enumerate(bins)}.values():
            if bins[k] + items[i] <= capacity:
                bins[k] += items[i]
                go(i + 1, bins)
                bins[k] -= items[i]
        go(i + 1, bins + [items[i]])

    go(0, [])
    return best[0]


def test_plan_against_exhaustive_search():
    rng, worse = random.Random(7), 0
    for _ in range(600):
        capacity = rng.choice([5, 8, 12, 20, 40])
        items = [rng.randint(1, capacity) for _ in range(rng.randint(1, 9))]
        n = len(sequences(P.make_plan(Counter(items), capacity), Counter(items)))
        best = fewest(items, capacity)
        assert best <= n <= best + 1
        worse += n > best
    assert worse <= 6


def test_reduction_alone_keeps_the_optimum():
    rng = random.Random(8)
    for _ in range(400):
        capacity = rng.choice([8, 12, 20])
        items = [rng.randint(1, capacity) for _ in range(rng.randint(1, 8))]
        plan = P._Plan(Counter(items), capacity)
        P.reduce_by_dominance(plan)
        rest = [w for w, n in plan.left.items() for _ in range(n)]
        assert plan.n_sequences + (fewest(rest, capacity) if rest else 0) == fewest(items, capacity)


def test_plan_size_does_not_follow_the_corpus():
    rng = random.Random(9)
    counts = Counter(min(4096, int(rng.lognormvariate(6.5, 1)) + 1) for _ in range(50_000))
    small = P.make_plan(counts, 4096)
    large = P.make_plan({k: v * 10_000 for k, v in counts.items()}, 4096)
    assert len(large.rows) < 2 * len(small.rows) + 4096
    total = sum(k * v * 10_000 for k, v in counts.items())
    assert large.n_sequences <= 1.001 * -(-total // 4096)


def test_encoder_gives_the_tokenizers_ids():
    rng = random.Random(3)
    parts = list("aAbzZéÉßÀÿ×÷İıſKÅ'sStdDlL.,%<>|_ \n\t\r\x0b\x0c\x1c\x85 ̸́İσςΣ0١²½ⅷ中文😀éﬁẞ\x00")
    parts += ["<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>", "'s", "'re", "'ll ", " the ", "don't", "antidisestablishment" * 5]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 60))) for _ in range(3000)]
    encoder = P.WordEncoder(PATH, room=500)
    expected = [np.array(e.ids, dtype="<u4").tobytes() for e in encoder.full.encode_batch(texts, add_special_tokens=False)]
    for at in range(0, len(texts), 500):
        ids, begin = encoder.encode(pa.array(texts[at:at + 500]))
        assert [ids[i:j].tobytes() for i, j in zip(begin, begin[1:])] == expected[at:at + 500]


@pytest.mark.parametrize("capacity", [64, 4096])
def test_pieces_and_sequences(spark, edge_docs, capacity):
    tokenizer = Tokenizer.from_file(PATH)
    rows = P.pack(edge_docs, NAME, capacity).collect()
    expected = Counter()
    for r in edge_docs.collect():
        ids = tokenizer.encode(r["text"] or "", add_special_tokens=False).ids + [1]
        for k, at in enumerate(range(0, len(ids), capacity)):
            part = np.array(ids[at:at + capacity], dtype="<u4")
            expected[r["doc_id"], k, at, len(part), zlib.crc32(part.tobytes())] += 1
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows) == expected
    seqs = defaultdict(list)
    for r in rows:
        seqs[r["sequence_id"]].append((r["offset"], r["length"]))
    for items in seqs.values():
        at = 0
        for offset, n in sorted(items):
            assert offset == at
            at += n
        assert at <= capacity


def test_empty_table(spark, no_docs):
    assert P.pack(no_docs, NAME).collect() == []
