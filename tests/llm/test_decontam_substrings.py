import hashlib
import itertools
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from siltlake.llm import decontam as D
from siltlake.llm import substrings as S
from siltlake.llm.arrays import utf8_column, word_hashes, word_table
from siltlake.llm.blocks import pack_arrays


def words(text):
    return re.findall(rb"[0-9a-z\x80-\xff]+", (text or "").encode().lower())


def test_word_hashes_equal_words():
    rng = random.Random(1)
    texts = ["".join(rng.choice(["a", "B", "é", " ", ",", "\n", "9", "word "]) for _ in range(rng.randint(0, 80))) for _ in range(300)] + [None, "", "x" * 5000]
    data, at = utf8_column(pa.array(texts))
    h, begin = word_hashes(data, at, word_table())
    seen = {}
    for i, t in enumerate(texts):
        own = words(t)
        assert begin[i + 1] - begin[i] == len(own)
        for w, x in zip(own, h[begin[i]:begin[i + 1]].tolist()):
            assert seen.setdefault(w, x) == x
    assert len(set(seen.values())) == len(seen)


def test_masks_are_lossless():
    assert D.WINDOW == 13 and D.MATCHES == 11
    for bad in itertools.combinations(range(D.WINDOW), 2):
        assert any(not any(m[b - s:b - s + 1] == "1" for b in bad if b >= s) for m in D.MASKS for s in range(D.WINDOW - len(m) + 1)), bad


def brute_overlaps(docs, items):
    out = set()
    for (d, t), (i, b) in itertools.product(docs, items):
        x, y = words(t), words(b)
        if len(y) < D.LEAST:
            continue
        width, least = (D.WINDOW, D.MATCHES) if len(y) >= D.WINDOW else (len(y), len(y))
        if any(sum(p == q for p, q in zip(x[k:k + width], y[j:j + width])) >= least
               for k in range(len(x) - width + 1) for j in range(len(y) - width + 1)):
            out.add((d, i))
    return out


def test_overlaps_against_all_windows(spark, monkeypatch):
    rng = random.Random(7)
    vocabulary = [f"w{i}" for i in range(300)] + ["The", "of"] * 20
    items = [(i, " ".join(rng.choice(vocabulary) for _ in range(rng.choice([3, 8, 10, 12, 13, 20, 45])))) for i in range(30)]
    items += [(0, items[0][1]), (90, None), (91, "")]
    docs = []
    for d in range(80):
        text = [rng.choice(vocabulary) for _ in range(rng.randint(0, 60))]
        item = rng.choice(items[:30])[1].split()
        cut = rng.randint(0, max(0, len(item) - 13))
        for k in range(rng.randint(0, 3)):
            item[rng.randrange(len(item))] = "other"
        at = rng.randint(0, len(text))
        docs.append((d, " ".join(text[:at] + item[cut:] + text[at:]).upper()))
    df = spark.createDataFrame([(d, t, 1) for d, t in docs], "doc_id long, text string, item_id int")
    bench = spark.createDataFrame(items, "item_id long, text string")
    expected = brute_overlaps(docs, items)
    assert 20 < len(expected)
    for size in (1 << 24, 800):  # one block, and several
        monkeypatch.setattr(D, "BLOCK_BYTES", size)
        rows = D.find_overlaps(df, bench).collect()
        assert {(r["doc_id"], r["item_id"]) for r in rows} == expected and len(rows) == len(expected)
    assert all(r["n_equal"] <= r["n_tokens"] for r in rows)


def test_decontamination_edge_rows(spark, edge_docs, no_docs):
    bench = spark.createDataFrame([(1, "one two three four five six seven X nine ten eleven twelve THIRTEEN fourteen"), (2, None), (None, "")], "item_id long, text string")
    rows = D.find_overlaps(edge_docs, bench).collect()
    assert [(r["doc_id"], r["item_id"], r["start_token"], r["n_tokens"], r["n_equal"]) for r in rows] == [(12, 1, 0, 14, 13)]
    assert D.find_overlaps(no_docs, bench).collect() == []
    assert D.find_overlaps(edge_docs, bench.where("false")).collect() == []


def brute_removed(rows, width=50):
    rows = [(-(1 << 63) if d is None else d, (t or "").encode()) for d, t in rows]
    least = {}
    for d, t in rows:
        for i in range(len(t) - width + 1):
            s = t[i:i + width]
            least[s] = min(least.get(s, d), d)
    out = []
    for d, t in rows:
        gone = bytearray(len(t))
        for i in range(len(t) - width + 1):
            if least[t[i:i + width]] < d:
                gone[i:i + width] = b"\1" * width
        kept = bytes(c for c, x in zip(t, gone) if not x)
        spans = sum(1 for i in range(len(t)) if gone[i] and not (i and gone[i - 1]))
        out.append((d, len(t), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def removed(docs):
    return sorted((-(1 << 63) if r[0] is None else r[0], *r[1:5]) for r in map(tuple, S.repeated_bytes(docs).collect()))


def passages(seed, n):
    rng = random.Random(seed)
    base = ["".join(rng.choice("ab cde") for _ in range(rng.randint(60, 400))) for _ in range(6)]
    for d in range(n):
        text = "".join(b[rng.randint(0, 40):rng.randint(41, len(b))] + rng.choice(["", "x", "a" * rng.randint(0, 120), "é"])
                       for b in rng.choices(base, k=rng.randint(0, 5)))
        yield rng.choice([d, d, d - 1, None]) if d > 3 else d, rng.choice([text, text, None, ""]) if d % 7 == 0 else text


@pytest.mark.parametrize("block_bytes,hot", [(1 << 24, 1024), (5000, 1024), (5000, 3)])
def test_removed_bytes_against_all_strings(spark, monkeypatch, block_bytes, hot):
    monkeypatch.setattr(S, "HOT_REGIONS", hot)
    rows = list(passages(5, 120))
    monkeypatch.setattr(S, "BLOCK_BYTES", block_bytes)
    assert removed(spark.createDataFrame(rows, "doc_id long, text string")) == brute_removed(rows)


def judged(texts):
    b = S._Block([pack_arrays(np.arange(len(texts)), np.zeros(len(texts), np.int8), np.array([len(t) for t in texts]), np.frombuffer(b"".join(texts), np.uint8))], S.WIDTH)
    return b, S.judge_pairs([[b.anchor, b.region, b.smallest, b.before, b.after]])[0]


def test_common_grams_are_not_sorted():
    """Regions of one frequent gram are sorted only where strings of them can
    be equal: by the size of the input nearly all grams come more than once."""
    rng = random.Random(4)
    noise = lambda n: bytes(rng.randrange(97, 123) for _ in range(n))
    grams = [noise(S.GRAM) for _ in range(100)]
    b, flags = judged([noise(60) + gram + noise(60) for gram in grams * 50])
    assert (np.unique(b.anchor, return_counts=True)[1] > 20).sum() > 2  # frequent anchors, in differing regions
    assert not flags.any()


def test_pairs_of_a_message_come_back():
    rng = np.random.default_rng(2)
    for n in (0, 1, 5000):
        lists = np.sort(rng.integers(0, 1 << 63, n).astype(np.uint64) * np.uint64(2)), rng.integers(0, 1 << 63, n).astype(np.uint64), rng.integers(-(1 << 63), 1 << 63, n), rng.integers(0, 1 << 24, n).astype(np.uint32)
        back = S.unpack_pairs(S.pack_pairs(*lists), "<u8", "<u8", "<i8", "<u4")
        assert all(a.dtype == b.dtype and (a == b).all() and len(a) == n for a, b in zip(lists, back))


def test_every_string_in_common_is_sorted(spark):
    rng = random.Random(6)
    noise = lambda n: "".join(rng.choice("abcdefgh") for _ in range(n))
    rows = []
    for i in range(300):
        common = noise(50)
        rows += [(2 * i, noise(70) + "x" + common + "x" + noise(70)), (2 * i + 1, noise(70) + "y" + common + "y" + noise(70))]
    b, flags = judged([t.encode() for _, t in rows])
    split = [i for i, (_, t) in enumerate(rows) if any(b.start[k] <= int(b.at[i]) + 71 < b.start[k] + b.count[k] and flags[b.pair[k]] & S.SEND for k in np.flatnonzero(b.doc == i))]
    assert split == list(range(600))
    offsets = set()
    for i in range(0, 600, 2):
        data = np.frombuffer(rows[i][1][71:121].encode(), np.uint8)
        (anchor,), grams = (S.regions(data, np.array([0, 50]), width)[0] for width in (S.WIDTH, S.GRAM))
        offsets.add(grams.tolist().index(anchor))
    assert offsets == set(range(35))  # the anchor stood at every place of a string
    assert removed(spark.createDataFrame(rows, "doc_id long, text string")) == brute_removed(rows)


def test_line_of_very_many_documents(spark):
    """Strings of a frequent line in differing surroundings are sent one by
    one, each distinct one once a block, to the buckets of their hashes."""
    rng = random.Random(8)
    noise = lambda n: "".join(rng.choice("abcdefgh") for _ in range(n))
    line = noise(60)
    rows = [(i, noise(rng.randint(0, 60)) + line + noise(rng.randint(0, 60))) for i in range(1500)]
    b, flags = judged([t.encode() for _, t in rows])
    pair, shift, number, hashes, least, at = b.hot_strings(flags, S.WIDTH)
    assert (flags & S.SPLIT > 0).any() and len(pair) == len(number) > len(hashes) > 0
    text = b.data.tobytes()
    assert len({text[x:x + 50] for x in at.tolist()}) == len(at) == len(np.unique(hashes))
    string = b.start[b.example[pair]] + shift
    for k in range(0, len(pair), 7):
        assert text[string[k]:string[k] + 50] == text[at[number[k]]:at[number[k]] + 50] and least[number[k]] <= b.ids[b.doc[b.example[pair[k]]]]
    assert removed(spark.createDataFrame(rows, "doc_id long, text string")) == brute_removed(rows)


def test_long_document_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(S, "_CHUNK", 700)
    rng = random.Random(3)
    text = "".join(rng.choice("abcd ") for _ in range(9000))
    rows = [(1, text), (2, text[100:8000]), (3, "zz" + text[50:170] + "yy"), (4, "a" * 4000), (5, "a" * 3000)]
    assert removed(spark.createDataFrame(rows, "doc_id long, text string")) == brute_removed(rows)


def test_refinement_equals_sorting():
    rng = np.random.default_rng(1)
    text = rng.integers(97, 99, 3000).astype(np.uint8)
    text[1500:1700] = text[200:400]
    left = np.concatenate([np.arange(1200, 0, -1), np.arange(1800, 0, -1)])
    place, bucket = S.refine(text, left, 50)
    strings = {}
    for p in np.flatnonzero(left >= 50).tolist():
        strings.setdefault(text[p:p + 50].tobytes(), []).append(p)
    expected = sorted(v for v in strings.values() if len(v) > 1)
    got = {}
    for p, b in zip(place.tolist(), bucket.tolist()):
        got.setdefault(b, []).append(p)
    assert sorted(map(sorted, got.values())) == expected


def test_substring_edge_rows(edge_docs, no_docs):
    assert removed(edge_docs) == brute_removed([(r["doc_id"], r["text"]) for r in edge_docs.collect()])
    assert S.repeated_bytes(no_docs).collect() == []
    for r in S.repeated_bytes(edge_docs).collect():
        assert sum(s["end"] - s["start"] for s in r["spans"]) == r["n_removed"] and len(r["spans"]) == r["n_spans"]
