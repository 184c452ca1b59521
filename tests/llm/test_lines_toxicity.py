import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from siltlake.llm import blocks as B
from siltlake.llm import lines as L
from siltlake.llm import toxicity as T
from siltlake.llm.queries import held_out


def distance(a, b, enough=10**9):
    """Edits, or some number over ``enough``."""
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        before, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            before, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, before + (x != y))
        if min(row) > enough:
            return min(row)
    return row[-1]


def edited(rng, text, most, letters="abé日😀 "):
    out = list(text)
    for _ in range(rng.randint(0, most)):
        k = rng.random()
        if out and k < 0.35:
            out.pop(rng.randrange(len(out)))
        elif k < 0.65:
            out.insert(rng.randint(0, len(out)), rng.choice(letters))
        elif out:
            out[rng.randrange(len(out))] = rng.choice(letters)
    return "".join(out)


@pytest.mark.parametrize("limit", [1, 2, 3])
def test_banded_distance(spark, limit):
    rng = random.Random(limit)
    pairs = []
    for _ in range(300):
        a = "".join(rng.choice("abé日 ") for _ in range(rng.randint(8, 40)))
        pairs.append((a, edited(rng, a, limit + 2)))
    df = spark.createDataFrame(pairs, "a string, b string").selectExpr("a", "b", "a x", "b y")
    whole = df.withColumn("d", L.edit_distance_within(F.col("x"), F.col("y"), limit)).collect()
    cut = df.where("a <> b").withColumn("m", L.differing_middles(F.col("x"), F.col("y"), limit))
    cut = cut.withColumn("d", L.edit_distance_within(F.col("m.a"), F.col("m.b"), limit)).collect()
    for r in whole + cut:
        assert min(r["d"], limit + 1) == min(distance(r["a"], r["b"]), limit + 1), (r["a"], r["b"])


def brute_lines(rows, edits, least):
    """By text of each document: the kept text, lines removed, near repeats."""
    placed = [(d, p, x) for d, t in rows if t is not None for p, x in enumerate(t.split("\n")) if len(x) >= least]
    first = {}
    for d, p, x in placed:
        key = (d is not None, d or 0, p)
        first[x] = min(first.get(x, key), key)
    near = {x for x in first for y in first if x != y and first[y] < first[x] and abs(len(x) - len(y)) <= edits and edits and distance(x, y, edits) <= edits}
    out = []
    for d, t in rows:
        if t is None:
            out.append((d, None, 0, 0))
            continue
        lines = t.split("\n")
        stay = [x for p, x in enumerate(lines) if len(x) < least or first[x] == (d is not None, d or 0, p) and x not in near]
        out.append((d, "\n".join(stay), len(lines) - len(stay),
                    len({p for p, x in enumerate(lines) if len(x) >= least and first[x] == (d is not None, d or 0, p) and x in near})))
    return sorted(out, key=str)


@pytest.mark.parametrize("edits", [0, 1, 2, 3])
def test_lines_against_all_pairs(spark, monkeypatch, edits):
    if edits == 3:
        monkeypatch.setattr(L, "BROADCAST_LINES", 0)
    rng = random.Random(edits)
    base = ["".join(rng.choice("abcde fgh") for _ in range(rng.randint(6, 24))) for _ in range(25)]
    rows = [(d, "\n".join(edited(rng, rng.choice(base), 2, "abz") for _ in range(rng.randint(0, 8)))) for d in range(60)]
    got = L.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string"), edits, 8, counts=True)
    got = sorted(((r["doc_id"], r["text"], r["n_removed"], r["n_near"]) for r in got.collect()), key=str)
    assert got == brute_lines(rows, edits, 8)
    assert edits == 0 or any(r[3] for r in got)


def test_edits_grow_with_the_length(spark):
    rng = random.Random(4)
    base = ["".join(rng.choice("abcde fghé") for _ in range(n)) for n in (29, 30, 48, 49, 50, 59, 98, 99, 100, 101, 150, 199, 200, 324, 399, 401, 810)]
    allowed = lambda n: 0 if n < 30 else 1 if n < 50 else 2 + int(math.log2(n // 50))
    rows = [(0, "\n".join(base))]
    rows += [(d, edited(rng, x, allowed(len(x)) + 2, "XYZ")) for d, x in enumerate([x for x in base for _ in range(12)], 1)]
    rows += [(900, "q" * 100 + base[13][4:] + "last"), (901, "p" * 100 + base[13])]
    first, near = {}, set()
    for d, t in rows:
        for p, x in enumerate(t.split("\n")):
            first.setdefault(x, (d, p))
    for x in first:
        for y in first:
            most = allowed(min(len(x), len(y)))
            if most and first[y] < first[x] and abs(len(x) - len(y)) <= most and distance(x, y, most) <= most:
                near.add(first[x])
    got = L.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string"), counts=True)
    assert {r["doc_id"] for r in got.where("n_near > 0").collect()} == {d for d, _ in near}
    assert len(near) > 50


def test_far_lines_of_one_template_are_not_written(spark, monkeypatch):
    rng = random.Random(6)
    rows = [(d, "The article of this page has the ID: " + "".join(rng.choice("0123456789") for _ in range(12))) for d in range(1500)]
    rows += [(2000 + d, t[:-1] + "x") for d, t in rows[:50]]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    own = docs.selectExpr("doc_id _id", "text _text")
    firsts = docs.selectExpr("doc_id _id", "array(0) _firsts")
    written, real = [], type(docs).checkpoint

    def counted(df, *args, **more):
        out = real(df, *args, **more)
        written.append(out.count())
        return out

    monkeypatch.setattr(type(docs), "checkpoint", counted)
    near = {r["_id"] for r in L._near_repeats(own, firsts, None, 30).collect()}
    assert near >= set(range(2000, 2050)) and len(near) < 60
    assert max(written) < 30 * 1550  # keys a line, not pairs


def test_keys_are_made_once(spark, monkeypatch):
    """Open lines look for further lines by the keys that all lines have anyway."""
    rng = random.Random(8)
    word = lambda n: "".join(rng.choice("abcdefghij") for _ in range(n))
    head, tail = word(20), word(20)  # all but the last row share both ends, and differ in their middles from all but one
    rows = [(d, head + word(15) + tail) for d in range(40)]
    rows += [(100 + d, t[:25] + "X" + t[26:]) for d, t in rows]
    rows += [(200, rows[3][1][:22] + "YZ" + rows[3][1][24:]), (201, word(60))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    made, read, real_keys, real_rest = [], [], L.segment_keys, L._rest

    def keys(*args, **more):
        made.append(args)
        return real_keys(*args, **more)

    def rest(*args, **more):
        read.append(args)
        return real_rest(*args, **more)

    monkeypatch.setattr(L, "segment_keys", keys)
    monkeypatch.setattr(L, "_rest", rest)
    got = {r["doc_id"] for r in L.dedup_lines(docs, counts=True).where("n_near > 0").collect()}
    assert got == {d for d, t in rows if any(e < d and distance(t, u, 2) <= 2 for e, u in rows)} >= {*range(100, 140), 200}
    assert len(read) == 1 and len(made) == 1


@pytest.mark.parametrize("edits, least", [(None, 30), (None, 8), (None, 1), (None, 49), (None, 70), (0, 1), (1, 1), (3, 1), (3, 8), (2, 30)])
def test_classes_of_lengths(spark, edits, least):
    """A line is in the class of every length that a partner which is no longer may have."""
    def of(n):
        if edits is not None:
            base = max(1, least)
            return (base << (n // base).bit_length() - 1, edits)
        return (max(2, least), 1) if n < 50 else (50 << (n // 50).bit_length() - 1, (n // 50).bit_length() + 1)

    lengths = [n for n in [*range(0, 420), 799, 800, 803, 12799, 12800, 12805] if n >= least]
    got = L.in_classes(spark.createDataFrame([(n,) for n in lengths], "_n int"), edits, least).select("_n", "_c.lo", "_c.edits").collect()
    expected = {(n, *of(m)) for n in lengths for m in range(max(n - of(n)[1], least, 1), n + 1)}
    assert len(got) == len(expected) and {tuple(r) for r in got} == expected


@pytest.mark.parametrize("times", [2, 3])
def test_short_lines_that_stand_often(spark, monkeypatch, times):
    if times == 3:
        monkeypatch.setattr(L, "BROADCAST_LINES", 0)
    rows = [(1, "All rights reserved.\nown\n\n"), (2, "Share\nAll rights reserved.\n \nShare"), (3, "All rights reserved.\n\n \nb"), (None, "b\nx"), (4, None)]
    got = L.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string"), counts=True, short_repeats=times).collect()
    got = {r["doc_id"]: (r["text"], r["n_removed"]) for r in got}
    assert got[1] == (rows[0][1], 0) and got[None] == ("b\nx", 0) and got[4] == (None, 0)
    assert got[2] == (("Share\n ", 2) if times == 2 else ("Share\n \nShare", 1))
    assert got[3] == (("\n ", 2) if times == 2 else ("\n \nb", 1))


def test_lines_edge_rows(edge_docs, no_docs):
    got = L.dedup_lines(edge_docs, counts=True)
    assert got.columns == [*edge_docs.columns, "n_lines", "n_removed", "n_near"]
    rows = [(r["doc_id"], r["text"]) for r in edge_docs.collect()]
    expected = [(d, t, n) for d, t, n, _ in brute_lines(rows, 1, 30)]
    assert sorted(((r["doc_id"], r["text"], r["n_removed"]) for r in got.collect()), key=str) == expected
    other = {(r["doc_id"], r["_id"], r["fp"], r["key"]) for r in edge_docs.collect()}
    assert {(r["doc_id"], r["_id"], r["fp"], r["key"]) for r in got.collect()} == other
    assert L.dedup_lines(no_docs).collect() == []


def test_line_plan_is_native(edge_docs):
    plan = L.dedup_lines(edge_docs)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|NestedLoop|Cartesian", plan)


def brute_toxicity(rows, labels):
    """(words, log-likelihood ratios of the pair model and of its backoff) by document, own counts left out."""
    texts = [re.findall(rb"[0-9a-z\x80-\xff]+", (t or "").encode().lower()) for _, t in rows]
    pairs = [Counter(zip([None, *w], w)) for w in texts]
    counts = {0: Counter(), 1: Counter()}
    for (d, _), p in zip(rows, pairs):
        if labels.get(d) is not None:
            counts[labels[d]].update(p)
    share = lambda c: c.count(1) / (c.count(1) + 2 * c.count(2)) if 1 in c and 2 in c else 0.5
    pair_discount = {c: share(list(counts[c].values())) for c in counts}
    words = {c: Counter(w for _, w in counts[c].elements()) for c in counts}
    discount = share([n for c in counts for n in words[c].values()])
    size = {c: sum(words[c].values()) for c in counts}
    out = []
    for (d, _), text, own in zip(rows, texts, pairs):
        left = {c: +(counts[c] - own if labels.get(d) == c else counts[c]) for c in counts}
        ends, begins, total = ({c: Counter() for c in counts} for _ in range(3))
        for c in counts:
            for (v, w), n in left[c].items():
                ends[c][w] += n
                begins[c][v] += 1
                total[c][v] += n
        whole = backoff = 0.0
        for v, w in zip([None, *text], text):
            held = sum(ends[c][w] > 0 for c in counts)
            if not held or not size[0] or not size[1]:
                continue
            p, q = {}, {}
            for c in counts:
                q[c] = max(ends[c][w] - discount, 0) / size[c] + discount * held / (size[0] + size[1])
                p[c] = q[c]
                if total[c][v]:
                    p[c] = (max(left[c][v, w] - pair_discount[c], 0) + pair_discount[c] * begins[c][v] * q[c]) / total[c][v]
            whole += math.log(p[1] / p[0])
            backoff += math.log(q[1] / q[0])
        out.append((d, len(text), round(whole, 5), round(backoff, 5)))
    return sorted(out, key=str)


def toxic_corpus(n=400, seed=2):
    rng = random.Random(seed)
    plain, bad = [f"w{i}" for i in range(400)], ["idiotic", "awfully", "Rotten"]
    rows, labels = [], []
    for d in range(n):
        text = [rng.choice(plain) for _ in range(rng.randint(3, 80))]
        toxic = d % 6 == 0
        if toxic:
            for _ in range(rng.randint(2, 5)):
                text.insert(rng.randint(0, len(text)), rng.choice(bad))
        rows.append((d, " ".join(text)))
        if d % 2 == 0 or d % 5 == 0:
            labels.append((d, int(toxic)))
    return rows, labels


def test_slices_hold_whole_documents(monkeypatch):
    monkeypatch.setattr(T, "SLICE", 10)
    assert T._slices(np.array([0])) == []
    assert T._slices(np.array([0, 0, 4, 4, 40, 41, 49, 50])) == [(0, 4), (4, 7)]
    assert T._slices(np.array([0, 10, 20])) == [(0, 1), (1, 2)]


@pytest.mark.parametrize("block_bytes", [1 << 24, 3000])
def test_evidence_against_brute_force(spark, monkeypatch, block_bytes):
    monkeypatch.setattr(B.block_count, "__defaults__", ("text", block_bytes))
    rows, labels = toxic_corpus(120)
    rows += [(200, None), (201, ""), (202, "w1 W1, w1"), (3, rows[3][1])]
    labels += [(0, 0), (999, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = T.word_evidence(docs, spark.createDataFrame(labels, "id long, toxic int")).collect()
    known = {}
    for d, t in labels:
        known[d] = max(t, known.get(d, 0))
    assert sorted(((r["doc_id"], r["words"], round(r["evidence"], 5), round(r["backoff"], 5)) for r in got), key=str) == brute_toxicity(rows, known)


def test_pairs_that_share_a_code(spark, monkeypatch):
    """A history whose pairs all share codes with others' is still followed by words: no likelihood is zero."""
    monkeypatch.setattr(T, "BLOCK_BYTES", 4)  # so short codes that many pairs share one
    monkeypatch.setattr(B.block_count, "__defaults__", ("text", 40000))  # blocks that know a code by other pairs
    rows, labels = toxic_corpus(600)
    rows = [(d, f"{t} r{d // 12} w{d % 2}") for d, t in rows]  # words that few others follow
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    table = spark.createDataFrame(labels, "doc_id long, toxic int")
    found = T.word_evidence(docs, table.withColumnRenamed("doc_id", "id")).collect()
    assert np.isfinite([[r["evidence"], r["backoff"]] for r in found]).all()
    got = {r["doc_id"]: r["score"] for r in T.toxicity(docs, table, ~held_out("doc_id")).collect()}
    out = [d for d, _ in rows if zlib.crc32(str(d).encode()) % 4 == 2]
    bad, fine = ([got[d] for d in out if (d % 6 == 0) is t] for t in (True, False))
    assert np.mean([x > y for x in bad for y in fine]) > 0.9


def test_held_out_accuracy_and_no_leak(spark):
    rows, labels = toxic_corpus(1200)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    label_table = spark.createDataFrame(labels, "doc_id long, toxic int")
    score = lambda t: {r["doc_id"]: r["score"] for r in T.toxicity(docs, t, ~held_out("doc_id")).collect()}
    got = score(label_table)
    out = [d for d, _ in rows if zlib.crc32(str(d).encode()) % 4 == 2]
    assert sum((got[d] >= T.THRESHOLD) == (d % 6 == 0) for d in out) / len(out) > 0.97
    turned = label_table.withColumn("toxic", F.when(held_out("doc_id"), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    assert score(turned) == pytest.approx(got)


def test_toxicity_edge_rows(spark, edge_docs, no_docs):
    labels = spark.createDataFrame([(3, 1, "x"), (4, 0, None), (None, 1, None), (5, None, None), (7, 3, None)], "doc_id long, toxic int, text string")
    rows = T.toxicity(edge_docs, labels).collect()
    assert len(rows) == edge_docs.count() and all(0 <= r["score"] <= 1 for r in rows)
    for none in (labels.where("false"), labels.where("toxic = 0")):
        assert {r["score"] for r in T.toxicity(edge_docs, none).collect()} == {0.5}
    assert T.toxicity(no_docs, labels).collect() == []


def test_map_is_logistic_regression():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(4000, 2))
    y = (rng.random(4000) < 1 / (1 + np.exp(-(2 * x[:, 0] - x[:, 1] + 0.5)))).astype(float)
    assert np.allclose(T.fit_map(x, y), [2, -1, 0.5], atol=0.2)
