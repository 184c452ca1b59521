import itertools
import random
import re

import numpy as np
import pytest
from xxhash import xxh64_intdigest

from siltlake.llm import embeddings as E
from siltlake.llm import simhash as S
from siltlake.llm.components import components


def smallest_reachable(nodes, linked):
    """By id, from the links between places in ``nodes``."""
    label = list(range(len(nodes)))

    def find(i):
        while label[i] != i:
            label[i] = label[label[i]]
            i = label[i]
        return i
    for i, j in linked:
        label[find(i)] = find(j)
    groups = {}
    for i in range(len(nodes)):
        if nodes[i] is not None:
            groups[find(i)] = min(groups.get(find(i), nodes[i]), nodes[i])
    return [groups.get(find(i)) for i in range(len(nodes))]


def brute_fingerprint(text, shingle=4):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i:i + shingle]) for i in range(max(1, len(words) - shingle + 1))]
    h = [xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(rows, limit):
    fps = [brute_fingerprint(t) for _, t in rows]
    linked = [(i, j) for i, j in itertools.combinations(range(len(rows)), 2) if bin(fps[i] ^ fps[j]).count("1") <= limit]
    return sorted(zip([d for d, _ in rows], [f"{f:016x}" for f in fps], smallest_reachable([d for d, _ in rows], linked)), key=str)


def test_fingerprint_slices(monkeypatch):
    text = " ".join(f"W{i * i}" for i in range(500)) + "\x1c é\x0bß"
    whole = S.fingerprint(text)
    assert whole == brute_fingerprint(text)
    monkeypatch.setattr(S, "_SLICE", 7)
    assert S.fingerprint(text) == whole


@pytest.mark.parametrize("limit", [0, 1, 3, 4, 7])
def test_every_close_pair_has_a_chain(limit):
    rng = np.random.default_rng(limit)
    masks = S.segment_masks(limit)
    assert sum(masks) == (1 << 64) - 1
    x = np.zeros(4000, dtype=np.uint64)
    for k in range(len(x)):
        for b in rng.choice(64, rng.integers(0, limit + 3), replace=False):
            x[k] |= np.uint64(1) << np.uint64(b)
    found = np.zeros(len(x), dtype=bool)
    for start, m in enumerate(masks):
        met = np.flatnonzero((x & np.uint64(m)) == 0)
        found[met[S.chain_links(x[met], start, masks, limit)]] = True
    assert (found == (np.bitwise_count(x) <= limit)).all()


def near_copies(rng, n):
    base = [" ".join(rng.choice("alpha beta gamma delta eps zeta eta".split()) + str(rng.randint(0, 9)) for _ in range(120)) for _ in range(6)]
    for i in range(n):
        words = rng.choice(base).split()
        for _ in range(rng.randint(0, 2)):
            words[rng.randrange(len(words))] = f"new{rng.randint(0, 99)}"
        yield i, " ".join(words) if rng.random() < 0.8 else f"alone {i} {rng.random()}"


def test_near_duplicates_against_all_pairs(spark):
    rows = list(near_copies(random.Random(2), 150)) + [(200, ""), (201, None), (202, "  \n")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(map(tuple, S.near_duplicates(docs).collect()), key=str) == brute_components(rows, 4)


def test_tiles_of_a_hot_key(spark):
    """Distinct fingerprints that all share a segment, many times the tile size."""
    rng = random.Random(5)
    fps = sorted({rng.getrandbits(14) << 20 for _ in range(700)})
    classes = spark.createDataFrame([(i, f) for i, f in enumerate(fps)], "id long, fp long")
    links = S.links(classes, 4, most=64)
    assert links.count() < 5 * 5 * len(fps)
    got = {r["node"]: r["component"] for r in components(links).collect()}
    expected = smallest_reachable(list(range(len(fps))), [(i, j) for i, j in itertools.combinations(range(len(fps)), 2) if bin(fps[i] ^ fps[j]).count("1") <= 4])
    assert [got.get(i, i) for i in range(len(fps))] == expected


def test_simhash_edge_rows(edge_docs, no_docs):
    rows = [(r["doc_id"], r["text"]) for r in edge_docs.collect()]
    assert sorted(map(tuple, S.near_duplicates(edge_docs).collect()), key=str) == brute_components(rows, 4)
    assert S.near_duplicates(no_docs).collect() == []


@pytest.mark.parametrize("edges", [[], [(1, 1)], [(1, 2), (2, 1), (None, 3)], [(i, i + 1) for i in range(60)],
                                   [(0, i) for i in range(1, 200)], [(i, (i * 7) % 40) for i in range(40)]])
def test_components(spark, edges):
    df = spark.createDataFrame(edges, "u long, v long")
    real = [(u, v) for u, v in edges if u is not None and u != v]
    nodes = sorted({x for e in real for x in e})
    expected = dict(zip(nodes, smallest_reachable(nodes, [(nodes.index(u), nodes.index(v)) for u, v in real])))
    assert {r["node"]: r["component"] for r in components(df).collect()} == expected


def brute_vectors(rows, cosine):
    good = [(i, np.array(v, dtype=float)) for i, (_, v) in enumerate(rows)
            if v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    linked = []
    for (i, a), (j, b) in itertools.combinations(good, 2):
        if len(a) == len(b):
            a, b = a / np.abs(a).max(), b / np.abs(b).max()
            if a @ b / np.sqrt((a @ a) * (b @ b)) >= cosine:
                linked.append((i, j))
    n = [sum(i in e for e in linked) for i in range(len(rows))]
    return n, smallest_reachable([d for d, _ in rows], linked)


def test_vectors_against_all_pairs(spark):
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(8, 32))
    rows = [(int(i), (centres[i % 8] + rng.normal(size=32) * rng.choice([0.02, 0.15, 1.0])).astype("f4").tolist()) for i in range(300)]
    rows += [(300, rows[0][1]), (301, rows[0][1]), (302, [2 * x for x in rows[0][1]]), (303, [3 * x for x in rows[0][1]])]
    got = sorted(E.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).collect())
    n, comp = brute_vectors(rows, 0.95)
    assert [r["n_links"] for r in got] == n and [r["component_id"] for r in got] == comp
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in got)


def test_recall_at_the_threshold(spark):
    """Pairs at a cosine just above the threshold, the hardest to find."""
    rng = np.random.default_rng(4)
    rows = []
    for i in range(400):
        a = rng.normal(size=64)
        a /= np.linalg.norm(a)
        b = rng.normal(size=64)
        b -= a * (a @ b)
        b /= np.linalg.norm(b)
        c = 0.9502
        rows += [(2 * i, a.tolist()), (2 * i + 1, (c * a + np.sqrt(1 - c * c) * b).tolist())]
    got = E.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    assert got.where("n_links > 0").count() >= 2 * 400 * 0.99


def test_dense_bucket_in_tiles(spark):
    rng = np.random.default_rng(6)
    centre = rng.normal(size=16)
    rows = [(i, i, (centre + rng.normal(size=16) * 0.02).astype("<f8").tobytes()) for i in range(300)]
    classes = spark.createDataFrame([(i, 1, bytearray(v)) for i, _, v in rows], "id long, n long, vector binary")
    found = E.cosine_links(classes, 300, most=32).groupBy("u").sum("n_links").collect()
    assert sorted(r[1] for r in found) == [299] * 300


def test_vector_edge_rows(spark):
    rows = [(0, None), (1, []), (2, [0.0, 0.0]), (3, [1.0, None]), (4, [float("nan"), 1.0]), (5, [float("inf"), 1.0]), (6, [1.0, 0.0]),
            (7, [1.0, 0.0]), (7, [1.0, 0.0]), (8, [1.0, 0.0, 0.0]), (9, [-0.0, 1.0]), (10, [0.0, 5.0]), (11, [1e-30, 0.0]), (None, None)]
    df = spark.createDataFrame([(i, v, 3, "x") for i, v in rows], "vec_id long, embedding array<float>, n int, vector string")
    got = {(r["vec_id"], r["n_links"], r["component_id"], r["kept"]) for r in E.near_vectors(df).collect()}
    assert got == {(0, 0, 0, True), (1, 0, 1, True), (2, 0, 2, True), (3, 0, 3, True), (4, 0, 4, True), (5, 0, 5, True), (6, 3, 6, True),
                   (7, 3, 6, False), (8, 0, 8, True), (9, 1, 9, True), (10, 1, 9, False), (11, 3, 6, False), (None, 0, None, None)}
    assert E.near_vectors(df.where("false")).collect() == []
