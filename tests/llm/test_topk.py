import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from siltlake.llm.topk import Bucket, Pack, _HIGH, _LOW, cell, pack_arrays, top_products

SCHEMA = "vec_id long, embedding array<double>"


def brute(rows, top=20, modulus=20):
    seen, own = set(), []
    for i, v in rows:
        if not v or any(x is None or not math.isfinite(x) for x in v) or any(math.isinf(64 * x) for x in v):
            continue
        q = tuple(math.floor(64 * x) for x in v)
        if (i, q) not in seen:
            seen.add((i, q))
            own.append((i, q))
    out = []
    for i, q in own:
        if i is None or i % modulus:
            continue
        found = [(-min(_HIGH, max(_LOW, sum(a * b for a, b in zip(q, p)))), j is None, j or 0, j) for j, p in own if len(p) == len(q) and j != i]
        out += [(i, r + 1, x[3], -x[0]) for r, x in enumerate(sorted(found, key=lambda x: x[:3])[:top])]
    return Counter(out)


def rows_of(df):
    return Counter((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in df.collect())


def vectors(seed, n, dim=16, spread=0.3):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((12, dim))
    x = centres[rng.integers(0, 12, n)] + spread * rng.standard_normal((n, dim))
    x *= np.exp(rng.normal(0, 0.8, n))[:, None]  # lengths differ widely
    return [(i, row.tolist()) for i, row in enumerate(x)]


def is_query():
    return F.col("vec_id") % 20 == 0


@pytest.mark.parametrize("bucket_rows,block_rows", [(100, 7), (16384, 8192)])
def test_against_brute_force(spark, bucket_rows, block_rows):
    rows = vectors(1, 900)
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    assert rows_of(top_products(df, is_query(), bucket_rows=bucket_rows, block_rows=block_rows)) == brute(rows)


def test_ties_copies_and_equal_lengths(spark):
    rows = [(i, [1.0, 0.5, -0.25, 0.0]) for i in range(300)] + [(1000 + i, [0.5, 1.0, 0.0, -0.25]) for i in range(200)]
    rows += [(2000 + i, [0.0, 0.0, 0.0, 0.0]) for i in range(60)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert rows_of(top_products(df, is_query(), bucket_rows=64, block_rows=16)) == brute(rows)


def test_edge_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0]), (0, [1.0, 2.0]), (0, [1.001, 2.0]), (0, [3.0, 1.0]), (20, None), (40, []), (60, [nan, 1.0]), (80, [inf, 1.0]), (100, [None, 1.0]),
            (120, [0.0, 0.0]), (7, [5.0, 5.0]), (7, [5.0, 5.0]), (None, [5.0, 5.0]), (None, [1.0, 1.0]), (140, [1.0, 2.0, 3.0]), (141, [1.0, 1.0, 1.0]),
            (160, [1e30, -1e30]), (161, [1e18, 1.0]), (180, [-4e4, 3.0]), (200, [1e308, 0.0])]
    df = spark.createDataFrame([(*r, 1, 2.0, "x", "y") for r in rows], SCHEMA + ", qid long, theta double, pack string, v string")
    assert rows_of(top_products(df, is_query())) == brute(rows)
    assert rows_of(top_products(df, is_query(), bucket_rows=2, block_rows=2)) == brute(rows)
    assert top_products(df.where("false"), is_query()).collect() == []
    few = spark.createDataFrame([(20, [1.0, 1.0])], SCHEMA)
    assert top_products(few, is_query()).collect() == []


def pack_of(ids, x, theta):
    x = np.floor(64 * np.asarray(x)).astype("<f8")
    n = len(ids)
    payload = pack_arrays(np.asarray(ids, np.int64), np.zeros(n, np.int8), np.sqrt((x * x).sum(1)), np.arange(n), np.asarray(theta, float),
                          np.frombuffer(b"<f8", np.uint8), x.ravel())
    return Pack(payload, x.shape[1])


def test_both_prunings_and_the_skip_are_used_and_lose_nothing():
    rng = np.random.default_rng(3)
    centres = rng.standard_normal((40, 24))
    x = centres[rng.integers(0, 40, 4000)] + 0.15 * rng.standard_normal((4000, 24))
    q = centres[:30] + 0.15 * rng.standard_normal((30, 24))
    bucket = Bucket(pack_of(range(4000), x, np.full(4000, -np.inf)))
    quantised = np.floor(64 * q)
    scores = quantised @ np.floor(64 * x).T
    theta = np.sort(scores, axis=1)[:, -20].copy()
    theta[10:20] = theta[10:20] * 0.3
    theta[20:] = np.sqrt((quantised[20:] ** 2).sum(1)) * bucket.norms[0] * 1.01
    counts = {}
    rows, cands, got = cell(pack_of(range(10000, 10030), q, theta), bucket, 20, counts)
    assert counts["skipped"] == 10 and counts["coordinate"] and counts["length"] and counts["products"] < 20 * 4000
    assert set(rows.tolist()) == set(range(20))
    for k in range(20):
        want = np.lexsort((np.arange(4000), -scores[k]))[:20]
        mine = rows == k
        assert bucket.ids[cands[mine]].tolist() == want.tolist() and got[mine].tolist() == scores[k][want].tolist()
