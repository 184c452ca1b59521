import zlib

import duckdb
import pytest

from siltlake.llm import urls as U
from siltlake.llm.sharding import shard_by_bytes

URLS = [None, "", "no scheme", "http://A.Example.NET/en/x", "http://example.net/de/", "https://org/fr/", "http://notorg/fr/", "http://x.org/en/cheap-pills",
        "http://net", "http://net?a=/", "http://net/", "http://example.com/de/a?b#c", "http://h.example.com/en/cheap/pills", "http://h/cheapest/pills",
        "http://h/free-pills", "http://h/sexton", "http://h/sex?x", "http://h/SEX", "a://b://c/de/", "http://h#://x/", "http://example.com:80/de/",
        "http://net/\nsex", "http://h/cheap/cheap", "://", "http:///en/", "http://ünï.net/é"]


@pytest.fixture(scope="module")
def pages(spark):
    rows = [(i, u, "sex", "x") for i, u in enumerate(URLS)] + [(3, URLS[3], None, None), (None, None, None, None)]
    return spark.createDataFrame(rows, "page_id long, url string, html string, host string")


def test_verdicts_equal_the_sql(pages):
    got = sorted(map(tuple, U.judge_urls(pages).collect()), key=str)
    con = duckdb.connect()
    con.register("pages", pages.toPandas().astype({"page_id": "Int64"}))
    assert got == sorted(con.execute(U.judge_sql()).fetchall(), key=str)


def test_named_cases(pages):
    rows = {r["page_id"]: r for r in U.judge_urls(pages).collect() if r["page_id"] is not None}
    assert (rows[3]["host"], rows[3]["rule"], rows[3]["verdict"]) == ("a.example.net", "example.net/en/", "allow")
    assert rows[4]["rule"] == "net/" and rows[4]["verdict"] == "block"
    assert (rows[7]["rule"], rows[7]["verdict"]) == (None, "block")
    assert (rows[8]["path"], rows[8]["rule"]) == ("", None)
    assert rows[6]["rule"] is None and rows[5]["rule"] == "org/fr/"
    assert rows[12]["verdict"] == "block" and rows[13]["verdict"] == "allow"
    assert rows[15]["verdict"] == "allow" and rows[17]["verdict"] == "block"
    assert rows[22]["verdict"] == "allow"  # one soft term twice


def test_no_pages(pages):
    assert U.judge_urls(pages.where("false")).collect() == []


def brute_shards(rows, shards):
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    total, at, out, seen = sum(r[1] for r in rows), 0, [], {}
    for doc, size, crc in rows:
        shard = min(shards - 1, (2 * at + size) * shards // (2 * total))
        seen[shard] = seen.get(shard, -1) + 1
        out.append((doc, size, crc, shard, seen[shard]))
        at += size
    return sorted(out, key=str)


@pytest.mark.parametrize("shards", [1, 3, 16])
def test_shards(spark, edge_docs, shards):
    rows = [(r["doc_id"], len((r["text"] or "").encode()) + 1, zlib.crc32((r["text"] or "").encode())) for r in edge_docs.collect()]
    assert sorted(map(tuple, shard_by_bytes(edge_docs, shards).collect()), key=str) == brute_shards(rows, shards)


def test_shards_with_one_hot_id(spark):
    docs = spark.range(3000).selectExpr("if(id % 3 = 0, 7, id) doc_id", "repeat('x', int(id % 50)) text").repartition(5)
    rows = [(r["doc_id"], len(r["text"]) + 1, zlib.crc32(r["text"].encode())) for r in docs.collect()]
    got = shard_by_bytes(docs, 16).collect()
    assert sorted(map(tuple, got), key=str) == brute_shards(rows, 16)
    sizes = {}
    for r in got:
        sizes[r["shard"]] = sizes.get(r["shard"], 0) + r["size"]
    assert max(sizes.values()) - min(sizes.values()) <= 2 * 51


def test_no_rows(no_docs):
    assert shard_by_bytes(no_docs, 16).collect() == []
