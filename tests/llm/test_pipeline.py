import random
from collections import defaultdict

import corpus_pipeline as C
import siltlake.llm.blocks as B
import siltlake.llm.toxicity as T
from test_decontam_substrings import brute_overlaps
from test_lines_toxicity import brute_lines, toxic_corpus
from test_near_duplicates import brute_components

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


def folder(spark, tmp_path, docs, labels, items):
    spark.createDataFrame([(d, t, "en", "s", len(t or "")) for d, t in docs], COLUMNS).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    return str(tmp_path)


def corpus():
    rng = random.Random(11)
    docs, labels = toxic_corpus(900)
    items = [(i, " ".join(f"bench{i} q{rng.randint(0, 99)}" for _ in range(12))) for i in range(5)]
    docs = [(d, t.replace(" ", "\n", 1)) for d, t in docs]
    docs += [(1000 + i, f"before it {items[i][1]} after it") for i in range(5)]
    docs += [(1100 + i, docs[5 + 6 * i][1]) for i in range(10)]  # exact copies
    docs += [(1200 + i, docs[7 + 6 * i][1] + " more") for i in range(10)]  # near copies
    docs += [(1300, None), (1301, ""), (1302, "  "), (1303, "a line that many documents share, word for word\nown line of this one, nobody else")]
    docs += [(1304 + i, f"a line that many documents share, word for word\nthe number {i} is {i * i * 7919} of a kind") for i in range(5)]
    return docs, labels, items


def test_each_stage_against_brute_force(spark, tmp_path):
    docs, labels, items = corpus()
    sf_dir = folder(spark, tmp_path, docs, labels, items)
    table = spark.read.parquet(f"{sf_dir}/documents.parquet")
    texts = lambda df: {r["doc_id"]: r["text"] for r in df.collect()}

    one = C.drop_toxic(spark, table, sf_dir)
    kept = texts(one)
    bad = {d for d, t in docs if t and any(w in t for w in ("idiotic", "awfully", "Rotten"))}
    assert len(bad & set(kept)) <= 0.1 * len(bad) and len(set(kept) - bad) >= 0.95 * (len(docs) - len(bad))
    assert all(kept[d] == t for d, t in docs if d in kept) and one.columns == table.columns

    rows = sorted(kept.items())
    two = texts(C.drop_repeated_lines(spark, one, sf_dir))
    expected = {d: t for d, t, n, _ in brute_lines(rows, 1, 30) if not n or (t and t.strip())}
    assert two == expected and any(two.get(d) != t for d, t in kept.items())

    frame = spark.createDataFrame([(d, t, "en", "s", 0) for d, t in two.items()], COLUMNS)
    three = texts(C.drop_near_duplicates(spark, frame, sf_dir))
    assert three == {d: two[d] for d, _, c in brute_components(sorted(two.items()), 4) if d == c}

    four = texts(C.drop_contaminated(spark, frame, sf_dir))
    leaked = {d for d, _ in brute_overlaps(list(two.items()), items)}
    assert four == {d: t for d, t in two.items() if d not in leaked}
    assert not any(1000 <= d < 1005 for d in four) and len(four) == len(two) - 5


def test_run(spark, tmp_path):
    docs, labels, items = corpus()
    sf_dir = folder(spark, tmp_path, docs, labels, items)
    rows = C.run(spark, sf_dir).collect()
    ids = {r["doc_id"] for r in rows}
    assert ids and not ids & {1000, 1001, 1002, 1003, 1004}
    seqs = defaultdict(list)
    for r in rows:
        seqs[r["sequence_id"]].append((r["offset"], r["length"]))
    for items in seqs.values():
        assert sum(n for _, n in items) <= 4096


def test_stages_take_edge_rows(spark, edge_docs, no_docs, tmp_path):
    sf_dir = folder(spark, tmp_path, [], [(3, 1)], [(1, None)])
    docs = edge_docs.select("doc_id", "text", "lang", "source", "n_chars")
    for name, stage in C.STAGES:
        out = stage(spark, docs, sf_dir)
        assert name == C.STAGES[-1][0] or out.columns == docs.columns
        assert out.count() <= 1 + docs.count() * 6
        assert stage(spark, no_docs.select(*docs.columns), sf_dir).collect() == []


def test_larger_reject_lists_are_joined_by_shuffle(spark, monkeypatch):
    docs = spark.createDataFrame([(i, "x") for i in [*range(50), None]], "doc_id long, text string")
    gone = spark.createDataFrame([(i,) for i in [1, 1, 2, None]], "doc_id long")
    for most in (1_000_000, 0):
        monkeypatch.setattr(C, "BROADCAST_IDS", most)
        out = C.without(docs, gone)
        assert sorted(r["doc_id"] for r in out.collect()) == [0, *range(3, 50)]


def test_rows_without_an_id_are_judged_one_by_one(spark, tmp_path):
    docs, labels, items = corpus()
    sf_dir = folder(spark, tmp_path, docs, labels, items)
    table = spark.read.parquet(f"{sf_dir}/documents.parquet")
    texts = ["you idiotic awfully Rotten idiotic awfully Rotten idiotic thing", f"quite before it {items[0][1]} and after", "a clean and lonely text without an id at all", "a clean and lonely text without an id at all"]
    nameless = spark.createDataFrame([(None, t, "en", "s", len(t)) for t in texts], COLUMNS)
    both = table.unionByName(nameless)
    left = lambda df: sorted(r["text"] for r in df.where("doc_id IS NULL").collect())
    assert left(C.drop_toxic(spark, both, sf_dir)) == sorted(texts[1:])
    assert left(C.drop_contaminated(spark, both, sf_dir)) == sorted([texts[0], *texts[2:]])
    assert left(C.drop_near_duplicates(spark, both, sf_dir)) == sorted(texts)  # equal rows are one
    assert C.drop_repeated_lines(spark, both, sf_dir).where("doc_id IS NULL").count() == 4


def test_clean_documents_stay_where_pairs_share_codes(spark, tmp_path, monkeypatch):
    """What comes from many texts in small: a document stays or goes by its own words."""
    monkeypatch.setattr(T, "BLOCK_BYTES", 4)
    monkeypatch.setattr(B.block_count, "__defaults__", ("text", 40000))
    docs, labels = toxic_corpus(600)
    docs = [(d, f"{t} r{d // 12} w{d % 2}") for d, t in docs]
    sf_dir = folder(spark, tmp_path, docs, labels, [])
    kept = {r["doc_id"] for r in C.drop_toxic(spark, spark.read.parquet(f"{sf_dir}/documents.parquet"), sf_dir).collect()}
    assert sum(d in kept for d, _ in docs if d % 6) > 0.8 * 500 and sum(d in kept for d, _ in docs if d % 6 == 0) < 0.5 * 100
