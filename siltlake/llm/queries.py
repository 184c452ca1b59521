"""The registered queries of the training-data operators: each reads its whole
table and returns the full result of its contract."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from siltlake.llm import ranked, topk, urls

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

PACK_TOKENIZER = "word_bpe_49k.json"


def register(name: str, oracle: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle.strip()
        return fn
    return deco


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@register("op1_pack")
def op1_pack(spark, sf_dir):
    from siltlake.llm.packing import pack
    return pack(table(spark, sf_dir, "documents"), PACK_TOKENIZER)


@register("op2_skip_chain_pii")
def op2_skip_chain_pii(spark, sf_dir):
    from siltlake.llm.pii import find_pii, pii_digest
    return pii_digest(find_pii(table(spark, sf_dir, "documents")))


@register("op3_url_vocabulary", urls.judge_sql())
def op3_url_vocabulary(spark, sf_dir):
    return urls.judge_urls(table(spark, sf_dir, "pages"))


@register("op4_byte_shards")
def op4_byte_shards(spark, sf_dir):
    from pyspark.sql import functions as F
    from siltlake.llm.sharding import shard_by_bytes
    return shard_by_bytes(table(spark, sf_dir, "documents"), 16).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


@register("op5_spaced_seeds")
def op5_spaced_seeds(spark, sf_dir):
    from siltlake.llm.decontam import find_overlaps
    return find_overlaps(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@register("op7_p_stable_hashing")
def op7_p_stable_hashing(spark, sf_dir):
    from siltlake.llm.embeddings import near_vectors
    return near_vectors(table(spark, sf_dir, "embeddings"))


@register("op8_pigeonring")
def op8_pigeonring(spark, sf_dir):
    from siltlake.llm.simhash import near_duplicates
    return near_duplicates(table(spark, sf_dir, "documents"))


@register("op9_segment_edit_join")
def op9_segment_edit_join(spark, sf_dir):
    from pyspark.sql import functions as F
    from siltlake.llm.lines import dedup_lines
    kept = dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"), counts=True, short_repeats=2)
    return kept.select("doc_id", "n_lines", "n_removed", "n_near", F.length("text").alias("n_chars"),
                       F.sha2(F.col("text").cast("binary"), 256).alias("text_sha256"))


def held_out(doc_id):
    """The rows whose labels are never learned from."""
    from pyspark.sql import functions as F
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2


@register("op10_kneser_ney_toxicity")
def op10_kneser_ney_toxicity(spark, sf_dir):
    from pyspark.sql import functions as F
    from siltlake.llm.toxicity import THRESHOLD, toxicity
    scored = toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), ~held_out("doc_id"))
    return scored.select("doc_id", held_out("doc_id").alias("held_out"), "score",
                         (F.col("score") >= THRESHOLD).cast("int").alias("predicted"), "words", "evidence", "backoff")


@register("op6_bucket_pointer_refinement")
def op6_bucket_pointer_refinement(spark, sf_dir):
    from siltlake.llm.substrings import repeated_bytes
    return repeated_bytes(table(spark, sf_dir, "documents")).drop("spans")


@register("op12_suffix_dawg")
def op12_suffix_dawg(spark, sf_dir):
    from siltlake.llm.conversations import damaged, repair_digest
    conversations = table(spark, sf_dir, "conversations")
    return repair_digest(conversations, damaged(conversations))


@register("op13_best_position", ranked.search_sql())
def op13_best_position(spark, sf_dir):
    return ranked.ranked_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@register("op11_norm_buckets", topk.top_sql())
def op11_norm_buckets(spark, sf_dir):
    from pyspark.sql import functions as F
    return topk.top_products(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)
