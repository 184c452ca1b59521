"""The corpus pipeline: toxicity, line dedup, SimHash near-dedup, benchmark
decontamination and best-fit packing, one operator a stage.

``STAGES`` lists ``(name, function)``; a function takes ``(spark, docs,
sf_dir)`` and returns the documents that stay, with the columns of
``documents`` (the last one: the packed pieces). ``run`` writes each stage's
result as Parquet to the shared folder and gives it to the next.

Rows that share an id stay or go together; rows without an id are told apart by
what they hold, so only equal ones do. A document goes if:
it is scored toxic; all its lines were repeats of other lines; another
document of its near-duplicate group has a smaller id; it shares a passage
with a benchmark item. Empty tables give no rows.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltlake.llm.decontam import find_overlaps
from siltlake.llm.lines import dedup_lines
from siltlake.llm.packing import pack
from siltlake.llm.queries import PACK_TOKENIZER, held_out
from siltlake.llm.simhash import near_duplicates
from siltlake.llm.toxicity import THRESHOLD, toxicity
from siltlake.session import checkpoint_dir

#: ids up to this number (16 bytes each in a hash table) are sent to every task; more are joined by a shuffle
BROADCAST_IDS = 1_000_000
#: a line too short for the edit join is boilerplate if it stands this often in all documents: short lines
#: that stand a few times are headings, answers and list items, which a text needs where it has them
SHORT_REPEATS = 10


ROW = "_row"


def identified(docs: DataFrame) -> DataFrame:
    """``docs`` with an id for every row: its own, or where it has none one
    made from what it holds (from 2^62 on, so that given ids come first)."""
    made = F.xxhash64("text", "lang", "source", "n_chars").bitwiseAND((1 << 62) - 1).bitwiseOR(1 << 62)
    return docs.withColumn(ROW, F.coalesce(F.col("doc_id").cast("long"), made))


def kept(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """The rows of ``identified`` documents whose id is not in ``gone(doc_id)``."""
    return without(docs, gone, ROW).drop(ROW)


def without(docs: DataFrame, gone: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """``docs`` without the rows whose id is in ``gone(doc_id)``."""
    checkpoint_dir(docs.sparkSession)
    ids = gone.select(F.col("doc_id").alias("_gone")).distinct().checkpoint()
    if ids.count() <= BROADCAST_IDS:
        ids = F.broadcast(ids)
    return docs.join(ids, docs[id_col].eqNullSafe(F.col("_gone")), "left_anti")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored at least ``THRESHOLD`` go."""
    docs = identified(docs)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").withColumn(ROW, F.col("doc_id").cast("long"))
    scored = toxicity(docs, labels, ~held_out("doc_id"), id_col=ROW)
    return kept(docs, scored.where(F.col("score") >= THRESHOLD))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated lines go, and documents of which nothing but white space is left."""
    left = dedup_lines(identified(docs), id_col=ROW, counts=True, short_repeats=SHORT_REPEATS)
    return left.where((F.col("n_removed") == 0) | F.col("text").rlike(r"\S")).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the document with the smallest id stays."""
    docs = identified(docs)
    return kept(docs, near_duplicates(docs, id_col=ROW).where("doc_id <> component_id"))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share a passage with a benchmark item go."""
    docs = identified(docs)
    return kept(docs, find_overlaps(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), id_col=ROW))


def pack_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document's pieces, packed into sequences."""
    return pack(docs, PACK_TOKENIZER)


STAGES = [
    ("toxicity", drop_toxic),
    ("line dedup", drop_repeated_lines),
    ("simhash near-dedup", drop_near_duplicates),
    ("benchmark decontamination", drop_contaminated),
    ("best-fit packing", pack_documents),
]

#: toxicity scores, fingerprints and token ids have no SQL form; tests compare with brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = f"{checkpoint_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{k}")
        docs = spark.read.parquet(f"{folder}/{k}")
    return docs


QUERIES = {"pipeline": run}
ORACLES: dict[str, str] = {} if ORACLE_SQL is None else {"pipeline": ORACLE_SQL}
