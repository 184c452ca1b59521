"""Contiguous shards of equal size from global byte-size prefix sums.

Rows are dealt to range blocks of the document id; each block's total size and
row count are summed, the block totals get a running sum (one short row per
block), and a row's place in the whole corpus is its block's start plus a
running sum inside the block. A row goes to the shard in which its middle byte
falls when the corpus is cut at equal targets, so each shard differs from the
mean by less than one row at either end.

Only built-in DataFrame functions are used. What is shuffled is the id, size
and checksum of a row, never its text. No window is wider than a block.

Defined results: a null text has no bytes; its checksum is that of no bytes.
A row's size is its bytes plus one, so empty rows are spread too. Rows sharing
an id are ordered by size and checksum; equal texts get no group of their own,
a cut may fall between them. Null ids come first. Fewer rows than shards leave
shards empty; an empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from siltlake.session import checkpoint_dir

BLOCKS_PER_PARTITION = 4


def shard_by_bytes(docs: DataFrame, shards: int = 16, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, size, text_crc32, shard (0..shards-1), slot (gapless from 0 in
    each shard, in id order)."""
    spark = docs.sparkSession
    checkpoint_dir(spark)
    text = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    rows = docs.select(F.col(id_col).alias("doc_id"), (F.octet_length(text) + F.lit(1)).cast("long").alias("size"),
                       F.crc32(text).alias("text_crc32"))
    # the input row number splits a run of equal ids over several blocks
    blocks = BLOCKS_PER_PARTITION * int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = (rows.withColumn("_tie", F.monotonically_increasing_id())
             .repartitionByRange(blocks, "doc_id", "size", "text_crc32", "_tie").drop("_tie")
             .withColumn("_block", F.spark_partition_id())
             .checkpoint())  # block numbers are only used as written here
    totals = dealt.groupBy("_block").agg(F.sum("size").alias("_bytes"), F.count("*").alias("_rows"))
    # one short row per block: the only window over all of them, bounded by the number of blocks
    totals = totals.withColumn("_all", F.col("_block") >= 0)
    every = Window.partitionBy("_all")
    before = every.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select("_block", F.coalesce(F.sum("_bytes").over(before), F.lit(0)).alias("_start"),
                           F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_first"),
                           F.sum("_bytes").over(every).alias("_total"))
    inside = Window.partitionBy("_block").orderBy("doc_id", "size", "text_crc32")
    running = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = (dealt.withColumn("_upto", F.sum("size").over(running)).withColumn("_nth", F.row_number().over(inside))
              .join(F.broadcast(starts), "_block")  # one row per block
              .select("doc_id", "size", "text_crc32", (F.col("_first") + F.col("_nth") - 1).alias("_row"),
                      F.expr(f"least({shards - 1}, int((2 * (_start + _upto) - size) * {shards} div (2 * _total)))").alias("shard")))
    first = placed.groupBy("shard").agg(F.min("_row").alias("_from"))
    return (placed.join(F.broadcast(first), "shard")  # one row per shard
            .select("doc_id", "size", "text_crc32", "shard", (F.col("_row") - F.col("_from")).alias("slot")))
