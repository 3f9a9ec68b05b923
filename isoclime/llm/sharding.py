"""Contiguous shards of near equal bytes from global prefix sums (DataFrame functions only).

Rows are range-partitioned by key; each partition's total bytes and rows are summed; a prefix sum over the
partition totals (one row per partition) gives every partition its global start, a running sum inside the
partition gives every row its own. Cutting the global byte line at equal targets gives the shards. Only
(key, size, crc) moves: no text is shuffled, and no key or group of copies is kept together, so neither
can unbalance a shard. The two broadcast tables have one row per partition and one per shard.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import materialize, partitions, table

ROW_OVERHEAD = 16


def shard_by_bytes(docs: DataFrame, n_shards: int, text: str = "text", key: str = "doc_id", overhead: int = ROW_OVERHEAD) -> DataFrame:
    """One row per input row: ``key``, size, text_crc32, law, shard, slot, grown_shard, start_byte.

    Size is the text's UTF-8 bytes (null: none) plus ``overhead``. Order is by key, null first; rows that
    tie on key are ordered by checksum and size, so equal rows are interchangeable; they are parted by where they
    are read, so any number of rows with one key (null, say) and one text goes over many tasks. A row goes to the shard
    that holds its middle byte. Empty input gives an empty result; other columns are ignored.
    """
    spark = docs.sparkSession
    body = F.coalesce(F.col(text), F.lit(""))
    light = docs.select(
        F.col(key).alias("_key"),
        (F.octet_length(body) + F.lit(overhead)).cast("long").alias("size"),
        F.crc32(body.cast("binary")).alias("text_crc32"),
        F.monotonically_increasing_id().alias("_place"),
    )
    order = ["_key", "text_crc32", "size", "_place"]  # the place parts rows that are equal otherwise, however many there are
    ranged = materialize(light.repartitionByRange(partitions(spark), *order).withColumn("_part", F.spark_partition_id()), "ranged")
    totals = ranged.groupBy("_part").agg(F.sum("size").alias("_bytes"), F.count("*").alias("_rows"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    base = totals.select(
        "_part",
        F.coalesce(F.sum("_bytes").over(before), F.lit(0)).alias("_byte0"),
        F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_row0"),
        F.sum("_bytes").over(everything).alias("_total"),
    )
    inside = Window.partitionBy("_part").orderBy(*order)
    running = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = ranged.select("*", F.sum("size").over(running).alias("_upto"), F.row_number().over(inside).alias("_nth"))
    placed = placed.join(F.broadcast(base), "_part").select(
        *order[:3],
        (F.col("_byte0") + F.col("_upto") - F.col("size")).alias("start_byte"),
        (F.col("_row0") + F.col("_nth") - 1).alias("_index"),
        "_total",
    )
    middle = (2 * F.col("start_byte") + F.col("size")) * F.lit(n_shards)
    placed = placed.withColumn("shard", F.least(F.lit(n_shards - 1), F.floor(middle / (2 * F.col("_total")))).cast("int"))
    first = placed.groupBy("shard").agg(F.min("_index").alias("_first"))
    return placed.join(F.broadcast(first), "shard").select(
        F.col("_key").alias(key),
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        (F.col("_index") - F.col("_first")).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
        "start_byte",
    )


def op9_byte_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_by_bytes(table(spark, sf_dir, "documents"), 40)
