"""Exact deduplication by deterministic block naming (DataFrame functions only).

Each text is cut into blocks of ``block_bytes`` bytes. Distinct blocks are sorted and numbered, adjacent
pairs of numbers are sorted and numbered again, and so on, until every document is one number: its
identity, equal for two documents exactly when their texts are equal. No hash decides equality: the block
hash only routes a block to its name, and blocks that share a hash are told apart by their bytes.

At scale: the texts' bytes cross the network once (as distinct blocks, pre-aggregated on the map side);
everything after that moves integers only. A group of copies, however large, collapses in the partial
aggregation, and the joins back to its rows are plain equi-joins whose hot side AQE can split.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import lower_ascii, materialize, named, table

BLOCK_BYTES = 4096


def _blocks(data: Column, block_bytes: int) -> Column:
    n = F.greatest(F.ceil(F.octet_length(data) / block_bytes), F.lit(1))
    return F.transform(
        F.sequence(F.lit(0).cast("long"), n - 1),
        lambda i: F.substring(data, (i * block_bytes + 1).cast("int"), F.lit(block_bytes)),
    )


def exact_dedup(
    docs: DataFrame,
    text: str = "text",
    key: str = "doc_id",
    block_bytes: int = BLOCK_BYTES,
    block_hash: Callable[[Column], Column] = lambda b: F.xxhash64(b),
) -> DataFrame:
    """One row per input row: ``key``, keep_id, group_size, kept, text_sha256, identity.

    Texts are equal when identical after lower-casing A-Z; null counts as empty. Of equal texts the row
    with the largest key is kept, and of rows that repeat that key one only. A null key is smaller than
    any other. Empty input gives an empty result; other columns are ignored, whatever their names.
    """
    spark = docs.sparkSession
    norm = docs.select(F.col(key).alias("_key"), lower_ascii(F.col(text)).alias("_norm"))
    cut = _blocks(F.col("_norm").cast("binary"), block_bytes)
    light = materialize(
        norm.select(
            F.monotonically_increasing_id().alias("_row"),
            "_key",
            F.sha2("_norm", 256).alias("_sha"),
            F.transform(cut, block_hash).alias("_hashes"),
        ),
        "rows",
    )
    items = light.select("_row", "_sha", F.size("_hashes").alias("_n"), F.posexplode("_hashes").alias("_i", "_h"))
    blocks = norm.select(F.explode(cut).alias("_block")).select(block_hash(F.col("_block")).alias("_h"), "_block").distinct()
    routes = materialize(blocks.groupBy("_h").agg(F.count("*").alias("_c")), "block_hashes")
    shared = routes.filter("_c > 1")
    if shared.isEmpty():
        items = items.withColumn("_tie", F.lit(0))
        names = named(routes.withColumn("_tie", F.lit(0)), ["_h", "_tie"], "_name", "block_names")
    else:
        order = Window.partitionBy("_h").orderBy("_block")
        told = materialize(blocks.join(shared.select("_h"), "_h").withColumn("_tie", F.row_number().over(order) - 1), "ties")
        at = norm.select(F.sha2("_norm", 256).alias("_sha"), F.posexplode(cut).alias("_i", "_block"))
        at = at.withColumn("_h", block_hash(F.col("_block"))).join(told.filter("_tie > 0"), ["_h", "_block"])
        at = at.select("_sha", "_i", "_tie").distinct()
        items = items.join(at, ["_sha", "_i"], "left").withColumn("_tie", F.coalesce("_tie", F.lit(0)))
        plain = routes.withColumn("_tie", F.lit(0)).select("_h", "_tie")
        names = named(plain.unionByName(told.filter("_tie > 0").select("_h", "_tie")), ["_h", "_tie"], "_name", "block_names")

    level, done = 0, None
    current = materialize(items.join(names, ["_h", "_tie"]).select("_row", "_i", "_n", "_name"), "level0")
    while True:
        ended = current.filter("_n = 1").select("_row", F.lit(level).alias("_level"), "_name")
        done = ended if done is None else done.unionByName(ended)
        rest = current.filter("_n > 1")
        if rest.isEmpty():
            break
        odd = F.col("_i") % 2 == 1
        pairs = rest.groupBy("_row", (F.col("_i") / 2).cast("int").alias("_i"), F.ceil(F.col("_n") / 2).cast("int").alias("_n")).agg(
            F.max(F.when(~odd, F.col("_name"))).alias("_left"), F.coalesce(F.max(F.when(odd, F.col("_name"))), F.lit(-1)).alias("_right")
        )
        pairs = materialize(pairs, f"pairs{level}")
        names = named(pairs, ["_left", "_right"], "_name", f"names{level + 1}")
        current = materialize(pairs.join(names, ["_left", "_right"]).select("_row", "_i", "_n", "_name"), f"level{level + 1}")
        level += 1

    rows = light.select("_row", "_key", "_sha").join(done, "_row")
    best = F.max(F.struct(F.col("_key"), (-F.col("_row")).alias("_first")))
    groups = materialize(rows.groupBy("_level", "_name").agg(F.count("*").alias("group_size"), best.alias("_best")), "groups")
    return rows.join(groups, ["_level", "_name"]).select(
        F.col("_key").alias(key),
        F.col("_best._key").alias("keep_id"),
        "group_size",
        (F.col("_row") == -F.col("_best._first")).alias("kept"),
        F.col("_sha").alias("text_sha256"),
        F.concat_ws(":", "_level", "_name").alias("identity"),
    )


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents")).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


ORACLE = """
WITH n AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
  FROM documents
)
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id = max(doc_id) OVER g AS kept, sha256(t) AS text_sha256
FROM n WINDOW g AS (PARTITION BY t)
"""
