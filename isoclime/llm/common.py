"""Helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
WORD = r"[^\x20\x09-\x0D]+"


def new_folder(spark: SparkSession, name: str) -> str:
    """A path below the folder all executors share that no other call gets; ``session.release`` deletes it."""
    return scratch(spark, name)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write once to the shared folder and read back: cuts lineage, fixes ids, survives lost executors."""
    path = new_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def lower_ascii(text: Column) -> Column:
    """A-Z to a-z and nothing else; null becomes empty."""
    return F.translate(F.coalesce(text, F.lit("")), UPPER, UPPER.lower())


def word_count(text: Column) -> Column:
    """Number of maximal runs of characters other than space and U+0009..U+000D; null: 0."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def sliced(batches: Iterator[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """The batches in slices of up to ``rows`` rows, so that what Python makes of their texts at a time stays small."""
    for b in batches:
        for at in range(0, b.num_rows, rows):
            yield b.slice(at, rows)


def named(df: DataFrame, keys: list[str], name: str, label: str) -> DataFrame:
    """Distinct ``keys`` rows, sorted globally, each given a unique order-preserving integer ``name``."""
    return materialize(
        df.select(*keys)
        .distinct()
        .repartitionByRange(partitions(df.sparkSession), *keys)
        .sortWithinPartitions(*keys)
        .withColumn(name, F.monotonically_increasing_id()),
        label,
    )
