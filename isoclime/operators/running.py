"""Running sums over tables of any size: a range sort, sums inside its partitions, prefix sums of their totals."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from isoclime.session import scratch


def running(df: DataFrame, order: Sequence[Column], sums: dict[str, str], by: Sequence[str] = ()) -> DataFrame:
    """``df`` plus, for each name in ``sums``, the running sum of its column in ``order``, apart for each group of ``by``.

    Rows should differ in ``order``. The sorted rows are written once, so their partitions stay what they are; no
    window holds more than one of them, and the table of totals has one row a partition and group.
    """
    spark = df.sparkSession
    n, path = int(spark.conf.get("spark.sql.shuffle.partitions")), scratch(spark, "ranged")
    df.repartitionByRange(n, *(F.col(c) for c in by), *order).withColumn("_part", F.spark_partition_id()).write.parquet(path)
    ranged = spark.read.parquet(path)
    totals = ranged.groupBy("_part", *by).agg(*(F.sum(c).alias(f"_of_{name}") for name, c in sums.items()))
    before = Window.partitionBy(*by).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    base = totals.select("_part", *by, *(F.coalesce(F.sum(f"_of_{name}").over(before), F.lit(0)).alias(f"_base_{name}") for name in sums))
    inside = Window.partitionBy("_part", *by).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    own = ranged.select("*", *(F.sum(c).over(inside).alias(name) for name, c in sums.items()))
    rows = own.join(F.broadcast(base), ["_part", *by])
    return rows.select(*df.columns, *((F.col(name) + F.col(f"_base_{name}")).alias(name) for name in sums))
