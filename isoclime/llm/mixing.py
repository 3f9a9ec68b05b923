"""Mixing sources to target weights as a time-varying curriculum.

Targets come from water filling over the sources' totals. Inside a source, documents stand in a fixed
pseudo-random order (MD5 of the key); cumulative sizes in that order are the source's token demand. Each
source has a weight schedule over training time 0..1 (straight lines between knots); its integral says what
share of the source's target has been consumed by a time, and inverting it turns cumulative demand into a
training position. Documents are then range-sorted by position.

At scale: only (key, source, size, order) is shuffled. A source may hold any share of the rows: running
sums are taken in buckets of the pseudo-random order and joined by a prefix sum over bucket totals, so no
source is ever one task. The table of sources is aggregated first and solved with window sums over its rows, one a
distinct source.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import materialize, partitions, table, word_count

WEIGHTS = (5, 2, 1)
SCHEDULES = (((0.0, 1.25), (1.0, 0.75)), ((0.0, 1.0), (1.0, 1.0)), ((0.0, 0.75), (1.0, 1.25)))
TOTAL, CAP = 1.5, 2
BUCKET_HEX = 3


def training_time(share: Column, knots: tuple[tuple[float, float], ...]) -> Column:
    """The time by which ``share`` (0..1) of the area under the schedule through ``knots`` is used up."""
    area = sum((t1 - t0) * (w0 + w1) / 2 for (t0, w0), (t1, w1) in zip(knots, knots[1:], strict=False))
    out, done = F.lit(float(knots[-1][0])), 1.0
    for (t0, w0), (t1, w1) in reversed(list(zip(knots, knots[1:], strict=False))):
        done -= (t1 - t0) * (w0 + w1) / 2 / area
        left = F.greatest(share - F.lit(max(done, 0.0)), F.lit(0.0))
        a, slope = w0 / area, (w1 - w0) / (t1 - t0) / area
        root = F.sqrt(F.greatest(F.lit(a * a) + F.lit(2 * slope) * left, F.lit(0.0)))
        here = F.lit(float(t0)) + F.coalesce(F.try_divide(2 * left, F.lit(a) + root), F.lit(0.0))
        out = here if t1 == knots[-1][0] else F.when(share >= F.lit(upper), out).otherwise(here)
        upper = done
    return out


def source_targets(light: DataFrame, weights: tuple = WEIGHTS, total: float = TOTAL, cap: int = CAP) -> DataFrame:
    """(source, source_size, target, class): water filling, each target capped at ``cap`` times the size."""
    every = Window.orderBy(F.col("source").asc_nulls_last())
    sources = light.groupBy("source").agg(F.sum("size").alias("source_size"))
    sources = sources.withColumn("class", ((F.row_number().over(every) - 1) % len(weights)).cast("int"))
    sources = sources.withColumn("w", F.element_at(F.lit(list(weights)), F.col("class") + 1).cast("double"))
    by_ratio = Window.orderBy(F.col("source_size") / F.col("w"), F.col("source").asc_nulls_last())
    upto, onward = by_ratio.rowsBetween(Window.unboundedPreceding, -1), by_ratio.rowsBetween(0, Window.unboundedFollowing)
    whole = by_ratio.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    room = F.sum("source_size").over(whole) * F.lit(float(total)) - F.coalesce(F.sum(F.col("source_size") * cap).over(upto), F.lit(0))
    sources = sources.withColumn("level", room / F.sum("w").over(onward))
    sources = sources.withColumn("open", F.col("level") * F.col("w") <= F.col("source_size") * cap)
    level = F.max(F.when(F.col("open"), F.col("level"))).over(whole)
    target = F.when(F.col("open"), level * F.col("w")).otherwise((F.col("source_size") * cap).cast("double"))
    return sources.select("source", "source_size", target.alias("target"), "class")


def curriculum(
    docs: DataFrame,
    text: str = "text",
    key: str = "doc_id",
    source: str = "source",
    weights: tuple = WEIGHTS,
    schedules: tuple = SCHEDULES,
    total: float = TOTAL,
    cap: int = CAP,
) -> DataFrame:
    """One row per input row, sorted by position: ``key``, size, source_size, target, taken, copies, position, position_2.

    Size is the text's number of words (null: 0). ``taken`` is what the mix takes of a document, at most
    ``cap`` times its size: whole passes first, then one more pass over the first documents of the order,
    the last of them in part, so a source's taken words sum to its target rounded. ``copies`` counts the
    passes a document is in; ``position`` and ``position_2`` are where the first two start (null where
    there is none). Rows are sorted by the unrounded position, ties by the MD5 order. Null is a source like any other, last in order. Rows that repeat key, source and size
    are interchangeable. Empty input gives an empty result; sources without words get nothing.
    """
    light = materialize(
        docs.select(
            F.col(key).alias("_key"),
            F.col(source).alias("source"),
            word_count(F.col(text)).alias("size"),
            F.md5(F.coalesce(F.col(key).cast("string"), F.lit(""))).alias("_order"),
        ),
        "sizes",
    )
    targets = source_targets(light, weights, total, cap)
    words = F.round("target").cast("long")
    rest = F.coalesce(words % F.nullif(F.col("source_size"), F.lit(0)), F.lit(0))
    passes = F.coalesce(F.try_divide(words - rest, F.col("source_size")), F.lit(0)).cast("long")
    targets = targets.withColumn("_extra", rest).withColumn("_passes", passes)
    light = light.withColumn("_bucket", F.substring("_order", 1, BUCKET_HEX))
    sums = light.groupBy("source", "_bucket").agg(F.sum("size").alias("_words"))
    before = Window.partitionBy("source").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select("source", "_bucket", F.coalesce(F.sum("_words").over(before), F.lit(0)).alias("_start"))
    starts = starts.withColumnsRenamed({"source": "_s", "_bucket": "_b"})
    starts = starts.join(targets, F.col("_s").eqNullSafe(F.col("source"))).drop("source")
    inside = Window.partitionBy("source", "_bucket").orderBy("_order", "size").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    own = light.select("*", (F.sum("size").over(inside) - F.col("size")).alias("_before"))
    rows = own.join(starts, F.col("source").eqNullSafe(F.col("_s")) & (F.col("_bucket") == F.col("_b")))
    begin = F.col("_start") + F.col("_before")
    extra = F.greatest(F.lit(0), F.least(F.col("size"), F.col("_extra") - begin))
    rows = rows.withColumn("_begin", begin).withColumn("taken", F.col("_passes") * F.col("size") + extra)
    rows = rows.withColumn("copies", F.when(F.col("size") > 0, F.col("_passes") + (extra > 0).cast("long")).otherwise(0).cast("int"))

    def at(copy: int) -> Column:
        share = F.try_divide((F.col("_begin") + copy * F.col("source_size")).cast("double"), F.col("target"))
        times = [training_time(share, schedules[i % len(schedules)]) for i in range(len(weights))]
        time = times[-1]
        for i in reversed(range(len(times) - 1)):
            time = F.when(F.col("class") == i, times[i]).otherwise(time)
        return F.when(F.col("copies") > copy, F.least(time, F.lit(1.0)))

    out = rows.select("_key", "_order", "size", "source_size", "target", "taken", "copies", at(0).alias("position"), at(1).alias("position_2"))
    order = [F.col("position").asc_nulls_last(), F.col("_order"), F.col("_key")]
    out = out.repartitionByRange(partitions(docs.sparkSession), *order).sortWithinPartitions(*order)
    return out.drop("_order").withColumnRenamed("_key", key)


def op8_curriculum_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = curriculum(table(spark, sf_dir, "documents"))
    return mixed.withColumns({name: F.round(name, 6) for name in ("position", "position_2")})  # as digits two engines agree on


ORACLE = """
WITH d AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS size,
         md5(coalesce(CAST(doc_id AS VARCHAR), '')) AS o
  FROM documents
), s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS n
  FROM d GROUP BY source
), c AS (
  SELECT *, n % 3 AS class, CASE n % 3 WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS w FROM s
), l AS (
  SELECT *, (CAST(sum(source_size) OVER () AS BIGINT) * 1.5::DOUBLE
             - CAST(coalesce(sum(source_size * 2) OVER (ORDER BY source_size / w, source NULLS LAST
                 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT))
            / sum(w) OVER (ORDER BY source_size / w, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM c
), t AS (
  SELECT source, source_size, class,
         CASE WHEN level * w <= source_size * 2
              THEN max(CASE WHEN level * w <= source_size * 2 THEN level END) OVER () * w
              ELSE CAST(source_size * 2 AS DOUBLE) END AS target
  FROM l
), r AS (
  SELECT d.*, t.source_size, t.class, t.target, CAST(round(t.target) AS BIGINT) AS words,
         CAST(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.o, d.size ROWS UNBOUNDED PRECEDING) AS BIGINT) - d.size AS b
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
), k AS (
  SELECT *, CASE WHEN source_size > 0 THEN words // source_size ELSE 0 END AS passes,
         CASE WHEN source_size > 0 THEN words % source_size ELSE 0 END AS extra
  FROM r
), m AS (
  SELECT *, passes * size + greatest(0, least(size, extra - b)) AS taken,
         CASE WHEN size > 0 THEN passes + CAST(greatest(0, least(size, extra - b)) > 0 AS BIGINT) ELSE 0 END AS n_copies
  FROM k
)
SELECT doc_id, size, source_size, target, taken, CAST(n_copies AS INTEGER) AS copies,
  CASE WHEN n_copies > 0 THEN round(least(CASE class
    WHEN 0 THEN 2 * (b / target) / (1.25 + sqrt(1.25 * 1.25 - b / target))
    WHEN 1 THEN 2 * (b / target) / (1.0 + sqrt(1.0))
    ELSE 2 * (b / target) / (0.75 + sqrt(0.75 * 0.75 + b / target)) END, 1.0), 6) END AS position,
  CASE WHEN n_copies > 1 THEN round(least(CASE class
    WHEN 0 THEN 2 * ((b + source_size) / target) / (1.25 + sqrt(1.25 * 1.25 - (b + source_size) / target))
    WHEN 1 THEN 2 * ((b + source_size) / target) / (1.0 + sqrt(1.0))
    ELSE 2 * ((b + source_size) / target) / (0.75 + sqrt(0.75 * 0.75 + (b + source_size) / target)) END, 1.0), 6) END AS position_2
FROM m
"""
