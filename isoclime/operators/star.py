"""Gold layer: dimensions, facts, and slowly changing places."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from isoclime.functions.calendar import date_key, day_slot, is_leap, season
from isoclime.session import scratch

CITY_COLUMNS = {
    "city_id": "int", "name": "string", "country": "string", "region": "string", "latitude": "double", "longitude": "double",
    "elevation": "double", "timezone": "string", "population": "long", "climate_regime": "string",
}


def dim_date(spark: SparkSession, start: str, end: str) -> DataFrame:
    """One row per day with its calendar attributes; weeks and weekdays are ISO (Monday is 1)."""
    days = spark.range(1).select(F.explode(F.sequence(F.lit(start).cast("date"), F.lit(end).cast("date"))).alias("date"))
    d = F.col("date")
    return days.select(
        "date", date_key(d).alias("date_key"), F.year(d).alias("year"), F.quarter(d).alias("quarter"), F.month(d).alias("month"),
        F.dayofmonth(d).alias("day"), F.weekofyear(d).alias("iso_week"), (F.weekday(d) + 1).alias("day_of_week"),
        day_slot(d).alias("slot"), is_leap(F.year(d)).alias("is_leap"),
    )


def dim_cities(seed: DataFrame) -> DataFrame:
    """The seed with the dimension's columns and types; one row per city_id is the seed's duty (check it)."""
    return seed.select(*(F.col(c).cast(t).alias(c) for c, t in CITY_COLUMNS.items()))


def city_seasons(cities: DataFrame, dates: DataFrame) -> DataFrame:
    """(city_id, date, season): a property of the place and the day, as hemispheres and regimes differ."""
    days = dates.select("date")
    grid = cities.select("city_id", "latitude", "climate_regime").crossJoin(days)
    return grid.select("city_id", "date", season(F.col("date"), F.col("latitude"), F.col("climate_regime")).alias("season"))


def fact_daily(silver: DataFrame, cities: DataFrame, measures: Sequence[str], day: str = "obs_date") -> DataFrame:
    """City-day measures with foreign keys, for the cities of the dimension."""
    known = cities.select("city_id")
    return silver.join(known, "city_id").select("city_id", date_key(F.col(day)).alias("date_key"), F.col(day).alias("date"), *measures)


def fact_hourly(silver: DataFrame, months: int = 24, as_of: str | None = None, ts: str = "ts") -> DataFrame:
    """The trailing ``months`` of an hourly series, counted from ``as_of`` or its newest stamp."""
    if as_of is not None:
        return silver.filter(F.col(ts) > F.lit(as_of).cast("timestamp") - F.make_ym_interval(F.lit(0), F.lit(months)))
    newest = silver.agg(F.max(ts).alias("_newest"))
    near = F.col(ts) > F.col("_newest") - F.make_ym_interval(F.lit(0), F.lit(months))
    return silver.join(F.broadcast(newest), near).drop("_newest")  # one row


def star_join(fact: DataFrame, cities: DataFrame, dates: DataFrame, how: str = "inner") -> DataFrame:
    """Fact rows with the attributes of both dimensions; ``left`` keeps orphans. Spark broadcasts what is small enough.

    A fact stored by ``year`` is joined on it as well: a filter on the dates then prunes the fact's folders at run time.
    """
    keys = ["date_key", "year"] if "year" in fact.columns else ["date_key"]
    dates = dates.drop("date") if "date" in fact.columns else dates
    return fact.join(cities, "city_id", how).join(dates, keys, how)


GOLD_BUCKETS = 64


def write_gold(df: DataFrame, name: str, path: str, buckets: int = GOLD_BUCKETS, day: str = "date") -> DataFrame:
    """Store a fact at ``path`` as table ``name``: folders by year, files by place, rows of a place in the order of days.

    Windows over places and joins on them read a place's rows from one bucket, whatever the years, and move none; filters on
    the year open their folders only. ``buckets`` stays the same for the table's life. Rows are dealt by year and bucket
    before writing, so each folder gets one file a bucket.
    """
    rows = df.withColumn("year", F.year(day)).repartition("year", F.pmod(F.hash("city_id"), F.lit(buckets)))
    writer = rows.write.partitionBy("year").bucketBy(buckets, "city_id").sortBy("city_id", day).option("path", path)
    writer.mode("overwrite").saveAsTable(name)
    return df.sparkSession.table(name)


def scd2_snapshot(current: DataFrame, incoming: DataFrame, keys: Sequence[str], tracked: Sequence[str], as_of: str) -> DataFrame:
    """The history with ``incoming`` as the state from ``as_of`` on.

    ``current`` has keys, tracked, valid_from, valid_to (null: open). Changed and vanished keys are closed,
    changed and new ones opened, unchanged ones left alone. Nulls compare as equal.
    """
    day = F.lit(as_of).cast("date")
    closed, open_ = current.filter("valid_to IS NOT NULL"), current.filter("valid_to IS NULL")
    old = open_.select(*keys, F.struct(*tracked).alias("_old"), "valid_from")
    new = incoming.select(*keys, F.struct(*tracked).alias("_new"), F.lit(True).alias("_given"))
    both = old.join(new, list(keys), "full_outer")
    stays = both.filter("_old <=> _new AND valid_from IS NOT NULL AND _given")
    goes = both.filter("valid_from IS NOT NULL AND (_given IS NULL OR NOT (_old <=> _new))")
    comes = both.filter("_given AND (valid_from IS NULL OR NOT (_old <=> _new))")
    none = F.lit(None).cast("date")
    columns = lambda df, struct, start, end: df.select(*keys, *(F.col(f"{struct}.{c}").alias(c) for c in tracked), start.alias("valid_from"), end.alias("valid_to"))
    out = closed.select(*keys, *tracked, "valid_from", "valid_to")
    out = out.unionByName(columns(stays, "_old", F.col("valid_from"), none))
    out = out.unionByName(columns(goes, "_old", F.col("valid_from"), day))
    return out.unionByName(columns(comes, "_new", day, none))


def as_of_dim(fact: DataFrame, history: DataFrame, keys: Sequence[str], day: str = "date") -> DataFrame:
    """Fact rows with the version of the dimension valid on their day; rows without one are kept with nulls.

    Versions of a key don't overlap. Versions and facts are sorted together by key and day, and each fact takes the last
    version before it, so no pair of a fact and a version that isn't its own is ever made. Ranges of the sort are
    written to the shared folder, and a key with more rows than a range goes over several of them: a range starts from
    the last version its key had in the ranges before. Facts with a null key or day have no version.
    """
    values = [c for c in history.columns if c not in keys]
    version = F.struct(*values)
    marks = history.select(*keys, F.col("valid_from").alias("_at"), F.lit(0).alias("_kind"), version.alias("_version"), F.lit(None).cast(fact.select(F.struct(*fact.columns)).schema[0].dataType).alias("_fact"))
    rows = fact.select(*keys, F.col(day).alias("_at"), F.lit(1).alias("_kind"), F.lit(None).cast(marks.schema["_version"].dataType).alias("_version"), F.struct(*fact.columns).alias("_fact"))
    spark, path = fact.sparkSession, scratch(fact.sparkSession, "as_of")
    order = [F.col(c) for c in ("_at", "_kind")]
    salt = F.when(F.col("_kind") == 1, F.xxhash64("_fact"))  # equal days of one key are parted too
    both = marks.unionByName(rows).repartitionByRange(int(spark.conf.get("spark.sql.shuffle.partitions")), *keys, *order, salt)
    both.withColumn("_part", F.spark_partition_id()).write.parquet(path)
    ranged = spark.read.parquet(path)
    lasts = ranged.filter("_kind = 0").groupBy("_part", *keys).agg(F.max_by("_version", "_at").alias("_last"))
    spread = ranged.select("_part", *keys).distinct().join(lasts, ["_part", *keys], "left")
    before = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    carried = spread.withColumn("_carried", F.last("_last", ignorenulls=True).over(before)).drop("_last")
    inside = Window.partitionBy("_part", *keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    own = ranged.withColumn("_own", F.last("_version", ignorenulls=True).over(inside)).filter("_kind = 1")
    found = own.join(carried.filter("_carried IS NOT NULL"), ["_part", *keys], "left").withColumn("_v", F.coalesce("_own", "_carried"))
    valid = F.col("_v.valid_to").isNull() | (F.col("_at") < F.col("_v.valid_to"))
    known = F.col("_at").isNotNull()
    for k in keys:
        known = known & F.col(k).isNotNull()
    return found.select("_fact.*", *(F.when(valid & known, F.col(f"_v.{c}")).alias(c) for c in values))


def open_history(df: DataFrame, keys: Sequence[str], tracked: Sequence[str], since: str) -> DataFrame:
    """A first history: every row open since a day."""
    return df.select(*keys, *tracked, F.lit(since).cast("date").alias("valid_from"), F.lit(None).cast("date").alias("valid_to"))


def newest_per(df: DataFrame, key: str, order: str) -> DataFrame:
    """The row with the greatest ``order`` of each key."""
    rank = F.row_number().over(Window.partitionBy(key).orderBy(F.desc(order)))
    return df.withColumn("_r", rank).filter("_r = 1").drop("_r")
