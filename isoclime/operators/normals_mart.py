"""The normals as a stored mart that batches of days are merged into, without reading old observations again.

The mart holds mergeable partial sums: for each place, slot and year the count, the sum and the sum of squares about a
fixed centre. Sums about the same centre add up whatever the batches were, so a merge touches only the years its days
fall in, and every kind of normal is made from the sums alone.

Layout: ``<path>/centres/since=<batch>`` has (city_id, centre), written once for a place and never changed, whose value
only has to lie near the place's level; ``<path>/sums/year=<year>/upto=<batch>`` has a year's sums after a batch. A
merge writes new ``upto`` folders from the year's newest earlier one and leaves that in place; readers take the newest of each
year. So a merge that fails half-way, or is run again, starts from the same sums and ends in the same folders: batches
count once. Batches are numbered upwards; ``tidy`` deletes what newer folders have replaced.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from isoclime.operators.climatology import keyed

SUMS = "city_id int, slot int, n long, s double, q double, year int, upto long"


def _folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders below a path; none if it isn't there."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = at.getFileSystem(spark._jsc.hadoopConfiguration())
    return sorted(f.getPath().getName() for f in fs.listStatus(at) if f.isDirectory()) if fs.exists(at) else []


def _numbers(spark: SparkSession, path: str, name: str) -> list[int]:
    return sorted(int(f.split("=")[1]) for f in _folders(spark, path) if f.startswith(f"{name}="))


def newest(spark: SparkSession, path: str, before: int | None = None) -> dict[int, int]:
    """The newest batch in each stored year, of those below ``before``: one entry a year of the calendar."""
    out = {}
    for year in _numbers(spark, f"{path}/sums", "year"):
        upto = [b for b in _numbers(spark, f"{path}/sums/year={year}", "upto") if before is None or b < before]
        if upto:
            out[year] = upto[-1]
    return out


def _sums(spark: SparkSession, path: str, at: dict[int, int]) -> DataFrame:
    """The sums of the given folders; no other folder is listed or read."""
    if not at:
        return spark.createDataFrame([], SUMS)
    folders = [f"{path}/sums/year={year}/upto={batch}" for year, batch in at.items()]
    return spark.read.schema(SUMS).option("basePath", f"{path}/sums").parquet(*folders)


def _centres(spark: SparkSession, path: str, before: int | None = None) -> DataFrame:
    since = [b for b in _numbers(spark, f"{path}/centres", "since") if before is None or b < before]
    if not since:
        return spark.createDataFrame([], "city_id int, centre double")
    return spark.read.schema("city_id int, centre double").parquet(*(f"{path}/centres/since={b}" for b in since))


def merge_days(spark: SparkSession, path: str, batch: int, days: DataFrame, withdrawn: DataFrame | None = None, value: str = "temp_mean") -> None:
    """Merge a batch of new days (city_id, obs_date, ``value``) into the mart.

    ``withdrawn`` holds days as they were merged earlier and no longer count (the old value of a revised day). Days are
    told apart by nothing: a day given in two batches counts twice. Merging a number again replaces its own work as
    long as no later one has been merged.
    """
    if any(b > batch for b in newest(spark, path).values()):
        raise ValueError(f"a batch after {batch} has been merged")
    rows = keyed(days, value).withColumn("sign", F.lit(1))
    if withdrawn is not None:
        rows = rows.unionByName(keyed(withdrawn, value).withColumn("sign", F.lit(-1)))
    known = _centres(spark, path, batch)
    fresh = keyed(days, value).join(known, "city_id", "left_anti").groupBy("city_id").agg(F.avg("value").alias("centre"))
    fresh.write.mode("overwrite").parquet(f"{path}/centres/since={batch}")
    x = F.col("value") - F.col("centre")
    sign = F.col("sign")
    own = rows.join(_centres(spark, path), "city_id").groupBy("city_id", "slot", "year")
    own = own.agg(F.sum(sign).alias("n"), F.sum(sign * x).alias("s"), F.sum(sign * x * x).alias("q"))
    touched = [r[0] for r in rows.select("year").distinct().collect()]  # years of a calendar
    before = {y: b for y, b in newest(spark, path, batch).items() if y in touched}
    old = _sums(spark, path, before).drop("upto")
    merged = old.unionByName(own).groupBy("city_id", "slot", "year").agg(*(F.sum(c).alias(c) for c in ("n", "s", "q")))
    out = merged.filter("n <> 0").withColumn("upto", F.lit(batch).cast("long")).repartition("year")
    out.write.partitionBy("year", "upto").mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(f"{path}/sums")


def stored_partials(spark: SparkSession, path: str) -> DataFrame:
    """The mart as ``climatology.partials`` makes it: n, s, q of city, slot and year, the city's centre and its years.

    For ``pooled_of`` (half 0: plain normals), ``loyo_of`` and ``trailing_of``.
    """
    sums = _sums(spark, path, newest(spark, path)).drop("upto")
    return sums.join(_centres(spark, path), "city_id").withColumn("years", F.collect_set("year").over(Window.partitionBy("city_id")))


def tidy(spark: SparkSession, path: str) -> int:
    """Delete folders that newer batches have replaced; returns how many. No reader of an older state may be left."""
    gone = 0
    for year, last in newest(spark, path).items():
        for batch in _numbers(spark, f"{path}/sums/year={year}", "upto"):
            if batch < last:
                at = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/sums/year={year}/upto={batch}")
                gone += at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
    return gone
