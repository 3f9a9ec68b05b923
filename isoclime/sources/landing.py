"""Bronze layer: what to fetch, reading payloads, idempotent appends, reconciliation, serving copies."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def expected_days(year: Column, start: str, end: str) -> Column:
    """Days of a year inside the span, both ends included."""
    first = F.greatest(F.make_date(year, F.lit(1), F.lit(1)), F.lit(start).cast("date"))
    last = F.least(F.make_date(year, F.lit(12), F.lit(31)), F.lit(end).cast("date"))
    return F.greatest(F.date_diff(last, first) + 1, F.lit(0))


def _years(start: str, end: str) -> Column:
    return F.explode(F.sequence(F.lit(int(start[:4])), F.lit(int(end[:4]))))


def reconcile_counts(obs: DataFrame, cities: DataFrame, start: str, end: str, day: str = "obs_date") -> DataFrame:
    """city_id, year, expected, actual, ok: distinct days landed against the calendar; chunks on one side only show too."""
    plan = cities.select("city_id").distinct().withColumn("year", _years(start, end))
    plan = plan.withColumn("expected", expected_days(F.col("year"), start, end))
    inside = obs.filter(F.col(day).between(F.lit(start).cast("date"), F.lit(end).cast("date")))
    have = inside.groupBy("city_id", F.year(day).alias("year")).agg(F.count_distinct(day).alias("actual"))
    out = plan.join(have, ["city_id", "year"], "full_outer").na.fill(0, ["expected", "actual"])
    return out.withColumn("ok", F.col("expected") == F.col("actual"))


def backfill_plan(cities: DataFrame, landed: DataFrame, start: str, end: str, day: str = "obs_date") -> DataFrame:
    """(city_id, year, n_expected) chunks still missing or incomplete."""
    counts = reconcile_counts(landed, cities, start, end, day)
    complete = counts.filter("ok").select("city_id", "year")
    chunks = cities.select("city_id").distinct().withColumn("year", _years(start, end))
    chunks = chunks.withColumn("n_expected", expected_days(F.col("year"), start, end))
    return chunks.join(complete, ["city_id", "year"], "left_anti")


def payload_schema(kind: str, variables: Sequence[str]) -> str:
    arrays = ", ".join(f"{v}: array<double>" for v in variables)
    return f"city_id int, {kind} struct<time: array<string>, {arrays}>, _corrupt string"


def read_payloads(spark: SparkSession, path: str, kind: str, variables: Sequence[str]) -> DataFrame:
    """Gzipped JSON payloads of parallel arrays, one row per time stamp, with the file they came from.

    Arrays of unequal length are padded with nulls; payloads that don't parse are left to
    ``parse_payload_errors``. One file is one task (gzip cannot be split): land many small files.
    """
    raw = spark.read.schema(payload_schema(kind, variables)).option("columnNameOfCorruptRecord", "_corrupt").json(path)
    rows = raw.filter(f"_corrupt IS NULL AND {kind} IS NOT NULL").select("city_id", kind, F.col("_metadata.file_path").alias("source_url"))
    zipped = F.arrays_zip(*(F.col(f"{kind}.{c}") for c in ("time", *variables)))
    out = rows.select("city_id", "source_url", F.inline(zipped).alias("time", *variables))
    return out.withColumn("time", F.try_to_timestamp("time"))


def parse_payload_errors(spark: SparkSession, path: str, kind: str, variables: Sequence[str]) -> DataFrame:
    """(source_url, payload) of payloads (one a line) that don't parse."""
    lines = spark.read.text(path).select(F.col("_metadata.file_path").alias("source_url"), F.col("value").alias("payload"))
    parsed = F.from_json("payload", payload_schema(kind, variables), {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"})
    return lines.filter(parsed["_corrupt"].isNotNull())


def with_lineage(df: DataFrame, ingested_at: str, source_url: str | None = None, day: str = "obs_date") -> DataFrame:
    """Adds ingested_at, source_url (unless the rows have one) and the partition column year."""
    out = df.withColumn("ingested_at", F.lit(ingested_at).cast("timestamp")).withColumn("year", F.year(day))
    return out if source_url is None else out.withColumn("source_url", F.lit(source_url))


def land(df: DataFrame, path: str, ingested_at: str, source_url: str | None = None, day: str = "obs_date") -> None:
    """Append with lineage, partitioned by year."""
    with_lineage(df, ingested_at, source_url, day).write.partitionBy("year").mode("append").parquet(path)


def new_rows(incoming: DataFrame, existing: DataFrame, keys: Sequence[str], values: Sequence[str]) -> DataFrame:
    """Rows whose key and values aren't there yet: a repeated delivery adds nothing, a revised value is a new version.

    The hash narrows the join; equal hashes count only if the values are equal too, null being equal to null.
    """
    stamp = F.xxhash64(*keys, *values)
    fresh = incoming.dropDuplicates([*keys, *values]).withColumn("_h", stamp)
    old = existing.select(*keys, *values).distinct().withColumn("_h", stamp).alias("old")
    fresh = fresh.alias("new")
    same = F.col("new._h") == F.col("old._h")
    for c in (*keys, *values):
        same = same & F.col(f"new.{c}").eqNullSafe(F.col(f"old.{c}"))
    return fresh.join(old, same, "left_anti").drop("_h")


def overwrite_chunks(df: DataFrame, path: str, by: Sequence[str] = ("city_id", "year")) -> None:
    """Replace exactly the chunks that ``df`` holds, whole; others stay."""
    writer = df.repartition(*by).write.option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(*by).mode("overwrite").parquet(path)


def pivot_long(df: DataFrame, elements: Sequence[str], entity: str = "city_id", day: str = "obs_date") -> DataFrame:
    """(entity, day, element, value) rows to one wide row per entity and day; of repeated elements the largest value counts."""
    return df.groupBy(entity, day).pivot("element", list(elements)).agg(F.max("value"))


EVERY = {"duplicate": 11, "null": 13, "fahrenheit": 17, "miles": 7, "local_time": 19}
UNITS = {"temp_mean": ("fahrenheit", 9, 5, 32)}


def corrupt(
    df: DataFrame, value: str = "temp_mean", entity: str = "city_id", day: str = "obs_date", seed: int = 0, every: dict[str, int] | None = None,
    units: dict[str, tuple[str, float, float, float]] = UNITS, stamp: str | None = None, zone: str | None = None,
) -> DataFrame:
    """Labelled synthetic mess, the same on every run: synthetic_fault says what was done to a row.

    By key arithmetic: a row's turn is 31 * entity plus its day (its hour, if ``stamp`` is given) plus ``seed``, and a
    fault befalls every so manieth turn (``every`` overrides ``EVERY``): null loses the value; a unit of ``units``
    (column: name, numerator, denominator, offset) shifts its column; local_time turns the UTC ``stamp`` into the
    local time of the ``zone`` column; duplicate lets the row arrive again. The first that applies counts.
    """
    rate = EVERY | (every or {})
    turn = F.col(entity) * 31 + (F.unix_date(day) if stamp is None else F.floor(F.unix_seconds(stamp) / 3600)) + seed
    due = lambda name: turn % rate[name] == 0
    names = ["null", *(u[0] for u in units.values()), *(["local_time"] if stamp is not None and zone is not None else [])]
    fault = F.coalesce(*(F.when(due(n), n) for n in names), F.lit("none"))
    once = df.withColumn("synthetic_fault", fault)
    is_ = lambda name: F.col("synthetic_fault") == name
    for column, (name, up, down, offset) in units.items():
        once = once.withColumn(column, F.when(is_(name), F.col(column) * up / down + offset).otherwise(F.col(column)))
    once = once.withColumn(value, F.when(~is_("null"), F.col(value)))
    if "local_time" in names:
        once = once.withColumn(stamp, F.when(is_("local_time"), F.from_utc_timestamp(stamp, F.col(zone))).otherwise(F.col(stamp)))
    again = df.filter(due("duplicate")).withColumn("synthetic_fault", F.lit("duplicate"))
    return once.unionByName(again)


def export_csv(df: DataFrame, path: str) -> None:
    """A mart as CSV files with a header; written in parallel, one file a partition."""
    df.write.mode("overwrite").option("header", True).csv(path)


def promote(df: DataFrame, target: str, name: str, **options: str) -> None:
    """Write a finished mart to the serving store: a JDBC URL gets a table, any other target a Parquet folder."""
    if target.startswith("jdbc:"):
        df.write.mode("overwrite").format("jdbc").options(url=target, dbtable=name, **options).save()
    else:
        df.write.mode("overwrite").parquet(f"{target.rstrip('/')}/{name}")


def stage_counts(df: DataFrame, name: str) -> tuple[DataFrame, Callable[[], int]]:
    """The frame, and a function that after an action tells its row count and raises if that was 0. No second pass."""
    seen = Observation(name)

    def check() -> int:
        n = seen.get["n"]
        if not n:
            raise RuntimeError(f"stage {name} made no rows")
        return n

    return df.observe(seen, F.count(F.lit(1)).alias("n")), check
