"""Silver layer: deduplication, contracts, units, time zones, gaps."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from isoclime.functions.calendar import convert


def dedup_latest(df: DataFrame, keys: Sequence[str], newest_first: Sequence[str], tiebreak: Sequence[str] = ()) -> DataFrame:
    """The newest row of each key; ``tiebreak`` columns (descending) make the choice total. A null key is a key."""
    order = [F.col(c).desc_nulls_last() for c in [*newest_first, *tiebreak]]
    ranked = df.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.filter("_rank = 1").drop("_rank")


def to_utc(df: DataFrame, ts: str, tz: str, out: str = "ts_utc") -> DataFrame:
    """Local stamps to UTC by each row's zone."""
    return df.withColumn(out, F.to_utc_timestamp(ts, F.col(tz)))


def local_view(df: DataFrame, dim_cities: DataFrame, ts: str = "ts") -> DataFrame:
    """Adds local_ts and local_date by the city's zone; rows of unknown cities are dropped."""
    zones = dim_cities.select("city_id", "timezone")
    local = F.from_utc_timestamp(ts, F.col("timezone"))
    return df.join(zones, "city_id").withColumn("local_ts", local).withColumn("local_date", F.to_date("local_ts"))


def dst_audit(df: DataFrame, dim_cities: DataFrame, ts: str = "ts") -> DataFrame:
    """City, local day, hours in it (23 or 25) and the change of offset, for each day on which an hourly series' offset changes."""
    seen = local_view(df.select("city_id", F.col(ts).alias("ts")), dim_cities)
    offset = (F.unix_timestamp("local_ts") - F.unix_timestamp("ts")).cast("int")
    before = F.lag("offset").over(Window.partitionBy("city_id").orderBy("ts"))
    moved = seen.withColumn("offset", offset).withColumn("change", F.col("offset") - before).filter("change <> 0")
    return moved.select("city_id", "local_date", "change", (F.lit(24) - F.col("change") / 3600).cast("int").alias("hours"))


def assert_units(df: DataFrame, ranges: Mapping[str, tuple[float, float]], keys: Sequence[str] = ("city_id", "obs_date")) -> DataFrame:
    """(keys, variable, value, low, high) of values outside their plausible range; nulls pass."""
    long = df.select(*keys, *(F.col(v).cast("double").alias(v) for v in ranges)).unpivot(list(keys), list(ranges), "variable", "value")
    low = F.create_map(*(F.lit(x) for v, (lo, _) in ranges.items() for x in (v, float(lo))))[F.col("variable")]
    high = F.create_map(*(F.lit(x) for v, (_, hi) in ranges.items() for x in (v, float(hi))))[F.col("variable")]
    return long.withColumn("low", low).withColumn("high", high).filter("value < low OR value > high")


def unit_consistency(df: DataFrame, value: str, by: str, entity: str = "city_id") -> DataFrame:
    """Per entity and pair of deliveries (``by``): ratio of means and of standard deviations; far from 1 hints at a unit."""
    stats = df.groupBy(entity, by).agg(F.avg(value).alias("mean"), F.stddev_samp(value).alias("sd"), F.count(value).alias("n"))
    a = stats.select(entity, *(F.col(c).alias(f"{c}_a") for c in (by, "mean", "sd", "n")))
    b = stats.select(entity, *(F.col(c).alias(f"{c}_b") for c in (by, "mean", "sd", "n")))
    return a.join(b, entity).filter(F.col(f"{by}_a") < F.col(f"{by}_b")).select(
        entity, f"{by}_a", f"{by}_b", "n_a", "n_b",
        F.try_divide("mean_b", "mean_a").alias("mean_ratio"), F.try_divide("sd_b", "sd_a").alias("sd_ratio"),
    )


def convert_units(df: DataFrame, units: Mapping[str, str]) -> DataFrame:
    """Columns given in a foreign unit (column: unit name or column holding it) to metric."""
    return df.withColumns({c: convert(F.col(c), F.col(u) if u in df.columns else F.lit(u)) for c, u in units.items()})


def null_profile(df: DataFrame, variables: Sequence[str], entity: str = "city_id", day: str = "obs_date") -> DataFrame:
    """Rows, nulls and null rate per entity, variable and year, in one pass."""
    flags = df.select(entity, F.year(day).alias("year"), *(F.col(v).isNull().cast("int").alias(v) for v in variables))
    sums = flags.groupBy(entity, "year").agg(F.count("*").alias("n_rows"), *(F.sum(v).alias(v) for v in variables))
    out = sums.unpivot([entity, "year", "n_rows"], list(variables), "variable", "n_null")
    return out.withColumn("null_rate", F.col("n_null") / F.col("n_rows"))


def enforce_contract(df: DataFrame, contract: StructType, strict: bool = False) -> DataFrame:
    """The contract's columns in its order and types, plus n_bad: how many values would not cast or are null where they may not be.

    A missing column raises, as does a column too many if ``strict``. Bad values become null; filter on
    n_bad or hand the result to a check.
    """
    missing = [f.name for f in contract if f.name not in df.columns]
    extra = [c for c in df.columns if c not in contract.names]
    if missing or (strict and extra):
        raise ValueError(f"contract broken: missing {missing}" + (f", unexpected {extra}" if strict else ""))
    casts = {f.name: F.col(f.name).try_cast(f.dataType) for f in contract}
    bad: Column = F.lit(0)
    for f in contract:
        lost = F.col(f.name).isNotNull() & casts[f.name].isNull()
        bad = bad + (lost if f.nullable else casts[f.name].isNull()).cast("int")
    return df.select(*(c.alias(n) for n, c in casts.items()), bad.alias("n_bad"))


def densify(df: DataFrame, entity: str = "city_id", day: str = "obs_date", start: str | None = None, end: str | None = None) -> DataFrame:
    """Every entity on every day of the span, with nulls for gaps. The span defaults to the data's own."""
    lo = F.lit(start).cast("date") if start else F.min(day)
    hi = F.lit(end).cast("date") if end else F.max(day)
    span = df.agg(lo.alias("lo"), hi.alias("hi")).first() if not (start and end) else None
    first, last = (span["lo"], span["hi"]) if span else (start, end)
    days = F.sequence(F.lit(first).cast("date"), F.lit(last).cast("date"))
    grid = df.select(entity).distinct().withColumn(day, F.explode(days))
    return grid.join(df, [entity, day], "left")


def missing_dates(df: DataFrame, entity: str = "city_id", day: str = "obs_date", start: str | None = None, end: str | None = None) -> DataFrame:
    """Days of the span without a row, per entity."""
    present = df.select(entity, day).distinct()
    return densify(present, entity, day, start, end).join(present, [entity, day], "left_anti")


def islands(df: DataFrame, entity: str = "city_id", day: str = "obs_date") -> DataFrame:
    """Runs of consecutive days: entity, start, end, length."""
    nth = F.row_number().over(Window.partitionBy(entity).orderBy(day))
    runs = df.select(entity, day).distinct().withColumn("_run", F.unix_date(day) - nth).groupBy(entity, "_run")
    return runs.agg(F.min(day).alias("start"), F.max(day).alias("end"), F.count("*").alias("length")).drop("_run")
