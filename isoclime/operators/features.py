"""Gap-aware features and labels: every window counts days (or seconds), never rows.

All daily windows share one partitioning and order, so Spark sorts a series once for all of them. A
place's series is bounded by the calendar, so no window partition grows with the number of places.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from isoclime.functions.calendar import cyclic, day_slot

LAGS, ROLLS, LEAD_DAYS = (1, 3, 7, 14), (7, 30), 7


def days(first: int, last: int, entity: str = "city_id", day: str = "obs_date") -> WindowSpec:
    """The days t+first..t+last of the same place."""
    return Window.partitionBy(entity).orderBy(F.unix_date(day)).rangeBetween(first, last)


def seconds(first: int, last: int, entity: str = "city_id", ts: str = "ts") -> WindowSpec:
    return Window.partitionBy(entity).orderBy(F.unix_timestamp(ts)).rangeBetween(first, last)


def lag_days(column: str, k: int) -> Column:
    """The value exactly k days before; null if that day is missing."""
    return F.max(column).over(days(-k, -k))


def lags(df: DataFrame, columns: Sequence[str] = ("temp_mean", "surface_pressure"), ks: Sequence[int] = LAGS) -> DataFrame:
    return df.withColumns({f"{c}_lag{k}": lag_days(c, k) for c in columns for k in ks})


def rolling(df: DataFrame, columns: Sequence[str] = ("temp_mean",), widths: Sequence[int] = ROLLS) -> DataFrame:
    """Mean, sample variance and count of the last ``w`` days, day t included."""
    out = {}
    for c in columns:
        for w in widths:
            span = days(-w + 1, 0)
            out |= {f"{c}_mean{w}": F.avg(c).over(span), f"{c}_var{w}": F.var_samp(c).over(span), f"{c}_n{w}": F.count(c).over(span)}
    return df.withColumns(out)


def trailing_z(df: DataFrame, within: int = 7) -> DataFrame:
    """z of day t, and the last z that isn't null within the past ``within`` days, t included."""
    return df.withColumn("z_now", F.col("z")).withColumn("z_last", F.last("z", ignorenulls=True).over(days(-within + 1, 0)))


def pressure_tendency_daily(df: DataFrame, column: str = "surface_pressure") -> DataFrame:
    return df.withColumns({f"{column}_change{h}h": F.col(column) - lag_days(column, h // 24) for h in (24, 72)})


def pressure_tendency_hourly(df: DataFrame, column: str = "pressure") -> DataFrame:
    before = lambda h: F.max(column).over(seconds(-3600 * h, -3600 * h))
    return df.withColumns({f"{column}_change{h}h": F.col(column) - before(h) for h in (24, 72)})


def cyclic_doy(df: DataFrame, day: str = "obs_date") -> DataFrame:
    sin, cos = cyclic(day_slot(F.col(day)))
    return df.withColumns({"doy_sin": sin, "doy_cos": cos})


def static_features(df: DataFrame, cities: DataFrame) -> DataFrame:
    return df.join(cities.select("city_id", "latitude", "elevation"), "city_id", "left")


def anomaly_count(df: DataFrame, width: int = 30) -> DataFrame:
    """Anomaly days among the last ``width`` days, t included."""
    return df.withColumn(f"anomaly_count{width}", F.sum(F.coalesce(F.col("is_anomaly").cast("int"), F.lit(0))).over(days(-width + 1, 0)))


def forward_label(df: DataFrame, lead: int = LEAD_DAYS, min_observed: int = 1) -> DataFrame:
    """label: 1 if any of t+1..t+lead is an anomaly, else 0.

    Null where t+lead lies beyond the place's last day, or fewer than ``min_observed`` of the days have a
    flag; then 0 could be wrong.
    """
    ahead = days(1, lead)
    newest = F.max("obs_date").over(Window.partitionBy("city_id"))
    hit = F.max(F.col("is_anomaly").cast("int")).over(ahead)
    known = (F.date_add("obs_date", lead) <= newest) & (F.count("is_anomaly").over(ahead) >= min_observed)
    return df.withColumn("label", F.when(known, hit))


def feature_table(daily: DataFrame, flags: DataFrame | None, cities: DataFrame, lead: int = LEAD_DAYS) -> DataFrame:
    """Features and label per city and day, from gold tables only; write it partitioned by year.

    Without ``flags``, ``daily`` holds z and is_anomaly itself; stored by place (``star.write_gold``), it isn't shuffled.
    """
    df = daily.select("city_id", "obs_date", "temp_mean", "surface_pressure", *([] if flags is not None else ["z", "is_anomaly"]))
    if flags is not None:
        df = df.join(flags.select("city_id", "obs_date", "z", "is_anomaly"), ["city_id", "obs_date"], "left")
    df = pressure_tendency_daily(trailing_z(rolling(lags(df))))
    df = forward_label(anomaly_count(df), lead)
    return static_features(cyclic_doy(df), cities).withColumn("year", F.year("obs_date"))


FEATURES = [
    *(f"{c}_lag{k}" for c in ("temp_mean", "surface_pressure") for k in LAGS),
    *(f"temp_mean_{s}{w}" for w in ROLLS for s in ("mean", "var")),
    "z_now", "z_last", "surface_pressure_change24h", "surface_pressure_change72h", "doy_sin", "doy_cos", "latitude", "elevation", "anomaly_count30",
]


def chronological_split(df: DataFrame, train_end: str, val_end: str, purge: int = LEAD_DAYS, day: str = "obs_date") -> DataFrame:
    """split: train, validate or test by date; rows whose label window crosses a boundary are dropped."""
    d, t, v = F.col(day), F.lit(train_end).cast("date"), F.lit(val_end).cast("date")
    split = F.when(d <= t, "train").when(d <= v, "validate").otherwise("test")
    crosses = ((d <= t) & (F.date_add(d, purge) > t)) | ((d > t) & (d <= v) & (F.date_add(d, purge) > v))
    return df.withColumn("split", split).filter(~crosses)


def class_balance(df: DataFrame, label: str = "label") -> DataFrame:
    """Rows, positives, rate and negative-to-positive weight per split, of rows with a label."""
    n, pos = F.count(label), F.sum(label).cast("long")
    return df.groupBy("split").agg(n.alias("n"), pos.alias("positives"), F.try_divide(pos, n).alias("rate"), F.try_divide(n - pos, pos).alias("pos_weight"))


def write_feature_table(features: DataFrame, path: str) -> None:
    """Stored by year: a reader of some years opens their folders only."""
    features.repartition("year", "city_id").write.partitionBy("year").mode("overwrite").parquet(path)


def point_in_time_audit(
    daily: DataFrame, flags_of: Callable[[DataFrame], DataFrame], cities: DataFrame, as_of: str, columns: Sequence[str] = FEATURES, tolerance: float = 1e-9
) -> DataFrame:
    """(city_id, obs_date, feature, with_future, without) whose value on day ``as_of`` changes when later data are removed; empty if none leaks.

    ``flags_of`` makes the flags from a daily series and is run again on the cut one, so a baseline that looks
    ahead shows. Values within a relative ``tolerance`` are the same.
    """
    cut = F.lit(as_of).cast("date")
    at = lambda df: df.filter(F.col("obs_date") == cut).select("city_id", "obs_date", *(F.col(c).cast("double").alias(c) for c in columns))
    past_days = daily.filter(F.col("obs_date") <= cut)
    full, past = at(feature_table(daily, flags_of(daily), cities)), at(feature_table(past_days, flags_of(past_days), cities))
    long = lambda df, name: df.unpivot(["city_id", "obs_date"], list(columns), "feature", name)
    both = long(full, "with_future").join(long(past, "without"), ["city_id", "obs_date", "feature"], "full_outer")
    a, b = F.col("with_future"), F.col("without")
    return both.filter(~F.coalesce(F.abs(a - b) <= tolerance * F.greatest(F.abs(a), F.abs(b), F.lit(1.0)), a.isNull() & b.isNull()))
