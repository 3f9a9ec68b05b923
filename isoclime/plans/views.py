"""The marts behind the four views: map, matrix, storms, risk of the week."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from isoclime.operators.features import seconds
from isoclime.operators.star import newest_per


def global_anomaly_map(flags: DataFrame, cities: DataFrame, as_of: str | None = None) -> DataFrame:
    """The latest row with a z of each city, up to ``as_of``, with its place."""
    seen = flags.filter("z IS NOT NULL")
    if as_of is not None:
        seen = seen.filter(F.col("obs_date") <= F.lit(as_of).cast("date"))
    latest = newest_per(seen, "city_id", "obs_date")
    place = cities.select("city_id", "name", "latitude", "longitude")
    return latest.join(place, "city_id").select("city_id", "name", "latitude", "longitude", "obs_date", "z", "magnitude", F.coalesce("direction", F.lit("normal")).alias("state"))


def climate_matrix(flags: DataFrame, years: Sequence[int] | None = None) -> DataFrame:
    """Anomaly days per city and year; years of the span without any show 0."""
    hits = flags.groupBy("city_id", "year").agg(F.count_if("is_anomaly").alias("anomaly_days"))
    if years is None:
        spine = flags.select("city_id").distinct().join(F.broadcast(flags.agg(F.min("year").alias("_a"), F.max("year").alias("_b"))))  # one row
        spine = spine.select("city_id", F.explode(F.sequence("_a", "_b")).alias("year"))
    else:
        spine = flags.select("city_id").distinct().withColumn("year", F.explode(F.array(*map(F.lit, years))))
    return spine.join(hits, ["city_id", "year"], "left").na.fill(0, ["anomaly_days"])


def climate_matrix_wide(matrix: DataFrame, years: Sequence[int]) -> DataFrame:
    return matrix.groupBy("city_id").pivot("year", list(years)).agg(F.sum("anomaly_days"))


def extremes_trend(matrix: DataFrame) -> DataFrame:
    """Slope of yearly counts per city, in days a year."""
    return matrix.groupBy("city_id").agg(F.regr_slope("anomaly_days", "year").alias("slope"), F.sum("anomaly_days").alias("total"))


def storm_dynamics(hourly: DataFrame, gusts: DataFrame | None = None, hours: int = 24) -> DataFrame:
    """Largest pressure drop within ``hours`` and peak gust per city-day; where no gust is known, the day's highest hourly wind."""
    drop = F.max("pressure").over(seconds(-3600 * hours, 0)) - F.col("pressure")
    per = hourly.withColumn("_drop", drop).groupBy("city_id", F.to_date("ts").alias("date"))
    per = per.agg(F.max("_drop").alias("pressure_drop"), F.max("wind_speed").alias("_wind"))
    if gusts is None:
        return per.select("city_id", "date", "pressure_drop", F.col("_wind").alias("peak_gust"))
    g = gusts.select("city_id", "date", "wind_gust")
    return per.join(g, ["city_id", "date"], "left").select("city_id", "date", "pressure_drop", F.coalesce("wind_gust", "_wind").alias("peak_gust"))


def storm_correlation(storms: DataFrame) -> DataFrame:
    return storms.groupBy("city_id").agg(F.count("*").alias("days"), F.corr("pressure_drop", "peak_gust").alias("correlation"))


def week_risk(predictions: DataFrame, as_of: str, lead: int = 7) -> DataFrame:
    """City and target day of the ``lead`` days after ``as_of``: the largest score issued so far whose window covers the day."""
    day = F.lit(as_of).cast("date")
    issued = predictions.filter(F.col("forecast_date").between(F.date_sub(day, lead - 1), day))
    cells = issued.withColumn("target_date", F.explode(F.sequence(F.date_add("forecast_date", 1), F.date_add("forecast_date", lead))))
    ahead = cells.filter(F.col("target_date") > day)
    return ahead.groupBy("city_id", "target_date").agg(F.max("risk_score").alias("risk"))


def week_risk_wide(cells: DataFrame, as_of: str, lead: int = 7) -> DataFrame:
    """The same with one column for each day ahead."""
    ahead = F.date_diff("target_date", F.lit(as_of).cast("date"))
    named = cells.withColumn("_d", F.concat(F.lit("day"), ahead.cast("string")))
    return named.groupBy("city_id").pivot("_d", [f"day{i}" for i in range(1, lead + 1)]).agg(F.max("risk"))


def top_risk(predictions: DataFrame, as_of: str, k: int = 5) -> DataFrame:
    """The k cities with the greatest score on a day, ranked; ties by city."""
    day = predictions.filter(F.col("forecast_date") == F.lit(as_of).cast("date"))
    top = day.orderBy(F.desc("risk_score"), "city_id").limit(k).select("city_id", "risk_score")
    return top.withColumn("rank", F.row_number().over(Window.orderBy(F.desc("risk_score"), "city_id")))
