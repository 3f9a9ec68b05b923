"""Point-in-time audits of a stored feature table over many days at once.

A feature of day t may rest on nothing that came after t. The audit makes every feature of the audited days again from
series that end on the day, baselines included, and reports what differs. No series is copied or run again for a day:

* features look back a bounded number of days, so a day needs that stretch of its series only;
* a baseline as it stood on day t is a difference of running sums (count, sum, squares) of its slot at a few dates:
  everything up to t, less the observation's own year up to t. Observations and the dates that are asked for are
  sorted together once, and each ask reads the running sums at its place.

So the cost is one sort of the series plus a fixed number of rows for each audited day and place.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from isoclime.functions.calendar import shift_slot
from isoclime.operators.climatology import HALF, MIN_N, THRESHOLD, flag_anomalies, keyed
from isoclime.operators.features import FEATURES, feature_table

LOOK_BACK = 31


def _day(text: str) -> Column:
    return F.lit(text).cast("date")


def cut_series(daily: DataFrame, days: Sequence[str], look_back: int = LOOK_BACK) -> DataFrame:
    """The ``look_back`` days up to each day of ``days``, with that day as ``as_of``."""
    near = F.filter(F.array(*map(_day, days)), lambda d: (d >= F.col("obs_date")) & (d < F.date_add("obs_date", look_back)))
    return daily.withColumn("as_of", F.explode(near))


def cut_baselines(daily: DataFrame, days: Sequence[str], value: str = "temp_mean", half: int = HALF, reference_years: Sequence[int] | None = None, look_back: int = LOOK_BACK) -> DataFrame:
    """city_id, as_of, obs_date, value, n, mu, sigma: pooled own-year-out baselines as they stood on each day.

    For every observation of the ``look_back`` days before each day; samples lie within +-half slots, on or before the day,
    in other years than the observation's (and in ``reference_years``, if given).
    """
    rows = keyed(daily, value).withColumn("centre", F.avg("value").over(Window.partitionBy("city_id")))
    x = F.col("value") - F.col("centre")
    used = rows if reference_years is None else rows.filter(F.col("year").isin(list(reference_years)))
    one = F.lit(1).cast("long")
    samples = used.select("city_id", "slot", F.col("obs_date").alias("at"), F.lit(0).alias("kind"), one.alias("n"), x.alias("s"), (x * x).alias("q"), F.lit(None).cast("struct<as_of: date, obs_date: date, sign: int>").alias("ask"))
    asked = cut_series(rows, days, look_back)
    own_end = F.make_date("year", F.lit(12), F.lit(31))
    # up to the day, less the own year: R(t) - R(min(t, end of the year)) + R(end of the year before)
    times = F.array(F.struct(F.col("as_of").alias("at"), F.lit(1).alias("sign")), F.struct(F.least("as_of", own_end).alias("at"), F.lit(-1).alias("sign")), F.struct(F.add_months(own_end, -12).alias("at"), F.lit(1).alias("sign")))
    near = F.array(*(shift_slot(F.col("slot"), F.lit(o)) for o in range(-half, half + 1)))
    asks = asked.select("city_id", "as_of", "obs_date", F.explode(near).alias("slot"), times.alias("times"))
    asks = asks.select("city_id", "as_of", "obs_date", "slot", F.inline("times"))
    asks = asks.select("city_id", "slot", "at", F.lit(1).alias("kind"), F.lit(0).cast("long").alias("n"), F.lit(0.0).alias("s"), F.lit(0.0).alias("q"), F.struct("as_of", "obs_date", "sign").alias("ask"))
    upto = Window.partitionBy("city_id", "slot").orderBy("at", "kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sums = samples.unionByName(asks).withColumns({c: F.sum(c).over(upto) for c in ("n", "s", "q")}).filter("kind = 1")
    sign = F.col("ask.sign")
    sums = sums.groupBy("city_id", "ask.as_of", "ask.obs_date").agg(*(F.sum(sign * F.col(c)).alias(c) for c in ("n", "s", "q")))
    out = asked.select("city_id", "as_of", "obs_date", "value", "centre").join(sums, ["city_id", "as_of", "obs_date"])
    variance = F.try_divide(F.col("q") - F.try_divide(F.col("s") * F.col("s"), F.col("n")), F.col("n") - 1)
    mu = F.col("centre") + F.try_divide("s", "n")
    return out.select("city_id", "as_of", "obs_date", "value", "n", mu.alias("mu"), F.when(F.col("n") >= 2, F.sqrt(F.greatest(variance, F.lit(0.0)))).alias("sigma"))


def audit_days(
    features: DataFrame,
    daily: DataFrame,
    cities: DataFrame,
    days: Sequence[str],
    columns: Sequence[str] = FEATURES,
    half: int = HALF,
    threshold: float = THRESHOLD,
    reference_years: Sequence[int] | None = None,
    tolerance: float = 1e-9,
    look_back: int = LOOK_BACK,
) -> DataFrame:
    """(city_id, obs_date, feature, with_future, without) of the stored ``features`` on ``days`` that later data have changed.

    Empty if nothing leaks. The features made again rest on pooled own-year-out baselines of ``reference_years``;
    ``without`` is the value they have when the series ends on the day. A row that only one side has is reported for each
    feature that isn't null there. Values within a relative ``tolerance`` are the same. No feature may look back
    ``look_back`` days or more.
    """
    based = cut_baselines(daily, days, "temp_mean", half, reference_years, look_back)
    z = F.when(F.col("n") >= MIN_N, F.try_divide(F.col("value") - F.col("mu"), F.col("sigma")))
    place = F.struct("city_id", "as_of").alias("city_id")  # each place as it stood on each day is a place of its own
    flags = flag_anomalies(based.select(place, "obs_date", z.alias("z")), threshold)
    series = cut_series(daily, days, look_back).select(place, "obs_date", "temp_mean", "surface_pressure")
    every = cities.select("city_id", "latitude", "elevation", F.explode(F.array(*map(_day, days))).alias("as_of")).select(place, "latitude", "elevation")
    again = feature_table(series, flags, every).filter("obs_date = city_id.as_of")
    cells = [F.col(c).cast("double").alias(c) for c in columns]
    past = again.select("city_id.city_id", "obs_date", *cells)
    stored = features.filter(F.col("obs_date").isin([F.to_date(_day(d)) for d in days])).select("city_id", "obs_date", *cells)
    long = lambda df, name: df.unpivot(["city_id", "obs_date"], list(columns), "feature", name)
    both = long(stored, "with_future").join(long(past, "without"), ["city_id", "obs_date", "feature"], "full_outer")
    a, b = F.col("with_future"), F.col("without")
    return both.filter(~F.coalesce(F.abs(a - b) <= tolerance * F.greatest(F.abs(a), F.abs(b), F.lit(1.0)), a.isNull() & b.isNull()))
