"""Day-of-year normals and Z-score anomalies.

Normals are built from partial sums per place, slot and year: the pooled window explodes partials, not
observations, and leaving a year out is a subtraction from the total, never a self-join. Values are centred
by the place's mean before squaring, so that large levels do not cost digits. Everything is partitioned by
(place, slot); one place's series is bounded by the calendar.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from isoclime.functions.calendar import day_slot, shift_slot
from isoclime.operators.running import running
from isoclime.session import scratch

THRESHOLD, HALF, MIN_N = 2.5, 7, 2


def keyed(obs: DataFrame, value: str = "temp_mean", entity: str = "city_id", day: str = "obs_date") -> DataFrame:
    """(city_id, obs_date, value, slot, year) of rows with a value."""
    return obs.filter(F.col(value).isNotNull()).select(
        F.col(entity).alias("city_id"), F.col(day).alias("obs_date"), F.col(value).cast("double").alias("value"), day_slot(F.col(day)).alias("slot"), F.year(day).alias("year")
    )


def normals(obs: DataFrame, value: str = "temp_mean", years: Sequence[int] | None = None) -> DataFrame:
    """n, mu and sigma per city and slot over the reference years (default: all)."""
    rows = keyed(obs, value)
    if years is not None:
        rows = rows.filter(F.col("year").isin(list(years)))
    return rows.groupBy("city_id", "slot").agg(F.count("*").alias("n"), F.avg("value").alias("mu"), F.stddev_samp("value").alias("sigma"))


def smooth_normals(normal: DataFrame, half: int = HALF, by: Sequence[str] = ()) -> DataFrame:
    """Circular n-weighted means of mu and sigma over +-half slots; sigma counts where it isn't null."""
    near = normal.withColumn("slot", F.explode(F.array(*(shift_slot(F.col("slot"), F.lit(o)) for o in range(-half, half + 1)))))
    weighted = lambda c: F.sum(F.col(c) * F.col("n")) / F.sum(F.when(F.col(c).isNotNull(), F.col("n")))
    return near.groupBy("city_id", "slot", *by).agg(F.sum("n").alias("n"), weighted("mu").alias("mu"), weighted("sigma").alias("sigma"))


def partials(obs: DataFrame, value: str = "temp_mean") -> DataFrame:
    """Count, sum and sum of squares of centred values per city, slot and year, with the centre and the city's years.

    Centre and years come from one window per city (whose series the calendar bounds), so the observations
    are read once and joined with nothing.
    """
    city = Window.partitionBy("city_id")
    rows = keyed(obs, value).withColumn("centre", F.avg("value").over(city)).withColumn("years", F.collect_set("year").over(city))
    x = F.col("value") - F.col("centre")
    return rows.groupBy("city_id", "slot", "year").agg(
        F.count("*").alias("n"), F.sum(x).alias("s"), F.sum(x * x).alias("q"), F.first("centre").alias("centre"), F.first("years").alias("years")
    )


def window_partials(parts: DataFrame, half: int = HALF) -> DataFrame:
    """Partials pooled over +-half slots, each keeping its own year."""
    if not half:
        return parts
    near = parts.withColumn("slot", F.explode(F.array(*(shift_slot(F.col("slot"), F.lit(o)) for o in range(-half, half + 1)))))
    return near.groupBy("city_id", "slot", "year").agg(F.sum("n").alias("n"), F.sum("s").alias("s"), F.sum("q").alias("q"), F.first("centre").alias("centre"), F.first("years").alias("years"))


def _finish(n: Column, s: Column, q: Column) -> list[Column]:
    """n, mu and sigma from sums; rounding below zero counts as zero variance, fewer than two samples as none."""
    variance = F.try_divide(q - F.try_divide(s * s, n), n - 1)
    return [n.alias("n"), (F.col("centre") + F.try_divide(s, n)).alias("mu"), F.when(n >= 2, F.sqrt(F.greatest(variance, F.lit(0.0)))).alias("sigma")]


def pooled_normals(obs: DataFrame, value: str = "temp_mean", half: int = HALF, years: Sequence[int] | None = None) -> DataFrame:
    """mu and sigma of all samples within +-half slots."""
    return pooled_of(partials(obs, value), half, years)


def pooled_of(parts: DataFrame, half: int = HALF, years: Sequence[int] | None = None) -> DataFrame:
    """``pooled_normals`` from partial sums, however they came about (``normals_mart`` stores them)."""
    if years is not None:
        parts = parts.filter(F.col("year").isin(list(years)))
    total = window_partials(parts, half).groupBy("city_id", "slot")
    total = total.agg(F.sum("n").alias("n"), F.sum("s").alias("s"), F.sum("q").alias("q"), F.first("centre").alias("centre"))
    return total.select("city_id", "slot", *_finish(F.col("n"), F.col("s"), F.col("q")))


def loyo_normals(obs: DataFrame, value: str = "temp_mean", half: int = HALF, pooling: str = "pooled", reference_years: Sequence[int] | None = None) -> DataFrame:
    """Normals per city, slot and ref_key (a year) that leave that year out.

    ``pooled`` takes all samples in the window; ``smoothed`` takes single-slot normals (two samples at
    least) and averages them by their counts. ``reference_years`` restricts what is pooled, e.g. to training
    years; years outside it still get normals. Rows exist for every year a city has.
    """
    return loyo_of(partials(obs, value), half, pooling, reference_years)


def loyo_of(parts: DataFrame, half: int = HALF, pooling: str = "pooled", reference_years: Sequence[int] | None = None) -> DataFrame:
    """``loyo_normals`` from partial sums."""
    if reference_years is not None:
        parts = parts.filter(F.col("year").isin(list(reference_years)))
    own = window_partials(parts, half if pooling == "pooled" else 0)
    total = own.groupBy("city_id", "slot").agg(
        F.sum("n").alias("n_all"), F.sum("s").alias("s_all"), F.sum("q").alias("q_all"), F.first("centre").alias("centre"), F.first("years").alias("years"),
        F.collect_list(F.struct("year", "n", "s", "q")).alias("by_year"),
    )
    grid = total.withColumn("ref_key", F.explode("years"))
    own_part = F.get(F.filter("by_year", lambda p: p["year"] == F.col("ref_key")), F.lit(0))
    less = lambda name: F.col(f"{name}_all") - F.coalesce(own_part[name], F.lit(0))
    out = grid.select("city_id", "slot", "ref_key", *_finish(less("n"), less("s"), less("q"))).filter("n >= 2")
    return out if pooling == "pooled" else smooth_normals(out, half, ["ref_key"])


def trailing_normals(obs: DataFrame, value: str = "temp_mean", n_years: int = 30, half: int = HALF) -> DataFrame:
    """Causal normals: for ref_key y, samples of years y-n_years..y-1 in the window."""
    return trailing_of(partials(obs, value), n_years, half)


def trailing_of(parts: DataFrame, n_years: int = 30, half: int = HALF) -> DataFrame:
    """``trailing_normals`` from partial sums."""
    own = window_partials(parts, half)
    w = Window.partitionBy("city_id", "slot").orderBy("year").rangeBetween(-n_years, -1)
    sums = own.select("city_id", "slot", F.col("year").alias("ref_key"), "centre", *(F.sum(c).over(w).alias(c) for c in ("n", "s", "q")))
    return sums.filter("n >= 2").select("city_id", "slot", "ref_key", *_finish(F.col("n"), F.col("s"), F.col("q")))


def zscore(obs: DataFrame, normal: DataFrame, value: str = "temp_mean", min_n: int = MIN_N) -> DataFrame:
    """Every observation with its normal and z = (value - mu) / sigma; null where sigma is 0 or null or n < min_n."""
    rows = keyed(obs, value)
    if "ref_key" in normal.columns:
        rows, keys = rows.withColumn("ref_key", F.col("year")), ["city_id", "slot", "ref_key"]
    else:
        keys = ["city_id", "slot"]
    z = F.when(F.col("n") >= min_n, F.try_divide(F.col("value") - F.col("mu"), F.col("sigma")))
    return rows.join(normal, keys, "left").select("city_id", "obs_date", "slot", "year", "value", "n", "mu", "sigma", z.alias("z"))


def flag_anomalies(z: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Adds is_anomaly (strictly beyond the threshold; null for a null z), direction and magnitude."""
    beyond = F.abs("z") > threshold
    direction = F.when(beyond & (F.col("z") > 0), "warm").when(beyond, "cold")
    return z.withColumn("is_anomaly", beyond).withColumn("direction", direction).withColumn("magnitude", F.abs("z"))


def anomalies(
    obs: DataFrame, value: str = "temp_mean", half: int = HALF, pooling: str = "smoothed", threshold: float = THRESHOLD, reference_years: Sequence[int] | None = None
) -> DataFrame:
    """The whole chain: own-year-out normals (of ``reference_years`` only, if given), z, flags."""
    return flag_anomalies(zscore(obs, loyo_normals(obs, value, half, pooling, reference_years), value), threshold)


def guarded_zscore(obs: DataFrame, value: str = "temp_mean", half: int = HALF, guard_days: int = 7, min_n: int = MIN_N) -> DataFrame:
    """Pooled own-year-out z that also drops reference samples within ``guard_days`` of the observation, across New Year.

    Only observations within guard_days of a year's end have such samples in another year; what they must
    lose is subtracted from the sums of the plain baseline.
    """
    rows = keyed(obs, value)
    centre = rows.groupBy("city_id").agg(F.avg("value").alias("centre"))
    own = window_partials(partials(obs, value), half).drop("years")
    total = own.groupBy("city_id", "slot").agg(F.sum("n").alias("n_all"), F.sum("s").alias("s_all"), F.sum("q").alias("q_all"))
    edge = (F.col("slot") <= guard_days) | (F.col("slot") > 366 - guard_days)
    near = rows.filter(edge)
    days = F.explode(F.array(*(F.date_add("obs_date", k) for k in range(-guard_days, guard_days + 1) if k)))
    ask = near.select("city_id", "obs_date", "slot", "year", days.alias("other_date"))
    other = near.join(centre, "city_id").select("city_id", F.col("obs_date").alias("other_date"), F.col("slot").alias("other_slot"), (F.col("value") - F.col("centre")).alias("x"))
    apart = F.pmod(F.col("slot") - F.col("other_slot"), F.lit(366))
    ask = ask.filter("year(other_date) <> year").join(other, ["city_id", "other_date"]).filter(F.least(apart, 366 - apart) <= half)
    lost = ask.groupBy("city_id", "obs_date").agg(F.count("*").alias("ln"), F.sum("x").alias("ls"), F.sum(F.col("x") * F.col("x")).alias("lq"))
    grid = rows.join(total, ["city_id", "slot"]).join(own, ["city_id", "slot", "year"]).join(lost, ["city_id", "obs_date"], "left")
    sums = [F.col(a) - F.col(b) - F.coalesce(c, F.lit(0)) for a, b, c in (("n_all", "n", "ln"), ("s_all", "s", "ls"), ("q_all", "q", "lq"))]
    out = grid.select("city_id", "obs_date", "slot", "year", "value", *_finish(*sums))
    return out.withColumn("z", F.when(F.col("n") >= min_n, F.try_divide(F.col("value") - F.col("mu"), F.col("sigma"))))


def anomaly_rate(flags: DataFrame) -> DataFrame:
    """Days with a z, anomalies, rate, warm and cold per city."""
    days, hits = F.count("z"), F.count_if("is_anomaly")
    return flags.groupBy("city_id").agg(
        days.alias("days"), hits.alias("anomalies"), F.try_divide(hits, days).alias("rate"),
        F.count_if(F.col("direction") == "warm").alias("warm"), F.count_if(F.col("direction") == "cold").alias("cold"),
    )


#: Event days up to which they are broadcast (a place and a day each); beyond, both sides meet by place and month.
MOST_EVENT_DAYS = 1 << 20


def validate_events(flags: DataFrame, events: DataFrame, most_days: int = MOST_EVENT_DAYS) -> DataFrame:
    """Known dated events against the flags: hit, peak |z| and its day (ties: the first), misses included.

    events: event_id, city_id, start_date, end_date, direction (null: any). Up to ``most_days`` days in all, the events'
    days are broadcast and flags stay where they are: what isn't an event's day is dropped by a hash join, and only one
    row an event is shuffled. Beyond, flags and events are dealt by place and month, so long spans are spread as well.
    """
    spans = events.filter("start_date <= end_date").select("event_id", "city_id", "start_date", "end_date", F.col("direction").alias("wanted"))
    total = spans.agg(F.sum(F.datediff("end_date", "start_date") + 1)).first()[0] or 0
    marks = flags.select("city_id", "obs_date", "is_anomaly", "direction", "magnitude")
    if total <= most_days:
        days = spans.select("event_id", "city_id", "wanted", F.explode(F.sequence("start_date", "end_date")).alias("obs_date"))
        seen = marks.join(F.broadcast(days), ["city_id", "obs_date"])
    else:
        month = lambda c: F.trunc(c, "month")
        dealt = spans.withColumn("_month", F.explode(F.sequence(month("start_date"), month("end_date"), F.expr("INTERVAL 1 MONTH"))))
        seen = marks.withColumn("_month", month("obs_date")).join(dealt, ["city_id", "_month"]).filter("obs_date BETWEEN start_date AND end_date")
    fits = F.col("is_anomaly") & (F.col("wanted").isNull() | (F.col("wanted") == F.col("direction")))
    order = F.when(F.col("magnitude").isNotNull(), F.struct(-F.col("magnitude"), "obs_date"))
    found = seen.groupBy("event_id").agg(F.bool_or(fits).alias("hit"), F.max("magnitude").alias("peak"), F.min_by("obs_date", order).alias("peak_date"))
    return events.select("event_id").distinct().join(found, "event_id", "left").withColumn("hit", F.coalesce("hit", F.lit(False)))


def require_events(validated: DataFrame, min_hits: int | None = None) -> int:
    """Number of events hit; raises if fewer than ``min_hits`` (default: all)."""
    row = validated.agg(F.count_if("hit").alias("hits"), F.count("*").alias("n")).first()
    if row["hits"] < (row["n"] if min_hits is None else min_hits):
        raise RuntimeError(f"only {row['hits']} of {row['n']} known events are flagged")
    return row["hits"]


def leap_audit(obs: DataFrame, z: DataFrame, value: str = "temp_mean") -> DataFrame:
    """One row: rows before and after the baseline join, 29 Feb rows before and after, and slots of 29 Feb and 1 Mar seen."""
    before = keyed(obs, value)
    feb29 = (F.month("obs_date") == 2) & (F.dayofmonth("obs_date") == 29)
    mar1 = (F.month("obs_date") == 3) & (F.dayofmonth("obs_date") == 1)
    a = before.agg(F.count("*").alias("rows_before"), F.count_if(feb29).alias("feb29_before"))
    b = z.agg(
        F.count("*").alias("rows_after"), F.count_if(feb29).alias("feb29_after"),
        F.array_join(F.array_sort(F.collect_set(F.when(feb29, F.col("slot")))), ",").alias("feb29_slots"),
        F.array_join(F.array_sort(F.collect_set(F.when(mar1, F.col("slot")))), ",").alias("mar1_slots"),
    )
    return a.join(b).withColumn("ok", F.expr("rows_before = rows_after AND feb29_before = feb29_after AND feb29_slots IN ('', '60') AND mar1_slots IN ('', '61')"))


def leakage_audit(obs: DataFrame, z: DataFrame, cities: Sequence[int] | None = None, value: str = "temp_mean", half: int = HALF) -> DataFrame:
    """Per city (all, or those of ``cities``): pooled baselines recomputed directly from other years' samples; rows and largest differences."""
    rows = keyed(obs, value)
    if cities is not None:
        rows = rows.filter(F.col("city_id").isin(list(cities)))
    spread = rows.select("city_id", F.col("year").alias("other_year"), F.col("value").alias("other"), F.explode(F.array(*(shift_slot(F.col("slot"), F.lit(o)) for o in range(-half, half + 1)))).alias("slot"))
    direct = rows.join(spread, ["city_id", "slot"]).filter("year <> other_year").groupBy("city_id", "obs_date")
    direct = direct.agg(F.avg("other").alias("mu2"), F.stddev_samp("other").alias("sigma2"), F.count("*").alias("n2"))
    both = z.join(direct, ["city_id", "obs_date"])
    far = lambda a, b: F.round(F.max(F.abs(F.col(a) - F.col(b)) / F.greatest(F.abs(F.col(b)), F.lit(1.0))), 6)
    return both.groupBy("city_id").agg(F.count("*").alias("rows"), F.max(F.abs(F.col("n") - F.col("n2"))).alias("max_n_diff"), far("mu", "mu2").alias("max_mu_diff"), far("sigma", "sigma2").alias("max_sigma_diff"))


def variability_rank(normal: DataFrame) -> DataFrame:
    """Cities by mean sigma, steadiest first; a city without one comes last.

    The means are written once: they are summed in whatever order partials arrive, so means computed a second time may
    differ in their last digit and would then not meet their own rank.
    """
    path = scratch(normal.sparkSession, "means")
    normal.groupBy("city_id").agg(F.avg("sigma").alias("mean_sigma")).write.parquet(path)
    means = normal.sparkSession.read.parquet(path)
    per = running(means.groupBy("mean_sigma").agg(F.count("*").alias("n")), [F.asc_nulls_last("mean_sigma")], {"upto": "n"})
    rank = per.select(F.col("mean_sigma").alias("_s"), (F.col("upto") - F.col("n") + 1).cast("int").alias("rank"))
    return means.join(rank, F.col("mean_sigma").eqNullSafe(F.col("_s"))).drop("_s")


def threshold_compare(flags: DataFrame, abs_delta: float) -> DataFrame:
    """Days flagged per city by a fixed departure, by z, and by both."""
    fixed = F.abs(F.col("value") - F.col("mu")) > abs_delta
    by_z = F.coalesce("is_anomaly", F.lit(False))
    return flags.groupBy("city_id").agg(F.count_if(fixed).alias("by_departure"), F.count_if(by_z).alias("by_z"), F.count_if(fixed & by_z).alias("by_both"))


def anomaly_spells(flags: DataFrame) -> DataFrame:
    """Runs of consecutive anomaly days: city_id, start, end, length, peak |z|."""
    hot = flags.filter("is_anomaly")
    nth = F.row_number().over(Window.partitionBy("city_id").orderBy("obs_date"))
    runs = hot.withColumn("_run", F.unix_date("obs_date") - nth).groupBy("city_id", "_run")
    return runs.agg(F.min("obs_date").alias("start"), F.max("obs_date").alias("end"), F.count("*").alias("length"), F.max("magnitude").alias("peak")).drop("_run")
