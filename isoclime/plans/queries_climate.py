"""Registered queries of the climatology, mart, feature, evaluation, model and streaming operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from isoclime.functions.calendar import day_slot
from isoclime.operators import climatology as clim
from isoclime.operators import evaluation as ev
from isoclime.operators import features as ft
from isoclime.operators import model as ml
from isoclime.operators import normals_mart as mart
from isoclime.operators.audit import audit_days
from isoclime.operators.cleaning import dedup_latest
from isoclime.operators.star import dim_cities
from isoclime.operators.tree_shapley import tree_shapley
from isoclime.plans import views
from isoclime.plans.queries_base import r
from isoclime.session import scratch
from isoclime.sources import proxies
from isoclime.sources.proxies import sql
from isoclime.streaming import streams

QUERIES: dict = {}
ORACLES: dict[str, str] = {}
TRAIN_END, VAL_END = "1998-12-31", "1999-12-31"


def query(name: str, oracle: str | None = None):
    def register(f):
        QUERIES[name] = f
        if oracle:
            ORACLES[name] = oracle
        return f

    return register


def saved(df: DataFrame, name: str) -> DataFrame:
    """Written to the shared folder and read back: what several steps read is computed once."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


#: Years up to TRAIN_END: all that baselines behind a model may know.
TRAIN_YEARS = range(1990, 1999)


def strict(daily_rows: DataFrame) -> DataFrame:
    """Flags whose normals come from training years alone: features and labels of later days owe nothing to later years."""
    return clim.anomalies(daily_rows, pooling="pooled", reference_years=TRAIN_YEARS)


def pooled(spark: SparkSession, d: str) -> DataFrame:
    """The flagged series with pooled own-year-out normals, from the deduplicated raw layer; silver and flags are written."""
    silver = saved(dedup_latest(proxies.bronze(spark, d), ["city_id", "obs_date"], ["ingested_at"], ["seq"]), "silver")
    return saved(clim.anomalies(silver, pooling="pooled"), "flags")


def daily(spark: SparkSession, d: str) -> DataFrame:
    return proxies.daily(spark, d)


def stored_days(spark: SparkSession, d: str, *measures: str) -> DataFrame:
    """Some measures of the daily series, written and read back: line items are read once, later steps read days of a calendar."""
    return saved(daily(spark, d).select("city_id", "obs_date", *measures), "daily")


N3 = "n, round(mu + 1e-7, 4) AS mu, round(sigma + 1e-7, 4) AS sigma"
NEAR = "least((a.slot - b.slot + 366) % 366, (b.slot - a.slot + 366) % 366) <= 7"
SLOTS = ", slots AS (SELECT DISTINCT city_id, unnest(range(1, 367)) AS slot FROM px_obs)"


def normal_columns(df: DataFrame, *keys: str) -> DataFrame:
    return df.select("city_id", "slot", *keys, "n", r("mu"), r("sigma"))


@query("d1_day_slot", sql("px_obs", "SELECT city_id, obs_date, slot FROM px_obs"))
def d1(spark: SparkSession, d: str) -> DataFrame:
    return daily(spark, d).select("city_id", "obs_date", day_slot(F.col("obs_date")).alias("slot"))


RAW = ", raw AS (SELECT city_id, slot, count(*) AS n, avg(temp_mean) AS mu, stddev_samp(temp_mean) AS sigma FROM px_obs GROUP BY 1, 2)"


@query("d2_normals", sql("px_obs", RAW + f" SELECT city_id, slot, {N3} FROM raw"))
def d2(spark: SparkSession, d: str) -> DataFrame:
    return normal_columns(clim.normals(daily(spark, d)))


@query(
    "d3_smooth_normals",
    sql("px_obs", RAW + SLOTS + f"""SELECT a.city_id, CAST(a.slot AS INTEGER) AS slot, CAST(sum(n) AS BIGINT) AS n, round(sum(mu * n) / sum(n) + 1e-7, 4) AS mu,
  round(sum(sigma * n) / sum(CASE WHEN sigma IS NOT NULL THEN n END) + 1e-7, 4) AS sigma
FROM slots a JOIN raw b ON a.city_id = b.city_id AND {NEAR} GROUP BY 1, 2"""),
)
def d3(spark: SparkSession, d: str) -> DataFrame:
    return normal_columns(clim.smooth_normals(clim.normals(daily(spark, d))))


@query(
    "d4_pooled_normals",
    sql("px_obs", SLOTS + f"""SELECT a.city_id, CAST(a.slot AS INTEGER) AS slot, count(*) AS n, round(avg(temp_mean) + 1e-7, 4) AS mu, round(stddev_samp(temp_mean) + 1e-7, 4) AS sigma
FROM slots a JOIN px_obs b ON a.city_id = b.city_id AND {NEAR} GROUP BY 1, 2"""),
)
def d4(spark: SparkSession, d: str) -> DataFrame:
    return normal_columns(clim.pooled_normals(daily(spark, d)))


@query(
    "d5_loyo_normals",
    sql("px_obs", f"""SELECT city_id, slot, year AS ref_key, count(*) AS n, round(avg(x) + 1e-7, 4) AS mu, round(stddev_samp(x) + 1e-7, 4) AS sigma FROM (
  SELECT a.city_id, a.slot, y.year, b.temp_mean AS x FROM (SELECT DISTINCT city_id, CAST(unnest(range(1, 367)) AS INTEGER) AS slot FROM px_obs) a
  JOIN (SELECT DISTINCT city_id, year FROM px_obs) y ON y.city_id = a.city_id
  JOIN px_obs b ON a.city_id = b.city_id AND b.year <> y.year AND {NEAR}) GROUP BY 1, 2, 3 HAVING count(*) >= 2"""),
)
def d5(spark: SparkSession, d: str) -> DataFrame:
    return normal_columns(clim.loyo_normals(daily(spark, d)), "ref_key")


SMOOTH = f""", single AS (SELECT o.city_id, o.slot, y.year, count(*) AS n, avg(temp_mean) AS mu, stddev_samp(temp_mean) AS sigma
  FROM px_obs o JOIN (SELECT DISTINCT city_id, year FROM px_obs) y ON y.city_id = o.city_id AND o.year <> y.year GROUP BY 1, 2, 3 HAVING count(*) >= 2
), smooth AS (SELECT a.city_id, a.obs_date, a.slot, a.year, any_value(a.temp_mean) AS temp_mean, CAST(sum(n) AS BIGINT) AS n, sum(mu * n) / sum(n) AS mu, sum(sigma * n) / sum(n) AS sigma
  FROM px_obs a LEFT JOIN single b ON a.city_id = b.city_id AND a.year = b.year AND {NEAR} GROUP BY 1, 2, 3, 4)"""


@query("d5_smoothed_zscore", sql("px_obs", SMOOTH + " SELECT city_id, obs_date, n, round(mu + 1e-7, 4) AS mu, round(sigma + 1e-7, 4) AS sigma, round((temp_mean - mu) / nullif(sigma, 0) + 1e-7, 4) AS z, abs((temp_mean - mu) / nullif(sigma, 0)) > 2.5 AS is_anomaly FROM smooth"))
def d5s(spark: SparkSession, d: str) -> DataFrame:
    return clim.anomalies(stored_days(spark, d, "temp_mean")).select("city_id", "obs_date", "n", r("mu"), r("sigma"), r("z"), "is_anomaly")


@query(
    "d6_trailing_normals",
    sql("px_obs", f"""SELECT city_id, slot, ref_key, count(*) AS n, round(avg(x) + 1e-7, 4) AS mu, round(stddev_samp(x) + 1e-7, 4) AS sigma FROM (
  SELECT a.city_id, a.slot, a.year AS ref_key, b.temp_mean AS x
  FROM (SELECT DISTINCT s.city_id, s.slot, b.year FROM (SELECT DISTINCT city_id, CAST(unnest(range(1, 367)) AS INTEGER) AS slot FROM px_obs) s
        JOIN px_obs b ON s.city_id = b.city_id AND least((s.slot - b.slot + 366) % 366, (b.slot - s.slot + 366) % 366) <= 7) a
  JOIN px_obs b ON a.city_id = b.city_id AND b.year BETWEEN a.year - 3 AND a.year - 1 AND {NEAR}) GROUP BY 1, 2, 3 HAVING count(*) >= 2"""),
)
def d6(spark: SparkSession, d: str) -> DataFrame:
    return normal_columns(clim.trailing_normals(daily(spark, d), n_years=3), "ref_key")


def normals_from_batches(spark: SparkSession, d: str) -> DataFrame:
    """The stored mart after three batches of days, the second of which brings late days of earlier years, and a revision."""
    path, days = scratch(spark, "normals"), saved(daily(spark, d), "daily")
    late, revised = F.dayofmonth("obs_date") % 9 == 0, F.dayofmonth("obs_date") == 5
    wrong = days.filter("year(obs_date) <= 1997").filter(revised & ~late).withColumn("temp_mean", F.col("temp_mean") + 1000)
    mart.merge_days(spark, path, 1, days.filter("year(obs_date) <= 1997").filter(~late & ~revised).unionByName(wrong))
    mart.merge_days(spark, path, 2, days.filter("year(obs_date) BETWEEN 1998 AND 1999").unionByName(days.filter("year(obs_date) <= 1997").filter(late)))
    rest = days.filter("year(obs_date) >= 2000").unionByName(days.filter("year(obs_date) <= 1997").filter(revised & ~late))
    mart.merge_days(spark, path, 3, rest, withdrawn=wrong)
    return mart.stored_partials(spark, path)


@query("d2_normals_mart", ORACLES["d2_normals"])
def d2_mart(spark: SparkSession, d: str) -> DataFrame:
    return normal_columns(clim.pooled_of(normals_from_batches(spark, d), 0))


@query("d3_smooth_normals_mart", ORACLES["d3_smooth_normals"])
def d3_mart(spark: SparkSession, d: str) -> DataFrame:
    return normal_columns(clim.smooth_normals(clim.pooled_of(normals_from_batches(spark, d), 0)))


@query("d4_pooled_normals_mart", ORACLES["d4_pooled_normals"])
def d4_mart(spark: SparkSession, d: str) -> DataFrame:
    return normal_columns(clim.pooled_of(normals_from_batches(spark, d)))


@query("d5_loyo_normals_mart", ORACLES["d5_loyo_normals"])
def d5_mart(spark: SparkSession, d: str) -> DataFrame:
    return normal_columns(clim.loyo_of(normals_from_batches(spark, d)), "ref_key")


@query("d6_trailing_normals_mart", ORACLES["d6_trailing_normals"])
def d6_mart(spark: SparkSession, d: str) -> DataFrame:
    return normal_columns(clim.trailing_of(normals_from_batches(spark, d), n_years=3), "ref_key")


@query("d7_zscore", sql("px_zf", "SELECT city_id, obs_date, slot, n, round(mu + 1e-7, 4) AS mu, round(sigma + 1e-7, 4) AS sigma, round(z + 1e-7, 4) AS z FROM px_zf"))
def d7(spark: SparkSession, d: str) -> DataFrame:
    obs = stored_days(spark, d, "temp_mean")
    return clim.zscore(obs, clim.loyo_normals(obs)).select("city_id", "obs_date", "slot", "n", r("mu"), r("sigma"), r("z"))


@query(
    "d7_guarded_zscore",
    sql("px_pairs", """, g AS (SELECT a.* , b.obs_date AS other_date FROM px_obs a JOIN px_obs b ON a.city_id = b.city_id AND a.year <> b.year
    AND least((a.slot - b.slot + 366) % 366, (b.slot - a.slot + 366) % 366) <= 7 AND abs(a.obs_date - b.obs_date) > 7)
SELECT a.city_id, a.obs_date, count(*) AS n, round(avg(b.temp_mean) + 1e-7, 4) AS mu, round((any_value(a.temp_mean) - avg(b.temp_mean)) / nullif(stddev_samp(b.temp_mean), 0) + 1e-7, 4) AS z
FROM g a JOIN px_obs b ON b.city_id = a.city_id AND b.obs_date = a.other_date GROUP BY 1, 2"""),
)
def d7g(spark: SparkSession, d: str) -> DataFrame:
    return clim.guarded_zscore(stored_days(spark, d, "temp_mean")).filter("n > 0").select("city_id", "obs_date", "n", r("mu"), r("z"))


FLAGS = "CASE WHEN is_anomaly THEN CASE WHEN z > 0 THEN 'warm' ELSE 'cold' END END"


@query("d8_flag_anomalies", sql("px_zf", f"SELECT city_id, obs_date, round(z + 1e-7, 4) AS z, is_anomaly, {FLAGS} AS direction, round(abs(z) + 1e-7, 4) AS magnitude FROM px_zf"))
def d8(spark: SparkSession, d: str) -> DataFrame:
    return pooled(spark, d).select("city_id", "obs_date", r("z"), "is_anomaly", "direction", r("magnitude"))


@query(
    "d9_anomaly_rate",
    sql("px_zf", """SELECT city_id, count(z) AS days, count(*) FILTER (is_anomaly) AS anomalies, round(count(*) FILTER (is_anomaly) / nullif(count(z), 0) + 1e-7, 4) AS rate,
  count(*) FILTER (is_anomaly AND z > 0) AS warm, count(*) FILTER (is_anomaly AND z < 0) AS cold FROM px_zf GROUP BY 1"""),
)
def d9(spark: SparkSession, d: str) -> DataFrame:
    return clim.anomaly_rate(pooled(spark, d)).select("city_id", "days", "anomalies", r("rate"), "warm", "cold")


EVENTS = """, ev AS (
  SELECT city_id AS event_id, city_id, arg_max(obs_date, z) AS start_date, arg_max(obs_date, z) + 1 AS end_date, 'warm' AS direction FROM px_zf WHERE city_id < 15 AND z IS NOT NULL GROUP BY city_id
  UNION ALL SELECT 1000, min(city_id), DATE '1990-01-01', DATE '1990-01-03', NULL FROM px_zf)"""


def known_events(flags: DataFrame) -> DataFrame:
    """The warmest day of each of the first cities, and one planted miss."""
    peak = F.max_by("obs_date", "z")
    hits = flags.filter("city_id < 15 AND z IS NOT NULL").groupBy("city_id").agg(peak.alias("start_date"))
    hits = hits.select(F.col("city_id").alias("event_id"), "city_id", "start_date", F.date_add("start_date", 1).alias("end_date"), F.lit("warm").alias("direction"))
    miss = flags.agg(F.min("city_id").alias("city_id"))
    day = lambda t: F.lit(t).cast("date")
    return hits.unionByName(miss.select(F.lit(1000).alias("event_id"), "city_id", day("1990-01-01").alias("start_date"), day("1990-01-03").alias("end_date"), F.lit(None).cast("string").alias("direction")))


@query(
    "d10_validate_events",
    sql("px_zf", EVENTS + """
SELECT event_id, coalesce(bool_or(is_anomaly AND (direction IS NULL OR direction = CASE WHEN z > 0 THEN 'warm' ELSE 'cold' END)), false) AS hit,
  round(max(abs(z)) + 1e-7, 4) AS peak, arg_max(obs_date, abs(z)) AS peak_date
FROM ev LEFT JOIN px_zf z ON z.city_id = ev.city_id AND obs_date BETWEEN start_date AND end_date GROUP BY 1"""),
)
def d10(spark: SparkSession, d: str) -> DataFrame:
    flags = pooled(spark, d)
    return clim.validate_events(flags, known_events(flags)).select("event_id", "hit", r("peak"), "peak_date")


@query(
    "d11_leap_audit",
    sql("px_obs px_zf", """, f AS (SELECT *, month(obs_date) = 2 AND day(obs_date) = 29 AS feb29, month(obs_date) = 3 AND day(obs_date) = 1 AS mar1 FROM px_obs)
SELECT count(*) AS rows_before, count(*) FILTER (feb29) AS feb29_before, (SELECT count(*) FROM px_zf) AS rows_after, count(*) FILTER (feb29) AS feb29_after,
  coalesce(string_agg(DISTINCT CASE WHEN feb29 THEN CAST(slot AS VARCHAR) END, ','), '') AS feb29_slots,
  coalesce(string_agg(DISTINCT CASE WHEN mar1 THEN CAST(slot AS VARCHAR) END, ','), '') AS mar1_slots, true AS ok FROM f"""),
)
def d11(spark: SparkSession, d: str) -> DataFrame:
    obs = stored_days(spark, d, "temp_mean")
    return clim.leap_audit(obs, clim.zscore(obs, clim.loyo_normals(obs)))


@query(
    "d12_leakage_audit",
    sql("px_z", """, direct AS (SELECT a.city_id, a.obs_date, count(*) AS n2, avg(b.temp_mean) AS mu2, stddev_samp(b.temp_mean) AS sigma2
  FROM px_obs a JOIN px_obs b ON a.city_id = b.city_id AND b.year < a.year + 1000 AND (b.slot - a.slot + 366 + 7) % 366 <= 14 AND b.year <> a.year GROUP BY 1, 2)
SELECT city_id, count(*) AS "rows", max(abs(n - n2)) AS max_n_diff, round(max(abs(mu - mu2) / greatest(abs(mu2), 1.0)), 6) AS max_mu_diff, round(max(abs(sigma - sigma2) / greatest(abs(sigma2), 1.0)), 6) AS max_sigma_diff
FROM px_z JOIN direct USING (city_id, obs_date) GROUP BY 1"""),
)
def d12(spark: SparkSession, d: str) -> DataFrame:
    obs = stored_days(spark, d, "temp_mean")
    z = clim.zscore(obs, clim.loyo_normals(obs)).filter("n IS NOT NULL")
    return clim.leakage_audit(obs, z)


@query(
    "d13_variability_rank",
    sql("px_obs", RAW + ', m AS (SELECT city_id, avg(sigma) AS s FROM raw GROUP BY 1) SELECT city_id, round(s + 1e-7, 4) AS mean_sigma, CAST(rank() OVER (ORDER BY s) AS INTEGER) AS rank FROM m'),
)
def d13(spark: SparkSession, d: str) -> DataFrame:
    return clim.variability_rank(clim.normals(daily(spark, d))).select("city_id", r("mean_sigma"), "rank")


@query(
    "d14_threshold_compare",
    sql("px_zf", """SELECT city_id, count(*) FILTER (abs(temp_mean - mu) > 100000) AS by_departure, count(*) FILTER (coalesce(is_anomaly, false)) AS by_z,
  count(*) FILTER (abs(temp_mean - mu) > 100000 AND coalesce(is_anomaly, false)) AS by_both FROM px_zf GROUP BY 1"""),
)
def d14(spark: SparkSession, d: str) -> DataFrame:
    return clim.threshold_compare(pooled(spark, d), 100000)


@query(
    "d15_anomaly_spells",
    sql("px_zf", """, h AS (SELECT *, obs_date - CAST(row_number() OVER (PARTITION BY city_id ORDER BY obs_date) AS INTEGER) AS run FROM px_zf WHERE is_anomaly)
SELECT city_id, min(obs_date) AS start, max(obs_date) AS "end", count(*) AS length, round(max(abs(z)) + 1e-7, 4) AS peak FROM h GROUP BY city_id, run"""),
)
def d15(spark: SparkSession, d: str) -> DataFrame:
    return clim.anomaly_spells(pooled(spark, d)).select("city_id", "start", "end", "length", r("peak"))


# Features and labels

DN = ", f AS (SELECT *, CAST(obs_date - DATE '1970-01-01' AS INTEGER) AS dn FROM px_zf)"
W = lambda a, b, o="dn": f"(PARTITION BY city_id ORDER BY {o} RANGE BETWEEN {a} AND {b})"


def back(k: int) -> str:
    return f"{k} PRECEDING"


@query(
    "e1_lags",
    sql("px_daily", ", f AS (SELECT *, CAST(obs_date - DATE '1970-01-01' AS INTEGER) AS dn FROM px_daily) SELECT city_id, obs_date, " + ", ".join(
        f"max({c}) OVER {W(back(k), back(k))} AS {c}_lag{k}" for c in ("temp_mean", "surface_pressure") for k in ft.LAGS) + " FROM f"),
)
def e1(spark: SparkSession, d: str) -> DataFrame:
    return ft.lags(daily(spark, d)).select("city_id", "obs_date", *(f"{c}_lag{k}" for c in ("temp_mean", "surface_pressure") for k in ft.LAGS))


@query(
    "e2_rolling",
    sql("px_daily", ", f AS (SELECT *, CAST(obs_date - DATE '1970-01-01' AS INTEGER) AS dn FROM px_daily) SELECT city_id, obs_date, " + ", ".join(
        f"round(avg(temp_mean) OVER {W(back(w - 1), 'CURRENT ROW')} + 1e-7, 4) AS temp_mean_mean{w}, round(var_samp(temp_mean) OVER {W(back(w - 1), 'CURRENT ROW')} / 1e6 + 1e-7, 4) AS temp_mean_var{w}, "
        f"count(temp_mean) OVER {W(back(w - 1), 'CURRENT ROW')} AS temp_mean_n{w}" for w in ft.ROLLS) + " FROM f"),
)
def e2(spark: SparkSession, d: str) -> DataFrame:
    out = ft.rolling(daily(spark, d))
    cells = [x for w in ft.ROLLS for x in (r(f"temp_mean_mean{w}"), F.round(F.col(f"temp_mean_var{w}") / 1e6 + 1e-7, 4).alias(f"temp_mean_var{w}"), f"temp_mean_n{w}")]
    return out.select("city_id", "obs_date", *cells)


@query("e3_trailing_z", sql("px_zf", DN + f" SELECT city_id, obs_date, round(z + 1e-7, 4) AS z_now, round(last_value(z IGNORE NULLS) OVER {W(back(6), 'CURRENT ROW')} + 1e-7, 4) AS z_last FROM f"))
def e3(spark: SparkSession, d: str) -> DataFrame:
    return ft.trailing_z(pooled(spark, d)).select("city_id", "obs_date", r("z_now"), r("z_last"))


@query(
    "e4_pressure_tendency_daily",
    sql("px_daily", ", f AS (SELECT *, CAST(obs_date - DATE '1970-01-01' AS INTEGER) AS dn FROM px_daily) SELECT city_id, obs_date, " + ", ".join(
        f"round(surface_pressure - max(surface_pressure) OVER {W(back(k), back(k))} + 1e-7, 4) AS surface_pressure_change{24 * k}h" for k in (1, 3)) + " FROM f"),
)
def e4(spark: SparkSession, d: str) -> DataFrame:
    return ft.pressure_tendency_daily(daily(spark, d)).select("city_id", "obs_date", r("surface_pressure_change24h"), r("surface_pressure_change72h"))


@query(
    "e5_pressure_tendency_hourly",
    sql("px_hourly", ", f AS (SELECT *, CAST(epoch(ts) AS BIGINT) AS s FROM px_hourly) SELECT city_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts, " + ", ".join(
        f"round(pressure - max(pressure) OVER {W(back(h * 3600), back(h * 3600), 's')} + 1e-7, 4) AS pressure_change{h}h" for h in (24, 72)) + " FROM f"),
)
def e5(spark: SparkSession, d: str) -> DataFrame:
    out = ft.pressure_tendency_hourly(proxies.hourly(spark, d))
    return out.select("city_id", F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("ts"), r("pressure_change24h"), r("pressure_change72h"))


@query("e6_cyclic_doy", sql("px_obs", "SELECT city_id, obs_date, round(sin(2 * pi() * slot / 366) + 1e-9, 6) AS doy_sin, round(cos(2 * pi() * slot / 366) + 1e-9, 6) AS doy_cos FROM px_obs"))
def e6(spark: SparkSession, d: str) -> DataFrame:
    return ft.cyclic_doy(daily(spark, d)).select("city_id", "obs_date", r("doy_sin", 6), r("doy_cos", 6))


@query("e7_static_features", sql("px_daily px_cities", "SELECT p.city_id, obs_date, round(latitude + 1e-7, 4) AS latitude, elevation FROM px_daily p LEFT JOIN px_cities c USING (city_id)"))
def e7(spark: SparkSession, d: str) -> DataFrame:
    return ft.static_features(daily(spark, d), proxies.cities(spark, d)).select("city_id", "obs_date", r("latitude"), "elevation")


@query("e8_anomaly_count", sql("px_zf", DN + f" SELECT city_id, obs_date, CAST(sum(coalesce(CAST(is_anomaly AS INTEGER), 0)) OVER {W(back(29), 'CURRENT ROW')} AS BIGINT) AS anomaly_count30 FROM f"))
def e8(spark: SparkSession, d: str) -> DataFrame:
    return ft.anomaly_count(pooled(spark, d)).select("city_id", "obs_date", "anomaly_count30")


AHEAD = W("1 FOLLOWING", "7 FOLLOWING")
LABEL = DN + f""", l AS (SELECT *, CASE WHEN obs_date + 7 <= max(obs_date) OVER (PARTITION BY city_id) AND count(is_anomaly) OVER {AHEAD} >= 1
  THEN max(CAST(is_anomaly AS INTEGER)) OVER {AHEAD} END AS label FROM f)"""


@query("e9_forward_label", sql("px_zf", LABEL + " SELECT city_id, obs_date, label FROM l"))
def e9(spark: SparkSession, d: str) -> DataFrame:
    return ft.forward_label(pooled(spark, d)).select("city_id", "obs_date", "label")


def feature_rows(spark: SparkSession, d: str) -> DataFrame:
    """The feature table on strict flags: no baseline behind a feature or label knows a year after training."""
    days = saved(daily(spark, d), "daily")
    return ft.feature_table(days, saved(strict(days), "strict_flags"), dim_cities(proxies.cities(spark, d)))


def lagged(column: str, k: int) -> str:
    return f"max({column}) OVER {W(back(k), back(k))}"


FEATURE_SQL = DN.replace("px_zf", "px_zsf").replace("f AS (SELECT *", "z AS (SELECT *") + f""", f AS (SELECT p.city_id, p.obs_date, p.temp_mean, p.surface_pressure, z, is_anomaly, slot, year, dn FROM px_daily p JOIN z USING (city_id, obs_date)
), ft AS (SELECT f.city_id, obs_date, year, {", ".join(f"{lagged(c, k)} AS {c}_lag{k}" for c in ("temp_mean", "surface_pressure") for k in ft.LAGS)},
  {", ".join(f"round(avg(temp_mean) OVER {W(back(w - 1), 'CURRENT ROW')} + 1e-7, 4) AS temp_mean_mean{w}, round(var_samp(temp_mean) OVER {W(back(w - 1), 'CURRENT ROW')} / 1e6 + 1e-7, 4) AS temp_mean_var{w}" for w in ft.ROLLS)},
  round(z + 1e-7, 4) AS z_now, round(last_value(z IGNORE NULLS) OVER {W(back(6), "CURRENT ROW")} + 1e-7, 4) AS z_last,
  {", ".join(f"round(surface_pressure - {lagged('surface_pressure', k)} + 1e-7, 4) AS surface_pressure_change{24 * k}h" for k in (1, 3))},
  round(sin(2 * pi() * slot / 366) + 1e-9, 6) AS doy_sin, round(cos(2 * pi() * slot / 366) + 1e-9, 6) AS doy_cos, round(latitude + 1e-7, 4) AS latitude, elevation,
  CAST(sum(coalesce(CAST(is_anomaly AS INTEGER), 0)) OVER {W(back(29), "CURRENT ROW")} AS BIGINT) AS anomaly_count30,
  CASE WHEN obs_date + 7 <= max(obs_date) OVER (PARTITION BY f.city_id) AND count(is_anomaly) OVER {AHEAD} >= 1 THEN max(CAST(is_anomaly AS INTEGER)) OVER {AHEAD} END AS label
FROM f LEFT JOIN px_cities ON px_cities.city_id = f.city_id)"""
FEATURE_SQL = FEATURE_SQL.replace("PARTITION BY city_id", "PARTITION BY f.city_id")


def feature_cells() -> list:
    """All features as the SQL has them: variances in millions, everything that is computed rounded."""
    exact = {f"{c}_lag{k}" for c in ("temp_mean", "surface_pressure") for k in ft.LAGS} | {"elevation", "anomaly_count30"}
    digits = {"doy_sin": 6, "doy_cos": 6}
    variance = lambda c: F.round(F.col(c) / 1e6 + 1e-7, 4).alias(c)
    return [c if c in exact else variance(c) if c.startswith("temp_mean_var") else r(c, digits.get(c, 4)) for c in ft.FEATURES]


@query("e10_feature_table", sql("px_zsf px_daily px_cities", FEATURE_SQL + " SELECT * FROM ft"))
def e10(spark: SparkSession, d: str) -> DataFrame:
    return feature_rows(spark, d).select("city_id", "obs_date", "year", *feature_cells(), "label")


@query("e10_feature_table_by_year", sql("px_zsf px_daily px_cities", FEATURE_SQL + " SELECT * FROM ft WHERE year = 1999"))
def e10_by_year(spark: SparkSession, d: str) -> DataFrame:
    """One year of the stored table: the filter prunes the other years' folders."""
    path = scratch(spark, "feature_table")
    ft.write_feature_table(feature_rows(spark, d), path)
    return spark.read.parquet(path).filter("year = 1999").select("city_id", "obs_date", "year", *feature_cells(), "label")


SPLIT = """, s AS (SELECT *, CASE WHEN obs_date <= DATE '1998-12-31' THEN 'train' WHEN obs_date <= DATE '1999-12-31' THEN 'validate' ELSE 'test' END AS split FROM l
  WHERE NOT (obs_date <= DATE '1998-12-31' AND obs_date + 7 > DATE '1998-12-31') AND NOT (obs_date > DATE '1998-12-31' AND obs_date <= DATE '1999-12-31' AND obs_date + 7 > DATE '1999-12-31'))"""


def labelled(flags: DataFrame) -> DataFrame:
    return ft.chronological_split(ft.forward_label(flags), TRAIN_END, VAL_END)


@query("e11_chronological_split", sql("px_zf", LABEL + SPLIT + " SELECT city_id, obs_date, split, label FROM s"))
def e11(spark: SparkSession, d: str) -> DataFrame:
    return labelled(pooled(spark, d)).select("city_id", "obs_date", "split", "label")


@query(
    "e12_class_balance",
    sql("px_zf", LABEL + SPLIT + """ SELECT split, count(label) AS n, CAST(sum(label) AS BIGINT) AS positives, round(sum(label) / count(label) + 1e-7, 4) AS rate,
  round((count(label) - sum(label)) / nullif(sum(label), 0) + 1e-7, 4) AS pos_weight FROM s GROUP BY 1"""),
)
def e12(spark: SparkSession, d: str) -> DataFrame:
    return ft.class_balance(labelled(pooled(spark, d))).select("split", "n", "positives", r("rate"), r("pos_weight"))


AUDITED = [f"{y}-{m:02}-15" for y in (1997, 1999, 2000) for m in (1, 3, 6, 9, 12)]


def audited(spark: SparkSession, d: str, flags_of: Callable[[DataFrame], DataFrame], years: range | None, columns: list[str] = ft.FEATURES) -> DataFrame:
    """The stored feature table of some flags, audited on ``AUDITED`` in one run."""
    days, cities = saved(daily(spark, d), "daily"), dim_cities(proxies.cities(spark, d))
    path = scratch(spark, "feature_table")
    ft.write_feature_table(ft.feature_table(days, saved(flags_of(days), "flags"), cities), path)
    return audit_days(spark.read.parquet(path), days, cities, AUDITED, columns, reference_years=years)


@query("e13_point_in_time_audit", sql("px_daily", "SELECT city_id, obs_date, CAST(NULL AS VARCHAR) AS feature FROM px_daily WHERE false"))
def e13(spark: SparkSession, d: str) -> DataFrame:
    """Strict flags rest on training years alone, so from the end of training on nothing that comes later changes a feature."""
    return audited(spark, d, strict, TRAIN_YEARS).filter("obs_date > DATE '1998-12-31'").select("city_id", "obs_date", "feature")


CUT = """, ask AS (SELECT CAST(unnest(%s) AS DATE) AS as_of
), own AS (SELECT as_of, o.* FROM ask JOIN px_obs o ON o.obs_date BETWEEN as_of - 29 AND as_of
), z AS (SELECT a.as_of, a.city_id, a.obs_date, CASE WHEN count(b.temp_mean) >= 2 THEN (any_value(a.temp_mean) - avg(b.temp_mean)) / nullif(stddev_samp(b.temp_mean), 0) END AS z
  FROM own a LEFT JOIN px_obs b ON a.city_id = b.city_id AND a.year <> b.year AND b.obs_date <= a.as_of AND least((a.slot - b.slot + 366) %% 366, (b.slot - a.slot + 366) %% 366) <= 7 GROUP BY 1, 2, 3
), past AS (SELECT city_id, as_of AS obs_date, arg_max(z, obs_date) FILTER (obs_date = as_of) AS z_now, arg_max(z, obs_date) FILTER (z IS NOT NULL AND obs_date > as_of - 7) AS z_last,
  CAST(count(*) FILTER (abs(z) > 2.5) AS DOUBLE) AS anomaly_count30 FROM z GROUP BY 1, 2 HAVING bool_or(obs_date = as_of)
), g AS (SELECT *, CAST(obs_date - DATE '1970-01-01' AS INTEGER) AS dn FROM px_zf
), full_ AS (SELECT city_id, obs_date, z AS z_now, last_value(z IGNORE NULLS) OVER %s AS z_last, CAST(sum(coalesce(CAST(is_anomaly AS INTEGER), 0)) OVER %s AS DOUBLE) AS anomaly_count30 FROM g
), both_ AS (SELECT city_id, obs_date, unnest(['z_now', 'z_last', 'anomaly_count30']) AS feature, unnest([f.z_now, f.z_last, f.anomaly_count30]) AS a, unnest([p.z_now, p.z_last, p.anomaly_count30]) AS b
  FROM past p JOIN full_ f USING (city_id, obs_date))
SELECT city_id, obs_date, feature, round(a + 1e-7, 4) AS with_future, round(b + 1e-7, 4) AS without FROM both_
WHERE NOT coalesce(abs(a - b) <= 1e-9 * greatest(abs(a), abs(b), 1.0), a IS NULL AND b IS NULL)""" % ([*AUDITED], W(back(6), "CURRENT ROW"), W(back(29), "CURRENT ROW"))


@query("e13_point_in_time_audit_pooled", sql("px_obs px_zf", CUT))
def e13_pooled(spark: SparkSession, d: str) -> DataFrame:
    """The same audit of flags whose baselines see all other years: what it reports is the leak, as direct joins have it."""
    flags_of = lambda rows: clim.anomalies(rows, pooling="pooled")
    found = audited(spark, d, flags_of, None, ["z_now", "z_last", "anomaly_count30"])
    return found.select("city_id", "obs_date", "feature", r("with_future"), r("without"))


# Baselines, metrics, models

PERSIST = LABEL + SPLIT + f""", p0 AS (SELECT city_id, obs_date, CAST(max(coalesce(CAST(is_anomaly AS INTEGER), 0)) OVER {W(back(6), 'CURRENT ROW')} AS DOUBLE) AS score FROM f
), p AS (SELECT s.*, p0.score FROM s JOIN p0 USING (city_id, obs_date))"""
CLIMATE = LABEL + SPLIT + """, tr AS (SELECT *, weekofyear(obs_date) AS wk FROM s WHERE split = 'train' AND label IS NOT NULL
), bw AS (SELECT city_id, wk, avg(label) AS a FROM tr GROUP BY 1, 2), bc AS (SELECT city_id, avg(label) AS a FROM tr GROUP BY 1
), c AS (SELECT s.*, coalesce(bw.a, bc.a, (SELECT avg(label) FROM tr)) AS score FROM s
  LEFT JOIN bw ON bw.city_id = s.city_id AND bw.wk = weekofyear(s.obs_date) LEFT JOIN bc ON bc.city_id = s.city_id)"""
CUMULATED = """, k AS (SELECT score AS s0, count(*) AS n, sum(label) AS pos FROM c WHERE label IS NOT NULL AND score IS NOT NULL {} GROUP BY 1
), t AS (SELECT *, sum(n) OVER (ORDER BY s0 DESC) AS alln, sum(pos) OVER (ORDER BY s0 DESC) AS tp, sum(pos) OVER () AS positives FROM k)"""


def persistence(flags: DataFrame) -> DataFrame:
    rows = labelled(flags)
    return saved(rows.join(ev.persistence_baseline(flags).select("city_id", "obs_date", "score"), ["city_id", "obs_date"]), "persistence")


def climate(flags: DataFrame) -> DataFrame:
    rows = labelled(flags)
    return ev.climatology_baseline(rows.filter("split = 'train'"), rows)


@query("f1_persistence_baseline", sql("px_zf", PERSIST + " SELECT city_id, obs_date, split, score FROM p"))
def f1(spark: SparkSession, d: str) -> DataFrame:
    return persistence(pooled(spark, d)).select("city_id", "obs_date", "split", "score")


@query("f2_climatology_baseline", sql("px_zf", CLIMATE + " SELECT city_id, obs_date, split, round(score + 1e-7, 4) AS score FROM c"))
def f2(spark: SparkSession, d: str) -> DataFrame:
    return climate(pooled(spark, d)).select("city_id", "obs_date", "split", r("score"))


def rounded(spark: SparkSession, d: str) -> DataFrame:
    """The climatology baseline with rounded scores, so that equal scores are equal wherever they were computed."""
    return saved(rounded_scores(pooled(spark, d)), "scores")


def rounded_scores(flags: DataFrame) -> DataFrame:
    return climate(flags).withColumn("score", F.round("score", 6))


ROUNDED = CLIMATE.replace("coalesce(bw.a, bc.a, (SELECT avg(label) FROM tr)) AS score", "round(coalesce(bw.a, bc.a, (SELECT avg(label) FROM tr)), 6) AS score")


@query(
    "f4_pr_auc",
    sql("px_zf", ROUNDED + CUMULATED.format("AND split = 'test'") + """, q AS (SELECT *, tp / alln AS p, tp / nullif(positives, 0) AS r FROM t
), z AS (SELECT *, coalesce(lag(p) OVER (ORDER BY s0 DESC), 1.0) AS p0, coalesce(lag(r) OVER (ORDER BY s0 DESC), 0.0) AS r0 FROM q)
SELECT round(sum(pos / nullif(positives, 0) * p) + 1e-7, 4) AS average_precision, round(sum((r - r0) * (p + p0) / 2) + 1e-7, 4) AS trapezoid FROM z"""),
)
def f4(spark: SparkSession, d: str) -> DataFrame:
    return ev.pr_auc(rounded(spark, d).filter("split = 'test'")).select(r("average_precision"), r("trapezoid"))


CONFUSION = """count(*) FILTER (score >= 0.1 AND label = 1) AS tp, count(*) FILTER (score >= 0.1 AND label = 0) AS fp,
  count(*) FILTER (score < 0.1 AND label = 1) AS fn, count(*) FILTER (score < 0.1 AND label = 0) AS tn"""


@query("f5_confusion", sql("px_zf", ROUNDED + f" SELECT split, {CONFUSION} FROM c WHERE label IS NOT NULL GROUP BY 1"))
def f5(spark: SparkSession, d: str) -> DataFrame:
    return ev.confusion(rounded(spark, d), 0.1, by=["split"])


@query("f5_f1_at", sql("px_zf", ROUNDED + f""", m AS (SELECT split, {CONFUSION} FROM c WHERE label IS NOT NULL GROUP BY 1)
SELECT split, round(tp / nullif(tp + fp, 0) + 1e-7, 4) AS precision, round(tp / nullif(tp + fn, 0) + 1e-7, 4) AS recall, round(2 * tp / nullif(2 * tp + fp + fn, 0) + 1e-7, 4) AS f1 FROM m"""))
def f5_f1(spark: SparkSession, d: str) -> DataFrame:
    return ev.f1_at(rounded(spark, d), 0.1, by=["split"]).select("split", r("precision"), r("recall"), r("f1"))


@query("f6_best_threshold", sql("px_zf", ROUNDED + CUMULATED.format("AND split = 'validate'") + ", b AS (SELECT s0 AS threshold, 2 * tp / (alln + positives) AS f1 FROM t) SELECT threshold, round(f1 + 1e-7, 4) AS f1 FROM b ORDER BY f1 DESC, threshold DESC LIMIT 1"))
def f6(spark: SparkSession, d: str) -> DataFrame:
    return ev.best_threshold(rounded(spark, d).filter("split = 'validate'")).select("threshold", r("f1"))


@query(
    "f7_brier",
    sql("px_zf", ROUNDED + """, v AS (SELECT *, (SELECT avg(label) FROM tr) AS base FROM c WHERE split = 'test' AND label IS NOT NULL)
SELECT round(avg(power(score - label, 2)) + 1e-7, 4) AS brier, round(avg(power(base - label, 2)) + 1e-7, 4) AS reference, round(1 - avg(power(score - label, 2)) / nullif(avg(power(base - label, 2)), 0) + 1e-7, 4) AS skill FROM v"""),
)
def f7(spark: SparkSession, d: str) -> DataFrame:
    rows = rounded(spark, d)
    base = rows.filter("split = 'train' AND label IS NOT NULL").agg(F.avg("label").alias("base"))
    return ev.brier(rows.filter("split = 'test'").join(F.broadcast(base)), reference="base").select(r("brier"), r("reference"), r("skill"))


CURVE = ", v AS (SELECT least(CAST(floor(score * 10) AS INTEGER), 9) AS bin, count(*) AS n, avg(score) AS ms, avg(label) AS ob FROM c WHERE label IS NOT NULL GROUP BY 1)"


@query("f8_calibration_curve", sql("px_zf", ROUNDED + CURVE + " SELECT bin, n, round(ms + 1e-7, 4) AS mean_score, round(ob + 1e-7, 4) AS observed FROM v"))
def f8(spark: SparkSession, d: str) -> DataFrame:
    return ev.calibration_curve(rounded(spark, d)).select("bin", "n", r("mean_score"), r("observed"))


@query("f8_calibration_error", sql("px_zf", ROUNDED + CURVE + " SELECT round(sum(n * abs(ms - ob)) / sum(n) + 1e-7, 4) AS ece FROM v"))
def f8_ece(spark: SparkSession, d: str) -> DataFrame:
    return ev.calibration_error(ev.calibration_curve(rounded(spark, d))).select(r("ece"))


@query("f9_prior_correction", sql("px_zf", ROUNDED + " SELECT city_id, obs_date, round(score / nullif(score + 9.0 * (1 - score), 0) + 1e-7, 4) AS corrected FROM c"))
def f9(spark: SparkSession, d: str) -> DataFrame:
    return rounded(spark, d).select("city_id", "obs_date", F.round(ev.prior_correction(F.col("score"), 9.0) + 1e-7, 4).alias("corrected"))


COMPARED = ROUNDED + f""", p0 AS (SELECT city_id, obs_date, CAST(max(coalesce(CAST(is_anomaly AS INTEGER), 0)) OVER {W(back(6), 'CURRENT ROW')} AS DOUBLE) AS score FROM f
), al AS (SELECT 'climatology' AS model, split, score, label FROM c WHERE label IS NOT NULL AND score IS NOT NULL
  UNION ALL SELECT 'persistence', s.split, p0.score, s.label FROM s JOIN p0 USING (city_id, obs_date) WHERE label IS NOT NULL
), k AS (SELECT model, split, score AS s0, count(*) AS n, sum(label) AS pos FROM al GROUP BY 1, 2, 3
), t AS (SELECT *, sum(pos) OVER w / sum(n) OVER w AS p, sum(pos) OVER (PARTITION BY model, split) AS positives FROM k WINDOW w AS (PARTITION BY model, split ORDER BY s0 DESC)
), m AS (SELECT model, split, count(*) FILTER (score >= 0.5 AND label = 1) AS tp, count(*) FILTER (score >= 0.5 AND label = 0) AS fp, count(*) FILTER (score < 0.5 AND label = 1) AS fn,
  avg(power(score - label, 2)) AS b FROM al GROUP BY 1, 2
), metrics AS (SELECT model, split, 'average_precision' AS metric, sum(pos / nullif(positives, 0) * p) AS value FROM t GROUP BY 1, 2
  UNION ALL SELECT model, split, 'f1', 2 * tp / nullif(2 * tp + fp + fn, 0) FROM m UNION ALL SELECT model, split, 'brier', b FROM m)"""


def compared(spark: SparkSession, d: str) -> DataFrame:
    flags = pooled(spark, d)
    return ev.compare_models({"climatology": saved(rounded_scores(flags), "scores"), "persistence": persistence(flags)})


@query("f10_compare_models", sql("px_zf", COMPARED + " SELECT model, split, metric, round(value + 1e-7, 4) AS value FROM metrics"))
def f10(spark: SparkSession, d: str) -> DataFrame:
    return compared(spark, d).select("model", "split", "metric", r("value"))


@query(
    "f10_beats_baselines",
    sql("px_zf", COMPARED + """, x AS (SELECT max(value) FILTER (model = 'climatology') AS value, max(value) FILTER (model <> 'climatology') AS best_other FROM metrics WHERE metric = 'average_precision' AND split = 'test')
SELECT round(value + 1e-7, 4) AS value, round(best_other + 1e-7, 4) AS best_other, value > best_other AS beats FROM x"""),
)
def f10_beats(spark: SparkSession, d: str) -> DataFrame:
    return ev.beats_baselines(compared(spark, d), "climatology").select(r("value"), r("best_other"), "beats")


def saved_features(spark: SparkSession, d: str) -> DataFrame:
    """The feature table with strict flags, split, written and read back: models pass over it many times."""
    days = stored_days(spark, d, "temp_mean", "surface_pressure")
    return saved(split_features(spark, d, days, saved(strict(days), "strict_flags")), "features")


def split_features(spark: SparkSession, d: str, days: DataFrame, flags: DataFrame) -> DataFrame:
    rows = ft.feature_table(days, flags, dim_cities(proxies.cities(spark, d)))
    return ft.chronological_split(rows, TRAIN_END, VAL_END)


def small_model(rows: DataFrame):
    return ml.train(rows.filter("split = 'train'"), max_iter=5, depth=3)


@query("f10_model_verdict")
def f10_model(spark: SparkSession, d: str) -> DataFrame:
    """The trained model against both baselines, all on strict flags; ``beats`` is the verdict on the test split."""
    days = stored_days(spark, d, "temp_mean", "surface_pressure")
    flags = saved(strict(days), "strict_flags")
    rows = saved(split_features(spark, d, days, flags), "features")
    trees = ml.scored(small_model(rows), rows).select("split", "score", "label")
    metrics = ev.compare_models({"trees": saved(trees, "trees"), "climatology": saved(climate(flags), "scores"), "persistence": persistence(flags)})
    metrics = saved(metrics, "metrics")
    verdict = ev.beats_baselines(metrics, "trees").select("beats")
    return metrics.join(F.broadcast(verdict)).select("model", "split", "metric", r("value"), "beats")


@query("f3_train_predict")
def f3(spark: SparkSession, d: str) -> DataFrame:
    rows = saved_features(spark, d)
    return ml.scored(small_model(rows), rows.filter("split = 'test'")).select("city_id", "obs_date", "label", r("score"))


@query("f11_shapley_importance")
def f11(spark: SparkSession, d: str) -> DataFrame:
    """Every test row explained exactly against all training rows."""
    rows = saved_features(spark, d)
    train = rows.filter("split = 'train'")
    phi = tree_shapley(ml.train(train), rows.filter("split = 'test'"), train, ft.FEATURES)
    return ml.mean_importance(phi).select("feature", r("importance", 6))


@query("f12_permutation_importance")
def f12(spark: SparkSession, d: str) -> DataFrame:
    rows = saved_features(spark, d)
    return ml.permutation_importance(ml.train(rows.filter("split = 'train'")), rows.filter("split = 'validate'"), ft.FEATURES)


@query("f13_predict")
def f13(spark: SparkSession, d: str) -> DataFrame:
    rows = saved_features(spark, d)
    new = ml.predict(small_model(rows), rows.filter("split = 'test'"), "v2", "2026-02-02 00:00:00")
    old = new.withColumn("model_version", F.lit("v1")).withColumn("scored_at", F.lit("2026-01-01 00:00:00").cast("timestamp"))
    return ml.upsert_predictions(old, new).select("city_id", "forecast_date", r("risk_score"), "label", "model_version", "lead_days")


@query(
    "f13_store_predictions",
    sql("px_zf", ROUNDED + """, runs AS (SELECT city_id, obs_date AS forecast_date, score AS risk_score, 'v1' AS model_version, 1 AS run FROM c WHERE obs_date BETWEEN DATE '2000-01-01' AND DATE '2000-03-31'
  UNION ALL SELECT city_id, obs_date, round(score * 0.5, 6), 'v2', 2 FROM c WHERE obs_date BETWEEN DATE '2000-03-01' AND DATE '2000-04-30' AND city_id % 3 <> 0
  UNION ALL SELECT city_id, obs_date, 1.0, 'v0', 0 FROM c WHERE obs_date BETWEEN DATE '2000-02-10' AND DATE '2000-05-02' AND city_id % 2 = 0)
SELECT city_id, forecast_date, risk_score, CAST(risk_score >= 0.1 AS INTEGER) AS label, model_version FROM runs QUALIFY row_number() OVER (PARTITION BY city_id, forecast_date ORDER BY run DESC) = 1"""),
)
def f13_store(spark: SparkSession, d: str) -> DataFrame:
    """Three upserts of the stored fact table, one of them older than what it meets; the second is run twice."""
    rows, path = rounded(spark, d), scratch(spark, "predictions")

    def run(where: str, score, version: str, scored_at: str) -> DataFrame:
        s = F.round(score, 6)
        out = rows.filter(where).select("city_id", F.col("obs_date").alias("forecast_date"), s.alias("risk_score"), (s >= 0.1).cast("int").alias("label"))
        return out.withColumn("model_version", F.lit(version)).withColumn("scored_at", F.lit(scored_at).cast("timestamp"))

    first = run("obs_date BETWEEN DATE '2000-01-01' AND DATE '2000-03-31'", F.col("score"), "v1", "2026-01-02 00:00:00")
    second = run("obs_date BETWEEN DATE '2000-03-01' AND DATE '2000-04-30' AND city_id % 3 <> 0", F.col("score") * 0.5, "v2", "2026-01-03 00:00:00")
    older = run("obs_date BETWEEN DATE '2000-02-10' AND DATE '2000-05-02' AND city_id % 2 = 0", F.lit(1.0), "v0", "2026-01-01 00:00:00")
    for new in (first, second, older, second):
        ml.store_predictions(new, path)
    return ml.stored_predictions(spark, path, first).select("city_id", "forecast_date", "risk_score", "label", "model_version")


@query("f14_save_model")
def f14(spark: SparkSession, d: str) -> DataFrame:
    rows, path = saved_features(spark, d), scratch(spark, "model")
    meta = {"train_end": TRAIN_END, "features": ft.FEATURES, "seed": ml.SEED, "partitions": ml.PARTITIONS, "max_iter": 5, "depth": 3}
    trained = small_model(rows)
    measured = ev.pr_auc(ml.scored(trained, rows.filter("split = 'validate'"))).first()
    ml.save_model(trained, path, meta | {"metrics": {"validate_average_precision": measured["average_precision"]}})
    model, known = ml.load_model(path)
    out = ml.scored(model, rows.filter("split = 'test'"), known["features"])
    return out.select("city_id", "obs_date", r("score"))


EDGES = {"temp_mean": [20000.0, 60000.0, 120000.0], "humidity": [20.0, 40.0, 60.0]}


@query(
    "f15_drift",
    sql("px_daily", ", b AS (" + " UNION ALL ".join(
        f"SELECT '{c}' AS feature, year(obs_date) <= 1998 AS ref, " + " + ".join(f"CAST({c} >= {e} AS INTEGER)" for e in cuts) + " AS bucket FROM px_daily WHERE year(obs_date) <= 1998 OR year(obs_date) >= 2000" for c, cuts in EDGES.items()) + """
), n AS (SELECT feature, bucket, count(*) FILTER (ref) AS a, count(*) FILTER (NOT ref) AS c FROM b GROUP BY 1, 2
), q AS (SELECT feature, greatest(a, 0.5)::DOUBLE / sum(a) OVER w AS p, greatest(c, 0.5)::DOUBLE / sum(c) OVER w AS q FROM n WINDOW w AS (PARTITION BY feature))
SELECT feature, round(sum((q - p) * ln(q / p)) + 1e-7, 4) AS psi FROM q GROUP BY 1"""),
)
def f15(spark: SparkSession, d: str) -> DataFrame:
    rows = stored_days(spark, d, *EDGES)
    return ev.drift(rows.filter("year(obs_date) <= 1998"), rows.filter("year(obs_date) >= 2000"), EDGES).select("feature", r("psi"))


SKETCHED = ["temp_mean", "humidity", "surface_pressure"]


@query(
    "f15_drift_from_sketches",
    sql("px_daily", f""", v AS (SELECT year(obs_date) AS y, unnest({SKETCHED}) AS feature, unnest([{", ".join(SKETCHED)}]) AS x FROM px_daily
), e AS (SELECT feature, quantile_disc(x, {[i / 8 for i in range(1, 8)]}) AS edges FROM v WHERE y <= 1998 GROUP BY 1
), b AS (SELECT v.feature, y <= 1998 AS ref, CAST(x > edges[1] AS INTEGER) + CAST(x > edges[2] AS INTEGER) + CAST(x > edges[3] AS INTEGER) + CAST(x > edges[4] AS INTEGER)
    + CAST(x > edges[5] AS INTEGER) + CAST(x > edges[6] AS INTEGER) + CAST(x > edges[7] AS INTEGER) AS bucket FROM v JOIN e ON e.feature = v.feature WHERE y <= 1998 OR y >= 2000
), n AS (SELECT feature, bucket, count(*) FILTER (ref) AS a, count(*) FILTER (NOT ref) AS c FROM b GROUP BY 1, 2
), q AS (SELECT feature, greatest(a, 0.5)::DOUBLE / sum(a) OVER w AS p, greatest(c, 0.5)::DOUBLE / sum(c) OVER w AS q FROM n WINDOW w AS (PARTITION BY feature))
SELECT feature, round(sum((q - p) * ln(q / p)) + 1e-7, 4) AS psi FROM q GROUP BY 1"""),
)
def f15_sketches(spark: SparkSession, d: str) -> DataFrame:
    """Yearly sketches are stored once; edges and drift come from them. Sketches this large are exact up to 65,535 values."""
    yearly = saved(ev.sketches(daily(spark, d).withColumn("year", F.year("obs_date")), SKETCHED, k=65535), "sketches")
    return ev.sketch_drift(yearly.filter("year <= 1998"), yearly.filter("year >= 2000"), k=65535).select("feature", r("psi"))


# Marts


@query(
    "g1_global_anomaly_map",
    sql("px_zf px_cities", f"""SELECT city_id, name, round(latitude + 1e-7, 4) AS latitude, longitude, obs_date, round(z + 1e-7, 4) AS z, round(abs(z) + 1e-7, 4) AS magnitude, coalesce({FLAGS}, 'normal') AS state
FROM px_zf JOIN px_cities USING (city_id) WHERE z IS NOT NULL QUALIFY row_number() OVER (PARTITION BY city_id ORDER BY obs_date DESC) = 1"""),
)
def g1(spark: SparkSession, d: str) -> DataFrame:
    out = views.global_anomaly_map(pooled(spark, d), dim_cities(proxies.cities(spark, d)))
    return out.select("city_id", "name", r("latitude"), "longitude", "obs_date", r("z"), r("magnitude"), "state")


MATRIX = """, spine AS (SELECT c.city_id, CAST(unnest(range((SELECT min(year) FROM px_zf), (SELECT max(year) FROM px_zf) + 1)) AS INTEGER) AS year FROM (SELECT DISTINCT city_id FROM px_zf) c
), mx AS (SELECT s.city_id, s.year, count(*) FILTER (is_anomaly) AS anomaly_days FROM spine s LEFT JOIN px_zf z USING (city_id, year) GROUP BY 1, 2)"""


@query("g2_climate_matrix", sql("px_zf", MATRIX + " SELECT * FROM mx"))
def g2(spark: SparkSession, d: str) -> DataFrame:
    return views.climate_matrix(pooled(spark, d))


YEARS = list(range(1995, 2002))


@query("g2_climate_matrix_wide", sql("px_zf", MATRIX + " SELECT city_id, " + ", ".join(f'CAST(sum(anomaly_days) FILTER (year = {y}) AS BIGINT) AS "{y}"' for y in YEARS) + " FROM mx GROUP BY 1"))
def g2w(spark: SparkSession, d: str) -> DataFrame:
    return views.climate_matrix_wide(views.climate_matrix(pooled(spark, d)), YEARS)


@query("g3_extremes_trend", sql("px_zf", MATRIX + " SELECT city_id, round(regr_slope(anomaly_days, year) + 1e-7, 4) AS slope, CAST(sum(anomaly_days) AS BIGINT) AS total FROM mx GROUP BY 1"))
def g3(spark: SparkSession, d: str) -> DataFrame:
    return views.extremes_trend(views.climate_matrix(pooled(spark, d))).select("city_id", r("slope"), "total")


STORMS = f""", h AS (SELECT *, CAST(epoch(ts) AS BIGINT) AS s FROM px_hourly
), dr AS (SELECT *, max(pressure) OVER {W(back(86400), 'CURRENT ROW', 's')} - pressure AS fall FROM h
), st AS (SELECT city_id, CAST(ts AS DATE) AS date, max(fall) AS pressure_drop, max(wind_speed) AS peak_gust FROM dr GROUP BY 1, 2)"""


@query("g4_storm_dynamics", sql("px_hourly", STORMS + " SELECT city_id, date, round(pressure_drop + 1e-7, 4) AS pressure_drop, peak_gust FROM st"))
def g4(spark: SparkSession, d: str) -> DataFrame:
    return views.storm_dynamics(proxies.hourly(spark, d)).select("city_id", "date", r("pressure_drop"), "peak_gust")


GUSTS = """, gu AS (SELECT CAST(user_id % 15 AS INTEGER) AS city_id, CAST(ts AS DATE) AS date, 2 * max(value) AS wind_gust FROM events WHERE day(ts) % 2 = 0 GROUP BY 1, 2)"""


@query("g4_storm_dynamics_gusts", sql("px_hourly", STORMS + GUSTS + " SELECT city_id, date, round(pressure_drop + 1e-7, 4) AS pressure_drop, round(coalesce(wind_gust, peak_gust) + 1e-7, 4) AS peak_gust FROM st LEFT JOIN gu USING (city_id, date)"))
def g4_gusts(spark: SparkSession, d: str) -> DataFrame:
    """With a daily gust where there is one (even days), else the day's highest hourly wind."""
    events = proxies.table(spark, d, "events").filter("day(ts) % 2 = 0")
    gusts = events.groupBy((F.col("user_id") % 15).cast("int").alias("city_id"), F.to_date("ts").alias("date")).agg((2 * F.max("value")).alias("wind_gust"))
    return views.storm_dynamics(proxies.hourly(spark, d), gusts).select("city_id", "date", r("pressure_drop"), r("peak_gust"))


@query("g4_storm_correlation", sql("px_hourly", STORMS + " SELECT city_id, count(*) AS days, round(corr(pressure_drop, peak_gust) + 1e-7, 4) AS correlation FROM st GROUP BY 1"))
def g4c(spark: SparkSession, d: str) -> DataFrame:
    return views.storm_correlation(views.storm_dynamics(proxies.hourly(spark, d))).select("city_id", "days", r("correlation"))


AS_OF = "2000-06-30"
CELLS = """, cells AS (SELECT city_id, CAST(unnest(generate_series(obs_date + 1, obs_date + 7, INTERVAL 1 DAY)) AS DATE) AS target_date, score FROM c WHERE obs_date BETWEEN DATE '2000-06-24' AND DATE '2000-06-30'
), hz AS (SELECT city_id, target_date, max(score) AS risk FROM cells WHERE target_date > DATE '2000-06-30' GROUP BY 1, 2)"""


def scores(spark: SparkSession, d: str) -> DataFrame:
    return rounded(spark, d).select("city_id", F.col("obs_date").alias("forecast_date"), F.col("score").alias("risk_score"))


@query("g5_week_risk", sql("px_zf", ROUNDED + CELLS + " SELECT * FROM hz"))
def g5(spark: SparkSession, d: str) -> DataFrame:
    return views.week_risk(scores(spark, d), AS_OF)


@query("g5_week_risk_wide", sql("px_zf", ROUNDED + CELLS + " SELECT city_id, " + ", ".join(f"max(risk) FILTER (target_date - DATE '2000-06-30' = {i}) AS day{i}" for i in range(1, 8)) + " FROM hz GROUP BY 1"))
def g5w(spark: SparkSession, d: str) -> DataFrame:
    return views.week_risk_wide(views.week_risk(scores(spark, d), AS_OF), AS_OF)


@query("g6_top_risk", sql("px_zf", ROUNDED + " SELECT city_id, score AS risk_score, CAST(row_number() OVER (ORDER BY score DESC, city_id) AS INTEGER) AS rank FROM c WHERE obs_date = DATE '2000-06-30' ORDER BY rank LIMIT 5"))
def g6(spark: SparkSession, d: str) -> DataFrame:
    return views.top_risk(scores(spark, d), AS_OF)


# Streams


def event_stream(spark: SparkSession, d: str) -> DataFrame:
    """The events table as a file stream; event_id, ts, city_id, value."""
    schema = proxies.table(spark, d, "events").schema
    rows = spark.readStream.schema(schema).parquet(f"{d}/event[s].parquet")  # a glob: a single file is no base folder
    return rows.select("event_id", F.col("ts").cast("timestamp").alias("ts"), (F.col("user_id") % 15).cast("int").alias("city_id"), "value")


@query("s1_stream_land", "SELECT event_id, CAST(user_id % 15 AS INTEGER) AS city_id, value FROM events")
def s1(spark: SparkSession, d: str) -> DataFrame:
    path = scratch(spark, "landed")
    streams.stream_land(event_stream(spark, d), ["event_id"], "ts", path, scratch(spark, "state")).awaitTermination()
    return spark.read.parquet(path).select("event_id", "city_id", "value")


HOURS = "SELECT CAST(user_id % 15 AS INTEGER) AS city_id, strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') AS hour, round(avg(value) + 1e-7, 4) AS mean_value, max(value) AS max_value, count(*) AS n FROM events {} GROUP BY 1, 2"


@query("s2_stream_hourly", HOURS.format("WHERE date_trunc('hour', ts) + INTERVAL 1 HOUR <= (SELECT max(ts) - INTERVAL 1 HOUR FROM events)"))
def s2(spark: SparkSession, d: str) -> DataFrame:
    path = scratch(spark, "hours")
    streams.stream_hourly(event_stream(spark, d), path, scratch(spark, "state")).awaitTermination()
    return spark.read.parquet(path).select("city_id", F.date_format("hour", "yyyy-MM-dd HH:mm:ss").alias("hour"), r("mean_value"), "max_value", "n")


@query("s2_batch_hourly", HOURS.format(""))
def s2_batch(spark: SparkSession, d: str) -> DataFrame:
    events = proxies.table(spark, d, "events").withColumn("city_id", (F.col("user_id") % 15).cast("int"))
    return streams.hourly(events).select("city_id", F.date_format("hour", "yyyy-MM-dd HH:mm:ss").alias("hour"), r("mean_value"), "max_value", "n")


@query("s3_stream_upsert_silver", "SELECT city_id, event_id, value FROM (SELECT CAST(user_id % 15 AS INTEGER) AS city_id, event_id, value, ts FROM events) QUALIFY row_number() OVER (PARTITION BY city_id ORDER BY ts DESC, event_id DESC) = 1")
def s3(spark: SparkSession, d: str) -> DataFrame:
    bronze = scratch(spark, "bronze")
    q = streams.stream_upsert_silver(event_stream(spark, d), ["city_id", "ts"], ["event_id", "value"], "ts", "ts", bronze, scratch(spark, "late"), scratch(spark, "state"))
    q.awaitTermination()
    return streams.silver_of(spark.read.parquet(bronze), ["city_id"], "ts", ["event_id"]).select("city_id", "event_id", "value")


@query("s3_stream_versions", "SELECT city_id, event_id, value FROM (SELECT CAST(user_id % 15 AS INTEGER) AS city_id, event_id, value, ts FROM events) QUALIFY row_number() OVER (PARTITION BY city_id ORDER BY ts DESC, event_id DESC) = 1")
def s3_keyed(spark: SparkSession, d: str) -> DataFrame:
    """Silver from the keyed stream: versions are told from state, nothing that was written is read again."""
    key, path = "spark.sql.streaming.stateStore.providerClass", scratch(spark, "versions")
    before = spark.conf.get(key, None)
    spark.conf.set(key, streams.STATE_STORE)
    try:
        streams.stream_versions(event_stream(spark, d), ["city_id", "ts"], ["event_id", "value"], "ts", "ts", path, scratch(spark, "state")).awaitTermination()
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)
    return streams.silver_of(spark.read.parquet(path).filter("is_late = 0"), ["city_id"], "ts", ["event_id"]).select("city_id", "event_id", "value")
