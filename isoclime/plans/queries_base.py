"""Registered queries of the landing, silver, gold and quality operators, each with its SQL counterpart."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from isoclime.operators import checks, cleaning, star
from isoclime.session import scratch, scratch_table
from isoclime.sources import landing, proxies
from isoclime.sources.proxies import MEASURES, sql

QUERIES: dict = {}
ORACLES: dict[str, str] = {}
START, END = "1995-01-01", "2000-12-31"


def query(name: str, oracle: str | None = None):
    def register(f):
        QUERIES[name] = f
        if oracle:
            ORACLES[name] = oracle
        return f

    return register


def r(name: str, digits: int = 4):
    """Rounded, after a nudge far above summing errors and far below a digit: exact ties fall alike in both engines."""
    return F.round(F.col(name) + 10.0 ** -(digits + 3), digits).alias(name)


def stamp(c: str, out: str):
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias(out)


def span(df: DataFrame, day: str = "obs_date") -> tuple[str, str]:
    row = df.agg(F.min(day).cast("string"), F.max(day).cast("string")).first()
    return row[0], row[1]


EXPECTED = """, grid AS (
  SELECT city_id, CAST(year AS INTEGER) AS year,
         CAST(greatest(least(make_date(year, 12, 31), DATE '2000-12-31') - greatest(make_date(year, 1, 1), DATE '1995-01-01') + 1, 0) AS INTEGER) AS n
  FROM px_cities CROSS JOIN (SELECT unnest(range(1995, 2001)) AS year)
), have AS (
  SELECT city_id, CAST(year(obs_date) AS INTEGER) AS year, count(DISTINCT obs_date) AS actual FROM px_daily
  WHERE obs_date BETWEEN DATE '1995-01-01' AND DATE '2000-12-31' {} GROUP BY 1, 2
)"""


@query(
    "a1_backfill_plan",
    sql("px_cities px_daily", EXPECTED.format("AND NOT (city_id % 4 = 0 AND year(obs_date) = 1997)") + """
SELECT city_id, year, n AS n_expected FROM grid LEFT JOIN have USING (city_id, year) WHERE coalesce(actual, 0) <> n"""),
)
def a1(spark: SparkSession, d: str) -> DataFrame:
    landed = proxies.daily(spark, d).filter(~((F.col("city_id") % 4 == 0) & (F.year("obs_date") == 1997)))
    return landing.backfill_plan(proxies.cities(spark, d), landed, START, END)


@query("a2_read_payloads", "SELECT CAST(user_id % 15 AS INTEGER) AS city_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS time, value FROM events")
def a2(spark: SparkSession, d: str) -> DataFrame:
    path = scratch(spark, "payloads")
    write_payloads(spark, d).write.option("compression", "gzip").json(path)
    got = landing.read_payloads(spark, path, "hourly", ["value"])
    return got.select("city_id", stamp("time", "time"), "value")


def write_payloads(spark: SparkSession, d: str) -> DataFrame:
    e = proxies.table(spark, d, "events").withColumn("t", F.col("ts").cast("timestamp"))
    rows = F.array_sort(F.collect_list(F.struct(F.date_format("t", "yyyy-MM-dd'T'HH:mm:ss").alias("time"), "value")))
    packs = e.groupBy((F.col("user_id") % 15).cast("int").alias("city_id"), F.to_date("t").alias("_d")).agg(rows.alias("r"))
    return packs.select("city_id", F.struct(F.col("r.time").alias("time"), F.col("r.value").alias("value")).alias("hourly"))


@query("a3_parse_payload_errors")
def a3(spark: SparkSession, d: str) -> DataFrame:
    path = scratch(spark, "payloads")
    text = write_payloads(spark, d).select("city_id", F.to_json(F.struct("city_id", "hourly")).alias("j"))
    broken = F.when(F.col("city_id") % 5 == 0, F.expr("left(j, length(j) - 5)")).otherwise(F.col("j"))
    text.select(broken.alias("value")).write.option("compression", "gzip").text(path)
    return landing.parse_payload_errors(spark, path, "hourly", ["value"]).select("payload")


@query("a4_land", sql("px_bronze", "SELECT city_id, obs_date, temp_mean, seq, CAST(year(obs_date) AS INTEGER) AS year, source_url, '2026-02-01 00:00:00' AS landed_at FROM px_bronze"))
def a4(spark: SparkSession, d: str) -> DataFrame:
    path = scratch(spark, "bronze")
    landing.land(proxies.bronze(spark, d).drop("ingested_at"), path, "2026-02-01 00:00:00")
    got = spark.read.parquet(path)
    return got.select("city_id", "obs_date", "temp_mean", "seq", "year", "source_url", stamp("ingested_at", "landed_at"))


@query("a4_land_hourly", sql("px_hourly", "SELECT city_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts, wind_speed, pressure, temperature, CAST(year(ts) AS INTEGER) AS year, 'https://archive.example/hourly' AS source_url, '2026-02-01 00:00:00' AS landed_at FROM px_hourly"))
def a4_hourly(spark: SparkSession, d: str) -> DataFrame:
    """Hourly rows, landed in two deliveries."""
    path, hours = scratch(spark, "bronze_hourly"), proxies.hourly(spark, d)
    for part in ("day(ts) <= 15", "day(ts) > 15"):
        landing.land(hours.filter(part), path, "2026-02-01 00:00:00", "https://archive.example/hourly", day="ts")
    return spark.read.parquet(path).select("city_id", stamp("ts", "ts"), "wind_speed", "pressure", "temperature", "year", "source_url", stamp("ingested_at", "landed_at"))


@query(
    "a5_new_rows",
    sql("px_bronze", """SELECT DISTINCT city_id, obs_date, temp_mean FROM px_bronze b WHERE NOT EXISTS (
  SELECT 1 FROM px_bronze e WHERE e.seq = 1 AND e.city_id = b.city_id AND e.obs_date = b.obs_date AND e.temp_mean = b.temp_mean)"""),
)
def a5(spark: SparkSession, d: str) -> DataFrame:
    raw = proxies.bronze(spark, d)
    fresh = landing.new_rows(raw, raw.filter("seq = 1"), ["city_id", "obs_date"], ["temp_mean"])
    return fresh.select("city_id", "obs_date", "temp_mean")


@query("a6_overwrite_chunks", sql("px_daily", "SELECT city_id, obs_date, CASE WHEN city_id = 1 AND year(obs_date) = 1997 THEN temp_mean * 2 ELSE temp_mean END AS temp_mean FROM px_daily"))
def a6(spark: SparkSession, d: str) -> DataFrame:
    path = scratch(spark, "chunks")
    all_ = proxies.daily(spark, d).select("city_id", "obs_date", "temp_mean", F.year("obs_date").alias("year"))
    landing.overwrite_chunks(all_, path)
    landing.overwrite_chunks(all_.filter("city_id = 1 AND year = 1997").withColumn("temp_mean", F.col("temp_mean") * 2), path)
    return spark.read.parquet(path).select("city_id", "obs_date", "temp_mean")


@query("a7_missing_dates", sql("px_spine", "SELECT city_id, obs_date FROM px_spine WHERE temp_mean IS NULL"))
def a7(spark: SparkSession, d: str) -> DataFrame:
    return cleaning.missing_dates(proxies.daily(spark, d))


@query(
    "a7_gap_islands",
    sql("px_spine", """, g AS (SELECT city_id, obs_date, obs_date - CAST(row_number() OVER (PARTITION BY city_id ORDER BY obs_date) AS INTEGER) AS run
  FROM px_spine WHERE temp_mean IS NULL)
SELECT city_id, min(obs_date) AS start, max(obs_date) AS "end", count(*) AS length FROM g GROUP BY city_id, run"""),
)
def a7_islands(spark: SparkSession, d: str) -> DataFrame:
    return cleaning.islands(cleaning.missing_dates(proxies.daily(spark, d)))


@query(
    "a8_reconcile_counts",
    sql("px_cities px_daily", EXPECTED.format("") + """
SELECT city_id, year, n AS expected, coalesce(actual, 0) AS actual, n = coalesce(actual, 0) AS ok FROM grid LEFT JOIN have USING (city_id, year)"""),
)
def a8(spark: SparkSession, d: str) -> DataFrame:
    return landing.reconcile_counts(proxies.daily(spark, d), proxies.cities(spark, d), START, END)


@query("a9_pivot_long", sql("px_daily", "SELECT city_id, obs_date, temp_mean, wind_gust, humidity FROM px_daily"))
def a9(spark: SparkSession, d: str) -> DataFrame:
    wide = proxies.daily(spark, d).select("city_id", "obs_date", "temp_mean", "wind_gust", "humidity")
    long = wide.unpivot(["city_id", "obs_date"], ["temp_mean", "wind_gust", "humidity"], "element", "value")
    return landing.pivot_long(long, ["temp_mean", "wind_gust", "humidity"])


@query(
    "a10_corrupt",
    sql("px_daily", """, t AS (SELECT city_id, obs_date, temp_mean, city_id * 31 + (obs_date - DATE '1970-01-01') AS turn FROM px_daily)
SELECT city_id, obs_date, round(CASE WHEN turn % 13 = 0 THEN NULL WHEN turn % 17 = 0 THEN temp_mean * 9 / 5 + 32 ELSE temp_mean END + 1e-7, 4) AS temp_mean,
       CASE WHEN turn % 13 = 0 THEN 'null' WHEN turn % 17 = 0 THEN 'fahrenheit' ELSE 'none' END AS synthetic_fault FROM t
UNION ALL SELECT city_id, obs_date, round(temp_mean + 1e-7, 4), 'duplicate' FROM t WHERE turn % 11 = 0"""),
)
def a10(spark: SparkSession, d: str) -> DataFrame:
    return landing.corrupt(proxies.daily(spark, d)).select("city_id", "obs_date", r("temp_mean"), "synthetic_fault")


@query(
    "a10_corrupt_hourly",
    sql("px_hourly px_cities", """, t AS (SELECT h.city_id, ts, wind_speed, pressure, timezone AS tz, h.city_id * 31 + CAST(floor(epoch(ts) / 3600) AS BIGINT) + 5 AS turn FROM px_hourly h JOIN px_cities c ON c.city_id = h.city_id
), k AS (SELECT *, CASE WHEN turn % 13 = 0 THEN 'null' WHEN turn % 9 = 0 THEN 'miles' WHEN turn % 19 = 0 THEN 'local_time' ELSE 'none' END AS fault FROM t
), u AS (SELECT city_id, CASE WHEN fault = 'local_time' THEN timezone(tz, timezone('UTC', ts)) ELSE ts END AS stamp, CASE WHEN fault = 'miles' THEN wind_speed * 5 / 8 ELSE wind_speed END AS wind_speed,
    CASE WHEN fault <> 'null' THEN pressure END AS pressure, fault AS synthetic_fault FROM k UNION ALL SELECT city_id, ts, wind_speed, pressure, 'duplicate' FROM t WHERE turn % 11 = 0)
SELECT city_id, strftime(stamp, '%Y-%m-%d %H:%M:%S') AS stamp, round(wind_speed + 1e-7, 4) AS wind_speed, round(pressure + 1e-7, 4) AS pressure, synthetic_fault FROM u"""),
)
def a10_hourly(spark: SparkSession, d: str) -> DataFrame:
    rows = proxies.hourly(spark, d).join(proxies.cities(spark, d).select("city_id", "timezone"), "city_id")
    bad = landing.corrupt(rows, "pressure", seed=5, every={"miles": 9}, units={"wind_speed": ("miles", 5, 8, 0)}, stamp="ts", zone="timezone")
    return bad.select("city_id", F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("stamp"), r("wind_speed"), r("pressure"), "synthetic_fault")


@query("a11_export_csv", sql("px_daily", "SELECT city_id, obs_date, temp_mean FROM px_daily"))
def a11(spark: SparkSession, d: str) -> DataFrame:
    path = scratch(spark, "csv")
    landing.export_csv(proxies.daily(spark, d).select("city_id", "obs_date", "temp_mean"), path)
    return spark.read.schema("city_id int, obs_date date, temp_mean double").option("header", True).csv(path)


@query("a12_promote", sql("px_cities", "SELECT city_id, name, latitude, timezone FROM px_cities"))
def a12(spark: SparkSession, d: str) -> DataFrame:
    target = scratch(spark, "serving")
    landing.promote(star.dim_cities(proxies.cities(spark, d)), target, "dim_cities")
    return spark.read.parquet(f"{target}/dim_cities").select("city_id", "name", "latitude", "timezone")


@query("a13_stage_counts", sql("px_daily", "SELECT 'daily' AS stage, count(*) AS n FROM px_daily"))
def a13(spark: SparkSession, d: str) -> DataFrame:
    seen, count = landing.stage_counts(proxies.daily(spark, d), "daily")
    seen.write.format("noop").mode("overwrite").save()
    return spark.createDataFrame([("daily", count())], "stage string, n long")


@query("b1_dedup_latest", sql("px_bronze", "SELECT city_id, obs_date, temp_mean, seq FROM px_bronze QUALIFY row_number() OVER (PARTITION BY city_id, obs_date ORDER BY ingested_at DESC, seq DESC) = 1"))
def b1(spark: SparkSession, d: str) -> DataFrame:
    return cleaning.dedup_latest(proxies.bronze(spark, d), ["city_id", "obs_date"], ["ingested_at"], ["seq"]).select("city_id", "obs_date", "temp_mean", "seq")


def stamped(spark: SparkSession, d: str) -> DataFrame:
    e = proxies.table(spark, d, "events")
    return e.select("event_id", F.col("ts").cast("timestamp").alias("ts"), (F.col("user_id") % 25).cast("int").alias("city_id"))


STAMPED = ", e AS (SELECT event_id, ts, c.city_id, timezone AS tz FROM events JOIN px_cities c ON user_id % 25 = c.city_id)"


@query("b2_to_utc", sql("px_cities", STAMPED + " SELECT event_id, strftime(timezone('UTC', timezone(tz, ts)), '%Y-%m-%d %H:%M:%S') AS ts_utc FROM e"))
def b2(spark: SparkSession, d: str) -> DataFrame:
    rows = stamped(spark, d).join(proxies.cities(spark, d), "city_id")
    return cleaning.to_utc(rows, "ts", "timezone").select("event_id", stamp("ts_utc", "ts_utc"))


@query(
    "b3_local_view",
    sql("px_cities", STAMPED + """, l AS (SELECT event_id, timezone(tz, timezone('UTC', ts)) AS lt FROM e)
SELECT event_id, strftime(lt, '%Y-%m-%d %H:%M:%S') AS local_ts, CAST(lt AS DATE) AS local_date FROM l"""),
)
def b3(spark: SparkSession, d: str) -> DataFrame:
    return cleaning.local_view(stamped(spark, d), proxies.cities(spark, d)).select("event_id", stamp("local_ts", "local_ts"), "local_date")


@query(
    "b4_dst_audit",
    sql("px_cities px_daily", """, h AS (SELECT city_id, timezone AS tz, unnest(generate_series(TIMESTAMP '1999-01-01', TIMESTAMP '1999-12-31 23:00', INTERVAL 1 HOUR)) AS ts
  FROM px_cities WHERE city_id IN (SELECT city_id FROM px_daily WHERE year(obs_date) = 1999)
), l AS (SELECT city_id, ts, timezone(tz, timezone('UTC', ts)) AS lt FROM h
), o AS (SELECT city_id, CAST(lt AS DATE) AS local_date, ts, CAST(epoch(lt) - epoch(ts) AS INTEGER) AS off FROM l
), c AS (SELECT city_id, local_date, off - lag(off) OVER (PARTITION BY city_id ORDER BY ts) AS change FROM o)
SELECT city_id, local_date, change, CAST(24 - change / 3600 AS INTEGER) AS hours FROM c WHERE change <> 0"""),
)
def b4(spark: SparkSession, d: str) -> DataFrame:
    hours = F.explode(F.expr("sequence(TIMESTAMP '1999-01-01', TIMESTAMP '1999-12-31 23:00:00', INTERVAL '1' HOUR)"))
    seen = proxies.daily(spark, d).filter("year(obs_date) = 1999").select("city_id").distinct()
    return cleaning.dst_audit(seen.withColumn("ts", hours), proxies.cities(spark, d))


RANGES = {"temp_mean": (0, 150000), "humidity": (0, 75), "surface_pressure": (1001, 1009)}


@query(
    "b5_assert_units",
    sql("px_daily", "SELECT * FROM (" + " UNION ALL ".join(
        f"SELECT city_id, obs_date, '{v}' AS variable, {v} AS value, {lo}::DOUBLE AS low, {hi}::DOUBLE AS high FROM px_daily WHERE {v} < {lo} OR {v} > {hi}" for v, (lo, hi) in RANGES.items()) + ")"),
)
def b5(spark: SparkSession, d: str) -> DataFrame:
    return cleaning.assert_units(proxies.daily(spark, d), RANGES)


@query(
    "b6_unit_consistency",
    sql("px_bronze", """, s AS (SELECT city_id, seq, avg(temp_mean) AS m, stddev_samp(temp_mean) AS sd, count(temp_mean) AS n FROM px_bronze GROUP BY 1, 2)
SELECT a.city_id, a.seq AS seq_a, b.seq AS seq_b, a.n AS n_a, b.n AS n_b, round(b.m / a.m + 1e-7, 4) AS mean_ratio, round(b.sd / a.sd + 1e-7, 4) AS sd_ratio
FROM s a JOIN s b ON a.city_id = b.city_id AND a.seq < b.seq"""),
)
def b6(spark: SparkSession, d: str) -> DataFrame:
    out = cleaning.unit_consistency(proxies.bronze(spark, d), "temp_mean", "seq")
    return out.select("city_id", "seq_a", "seq_b", "n_a", "n_b", r("mean_ratio"), r("sd_ratio"))


@query("b7_convert_units", sql("px_daily", "SELECT city_id, obs_date, round((temp_mean - 32) * 5.0 / 9 + 1e-7, 4) AS temp_mean, round(wind_speed * 1852.0 / 3600 + 1e-7, 4) AS wind_speed FROM px_daily"))
def b7(spark: SparkSession, d: str) -> DataFrame:
    out = cleaning.convert_units(proxies.daily(spark, d), {"temp_mean": "fahrenheit", "wind_speed": "knots"})
    return out.select("city_id", "obs_date", r("temp_mean"), r("wind_speed"))


@query(
    "b8_null_profile",
    sql("px_spine", "SELECT * FROM (" + " UNION ALL ".join(
        f"SELECT city_id, CAST(year(obs_date) AS INTEGER) AS year, count(*) AS n_rows, '{v}' AS variable, count(*) - count({v}) AS n_null, round((count(*) - count({v}))::DOUBLE / count(*) + 1e-7, 4) AS null_rate FROM px_spine GROUP BY 1, 2"
        for v in ("temp_mean", "humidity")) + ")"),
)
def b8(spark: SparkSession, d: str) -> DataFrame:
    out = cleaning.null_profile(proxies.spine(spark, d), ["temp_mean", "humidity"])
    return out.select("city_id", "year", "n_rows", "variable", "n_null", r("null_rate"))


@query(
    "b9_enforce_contract",
    sql("px_bronze", """SELECT city_id, obs_date, CASE WHEN city_id % 5 <> 0 THEN seq END AS seq, CAST(city_id % 5 = 0 AS INTEGER) AS n_bad FROM px_bronze"""),
)
def b9(spark: SparkSession, d: str) -> DataFrame:
    raw = proxies.bronze(spark, d)
    text = raw.select(F.col("city_id").cast("string"), F.col("obs_date").cast("string"), F.when(F.col("city_id") % 5 == 0, "n/a").otherwise(F.col("seq").cast("string")).alias("seq"), "source_url")
    return cleaning.enforce_contract(text, StructType.fromDDL("city_id int NOT NULL, obs_date date NOT NULL, seq int"))


@query("b10_densify", sql("px_spine", "SELECT city_id, obs_date, temp_mean, humidity FROM px_spine"))
def b10(spark: SparkSession, d: str) -> DataFrame:
    return proxies.spine(spark, d).select("city_id", "obs_date", "temp_mean", "humidity")


DIM_DATE = """, dim_date AS (SELECT obs_date AS date, CAST(year(obs_date) * 10000 + month(obs_date) * 100 + day(obs_date) AS INTEGER) AS date_key,
  CAST(year(obs_date) AS INTEGER) AS year, CAST(quarter(obs_date) AS INTEGER) AS quarter, CAST(month(obs_date) AS INTEGER) AS month,
  CAST(day(obs_date) AS INTEGER) AS day, CAST(weekofyear(obs_date) AS INTEGER) AS iso_week, CAST(isodow(obs_date) AS INTEGER) AS day_of_week,
  CAST(dayofyear(make_date(2000, month(obs_date), day(obs_date))) AS INTEGER) AS slot,
  (year(obs_date) % 4 = 0 AND year(obs_date) % 100 <> 0) OR year(obs_date) % 400 = 0 AS is_leap FROM px_days)"""


def dates(spark: SparkSession, d: str) -> DataFrame:
    return star.dim_date(spark, *span(proxies.daily(spark, d)))


@query("c1_dim_date", sql("px_days", DIM_DATE + " SELECT * FROM dim_date"))
def c1(spark: SparkSession, d: str) -> DataFrame:
    return dates(spark, d)


SEASON = """CASE WHEN climate_regime = 'none' THEN 'all_year'
  WHEN climate_regime = 'wet_dry' THEN CASE WHEN m BETWEEN 5 AND 10 THEN 'wet' ELSE 'dry' END
  WHEN m IN (12, 1, 2) THEN 'winter' WHEN m IN (3, 4, 5) THEN 'spring' WHEN m IN (6, 7, 8) THEN 'summer' ELSE 'autumn' END"""


@query(
    "c2_city_seasons",
    sql("px_cities px_days", f""", g AS (SELECT city_id, obs_date AS date, climate_regime,
  CASE WHEN latitude >= 0 THEN month(obs_date) ELSE (month(obs_date) + 5) % 12 + 1 END AS m FROM px_cities CROSS JOIN px_days)
SELECT city_id, date, {SEASON} AS season FROM g"""),
)
def c2(spark: SparkSession, d: str) -> DataFrame:
    return star.city_seasons(proxies.cities(spark, d), dates(spark, d))


@query("c3_dim_cities", sql("px_cities", "SELECT * FROM px_cities"))
def c3(spark: SparkSession, d: str) -> DataFrame:
    return star.dim_cities(proxies.cities(spark, d))


@query(
    "c4_fact_daily",
    sql("px_daily px_cities", f"""SELECT city_id, CAST(year(obs_date) * 10000 + month(obs_date) * 100 + day(obs_date) AS INTEGER) AS date_key, obs_date AS date, {', '.join(MEASURES)}
FROM px_daily JOIN px_cities USING (city_id)"""),
)
def c4(spark: SparkSession, d: str) -> DataFrame:
    return star.fact_daily(proxies.daily(spark, d), proxies.cities(spark, d), MEASURES)


@query("c5_fact_hourly", sql("px_hourly", "SELECT city_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts, wind_speed, pressure, temperature FROM px_hourly WHERE ts > TIMESTAMP '2024-01-15'"))
def c5(spark: SparkSession, d: str) -> DataFrame:
    out = star.fact_hourly(proxies.hourly(spark, d), 24, "2026-01-15 00:00:00")
    return out.select("city_id", stamp("ts", "ts"), "wind_speed", "pressure", "temperature")


@query("c5_fact_hourly_newest", sql("px_hourly", "SELECT city_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts, wind_speed FROM px_hourly WHERE ts > (SELECT max(ts) - INTERVAL 24 MONTH FROM px_hourly)"))
def c5_newest(spark: SparkSession, d: str) -> DataFrame:
    return star.fact_hourly(proxies.hourly(spark, d), 24).select("city_id", stamp("ts", "ts"), "wind_speed")


@query(
    "c6_star_join",
    sql("px_daily px_cities px_days", DIM_DATE + """
SELECT city_id, p.obs_date AS date, temp_mean, name, region, quarter, iso_week, slot FROM px_daily p JOIN px_cities USING (city_id) JOIN dim_date d ON d.date = p.obs_date"""),
)
def c6(spark: SparkSession, d: str) -> DataFrame:
    cities = star.dim_cities(proxies.cities(spark, d))
    fact = star.fact_daily(proxies.daily(spark, d), cities, ["temp_mean"])
    return star.star_join(fact, cities, dates(spark, d)).select("city_id", "date", "temp_mean", "name", "region", "quarter", "iso_week", "slot")


@query(
    "c6_star_join_left",
    sql("px_daily px_cities px_days", DIM_DATE + """
SELECT p.city_id, p.obs_date AS date, temp_mean, name, quarter FROM px_daily p LEFT JOIN (SELECT * FROM px_cities WHERE city_id % 4 <> 1) c USING (city_id)
LEFT JOIN (SELECT * FROM dim_date WHERE quarter <> 2) d ON d.date = p.obs_date"""),
)
def c6_left(spark: SparkSession, d: str) -> DataFrame:
    """Facts of places and days that the dimensions lack are kept, with nulls."""
    cities = star.dim_cities(proxies.cities(spark, d))
    fact = star.fact_daily(proxies.daily(spark, d), cities, ["temp_mean"])
    joined = star.star_join(fact, cities.filter("city_id % 4 <> 1"), dates(spark, d).filter("quarter <> 2"), "left")
    return joined.select("city_id", "date", "temp_mean", "name", "quarter")


@query(
    "c6_star_join_stored",
    sql("px_daily px_cities px_days", DIM_DATE + """
SELECT city_id, p.obs_date AS date, temp_mean, name, quarter, CAST(year(p.obs_date) AS INTEGER) AS year FROM px_daily p JOIN px_cities USING (city_id) JOIN dim_date d ON d.date = p.obs_date
WHERE d.is_leap AND quarter = 1"""),
)
def c6_stored(spark: SparkSession, d: str) -> DataFrame:
    """The stored fact: a filter on the calendar leaves the folders of leap years alone to be read."""
    cities = star.dim_cities(proxies.cities(spark, d))
    fact = star.write_gold(star.fact_daily(proxies.daily(spark, d), cities, ["temp_mean"]), scratch_table("fact"), scratch(spark, "fact"), 8)
    joined = star.star_join(fact, cities, dates(spark, d).filter("is_leap AND quarter = 1"))
    return joined.select("city_id", "date", "temp_mean", "name", "quarter", "year")


def history(spark: SparkSession, d: str) -> DataFrame:
    seed = star.dim_cities(proxies.cities(spark, d))
    first = star.open_history(seed, ["city_id"], ["name", "population"], "1995-01-01")
    later = seed.filter("city_id <> 3").withColumn("population", F.when(F.col("city_id") % 2 == 0, F.col("population") + 1000).otherwise(F.col("population")))
    extra = seed.filter("city_id = 4").withColumn("city_id", F.col("city_id") + 100)
    return star.scd2_snapshot(first, later.unionByName(extra), ["city_id"], ["name", "population"], "1998-06-01")


HISTORY = """, hist AS (
  SELECT city_id, name, population, DATE '1995-01-01' AS valid_from, CASE WHEN city_id = 3 OR city_id % 2 = 0 THEN DATE '1998-06-01' END AS valid_to FROM px_cities
  UNION ALL SELECT city_id, name, population + 1000, DATE '1998-06-01', NULL FROM px_cities WHERE city_id % 2 = 0
  UNION ALL SELECT city_id + 100, name, population, DATE '1998-06-01', NULL FROM px_cities WHERE city_id = 4)"""


@query("c7_scd2_snapshot", sql("px_cities", HISTORY + " SELECT * FROM hist"))
def c7(spark: SparkSession, d: str) -> DataFrame:
    return history(spark, d)


@query(
    "c8_as_of_dim",
    sql("px_cities px_daily", HISTORY + """
SELECT p.city_id, p.obs_date, h.population, h.valid_from FROM px_daily p
LEFT JOIN hist h ON h.city_id = p.city_id AND h.valid_from <= p.obs_date AND (h.valid_to IS NULL OR p.obs_date < h.valid_to)"""),
)
def c8(spark: SparkSession, d: str) -> DataFrame:
    return star.as_of_dim(proxies.daily(spark, d), history(spark, d), ["city_id"], "obs_date").select("city_id", "obs_date", "population", "valid_from")


@query("h1_check_unique", "SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1")
def h1(spark: SparkSession, d: str) -> DataFrame:
    return checks.check_unique(proxies.table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("h2_check_not_null", sql("px_spine", "SELECT city_id, obs_date, 'temp_mean,humidity' AS null_columns FROM px_spine WHERE temp_mean IS NULL"))
def h2(spark: SparkSession, d: str) -> DataFrame:
    return checks.check_not_null(proxies.spine(spark, d), ["city_id", "temp_mean", "humidity"]).select("city_id", "obs_date", "null_columns")


@query("h3_check_relationship", sql("px_daily px_cities", "SELECT city_id, obs_date FROM px_daily WHERE city_id NOT IN (SELECT city_id FROM px_cities WHERE city_id % 6 <> 0)"))
def h3(spark: SparkSession, d: str) -> DataFrame:
    return checks.check_relationship(proxies.daily(spark, d).select("city_id", "obs_date"), proxies.cities(spark, d).filter("city_id % 6 <> 0"), "city_id")


@query("h4_check_accepted", "SELECT event_id, event_type FROM events WHERE event_type NOT IN ('click', 'view')")
def h4(spark: SparkSession, d: str) -> DataFrame:
    return checks.check_accepted(proxies.table(spark, d, "events"), "event_type", ["click", "view"]).select("event_id", "event_type")


EXPECTATIONS = [
    {"kind": "range", "column": "humidity", "low": 0, "high": 75},
    {"kind": "not_null", "column": "temp_mean"},
    {"kind": "rows", "low": 1, "high": 10**9},
    {"kind": "mean", "column": "wind_speed", "low": 100, "high": 200},
]


@query(
    "h5_check_expectations",
    sql("px_daily", """, e AS (SELECT unnest(['range(humidity)', 'not_null(temp_mean)', 'rows', 'mean(wind_speed)']) AS expectation,
  unnest([count(*) FILTER (humidity NOT BETWEEN 0 AND 75), count(*) FILTER (temp_mean IS NULL), CASE WHEN count(*) >= 1 THEN 0 ELSE 1 END,
          CASE WHEN avg(wind_speed) BETWEEN 100 AND 200 THEN 0 ELSE 1 END]) AS failing FROM px_daily)
SELECT expectation, CAST(failing AS BIGINT) AS failing, failing = 0 AS ok FROM e"""),
)
def h5(spark: SparkSession, d: str) -> DataFrame:
    return checks.check_expectations(proxies.daily(spark, d), EXPECTATIONS)


ORDER_EXPECTATIONS = [
    {"kind": "regex", "column": "event_type", "pattern": "^(click|view)$"},
    {"kind": "monotone", "column": "ts", "by": ["user_id"], "order": ["event_id"]},
    {"kind": "monotone", "column": "value", "by": ["user_id"], "order": ["event_id"]},
]


@query(
    "h5_order_expectations",
    """WITH e AS (SELECT *, ts < lag(ts) OVER w AS falls_ts, value < lag(value) OVER w AS falls_value FROM events WINDOW w AS (PARTITION BY user_id ORDER BY event_id)
), c AS (SELECT unnest(['regex(event_type)', 'monotone(ts)', 'monotone(value)']) AS expectation,
  unnest([count(*) FILTER (NOT regexp_matches(event_type, '^(click|view)$')), count(*) FILTER (falls_ts), count(*) FILTER (falls_value)]) AS failing FROM e)
SELECT expectation, CAST(failing AS BIGINT) AS failing, failing = 0 AS ok FROM c""",
)
def h5_order(spark: SparkSession, d: str) -> DataFrame:
    return checks.check_expectations(proxies.table(spark, d, "events"), ORDER_EXPECTATIONS)


@query(
    "h6_run_suite",
    sql("px_daily px_cities", """, k AS (
  SELECT 'unique' AS "check", 'daily' AS table_name, (SELECT count(*) FROM (SELECT 1 FROM px_daily GROUP BY city_id, obs_date HAVING count(*) > 1)) AS failing
  UNION ALL SELECT 'relationship', 'daily', (SELECT count(*) FROM px_daily WHERE city_id NOT IN (SELECT city_id FROM px_cities))
  UNION ALL SELECT 'unique', 'lineitem', (SELECT count(*) FROM (SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)))
SELECT "check", table_name, failing, failing = 0 AS ok FROM k"""),
)
def h6(spark: SparkSession, d: str) -> DataFrame:
    daily = proxies.daily(spark, d)
    suite = [
        ("unique", "daily", checks.check_unique(daily, ["city_id", "obs_date"])),
        ("relationship", "daily", checks.check_relationship(daily, proxies.cities(spark, d), "city_id")),
        ("unique", "lineitem", checks.check_unique(proxies.table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"])),
    ]
    return checks.run_suite(suite, stop=False)




GATE = {"not_null": ["temp_mean"], "range": {"humidity": (10.0, 60.0), "wind_speed": (1.0, 45.0), "surface_pressure": (1000.0, 1010.0)}}


@query(
    "h6_gated_write",
    sql("px_daily", """, k AS (SELECT 'rows' AS "check", 0 AS failing UNION ALL SELECT 'not_null(temp_mean)', count(*) FILTER (temp_mean IS NULL) FROM px_daily
  UNION ALL SELECT 'range(humidity)', count(*) FILTER (NOT humidity BETWEEN 10 AND 60) FROM px_daily UNION ALL SELECT 'range(wind_speed)', count(*) FILTER (NOT wind_speed BETWEEN 1 AND 45) FROM px_daily
  UNION ALL SELECT 'range(surface_pressure)', count(*) FILTER (NOT surface_pressure BETWEEN 1000 AND 1010) FROM px_daily)
SELECT "check", CAST(failing AS BIGINT) AS failing, (SELECT sum(failing) FROM k) = 0 AS published FROM k"""),
)
def h6_gated(spark: SparkSession, d: str) -> DataFrame:
    """The daily table's checks, counted while it is written; what they found, and whether it was published."""
    try:
        report, published = checks.gated_write(proxies.daily(spark, d), scratch(spark, "gated"), checks.row_rules(GATE)), True
    except checks.GateError as e:
        report, published = e.report, False
    return spark.createDataFrame([(name, n, published) for name, n in report], "check string, failing long, published boolean")
