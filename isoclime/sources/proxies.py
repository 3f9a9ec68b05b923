"""City-day and city-hour series derived from the star-schema test tables, in Spark and (for checks) in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ZONES = ["UTC", "America/Phoenix", "Atlantic/Reykjavik", "Asia/Kolkata", "Australia/Sydney", "Pacific/Auckland", "Europe/Berlin", "America/New_York"]
MEASURES = ["temp_mean", "temp_max", "temp_min", "precipitation", "wind_speed", "wind_gust", "surface_pressure", "humidity"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cities(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("n_nationkey")
    zone = F.element_at(F.array(*map(F.lit, ZONES)), (key % 8 + 1).cast("int"))
    regime = F.when(key == 8, "wet_dry").when(key == 9, "none").otherwise("temperate")
    joined = table(spark, sf_dir, "nation").join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return joined.select(
        key.cast("int").alias("city_id"),
        F.col("n_name").alias("name"),
        F.concat(F.lit("COUNTRY_"), (key % 7).cast("string")).alias("country"),
        F.col("r_name").alias("region"),
        (F.lit(-37.0) + F.lit(101.0) * key / 24).alias("latitude"),
        (F.lit(-180.0) + F.lit(15.0) * key).alias("longitude"),
        (F.lit(10.0) + F.lit(72.0) * key).alias("elevation"),
        zone.alias("timezone"),
        ((key + 1) * 100000).cast("long").alias("population"),
        regime.alias("climate_regime"),
    )


def daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per city and day with all measures, rounded so that summing order leaves no trace."""
    items = table(spark, sf_dir, "lineitem").join(table(spark, sf_dir, "supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
    return items.groupBy(F.col("s_nationkey").cast("int").alias("city_id"), F.col("l_shipdate").cast("date").alias("obs_date")).agg(
        F.round(F.sum("l_extendedprice"), 2).alias("temp_mean"),
        F.max("l_extendedprice").alias("temp_max"),
        F.min("l_extendedprice").alias("temp_min"),
        F.round(F.sum("l_tax"), 2).alias("precipitation"),
        F.round(F.avg("l_quantity"), 6).alias("wind_speed"),
        F.max("l_quantity").alias("wind_gust"),
        F.round(F.avg("l_discount") * 100 + 1000, 6).alias("surface_pressure"),
        F.round(F.avg("l_tax") * 1000, 6).alias("humidity"),
    )


def bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The daily series as raw deliveries: newest rows, stale versions, and exact copies."""
    new = daily(spark, sf_dir)
    turn = F.col("city_id") + F.dayofmonth("obs_date")
    when = lambda text: F.lit(text).cast("timestamp")
    parts = [
        new.withColumn("ingested_at", when("2026-01-02 00:00:00")).withColumn("seq", F.lit(1)),
        new.filter(turn % 5 == 0).withColumn("temp_mean", F.col("temp_mean") * 0.5).withColumn("ingested_at", when("2026-01-01 00:00:00")).withColumn("seq", F.lit(0)),
        new.filter(turn % 7 == 0).withColumn("ingested_at", when("2026-01-02 00:00:00")).withColumn("seq", F.lit(0)),
    ]
    out = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return out.withColumn("source_url", F.concat(F.lit("https://archive.example/daily?city="), F.col("city_id").cast("string")))


def spine(spark: SparkSession, sf_dir: str) -> DataFrame:
    from isoclime.operators.cleaning import densify

    return densify(daily(spark, sf_dir))


def hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.get_json_object("props", "$.k").cast("int")
    hour = F.date_trunc("hour", F.col("ts").cast("timestamp"))
    return table(spark, sf_dir, "events").groupBy((F.col("user_id") % 15).cast("int").alias("city_id"), hour.alias("ts")).agg(
        F.round(F.avg("value"), 6).alias("wind_speed"),
        F.round(F.avg(k) + 1000, 6).alias("pressure"),
        F.max("value").alias("temperature"),
    )


#: The same series for DuckDB.
SQL = {
    "px_cities": f"""
      SELECT CAST(n_nationkey AS INTEGER) AS city_id, n_name AS name, 'COUNTRY_' || (n_nationkey % 7) AS country, r_name AS region,
             -37.0::DOUBLE + 101.0::DOUBLE * n_nationkey / 24 AS latitude, -180.0::DOUBLE + 15.0::DOUBLE * n_nationkey AS longitude,
             10.0::DOUBLE + 72.0::DOUBLE * n_nationkey AS elevation, ({ZONES!r})[n_nationkey % 8 + 1] AS timezone,
             CAST((n_nationkey + 1) * 100000 AS BIGINT) AS population,
             CASE n_nationkey WHEN 8 THEN 'wet_dry' WHEN 9 THEN 'none' ELSE 'temperate' END AS climate_regime
      FROM nation JOIN region ON n_regionkey = r_regionkey""",
    "px_daily": """
      SELECT CAST(s_nationkey AS INTEGER) AS city_id, CAST(l_shipdate AS DATE) AS obs_date, round(sum(l_extendedprice), 2) AS temp_mean,
             max(l_extendedprice) AS temp_max, min(l_extendedprice) AS temp_min, round(sum(l_tax), 2) AS precipitation,
             round(avg(l_quantity), 6) AS wind_speed, max(l_quantity) AS wind_gust,
             round(avg(l_discount) * 100 + 1000, 6) AS surface_pressure, round(avg(l_tax) * 1000, 6) AS humidity
      FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY 1, 2""",
    "px_bronze": """
      SELECT *, 'https://archive.example/daily?city=' || city_id AS source_url FROM (
        SELECT *, TIMESTAMP '2026-01-02' AS ingested_at, 1 AS seq FROM px_daily
        UNION ALL SELECT * REPLACE (temp_mean * 0.5 AS temp_mean), TIMESTAMP '2026-01-01', 0 FROM px_daily WHERE (city_id + day(obs_date)) % 5 = 0
        UNION ALL SELECT *, TIMESTAMP '2026-01-02', 0 FROM px_daily WHERE (city_id + day(obs_date)) % 7 = 0)""",
    "px_days": """
      SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS obs_date FROM (SELECT min(obs_date) AS lo, max(obs_date) AS hi FROM px_daily)""",
    "px_spine": """
      SELECT c.city_id, d.obs_date, temp_mean, temp_max, temp_min, precipitation, wind_speed, wind_gust, surface_pressure, humidity
      FROM (SELECT DISTINCT city_id FROM px_daily) c CROSS JOIN px_days d LEFT JOIN px_daily p ON p.city_id = c.city_id AND p.obs_date = d.obs_date""",
    "px_hourly": """
      SELECT CAST(user_id % 15 AS INTEGER) AS city_id, date_trunc('hour', ts) AS ts, round(avg(value), 6) AS wind_speed,
             round(avg(CAST(json_extract_string(props, '$.k') AS INTEGER)) + 1000, 6) AS pressure, max(value) AS temperature
      FROM events GROUP BY 1, 2""",
    "px_obs": """
      SELECT *, CAST(dayofyear(make_date(2000, month(obs_date), day(obs_date))) AS INTEGER) AS slot, CAST(year(obs_date) AS INTEGER) AS year FROM px_daily""",
    "px_pairs": """
      SELECT a.city_id, a.obs_date, a.slot, a.year, a.temp_mean, b.temp_mean AS other, b.year AS other_year, b.slot AS other_slot
      FROM px_obs a JOIN px_obs b ON a.city_id = b.city_id AND a.year <> b.year
        AND least((a.slot - b.slot + 366) % 366, (b.slot - a.slot + 366) % 366) <= 7""",
    "px_z": """
      SELECT city_id, obs_date, slot, year, any_value(temp_mean) AS temp_mean, count(*) AS n, avg(other) AS mu, stddev_samp(other) AS sigma,
             (any_value(temp_mean) - avg(other)) / nullif(stddev_samp(other), 0) AS z
      FROM px_pairs GROUP BY ALL HAVING count(*) >= 2""",
    "px_zf": """
      SELECT o.city_id, o.obs_date, o.slot, o.year, o.temp_mean, z.n, z.mu, z.sigma, z.z, abs(z.z) > 2.5 AS is_anomaly
      FROM px_obs o LEFT JOIN px_z z USING (city_id, obs_date)""",
    "px_zs": """
      SELECT o.city_id, o.obs_date, o.slot, o.year, any_value(o.temp_mean) AS temp_mean,
             CASE WHEN count(p.other) >= 2 THEN (any_value(o.temp_mean) - avg(p.other)) / nullif(stddev_samp(p.other), 0) END AS z
      FROM px_obs o LEFT JOIN px_pairs p ON p.city_id = o.city_id AND p.obs_date = o.obs_date AND p.other_year <= 1998 GROUP BY 1, 2, 3, 4""",
    "px_zsf": """
      SELECT *, abs(z) > 2.5 AS is_anomaly FROM px_zs""",
}


def sql(needs: str, body: str) -> str:
    """``body`` (a SELECT, or further CTEs and a SELECT after a leading comma) with the named series in front."""
    order = list(SQL)
    above = {
        "px_bronze": ["px_daily"], "px_days": ["px_daily"], "px_spine": ["px_daily", "px_days"], "px_obs": ["px_daily"],
        "px_pairs": ["px_obs"], "px_z": ["px_pairs"], "px_zf": ["px_z"], "px_zs": ["px_pairs"], "px_zsf": ["px_zs"],
    }
    want: set[str] = set()
    todo = needs.split()
    while todo:
        if (name := todo.pop()) not in want:
            want.add(name)
            todo += above.get(name, [])
    head = ",\n".join(f"{n} AS ({SQL[n]})" for n in order if n in want)
    return f"WITH {head}{body if body.lstrip().startswith(',') else chr(10) + body}"
