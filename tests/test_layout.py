"""What the stored layout saves: no exchange before windows over places, and folders pruned while a query runs."""

import pytest
from pyspark.sql import functions as F

from isoclime.operators import climatology as clim
from isoclime.operators import features as ft
from isoclime.operators import star
from isoclime.session import scratch, scratch_table
from isoclime.sources import proxies


@pytest.fixture(scope="module")
def gold(spark, sf_dir):
    days = proxies.daily(spark, sf_dir)
    flags = clim.anomalies(days, pooling="pooled").select("city_id", "obs_date", "z", "is_anomaly")
    rows = days.select("city_id", "obs_date", "temp_mean", "surface_pressure").join(flags, ["city_id", "obs_date"], "left")
    return star.write_gold(rows, scratch_table("gold"), scratch(spark, "gold"), 4, day="obs_date")


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]


def test_feature_windows_move_no_row_of_a_stored_series(spark, sf_dir, gold):
    cities = star.dim_cities(proxies.cities(spark, sf_dir))
    out = ft.feature_table(gold, None, cities.hint("broadcast"))
    lines = final_plan(out).splitlines()
    windows = [i for i, line in enumerate(lines) if " Window " in line or "Window [" in line]
    scan = max(i for i, line in enumerate(lines) if "Scan parquet" in line and "gold" in line)
    assert windows and not any("Exchange hashpartitioning" in line for line in lines[windows[0] : scan + 1])
    flags = gold.select("city_id", "obs_date", "z", "is_anomaly")
    loose = ft.feature_table(spark.read.parquet(*gold.inputFiles()), flags, cities.hint("broadcast"))
    assert "Exchange hashpartitioning" in final_plan(loose)
    same = lambda df: sorted(map(str, df.select("city_id", "obs_date", *ft.FEATURES, "label").collect()))
    assert same(out) == same(loose)


def test_a_calendar_filter_prunes_years_at_run_time(spark, sf_dir):
    cities = star.dim_cities(proxies.cities(spark, sf_dir))
    fact = star.write_gold(star.fact_daily(proxies.daily(spark, sf_dir), cities, ["temp_mean"]), scratch_table("fact"), scratch(spark, "fact"), 4)
    dates = star.dim_date(spark, "1995-01-01", "2001-12-31")
    calendar = scratch(spark, "dates")
    dates.write.parquet(calendar)
    joined = star.star_join(fact, cities, spark.read.parquet(calendar).filter("is_leap AND quarter = 1"))
    text = final_plan(joined.select("city_id", "date", "temp_mean", "year"))
    assert "dynamicpruning" in text.lower()
    assert {r.year for r in joined.select("year").distinct().collect()} == {1996, 2000}


def test_left_star_join_keeps_orphans(spark, gold):
    fact = gold.withColumn("date_key", F.expr("year(obs_date) * 10000 + month(obs_date) * 100 + day(obs_date)")).withColumnRenamed("obs_date", "date").drop("year")
    none = spark.createDataFrame([], "city_id int, name string")
    out = star.star_join(fact, none, star.dim_date(spark, "1996-01-01", "1996-01-31"), "left")
    assert out.count() == fact.count() and out.filter("name IS NOT NULL").count() == 0
    assert out.filter("quarter IS NULL").count() == fact.filter("date NOT BETWEEN '1996-01-01' AND '1996-01-31'").count()
