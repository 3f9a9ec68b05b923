"""Audits over many days against the audit of one day, and planted leaks."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from isoclime.operators import audit
from isoclime.operators import climatology as clim
from isoclime.operators import features as ft

FIRST = dt.date(1999, 1, 1)
DAYS = ["2001-03-15", "2002-01-03", "2002-12-30"]
SCHEMA = "city_id int, obs_date date, temp_mean double, surface_pressure double"


@pytest.fixture(scope="module")
def daily(spark):
    rows = []
    for d in range(5 * 366):
        for c in (1, 2):
            if (d * 7 + c) % 11:
                rows.append((c, FIRST + dt.timedelta(days=d), float((d * 7919 + c * 31) % 1009), 1000.0 + d * 13 % 17))
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def cities(spark):
    return spark.createDataFrame([(1, 10.0, 5.0), (2, -20.0, 7.0)], "city_id int, latitude double, elevation double")


def rows(df):
    return sorted((r.city_id, r.obs_date, r.feature, r.with_future and round(r.with_future, 7), r.without and round(r.without, 7)) for r in df.collect())


@pytest.mark.parametrize("years", [None, (1999, 2000)])
def test_one_run_reports_what_the_audit_of_each_day_reports(spark, daily, cities, years):
    flags_of = lambda d: clim.anomalies(d, pooling="pooled", reference_years=years, threshold=1.2)
    table = ft.feature_table(daily, flags_of(daily), cities)
    got = rows(audit.audit_days(table, daily, cities, DAYS, threshold=1.2, reference_years=years))
    want = []
    for d in DAYS:
        want += rows(ft.point_in_time_audit(daily, flags_of, cities, d))
    assert got == sorted(want)
    assert bool(got) == (years is None)


def test_planted_leaks_on_three_days_are_found_in_one_run(daily, cities):
    years = (1999, 2000)
    table = ft.feature_table(daily, clim.anomalies(daily, pooling="pooled", reference_years=years), cities)
    ahead = F.max("temp_mean").over(ft.days(1, 1))
    leaky = table.withColumns({
        "temp_mean_lag1": F.when(F.col("obs_date") == DAYS[0], ahead).otherwise(F.col("temp_mean_lag1")),
        "surface_pressure_lag3": F.when(F.col("obs_date") == DAYS[1], F.col("surface_pressure_lag3") + 1).otherwise(F.col("surface_pressure_lag3")),
        "anomaly_count30": F.when((F.col("obs_date") == DAYS[2]) & (F.col("city_id") == 2), 77).otherwise(F.col("anomaly_count30")),
    })
    got = audit.audit_days(leaky, daily, cities, DAYS, reference_years=years).collect()
    assert {(str(r.obs_date), r.feature) for r in got} == {(DAYS[0], "temp_mean_lag1"), (DAYS[1], "surface_pressure_lag3"), (DAYS[2], "anomaly_count30")}
    assert {r.city_id for r in got if str(r.obs_date) == DAYS[2]} == {2}


def test_baselines_of_a_day_are_those_of_the_cut_series(daily):
    got = {(r.city_id, str(r.as_of), r.obs_date): (r.n, r.mu, r.sigma) for r in audit.cut_baselines(daily, DAYS, look_back=5).collect()}
    for d in DAYS:
        past = daily.filter(F.col("obs_date") <= d)
        normal = clim.zscore(past, clim.loyo_normals(past)).filter(F.col("obs_date") > F.date_sub(F.lit(d).cast("date"), 5))
        for r in normal.collect():
            n, mu, sigma = got[r.city_id, d, r.obs_date]
            assert n == r.n and mu == pytest.approx(r.mu, rel=1e-9) and sigma == pytest.approx(r.sigma, rel=1e-9)
