import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from isoclime.functions.calendar import day_slot, season
from isoclime.operators import climatology as clim

YEARS = range(1996, 2003)


def series(spark, change=None, city=1, seed=2):
    rng, rows = random.Random(seed), []
    day = dt.date(YEARS[0], 1, 1)
    while day.year in YEARS:
        value = 20 + 10 * abs(day.timetuple().tm_yday - 183) / 183 + rng.gauss(0, 2)
        rows.append((city, day, change(day, value) if change else value))
        day += dt.timedelta(days=rng.choice([3, 4, 5]))
    return spark.createDataFrame(rows, "city_id int, obs_date date, temp_mean double")


def z_of(df, **options):
    return {r.obs_date: r.z for r in clim.anomalies(df, **options).collect()}


def test_slots_and_seasons(spark):
    rows = spark.sql("SELECT explode(array(DATE'1999-02-28', DATE'2000-02-29', DATE'1999-03-01', DATE'2000-03-01', DATE'1999-12-31', DATE'2000-12-31')) AS d")
    assert [r.s for r in rows.select(day_slot(F.col("d")).alias("s")).collect()] == [59, 60, 61, 61, 366, 366]
    place = spark.sql("SELECT DATE'2000-01-15' AS d, * FROM VALUES (50.0, 'temperate'), (-50.0, 'temperate'), (5.0, 'wet_dry'), (-5.0, 'wet_dry'), (0.0, 'none'), (NULL, 'temperate') AS t(lat, r)")
    assert [r.s for r in place.select(season(F.col("d"), F.col("lat"), F.col("r")).alias("s")).collect()] == ["winter", "summer", "dry", "wet", "all_year", None]


@pytest.mark.parametrize("pooling", ["pooled", "smoothed"])
def test_shifting_scaling_and_order_leave_z_alone(spark, pooling):
    base = z_of(series(spark), pooling=pooling)
    moved = z_of(series(spark, lambda d, v: 3 * v + 500).repartition(7), pooling=pooling)
    assert base.keys() == moved.keys()
    assert all((base[d] is None) == (moved[d] is None) and (base[d] is None or abs(base[d] - moved[d]) < 1e-8) for d in base)


@pytest.mark.parametrize("pooling", ["pooled", "smoothed"])
def test_own_year_never_enters_its_own_baseline(spark, pooling):
    plain = clim.loyo_normals(series(spark), pooling=pooling)
    spiked = clim.loyo_normals(series(spark, lambda d, v: v + 400 if d.year == 1999 else v), pooling=pooling)
    both = plain.join(spiked.select("city_id", "slot", "ref_key", F.col("mu").alias("mu2"), F.col("sigma").alias("sigma2")), ["city_id", "slot", "ref_key"])
    same = (F.abs(F.col("mu") - F.col("mu2")) < 1e-6) & (F.abs(F.col("sigma") - F.col("sigma2")) < 1e-6)
    own = both.filter("ref_key = 1999")
    assert own.count() > 300 and own.filter(~same).count() == 0
    assert both.filter("ref_key <> 1999").filter(~same).count() > 300


def test_year_wrap_pools_december_with_january(spark):
    rows = [(1, dt.date(y, 12, 31), float(y)) for y in (1999, 2000, 2001)] + [(1, dt.date(2002, 1, 2), 0.0)]
    got = {r.slot: r.n for r in clim.pooled_normals(spark.createDataFrame(rows, "city_id int, obs_date date, temp_mean double")).collect()}
    assert got[366] == 4 and got[1] == 4 and 180 not in got


def test_no_spread_or_too_few_years_give_null(spark):
    flat = [(1, dt.date(y, 6, 1), 5.0) for y in range(1996, 2000)] + [(2, dt.date(1999, 6, 1), 5.0), (3, dt.date(1999, 6, 1), None)]
    out = clim.anomalies(spark.createDataFrame(flat, "city_id int, obs_date date, temp_mean double"), pooling="pooled").collect()
    assert len(out) == 5 and all(r.z is None and r.is_anomaly is None for r in out)


def test_cold_day_and_known_events(spark):
    days = sorted(z_of(series(spark)))
    flags = clim.anomalies(series(spark, lambda d, v: v - 100 if d == days[50] else v))
    coldest = flags.orderBy("z").first()
    assert (coldest.obs_date, coldest.direction, coldest.is_anomaly) == (days[50], "cold", True)
    events = spark.createDataFrame([(1, 1, days[50], days[50], "cold"), (2, 1, days[50], days[50], "warm"), (3, 9, days[50], days[50], None)], "event_id int, city_id int, start_date date, end_date date, direction string")
    got = clim.validate_events(flags, events)
    assert {r.event_id: r.hit for r in got.collect()} == {1: True, 2: False, 3: False}
    assert clim.require_events(got, 1) == 1
    with pytest.raises(RuntimeError):
        clim.require_events(got)


def test_reference_years_restrict_what_is_pooled(spark):
    train = clim.loyo_normals(series(spark), reference_years=[1996, 1997, 1998])
    late = clim.loyo_normals(series(spark, lambda d, v: v + 99 if d.year > 1998 else v), reference_years=[1996, 1997, 1998])
    one = {(r.slot, r.ref_key): round(r.mu, 6) for r in train.collect()}
    assert one == {(r.slot, r.ref_key): round(r.mu, 6) for r in late.collect()} and any(k[1] == 2002 for k in one)


def test_empty_series(spark):
    assert clim.anomalies(series(spark).limit(0)).collect() == []
