"""The stored normals against one run over all days."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from isoclime.operators import climatology as clim
from isoclime.operators import normals_mart as mart

SCHEMA = "city_id int, obs_date date, temp_mean double"


def series(spark, years=(2001, 2002, 2003, 2004), cities=(1, 2)):
    rows, day = [], dt.date(years[0], 1, 1)
    while day <= dt.date(years[-1], 12, 31):
        rows += [(c, day, 10.0 * c + (day.toordinal() * 7919 * c % 1000) / 37) for c in cities if day.toordinal() % 3 != c]
        day += dt.timedelta(days=1)
    return spark.createDataFrame([*rows, (1, dt.date(2002, 2, 2), None)], SCHEMA)


def table(df):
    out = {}
    for r in df.collect():
        key = (r.city_id, r.slot, r.asDict().get("ref_key"))
        assert key not in out
        out[key] = (r.n, round(r.mu, 6), None if r.sigma is None else round(r.sigma, 6))
    return out


def same_as_one_run(spark, path, days):
    parts = mart.stored_partials(spark, path)
    assert table(clim.pooled_of(parts)) == table(clim.pooled_normals(days))
    assert table(clim.loyo_of(parts, pooling="smoothed")) == table(clim.loyo_normals(days, pooling="smoothed"))
    assert table(clim.trailing_of(parts, 2)) == table(clim.trailing_normals(days, n_years=2))


def files(path):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")}


def test_batches_equal_one_run_replays_change_nothing_and_other_years_stay(spark, tmp_path):
    path, days = str(tmp_path / "mart"), series(spark)
    first = days.filter("year(obs_date) <= 2002 AND day(obs_date) <> 3 AND city_id = 1")
    second = days.filter("year(obs_date) <= 2002 AND (day(obs_date) = 3 OR city_id = 2)")
    mart.merge_days(spark, path, 1, first)
    mart.merge_days(spark, path, 2, second)
    mart.merge_days(spark, path, 2, second)
    same_as_one_run(spark, path, days.filter("year(obs_date) <= 2002"))
    kept = files(path)
    mart.merge_days(spark, path, 3, days.filter("year(obs_date) >= 2003"))
    assert {f: t for f, t in files(path).items() if f in kept} == kept
    same_as_one_run(spark, path, days)
    assert mart.newest(spark, path) == {2001: 2, 2002: 2, 2003: 3, 2004: 3}
    assert mart.tidy(spark, path) == 2
    same_as_one_run(spark, path, days)


def test_a_merge_reads_no_untouched_year_and_no_observation(spark, tmp_path):
    path, days = str(tmp_path / "mart"), series(spark)
    mart.merge_days(spark, path, 1, days.filter("year(obs_date) <= 2003"))
    at = f"{path}/sums/year=2002/upto=1"
    saved = {f: open(f"{at}/{f}", "rb").read() for f in os.listdir(at)}
    for f in saved:
        with open(f"{at}/{f}", "wb") as out:
            out.write(b"not a table")
    mart.merge_days(spark, path, 2, days.filter("year(obs_date) = 2004"))
    for f, data in saved.items():
        with open(f"{at}/{f}", "wb") as out:
            out.write(data)
    same_as_one_run(spark, path, days)
    assert all(path in f for f in mart.stored_partials(spark, path).inputFiles())


def test_a_merge_that_stopped_half_way_is_made_good_by_its_replay(spark, tmp_path, monkeypatch):
    path, days = str(tmp_path / "mart"), series(spark)
    mart.merge_days(spark, path, 1, days.filter("day(obs_date) > 9"))
    late = days.filter("day(obs_date) <= 9")
    mart.merge_days(spark, path, 2, late.filter("year(obs_date) = 2001"))  # as if only one folder of the batch had been written
    mart.merge_days(spark, path, 2, late)
    same_as_one_run(spark, path, days)


def test_revised_days_withdraw_their_old_values(spark, tmp_path):
    path, days = str(tmp_path / "mart"), series(spark)
    old = days.filter("day(obs_date) = 7").withColumn("temp_mean", F.col("temp_mean") + 3)
    mart.merge_days(spark, path, 1, days.filter("day(obs_date) <> 7").unionByName(old))
    mart.merge_days(spark, path, 2, days.filter("day(obs_date) = 7"), withdrawn=old)
    same_as_one_run(spark, path, days)
    mart.merge_days(spark, path, 3, days.filter("false"), withdrawn=days.filter("city_id = 2"))
    same_as_one_run(spark, path, days.filter("city_id = 1"))


def test_an_older_batch_and_an_empty_mart(spark, tmp_path):
    path, days = str(tmp_path / "mart"), series(spark)
    assert mart.stored_partials(spark, path).count() == 0
    mart.merge_days(spark, path, 5, days)
    with pytest.raises(ValueError, match="after 4"):
        mart.merge_days(spark, path, 4, days)
