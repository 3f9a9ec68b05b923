import gzip
import json

import pytest
from pyspark.sql import functions as F

from isoclime.operators.cleaning import dedup_latest, local_view
from isoclime.sources import landing


def test_backfill_is_done_once_landed(spark):
    cities = spark.createDataFrame([(1,), (2,)], "city_id int")
    days = spark.sql("SELECT explode(sequence(DATE'1996-01-01', DATE'1996-12-31')) AS obs_date").withColumn("city_id", F.lit(1))
    plan = landing.backfill_plan(cities, days, "1996-01-01", "1996-12-31").collect()
    assert [tuple(r) for r in plan] == [(2, 1996, 366)]
    counts = {r.city_id: (r.expected, r.actual, r.ok) for r in landing.reconcile_counts(days, cities, "1996-01-01", "1996-12-31").collect()}
    assert counts == {1: (366, 366, True), 2: (366, 0, False)}


def test_redelivery_adds_nothing_and_revision_is_a_version(spark):
    schema = "k int, v double, note string"
    first = spark.createDataFrame([(1, 1.0, "a"), (1, 1.0, "again"), (2, None, "b")], schema)
    have = landing.new_rows(first, first.limit(0), ["k"], ["v"])
    assert have.count() == 2
    assert landing.new_rows(first, have, ["k"], ["v"]).count() == 0
    revised = spark.createDataFrame([(2, 5.0, "c"), (1, 1.0, "d"), (None, 1.0, "e")], schema)
    assert sorted(r.note for r in landing.new_rows(revised, have, ["k"], ["v"]).collect()) == ["c", "e"]


def test_payloads_good_bad_and_uneven(spark, tmp_path):
    good = {"city_id": 7, "daily": {"time": ["2020-01-01", "2020-01-02"], "t": [1.5, None], "p": [3.0]}}
    for name, text in (("good", json.dumps(good)), ("bad", '{"city_id": 8, "daily": {"ti')):
        with gzip.open(tmp_path / f"{name}.json.gz", "wt") as f:
            f.write(text + "\n")
    got = landing.read_payloads(spark, str(tmp_path), "daily", ["t", "p"]).orderBy("time").collect()
    assert [(r.city_id, str(r.time)[:10], r.t, r.p) for r in got] == [(7, "2020-01-01", 1.5, 3.0), (7, "2020-01-02", None, None)]
    errors = landing.parse_payload_errors(spark, str(tmp_path), "daily", ["t", "p"]).collect()
    assert len(errors) == 1 and errors[0].payload.startswith('{"city_id": 8') and "bad.json.gz" in errors[0].source_url


def test_land_and_overwrite_chunks(spark, tmp_path):
    rows = spark.createDataFrame([(1, "1999-01-01", 1.0), (2, "2000-01-01", 2.0)], "city_id int, d string, v double").select("city_id", F.to_date("d").alias("obs_date"), "v")
    path = str(tmp_path / "landed")
    landing.land(rows, path, "2026-01-01 00:00:00", "u")
    landing.land(rows, path, "2026-01-02 00:00:00", "u")
    assert spark.read.parquet(path).groupBy("year").count().count() == 2
    chunks = str(tmp_path / "chunks")
    with_year = rows.withColumn("year", F.year("obs_date"))
    landing.overwrite_chunks(with_year, chunks)
    landing.overwrite_chunks(with_year.filter("city_id = 1").withColumn("v", F.lit(9.0)), chunks)
    assert sorted((r.city_id, r.v) for r in spark.read.parquet(chunks).collect()) == [(1, 9.0), (2, 2.0)]


def test_stage_counts_raise_on_nothing(spark):
    df, check = landing.stage_counts(spark.range(5), "five")
    df.write.format("noop").mode("overwrite").save()
    assert check() == 5
    df, check = landing.stage_counts(spark.range(0), "none")
    df.write.format("noop").mode("overwrite").save()
    with pytest.raises(RuntimeError):
        check()


def test_dedup_has_one_winner_among_ties(spark):
    rows = spark.createDataFrame([(1, 5, 1), (1, 5, 2), (1, 4, 9), (None, 1, 1)], "k int, at int, seq int")
    got = dedup_latest(rows, ["k"], ["at"], ["seq"]).collect()
    assert sorted(((r.k, r.seq) for r in got), key=str) == [(1, 2), (None, 1)]


def test_local_days_of_awkward_zones(spark):
    zones = ["Australia/Sydney", "Pacific/Auckland", "America/Phoenix", "Atlantic/Reykjavik", "Asia/Kolkata"]
    dim = spark.createDataFrame(list(enumerate(zones)), "city_id int, timezone string")
    hours = spark.sql("SELECT explode(sequence(TIMESTAMP'2019-01-01', TIMESTAMP'2019-12-31 23:00:00', INTERVAL 1 HOUR)) AS ts")
    seen = local_view(hours.crossJoin(dim.select("city_id")), dim)
    days = seen.groupBy("city_id", "local_date").count().filter("local_date BETWEEN '2019-01-03' AND '2019-12-30' AND count <> 24").collect()
    got = {}
    for r in days:
        got.setdefault(zones[r.city_id], set()).add((str(r.local_date), r["count"]))
    assert got["Australia/Sydney"] == {("2019-04-07", 25), ("2019-10-06", 23)}
    assert got["Pacific/Auckland"] == {("2019-04-07", 25), ("2019-09-29", 23)}
    assert not {"America/Phoenix", "Atlantic/Reykjavik", "Asia/Kolkata"} & set(got)
    half = seen.filter("city_id = 4").selectExpr("(unix_timestamp(local_ts) - unix_timestamp(ts)) / 60 AS m").distinct().collect()
    assert [r.m for r in half] == [330.0]
