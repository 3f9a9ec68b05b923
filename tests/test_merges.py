"""As-of merges and event checks: results by definition, and plans."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from isoclime.operators import climatology as clim
from isoclime.operators import star

DAY = dt.date(2000, 1, 1)
at = lambda n: DAY + dt.timedelta(days=n)
HISTORY = "k int, city string, name string, valid_from date, valid_to date"
FACT = "k int, city string, date date, name int"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("partitions", ["1", "7"])
def test_as_of_equals_the_interval_join(spark, partitions):
    rng, versions = random.Random(3), []
    for k in [*range(5), None]:
        day = 0
        for i in range(rng.randrange(1, 30)):
            start = day + rng.randrange(0, 3)
            day = start + rng.randrange(1, 9)
            versions.append((k, "x", None if i % 4 == 0 else f"v{i}", at(start), None if i == 29 else at(day)))
    facts = [(rng.choice([0, 1, 2, 3, 4, 5, 9, None]), "x", None if i % 50 == 0 else at(rng.randrange(-9, 150)), i % 7) for i in range(900)]
    facts += [facts[1]] * 3
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        got = sorted(map(tuple, star.as_of_dim(spark.createDataFrame(facts, FACT).drop("name"), spark.createDataFrame(versions, HISTORY), ["k", "city"]).collect()), key=str)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    want = []
    for k, city, day, _ in facts:
        own = [v[2:] for v in versions if k is not None and day is not None and v[0] == k and v[3] <= day and (v[4] is None or day < v[4])]
        want.append((k, city, day, *(own[0] if own else (None, None, None))))
    assert got == sorted(want, key=str)


def test_ten_thousand_versions_of_one_key_multiply_no_row(spark):
    history = spark.range(10_000).select(F.lit(1).alias("k"), F.col("id").alias("v"), F.date_add(F.lit(DAY), F.col("id").cast("int")).alias("valid_from"), F.date_add(F.lit(DAY), F.col("id").cast("int") + 1).alias("valid_to"))
    facts = spark.range(30_000).select(F.lit(1).alias("k"), F.date_add(F.lit(DAY), (F.col("id") % 12_000).cast("int")).alias("date"), "id")
    out = star.as_of_dim(facts, history, ["k"])
    assert out.agg(F.count("*"), F.count_if(F.expr("v = id % 12000")), F.count("v")).first()[:] == (30_000, 26_000, 26_000)
    wide = out.select(F.spark_partition_id().alias("p")).groupBy("p").count().agg(F.max("count")).first()[0]
    assert wide < 20_000  # the one key goes over several ranges
    assert "NestedLoop" not in plan(out) and "Cartesian" not in plan(out)


EVENTS = "event_id int, city_id int, start_date date, end_date date, direction string"


@pytest.fixture(scope="module")
def flags(spark):
    rows = [(c, at(d), (c + d) % 7 == 0, "warm" if d % 2 else "cold", float((c * 31 + d * 17) % 23) if d % 11 else None) for c in range(20) for d in range(120)]
    return spark.createDataFrame(rows, "city_id int, obs_date date, is_anomaly boolean, direction string, magnitude double")


@pytest.mark.parametrize("most", [10_000, 0])
def test_events_by_definition_either_way(spark, flags, most):
    rng = random.Random(1)
    events = [(i, rng.randrange(22), at(a := rng.randrange(-20, 130)), at(a + rng.randrange(90)), rng.choice([None, "warm", "cold"])) for i in range(60)]
    events += [(900, 3, at(500), at(600), None), (901, 3, at(9), at(8), None)]
    rows = flags.collect()
    want = []
    for i, city, start, end, wanted in events:
        seen = [r for r in rows if r.city_id == city and start <= r.obs_date <= end]
        best = max((r for r in seen if r.magnitude is not None), key=lambda r: (r.magnitude, -r.obs_date.toordinal()), default=None)
        want.append((i, any(r.is_anomaly and wanted in (None, r.direction) for r in seen), best and best.magnitude, best and best.obs_date))
    got = clim.validate_events(flags, spark.createDataFrame(events, EVENTS), most).collect()
    assert sorted((r.event_id, r.hit, r.peak, r.peak_date) for r in got) == sorted(want)


def test_events_leave_the_flags_where_they_are(spark, tmp_path):
    spark.range(300_000).selectExpr("cast(id % 500 as int) city_id", f"date_add(DATE '{DAY}', cast(id / 500 as int)) obs_date", "id % 97 = 0 is_anomaly", "'warm' direction", "cast(id % 31 as double) magnitude").write.parquet(f"{tmp_path}/f")
    flags = spark.read.parquet(f"{tmp_path}/f")
    events = spark.createDataFrame([(i, i, at(3), at(5), None) for i in range(7)], EVENTS)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1k")
    try:
        out = clim.validate_events(flags, events)
        assert out.count() == 7
        out.collect()
        text = out._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    lines = text.splitlines()
    scan = next(i for i, line in enumerate(lines) if "Scan parquet" in line)
    above = [line for line in lines[:scan] if lines[scan].index("+-") > (line.index("+-") if "+-" in line else 0)]
    hashed = max(i for i, line in enumerate(above) if "BroadcastHashJoin" in line)
    assert not any("Exchange" in line for line in above[hashed:])
