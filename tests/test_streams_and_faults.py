import datetime as dt

from isoclime.operators import checks
from isoclime.sources import landing
from isoclime.streaming import streams

KEYS, VALUES = ["city_id", "ts"], ["value"]


def rows(spark, *cells):
    data = [(c, dt.datetime(2024, 1, d, h), v, dt.datetime(2024, 2, 1)) for c, d, h, v in cells]
    return spark.createDataFrame(data, "city_id int, ts timestamp, value double, seen timestamp")


def test_a_replayed_batch_changes_nothing(spark, tmp_path):
    bronze, late, marks = (f"{tmp_path}/{n}" for n in ("bronze", "late", "marks"))
    run = lambda df, n: streams.upsert_batch(df, n, KEYS, VALUES, "ts", "seen", bronze, late, marks)
    state = lambda path: sorted((r.city_id, r.ts.day, r.value) for r in spark.read.parquet(path).collect())
    first = rows(spark, (1, 1, 0, 1.0), (1, 2, 0, 2.0), (1, 2, 0, 2.0))
    second = rows(spark, (1, 3, 0, 3.0), (1, 20, 0, 4.0), (1, 2, 0, 2.5))  # within a batch the mark is that before it
    for df, n in ((first, 0), (first, 0), (second, 1), (second, 1), (first, 0)):
        run(df, n)
    assert state(bronze) == [(1, 1, 1.0), (1, 2, 2.0), (1, 2, 2.5), (1, 3, 3.0), (1, 20, 4.0)] and state(late) == []
    third = rows(spark, (2, 5, 0, 9.0), (2, 19, 0, 8.0), (1, 3, 0, 3.0))  # beyond a week before the 20th: aside
    for _ in range(2):
        run(third, 2)
    assert state(late) == [(1, 3, 3.0), (2, 5, 9.0)] and len(state(bronze)) == 6
    run(second, 1)
    assert state(late) == [(1, 3, 3.0), (2, 5, 9.0)] and len(state(bronze)) == 6


def test_repeats_land_once(spark, tmp_path):
    rows(spark, (1, 1, 0, 1.0), (1, 1, 1, 2.0), (1, 1, 0, 1.0)).coalesce(1).write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema("city_id int, ts timestamp, value double, seen timestamp").parquet(f"{tmp_path}/in")
    streams.stream_land(stream, KEYS, "ts", f"{tmp_path}/out", f"{tmp_path}/state").awaitTermination()
    assert sorted(r.value for r in spark.read.parquet(f"{tmp_path}/out").collect()) == [1.0, 2.0]


def test_monotone_expectation_counts_falls(spark):
    df = spark.createDataFrame([(1, 1, 5), (1, 2, 4), (1, 3, 4), (2, 1, 0), (2, 2, None), (2, 3, -1)], "g int, o int, v int")
    got = checks.check_expectations(df, [{"kind": "monotone", "column": "v", "by": ["g"], "order": ["o"]}]).first()
    assert tuple(got) == ("monotone(v)", 1, False)  # after a null nothing is known


def test_fault_rates_and_seed(spark):
    df = spark.createDataFrame([(c, dt.date(2024, 1, 1) + dt.timedelta(days=n), 10.0) for c in range(3) for n in range(40)], "city_id int, obs_date date, temp_mean double")
    faults = lambda **kw: sorted((r.city_id, r.obs_date, r.temp_mean, r.synthetic_fault) for r in landing.corrupt(df, **kw).fillna(-1.0).collect())
    assert faults() == faults() != faults(seed=1)
    often = [f[3] for f in faults(every={"null": 2, "duplicate": 1000})]
    assert often.count("null") == 60 and "fahrenheit" in often and "duplicate" not in often
