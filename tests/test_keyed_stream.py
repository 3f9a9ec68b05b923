"""The keyed stream against the operator that reads its tables again, over several runs."""

import datetime as dt

import pytest

from isoclime.streaming import streams

KEYS, VALUES, SCHEMA = ["city_id", "ts"], ["value"], "city_id int, ts timestamp, value double, seen timestamp"


def rows(spark, *cells):
    data = [(c, dt.datetime(2024, 1, d, h), v, dt.datetime(2024, 2, 1)) for c, d, h, v in cells]
    return spark.createDataFrame(data, SCHEMA)


BATCHES = [
    [(1, 1, 0, 1.0), (1, 2, 0, 2.0), (1, 2, 0, 2.0)],
    [(1, 3, 0, 3.0), (1, 20, 0, 4.0), (1, 2, 0, 2.5), (1, 2, 0, None)],
    [(2, 5, 0, 9.0), (2, 19, 0, 8.0), (1, 3, 0, 3.5), (1, 20, 0, 4.0), (1, 20, 1, 4.0), (1, 2, 0, None)],
    [(2, 5, 0, 9.0), (2, 19, 0, 8.0), (3, 14, 0, 7.0), (3, 12, 0, 7.0)],
]


@pytest.fixture
def rocks(spark):
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key, None)
    spark.conf.set(key, streams.STATE_STORE)
    yield
    spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def state(df):
    return sorted((r.city_id, r.ts.day, r.ts.hour, str(r.value)) for r in df.collect())


def test_same_rows_as_the_operator_that_reads_its_tables(spark, tmp_path, rocks):
    bronze, late, marks = (f"{tmp_path}/{n}" for n in ("bronze", "late", "marks"))
    for n, cells in enumerate(BATCHES):
        streams.upsert_batch(rows(spark, *cells), n, KEYS, VALUES, "ts", "seen", bronze, late, marks)
        rows(spark, *cells).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        stream = streams.read_folder(spark, f"{tmp_path}/in", rows(spark).schema if cells is None else rows(spark, *cells).schema)
        streams.stream_versions(stream, KEYS, VALUES, "ts", "seen", f"{tmp_path}/out", f"{tmp_path}/check").awaitTermination()
    got = spark.read.parquet(f"{tmp_path}/out")
    assert state(got.filter("is_late = 0")) == state(spark.read.parquet(bronze))
    known = (1, 2, 0, "None")  # landed in time before: repeated late, it's a repeat here, and a late row there
    assert state(got.filter("is_late = 1")) == sorted(r for r in state(spark.read.parquet(late)) if r != known)


def test_state_is_bounded_by_days_and_repeats_land_again_after_it(spark, tmp_path, rocks):
    sizes = []
    for n in range(4):
        day = dt.datetime(2024, 1, 1) + dt.timedelta(days=40 * n)
        cells = [(c, day + dt.timedelta(hours=h), 1.0, day) for c in range(3) for h in range(4)]
        spark.createDataFrame(cells, SCHEMA).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        stream = streams.read_folder(spark, f"{tmp_path}/in", spark.createDataFrame(cells, SCHEMA).schema)
        query = streams.stream_versions(stream, KEYS, VALUES, "ts", "seen", f"{tmp_path}/out", f"{tmp_path}/check", keep_days=5)
        query.awaitTermination()
        reader = spark.read.format("statestore").option("stateVarName", "seen").load(f"{tmp_path}/check")
        sizes.append(reader.count())
    assert max(sizes) <= 24 and sizes[-1] <= 24
    assert spark.read.parquet(f"{tmp_path}/out").count() == 48
