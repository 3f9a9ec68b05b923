"""Gates on the write, the stored prediction table, and drift from sketches."""

import datetime as dt
import os
import random

import pytest
from pyspark.sql import functions as F

from isoclime.operators import checks
from isoclime.operators import evaluation as ev
from isoclime.operators import model as ml

DAY = dt.date(2000, 1, 1)
RULES = {
    "not_null": ["k"], "accepted": {"kind": ["a", "b"]}, "range": {"v": (0.0, 99.0)}, "regex": {"name": "^n[0-9]+$"},
}


def table(spark, n=1000):
    return spark.range(n).selectExpr("cast(id as int) k", "if(id % 2 = 0, 'a', 'b') kind", "cast(id % 100 as double) v", "concat('n', id) name", "cast(id % 3 as int) part")


def test_one_scan_checks_everything_and_publishes(spark, tmp_path):
    scans = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            scans.add(b.num_rows)
            yield b

    df = table(spark)
    report = checks.gated_write(df.mapInArrow(count, df.schema), f"{tmp_path}/t", checks.row_rules(RULES), by=["part"])
    assert scans.value == 1000 and report == [("rows", 0), ("not_null(k)", 0), ("accepted(kind)", 0), ("range(v)", 0), ("regex(name)", 0)]
    assert spark.read.parquet(f"{tmp_path}/t").count() == 1000 and os.listdir(tmp_path) == ["t"]


def test_a_failing_write_leaves_no_table_and_keeps_the_old_one(spark, tmp_path):
    good, path = table(spark), f"{tmp_path}/t"
    bad = good.withColumns({"k": F.when(F.col("k") > 9, F.col("k")), "v": F.col("v") * 2, "kind": F.when(F.col("k") == 1, "z").otherwise(F.col("kind"))})
    with pytest.raises(checks.GateError) as e:
        checks.gated_write(bad, path, checks.row_rules(RULES))
    assert dict(e.value.report) == {"rows": 0, "not_null(k)": 10, "accepted(kind)": 1, "range(v)": 500, "regex(name)": 0}
    assert os.listdir(tmp_path) == [] and "range(v) (500)" in str(e.value)
    checks.gated_write(good, path, checks.row_rules(RULES))
    for wrong in (bad, good.limit(0)):
        with pytest.raises(checks.GateError):
            checks.gated_write(wrong, path, checks.row_rules(RULES))
    assert spark.read.parquet(path).count() == 1000 and os.listdir(tmp_path) == ["t"]


def predictions(spark, dates, cities, version, hour):
    rows = [(c, DAY + dt.timedelta(days=d), hash((c, d, version)) % 97 / 97, c % 2, version, dt.datetime(2026, 1, 1, hour)) for d in dates for c in cities]
    return spark.createDataFrame(rows, "city_id int, forecast_date date, risk_score double, label int, model_version string, scored_at timestamp")


def files(path):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")}


def test_two_upserts_equal_one_and_touch_their_dates_only(spark, tmp_path):
    path = f"{tmp_path}/predictions"
    one, two = predictions(spark, range(10), range(6), "v1", 1), predictions(spark, range(7, 12), range(3, 9), "v2", 2)
    ml.store_predictions(one, path)
    before = files(path)
    ml.store_predictions(two, path)
    want = sorted(map(tuple, ml.upsert_predictions(one, two).collect()))
    assert sorted(map(tuple, ml.stored_predictions(spark, path, one).collect())) == want
    after = files(path)
    kept = {f: t for f, t in before.items() if f.split("forecast_date=")[1][:10] < "2000-01-08"}
    assert len(kept) >= 7 and kept.items() <= after.items()
    ml.store_predictions(two, path)
    ml.store_predictions(one, path)  # older than what is there
    ml.store_predictions(one.limit(0), path)
    assert sorted(map(tuple, ml.stored_predictions(spark, path, one).collect())) == want
    plan = ml.stored_predictions(spark, path, one, [DAY])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(forecast_date" in plan or "PartitionFilters: [(forecast_date" in plan


def test_a_run_that_ended_before_the_replacement_is_finished_by_the_next(spark, tmp_path):
    path = f"{tmp_path}/predictions"
    one, two = predictions(spark, range(4), range(3), "v1", 1), predictions(spark, range(2, 5), range(3), "v2", 2)
    ml.store_predictions(one, path)
    ml.upsert_predictions(ml.stored_predictions(spark, path, one, [DAY + dt.timedelta(days=d) for d in range(2, 5)]), two).write.parquet(f"{path}-pending")
    ml.store_predictions(predictions(spark, [30], [1], "v3", 3), path)
    got = {(r.city_id, r.forecast_date): r.model_version for r in ml.stored_predictions(spark, path, one).collect()}
    assert len(got) == 5 * 3 + 1 and got[1, DAY + dt.timedelta(days=4)] == "v2" and got[0, DAY] == "v1"
    assert os.listdir(tmp_path) == ["predictions"]


def test_sketch_edges_lie_within_the_rank_error(spark):
    rng = random.Random(7)
    values = [rng.gauss(0, 1) ** 3 for _ in range(40_000)]
    df = spark.createDataFrame([(i % 5, v) for i, v in enumerate(values)], "year int, x double").repartition(4)
    k = 512
    edges = ev.sketch_edges(ev.merged(ev.sketches(df, ["x"], k=k), k), 10).first().edges
    ordered = sorted(values)
    for i, e in enumerate(edges, 1):
        below = sum(v <= e for v in ordered) / len(ordered)
        assert abs(below - i / 10) < 3 * 1.8 / k
    assert edges == sorted(edges) and len(edges) == 9


def test_sketch_drift_equals_drift_over_the_same_edges(spark):
    rows = [(y, float((i * 37 + y) % 101), None if i % 10 == y % 10 else float(i % 7)) for y in range(1, 7) for i in range(300)]
    df = spark.createDataFrame(rows, "year int, a double, b double").withColumn("c", F.lit(None).cast("double"))
    parts = ev.sketches(df, ["a", "b", "c"])
    got = {r.feature: r.psi for r in ev.sketch_drift(parts.filter("year < 4"), parts.filter("year >= 4")).collect()}
    edges = {r.feature: r.edges for r in ev.sketch_edges(ev.merged(parts.filter("year < 4")), 8).collect()}
    nudged = {c: [e + 1e-9 for e in edges[c]] for c in ("a", "b")}  # there, an edge belongs to the bucket above
    want = {r.feature: r.psi for r in ev.drift(df.filter("year < 4"), df.filter("year >= 4"), nudged).collect()}
    assert edges["c"] == [] and got.pop("c") == 0.0
    assert got == pytest.approx(want, abs=1e-12)
