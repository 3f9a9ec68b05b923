import datetime as dt

from pyspark.sql import functions as F

from isoclime.operators import checks
from isoclime.operators import climatology as clim
from isoclime.operators import evaluation as ev
from isoclime.operators import features as ft
from isoclime.operators import model as ml
from isoclime.operators import star
from isoclime.operators.running import running
from isoclime.operators.tree_shapley import tree_shapley

DAY = dt.date(2000, 1, 1)


def days(spark, numbers, flags=()):
    rows = [(1, DAY + dt.timedelta(days=n), float(n), n in flags, 1.0 * (n in flags)) for n in numbers]
    return spark.createDataFrame(rows, "city_id int, obs_date date, temp_mean double, is_anomaly boolean, z double")


def test_gaps_never_shift_rows(spark):
    df = ft.rolling(ft.lags(days(spark, [0, 1, 2, 5, 6, 8]), ["temp_mean"], [1, 3]), widths=[3])
    got = {r.temp_mean: (r.temp_mean_lag1, r.temp_mean_lag3, r.temp_mean_n3) for r in df.collect()}
    assert got == {0: (None, None, 1), 1: (0, None, 2), 2: (1, None, 3), 5: (None, 2, 1), 6: (5, None, 2), 8: (None, 5, 2)}


def test_label_excludes_today_and_is_null_without_a_future(spark):
    df = ft.forward_label(days(spark, range(20), {3}))
    got = {int(r.temp_mean): r.label for r in df.collect()}
    assert [got[i] for i in range(20)] == [1, 1, 1] + [0] * 10 + [None] * 7


def test_future_rows_leave_features_alone(spark):
    cities = spark.createDataFrame([(1, 10.0, 5.0)], "city_id int, latitude double, elevation double")
    daily = days(spark, range(60), {40}).withColumn("surface_pressure", F.col("temp_mean"))
    assert ft.point_in_time_audit(daily, lambda rows: rows, cities, "2000-02-01").count() == 0


def test_audit_reports_baselines_that_look_ahead(spark):
    rows = [(1, dt.date(y, 3, d), float(d * y % 17 + y % 3), 0.0) for y in range(2001, 2007) for d in range(1, 29)]
    daily = spark.createDataFrame(rows, "city_id int, obs_date date, temp_mean double, surface_pressure double")
    cities = spark.createDataFrame([(1, 10.0, 5.0)], "city_id int, latitude double, elevation double")
    leaking = ft.point_in_time_audit(daily, lambda d: clim.anomalies(d, pooling="pooled"), cities, "2003-03-15")
    assert {"z_now", "z_last"} <= {r.feature for r in leaking.collect()}
    strict = ft.point_in_time_audit(daily, lambda d: clim.anomalies(d, pooling="pooled", reference_years=[2001, 2002]), cities, "2003-03-15")
    assert strict.collect() == []


def test_running_sums_equal_plain_ones(spark):
    rows = [(i % 3, (i * 37) % 101, i % 5) for i in range(101)]
    df = spark.createDataFrame(rows, "g int, k int, x int")
    got = {(r.g, r.k): r.total for r in running(df, [F.desc("k")], {"total": "x"}, ["g"]).collect()}
    assert got == {(g, k): sum(x for h, m, x in rows if h == g and m >= k) for g, k, _ in rows}
    got = {r.k: r.total for r in running(df, [F.asc("k")], {"total": "x"}).collect()}
    assert got == {k: sum(x for _, m, x in rows if m <= k) for _, k, _ in rows}
    assert running(df.limit(0), [F.asc("k")], {"total": "x"}).collect() == []


def test_split_purges_labels_across_boundaries(spark):
    out = ft.chronological_split(days(spark, range(40)), "2000-01-10", "2000-01-25").collect()
    got = {}
    for r in out:
        got.setdefault(r.split, []).append(int(r.temp_mean))
    assert (got["train"], got["validate"], got["test"]) == ([0, 1, 2], list(range(10, 18)), list(range(25, 40)))


def test_average_precision_and_trapezoid(spark):
    df = spark.createDataFrame([(0.9, 1), (0.8, 0), (0.7, 1), (0.6, 0)], "score double, label int")
    r = ev.pr_auc(df).first()
    assert round(r.average_precision, 4) == 0.8333 and round(r.trapezoid, 4) == 0.7917
    tied = spark.createDataFrame([(0.5, 1), (0.5, 0), (0.5, 0), (0.5, 0)], "score double, label int")
    assert ev.pr_auc(tied).first().average_precision == 0.25
    assert tuple(ev.best_threshold(df).first()) == (0.7, 0.8)


def test_baseline_reads_training_rows_only(spark):
    rows = [(1, DAY, 1), (1, DAY + dt.timedelta(days=60), 0)]
    train = spark.createDataFrame(rows, "city_id int, obs_date date, label int")
    new = spark.createDataFrame([(1, DAY + dt.timedelta(days=364), 0), (1, DAY + dt.timedelta(days=120), 1), (2, DAY, 1)], train.schema)
    assert sorted(r.score for r in ev.climatology_baseline(train, new).collect()) == [0.5, 0.5, 1.0]


def test_model_learns_repeats_and_explains(spark, tmp_path):
    rows = [(i % 5, DAY + dt.timedelta(days=i // 5), float(i * 37 % 101), float(i * 53 % 89), int(i * 37 % 101 > 70)) for i in range(600)]
    df = spark.createDataFrame(rows, "city_id int, obs_date date, a double, b double, label int")
    model = ml.train(df, ["a", "b"], max_iter=4, depth=2)
    again = ml.train(df.repartition(3), ["a", "b"], max_iter=4, depth=2)
    first, second = (ml.scored(m, df, ["a", "b"]).orderBy("city_id", "obs_date").select("score").collect() for m in (model, again))
    assert first == second
    assert ev.pr_auc(ml.scored(model, df, ["a", "b"])).first().average_precision > 0.95
    phi = tree_shapley(model, df.limit(3), df.filter("city_id = 2").limit(4), ["a", "b"])
    assert {r.feature: r.importance > 0.01 for r in ml.mean_importance(phi).collect()} == {"a": True, "b": False}
    ml.save_model(model, str(tmp_path / "m"), {"features": ["a", "b"]})
    loaded, meta = ml.load_model(str(tmp_path / "m"))
    assert ml.scored(loaded, df, meta["features"]).orderBy("city_id", "obs_date").select("score").collect() == first


def test_history_closes_opens_and_keeps(spark):
    schema = "k int, v string"
    one = star.open_history(spark.createDataFrame([(1, "a"), (2, None), (3, "c")], schema), ["k"], ["v"], "2000-01-01")
    two = star.scd2_snapshot(one, spark.createDataFrame([(1, "b"), (2, None), (4, "d")], schema), ["k"], ["v"], "2001-01-01")
    got = {(r.k, r.v, str(r.valid_from)[:4], str(r.valid_to)[:4]) for r in two.collect()}
    assert got == {(1, "a", "2000", "2001"), (1, "b", "2001", "None"), (2, None, "2000", "None"), (3, "c", "2000", "2001"), (4, "d", "2001", "None")}
    facts = spark.createDataFrame([(1, dt.date(2000, 12, 31)), (1, dt.date(2001, 1, 1)), (9, DAY)], "k int, date date")
    assert sorted(str(r.v) for r in star.as_of_dim(facts, two, ["k"]).collect()) == ["None", "a", "b"]


def test_suite_raises_with_names(spark):
    df = spark.createDataFrame([(1, None), (1, 2)], "k int, v int")
    suite = [("unique", "t", checks.check_unique(df, ["k"])), ("not_null", "t", checks.check_not_null(df, ["k"]))]
    assert [(r["check"], r.failing) for r in checks.run_suite(suite, stop=False).collect()] == [("unique", 1), ("not_null", 0)]
    try:
        checks.run_suite(suite)
        raise AssertionError("no failure raised")
    except RuntimeError as e:
        assert "unique on t (1)" in str(e)
