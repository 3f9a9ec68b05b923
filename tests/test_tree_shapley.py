"""Exact tree Shapley values against full enumeration of coalitions, and permutation importance against known values."""

import datetime as dt
import itertools
import math

import pytest
from pyspark.sql import functions as F

from isoclime.operators import model as ml
from isoclime.operators.evaluation import pr_auc
from isoclime.operators.tree_shapley import leaves, margin, tree_shapley

NAMES = ["a", "b", "c", "d"]
DAY = dt.date(2000, 1, 1)


@pytest.fixture(scope="module")
def table(spark):
    rows = []
    for i in range(400):
        a, b, c, d = float(i * 37 % 101), float(i * 53 % 89), float(i * 7 % 13), float(i * 11 % 17)
        rows.append((i % 5, DAY + dt.timedelta(days=i // 5), a, b if i % 9 else None, c, d, int(a + 2 * b > 140 and c > 4)))
    return spark.createDataFrame(rows, "city_id int, obs_date date, a double, b double, c double, d double, label int")


@pytest.fixture(scope="module")
def model(table):
    return ml.train(table, NAMES, max_iter=5, depth=4)


def enumerated(model, spark, x, back):
    """Shapley values of one row by all coalitions, scored by the model itself."""
    subsets = [s for k in range(5) for s in itertools.combinations(range(4), k)]
    mixed = [(subsets.index(s), *(x[i] if i in s else z[i] for i in range(4))) for s in subsets for z in back]
    df = spark.createDataFrame(mixed, "s int, a double, b double, c double, d double")
    v = {subsets[r.s]: r.v for r in margin(model, df, NAMES).groupBy("s").agg(F.avg("margin").alias("v")).collect()}
    out = []
    for i in range(4):
        others = [s for s in subsets if i not in s]
        weight = [math.factorial(len(s)) * math.factorial(3 - len(s)) / 24 for s in others]
        out.append(sum(w * (v[tuple(sorted((*s, i)))] - v[s]) for w, s in zip(weight, others, strict=True)))
    return out


def test_equals_full_enumeration(spark, table, model):
    assert {f for _, _, path in leaves(model) for f, _, _ in path} >= {0, 1, 2}
    back = table.filter("city_id = 2").limit(25)
    rows = table.filter("city_id = 3").orderBy("obs_date").limit(6)
    got = {}
    for r in tree_shapley(model, rows, back, NAMES).collect():
        got.setdefault((r.city_id, r.obs_date), {})[r.feature] = r.phi
    others = [tuple(r) for r in back.select(*NAMES).collect()]
    assert any(None in z for z in others)
    for r in rows.collect():
        want = enumerated(model, spark, [r[c] for c in NAMES], others)
        assert [got[r.city_id, r.obs_date][c] for c in NAMES] == pytest.approx(want, abs=1e-9)


def test_sums_are_margins_above_the_background_mean(table, model):
    sums = tree_shapley(model, table, table, NAMES).groupBy("city_id", "obs_date").agg(F.sum("phi").alias("s"), F.count("*").alias("n"))
    known = margin(model, table, NAMES)
    mean = known.agg(F.avg("margin")).first()[0]
    both = sums.join(known, ["city_id", "obs_date"]).select((F.abs(F.col("s") - F.col("margin") + mean) < 1e-9).alias("ok"), "n").collect()
    assert len(both) == 400 and all(r.ok and r.n == 4 for r in both)


def test_no_row_meets_another_row(table, model):
    plan = tree_shapley(model, table, table, NAMES)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan and "Python" not in plan


def test_permutation_importance_has_the_drop_of_a_known_shuffle(spark, table):
    """The useful feature loses what its permutation, made again by hand, loses; a useless one loses nothing."""
    rows = table.select("city_id", "obs_date", F.col("label").cast("double").alias("useful"), F.lit(1.0).alias("useless"), "label")
    model = ml.train(rows, ["useful", "useless"], max_iter=2, depth=1)
    got = {r.feature: r.importance for r in ml.permutation_importance(model, rows, ["useful", "useless"], ["useful", "useless"]).collect()}
    known = ml.scored(model, rows, ["useful", "useless"])
    assert pr_auc(known).first().average_precision == 1.0
    ordered = rows.withColumn("i", F.expr("row_number() OVER (ORDER BY city_id, obs_date)").cast("long"))
    spots = ordered.withColumn("h", F.xxhash64(F.lit(ml.SEED), F.lit("useful"), "i")).select("h", "i", "useful").collect()
    drawn = [r.useful for r in sorted(spots, key=lambda r: (r.h, r.i))]
    labels = [r.label for r in ordered.orderBy("i").collect()]
    n, positives = len(labels), sum(labels)
    high = [y for y, x in zip(labels, drawn, strict=True) if x == 1.0]
    average = sum(high) / positives * sum(high) / len(high) + (1 - sum(high) / positives) * positives / n
    assert got["useless"] == 0.0
    assert got["useful"] == pytest.approx(1.0 - average, abs=1e-12)
