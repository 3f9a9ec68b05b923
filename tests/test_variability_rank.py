"""Ranks of cities whose means change in their last digits each time they are computed."""

import random

from pyspark.sql import functions as F

from isoclime.operators import climatology as clim

SCHEMA = "city_id int, slot int, sigma double"


def test_every_city_keeps_a_rank_when_means_differ_in_the_last_digits(spark):
    noise = F.udf(lambda: random.random() * 1e-9, "double").asNondeterministic()
    normal = spark.createDataFrame([(c, s, 100.0 + c) for c in range(25) for s in range(4)], SCHEMA)
    got = clim.variability_rank(normal.withColumn("sigma", F.col("sigma") + noise())).collect()
    assert sorted((r.city_id, r["rank"]) for r in got) == [(c, c + 1) for c in range(25)]


def test_a_city_without_a_sigma_comes_last_as_in_sql(spark):
    normal = spark.createDataFrame([(1, 1, None), (2, 1, 3.0), (3, 1, 2.0), (4, 1, None), (5, 1, 3.0)], SCHEMA)
    got = clim.variability_rank(normal).collect()
    assert {r.city_id: r["rank"] for r in got} == {3: 1, 2: 2, 5: 2, 1: 4, 4: 4}
