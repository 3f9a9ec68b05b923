from pyspark.sql import functions as F

from isoclime.operators import climatology as clim
from isoclime.plans import queries_climate as qc


def test_audit_without_a_list_sees_a_leak_in_any_city(spark, sf_dir):
    obs = qc.daily(spark, sf_dir)
    z = clim.zscore(obs, clim.loyo_normals(obs)).filter("n IS NOT NULL")
    last = z.agg(F.max("city_id")).first()[0]
    assert last > 4
    leaked = z.withColumn("n", F.col("n") + F.when(F.col("city_id") == last, 1).otherwise(0))
    got = {r.city_id: r.max_n_diff for r in clim.leakage_audit(obs, leaked).collect()}
    assert set(got) == {r.city_id for r in z.filter("n >= 2").select("city_id").distinct().collect()}
    assert {c for c, d in got.items() if d} == {last}
