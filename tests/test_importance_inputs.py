from isoclime.operators import features as ft
from isoclime.operators import model as ml
from isoclime.plans import queries_climate as qc


def test_importance_reads_all_rows_and_features(spark, sf_dir, monkeypatch):
    rows, seen, trained = qc.saved_features(spark, sf_dir), {}, []
    monkeypatch.setattr(qc, "saved_features", lambda *_: rows)
    monkeypatch.setattr(ml, "train", lambda df, **options: trained.append(options))
    empty = spark.createDataFrame([], "row_id int, feature string, phi double")
    monkeypatch.setattr(qc, "tree_shapley", lambda m, df, back, features: seen.update(test=df, train=back, features=features) or empty)
    monkeypatch.setattr(ml, "permutation_importance", lambda m, df, columns: seen.update(validate=df, columns=columns) or empty)
    qc.f11(spark, sf_dir)
    qc.f12(spark, sf_dir)
    for split in ("test", "train", "validate"):
        assert seen[split].count() == rows.filter(f"split = '{split}'").count() > 0
    assert list(seen["columns"]) == list(seen["features"]) == list(ft.FEATURES) and trained == [{}, {}]
