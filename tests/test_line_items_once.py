"""Queries that pass over the daily series several times read the line items once."""

import pytest

from isoclime.plans import queries_climate as qc

SEVERAL = ["d5_smoothed_zscore", "d7_zscore", "d7_guarded_zscore", "d11_leap_audit", "d12_leakage_audit", "f15_drift"]


def reads(df):
    return any("lineitem.parquet" in f for f in df.inputFiles())


@pytest.mark.parametrize("name", ["saved_features", *SEVERAL])
def test_line_items_are_read_by_one_written_frame(spark, sf_dir, monkeypatch, name):
    kept, plain = [], qc.saved

    def saved(df, label):
        kept.append(reads(df))
        return plain(df, label)

    monkeypatch.setattr(qc, "saved", saved)
    out = (qc.QUERIES.get(name) or getattr(qc, name))(spark, sf_dir)
    assert kept.count(True) == 1 and not reads(out)
