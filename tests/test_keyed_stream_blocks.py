"""State of the keyed stream in blocks: few entries a group, however many versions, and the same answers as a set."""

import datetime as dt
import random
from types import SimpleNamespace

import numpy as np
import pandas as pd
import pytest

from isoclime.streaming import streams

SCHEMA = "city_id int, ts timestamp, value double, seen timestamp"


@pytest.fixture
def rocks(spark):
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key, None)
    spark.conf.set(key, streams.STATE_STORE)
    yield
    spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def test_a_group_of_many_versions_takes_few_state_entries(spark, tmp_path, rocks):
    day, n = dt.datetime(2024, 1, 1), 3000
    for run in range(2):  # the second run repeats half of the first
        cells = [(1, day + dt.timedelta(seconds=i), 1.0, day) for i in range(run * n // 2, run * n // 2 + n)]
        spark.createDataFrame(cells, SCHEMA).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        stream = streams.read_folder(spark, f"{tmp_path}/in", spark.createDataFrame(cells, SCHEMA).schema)
        streams.stream_versions(stream, ["city_id", "ts"], ["value"], "ts", "seen", f"{tmp_path}/out", f"{tmp_path}/check").awaitTermination()
    assert spark.read.format("statestore").option("stateVarName", "seen").load(f"{tmp_path}/check").count() <= 2 * streams.SHARES
    out = spark.read.parquet(f"{tmp_path}/out")
    assert out.count() == out.select("ts").distinct().count() == n * 3 // 2


class Listed:
    """A list state in memory."""

    def __init__(self):
        self.rows = []

    def get(self):
        return iter(list(self.rows))

    def appendValue(self, row):
        self.rows.append(row)

    def put(self, rows):
        self.rows = list(rows)


def test_blocks_answer_as_a_set_does_over_many_batches():
    rng, listed, timers = random.Random(7), Listed(), []
    # few distinct bytes, zeros first and last among them: digests that differ at their ends only
    ids = [bytes([a]) + bytes(14) + bytes([b]) for a in range(40) for b in range(40)]
    processor = streams.Versions(["version_id"], 1000)
    processor.init(SimpleNamespace(getListState=lambda *_: listed, registerTimer=timers.append))
    known, most = set(), 0
    for _ in range(3 * streams.MOST_BLOCKS):
        parts = [[rng.choice(ids) for _ in range(rng.randint(1, 8))] for _ in range(rng.randint(1, 3))]
        want = []
        for version in (v for p in parts for v in p):
            if version not in known:
                known.add(version)
                want.append(version)
        frames = (pd.DataFrame({"version_id": p, "stamp_ms": range(len(p))}) for p in parts)
        got = [v for out in processor.handleInputRows(None, frames, SimpleNamespace(getCurrentWatermarkInMs=lambda: 0)) for v in out["version_id"]]
        assert got == want
        most = max(most, len(listed.rows))
    assert most <= streams.MOST_BLOCKS and sum(len(b) for (b,) in listed.rows) == 16 * len(known)


def test_known_digests_against_a_set():
    rng = np.random.default_rng(3)
    known, plain = streams.Known(), set()
    for size in (1, 1, 5, 0, 300, 2, 1000, 40):
        raw = rng.integers(0, 256, (size, 16), dtype=np.uint8).tobytes()
        known.add(np.frombuffer(raw, streams.DIGEST))
        plain |= {raw[i : i + 16] for i in range(0, len(raw), 16)}
    held = np.frombuffer(b"".join(sorted(plain)), streams.DIGEST)
    assert known.holds(held).all() and not known.holds(np.frombuffer(bytes(16) + b"\xff" * 16, streams.DIGEST)).any()
    assert len(known.blocks) <= 11
