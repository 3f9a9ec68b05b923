import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from isoclime.llm.common import materialize
from isoclime.llm import exact_dedup, sharding

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def rows(seed=4):
    rng = random.Random(seed)
    bodies = [None, "", "É", "é", "ABC", "abc", "aBc " * 700, "abc " * 700, "x" * 64, "x" * 65, "x" * 128]
    bodies += ["".join(rng.choices("abAB ", k=rng.randint(0, 300))) for _ in range(40)]
    out = [(i, rng.choice(bodies), "t", 1) for i in range(300)]
    return out + [(None, "abc", None, 2), (299, out[299][1], "again", 3), (298, "another text under a used id", None, 4)]


def brute_keep(data):
    groups = {}
    for d, t, *_ in data:
        groups.setdefault((t or "").translate(LOWER), []).append(d)
    best = {k: max((d for d in v if d is not None), default=None) for k, v in groups.items()}
    return sorted(((d, best[k], len(groups[k]), hashlib.sha256(k.encode()).hexdigest()) for d, t, *_ in data if (k := (t or "").translate(LOWER)) is not None), key=str)


@pytest.mark.parametrize("block_hash", [lambda b: F.xxhash64(b), lambda b: (F.octet_length(b) % 3).cast("long")])
def test_matches_brute_force_even_when_hashes_collide(spark, block_hash):
    data = rows()
    df = spark.createDataFrame(data, "doc_id long, text string, keep_id string, _row int")
    got = exact_dedup.exact_dedup(df, block_bytes=64, block_hash=block_hash).collect()
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got), key=str) == brute_keep(data)
    kept = [r for r in got if r.kept]
    assert len(kept) == len({r.text_sha256 for r in got}) == len({r.identity for r in got})
    assert all(r.doc_id == r.keep_id for r in kept)


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert exact_dedup.exact_dedup(df).collect() == []
    assert sharding.shard_by_bytes(df, 4).collect() == []


def test_shards_are_contiguous_and_even(spark):
    data = rows() + [(1000 + i, "y" * (i % 50), None, 0) for i in range(500)]
    df = spark.createDataFrame(data, "doc_id long, text string, shard string, size string").repartition(5)
    got = sharding.shard_by_bytes(df, 7).collect()
    assert sorted(((r.doc_id, r.size, r.text_crc32) for r in got), key=str) == sorted(((d, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for d, t, *_ in data), key=str)
    total, target = sum(r.size for r in got), sum(r.size for r in got) / 7
    order = sorted(got, key=lambda r: r.start_byte)
    assert [r.shard for r in order] == sorted(r.shard for r in order)
    assert [r.doc_id for r in order if r.doc_id is not None] == sorted(d for d, *_ in data if d is not None)
    assert [r.start_byte for r in order] == [sum(x.size for x in order[:i]) for i in range(len(order))] and total > 0
    largest = max(r.size for r in got)
    for s in range(7):
        own = [r for r in order if r.shard == s]
        assert [r.slot for r in own] == list(range(len(own)))
        assert abs(sum(r.size for r in own) - target) <= largest
    assert {(r.law, r.grown_shard) for r in got} == {("bytes", None)}


def test_one_row_and_more_shards_than_rows(spark):
    df = spark.createDataFrame([(5, "abc")], "doc_id long, text string")
    assert [(r.shard, r.slot) for r in sharding.shard_by_bytes(df, 40).collect()] == [(20, 0)]


def test_a_text_that_is_a_third_of_all_rows_leaves_shards_even(spark):
    rows = [(i, "the same text again" if i % 3 == 0 else f"text {i} " + "x" * (i % 40)) for i in range(900)]
    got = sharding.shard_by_bytes(spark.createDataFrame(rows, "doc_id long, text string"), 9).collect()
    sums, copies = {}, set()
    for r in got:
        sums[r.shard] = sums.get(r.shard, 0) + r.size
        if r.doc_id % 3 == 0:
            copies.add(r.shard)
    assert max(sums.values()) - min(sums.values()) <= 2 * max(r.size for r in got) and copies == set(range(9))


def test_a_third_of_all_rows_without_id_and_with_one_text_go_over_many_tasks(spark, monkeypatch):
    import isoclime.llm.sharding as sharding

    seen = []
    keep = lambda df, name: seen.append(materialize(df, name)) or seen[-1]
    monkeypatch.setattr(sharding, "materialize", keep)
    rows = [(None if i % 3 == 0 else i, "same" if i % 3 == 0 else f"text {i}") for i in range(6000)]
    df = spark.createDataFrame(rows, "doc_id int, text string").repartition(6)
    got = sharding.shard_by_bytes(df, 10).collect()
    sizes = [sum(r.size for r in got if r.shard == s) for s in range(10)]
    assert len(got) == 6000 and max(sizes) - min(sizes) < 60
    assert all(sorted(r.slot for r in got if r.shard == s) == list(range(sum(r.shard == s for r in got))) for s in range(10))
    parts = [r["count"] for r in seen[0].filter("_key IS NULL").groupBy("_part").count().collect()]
    assert len(parts) >= 2 and max(parts) < 1900
