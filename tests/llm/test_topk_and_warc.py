import hashlib
import math
import random

import numpy as np
from pyspark.sql import functions as F

from isoclime.llm import topk, warc


def brute_top(vectors, queries, k):
    out = set()
    for q, v in queries:
        scored = sorted(((-sum(a * b for a, b in zip(v, w, strict=False)), i is None, i or 0, i) for i, w in vectors if i != q))[:k]
        out |= {(q, rank, s[3], -s[0]) for rank, s in enumerate(scored, 1)}
    return out


def test_search_matches_brute_force(spark):
    rng = random.Random(2)
    vectors = [(i, [rng.randint(-300, 300) for _ in range(12)]) for i in range(200)]
    vectors += [(300 + i, vectors[7][1]) for i in range(30)]  # ties across the boundary
    vectors += [(400, []), (401, [5]), (402, [0] * 12), (None, vectors[7][1]), (403, [10**6, -(10**6)] * 6)]
    queries = [v for v in vectors if v[0] is not None and (v[0] % 25 == 0 or v[0] in (7, 301, 401, 403))]
    df = spark.createDataFrame(vectors, "id long, v array<long>")
    ask = spark.createDataFrame(queries, "id long, v array<long>")
    for rows, precision in ((1 << 16, 7), (64, 3), (50, 1)):
        got = topk.search(topk.build_index(df, rows, precision), ask, 10, 5)
        assert set(map(tuple, got.collect())) == brute_top(vectors, queries, 10)


def test_few_candidates_repeated_queries_and_empty_tables(spark):
    df = spark.createDataFrame([(1, [1, 2]), (2, [3, 4]), (2, [5, 6])], "id long, v array<long>")
    index = topk.build_index(df)
    assert sorted(map(tuple, topk.search(index, df.filter("id = 2"), 3).collect())) == [(2, 1, 1, 11), (2, 1, 1, 17)]
    assert topk.search(index, df.limit(0)).collect() == []
    assert topk.search(topk.build_index(df.limit(0)), df).collect() == []


def test_unusable_vectors_take_no_part(spark):
    bad = [[1.0, None], [float("nan")], [float("inf")], None]
    df = spark.createDataFrame([(v,) for v in [*bad, [0.5, -0.0004], []]], "embedding array<float>")
    assert [r.v for r in df.select(topk.quantised(F.col("embedding")).alias("v")).collect()] == [None] * 4 + [[512, -1], []]


def test_bitmap_sums():
    rng = np.random.default_rng(0)
    values = rng.integers(0, 2, (40, 130))
    maps = np.stack([np.packbits(np.pad(v, (0, 62)).astype(np.uint8), bitorder="little").view(np.uint64) for v in values])
    sums = topk.add_slices({0: maps[:20], 3: maps[20:]}, 3)
    got = sum(np.unpackbits(s.view(np.uint8), bitorder="little")[:130].astype(int) << p for p, s in enumerate(sums))
    assert (got == values[:20].sum(axis=0) + 8 * values[20:].sum(axis=0)).all()
    for q in range(-40, 41):
        assert sum((-1 if minus else 1) << p for p, minus in topk.signed_digits(q)) == q


def test_url_keys_sort_by_host():
    keys = ["http://WWW.b.example.com:80/x?q=1#f", "https://user@b.example.com:8443", None, "", "no url", "http://[bad"]
    assert [warc.url_key(k) for k in keys] == ["com,example,b,www)/x?q=1", "com,example,b:8443)/", "", "", "no url", "http://[bad"]


def pages():
    rng = random.Random(6)
    bodies = ["", "a" * 99, "b" * 100, "é" * 50, "x" * 5000, "<p>\r\n\r\nWARC/1.1\r\n</p>" * 9] + ["".join(rng.choices("abc<>", k=rng.randint(0, 400))) for _ in range(60)]
    urls = [None, "http://h.example.org/a b\n", "https://é.example.org/ü?x=" + "y" * 50] + [f"http://h{i % 4}.example.org/{i}" for i in range(20)]
    out = [(i, rng.choice(urls), rng.choice(bodies), "x") for i in range(400)]
    return out + [(1000, None, None, "x"), (None, "http://h.example.org/", "b" * 100, "x"), (3, out[3][1], out[3][2], "again")]


def test_archive_round_trip(spark):
    data = pages()
    df = spark.createDataFrame(data, "page_id long, url string, html string, file string").repartition(4)
    captures = warc.write_archives(warc.with_revisits(df), archive_bytes=20_000)
    assert captures.select("file").distinct().count() > 4
    index = warc.build_index(captures, block_lines=7, files=5)
    assert len(index.files) > 1 and len(warc.IndexFile(index.files[0]).blocks) > 1
    got = warc.fetch(warc.lookup(index, captures)).collect()
    first = {}
    for p, _, h, _ in data:
        if p is not None and len((h or "").encode()) >= 100:
            first[h] = min(first.get(h, math.inf), p)
    want = []
    for p, _, h, _ in data:
        body = (h or "").encode()
        to = first.get(h) if first.get(h) != p else None
        want.append((p, len(body), hashlib.sha256(body).hexdigest(), "response" if to is None else "revisit", to, None if to is not None else body))
    assert sorted(((*r[:5], None if r.payload is None else bytes(r.payload)) for r in got), key=str) == sorted(want, key=str)
    missing = spark.createDataFrame([("zz)/", 1), ("", -5)], "url_key string, capture long")
    assert warc.lookup(index, missing).collect() == []
    assert warc.archive_and_read(df.limit(0)).collect() == []


def test_stores_are_named_as_arrow_names_them():
    names = {"s3a://b/p": "s3://b/p", "s3n://b/p": "s3://b/p", "s3://b/p": "s3://b/p", "hdfs://h:1/p": "hdfs://h:1/p", "file:/tmp/a b": "/tmp/a b", "file:///tmp/x": "/tmp/x", "/tmp/x": "/tmp/x", "gs://b/p": "gs://b/p"}
    assert {k: warc.store_uri(k) for k in names} == names
