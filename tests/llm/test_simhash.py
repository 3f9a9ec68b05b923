import random
import re

import numpy as np
import xxhash

from isoclime.llm import simhash
from isoclime.llm.components import components


def brute_fingerprint(text, k=4):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + k]) for i in range(len(words) - k + 1)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << bit for bit in range(64) if sum(h >> bit & 1 for h in hashes) * 2 > len(hashes))


def brute_components(fps):
    """{doc: least doc reachable} for {doc: fingerprint}."""
    comp, docs = {d: d for d in fps}, sorted(fps)

    def root(d):
        while comp[d] != d:
            d = comp[d]
        return d

    for i, a in enumerate(docs):
        for b in docs[:i]:
            if bin(fps[a] ^ fps[b]).count("1") <= 4:
                x, y = sorted((root(a), root(b)))
                comp[y] = x
    return {d: root(d) for d in docs}


def near(rng, base, bits):
    for b in rng.sample(range(64), bits):
        base ^= 1 << b
    return base


def test_fingerprint_matches_brute_force():
    for text in (None, "", "  \t", "One", "ÀB c d", "a b c d e " * 50, "x y z\x1fw v", "Über Öl\nund\x0bmehr Wörter\x00 hier"):
        assert simhash.fingerprint(text) == brute_fingerprint(text)


def test_links_connect_what_brute_force_connects(spark):
    rng = random.Random(3)
    fps = []
    for _ in range(40):
        base = rng.getrandbits(64)
        fps += [base] + [near(rng, base, rng.randint(1, 6)) for _ in range(rng.choice([0, 1, 3, 30]))]
    fps = {i: f for i, f in enumerate(dict.fromkeys(fps))}
    rows = [(int(np.uint64(f).astype(np.int64)),) for f in fps.values()]
    want = brute_components(fps)
    for hot in (2048, 3):  # the second deals every larger cell over finer ones
        links = simhash.fingerprint_links(spark.createDataFrame(rows, "fp long"), 4, hot).collect()
        for a, b in ((r.a_fp, r.b_fp) for r in links):
            assert bin((a ^ b) & (2**64 - 1)).count("1") <= 4
        at = {int(np.int64(r[0])): i for i, r in enumerate(rows)}
        got = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
        classes = {}
        for v, i in at.items():
            classes.setdefault(got.get(v, v), set()).add(i)
        assert sorted(map(sorted, classes.values())) == sorted(
            sorted(i for i in want if want[i] == r) for r in set(want.values())
        )


def test_wide_links_are_verified_and_crowded_cells_complete(spark):
    rng = random.Random(8)
    groups = []
    for size in (1, 1, 2, 40, 60):
        base = [rng.getrandbits(64), rng.getrandbits(64)]
        groups.append([tuple(base)] + [(near(rng, base[0], 2), near(rng, base[1], rng.randint(0, 3))) for _ in range(size - 1)])
    rows = sorted({f for g in groups for f in g})
    signed = lambda f: tuple(int(np.uint64(x).astype(np.int64)) for x in f)
    df = spark.createDataFrame([signed(f) for f in rows], "fp long, fp1 long")
    found = []
    for hot in (2048, 5):
        links = [((r.a_fp, r.a_fp1), (r.b_fp, r.b_fp1)) for r in simhash.fingerprint_links(df, 20, hot, 2).collect()]
        for a, b in links:
            assert sum(bin((x ^ y) & (2**64 - 1)).count("1") for x, y in zip(a, b, strict=True)) <= 20
        edges = spark.createDataFrame(links, "a struct<x:long,y:long>, b struct<x:long,y:long>")
        got = {tuple(r.node): tuple(r.root) for r in components(edges).collect()}
        found.append({frozenset(v for v in got if got[v] == root) for root in set(got.values())})
    assert found[0] == found[1] == {frozenset(map(signed, g)) for g in groups if len(set(g)) > 1}


def test_documents_with_odd_rows(spark):
    texts = {1: None, 2: "", 3: "one two three four five six", 4: "ONE two three four five six", 5: "short", 6: "word " * 5000}
    rows = [(d, t, "en", "en") for d, t in texts.items()] + [(6, texts[6], "en", "x"), (None, "short", None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, fp string, key string")
    got = sorted(map(tuple, simhash.simhash_components(df).collect()), key=str)
    want = brute_components({d: brute_fingerprint(t) for d, t in texts.items()})
    expect = [(d, f"{brute_fingerprint(t):016x}", want[d]) for d, t in texts.items()]
    expect += [(6, f"{brute_fingerprint(texts[6]):016x}", want[6]), (None, f"{brute_fingerprint('short'):016x}", 5)]
    assert got == sorted(expect, key=str)
    assert simhash.simhash_components(df.limit(0)).collect() == []
    wide = sorted(map(tuple, simhash.simhash_components(df, width=2, max_bits=20).collect()), key=str)
    assert [(d, f[:16]) for d, f, _ in wide] == [(d, f) for d, f, _ in got] and {len(f) for _, f, _ in wide} == {32}
    assert simhash.simhash_components(df.limit(0), width=2, max_bits=20).collect() == []


def test_components_of_a_long_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(300)] + [(1000, 1000 + i) for i in range(300)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert len(got) == 601 and len({got[i] for i in range(301)}) == 1 and len(set(got.values())) == 2
