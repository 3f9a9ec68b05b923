"""Periodic runs against a brute-force search."""

import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest

from isoclime.llm import runs as pr


def brute(words, exponent=4, shortest=6):
    """Every maximal stretch of every period, by definition."""
    n, out = len(words), []
    for q in range(1, n // exponent + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            start = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            part = words[start : i + q]
            least = all(part[d:] != part[:-d] for d in range(1, q))
            if least and len(part) >= max(shortest, exponent * q):
                out.append((start, len(part), q))
    return sorted(out, key=lambda r: (r[0], r[2]))


def digest(doc_id, text):
    """The contract's row for one document."""
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n, h = len(words), zlib.crc32(str(doc_id).encode())
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    found = brute(words)
    dropped = {i for s, m, q in found for i in range(s + q, s + m)}
    best = max(found, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=None)
    lines = "".join(f"{s},{m},{q}\n" for s, m, q in found)
    kept = " ".join(w for i, w in enumerate(words) if i not in dropped)
    sha = [hashlib.sha256(t.encode()).hexdigest() for t in (lines, kept)]
    return (doc_id, len(found), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None, *sha)


def sequence(rng, n):
    """Few letters, with powers of short and long words planted, some one letter off."""
    out = []
    while len(out) < n:
        root = [rng.randrange(rng.choice((1, 2, 3, 9))) for _ in range(rng.randrange(1, rng.choice((3, 8, 40))))]
        out += (root * rng.randrange(1, 9))[: rng.randrange(1, 200)]
    return out[:n]


@pytest.mark.parametrize("exponent", [2, 3, 4, 7])
def test_catchers_equal_brute_force_however_words_come(exponent):
    rng = random.Random(exponent)
    for case in range(120):
        seq = sequence(rng, rng.randrange(1, 400))
        words = np.array(seq, np.int64)
        catchers, at = pr.Catchers(len(seq), exponent, 6), 0
        while at < len(seq):
            step = rng.choice((1, 2, 7, 1000)) if case % 2 else 1000
            catchers.append(words[at : at + step])
            at += step
        assert catchers.finish() == brute(seq, exponent, 6), seq


def test_known_squares_are_there_before_the_sequence_ends():
    c = pr.Catchers(1000)
    c.append(np.arange(50) + 10)
    c.append(np.array([1, 2, 3] * 6))
    assert c.open and set(c.open) == {(50, 3)}
    c.append(np.array([1, 2, 9]))
    assert c.runs == {(50, 20, 3)} and not c.open


def test_levels_keep_a_bounded_tail():
    c = pr.Catchers(1 << 16)
    for at in range(0, 1 << 16, 1 << 12):
        c.append(np.arange(at, at + (1 << 12)))
    for k in range(10):
        assert len(c.hashes[k]) <= 6 << k | 1 << 12


def test_words_that_hash_alike_are_told_apart(monkeypatch):
    monkeypatch.setattr(pr, "hash", lambda w: 7, raising=False)
    texts = [pr.Words(b"a b c d e f g h i j"), pr.Words(b"x y x y x y x y x y z")]
    assert pr.find_runs(texts, 4, 6) == [[], [(0, 10, 2)]]


def test_texts(spark, monkeypatch):
    monkeypatch.setattr(pr, "GROUP_BYTES", 100)
    rng = random.Random(2)
    rows = [(None, None), (1, ""), (1, " \t\n"), (2, "no " * 5), (2, "no " * 6), (3, "a b " * 9), (3, "a b " * 9), (4, "x\x0by\x0cx y x y\rx y")]
    rows += [(10 + i, " ".join("abc"[c % 3] * (1 + c) for c in sequence(rng, 150))) for i in range(30)]
    df = spark.createDataFrame([(k, t, "clash", 1) for k, t in rows], "doc_id int, text string, runs string, key int")
    got = [(r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in pr.periodic_runs(df).collect()]
    want = []
    for k, t in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", t or "")
        found = brute(words)
        dropped = {i for s, m, q in found for i in range(s + q, s + m)}
        want.append((k, len(words), found, " ".join(w for i, w in enumerate(words) if i not in dropped)))
    assert sorted(got, key=str) == sorted(want, key=str)
    assert pr.periodic_runs(df.limit(0)).count() == 0
    with pytest.raises(ValueError, match="twice"):
        pr.periodic_runs(df, exponent=1)


def test_query_rows_by_definition(spark, tmp_path):
    rng = random.Random(8)
    rows = [(i, " ".join("abcdefgh"[c % 8] for c in sequence(rng, rng.randrange(0, 120)))) for i in range(150)]
    rows += [(1000 + i, " ".join(str(rng.random()) for _ in range(rng.randrange(1, 90)))) for i in range(60)] + [(2000, None), (2001, "")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted(tuple(r)[:8] for r in pr.op12_periodic_runs(spark, str(tmp_path)).collect())
    assert got == sorted(digest(*r) for r in rows)
    assert sum(zlib.crc32(str(i).encode()) % 10 == 0 for i, _ in rows) > 10


def test_a_long_text_of_one_word():
    n = 300_000
    text = pr.Words(b"a " * n)
    assert pr.find_runs([text], 4, 6) == [[(0, n, 1)]]
