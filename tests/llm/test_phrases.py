"""Collocations against a brute-force count."""

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from isoclime.llm import phrases as ph


def brute(rows, support, share=80, top=2000):
    """The contract, by definition."""
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", lowered):
            words = re.findall("[^ \t]+", piece)
            n[lang] += len(words)
            for d in range(1, 5):
                f.update((lang, tuple(words[i : i + d])) for i in range(len(words) - d + 1))
    found = {k: a for k, a in f.items() if len(k[1]) > 1 and a >= support}
    longer = Counter()
    for (lang, w), a in found.items():
        for size in range(2, len(w)):
            for i in range(len(w) - size + 1):
                part = (lang, w[i : i + size])
                longer[part] = max(longer[part], a)
    out = {}
    for (lang, w), a in found.items():
        if 100 * longer[lang, w] >= share * a:
            continue
        score, _, left, right = min((2000000 * a // (f[lang, w[:k]] + f[lang, w[k:]]), k, f[lang, w[:k]], f[lang, w[k:]]) for k in range(1, len(w)))
        out.setdefault(lang, []).append((-score, -a, " ".join(w).encode(), left, right))
    return sorted((g, i, p.decode(), -a, left, right, n[g], -s) for g, rs in out.items() for i, (s, a, p, left, right) in enumerate(sorted(rs)[:top], 1))


def texts(rng, n):
    words = ["the", "of", "The", "New", "york", "é", "中文", "a b", "x", "\x00y", "in", "spite"]
    out = []
    for _ in range(n):
        t = []
        for _ in range(rng.randrange(60)):
            t.append(rng.choice(["in spite of the", "new york", *words, *words]))
            t.append(rng.choice([" ", " ", " ", "\t ", ". ", ",", "\n", " \r\n"]))
        out.append((rng.choice(["en", "en", "", None, "de"]), "".join(t)))
    return out


@pytest.mark.parametrize("budget", [None, 40, 150, 1000])
def test_brute_force(spark, monkeypatch, budget):
    monkeypatch.setattr(ph, "LEAST_SUFFIXES", 500)
    rows = [*texts(random.Random(4), 250), ("en", None), ("en", ""), (None, "...")]
    df = spark.createDataFrame([(g, t, "clash", 1) for g, t in rows], "lang string, text string, phrase string, a int").repartition(3)
    got = sorted(map(tuple, ph.collocations(df, support=5, budget=budget).collect()))
    assert got == brute(rows, 5)
    assert ph.collocations(df.limit(0), support=5, budget=budget).count() == 0


def test_top_and_ties(spark):
    rows = [("en", "b c. a b. d e, e f. " * 7), ("en", "q r s t u " * 3)]
    df = spark.createDataFrame(rows, "lang string, text string")
    assert sorted(map(tuple, ph.collocations(df, support=3, top=4).collect())) == brute(rows, 3, top=4)
    assert sorted(map(tuple, ph.collocations(df, support=3, share=100).collect())) == brute(rows, 3, share=100)


@pytest.mark.parametrize(("most", "span"), [(1, 1), (7, 5), (50, 1 << 20)])
def test_suffixes_survive_any_cut_of_a_text(most, span):
    rows = [*texts(random.Random(9), 12), ("en", None), ("fr", "one long piece of words without an end " * 5)]
    batch = pa.RecordBatch.from_arrays([pa.array([g or "und" for g, _ in rows]), pa.array([(t or "").encode() for _, t in rows])], ["lang", "text"])
    got = Counter()
    for lang, ids, upto, spelt in ph.streams(iter([batch]), most, span):
        got.update((lang, tuple(spelt[i] for i in s if i)) for s in np.stack(ph.suffixes(ids, upto)).T.tolist())
    want = Counter()
    for lang, text in rows:
        for piece in re.split(b"[.,;:!?\n\x0b\x0c\r]", (text or "").encode().translate(bytes.maketrans(ph.UPPER.encode(), ph.UPPER.lower().encode()))):
            words = re.findall(rb"[^ \t]+", piece)
            want.update((lang or "und", tuple(words[i : i + 4])) for i in range(len(words)))
    assert got == want


def test_one_prefix_in_most_suffixes(spark):
    rows = [("en", "hot pair of " + "word" + str(i % 40) + ". hot pair of the same line") for i in range(400)]
    df = spark.createDataFrame(rows, "lang string, text string").repartition(5)
    assert sorted(map(tuple, ph.collocations(df, support=6, budget=50).collect())) == brute(rows, 6)


def test_a_product_beyond_64_bits(spark):
    from pyspark.sql import functions as F

    df = spark.sql("SELECT 5000000000000000L AS a, 6000000000000000L AS l, 7000000000000000L AS r")
    assert df.select(F.expr("cast(cast(a as decimal(20, 0)) * 2000000 div (l + r) as bigint)")).first()[0] == 2000000 * 5 // 13
