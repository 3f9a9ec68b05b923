"""Licence scans: a trained paragraph classifier whose predictions templates must confirm.

A paragraph is a run of lines with words; lines without any (blank ones, or bare comment marks) part paragraphs, so
a notice is read across its line breaks. Each paragraph is scored in overlapping windows of two sizes, short and
long (``SIZES`` pieces of ``PIECE`` words, one starting at each piece), which cover all of it: sparse hashed word 1- and 2-grams go through a multinomial logistic regression over licence
families and an unknown class. It is trained on notices written out from the templates below, alone and amid the
corpus' own words, and on unknown text: names of no known licence, and a bounded sample of the corpus
(``SAMPLE_WINDOWS`` windows, one a document, chosen by a hash whose rate follows from a count). A temperature
fitted on templates and windows held out of a first training calibrates the scores; the second training then uses all.

A window's families are those that are likelier than unknown, so a window may name several; a family counts only
where one of its templates is found in the window, up to one word pair in ``SPARE``. Scanning is one pass over the
whole texts, without a shuffle.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table
from .repeats import BASE, INVERSE, MIX, _power

BITS, SAMPLE_WINDOWS, WINDOW_BYTES, THRESHOLD, UNKNOWN = 16, 1500, 4096, 0.5, "unknown"
#: Words of a piece, pieces of short and long windows (a template fits into all pieces of one but one), and how many pairs of a template allow one to be missing.
PIECE, SIZES, SPARE = 6, (2, 5), 8
#: Names and characteristic phrases of licence families.
TEMPLATES: dict[str, list[str]] = {
    "MIT": [
        "MIT License", "the MIT license", "SPDX MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
        "to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software",
    ],
    "Apache-2.0": [
        "Apache License, Version 2.0", "Apache License 2.0", "Apache-2.0", "Apache Software License 2.0",
        "you may not use this file except in compliance with the License",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS BASIS",
    ],
    "GPL-3.0": [
        "GNU General Public License, version 3", "GNU General Public License v3", "GNU GPL v3", "GNU GPLv3", "GPL-3.0",
        "either version 3 of the License, or (at your option) any later version",
    ],
    "GPL-2.0": [
        "GNU General Public License, version 2", "GNU General Public License v2", "GNU GPL v2", "GNU GPLv2", "GPL-2.0",
        "either version 2 of the License, or (at your option) any later version",
    ],
    "LGPL": ["GNU Lesser General Public License", "GNU LGPL", "LGPL-3.0", "LGPL-2.1"],
    "AGPL-3.0": ["GNU Affero General Public License", "GNU AGPL", "AGPL-3.0"],
    "BSD": [
        "BSD 3-Clause License", "BSD 2-Clause License", "the BSD license", "BSD-3-Clause", "BSD-2-Clause",
        "Redistribution and use in source and binary forms, with or without modification, are permitted",
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products",
    ],
    "MPL-2.0": [
        "Mozilla Public License, version 2.0", "Mozilla Public License", "MPL-2.0",
        "This Source Code Form is subject to the terms of the Mozilla Public License",
    ],
    "ISC": ["ISC License", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"],
    "CC-BY": ["CC BY 4.0", "Creative Commons Attribution 4.0 International License", "CC-BY-4.0"],
    "CC-BY-SA": ["CC BY-SA 4.0", "Creative Commons Attribution-ShareAlike 4.0 International License", "CC-BY-SA-4.0"],
    "CC-BY-NC": ["CC BY-NC 4.0", "Creative Commons Attribution-NonCommercial 4.0 International License", "CC-BY-NC-4.0"],
    "CC-BY-ND": ["CC BY-ND 4.0", "Creative Commons Attribution-NoDerivatives 4.0 International License", "CC-BY-ND-4.0"],
    "CC0": ["CC0 1.0", "Creative Commons Zero", "CC0 1.0 Universal Public Domain Dedication"],
    "Unlicense": ["the Unlicense", "This is free and unencumbered software released into the public domain"],
    "EPL": ["Eclipse Public License", "EPL-2.0", "Eclipse Public License, version 2.0"],
}
#: Identifiers that name a family after one of the markers.
IDENTIFIERS = {
    "MIT": ["MIT"], "Apache-2.0": ["Apache-2.0", "Apache 2.0"], "GPL-3.0": ["GPL-3.0", "GPLv3"], "GPL-2.0": ["GPL-2.0", "GPLv2"], "LGPL": ["LGPL"],
    "AGPL-3.0": ["AGPL-3.0", "AGPLv3"], "BSD": ["BSD", "0BSD"], "MPL-2.0": ["MPL-2.0"], "ISC": ["ISC"], "CC0": ["CC0"], "Unlicense": ["Unlicense"], "EPL": ["EPL-2.0"],
}
MARKERS = ["SPDX-License-Identifier: {}", "License: {}", "Licence: {}"]
CARRIERS = [
    "{}", "Licensed under {}.", "Licensed under the {}.", "Released under the {}.", "Released under {}.", "This work is licensed under the {}.",
    "This software is distributed under the terms of the {}.", "License: {}", "SPDX-License-Identifier: {}", "Copyright (c) 2020 the authors. {}",
    "See the file LICENSE for the {}.", "All files are covered by {} unless noted.",
]
PHRASES = {f: own + [m.format(i) for i in IDENTIFIERS.get(f, []) for m in MARKERS] for f, own in TEMPLATES.items()}
_SPACED = bytes(b if chr(b).isalnum() or b >= 128 or b == 10 else 32 for b in range(256))


def _tokens(text: str) -> list[str]:
    return re.findall(r"[^\W_]+", text.lower())


def _pairs(words: list[str]) -> list[tuple[str, str]]:
    return list(zip(words, words[1:], strict=False))


_PHRASE_PAIRS = {f: [_pairs(_tokens(p)) for p in own] for f, own in PHRASES.items()}


def confirm(family: str, have: set[tuple[str, str]]) -> float:
    """The largest share of a template's word pairs in ``have`` among templates that lack at most one in ``SPARE``; else 0."""
    shares = [(sum(p in have for p in own), len(own)) for own in _PHRASE_PAIRS[family]]
    return max((n / of for n, of in shares if of - n <= of // SPARE), default=0.0)


@dataclass
class Words:
    """The words of some texts: the lower-cased bytes, where each word stands, the grams that start at it, and its piece."""

    data: bytes
    starts: np.ndarray
    ends: np.ndarray
    single: np.ndarray
    double: np.ndarray
    piece: np.ndarray
    first: np.ndarray  # first word of each piece
    paragraph: np.ndarray  # of each piece
    text: np.ndarray  # of each paragraph
    windows: np.ndarray  # pieces that start a window
    after: np.ndarray  # of each window: the piece after its last

    def window(self, i: int) -> str:
        """The words of a window, as they stand."""
        end = self.after[i]
        last = (self.first[end] if end < len(self.first) else len(self.starts)) - 1
        return self.data[self.starts[self.first[self.windows[i]]] : self.ends[last]].decode("utf-8", "replace")


NO_GRAM = 1 << BITS  # a feature that weighs nothing


def words_of(texts: list[str]) -> Words:
    parts = [t.lower().encode("utf-8", "surrogatepass") for t in texts]
    whole = b"\n\n".join(parts) + b" "
    a = np.frombuffer(whole.translate(_SPACED), np.uint8)
    edge = np.diff(np.concatenate(([0], ((a != 32) & (a != 10)).astype(np.int8))))
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    n = len(starts)
    sums = np.zeros(len(a) + 1, np.uint64)
    np.cumsum((a.astype(np.uint64) + np.uint64(1)) * _power(INVERSE, len(a)), out=sums[1:])
    names = (sums[ends] - sums[starts]) * _power(BASE, len(a))[starts]
    mixed = lambda x: (((x ^ (x >> np.uint64(29))) * MIX[0]) >> np.uint64(64 - BITS)).astype(np.int64)
    line = np.cumsum(a == 10)[starts]
    opens = np.concatenate((np.ones(min(n, 1), bool), np.diff(line) > 1))  # a line without words lies between
    paragraph = np.cumsum(opens) - 1
    within = np.arange(n) - np.flatnonzero(opens)[paragraph]
    heads = within % PIECE == 0
    double = np.full(n, NO_GRAM, np.int64)
    if n > 1:
        double[:-1] = np.where(opens[1:], NO_GRAM, mixed(names[:-1] * MIX[1] + names[1:]))
    first = np.flatnonzero(heads)
    own = paragraph[first]
    offsets = np.cumsum([0, *(len(p) + 2 for p in parts)])[:-1]
    text = np.searchsorted(offsets, starts[opens], side="right") - 1
    ends_at = np.searchsorted(own, own, side="right")  # the piece after the paragraph's last
    place = np.arange(len(own))
    each = [np.flatnonzero((place + size <= ends_at) | (within[first] == 0)) for size in SIZES]
    after = np.concatenate([np.minimum(w + size, ends_at[w]) for w, size in zip(each, SIZES, strict=True)])
    return Words(whole, starts, ends, mixed(names), double, np.cumsum(heads) - 1, first, own, text, np.concatenate(each), after)


@dataclass
class LicenceModel:
    """Families (the last is unknown), weights by feature and family (a row of zeros last), biases, and the temperature."""

    families: list[str]
    weights: np.ndarray
    bias: np.ndarray
    temperature: float = 1.0

    def margins(self, words: Words) -> np.ndarray:
        """Scores of all windows before the softmax."""
        if not len(words.starts):
            return np.zeros((0, len(self.families)), np.float32)
        add = lambda x: np.concatenate((np.zeros((1, x.shape[1])), np.cumsum(np.add.reduceat(x, words.first), axis=0, dtype=np.float64)))
        sums, grams = add(self.weights[words.single] + self.weights[words.double]), add(1.0 + (words.double != NO_GRAM)[:, None])
        inside = lambda x: x[words.after] - x[words.windows]
        return self.bias + inside(sums) / np.sqrt(inside(grams))

    def odds(self, margins: np.ndarray) -> np.ndarray:
        """Calibrated probability of each family against unknown alone."""
        return 1 / (1 + np.exp(-(margins[:, :-1] - margins[:, -1:]) / self.temperature))


def _crc(text: str) -> int:
    return zlib.crc32(text.encode("utf-8", "surrogatepass"))


def examples(unknown: list[str]) -> list[tuple[str, str, bool]]:
    """(family, text, held out): every template in every carrier and amid corpus words; carriers around corpus words; corpus windows."""
    words, out, at = [w for u in unknown for w in u.split()], [], 0

    def some(n: int) -> str:
        nonlocal at
        at += n
        return " ".join(words[at - n : at] if at <= len(words) else (words * (1 + at // max(len(words), 1)))[at - n : at])

    for family, own in PHRASES.items():
        for number, name in enumerate(own):
            held = number > 0 and _crc(name) % 4 == 0
            out += [(family, c.format(name), held) for c in CARRIERS]
            n = len(_tokens(name))
            room = next(size * PIECE - n for size in SIZES if n <= (size - 1) * PIECE)
            for before in (0, room // 4, room // 2, room - room // 4, room):
                out.append((family, f"{some(before)} {name} {some(room - before)}", held))
    for i in range(25 * len(CARRIERS)):
        out.append((UNKNOWN, CARRIERS[i % len(CARRIERS)].format(some(1 + i % 4)), i % 4 == 0))
    return out + [(UNKNOWN, u, i % 4 == 0) for i, u in enumerate(unknown)]


def sample_windows(docs: DataFrame, text: str, key: str, n: int) -> list[str]:
    """Up to ``n`` windows of the corpus, one a document; what reaches the driver does not grow with the input."""
    total = docs.count()
    spot = F.xxhash64(F.lit("licences"), F.col(key), F.length(text))
    rows = docs.select(spot.alias("spot"), F.col(text).cast("string").alias("text")).filter("text IS NOT NULL")
    rows = rows.filter(F.shiftrightunsigned("spot", 2) <= F.lit(int(min(1.0, 1.3 * n / max(total, 1)) * (1 << 62))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for spot, t in zip(*(c.to_pylist() for c in b.columns), strict=True):
                words = words_of([t])
                if len(words.windows):
                    one = words.window((spot >> 8) % len(words.windows)).replace("\n", " ")
                    if len(one) <= WINDOW_BYTES:
                        out.append((spot, one))
            yield pa.RecordBatch.from_arrays([pa.array([o[0] for o in out], pa.int64()), pa.array([o[1] for o in out], pa.string())], ["spot", "part"])

    got = rows.mapInArrow(run, "spot long, part string").orderBy("spot", "part").limit(n).collect()
    return [r["part"] for r in sorted(got, key=lambda r: (r["spot"], r["part"]))]


class _Training:
    """Full-batch gradient descent with momentum on the sparse examples."""

    def __init__(self, texts: list[str], label: np.ndarray, n_families: int):
        words = words_of([t.replace("\n", " ") for t in texts])
        row = words.text[words.paragraph[words.piece]]
        both = words.double != NO_GRAM
        feature, row = np.concatenate((words.single, words.double[both])), np.concatenate((row, row[both]))
        order = np.argsort(row, kind="stable")
        self.row, self.label, self.k = row[order], label, n_families
        self.used, self.column = np.unique(feature[order], return_inverse=True)
        self.n = len(texts)
        self.value = (1 / np.sqrt(np.maximum(np.bincount(self.row, minlength=self.n), 1)))[self.row]
        self.w, self.b = np.zeros((n_families, len(self.used))), np.zeros(n_families)

    def margins(self) -> np.ndarray:
        sums = [np.bincount(self.row, self.value * own[self.column], self.n) for own in self.w]
        return np.stack(sums, axis=1) + self.b

    def fit(self, chosen: np.ndarray, rounds: int) -> None:
        share = np.bincount(self.label[chosen], minlength=self.k)
        weight = np.where(chosen, chosen.sum() / (self.k * np.maximum(share, 1)[self.label]), 0)
        truth, step = np.eye(self.k)[self.label], np.zeros_like(self.w)
        for _ in range(rounds):
            error = (softmax(self.margins()) - truth) * (weight / weight.sum())[:, None]
            slope = np.stack([np.bincount(self.column, self.value * e[self.row], len(self.used)) for e in error.T.copy()])
            step = 0.9 * step - 40.0 * (slope + 1e-6 * self.w)
            self.w += step
            self.b -= 2.0 * error.sum(axis=0)


def softmax(z: np.ndarray) -> np.ndarray:
    z = np.exp(z - z.max(axis=1, keepdims=True))
    return z / z.sum(axis=1, keepdims=True)


def fit(docs: DataFrame, text: str = "text", key: str = "doc_id", rounds: int = 50) -> LicenceModel:
    """Train with up to ``SAMPLE_WINDOWS`` corpus windows that confirm no family as unknown."""
    plain = []
    for part in sample_windows(docs, text, key, SAMPLE_WINDOWS):
        have = set(_pairs(_tokens(part)))
        if not any(confirm(f, have) for f in PHRASES):
            plain.append(part)
    known = examples(plain)
    families = [*PHRASES, UNKNOWN]
    label = np.array([families.index(f) for f, *_ in known])
    held = np.array([h for *_, h in known])
    training = _Training([t for _, t, _ in known], label, len(families))
    training.fit(~held, rounds)
    z = training.margins()[held]
    loss = lambda t: -np.log(np.maximum(softmax(z / t)[np.arange(len(z)), label[held]], 1e-12)).mean()
    temperature = float(min(np.geomspace(0.25, 4, 33), key=loss))
    training.fit(np.ones(len(known), bool), rounds // 2)
    full = np.zeros(((1 << BITS) + 1, len(families)), np.float32)
    full[training.used] = training.w.T
    return LicenceModel(families, full, training.b.astype(np.float32), temperature)


def scan(docs: DataFrame, model: LicenceModel, text: str = "text", key: str = "doc_id") -> DataFrame:
    """One row per input row: ``key``, n_paragraphs, findings (paragraph number from 0, family, score, containment).

    Paragraphs without a word are not counted; null and empty texts have none. A finding is a paragraph with a
    window where the family's calibrated odds against unknown reach ``THRESHOLD`` and a template is confirmed;
    the window of the largest score speaks for the paragraph. Repeated rows repeat in the result; empty input
    gives an empty result; other columns are ignored.
    """
    src = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(model)  # one row of weights for each of 2**BITS features
    kind = pa.list_(pa.struct([("paragraph", pa.int32()), ("family", pa.string()), ("score", pa.float64()), ("containment", pa.float64())]))

    def scanned(texts: list[str], m: LicenceModel) -> tuple[list[int], list[list[dict]]]:
        words = words_of(texts)
        odds = m.odds(m.margins(words))
        first = np.searchsorted(words.text, np.arange(len(texts)))  # first paragraph of each text
        found: list[dict[tuple[int, str], dict]] = [{} for _ in texts]
        at, held = -1, set()
        for i, f in np.argwhere(odds >= THRESHOLD).tolist():
            if i != at:
                at, held = i, set(_pairs(_tokens(words.window(i))))
            share = confirm(m.families[f], held)
            if share:
                p = int(words.paragraph[words.windows[i]])
                d = int(words.text[p])
                one = {"paragraph": p - int(first[d]), "family": m.families[f], "score": float(odds[i, f]), "containment": share}
                spot = (one["paragraph"], one["family"])
                if spot not in found[d] or found[d][spot]["score"] < one["score"]:
                    found[d][spot] = one
        counts = np.bincount(words.text, minlength=len(texts)).tolist()
        return counts, [sorted(f.values(), key=lambda x: (x["paragraph"], x["family"])) for f in found]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts, at, counts, found = [t or "" for t in b.column(1).to_pylist()], 0, [], []
            while at < len(texts):
                end, size = at, 0
                while end < len(texts) and (end == at or size + len(texts[end]) <= 1 << 19):
                    size += len(texts[end])
                    end += 1
                for out, more in zip((counts, found), scanned(texts[at:end], shared.value), strict=True):
                    out += more
                at = end
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(counts, pa.int64()), pa.array(found, kind)], ["key", "n_paragraphs", "findings"])

    findings = "findings array<struct<paragraph:int,family:string,score:double,containment:double>>"
    out = src.mapInArrow(run, f"key {src.schema['key'].dataType.simpleString()}, n_paragraphs long, {findings}")
    return out.withColumnRenamed("key", key)


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = scan(docs, fit(docs))
    best = F.array_max(F.transform("findings", lambda f: F.struct(f["score"], f["family"], f["paragraph"])))
    return found.select(
        "doc_id",
        "n_paragraphs",
        F.size("findings").cast("long").alias("n_findings"),
        best["family"].alias("license"),
        best["score"].alias("score"),
        F.array_sort(F.array_distinct("findings.family")).alias("families"),
    )
