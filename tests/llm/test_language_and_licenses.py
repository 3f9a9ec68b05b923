import zlib

from isoclime.llm import language, licenses
from isoclime.llm.common import table

ODD = [(1, None), (2, ""), (3, " 123 !?"), (4, "日本"), (5, "the cat and the dog " * 3000), (None, "le chat et la souris"), (7, "ª")]


def test_held_out_accuracy(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    found = language.op5_language_id(spark, sf_dir).join(docs.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in found if r.held_out]
    assert len(held) > 20 and sum(r.lang_pred == r.lang for r in held) / len(held) >= 0.97
    assert all(0 <= r.score <= 1 for r in found)
    again = {r.doc_id: (r.lang_pred, r.score) for r in language.op5_language_id(spark, sf_dir).collect()}
    assert all(again[r.doc_id] == (r.lang_pred, r.score) for r in found)


def test_odd_texts_and_columns(spark, sf_dir):
    model = language.fit(table(spark, sf_dir, "documents"))
    assert set(model.families) == {"germanic", "romance"}
    df = spark.createDataFrame([(d, t, "x") for d, t in ODD], "doc_id long, text string, lang_pred string")
    got = {r.doc_id: (r.lang_pred, r.score) for r in language.identify(df, model).collect()}
    assert [got[d] for d in (1, 2, 3)] == [("und", 0.0)] * 3
    assert all(got[d][0] in {"en", "de", "fr", "es"} for d in (4, 5, None, 7))
    assert language.identify(df.limit(0), model).collect() == []


def test_no_labels_and_a_lone_language(spark):
    df = spark.createDataFrame([(i, "some text here", None) for i in range(4)], "doc_id long, text string, lang string")
    assert {r.lang_pred for r in language.identify(df, language.fit(df)).collect()} == {"und"}
    one = spark.createDataFrame([(1, "some text here", "xx")], df.schema)
    assert {(r.lang_pred, r.score) for r in language.identify(df, language.fit(one)).collect()} == {("xx", 1.0)}


MIT_TEXT = """Copyright (c) 2021 Some Body

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software.
"""
BSD_TEXT = """/*
 * Redistribution and use in source and binary forms, with or without
 * modification, are permitted provided that the following conditions
 * are met:
 *
 * 1. Redistributions of source code must retain the above copyright
 *    notice, this list of conditions and the following disclaimer.
 */
"""
APACHE_TEXT = """# Unless required by applicable law or agreed to in writing,
# software distributed under the License is distributed on an
# "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND.
"""


def test_licences_are_found_and_prose_is_not(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    model = licenses.fit(docs)
    prose = max((r.text for r in docs.filter("lang = 'en'").select("text").collect() if r.text), key=len).replace("\n", " ").split()[:3000]
    amid = lambda line: " ".join([*prose[:1500], line, *prose[1500:]])
    wanted = [
        ("Released under the MIT License.", {"MIT"}), ("Licensed under CC BY-NC 4.0.", {"CC-BY-NC"}),
        ("Licensed under the Apache License, Version 2.0.", {"Apache-2.0"}), (licenses.TEMPLATES["BSD"][5], {"BSD"}),
        (MIT_TEXT, {"MIT"}), (BSD_TEXT, {"BSD"}), (APACHE_TEXT, {"Apache-2.0"}), ("// SPDX-License-Identifier: MIT", {"MIT"}),
        ("License: MIT", {"MIT"}), ("# SPDX-License-Identifier: ISC", {"ISC"}), ("SPDX-License-Identifier: Unlicense", {"Unlicense"}),
        ("Dual licensed under the MIT License or the Apache License, Version 2.0, as you like.", {"MIT", "Apache-2.0"}),
        (amid("This work is licensed under CC BY-NC 4.0."), {"CC-BY-NC"}), (amid("Released under the MIT License."), {"MIT"}),
        (amid(MIT_TEXT.replace("\n", " ")), {"MIT"}),
        ("Licensed under the Sleepycat License.", set()), ("Released under the PostgreSQL License, version 2.", set()),
        ("Licensed under the rules of the house.", set()), ("The license was granted by the city.", set()), (" ".join(prose), set()), ("word " * 30000, set()),
    ]
    rows = [(i, t, None) for i, (t, _) in enumerate(wanted)]
    rows += [(100, None, None), (101, "", None), (102, " -- \n\n * ", None), (None, "Prose\nfirst.\n\nReleased under the\nMIT License.\n\n\nLicense: ISC", "x")]
    got = {r.doc_id: r for r in licenses.scan(spark.createDataFrame(rows, "doc_id long, text string, findings string"), model).collect()}
    for i, (text, families) in enumerate(wanted):
        assert {f.family for f in got[i].findings} == families, text[:80]
        assert all(0.5 <= f.score <= 1 and f.containment >= 0.8 for f in got[i].findings)
    assert [(f.paragraph, f.family) for f in got[None].findings] == [(1, "MIT"), (2, "ISC")] and got[None].n_paragraphs == 3
    assert all(got[d].n_paragraphs == 0 and got[d].findings == [] for d in (100, 101, 102))


def test_windows_cover_every_word(spark):
    texts = ["", "one", " ".join(f"w{i}" for i in range(100)), "a b\n\nc\n \t-\nd", " ".join(f"v{i}" for i in range(25)) + "\nlast"]
    words = licenses.words_of(texts)
    seen = [words.window(i).split() for i in range(len(words.windows))]
    assert {w for own in seen for w in own if w != "-"} == {w for t in texts for w in t.split() if w != "-"}
    assert words.text.tolist() == [1, 2, 3, 3, 3, 4] and max(map(len, seen)) <= licenses.SIZES[-1] * licenses.PIECE
    long, most = texts[2].split(), (licenses.SIZES[-1] - 1) * licenses.PIECE
    for i in range(len(long) - most + 1):
        assert any(long[i : i + most] == own[k : k + most] for own in seen for k in range(len(own)))
    assert max(len(licenses._tokens(p)) for own in licenses.PHRASES.values() for p in own) <= most


def test_licence_query_agrees_with_plain_search(spark, sf_dir):
    lines = {"CC-BY-NC": "Licensed under CC BY-NC 4.0.", "GPL-3.0": "GNU General Public License, version 3.", "MIT": "Released under the MIT License.", "Apache-2.0": "Licensed under the Apache License, Version 2.0."}
    texts = {r.doc_id: r.text for r in table(spark, sf_dir, "documents").collect()}
    got = {r.doc_id: r.families for r in licenses.op7_license_scan(spark, sf_dir).collect()}
    assert got == {d: sorted(f for f, line in lines.items() if line in (t or "")) for d, t in texts.items()}


def test_held_out_rows_and_a_rare_language(spark, sf_dir):
    for r in language.op5_language_id(spark, sf_dir).select("doc_id", "held_out").collect():
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
    words = {f"x{i:03d}": [f"{chr(97 + i % 26)}{chr(97 + i // 26)}{w}" for w in ("ra", "to", "mi", "ne")] for i in range(14)}
    rows = [(i * 10 + k, " ".join(own), code) for i, (code, own) in enumerate(words.items()) for k in range(3 if i else 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language.fit(df)
    assert sorted(n for own in model.families.values() for n in own) == sorted(words)  # the rarest too
    assert [r.lang_pred for r in language.identify(df.filter("lang = 'x000'"), model).collect()] == ["x000"]
