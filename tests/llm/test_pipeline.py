import random

import corpus_pipeline as cp
from isoclime.llm.common import materialize

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


def corpus():
    rng = random.Random(11)
    word = lambda: "".join(rng.choices("abcdefghilmnoprstu", k=rng.randint(2, 9)))
    prose = lambda n: " ".join(word() for _ in range(n))
    clean = [prose(rng.randint(60, 400)) for _ in range(60)]
    base = prose(500)
    words = base.split()
    near = [" ".join(words[:i] + [word()] + words[i + 1 :]) for i in (100, 250, 400)]
    texts = [*clean, base, *near, clean[0].upper(), clean[0], None, "", "123 --- 45", clean[1]]
    rows = [(i, t, None if i % 9 == 0 else "en", f"s{i % 3}", len(t or "")) for i, t in enumerate(texts)]
    return rows + [(None, prose(80), "en", None, 1), (2, clean[2], "en", "s2", 5), (2, prose(90), "en", "s2", 6)]


def stages(spark, rows):
    docs, out = spark.createDataFrame(rows, COLUMNS), []
    for name, stage in cp.STAGES:
        docs = materialize(stage(spark, docs, None), name)
        out.append(docs)
    return out


def test_every_stage(spark):
    rows = corpus()
    language, exact, near, mixed, packed = stages(spark, rows)
    have = lambda df: sorted(map(tuple, df.select("doc_id", "text").collect()), key=str)
    lettered = sorted(((d, t) for d, t, *_ in rows if t and any(map(str.isalpha, t))), key=str)
    assert have(language) == lettered and language.filter("lang IS NULL").count() == 0
    best = {}
    for d, t in lettered:
        k = t.lower()
        best[k] = max(best.get(k, (-1, "")), (-1 if d is None else d, t))
    assert have(exact) == sorted(((None if d == -1 else d, t) for d, t in best.values()), key=str)
    assert have(near) == sorted(((d, t) for d, t in have(exact) if d not in (61, 62, 63)), key=str)  # 60 stays of 60..63
    copies = {}
    for r in mixed.collect():
        copies[(r.doc_id, r.text)] = copies.get((r.doc_id, r.text), 0) + 1
    assert set(copies) <= set(have(near)) and set(copies.values()) <= {1, 2}
    words = lambda rows: sum(len(t.split()) for t in rows)
    share = words(t for (_, t), n in copies.items() for _ in range(n)) / words(t for _, t in have(near))
    assert 1.4 < share < 1.7
    tokens = {}
    for r in packed.filter("start = 0").collect():
        tokens[r.doc_id] = tokens.get(r.doc_id, 0) + 1
    assert sum(tokens.values()) == sum(copies.values())
    assert language.columns == exact.columns == near.columns == mixed.columns == [c.split()[0] for c in COLUMNS.split(", ")]


def test_empty_table_and_extra_columns(spark):
    assert [df.count() for df in stages(spark, [])] == [0] * 5
    names = ["score", "lang_pred", "_k", "_t", "_at", "key", "row", "sha", "_Order", "position", "copies", "component_id", "_key", "size"]
    rows = [(i, f"some words of text number {i} " + f"w{i} " * 70, "en", "s", 3, *(i * 100 + n for n in range(len(names)))) for i in range(4)]
    docs = spark.createDataFrame(rows, COLUMNS + "".join(f", {n} long" for n in names))
    for _, stage in cp.STAGES[:-1]:
        docs = materialize(stage(spark, docs, None), "stage")
        assert docs.columns[5:] == names
        assert {tuple(r) for r in docs.collect()} == set(rows)


def test_null_ids_and_repeated_rows_have_a_fixed_winner(spark):
    base = " ".join(f"word{i}" for i in range(100))
    rows = [(1, base + " end", "en", "b", 1), (None, base + " fin", "en", "a", 2), (7, "Twice here", "en", "b", 3), (7, "twice here", "en", "a", 4), (7, "Twice here", "en", "a", 5)]
    rows += [(None, "one copy", "en", "a", 1), (3, "ONE copy", "en", "a", 1)]
    for order in (rows, rows[::-1]):
        docs = spark.createDataFrame(order, COLUMNS).repartition(3)
        exact = materialize(cp.drop_exact_copies(spark, docs, None), "exact")
        got = {tuple(r) for r in exact.collect()}
        first = {r for r in got if r[0] == 7}
        assert len(first) == 1 and first <= {rows[2], rows[4]} and (3, "ONE copy", "en", "a", 1) in got and len(got) == 4
        winner = first if order is rows else winner  # noqa: F821
        assert first == winner
        near = {tuple(r) for r in cp.drop_near_copies(spark, exact, None).collect()}
        assert rows[0] in near and rows[1] not in near and len(near) == 3


def test_run_leaves_only_its_last_input_behind(spark, sf_dir):
    from isoclime import session

    begin = session.mark()
    out = cp.run(spark, sf_dir)
    assert [name.rsplit("/", 1)[-1].split("-")[0] for _, name in session._made[begin:]] == ["curriculum_mix"]
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id").distinct().collect()
    pieces = out.collect()
    assert {r.doc_id for r in pieces} <= {r.doc_id for r in docs} and sum(r.length for r in pieces) > 0
