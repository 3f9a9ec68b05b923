import random
import re
import zlib

import numpy as np
from tokenizers import Tokenizer

from isoclime.llm import mixing, packing

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def targets(sizes):
    """Reshare by weight until no source is above twice its size."""
    names = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    open_, out, left = set(names), {}, 1.5 * sum(sizes.values())
    while open_:
        level = left / sum(weight[s] for s in open_)
        above = [s for s in open_ if level * weight[s] > 2 * sizes[s]]
        for s in above or list(open_):
            out[s] = 2.0 * sizes[s] if above else level * weight[s]
            open_.discard(s)
            left -= out[s]
    return out


def test_mix_matches_brute_force_targets(spark):
    rng = random.Random(9)
    data = [(i, " ".join(["w"] * rng.randint(0, 40)), rng.choice(["a", "b", "c", "ü", "Z", None]), 7) for i in range(400)]
    data += [(900, None, "empty", 0), (901, "\t \x0b", "empty", 0), (902, "one", "tiny", 0), (None, "x y", None, 1), (5, data[5][1], data[5][2], 9)]
    df = spark.createDataFrame(data, "doc_id long, text string, source string, size int")
    got = mixing.curriculum(df).collect()
    sizes = {}
    for _, t, s, _ in data:
        sizes[s] = sizes.get(s, 0) + len(WORD.findall(t or ""))
    want, by = targets(sizes), {d: s for d, _, s, _ in data}
    assert len(got) == len(data)
    taken = {}
    for r in got:
        s = by[r.doc_id]
        assert r.source_size == sizes[s] and abs(r.target - want[s]) < 1e-6
        assert 0 <= r.taken <= 2 * r.size and r.copies == (r.taken > 0) + (r.taken > r.size)
        assert (r.position is not None) == (r.copies > 0) and (r.position_2 is not None) == (r.copies > 1)
        assert all(p is None or 0 <= p <= 1 for p in (r.position, r.position_2))
        taken[s] = taken.get(s, 0) + r.taken
    assert all(abs(taken[s] - want[s]) <= 1 for s in want)
    positions = [r.position for r in got if r.position is not None]
    assert positions == sorted(positions)
    again = mixing.curriculum(df.repartition(7)).collect()
    assert sorted(map(tuple, again), key=str) == sorted(map(tuple, got), key=str)
    assert mixing.curriculum(df.limit(0)).collect() == []


def test_training_time_inverts_schedules(spark):
    knots = ((0.0, 2.0), (0.25, 2.0), (0.5, 0.0), (1.0, 1.0))
    df = spark.range(0, 101).selectExpr("id / 100D AS u")
    got = [r.t for r in df.select(mixing.training_time(df.u, knots).alias("t")).collect()]
    grid = np.linspace(0, 1, 100001)
    area = np.concatenate(([0], np.cumsum(np.diff(grid) * (np.interp(grid[1:], *zip(*knots, strict=True)) + np.interp(grid[:-1], *zip(*knots, strict=True))) / 2)))
    for i, t in enumerate(got):
        assert abs(np.interp(t, grid, area / area[-1]) - i / 100) < 1e-4


def test_ids_are_the_tokenizer_files_own():
    path = packing.default_tokenizer()
    slow, fast = Tokenizer.from_file(path), packing.encoder(path)
    texts = ["", "Hello  world\n\n don't", "ÀÉ ß日本語 🙂", "a<|endoftext|>b", "x" * 3000, " \t\r\n ", "1234 5,6", "\x00\x01"]
    for t in texts:
        assert fast.encode(t, allowed_special="all") == slow.encode(t, add_special_tokens=False).ids


def check_sequences(rows, window):
    sequences = {}
    for s, offset, n in rows:
        sequences.setdefault(s, []).append((offset, n))
    lengths = []
    for pieces in sequences.values():
        at = 0
        for offset, n in sorted(pieces):
            assert offset == at and n > 0
            at += n
        assert at <= window and at & (at - 1) == 0
        lengths.append(at)
    return lengths


def test_plan_never_pads():
    rng = random.Random(1)
    for _ in range(60):
        lengths = [rng.choice([1, 2, 63, 64, 65, rng.randint(1, 300)]) for _ in range(rng.randint(1, 80))]
        sequences = packing.plan(lengths, 64)
        rows = [(s, sum(p[2] for p in pieces[:i]), p[2]) for s, pieces in enumerate(sequences) for i, p in enumerate(pieces)]
        assert sum(n for n in check_sequences(rows, 64) if n < 64) < 64
        for d, n in enumerate(lengths):
            spans = sorted((p[1], p[2]) for pieces in sequences for p in pieces if p[0] == d)
            assert [a for a, _ in spans] == [sum(m for _, m in spans[:i]) for i in range(len(spans))] and sum(m for _, m in spans) == n


def test_best_fit_takes_the_tightest_window():
    tree = packing.CapacityTree(64)
    for room in (5, 9, 40, 64):
        tree.add(room, 1)
    assert [tree.tightest(n) for n in (1, 5, 6, 10, 41, 64)] == [5, 5, 9, 40, 64, 64]
    tree.add(64, -1)
    assert tree.tightest(41) == -1


def test_pieces_round_trip(spark):
    texts = [None, "", "short one", "word " * 5000, "Ünï " * 40] + [f"text number {i} " * (i % 60) for i in range(150)]
    data = [(i, t, 3) for i, t in enumerate(texts)] + [(None, "no id", 3)]
    df = spark.createDataFrame(data, "doc_id long, text string, length int")
    for group in (1 << 23, 3000):
        got = packing.pack(df, group_tokens=group).collect()
        check_sequences([(r.sequence_id, r.offset, r.length) for r in got], 2048)
        enc = packing.encoder(packing.default_tokenizer())
        for d, t, _ in data:
            own = sorted((r for r in got if r.doc_id == d), key=lambda r: r.start)
            ids = [x for r in own for x in r.ids]
            assert ids == enc.encode(t or "", allowed_special="all") + [1]
            assert {r.doc_tokens for r in own} == {len(ids)}
            for r in own:
                assert r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes()) and r.length == len(r.ids)
    assert packing.pack(df.limit(0)).collect() == []


def test_runs_of_three_million_blanks_are_encoded_as_the_file_says(spark):
    library = Tokenizer.from_file(packing.default_tokenizer())
    rows = [(i, f"a{blank * 3_000_000}b") for i, blank in enumerate((" ", "\t", "\n"))]
    want = {i: library.encode(t, add_special_tokens=False).ids + [1] for i, t in rows}
    got = {}
    for r in packing.pack(spark.createDataFrame(rows, "doc_id int, text string").repartition(3)).collect():
        assert r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4"))
        got.setdefault(r.doc_id, []).append((r.start, r.ids))
    assert {i: [x for _, ids in sorted(parts) for x in ids] for i, parts in got.items()} == want


def test_plan_equals_best_fit_by_search():
    """``plan`` against best-fit decreasing with a plain search for the tightest window, up to where windows are closed."""
    rng = random.Random(12)
    for _ in range(60):
        lengths = [rng.randrange(1, 90) for _ in range(rng.randrange(1, 80))]
        bins = []
        for d, n in sorted(((d, n % 32) for d, n in enumerate(lengths) if n % 32), key=lambda p: (-p[1], p[0])):
            fits = [b for b in bins if sum(m for _, m in b) + n <= 32]
            if fits:
                max(fits, key=lambda b: sum(m for _, m in b)).append((d, n))
            else:
                bins.append([(d, n)])
        closed = sum(sum(m for _, m in b) == 32 for b in bins)
        out = packing.plan(lengths, 32)
        full = [p for p in out if sum(n for _, _, n in p) == 32]
        left = sum(lengths) % 32
        assert len(out) - len(full) == left.bit_count() and len(full) == sum(lengths) // 32
        whole = sum(n // 32 for n in lengths)
        assert all(start == lengths[d] - n and n == lengths[d] % 32 for p in out[whole : whole + closed] for d, start, n in p)  # as best fit left them
