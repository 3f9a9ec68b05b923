import hashlib
import random
from collections import Counter

from isoclime.llm.repeats import remove_repeats, segments


def brute(texts, length):
    bodies = [(t or "").encode() for t in texts]
    seen = Counter(b[i : i + length] for b in bodies for i in range(len(b) - length + 1))
    out = []
    for b in bodies:
        gone = [False] * len(b)
        for i in range(len(b) - length + 1):
            if seen[b[i : i + length]] > 1:
                gone[i : i + length] = [True] * length
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        kept = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        out.append((len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def corpus(seed):
    rng = random.Random(seed)
    prose = lambda n: "".join(rng.choice("aeiouéßnrstl  \n") for _ in range(n))
    passage, unit = prose(90), prose(17)
    texts = [None, "", "short", prose(39), prose(40), "x" * 300, "ab" * 100, unit * 9]
    texts += [prose(rng.randint(0, 80)) + passage + prose(rng.randint(0, 80)) for _ in range(30)]
    whole = prose(200)
    texts += [whole] * 4 + [whole[:80] + "#" + whole[80:], whole[50:130], passage[:40], passage[1:41], passage[:39]]
    texts += [prose(150) for _ in range(10)]
    rng.shuffle(texts)
    return texts


def test_matches_brute_force(spark):
    texts = corpus(1)
    want = sorted((i, *r) for i, r in enumerate(brute(texts, 40)))
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in enumerate(texts)], "doc_id long, text string, sha string, n int")
    for shard, slice_chunks, span in ((1 << 20, 1, 1 << 20), (2000, 1 << 10, 30), (300, 2, 7)):  # small shards send large groups to the chunks
        got = remove_repeats(df, length=40, gram=12, shard_bytes=shard, chunk_bytes=700, bucket_windows=500, slice_chunks=slice_chunks, span_bytes=span)
        assert sorted(map(tuple, got.drop("kept").collect())) == want


def test_repeated_rows_null_ids_and_empty_table(spark):
    rows = [(1, "q" * 10 + "w" * 20), (1, "q" * 10 + "w" * 20), (None, "only here, once and for all"), (None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(((r.doc_id, r.n_removed, bytes(r.kept)) for r in remove_repeats(df, length=20, gram=8).collect()), key=str)
    assert got == sorted([(1, 30, b""), (1, 30, b""), (None, 0, b"only here, once and for all"), (None, 0, b"")], key=str)
    assert remove_repeats(df.limit(0), length=20, gram=8).collect() == []


def test_long_texts_are_hashed_in_pieces():
    """Every window is in one segment, with the same value whatever the pieces; what is held at a time is bounded."""
    rng = random.Random(6)
    texts = [bytes(rng.choice(b"abcd ") for _ in range(n)) for n in (5000, 3, 90, 700, 0, 40)] + [b"z" * 4000]
    windows = {}
    for span in (50, 333, 1 << 20):
        of_value = {}
        for number, value, first, last, hashes, place in segments(texts, 40, 12, span):
            assert len(hashes) <= max(2 * (span + 40), 50) or span == 1 << 20
            for i, v, a, b, p in zip(number.tolist(), value.tolist(), first.tolist(), last.tolist(), place.tolist(), strict=True):
                assert min(hashes[p + a : p + a + 29]) == v
                for w in range(a, b + 1):
                    assert (i, w) not in of_value
                    of_value[i, w] = v
        windows.setdefault("all", of_value)
        assert of_value == windows["all"] and len(of_value) == sum(max(0, len(t) - 39) for t in texts)
