"""Token counts against the tokenizer's own library."""

import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from isoclime.llm import token_counts as tc
from isoclime.llm.packing import default_tokenizer

PATH = default_tokenizer()
PARTS = ["'", " ", "  ", "\n", "\t", "s", "'re", "'ll", "'ve", "'d", "r", "v", "l", "e", "a", "the", "The", "é", "中", "1", "23", "!", "...", "<|endoftext|>"]
PARTS += ["<|end", "<", "　", " ", "\U0001f600", "٠", "\x85", "\x1c", "aaaa", "==", " a", "0000", "\r\n", "ing", "ation"]


@pytest.fixture(scope="module")
def kinds():
    return tc.classes(PATH)


def library(texts):
    tok = Tokenizer.from_file(PATH)
    return [len(tok.encode(t, add_special_tokens=False).ids) for t in texts]


def counted(texts, kinds, size):
    counter, out = tc.Counter(PATH, kinds), []
    for span, final in tc.spans((t.encode() for t in texts), tc.merger(PATH).special, size):
        out += counter.feed(span, final)
    return out


@pytest.mark.parametrize(("n", "size"), [(3000, 1 << 20), (200, 41)])
def test_random_texts_at_two_span_sizes(kinds, n, size):
    rng = random.Random(n)
    texts = ["".join(rng.choice(PARTS) for _ in range(rng.randrange(40))) for _ in range(n)]
    assert counted(texts, kinds, size) == library(texts)


def test_pieces_longer_than_a_chunk_and_a_span(kinds):
    rng = random.Random(5)
    texts = ["a" * 70001, " " * 70000 + "x", "\n" * 40000, "abc" * 20001, "".join(rng.choice("abcdefgh") for _ in range(40000)), "", "x"]
    assert counted(texts, kinds, 9000) == library(texts)


def test_every_code_point_is_split_as_the_library_does(kinds):
    split = Tokenizer.from_file(PATH).pre_tokenizer.pre_tokenize_str
    table = np.frombuffer(zlib.decompress(kinds), np.uint8)
    for lo in [*range(0, 0x3000, 256), 0xA700, 0x10D00, 0x1E900, 0x2FA00, 0x323A0, 0xE0100]:
        chars = [chr(c) for c in range(lo, lo + 256)]
        text = "".join(f"{c}a!{c}1" for c in chars)
        marks, _, _ = tc.split_marks(table[[ord(c) for c in text]], tc.FRESH)
        begins = (marks & 1).astype(bool)
        begins[:-1] |= marks[1:] > 1
        assert np.flatnonzero(begins).tolist() == [at for _, (at, _) in split(text)], hex(lo)


def test_chunk_maps_compose_to_a_sequential_run(kinds):
    rng = np.random.default_rng(3)
    text = rng.integers(0, tc.BREAK + 1, 5000).astype(np.uint8)
    state, want = tc.FRESH, []
    for c in text:
        want.append(tc.MARK[state, c])
        before, state = state, int(tc.STEP[state, c])
    for length in (7, 256, 6000):
        marks, last, after = tc.split_marks(text, tc.FRESH, length)
        assert (marks.tolist(), last, after) == (want, before, state)


def test_table_of_transitions_may_be_dropped_at_any_span(kinds, monkeypatch):
    monkeypatch.setattr(tc, "MOST_TRANSITIONS", 50)
    monkeypatch.setattr(tc, "_mergers", {})
    texts = ["the quick brown fox's tail " * 30, "unbelievably long " * 50]
    assert counted(texts, kinds, 60) == library(texts)


def test_rows(spark):
    rows = [(1, "hello world", "x"), (1, "hello world", "y"), (None, None, "z"), (3, "", "w"), (4, "a " * 512, "v"), (5, "a" + " b" * 512, "u")]
    df = spark.createDataFrame(rows, "doc_id int, text string, n_tokens string")
    got = sorted(map(tuple, tc.count_tokens(df).collect()), key=str)
    want = library(["hello world", "a " * 512, "a" + " b" * 512])
    assert got == sorted([(1, 11, want[0], False), (1, 11, want[0], False), (None, 0, 0, False), (3, 0, 0, False), (4, 1024, want[1], want[1] > 512), (5, 1025, want[2], True)], key=str)
    assert tc.count_tokens(df.limit(0)).count() == 0
    assert tc.count_tokens(df, limit=1).filter("over_limit").count() == 4


def test_query_counts_every_document(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    got = {r.doc_id: (r.n_bytes, r.n_tokens) for r in tc.op11_token_counts(spark, sf_dir).collect()}
    want = library([d.text or "" for d in docs])
    assert got == {d.doc_id: (len((d.text or "").encode()), n) for d, n in zip(docs, want, strict=True)}


def test_other_tokenizers_are_refused():
    import public_tokenizers

    with pytest.raises(ValueError, match="byte-level"):
        tc.Merger(public_tokenizers.path("word_bpe_49k.json"))
