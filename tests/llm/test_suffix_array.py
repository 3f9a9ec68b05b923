import random

import numpy as np

from isoclime.llm.suffix_array import permuted_lcp, suffix_array


def check(text: bytes):
    t = np.array([b + 1 for b in text] + [0], np.int16)
    sa = suffix_array(t, 258)
    whole = t.tolist()
    want = sorted(range(len(whole)), key=lambda i: whole[i:])
    assert sa.tolist() == want
    lcp = permuted_lcp(t, sa)
    for a, b in zip(want, want[1:], strict=False):
        n = 0
        while whole[a + n] == whole[b + n]:
            n += 1
        assert lcp[b] == n


def test_small_alphabets_and_repeats():
    rng = random.Random(5)
    for _ in range(150):
        n = rng.randint(0, 60)
        check(bytes(rng.choices(b"ab" if rng.random() < 0.5 else b"abcd", k=n)))
    check(b"a" * 200)
    check(b"abcab" * 40)
    unit = bytes(rng.choices(b"abcdefgh ", k=90))
    check(unit + b"x" + unit + b"y" + unit[10:])
    check(b"mississippi" * 3 + bytes(range(200)))


def test_names_repeat_on_several_levels():
    rng = random.Random(6)
    text = b"abcab"
    for _ in range(5):  # repeats within repeats
        text = text + bytes(rng.choices(b"abc", k=3)) + text + bytes(rng.choices(b"abc", k=2)) + text[: len(text) // 2]
    check(text)
    check(text + bytes(rng.choices(b"abcdefgh", k=300)) + text[50:250])
    for size in (2, 3, 20):
        check(bytes(rng.choices(range(1, 1 + size), k=1500)))
    check((b"a" * 70 + b"b") * 12 + b"a" * 71)
    a, b = b"a", b"ab"
    while len(b) < 1200:  # Fibonacci words
        a, b = b, b + a
    check(b)
