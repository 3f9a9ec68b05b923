import random

import corpus_pipeline as cp
from isoclime.llm import simhash

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


def shingles(text):
    words = text.lower().split()
    return {tuple(words[i : i + 5]) for i in range(max(len(words) - 4, 1))}


def brute(texts):
    """The least number of each text's component under links of an exact Jaccard similarity of 0.8 or more."""
    sets, root = [shingles(t) for t in texts], list(range(len(texts)))
    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            common = len(a & b)
            if common / (len(a) + len(b) - common) >= 0.8:
                x, y = sorted((root[i], root[j]))
                root = [x if r == y else r for r in root]
    return root


def edited(rng, words, share):
    """One run of words at the end replaced, so that a Jaccard similarity near ``share`` is left."""
    keep = round(len(words) * 2 * share / (1 + share))
    return words[:keep] + [f"x{rng.getrandbits(40)}" for _ in range(len(words) - keep)]


def texts():
    rng, out = random.Random(5), []
    for share in (0.60, 0.70, 0.76, 0.79, 0.801, 0.81, 0.83, 0.85, 0.9):
        for n in (60, 200, 500, 900):
            words = [f"w{rng.getrandbits(40)}" for _ in range(n)]
            out += [" ".join(words), " ".join(edited(rng, words, share))]
    words = [f"h{rng.getrandbits(40)}" for _ in range(80)]  # a chain of steps, and a group
    out += [" ".join(words[i : i + 60]) for i in range(0, 20, 3)]
    out += [" ".join([*words[:75], f"g{i}"]) for i in range(30)]
    return [*out, "one two", "One TWO three", "one two", ""]


def test_near_stage_equals_brute_force_jaccard(spark):
    own = list(dict.fromkeys(t.lower() for t in texts() if t))
    want = {i for i, r in enumerate(brute(own)) if i == r}
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in enumerate(own)], COLUMNS)
    got = {r.doc_id for r in cp.drop_near_copies(spark, docs, None).collect()}
    assert got == want


def test_blocks_give_the_same_components(spark):
    own = texts()
    docs = spark.createDataFrame(list(enumerate(own)), "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in simhash.jaccard_components(docs, words_per_shingle=5, block=400).collect()}
    assert [got[i] for i in range(len(own))] == brute(own)
    assert simhash.jaccard_components(docs.limit(0)).collect() == []
