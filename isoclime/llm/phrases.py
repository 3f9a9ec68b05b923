"""Collocations from depth-truncated suffix subtrees, built group by group after vertical partitioning.

1. *Vertical partitioning.* All words are counted. A word that occurs more often than the budget of a group is extended
   by its next word, a pair that still does by a third: each depth is one more pass over the texts that counts below
   the heavy prefixes only (there are at most total / budget of these, so tasks can be told them). The prefixes in
   order, with running sums of their counts, are cut into groups of about one budget of suffixes.
2. *Subtrees.* Every word starts a suffix of up to four words that ends with its piece. A task counts equal suffixes,
   sorts them, and sends each group one compressed block. A group's blocks together hold every suffix that begins with
   its prefixes, so its subtree stands alone: its suffixes are sorted, nodes are ranges of equal beginnings, and a
   node's count is the sum of its leaves. Nodes below the support are left out.
3. Candidates look up the counts of their parts, longer candidates tell their parts what they weigh, and the best of
   each language are ranked; these tables hold only phrases of at least the support.

A group's memory is bounded by the budget, which grows only beyond ``MOST_GROUPS`` groups of ``MOST_SUFFIXES``.
A suffix that a prefix of any share of the corpus repeats is one row a block. Texts are read in spans; no step depends on
a text's length.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.running import running
from .common import UPPER, materialize, partitions, table

DEPTH = 4
SPAN, PORTION, MOST_WORDS = 1 << 20, 1 << 20, 1 << 20  # bytes tokenised, words held, and distinct words held by a task
LEAST_SUFFIXES, MOST_SUFFIXES, MOST_GROUPS = 1 << 14, 1 << 19, 1 << 14
END = b"\xff"  # of a piece; no byte of UTF-8

_breaks = b".,;:!?\x0a\x0b\x0c\x0d"
FOLD = bytes.maketrans(UPPER.encode() + _breaks, UPPER.lower().encode() + END * len(_breaks))
EDGE = re.compile(rb"[\x20\x09-\x0D.,;:!?]")

Prefix = tuple[bytes, ...]


class Names(dict):
    """Numbers for words in the order of their first use; 0 ends a piece."""

    def __init__(self):
        super().__init__({END: 0})

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        return n


def streams(batches: Iterator[pa.RecordBatch], most: int = PORTION, span: int = SPAN) -> Iterator[tuple[str, np.ndarray, int, list[bytes]]]:
    """(language, word numbers, how many of these to count, words by number); numbers after that are there to look ahead."""
    names, held, n = Names(), {}, 0
    for b in batches:
        for lang, text in zip(b.column(0).to_pylist(), b.column(1), strict=True):
            text, at = text.as_py(), 0
            while at <= len(text):
                edge = EDGE.search(text, at + span)
                to = edge.end() if edge else len(text)
                last = to == len(text)
                words = text[at:to].translate(FOLD).replace(END, b" \xff ").split()
                if last:
                    words.append(END)
                held.setdefault(lang, []).append(np.fromiter(map(names.__getitem__, words), np.int32, len(words)))
                n += len(words)
                if n >= most or len(names) > MOST_WORDS:
                    spelt, rest = list(names), []
                    for g, rows in held.items():
                        ids = np.concatenate(rows)
                        upto = len(ids) if last or g != lang else max(0, len(ids) - DEPTH + 1)
                        rest += [spelt[i] for i in ids[upto:].tolist()]
                        yield g, ids, upto, spelt
                    names, held, n = Names(), {}, 0
                    if rest:
                        held[lang] = [np.array([names[w] for w in rest], np.int32)]
                at = to if not last else len(text) + 1
    spelt = list(names)
    for lang, rows in held.items():
        ids = np.concatenate(rows)
        yield lang, ids, len(ids), spelt


def suffixes(ids: np.ndarray, upto: int) -> list[np.ndarray]:
    """The first, second, ... word of the suffixes that begin at the words to count; 0 beyond the end of a piece."""
    padded = np.concatenate((ids, np.zeros(DEPTH, ids.dtype))).astype(np.int64)
    at = np.flatnonzero(ids[:upto])
    out = [padded[at]]
    for k in range(1, DEPTH):
        out.append(np.where(out[-1] > 0, padded[at + k], 0))
    return out


def below(lang: str, words: list[np.ndarray], spelt: list[bytes], heavy: dict[str, set[Prefix]], depth: int) -> np.ndarray:
    """Which suffixes begin with a heavy prefix of ``depth`` words."""
    own = heavy.get(lang, set())
    numbers = {w: i for i, w in enumerate(spelt)} if own else {}
    keys = [tuple(numbers.get(w, -1) for w in p) for p in own if len(p) == depth]
    packed = np.array([pack(k) for k in keys if min(k) > 0], np.int64)
    return np.isin(pack(words[:depth]), packed)


def pack(words) -> np.ndarray:
    """Up to three word numbers (below 2^21 each) as one."""
    out = words[0]
    for w in words[1:]:
        out = out << 21 | w
    return out


def spell(columns: list[np.ndarray], spelt: list[bytes]) -> pa.Array:
    """Phrases, space-joined."""
    words = pa.array(spelt, pa.binary())
    parts = [words.take(pa.array(np.maximum(c, 0))) for c in columns]
    joined = pc.binary_join_element_wise(*parts, pa.scalar(b" ")) if len(parts) > 1 else parts[0]
    return joined.cast(pa.string())


def prefix_counts(src: DataFrame, depth: int, heavy: dict[str, set[Prefix]]) -> DataFrame:
    """lang, phrase, f of all words (depth 1), or of the phrases of ``depth`` words below heavy prefixes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, ids, upto, spelt in streams(batches):
            if depth == 1:
                counts = np.bincount(ids[:upto], minlength=1)
                columns = [np.flatnonzero(counts[1:]) + 1]
                counts = counts[columns[0]]
            else:
                words = suffixes(ids, upto)
                some = below(lang, words, spelt, heavy, depth - 1) & (words[depth - 1] > 0)
                keys, counts = np.unique(pack([w[some] for w in words[:depth]]), return_counts=True)
                columns = [keys >> 21 * k & (1 << 21) - 1 for k in reversed(range(depth))]
            if len(counts):
                phrases = spell(columns, spelt)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(counts)), phrases, pa.array(counts, pa.int64())], ["lang", "phrase", "f"])

    return src.mapInArrow(run, "lang string, phrase string, f long").groupBy("lang", "phrase").agg(F.sum("f").alias("f"))


def heavy_prefixes(counts: DataFrame, budget: int) -> list[tuple[str, str, int]]:
    """Those above the budget: at most total / budget rows."""
    return [tuple(r) for r in counts.filter(F.col("f") > budget).select("lang", "phrase", "f").collect()]


def as_prefixes(rows: list[tuple[str, str, int]]) -> dict[str, set[Prefix]]:
    out: dict[str, set[Prefix]] = {}
    for lang, phrase, _ in rows:
        out.setdefault(lang, set()).add(tuple(phrase.encode().split(b" ")))
    return out


def boundaries(counts: list[DataFrame], heavy: list[list[tuple[str, str, int]]], budget: int) -> list[tuple[bytes, ...]]:
    """The first prefix (after its language) of each group of about ``budget`` suffixes; at most total / budget + 1 of them."""
    light = None
    for depth, df in enumerate(counts):
        part = df.filter(F.col("f") <= budget) if depth < len(counts) - 1 or depth < DEPTH - 2 else df
        light = part if light is None else light.unionByName(part)
    words = [F.split_part("phrase", F.lit(" "), F.lit(k)).alias(f"w{k}") for k in range(1, DEPTH)]
    keyed = light.select("lang", *words, "f")
    order = [F.col(c) for c in ("lang", "w1", "w2", "w3")]
    summed = running(keyed, order, {"upto": "f"})
    group = F.floor((F.col("upto") - F.col("f")) / F.lit(budget))
    firsts = summed.groupBy(group.alias("g")).agg(F.min(F.struct(*order)).alias("p")).select("p.*").collect()
    return sorted((r[0].encode(), *(w.encode() for w in r[1:] if w)) for r in firsts)


def blocks(src: DataFrame, firsts: list[tuple[bytes, ...]], heavy: dict[str, set[Prefix]]) -> DataFrame:
    """group, lang, n, words, codes: the distinct suffixes of at least two words a task found for a group, with counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, ids, upto, spelt in streams(batches):
            words = suffixes(ids, upto)
            some = words[1] > 0
            words = [w[some] for w in words]
            if not len(words[0]):
                continue
            one, two, low, head = below(lang, words, spelt, heavy, 1), below(lang, words, spelt, heavy, 2), pack(words[2:]), pack(words[:2])
            order = np.lexsort((low, head))
            head, low, one, two = head[order], low[order], one[order], two[order]
            new = np.concatenate(([True], (head[1:] != head[:-1]) | (low[1:] != low[:-1])))
            at = np.flatnonzero(new)
            counts = np.diff(np.append(at, len(head)))
            head, low, one, two = head[at], low[at], one[at], two[at]
            mask = (1 << 21) - 1
            cols = np.stack((head >> 21, head & mask, low >> 21, low & mask))
            depth = 1 + one + two
            prefix = np.where(depth[None, :] > np.arange(DEPTH - 1)[:, None], cols[: DEPTH - 1], 0)
            keys, inverse = np.unique(pack(prefix), return_inverse=True)
            tag, known = lang.encode(), []
            for k in keys.tolist():
                p = [spelt[i] for i in (k >> 42, k >> 21 & mask, k & mask) if i]
                known.append(max(0, bisect_right(firsts, (tag, *p)) - 1))
            group = np.array(known, np.int32)[inverse]
            group[two & (cols[2] == 0)] = -1  # ends with a heavy pair, whose count is known
            order = np.argsort(group, kind="stable")
            cuts = np.flatnonzero(np.diff(group[order], prepend=-1))
            rows = []
            for lo, hi in zip(cuts, np.append(cuts[1:], len(order)), strict=True):
                part = order[lo:hi]
                if group[part[0]] < 0:
                    continue
                used, codes = np.unique(cols[:, part], return_inverse=True)
                spelling = b"\n".join(spelt[i] for i in used.tolist())
                data = np.concatenate((codes.reshape(4, -1).astype("<u4"), counts[None, part].astype("<u4"))).tobytes()
                rows.append((int(group[part[0]]), lang, hi - lo, len(spelling), pa.compress(spelling, "zstd", asbytes=True), pa.compress(data, "zstd", asbytes=True)))
            if rows:
                kinds = (pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.binary(), pa.binary())
                columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, ["group", "lang", "n", "n_words", "words", "codes"])

    return src.mapInArrow(run, "group int, lang string, n long, n_words long, words binary, codes binary")


def subtree(lang: str, rows: list[tuple[int, bytes, int, bytes]], support: int, heavy: set[Prefix]) -> tuple[list[pa.Array], list[np.ndarray]]:
    """Phrases of two words or more and their counts, of at least ``support``, from a group's blocks of one language."""
    names, parts = Names(), []
    for n, words, n_words, codes in rows:
        numbers = np.array([names[w] for w in pa.decompress(words, n_words, "zstd", asbytes=True).split(b"\n")], np.int64)
        block = np.frombuffer(pa.decompress(codes, 20 * n, "zstd", asbytes=True), "<u4").reshape(5, n)
        parts.append(np.concatenate((numbers[block[:4]], block[4:].astype(np.int64))))
    cols = np.concatenate(parts, axis=1)
    del parts
    head, low = cols[0] << 32 | cols[1], cols[2] << 32 | cols[3]
    cols = cols[:, np.lexsort((low, head))]
    leaves, spelt = cols[4], list(names)
    new = np.zeros(cols.shape[1], bool)
    new[0] = True
    new[1:] = cols[0, 1:] != cols[0, :-1]
    phrases, counts = [], []
    for depth in range(2, DEPTH + 1):
        new[1:] |= cols[depth - 1, 1:] != cols[depth - 1, :-1]
        at = np.flatnonzero(new)
        sums = np.add.reduceat(leaves, at)
        kept = (sums >= support) & (cols[depth - 1, at] > 0)
        at, sums = at[kept], sums[kept]
        if depth < DEPTH and len(at):
            light = np.array([tuple(spelt[i] for i in p) not in heavy for p in cols[:depth, at].T.tolist()], bool)
            at, sums = at[light], sums[light]
        if len(at):
            phrases.append(spell(list(cols[:depth, at]), spelt))
            counts.append(sums)
    return phrases, counts


def phrase_counts(docs: DataFrame, text: str, lang: str, support: int, budget: int | None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(lang, phrase, f) of all phrases of 1 to ``DEPTH`` words with f >= support; (lang, n); the heavy words among the first."""
    spark = docs.sparkSession
    src = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"), F.coalesce(F.col(text).cast("string"), F.lit("")).cast("binary").alias("text"))
    counts = [materialize(prefix_counts(src, 1, {}), "words")]
    total = counts[0].agg(F.coalesce(F.sum("f"), F.lit(0))).first()[0]
    if budget is None:
        budget = max(LEAST_SUFFIXES, min(MOST_SUFFIXES, total // (4 * partitions(spark))), -(-total // MOST_GROUPS))
    heavy = [heavy_prefixes(counts[0], budget)]
    while heavy[-1] and len(heavy) < DEPTH - 1:
        counts.append(materialize(prefix_counts(src, len(heavy) + 1, as_prefixes(heavy[-1])), "prefixes"))
        heavy.append(heavy_prefixes(counts[-1], budget))
    firsts = boundaries(counts, heavy, budget)
    known = as_prefixes([r for rows in heavy for r in rows])

    def grow(_: tuple, group: pa.Table) -> pa.Table:
        out: list[pa.RecordBatch] = []
        by_lang: dict[str, list] = {}
        for g, n, n_words, words, codes in zip(*(group.column(c).to_pylist() for c in ("lang", "n", "n_words", "words", "codes")), strict=True):
            by_lang.setdefault(g, []).append((n, words, n_words, codes))
        for g, rows in by_lang.items():
            for p, c in zip(*subtree(g, rows, support, known.get(g, set())), strict=True):
                out.append(pa.RecordBatch.from_arrays([pa.array([g] * len(p), pa.string()), p, pa.array(c, pa.int64())], ["lang", "phrase", "f"]))
        return pa.Table.from_batches(out, pa.schema([("lang", pa.string()), ("phrase", pa.string()), ("f", pa.int64())]))

    nodes = blocks(src, firsts, known).groupBy("group").applyInArrow(grow, "lang string, phrase string, f long")
    words = counts[0].filter(F.col("f") >= support)
    found = words.unionByName(nodes)
    for df in counts[1:]:  # heavy pairs and triples stand in several groups: their counts come from the partitioning
        found = found.unionByName(df.filter((F.col("f") >= support) & (F.col("f") > budget)))
    n = counts[0].groupBy("lang").agg(F.sum("f").alias("n"))
    big = spark.createDataFrame(heavy[0], "lang string, phrase string, f long")
    return materialize(found, "phrases"), n, big


def _part(phrase: str, k: str) -> tuple[Column, Column]:
    """The first ``k`` words of a phrase and the rest."""
    first = F.expr(f"substring_index({phrase}, ' ', {k})")
    return first, F.expr(f"substring({phrase}, length(substring_index({phrase}, ' ', {k})) + 2)")


def look_up(df: DataFrame, part: str, name: str, phrases: DataFrame, big: DataFrame) -> DataFrame:
    """``df`` plus the count of the phrase in column ``part``. Words that many rows ask for come from the bounded ``big``."""
    hot = F.broadcast(big.select(F.col("lang"), F.col("phrase").alias(part), F.col("f").alias("_hot")))
    asked = df.join(hot, ["lang", part], "left")
    key = F.when(F.col("_hot").isNotNull(), F.concat(F.lit("\n"), "phrase")).otherwise(F.col(part))  # no phrase holds a line break
    counts = phrases.select("lang", F.col("phrase").alias("_key"), F.col("f").alias("_f"))
    found = asked.withColumn("_key", key).join(counts, ["lang", "_key"], "left")
    return found.withColumn(name, F.coalesce("_hot", "_f")).drop("_hot", "_key", "_f")


def collocations(
    docs: DataFrame,
    text: str = "text",
    lang: str = "lang",
    support: int = 30,
    share: int = 80,
    top: int | None = 2000,
    budget: int | None = None,
) -> DataFrame:
    """Phrases of 2 to 4 words of each language, best first: lang, rank, phrase, a, l, r, n, score.

    Texts are lower-cased (A-Z), split at ``.,;:!?`` and line breaks into pieces and these at blanks into words. ``a``
    counts all occurrences of the phrase within pieces (at least ``support``), ``l`` and ``r`` those of its two parts at
    the cut with the least score floor(2000000 a / (l + r)) (ties: the shorter first part), ``n`` the language's words. A
    phrase is left out if a longer candidate holds it and occurs at least ``share`` percent as often. Order: score and
    ``a`` descending, then the phrase's bytes; ``top`` a language, or all (None). Null languages are ``und``, null and
    empty texts have no words; keys and other columns aren't read. An empty table gives an empty result. ``budget`` is
    the number of suffixes of a group (default: from the corpus' size and the shuffle partitions).
    """
    phrases, sizes, big = phrase_counts(docs, text, lang, support, budget)
    words = F.size(F.split("phrase", " "))
    candidates = phrases.filter(words > 1).withColumnRenamed("f", "a")
    first, rest = _part("phrase", "k")
    cuts = candidates.select("lang", "phrase", "a", F.explode(F.sequence(F.lit(1), words - 1)).alias("k"))
    cuts = cuts.select("*", first.alias("first"), rest.alias("rest"))
    cuts = look_up(look_up(cuts, "first", "l", phrases, big), "rest", "r", phrases, big)
    score = F.expr("cast(cast(a as decimal(20, 0)) * 2000000 div (l + r) as bigint)")
    scored = cuts.groupBy("lang", "phrase", "a").agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut"))

    inner = []
    for n in range(3, DEPTH + 1):
        for size in range(2, n):
            for at in range(n - size + 1):
                inner.append(F.when(words == n, F.array_join(F.slice(F.split("phrase", " "), at + 1, size), " ")))
    held = candidates.filter(words > 2).select("lang", F.explode(F.array_compact(F.array(*inner))).alias("phrase"), "a")
    heaviest = held.groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    wide = lambda c: F.col(c).cast("decimal(20, 0)")
    kept = scored.join(heaviest, ["lang", "phrase"], "left").filter(F.col("longer").isNull() | (wide("longer") * 100 < wide("a") * share))
    best = kept.select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = best.withColumn("rank", F.row_number().over(order))
    if top is not None:
        ranked = ranked.filter(F.col("rank") <= top)
    return ranked.join(sizes, "lang").select("lang", F.col("rank").cast("int"), "phrase", "a", "l", "r", "n", "score")


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


ORACLE = r"""
WITH pieces AS (
  SELECT row_number() OVER () AS piece, lang, regexp_extract_all(piece, '[^ \t]+') AS w
  FROM (SELECT coalesce(lang, 'und') AS lang,
               unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\n\x0B\f\r]')) AS piece
        FROM documents)),
grams AS (
  SELECT lang, d, array_to_string(w[i : i + d - 1], ' ') AS phrase
  FROM pieces, unnest(range(1, 5)) AS ds(d), unnest(range(1, len(w) - d + 2)) AS starts(i)),
f AS (SELECT lang, d, phrase, count(*) AS f FROM grams GROUP BY ALL HAVING count(*) >= 30),
sizes AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM pieces GROUP BY lang),
cand AS (SELECT lang, d, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE d > 1),
cuts AS (
  SELECT c.lang, c.phrase, c.a, k, l.f AS l, r.f AS r, CAST(CAST(2000000 AS HUGEINT) * c.a // (l.f + r.f) AS BIGINT) AS score
  FROM cand c, unnest(range(1, c.d)) AS ks(k)
  JOIN f l ON l.lang = c.lang AND l.phrase = array_to_string(c.w[1 : k], ' ')
  JOIN f r ON r.lang = c.lang AND r.phrase = array_to_string(c.w[k + 1 :], ' ')),
scored AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
inside AS (
  SELECT lang, array_to_string(w[i : i + s - 1], ' ') AS phrase, max(a) AS longer
  FROM cand, unnest(range(2, d)) AS ss(s), unnest(range(1, d - s + 2)) AS starts(i) GROUP BY 1, 2),
ranked AS (
  SELECT s.*, row_number() OVER (PARTITION BY s.lang ORDER BY score DESC, a DESC, s.phrase) AS rank
  FROM scored s LEFT JOIN inside i ON i.lang = s.lang AND i.phrase = s.phrase
  WHERE longer IS NULL OR 100 * longer < 80 * a)
SELECT lang, CAST(rank AS INTEGER) AS rank, phrase, a, l, r, n, score FROM ranked JOIN sizes USING (lang) WHERE rank <= 2000
"""
