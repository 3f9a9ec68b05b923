"""Periodic runs in word sequences, found online by catchers over completed dyadic blocks.

A run is a maximal stretch of words with smallest period q that is at least ``exponent`` * q (and ``shortest``) long.

* Level k looks after the periods from ``least_period(k)`` to ``least_period(k + 1) - 1``. They are so short against
  the run that one whole block of 2^k words, aligned to a multiple of 2^k, lies in it together with the block's
  repetition q words later. Once such a block is complete, its catcher waits for that repetition.
* Each appended word ends one window of 2^k words a level. Its hash (made of the hashes of its halves, one level
  down) is compared with those of the completed blocks that lie within the level's periods before it: at most one
  block a level for exponents of 4 or more. Equal hashes report a square, or most of one.
* Squares merge into runs: a reported one is extended word by word to the left, and to the right as far as words have
  come; what reaches the last word stays open and grows with the words appended next. Squares inside a known stretch
  of the same period, or of a period that divides it, add nothing.

Work is a few operations a word and level, numpy takes all words appended together at once, and a level keeps about
2.5 blocks of hashes. Short documents of like length go through one set of catchers, parted by words that occur once.
Hashes only choose what to look at: runs are verified word by word, and a document in which different words have
hashed alike is done again with exact word numbers.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import WORD, table

GROUP_BYTES, PORTION = 1 << 22, 1 << 18  # texts done together, and words appended at a time
BLANKS = np.zeros(256, bool)
BLANKS[[0x20, *range(0x09, 0x0E)]] = True


def least_period(level: int, exponent: int) -> int:
    return max(1, -(-((2 << level) - 1) // (exponent - 1)))


_factors = np.arange(2)


def least_factors(upto: int) -> np.ndarray:
    """The least prime factor of every number up to ``upto`` at least; 1 of 1."""
    global _factors
    if len(_factors) <= upto:
        out = np.arange(2 * upto + 1)
        for f in range(2, int(len(out) ** 0.5) + 1):
            if out[f] == f:
                part = out[f * f :: f]
                part[part == np.arange(f * f, len(out), f)] = f
        _factors = out
    return _factors


class Catchers:
    """Runs of one sequence of 64-bit words. ``longest`` bounds the length of any run asked for (levels beyond it are left out)."""

    def __init__(self, longest: int, exponent: int = 4, shortest: int = 6):
        self.exponent, self.shortest = exponent, shortest
        self.levels = 0
        while least_period(self.levels, exponent) * exponent <= longest:
            self.levels += 1
        self.words = np.zeros(0, np.int64)
        self.base, self.hashes = [0] * self.levels, [np.zeros(0, np.uint64) for _ in range(self.levels)]
        self.open: dict[tuple[int, int], int] = {}  # (start, period): end, which is the last word's
        self.runs: set[tuple[int, int, int]] = set()

    def append(self, words: np.ndarray) -> None:
        self.words = np.concatenate((self.words, words)) if len(self.words) else words
        n = len(self.words)
        for (start, period), end in list(self.open.items()):
            del self.open[start, period]
            self._keep(start, self._right(end - period, period), period)
        for k in range(self.levels):
            size, low, high = 1 << k, least_period(k, self.exponent), least_period(k + 1, self.exponent) - 1
            at = self.base[k] + len(self.hashes[k])
            if n - size < at:
                break
            self.hashes[k] = np.concatenate((self.hashes[k], self._windows(k, at, n - size + 1)))
            base, hashes = self.base[k], self.hashes[k]
            p = np.arange(at, n - size + 1)
            block = (p - low) // size * size
            while high >= low:
                waits = (block >= 0) & (block >= p - high)
                if not waits.any():
                    break
                i = np.flatnonzero(waits)
                i = i[hashes[p[i] - base] == hashes[block[i] - base]]
                if len(i):
                    self._merge(block[i], p[i] - block[i], k)
                block = block - size
        for k in range(self.levels):
            size, high = 1 << k, least_period(k + 1, self.exponent)
            drop = n - 2 * size - max(high, size) - self.base[k]
            if drop > size:
                self.hashes[k], self.base[k] = self.hashes[k][drop:].copy(), self.base[k] + drop

    def finish(self) -> list[tuple[int, int, int]]:
        """All runs as (start, length, period), in this order."""
        for (start, period), end in self.open.items():
            self._close(start, end, period)
        self.open = {}
        return sorted(self.runs, key=lambda r: (r[0], r[2]))

    def _windows(self, k: int, at: int, to: int) -> np.ndarray:
        if k == 0:
            return self.words[at:to].view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        half, a = self.hashes[k - 1], at - self.base[k - 1]
        left, right = half[a : a + to - at], half[a + (1 << k - 1) :][: to - at]
        return (left ^ (left >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) + (right ^ (right >> np.uint64(31))) * np.uint64(0x94D049BB133111EB)

    def _merge(self, block: np.ndarray, period: np.ndarray, k: int) -> None:
        """Squares reported at a level, each at the start of its block, become stretches of their least periods."""
        hashes, base, size = self.hashes[k], self.base[k], 1 << k
        factor, least, rest = least_factors(int(period.max())), period.copy(), period.copy()
        while (rest > 1).any():
            f = factor[rest]
            less = least // f
            least = np.where((rest > 1) & (hashes[block - base] == hashes[block + less - base]), less, least)
            rest //= f
        order = np.lexsort((block, least))
        block, period, least = block[order], period[order], least[order]
        cuts = [0, *(np.flatnonzero(np.diff(least)) + 1).tolist(), len(least)]
        for lo, hi in zip(cuts, cuts[1:], strict=False):
            own, q = block[lo:hi], int(least[lo])
            i = 0
            while i < len(own):
                s = int(own[i])
                start, end = self._stretch(s, q)
                to = i + max(1, int(np.searchsorted(own[i:], end - q)))
                for j in (np.flatnonzero(own[i:to] + period[lo + i : lo + to] + size > end) + i).tolist():
                    if period[lo + j] > q:  # the shorter period's hashes were equal by chance
                        longer = int(period[lo + j])
                        self._keep(*self._stretch(int(own[j]), longer), longer)
                self._keep(start, end, q)
                i = to

    def _keep(self, start: int, end: int, period: int) -> None:
        if end == len(self.words):
            self.open[start, period] = end
        else:
            self._close(start, end, period)

    def _close(self, start: int, end: int, period: int) -> None:
        w, n = self.words, end - start
        if n < max(self.shortest, self.exponent * period):
            return
        rest = period
        while rest > 1:  # a period of at most a quarter of the stretch is a multiple of the least
            f = int(least_factors(rest)[rest])
            less = period // f
            if np.array_equal(w[start : end - less], w[start + less : end]):
                return
            while rest % f == 0:
                rest //= f
        self.runs.add((start, n, period))

    def _stretch(self, s: int, q: int) -> tuple[int, int]:
        """The maximal stretch with period ``q`` in which words s and s + q are; empty if these differ."""
        w = self.words
        if w[s] != w[s + q]:
            return s, s
        step, lo = 16, s
        while lo > 0:
            part = max(lo - step, 0)
            differ = np.flatnonzero(w[part:lo] != w[part + q : lo + q])
            if len(differ):
                lo = part + int(differ[-1]) + 1
                break
            lo, step = part, 2 * step
        return lo, self._right(s, q)

    def _right(self, i: int, q: int) -> int:
        """The end of a stretch with period ``q`` whose words up to ``i`` (not included) repeat q words later."""
        w, step = self.words, 16
        while i + q < len(w):
            part = min(i + step, len(w) - q)
            differ = np.flatnonzero(w[i:part] != w[i + q : part + q])
            if len(differ):
                return i + int(differ[0]) + q
            i, step = part, 2 * step
        return len(w)


class Words:
    """The words of one text by their places, without an object for each."""

    def __init__(self, text: bytes):
        self.text = text
        edges = np.flatnonzero(np.diff(BLANKS[np.frombuffer(text, np.uint8)], prepend=True, append=True))
        self.starts, self.ends = edges[::2].astype(np.int32), edges[1::2].astype(np.int32)

    def __len__(self) -> int:
        return len(self.starts)

    def numbers(self, exact: bool = False) -> np.ndarray:
        """A 64-bit number for each word: its hash, or (``exact``) one of its own."""
        known: dict[bytes, int] = {}
        number = (lambda w: known.setdefault(w, len(known))) if exact else hash
        out = np.empty(len(self), np.int64)
        for at in range(0, len(self), PORTION):
            to = min(at + PORTION, len(self))
            out[at:to] = np.fromiter(map(number, self.text[self.starts[at] : self.ends[to - 1]].split()), np.int64, to - at)
        return out

    def periodic(self, start: int, length: int, period: int) -> bool:
        """Whether the stretch lies in the text and has the period, by its bytes."""
        if start < 0 or start + length > len(self):
            return False
        text, starts, ends = self.text, self.starts, self.ends
        return all(text[starts[i] : ends[i]] == text[starts[i + period] : ends[i + period]] for i in range(start, start + length - period))

    def joined(self, kept: np.ndarray) -> bytes:
        """The kept words, parted by one space."""
        out, at = [], np.flatnonzero(kept)
        for lo in range(0, len(at), PORTION):
            some = at[lo : lo + PORTION]
            if len(some) == some[-1] - some[0] + 1:
                out.append(b" ".join(self.text[self.starts[some[0]] : self.ends[some[-1]]].split()))
            else:
                out.append(b" ".join([self.text[a:b] for a, b in zip(self.starts[some].tolist(), self.ends[some].tolist(), strict=True)]))
        return b" ".join(out)


def find_runs(texts: list[Words], exponent: int, shortest: int) -> list[list[tuple[int, int, int]]]:
    """The runs of each text; texts of like length share catchers."""
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    groups: dict[int, list[int]] = {}
    for i, t in enumerate(texts):
        if len(t) >= max(shortest, exponent):
            groups.setdefault(len(t).bit_length(), []).append(i)
    for group in groups.values():
        catchers, firsts, n = Catchers(max(len(texts[i]) for i in group), exponent, shortest), [], 0
        rows: list[np.ndarray] = []
        for j, i in enumerate(group):
            firsts.append(n)
            rows += [texts[i].numbers(), np.array([hash((j, "end"))])]
            n += len(texts[i]) + 1
        sequence = np.concatenate(rows)
        del rows
        for at in range(0, n, PORTION):
            catchers.append(sequence[at : at + PORTION])
        failed = set()
        for start, length, period in catchers.finish():
            j = int(np.searchsorted(firsts, start, "right")) - 1
            run = (start - firsts[j], length, period)
            if texts[group[j]].periodic(*run):
                out[group[j]].append(run)
            else:
                failed.update(group[j : int(np.searchsorted(firsts, start + length - 1, "right"))])
        for i in failed:
            alone = Catchers(len(texts[i]), exponent, shortest)
            alone.append(texts[i].numbers(exact=True))
            out[i] = alone.finish()
    return out


RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def periodic_runs(docs: DataFrame, text: str = "text", key: str = "doc_id", exponent: int = 4, shortest: int = 6) -> DataFrame:
    """One row per document: ``key``, n_words, runs (array of start, length, period, by start, then period), collapsed.

    Words are ``[^\\x20\\x09-\\x0D]+``, numbered from 0. ``collapsed`` is the text's words joined by one space, without
    those that a run holds after its first ``period`` words. ``exponent`` is a whole number of 2 or more: the least
    length of a run in periods, beside ``shortest`` words. Null and empty texts have no words, no runs and an empty
    ``collapsed``. Keys may be null or repeat: every row is a document. Other columns are ignored whatever their names;
    an empty table gives an empty result. No shuffle; about 60 bytes a word of the longest text are held.
    """
    if exponent < 2:
        raise ValueError("a run repeats at least twice")
    src = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text).cast("string"), F.lit("")).cast("binary").alias("text"))

    def done(keys: list[pa.Scalar], kind: pa.DataType, texts: list[bytes]) -> pa.RecordBatch:
        words = [Words(t) for t in texts]
        found, collapsed = find_runs(words, exponent, shortest), []
        for w, runs in zip(words, found, strict=True):
            kept = np.ones(len(w), bool)
            for start, length, period in runs:
                kept[start + period : start + length] = False
            collapsed.append(w.joined(kept))
        flat = np.array([r for runs in found for r in runs], np.int64).reshape(-1, 3)
        rows = pa.StructArray.from_arrays([pa.array(flat[:, c]) for c in range(3)], fields=list(RUN))
        offsets = np.concatenate(([0], np.cumsum([len(r) for r in found]))).astype(np.int32)
        lists = pa.ListArray.from_arrays(pa.array(offsets), rows)
        n = pa.array([len(w) for w in words], pa.int64())
        return pa.RecordBatch.from_arrays([pa.array(keys, kind), n, lists, pa.array(collapsed, pa.binary()).cast(pa.string())], ["key", "n_words", "runs", "collapsed"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys, texts, held, kind = [], [], 0, b.schema.field(0).type
            for i in range(b.num_rows):
                t = b.column(1)[i].as_py()
                if texts and held + len(t) > GROUP_BYTES:
                    yield done(keys, kind, texts)
                    keys, texts, held = [], [], 0
                keys.append(b.column(0)[i].as_py())
                texts.append(t)
                held += len(t)
            if texts:
                yield done(keys, kind, texts)

    kind = src.schema["key"].dataType.simpleString()
    schema = f"key {kind}, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string"
    return src.mapInArrow(run, schema).withColumnRenamed("key", key)


def best_run(runs: Column) -> Column:
    """The run with the greatest length / period, exactly; ties: least start, then least period (their order); null if none."""

    def better(best: Column, run: Column) -> Column:
        return F.when(best.isNull() | (run.length * best.period > best.length * run.period), run).otherwise(best)

    return F.aggregate(runs, F.lit(None).cast("struct<start: long, length: long, period: long>"), better)


def planted(docs: DataFrame) -> DataFrame:
    """doc_id and text of documents; in those whose crc32 of the id is divisible by 10, words from one on repeat with a period."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g, n = F.floor(h / 10).cast("int"), F.size("words")
    a = g % n
    p = 1 + F.floor((n - a) / (3 + g % 8)).cast("int")
    cycle = F.expr("slice(words, a + 1, p)")
    again = F.flatten(F.array_repeat(cycle, F.expr("cast(ceil((n - a) / p) as int)")))
    words = F.regexp_extract_all(F.col("text"), F.lit(WORD), F.lit(0))
    chosen = docs.select("doc_id", "text", F.when(h % 10 == 0, words).alias("words"), g.alias("g"))
    sized = chosen.select("*", F.when(n > 0, n).alias("n")).select("*", F.when(F.col("n") > 0, a).alias("a"))
    timed = sized.select("*", F.when(F.col("n") > 0, p).alias("p"))
    text = F.array_join(F.slice(F.concat(F.expr("slice(words, 1, a)"), again), 1, F.col("n")), " ")
    return timed.select("doc_id", F.when(F.col("n") > 0, text).otherwise(F.col("text")).alias("text"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs(planted(table(spark, sf_dir, "documents")))
    listed = F.transform("runs", lambda r: F.concat_ws(",", *(r[c].cast("string") for c in ("start", "length", "period"))))
    lines = F.when(F.size("runs") == 0, "").otherwise(F.concat(F.array_join(listed, "\n"), F.lit("\n")))
    with_best = found.select("doc_id", "n_words", "runs", "collapsed", best_run(F.col("runs")).alias("best"))
    return with_best.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "best.start",
        "best.length",
        "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(lines.cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
        "n_words",
    )
