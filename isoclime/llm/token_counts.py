"""Token counts by a tokenizer compiled into two deterministic finite-state transducers.

1. The *splitter* reads characters as classes (letters, numbers, white space, ...) and marks where pieces begin. A mark
   may come one character late (the last blank of a run belongs to the next piece), never more. It has 11 states, so
   a chunk of text is a map from the state it is entered in to the state it is left in. The maps of all chunks are
   computed side by side, composed by a parallel prefix scan, and tell every chunk's true state at its entry.
2. The *merger* reads the bytes of a piece. After any prefix, the last token of the prefix's own encoding and the
   counts at the places where a longer token may still have begun are all that the future depends on: that is its
   state. A transition carries the change of the token count, so the changes sum up to the number of tokens. States
   are made when they are first reached. A chunk that holds the beginning of a piece is left in a state that doesn't
   depend on how it was entered, so its map needs one run; the bytes before that beginning, and chunks within one
   huge piece, are run once more from the state the chunk before was left in, until both runs meet.

A pair of tokens stands side by side in an encoding unless some merge across their border comes before the merges
that build either of them; a prefix has exactly one last token that fits what precedes it.

Texts stream through in spans of ``SPAN`` bytes whatever their length, and both states carry over, so memory doesn't
grow with a text beyond the text itself. No shuffle; a lost task is run again on its input split.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table
from .packing import _byte_alphabet, default_tokenizer

SPAN, CHUNK, LIMIT = 1 << 20, 512, 512
DOC_END, SPECIAL = 0xFF, 0xFE  # bytes that UTF-8 never holds
MOST_TRANSITIONS = 1 << 19  # what a worker keeps of the merger; beyond it, the table is begun anew

# --- the splitter -----------------------------------------------------------------------------------------------------

#: Classes of characters. The first five are letters: s t m d end a contraction, r v need an e, l needs an l.
LETTER, STMD, RV, EL, E, NUMBER, BLANK, SPACE, QUOTE, OTHER, BREAK, PAD = range(12)
CLASSES = 12
#: States: before a piece; in letters, numbers, other signs; after a quote, quote+r/v, quote+l; in white space of one
#: or more characters, whose last is a blank or not.
FRESH, IN_L, IN_N, IN_O, Q, QRV, QL, ONE_B, ONE_S, MANY_B, MANY_S = range(11)
STATES = 11


def splitter() -> tuple[np.ndarray, np.ndarray]:
    """(next state, marks) for each state and class; mark 1: a piece begins here, 2: at the character before."""
    step, mark = np.zeros((STATES, CLASSES), np.uint8), np.zeros((STATES, CLASSES), np.uint8)
    letters = (LETTER, STMD, RV, EL, E)

    def opened(c: int) -> int:
        """The state after the first character of a piece."""
        return IN_L if c in letters else {NUMBER: IN_N, BLANK: ONE_B, SPACE: ONE_S, QUOTE: Q, OTHER: IN_O, BREAK: FRESH}[c]

    own = {IN_L: letters, IN_N: (NUMBER,), IN_O: (QUOTE, OTHER), Q: (QUOTE, OTHER)}
    ends = {Q: (STMD,), QRV: (E,), QL: (EL,)}
    for s in range(STATES):
        for c in range(CLASSES):
            if c == PAD:
                step[s, c] = s
            elif c in ends.get(s, ()):
                step[s, c] = FRESH  # the contraction is complete
            elif s == Q and c in (RV, EL):
                step[s, c] = QRV if c == RV else QL
            elif s in (QRV, QL):  # no contraction: the quote stands alone and the letter begins a piece
                step[s, c], mark[s, c] = opened(c), 2 | (c not in letters)
            elif c in own.get(s, ()):
                step[s, c] = IN_O if s == Q else s
            elif s >= ONE_B and c in (BLANK, SPACE):
                step[s, c] = MANY_B if c == BLANK else MANY_S
            elif s >= ONE_B and c != BREAK:  # the run ends before a piece: its last character splits off
                joined = s in (ONE_B, MANY_B)
                step[s, c] = (IN_O if c == QUOTE else opened(c)) if joined else opened(c)
                mark[s, c] = (2 if s in (MANY_B, MANY_S) else 0) | (not joined)
            else:
                step[s, c], mark[s, c] = opened(c), 1
    return step, mark


STEP, MARK = splitter()


def classes(path: str) -> bytes:
    """The class of every code point as the tokenizer's own library splits them, deflated."""
    from tokenizers import Tokenizer

    split = Tokenizer.from_file(path).pre_tokenizer.pre_tokenize_str
    out = np.full(0x110000, OTHER, np.uint8)

    def same(lo: int, hi: int) -> int:
        """The class of all code points lo..hi-1, or -1 if they differ or are white space."""
        chars, n = "".join(map(chr, range(lo, hi))), hi - lo
        if [span for _, span in split("!" + chars + "a")] == [(0, 1), (1, n + 2)]:
            return LETTER
        spans = [span for _, span in split("!" + chars + "1")]
        return {(1, n + 2): NUMBER, (n + 1, n + 2): OTHER}.get(spans[1], -1) if len(spans) == 2 else -1

    todo = [(c, c + 1) for c in range(0x80)] + [(lo, min(lo + 1024, 0x110000)) for lo in range(0x80, 0x110000, 1024) if not 0xD800 <= lo < 0xE000]
    todo[todo.index((0xD480, 0xD880))] = (0xD480, 0xD800)
    todo.append((0xE000, 0xE080))
    while todo:
        lo, hi = todo.pop()
        kind = same(lo, hi)
        if kind >= 0:
            out[lo:hi] = kind
        elif hi - lo == 1:
            out[lo] = SPACE
        else:
            todo += [(lo, (lo + hi) // 2), ((lo + hi) // 2, hi)]
    for chars, kind in (("stmd", STMD), ("rv", RV), ("l", EL), ("e", E), (" ", BLANK), ("'", QUOTE)):
        out[[ord(c) for c in chars]] = kind
    return zlib.compress(out.tobytes())


def lanes(values: np.ndarray, length: int, fill: int) -> np.ndarray:
    """``values`` cut into chunks, one a column, step by step down the rows; the end is filled up."""
    n = -(-len(values) // length)
    out = np.full(n * length, fill, values.dtype)
    out[: len(values)] = values
    return np.ascontiguousarray(out.reshape(n, length).T)


def scan(maps: np.ndarray) -> np.ndarray:
    """Prefix compositions of state maps (rows: chunks, columns: states), in a logarithmic number of steps."""
    out, by = maps.copy(), 1
    while by < len(out):
        out[by:] = np.take_along_axis(out[by:], out[:-by].astype(np.intp), axis=1)
        by *= 2
    return out


def split_marks(kinds: np.ndarray, state: int, length: int = CHUNK // 2) -> tuple[np.ndarray, int, int]:
    """(marks, state before the last character, state after it) of a span of classes entered in ``state``."""
    rows = lanes(kinds, length, PAD)
    step, mark = STEP.ravel(), MARK.ravel()
    ways = np.repeat(np.arange(STATES, dtype=np.uint8)[:, None], rows.shape[1], axis=1)
    for row in rows:
        ways = step[ways * np.uint8(CLASSES) + row]
    entry = np.full(rows.shape[1], state, np.uint8)
    entry[1:] = scan(np.ascontiguousarray(ways.T))[:-1, state]
    marks, before, last = np.empty_like(rows), state, (len(kinds) - 1) % length
    for i, row in enumerate(rows):
        if i == last:
            before = int(entry[-1])
        at = entry * np.uint8(CLASSES) + row
        entry, marks[i] = step[at], mark[at]
    return marks.T.ravel()[: len(kinds)], before, int(entry[-1])


# --- the merger -------------------------------------------------------------------------------------------------------


class Merger:
    """The transducer over bytes of a byte-level BPE vocabulary; states and transitions are made on demand."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.special = check(spec)
        letters = _byte_alphabet()
        vocab = spec["model"]["vocab"]
        pairs = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        parts: dict[int, tuple[int, int, int]] = {}  # token: what it is merged from, and that merge's place in the order
        self.after: dict[int, dict[int, int]] = {}  # left part: {right part: place}
        for i, (a, b) in enumerate(pairs):
            parts.setdefault(vocab[a + b], (vocab[a], vocab[b], i))
            self.after.setdefault(vocab[a], {})[vocab[b]] = i
        never = len(pairs) + 1
        self.left: dict[int, list] = {}  # what stands at a token's left edge, and which merge ends it; likewise right
        self.right: dict[int, list] = {}
        for side, edges in ((0, self.left), (1, self.right)):
            for t in vocab.values():
                out, token, until = [], t, never
                while True:
                    out.append((token, until))
                    if token not in parts:
                        break
                    token, until = parts[token][side], parts[token][2]
                edges[t] = out
        self.child: dict[int, int] = {}  # trie of all tokens: node * 256 + byte
        self.token, self.inner, self.spelt = [-1], bytearray(1), [b""]
        self.bytes: dict[int, bytes] = {}
        for text, t in vocab.items():
            if t not in parts and len(text) > 1:
                continue  # special, or never made by a merge
            node, self.bytes[t] = 0, bytes(letters[c] for c in text)
            for at, c in enumerate(self.bytes[t]):
                self.inner[node] = 1
                node = self.child.setdefault(node << 8 | c, len(self.token))
                if node == len(self.token):
                    self.token.append(-1)
                    self.inner.append(0)
                    self.spelt.append(self.bytes[t][: at + 1])
            self.token[node] = t
        self.barred: dict[int, dict[int, int]] = {}
        self.restart()

    def restart(self) -> None:
        """Forget all states but the fresh one."""
        self.states: list[tuple] = [(-1, ())]
        self.ids = {self.states[0]: 0}
        self.likes: dict[tuple[int, int], int] = {}
        self.first: dict[tuple[int, frozenset], int] = {}
        self.bits = MOST_TRANSITIONS.bit_length()
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.values = np.zeros(1 << self.bits, np.int64)
        self.held = 0
        self._put(DOC_END, 0, 0)
        self._put(SPECIAL, 0, 1)

    def bars(self, token: int) -> dict[int, int]:
        """What may not stand at the left edge behind ``token``: its merge with the token's right edge, by place."""
        out = self.barred.get(token)
        if out is None:
            out = {}
            for edge, until in self.right[token]:
                for other, place in self.after.get(edge, {}).items():
                    if place < until and place < out.get(other, until):
                        out[other] = place
            self.barred[token] = out
        return out

    def side_by_side(self, token: int, other: int) -> bool:
        bars = self.bars(token)
        return not any(bars.get(edge, until + 1) <= until for edge, until in self.left[other])

    def _alike(self, node: int, before: int) -> int:
        """A token that bars the same continuations of ``node`` as ``before``; -1 if it bars none. Few states thus do."""
        if before < 0:
            return before
        known = self.likes.get((node, before))
        if known is None:
            spelt, text = self.spelt[node], self.bytes
            bars = frozenset((t, place) for t, place in self.bars(before).items() if text[t].startswith(spelt) or spelt.startswith(text[t]))
            known = self.likes[node, before] = self.first.setdefault((node, bars), before) if bars else -1
        return known

    def _make(self, key: int) -> None:
        """The transition of a state (key >> 8) on a byte (key & 255)."""
        last, begun = self.states[key >> 8]
        byte, child, token = key & 255, self.child, self.token
        ways = [(node, before, n) for at, before, n in begun if (node := child.get(at << 8 | byte)) is not None]
        ways.append((child[byte], last, 0))
        for node, before, n in ways:
            t = token[node]
            if t >= 0 and (before < 0 or self.side_by_side(before, t)):
                break
        change = n + 1
        state = (self._alike(0, t), tuple((node, self._alike(node, before), m - change) for node, before, m in ways if self.inner[node]))
        to = self.ids.setdefault(state, len(self.states))
        if to == len(self.states):
            self.states.append(state)
        self._put(key, to, change)

    def _slot(self, key: int) -> int:
        return (key * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF) >> (64 - self.bits)

    def _put(self, key: int, to: int, change: int) -> None:
        if 2 * self.held >= len(self.keys):
            old = self.keys >= 0
            known = list(zip(self.keys[old].tolist(), self.values[old].tolist(), strict=True))
            self.bits += 1
            self.keys, self.values, self.held = np.full(1 << self.bits, -1, np.int64), np.zeros(1 << self.bits, np.int64), 0
            for k, v in known:
                self._put(k, v >> 16, (v & 65535) - 32768)
        at, mask = self._slot(key), len(self.keys) - 1
        while self.keys[at] >= 0:
            at = at + 1 & mask
        self.keys[at], self.values[at] = key, to << 16 | change + 32768
        self.held += 1

    def one(self, key: int) -> int:
        """State << 16 | change + 32768, for one key."""
        keys, at, mask = self.keys, self._slot(key), len(self.keys) - 1
        while True:
            k = keys.item(at)
            if k == key:
                return self.values.item(at)
            if k < 0:
                self._make(key)
                return self.one(key)
            at = at + 1 & mask

    def many(self, keys: np.ndarray) -> np.ndarray:
        at = ((keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)
        out, mask = self.values[at], len(self.keys) - 1
        lost = np.flatnonzero(self.keys[at] != keys)
        for _ in range(8):
            if not len(lost):
                return out
            at[lost] = at[lost] + 1 & mask
            hit = self.keys[at[lost]] == keys[lost]
            out[lost[hit]] = self.values[at[lost[hit]]]
            lost = lost[~hit]
        for i in lost.tolist():
            out[i] = self.one(keys.item(i))
        return out

    def changes(self, data: np.ndarray, begins: np.ndarray, state: int, length: int = CHUNK) -> tuple[np.ndarray, int]:
        """(change of the count at every byte, state after the last), for bytes entered in ``state``."""
        if self.held > MOST_TRANSITIONS:
            kept = self.states[state]
            self.restart()
            state = self.ids.setdefault(kept, len(self.states))
            if state:
                self.states.append(kept)
        n = len(data)
        rows, fresh = lanes(data, length, DOC_END), lanes(begins, length, 1)
        path = np.zeros((length + 1, rows.shape[1]), np.int64)
        out = np.empty(rows.shape, np.int16)
        for i in range(length):
            got = self.many(np.where(fresh[i], 0, path[i]) << 8 | rows[i])
            path[i + 1] = got >> 16
            out[i] = (got & 65535) - 32768
        for j in range(rows.shape[1]):  # what stands before the first beginning, from the state before
            end = min(length, n - j * length)
            i = 0
            while i < end and not fresh[i, j] and path[i, j] != state:
                got = self.one(state << 8 | int(rows[i, j]))
                out[i, j], state = (got & 65535) - 32768, got >> 16
                i += 1
            if i < end:
                state = int(path[end, j])
        return out.T.ravel()[:n], state


def check(spec: dict) -> list[bytes]:
    """The special strings of a supported tokenizer file; another kind of tokenizer is an error."""
    model, split = spec["model"], spec["pre_tokenizer"] or {}
    plain = spec["normalizer"] is None and model["type"] == "BPE" and split.get("type") == "ByteLevel" and split.get("use_regex", True)
    plain = plain and not split["add_prefix_space"] and not any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges"))
    if not plain or any(t["single_word"] or t["lstrip"] or t["rstrip"] for t in spec["added_tokens"]):
        raise ValueError("not a plain byte-level BPE")
    return sorted((t["content"].encode() for t in spec["added_tokens"]), key=len, reverse=True)


_mergers: dict[str, Merger] = {}


def merger(path: str) -> Merger:
    if path not in _mergers:
        _mergers[path] = Merger(path)
    return _mergers[path]


# --- texts ------------------------------------------------------------------------------------------------------------


class Counter:
    """Counts the tokens of a stream of bytes, in which ``DOC_END`` ends a document and ``SPECIAL`` is one token."""

    def __init__(self, path: str, kinds: bytes):
        self.merger = merger(path)
        self.kinds = np.frombuffer(zlib.decompress(kinds), np.uint8)
        self.rest, self.split, self.state, self.partial = b"", FRESH, 0, 0

    def feed(self, span: bytes, final: bool) -> list[int]:
        """Counts of the documents that end in this span; ``final``: the span ends with a document."""
        data = np.frombuffer(self.rest + span, np.uint8)
        if not len(data):
            return []
        starts = np.flatnonzero((data & 0xC0) != 0x80)
        lead = data[starts]
        points = lead.astype(np.int32)
        for n, least, bits in ((1, 0xC0, 0x1F), (2, 0xE0, 0x0F), (3, 0xF0, 0x07)):
            many = np.flatnonzero((lead >= least) & (lead < (0xE0, 0xF0, 0xFE)[n - 1]))
            value = (lead[many] & bits).astype(np.int32)
            for k in range(n):
                value = value << 6 | (data[starts[many] + k + 1] & 0x3F)
            points[many] = value
        points[lead >= SPECIAL] = 0
        kinds = self.kinds[points]
        kinds[lead >= SPECIAL] = BREAK
        marks, before, after = split_marks(kinds, self.split)
        begins = marks & 1
        begins[:-1] |= marks[1:] >> 1
        till = len(data) if final else int(starts[-1])
        flags = np.zeros(len(data), np.uint8)
        flags[starts] = begins
        self.rest, self.split = (b"", after) if final else (data[till:].tobytes(), before)
        if not till:
            return []
        data = data[:till]
        change, self.state = self.merger.changes(data, flags[:till], self.state)
        total = np.concatenate(([0], np.cumsum(change, dtype=np.int64)))
        ends = total[np.flatnonzero(data == DOC_END)]
        if not len(ends):
            self.partial += int(total[-1])
            return []
        counts = np.diff(ends, prepend=0)
        counts[0] += self.partial
        self.partial = int(total[-1] - ends[-1])
        return counts.tolist()


def spans(texts: Iterator[bytes], special: list[bytes], size: int = SPAN) -> Iterator[tuple[bytes, bool]]:
    """The stream of ``Counter``: texts cut and joined to about ``size`` bytes, never within a character or special string."""
    marks = re.compile(b"|".join(map(re.escape, special)) or b"(?!)")
    longest = max(map(len, special), default=1)
    firsts = re.compile(b"[" + re.escape(bytes({s[0] for s in special})) + b"]") if special else None
    held, n = [], 0
    for text in texts:
        at = 0
        while at < len(text):
            end = min(at + size, len(text))
            if end < len(text):
                while text[end] & 0xC0 == 0x80:
                    end -= 1
                if firsts and (first := firsts.search(text, max(at + 1, end - longest + 1), end)):
                    end = first.start()
            part = marks.sub(bytes([SPECIAL]), text[at:end])
            held.append(part)
            n += len(part)
            at = end
            if n >= size and at < len(text):
                yield b"".join(held), False
                held, n = [], 0
        held.append(bytes([DOC_END]))
        n += 1
        if n >= size:
            yield b"".join(held), True
            held, n = [], 0
    if held:
        yield b"".join(held), True


def count_tokens(docs: DataFrame, text: str = "text", key: str = "doc_id", tokenizer: str | None = None, limit: int = LIMIT) -> DataFrame:
    """One row per document: ``key``, n_bytes (UTF-8), n_tokens, over_limit (more than ``limit`` tokens).

    Counts equal those of the tokenizers library without added special tokens; a special string written out in a text
    is one token. ``tokenizer`` is a byte-level BPE file of that library (another kind is an error). Null texts count
    as empty, which have no tokens. Keys may be null or repeat: every row is a document. Rows keep no order; other
    columns are ignored whatever their names. An empty table gives an empty result.
    """
    path = tokenizer or default_tokenizer()
    kinds = classes(path)
    src = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text).cast("string"), F.lit("")).cast("binary").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        special, counter = merger(path).special, Counter(path, kinds)
        for b in batches:
            column, counts = b.column(1), []
            for span, final in spans((column[i].as_py() for i in range(b.num_rows)), special):
                counts += counter.feed(span, final)
            sizes = np.diff(np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + b.num_rows + 1])
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(sizes, pa.int64()), pa.array(counts, pa.int64())], ["key", "n_bytes", "n_tokens"])

    kind = src.schema["key"].dataType.simpleString()
    out = src.mapInArrow(run, f"key {kind}, n_bytes long, n_tokens long")
    return out.select(F.col("key").alias(key), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))


def op11_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(table(spark, sf_dir, "documents"))
