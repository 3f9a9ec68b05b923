"""Best-fit-decreasing packing of tokenised documents into fixed windows.

Overlong documents are first cut into full windows. What remains is sorted by length, longest first, and
each piece goes to the open window with the least room that still holds it; a segment tree over remaining
capacity finds that window. The few windows with room left are then closed by cutting: the emptiest give
their pieces to fill the fullest, and the last one is split along the binary digits of its fill, so every
sequence ends up either full or a power of two long and nothing is padded.

Each task packs the documents it reads in groups of at most ``group_tokens`` tokens (plus one document):
no shuffle, memory bounded by the group, and a lost task is simply run again on the same input split.
Sequence ids are the partition number in the high bits and a counter in the low 33.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from .common import table

WINDOW, END_ID, GROUP_TOKENS = 2048, 1, 1 << 21
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"  # fixed: byte-level pre-tokenisation

_encoders: dict[str, tiktoken.Encoding] = {}


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def _byte_alphabet() -> dict[str, int]:
    """The printable stand-ins of byte-level vocabularies: bytes that print stand for themselves."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


def encoder(path: str) -> tiktoken.Encoding:
    """The byte-level BPE of a tokenizers JSON file, run by the faster library; ids are the file's own."""
    if path not in _encoders:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        letters = _byte_alphabet()
        vocab = {bytes(letters[c] for c in t): i for t, i in spec["model"]["vocab"].items() if t not in special}
        _encoders[path] = tiktoken.Encoding("byte_bpe", pat_str=PATTERN, mergeable_ranks=vocab, special_tokens=special)
    return _encoders[path]


_plain: dict[str, Tokenizer] = {}


def encode(path: str, text: str) -> np.ndarray:
    """The ids of a text; where its longest run of white space exceeds what the faster library can match, by the file's own library."""
    try:
        return encoder(path).encode_to_numpy(text, allowed_special="all")
    except ValueError:  # its regular expression runs out of room, from about a million blanks or line breaks on
        if path not in _plain:
            _plain[path] = Tokenizer.from_file(path)
        return np.array(_plain[path].encode(text, add_special_tokens=False).ids, np.uint32)


class CapacityTree:
    """Open windows by remaining capacity; ``tightest(n)`` is the least capacity >= n that has one, or -1."""

    def __init__(self, window: int):
        self.leaves = 1 << window.bit_length()
        self.counts = [0] * (2 * self.leaves)

    def add(self, capacity: int, by: int) -> None:
        at = self.leaves + capacity
        while at:
            self.counts[at] += by
            at >>= 1

    def tightest(self, need: int) -> int:
        at, counts = self.leaves + need, self.counts
        if counts[at]:
            return need
        while at > 1:
            if not at & 1 and counts[at + 1]:
                at += 1
                while at < self.leaves:
                    at = 2 * at if counts[2 * at] else 2 * at + 1
                return at - self.leaves
            at >>= 1
        return -1


def plan(lengths: list[int], window: int = WINDOW) -> list[list[tuple[int, int, int]]]:
    """Sequences as lists of (document, start, length); documents are numbered as in ``lengths``, all positive."""
    full, short = [], []
    for d, n in enumerate(lengths):
        cut = n - n % window
        full += [[(d, at, window)] for at in range(0, cut, window)]
        if n > cut:
            short.append((d, cut, n - cut))
    short.sort(key=lambda p: (-p[2], p[0]))
    tree, open_at, bins = CapacityTree(window), [[] for _ in range(window + 1)], []
    for piece in short:
        room = tree.tightest(piece[2])
        if room < 0:
            bins.append([])
            at, room = len(bins) - 1, window
        else:
            at = open_at[room].pop()
            tree.add(room, -1)
        bins[at].append(piece)
        if room > piece[2]:
            open_at[room - piece[2]].append(at)
            tree.add(room - piece[2], 1)
    gaps = sorted((room, at) for room in range(1, window + 1) for at in open_at[room])
    loose = [bins[at] for _, at in gaps]  # fullest first
    full += [b for i, b in enumerate(bins) if i not in {at for _, at in gaps}]
    return full + _close(loose, window)


def _close(loose: list[list[tuple[int, int, int]]], window: int) -> list[list[tuple[int, int, int]]]:
    """Fill the fullest from the emptiest; split the last into powers of two."""
    out, i, j = [], 0, len(loose) - 1
    while i < j:
        room = window - sum(p[2] for p in loose[i])
        while room and i < j:
            d, start, n = loose[j].pop()
            take = min(n, room)
            loose[i].append((d, start, take))
            room -= take
            if take < n:
                loose[j].append((d, start + take, n - take))
            if not loose[j]:
                j -= 1
        if not room:
            out.append(loose[i])
            i += 1
    if i == j:
        rest = loose[i]
        fill = sum(p[2] for p in rest)
        for bit in reversed(range(fill.bit_length())):
            need, part = fill & (1 << bit), []
            while need:
                d, start, n = rest.pop()
                take = min(n, need)
                part.append((d, start, take))
                need -= take
                if take < n:
                    rest.append((d, start + take, n - take))
            if part:
                out.append(part)
    return out


def pack(
    docs: DataFrame,
    text: str = "text",
    key: str = "doc_id",
    window: int = WINDOW,
    tokenizer: str | None = None,
    end_id: int = END_ID,
    group_tokens: int = GROUP_TOKENS,
) -> DataFrame:
    """One row per piece: ``key``, start, length, ids_crc32, doc_tokens, sequence_id, offset, ids (the piece's token ids).

    A document is its text's ids (null: none) followed by ``end_id``; a special token written out in a text
    is that token. Every id is in exactly one piece and every sequence is gapless from offset 0, at most
    ``window`` long, and either full or a power of two. Repeated rows are documents of their own. Keys may
    be null. Empty input gives an empty result; other columns are ignored. ``window`` is a power of two. Texts of any
    length and runs of white space of any length are encoded; one text's ids are held at a time beside its group's.
    """
    path = tokenizer or default_tokenizer()
    src = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    names = ["key", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "ids"]

    def flush(keys: list, key_type: pa.DataType, ids: list[np.ndarray], base: int) -> tuple[list[pa.RecordBatch], int]:
        sequences, rows, parts = plan([len(x) for x in ids], window), [], []
        for s, pieces in enumerate(sequences):
            offset = 0
            for d, start, n in pieces:
                part = ids[d][start : start + n]
                rows.append((d, start, n, zlib.crc32(part), len(ids[d]), base + s, offset))
                parts.append(part)
                offset += n
        out, step = [], 1 << 10
        for at in range(0, len(rows), step):
            some = np.array(rows[at : at + step], np.int64)
            lengths = np.concatenate(([0], np.cumsum(some[:, 2]))).astype(np.int32)
            tokens = np.concatenate(parts[at : at + step]).view(np.int32)
            arrays = [pa.array([keys[d] for d in some[:, 0]], key_type), *(pa.array(some[:, k]) for k in range(1, 7))]
            arrays.append(pa.ListArray.from_arrays(pa.array(lengths), pa.array(tokens)))
            out.append(pa.RecordBatch.from_arrays(arrays, names))
        return out, base + len(sequences)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base = TaskContext.get().partitionId() << 33
        keys, ids, held, key_type = [], [], 0, None
        for b in batches:
            key_type = b.schema.field(0).type
            for k, t in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                own = np.append(encode(path, t.as_py() or ""), np.uint32(end_id)).astype("<u4")
                keys.append(k)
                ids.append(own)
                held += len(own)
                if held >= group_tokens:
                    out, base = flush(keys, key_type, ids, base)
                    yield from out
                    keys, ids, held = [], [], 0
        if ids:
            yield from flush(keys, key_type, ids, base)[0]

    kind = src.schema["key"].dataType.simpleString()
    rest = "start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, ids array<int>"
    return src.mapInArrow(run, f"key {kind}, {rest}").withColumnRenamed("key", key)


def op4_pack_best_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents")).drop("ids")
