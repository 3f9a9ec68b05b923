"""Removal of repeated passages: every byte covered by a string of ``length`` bytes that starts anywhere else too.

1. Equal texts become one row with a count, in a table bucketed by text id, so no text is shuffled again.
2. Each window of ``length`` bytes is routed by the least hash among the ``GRAM``-byte strings in it, which
   equal windows share. A maximal run of windows with one such value is a segment. Values whose string occurs
   once in the whole corpus cannot hold a repeat and end there.
3. Segments of the other values are cut out, equal ones become one with a weight, and whole groups of a value
   fill shards of about ``SHARD_BYTES``. Each shard's suffix array is built by induced sorting; adjacent
   suffixes whose permuted common prefix reaches ``length``, or that stand for several copies, are repeats.
4. A group larger than a shard (a passage in a large share of all documents, with as many different
   surroundings) is dealt over chunks. Each chunk's suffix array tells its distinct windows; chunks exchange
   one digest for each in buckets and learn which occur elsewhere. No group is ever in one task. A bucket is
   split by chunk into slices, which are merged first: a window that stands in every chunk adds 17 bytes a
   chunk to slices of about ``SLICE_CHUNKS`` chunks, then 17 bytes a slice to its bucket.
5. Repeated intervals go back to their texts, and per-text results to the documents.

Matches are exact: hashes only route. Step 4 takes equal 128-bit BLAKE2 digests for equal windows, and equal
SHA-256 for equal texts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_table
from .common import materialize, new_folder, partitions, table
from .suffix_array import permuted_lcp, suffix_array

SPAN = 1 << 20  # bytes of text hashed at a time
LENGTH, GRAM, SHARD_BYTES, CHUNK_BYTES, BUCKET_WINDOWS, SLICE_CHUNKS = 200, 40, 1 << 20, 1 << 20, 1 << 18, 1 << 10
#: An odd number and its inverse modulo 2**64, and two odd multipliers that mix bits.
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)
MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))

_powers: dict[int, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64."""
    if len(_powers.get(base, ())) < n:
        m = max(1 << 20, 1 << n.bit_length())
        x = np.full(m, base, np.uint64)
        x[0] = 1
        _powers[base] = np.cumprod(x, dtype=np.uint64)
    return _powers[base][:n]


def gram_hashes(data: np.ndarray, gram: int) -> np.ndarray:
    """A mixed hash of each ``gram``-byte string, alike wherever it stands."""
    n = len(data) - gram + 1
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _power(INVERSE, len(data)), out=sums[1:])
    h = (sums[gram:] - sums[:-gram]) * _power(BASE, n)
    h = (h ^ (h >> np.uint64(30))) * MIX[0]
    h = (h ^ (h >> np.uint64(27))) * MIX[1]
    return h ^ (h >> np.uint64(31))


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    n = len(x) - width + 1
    padded = np.full(-(-len(x) // width) * width, np.uint64(2**64 - 1))
    padded[: len(x)] = x
    blocks = padded.reshape(-1, width)
    left = np.minimum.accumulate(blocks, axis=1).ravel()
    right = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(right[:n], left[width - 1 : width - 1 + n])


def spans(texts: list[bytes], length: int, span: int) -> Iterator[tuple[int, int, bytes]]:
    """(text number, place, bytes) of pieces with up to ``span`` windows, so that every window lies in one of them."""
    for i, t in enumerate(texts):
        if len(t) < span + length:
            yield i, 0, t
        else:
            for at in range(0, len(t) - length + 1, span):
                yield i, at, t[at : at + span + length - 1]


def segments(texts: list[bytes], length: int, gram: int, span: int = SPAN) -> Iterator[tuple[np.ndarray, ...]]:
    """(text number, routing value, first window, last window, hashes, place of the text in them) of all segments.

    About ``span`` bytes of text at a time: short texts together, long ones piece by piece. A segment that crosses two pieces is two.
    """
    held: list[tuple[int, int, bytes]] = []

    def flush() -> Iterator[tuple[np.ndarray, ...]]:
        lengths = np.array([len(t) for _, _, t in held], np.int64)
        windows = np.maximum(lengths - length + 1, 0)
        if windows.any():
            data = np.frombuffer(b"".join(t for _, _, t in held), np.uint8)
            hashes = gram_hashes(data, gram)
            least = sliding_min(hashes, length - gram + 1)
            of = np.repeat(np.arange(len(lengths)), windows)
            first = np.cumsum(windows) - windows
            within = np.arange(len(of)) - first[of]
            place = np.cumsum(lengths) - lengths
            value = least[place[of] + within]
            starts = np.flatnonzero(np.concatenate(([True], (value[1:] != value[:-1]) | (of[1:] != of[:-1]))))
            ends = np.append(starts[1:], len(of)) - 1
            number, at = (np.array([h[k] for h in held], np.int64)[of[starts]] for k in (0, 1))
            yield number, value[starts], within[starts] + at, within[ends] + at, hashes, place[of[starts]] - at

    size = 0
    for piece in spans(texts, length, span):
        if held and size + len(piece[2]) > span:
            yield from flush()
            held, size = [], 0
        held.append(piece)
        size += len(piece[2])
    if held:
        yield from flush()


def times_inside(value: np.ndarray, first: np.ndarray, last: np.ndarray, hashes: np.ndarray, place: np.ndarray, grams: int) -> np.ndarray:
    """How often a segment's value stands in the segment; twice or more where the text repeats within it."""
    sizes = last - first + grams
    starts = np.cumsum(sizes) - sizes
    at = np.arange(int(sizes.sum())) + np.repeat(place + first - starts, sizes)
    return np.add.reduceat(hashes[at] == np.repeat(value, sizes), starts, dtype=np.int64)


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def window_classes(parts: list[bytes], length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """By suffix array: (classes, starts, sizes) of the parts joined by one byte each.

    classes has a number for each place where a whole window starts, the same for equal windows, else -1.
    """
    sizes = np.array([len(p) for p in parts], np.int64)
    starts = np.cumsum(sizes + 1) - sizes - 1
    text = np.ones(int((sizes + 1).sum()) + 1, np.int16)  # 1 parts segments, 0 ends all
    raw = np.frombuffer(b"\0".join(parts) + b"\0", np.uint8)
    text[:-1] = raw.astype(np.int16) + 2
    text[starts + sizes], text[-1] = 1, 0
    sa = suffix_array(text, 258)
    alike = permuted_lcp(text, sa)[sa] >= length  # with the suffix before it
    of = np.searchsorted(starts, sa, side="right") - 1
    whole = (sa + length <= starts[of] + sizes[of]) & (sa < len(text) - 1)
    classes = np.full(len(text), -1, np.int64)
    classes[sa[whole]] = np.cumsum(~alike)[whole]
    return classes, starts, sizes


def class_weights(classes: np.ndarray, starts: np.ndarray, weights: list[int]) -> np.ndarray:
    """The weights of each class' windows, summed."""
    at = np.flatnonzero(classes >= 0)
    return np.bincount(classes[at], weights=np.array(weights, np.float64)[np.searchsorted(starts, at, side="right") - 1])


def repeated_windows(parts: list[bytes], weights: list[int], length: int) -> list[np.ndarray]:
    """For each distinct segment, which of its windows occur twice or more among all, weights counted: boolean arrays."""
    classes, starts, sizes = window_classes(parts, length)
    weight = class_weights(classes, starts, weights)
    repeated = np.zeros(len(classes), bool)
    at = classes >= 0
    repeated[at] = weight[classes[at]] >= 2
    return [repeated[s : s + max(n - length + 1, 0)] for s, n in zip(starts.tolist(), sizes.tolist(), strict=True)]


def _runs(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last index of each run of True."""
    edge = np.diff(np.concatenate(([0], flags.astype(np.int8), [0])))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1) - 1


def _spans(rows: list[tuple[bytes, int, np.ndarray]]) -> pa.RecordBatch:
    """Runs of repeated windows of (segment, number of the first window, flags)."""
    found = [(sid, *(base + x for x in _runs(flags))) for sid, base, flags in rows if flags.any()]
    arrays = [pa.array([f[0] for f in found], pa.binary()), pa.array([f[1] for f in found], pa.list_(pa.int64())), pa.array([f[2] for f in found], pa.list_(pa.int64()))]
    return pa.RecordBatch.from_arrays(arrays, ["sid", "first", "last"])


SPANS = "sid binary, first array<long>, last array<long>"


def _sharded(distinct: DataFrame, length: int, shard_bytes: int) -> DataFrame:
    """Spans of distinct segments (h, sid, weight, part) whose groups fit a shard: whole groups of h share suffix arrays."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, held, group, size, value = [], 0, [], 0, None

        def solved(rows: list) -> Iterator[pa.RecordBatch]:
            if rows:
                flags = repeated_windows([r[2] for r in rows], [r[1] for r in rows], length)
                yield _spans([(r[0], 0, f) for r, f in zip(rows, flags, strict=True)])

        for b in batches:
            for h, sid, weight, part in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if h != value:
                    if held + size > shard_bytes:
                        yield from solved(shard)
                        shard, held = [], 0
                    shard, held, group, size, value = shard + group, held + size, [], 0, h
                group.append((sid, weight, part))
                size += len(part)
        if held + size > shard_bytes:
            yield from solved(shard)
            shard = []
        yield from solved(shard + group)

    rows = distinct.select("h", "sid", "weight", "part").repartition(partitions(distinct.sparkSession), "h")
    return rows.sortWithinPartitions("h", "sid").mapInArrow(run, SPANS)


def _digests(parts: list[bytes], length: int) -> np.ndarray:
    """16-byte digests of all windows of the parts, in order."""
    out = bytearray()
    for p in parts:
        for i in range(len(p) - length + 1):
            out += hashlib.blake2b(p[i : i + length], digest_size=16).digest()
    return np.frombuffer(bytes(out), "V16")


def _dealt(large: DataFrame, length: int, chunk_bytes: int, bucket_windows: int, slice_chunks: int) -> DataFrame:
    """Spans of segments of groups beyond a shard, by exchanging the digests of windows between chunks."""

    def chunked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, n, rows, size = TaskContext.get().partitionId() << 33, 0, [], 0

        def row() -> pa.RecordBatch:
            cells = [[first + n], *([[r[i] for r in rows]] for i in range(4))]
            kinds = [pa.int64(), pa.list_(pa.binary()), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.binary())]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cells, kinds, strict=True)], ["chunk", "sids", "bases", "weights", "parts"])

        for b in batches:
            for sid, weight, part in zip(*(c.to_pylist() for c in b.columns), strict=True):
                for at in range(0, max(len(part) - length + 1, 1), chunk_bytes):  # a long part is cut, each window staying whole
                    rows.append((sid, at, weight, part[at : at + chunk_bytes + length - 1]))
                    size += len(rows[-1][3])
                    if size >= chunk_bytes:
                        yield row()
                        n, rows, size = n + 1, [], 0
        if rows:
            yield row()

    chunks = large.select("sid", "weight", "part").repartition(partitions(large.sparkSession))
    chunks = materialize(chunks.mapInArrow(chunked, "chunk long, sids array<binary>, bases array<long>, weights array<long>, parts array<binary>"), "chunks")
    total, n = chunks.agg(F.sum(F.aggregate("parts", F.lit(0).cast("long"), lambda a, p: a + F.octet_length(p))), F.count("*")).first()
    buckets, slices = 1 + (total or 0) // bucket_windows, 1 + n // slice_chunks

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for chunk, weights, parts in zip(*(b.column(i).to_pylist() for i in (0, 3, 4)), strict=True):
                classes, starts, _ = window_classes(parts, length)
                each, first = np.unique(classes, return_index=True)
                each, first = each[each >= 0], first[each >= 0]
                if not len(each):
                    continue
                joined = b"\0".join(parts)
                unique = _digests([joined[i : i + length] for i in first.tolist()], length)
                sums = np.minimum(class_weights(classes, starts, weights)[each], 2).astype(np.int8)
                bucket = unique.view(np.uint64)[::2] % np.uint64(buckets)
                for k in np.unique(bucket):
                    at = bucket == k
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([int(k)], pa.int64()), pa.array([chunk], pa.int64()), pa.array([unique[at].tobytes()]), pa.array([sums[at].tobytes()])],
                        ["bucket", "chunk", "digests", "sums"],
                    )

    def counted(rows: pa.Table) -> tuple[list[np.ndarray], np.ndarray]:
        """Each row's digests, and for all of them whether they stand for two windows or more."""
        each = [np.frombuffer(d, "V16") for d in rows.column("digests").to_pylist()]
        sums = np.concatenate([np.frombuffer(x, np.int8) for x in rows.column("sums").to_pylist()])
        _, inverse = np.unique(np.concatenate(each), return_inverse=True)
        return each, np.bincount(inverse, weights=sums)[inverse] >= 2

    def merge(rows: pa.Table) -> pa.Table:
        each, twice = counted(rows)
        unique, first = np.unique(np.concatenate(each), return_index=True)
        sums = np.where(twice[first], 2, 1).astype(np.int8)
        return pa.table([rows.column("bucket")[:1], rows.column("slice")[:1], pa.array([unique.tobytes()]), pa.array([sums.tobytes()])], ["bucket", "slice", "digests", "sums"])

    def answer(rows: pa.Table) -> pa.Table:
        each, twice = counted(rows)
        told = [own[flag].tobytes() for own, flag in zip(each, np.split(twice, list(accumulate(map(len, each)))[:-1]), strict=True)]
        return pa.table([rows.column("bucket"), rows.column("slice"), pa.array(told, pa.binary())], ["bucket", "slice", "repeated"])

    def tell(rows: pa.Table, told: pa.Table) -> pa.Table:
        repeated = np.frombuffer(b"".join(told.column("repeated").to_pylist()), "V16")
        each = [np.frombuffer(d, "V16") for d in rows.column("digests").to_pylist()]
        return pa.table([rows.column("chunk"), pa.array([own[np.isin(own, repeated)].tobytes() for own in each], pa.binary())], ["chunk", "repeated"])

    def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for sids, bases, parts, repeated in zip(*(c.to_pylist() for c in b.columns), strict=True):
                flags = np.isin(_digests(parts, length), np.frombuffer(b"".join(repeated), "V16"))
                cuts = list(accumulate(max(len(p) - length + 1, 0) for p in parts))[:-1]
                yield _spans(list(zip(sids, bases, np.split(flags, cuts), strict=True)))

    asked = chunks.mapInArrow(ask, "bucket long, chunk long, digests binary, sums binary")
    asked = materialize(asked.withColumn("slice", F.pmod(F.xxhash64("chunk"), F.lit(slices))), "digests")
    merged = asked.groupBy("bucket", "slice").applyInArrow(merge, "bucket long, slice long, digests binary, sums binary")
    told = merged.groupBy("bucket").applyInArrow(answer, "bucket long, slice long, repeated binary")
    told = asked.groupBy("bucket", "slice").cogroup(told.groupBy("bucket", "slice")).applyInArrow(tell, "chunk long, repeated binary")
    told = told.groupBy("chunk").agg(F.collect_list("repeated").alias("repeated"))  # no more than a chunk's own windows
    return chunks.select("chunk", "sids", "bases", "parts").join(told, "chunk").select("sids", "bases", "parts", "repeated").mapInArrow(settle, SPANS)


def _table(df: DataFrame, name: str, key: str) -> DataFrame:
    """A table bucketed by ``key`` in the shared folder, so that joins on it leave its rows where they are."""
    spark, path, name = df.sparkSession, new_folder(df.sparkSession, name), scratch_table(name)
    n = partitions(spark)
    df.repartition(n, key).write.option("compression", "zstd").option("path", path).bucketBy(n, key).saveAsTable(name)
    return spark.table(name)


def remove_repeats(
    docs: DataFrame,
    text: str = "text",
    key: str = "doc_id",
    length: int = LENGTH,
    gram: int = GRAM,
    shard_bytes: int = SHARD_BYTES,
    chunk_bytes: int = CHUNK_BYTES,
    bucket_windows: int = BUCKET_WINDOWS,
    slice_chunks: int = SLICE_CHUNKS,
    span_bytes: int = SPAN,
) -> DataFrame:
    """One row per input row: ``key``, n_bytes, n_removed, n_spans, kept_sha256, kept (the remaining bytes).

    Works on UTF-8 bytes; null is empty. Texts shorter than ``length`` keep everything; of equal longer texts
    everything goes, the first included, and rows that repeat key and text are copies like any other.
    Empty input gives an empty result; other columns are ignored. ``gram`` is less than ``length``.
    """
    spark = docs.sparkSession
    body = F.coalesce(F.col(text), F.lit("")).cast("binary")
    sha = F.unhex(F.sha2(body, 256))
    rows = docs.select(F.col(key).alias("_key"), sha.alias("sha"), body.alias("body"))
    unique = rows.groupBy("sha").agg(F.count("*").alias("n"), F.first("body").alias("body"))
    tid = F.conv(F.substring(F.hex("sha"), 1, 15), 16, 10).cast("long")  # may coincide: spans carry the whole digest
    unique = _table(unique.select(tid.alias("tid"), "sha", "n", "body"), "repeats_texts", "tid")

    def values(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            weights = b.column(0).to_numpy()
            for of, value, first, last, hashes, place in segments(b.column(1).to_pylist(), length, gram, span_bytes):
                inside = times_inside(value, first, last, hashes, place, length - gram + 1)
                each, inverse = np.unique(value, return_inverse=True)
                sums = np.bincount(inverse, weights=np.minimum(weights[of] * inside, 2)).astype(np.int64)
                yield pa.RecordBatch.from_arrays([_signed(each), pa.array(sums)], ["h", "c"])

    def occurrences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids = b.column(0).to_numpy()
            for of, value, *_ in segments(b.column(1).to_pylist(), length, gram, span_bytes):
                yield pa.RecordBatch.from_arrays([_signed(value), pa.array(ids[of])], ["h", "tid"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            tids, shas, counts = (b.column(i).to_pylist() for i in range(3))
            texts, wanted = b.column(3).to_pylist(), b.column(4)
            for of, value, first, last, *_ in segments(texts, length, gram, span_bytes):
                keep = np.zeros(len(of), bool)
                for d in np.unique(of):
                    at = slice(*np.searchsorted(of, (d, d + 1)))
                    own = wanted[int(d)].values.to_numpy(zero_copy_only=False).view(np.uint64)
                    keep[at] = np.isin(value[at], own)
                of, value, first, last = of[keep], value[keep], first[keep], last[keep]
                parts = [texts[d][i : j + length] for d, i, j in zip(of.tolist(), first.tolist(), last.tolist(), strict=True)]
                sids = [hashlib.blake2b(p, digest_size=16).digest() for p in parts]
                yield pa.RecordBatch.from_arrays(
                    [
                        _signed(value), pa.array(sids, pa.binary()), pa.array([tids[d] for d in of], pa.int64()), pa.array([shas[d] for d in of], pa.binary()),
                        pa.array(first), pa.array([counts[d] for d in of], pa.int64()), pa.array(last - first + length), pa.array(parts, pa.binary()),
                    ],
                    ["h", "sid", "tid", "sha", "at", "n", "size", "part"],
                )

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["sha", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"]
        for b in batches:
            out: list[tuple] = []
            for sha, body, spans in zip(*(c.to_pylist() for c in b.columns), strict=True):
                edge = np.zeros(len(body) + 1, np.int64)
                for s in spans or ():
                    if s["sha"] == sha:
                        edge[s["first"]] += 1
                        edge[s["last"] + length] -= 1
                gone = np.cumsum(edge[:-1]) > 0
                kept = np.frombuffer(body, np.uint8)[~gone].tobytes()
                out.append((sha, len(body), int(gone.sum()), len(_runs(gone)[0]), hashlib.sha256(kept).hexdigest(), kept))
            kinds = [pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
            columns = list(zip(*out, strict=True)) or [[]] * 6
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    counts = unique.select("n", "body").mapInArrow(values, "h long, c long").groupBy("h").agg(F.sum("c").alias("c"))
    several = materialize(counts.filter("c > 1").select("h"), "routing_values")
    found = unique.select("tid", "body").mapInArrow(occurrences, "h long, tid long").join(several, "h")
    wanted = found.groupBy("tid").agg(F.collect_list("h").alias("hs"))
    with_values = unique.join(wanted, "tid").select("tid", "sha", "n", "body", "hs")
    cuts = materialize(with_values.mapInArrow(cut, "h long, sid binary, tid long, sha binary, at long, n long, size long, part binary"), "segments")
    distinct = cuts.groupBy("h", "sid").agg(F.sum("n").alias("weight"), F.first("part").alias("part"))
    sizes = cuts.groupBy("h", "sid").agg(F.max("size").alias("size")).groupBy("h").agg(F.sum("size").alias("size"))
    large = sizes.filter(F.col("size") > shard_bytes)
    large = materialize(large.select("h"), "large_groups")
    if large.isEmpty():
        spans = materialize(_sharded(distinct, length, shard_bytes), "spans")
    else:
        spans = _sharded(distinct.join(large, "h", "left_anti"), length, shard_bytes)
        spans = materialize(spans.unionByName(_dealt(distinct.join(large, "h", "left_semi"), length, chunk_bytes, bucket_windows, slice_chunks)), "spans")
    placed = cuts.select("sid", "tid", "sha", "at").join(spans, "sid")
    placed = placed.select("tid", "sha", "at", F.explode(F.arrays_zip("first", "last")).alias("s"))
    span = F.struct("sha", (F.col("at") + F.col("s.first")).alias("first"), (F.col("at") + F.col("s.last")).alias("last"))
    placed = placed.groupBy("tid").agg(F.collect_list(span).alias("spans"))
    done = unique.join(placed, "tid", "left").select("sha", "body", "spans")
    done = done.mapInArrow(finish, "sha binary, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")
    return rows.select("_key", "sha").join(done, "sha").drop("sha").withColumnRenamed("_key", key)


def op1_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents")).drop("kept")
