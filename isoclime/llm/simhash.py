"""SimHash near-duplicates through a segment-popcount embedding and a grid range-join.

A 64-bit fingerprint is embedded as 32 bit counts of 2-bit segments. The Manhattan distance of two
embeddings never exceeds the Hamming distance of the fingerprints, so fingerprints within ``max_bits`` lie
within ``max_bits`` of each other in the embedding, and within half of that in one of its two halves. The
grid join therefore looks at each half alone: every fingerprint enters the cells within max_bits / 4 grid
steps of its own, so that two that are close enough meet in a cell, and cell mates are verified exactly on
all 64 bits.

Only distinct fingerprints are joined, so copies of a text never meet each other. A cell yields a spanning
forest of its links, never all pairs, and the links go to the component search. Where a cell holds more than
``crowd`` fingerprints the grid gets finer: its members are dealt by the same rule once more, over the two
quarters that the cell's half leaves out. Fingerprints within ``max_bits`` lie within half of that in one of
these quarters too, so none that are close enough part; 34 rows a member, and no pairs of blocks.

``width`` puts several 64-bit fingerprints side by side, for near-duplicates that differ in more bits than
one can spare: two documents are candidates if any half of any of them is close in the grid (and, where
crowded, a quarter of its other half), and are linked if all bits together differ in at most ``max_bits``.
Candidates are then a matter of chance, more likely the closer two texts are (measured in the README); what is
linked is still verified on all bits.

``jaccard_components`` settles near copies by the exact Jaccard similarity of their shingle sets. Wide
fingerprints and MinHash bands only say who is looked at: two sets of similarity J share none of ``BANDS``
bands of ``BAND_ROWS`` minima with probability (1 - J**BAND_ROWS)**BANDS, 2.6e-5 at 0.8 and less above. All
sets of one component of candidates then meet, and a link is what reaches the threshold.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialize, partitions, sliced, table
from .components import components

SHINGLE_WORDS, MAX_BITS, CROWD = 4, 4, 1 << 14
BANDS, BAND_ROWS, BLOCK_HASHES, FILTER_BITS = 20, 4, 1 << 19, 1 << 26
SEGMENTS = np.uint64(0x5555555555555555)


def fingerprint(text: str | None, words_per_shingle: int = SHINGLE_WORDS) -> int:
    """64-bit SimHash over word shingles, repeats counted; no word: 0."""
    return int(wide_fingerprint(text, words_per_shingle, 1)[0])


def shingle_hashes(text: str | None, words_per_shingle: int) -> np.ndarray:
    """64-bit hashes of the word shingles, repeats kept; no word: none."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    k = min(words_per_shingle, len(words))
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = np.concatenate(([0], ends[:-1]))
    digest = xxhash.xxh64_intdigest
    spans = zip(starts[: len(words) - k + 1].tolist(), (ends[k - 1 :] - 1).tolist(), strict=True)
    return np.array([digest(joined[i:j], 42) for i, j in spans], np.uint64)


def wide_fingerprint(text: str | None, words_per_shingle: int, width: int) -> np.ndarray:
    """``width`` SimHashes; the first from the shingles' hashes, each other from those remixed."""
    return _wide(shingle_hashes(text, words_per_shingle), width)


def _wide(hashes: np.ndarray, width: int) -> np.ndarray:
    if not len(hashes):
        return np.zeros(width, np.uint64)
    out = []
    for _ in range(width):
        ones = np.zeros(64, np.int64)
        for at in range(0, len(hashes), 1 << 14):
            bits = np.unpackbits(hashes[at : at + (1 << 14)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            ones += bits.sum(axis=0, dtype=np.int32)
        out.append(np.packbits(2 * ones > len(hashes), bitorder="little").view(np.uint64)[0])
        hashes = (hashes ^ (hashes >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
        hashes = (hashes ^ (hashes >> np.uint64(29))) * np.uint64(0xC4CEB9FE1A85EC53)
    return np.array(out, np.uint64)


def names_of(width: int) -> list[str]:
    return ["fp", *(f"fp{i}" for i in range(1, width))]


def fingerprints(docs: DataFrame, text: str = "text", key: str = "doc_id", words_per_shingle: int = SHINGLE_WORDS, width: int = 1) -> DataFrame:
    """(key, fp, fp1, ...): the fingerprints as signed longs, one row per input row."""
    src = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    names = names_of(width)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in sliced(batches):
            fps = np.array([wide_fingerprint(t, words_per_shingle, width) for t in b.column(1).to_pylist()], np.uint64).reshape(-1, width)
            yield pa.RecordBatch.from_arrays([b.column(0), *_columns(fps)], ["key", *names])

    return src.mapInArrow(run, f"key {src.schema['key'].dataType.simpleString()}, " + ", ".join(f"{n} long" for n in names))


def _columns(fps: np.ndarray) -> list[pa.Array]:
    return [pa.array(np.ascontiguousarray(fps[:, w]).view(np.int64)) for w in range(fps.shape[1])]


def _array(b: pa.RecordBatch, first: int, width: int) -> np.ndarray:
    return np.stack([b.column(first + w).to_numpy(zero_copy_only=False).view(np.uint64) for w in range(width)], axis=1)


def _near(a: np.ndarray, b: np.ndarray, max_bits: int) -> np.ndarray:
    return np.bitwise_count(a ^ b).sum(axis=-1, dtype=np.int32) <= max_bits


def _cells(fps: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """(cell, row of fps): for both halves of each fingerprint, the cells within ``radius`` (0 or 1) steps of its own."""
    rows, cells, owners = np.arange(len(fps)), [], []
    for half in range(2 * fps.shape[1]):
        word = fps[:, half // 2]
        counts = (word & SEGMENTS) + ((word >> np.uint64(1)) & SEGMENTS)
        code = (counts >> np.uint64(32 * (half % 2))) & np.uint64(0xFFFFFFFF)
        tag = np.uint64(half << 32)
        cells.append(code | tag)
        owners.append(rows)
        for s in range(16 if radius else 0):
            unit = np.uint64(1 << (2 * s))
            field = (code >> np.uint64(2 * s)) & np.uint64(3)
            for keep, moved in ((field < 2, code + unit), (field > 0, code - unit)):
                cells.append(moved[keep] | tag)
                owners.append(rows[keep])
    return np.concatenate(cells), np.concatenate(owners)


def _quarters(cells: np.ndarray, fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(finer cell, row): for each row of a cell, the cells within a step in both quarters of the half its cell leaves out."""
    rows, half = np.arange(len(fps)), (cells >> np.uint64(32)).astype(np.int64)
    word = fps[rows, half // 2]
    counts = (word & SEGMENTS) + ((word >> np.uint64(1)) & SEGMENTS)
    other = counts >> (32 * (1 - half % 2)).astype(np.uint64)
    finer, owners = [], []
    for quarter in range(2):
        code = (other >> np.uint64(16 * quarter)) & np.uint64(0xFFFF)
        tag = (cells << np.uint64(17)) | np.uint64(quarter << 16)
        finer.append(code | tag)
        owners.append(rows)
        for s in range(8):
            unit, field = np.uint64(1 << (2 * s)), (code >> np.uint64(2 * s)) & np.uint64(3)
            for keep, moved in ((field < 2, code + unit), (field > 0, code - unit)):
                finer.append((moved | tag)[keep])
                owners.append(rows[keep])
    return np.concatenate(finer), np.concatenate(owners)


def _forest(fps: np.ndarray, max_bits: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """A spanning forest of the links inside one cell."""
    out, rest = [], fps
    while len(rest) > 1:
        queue, rest = [rest[0]], rest[1:]
        while queue and len(rest):
            at = queue.pop()
            near = _near(rest, at, max_bits)
            if near.any():
                found = rest[near]
                out.append((np.broadcast_to(at, found.shape), found))
                queue.extend(found)
                rest = rest[~near]
    return out


def _links(cells: np.ndarray, fps: np.ndarray, max_bits: int, small: int = 8) -> tuple[np.ndarray, np.ndarray]:
    """Verified links of whole runs of equal cells (rows sorted by cell)."""
    starts = np.flatnonzero(np.concatenate(([True], cells[1:] != cells[:-1])))
    sizes = np.diff(np.concatenate((starts, [len(cells)])))
    of = np.repeat(sizes, sizes)
    pairs = []
    at = np.flatnonzero((of > 1) & (of <= small))
    for step in range(1, small):
        at = at[at + step < len(cells)]
        at = at[cells[at] == cells[at + step]]
        if not len(at):
            break
        near = _near(fps[at], fps[at + step], max_bits)
        pairs.append((fps[at[near]], fps[at[near] + step]))
    for s, n in zip(starts[sizes > small], sizes[sizes > small], strict=True):
        pairs += _forest(fps[s : s + n], max_bits)
    if not pairs:
        return fps[:0], fps[:0]
    return np.concatenate([p[0] for p in pairs]), np.concatenate([p[1] for p in pairs])


def _packed(a: np.ndarray, b: np.ndarray, crowded: np.ndarray, names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([*_columns(a), *_columns(b), pa.array(crowded)], names)


def fingerprint_links(fps: DataFrame, max_bits: int = MAX_BITS, crowd: int = CROWD, width: int = 1) -> DataFrame:
    """Links between distinct fingerprints (columns fp, fp1, ...): a_fp, a_fp1, ..., b_fp, b_fp1, ...

    For ``width`` 1 they connect whatever lies within ``max_bits`` (0, 2 or 4) bits.
    """
    if width == 1 and max_bits not in (0, 2, 4):
        raise ValueError("max_bits must be 0, 2 or 4 for one fingerprint: the grid's cells are built for these")
    spark, radius, own = fps.sparkSession, int(max_bits > 0), names_of(width)
    ends = [f"{side}_{n}" for side in "ab" for n in own]
    longs = lambda names: ", ".join(f"{n} long" for n in names)

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = _array(b, 0, width)
            for at in range(0, len(rows), 1 << 12):
                cell, of = _cells(rows[at : at + (1 << 12)], radius)
                yield pa.RecordBatch.from_arrays([pa.array(cell.view(np.int64)), *_columns(rows[at + of])], ["cell", *own])

    def finer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cells, rows = b.column(0).to_numpy(zero_copy_only=False).view(np.uint64), _array(b, 1, width)
            for at in range(0, len(rows), 1 << 12):
                cell, of = _quarters(cells[at : at + (1 << 12)], rows[at : at + (1 << 12)])
                yield pa.RecordBatch.from_arrays([pa.array(cell.view(np.int64)), *_columns(rows[at + of])], ["cell", *own])

    def meet(limit: int | None):
        """Links of the cells of up to ``limit`` members (rows sorted by cell), and the members of the others."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            def crowded(cells: np.ndarray, rows: np.ndarray) -> pa.RecordBatch:
                return _packed(rows, rows, cells.view(np.int64), [*ends, "crowded"])

            def settled(cells: np.ndarray, rows: np.ndarray) -> Iterator[pa.RecordBatch]:
                if not len(cells):
                    return
                starts = np.flatnonzero(np.concatenate(([True], cells[1:] != cells[:-1])))
                sizes = np.diff(np.concatenate((starts, [len(cells)])))
                many = np.repeat(sizes > (limit or len(cells)), sizes)
                if many.any():
                    yield crowded(cells[many], rows[many])
                if not many.all():
                    a, b = _links(cells[~many], rows[~many], max_bits)
                    yield _packed(a, b, np.full(len(a), -1), [*ends, "crowded"])

            cells, rows, over = np.zeros(0, np.uint64), np.zeros((0, width), np.uint64), None  # over: a cell found to be crowded
            for b in batches:
                cells = np.concatenate((cells, b.column(0).to_numpy(zero_copy_only=False).view(np.uint64)))
                rows = np.concatenate((rows, _array(b, 1, width)))
                if over is not None:
                    n = int(np.count_nonzero(cells == over))
                    if n:
                        yield crowded(cells[:n], rows[:n])
                    cells, rows = cells[n:], rows[n:]
                if not len(cells):
                    continue
                last = int(np.argmax(cells == cells[-1]))
                yield from settled(cells[:last], rows[:last])
                over, cells, rows = None, cells[last:], rows[last:]
                if limit and len(cells) > limit:
                    yield crowded(cells, rows)
                    over, cells, rows = cells[-1], cells[:0], rows[:0]
            yield from settled(cells, rows)

        return run

    def settle(cells: DataFrame, limit: int | None) -> DataFrame:
        cells = cells.repartition(partitions(spark), "cell").sortWithinPartitions("cell")
        return cells.mapInArrow(meet(limit), f"{longs([*ends, 'crowded'])}").distinct()

    cells = fps.select(*own).mapInArrow(spread, f"cell long, {longs(own)}")
    met = materialize(settle(cells, crowd), "cell_links")
    links, many = met.filter("crowded < 0").select(*ends), met.filter("crowded >= 0")
    if many.isEmpty():
        return links
    members = many.select(F.col("crowded").alias("cell"), *(F.col(f"a_{n}").alias(n) for n in own))
    members = members.repartition(partitions(spark), *own)  # a crowded cell's members leave its task
    return links.unionByName(settle(members.mapInArrow(finer, f"cell long, {longs(own)}"), None).select(*ends))


def simhash_components(
    docs: DataFrame,
    text: str = "text",
    key: str = "doc_id",
    words_per_shingle: int = SHINGLE_WORDS,
    max_bits: int = MAX_BITS,
    crowd: int = CROWD,
    width: int = 1,
) -> DataFrame:
    """One row per input row: ``key``, fingerprint (16 hex digits for each 64 bits), component_id (least key reachable).

    Null and wordless texts have fingerprint zero and link like any other; texts shorter than a shingle
    hash as a whole. Repeated rows repeat in the result. Null keys are carried along and never chosen as
    the least unless a component has no other. Empty input gives an empty result.
    """
    names = names_of(width)
    own = materialize(fingerprints(docs, text, key, words_per_shingle, width), "fingerprints")
    per_fp = own.groupBy(*names).agg(F.min("key").alias("least"))
    links = fingerprint_links(per_fp, max_bits, crowd, width)
    ends = [F.col(f"{side}_fp") if width == 1 else F.struct(*(F.col(f"{side}_{n}").alias(n) for n in names)) for side in "ab"]
    node = F.col("fp") if width == 1 else F.struct(*names)
    roots = components(links.select(ends[0].alias("a"), ends[1].alias("b")))
    per_fp = per_fp.withColumn("node", node).join(roots, "node", "left")
    per_fp = materialize(per_fp.select(*names, "least", F.coalesce("root", "node").alias("root")), "roots")
    ids = materialize(per_fp.groupBy("root").agg(F.min("least").alias("component_id")), "component_ids")
    labels = materialize(per_fp.join(ids, "root").select(*names, "component_id"), "labels")
    return own.join(labels, names).select(
        F.col("key").alias(key), F.concat(*(F.lpad(F.lower(F.hex(n)), 16, "0") for n in names)).alias("fingerprint"), "component_id"
    )


_MINIMA = np.random.default_rng(80).integers(1 << 63, size=(3, BANDS * BAND_ROWS), dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _set_of(hashes: np.ndarray) -> tuple[bytes, np.ndarray]:
    """The digest of a shingle set, and its hashes, sorted; no word: the set of the hash zero."""
    own = np.unique(hashes) if len(hashes) else np.zeros(1, np.uint64)
    return xxhash.xxh3_128_digest(own.tobytes()), own


def _bands(own: np.ndarray) -> np.ndarray:
    """One 64-bit name for each band of minima of a shingle set."""
    least = np.full(BANDS * BAND_ROWS, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(own), 1 << 10):
        x = (own[at : at + (1 << 10), None] ^ _MINIMA[0]) * _MINIMA[1]
        x ^= x >> np.uint64(32)
        least = np.minimum(least, (x * _MINIMA[2]).min(axis=0))
    rows = least.reshape(BANDS, BAND_ROWS)
    return np.array([xxhash.xxh3_64_intdigest(r.tobytes(), i) for i, r in enumerate(rows)], np.uint64).view(np.int64)


def _jaccard_forest(sets: list[np.ndarray], threshold: float) -> list[tuple[int, int]]:
    """A spanning forest of the pairs of sets (sorted, not empty) whose Jaccard similarity is ``threshold`` or more."""
    out, every = [], np.array([len(s) for s in sets])
    names, ids = np.unique(np.concatenate(sets), return_inverse=True)
    own = np.split(ids, np.cumsum(every)[:-1])
    mark, rest = np.zeros(len(names), bool), np.arange(len(sets))
    while len(rest) > 1:
        queue, rest = [int(rest[0])], rest[1:]
        flat = np.concatenate([own[i] for i in rest])
        while queue and len(rest):
            at = queue.pop()
            mark[own[at]] = True
            sizes = every[rest]
            common = np.add.reduceat(mark[flat], np.cumsum(sizes) - sizes, dtype=np.int64)
            mark[own[at]] = False
            near = common / (every[at] + sizes - common) >= threshold
            if near.any():
                found = rest[near].tolist()
                out += [(at, i) for i in found]
                queue += found
                flat, rest = flat[np.repeat(~near, sizes)], rest[~near]
    return out


def _star(members: DataFrame, group: str, label: str) -> DataFrame:
    """(a, b): every ``node`` of a group of two or more, and the least of the group."""
    least = members.groupBy(group).agg(F.min("node").alias("b"), F.count("*").alias("n")).filter("n > 1").drop("n")
    return members.join(materialize(least, label), group).select(F.col("node").alias("a"), "b").filter("a <> b")


def _candidates(own: DataFrame, max_bits: int, crowd: int, width: int) -> DataFrame:
    """(a, b): links between nodes that connect whatever shares a band or is linked by fingerprints."""
    names = names_of(width)
    bands = own.select("node", F.explode("bands").alias("band"))
    fp = lambda side: F.struct(*(F.col(f"{side}{n}").alias(n) for n in names))
    members = own.select("node", fp("").alias("fps"))
    per_fp = materialize(members.groupBy("fps").agg(F.min("node").alias("node")), "fingerprint_nodes")
    links = fingerprint_links(per_fp.select("fps.*"), max_bits, crowd, width)
    links = links.select(fp("a_").alias("x"), fp("b_").alias("y")).filter("x <> y")
    for end, name in (("x", "a"), ("y", "b")):
        links = links.join(per_fp.select(F.col("fps").alias(end), F.col("node").alias(name)), end)
    return _star(bands, "band", "bands").unionByName(_star(members, "fps", "same_fingerprints")).unionByName(links.select("a", "b"))


def jaccard_components(
    docs: DataFrame,
    text: str = "text",
    key: str = "doc_id",
    words_per_shingle: int = SHINGLE_WORDS,
    threshold: float = 0.8,
    max_bits: int = MAX_BITS,
    width: int = 1,
    crowd: int = CROWD,
    block: int = BLOCK_HASHES,
) -> DataFrame:
    """One row per input row: ``key``, component_id (least key reachable by links of Jaccard ``threshold`` or more).

    Only distinct sets are compared; wordless texts are one set. Components of candidates whose sets hold
    more than ``block`` hashes are cut into blocks that meet pairwise in separate groups. Sets are made
    again from the text for candidates alone. Keys are not null.
    """
    spark, names = docs.sparkSession, names_of(width)
    src = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    kind = src.schema["key"].dataType.simpleString()

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in sliced(batches):
            nodes, sizes, bands, fps = [], [], [], []
            for t in b.column(1).to_pylist():
                hashes = shingle_hashes(t, words_per_shingle)
                node, own = _set_of(hashes)
                nodes.append(node)
                sizes.append(len(own))
                bands.append(_bands(own))
                fps.append(_wide(hashes, width))
            fps = np.array(fps, np.uint64).reshape(-1, width)
            columns = [b.column(0), pa.array(nodes, pa.binary()), pa.array(sizes, pa.int64()), pa.array(bands, pa.list_(pa.int64())), *_columns(fps)]
            yield pa.RecordBatch.from_arrays(columns, ["key", "node", "size", "bands", *names])

    longs = ", ".join(f"{n} long" for n in names)
    rows = materialize(src.mapInArrow(describe, f"key {kind}, node binary, size long, bands array<long>, {longs}"), "shingle_sets")
    own = rows.groupBy("node").agg(F.min("key").alias("least"), *(F.first(c).alias(c) for c in ("size", "bands", *names)))
    own = materialize(own, "nodes")
    roots = components(_candidates(own, max_bits, crowd, width))
    chosen = materialize(own.select("node", "least", "size").join(roots, "node"), "candidates")

    spot = lambda c: F.pmod(F.xxhash64(c), F.lit(FILTER_BITS))
    at = chosen.select(spot("least").alias("at")).filter("at > 0").groupBy(F.expr("bitmap_bucket_number(at)").alias("bucket"))
    bits = np.zeros(FILTER_BITS // 8, np.uint8)
    for r in at.agg(F.expr("bitmap_construct_agg(bitmap_bit_position(at))").alias("bits")).collect():  # at most 8 MB
        first = (r.bucket - 1) * 4096
        part = np.frombuffer(bytes(r.bits), np.uint8)
        bits[first : first + len(part)] = part[: len(bits) - first]
    shared = spark.sparkContext.broadcast(bits)

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in sliced(batches):
            # bitmap buckets count from 1: bucket k + 1 holds k * 32768 + 1 .. (k + 1) * 32768; spot 0 is in none and always let through
            spots = b.column(0).to_numpy(zero_copy_only=False) - 1
            held = (spots < 0) | (shared.value[spots >> 3] >> (spots & 7) & 1 > 0)
            got = [_set_of(shingle_hashes(t, words_per_shingle)) for t in b.column(1).filter(pa.array(held)).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array([g[0] for g in got], pa.binary()), pa.array([g[1].tobytes() for g in got], pa.binary())], ["node", "hashes"])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def linked(nodes: list[bytes], members: list[bytes]) -> pa.RecordBatch:
            pairs = _jaccard_forest([np.frombuffer(m, np.uint64) for m in members], threshold)
            return pa.RecordBatch.from_arrays([pa.array([nodes[p[i]] for p in pairs], pa.binary()) for i in (0, 1)], ["a", "b"])

        group, nodes, members = None, [], []
        for b in batches:
            for g, node, some in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if g != group:
                    if len(nodes) > 1:
                        yield linked(nodes, members)
                    group, nodes, members = g, [], []
                nodes.append(node)
                members.append(some)
        if len(nodes) > 1:
            yield linked(nodes, members)

    blocks = F.ceil(F.col("weight") / block)
    weights = chosen.groupBy("root").agg(F.sum("size").alias("weight")).select("root", blocks.alias("blocks"))
    placed = chosen.select("node", "root").join(weights, "root").withColumn("i", F.pmod(F.xxhash64("node"), F.col("blocks")))
    placed = placed.withColumn("j", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))).filter("blocks = 1 OR i <> j")
    placed = placed.select("node", F.xxhash64("root", F.least("i", "j"), F.greatest("i", "j")).alias("group"))  # a shared hash only adds comparisons
    found = src.select(spot("key").alias("spot"), "text").mapInArrow(sets, "node binary, hashes binary")
    met = found.join(placed, "node").select("group", "node", "hashes").repartition(partitions(spark), "group").sortWithinPartitions("group")
    links = components(met.mapInArrow(compare, "a binary, b binary"))
    labels = own.select("node", "least").join(links, "node", "left").withColumn("root", F.coalesce("root", "node"))
    labels = materialize(labels.select("node", "least", "root"), "labels")
    ids = materialize(labels.groupBy("root").agg(F.min("least").alias("component_id")), "component_ids")
    labels = labels.join(ids, "root").select("node", "component_id")
    return rows.select("key", "node").join(labels, "node").select(F.col("key").alias(key), "component_id")


def op3_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_components(table(spark, sf_dir, "documents"))
