"""Exact top-k inner-product search on a bit-sliced index.

The index stores, for each block of vectors and each attribute (dimension), the attribute's values as bit
slices: slice j holds bit j of every row's quantised value, packed 64 rows to a word. A query adds the
slices, shifted and signed by the digits of its own components, with carry-save adders that work on whole
bitmaps; the sums come out as slices too. Top rows are then selected from the most significant slice
downward. What quantisation dropped is bounded, so every row that could still belong to the top k lies within
a known distance of the k-th quantised sum; those boundary rows are scored exactly.

Blocks hold up to ``block_rows`` vectors and stay whole: the queries, a small share of the rows, come to every
block in chunks of up to ``chunk_queries`` and stream past it, and what leaves is k rows a query and block. Tables
too small to give every task such a block are cut into smaller ones, down to ``LEAST_ROWS``. A task holds one
block and one chunk at a time. Nothing is broadcast.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import materialize, partitions, table

K, SCALE, EVERY = 10, 1024, 100
BLOCK_ROWS, LEAST_ROWS, CHUNK_QUERIES, PRECISION = 1 << 16, 1 << 13, 32, 7


def quantised(embedding: Column, scale: int = SCALE) -> Column:
    """floor(scale * x) of every component, or null where the vector takes no part."""
    usable = F.forall(embedding, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    return F.when(embedding.isNotNull() & usable, F.transform(embedding, lambda x: F.floor(F.lit(float(scale)) * x.cast("double"))))


def signed_digits(q: int) -> list[tuple[int, bool]]:
    """Powers of two with signs (True: minus) that add up to q, no two adjacent."""
    out, p, minus = [], 0, q < 0
    q = abs(q)
    while q:
        if q & 1:
            down = q & 3 == 3
            out.append((p, down != minus))
            q += 1 if down else -1
        q >>= 1
        p += 1
    return out


def slice_attribute(values: np.ndarray, precision: int = PRECISION) -> tuple[int, int, np.ndarray]:
    """(least value, dropped low bits, slices) of one attribute; slices: words of 64 rows, least significant first."""
    least = int(values.min()) if len(values) else 0
    over = (values - least).astype(np.uint64)
    bits = int(over.max()).bit_length() if len(values) else 0
    low, words = max(0, bits - precision), -(-len(values) // 64)
    padded = np.zeros(words * 64, np.uint64)
    padded[: len(values)] = over >> np.uint64(low)
    slices = [np.packbits((padded >> np.uint64(j)).astype(np.uint8) & 1, bitorder="little").view(np.uint64) for j in range(bits - low)]
    return least, low, np.stack(slices) if slices else np.zeros((0, words), np.uint64)


def add_slices(by_weight: dict[int, np.ndarray], words: int) -> list[np.ndarray]:
    """Slices of the sum of bitmaps, each counted 2**weight times; carry-save until one is left for each weight."""
    out, p = [], 0
    by_weight = dict(by_weight)
    while by_weight:
        own = by_weight.pop(p, None)
        carries = []
        while own is not None and len(own) > 1:
            n = len(own) // 3
            if n:
                a, b, c = own[:n], own[n : 2 * n], own[2 * n : 3 * n]
                half = a ^ b
                carries.append((a & b) | (half & c))
                own = np.concatenate((half ^ c, own[3 * n :]))
            else:
                carries.append((own[:1] & own[1:]))
                own = own[:1] ^ own[1:]
        if carries:
            more = [by_weight[p + 1]] if p + 1 in by_weight else []
            by_weight[p + 1] = np.concatenate(more + carries)
        out.append(own[0] if own is not None else np.zeros(words, np.uint64))
        p += 1
    return out


def count(bitmap: np.ndarray) -> int:
    return int(np.bitwise_count(bitmap).sum())


def kth_sum(slices: list[np.ndarray], rows: np.ndarray, k: int) -> int:
    """The k-th largest sum among ``rows`` (a bitmap with at least k bits), from the top slice down."""
    sure, tied, value = 0, rows, 0
    for p in reversed(range(len(slices))):
        ones = tied & slices[p]
        n = count(ones)
        if sure + n >= k:
            tied, value = ones, value | (1 << p)
        else:
            sure, tied = sure + n, tied & ~slices[p]
    return value


def at_least(slices: list[np.ndarray], rows: np.ndarray, bound: int) -> np.ndarray:
    """Those of ``rows`` whose sum is ``bound`` or more."""
    if bound <= 0:
        return rows
    if bound.bit_length() > len(slices):
        return np.zeros_like(rows)
    above, tied = np.zeros_like(rows), rows
    for p in reversed(range(len(slices))):
        if bound >> p & 1:
            tied = tied & slices[p]
        else:
            above, tied = above | (tied & slices[p]), tied & ~slices[p]
    return above | tied


class Block:
    """The attributes of one block: exact values (attributes x rows), slices, and what quantisation dropped."""

    def __init__(self, values: np.ndarray, sliced: list[tuple[int, int, np.ndarray]]):
        self.values, self.n = values, values.shape[1]
        self.words = -(-self.n // 64)
        self.least = [s[0] for s in sliced]
        self.low = [s[1] for s in sliced]
        self.slices = np.concatenate([s[2] for s in sliced]) if sliced else np.zeros((0, self.words), np.uint64)
        self.start = [0, *accumulate(len(s[2]) for s in sliced)]
        self.rows = np.packbits(np.arange(self.words * 64) < self.n, bitorder="little").view(np.uint64)

    def top(self, query: np.ndarray, k: int, without: np.ndarray) -> np.ndarray:
        """Row numbers that hold the top k by score, and whatever ties with them, among rows not in ``without``."""
        gone = np.zeros(self.words * 64, bool)
        gone[without] = True
        rows = self.rows & ~np.packbits(gone, bitorder="little").view(np.uint64)
        if count(rows) > k:
            picks: dict[int, list[int]] = {}
            minus: dict[int, list[bool]] = {}
            slack = 0
            for d, q in enumerate(query.tolist()[: len(self.least)]):
                slack += abs(q) * ((1 << self.low[d]) - 1)
                for p, down in signed_digits(q):
                    for j in range(self.start[d], self.start[d + 1]):
                        w = p + self.low[d] + j - self.start[d]
                        picks.setdefault(w, []).append(j)
                        minus.setdefault(w, []).append(down)  # minus a bit is its complement less one
            base = min(picks, default=0)
            by_weight = {
                w - base: self.slices[at] ^ np.where(minus[w], np.uint64(2**64 - 1), np.uint64(0))[:, None] for w, at in picks.items()
            }
            sums = add_slices(by_weight, self.words)
            rows = at_least(sums, rows, kth_sum(sums, rows, k) - (slack >> base) - 1)
        return np.flatnonzero(np.unpackbits(rows.view(np.uint8), bitorder="little"))

    def score(self, query: np.ndarray, rows: np.ndarray) -> np.ndarray:
        n = min(len(query), len(self.values))
        return query[:n] @ self.values[:n, rows]


def build_index(vectors: DataFrame, block_rows: int | None = None, precision: int = PRECISION) -> DataFrame:
    """(block, attribute, ids, least, low, slices, exact) from (id long, v array<long>); attribute -1 has the ids."""
    n = vectors.count()
    even = min(BLOCK_ROWS, max(LEAST_ROWS, n // partitions(vectors.sparkSession)))  # a block a task, within bounds
    blocks = max(1, -(-n // (block_rows or even)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, parts = [], []
        for b in batches:
            ids.append(b.column(0))
            flat, offsets = b.column(1).values, b.column(1).offsets.to_numpy().astype(int)
            flat, lengths = flat.to_numpy(zero_copy_only=False), np.diff(offsets)
            part = np.zeros((len(lengths), int(lengths.max(initial=0))), np.int64)
            part[np.arange(part.shape[1]) < lengths[:, None]] = flat[offsets[0] : offsets[-1]]
            parts.append(part)
        if not ids:
            return
        width = max(p.shape[1] for p in parts)
        values = np.concatenate([np.pad(p, ((0, 0), (0, width - p.shape[1]))) for p in parts]).T
        block, ids = TaskContext.get().partitionId(), [x for a in ids for x in a.to_pylist()]
        names = ["block", "attribute", "ids", "least", "low", "slices", "exact"]
        kinds = [pa.int32(), pa.int32(), pa.list_(pa.int64()), pa.int64(), pa.int32(), pa.binary(), pa.binary()]

        def row(*cells) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([c], k) for c, k in zip(cells, kinds, strict=True)], names)

        yield row(block, -1, ids, None, None, None, None)
        for d in range(width):
            own = np.ascontiguousarray(values[d])
            least, low, slices = slice_attribute(own, precision)
            yield row(block, d, None, least, low, slices.tobytes(), own.tobytes())

    schema = "block int, attribute int, ids array<long>, least long, low int, slices binary, exact binary"
    return materialize(vectors.repartition(blocks).mapInArrow(run, schema), "bit_sliced_index")


def search(index: DataFrame, queries: DataFrame, k: int = K, chunk_queries: int = CHUNK_QUERIES) -> DataFrame:
    """(query_id, rank, vec_id, score) for (id long, v array<long>) queries: a query's own id is no candidate.

    Ranks are by score, then smaller vec_id (null last). A query given twice is answered twice. Vectors of
    other lengths count as padded with zeros. Queries with fewer than k candidates get all of them.
    """
    spark = index.sparkSession

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 33
        for b in batches:
            for at in range(0, b.num_rows, chunk_queries):
                part = b.slice(at, chunk_queries)
                cells = [range(number, number + part.num_rows), part.column(0).to_pylist(), part.column(1).to_pylist()]
                kinds = [pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.list_(pa.int64()))]
                yield pa.RecordBatch.from_arrays([pa.array([list(c)], k) for c, k in zip(cells, kinds, strict=True)], ["numbers", "asked", "vectors"])
                number += part.num_rows

    chunks = queries.select("id", "v").mapInArrow(pack, "numbers array<long>, asked array<long>, vectors array<array<long>>")
    chunks = materialize(chunks, "query_chunks")
    n_blocks = index.filter("attribute = -1").agg(F.coalesce(F.max("block"), F.lit(-1))).first()[0] + 1
    asked = chunks.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(max(n_blocks - 1, 0)))))
    columns = ["block", "attribute", "ids", "least", "low", "slices", "exact", "numbers", "asked", "vectors"]
    met = index.unionByName(asked, allowMissingColumns=True).select(*columns).repartition(partitions(spark), "block")
    met = met.sortWithinPartitions("block", F.col("attribute").asc_nulls_last())  # a block's slices, then its chunks

    def answer(block: Block, ids: np.ndarray, known: np.ndarray, row: dict) -> pa.RecordBatch:
        out: list[list] = [[], [], [], []]
        for number, own, v in zip(row["numbers"], row["asked"], row["vectors"], strict=True):
            vector = np.array(v, np.int64)
            rows = block.top(vector, k, np.flatnonzero((ids == own) & known) if own is not None else np.zeros(0, np.int64))
            scores = block.score(vector, rows)
            best = np.lexsort((ids[rows], -scores))[:k]
            out[0] += [number] * len(best)
            out[1] += [own] * len(best)
            out[2] += [int(ids[i]) if known[i] else None for i in rows[best]]
            out[3] += scores[best].tolist()
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in out], ["number", "query_id", "vec_id", "score"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, ids, known, sliced, values, block = None, None, None, [], [], None
        for b in batches:
            for row in b.to_pylist():
                if row["block"] != at:
                    at, ids, sliced, values, block = row["block"], None, [], [], None
                if row["attribute"] == -1:
                    known = np.array([i is not None for i in row["ids"]])
                    ids = np.array([np.iinfo(np.int64).max if i is None else i for i in row["ids"]], np.int64)
                elif row["attribute"] is not None:
                    sliced.append((row["least"], row["low"], np.frombuffer(row["slices"], np.uint64).reshape(-1, -(-len(ids) // 64))))
                    values.append(np.frombuffer(row["exact"], np.int64))
                elif ids is not None:
                    block = block or Block(np.array(values).reshape(-1, len(ids)), sliced)
                    yield answer(block, ids, known, row)

    found = met.mapInArrow(run, "number long, query_id long, vec_id long, score long")
    order = Window.partitionBy("number").orderBy(F.desc("score"), F.col("vec_id").asc_nulls_last())
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def op10_bit_sliced_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), quantised(F.col("embedding")).alias("v"))
    vectors = materialize(vectors.filter("v IS NOT NULL"), "vectors")
    return search(build_index(vectors), vectors.filter(F.col("id") % EVERY == 0))


ORACLE = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
), p AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
         CAST(list_sum(list_transform(list_zip(q.e, c.e), lambda z: z[1] * z[2])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id
)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM p QUALIFY rank <= 10
"""
