"""Nearest vectors by a block matrix join of int8 tiles.

Query and candidate vectors are normalised, scaled to int8 and cut into
blocks; only codes, scales, measured errors and digests travel.  Every pair of
blocks is one tile: an integer matrix product gives all cosines of the tile
with a proven error bound, and a pair survives if its upper bound reaches the
k-th best lower bound that its query has seen so far.  Survivors meet the
original vectors once, are computed again in double precision, and merged by
bounded heaps.

Error bound: a unit vector x is a*q + e with integer q and scale a, so for two
of them |x.y - ab(q.r)| <= |e_x| + |e_y| + |e_x||e_y|, each |e| being measured.

Of equal vectors (by a digest of 128 bits) a query keeps the k smallest ids in
each task, so a vector that a third of all rows share costs no more than
another.

Defined cases: vectors that are null, empty, zero or that hold null or
non-finite components take no part; vectors are compared with those of their
own length; equal cosines go to the smaller id; repeated ids count as separate
candidates but never answer the query of the same id, which is asked once with
the smallest of its vectors; with fewer candidates than k all are returned; an
empty table gives an empty table.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import buckets_for, stored

_BLOCK = "block long, width int, ids binary, marks binary, codes binary, scales binary, errors binary"
_NAMES = ["block", "width", "ids", "marks", "codes", "scales", "errors"]
_TYPES = [pa.int64(), pa.int32(), *[pa.binary()] * 5]


def usable(df: DataFrame, key: str, vector: str) -> DataFrame:
    """(id, v): vectors that can be compared, as arrays of doubles."""
    v = F.col("v")
    held = df.select(F.col(key).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v")).where(F.col("id").isNotNull() & (F.size(v) > 0))
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return held.where(finite).where(F.exists(v, lambda x: x != 0))


class Block:
    """Vectors of one length as int8 codes: ids, digests of the originals, codes, scales and error norms."""

    def __init__(self, ids: np.ndarray, marks: np.ndarray, codes: np.ndarray, scales: np.ndarray, errors: np.ndarray):
        self.ids, self.marks, self.codes, self.scales, self.errors = ids, marks, codes, scales, errors

    @classmethod
    def coded(cls, ids: np.ndarray, vectors: np.ndarray) -> Block:
        # The largest component is divided out first, so that no square over- or underflows.
        unit = vectors / np.abs(vectors).max(axis=1, keepdims=True)
        unit = unit / np.sqrt((unit * unit).sum(axis=1, keepdims=True))
        scale = np.abs(unit).max(axis=1) / 127
        codes = np.rint(unit / scale[:, None])
        error = unit - codes * scale[:, None]
        marks = np.frombuffer(b"".join(xxhash.xxh3_128_digest(v.tobytes()) for v in np.ascontiguousarray(vectors + 0.0)), "V16")
        return cls(ids, marks, codes.astype(np.int8), scale, np.sqrt((error * error).sum(axis=1)) + 1e-12)

    def row(self) -> tuple:
        return (int(self.ids[0]), self.codes.shape[1], self.ids.tobytes(), self.marks.tobytes(), self.codes.tobytes(), self.scales.tobytes(), self.errors.tobytes())

    @classmethod
    def of(cls, width: int, ids: bytes, marks: bytes, codes: bytes, scales: bytes, errors: bytes) -> Block:
        return cls(np.frombuffer(ids, np.int64), np.frombuffer(marks, "V16"), np.frombuffer(codes, np.int8).reshape(-1, width), np.frombuffer(scales), np.frombuffer(errors))


def table_of(blocks: list[Block]) -> pa.Table:
    rows = [b.row() for b in blocks]
    return pa.table([pa.array([r[i] for r in rows], t) for i, t in enumerate(_TYPES)], names=_NAMES)


def cut(ids: np.ndarray, lists: pa.ListArray, size: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """At most ``size`` ids and their vectors, all of one length."""
    at = lists.offsets.to_numpy()
    flat = lists.values.to_numpy(zero_copy_only=False)
    lengths = np.diff(at)
    for width in np.unique(lengths):
        own = np.flatnonzero(lengths == width)
        for i in range(0, len(own), size):
            some = own[i : i + size]
            yield ids[some], flat[at[some][:, None] + np.arange(width)]


def blocks(rows: DataFrame, size: int) -> DataFrame:
    """Rows (id, v) as blocks of about ``size`` vectors of one length."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[Block]] = {}

        def whole(width: int) -> pa.RecordBatch:
            parts = held.pop(width)
            merged = Block(*(np.concatenate([getattr(p, f) for p in parts]) for f in ("ids", "marks", "codes", "scales", "errors")))
            return table_of([merged]).combine_chunks().to_batches()[0]

        for batch in batches:
            for ids, vectors in cut(batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64), batch.column(1), size):
                width = vectors.shape[1]
                held.setdefault(width, []).append(Block.coded(ids, vectors))
                if sum(len(b.ids) for b in held[width]) >= size:
                    yield whole(width)
        for width in list(held):
            yield whole(width)

    return rows.mapInArrow(run, _BLOCK)


def products(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Integer products of codes: sums over 1,024 components stay below 2**24, so float32, where the machine multiplies fastest, is exact."""
    out = np.zeros((len(x), len(y)))
    for a in range(0, x.shape[1], 1024):
        out += x[:, a : a + 1024].astype(np.float32) @ y[:, a : a + 1024].astype(np.float32).T
    return out


class Survivors:
    """For one query the candidates that may still be among its k nearest."""

    def __init__(self, k: int):
        self.k, self.floor = k, -np.inf
        self.ids, self.marks, self.low, self.high = np.zeros(0, np.int64), np.zeros(0, "V16"), np.zeros(0), np.zeros(0)

    def add(self, ids: np.ndarray, marks: np.ndarray, low: np.ndarray, high: np.ndarray) -> None:
        self.ids, self.marks, self.low, self.high = (np.concatenate(x) for x in ((self.ids, ids), (self.marks, marks), (self.low, low), (self.high, high)))
        if len(self.low) > self.k:
            self.floor = np.partition(self.low, len(self.low) - self.k)[len(self.low) - self.k]
        keep = self.high >= self.floor
        if keep.sum() > 4 * self.k:
            # Of equal vectors the k smallest ids come first anyway.
            _, group = np.unique(self.marks, return_inverse=True)
            order = np.lexsort((self.ids, group))
            g = group[order]
            begin = np.flatnonzero(np.append(True, g[1:] != g[:-1]))
            place = np.empty(len(g), np.int64)
            place[order] = np.arange(len(g)) - np.repeat(begin, np.diff(np.append(begin, len(g))))
            keep &= place < self.k
        self.ids, self.marks, self.low, self.high = (x[keep] for x in (self.ids, self.marks, self.low, self.high))


def tile(q: Block, c: Block, found: dict[int, Survivors], k: int) -> None:
    """Add the candidates of one tile to each query's survivors."""
    product = products(q.codes, c.codes)
    product *= q.scales[:, None]
    product *= c.scales[None, :]
    for i, own in enumerate(q.ids.tolist()):
        held = found.setdefault(own, Survivors(k))
        bound = q.errors[i] + c.errors + q.errors[i] * c.errors + 1e-9
        high = product[i] + bound
        near = np.flatnonzero((high >= held.floor) & (c.ids != own))
        low = product[i][near] - bound[near]
        if len(near) > k:
            floor = np.partition(low, len(low) - k)[len(low) - k]
            some = high[near] >= floor
            near, low = near[some], low[some]
        if len(near):
            held.add(c.ids[near], c.marks[near], low, high[near])


_SURVIVOR = "query_id long, vec_id long, mark binary, low double, high double"


def nearest(df: DataFrame, key: str, vector: str, every: int, k: int, query_block: int = 1024, candidate_block: int = 8192) -> DataFrame:
    """The k nearest candidates of each query (rows whose id is divisible by ``every``): query_id, rank, vec_id, score."""
    spark = df.sparkSession
    rows = usable(df, key, vector)
    queries = stored(rows.where(F.col("id") % every == 0).groupBy("id").agg(F.min("v").alias("v")), "queries")
    slots = buckets_for(queries.count(), query_block, least=1)
    # Query blocks are dealt by a hash of the id; each candidate block meets each slot once.
    dealt = queries.withColumn("slot", F.pmod(F.xxhash64("id"), F.lit(slots)).cast("int"))

    def gather(key_row: tuple, table: pa.Table) -> pa.Table:
        out = table_of([Block.coded(ids, vectors) for ids, vectors in cut(table["id"].to_numpy(), table["v"].combine_chunks(), query_block)])
        return pa.table([pa.array([key_row[0].as_py()] * len(out), pa.int32()), *out.columns[1:]], names=["slot", "width", *(f"q_{n}" for n in _NAMES[2:])])

    query_blocks = dealt.groupBy("slot").applyInArrow(gather, "slot int, width int, q_ids binary, q_marks binary, q_codes binary, q_scales binary, q_errors binary")
    spread = max(1, spark.sparkContext.defaultParallelism)
    candidates = blocks(rows, candidate_block).withColumn("slot", F.explode(F.sequence(F.lit(0), F.lit(slots - 1))))
    tiles = candidates.join(query_blocks, ["slot", "width"]).repartition(max(spread, slots), "slot", "block")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, Survivors] = {}
        for batch in batches:
            for r in batch.to_pylist():
                tile(*(Block.of(r["width"], *(r[p + n] for n in _NAMES[2:])) for p in ("q_", "")), found, k)
        names = list(found)
        for i in range(0, len(names), 4096):
            some = names[i : i + 4096]
            held = [found[n] for n in some]
            marks = [m.tobytes() for s in held for m in s.marks]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(np.array(some, np.int64), [len(s.ids) for s in held])), pa.array(np.concatenate([s.ids for s in held])), pa.array(marks, pa.binary()), pa.array(np.concatenate([s.low for s in held])), pa.array(np.concatenate([s.high for s in held]))],
                names=["query_id", "vec_id", "mark", "low", "high"],
            )

    survivors = stored(tiles.select("width", *(p + n for p in ("q_", "") for n in _NAMES[2:])).mapInArrow(run, _SURVIVOR), "survivors")
    # The k-th best lower bound over all tasks; each gave its k best, so arrays are short.
    floors = survivors.groupBy("query_id").agg(F.sort_array(F.collect_list("low"), asc=False).alias("low")).select("query_id", F.coalesce(F.get("low", F.lit(k - 1)), F.lit(float("-inf"))).alias("floor"))
    pairs = survivors.join(floors, "query_id").where("high >= floor").select("query_id", "vec_id").distinct()
    exact = pairs.join(rows.withColumnRenamed("id", "vec_id"), "vec_id").join(queries.select(F.col("id").alias("query_id"), F.col("v").alias("q")), "query_id").where(F.size("v") == F.size("q"))

    def rescore(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # One heap for each query that this task sees; of k entries, worst first.
        heaps: dict[int, list] = {}
        for batch in batches:
            for q, v, score in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), cosines(batch.column(2), batch.column(3)).tolist(), strict=True):
                heap = heaps.setdefault(q, [])
                (heapq.heappush if len(heap) < k else heapq.heappushpop)(heap, (score, -v))
        flat = [(q, -v, s) for q, heap in heaps.items() for s, v in heap]
        for i in range(0, len(flat), 50_000):
            some = flat[i : i + 50_000]
            yield pa.RecordBatch.from_arrays([pa.array([x[j] for x in some], t) for j, t in enumerate((pa.int64(), pa.int64(), pa.float64()))], names=["query_id", "vec_id", "score"])

    won = exact.select("query_id", "vec_id", "v", "q").mapInArrow(rescore, "query_id long, vec_id long, score double")
    best = won.groupBy("query_id").agg(F.slice(F.sort_array(F.collect_list(F.struct((-F.col("score")).alias("s"), F.col("vec_id").alias("v")))), 1, k).alias("best"))
    return best.select("query_id", F.posexplode("best").alias("p", "b")).select("query_id", (F.col("p") + 1).alias("rank"), F.col("b.v").alias("vec_id"), (-F.col("b.s")).alias("score"))


def cosines(left: pa.ListArray, right: pa.ListArray) -> np.ndarray:
    """Cosines of pairs of vectors of equal length, in double precision."""
    out = np.zeros(len(left))
    flat = [(x.values.to_numpy(zero_copy_only=False), x.offsets.to_numpy()) for x in (left, right)]
    width = np.diff(flat[0][1])
    for n in np.unique(width):
        own = np.flatnonzero(width == n)
        x, y = (values[at[own][:, None] + np.arange(n)] for values, at in flat)
        x, y = (v / np.abs(v).max(axis=1, keepdims=True) for v in (x, y))
        x, y = (v / np.sqrt((v * v).sum(axis=1, keepdims=True)) for v in (x, y))
        out[own] = (x * y).sum(axis=1)
    return out
