"""Product codes of vectors, with codebooks found by filtering Lloyd rounds.

A vector's components are scaled to integers and cut into equal consecutive
parts.  Every partition builds, for blocks of its rows, a kd-tree over each
part; nodes keep their bounding box, and the sum and number of their points.
The trees are written once to the shared folder.  In each round a tree is
walked from the root with the set of codebook entries that may be nearest to
some point of a node: an entry that is farther than another from the whole box
drops out, and where one is left the whole subtree is assigned by its stored
sum and count.  Only in leaves with several entries left are points compared.

All arithmetic is on 64-bit integers, so ties are exact and go to the lower
index.  What comes to the driver is one row for each part, entry and
component, whatever the number of vectors.

Defined cases: vectors that are null, hold null or non-finite components, have
no components or a number that is no multiple of the number of parts take no
part, nor do those whose length differs from that of the smallest id's vector
or whose components are so large (|x| above 524,288 with 64 components and a
scale of 256) that squared distances would pass 64 bits; with fewer vectors
than entries a codebook has one entry for each; repeated ids are coded row by
row, and start codebooks in order of their vectors; null ids come last there;
an empty table gives an empty one.  A label's total that passes 64 bits is
null.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .exchange import give_back, packed, unpacked
from .shared import stored

#: Rows whose parts share a tree, and the least number of points in a leaf.
BLOCK, LEAF = 1 << 14, 16


@dataclass
class Codebooks:
    """``entries[part, entry, position]`` as integers of components times ``scale``."""

    entries: np.ndarray
    scale: int

    def sha256(self) -> str:
        return hashlib.sha256(",".join(map(str, self.entries.ravel().tolist())).encode()).hexdigest()

    def vectors(self, codes: np.ndarray) -> np.ndarray:
        """What rows of codes stand for: the middle of each integer's interval."""
        picked = self.entries[np.arange(self.entries.shape[0])[None], codes]
        return ((picked + 0.5) / self.scale).reshape(len(codes), -1)


def starts(n: int, level: int) -> np.ndarray:
    """Where each of a level's nodes begins among n points in tree order."""
    return (np.arange(1 << level, dtype=np.int64) * n) >> level


@dataclass
class Tree:
    """A balanced kd-tree: node i of a level has the children 2 i and 2 i + 1 of the next."""

    order: np.ndarray  # the row of each point
    points: np.ndarray  # in tree order
    low: list[np.ndarray]  # by level: boxes and sums of the nodes
    high: list[np.ndarray]
    total: list[np.ndarray]

    @classmethod
    def over(cls, points: np.ndarray) -> Tree:
        n = len(points)
        depth = max(0, (n // LEAF).bit_length() - 1)
        order, low, high, total = np.arange(n), [], [], []
        for level in range(depth + 1):
            at = starts(n, level)
            low.append(np.minimum.reduceat(points, at))
            high.append(np.maximum.reduceat(points, at))
            total.append(np.add.reduceat(points, at))
            if level < depth:
                node = np.repeat(np.arange(len(at)), np.diff(at, append=n))
                widest = (high[-1] - low[-1]).argmax(axis=1)
                by = np.lexsort((points[np.arange(n), widest[node]], node))
                order, points = order[by], points[by]
        return cls(order, points, low, high, total)

    def assigned(self, entries: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        """(level, nodes, their entry) for whole subtrees, then (-1, points, their entry) for what is left in leaves."""
        n, index = len(self.points), np.arange(len(entries))
        nodes, alive = np.zeros(1, np.int64), np.ones((1, len(entries)), bool)
        for level, (low, high) in enumerate(zip(self.low, self.high, strict=True)):
            if level:
                nodes, alive = np.repeat(2 * nodes, 2), np.repeat(alive, 2, axis=0)
                nodes[1::2] += 1
            lo, hi = low[nodes][:, None], high[nodes][:, None]
            middle = ((2 * entries[None] - (lo + hi)) ** 2).sum(axis=2)
            middle[~alive] = np.iinfo(np.int64).max
            best = middle.argmin(axis=1)
            near = entries[best][:, None]
            # The corner of the box that is best for an entry against the one nearest to the middle.
            corner = np.where(entries[None] > near, hi, lo)
            own, other = ((entries[None] - corner) ** 2).sum(axis=2), ((near - corner) ** 2).sum(axis=2)
            alive &= ~((own > other) | ((own == other) & (index[None] > best[:, None])))
            one = alive.sum(axis=1) == 1
            if one.any():
                yield level, nodes[one], alive[one].argmax(axis=1)
            nodes, alive = nodes[~one], alive[~one]
            if not len(nodes):
                return
        at = starts(n, len(self.low) - 1)
        size = np.diff(at, append=n)[nodes]
        end = np.cumsum(size)
        points = np.repeat(at[nodes] - (end - size), size) + np.arange(end[-1])
        apart = np.zeros((len(points), len(entries)), np.int64)
        for d in range(entries.shape[1]):
            apart += (self.points[points, d][:, None] - entries[None, :, d]) ** 2
        apart[~np.repeat(alive, size, axis=0)] = np.iinfo(np.int64).max
        yield -1, points, apart.argmin(axis=1)

    def sums(self, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each entry the sum and number of its points."""
        total, count = np.zeros_like(entries), np.zeros(len(entries), np.int64)
        n = len(self.points)
        for level, what, entry in self.assigned(entries):
            value = self.points[what] if level < 0 else self.total[level][what]
            times = np.ones(len(what), np.int64) if level < 0 else np.diff(starts(n, level), append=n)[what]
            np.add.at(total, entry, value)
            np.add.at(count, entry, times)
        return total, count

    def codes(self, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each row its entry and squared distance."""
        n = len(self.points)
        found = np.zeros(n, np.int64)
        for level, what, entry in self.assigned(entries):
            if level < 0:
                found[what] = entry
                continue
            at = starts(n, level)
            size = np.diff(at, append=n)[what]
            end = np.cumsum(size)
            found[np.repeat(at[what] - (end - size), size) + np.arange(end[-1])] = np.repeat(entry, size)
        code, error = np.empty(n, np.int64), np.empty(n, np.int64)
        code[self.order] = found
        error[self.order] = ((self.points - entries[found]) ** 2).sum(axis=1)
        return code, error

    def arrays(self) -> list[np.ndarray]:
        out = [self.order.astype(np.uint32)]
        for a in (self.points, *self.low, *self.high, *self.total):
            least = int(a.min())
            span = int(a.max()) - least
            kind = next((k for k in (np.uint8, np.uint16, np.uint32) if span <= np.iinfo(k).max), np.int64)
            out += [np.array([least], np.int64), (a - least).ravel().astype(kind)]
        return out

    @classmethod
    def of(cls, arrays: list[np.ndarray], width: int) -> Tree:
        wide = [(b.astype(np.int64) + a[0]).reshape(-1, width) for a, b in zip(arrays[1::2], arrays[2::2], strict=True)]
        levels = (len(wide) - 1) // 3
        return cls(arrays[0].astype(np.int64), wide[0], *(wide[1 + i * levels : 1 + (i + 1) * levels] for i in range(3)))


class Forest:
    """Trees over the parts of all vectors, in blocks of rows, kept in the shared folder."""

    def __init__(self, table: DataFrame, parts: int, width: int, scale: int, first: np.ndarray):
        self.table, self.parts, self.width, self.scale, self.first = table, parts, width, scale, first

    @staticmethod
    def trees(raw: pa.Scalar, parts: int, width: int) -> Iterator[tuple[int, Tree]]:
        """Each part's tree of a block, one at a time."""
        for part, one in enumerate(raw.values):
            yield part, Tree.of(unpacked(one.as_buffer()), width // parts)


def integers(vectors: np.ndarray, scale: int) -> np.ndarray:
    return np.floor(vectors.astype(np.float64) * scale).astype(np.int64)


def planted(df: DataFrame, key: str, vector: str, label: str, parts: int = 16, entries: int = 64, scale: int = 256) -> Forest:
    """Build the trees; the codebooks to start from are those of the ``entries`` smallest ids."""
    v = F.col("vector")
    rows = df.select(F.col(key).alias("key"), v_of(df, vector).alias("vector"), F.col(label).alias("label"))
    bound = F.lit(float(1 << 30) / scale) / F.sqrt(F.size(v).cast("double"))
    # Written so that no condition on components is met by vectors that are null or empty.
    rows = rows.where(v.isNotNull()).where((F.size(v) > 0) & (F.size(v) % parts == 0)).where(F.forall(v, lambda x: x.isNotNull() & (F.abs(x) <= bound)))
    smallest = lambda: rows.orderBy(F.col("key").asc_nulls_last(), "vector").limit(entries).select("vector").collect()
    first = smallest()
    width = len(first[0]["vector"]) if first else parts
    rows = rows.where(F.size(v) == width)
    if any(len(r["vector"]) != width for r in first):
        first = smallest()
    begin = integers(np.array([r["vector"] for r in first], np.float64).reshape(-1, width), scale).reshape(-1, parts, width // parts).transpose(1, 0, 2)

    def grow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[pa.RecordBatch] = []

        def block() -> pa.RecordBatch:
            table = pa.Table.from_batches(waiting).combine_chunks()
            whole = integers(table["vector"].chunk(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, width), scale)
            trees = [packed(*Tree.over(np.ascontiguousarray(x)).arrays()) for x in np.split(whole, parts, axis=1)]
            one = lambda values: pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)
            return pa.RecordBatch.from_arrays([one(table["key"].chunk(0)), one(table["label"].chunk(0)), one(pa.array(trees, pa.binary()))], names=["keys", "labels", "trees"])

        size = 0
        for batch in batches:
            while len(batch):
                part = batch.slice(0, BLOCK - size)
                waiting.append(part)
                batch, size = batch.slice(len(part)), size + len(part)
                if size == BLOCK:
                    yield block()
                    waiting, size = [], 0
                    give_back()
        if size:
            yield block()

    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    table = stored(rows.mapInArrow(grow, f"keys array<{kinds['key']}>, labels array<{kinds['label']}>, trees array<binary>"), "trees")
    return Forest(table, parts, width, scale, begin)


def v_of(df: DataFrame, vector: str) -> F.Column:
    """The vector's components as doubles."""
    return F.col(vector).cast("array<double>")


def refined(forest: Forest, books: np.ndarray) -> np.ndarray:
    """One round: every entry becomes the floor of its parts' mean; unused entries stay."""
    shared = forest.table.sparkSession.sparkContext.broadcast(books)
    parts, width = forest.parts, forest.width

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, times = np.zeros_like(shared.value), np.zeros(shared.value.shape[:2], np.int64)
        for batch in batches:
            for raw in batch.column(0):
                for part, tree in Forest.trees(raw, parts, width):
                    a, b = tree.sums(shared.value[part])
                    total[part] += a
                    times[part] += b
            give_back()
        place = np.indices(total.shape).reshape(3, -1)
        yield pa.RecordBatch.from_arrays([*(pa.array(x.astype(np.int32)) for x in place), pa.array(total.ravel()), pa.array(np.repeat(times.ravel(), total.shape[2]))], names=["part", "entry", "position", "total", "times"])

    # Totals are kept as decimals, so that no sum of many large components passes 64 bits.
    found = forest.table.select("trees").mapInArrow(count, "part int, entry int, position int, total long, times long").where("times > 0")
    out = books.copy()
    for r in found.groupBy("part", "entry", "position").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"), F.sum("times").alias("times")).collect():
        out[r["part"], r["entry"], r["position"]] = int(r["total"]) // r["times"]
    return out


def fitted(forest: Forest, rounds: int = 2) -> Codebooks:
    books = forest.first
    for _ in range(rounds if books.size else 0):
        books = refined(forest, books)
    return Codebooks(books, forest.scale)


def coded(forest: Forest, books: Codebooks) -> DataFrame:
    """(key, label, code binary of one index for each part, error) for each vector."""
    shared = forest.table.sparkSession.sparkContext.broadcast(books)
    parts, width = forest.parts, forest.width
    kinds = {f.name: f.dataType.elementType.simpleString() for f in forest.table.schema}

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = np.uint8 if shared.value.entries.shape[1] <= 256 else np.dtype("<u2")
        for batch in batches:
            for keys, labels, raw in zip(*batch.columns, strict=True):
                n = len(keys.values)
                codes, error = np.zeros((n, parts), kind), np.zeros(n, np.int64)
                for part, tree in Forest.trees(raw, parts, width):
                    own, apart = tree.codes(shared.value.entries[part])
                    codes[:, part] = own
                    error += apart
                yield pa.RecordBatch.from_arrays([keys.values, labels.values, pa.array([row.tobytes() for row in codes], pa.binary()), pa.array(error)], names=["key", "label", "code", "error"])
            give_back()

    return forest.table.select("keys", "labels", "trees").mapInArrow(assign, f"key {kinds['keys']}, label {kinds['labels']}, code binary, error long")


def label_errors(rows: DataFrame) -> DataFrame:
    """``rows`` (key, label, code, error) with the error summed over all rows of an equal label, nulls together.

    Labels of a thousandth of all rows or more, a thousand at most, are
    broadcast; the others are joined by a shuffle, in which none is large.
    """
    rows = stored(rows, "codes")
    sums = stored(rows.groupBy(F.col("label").alias("of")).agg(F.try_sum("error").alias("label_error"), F.count("*").alias("n")), "label-errors")
    many = F.col("n") * 1000 >= rows.count()
    same = F.col("label").eqNullSafe(F.col("of"))
    hot = F.broadcast(sums.where(many))
    names = [*rows.columns, "label_error"]
    return rows.join(hot, same).select(names).unionByName(rows.join(hot, same, "left_anti").join(sums.where(~many), same).select(names))
