"""Asking questions about keys between chunks of documents and buckets of keys.

Documents are dealt once to chunks of a few megabytes of text, kept in a table
that is bucketed by chunk, so that later steps meet a chunk's documents without
a shuffle.  A chunk asks about each of its distinct keys once (so a key of a
third of all rows costs a bucket one entry for each chunk), many keys to a row;
buckets answer in the same order.
"""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import discard, noted, shared_folder
from .units import text_bytes

ASK = "bucket int, chunk long, keys binary, extra binary"
REPLY = "chunk long, level int, bucket int, answer binary"
#: Bits of a row's name: the input partition, the chunk within it, the row within that.
PARTITION_BITS, RUN_BITS, ROW_BITS = 23, 20, 20
#: A worker that holds more than this hands freed memory back to the system.
KEPT_BYTES = 64 << 20



def give_back() -> None:
    """Return freed memory to the system, if this worker holds much; idle workers otherwise keep the peak of their largest group."""
    try:
        with open("/proc/self/statm") as f:
            held = int(f.read().split()[1]) * 4096
        if held > KEPT_BYTES:
            pa.default_memory_pool().release_unused()
            ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # another system; nothing depends on it
        pass


def frugal(work: Callable[..., pa.Table], cogrouped: bool) -> Callable[..., pa.Table]:
    """``work`` on (key, table) or (key, table, table), giving memory back after each group."""

    def one(key: tuple, x: pa.Table) -> pa.Table:
        out = work(key, x)
        del x
        give_back()
        return out

    def two(key: tuple, x: pa.Table, y: pa.Table) -> pa.Table:
        out = work(key, x, y)
        del x, y
        give_back()
        return out

    return two if cogrouped else one


class Chunks:
    """A table (chunk, doc_id, text, further columns c_0, c_1, ...) bucketed by chunk, and the number of chunks."""

    def __init__(self, table: DataFrame, name: str, place: str, n: int):
        self.table, self.name, self.place, self.n = table, name, place, n

    def drop(self) -> None:
        """Drop the table, once nothing reads it any more."""
        discard(self.table.sparkSession, "table", self.name)
        discard(self.table.sparkSession, "folder", self.place)


def chunked(df: DataFrame, key: str, text: str, carry: list[str] | None = None, chunk_bytes: int = 8 << 20) -> Chunks:
    """Deal the rows to chunks.

    A chunk is a run of documents of one input partition with about
    ``chunk_bytes`` of text (a longer document is a chunk of its own) and at
    most 2**20 rows, so making the table moves nothing between executors.
    """
    spark = df.sparkSession
    rows = df.select(F.col(key).alias("doc_id"), F.col(text).alias("text"), *(F.col(c).alias(f"c_{i}") for i, c in enumerate(carry or [])))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, run, held, rows_held = TaskContext.get().partitionId(), 0, 0, 0
        if part >> PARTITION_BITS:
            raise ValueError(f"more than {1 << PARTITION_BITS} input partitions: raise spark.sql.files.maxPartitionBytes")
        for batch in batches:
            _, docs = text_bytes(batch.column(1))
            a = 0
            while a < len(batch):
                b = max(a + 1, int(np.searchsorted(docs, docs[a] + chunk_bytes - held, side="right")) - 1)
                b = min(b, len(batch), a + (1 << ROW_BITS) - rows_held)
                chunk = (part << RUN_BITS) | run
                # Half a megabyte at a time reaches the writer.
                step = a
                while step < b:
                    end = min(b, max(step + 1, int(np.searchsorted(docs, docs[step] + (1 << 19), side="right")) - 1))
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(end - step, chunk, np.int64)), *(c.slice(step, end - step) for c in batch.columns)], names=["chunk", *batch.schema.names])
                    step = end
                held, rows_held = held + int(docs[b] - docs[a]), rows_held + b - a
                if held >= chunk_bytes or b < len(batch) or rows_held >> ROW_BITS:
                    run, held, rows_held = run + 1, 0, 0
                    if run >> RUN_BITS:
                        raise ValueError(f"more than {1 << RUN_BITS} chunks in an input partition: lower spark.sql.files.maxPartitionBytes")
                a = b
            del batch, docs
            give_back()

    schema = ", ".join(["chunk long", *(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema)])
    buckets = min(max(24, 2 * rows.rdd.getNumPartitions()), int(spark.conf.get("spark.sql.sources.bucketing.maxBuckets", "100000")))
    name = f"chunks_{uuid.uuid4().hex}"
    # Only bucketed tables keep their partitioning, but the table's files lie in the shared folder, not in the warehouse.
    place = f"{shared_folder(spark)}/{name}"
    noted("table", name)
    noted("folder", place)
    # Files are read whole, a bucket at a time, so small row groups cost nothing and keep the writer small.
    rows.mapInArrow(deal, schema).write.format("parquet").option("path", place).option("compression", "zstd").option("parquet.block.size", 8 << 20).bucketBy(buckets, "chunk").saveAsTable(name)
    table = spark.table(name)
    return Chunks(table, name, place, table.agg(F.count_distinct("chunk").alias("n")).first()["n"])


def in_order(table: pa.Table) -> pa.Table:
    """A chunk's rows in an order that does not depend on the shuffle."""
    return table.sort_by([("doc_id", "ascending"), ("text", "ascending")]).combine_chunks()


def bucket_of(keys: np.ndarray, buckets: int) -> np.ndarray:
    """Sorted keys have sorted buckets."""
    return ((keys >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int32)


def rows_of(chunk: int, places: np.ndarray) -> np.ndarray:
    """The names of a chunk's rows at these places (in order)."""
    return (np.int64(chunk) << np.int64(ROW_BITS)) | places.astype(np.int64)


def asks(chunk: int, keys: np.ndarray, extra: np.ndarray, buckets: int) -> pa.Table:
    """One row for each bucket in which the sorted distinct keys fall; keys of two words go by the first."""
    at = bucket_of(keys if keys.ndim == 1 else keys[:, 0], buckets)
    which, start = np.unique(at, return_index=True)
    end = np.append(start, len(keys))[1:]
    return pa.table({
        "bucket": pa.array(which, pa.int32()),
        "chunk": pa.array(np.full(len(which), chunk, np.int64)),
        "keys": pa.array([keys[a:b].tobytes() for a, b in zip(start, end, strict=True)], pa.binary()),
        "extra": pa.array([extra[a:b].tobytes() for a, b in zip(start, end, strict=True)], pa.binary()),
    })


def column_of(table: pa.Table, name: str, kind: np.dtype | type) -> list[np.ndarray]:
    return [np.frombuffer(x.as_buffer() if x.is_valid else b"", kind) for x in table[name]]


def replies(table: pa.Table, level: int, answers: list[np.ndarray]) -> pa.Table:
    n = len(table)
    return pa.table({"chunk": table["chunk"].cast(pa.int64()), "level": pa.array([level] * n, pa.int32()), "bucket": table["bucket"].cast(pa.int32()), "answer": pa.array([x.tobytes() for x in answers], pa.binary())})


def answered(table: pa.Table, level: int, kind: np.dtype | type) -> np.ndarray:
    """The answers of one level in the order of the chunk's sorted keys."""
    import pyarrow.compute as pc

    own = table.filter(pc.equal(table["level"], level)).sort_by("bucket")
    parts = column_of(own, "answer", kind)
    return np.concatenate(parts) if parts else np.zeros(0, kind)


def packed(*columns: np.ndarray) -> bytes:
    """Arrays as bytes: the first bytes of all items, then the second ones, and so on, which compresses small numbers well."""
    out = [np.array([len(columns)] + [x for c in columns for x in (len(c), c.dtype.num)], np.int64).tobytes()]
    out += [np.ascontiguousarray(c.view(np.uint8).reshape(len(c), c.itemsize).T).tobytes() for c in columns if len(c)]
    return zstandard.ZstdCompressor(level=1).compress(b"".join(out))


def unpacked(data: bytes | pa.Buffer) -> list[np.ndarray]:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    n = int(raw[:8].view(np.int64)[0])
    head, at, out = raw[8 : 8 + 16 * n].view(np.int64), 8 + 16 * n, []
    for i in range(n):
        size, kind = int(head[2 * i]), _KINDS[int(head[2 * i + 1])]
        out.append(np.ascontiguousarray(raw[at : at + size * kind.itemsize].reshape(kind.itemsize, size).T).reshape(-1).view(kind) if size else np.zeros(0, kind))
        at += size * kind.itemsize
    return out


_KINDS = {np.dtype(k).num: np.dtype(k) for k in (np.uint8, np.uint16, np.uint32, np.uint64, np.int32, np.int64, np.float64)}
