"""WARC archives: writing records, reading them back, and putting segments together.

Long records are written in segments: the first keeps its type and carries
``WARC-Segment-Number: 1``, the others are ``continuation`` records that name
the first by ``WARC-Segment-Origin-ID``, and the last states the total length.
``reassembled`` groups segments by that identifier, orders them by number,
verifies numbers and total length, and decodes chunked transfer framing.

Defined cases: a null payload is the empty payload; records of which a segment
is missing, doubled or of the wrong total length, and bodies with broken chunk
framing, give a row with ``error`` set and a null payload; repeated page ids
give a record each; a row without an id is a response of its own; an empty
table gives an empty table; further columns do not matter.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import stored

# Fixed values of the format.
VERSION = b"WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP_HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n"

ARCHIVE = "archive string, content binary"
RECORD = "record_id string, record_type string, origin string, segment int, total_length long, target string, refers_to string, payload_digest string, block binary"
_RECORD_NAMES = ["record_id", "record_type", "origin", "segment", "total_length", "target", "refers_to", "payload_digest", "block"]
_RECORD_TYPES = [pa.string(), pa.string(), pa.string(), pa.int32(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.binary()]


def digest32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def chunked(body: bytes, size: int) -> bytes:
    parts = [b"%x\r\n%s\r\n" % (len(body[i : i + size]), body[i : i + size]) for i in range(0, len(body), size)]
    return b"".join(parts) + b"0\r\n\r\n"


def unchunked(body: bytes) -> bytes:
    out, at = [], 0
    while True:
        end = body.index(b"\r\n", at)
        size = int(body[at:end].split(b";")[0], 16)
        at = end + 2
        if size == 0:
            return b"".join(out)
        if body[at + size : at + size + 2] != b"\r\n":
            raise ValueError("broken chunk")
        out.append(body[at : at + size])
        at += size + 2


def record(fields: list[tuple[str, str]], block: bytes) -> bytes:
    """One record as a gzip member of its own."""
    head = VERSION + b"\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields).encode() + b"Content-Length: %d\r\n\r\n" % len(block)
    packer = zlib.compressobj(1, zlib.DEFLATED, 31)
    return packer.compress(head + block + b"\r\n\r\n") + packer.flush()


def records_for(row_id: str, target: str, payload: bytes, refers_to: str | None, segment_bytes: int, chunk_bytes: int) -> Iterator[bytes]:
    kind = "response" if refers_to is None else "revisit"
    fields = [("WARC-Type", kind), ("WARC-Record-ID", f"<{row_id}>"), ("WARC-Date", "2024-01-01T00:00:00Z"), ("WARC-Target-URI", re.sub(r"\s", "%20", target)), ("WARC-Payload-Digest", f"sha1:{digest32(payload)}"), ("Content-Type", "application/http; msgtype=response")]
    if refers_to is not None:
        yield record([*fields, ("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", f"<{refers_to}>")], HTTP_HEAD)
        return
    block = HTTP_HEAD + chunked(payload, chunk_bytes)
    if len(block) <= segment_bytes:
        yield record(fields, block)
        return
    parts = [block[i : i + segment_bytes] for i in range(0, len(block), segment_bytes)]
    yield record([*fields, ("WARC-Segment-Number", "1")], parts[0])
    for n, part in enumerate(parts[1:], 2):
        more = [("WARC-Segment-Total-Length", str(len(block)))] if n == len(parts) else []
        yield record([("WARC-Type", "continuation"), ("WARC-Record-ID", f"<{row_id}:{n}>"), ("WARC-Date", "2024-01-01T00:00:00Z"), ("WARC-Segment-Origin-ID", f"<{row_id}>"), ("WARC-Segment-Number", str(n)), *more], part)


def archives(rows: DataFrame, segment_bytes: int = 16_384, chunk_bytes: int = 4_096, archive_bytes: int = 8 << 20, side_by_side: int = 2) -> DataFrame:
    """(archive, content): columns name, target, payload, refers_to as archives; segments go to several in turn."""
    picked = rows.select("name", "target", "payload", "refers_to")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, made, turn, n = TaskContext.get().partitionId(), 0, 0, 0
        open_files: list[list[bytes]] = [[] for _ in range(side_by_side)]
        sizes = [0] * side_by_side

        def closed(i: int) -> pa.RecordBatch:
            nonlocal made
            made += 1
            content = b"".join(open_files[i])
            open_files[i], sizes[i] = [], 0
            return pa.RecordBatch.from_arrays([pa.array([f"part-{part:06d}-{made:05d}.warc.gz"]), pa.array([content], pa.binary())], names=["archive", "content"])

        for batch in batches:
            for name, target, payload, refers in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                n += 1
                for raw in records_for(f"urn:x-row:{name if name is not None else ''}:{part}-{n}", target or "", payload or b"", f"urn:x-row:{refers}" if refers is not None else None, segment_bytes, chunk_bytes):
                    turn = (turn + 1) % side_by_side
                    open_files[turn].append(raw)
                    sizes[turn] += len(raw)
                    if sizes[turn] >= archive_bytes:
                        yield closed(turn)
        for i in range(side_by_side):
            if open_files[i]:
                yield closed(i)

    return picked.mapInArrow(run, ARCHIVE)


def parsed(raw: bytes) -> tuple:
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "replace").split("\r\n")
    f = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
    bare = lambda k: f[k].strip("<>") if k in f else None
    number = lambda k: int(f[k]) if k in f else None
    own = bare("warc-record-id")
    digest = f.get("warc-payload-digest")
    return own, f.get("warc-type"), bare("warc-segment-origin-id") or own, number("warc-segment-number"), number("warc-segment-total-length"), f.get("warc-target-uri"), bare("warc-refers-to"), digest.removeprefix("sha1:") if digest else None, rest[: int(f.get("content-length", 0))]


def read_records(found: DataFrame) -> DataFrame:
    """RECORD rows of all archives."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                out, size = [], 0
                view = memoryview(content.as_buffer())
                while len(view):
                    reader = zlib.decompressobj(31)
                    # Only a stretch is handed over each time, so what is left is never copied whole.
                    raw, at = bytearray(), 0
                    while not reader.eof and at < len(view):
                        raw += reader.decompress(view[at : at + 65_536])
                        at += 65_536
                    view = view[min(at, len(view)) - len(reader.unused_data) :] if reader.eof else view[len(view) :]
                    out.append(parsed(bytes(raw)))
                    size += len(raw)
                    if size > 8 << 20:
                        yield _records(out)
                        out, size = [], 0
                yield _records(out)

    return found.select("content").mapInArrow(run, RECORD)


def _records(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(_RECORD_TYPES)], names=_RECORD_NAMES)


PAYLOAD = "record_id string, record_type string, target string, refers_to string, payload_digest string, segments int, payload binary, error string"
_PAYLOAD_NAMES = ["record_id", "record_type", "target", "refers_to", "payload_digest", "segments", "payload", "error"]
_PAYLOAD_TYPES = [pa.string(), pa.string(), pa.string(), pa.string(), pa.string(), pa.int32(), pa.binary(), pa.string()]


def joined(segments: list[tuple]) -> tuple:
    """A record's payload from its segments, ordered by number."""
    head = segments[0]
    payload, error = None, None
    try:
        if len(segments) > 1 or head[3] is not None:
            if [s[3] for s in segments] != list(range(1, len(segments) + 1)):
                raise ValueError("segments are missing or doubled")
            if sum(len(s[8]) for s in segments) != segments[-1][4]:
                raise ValueError("total length differs")
        block = b"".join(s[8] for s in segments)
        if head[1] == "response":
            http, gap, body = block.partition(b"\r\n\r\n")
            if not gap:
                raise ValueError("no HTTP head")
            payload = unchunked(body) if re.search(rb"(?i)^transfer-encoding:\s*chunked\s*$", http, re.M) else body
            if head[7] is not None and digest32(payload) != head[7]:
                raise ValueError("payload digest differs")
    except ValueError as e:
        payload, error = None, str(e)[:200]
    return (head[2], head[1], head[5], head[6], head[7], len(segments), payload, error)


def reassembled(records: DataFrame) -> DataFrame:
    """PAYLOAD rows: whole records as they are, segmented ones put together."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []  # the segments of one record; they arrive ordered
        for batch in batches:
            out, size = [], 0
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if held and (row[2] != held[0][2] or row[3] is None):
                    out.append(joined(held))
                    size += len(out[-1][6] or b"")
                    held = []
                held.append(row)
            if out:
                yield _payloads(out)
        if held:
            yield _payloads([joined(held)])

    whole = records.where("segment is null")
    cut = records.where("segment is not null")
    together = cut.repartition("origin").sortWithinPartitions("origin", "segment")
    return whole.mapInArrow(run, PAYLOAD).unionByName(together.mapInArrow(run, PAYLOAD))


def _payloads(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(_PAYLOAD_TYPES)], names=_PAYLOAD_NAMES)


#: Parts over which the rows of one payload are spread when they learn of its first row.
SALTS = 16


def salted(df: DataFrame) -> DataFrame:
    """Each row once for every part."""
    return df.withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))


def with_originals(pages: DataFrame, key: str, payload: str, least_bytes: int = 0) -> DataFrame:
    """Each row with ``refers_to``: the smallest key among equal payloads of at least ``least_bytes``, null for that row itself."""
    body = F.coalesce(F.col(payload), F.lit(""))
    rows = pages.withColumn("_digest", F.sha1(body)).withColumn("_bytes", F.octet_length(body)).withColumn("_salt", F.pmod(F.xxhash64(key), F.lit(SALTS)))
    same = rows.where(F.col("_bytes") >= least_bytes).groupBy("_digest").agg(F.min(key).alias("_least"), F.count("*").alias("_n")).where("_n > 1").select("_digest", "_least")
    found = rows.join(salted(same), ["_digest", "_salt"], "left")
    return found.withColumn("refers_to", F.when(F.col("_least") < F.col(key), F.col("_least"))).drop("_digest", "_bytes", "_least", "_salt")


def archived(pages: DataFrame, key: str, target: str, payload: str, least_bytes: int = 0, **form: int) -> DataFrame:
    """Write all rows as archives in the shared folder, read them back and put segments together."""
    picked = pages.select(F.col(key).alias("name"), F.col(target).alias("target"), F.col(payload).alias("body"))
    marked = with_originals(picked, "name", "body", least_bytes)
    rows = marked.select("name", "target", F.encode(F.coalesce(F.col("body"), F.lit("")), "UTF-8").alias("payload"), "refers_to")
    return reassembled(read_records(stored(archives(rows, **form), "warc")))


def catalogued(records: DataFrame) -> DataFrame:
    """Reassembled records without their payloads: row (the key in the identifier, null if it had none), payload_bytes, payload_digest, record_type, refers_to, error.

    The archives are read once.  A revisit stores no payload; its size is that of the response it refers to.
    """
    name = lambda c: F.when(F.length(F.split(c, ":")[2]) > 0, F.split(c, ":")[2])
    told = records.select(name("record_id").alias("row"), F.octet_length("payload").cast("long").alias("payload_bytes"), "payload_digest", "record_type", name("refers_to").alias("refers_to"), "error")
    told = stored(told, "records")
    sizes = told.where("record_type = 'response' and row is not null").groupBy("row", "payload_digest").agg(F.max("payload_bytes").alias("_bytes")).withColumnRenamed("row", "refers_to")
    revisits = told.where("record_type = 'revisit'").withColumn("_salt", F.pmod(F.xxhash64("row"), F.lit(SALTS)))
    found = revisits.join(salted(sizes.join(revisits.select("refers_to").distinct(), "refers_to", "left_semi")), ["refers_to", "payload_digest", "_salt"], "left")
    return told.where("record_type = 'response'").unionByName(found.select(*(c for c in told.columns if c != "payload_bytes"), F.col("_bytes").alias("payload_bytes")))
