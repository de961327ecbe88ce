"""TIFF: writing 8-bit grey pages, and walking image directories back to pixels.

``decode_pages`` emits one row for each page (image directory) of each file.
It reads both byte orders and both bit orders, strips and tiles, samples side
by side or in planes, 1, 2, 4, 8, 16 and 32 bits, no compression, PackBits, LZW
and deflate, and undoes horizontal and floating-point differencing.
``encode_text_media`` stores texts losslessly as such pages.

Pixels come row by row, samples side by side, little-endian, samples of less
than 8 bits as a byte each.

Defined cases: a null or empty file, a file without the TIFF magic, a loop in
the directory chain and a damaged strip each give one row with ``error`` set
and null pixels (page -1 if no directory could be read); empty tables give
empty tables; a null text is the empty text; further columns of the input do
not matter, as columns are picked by name; repeated rows are files of their own.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .units import text_bytes

# Fixed values of the file format.
NONE, LZW, DEFLATE, OLD_DEFLATE, PACKBITS = 1, 5, 8, 32946, 32773
WIDTH, HEIGHT, BITS, COMPRESSION, PHOTOMETRIC, STRIP_OFFSETS, SAMPLES, ROWS_PER_STRIP, STRIP_COUNTS = 256, 257, 258, 259, 262, 273, 277, 278, 279
FILL_ORDER, PLANES = 266, 284
PREDICTOR, TILE_WIDTH, TILE_LENGTH, TILE_OFFSETS, TILE_COUNTS = 317, 322, 323, 324, 325
FIELD = {1: ("B", 1), 2: ("B", 1), 3: ("H", 2), 4: ("I", 4), 16: ("Q", 8)}

TEXT_WIDTH = 192


def packbits_encode(data: bytes) -> bytes:
    out, i, n = bytearray(), 0, len(data)
    while i < n:
        j = i + 1
        while j < n and j - i < 128 and data[j] == data[i]:
            j += 1
        if j - i > 1:
            out += bytes([257 - (j - i), data[i]])
            i = j
            continue
        while j < n and j - i < 128 and (j + 1 >= n or data[j] != data[j + 1]):
            j += 1
        out += bytes([j - i - 1]) + data[i:j]
        i = j
    return bytes(out)


def packbits_decode(data: bytes) -> bytes:
    out, i = bytearray(), 0
    while i < len(data):
        k = data[i]
        if k < 128:
            out += data[i + 1 : i + 2 + k]
            i += 2 + k
        elif k > 128:
            out += data[i + 1 : i + 2] * (257 - k)
            i += 2
        else:
            i += 1
    return bytes(out)


def lzw_encode(data: bytes) -> bytes:
    """Variable-width codes, most significant bit first, widened one code early."""
    table, width, acc, held, out, prefix = {bytes([b]): b for b in range(256)}, 9, 0, 0, bytearray(), b""

    def put(code: int) -> None:
        nonlocal acc, held
        acc, held = (acc << width) | code, held + width
        while held >= 8:
            held -= 8
            out.append((acc >> held) & 255)
        acc &= (1 << held) - 1

    put(256)
    size = 258
    for b in data:
        longer = prefix + bytes([b])
        if longer in table:
            prefix = longer
            continue
        put(table[prefix])
        table[longer] = size
        size += 1
        if size == 4094:
            put(256)
            table, width, size = {bytes([x]): x for x in range(256)}, 9, 258
        elif size in (512, 1024, 2048):
            width += 1
        prefix = bytes([b])
    if prefix:
        put(table[prefix])
        size += 1
        if size in (512, 1024, 2048):
            width += 1
    put(257)
    if held:
        out.append((acc << (8 - held)) & 255)
    return bytes(out)


def lzw_decode(data: bytes) -> bytes:
    acc = held = 0
    width, table, out, last = 9, [bytes([b]) for b in range(256)] + [b"", b""], bytearray(), b""
    for byte in data:
        acc, held = (acc << 8) | byte, held + 8
        if held < width:
            continue
        held -= width
        code = acc >> held
        acc &= (1 << held) - 1
        if code == 257:
            break
        if code == 256:
            table, width, last = table[:258], 9, b""
            continue
        if last:
            if code > len(table):
                raise ValueError("LZW code out of range")
            table.append(last + (table[code][:1] if code < len(table) else last[:1]))
        elif code >= len(table):
            raise ValueError("LZW code out of range")
        last = table[code]
        out += last
        if len(table) in (511, 1023, 2047):
            width += 1
    return bytes(out)


ENCODE = {NONE: bytes, PACKBITS: packbits_encode, LZW: lzw_encode, DEFLATE: lambda b: zlib.compress(b, 1)}
DECODE = {NONE: bytes, PACKBITS: packbits_decode, LZW: lzw_decode, DEFLATE: zlib.decompress, OLD_DEFLATE: zlib.decompress}


def write_tiff(pages: list[np.ndarray], compression: int = DEFLATE, predictor: int = 2, rows_per_strip: int = 64, tile: int = 0) -> bytes:
    """A little-endian file with one directory for each 2-D uint8 page; ``tile`` > 0 stores square tiles instead of strips."""
    out, link = bytearray(b"II*\0\0\0\0\0"), 4
    for page in pages:
        height, width = page.shape
        if tile:
            padded = np.zeros((-(-height // tile) * tile, -(-width // tile) * tile), np.uint8)
            padded[:height, :width] = page
            parts = [padded[y : y + tile, x : x + tile] for y in range(0, padded.shape[0], tile) for x in range(0, padded.shape[1], tile)]
        else:
            parts = [page[y : y + rows_per_strip] for y in range(0, height, rows_per_strip)]
        at, sizes = [], []
        for part in parts:
            if predictor == 2:
                differences = part.copy()
                differences[:, 1:] -= part[:, :-1]
                part = differences
            coded = ENCODE[compression](part.tobytes())
            at.append(len(out))
            sizes.append(len(coded))
            out += coded + b"\0" * (len(coded) % 2)
        spots = []
        for values in (at, sizes):
            spots.append(values[0] if len(values) == 1 else len(out))
            if len(values) > 1:
                out += struct.pack(f"<{len(values)}I", *values)
        tags = [(WIDTH, 4, 1, width), (HEIGHT, 4, 1, height), (BITS, 3, 1, 8), (COMPRESSION, 3, 1, compression), (PHOTOMETRIC, 3, 1, 1), (SAMPLES, 3, 1, 1), (PREDICTOR, 3, 1, predictor)]
        if tile:
            tags += [(TILE_WIDTH, 4, 1, tile), (TILE_LENGTH, 4, 1, tile), (TILE_OFFSETS, 4, len(at), spots[0]), (TILE_COUNTS, 4, len(at), spots[1])]
        else:
            tags += [(STRIP_OFFSETS, 4, len(at), spots[0]), (ROWS_PER_STRIP, 4, 1, rows_per_strip), (STRIP_COUNTS, 4, len(at), spots[1])]
        struct.pack_into("<I", out, link, len(out))
        out += struct.pack("<H", len(tags))
        for tag, kind, count, value in sorted(tags):
            out += struct.pack("<HHI", tag, kind, count) + (struct.pack("<HH", value, 0) if kind == 3 else struct.pack("<I", value))
        link = len(out)
        out += b"\0\0\0\0"
    return bytes(out)


def directories(data: bytes) -> Iterator[tuple[str, dict[int, tuple[int, ...]]]]:
    """The byte order and the whole-number fields of each image directory."""
    order = {b"II*\0": "<", b"MM\0*": ">"}.get(data[:4])
    if order is None or len(data) < 8:
        raise ValueError("not a TIFF file")
    (at,), seen = struct.unpack_from(order + "I", data, 4), set()
    while at:
        if at in seen:
            raise ValueError("the directory chain has a loop")
        seen.add(at)
        (count,), fields = struct.unpack_from(order + "H", data, at), {}
        for i in range(count):
            tag, kind, n = struct.unpack_from(order + "HHI", data, at + 2 + 12 * i)
            if kind in FIELD:
                letter, size = FIELD[kind]
                spot = at + 10 + 12 * i
                if n * size > 4:
                    (spot,) = struct.unpack_from(order + "I", data, spot)
                fields[tag] = struct.unpack_from(f"{order}{n}{letter}", data, spot)
        yield order, fields
        (at,) = struct.unpack_from(order + "I", data, at + 2 + 12 * count)


#: Every byte with its bits in the other order.
_MIRRORED = np.packbits(np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1)[:, ::-1], axis=1)[:, 0]


def samples_of(data: bytes, rows: int, across: int, samples: int, bits: int, predictor: int, order: str) -> np.ndarray:
    """A strip's or tile's samples as rows x across x samples, differences undone."""
    if bits < 8:
        line = -(-across * samples * bits // 8)
        flat = np.unpackbits(np.frombuffer(data, np.uint8)[: rows * line].reshape(rows, line), axis=1)[:, : across * samples * bits]
        weights = 1 << np.arange(bits - 1, -1, -1)
        return (flat.reshape(rows, across, samples, bits) * weights).sum(axis=3).astype(np.uint8)
    size = bits // 8
    if predictor == 3:
        # Bytes of equal rank lie together, highest first, and are differenced along the row.
        line = np.frombuffer(data, np.uint8)[: rows * across * samples * size].reshape(rows, across * size, samples)
        planes = np.cumsum(line, axis=1, dtype=np.uint8).reshape(rows, size, across * samples)
        return np.ascontiguousarray(planes.transpose(0, 2, 1)[:, :, ::-1]).view(f"<u{size}").reshape(rows, across, samples)
    kind = np.dtype(f"{order}u{size}")
    part = np.frombuffer(data, kind, min(rows * across * samples, len(data) // size)).reshape(rows, across, samples)
    return np.cumsum(part, axis=1, dtype=kind.newbyteorder("=")) if predictor == 2 else part


def read_page(data: bytes, fields: dict[int, tuple[int, ...]], order: str = "<") -> np.ndarray:
    """The page's samples as height x (width * samples)."""
    width, height = fields[WIDTH][0], fields[HEIGHT][0]
    samples, bits, coding, predictor, planes, fill = (fields.get(k, (1,))[0] for k in (SAMPLES, BITS, COMPRESSION, PREDICTOR, PLANES, FILL_ORDER))
    if bits not in (1, 2, 4, 8, 16, 32) or len(set(fields.get(BITS, (1,)))) > 1 or coding not in DECODE or predictor not in (1, 2, 3) or (predictor > 1 and bits < 8) or (predictor == 3 and bits < 16):
        raise ValueError(f"unsupported page: {bits} bits, compression {coding}, predictor {predictor}")
    tiled = TILE_OFFSETS in fields
    across, down = (fields[TILE_WIDTH][0], fields[TILE_LENGTH][0]) if tiled else (width, min(height, fields.get(ROWS_PER_STRIP, (height,))[0]))
    at, sizes = (fields[TILE_OFFSETS], fields[TILE_COUNTS]) if tiled else (fields[STRIP_OFFSETS], fields[STRIP_COUNTS])
    columns = -(-width // across)
    each = columns * -(-height // down)
    # In planes, all strips of one sample come before those of the next.
    apart = planes == 2 and samples > 1
    own = 1 if apart else samples
    page = np.zeros((height, width, samples), f"<u{max(1, bits // 8)}")
    if len(at) != each * (samples if apart else 1):
        raise ValueError(f"{len(at)} strips or tiles where {each * (samples if apart else 1)} are needed")
    for i, (start, size) in enumerate(zip(at, sizes, strict=True)):
        plane, i = divmod(i, each)
        y, x = i // columns * down, i % columns * across
        rows = down if tiled else min(down, height - y)
        raw = data[start : start + size]
        if fill == 2:
            raw = _MIRRORED[np.frombuffer(raw, np.uint8)].tobytes()
        part = samples_of(DECODE[coding](raw), rows, across, own, bits, predictor, order)[: height - y, : width - x]
        page[y : y + part.shape[0], x : x + part.shape[1], plane : plane + own] = part
    return page.reshape(height, -1)


PAGE_FIELDS = [("page", pa.int32()), ("width", pa.int32()), ("height", pa.int32()), ("samples", pa.int32()), ("compression", pa.int32()), ("predictor", pa.int32()), ("tiled", pa.bool_()), ("pixels", pa.binary()), ("error", pa.string())]
PAGE_SCHEMA = "page int, width int, height int, samples int, compression int, predictor int, tiled boolean, pixels binary, error string"


def pages_of(data: bytes | None) -> Iterator[tuple]:
    """One tuple of PAGE_FIELDS for each page."""
    n = 0
    try:
        if not data:
            raise ValueError("no file")
        for n, (order, f) in enumerate(directories(data)):  # noqa: B007
            about = (n, f[WIDTH][0], f[HEIGHT][0], *(f.get(k, (1,))[0] for k in (SAMPLES, COMPRESSION, PREDICTOR)), TILE_OFFSETS in f)
            try:
                yield (*about, read_page(data, f, order).tobytes(), None)
            except (ValueError, KeyError, IndexError, TypeError, ZeroDivisionError, zlib.error, struct.error) as e:
                yield (*about, None, f"{type(e).__name__}: {e}"[:200])
    except (ValueError, KeyError, IndexError, struct.error) as e:
        yield (-1, None, None, None, None, None, None, None, f"{type(e).__name__}: {e}"[:200])


def decode_pages(df: DataFrame, key: str, media: str, keep: list[str] | None = None) -> DataFrame:
    """One row for each page of each file in column ``media``, in the order of the input: the key, kept columns, ``file``
    (the file's number in its task), then PAGE_SCHEMA."""
    keep = keep or []
    rows = df.select(F.col(key).alias("key"), *(F.col(c).alias(f"k_{i}") for i, c in enumerate(keep)), F.col(media).alias("media"))
    names = ["key", *(f"k_{i}" for i in range(len(keep)))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before = 0
        for batch in batches:
            data, own, out, size = batch.column(len(names)), [], [], 0
            for i in range(len(batch)):
                for page in pages_of(data[i].as_py()):
                    own.append(i)
                    out.append(page)
                    size += len(page[7] or b"")
                    if size > 1 << 22:
                        yield paged(batch, before, own, out)
                        own, out, size = [], [], 0
            yield paged(batch, before, own, out)
            before += len(batch)

    def paged(batch: pa.RecordBatch, before: int, own: list[int], out: list[tuple]) -> pa.RecordBatch:
        at = pa.array(own, pa.int64())
        kept = batch.select(names).take(at)
        return pa.RecordBatch.from_arrays([*kept.columns, pc.add(at, before), *(pa.array([r[j] for r in out], t) for j, (_, t) in enumerate(PAGE_FIELDS))], names=[*names, "file", *(n for n, _ in PAGE_FIELDS)])

    kept = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema if f.name != "media")
    return rows.mapInArrow(run, f"{kept}, file long, {PAGE_SCHEMA}").withColumnsRenamed({"key": key} | {f"k_{i}": c for i, c in enumerate(keep)})


#: How texts are stored, by their checksum modulo 16; other remainders take the last.
TEXT_FORMS = {
    0: {"compression": LZW, "predictor": 2}, 1: {"compression": PACKBITS, "predictor": 1}, 2: {"compression": PACKBITS, "predictor": 1, "tile": 64},
    3: {"compression": DEFLATE, "predictor": 2, "tile": 64}, 4: {"compression": NONE, "predictor": 2}, -1: {"compression": DEFLATE, "predictor": 2},
}


def text_payload(raw: bytes) -> bytes:
    """The bytes, filled up with spaces to a positive multiple of the page width."""
    return raw + b" " * (max(1, -(-len(raw) // TEXT_WIDTH)) * TEXT_WIDTH - len(raw))


def text_media(raw: bytes, rows_per_page: int, **form: int) -> bytes:
    pixels = np.frombuffer(text_payload(raw), np.uint8).reshape(-1, TEXT_WIDTH)
    form = form or TEXT_FORMS.get(zlib.crc32(raw) % 16, TEXT_FORMS[-1])
    return write_tiff([pixels[y : y + rows_per_page] for y in range(0, len(pixels), rows_per_page)], **form)


def encode_text_media(df: DataFrame, key: str, text: str, rows_per_page: int = 256, **form: int) -> DataFrame:
    """(key, n_bytes, media): each text as a TIFF file of 192 samples a row, in a form that follows from the text unless ``form`` states one."""
    rows = df.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    kind = rows.schema["key"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, at = text_bytes(batch.column(1))
            media = [text_media(data[a:b].tobytes(), rows_per_page, **form) for a, b in zip(at[:-1], at[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.diff(at)), pa.array(media, pa.binary())], names=["key", "n_bytes", "media"])

    return rows.mapInArrow(run, f"key {kind}, n_bytes long, media binary").withColumnRenamed("key", key)


def page_digests(pages: DataFrame, key: str, keep: list[str]) -> DataFrame:
    """What each file's pages hold, from the rows of ``decode_pages`` in their order: payload size and digests, and a feature.

    The feature is ``pages/mean/deviation/distinct samples`` over all pixels.
    A file with a damaged page gives null payload columns.
    """
    rows = pages.select(F.col(key).alias("key"), *(F.col(c).alias(f"k_{i}") for i, c in enumerate(keep)), "file", "pixels", "error")
    n = len(keep) + 1
    types = [*(None for _ in range(n)), pa.int64(), pa.string(), pa.int64(), pa.string()]
    names = [*rows.columns[:n], "payload_bytes", "payload_sha256", "tail_crc32", "feature"]

    class File:
        """The digests of one file, page by page."""

        def __init__(self, about: tuple):
            self.about, self.pages, self.size, self.sha, self.tail, self.counts, self.bad = about, 0, 0, hashlib.sha256(), b"", np.zeros(256, np.int64), False

        def add(self, pixels: bytes | None, error: str | None) -> None:
            self.pages, self.bad = self.pages + 1, self.bad or error is not None
            if not self.bad:
                self.size += len(pixels)
                self.sha.update(pixels)
                self.tail = (self.tail + pixels[-16:])[-16:]
                self.counts += np.bincount(np.frombuffer(pixels, np.uint8), minlength=256)

        def row(self) -> tuple:
            if self.bad or not self.size:
                return (*self.about, None, None, None, None)
            mean = float(self.counts @ np.arange(256)) / self.size
            spread = float(self.counts @ (np.arange(256) - mean) ** 2 / self.size) ** 0.5
            return (*self.about, self.size, self.sha.hexdigest(), zlib.crc32(self.tail), f"{self.pages}/{mean:.6f}/{spread:.6f}/{int((self.counts > 0).sum())}")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own: File | None = None
        last, kinds = -1, []

        def table(files: list[File]) -> pa.RecordBatch:
            found = [f.row() for f in files]
            return pa.RecordBatch.from_arrays([pa.array([r[j] for r in found], t) for j, t in enumerate(kinds)], names=names)

        for batch in batches:
            kinds = [batch.column(j).type if t is None else t for j, t in enumerate(types)]
            about, done = list(zip(*(batch.column(j).to_pylist() for j in range(n)), strict=True)), []
            pixels, errors = batch.column(n + 1), batch.column(n + 2).to_pylist()
            for i, number in enumerate(batch.column(n).to_pylist()):
                if number != last:
                    if own:
                        done.append(own)
                    own, last = File(about[i]), number
                own.add(pixels[i].as_py(), errors[i])
            if done:
                yield table(done)
        if own:
            yield table([own])

    schema = ", ".join([*(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields[:n]), "payload_bytes long, payload_sha256 string, tail_crc32 long, feature string"])
    return rows.mapInArrow(run, schema).withColumnsRenamed({"key": key} | {f"k_{i}": c for i, c in enumerate(keep)})


def media_digest(df: DataFrame, key: str, media: str, keep: list[str]) -> DataFrame:
    """Size and digest of each stored file, and what its pages hold when read back page by page."""
    stated = df.select(key, *keep, media).withColumns({"media_bytes": F.octet_length(media).cast("long"), "media_sha256": F.sha2(media, 256)})
    keep = [*keep, "media_bytes", "media_sha256"]
    return page_digests(decode_pages(stated, key, media, keep), key, keep)
