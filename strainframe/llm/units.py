"""Splitting whole texts into words or whitespace-led units, one Arrow batch at a time.

All functions work on the UTF-8 bytes of a text column and stay in numpy and
Arrow: no Python object is made for each word, only for each *distinct* word
of a batch.  Null texts count as empty.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash

#: ``[\x20\x09-\x0D]``: the bytes that separate words.
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: A-Z to a-z, every other byte unchanged.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words whose every output bit depends on every input bit."""
    x = x ^ (x >> np.uint64(30))
    x *= _M1
    x ^= x >> np.uint64(27)
    x *= _M2
    x ^= x >> np.uint64(31)
    return x


def pair_hash(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """64-bit hashes of ordered pairs of 64-bit hashes."""
    return mix(left * np.uint64(0x9E3779B97F4A7C15) + mix(right + np.uint64(0xD1B54A32D192ED03)))


def text_bytes(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts after each other, and the n + 1 offsets of the texts."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    if not pa.types.is_large_string(column.type) and not pa.types.is_large_binary(column.type):
        column = column.cast(pa.large_binary() if pa.types.is_binary(column.type) else pa.large_string())
    n = len(column)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64, n + 1, column.offset * 8)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def slices(data: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """Adjacent slices of ``data`` as an Arrow binary array."""
    if offsets[-1] < 2**31:
        return pa.Array.from_buffers(pa.binary(), len(offsets) - 1, [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(data))])
    return pa.Array.from_buffers(pa.large_binary(), len(offsets) - 1, [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(data))])


@dataclass
class Words:
    """``codes[first[d]:first[d + 1]]`` are the words of document d as places in ``distinct``."""

    codes: np.ndarray
    first: np.ndarray
    distinct: pa.Array

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each distinct word."""
        return np.fromiter(map(xxhash.xxh3_64_intdigest, self.distinct.to_pylist()), np.uint64, len(self.distinct))


def encode(values: pa.Array) -> tuple[np.ndarray, pa.Array]:
    if len(values) == 0:
        return np.zeros(0, np.int32), values
    e = values.dictionary_encode()
    return e.indices.to_numpy(zero_copy_only=False), e.dictionary


def words(column: pa.Array | pa.ChunkedArray, lower: bool = False) -> Words:
    """The words ``[^\\x20\\x09-\\x0D]+`` of each text; ``lower`` folds A-Z first."""
    data, docs = text_bytes(column)
    inside = ~SPACE[data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    heads = docs[:-1][docs[:-1] < docs[1:]]
    begins[heads] = inside[heads]
    starts = np.flatnonzero(begins)
    kept = data[inside]
    if lower:
        kept = LOWER[kept]
    at = np.empty(len(starts) + 1, np.int64)
    at[-1] = len(kept)
    at[:-1] = np.cumsum(inside)[starts] - 1
    codes, distinct = encode(slices(kept, at))
    return Words(codes, np.searchsorted(starts, docs), distinct)


#: A random 64-bit word for each place (modulo 64) and byte; the same in every process.
_TABLE = mix(np.arange(1, 64 * 256 + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def runs(docs: np.ndarray, most: int = 1 << 22) -> list[tuple[int, int]]:
    """Ranges of documents that hold about ``most`` bytes, or one document."""
    out, a, n = [], 0, len(docs) - 1
    while a < n:
        b = max(a + 1, int(np.searchsorted(docs, docs[a] + most, side="right")) - 1)
        out.append((a, b))
        a = b
    return out


def word_hashes(column: pa.Array | pa.ChunkedArray, lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash of every word of every text, and the n + 1 offsets of the texts.

    The hash of a word is the mixed sum of a random number for each byte and
    place: two different words of up to 64 bytes meet with probability 2**-64.
    """
    data, docs = text_bytes(column)
    hashes, counts = [], []
    for a, b in runs(docs, 1 << 20):
        part, own = data[docs[a] : docs[b]], docs[a : b + 1] - docs[a]
        if lower:
            part = LOWER[part]
        inside = ~SPACE[part]
        begins = inside.copy()
        begins[1:] &= ~inside[:-1]
        heads = own[:-1][own[:-1] < own[1:]]
        begins[heads] = inside[heads]
        starts = np.flatnonzero(begins)
        counts.append(np.diff(np.searchsorted(starts, own)))
        if not len(starts):
            continue
        kept = part[inside]
        at = np.cumsum(inside, dtype=np.int64)[starts] - 1
        lengths = np.diff(at, append=len(kept))
        place = np.arange(len(kept)) - np.repeat(at, lengths)
        value = _TABLE[((place & 63) << 8) | kept]
        if lengths.max() > 64:
            value *= mix((place >> 6).astype(np.uint64)) | np.uint64(1)
        hashes.append(mix(np.add.reduceat(value, at) + lengths.astype(np.uint64)))
    first = np.concatenate([[0], np.cumsum(np.concatenate(counts))]) if counts else np.zeros(len(docs), np.int64)
    return (np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)), first.astype(np.int64)


def byte_grams(column: pa.Array | pa.ChunkedArray, n: int, bits: int, lower: bool) -> tuple[np.ndarray, np.ndarray]:
    """The bucket of every run of n bytes of every text (white space folded to one kind of byte), and the offsets of the texts."""
    data, docs = text_bytes(column)
    out, counts = [], []
    for a, b in runs(docs, 1 << 20):
        part, own = data[docs[a] : docs[b]], docs[a : b + 1] - docs[a]
        if lower:
            part = LOWER[part]
        part = np.where(SPACE[part], np.uint8(32), part)
        code = np.zeros(max(0, len(part) - n + 1), np.uint64)
        for i in range(n):
            code = (code << np.uint64(8)) | part[i : i + len(code)]
        code = (code * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - bits)).astype(np.int32)
        each = np.maximum(np.diff(own) - n + 1, 0)
        place = np.ones(len(code), bool)
        # Runs that reach into the next text are left out.
        for cut in range(1, n):
            spot = own[1:-1] - cut
            place[spot[(spot >= 0) & (spot < len(code))]] = False
        out.append(code[place])
        counts.append(each)
    first = np.concatenate([[0], np.cumsum(np.concatenate(counts))]) if counts else np.zeros(len(docs), np.int64)
    return (np.concatenate(out) if out else np.zeros(0, np.int32)), first.astype(np.int64)


def sums(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """The sum of each text's values; 0 where it has none."""
    out = np.zeros(len(first) - 1)
    some = first[1:] > first[:-1]
    if some.any():
        out[some] = np.add.reduceat(values, first[:-1][some])
    return out
