"""Bounded-space online packing of token ids into fixed windows.

Each input partition keeps ``open_windows`` windows.  A piece goes into the
window it fits best; where none has room, the fullest is topped up with the
first ids of the piece and emitted full, and the rest of the piece goes on.
What is open when a partition ends is merged, ``fan_in`` partitions at a time,
by the same rule, until one group is left, so no task ever holds more than
``fan_in * open_windows`` windows.

Defined cases: a null text is the empty text, whose document is the end id
alone; a null id stays null; a text of any length is cut into as many pieces as
it needs; repeated rows are packed as often as they occur; an empty table gives
an empty table.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from .bpe import byte_letters
from .shared import stored
from .units import LOWER, SPACE, encode, slices, text_bytes

PIECE = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
_NAMES = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]


@lru_cache(4)
def tokenizer_at(path: str) -> Tokenizer:
    t = Tokenizer.from_file(path)
    t.no_truncation()
    t.no_padding()
    return t


#: Byte classes for cutting units: white space, letters, digits, other printable ASCII; the rest is never cut at.
_SPACE, _LETTER, _DIGIT, _SIGN, _REST = range(5)
_CLASS = np.full(256, _REST, np.uint8)
_CLASS[SPACE] = _SPACE
_CLASS[33:127] = _SIGN
_CLASS[48:58] = _DIGIT
_CLASS[65:91] = _CLASS[97:123] = _LETTER
_CLASS[ord("'")] = _REST
#: Second bytes of the letters U+00C0 to U+00FF, and of the capitals among them.
_LATIN, _CAPITAL = np.zeros(256, bool), np.zeros(256, bool)
_LATIN[0x80:0xC0] = _CAPITAL[0x80:0x9F] = True
_LATIN[[0x97, 0xB7]] = _CAPITAL[[0x97]] = False


class WordTokenizer:
    """Ids by a lower-casing tokenizer that ends a word at any white space, a sign or a digit.

    Texts are cut into units wherever the tokenizer surely starts a new word:
    at ASCII white space, between letters (ASCII or Latin-1), digits and ASCII
    signs.  A unit of one such kind is one word for the merge table; any other
    (apostrophes, further alphabets, combining marks) is left to the whole
    tokenizer.  Either is encoded once for a run of texts, or for a task.
    """

    def __init__(self, path: str, remember: int = 150_000):
        self.tokenizer, self.remember = tokenizer_at(path), remember
        self.model = self.tokenizer.model
        self.special = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.letters = byte_letters()
        self.memory: dict[bytes, tuple[int, ...]] = {}

    def word(self, unit: bytes) -> tuple[int, ...]:
        """The ids of a unit of one kind, straight from the merge table."""
        return tuple(t.id for t in self.model.tokenize(unit.decode() if unit.isascii() else "".join(self.letters[b] for b in unit)))

    def __call__(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        raw, docs = text_bytes(column)
        data, kind = LOWER[raw], _CLASS[raw]
        latin = np.flatnonzero((raw[:-1] == 0xC3) & _LATIN[raw[1:]]) if len(raw) else np.zeros(0, np.int64)
        kind[latin] = kind[latin + 1] = _LETTER
        capital = latin[_CAPITAL[raw[latin + 1]]] + 1
        data[capital] += 32
        inside = kind != _SPACE
        begins = inside.copy()
        if len(raw):
            before, after = kind[:-1], kind[1:]
            changed = (before != after) | (after == _DIGIT)
            begins[1:] &= (before == _SPACE) | (changed & (before != _REST) & (after != _REST))
        heads = docs[:-1][docs[:-1] < docs[1:]]
        begins[heads] = inside[heads]
        starts = np.flatnonzero(begins)
        at = np.append(np.cumsum(inside, dtype=np.int32)[starts] - 1, int(inside.sum()))
        codes, distinct = encode(slices(data[inside], at))
        # The first place of each distinct unit tells its kind.
        where = np.zeros(len(distinct), np.int64)
        where[codes[::-1]] = np.arange(len(codes))[::-1]
        own = kind[inside]
        plain = np.ones(len(at), bool)
        rest = np.flatnonzero(own == _REST)
        plain[np.searchsorted(at, rest, side="right") - 1] = False
        units, plain = distinct.to_pylist(), plain[where].tolist()
        memory, ids, odd = self.memory, [], []
        for i, u in enumerate(units):
            got = memory.get(u)
            if got is None:
                if not plain[i]:
                    odd.append(i)
                    got = ()
                else:
                    got = self.word(u)
                    if len(memory) < self.remember:
                        memory[u] = got
            ids.append(got)
        if odd:
            for i, e in zip(odd, self.tokenizer.encode_batch([units[i].decode() for i in odd], add_special_tokens=False), strict=True):
                ids[i] = tuple(e.ids)
        length = np.fromiter(map(len, ids), np.int64, len(ids))
        flat = np.fromiter(chain.from_iterable(ids), np.int32, int(length.sum()))
        source = np.cumsum(length) - length
        each = length[codes]
        end = np.cumsum(each)
        place = np.repeat(source[codes] - (end - each), each) + np.arange(int(end[-1]) if len(end) else 0)
        out, bounds = flat[place], np.concatenate([[0], end])[np.searchsorted(starts, docs)]
        return self._with_special(raw, docs, out, bounds)

    def _with_special(self, raw: np.ndarray, docs: np.ndarray, out: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Texts that hold a special token's string are encoded whole."""
        whole, everything = {}, raw.tobytes()
        for mark in self.special:
            at = everything.find(mark)
            while at >= 0:
                d = int(np.searchsorted(docs, at, side="right")) - 1
                if at + len(mark) <= docs[d + 1]:
                    whole[d] = np.asarray(self.tokenizer.encode(everything[docs[d] : docs[d + 1]].decode(), add_special_tokens=False).ids, np.int32)
                at = everything.find(mark, at + 1)
        if not whole:
            return out, bounds
        parts = [whole.get(d, out[bounds[d] : bounds[d + 1]]) for d in range(len(docs) - 1)]
        return np.concatenate(parts), np.concatenate([[0], np.cumsum([len(x) for x in parts])])


class Packer:
    """Open windows of one task.  A piece is (doc_id, start, ids, doc_tokens)."""

    def __init__(self, capacity: int, open_windows: int, prefix: int):
        self.capacity, self.most, self.next = capacity, open_windows, prefix << 32
        self.windows: list[list] = []  # [room, pieces]
        self.out: list[tuple] = []

    def add(self, doc: int, start: int, ids: np.ndarray, total: int) -> None:
        while len(ids) >= self.capacity:
            self.emit([(doc, start, ids[: self.capacity], total)])
            start, ids = start + self.capacity, ids[self.capacity :]
        while len(ids):
            n = len(ids)
            best = min((w for w in self.windows if w[0] >= n), key=lambda w: w[0], default=None)
            if best is None and len(self.windows) < self.most:
                best = [self.capacity, []]
                self.windows.append(best)
            if best is not None:
                best[0] -= n
                best[1].append((doc, start, ids, total))
                if not best[0]:
                    self.close(best)
                return
            full = min(self.windows, key=lambda w: w[0])
            room = full[0]
            full[1].append((doc, start, ids[:room], total))
            self.close(full)
            start, ids = start + room, ids[room:]

    def close(self, window: list) -> None:
        self.windows = [w for w in self.windows if w is not window]
        self.emit(window[1])

    def emit(self, pieces: list[tuple]) -> None:
        at = 0
        for doc, start, ids, total in pieces:
            self.out.append((doc, start, len(ids), zlib.crc32(ids.astype("<u4").tobytes()), total, self.next, at))
            at += len(ids)
        self.next += 1

    def taken(self) -> pa.RecordBatch:
        rows, self.out = self.out, []
        return _rows(rows, None, None)

    def left(self, group: int) -> pa.RecordBatch:
        """What the open windows hold, for a later merge."""
        pieces = [p for w in sorted(self.windows, key=lambda w: w[0]) for p in w[1]]
        rows = [(d, s, len(i), 0, t, -1, -1) for d, s, i, t in pieces]
        return _rows(rows, [i.astype("<u4").tobytes() for _, _, i, _ in pieces], group)


def _rows(rows: list[tuple], ids: list[bytes] | None, group: int | None) -> pa.RecordBatch:
    n = len(rows)
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], pa.int64()) for i in range(7)] + [pa.array(ids if ids is not None else [None] * n, pa.binary()), pa.array([group] * n, pa.int64())], names=[*_NAMES, "ids", "part"])


def merger(capacity: int, open_windows: int, depth: int, final: bool):
    """The merge of one group of partitions' leftovers."""

    def merge(key: tuple, table: pa.Table) -> pa.Table:
        group = key[0].as_py()
        packer = Packer(capacity, open_windows, (depth << 26) + group)
        # Largest pieces first; ties by document and place, so a rerun packs alike.
        for r in sorted(table.to_pylist(), key=lambda r: (-r["length"], r["doc_id"] is None, r["doc_id"] or 0, r["start"], r["ids"])):
            packer.add(r["doc_id"], r["start"], np.frombuffer(r["ids"], "<u4").astype(np.int32), r["doc_tokens"])
        if final:
            # The open windows become one stream again: all but the last are cut full.
            rest, packer.windows, packer.most = [p for w in packer.windows for p in w[1]], [], 1
            for p in rest:
                packer.add(*p)
            for w in list(packer.windows):
                packer.close(w)
        return pa.Table.from_batches([packer.taken(), packer.left(group)])

    return merge


def pack(df: DataFrame, key: str, text: str, tokenizer: str, end_id: int, capacity: int = 4096, open_windows: int = 16, fan_in: int = 64) -> DataFrame:
    """One row (PIECE) for each piece of each document."""
    rows = df.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, part = WordTokenizer(tokenizer), TaskContext.get().partitionId()
        packer = Packer(capacity, open_windows, part)
        for batch in batches:
            _, docs = text_bytes(batch.column(1))
            a = 0
            while a < len(batch):
                b = max(a + 1, int(np.searchsorted(docs, docs[a] + (1 << 24))))
                ids, at = words(batch.column(1).slice(a, b - a))
                for i, doc in enumerate(batch.column(0).slice(a, b - a).to_pylist()):
                    whole = np.append(ids[at[i] : at[i + 1]], np.int32(end_id))
                    packer.add(doc, 0, whole, len(whole))
                yield packer.taken()
                a = b
        yield packer.left(part)

    schema = PIECE + ", ids binary, part long"
    parts = stored(rows.mapInArrow(first, schema), "packed")
    done, depth = [parts.where("ids is null")], 1
    left = parts.where("ids is not null")
    spread = parts.sparkSession.sparkContext.defaultParallelism
    last = left.agg(F.max("part")).first()[0]
    while last is not None:
        final = last < fan_in

        grouped = left.withColumn("part", F.floor(F.col("part") / fan_in)).repartition(max(1, min(spread, last // fan_in + 1)), "part")
        merged = stored(grouped.groupBy("part").applyInArrow(merger(capacity, open_windows, depth, final), schema), "packed")
        done.append(merged.where("ids is null"))
        left, last, depth = merged.where("ids is not null"), None if final else last // fan_in, depth + 1
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out.select(*_NAMES)
