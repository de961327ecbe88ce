"""Byte-level BPE with a minimal acyclic transducer lexicon.

``Lexicon`` is a finite automaton over bytes whose equal suffixes are shared.
Every frequent unit (a word with the white-space byte before it) is a path;
the ids it encodes to are found by minimal perfect hashing: each arc carries
the number of accepted units that sort before those behind it, the sum along
the path is the unit's rank, and the rank points into an array of ids.  The
arrays lie in one file that workers map into memory, so one copy serves all
workers of a machine.  Units that the lexicon lacks are merged exactly by
rank, as the tokenizer's own merge table says.

Defined cases: a null text is the empty text and has no ids; a text that
holds a special token's string is cut there first; a text of any length is
taken whole.
"""

from __future__ import annotations

import hashlib
import json
import os
import tempfile
import uuid
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import stored
from .units import SPACE, encode, slices, text_bytes

#: Fixed value: the pre-tokeniser's pattern.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: First bytes of characters beyond ASCII that may be white space; no cut is made before them.
_WIDE_SPACE = np.zeros(256, bool)
_WIDE_SPACE[[0xC2, 0xE1, 0xE2, 0xE3]] = True


def byte_letters() -> list[str]:
    """The printable letter by which a byte-level vocabulary names each byte."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    names, extra = {b: chr(b) for b in plain}, 0
    for b in range(256):
        if b not in names:
            names[b] = chr(256 + extra)
            extra += 1
    return [names[b] for b in range(256)]


class Merges:
    """The vocabulary and merge table of a byte-level BPE file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        byte_of = {c: b for b, c in enumerate(byte_letters())}
        vocab = spec["model"]["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        raw = lambda token: bytes(byte_of[c] for c in token)
        self.ids = {raw(t): i for t, i in vocab.items() if t not in self.special}
        pairs = [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
        self.rank = {(raw(a), raw(b)): r for r, (a, b) in enumerate(pairs)}
        self.tokens = [b""] * (1 + max([*vocab.values(), *self.special.values()]))
        for t, i in self.ids.items():
            self.tokens[i] = t
        for t, i in self.special.items():
            self.tokens[i] = t.encode()
        self._pattern = regex.compile(PATTERN)
        self._cut = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        pair = np.array([(self.ids[a] << 32) | self.ids[b] for a, b in self.rank], np.int64)
        order = np.argsort(pair)
        self.pair = pair[order]
        self.pair_rank = np.fromiter(self.rank.values(), np.int64, len(pair))[order]
        self.pair_id = np.array([self.ids[a + b] for a, b in self.rank], np.int32)[order]
        self.byte_id = np.array([self.ids.get(bytes([b]), -1) for b in range(256)], np.int32)

    def merge(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all pieces after each other, and the n + 1 offsets.

        In each round every piece merges all places of its pair of lowest
        rank, from the left; a pair made by a merge never ranks below it.
        """
        lengths = np.fromiter(map(len, pieces), np.int64, len(pieces))
        ids = self.byte_id[np.frombuffer(b"".join(pieces), np.uint8)]
        piece = np.repeat(np.arange(len(pieces)), lengths)
        none = np.int64(1 << 60)
        settled: list[tuple[np.ndarray, np.ndarray]] = []
        while len(ids):
            rank, made = np.full(len(ids), none), np.zeros(len(ids), np.int32)
            if len(ids) > 1:
                key = (ids[:-1].astype(np.int64) << 32) | ids[1:]
                spot = np.minimum(np.searchsorted(self.pair, key), len(self.pair) - 1)
                found = (self.pair[spot] == key) & (piece[:-1] == piece[1:])
                rank[:-1][found] = self.pair_rank[spot[found]]
                made[:-1][found] = self.pair_id[spot[found]]
            starts = np.flatnonzero(np.append(True, piece[1:] != piece[:-1]))
            low = np.minimum.reduceat(rank, starts)
            each = np.diff(np.append(starts, len(ids)))
            over = np.repeat(low == none, each)
            if over.any():
                settled.append((piece[over], ids[over]))
                keep = ~over
                ids, piece, rank, made = ids[keep], piece[keep], rank[keep], made[keep]
                low, each = low[low != none], each[low != none]
                if not len(ids):
                    break
            here = rank == np.repeat(low, each)
            # Of neighbouring places of a pair like (a, a), every other one counts, from the left.
            at = np.flatnonzero(here)
            run = np.append(True, np.diff(at) > 1)
            head = np.maximum.accumulate(np.where(run, np.arange(len(at)), 0))
            at = at[(np.arange(len(at)) - head) % 2 == 0]
            ids[at] = made[at]
            stay = np.ones(len(ids), bool)
            stay[at + 1] = False
            ids, piece = ids[stay], piece[stay]
        if not settled:
            return np.zeros(0, np.int32), np.zeros(len(pieces) + 1, np.int64)
        which, flat = (np.concatenate(x) for x in zip(*settled, strict=True))
        order = np.argsort(which, kind="stable")
        return flat[order], np.concatenate([[0], np.cumsum(np.bincount(which, minlength=len(pieces)))])

    def encode_many(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of whole texts or units after each other, and the n + 1 offsets."""
        special: list[tuple[int, int]] = []
        if self._cut and any(mark in everything for everything in ("\n".join(texts),) for mark in self.special):
            pieces, counts = [], []
            for text in texts:
                n = len(pieces)
                for part in self._cut.split(text):
                    if part in self.special:
                        special.append((len(pieces), self.special[part]))
                        pieces.append(b"")
                    else:
                        pieces += [m.encode() for m in self._pattern.findall(part)]
                counts.append(len(pieces) - n)
        else:
            found = list(map(self._pattern.findall, texts))
            counts = list(map(len, found))
            pieces = list(map(str.encode, chain.from_iterable(found)))
        ids, at = self.merge(pieces)
        if special:
            where = np.array([i for i, _ in special])
            ids = np.insert(ids, at[where], [i for _, i in special])
            at = at + np.searchsorted(where, np.arange(len(at)), side="left")
        return ids.astype(np.int32), at[np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)]

    def encode(self, text: str) -> list[int]:
        """The ids of a whole text or unit."""
        return self.encode_many([text])[0].tolist()


@lru_cache(4)
def merges(path: str) -> Merges:
    return Merges(path)


def unit_table(column: pa.Array, whole: Iterable[bytes] = ()) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Units of each text: codes, n + 1 offsets, distinct units.

    A text is cut before every white-space byte that another byte follows
    which cannot begin white space.  No token of the pattern spans such a cut
    and no look-ahead crosses it, so units encode independently.  Texts that
    hold a string of ``whole`` stay in one piece.
    """
    data, docs = text_bytes(column)
    n = len(data)
    space = SPACE[data]
    cut = np.zeros(n, bool)
    if n > 1:
        cut[:-1] = space[:-1] & ~space[1:] & ~_WIDE_SPACE[data[1:]]
    raw = data.tobytes() if whole else b""
    for mark in whole:
        at = raw.find(mark)
        while at >= 0:
            d = int(np.searchsorted(docs, at, side="right")) - 1
            cut[docs[d] : docs[d + 1]] = False
            at = raw.find(mark, max(at + 1, int(docs[d + 1])))
    # The last byte of a text never begins a unit by itself; each text's first byte always does.
    ends = docs[1:][docs[1:] > docs[:-1]] - 1
    cut[ends] = False
    cut[docs[:-1][docs[1:] > docs[:-1]]] = True
    starts = np.flatnonzero(cut)
    codes, distinct = encode(slices(data, np.append(starts, n)))
    return codes, np.searchsorted(starts, docs), distinct


class Lexicon:
    """A minimal acyclic automaton in five arrays of one file."""

    MAGIC = 0x4C455831

    def __init__(self, path: str):
        head = np.memmap(path, np.int64, "r", shape=(6,))
        if int(head[0]) != self.MAGIC:
            raise ValueError("not a lexicon")
        states, arcs, units, ids = (int(x) for x in head[1:5])
        at = 48
        take = lambda kind, n: np.memmap(path, kind, "r", offset=at, shape=(max(1, n),))
        self.key, at = take(np.int64, arcs), at + 8 * max(1, arcs)  # state * 256 + byte, ascending
        self.to, at = take(np.int32, arcs), at + 4 * max(1, arcs)
        self.before, at = take(np.int32, arcs), at + 4 * max(1, arcs)  # accepted units that sort before those behind the arc
        self.final, at = take(np.int32, states), at + 4 * max(1, states)
        self.first, at = take(np.int32, units + 1), at + 4 * (units + 1)
        self.ids = take(np.int32, ids)
        self.arcs, self.units = arcs, units

    @classmethod
    def write(cls, path: str, units: list[bytes], ids: list[np.ndarray]) -> None:
        """Compile sorted distinct units; states with equal futures become one."""
        register: dict[tuple, int] = {}
        finals: list[int] = []
        counts: list[int] = []
        arcs: list[tuple[int, int, int, int]] = []

        def freeze(node: list) -> int:
            """node: [final, [(byte, state)]]"""
            form = (node[0], tuple(node[1]))
            if form not in register:
                state = register[form] = len(finals)
                finals.append(node[0])
                total = node[0]
                for byte, to in node[1]:
                    arcs.append((state, byte, to, total))
                    total += counts[to]
                counts.append(total)
            return register[form]

        path_nodes: list[list] = [[0, []]]
        last = b""

        def close(depth: int) -> None:
            while len(path_nodes) - 1 > depth:
                state = freeze(path_nodes.pop())
                path_nodes[-1][1].append((last[len(path_nodes) - 1], state))

        for unit in units:
            shared = len(os.path.commonprefix([last, unit]))
            close(shared)
            path_nodes += [[0, []] for _ in unit[shared:]]
            path_nodes[-1][0] = 1
            last = unit
        close(0)
        root = freeze(path_nodes[0])
        n = len(finals)
        swap = np.arange(n)  # the root becomes state 0
        swap[[0, root]] = [root, 0] if n > 1 else [0, 0]
        table = np.array(arcs, np.int64).reshape(-1, 4)
        key = swap[table[:, 0]] * 256 + table[:, 1]
        order = np.argsort(key)
        final = np.zeros(n, np.int32)
        final[swap] = finals
        flat = np.concatenate([np.asarray(x, np.int32) for x in ids]) if ids else np.zeros(0, np.int32)
        first = np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype(np.int32)
        full = lambda a, kind: (a.astype(kind) if len(a) else np.zeros(1, kind)).tobytes()
        with open(path, "wb") as f:
            f.write(np.array([cls.MAGIC, n, len(arcs), len(units), len(flat), 0], np.int64).tobytes())
            f.write(full(key[order], np.int64) + full(swap[table[order, 2]], np.int32) + full(table[order, 3], np.int32) + full(final, np.int32) + first.tobytes() + full(flat, np.int32))

    def ranks(self, units: pa.Array) -> np.ndarray:
        """The rank of each unit, -1 where the lexicon lacks it; all units walk in step."""
        n = len(units)
        out = np.full(n, -1, np.int64)
        if not n or not self.arcs:
            return out
        data, at = text_bytes(units)
        length = np.diff(at)
        live = np.arange(n)
        state, rank, depth = np.zeros(n, np.int64), np.zeros(n, np.int64), 0
        while len(live):
            done = length[live] == depth
            ended = live[done & (self.final[state] == 1)]
            out[ended] = rank[done & (self.final[state] == 1)]
            live, state, rank = live[~done], state[~done], rank[~done]
            want = state * 256 + data[at[live] + depth]
            spot = np.minimum(np.searchsorted(self.key, want), self.arcs - 1)
            good = self.key[spot] == want
            live, spot = live[good], spot[good]
            state, rank, depth = self.to[spot].astype(np.int64), rank[good] + self.before[spot], depth + 1
        return out


def unit_counts(df: DataFrame, text: str, special: list[bytes]) -> DataFrame:
    """(unit binary, n long): how often each unit occurs over all texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes, _, distinct = unit_table(batch.column(0), special)
            n = np.bincount(codes, minlength=len(distinct))
            # A unit seen once in a whole batch cannot be frequent; the lexicon is a cache, so leaving it out costs no result.
            keep = n > 1
            yield pa.RecordBatch.from_arrays([distinct.cast(pa.binary()).filter(pa.array(keep)), pa.array(n[keep])], names=["unit", "n"])

    return df.select(text).mapInArrow(run, "unit binary, n long").groupBy("unit").agg(F.sum("n").alias("n"))


#: Folders of lexicons that executors may still fetch; they go when the driver ends.
_FOLDERS: list[tempfile.TemporaryDirectory] = []


def frequent_units(counts: DataFrame, size: int) -> list[bytes]:
    """At most ``size`` units, those of the largest counts; a histogram tells the least count first, so little more than them is sent."""
    # Counts up to 1,024 have a step each, larger ones 64 steps for each doubling.
    step = F.when(F.col("n") <= 1024, F.col("n")).otherwise(F.lit(1024) + F.floor((F.log2("n") - 10) * 64) + 1).cast("long")
    taken, least, room = 0, None, size
    for row in counts.groupBy(step.alias("step")).agg(F.count("*").alias("units")).orderBy(F.desc("step")).collect():
        least, room = row["step"], size - taken
        taken += row["units"]
        if taken > size:
            break
    if least is None:
        return []
    above = counts.where(step > least).select("unit").collect()
    # The last step may hold more than there is room for; the lexicon is a cache, so any of them will do.
    return [bytes(r["unit"]) for r in above + counts.where(step == least).select("unit").limit(room).collect()]


def build_lexicon(df: DataFrame, text: str, tokenizer: str, size: int = 131_072, longest: int = 48) -> str:
    """Compile the ``size`` most frequent units into a file that every executor gets; returns its name there."""
    m = merges(tokenizer)
    special = [s.encode() for s in m.special]
    units = sorted(frequent_units(stored(unit_counts(df, text, special).where(F.length("unit") <= longest), "units"), size))
    folder = tempfile.TemporaryDirectory(prefix="lexicon-")
    _FOLDERS.append(folder)
    name = f"lexicon-{uuid.uuid4().hex}.bin"
    ids, at = m.encode_many([u.decode() for u in units])
    Lexicon.write(f"{folder.name}/{name}", units, np.split(ids, at[1:-1]) if units else [])
    df.sparkSession.sparkContext.addFile(f"{folder.name}/{name}")
    return name


class Encoder:
    """Whole texts of an Arrow column to ids, through the lexicon and exact merging."""

    def __init__(self, tokenizer: str, lexicon: str | None):
        self.merges = merges(tokenizer)
        self.special = [s.encode() for s in self.merges.special]
        self.lexicon = Lexicon(lexicon) if lexicon else None

    def __call__(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids after each other, and the n + 1 offsets of the texts."""
        codes, docs, distinct = unit_table(column, self.special)
        n = len(distinct)
        rank = self.lexicon.ranks(distinct) if self.lexicon else np.full(n, -1, np.int64)
        missing = np.flatnonzero(rank < 0)
        own, own_at = self.merges.encode_many([u.decode() for u in distinct.take(pa.array(missing)).to_pylist()])
        length = np.zeros(n + 1, np.int64)
        source = np.zeros(n, np.int64)
        if self.lexicon:
            hit = rank >= 0
            source[hit] = self.lexicon.first[rank[hit]]
            length[:-1][hit] = self.lexicon.first[rank[hit] + 1] - source[hit]
        pool = [np.asarray(self.lexicon.ids)] if self.lexicon else []
        size = len(pool[0]) if pool else 0
        length[missing] = np.diff(own_at)
        source[missing] = size + own_at[:-1]
        pool.append(own)
        ids = np.concatenate(pool)
        each = length[codes]
        end = np.cumsum(each)
        total = int(end[-1]) if len(end) else 0
        at = np.repeat(source[codes] - (end - each), each) + np.arange(total)
        bounds = np.concatenate([[0], end])[docs]
        return ids[at], bounds


def encode_decode(df: DataFrame, key: str, text: str, tokenizer: str, lexicon: str | None) -> DataFrame:
    """(key, n_tokens, ids binary of little-endian uint32, decoded binary) for each text."""
    rows = df.select(F.col(key).alias("key"), F.col(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(tokenizer, SparkFiles.get(lexicon) if lexicon else None)
        for batch in batches:
            for ids, keys, at, decoded, out in coded(encoder, batch):
                yield pa.RecordBatch.from_arrays([keys, pa.array(np.diff(at)), slices(ids.astype("<u4").view(np.uint8), at * 4), slices(decoded, out)], names=["key", "n_tokens", "ids", "decoded"])

    return rows.mapInArrow(run, f"key {rows.schema['key'].dataType.simpleString()}, n_tokens long, ids binary, decoded binary").withColumnRenamed("key", key)


def coded(encoder: Encoder, batch: pa.RecordBatch, most: int = 1 << 23) -> Iterator[tuple]:
    """Ids and decoded bytes of a batch, in runs of about ``most`` bytes of text."""
    tokens = pa.array(encoder.merges.tokens, pa.binary())
    width = np.fromiter(map(len, encoder.merges.tokens), np.int64, len(tokens))
    _, docs = text_bytes(batch.column(1))
    a = 0
    while a < len(batch):
        b = max(a + 1, int(np.searchsorted(docs, docs[a] + most)))
        ids, at = encoder(batch.column(1).slice(a, b - a))
        decoded = text_bytes(tokens.take(pa.array(ids)))[0] if len(ids) else np.zeros(0, np.uint8)
        out = np.concatenate([[0], np.cumsum(width[ids])])[at]
        yield ids, batch.column(0).slice(a, b - a), at, decoded, out
        a = b


def encode_decode_digests(df: DataFrame, key: str, text: str, tokenizer: str, lexicon: str | None) -> DataFrame:
    """(key, n_tokens, ids_sha256, decoded_sha256): as ``encode_decode``, digested where it is made."""
    rows = df.select(F.col(key).alias("key"), F.col(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(tokenizer, SparkFiles.get(lexicon) if lexicon else None)
        sha = lambda raw, at: pa.array([hashlib.sha256(raw[a:b]).hexdigest() for a, b in zip(at[:-1], at[1:], strict=True)], pa.string())
        for batch in batches:
            for ids, keys, at, decoded, out in coded(encoder, batch):
                lossy = [decoded[a:b].tobytes().decode("utf-8", "replace").encode() for a, b in zip(out[:-1], out[1:], strict=True)]
                yield pa.RecordBatch.from_arrays([keys, pa.array(np.diff(at)), sha(memoryview(ids.astype("<u4").view(np.uint8)), at * 4), pa.array([hashlib.sha256(x).hexdigest() for x in lossy], pa.string())], names=["key", "n_tokens", "ids_sha256", "decoded_sha256"])

    return rows.mapInArrow(run, f"key {rows.schema['key'].dataType.simpleString()}, n_tokens long, ids_sha256 string, decoded_sha256 string").withColumnRenamed("key", key)
