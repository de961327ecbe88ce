"""Aligning two tokenizers' tokens over the same bytes.

A text's tokens by a byte-level BPE (A) and by a piece model (B) are laid over
the bytes of space + text.  B's tokens are a static index of intervals, sorted
by where they begin and end; two bisections for each A token stab it and give
the run of B tokens that overlap it.  Byte positions that no token of either
side spans cut both into groups, the smallest spans that both split alike.

Corpus-wide counts of id pairs need one round of aggregation: chunks of
documents keep their distinct pairs, sums come from a plain ``groupBy`` over
(chunk, pair) rows, and go back to the chunks that asked.

Defined cases: texts null, empty, or not spelled back by both tokenizers (the
piece model writes a space for U+2581) have no tokens, zero counts and the
digest ''; strings of special tokens are plain text; texts are taken whole
whatever their length; repeated rows and null ids are kept, and count as often
as they occur; an empty table gives an empty one; further columns have no
effect.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe import PATTERN, merges, unit_table
from .exchange import RUN_BITS, frugal, give_back, packed, unpacked
from .shared import stored
from .units import encode, runs, slices, text_bytes

#: Bytes of text that are aligned at once; a longer text is taken by itself.
STEP = 2 << 20


def ragged(lists: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """Lists as one array and its n + 1 offsets."""
    at = np.concatenate([[0], np.cumsum(np.fromiter(map(len, lists), np.int64, len(lists)))]).astype(np.int64)
    flat = np.fromiter((i for ids in lists for i in ids), np.int64, int(at[-1]))
    return flat, at


def spread(codes: np.ndarray, first: np.ndarray, flat: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts from those of their distinct units, and the offsets of the texts."""
    each = np.diff(at)[codes]
    end = np.cumsum(each)
    total = int(end[-1]) if len(end) else 0
    place = np.repeat(at[:-1][codes] - (end - each), each) + np.arange(total)
    return flat[place], np.concatenate([[0], end]).astype(np.int64)[first]


class ByteTokens:
    """Ids of a byte-level BPE; each distinct unit of a column is merged once."""

    def __init__(self, path: str):
        table = merges(path)
        by_rank = sorted(table.rank, key=table.rank.get)
        ids = [table.ids[a + b] for a, b in by_rank]
        # The merging library ranks by id, so ids must ascend as merges do.
        self.fast = tiktoken.Encoding("bytes", pat_str=PATTERN, mergeable_ranks=table.ids, special_tokens={}) if ids == sorted(ids) and len(table.byte_id) == 256 and table.byte_id.min() >= 0 else None
        self.table, self.tokens = table, pa.array(table.tokens, pa.binary())

    def __call__(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        codes, first, distinct = unit_table(column)
        units = [u.decode() for u in distinct.to_pylist()]
        if self.fast:
            flat, at = ragged([self.fast.encode_ordinary(u) for u in units])
        else:
            pieces = [self.table._pattern.findall(u) for u in units]
            flat, ends = self.table.merge([p.encode() for u in pieces for p in u])
            flat, at = flat.astype(np.int64), ends[np.concatenate([[0], np.cumsum([len(u) for u in pieces])]).astype(np.int64)]
        return spread(codes, first, flat, at)


class PieceTokens:
    """Ids of a piece model over texts that begin with a space, which stands for the one that the model adds.

    Texts are cut before each space that follows another character: no piece
    spans such a place (the constructor looks), so each distinct unit is
    encoded once.
    """

    def __init__(self, path: str):
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        self.space = [self.model.piece_to_id("▁")]
        self.cuts = not any("▁" in p.lstrip("▁") for p in pieces)
        self.tokens = pa.array([bytes([int(p[3:5], 16)]) if self.model.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)], pa.binary())

    def __call__(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        data, docs = text_bytes(column)
        cut = np.zeros(len(data), bool)
        if self.cuts and len(data) > 1:
            cut[1:] = (data[1:] == 32) & (data[:-1] != 32)
        cut[docs[:-1][docs[:-1] < docs[1:]]] = True
        starts = np.flatnonzero(cut)
        codes, distinct = encode(slices(data, np.append(starts, len(data))))
        units = [u.decode()[1:] for u in distinct.to_pylist()]
        # A space alone is the one that the model adds, which it leaves out of an empty text.
        flat, at = ragged([ids or self.space for ids in self.model.encode(units, num_threads=1)] if units else [])
        return spread(codes, np.searchsorted(starts, docs), flat, at)


@lru_cache(4)
def tokenizers(a: str, b: str) -> tuple[ByteTokens, PieceTokens]:
    return ByteTokens(a), PieceTokens(b)


def widths(tokens: pa.Array) -> np.ndarray:
    return pc.binary_length(tokens).to_numpy(zero_copy_only=False).astype(np.int64)


@dataclass
class Laid:
    """Both tokenizers' tokens of several texts; only texts that both spell back have any."""

    a: np.ndarray  # ids
    a_first: np.ndarray  # offsets of the texts
    b: np.ndarray
    b_first: np.ndarray
    a_end: np.ndarray  # bytes, counted over all texts
    b_end: np.ndarray

    def overlaps(self) -> tuple[np.ndarray, np.ndarray]:
        """Places of A and B tokens that overlap, by A token and then by B token."""
        a_begin = np.concatenate([[0], self.a_end[:-1]])
        b_begin = np.concatenate([[0], self.b_end[:-1]])
        first = np.searchsorted(self.b_end, a_begin, side="right")
        n = np.searchsorted(b_begin, self.a_end, side="left") - first
        end = np.cumsum(n)
        place = np.repeat(first - (end - n), n) + np.arange(int(end[-1]) if len(end) else 0)
        return np.repeat(np.arange(len(n)), n), place

    def group_ends(self) -> tuple[np.ndarray, np.ndarray]:
        """Which A and which B tokens are the last of a group: those that end where one of the other side ends."""
        spot = np.searchsorted(self.b_end, self.a_end)
        spot_a = np.searchsorted(self.a_end, self.b_end)
        return self.b_end[np.minimum(spot, max(len(self.b) - 1, 0))] == self.a_end if len(self.b) else np.zeros(0, bool), self.a_end[np.minimum(spot_a, max(len(self.a) - 1, 0))] == self.b_end if len(self.a) else np.zeros(0, bool)


def laid(column: pa.Array, a: ByteTokens, b: PieceTokens) -> Laid:
    """Tokens of space + text for each text of a string column."""
    texts = pc.fill_null(column.cast(pa.large_string()), "")
    spaced = pc.binary_join_element_wise(pa.scalar("", pa.large_string()), texts, pa.scalar(" ", pa.large_string()))
    data, docs = text_bytes(spaced)
    found = []
    whole = np.diff(docs) > 1
    for side in (a, b):
        ids, first = side(spaced)
        said, width = text_bytes(side.tokens.take(pa.array(ids)))[0] if len(ids) else np.zeros(0, np.uint8), widths(side.tokens)
        ends = np.concatenate([[0], np.cumsum(width[ids])])
        cut = ends[first]
        if not (len(said) == len(data) and np.array_equal(cut, docs) and np.array_equal(said, data)):
            whole &= np.array([data[p:q].tobytes() == said[r:s].tobytes() for p, q, r, s in zip(docs[:-1], docs[1:], cut[:-1], cut[1:], strict=True)], bool)
        found.append((ids, first, width))
    out = []
    for ids, first, width in found:
        n = np.where(whole, np.diff(first), 0)
        ids = ids[np.repeat(whole, np.diff(first))]
        out += [ids, np.concatenate([[0], np.cumsum(n)]).astype(np.int64), np.cumsum(width[ids])]
    return Laid(out[0], out[1], out[3], out[4], out[2], out[5])


@lru_cache(4)
def _written(n: int, plain: str, last: str) -> pa.Array:
    """Each id in decimal, followed by one of two signs."""
    return pa.array([f"{i}{plain}" for i in range(n)] + [f"{i}{last}" for i in range(n)], pa.binary())


def spelled_groups(x: Laid, n_a: int, n_b: int) -> tuple[memoryview, np.ndarray]:
    """``a1,a2|b1;a3|b2,b3;`` for all texts after each other, and the n + 1 offsets of the texts."""
    a_last, b_last = x.group_ends()
    a_group = np.cumsum(a_last) - a_last
    b_group = np.cumsum(b_last) - b_last
    groups = int(a_last.sum())
    b_before = np.concatenate([[0], np.cumsum(np.bincount(b_group, minlength=groups))])
    a_until = np.cumsum(np.bincount(a_group, minlength=groups))
    codes = np.empty(len(x.a) + len(x.b), np.int64)
    codes[np.arange(len(x.a)) + b_before[a_group]] = x.a + n_a * a_last
    codes[np.arange(len(x.b)) + a_until[b_group]] = x.b + n_b * b_last + 2 * n_a
    words = pa.concat_arrays([_written(n_a, ",", "|"), _written(n_b, ",", ";")])
    raw, at = text_bytes(words.take(pa.array(codes))) if len(codes) else (np.zeros(0, np.uint8), np.zeros(1, np.int64))
    return memoryview(np.ascontiguousarray(raw)), at[x.a_first + x.b_first]


def grouped(df: DataFrame, key: str, text: str, a: str, b: str) -> DataFrame:
    """One row for each group: key, its place in the text, the bytes of space + text that it covers, ids of either side."""
    rows = df.select(F.col(key).alias("key"), F.col(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sides = tokenizers(a, b)
        for batch in batches:
            for p, q in runs(text_bytes(batch.column(1))[1], STEP):
                x = laid(batch.column(1).slice(p, q - p), *sides)
                a_last, b_last = x.group_ends()
                a_at, b_at = (np.concatenate([[0], np.flatnonzero(last) + 1]).astype(np.int32) for last in (a_last, b_last))
                ends = np.concatenate([[0], x.a_end[a_last]])
                before = np.concatenate([[0], np.cumsum(a_last)])[x.a_first]
                n = np.diff(before)
                doc = np.repeat(np.arange(q - p), n)
                began = ends[before[:-1]]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(p, q - p).take(pa.array(doc)), pa.array(np.arange(len(doc)) - before[doc]), pa.array(ends[:-1] - began[doc]), pa.array(ends[1:] - began[doc]), pa.ListArray.from_arrays(pa.array(a_at), pa.array(x.a.astype(np.int32))), pa.ListArray.from_arrays(pa.array(b_at), pa.array(x.b.astype(np.int32)))],
                    names=["key", "group", "first_byte", "end_byte", "a_ids", "b_ids"],
                )
            give_back()

    kind = rows.schema["key"].dataType.simpleString()
    return rows.mapInArrow(run, f"key {kind}, group long, first_byte long, end_byte long, a_ids array<int>, b_ids array<int>").withColumnRenamed("key", key)


_COUNTS = ("n_a", "n_b", "n_groups", "n_links")


def chunks(df: DataFrame, key: str, text: str, a: str, b: str) -> DataFrame:
    """One row for each few megabytes of text: what each document has, the distinct id pairs that its links hold, and which document holds which how often."""
    rows = df.select(F.col(key).alias("key"), F.col(text).alias("text"))
    kind = rows.schema["key"].dataType.simpleString()

    def aligned(chunk: int, batch: pa.RecordBatch, sides: tuple[ByteTokens, PieceTokens]) -> pa.RecordBatch:
        x = laid(batch.column(1), *sides)
        raw, at = spelled_groups(x, *(len(s.tokens) for s in sides))
        shas = [hashlib.sha256(raw[p : q - 1]).hexdigest() if q > p else "" for p, q in zip(at[:-1], at[1:], strict=True)]
        from_a, from_b = x.overlaps()
        doc = np.repeat(np.arange(len(batch)), np.diff(x.a_first))
        codes, names = encode(pa.array((x.b[from_b] << 32) | x.a[from_a]))
        held = names.to_numpy()
        order = np.argsort(held)
        rank = np.empty(len(held), np.int64)
        rank[order] = np.arange(len(held))
        each, times = np.unique(doc[from_a] * np.int64(max(len(held), 1)) + rank[codes], return_counts=True)
        owner, pair = np.divmod(each, np.int64(max(len(held), 1)))
        made = {
            "n_a": np.diff(x.a_first), "n_b": np.diff(x.b_first),
            "n_groups": np.diff(np.concatenate([[0], np.cumsum(x.group_ends()[0])])[x.a_first]),
            "n_links": np.bincount(doc[from_a], minlength=len(batch)),
        }
        one = lambda values: pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)
        columns = [pa.array([chunk]), one(batch.column(0)), *(one(pa.array(made[c], pa.int64())) for c in _COUNTS), one(pa.array(shas, pa.string()))]
        columns += [one(pa.array(held[order])), one(pa.array(np.bincount(codes, minlength=len(held))[order])), pa.array([packed(np.bincount(owner, minlength=len(batch)).astype(np.uint32), pair.astype(np.uint32), times.astype(np.uint32))], pa.binary())]
        return pa.RecordBatch.from_arrays(columns, names=["chunk", "keys", *_COUNTS, "shas", "pairs", "times", "held"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sides, chunk = tokenizers(a, b), TaskContext.get().partitionId() << RUN_BITS
        waiting: list[pa.RecordBatch] = []
        size = 0
        for batch in batches:
            _, docs = text_bytes(batch.column(1))
            for p, q in runs(docs, STEP):
                waiting.append(batch.slice(p, q - p))
                size += int(docs[q] - docs[p])
                if size >= STEP:
                    yield aligned(chunk, pa.Table.from_batches(waiting).combine_chunks().to_batches()[0], sides)
                    waiting, size, chunk = [], 0, chunk + 1
                    give_back()
        some = pa.Table.from_batches(waiting).combine_chunks().to_batches() if waiting else []
        for batch in some:
            yield aligned(chunk, batch, sides)
            chunk += 1

    lists = ", ".join(f"{c} array<long>" for c in _COUNTS)
    return rows.mapInArrow(run, f"chunk long, keys array<{kind}>, {lists}, shas array<string>, pairs array<long>, times array<long>, held binary")


def aligned_digests(df: DataFrame, key: str, text: str, a: str, b: str) -> DataFrame:
    """For each text: its key, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256."""
    kind = df.schema[key].dataType.simpleString()
    table = stored(chunks(df, key, text, a, b), "aligned")
    asked = table.select(F.col("chunk").alias("home"), F.inline(F.arrays_zip("pairs", "times"))).withColumnRenamed("pairs", "pair")
    totals = stored(asked.groupBy("pair").agg(F.sum("times").alias("total")), "pair-counts")
    side = F.shiftright("pair", 32)
    # One row for each id of B's vocabulary at most, so this side is bounded by the tokenizer.
    best = totals.groupBy(side.alias("b")).agg(F.max("total").alias("most"))
    marked = totals.join(F.broadcast(best), side == F.col("b")).select("pair", "total", (F.col("total") == F.col("most")).alias("best"))
    answers = asked.join(marked, "pair").select("home", "pair", "total", "best")

    def told(_key: tuple, rows: pa.Table, known: pa.Table) -> pa.Table:
        known = known.sort_by("pair")
        total, best = known["total"].to_numpy(), known["best"].to_numpy()
        n, pair, times = unpacked(rows["held"].chunk(0)[0].as_buffer())
        first = np.concatenate([[0], np.cumsum(n)]).astype(np.int64)
        pair, times = pair.astype(np.int64), times.astype(np.int64)
        lists = {c: rows[c].chunk(0).flatten() for c in ("keys", *_COUNTS, "shas")}
        counted = [exact_sums(times * best[pair], first), exact_sums(times * total[pair], first)]
        return pa.table({"key": lists["keys"], **{c: lists[c] for c in _COUNTS}, "n_best": pa.array(counted[0]), "count_sum": pa.array(counted[1]), "groups_sha256": lists["shas"]})

    counts = ", ".join(f"{c} long" for c in (*_COUNTS, "n_best", "count_sum"))
    kept = table.select("chunk", "keys", *_COUNTS, "shas", "held")
    return kept.groupBy("chunk").cogroup(answers.groupBy("home")).applyInArrow(frugal(told, cogrouped=True), f"key {kind}, {counts}, groups_sha256 string").withColumnRenamed("key", key)


def exact_sums(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """The sum of each run of 64-bit integers."""
    return np.diff(np.concatenate([[0], np.cumsum(values, dtype=np.int64)])[first])
