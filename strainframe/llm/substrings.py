"""Exact removal of word windows that occur more than once, by level-wise doubling.

Windows are judged at growing lengths, each about twice the last: 9 words, 18,
then 35, by default.  At the first length every window of a text long enough
is asked about.  A window goes to the next length only if both its ends, the
windows of the last length at its begin and at its end, were repeated; this
ends at the full length, or where no candidate survives.  Words under repeated
full windows are removed.

Short windows meet by hashes of 64 bits, which can only keep a candidate too
many; full ones are judged by 128 bits.

Defined cases: a null text has no words; a text shorter than a window is never
cut (but its words are joined by single spaces like any other's); repeated
rows are copies of each other; texts are taken whole; an empty table gives an
empty table; carried columns may have any names, those of the results too.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from .exchange import ASK, REPLY, answered, asks, chunked, frugal, column_of, in_order, replies
from .shared import stored
from .units import SPACE, mix, pair_hash, text_bytes, word_hashes

def lengths_to(window: int, first: int) -> list[int]:
    """The lengths judged: halves of the window down to about ``first``."""
    out = [window]
    while -(-out[0] // 2) >= first and out[0] > 1:
        out.insert(0, -(-out[0] // 2))
    return out


def window_hashes(words: np.ndarray, length: int) -> np.ndarray:
    """Hashes of the windows of ``length`` words that begin at each word, by doubling."""
    out, size = words, 1
    while size * 2 <= length and len(out):
        out = pair_hash(out[: len(out) - size], out[size:]) if len(out) > size else out[:0]
        size *= 2
    if size < length:
        rest = length - size
        out = pair_hash(out[: len(out) - rest], out[rest:]) if len(out) > rest else out[:0]
    return out


def wide_hashes(words: np.ndarray, length: int, at: np.ndarray) -> np.ndarray:
    """128-bit hashes, as two words, of the windows that begin at these places."""
    other = mix(words + np.uint64(0x2545F4914F6CDD1D))
    return np.stack([window_hashes(words, length)[at], window_hashes(other, length)[at]], axis=1)


def distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct keys of one or two words, the place of each key among them, and their numbers."""
    if keys.ndim == 1:
        return np.unique(keys, return_inverse=True, return_counts=True)
    order = np.lexsort((keys[:, 1], keys[:, 0]))
    own = keys[order]
    fresh = np.append(True, (own[1:] != own[:-1]).any(axis=1)) if len(own) else np.zeros(0, bool)
    place = np.empty(len(own), np.int64)
    place[order] = np.cumsum(fresh) - 1
    return own[fresh], place, np.bincount(place, minlength=int(fresh.sum()))


class Windows:
    """The windows of one chunk, as far as answers have come."""

    def __init__(self, column: pa.ChunkedArray, window: int, first: int):
        self.lengths, self.window = lengths_to(window, first), window
        self.words, self.first = word_hashes(column)
        size = np.diff(self.first)
        self.end = np.repeat(self.first[1:], size)
        place = np.arange(len(self.words))
        self.open = np.repeat(size >= window, size) & (place + self.lengths[0] <= self.end)

    def questions(self, level: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct keys, whether each stands at several places here, and the place of each open window's key among them."""
        length, at = self.lengths[level], np.flatnonzero(self.open)
        if length == self.window:
            own = wide_hashes(self.words, length, at) if len(at) else np.zeros((0, 2), np.uint64)
        else:
            own = window_hashes(self.words, length)[at] if len(at) else np.zeros(0, np.uint64)
        keys, place, n = distinct(own)
        return keys, (n > 1).astype(np.uint8), place

    def settle(self, level: int, repeated: np.ndarray) -> None:
        """Keep repeated windows; those of the next length begin where both ends are kept."""
        keys, _, place = self.questions(level)
        if len(keys) != len(repeated):
            raise ValueError(f"{len(repeated)} answers for {len(keys)} keys")
        self.open[self.open] = repeated[place] > 0
        if level + 1 < len(self.lengths):
            further = self.lengths[level + 1] - self.lengths[level]
            both = np.zeros_like(self.open)
            both[: len(both) - further] = self.open[: len(both) - further] & self.open[further:]
            self.open = both & (np.arange(len(both)) + self.lengths[level + 1] <= self.end)

    def covered(self) -> np.ndarray:
        """The words under windows that are still open."""
        edge = np.zeros(len(self.words) + 1, np.int32)
        at = np.flatnonzero(self.open)
        edge[at] += 1
        edge[at + self.window] -= 1
        return np.cumsum(edge[:-1]) > 0


def asking(level: int, window: int, first: int, buckets: int):
    def ask(key: tuple, docs: pa.Table, told: pa.Table | None = None) -> pa.Table:
        docs = in_order(docs)
        w = Windows(docs["text"], window, first)
        for done in range(level):
            w.settle(done, answered(told, done, np.uint8))
        keys, several, _ = w.questions(level)
        return asks(key[0].as_py(), keys, several, buckets)

    if level == 0:
        return lambda key, docs: ask(key, docs)
    return lambda key, docs, told: ask(key, docs, told)


def judging(level: int, wide: bool):
    def judge(table: pa.Table) -> pa.Table:
        parts, several = column_of(table, "keys", np.uint64), column_of(table, "extra", np.uint8)
        keys = np.concatenate(parts)
        _, place, n = distinct(keys.reshape(-1, 2) if wide else keys)
        flag = (n > 1) | (np.bincount(place, np.concatenate(several), len(n)) > 0)
        answer = flag[place].astype(np.uint8)
        return replies(table, level, np.split(answer, np.cumsum([len(x) for x in several])[:-1]))

    return judge


def joined_words(column: pa.ChunkedArray, keep: np.ndarray, first: np.ndarray) -> pa.Array:
    """The kept words of each text, joined by single spaces."""
    data, docs = text_bytes(column)
    inside = ~SPACE[data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    heads = docs[:-1][docs[:-1] < docs[1:]]
    begins[heads] = inside[heads]
    starts = np.cumsum(inside, dtype=np.int64)[begins] - 1
    lengths = np.diff(starts, append=int(inside.sum()))
    kept = data[inside][np.repeat(keep, lengths)]
    lengths = lengths[keep]
    out = np.full(len(kept) + len(lengths), 32, np.uint8)
    out[np.arange(len(kept)) + np.repeat(np.arange(len(lengths)), lengths)] = kept
    at = np.concatenate([[0], np.cumsum(lengths + 1)])
    bounds = np.concatenate([[0], np.cumsum(keep)])[first]
    raw = out.tobytes()
    return pa.array([raw[at[a] : at[b] - 1].decode() if b > a else "" for a, b in zip(bounds[:-1], bounds[1:], strict=True)], pa.string())


def without_repeats(df: DataFrame, key: str, text: str, window: int = 35, first: int = 9, carry: list[str] | None = None, keep_clean: bool = False, counts: tuple[str, str] = ("n_words", "n_removed")) -> DataFrame:
    """(key, text of the kept words, numbers of words and of removed ones, carried columns), one row for each row of ``df``.

    With ``keep_clean``, texts that lose no word stay as they are, white space
    included.  ``counts`` names the two numbers.
    """
    carry = carry or []
    table = chunked(df, key, text, carry)
    docs, slim = table.table, table.table.select("chunk", "doc_id", "text")
    buckets = max(12, table.n // 2)
    lengths, told = lengths_to(window, first), None
    for level in range(len(lengths)):
        ask = frugal(asking(level, window, first, buckets), level > 0)
        grouped = slim.groupBy("chunk")
        asked = grouped.applyInArrow(ask, ASK) if told is None else grouped.cogroup(told.groupBy("chunk")).applyInArrow(ask, ASK)
        answers = stored(asked.groupBy("bucket").applyInArrow(judging(level, level + 1 == len(lengths)), REPLY), "answers")
        told = answers if told is None else told.unionByName(answers)

    def finish(_: tuple, docs: pa.Table, told: pa.Table) -> pa.Table:
        docs = in_order(docs)
        w = Windows(docs["text"], window, first)
        for level in range(len(w.lengths)):
            w.settle(level, answered(told, level, np.uint8))
        gone = w.covered()
        removed = np.diff(np.concatenate([[0], np.cumsum(gone)])[w.first])
        n, size = np.diff(w.first), len(docs)
        text = joined_words(docs["text"], ~gone, w.first)
        del w, gone
        if keep_clean:
            text = pc.if_else(pa.array(removed == 0), docs["text"].combine_chunks().cast(pa.string()), text)
        out = docs.drop_columns(["chunk", "text"])
        return out.append_column("text", text).append_column("n_words", pa.array(n)).append_column("n_removed", pa.array(removed)) if size else out

    fields = [f"{f.name} {f.dataType.simpleString()}" for f in docs.schema if f.name not in ("chunk", "text")]
    out = docs.groupBy("chunk").cogroup(told.groupBy("chunk")).applyInArrow(frugal(finish, True), ", ".join([*fields, "text string, n_words long, n_removed long"]))
    names = {"doc_id": key, "text": text, "n_words": counts[0], "n_removed": counts[1]} | {f"c_{i}": c for i, c in enumerate(carry)}
    return out.toDF(*(names[c] for c in out.columns))
