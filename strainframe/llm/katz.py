"""Katz backoff over pairs of words, with Good-Turing discounts.

Training counts live in tables partitioned by kind, in rows by bucket: single tokens,
and pairs by the hash of their context (a context of very many tokens is
spread over several buckets).  A token's probability is found by recursion:

    p(w | u) = d(r) r / C(u)                     if the pair stands r > 0 times
             = a(u) p(w)                         else
    p(w)     = d1(c) c / N                       if the token stands c > 0 times
             = what those leave                  else (all unknown words together)

d(r) are Good-Turing discounts for r up to ``k``, 1 beyond.  a(u) is exactly
(1 - sum of the first line over seen w) / (1 - sum of p(w) over seen w), so the
probabilities of all known tokens and the unknown one sum to 1.  A context
whose counts all lie beyond ``k`` gets one count more in its denominator, so
that it too leaves something.  The first token's context is the text's start.

Defined cases: a null or empty text is its end alone; unknown words are one
class; without training texts every token has probability 1 and N is 0;
repeated rows count as often as they occur; texts are taken whole.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .exchange import ASK, asks, chunked, column_of, frugal, packed, unpacked
from .shared import buckets_for, stored
from .units import mix, word_hashes

END = np.uint64(0xE17D0F7E37)
START = np.uint64(2**63 - 1)
TOLD = "kind string, chunk long, level int, bucket int, answer binary, stats array<bigint>"
PER_BUCKET = 1_500_000


def discounts(n: np.ndarray) -> np.ndarray:
    """d(1) to d(k) from the numbers of things seen once, twice, ..., k + 1 times; each above 0 and below 1.

    Where Good-Turing has no such answer (a number is 0, or the counts rise),
    absolute discounting takes its place.
    """
    k = len(n) - 1
    r = np.arange(1, k + 1)
    n = n.astype(np.float64)
    if (n > 0).all():
        common = (k + 1) * n[k] / n[0]
        d = ((r + 1) * n[1:] / (r * n[:-1]) - common) / (1 - common) if common != 1 else np.zeros(k)
        if ((d > 0) & (d < 1)).all():
            return d
    off = n[0] / (n[0] + 2 * n[1]) if n[0] > 0 else 0.5
    return (r - min(max(off, 0.05), 0.95)) / r


@dataclass
class Singles:
    """Probabilities of single tokens by their counts."""

    total: int  # N
    types: int  # V
    discount: np.ndarray

    left: float = 1.0
    size: float = 1.0

    @classmethod
    def of(cls, total: int, types: int, by_count: np.ndarray) -> Singles:
        """by_count: the numbers of types seen 1 to k + 1 times."""
        d = discounts(by_count)
        lost = float(((1 - d) * by_count[:-1] * np.arange(1, len(d) + 1)).sum())
        # Without a rare type nothing would be left for unknown words: one count more.
        size = total if lost > 0 else total + 1
        return cls(total, types, d, (lost if lost > 0 else 1.0) / size if size else 1.0, float(max(size, 1)))

    def p(self, counts: np.ndarray) -> np.ndarray:
        d = np.ones(len(counts))
        few = (counts > 0) & (counts <= len(self.discount))
        d[few] = self.discount[counts[few].astype(np.int64) - 1]
        return np.where(counts > 0, d * counts / self.size, self.left)

    def base(self, counts: np.ndarray) -> np.ndarray:
        return np.log10((counts + 1.0) / (self.total + 1 * (self.types + 1)))


class Tokens:
    """A chunk's documents in a fixed order, as places in their sorted distinct token hashes."""

    def __init__(self, docs: pa.Table):
        self.docs = docs.sort_by([("doc_id", "ascending"), ("text", "ascending")]).combine_chunks()
        words, first = word_hashes(self.docs["text"], lower=True)
        n = len(first) - 1
        self.first = first + np.arange(n + 1)
        stream = np.empty(len(words) + n, np.uint64)
        ends = self.first[1:] - 1
        inner = np.ones(len(stream), bool)
        inner[ends] = False
        stream[inner], stream[ends] = words, END
        self.keys, self.codes = np.unique(stream, return_inverse=True)
        learn = self.docs["c_0"].fill_null(False).to_numpy()
        self.learn = np.repeat(learn, np.diff(self.first))

    def counts(self) -> np.ndarray:
        return np.bincount(self.codes[self.learn], minlength=len(self.keys)).astype(np.uint32)

    def pairs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Distinct (context, word) as places, training counts, and each token's place among them; context -1 is the start."""
        n = len(self.keys)
        context = np.empty_like(self.codes)
        context[1:] = self.codes[:-1]
        context[self.first[:-1]] = n
        pair, place = np.unique(context.astype(np.int64) * (n + 1) + self.codes, return_inverse=True)
        count = np.bincount(place[self.learn], minlength=len(pair)).astype(np.uint32)
        return pair // (n + 1), pair % (n + 1), count, place


def told_singles(tokens: Tokens, told: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """The id and training count of each distinct token."""
    import pyarrow.compute as pc

    own = told.filter(pc.equal(told["level"], 1)).sort_by("bucket")
    ids, counts = [], []
    for bucket, raw in zip(own["bucket"].to_pylist(), own["answer"].to_pylist(), strict=True):
        place, count = unpacked(raw)
        ids.append((np.uint64(bucket) << np.uint64(32)) | place.astype(np.uint64))
        counts.append(count)
    if not ids:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    ids, counts = np.concatenate(ids), np.concatenate(counts)
    if len(ids) != len(tokens.keys):
        raise ValueError("answers and tokens differ in number")
    return ids, counts


def dealt(context: np.ndarray, context_count: np.ndarray, word: np.ndarray, share: float, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """The bucket of each pair, and whether its context is spread over several."""
    parts = np.maximum(np.ceil(context_count / share), 1).astype(np.uint64)
    part = (mix(word + np.uint64(1)) >> np.uint64(16)) % parts
    key = mix(context ^ (part * np.uint64(0x9E3779B97F4A7C15)))
    return ((key >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64), parts > 1


class Pairs:
    """A chunk's distinct pairs in the order of the questions about them."""

    def __init__(self, docs: pa.Table, told: pa.Table, starts: int, share: float, buckets: int):
        self.tokens = Tokens(docs)
        self.ids, self.counts = told_singles(self.tokens, told)
        context, word, self.count, self.place = self.tokens.pairs()
        ids, counts = np.append(self.ids, START), np.append(self.counts, np.uint64(starts))
        self.context, self.context_count = ids[context], counts[context]
        self.word, self.word_count = ids[word], counts[word]
        bucket, self.spread = dealt(self.context, self.context_count, self.word, share, buckets)
        self.order = np.argsort(bucket, kind="stable")  # pairs of a context stay together
        self.bucket = bucket[self.order]
        self.which, self.start = np.unique(self.bucket, return_index=True)
        self.end = np.append(self.start, len(self.bucket))[1:]


def heads(values: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.append(True, values[1:] != values[:-1])) if len(values) else np.zeros(0, np.int64)


def ask_singles(buckets: int):
    def ask(key: tuple, docs: pa.Table) -> pa.Table:
        t = Tokens(docs)
        out = asks(key[0].as_py(), t.keys, t.counts(), buckets)
        return out

    return ask


def tell_singles(k: int):
    """Totals of one bucket's tokens, answers to all who asked, and the bucket's part of the statistics."""

    def tell(table: pa.Table) -> pa.Table:
        parts, extra = column_of(table, "keys", np.uint64), column_of(table, "extra", np.uint32)
        distinct, place = np.unique(np.concatenate(parts), return_inverse=True)
        total = np.bincount(place, np.concatenate(extra), len(distinct)).astype(np.int64)
        bucket, cuts = table["bucket"][0].as_py(), np.cumsum([len(p) for p in parts])[:-1]
        rows = [("reply", chunk, 1, bucket, packed(own.astype(np.uint32), total[own].astype(np.uint64)), None) for chunk, own in zip(table["chunk"].to_pylist(), np.split(place, cuts), strict=True)]
        seen = total[total > 0]
        stats = [int(seen.sum()), len(seen), *(int((seen == r).sum()) for r in range(1, k + 2))]
        rows.append(("single", -1, 1, bucket, packed(distinct[total > 0], seen), stats))
        return told_table(rows)

    return tell


def told_table(rows: list[tuple]) -> pa.Table:
    kinds = [pa.string(), pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.list_(pa.int64())]
    return pa.table([pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds)], names=["kind", "chunk", "level", "bucket", "answer", "stats"])


def ask_pairs(starts: int, share: float, buckets: int):
    def ask(key: tuple, docs: pa.Table, told: pa.Table) -> pa.Table:
        p = Pairs(docs, told, starts, share, buckets)
        keys = []
        for a, b in zip(p.start, p.end, strict=True):
            own = p.order[a:b]
            context = p.context[own]
            head = heads(context)
            keys.append(packed(context[head], np.diff(np.append(head, len(own))).astype(np.uint32), p.word[own], p.word_count[own], p.count[own], p.spread[own][head].astype(np.uint8)))
        n = len(keys)
        return pa.table({"bucket": pa.array(p.which, pa.int32()), "chunk": pa.array([key[0].as_py()] * n, pa.int64()), "keys": pa.array(keys, pa.binary()), "extra": pa.array([b""] * n, pa.binary())})

    return ask


def tell_pairs(k: int, singles: Singles):
    """Totals of one bucket's pairs; answers hold each pair's count, and for contexts of unseen pairs what their weight needs."""

    def tell(table: pa.Table) -> pa.Table:
        asked = [unpacked(x) for x in table["keys"].to_pylist()]
        context = np.concatenate([np.repeat(a[0], a[1]) for a in asked])
        word = np.concatenate([a[2] for a in asked])
        order = np.lexsort((word, context))
        c, w = context[order], word[order]
        fresh = np.append(True, (c[1:] != c[:-1]) | (w[1:] != w[:-1]))
        place = np.empty(len(order), np.int64)
        place[order] = np.cumsum(fresh) - 1
        total = np.bincount(place, np.concatenate([a[4] for a in asked]), int(fresh.sum())).astype(np.int64)
        c, w = c[fresh], w[fresh]
        p = singles.p(np.concatenate([a[3] for a in asked])[order][fresh])
        own_context = np.cumsum(np.append(True, c[1:] != c[:-1])) - 1
        seen = total > 0
        n = int(own_context[-1]) + 1
        # For each context: numbers of words seen 1 to k times, counts beyond, and the single-token mass of seen words.
        facts = np.stack([np.bincount(own_context[total == r], minlength=n) for r in range(1, k + 1)] + [np.bincount(own_context[total > k], total[total > k], n), np.bincount(own_context[seen], p[seen], n)], axis=1).astype(np.float64)
        full = facts[:, :k].sum(axis=1) == 0
        rows, at = [], 0
        bucket = table["bucket"][0].as_py()
        for chunk, a in zip(table["chunk"].to_pylist(), asked, strict=True):
            own = place[at : at + len(a[2])]
            at += len(own)
            count, head = total[own], np.cumsum(a[1].astype(np.int64)) - a[1]
            wanting = np.add.reduceat((count == 0).astype(np.int64), head) > 0
            facts_of = facts[own_context[own[head[wanting]]]]
            flag = full[own_context[own]].astype(np.uint64)
            rows.append(("reply", chunk, 2, bucket, packed((count.astype(np.uint64) << np.uint64(1)) | flag, *facts_of.T.copy()), None))
        spread = np.zeros(n, bool)
        heads_ = np.concatenate([np.cumsum(a[1].astype(np.int64)) - a[1] + off for a, off in zip(asked, np.cumsum([0] + [len(a[2]) for a in asked[:-1]]), strict=True)])
        spread[own_context[place[heads_]]] = np.concatenate([a[5] for a in asked]) > 0
        names = c[heads(c)]
        if spread.any():
            rows.append(("spread", -1, 2, bucket, packed(names[spread], *facts[spread].T.copy()), None))
        seen_total = total[seen]
        rows.append(("pair", -1, 2, bucket, packed(c[seen], w[seen], seen_total), [int((seen_total == r).sum()) for r in range(1, k + 2)]))
        return told_table(rows)

    return tell


def backoff(facts: np.ndarray, size: np.ndarray, discount: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The backoff weight of each context, and its denominator."""
    k = len(discount)
    few = facts[:, :k]
    full = few.sum(axis=1) == 0
    size = np.where(full, size + 1.0, size)
    kept = (few * (discount * np.arange(1, k + 1))).sum(axis=1) + facts[:, k]
    return (1 - kept / size) / np.maximum(1 - facts[:, k + 1], 1e-300), size


def score_chunk(starts: int, share: float, buckets: int, singles: Singles, discount: np.ndarray, spread: dict[int, np.ndarray]):
    k = len(discount)

    def score(_: tuple, docs: pa.Table, told: pa.Table) -> pa.Table:
        import pyarrow.compute as pc

        p = Pairs(docs, told, starts, share, buckets)
        own = told.filter(pc.equal(told["level"], 2)).sort_by("bucket")
        log_p = np.empty(len(p.order))
        context, word_p = p.context[p.order], singles.p(p.word_count[p.order])
        size, spread_over = p.context_count[p.order].astype(np.float64), p.spread[p.order]
        for a, b, raw in zip(p.start, p.end, own["answer"].to_pylist(), strict=True):
            code, *facts = unpacked(raw)
            count, full = (code >> np.uint64(1)).astype(np.int64), (code & np.uint64(1)) > 0
            head = heads(context[a:b])
            each = np.diff(np.append(head, b - a))
            run_size, run_full = size[a:b][head], full[head]
            wanting = np.add.reduceat((count == 0).astype(np.int64), head) > 0
            weight = np.ones(len(head))
            if wanting.any():
                weight[wanting] = backoff(np.stack(facts, axis=1), run_size[wanting], discount)[0]
            for i in np.flatnonzero(spread_over[a:b][head]):
                whole = spread[int(context[a:b][head[i]])]
                weight[i] = backoff(whole[None], run_size[i : i + 1], discount)[0][0]
                run_full[i] = whole[:k].sum() == 0
            run_size = np.where(run_full, run_size + 1, run_size)
            # A context that training lacks backs off whole.
            weight[size[a:b][head] == 0] = 1.0
            d = np.ones(b - a)
            few = (count > 0) & (count <= k)
            d[few] = discount[count[few] - 1]
            seen = d * count / np.maximum(np.repeat(run_size, each), 1)
            log_p[a:b] = np.log10(np.where(count > 0, seen, np.repeat(weight, each) * word_p[a:b]))
        by_pair = np.empty(len(p.order))
        by_pair[p.order] = log_p
        t = p.tokens
        at = t.first[:-1]
        total = lambda x: np.add.reduceat(x, at) if len(at) else np.zeros(0)
        base, known = singles.base(p.counts.astype(np.float64))[t.codes], (p.counts > 0)[t.codes]
        n = len(at)
        return pa.table({
            "doc_id": t.docs["doc_id"], "n_tokens": pa.array(np.diff(t.first)), "n_known": pa.array(total(known.astype(np.int64)).astype(np.int64)),
            "train_tokens": pa.array([singles.total] * n, pa.int64()), "base_score": pa.array(total(base)), "score": pa.array(total(by_pair[p.place])),
        })

    return score


def score_texts(df: DataFrame, key: str, text: str, learn: Column, k: int = 5, chunk_bytes: int = 16 << 20) -> DataFrame:
    """(key, n_tokens, n_known, train_tokens, base_score, score) for each row; ``learn`` says which rows train."""
    table = chunked(df.select(F.col(key).alias("id"), F.col(text).alias("text"), F.coalesce(learn, F.lit(False)).alias("learn")), "id", "text", ["learn"], chunk_bytes)
    docs, chunks = table.table, table.n
    single_buckets = buckets_for(chunks * 500_000, PER_BUCKET)
    told = stored(docs.groupBy("chunk").applyInArrow(frugal(ask_singles(single_buckets), False), ASK).groupBy("bucket").applyInArrow(tell_singles(k), TOLD), "singles", "kind")
    stats = told.where("kind = 'single'").select(F.posexplode("stats").alias("i", "n")).groupBy("i").agg(F.sum("n").alias("n")).collect()
    by = {r["i"]: r["n"] for r in stats}
    singles = Singles.of(by.get(0, 0), by.get(1, 0), np.array([by.get(2 + r, 0) for r in range(k + 1)]))
    starts = docs.where("c_0").count()
    pair_buckets = buckets_for(2 * singles.total // 3 + chunks, PER_BUCKET)
    share = max(1.0, singles.total / (2 * pair_buckets))
    replies = told.where("kind = 'reply'").select("chunk", "level", "bucket", "answer")
    asked = docs.groupBy("chunk").cogroup(replies.groupBy("chunk")).applyInArrow(frugal(ask_pairs(starts, share, pair_buckets), True), ASK)
    more = stored(asked.groupBy("bucket").applyInArrow(tell_pairs(k, singles), TOLD), "pairs", "kind")
    stats = more.where("kind = 'pair'").select(F.posexplode("stats").alias("i", "n")).groupBy("i").agg(F.sum("n").alias("n")).collect()
    by = {r["i"]: r["n"] for r in stats}
    discount = discounts(np.array([by.get(r, 0) for r in range(k + 1)]))
    # At most four parts of spread contexts for each bucket, each a few numbers.
    spread: dict[int, np.ndarray] = {}
    for row in more.where("kind = 'spread'").select("answer").toLocalIterator():
        names, *facts = unpacked(bytes(row["answer"]))
        for name, fact in zip(names.tolist(), np.stack(facts, axis=1), strict=True):
            spread[name] = spread.get(name, 0) + fact
    replies = replies.unionByName(more.where("kind = 'reply'").select("chunk", "level", "bucket", "answer"))
    kind = dict(docs.dtypes)["doc_id"]
    out = docs.groupBy("chunk").cogroup(replies.groupBy("chunk")).applyInArrow(frugal(score_chunk(starts, share, pair_buckets, singles, discount, spread), True), f"doc_id {kind}, n_tokens long, n_known long, train_tokens long, base_score double, score double")
    out = stored(out.withColumnRenamed("doc_id", key), "scores")
    table.drop()
    return out
