"""Supervised subword embeddings for quality.

Words, pairs of neighbouring words and runs of bytes are hashed to learned
vectors; a document is the sum of its three mean vectors, and a softmax output
gives the probability of label 1.  numpy stochastic gradient descent (AdaGrad
steps) trains vectors and output together in one task, on a sample of labelled
rows whose size is a parameter; only the numbers that scoring needs come to the
driver.

As document vectors are means and the output is linear before the softmax,
scoring needs only one number for each bucket: its vector's product with the
output's weights.

Defined cases: a null or empty text, or one without any feature, gets the
model's bias score; texts are scored whole whatever their length; labels that
are null, other than 0 and 1 or differ for one key are not learned from; without labels of both
kinds the score is the share of label 1 (0.5 without labels).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .exchange import frugal
from .units import byte_grams, pair_hash, runs, sums, text_bytes, word_hashes

WORD_BITS, PAIR_BITS, GRAM_BITS, GRAM = 17, 17, 16, 4
_SIZES = (1 << WORD_BITS, 1 << PAIR_BITS, 1 << GRAM_BITS)


def features(column: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
    """Buckets and offsets for words, word pairs and byte runs."""
    h, first = word_hashes(column)
    pairs = (pair_hash(h[:-1], h[1:]) >> np.uint64(64 - PAIR_BITS)).astype(np.int32) if len(h) > 1 else np.zeros(0, np.int32)
    inner = np.ones(len(pairs), bool)
    seam = first[1:-1] - 1
    inner[seam[(seam >= 0) & (seam < len(pairs))]] = False
    each = np.maximum(np.diff(first) - 1, 0)
    return [((h >> np.uint64(64 - WORD_BITS)).astype(np.int32), first), (pairs[inner], np.concatenate([[0], np.cumsum(each)])), byte_grams(column, GRAM, GRAM_BITS, lower=False)]


@dataclass
class Model:
    tables: list[np.ndarray]  # one number for each bucket of each kind
    bias: float

    def score(self, column: pa.Array) -> np.ndarray:
        """Probability of label 1 of each text, a few megabytes of text at a time."""
        return np.concatenate([self._score(column.slice(a, b - a)) for a, b in runs(text_bytes(column)[1])]) if len(column) else np.zeros(0)

    def _score(self, column: pa.Array) -> np.ndarray:
        logit = np.full(len(column), self.bias)
        for table, (buckets, first) in zip(self.tables, features(column), strict=True):
            logit += sums(table[buckets], first) / np.maximum(np.diff(first), 1)
        return 1 / (1 + np.exp(-np.clip(logit, -700, 700)))


def counted(column: pa.Array) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each kind: offsets of the texts, their distinct buckets, and each bucket's share of the text's features.

    Texts are taken a few megabytes at a time, so only distinct buckets are ever held for all of them.
    """
    held: list[list[tuple]] = [[], [], []]
    for a, b in runs(text_bytes(column)[1], 1 << 20):
        for kind, (buckets, first) in enumerate(features(column.slice(a, b - a))):
            n = np.diff(first)
            key, times = np.unique(np.repeat(np.arange(b - a), n) << 32 | buckets, return_counts=True)
            doc = key >> 32
            held[kind].append((np.bincount(doc, minlength=b - a), (key & 0xFFFFFFFF).astype(np.int32), (times / n[doc]).astype(np.float32)))
    out = []
    for parts in held:
        counts, spots, weights = (np.concatenate(x) for x in zip(*parts, strict=True))
        parts.clear()
        out.append((np.concatenate([[0], np.cumsum(counts)]), spots, weights))
    return out


def train(texts: list[str | None] | pa.Array, labels: np.ndarray, dim: int = 8, epochs: int = 4, batch: int = 64, rate: float = 0.5, seed: int = 7) -> Model:
    """Fit by stochastic gradient descent on the softmax loss."""
    share = float(labels.mean()) if len(labels) else 0.5
    if share in (0.0, 1.0) or not len(labels):
        share = min(max(share, 1e-6), 1 - 1e-6)
        return Model([np.zeros(n) for n in _SIZES], float(np.log(share / (1 - share))))
    rng = np.random.default_rng(seed)
    kinds = counted(texts if isinstance(texts, pa.Array) else pa.array(texts, pa.large_string()))
    vectors = [rng.normal(0, 1 / dim, (n, dim)).astype(np.float32) for n in _SIZES]
    squares = [np.full(n, 1e-6, np.float32) for n in _SIZES]
    out, out_squares = rng.normal(0, 1 / dim, (dim, 2)), np.full((dim, 2), 1e-6)
    bias = np.log([1 - share, share])
    for epoch in range(epochs):
        order, step = rng.permutation(len(labels)), rate * (1 - epoch / epochs)
        for i in range(0, len(order), batch):
            rows = order[i : i + batch]
            hidden, used = np.zeros((len(rows), dim)), []
            for (first, spots, weights), table in zip(kinds, vectors, strict=True):
                count = first[rows + 1] - first[rows]
                doc = np.repeat(np.arange(len(rows)), count)
                at = np.repeat(first[rows] - (np.cumsum(count) - count), count) + np.arange(int(count.sum()))
                spot, weight = spots[at], weights[at]
                gathered = table[spot] * weight[:, None]
                hidden += np.stack([np.bincount(doc, gathered[:, d], len(rows)) for d in range(dim)], axis=1)
                used.append((doc, spot, weight))
            logits = hidden @ out + bias
            p = np.exp(logits - logits.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            p[np.arange(len(rows)), labels[rows]] -= 1
            back = p @ out.T
            grad = hidden.T @ p / len(rows)
            out_squares += grad * grad
            out -= step * grad / np.sqrt(out_squares)
            bias = bias - 0.1 * step * p.mean(axis=0)
            for (doc, spot, weight), table, square in zip(used, vectors, squares, strict=True):
                own, place = np.unique(spot, return_inverse=True)
                g = np.stack([np.bincount(place, weight * back[doc, d], len(own)) for d in range(dim)], axis=1)
                square[own] += (g * g).mean(axis=1)
                table[own] -= 0.2 * step * g / np.sqrt(square[own])[:, None]
    edge = out[:, 1] - out[:, 0]
    return Model([table.astype(np.float64) @ edge for table in vectors], float(bias[1] - bias[0]))


def fit(docs: DataFrame, labels: DataFrame, key: str, text: str, label: str, most: int = 8000, per_class: int = 3000) -> Model:
    """Learn from at most ``most`` labelled rows, those of the smallest hashes of their key, ``per_class`` of them at most with label 0."""
    known = labels.select(F.col(key).alias("_key"), F.col(label).cast("int").alias("_label")).where(F.col("_label").isin(0, 1)).groupBy("_key").agg(F.min("_label").alias("_label"), F.max("_label").alias("_other")).where("_label = _other")
    chosen = None
    for value in (0, 1):
        some = known.where(F.col("_label") == value).orderBy(F.xxhash64(F.col("_key")), "_key").limit(per_class if value == 0 else most - per_class).select("_key", "_label")
        chosen = some if chosen is None else chosen.unionByName(some)
    # Of several texts of one key the first, so rows are bounded by ``most``.
    rows = docs.select(F.col(key).alias("_key"), F.col(text).alias("_text")).join(F.broadcast(chosen), "_key").groupBy("_key", "_label").agg(F.min("_text").alias("_text"))
    # A task trains, so neither texts nor what training holds come to the driver, whose memory all stages share.
    found = rows.groupBy(F.lit(0).alias("_all")).applyInArrow(frugal(learned, False), "tables array<binary>, bias double").first()
    if found is None:
        return train([], np.zeros(0, np.int64))
    return Model([np.frombuffer(table) for table in found["tables"]], found["bias"])


def learned(_key: tuple, rows: pa.Table) -> pa.Table:
    """The model that the chosen rows give, as one row."""
    order = pc.sort_indices(rows, sort_keys=[("_key", "ascending")])
    texts, truth = rows["_text"].cast(pa.large_string()).combine_chunks().take(order), rows["_label"].to_numpy().astype(np.int64)[order.to_numpy()]
    model = train(texts, truth)
    return pa.table({"tables": pa.array([[t.tobytes() for t in model.tables]], pa.list_(pa.binary())), "bias": [model.bias]})


def scored(docs: DataFrame, text: str, model: Model, threshold: float = 0.3, score: str = "score", predicted: str = "predicted") -> DataFrame:
    """``docs`` with the columns ``score`` and ``predicted``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def probability(texts):  # noqa: ANN001, ANN202
        import pandas as pd

        return pd.Series(shared.value.score(pa.array(texts, pa.large_string(), from_pandas=True)))

    return docs.withColumn(score, probability(F.col(text))).withColumn(predicted, F.when(F.col(score) >= threshold, 1).otherwise(0))
