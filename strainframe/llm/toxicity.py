"""Toxicity by character n-grams scaled by naive Bayes log-count ratios.

A text's features say which runs of 3 to 6 characters it holds at least once,
twice and four times, white space folded to one kind and letters as they are.
Each is scaled by the log of the ratio of its smoothed document shares among
labels 1 and 0, and a linear classifier with a logistic output is trained on
the scaled features by numpy gradient descent, both labels weighing alike.

Learning takes a sample of labelled rows whose size is a parameter.  Executors
count n-grams of the sample; only those whose shares differ by most standard
errors, ``features`` at most, become features, so what comes to the driver is
one bit for each sampled row and feature, however long texts are.

Defined cases: a null or empty text, or one with none of the features, gets the
model's bias score; texts are scored whole whatever their length; labels that
are null, other than 0 and 1 or differ for one key are not learned from, nor
are labels or texts without a key; of several texts of a key the first in order
is learned from; without labels of both kinds the score is the share of label 1
(0.5 without labels); columns of the input may have any names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .exchange import give_back
from .shared import stored
from .units import SPACE, runs, text_bytes

BITS, SIZES, TIMES = 22, (3, 4, 5, 6), (1, 2, 4)
#: Bytes of text whose n-grams are held at once.
STEP = 1 << 20


def characters(data: np.ndarray, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A number for each UTF-8 character (its bytes; white space as one space), and the offsets of the texts in characters."""
    lead = (data & 0xC0) != 0x80
    at = np.flatnonzero(lead)
    code = np.where(SPACE[data[at]], np.uint32(32), data[at].astype(np.uint32))
    length = np.diff(at, append=len(data))
    for i in range(1, 4):
        longer = length > i
        code[longer] |= data[at[longer] + i].astype(np.uint32) << np.uint32(8 * i)
    return code, np.searchsorted(at, docs)


def held(column: pa.Array, wanted: np.ndarray | None = None) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """For runs (a, b) of texts: each (text, feature), once; only for buckets that ``wanted`` says, if given.

    A feature is 4 times the bucket of an n-gram, plus the place in ``TIMES`` of how often it occurs at least.
    """
    data, docs = text_bytes(column)
    for a, b in runs(docs, STEP):
        code, own = characters(data[docs[a] : docs[b]], docs[a : b + 1] - docs[a])
        text = np.repeat(np.arange(b - a, dtype=np.int64), np.diff(own))
        rolling, found = np.zeros(len(code), np.uint64), []
        for i in range(max(SIZES)):
            # The hash of the run of i + 1 characters that begins at each place.
            rolling = rolling[: len(code) - i] * np.uint64(0x9E3779B97F4A7C15) + code[i:].astype(np.uint64) + np.uint64(1)
            if i + 1 not in SIZES or not len(rolling):
                continue
            bucket = (((rolling ^ (rolling >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(64 - BITS)).astype(np.int64)
            keep = text[: len(bucket)] == text[i:]
            if wanted is not None:
                keep &= wanted[bucket]
            found.append((text[: len(bucket)][keep] << BITS) | bucket[keep])
        each, n = np.unique(np.concatenate(found), return_counts=True) if found else (np.zeros(0, np.int64), np.zeros(0, np.int64))
        each = np.concatenate([(each[n >= least] << 2) | place for place, least in enumerate(TIMES)])
        yield a, b, each >> (BITS + 2), each & ((4 << BITS) - 1)


def buckets_of(features: np.ndarray) -> np.ndarray:
    """Which buckets have features."""
    wanted = np.zeros(1 << BITS, bool)
    wanted[features >> 2] = True
    return wanted


def found_in(features: np.ndarray, feature: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which of ``feature`` are among the ascending ``features``, and their places there."""
    place = np.minimum(np.searchsorted(features, feature), len(features) - 1)
    known = features[place] == feature
    return known, place[known]


@dataclass
class Model:
    features: np.ndarray  # ascending
    weights: np.ndarray
    bias: float

    def score(self, column: pa.Array) -> np.ndarray:
        """Probability of label 1 of each text."""
        out = np.full(len(column), self.bias)
        if len(self.features):
            for a, b, text, feature in held(column, buckets_of(self.features)):
                known, place = found_in(self.features, feature)
                out[a:b] += np.bincount(text[known], self.weights[place], b - a)
        return 1 / (1 + np.exp(-np.clip(out, -700, 700)))


def ratios(with_one: np.ndarray, with_zero: np.ndarray, ones: int, zeros: int) -> np.ndarray:
    """Log-count ratios of features from the numbers of documents that hold them."""
    return np.log((with_one + 1) / (ones + 2)) - np.log((with_zero + 1) / (zeros + 2))


def train(x: np.ndarray, y: np.ndarray, ratio: np.ndarray, rounds: int = 300, penalty: float = 0.01) -> tuple[np.ndarray, float]:
    """Weights of the features, their ratios included, and a bias: full gradient steps with momentum on the logistic loss."""
    scaled = x.astype(np.float32) * ratio.astype(np.float32)
    w, speed, bias, bias_speed = np.zeros(len(ratio)), np.zeros(len(ratio)), 0.0, 0.0
    share = np.where(y > 0, 0.5 / y.sum(), 0.5 / (1 - y).sum())
    # The loss's curvature is at most a quarter of the largest eigenvalue of the scaled features' products.
    v = np.ones(len(ratio), np.float32)
    top = 1.0
    for _ in range(20):
        v = scaled.T @ (share.astype(np.float32) * (scaled @ v))
        top = float(np.linalg.norm(v)) or 1.0
        v /= top
    step = 1 / (0.25 * (top + 1) + penalty)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(scaled @ w.astype(np.float32) + bias, -60, 60)))
        back = (p - y) * share
        speed = 0.9 * speed - step * (scaled.T @ back.astype(np.float32) + penalty * w)
        bias_speed = 0.9 * bias_speed - step * back.sum()
        w, bias = w + speed, bias + bias_speed
    return w * ratio, bias


def labelled(labels: DataFrame, key: str, label: str, most: int, per_class: int) -> DataFrame:
    """(_key, _label) of at most ``most`` keys, ``per_class`` of them with label 1: those of the smallest hashes."""
    known = labels.select(F.col(key).alias("_key"), F.col(label).cast("int").alias("_label")).where(F.col("_key").isNotNull() & F.col("_label").isin(0, 1))
    once = known.groupBy("_key").agg(F.min("_label").alias("_label"), F.max("_label").alias("_other")).where("_label = _other")
    some = lambda value, n: once.where(F.col("_label") == value).orderBy(F.xxhash64("_key"), "_key").limit(n).select("_key", "_label")
    return some(1, per_class).unionByName(some(0, most - per_class))


def fit(docs: DataFrame, labels: DataFrame, key: str, text: str, label: str, most: int = 8000, per_class: int = 3000, features: int = 2048) -> Model:
    """Learn from at most ``most`` labelled keys; that many ids and labels, and nothing longer, are broadcast."""
    chosen = labelled(labels, key, label, most, per_class)
    own = docs.select(F.col(key).alias("_key"), F.col(text).alias("_text")).where(F.col("_key").isNotNull())
    sample = stored(own.join(F.broadcast(chosen), "_key").groupBy("_key", "_label").agg(F.min("_text").alias("_text")), "labelled").select("_label", "_text")

    def counting(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            label_of = batch.column(0).to_numpy(zero_copy_only=False)
            for a, _, text_at, feature in held(batch.column(1)):
                names, n = np.unique((feature << 1) | label_of[a + text_at], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(names >> 1), pa.array((names & 1) * n), pa.array((1 - (names & 1)) * n)], names=["feature", "ones", "zeros"])
            give_back()

    n_of = {r["_label"]: r["n"] for r in sample.groupBy("_label").agg(F.count("*").alias("n")).collect()}
    ones, zeros = n_of.get(1, 0), n_of.get(0, 0)
    if not ones or not zeros:
        share = min(max(ones / (ones + zeros), 1e-6), 1 - 1e-6) if n_of else 0.5
        return Model(np.zeros(0, np.int64), np.zeros(0), float(np.log(share / (1 - share))))
    counts = sample.mapInArrow(counting, "feature long, ones long, zeros long").groupBy("feature").agg(F.sum("ones").alias("ones"), F.sum("zeros").alias("zeros"))
    best = counts.withColumn("apart", errors_apart(F.col("ones"), F.col("zeros"), ones, zeros)).orderBy(F.desc("apart"), "feature").limit(features).select("feature", "ones", "zeros").collect()
    rows = np.array([tuple(r) for r in best], np.int64).reshape(-1, 3)
    rows = rows[np.argsort(rows[:, 0])]
    names, ratio = rows[:, 0], ratios(rows[:, 1], rows[:, 2], ones, zeros)

    def bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, text_at, feature in held(batch.column(1), buckets_of(names)):
                known, place = found_in(names, feature)
                x = np.zeros((b - a, len(names)), bool)
                x[text_at[known], place] = True
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.array([r.tobytes() for r in np.packbits(x, axis=1)], pa.binary())], names=["label", "bits"])

    # One bit for each feature and row; the order makes training repeatable.
    told = sample.mapInArrow(bits, "label int, bits binary").orderBy("bits", "label").toArrow()
    x = np.unpackbits(np.frombuffer(b"".join(told["bits"].to_pylist()), np.uint8).reshape(len(told), -1), axis=1, count=len(names))
    weights, bias = train(x, told["label"].to_numpy().astype(np.float64), ratio)
    return Model(names, weights, bias)


def errors_apart(with_one: Column, with_zero: Column, ones: int, zeros: int) -> Column:
    """By how many standard errors the shares of documents of either label differ."""
    p, q, both = with_one / F.lit(float(ones)), with_zero / F.lit(float(zeros)), (with_one + with_zero + 1) / F.lit(float(ones + zeros + 2))
    return F.abs(p - q) / F.sqrt(both * (1 - both) * F.lit(1 / ones + 1 / zeros))


def scored(docs: DataFrame, text: str, model: Model, threshold: float = 0.7, score: str = "score", predicted: str = "predicted") -> DataFrame:
    """``docs`` with the columns ``score`` and ``predicted``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def probability(texts):  # noqa: ANN001, ANN202
        import pandas as pd

        return pd.Series(shared.value.score(pa.array(texts, pa.large_string(), from_pandas=True)))

    return docs.withColumn(score, probability(F.col(text))).withColumn(predicted, F.when(F.col(score) >= threshold, 1).otherwise(0))
