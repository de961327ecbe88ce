"""Language identification by error-correcting output codes.

Each language has a codeword; each of its bits is predicted by a binary
classifier over hashed runs of bytes, whose weight for a bucket is the log
odds of that bucket in the languages of either side.  Decoding is loss
weighted: the codeword with the smallest sum of logistic losses wins, each bit
weighing by how well it did on the learning sample.  A text whose best two
codewords are close in loss is flagged as ambiguous.

With up to seven languages the code is exhaustive (every split of the
languages into two sides); with more it is the best of many random codes.

Defined cases: a null text, or one without any letter, is ``und`` with score
0; a text too short for one run of bytes is decoded from zero margins; texts
are taken whole whatever their length; with a single learned language that one
is predicted, and with none ``und``; repeated ids are learned from once for
each language; columns of the input may have any names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import stored, unused
from .units import byte_grams, runs, sums, text_bytes

BITS, GRAM = 15, 4
_LETTER = regex.compile(r"\p{L}")
_ASCII_LETTER = np.zeros(256, bool)
_ASCII_LETTER[65:91] = _ASCII_LETTER[97:123] = True


def codewords(n: int, tries: int = 200, seed: int = 3) -> np.ndarray:
    """n codewords of -1 and 1, as rows."""
    if n < 2:
        return np.ones((n, 1), int)
    if n <= 7:
        sides = [s for k in range(1, n) for s in combinations(range(n), k) if 0 in s]
        return np.array([[1 if i in s else -1 for s in sides] for i in range(n)])
    rng, width = np.random.default_rng(seed), 10 * int(np.ceil(np.log2(n)))
    best, apart = None, -1
    for _ in range(tries):
        code = rng.choice([-1, 1], (n, width))
        code = code[:, np.abs(code.sum(axis=0)) < n]
        least = min((code[i] != code[j]).sum() for i, j in combinations(range(n), 2))
        if least > apart:
            best, apart = code, least
    return best


@dataclass
class Model:
    languages: list[str]
    code: np.ndarray
    weights: np.ndarray  # one row of bucket weights for each bit
    scale: np.ndarray  # makes margins of different bits comparable
    trust: np.ndarray  # how much each bit's loss counts

    def predict(self, column: pa.Array, least_gap: float) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Language, score, and whether the runner-up is close, for each text, a few megabytes of text at a time."""
        found = [self._predict(part, least_gap) for part in parts(column)]
        names, score, close = zip(*found, strict=True) if found else ((), (), ())
        return [x for part in names for x in part], np.concatenate(score) if found else np.zeros(0), np.concatenate(close) if found else np.zeros(0, bool)

    def _predict(self, column: pa.Array, least_gap: float) -> tuple[list[str], np.ndarray, np.ndarray]:
        n = len(column)
        if not self.languages:
            return ["und"] * n, np.zeros(n), np.ones(n, bool)
        margins = bit_margins(self.weights, column) * self.scale
        loss = np.stack([(np.logaddexp(0, -margins * word) * self.trust).sum(axis=1) for word in self.code], axis=1)
        likely = np.exp(loss.min(axis=1, keepdims=True) - loss)
        likely /= likely.sum(axis=1, keepdims=True)
        best = loss.argmin(axis=1)
        ordered = np.sort(loss, axis=1)
        gap = (ordered[:, 1] - ordered[:, 0]) / self.trust.sum() if len(self.languages) > 1 else np.full(n, np.inf)
        letters = has_letter(column)
        score = np.where(letters, likely[np.arange(n), best], 0.0)
        return [self.languages[b] if ok else "und" for b, ok in zip(best, letters, strict=True)], score, (gap < least_gap) | ~letters


def parts(column: pa.Array) -> Iterator[pa.Array]:
    """The column in slices of a few megabytes of text."""
    for a, b in runs(text_bytes(column)[1]):
        yield column.slice(a, b - a)


def bit_margins(weights: np.ndarray, column: pa.Array) -> np.ndarray:
    """The mean weight of each text's buckets, for each bit."""
    buckets, first = byte_grams(column, GRAM, BITS, lower=True)
    size = np.maximum(np.diff(first), 1)
    return np.stack([sums(w[buckets], first) / size for w in weights], axis=1)


def has_letter(column: pa.Array) -> np.ndarray:
    data, docs = text_bytes(column)
    out, wide = (np.diff(np.concatenate([[0], np.cumsum(x, dtype=np.int32)])[docs]) > 0 for x in (_ASCII_LETTER[data], data >= 128))
    for i in np.flatnonzero(~out & wide):
        out[i] = _LETTER.search(data[docs[i] : docs[i + 1]].tobytes().decode()) is not None
    return out


def counts_of(column: pa.Array) -> np.ndarray:
    """How often each bucket occurs in all texts together."""
    out = np.zeros(1 << BITS, np.int64)
    for part in parts(column):
        out += np.bincount(byte_grams(part, GRAM, BITS, lower=True)[0], minlength=1 << BITS)
    return out


def coded(languages: list[str], counts: np.ndarray) -> Model:
    """Codewords and bit classifiers from each language's bucket counts; margins are not yet scaled."""
    code = codewords(len(languages))
    # Every language weighs alike, however much text it has.
    share = (counts + 0.1) / (counts + 0.1).sum(axis=1, keepdims=True) if len(languages) else counts
    weights = []
    for bit in code.T:
        ones, others = share[bit > 0], share[bit < 0]
        weights.append(np.clip(np.log(ones.mean(axis=0)) - np.log(others.mean(axis=0)), -6, 6) if len(ones) and len(others) else np.zeros(1 << BITS))
    bits = code.shape[1]
    return Model(languages, code, np.array(weights) if languages else np.zeros((0, 1 << BITS)), np.ones(bits), np.ones(bits))


def tested(model: Model, column: pa.Array, langs: list[str]) -> np.ndarray:
    """For each bit the sums of the margins' sizes and of right signs, and the number of texts."""
    label = np.searchsorted(np.array(model.languages), langs)
    out, at = np.zeros((3, model.code.shape[1])), 0
    for part in parts(column):
        margins = bit_margins(model.weights, part)
        right = np.sign(margins) == model.code[label[at : at + len(part)]]
        out += np.stack([np.abs(margins).sum(axis=0), right.sum(axis=0), np.full(right.shape[1], len(part))])
        at += len(part)
    return out


def scaled(model: Model, told: np.ndarray) -> Model:
    """Margins of mean size 4, and the trust that each bit earned."""
    size, right, n = told
    model.scale = 4 / np.maximum(size / np.maximum(n, 1), 1e-9)
    model.trust = np.maximum(2 * right / np.maximum(n, 1) - 1, 0.05)
    return model


def train(texts: list[str | None], langs: list[str]) -> Model:
    """Fit on texts in memory."""
    languages, column, own = sorted(set(langs)), pa.array(texts, pa.large_string()), np.array(langs, object)
    counts = np.array([counts_of(column.filter(pa.array(own == name))) for name in languages]) if languages else np.zeros((0, 1 << BITS))
    model = coded(languages, counts)
    return scaled(model, tested(model, column, langs)) if languages else model


def fit(docs: DataFrame, key: str, text: str, lang: str, learn: Column, per_language: int = 1500) -> Model:
    """Learn from at most ``per_language`` keys of each language, those of the smallest hashes (of several texts of a key the first).

    One scan counts keys, one ranks those of the smallest hashes, one fetches
    their texts; counting is done by the executors, so no text comes to the
    driver.  Keys are broadcast: 1,500 for each language.
    """
    known = docs.where(learn & F.col(lang).isNotNull() & F.col(key).isNotNull()).select(F.col(key).alias("key"), F.col(lang).alias("lang"), F.col(text).alias("text"))
    named = known.select("key", "lang", F.xxhash64("key").alias("hash"))
    # A share of the hashes that holds twice as many keys as are taken, by an estimate of each language's keys, so
    # that no language's keys all meet in one task; where fewer were held than are taken, all are.
    sizes = named.groupBy("lang").agg(F.approx_count_distinct("key", 0.02).alias("n"))
    least = F.lit(float(-(1 << 63))) + F.lit(float(1 << 64)) * F.least(F.lit(1.0), F.lit(2.0 * per_language + 200) / F.greatest(F.col("n"), F.lit(1)))
    few = named.join(F.broadcast(sizes.select("lang", least.alias("below"))), "lang").where(F.col("hash") <= F.col("below")).select("key", "lang", "hash").distinct()
    order = Window.partitionBy("lang").orderBy("hash", "key")
    keys = few.withColumn("place", F.row_number().over(order)).where(F.col("place") <= per_language).select("key", "lang")
    sample = stored(known.join(F.broadcast(keys), ["key", "lang"], "left_semi").groupBy("key", "lang").agg(F.min("text").alias("text")), "languages").select("lang", "text")

    def counting(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, np.ndarray] = {}
        for batch in batches:
            names = batch.column(0).dictionary_encode()
            for i, name in enumerate(names.dictionary.to_pylist()):
                held[name] = held.get(name, 0) + counts_of(batch.column(1).filter(pc.equal(names.indices, i)))
        for name, counts in held.items():
            yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([counts.tobytes()], pa.binary())], names=["lang", "counts"])

    counts: dict[str, np.ndarray] = {}
    for name, raw in sample.coalesce(32).mapInArrow(counting, "lang string, counts binary").toLocalIterator():
        counts[name] = counts.get(name, 0) + np.frombuffer(raw, np.int64)
    languages = sorted(counts)
    model = coded(languages, np.array([counts[x] for x in languages]) if languages else np.zeros((0, 1 << BITS)))
    if not languages:
        return model
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def testing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            told = tested(shared.value, batch.column(1), batch.column(0).to_pylist())
            yield pa.RecordBatch.from_arrays([pa.array([told.tobytes()], pa.binary())], names=["told"])

    rows = sample.coalesce(32).mapInArrow(testing, "told binary").collect()
    return scaled(model, sum(np.frombuffer(r["told"]).reshape(3, -1) for r in rows))


def identified(docs: DataFrame, text: str, model: Model, least_gap: float = 0.05, into: str | None = None) -> DataFrame:
    """``docs`` with lang_pred, score and ambiguous, as columns or as fields of a struct named ``into``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("lang_pred string, score double, ambiguous boolean")
    def predict(texts):  # noqa: ANN001, ANN202
        import pandas as pd

        names, score, unsure = shared.value.predict(pa.array(texts, pa.large_string(), from_pandas=True), least_gap)
        return pd.DataFrame({"lang_pred": names, "score": score, "ambiguous": unsure})

    name = into or unused(docs, "found")
    found = docs.withColumn(name, predict(F.col(text)))
    return found if into else found.select(*docs.columns, f"{name}.*")
