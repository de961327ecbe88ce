"""The toxicity classifier: features against plain slicing, held-out labels, and rows of every kind."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq

from strainframe.llm import toxicity

SF = "/root/testdata/sf0.01"
SCHEMA = "doc_id long, text string, score double, _key int, _label string"


def test_characters_and_features():
    texts = ["héllo  wörld\n漢字😀 ab", "", None, "ab", "aaaaaaaa", "x" * 10]
    got: dict[int, Counter] = {i: Counter() for i in range(len(texts))}
    for a, _, text, feature in toxicity.held(pa.array(texts, pa.large_string())):
        for t, f in zip(text.tolist(), feature.tolist(), strict=True):
            got[a + t][f & 3] += 1
    for i, text in enumerate(texts):
        plain = re.sub(r"[\x20\x09-\x0d]", " ", text or "")
        grams = Counter(plain[p : p + n] for n in toxicity.SIZES for p in range(len(plain) - n + 1))
        assert got[i] == Counter({place: n for place, least in enumerate(toxicity.TIMES) if (n := sum(c >= least for c in grams.values()))})
    code, first = toxicity.characters(np.frombuffer("aé漢😀\t".encode(), np.uint8), np.array([0, 3, 11]))
    assert len(set(code.tolist())) == 5 and first.tolist() == [0, 2, 5] and code[4] == 32


def test_equal_texts_have_equal_features_wherever_they_stand():
    texts = ["one bad word", "other text", "one bad word"]
    parts = [(text, f) for _, _, text, f in toxicity.held(pa.array(texts, pa.large_string()))]
    text, feature = parts[0]
    assert np.array_equal(feature[text == 0], feature[text == 2])


def test_toxicity_query_on_held_out_rows(spark):
    from strainframe.llm.queries import op13_ratio_toxicity

    rows = pq.read_table(f"{SF}/labels.parquet").to_pylist()
    want = {r["doc_id"]: r["toxic"] for r in rows if r["toxic"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1}
    found = op13_ratio_toxicity(spark, SF).collect()
    got = {r.doc_id: r for r in found}
    assert len(found) == pq.read_table(f"{SF}/documents.parquet").num_rows
    scores = {v: [got[k].score for k, label in want.items() if label == v and k in got] for v in (0, 1)}
    pairs = [(a > b) + 0.5 * (a == b) for a in scores[1] for b in scores[0]]
    assert min(map(len, scores.values())) >= 15 and sum(pairs) / len(pairs) >= 0.97
    assert sum(s >= 0.7 for s in scores[0]) <= 1 and sum(s >= 0.7 for s in scores[1]) >= 0.7 * len(scores[1])
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) and r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in found)


def test_rows_of_every_kind(spark):
    rng = random.Random(2)
    plain = ["lorem", "ipsum", "dolor", "sit", "amet"]
    rows = [(i, " ".join(rng.choice(plain) for _ in range(40)) + (" Vile! vile " * 2 if i % 3 == 0 else ""), 0.5, 1, "x") for i in range(120)]
    rows += [(900, None, None, None, None), (901, "", None, None, None), (902, "lorem vile vile " * 100_000, None, None, None), (902, "again", None, None, None), (None, "vile vile", None, None, None), (903, "??", None, None, None)]
    df = spark.createDataFrame(rows, SCHEMA)
    labels = [(i, int(i % 3 == 0)) for i in range(90)] + [(900, None), (None, 1), (5, 1), (6, 1), (7, 3), (901, 0), (902, 1)]
    model = toxicity.fit(df, spark.createDataFrame(labels, "doc_id long, toxic int"), "doc_id", "text", "toxic")
    got = toxicity.scored(df, "text", model, score="s", predicted="p").collect()
    assert len(got) == len(rows) and got[0].asDict().keys() == {"doc_id", "text", "score", "_key", "_label", "s", "p"}
    by = {r.doc_id: r for r in got if r.text != "again"}
    assert all(by[i].p == (i % 3 == 0) for i in range(90, 120)) and by[902].p == 1
    assert by[900].s == by[901].s == by[903].s and 0 <= by[900].s <= 1


def test_without_labels_of_both_kinds(spark):
    df = spark.createDataFrame([(1, "a b c"), (2, "d e f"), (3, None)], "doc_id long, text string")
    for labels, want in (([], 0.5), ([(1, 1), (2, 1)], 1.0), ([(1, 0)], 0.0), ([(9, 0), (1, 1)], 1.0)):
        model = toxicity.fit(df, spark.createDataFrame(labels, "doc_id long, toxic int"), "doc_id", "text", "toxic")
        assert all(abs(r.score - want) < 1e-4 for r in toxicity.scored(df, "text", model).collect())
    none = df.where("doc_id < 0")
    assert toxicity.scored(none, "text", toxicity.fit(none, spark.createDataFrame([], "doc_id long, toxic int"), "doc_id", "text", "toxic")).count() == 0


def test_training_repeats_and_does_not_depend_on_partitions(spark):
    df = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    one, two = (toxicity.fit(x, labels, "doc_id", "text", "toxic") for x in (df, df.repartition(7)))
    assert np.array_equal(one.features, two.features) and np.allclose(one.weights, two.weights, atol=1e-6) and abs(one.bias - two.bias) < 1e-6
