"""From raw documents to packed training sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and works on every document its
predecessor kept.  All but the last return the columns of ``docs``.

Defined cases: null and empty texts get the classifier's bias score, have no
language and so end at the second stage; documents without an id cannot be
named as copies of others and stay; of several rows of one id the first by text
stays after the third stage; further columns of any name are kept as they are;
an empty table passes through every stage.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strainframe.llm import jaccard, langid, packing, quality, substrings
from strainframe.llm.shared import scratch, stored, unused


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts; it learns from the labels given."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = quality.fit(docs, labels, "doc_id", "text", "quality")
    score, accepted = unused(docs, "score"), unused(docs, "accepted")
    return quality.scored(docs, "text", model, score=score, predicted=accepted).where(F.col(accepted) == 1).select(docs.columns)


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a known language; those without letters, and those between languages with neither likely, go."""
    model = langid.fit(docs, "doc_id", "text", "lang", learn=F.lit(True))
    name = unused(docs, "language")
    found = F.col(name)
    kept = (found["lang_pred"] != "und") & ~(found["ambiguous"] & (found["score"] < 0.6))
    return langid.identified(docs, "text", model, into=name).where(kept).select(docs.columns)


def one_of_alike(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest id, of each group whose sets of five-word shingles are 80 % alike."""
    groups = jaccard.similar_components(docs, "doc_id", "text", words=5, least=80)
    first = groups.where("component_id = doc_id").groupBy("doc_id").agg(F.count("*").alias("rows"))
    once = docs.join(first.where("rows = 1"), "doc_id", "left_semi")
    # Of several rows of one id the first by text, then by all columns.
    place = unused(docs, "place")
    order = Window.partitionBy("doc_id").orderBy("text", F.to_json(F.struct(*(F.col(c) for c in docs.columns))))
    several = docs.join(first.where("rows > 1"), "doc_id", "left_semi").withColumn(place, F.row_number().over(order)).where(F.col(place) == 1)
    return once.select(docs.columns).unionByName(several.select(docs.columns)).unionByName(docs.where("doc_id is null"))


def without_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages of 35 words and more that stand elsewhere too; other texts stay as they are."""
    others = [c for c in docs.columns if c not in ("doc_id", "text")]
    words, removed = unused(docs, "n_words"), unused(docs, "n_removed")
    kept = substrings.without_repeats(docs, "doc_id", "text", window=35, carry=others, keep_clean=True, counts=(words, removed))
    if "n_chars" in others:
        kept = kept.withColumn("n_chars", F.when(F.col(removed) > 0, F.length("text").cast("long")).otherwise(F.col("n_chars")))
    return kept.select(docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids packed into sequences of 4,096, one row for each piece."""
    return packing.pack(docs, "doc_id", "text", public_tokenizers.path("word_bpe_49k.json"), end_id=2)


STAGES = [
    ("quality classifier", good_quality),
    ("language ID", known_language),
    ("n-gram Jaccard join", one_of_alike),
    ("substring dedup", without_passages),
    ("packing", packed),
]

#: SQL can express neither the classifiers nor the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        with scratch(spark):
            docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
