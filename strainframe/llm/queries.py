"""The registered queries: each applies one operator, with production parameters, to its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import alignment, ann, bpe, jaccard, katz, langid, packing, quality, quantiser, substrings, tiff, toxicity, warc


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_tiff_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts stored as paged TIFF files, read back page by page."""
    media = tiff.encode_text_media(documents(spark, sf_dir), "doc_id", "text")
    return tiff.media_digest(media, "doc_id", "media", keep=["n_bytes"]).select("doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature")


def op9_bpe_lexicon(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Byte-level BPE through a mapped automaton, and back."""
    docs, tokenizer = documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json")
    return bpe.encode_decode_digests(docs, "doc_id", "text", tokenizer, bpe.build_lexicon(docs, "text", tokenizer))


def remainder(key: str, modulus: int) -> Column:
    """crc32 of the key as text, modulo ``modulus``."""
    return F.crc32(F.col(key).cast("string")) % modulus


def op2_ecoc_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document by error-correcting output codes."""
    docs = documents(spark, sf_dir)
    model = langid.fit(docs, "doc_id", "text", "lang", learn=remainder("doc_id", 3) != 1)
    found = langid.identified(docs.select("doc_id", "text"), "text", model)
    return found.select("doc_id", (remainder("doc_id", 3) == 1).alias("held_out"), "lang_pred", "score", "ambiguous")


def op6_level_doubling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words under repeated windows of 35 words removed from every document."""
    kept = substrings.without_repeats(documents(spark, sf_dir), "doc_id", "text", window=35)
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


def op7_subword_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality scores of every document by supervised subword embeddings."""
    docs, labels = documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = quality.fit(docs, labels.where(remainder("doc_id", 5) != 0), "doc_id", "text", "quality")
    found = quality.scored(docs.select("doc_id", "text"), "text", model)
    return found.select("doc_id", (remainder("doc_id", 5) == 0).alias("held_out"), "score", "predicted")


def op3_katz_backoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log probabilities of every document under a backoff model of word pairs."""
    held_out = remainder("doc_id", 7) == 2
    found = katz.score_texts(documents(spark, sf_dir), "doc_id", "text", learn=~held_out)
    return found.select("doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op4_block_matrix_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five nearest vectors of every fiftieth, by int8 tiles and exact rescoring."""
    return ann.nearest(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), "vec_id", "embedding", every=50, k=5)


def op5_warc_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages written as WARC archives with segments and revisits, read back and put together."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    found = warc.catalogued(warc.archived(pages, "page_id", "url", "html"))
    return found.select(F.col("row").cast("long").alias("page_id"), "payload_bytes", "payload_digest", "record_type", F.col("refers_to").cast("long").alias("refers_to"))


def op8_bounded_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as token ids in windows of 4,096."""
    return packing.pack(documents(spark, sf_dir), "doc_id", "text", public_tokenizers.path("word_bpe_49k.json"), end_id=2)


def op10_metric_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose sets of four-word shingles are 85 % alike."""
    return jaccard.similar_components(documents(spark, sf_dir), "doc_id", "text", words=4, least=85)


def op11_interval_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of two tokenizers aligned over the bytes of every document."""
    return alignment.aligned_digests(documents(spark, sf_dir), "doc_id", "text", public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))


def op12_filtering_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Embeddings as sixteen codes each, from codebooks refined by filtering Lloyd rounds."""
    forest = quantiser.planted(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), "vec_id", "embedding", "label")
    books = quantiser.fitted(forest)
    found = quantiser.label_errors(quantiser.coded(forest, books))
    return found.select(F.col("key").alias("vec_id"), F.lower(F.hex("code")).alias("code"), "error", "label_error", F.lit(books.sha256()).alias("codebooks_sha256"))


def op13_ratio_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity scores of every document by character n-grams scaled by log-count ratios."""
    docs, labels = documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = toxicity.fit(docs, labels.where(remainder("doc_id", 3) != 1), "doc_id", "text", "toxic")
    found = toxicity.scored(docs.select("doc_id", "text"), "text", model)
    return found.select("doc_id", (remainder("doc_id", 3) == 1).alias("held_out"), "score", "predicted")


QUERIES = {f.__name__: f for f in (op1_tiff_pages, op2_ecoc_language_id, op3_katz_backoff, op4_block_matrix_join, op5_warc_segments, op6_level_doubling, op7_subword_quality, op8_bounded_packing, op9_bpe_lexicon, op10_metric_jaccard, op11_interval_alignment, op12_filtering_codes, op13_ratio_toxicity)}
#: DuckDB SQL for those that SQL can express; the others are tested against brute force, the libraries or held-out rows.
ORACLES: dict[str, str] = {
    "op6_level_doubling": r"""
        WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') ws FROM documents),
        h AS (SELECT doc_id, i, md5(array_to_string(ws[i:i + 34], ' ')) k FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 33)) i FROM w)),
        r AS (SELECT k FROM h GROUP BY k HAVING count(*) > 1),
        gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 35)) pos FROM h WHERE k IN (SELECT k FROM r)),
        u AS (SELECT doc_id, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) pos FROM w),
        kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY pos) t, count(*) n FROM u ANTI JOIN gone USING (doc_id, pos) GROUP BY 1)
        SELECT w.doc_id, len(ws)::BIGINT n_words, (len(ws) - coalesce(n, 0))::BIGINT n_removed, sha256(coalesce(t, '')) kept_sha256 FROM w LEFT JOIN kept USING (doc_id)""",
    "op10_metric_jaccard": r"""
        WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') ws FROM documents),
        s AS (SELECT DISTINCT doc_id, array_to_string(ws[i:i + 3], ' ') g FROM (SELECT doc_id, ws, unnest(CASE WHEN len(ws) >= 4 THEN range(1, len(ws) - 2) WHEN len(ws) > 0 THEN [1] ELSE [] END) i FROM w)),
        n AS (SELECT doc_id, count(*) c FROM s GROUP BY 1),
        b AS (SELECT x.doc_id x, y.doc_id y, count(*) common FROM s x JOIN s y USING (g) GROUP BY 1, 2),
        e AS (SELECT x, y FROM b JOIN n p ON p.doc_id = x JOIN n q ON q.doc_id = y WHERE 100 * common >= 85 * (p.c + q.c - common)),
        r AS (SELECT x, y FROM e UNION SELECT r.x, e.y FROM r JOIN e ON r.y = e.x)
        SELECT w.doc_id, coalesce(c, 0) n_shingles, coalesce(m, w.doc_id) component_id FROM w LEFT JOIN n USING (doc_id) LEFT JOIN (SELECT x, min(y) m FROM r GROUP BY 1) k ON k.x = w.doc_id""",
}
