"""The pipeline's stages on small tables: each decides as its operator does and keeps the columns."""

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

corpus_pipeline = pytest.importorskip("corpus_pipeline")

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


def tables(spark, folder):
    rng = random.Random(7)
    tongues = {"aa": [f"al{i}pha" for i in range(80)], "bb": [f"br{i}um" for i in range(80)]}
    rows = []
    for i in range(160):
        lang = "aa" if i % 2 else "bb"
        words = [rng.choice(tongues[lang]) for _ in range(90)]
        if i % 8 == 3:
            words = ["BUY!!"] * 60 + words[:20]
        rows.append([i, " ".join(words), lang if i % 5 else None, "s"])
    rows += [[200, rows[4][1], "bb", "s"], [201, rows[4][1] + " more", None, None], [202, None, None, None], [203, "123 456 -- 789", None, "s"], [204, "", None, None]]
    passage = " ".join(f"common{i}" for i in range(60))
    rows[10][1] += "\n" + passage
    rows[12][1] = passage + "  " + rows[12][1]
    rows = [tuple(r) + (len(r[1]) if r[1] is not None else None,) for r in rows]
    spark.createDataFrame(rows, COLUMNS).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(i, int(i % 8 != 3), 0) for i in range(0, 160)], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return {r[0]: r for r in rows}


def test_stages(spark, tmp_path):
    folder = f"file://{tmp_path}"
    rows = tables(spark, folder)
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality classifier", "language ID", "n-gram Jaccard join", "substring dedup", "packing"]
    kept = []
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, folder)
        if i < 4:
            assert out.columns == docs.columns
        path = f"{folder}/stage{i}"
        out.write.parquet(path)
        docs = spark.read.parquet(path)
        kept.append({r.doc_id for r in docs.select("doc_id").distinct().collect()})
        if i == 3:
            texts = {r.doc_id: r for r in docs.collect()}
    bad = {i for i in range(160) if i % 8 == 3}
    assert not kept[0] & bad and set(range(160)) - bad <= kept[0]
    assert kept[1] == kept[0] - {202, 203, 204}
    assert kept[2] == kept[1] - {200, 201}
    assert kept[3] == kept[2] == kept[4]
    assert "common5" not in texts[10].text and "common5" not in texts[12].text and texts[10].n_chars == len(texts[10].text)
    assert texts[8].text == rows[8][1]
    total = {}
    for r in docs.collect():
        total[r.doc_id] = total.get(r.doc_id, 0) + r.length
        assert r.doc_tokens >= r.length > 0
    assert all(total[r.doc_id] == r.doc_tokens for r in docs.collect())


def test_stages_keep_clashing_columns_and_one_row_of_an_id(spark, tmp_path):
    folder = f"file://{tmp_path}"
    tables(spark, folder)
    clashes = ["score", "accepted", "language", "n_words", "n_removed", "place", "chunk", "row", "node", "rows", "found", "component_id"]
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("*", *(F.concat(F.lit(f"{c} "), F.col("doc_id").cast("string")).alias(c) for c in clashes))
    again = docs.where("doc_id = 6").withColumn("text", F.concat(F.lit("a "), F.col("text"), F.lit(" z")))
    docs = docs.unionByName(again).unionByName(docs.where("doc_id = 8").withColumn("doc_id", F.lit(None).cast("long")))
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        out = stage(spark, docs, folder)
        assert out.columns == docs.columns and out.schema == docs.schema
        out.write.parquet(f"{folder}/clash{i}")
        docs = spark.read.parquet(f"{folder}/clash{i}")
        rows = docs.collect()
        for r in rows:
            assert all(r[c] == f"{c} {r.doc_id if r.doc_id is not None else 8}" for c in clashes)
        if i == 2:
            (six,) = [r for r in rows if r.doc_id == 6]
            assert six.text.startswith("a ")
            assert len([r for r in rows if r.doc_id is None]) == 1


def test_run_equals_its_stages(spark, tmp_path):
    """What run() packs is what the stages keep: words by the classifiers, one text of each group, no repeated passage."""
    import public_tokenizers
    from strainframe.llm import packing

    folder = f"file://{tmp_path}"
    rows = tables(spark, folder)
    got = {}
    for r in corpus_pipeline.run(spark, folder).collect():
        got.setdefault(r.doc_id, []).append(r)
    t = packing.tokenizer_at(public_tokenizers.path("word_bpe_49k.json"))
    passage = " ".join(f"common{i}" for i in range(60))
    assert set(got) == {i for i in range(160) if i % 8 != 3}
    for key, pieces in got.items():
        text = rows[key][1]
        if passage in text:
            text = " ".join(text.replace(passage, " ").split())
        ids, at = [*t.encode(text, add_special_tokens=False).ids, 2], 0
        for r in sorted(pieces, key=lambda r: r.start):
            assert (r.start, r.ids_crc32, r.doc_tokens) == (at, zlib.crc32(np.array(ids[at : at + r.length], "<u4").tobytes()), len(ids))
            at += r.length
        assert at == len(ids)


def test_empty_documents(spark, tmp_path):
    folder = f"file://{tmp_path}"
    spark.createDataFrame([], COLUMNS).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    assert corpus_pipeline.run(spark, folder).count() == 0


def test_registered_queries_follow_their_contracts(spark):
    """Columns and a few values of each opN query over the smallest tables."""
    from strainframe.llm.queries import QUERIES

    sf = "/root/testdata/sf0.001"
    want = {
        1: "doc_id n_bytes payload_bytes payload_sha256 tail_crc32 media_bytes media_sha256 feature", 2: "doc_id held_out lang_pred score", 3: "doc_id held_out n_tokens n_known train_tokens base_score score",
        4: "query_id rank vec_id score", 5: "page_id payload_bytes payload_digest record_type refers_to", 6: "doc_id n_words n_removed kept_sha256", 7: "doc_id held_out score predicted",
        8: "doc_id start length ids_crc32 doc_tokens sequence_id offset", 9: "doc_id n_tokens ids_sha256 decoded_sha256", 10: "doc_id n_shingles component_id",
        11: "doc_id n_a n_b n_groups n_links n_best count_sum groups_sha256", 12: "vec_id code error label_error codebooks_sha256", 13: "doc_id held_out score predicted",
    }
    n = spark.read.parquet(f"{sf}/documents.parquet").count()
    for name, f in QUERIES.items():
        number = int(name[2:].split("_")[0])
        df = f(spark, sf)
        assert set(want[number].split()) <= set(df.columns)
        rows = df.collect()
        if number in (1, 2, 3, 6, 7, 9, 10, 11, 13):
            assert len(rows) == n == len({r.doc_id for r in rows})
        if "held_out" in df.columns:
            modulus, rest = {2: (3, 1), 3: (7, 2), 7: (5, 0), 13: (3, 1)}[number]
            assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % modulus == rest) for r in rows)


def test_failed_work_leaves_nothing_behind(spark):
    import os

    from strainframe.llm import exchange, shared

    folder = shared.shared_folder(spark).removeprefix("file://")
    df = spark.range(20).selectExpr("id doc_id", "cast(id as string) text")
    before = set(os.listdir(folder))
    try:
        with shared.scratch(spark):
            table = exchange.chunked(df, "doc_id", "text")
            assert os.path.isdir(table.place.removeprefix("file://")) and table.table.count() == 20
            shared.stored(df, "one")
            raise KeyError
    except KeyError:
        pass
    assert set(os.listdir(folder)) == before and not any(t.name == table.name for t in spark.catalog.listTables())
    with shared.scratch(spark):
        table = exchange.chunked(df, "doc_id", "text")
        kept = shared.stored(table.table.select("doc_id"), "kept")
    assert kept.count() == 20 and len(set(os.listdir(folder)) - before) == 1


def test_sample_of_a_language_with_many_keys(spark):
    from pyspark.sql import functions as F

    from strainframe.llm import langid

    df = spark.range(30_000).select(F.col("id").alias("k"), F.when(F.col("id") % 10 == 0, "b").otherwise("a").alias("l"), F.concat(F.lit("t"), (F.col("id") % 9).cast("string"), F.lit(" some text")).alias("t"))
    df = df.unionByName(df.where("l = 'b'"))
    model = langid.fit(df, "k", "t", "l", learn=F.lit(True), per_language=1200)
    first = {lang: [r.k for r in df.where(F.col("l") == lang).select("k", F.xxhash64("k").alias("h")).distinct().orderBy("h", "k").limit(1200).collect()] for lang in "ab"}
    same = langid.fit(df.where(F.col("k").isin(first["a"] + first["b"])), "k", "t", "l", learn=F.lit(True), per_language=1200)
    assert (model.weights == same.weights).all() and (model.trust == same.trust).all()
