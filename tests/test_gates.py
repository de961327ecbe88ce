"""Checked sources and matrices on small files and tables."""

import gzip
import io
import sqlite3
import zipfile

import pytest

from strainframe.operators import matrix
from strainframe.sources import gates

GOOD = b">a note\nACGT\nNN\n\n>b\nRYK\n"


@pytest.mark.parametrize(
    ("content", "problem"),
    [(GOOD, None), (gzip.compress(GOOD), None), (gzip.compress(GOOD)[:-9], "corrupt_gzip"), (b"", "not_fasta"), (b"ACGT", "not_fasta"), (b">a\nAC-GT", "invalid_characters"), (b">a\n>b\nA", "empty_contig"), (b">a\nA\n>b\n", "empty_contig"), (">a\né".encode(), "not_ascii")],
)
def test_assembly_problems(content, problem):
    contigs, bases, found = gates.assembly_problem(content)
    assert found == problem
    if problem is None:
        assert (contigs, bases) == (2, 9)


def test_archive_members(spark, tmp_path):
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w") as z:
        for name, raw in (("x/g1.fasta", GOOD), ("g2.FNA.gz", gzip.compress(GOOD)), ("g3.fa", b"no"), ("other.fa", GOOD), ("a/g4.fa", GOOD), ("b/g4.fa", GOOD)):
            z.writestr(name, raw)
    (tmp_path / "one.zip").write_bytes(buffer.getvalue())
    (tmp_path / "bad.zip").write_bytes(b"not an archive")
    wanted = spark.createDataFrame([("g1", "s1"), ("g2", "s2"), ("g3", "s3"), ("g4", "s4")], "stem string, source string")
    got = {(r.member, r.source, r.bases, r.problem) for r in gates.archive_members(spark, str(tmp_path), wanted).collect()}
    assert got == {("x/g1.fasta", "s1", 9, None), ("g2.FNA.gz", "s2", 9, None), ("g3.fa", "s3", 0, "not_fasta"), ("other.fa", None, 9, "not_requested"), ("a/g4.fa", "s4", 9, "repeated_id"), ("b/g4.fa", "s4", 9, "repeated_id"), (None, None, 0, "not_zip")}


def test_allele_index_files(spark, tmp_path):
    path = tmp_path / "alleles.db"
    with sqlite3.connect(path) as index:
        index.execute("CREATE TABLE alleles (hash TEXT, gene TEXT, st INTEGER, reverse INTEGER)")
        index.executemany("INSERT INTO alleles VALUES (?, ?, ?, ?)", [("a" * 40, "l", 1, 0), ("b" * 40, "l", 1, 1), ("c" * 40, "l", 2, 0), ("d" * 40, "l", 2, 0), ("e" * 40, "m", 1, 0), ("short", "l", 3, 0), ("f" * 40, "l", 0, 0)])
    index.close()
    good, bad = gates.allele_index(spark, str(path), spark.createDataFrame([("l",)], "locus string"))
    assert [tuple(r) for r in good.collect()] == [("l", "1", "a" * 40)]
    assert {tuple(r) for r in bad.collect()} == {("l", "2", "conflicting_sequences"), ("m", "1", "unknown_locus"), ("l", "3", "invalid_digest"), ("l", "0", "invalid_number")}


def test_evidence_problems():
    cases = {None: "missing", "{": "not_json", "[1, NaN]": "not_finite", '{"a": {"API-KEY": 1}}': "secret_key", '{"a": [1.5, null, "token"]}': None, "1e999": "not_finite"}
    assert {k: gates.evidence_problem(k) for k in cases} == cases


def test_matrix_of_empty_and_wrong_tables(spark):
    calls = spark.createDataFrame([("b", "l1", "x"), ("a", "l2", "y"), ("a", "l1", None), ("b", "l2", "y")], "sample_id string, locus string, allele string")
    vocabulary, codes = matrix.coded(calls, ["sample_id", "locus"])
    assert {r.allele: r.code for r in vocabulary.collect()} == {"y": 1, "x": 2}
    assert {(r.sample_id, r.locus): r.code for r in codes.collect()} == {("a", "l1"): 0, ("a", "l2"): 1, ("b", "l1"): 2, ("b", "l2"): 1}
    ids = spark.createDataFrame([("a",), ("b",)], "sample_id string")
    loci = spark.createDataFrame([("l1",), ("l2",)], "locus string")
    assert matrix.matrix_problems(ids, loci, vocabulary, codes).count() == 0
    wrong = matrix.matrix_problems(ids.unionByName(ids.limit(1)).unionByName(spark.createDataFrame([("no/path",)], "sample_id string")), loci.limit(1), vocabulary.unionByName(spark.createDataFrame([(3, " ")], "code int, allele string")), codes.unionByName(codes).withColumn("code", codes["code"] - 1))
    assert {r.problem for r in wrong.collect()} == {"repeated_sample", "unsafe_sample", "missing_category", "code_out_of_range", "unknown_locus", "repeated_cell"}
    none = calls.where("1 = 0")
    assert matrix.coded(none, ["sample_id", "locus"])[0].count() == 0


def test_assemblies_are_files_of_few_folders(spark, tmp_path, monkeypatch):
    from strainframe.plans import q_gates

    monkeypatch.setattr(q_gates, "place", lambda _spark, _label: f"file://{tmp_path}/assemblies")
    found = q_gates.s29_fasta_gate(spark, "/root/testdata/sf0.01").collect()
    assert sum(r.files for r in found) == 100
    assert [p.name for p in (tmp_path / "assemblies").iterdir()] == ["0"]
