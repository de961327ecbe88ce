"""Typing exports, index pages, allele files and guards on small cases."""

import gzip
import json

import pytest

from strainframe.operators import guards
from strainframe.sources import exports

SCOPE = {"cgmlst_scheme": "s", "cgmlst_scheme_version": "1"}
PROFILE = SCOPE | {"cgmlst_loci": ["a", "b"], "cgmlst_profile": {"a": 7, "b": "-"}}
CLUSTERS = {"hiercc_scheme": "s", "hiercc_scheme_version": "1", "hiercc_codes": {"HC005": " 03 ", "d0": 0}}
CASES = [
    (PROFILE, None),
    (PROFILE | {"cgmlst_novel_alleles": {"b": "A" * 40}}, None),
    (PROFILE | {"cgmlst_novel_alleles": None}, None),
    (CLUSTERS, None),
    ({}, "no_assignment"),
    (PROFILE | {"source_genome_id": " g"}, "no_source_id"),
    (PROFILE | {"source_genome_id": 5}, "no_source_id"),
    (PROFILE | {"cgmlst_scheme": " "}, "no_scope"),
    (PROFILE | {"cgmlst_database_sha256": "ab"}, "invalid_fingerprint"),
    (PROFILE | {"cgmlst_loci": ["a", "a"]}, "no_locus_universe"),
    (PROFILE | {"cgmlst_loci": ["a"]}, "undeclared_loci"),
    (SCOPE | {"cgmlst_loci": ["a"]}, "undeclared_loci"),
    (PROFILE | {"cgmlst_profile": {"a": "00"}}, "invalid_allele"),
    (PROFILE | {"cgmlst_novel_alleles": {"a": "A" * 40}}, "invalid_novel_loci"),
    (PROFILE | {"cgmlst_novel_alleles": {"b": "A"}}, "invalid_novel_allele"),
    (CLUSTERS | {"hiercc_codes": [1]}, "no_codes"),
    (CLUSTERS | {"hiercc_codes": {"HC": 1}}, "invalid_code"),
    (CLUSTERS | {"hiercc_codes": {"HC5": 1, "d05": 1}}, "repeated_level"),
]


def test_public_typing(spark, tmp_path):
    for i, (row, _) in enumerate(CASES):
        (tmp_path / f"{i}.json").write_text(json.dumps([{"source_genome_id": "g"} | row]))
    (tmp_path / "90.json").write_text('{"assignments": []}')
    (tmp_path / "91.json").write_text("[")
    (tmp_path / "92.json").write_text("[1]")
    (tmp_path / "93.json").write_text(json.dumps([{"source_genome_id": "g"} | CLUSTERS, {"source_genome_id": "h"}]))
    good, bad = exports.public_typing(spark, str(tmp_path))
    number = lambda path: int(path.rsplit("/", 1)[1].split(".")[0])
    problems = {number(r.file): r.problem for r in bad.collect()}
    assert problems == {i: p for i, (_, p) in enumerate(CASES) if p} | {90: "no_assignments", 91: "not_json", 92: "not_an_object", 93: "no_assignment"}
    rows = {number(r.file): r for r in good.collect()}
    assert sorted(rows) == [0, 1, 2, 3]
    assert rows[0].calls == {"a": "7"} and rows[0].called_fraction == 0.5 and rows[0].status == "resolved"
    assert rows[1].novel == {"b": "a" * 40} and rows[1].called_fraction == 1.0
    assert rows[3].calls == {"HC5": "3", "HC0": "0"} and rows[3].ordinal == 1


def test_scheme_index(spark, tmp_path):
    (tmp_path / "a").write_text('<a href="../">up</a> 7\n<a href="x.fasta.gz">x</a> day 12\n<a href="y-1.fasta.gz">y</a> day 3\n<a href="z.fasta">z</a> 4\n')
    (tmp_path / "b").write_text("<p>nothing</p>\n")
    (tmp_path / "c").write_text('<a href="x.fasta.gz">x</a> 0\n<a href="y.fasta.gz">x</a> 5\n')
    good, bad = exports.scheme_index(spark, str(tmp_path))
    assert {(r.locus, r.bytes) for r in good.collect()} == {("x", 12), ("y-1", 3)}
    assert {(r.file[-1], r.locus, r.problem) for r in bad.collect()} == {("b", None, "no_loci"), ("c", "x", "missing_size")}


@pytest.mark.parametrize(
    ("text", "problem"),
    [(b">a x\nAC\nGT\n\n>b\r\nNN\r\n", None), (b"", "empty"), (b">a\nA\n>a\nC", "repeated_or_no_name"), (b">\nA", "repeated_or_no_name"), (b">a\n>b\nA", "empty_allele"), (b">a\nA-", "invalid_characters"), (b"A\n>a\nA", "not_fasta"), (">a\né".encode(), "not_ascii"), (b">a\n" + b"A" * 100, "too_large")],
)
def test_allele_file_problems(text, problem):
    alleles, size, found = exports.allele_file_problem(gzip.compress(text), 90)
    assert found == problem
    if problem is None:
        assert (alleles, size) == (2, len(text))
    assert exports.allele_file_problem(gzip.compress(text)[:-9])[2] == "corrupt_gzip"


def test_alignment_problems_of_good_and_empty_tables(spark):
    good = spark.createDataFrame([("a", "A-C"), ("b", "-GT")], "sample_id string, seq string")
    first = spark.createDataFrame([("a", "AC"), ("b", "GT")], "sample_id string, seq string")
    assert guards.alignment_problems(good, first).count() == 0
    none = good.where("1 = 0")
    assert {tuple(r) for r in guards.alignment_problems(none, first).collect()} == {("a", "not_aligned"), ("b", "not_aligned"), (None, "empty")}
