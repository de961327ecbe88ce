"""Records to datasets and distance evidence: whole tables against SQL, and what must be refused."""

import json

import duckdb
import pytest

from strainframe.plans import catalogue
from strainframe.sources import records as R

from .test_queries import TABLES, rows

LARGER = ["s03_restored_samples", "s04_frozen_records", "s05_dataset_members", "s05_dataset_calls", "s06_canonical_samples", "s07_derived_evidence", "s23_v05_distance_evidence"]


@pytest.mark.parametrize("name", LARGER)
def test_whole_tables(spark, name):
    at, duck = "/root/testdata/sf0.1", duckdb.connect()
    for t in TABLES:
        duck.execute(f"CREATE VIEW {t} AS SELECT * FROM '{at}/{t}.parquet'")
    assert rows(catalogue.QUERIES[name](spark, at).toPandas()) == rows(duck.execute(catalogue.ORACLES[name]).fetchdf())


def parsed(spark, *given):
    return spark.createDataFrame([(json.dumps(g),) for g in given], "v string").selectExpr("try_variant_get(parse_json(v), '$', 'map<string,variant>') record")


def test_files_of_records(spark, tmp_path):
    cases = {
        "a": [{"sample_id": "x", "species": "One"}, 3, {"sample_id": "y", "species": "two", "origin": "context"}],
        "b": {"records": [], "parameters": {}}, "c": {"records": [{"sample_id": "z"}], "lineages": {}}, "d": {"records": [{"sample_id": "z"}], "parameters": []}, "e": [],
    }
    for name, case in cases.items():
        (tmp_path / f"{name}.json").write_text(json.dumps(case))
    good, bad = R.frozen_records(spark, str(tmp_path), species="ONE")
    got = good.select(R.field("sample_id").alias("id"), R.field("role").alias("role"), R.field("species").alias("species")).collect()
    assert [tuple(r) for r in got] == [("x", "input", "ONE")]
    assert sorted((r.file[-6], r.ordinal, r.problem) for r in bad.collect() if r.ordinal is None) == [("b", None, "no_records"), ("c", None, "malformed_section"), ("d", None, "malformed_section"), ("e", None, "no_records")]
    assert sorted((r.ordinal, r.problem) for r in bad.collect() if r.ordinal is not None) == [(1, "not_an_object"), (2, "other_species")]


def test_profiles_that_fit_no_or_several_catalogues(spark):
    loci = ["l1", "l2"]
    sheets = spark.createDataFrame([("s", "1", "v1", None, loci), ("s", "1", "v2", None, loci), ("s", "2", None, "ab" * 32, loci)], "scheme_id string, scheme_version string, database_version string, database_sha256 string, loci array<string>")
    base = {"cgmlst_scheme": "s", "cgmlst_scheme_version": "1", "cgmlst_profile": {"l1": "007", "l2": "?"}}
    given = [
        base | {"sample_id": "one", "cgmlst_database_version": "v1"}, base | {"sample_id": "several"}, base | {"sample_id": "none", "cgmlst_database_version": "v9"}, base | {"sample_id": "other", "cgmlst_scheme_version": None},
        base | {"sample_id": "sha", "cgmlst_scheme_version": "2", "cgmlst_database_sha256": "AB" * 32}, base | {"sample_id": "unlike", "cgmlst_scheme_version": "2"}, base | {"sample_id": "bad", "cgmlst_scheme_version": "2", "cgmlst_database_sha256": "zz"},
        {"sample_id": "bare"}, base | {"sample_id": "twice", "cgmlst_database_version": "v1"}, base | {"sample_id": "twice", "cgmlst_database_version": "v1"},
    ]
    members, calls, problems = R.profiles(parsed(spark, *given), sheets)
    assert sorted(r.sample_id for r in members.collect()) == ["one", "sha"]
    assert sorted((r.sample_id, r.locus) for r in calls.collect()) == [("one", "l1"), ("sha", "l1")]
    assert {r.sample_id: r.problem for r in problems.collect()} == {"several": "several_catalogues", "none": "no_catalogue", "other": "no_catalogue", "unlike": "no_catalogue", "bad": "invalid_fingerprint", "twice": "repeated_id"}


def test_flat_table_with_wrong_parts(spark):
    table = R.stored(parsed(spark, {"sample_id": "a", "host": None, "x": [1]}, {"sample_id": "b"}))
    spoiled = table.selectExpr("* except (extra)", "if(sample_id = 'b', '{\"host\": 1}', extra) extra").unionByName(table.where("sample_id = 'b'").selectExpr("* except (present)", "array('sample_id', 'x') present"))
    good, bad = R.restored(spoiled)
    assert [json.loads(r[0]) for r in good.selectExpr("to_json(record)").collect()] == [{"x": [1], "sample_id": "a", "host": None}]
    assert sorted(r.problem for r in bad.collect()) == ["invalid_extra", "invalid_present"]


def test_distances_that_are_blank_or_no_numbers(spark):
    row = ("a", "b", "1", "4", None, None, "0.25")
    given = [row, ("a", "c", "1", "4", "", "", ""), ("a", "d", "0", "0", None, None, "0"), ("a", "e", "1", "4", None, "x", None), ("a", "f", "1", "4", None, None, "Infinity"), ("a", "g", "true", "4", None, None, None), (None, "h", "1", "4", None, None, None)]
    pairs = spark.createDataFrame(given, "sample_id_1 string, sample_id_2 string, allele_differences string, shared_called_loci string, scheme_loci string, call_overlap string, distance string")
    got = {r.sample_id_2: r.problem for r in R.distance_problems(pairs, 4).collect()}
    assert got == {"d": "distance_disagrees", "e": "overlap_disagrees", "f": "distance_out_of_range", "g": "invalid_count", "h": "no_identifier"}
    assert R.distance_problems(pairs.limit(0), 4).collect() == []
