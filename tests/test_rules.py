"""Scalar rules, pairs and statistics on small literal tables."""

import datetime as dt
import json
import time

import pytest
from pyspark.sql import functions as F

from strainframe.functions import dates as D
from strainframe.functions import scalars as S
from strainframe.operators import aggregates as A
from strainframe.operators import identity as I
from strainframe.operators import pairs as P
from strainframe.operators import validate as X
from strainframe.sources import bundle, newick, readers


def values(spark, texts, *columns):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return [tuple(r)[1:] for r in df.select("i", *columns).orderBy("i").collect()]


CODES = [
    ("0,0,197,0,4,0,93,0,0,0", "complete", 10), ("0_0_197_0_4_0_93", "partial", 7), ("0,0,197,0,4,-,-,-,-,-", "partial", 5), ("0,0,197,0,4,*f26e", "partial", 5),
    ("", "missing", 0), (None, "missing", 0), ("N/A", "missing", 0), ("0,0,bad,0,4", "malformed", 0), ("0,0,-,0,4", "malformed", 0), (",".join("0" * 11), "malformed", 0), ("0,-1,2", "malformed", 0),
]


def test_lineage_codes(spark):
    got = values(spark, [c[0] for c in CODES], S.lineage_status(F.col("t")), F.size(S.lineage_components(F.col("t"))))
    assert got == [c[1:] for c in CODES]


def test_alleles(spark):
    texts = [None, "0", "", "-", "?", "null", "unknown", "007", "A" * 40, "x1", "1.5"]
    assert [g[0] for g in values(spark, texts, S.model_allele(F.col("t")))] == [None] * 7 + ["007", "A" * 40, "x1", "1.5"]
    assert [g[0] for g in values(spark, texts, S.comparable_allele(F.col("t")))] == [None] * 7 + ["7", "a" * 40, None, None]


def test_ingested_dates(spark):
    texts = ["2018", "2018-02", "2020-02-29", "2018/2019", "2019-02-31", "2019/2018", "", None]
    got = values(spark, texts, *D.ingest(F.col("t")))
    assert [g[2] for g in got] == ["year", "month", "day", "interval", "invalid", "invalid", "missing", "missing"]
    assert got[1][:2] == (dt.date(2018, 2, 1), dt.date(2018, 2, 28)) and got[4][:2] == (None, None)


def test_clock_dates(spark):
    good = ["1980-XX-XX", "1980-05-XX", "1980-XX-17", "1980.5", "[1980:1981.5]"]
    bad = ["[1982:1980]", "nan", "1980-13-XX", "1980-02-30", "before 1980", "1980-XX"]
    got = values(spark, good + bad + ["2050"], D.clock_bounds(F.col("t"), "2001-12-31")["status"])
    assert [g[0] for g in got] == ["valid"] * 5 + ["invalid"] * 6 + ["future"]


def test_given_bounds_must_fit_their_precision(spark):
    d = dt.date
    rows = [(0, d(2000, 2, 1), d(2000, 2, 29), "month"), (1, d(2000, 2, 1), d(2000, 2, 28), "month"), (2, d(2000, 1, 1), d(2000, 12, 31), "year"), (3, d(2000, 5, 1), d(2000, 5, 2), "day"), (4, d(2000, 5, 1), d(2000, 5, 2), None), (5, d(2000, 5, 2), d(2000, 5, 1), "interval")]
    df = spark.createDataFrame(rows, "i int, s date, e date, p string")
    got = [r.status for r in df.select("i", D.canonical(F.lit(None), F.col("s"), F.col("e"), F.col("p")).alias("d")).select("i", "d.status").orderBy("i").collect()]
    assert got == ["valid", "invalid", "valid", "invalid", "valid", "invalid"]


def profiles(spark, rows, loci=4):
    """rows: (id, role, alleles, version, sha)"""
    p = spark.createDataFrame([(i, r, "s", None if v is None else f"scheme|{v}", sha, "l", loci) for i, r, _, v, sha in rows], "sample_id string, role string, species_key string, scope string, database_sha256 string, loci_key string, n_loci int")
    c = spark.createDataFrame([(i, f"l{k}", a) for i, _, alleles, _, _ in rows for k, a in enumerate(alleles) if a is not None], "sample_id string, locus string, allele string")
    return p, c


MIXED = [("a", "input", "1234", "1", ""), ("b", "context", ["900000", "2", None, "4"], "1", ""), ("c", "context", ["1", None, "3", "9"], "1", ""), ("d", "context", [None, None, "3", "4"], "1", ""), ("e", "context", "1234", "1", "a" * 64), ("f", "context", "1234", "1", "b" * 64), ("g", "context", "1234", None, ""), ("h", "context", [None] * 4, "1", "")]


def test_pairs_reasons_and_audit_reconcile(spark):
    p, c = profiles(spark, MIXED)
    every = {(r.a, r.b): r for r in P.all_pairs(p, c, 0.6).collect()}
    assert len(every) == 28
    assert every["a", "b"].diff == 1 and every["a", "b"].shared == 3
    assert every["e", "f"].reason == every["a", "g"].reason == "incompatible_or_unversioned_scheme"
    assert every["a", "h"].reason == every["g", "h"].reason == "profile_unavailable"
    assert every["b", "d"].reason == "insufficient_called_overlap" and every["b", "d"].distance is None
    counts = {}
    for r in every.values():
        counts[r.reason or "comparable"] = counts.get(r.reason or "comparable", 0) + 1
    assert {r.reason: r.n for r in P.pair_audit(p, c, 0.6).collect()} == counts
    assert {r.sample_id: r.reason for r in P.self_exclusions(p, c, 0.6).collect()} == {"d": "insufficient_called_overlap", "g": "incompatible_or_unversioned_scheme", "h": "profile_unavailable"}
    plain = [r for r in MIXED if r[3] == "1" and not r[4]]
    p, c = profiles(spark, plain)
    key = lambda df: sorted((r.a, r.b, r.diff, r.shared) for r in df.collect())
    assert key(P.packed_pairs(c, 0.6, 4, block=2)) == key(P.comparable_pairs(p, c, 0.6))


@pytest.mark.parametrize("rows, overlap, want", [
    ([("q", "input", "1111"), ("a", "context", ["99999", "1", "1", "1"]), ("b", "context", "2111")], 0.6, [("a", 1, 2), ("b", 1, 2)]),
    ([("q", "input", "1111"), ("a", "context", ["2", None, None, "1"]), ("b", "context", "2211")], 0.5, [("a", 1, 1)]),
    ([("q", "input", "1111"), ("a", "context", ["1", None, None, None])], 0.6, [(None, None, None)]),
])
def test_nearest_by_raw_count_with_ties(spark, rows, overlap, want):
    p, c = profiles(spark, [(*r, "1", "") for r in rows])
    found = P.nearest_with_ties(P.comparable_pairs(p, c, overlap).select("a", "b", "diff", "shared", "distance"), p.withColumn("country", F.lit(None).cast("string")))
    assert sorted(((r.context_id, r.diff, r.ties) for r in found.collect()), key=str) == want


def test_snp_pairs(spark):
    s = spark.createDataFrame([("L1", "ACGTNN"), ("L2", "ATGTAA"), ("C1", "NNNNNN"), ("X", "")], "sample_id string, seq string").where("seq != ''")
    got = {(r.a, r.b): (r.snps, r.callable, r.proportion) for r in P.snp_pairs(s).collect()}
    assert got[("L1", "L2")] == (1, 4, 0.25) and got[("C1", "L1")] == (0, 0, None)
    long = spark.createDataFrame([("a", "ACGT" * 20 + "A"), ("b", "ACGA" * 20 + "C")], "sample_id string, seq string")
    assert P.snp_pairs(long).first()[2:4] == (21, 81)


def test_false_discovery(spark):
    df = spark.createDataFrame([(1, None), (2, 0.5), (3, 0.04), (4, 0.001)], "i int, p double")
    assert [r.q if r.q is None else round(r.q, 9) for r in A.false_discovery(df).orderBy("i").collect()] == [None, 0.5, 0.06, 0.003]


def test_regression(spark):
    rows = [("g", 2000.0, 3.0), ("g", 2001.0, 2.0), ("g", 2002.0, 1.0), ("flat", 2000.0, 1.0), ("flat", 2001.0, 1.0), ("flat", 2002.0, 1.0), ("two", 2000.0, 1.0), ("two", 2000.0, 2.0), ("two", 2001.0, 2.0)]
    got = {r["k"]: r for r in A.regression(spark.createDataFrame(rows, "k string, x double, y double"), "k").collect()}
    assert (got["g"].slope, got["g"].reference, got["g"].centre, got["g"].r, got["g"].r2) == (-1, 2001, 2, -1, 1)
    assert got["flat"].slope == 0 and got["flat"].r is None and got["flat"].r2 is None
    assert got["two"].status == "insufficient_data" and got["two"].slope is None


def test_screen_flags_only_isolated_samples(spark):
    rows = [(a, b, 0.5 if b == 9 else 0.001 + 1e-5 * (a + b)) for b in range(10) for a in range(b)]
    got = A.screen(spark.createDataFrame(rows, "a int, b int, d double"), "d", 10, 5).collect()
    assert [r.sample_id for r in got if r.flagged] == [9]
    equal = spark.createDataFrame([(a, b, 0.0) for b in range(4) for a in range(b)], "a int, b int, d double")
    assert {(r.robust_z, r.ratio, r.flagged) for r in A.screen(equal, "d", 10, 5).collect()} == {(0.0, 1.0, False)}


def test_identity_components(spark):
    rows = [(1, "x"), (2, "x"), (2, "y"), (3, "z"), (4, "y"), (5, "q")]
    assert {r.id: r.unit for r in I.connected(spark.createDataFrame(rows, "id long, alias string")).collect()} == {1: 1, 2: 1, 4: 1, 3: 3, 5: 5}
    chain = [(i, f"a{i}") for i in range(60)] + [(i, f"a{i + 1}") for i in range(60)]
    assert {r.unit for r in I.connected(spark.createDataFrame(chain, "id long, alias string")).collect()} == {0}


def test_disagreeing_matches_are_a_conflict(spark):
    rows = spark.createDataFrame([(1, ["a"]), (2, ["b", "c"]), (3, ["z"])], "id long, ids array<string>")
    given = spark.createDataFrame([("a", "x"), ("a", "x"), ("b", "x"), ("c", "y")], "src string, code string")
    got = {r.id: (r.status, r.code, r.matches) for r in I.annotate(rows, F.col("ids"), given, "src", F.col("code"), "code").collect()}
    assert got == {1: ("assigned", "x", 2), 2: ("conflict", None, 2), 3: ("missing", None, 0)}


def test_allele_export(spark):
    df = spark.createDataFrame([("A", "g1", "2"), ("A", "g2", "3"), ("A", "g2", "4"), ("A", "g3", "0"), ("A", "g1", " 2 ")], "s string, l string, a string")
    got = {r.locus: (r.allele, r.status) for r in readers.allele_export(df, "s", "l", "a").collect()}
    assert got == {"g1": ("2", "called"), "g2": (None, "ambiguous"), "g3": (None, "missing")}


def test_newick():
    rows = newick.parse("((q:1,'c 1':1)x:1[note],(c2:1,c3:-4e-1):1);")
    assert [r[0] for r in rows if r[0].startswith("c")] == ["c 1", "c2", "c3"] and ("x", "inner1", 1.0) in rows
    assert newick.parse(newick.written(rows)) and sorted(map(str, newick.parse(newick.written(rows)))) == sorted(map(str, [(("inner1" if a is None else a), b, c) for a, b, c in rows]))
    for bad in ("((a,b);", "(a,,b);", "(a,a);"):
        with pytest.raises((ValueError, TypeError, IndexError)):
            newick.parse(bad)


def test_bundle_detects_changes(spark, tmp_path):
    at = f"file://{tmp_path}/b"
    df = spark.createDataFrame([(1, "x"), (2, None), (2, "")], "i int, t string")
    bundle.write_bundle({"t": df, "u": df.where("i = 1")}, at)
    assert sorted(map(tuple, bundle.read_bundle(spark, at)["t"].collect()), key=str) == sorted([(1, "x"), (2, None), (2, "")], key=str)
    df.limit(1).write.mode("append").parquet(f"{at}/u")
    with pytest.raises(ValueError):
        bundle.read_bundle(spark, at)
    with pytest.raises(Exception):
        bundle.write_bundle({"t": df}, at)


def test_bins(spark):
    good = [("a", 0, 50), ("a", 50, 100), ("b", 0, 60), ("b", 50, 90)]
    got = {(r.group, r.rule) for r in X.bins_violations(spark.createDataFrame(good, "group string, least int, most int"), 0, 100).collect()}
    assert got == {("b", "overlap"), ("b", "wrong_end")}


def test_lineage_exports_are_cut_once_each(spark, tmp_path):
    n = 30_000
    (tmp_path / "a.json").write_text(json.dumps([{"Source genome_ID": str(i), "LIN code": f"{i % 7}_1"} for i in range(n)]))
    (tmp_path / "b.tsv").write_text("source-genome-id\tLINcode\n" + "\n".join(f"t{i}\t{i % 7}_1" for i in range(n)))
    (tmp_path / "c.csv").write_text("Source Genome Id,LIN code\nx\n,5\ny,\n")
    (tmp_path / "d.csv").write_text("Source Genome Id,LIN code\n")
    begun = time.monotonic()
    good, bad = readers.lineage_export(spark, f"file://{tmp_path}")
    assert {(r.id, r.code) for r in good.collect()} == {(f"{t}{i}", f"{i % 7}_1") for t in ("", "t") for i in range(n)} | {("x", ""), ("y", "")}
    assert sorted(r.file.rpartition("/")[2] for r in bad.collect()) == ["c.csv", "d.csv"]
    assert time.monotonic() - begun < 60
