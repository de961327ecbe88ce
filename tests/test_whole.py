"""Queries over tables that reach beyond fixed ids and bins, against brute force."""

import hashlib
from itertools import combinations

import duckdb
import pytest

from strainframe.plans import catalogue

from .test_queries import TABLES, rows

SUPPLIERS = 171
#: Queries whose tables reach beyond small fixed ids or bins, and the scale factor on which they are held against their SQL.
LARGER = {
    "f06_compatible_typing": "0.01", "f28_prefix_relation": "0.01", "j15_direct_dna": "0.01", "a36_fixed_panel": "0.01", "j08_focal_resolution": "0.01", "t15_degrees": "0.01",
    "t11_connected_units": "0.01", "a12_unit_summary": "0.01", "t21_ego_network": "0.01", "f23_period_comparison": "0.01", "a24_binned_profile": "0.1", "u01_captured_stream": "0.01", "j17_bin_branches": "0.01",
}


@pytest.mark.parametrize("name", sorted(LARGER))
def test_whole_tables(spark, name):
    at, duck = f"/root/testdata/sf{LARGER[name]}", duckdb.connect()
    for t in TABLES:
        duck.execute(f"CREATE VIEW {t} AS SELECT * FROM '{at}/{t}.parquet'")
    want = rows(duck.execute(catalogue.ORACLES[name]).fetchdf())
    assert rows(catalogue.QUERIES[name](spark, at).toPandas()) == want


@pytest.fixture(scope="module")
def wide(spark, tmp_path_factory):
    """A folder with suppliers 0 to 170, their nations and regions."""
    at = str(tmp_path_factory.mktemp("wide"))
    for t in ("nation", "region"):
        spark.read.parquet(f"/root/testdata/sf0.001/{t}.parquet").write.parquet(f"{at}/{t}.parquet")
    spark.range(SUPPLIERS).selectExpr("id s_suppkey", "id % 25 s_nationkey", "cast(id as double) s_acctbal").write.parquet(f"{at}/supplier.parquet")
    return at


def got(spark, name, at):
    return [tuple(r) for r in catalogue.QUERIES[name](spark, at).collect()]


def smallest(ids, links):
    """The smallest id of each id's component."""
    up = {i: i for i in ids}

    def top(i):
        while up[i] != i:
            i = up[i]
        return i

    for a, b in links:
        a, b = sorted((top(a), top(b)))
        up[b] = a
    return {i: top(i) for i in ids}


def sequence(i):
    digest = "".join(hashlib.md5(str(k).encode()).hexdigest() for k in (i % 40, i % 7))
    return digest.translate(str.maketrans("0123456789abcdef", "ACGTACGTACGTACGN"))


def test_all_sequences(spark, wide):
    seqs = {i: sequence(i) for i in range(SUPPLIERS)}
    want = {}
    for a, b in combinations(seqs, 2):
        both = [(x, y) for x, y in zip(seqs[a], seqs[b], strict=True) if "N" not in (x, y)]
        want[a, b] = (sum(x != y for x, y in both), len(both))
    found = got(spark, "j04_snp_pairs", wide)
    assert len(found) == len(want)
    assert {r[:2]: r[2:4] for r in found} == want
    # Inputs are multiples of ten; each has one nearest context.
    near = {}
    for (a, b), (snps, sites) in want.items():
        for x, y in ((a, b), (b, a)):
            if x % 10 == 0 and y % 10:
                near[x] = min(near.get(x, (99,)), (snps, -sites, y))
    assert {r[0]: (r[2], -r[3], r[1]) for r in got(spark, "j05_nearest_single", wide)} == near
    linked = [p for p, (snps, sites) in want.items() if sites and snps <= 25]
    assert dict(got(spark, "c03_single_linkage", wide)) == smallest(seqs, linked)
    assert {r[:2]: (r[3], r[2]) for r in got(spark, "f31_sequence_stats", wide)} == {p: v for p, v in want.items() if p[0] + 1 == p[1]}
    assert sum(r[1] for r in got(spark, "s19_s20_fasta", wide)) == SUPPLIERS


def test_sites_of_all_sequences(spark, wide):
    columns = list(zip(*(sequence(i) for i in range(SUPPLIERS)), strict=True))
    assert sorted(got(spark, "a22_complete_sites", wide)) == [(i, "N" not in x, len(set(x))) for i, x in enumerate(columns, 1)]
    masks = {(a, p): any(sequence(i)[p - 1] == "N" for i in range(a, SUPPLIERS, 3)) for a in range(3) for p in range(1, 65)}
    assert {r[:2]: r[2] for r in got(spark, "a23_strict_mask", wide)} == masks


def test_all_identities(spark, tmp_path):
    """800 records in units of up to six, most of them beyond id 300."""
    rows = [(i, i // 100, float(i * 7919 % 1000)) for i in range(800)]
    spark.createDataFrame(rows, "c_custkey bigint, c_nationkey bigint, c_acctbal double").write.parquet(f"{tmp_path}/customer.parquet")
    sample = {i: i % 400 for i, _, _ in rows}
    run = {i: i % 37 * 1000 + n for i, n, _ in rows}
    links = [(a, b) for a, b in combinations(sample, 2) if sample[a] == sample[b] or run[a] == run[b]]
    unit = smallest(sample, links)
    assert dict(got(spark, "t11_connected_units", tmp_path)) == unit
    country = {i: None if i % 6 == 0 else n % 9 for i, n, _ in rows}
    want = {}
    for u in set(unit.values()):
        own = [i for i in unit if unit[i] == u]
        names = {country[i] for i in own} - {None}
        best = max(own, key=lambda i: (rows[i][2], -i))
        reason = "conflicting_samples" if len({sample[i] for i in own}) > 1 else "duplicate" if len(own) > 1 else "retained"
        want[u] = (len(own), best, len(names), len(names) > 1, reason)
    assert {r[0]: r[1:] for r in got(spark, "a12_unit_summary", tmp_path)} == want


def test_all_bins_of_branches(spark, tmp_path):
    """Intervals that begin at part keys up to 4,970, one for each supplier."""
    spark.range(72).selectExpr("id l_suppkey", "id * 70 l_partkey", "cast(id % 50 + 1 as double) l_quantity", "id l_orderkey").write.parquet(f"{tmp_path}/lineitem.parquet")
    want = {}
    for i in range(72):
        for b in {i * 70 // 100, (i * 70 + i % 50) // 100}:
            want[b] = want.get(b, 0) + 1
    assert max(want) > 20
    assert sorted(got(spark, "j17_bin_branches", tmp_path)) == [(b, n, n) for b, n in sorted(want.items())]
