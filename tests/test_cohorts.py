"""Cohort mergers, size limits and neighbour joining."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from strainframe.operators import cohorts as C
from strainframe.operators import pairs as P
from strainframe.sources import cohorts as M


def test_large_cohorts_are_refused_whole(spark):
    pairs = [(g, f"{g}{i:02}", f"{g}{j:02}", 0.1) for g, n in (("x", 6), ("y", 5), ("z", 2)) for j in range(n) for i in range(j)]
    df = spark.createDataFrame(pairs, "group string, a string, b string, distance double")
    kept, refused = C.bounded(df, 5)
    assert [tuple(r) for r in refused.collect()] == [("x", 6, "more_than_5_members")]
    assert {r.group: r.n for r in kept.groupBy("group").agg(F.count("*").alias("n")).collect()} == {"y": 10, "z": 1}
    assert C.bounded(df)[1].count() == 0


def joined_plainly(names, matrix):
    """Neighbour joining with a new matrix each round; edges only."""
    labels, apart, edges, made = [str(n) for n in names], matrix.astype(float).copy(), [], 0
    while len(labels) > 2:
        n, total = len(labels), apart.sum(axis=1)
        q = (n - 2) * apart - total[:, None] - total[None, :]
        np.fill_diagonal(q, np.inf)
        i, j = sorted(divmod(int(q.argmin()), n))
        made += 1
        left = apart[i, j] / 2 + (total[i] - total[j]) / (2 * (n - 2))
        edges += [(labels[i], f"inner{made}", left), (labels[j], f"inner{made}", apart[i, j] - left)]
        row, keep = (apart[i] + apart[j] - apart[i, j]) / 2, [k for k in range(n) if k not in (i, j)]
        apart = np.block([[apart[np.ix_(keep, keep)], row[keep][:, None]], [row[keep][None, :], np.zeros((1, 1))]])
        labels = [labels[k] for k in keep] + [f"inner{made}"]
    return [*edges, (labels[0], labels[1], apart[0, 1])]


@pytest.mark.parametrize("ties", [True, False])
def test_neighbour_joining_makes_the_same_edges(ties):
    rng = np.random.default_rng(5)
    n = 40
    m = rng.integers(1, 6, (n, n)) / 25 if ties else rng.random((n, n))
    m = np.triu(m, 1) + np.triu(m, 1).T
    names = [f"s{i}" for i in range(n)]
    rows = C.neighbour_joining(names, m)
    got = {frozenset((node, parent)): length for node, parent, length in rows if parent is not None}
    want = {frozenset(e[:2]): e[2] for e in joined_plainly(names, m)}
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-9 for k in want)


def test_mergers(spark):
    samples = spark.createDataFrame([("m1", "a", "x", "/w/a"), ("m2", "b", "y", "/w/b"), ("m2", "c", "z", "/w/c")], "member string, sample_id string, label string, assembly_reference string")
    loci = spark.createDataFrame([(m, "s", "1", locus) for m in ("m1", "m2") for locus in ("l1", "l2")], "member string, scheme string, version string, locus string")
    calls = spark.createDataFrame([("m1", "a", "s", "1", "l1", "5"), ("m2", "b", "s", "1", "l2", "6"), ("m2", "c", "s", "1", "l1", "7")], "member string, sample_id string, scheme string, version string, locus string, allele string")
    status = spark.createDataFrame([("m1", "complete"), ("m2", "complete")], "member string, status string")
    planned = spark.createDataFrame([("a",), ("b",), ("c",)], "sample_id string")
    assert M.merger_problems(planned, status, samples, calls, loci).count() == 0
    whole = M.merged(samples, calls, loci)
    assert whole["samples"].count() == 3 and whole["catalogues"].count() == 2 and whole["calls"].select("catalogue").distinct().count() == 1
    proof = lambda cohort: {(r.table, r.name, r.only_merged, r.only_members) for r in M.proof(cohort, samples, calls, loci, free=["assembly_reference"]).collect()}
    assert proof(whole) == set()
    moved = whole | {"samples": whole["samples"].withColumn("assembly_reference", F.lit("elsewhere"))}
    assert proof(moved) == set()
    changed = whole | {"samples": whole["samples"].withColumn("label", F.when(F.col("sample_id") == "b", "?").otherwise(F.col("label"))), "calls": whole["calls"].unionByName(whole["calls"].where("sample_id = 'c'"))}
    assert proof(changed) == {("samples", "b", 1, 1), ("calls", "c", 1, 0)}
    odd = M.merger_problems(planned.unionByName(spark.createDataFrame([("d",)], "sample_id string")).where("sample_id != 'a'"), status.withColumn("status", F.when(F.col("member") == "m2", "failed").otherwise(F.col("status"))), samples.unionByName(samples.where("sample_id = 'c'")), calls.withColumn("locus", F.when(F.col("sample_id") == "a", "l9").otherwise(F.col("locus"))), loci)
    assert {tuple(r) for r in odd.collect()} == {("m2", "incomplete"), ("d", "planned_but_missing"), ("m1", "not_planned"), ("m2", "repeated_sample"), ("m1", "call_outside_catalogue")}


def test_cohorts_from_classes_equal_first_fit_of_samples(spark):
    rng = np.random.default_rng(3)
    # Few kinds of called loci, databases and scopes, so that samples repeat; some have too few calls or none.
    kinds = [[k for k in range(6) if rng.random() < 0.8] for _ in range(9)] + [[], [0], list(range(6))]
    shas, scopes = ["", "A", "b"], ["x", "y", None]
    rows = [(i, kinds[rng.integers(len(kinds))], shas[rng.integers(3)], scopes[rng.choice(3, p=[0.6, 0.3, 0.1])]) for i in range(150)]
    profiles = spark.createDataFrame([(i, "sp", scope, sha, "loci", 6) for i, _, sha, scope in rows], "sample_id long, species_key string, scope string, database_sha256 string, loci_key string, n_loci int")
    calls = spark.createDataFrame([(i, f"l{k}", str(i % 4)) for i, own, _, _ in rows for k in own], "sample_id long, locus string, allele string")
    fits = lambda p, q: p[3] is not None and p[3] == q[3] and (not p[2] or not q[2] or p[2] == q[2]) and len(set(p[1]) & set(q[1])) / 6 >= 0.6
    cohorts: list[list[tuple]] = []
    for s in rows:
        home = next((k for k in cohorts if all(fits(m, s) for m in k)), None)
        cohorts.append([s]) if home is None else home.append(s)
    members = P.cohort_members(profiles, calls, 0.6)
    numbers = {r.sample_id: r.cohort for r in P.numbered_cohorts(profiles, members).collect()}
    assert numbers == {m[0]: i for i, k in enumerate(cohorts, 1) for m in k}
    assert {(r.group, r.a, r.b): round(r.distance, 9) for r in P.member_pairs(members, calls).collect()} == {(r.group, r.a, r.b): round(r.distance, 9) for r in P.cohort_pairs(profiles, P.comparable_pairs(profiles, calls, 0.6)).collect()}
    kept, sizes = C.bounded_members(members, 10)
    assert {r.group: (r.members, r.reason) for r in sizes.collect()} == {k[0][0]: (len(k), "more_than_10_members" if len(k) > 10 else None) for k in cohorts if len(k) > 1}
    assert {r.sample_id for r in kept.collect()} == {m[0] for k in cohorts if 1 < len(k) <= 10 for m in k}
