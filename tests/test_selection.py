"""Diverse selections and ensembles against one that looks at every pair."""

import hashlib
import random

from pyspark.sql import functions as F

from strainframe.operators import selection as L


def plain(ids, chosen, dist, size, seed):
    order = lambda s: hashlib.md5(f"{seed}|{s}".encode()).hexdigest()
    out = [(s, "mandatory") for s in sorted(chosen)]
    while len(out) < size and len(out) < len(ids):
        have = [s for s, _ in out]
        left = [s for s in ids if s not in have]
        least = {s: min(dist[min(s, o), max(s, o)] for o in have if (min(s, o), max(s, o)) in dist) for s in left if any((min(s, o), max(s, o)) in dist for o in have)}
        if least:
            top = max(least.values())
            out.append((min((s for s in least if least[s] == top), key=order), "diversity"))
        else:
            out.append((min(left, key=order), "background"))
    return [(s, i, why) for i, (s, why) in enumerate(out, 1)]


def tables(spark, n=14, seed=1):
    rng = random.Random(seed)
    dist = {(a, b): rng.randint(1, 4) / 4 for a in range(n) for b in range(a + 1, n) if (a < 9) == (b < 9)}
    pool = spark.range(n).select(F.col("id").alias("sample_id"))
    pairs = spark.createDataFrame([(a, b, d) for (a, b), d in dist.items()], "a long, b long, distance double")
    return pool, pairs, dist


def test_farthest_first_against_all_pairs(spark):
    pool, pairs, dist = tables(spark)
    chosen = pool.where("sample_id in (2, 5)")
    got = L.diverse(pool.repartition(5), chosen, pairs.repartition(3), 9, 40, runs=2).collect()
    for run in (1, 2):
        assert sorted((r.sample_id, r.position, r.reason) for r in got if r.run == run) == sorted(plain(range(14), [2, 5], dist, 9, 40 + run))
    # With nothing chosen a random sample comes first; a pool that is too small is taken whole.
    got = L.diverse(pool, chosen.where("false"), pairs, 30, 7).collect()
    assert sorted((r.sample_id, r.position, r.reason) for r in got) == sorted(plain(range(14), [], dist, 30, 8))


def test_quota_cells_come_before_distance(spark):
    pool, pairs, _ = tables(spark)
    chosen = pool.where("sample_id = 0")
    cells = pool.select("sample_id", (F.col("sample_id") % 3).cast("string").alias("cell"))
    rows = L.diverse(pool, chosen, pairs, 8, 3, runs=3, cells=cells).collect()
    for run in (1, 2, 3):
        own = sorted((r for r in rows if r.run == run), key=lambda r: r.position)
        assert [r.position for r in own] == list(range(1, 9)) and len({r.sample_id for r in own}) == 8
        assert [r.reason for r in own][:3] == ["mandatory", "quota", "quota"] and len({r.sample_id % 3 for r in own[1:3]}) == 2
    assert len({tuple(r.sample_id for r in rows if r.run == run and r.reason == "quota") for run in (1, 2, 3)}) > 1


def test_equal_sets_are_drawn_again(spark):
    # Two of five comparable with none: ten sets, drawn at random.
    pool = spark.range(6).select(F.col("id").alias("sample_id"))
    none = spark.createDataFrame([], "a long, b long, distance double")
    chosen = pool.where("sample_id = 0")
    members, audit = L.distinct_sets(pool, chosen, none, 3, 0, 1, 4)
    sets = {}
    for r in members.collect():
        sets.setdefault(r.run, set()).add(r.sample_id)
    assert len(sets) == 4 and len({frozenset(s) for s in sets.values()}) == 4 and all(len(s) == 3 and 0 in s for s in sets.values())
    told = {r.run: r for r in audit.collect()}
    assert all(r.status == "distinct" and r.duplicate_of is None and r.size == 3 for r in told.values())
    assert all(r.seed == 1 + r.run + (r.attempts - 1) * 4 for r in told.values())
    # Three sets of one more sample exist, so a fourth cannot differ.
    small = pool.where("sample_id < 4")
    _, audit = L.distinct_sets(small, chosen, none, 2, 0, 1, 4, attempts=12)
    told = sorted(audit.collect(), key=lambda r: r.run)
    assert sorted(r.status for r in told) == ["distinct"] * 3 + ["no_distinct_set_found"] and [r.attempts for r in told if r.duplicate_of] == [12]
    # Nothing to choose.
    _, audit = L.distinct_sets(small, small, none, 2, 0, 1, 2)
    assert [(r.status, r.attempts, r.duplicate_of) for r in sorted(audit.collect(), key=lambda r: r.run)] == [("no_choices", 1, None), ("no_choices", 1, 1)]


def test_budget(spark):
    pool = spark.range(10).select(F.col("id").alias("sample_id"))
    assert tuple(L.budget(pool, pool.where("sample_id < 6"), 4, 2).first()) == (4, 8, 6, 2, 10)
    assert tuple(L.budget(pool, pool.where("sample_id < 2"), 4, 1).first()) == (4, 4, 2, 0, 10)


def test_an_empty_pool_has_no_sets(spark):
    pool = spark.range(0).select(F.col("id").alias("sample_id"))
    none = spark.createDataFrame([], "a long, b long, distance double")
    members, audit = L.distinct_sets(pool, pool, none, 3, 0, 1, 2)
    assert members.count() == 0 and audit.count() == 0
