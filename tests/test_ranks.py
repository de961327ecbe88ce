"""Places, running totals and first-seen codes over many ranges."""

import pytest
from pyspark.sql import functions as F

from strainframe.operators import aggregates, matrix, ranks


@pytest.fixture
def partitions(spark, request):
    """Another number of shuffle partitions, with or without adaptive plans."""
    old = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.enabled")}
    n, adaptive = request.param
    spark.conf.set("spark.sql.shuffle.partitions", str(n))
    spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    yield n
    for k, v in old.items():
        spark.conf.set(k, v)


@pytest.mark.parametrize(("partitions", "alleles"), [((200, "true"), 100_000), ((4, "false"), 100_000), ((64, "true"), 400_000)], indirect=["partitions"])
def test_first_seen_codes_of_many_alleles(spark, partitions, alleles):
    calls = spark.range(alleles).select((F.col("id") * 7919 % alleles).alias("sample_id"), F.lit("l").alias("locus"), F.concat(F.lit("a"), (F.col("id") * 7919 % alleles).cast("string")).alias("allele"))
    again = calls.select((F.col("sample_id") + alleles).alias("sample_id"), "locus", "allele")
    vocabulary, codes = matrix.coded(calls.unionByName(again), ["sample_id", "locus"])
    # The allele of sample i is first seen there, so its code is i + 1, in both tables.
    assert vocabulary.where(F.concat(F.lit("a"), (F.col("code") - 1).cast("string")) != F.col("allele")).count() == 0
    assert codes.where((F.col("sample_id") % alleles) + 1 != F.col("code")).count() == 0
    assert (vocabulary.count(), codes.count()) == (alleles, 2 * alleles)


@pytest.mark.parametrize("partitions", [(16, "true"), (16, "false")], indirect=True)
def test_places_and_running_totals(spark, partitions):
    df = spark.range(5000).select(F.col("id"), (F.col("id") * 37 % 1000).alias("v"))
    got = {r.id: r.position for r in ranks.numbered(df, [F.desc("v"), "id"]).collect()}
    order = sorted(range(5000), key=lambda i: (-(i * 37 % 1000), i))
    assert got == {k: i for i, k in enumerate(order, 1)}
    totals = {r.id: (r.s, r.m) for r in ranks.running(ranks.running(df, ["v", "id"], "s", total="v"), ["v", "id"], "m", least=-F.col("id")).collect()}
    s, m, want = 0, 0, {}
    for k in sorted(range(5000), key=lambda i: (i * 37 % 1000, i)):
        s, m = s + k * 37 % 1000, min(m, -k)
        want[k] = (s, m)
    assert totals == want
    empty = df.where("id < 0")
    assert ranks.numbered(empty, ["v"]).count() == 0 and ranks.running(empty, ["v"], "s", total="v").count() == 0


def test_false_discovery_over_ranges(spark):
    ps = [((i * 733) % 911) / 911 for i in range(3000)] + [None, None]
    df = spark.createDataFrame(list(enumerate(ps)), "id long, p double")
    got = {r.id: r.q for r in aggregates.false_discovery(df).collect()}
    known = sorted((p, i) for i, p in enumerate(ps) if p is not None)
    want, least = {i: None for i, p in enumerate(ps) if p is None}, 1.0
    rank = {p: k for k, (p, _) in enumerate(known, 1)}
    for p, i in reversed(known):
        least = min(least, p * len(known) / rank[p])
        want[i] = least
    assert got.keys() == want.keys() and all((got[k] is None) == (w is None) and (w is None or abs(got[k] - w) < 1e-12) for k, w in want.items())
