"""Every two tiles meet once in strips, however many tiles and strips there are."""

import pytest
from pyspark.sql import functions as F

from strainframe.functions import scalars as S
from strainframe.operators import pairs as P
from strainframe.operators import tiles


@pytest.fixture
def strips(monkeypatch):
    """Tiles of seven samples, four strips."""
    monkeypatch.setattr(tiles, "STRIPS", 4)
    monkeypatch.setattr(tiles.stacked, "__defaults__", (7,))


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


def lineages(spark, n):
    some = [[], [1], [1, 2], [1, 2, 3], [1, 2, 4], [1, 2, 3, 4], [2, 2, 3], list(range(10))]
    return spark.createDataFrame([(f"s{i}", some[i * 5 % 8]) for i in range(n)], "sample_id string, n array<bigint>")


def test_a_tile_travels_once_for_each_strip(spark, strips):
    sent = spark.sparkContext.accumulator(0)

    def work(x, y):
        sent.add(1)
        return {"n": tiles.np.ones((len(x["ids"][0]), len(y["ids"][0])), "int64")}

    own = tiles.stacked(spark.range(100).select(F.col("id").alias("sample_id")))
    found = tiles.met_in_order(own, work, "n long", 8 * F.size("ids"))
    assert sorted((r.a, r.b) for r in found.collect()) == [(a, b) for a in range(100) for b in range(a + 1, 100)]
    assert own.count() == 15 and sent.value == 15 * 16 // 2
    # Each of 15 tiles goes to four strips, not to 15 meetings; twice the tiles go there twice as often in all, not four times.
    assert tiles.in_turn(own, F.lit(1))[0].count() == 15 * 4 and found._jdf.queryExecution().toRdd().getNumPartitions() < 15 * 16 // 2
    more = tiles.stacked(spark.range(200).select(F.col("id").alias("sample_id")))
    assert more.count() == 29 and tiles.in_turn(more, F.lit(1))[0].count() == 29 * 4


def test_larger_tiles_make_more_strips(spark, strips, monkeypatch):
    monkeypatch.setattr(tiles, "HELD", 100)
    own = tiles.stacked(spark.range(60).select(F.col("id").alias("sample_id")))
    found = tiles.met_in_order(own, lambda x, y: {"n": tiles.np.ones((len(x["ids"][0]), len(y["ids"][0])), "int64")}, "n long", 8 * F.size("ids"))
    assert found.count() == found.select("a", "b").distinct().count() == 60 * 59 // 2


def test_prefixes_meet_as_tiles(spark, strips):
    own = lineages(spark, 40)
    every = P.tiled(own, 9).select("p.sample_id", "q.sample_id", S.prefix_relation(F.col("p.n"), F.col("q.n"), 3), S.prefix_depth(F.col("p.n"), F.col("q.n")))
    found = P.prefix_pairs(own, 3)
    assert rows_of(found) == rows_of(every) and found.count() == 780
    # No pair is looked at by expressions over arrays, which are not compiled.
    assert "zip_with" not in found._jdf.queryExecution().executedPlan().toString()


def test_bases_meet_as_tiles(spark, strips):
    seqs = {i: "".join("ACGTNacgt-"[(i * 7 + k * k * (i + 1)) % 10] for k in range(70)) for i in range(30)}
    found = P.snp_pairs(spark.createDataFrame([*seqs.items(), (30, None), (31, "é" * 70), (5, seqs[5])], "sample_id long, seq string"))
    got = {(r.a, r.b): (r.snps, r.callable) for r in found.collect()}
    seqs |= {31: "N" * 70}
    for a in range(32):
        for b in range(a + 1, 32):
            if b == 30 or a == 30:
                assert got[a, b] == (None, None)
                continue
            both = [(x, y) for x, y in zip(seqs[a].upper(), seqs[b].upper(), strict=True) if x in "ACGT" and y in "ACGT"]
            assert got[a, b] == (sum(x != y for x, y in both), len(both))
    assert (5, 5) not in got and "bit_count" not in found._jdf.queryExecution().executedPlan().toString()
