"""Pairwise comparison of profiles by tiles of coded matrices.

Alleles are numbered exactly, locus by locus; a profile becomes one row of
codes, and a few hundred rows of one comparison block become one binary
matrix.  Two tiles of a block meet once by an equi-join on their numbers, and
numpy compares them locus by locus.  A block with most of the samples is many
tiles, so no key of the data decides how much a task holds.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.shared import checkpointed
from .ranks import numbered

#: Samples of a tile, and most partitions over which meetings of tiles are spread.
TILE, MEETINGS = 512, 2048
#: Tiles that meet a strip together, and bytes of codes (one a call) of a strip of tiles.
GROUP, STRIP = 4, 4 << 20
#: Most strips of a block where every two tiles meet, unless a strip would be larger than so many bytes.
STRIPS, HELD = 32, 32 << 20
#: Columns of profiles and tiles with a meaning of their own; others are carried along.
FIXED = ("sample_id", "block", "sha", "side", "tile", "ids", "shas", "loci", "item", "matrix")


def coded_profiles(profiles: DataFrame, calls: DataFrame, tile: int, every: bool = False) -> DataFrame:
    """(block, tile, sample_id, sha, loci, spots array<int>, codes array<int>) of (sample_id, block, sha) and called (sample_id, locus, allele).

    A sample has one call for a locus; of several the smallest allele counts.  Where ``profiles`` have a ``side`` (0 or 1),
    tiles are of one side, whose number is their number's last bit.  Other columns of ``profiles`` are carried along.
    Samples without a call are left out, unless ``every`` one is asked for.
    """
    more = [c for c in profiles.columns if c not in FIXED]
    sizes = profiles.groupBy("block").agg(F.ceil(F.count("*") / tile).alias("tiles"))
    number = F.pmod(F.xxhash64("sample_id", F.lit(5)), F.col("tiles"))
    if "side" in profiles.columns:
        number = 2 * number + F.col("side")
    dealt = profiles.join(sizes, "block").select("sample_id", "block", "sha", number.cast("int").alias("tile"), *more)
    own = calls.where("allele is not null").select("sample_id", "locus", "allele").join(dealt, "sample_id")
    # The alleles of a locus are numbered together, in one task for each block and locus.
    coded = own.withColumn("code", F.dense_rank().over(Window.partitionBy("block", "locus").orderBy("allele")))
    loci = own.select("block", "locus").distinct().withColumn("spot", F.row_number().over(Window.partitionBy("block").orderBy("locus")) - 1)
    width = loci.groupBy("block").agg(F.count("*").cast("int").alias("loci"))
    cells = coded.join(loci.join(width, "block"), ["block", "locus"])
    packed = cells.groupBy("block", "tile", "sample_id", "sha", "loci", *more).agg(F.sort_array(F.collect_list(F.struct("spot", "code"))).alias("cells"))
    packed = packed.select("block", "tile", "sample_id", "sha", "loci", *more, F.col("cells.spot").alias("spots"), F.col("cells.code").alias("codes"))
    if not every:
        return packed
    bare = dealt.join(own.select("sample_id").distinct(), "sample_id", "left_anti").join(width, "block", "left")
    none = F.array().cast("array<int>")
    return packed.unionByName(bare.select("block", "tile", "sample_id", "sha", F.coalesce("loci", F.lit(0)).alias("loci"), *more, none.alias("spots"), none.alias("codes")))


def tiled_profiles(profiles: DataFrame, calls: DataFrame, tile: int = TILE, *, every: bool = False) -> DataFrame:
    """(block, tile, ids, shas, loci, item, matrix): row-major codes, 0 where there is no call, of samples of one block; arrays of other columns."""
    coded = coded_profiles(profiles, calls, tile, every)
    more = [c for c in profiles.columns if c not in FIXED]

    def stack(_key: tuple, rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("sample_id").combine_chunks()
        n, loci = len(rows), rows["loci"][0].as_py()
        out = np.zeros((n, loci), np.uint32)
        spots = rows["spots"].chunk(0)
        at = np.repeat(np.arange(n), np.diff(spots.offsets.to_numpy()))
        # Written from the last cell to the first, so the smallest code of a repeated cell stays.
        out[at[::-1], spots.flatten().to_numpy()[::-1]] = rows["codes"].chunk(0).flatten().to_numpy()[::-1]
        kind = next(k for k in (np.uint8, np.uint16, np.uint32) if out.max(initial=0) <= np.iinfo(k).max)
        one = lambda values: pa.ListArray.from_arrays(pa.array([0, n], pa.int32()), values)
        return pa.table({"block": rows["block"].slice(0, 1), "tile": rows["tile"].slice(0, 1), "ids": one(rows["sample_id"].chunk(0)), "shas": one(rows["sha"].chunk(0)), "loci": pa.array([loci], pa.int32()), "item": pa.array([np.dtype(kind).itemsize], pa.int32()), "matrix": pa.array([out.astype(kind).tobytes()], pa.binary()), **{c: one(rows[c].chunk(0)) for c in more}})

    types = dict(coded.dtypes)
    kind = types["sample_id"]
    return checkpointed(coded.groupBy("block", "tile").applyInArrow(stack, f"block string, tile int, ids array<{kind}>, shas array<string>, loci int, item int, matrix binary" + "".join(f", {c} array<{types[c]}>" for c in more)))


def compared(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For all rows of a against all of b: loci called in both, and loci called in both but differently."""
    shared = ((a != 0).astype(np.float32) @ (b != 0).astype(np.float32).T).astype(np.int32)
    equal = np.zeros(shared.shape, np.int32)
    # Counts of up to 255 loci at a time fit one byte, which numpy adds fastest.
    left, right = np.ascontiguousarray(a.T), np.ascontiguousarray(b.T)
    # No call never equals no call.
    wide = np.result_type(left.dtype, np.uint8)
    right = np.where(right == 0, np.array(np.iinfo(wide).max, wide), right) if left.max(initial=0) < np.iinfo(wide).max else right
    exact = left.max(initial=0) < np.iinfo(wide).max
    some = np.empty(shared.shape, np.uint8)
    for first in range(0, len(left), 255):
        some[:] = 0
        for i in range(first, min(first + 255, len(left))):
            same = left[i][:, None] == right[i][None, :]
            if not exact:
                same &= (left[i] != 0)[:, None]
            np.add(some, same.view(np.uint8), out=some)
        equal += some
    return shared, shared - equal


def side(rows: pa.Table) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Names, digests and codes of a tile."""
    ids = rows["ids"].chunk(0).flatten()
    item = {1: np.uint8, 2: np.uint16, 4: np.uint32}[rows["item"][0].as_py()]
    return ids, np.array(rows["shas"].chunk(0).flatten().to_pylist(), object), np.frombuffer(rows["matrix"][0].as_buffer(), item).reshape(len(ids), rows["loci"][0].as_py())


def judged(x: tuple, y: tuple) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For two sides: loci called in both, those called differently, and whether some are shared and the digests agree, where both name one."""
    (_, sha, a), (_, other_sha, b) = x, y
    wide = np.result_type(a, b)
    shared, diff = compared(a.astype(wide, copy=False), b.astype(wide, copy=False))
    ok = shared > 0
    if (sha != "").any() and (other_sha != "").any():
        ok &= (sha == "")[:, None] | (other_sha == "")[None, :] | (sha[:, None] == other_sha[None, :])
    return shared, diff, ok


def same_place(ids: pa.Array, others: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Where the same sample stands on both sides."""
    at = pc.index_in(others, value_set=ids)
    q = np.flatnonzero(at.is_valid().to_numpy(zero_copy_only=False))
    return at.drop_null().to_numpy(zero_copy_only=False), q


def in_strips(left: DataFrame, right: DataFrame, work: Callable, schema: str) -> DataFrame:
    """``work`` (left tile, strip of right tiles) of all tiles of a block: rows grow with left samples and strips, not with samples squared.

    A few left tiles meet a strip of right ones in one group, so a tile travels once for each strip.
    """
    per = F.greatest(F.lit(1), F.floor(F.lit(STRIP) / (TILE * F.greatest(F.col("loci"), F.lit(1)))))
    # Tiles of one side have every other number.
    x = left.withColumn("i", F.floor(F.shiftright("tile", 1) / GROUP))
    y = right.withColumn("j", F.floor(F.shiftright("tile", 1) / per))
    i, j = x.select("block", "i").distinct(), y.select("block", "j").distinct()
    meetings = i.join(j, "block").count()
    spread = int(max(1, min(meetings, MEETINGS)))
    names = [c for c in right.columns if c != "block"]
    x = x.join(j, "block").repartition(spread, "block", "i", "j")
    y = y.join(i, "block").select(F.col("block").alias("block_"), F.col("i").alias("i_"), F.col("j").alias("j_"), *(F.col(c).alias(f"{c}_") for c in names)).repartition(spread, "block_", "i_", "j_")
    empty = x.sparkSession.createDataFrame([], schema).toArrow().schema

    def meet(x: pa.Table, y: pa.Table) -> pa.Table:
        strip = [y.slice(k, 1).combine_chunks().rename_columns([c.removesuffix("_") for c in y.column_names]) for k in range(len(y))]
        done = [work(x.slice(k, 1).combine_chunks(), strip) for k in range(len(x))] if strip else []
        return pa.concat_tables([d.cast(empty) for d in done]) if done else empty.empty_table()

    return x.groupBy("block", "i", "j").cogroup(y.groupBy("block_", "i_", "j_")).applyInArrow(meet, schema)


def kind_of(tiles: DataFrame) -> str:
    """The type of samples' ids."""
    return dict(tiles.dtypes)["ids"].removeprefix("array<").removesuffix(">")


def near_counts(tiles: DataFrame, overlap: float, k: int) -> DataFrame:
    """(a, b, shared, diff) of tiles of two sides, with ``n_loci``: for each sample a of side 1 its k nearest of each strip of side 0, and their ties.

    Only pairs whose shared calls reach ``overlap`` of ``n_loci``, and whose digests agree, are looked at.
    """
    far = np.iinfo(np.int32).max

    def work(x: pa.Table, strip: list[pa.Table]) -> pa.Table:
        own, n_loci, found = side(x), x["n_loci"][0].as_py(), []
        best = np.full((len(own[0]), k), far, np.int32)
        for y in strip:
            other = side(y)
            shared, diff, ok = judged(own, other)
            away = np.where(ok & (shared / n_loci >= overlap), diff, far)
            near = np.partition(away, k - 1, axis=1)[:, :k] if away.shape[1] > k else away
            best = np.partition(np.concatenate([best, near], axis=1), k - 1, axis=1)[:, :k]
            p, q = np.nonzero((away < far) & (away <= best.max(axis=1)[:, None]))
            found.append((p, other[0].take(pa.array(q)), shared[p, q], diff[p, q]))
        p, shared, diff = (np.concatenate([f[m] for f in found]) for m in (0, 2, 3))
        keep = diff <= best.max(axis=1)[p]
        b = pa.concat_arrays([f[1] for f in found])
        return pa.table({"a": own[0].take(pa.array(p[keep])), "b": b.filter(pa.array(keep)), "shared": shared[keep], "diff": diff[keep]})

    kind = kind_of(tiles)
    return in_strips(tiles.where("tile % 2 = 1"), tiles.where("tile % 2 = 0"), work, f"a {kind}, b {kind}, shared long, diff long")


def nearest_counts(tiles: DataFrame, overlap: float) -> DataFrame:
    """(sample_id, diff, ties, least): for each sample of side 0 or 1, the fewest differences to *other* samples of side 1, how many have so few, and the smallest distance; a row a strip."""
    far = np.iinfo(np.int32).max

    def work(x: pa.Table, strip: list[pa.Table]) -> pa.Table:
        own, n_loci = side(x), x["n_loci"][0].as_py()
        n = len(own[0])
        diffs, ties, least = np.full(n, far, np.int64), np.zeros(n, np.int64), np.full(n, np.inf)
        for y in strip:
            other = side(y)
            shared, diff, ok = judged(own, other)
            ok &= shared / n_loci >= overlap
            ok[same_place(own[0], other[0])] = False
            away = np.where(ok, diff, far)
            now = away.min(axis=1).astype(np.int64)
            count = (away == now[:, None]).sum(axis=1)
            ties = np.where(now < diffs, count, ties + np.where(now == diffs, count, 0))
            diffs = np.minimum(diffs, now)
            least = np.minimum(least, np.where(ok, diff / np.maximum(shared, 1), np.inf).min(axis=1))
        some = diffs < far
        return pa.table({"sample_id": own[0].filter(pa.array(some)), "diff": diffs[some], "ties": ties[some], "least": least[some]})

    return in_strips(tiles, tiles.where("tile % 2 = 1"), work, f"sample_id {kind_of(tiles)}, diff long, ties long, least double")


def count_histograms(tiles: DataFrame, overlap: float) -> DataFrame:
    """(sample_id, shared, diff, n): how many other samples share so many calls with each sample and differ in so many; some rows for each strip."""

    def work(x: pa.Table, strip: list[pa.Table]) -> pa.Table:
        own, n_loci = side(x), x["n_loci"][0].as_py()
        n, wide = len(own[0]), own[2].shape[1] + 1
        row, told = np.arange(n)[:, None], {}
        for y in strip:
            other = side(y)
            shared, diff, ok = judged(own, other)
            ok &= shared / n_loci >= overlap
            ok[same_place(own[0], other[0])] = False
            # One number for each sample and pair of counts.
            key = ((row * wide + shared) * wide + diff)[ok]
            if n * wide * wide <= 1 << 24:
                counts = np.bincount(key, minlength=n * wide * wide)
                told["all"] = counts + told.get("all", 0)
            else:
                for at, m in zip(*np.unique(key, return_counts=True), strict=True):
                    told[at] = told.get(at, 0) + m
        if "all" in told:
            key = np.flatnonzero(told["all"])
            m = told["all"][key]
        else:
            key, m = np.array(list(told), np.int64), np.array(list(told.values()), np.int64)
        return pa.table({"sample_id": own[0].take(pa.array(key // wide // wide)), "shared": key // wide % wide, "diff": key % wide, "n": m})

    return in_strips(tiles, tiles, work, f"sample_id {kind_of(tiles)}, shared long, diff long, n long")


def in_turn(tiles: DataFrame, size: Column) -> tuple[DataFrame, int]:
    """Tiles as they go to the strips (block, _i, _j) they meet in, with their own ``_strip``, and over how many partitions.

    A block's tiles are cut into ``STRIPS`` strips at most, of which every two meet, so a tile travels that often however
    many tiles there are; more strips are made only where one would pass ``HELD`` bytes.
    """
    names = [c for c in tiles.columns if c != "block"]
    most = tiles.groupBy("block").agg((F.max("tile") + 1).alias("_tiles"), F.max(size).alias("_size"))
    fit = F.greatest(F.lit(1), F.floor(F.lit(HELD) / F.greatest(F.lit(1), F.coalesce("_size", F.lit(1)))))
    most = most.withColumn("_per", F.least(F.ceil(F.col("_tiles") / STRIPS), fit)).withColumn("_strips", F.ceil(F.col("_tiles") / F.col("_per")))
    held = tiles.join(most, "block").withColumn("_strip", F.floor(F.col("tile") / F.col("_per")))
    # Meetings are few bytes and much work, so they are spread by number, not by size.
    count = held.groupBy("block").agg(F.max(F.col("_strips")).alias("t")).agg(F.coalesce(F.sum(F.col("t") * (F.col("t") + 1) / 2), F.lit(0.0))).first()[0]
    spread = int(max(1, min(2 * count - 1, max(MEETINGS, tiles.sparkSession.sparkContext.defaultParallelism))))
    # Each tile goes once to every strip, its own included; the smaller number is the left one there.
    other = held.withColumn("_other", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_strips") - 1)))
    return other.select("block", F.least("_strip", "_other").alias("_i"), F.greatest("_strip", "_other").alias("_j"), "_strip", *names), spread


def met(tiles: DataFrame, work: Callable, schema: str, size: Column | None = None) -> DataFrame:
    """``work`` (block, left tile, right tile, whether they are one) of every two tiles of a block, each two once.

    Strips of tiles meet in one group, which rows leave meeting by meeting; ``size`` is a tile's bytes (of its matrix).
    """
    sent, spread = in_turn(tiles, F.octet_length("matrix") if size is None else size)
    empty = tiles.sparkSession.createDataFrame([], schema).toArrow().schema

    def meet(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, i, j = (k.as_py() for k in key)
        rows = pa.Table.from_batches(batches)
        own = {k: [rows.slice(at, 1).combine_chunks() for at in np.flatnonzero(np.asarray(rows["_strip"]) == k)] for k in {i, j}}
        for x in own[i]:
            for y in own[j]:
                left, right = x["tile"][0].as_py(), y["tile"][0].as_py()
                if left <= right:
                    yield from work(block, x, y, left == right).cast(empty).combine_chunks().to_batches()

    return sent.repartition(spread, "block", "_i", "_j").groupBy("block", "_i", "_j").applyInArrow(meet, schema)


def stacked(rows: DataFrame, tile: int = TILE) -> DataFrame:
    """(block, tile, ids, arrays of the other columns): rows with a sample_id, dealt to tiles of one block in order of it."""
    more = [c for c in rows.columns if c != "sample_id"]
    dealt = numbered(rows.where("sample_id is not null"), ["sample_id"], "_at").withColumn("tile", F.floor((F.col("_at") - 1) / tile).cast("int"))
    own = dealt.groupBy("tile").agg(F.sort_array(F.collect_list(F.struct("_at", "sample_id", *more))).alias("r"))
    return checkpointed(own.select(F.lit("").alias("block"), "tile", F.col("r.sample_id").alias("ids"), *(F.col(f"r.{c}").alias(c) for c in more)))


def met_in_order(tiles: DataFrame, work: Callable, schema: str, size: Column) -> DataFrame:
    """(a, b, and what ``work`` (left tile, right tile) has, an array a column) of every two samples a < b of ``stacked`` tiles."""
    kind = kind_of(tiles)

    def meet(_block: str, x: pa.Table, y: pa.Table, same: bool) -> pa.Table:
        left, right = x["ids"].chunk(0).flatten(), y["ids"].chunk(0).flatten()
        every = np.ones((len(left), len(right)), bool)
        p, q = np.nonzero(np.triu(every, 1) if same else every)
        out = pa.table({"a": left.take(pa.array(p)), "b": right.take(pa.array(q)), **{k: pa.array(v[p, q]) for k, v in work(x, y).items()}})
        # A sample that is there twice stands beside itself.
        return out.filter(pc.less(out["a"], out["b"]))

    return met(tiles, meet, f"a {kind}, b {kind}, {schema}", size)


def ordered(ids: pa.Array, others: pa.Array, p: np.ndarray, q: np.ndarray) -> tuple[pa.Array, pa.Array, np.ndarray]:
    """The samples of pairs (p, q), smaller first, and which pairs were turned."""
    left, right = ids.take(pa.array(p)), others.take(pa.array(q))
    swap = pc.greater(left, right)
    return pc.if_else(swap, right, left), pc.if_else(swap, left, right), swap.to_numpy(zero_copy_only=False)


def pair_counts(tiles: DataFrame, least: float = 0.0) -> DataFrame:
    """(block, a, b, shared, diff) of all pairs a < b of a block whose shared calls are some, and at least ``least`` of its loci.

    Of two profiles that both name a database by its digest, the digests must agree.
    """

    def work(block: str, x: pa.Table, y: pa.Table, same: bool) -> pa.Table:
        own, other = side(x), side(y)
        shared, diff, ok = judged(own, other)
        ok &= shared >= least * own[2].shape[1]
        p, q = np.nonzero(np.triu(ok, 1) if same else ok)
        a, b, _ = ordered(own[0], other[0], p, q)
        return pa.table({"block": pa.array([block] * len(p), pa.string()), "a": a, "b": b, "shared": shared[p, q], "diff": diff[p, q]})

    kind = kind_of(tiles)
    return met(tiles, work, f"block string, a {kind}, b {kind}, shared long, diff long")
