"""Choosing samples: pins, mandatory neighbours, strata, quotas, diversity, and checks of saved choices.

Random choices are orders by ``md5(seed|id)``, so they do not depend on partitions.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.shared import checkpoint_folder, checkpointed
from . import pairs as P
from .ranks import numbered


def drawn(seed: int, *keys: Column) -> Column:
    """A reproducible random order."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *(k.cast("string") for k in keys)))


def pinned(pool: DataFrame, pins: DataFrame) -> DataFrame:
    """(pin, status, sample_id): pins name a sample, a source or an accession, and must mean exactly one sample."""
    names = pool.select("sample_id", F.explode(F.array(F.col("sample_id").cast("string"), "source", "accession")).alias("pin")).distinct()
    hits = pins.join(names, "pin", "left").groupBy("pin").agg(F.count("sample_id").alias("n"), F.min("sample_id").alias("sample_id"))
    status = F.when(F.col("n") == 1, "pinned").when(F.col("n") == 0, "unknown").otherwise("ambiguous")
    return hits.select("pin", status.alias("status"), F.when(status == "pinned", F.col("sample_id")).alias("sample_id"))


def strata(rows: DataFrame, cells: list[Column]) -> DataFrame:
    """(sample_id, cell) with missing parts as Unknown."""
    return rows.select("sample_id", F.concat_ws("/", *(F.coalesce(F.when(F.trim(c.cast("string")) != "", c.cast("string")), F.lit("Unknown")) for c in cells)).alias("cell"))


def quotas(cells: DataFrame, mandatory: DataFrame, size: int, seed: int) -> DataFrame:
    """Cells that get one place: of those with someone not mandatory, as many as min(places left, a quarter of the size), in random order."""
    open_cells = cells.join(mandatory.select("sample_id").distinct(), "sample_id", "left_anti").select("cell").distinct()
    held = mandatory.select("sample_id").distinct().agg(F.count("*").alias("held"))  # one row
    ranked = numbered(open_cells.withColumn("_drawn", drawn(seed, F.col("cell"))), ["_drawn", "cell"], "place")
    return ranked.join(F.broadcast(held)).where((F.col("place") <= F.greatest(F.lit(0), F.lit(size) - F.col("held"))) & (F.col("place") <= -(-size // 4))).select("cell", F.col("place").cast("bigint").alias("place"))


def representatives(cells: DataFrame, mandatory: DataFrame, places: DataFrame, seed: int) -> DataFrame:
    """One random sample that is not mandatory from each cell with a place."""
    free = cells.join(mandatory.select("sample_id").distinct(), "sample_id", "left_anti").join(places, "cell")
    first = free.groupBy("cell", "place").agg(F.min(F.struct(drawn(seed, F.col("sample_id")).alias("o"), "sample_id")).alias("m"))
    return first.select("cell", "place", F.col("m.sample_id").alias("sample_id"))


class Listed:
    """Distances from a table of pairs (a, b, distance)."""

    def __init__(self, pairs: DataFrame):
        self.near = neighbours(pairs)

    def least(self, chosen: DataFrame, _runs: int) -> DataFrame:
        """(run, sample_id, least): the smallest distance of each sample to those (run, sample_id) chosen."""
        return chosen.select("run", F.col("sample_id").alias("x")).join(self.near, "x").groupBy("run", F.col("y").alias("sample_id")).agg(F.min("distance").alias("least"))

    def told(self, now: list[tuple], ids: DataFrame) -> DataFrame:
        """(run, sample_id, _d): distances to the one sample of each run that was just chosen."""
        return self.near.where(F.col("x").isin([x[1] for x in now])).join(F.broadcast(ids.withColumnRenamed("sample_id", "x")), "x").select("run", F.col("y").alias("sample_id"), F.col("distance").alias("_d"))


class Compared:
    """Distances made from profiles when they are asked for, as ``comparable_pairs`` would list them; no table of pairs is made.

    What every run holds is compared with all samples tile by tile, once; the few that single runs hold, and those chosen in
    a round, with one pass over the profiles.
    """

    def __init__(self, profiles: DataFrame, calls: DataFrame, overlap: float):
        self.profiles, self.calls, self.overlap = profiles, calls, overlap
        self.packed: DataFrame | None = None
        self.base: tuple[list, DataFrame] | None = None

    def rows(self) -> DataFrame:
        if self.packed is None:
            self.packed = checkpointed(P.packed_profiles(self.profiles, self.calls))
        return self.packed

    def least(self, chosen: DataFrame, runs: int) -> DataFrame:
        held = chosen.select("run", "sample_id").distinct()
        common = held.groupBy("sample_id").agg(F.count("*").alias("n")).where(F.col("n") == runs).select("sample_id")
        # Runs that are drawn again hold the same, whose distances are kept.
        digest = common.agg(F.count("*"), F.sum(F.xxhash64("sample_id").cast("decimal(38,0)"))).collect()
        if self.base is None or self.base[0] != digest:
            self.base = digest, checkpointed(P.nearest_chosen(self.profiles, self.calls, self.overlap, common).select("sample_id", "least"))
        every = self.base[1].join(F.broadcast(held.select("run").distinct()))
        own = P.distances_to(held.join(common, "sample_id", "left_anti"), self.rows(), self.overlap)
        return every.select("run", "sample_id", "least").unionByName(own.select("run", "sample_id", F.col("distance").alias("least"))).groupBy("run", "sample_id").agg(F.min("least").alias("least"))

    def told(self, _now: list[tuple], ids: DataFrame) -> DataFrame:
        return P.distances_to(ids, self.rows(), self.overlap).withColumnRenamed("distance", "_d")


def distances(pairs: DataFrame | Compared) -> Listed | Compared:
    return Listed(pairs) if isinstance(pairs, DataFrame) else pairs


def neighbours(pairs: DataFrame) -> DataFrame:
    """Each pair from either side as (x, y, distance), written in the order of x so that a round reads little more than the rows it asks for."""
    spark = pairs.sparkSession
    ways = [pairs.select(F.col(p).alias("x"), F.col(q).alias("y"), F.col("distance").cast("double").alias("distance")) for p, q in (("a", "b"), ("b", "a"))]
    at = f"{checkpoint_folder(spark)}/neighbours-{uuid.uuid4().hex}"
    ways[0].unionByName(ways[1]).where("distance is not null").repartitionByRange("x").sortWithinPartitions("x").write.parquet(at)
    return spark.read.parquet(at)


def farthest_first(pool: DataFrame, chosen: DataFrame, near: Listed | Compared, size: int, seeds: dict[int, int], every: int = 4) -> DataFrame:
    """(run, sample_id, position, reason): what fills each run up to ``size``, one sample of every run in each round.

    ``chosen`` are (run, sample_id, position, reason), ``seeds`` each run's
    seed, ``near`` as ``distances`` gives it.  A round is one distributed
    maximum of the distance to the nearest chosen sample, ties by random
    order; where none is comparable, a random one follows.  The driver sees
    one row for each run and round; distances stay in a table, which is
    checkpointed every few rounds.
    """
    spark, kind = pool.sparkSession, dict(pool.dtypes)["sample_id"]
    held = {r["run"]: r["n"] for r in chosen.groupBy("run").agg(F.count("*").alias("n")).collect()}
    held = {run: held.get(run, 0) for run in seeds}
    if all(n >= size for n in held.values()):
        return spark.createDataFrame([], f"run int, sample_id {kind}, position int, reason string")
    runs = spark.createDataFrame(list(seeds.items()), "run int, seed int")
    # One row for each run.
    left = pool.select("sample_id").distinct().join(F.broadcast(runs)).join(chosen.select("run", "sample_id"), ["run", "sample_id"], "left_anti")
    left = left.select("run", "sample_id", F.md5(F.concat_ws("|", F.col("seed").cast("string"), F.col("sample_id").cast("string"))).alias("drawn"))
    state = checkpointed(left.join(near.least(chosen, len(seeds)), ["run", "sample_id"], "left"))
    picked: list[tuple] = []
    rounds = 0
    while any(n < size for n in held.values()):
        open_ = [run for run, n in held.items() if n < size]
        best = F.min(F.struct(F.when(F.col("least").isNull(), 1).otherwise(0).alias("none"), (-F.coalesce("least", F.lit(0.0))).alias("far"), "drawn", "sample_id"))
        found = state.where(F.col("run").isin(open_)).groupBy("run").agg(best.alias("b")).collect()
        for run in set(open_) - {r["run"] for r in found}:
            held[run] = size  # the pool is used up
        if not found:
            continue
        now = []
        for r in found:
            held[r["run"]] += 1
            now.append((r["run"], r["b"]["sample_id"], held[r["run"]], "background" if r["b"]["none"] else "diversity"))
        picked += now
        ids = spark.createDataFrame([x[:2] for x in now], f"run int, sample_id {kind}")
        told = near.told(now, ids)
        state = state.join(F.broadcast(ids), ["run", "sample_id"], "left_anti").join(told, ["run", "sample_id"], "left").select("run", "sample_id", "drawn", F.least("least", "_d").alias("least"))
        rounds += 1
        if rounds % every == 0:
            state = checkpointed(state)
    return spark.createDataFrame(picked, f"run int, sample_id {kind}, position int, reason string")


def with_mandatory(mandatory: DataFrame, runs: list[int]) -> DataFrame:
    """(run, sample_id, position, reason) of what every run holds."""
    placed = numbered(mandatory.select("sample_id").distinct(), ["sample_id"])
    return placed.select(F.explode(F.array(*map(F.lit, runs))).alias("run"), "sample_id", F.col("position").cast("int").alias("position"), F.lit("mandatory").alias("reason"))


def quota_draws(cells: DataFrame, mandatory: DataFrame, size: int, seed: int, seeds: dict[int, int]) -> DataFrame:
    """(run, cell, place, sample_id): one random sample of each quota cell, drawn anew for every run; cells and their places are the same for all runs."""
    places = quotas(cells, mandatory, size, seed)
    runs = cells.sparkSession.createDataFrame(list(seeds.items()), "run int, seed int")
    free = cells.join(mandatory.select("sample_id").distinct(), "sample_id", "left_anti").join(places, "cell").join(F.broadcast(runs))
    order = F.md5(F.concat_ws("|", F.col("seed").cast("string"), F.col("sample_id").cast("string")))
    first = free.groupBy("run", "cell", "place").agg(F.min(F.struct(order.alias("o"), "sample_id")).alias("m"))
    return first.select("run", "cell", "place", F.col("m.sample_id").alias("sample_id"))


def diverse(pool: DataFrame, chosen: DataFrame, pairs: DataFrame | Compared, size: int, seed: int, runs: int = 1, cells: DataFrame | None = None) -> DataFrame:
    """(run, sample_id, position, reason): chosen ones first, then one of each quota cell, then again and again the sample farthest from all chosen ones.

    Rows do not depend on partitions: equals are settled by ``md5(seed|id)``.
    """
    return drawn_sets(pool, chosen, distances(pairs), size, seed, {r: seed + r for r in range(1, runs + 1)}, cells)


def drawn_sets(pool: DataFrame, chosen: DataFrame, near: Listed | Compared, size: int, seed: int, seeds: dict[int, int], cells: DataFrame | None) -> DataFrame:
    held = with_mandatory(chosen, list(seeds))
    if cells is not None:
        base = chosen.select("sample_id").distinct().count()
        drawn_ = quota_draws(cells, chosen, size, seed, seeds)
        held = held.unionByName(drawn_.select("run", "sample_id", (F.col("place") + base).cast("int").alias("position"), F.lit("quota").alias("reason")))
    held = checkpointed(held)
    return held.unionByName(farthest_first(pool, held, near, size, seeds))


def ensemble(runs: DataFrame) -> DataFrame:
    """Runs that chose the same set share a digest; all but the first are duplicates."""
    listed = runs.groupBy("run").agg(F.count("*").alias("size"), F.sha2(F.concat_ws(",", F.transform(F.sort_array(F.collect_list("sample_id")), lambda x: x.cast("string"))), 256).alias("digest"))
    return listed.withColumn("duplicate_of", F.when(F.min("run").over(Window.partitionBy("digest")) < F.col("run"), F.min("run").over(Window.partitionBy("digest"))))


def distinct_sets(pool: DataFrame, chosen: DataFrame, pairs: DataFrame | Compared, size: int, reserve: int, seed: int, runs: int, cells: DataFrame | None = None, attempts: int = 32) -> tuple[DataFrame, DataFrame]:
    """(members, audit) of ``runs`` sets that differ where the pool allows it.

    ``size`` grows to the chosen ones and ``reserve`` further places.  Sets
    equal to an earlier one are drawn again with another seed, up to
    ``attempts`` times, several at once; each run takes its first that is new.  ``members`` are (run,
    sample_id, position, reason), ``audit`` (run, seed, attempts, size,
    duplicate_of, status).  The driver holds a digest for each run.
    """
    spark = pool.sparkSession
    needed, available = chosen.select("sample_id").distinct().count(), pool.select("sample_id").distinct().count()
    effective = max(size, needed + reserve)
    fixed = needed >= effective or available <= effective
    near = distances(pairs)
    seen: dict[str, int] = {}
    kept, told, open_, first = None, {}, list(range(1, runs + 1)), 0
    while open_:
        # The first sets are drawn alone, then ever more attempts of the runs still open together.
        last = 1 if fixed else min(attempts, max(1, 3 * first + 1))
        tried = {i: (r, t) for i, (r, t) in enumerate(((r, t) for r in open_ for t in range(first, last)), 1)}
        seeds = {i: seed + r + t * runs for i, (r, t) in tried.items()}
        sets = checkpointed(drawn_sets(pool, chosen, near, effective, seed, seeds, cells))
        digests = {r["run"]: r for r in ensemble(sets).collect()}
        taken: dict[int, int] = {}
        for i, (r, t) in tried.items():
            if r in taken or i not in digests:
                continue
            earlier = seen.get(digests[i]["digest"])
            final = last == (1 if fixed else attempts) and t + 1 == last
            if earlier is None or final:
                seen.setdefault(digests[i]["digest"], r)
                taken[r] = i
                told[r] = (r, seeds[i], t + 1, digests[i]["size"], earlier)
        if taken:
            names = spark.createDataFrame([(i, r) for r, i in taken.items()], "run int, _run int")
            part = sets.join(F.broadcast(names), "run").select(F.col("_run").alias("run"), "sample_id", "position", "reason")
            kept = part if kept is None else kept.unionByName(part)
        open_ = [r for r in open_ if r not in taken] if last < (1 if fixed else attempts) else []
        first = last
    kept = sets if kept is None else kept  # nothing to choose and nothing held: no rows
    status = lambda duplicate: "no_choices" if fixed else "no_distinct_set_found" if duplicate else "distinct"
    audit = spark.createDataFrame([(*told[r], status(told[r][4])) for r in sorted(told)], "run int, seed int, attempts int, size long, duplicate_of int, status string")
    return kept, audit


def budget(pool: DataFrame, chosen: DataFrame, size: int, reserve: int) -> DataFrame:
    """(requested, effective, mandatory, overrun, available): the arithmetic of a selection's size."""
    counts = lambda df, name: df.select("sample_id").distinct().agg(F.count("*").alias(name))  # noqa: E731  one row each
    both = counts(chosen, "mandatory").join(F.broadcast(counts(pool, "available")))
    return both.select(F.lit(size).cast("bigint").alias("requested"), F.greatest(F.lit(size), F.col("mandatory") + reserve).alias("effective"), "mandatory", F.greatest(F.lit(0), F.col("mandatory") - size).alias("overrun"), "available")


def all_inputs(pool: DataFrame, mandatory: DataFrame, size: int) -> DataFrame:
    """Every input, every mandatory neighbour, then context in order of id up to ``size``; inputs and neighbours may go beyond it."""
    ranked = pool.join(mandatory.select("sample_id", F.lit(True).alias("_need")).distinct(), "sample_id", "left").withColumn("reason", F.when(F.col("role") == "input", "input").when(F.col("_need"), "mandatory_neighbour").otherwise("fill"))
    grade = F.when(F.col("reason") == "input", 0).when(F.col("reason") == "mandatory_neighbour", 1).otherwise(2)
    placed = numbered(ranked.withColumn("_grade", grade), ["_grade", "sample_id"])
    return placed.where((F.col("reason") != "fill") | (F.col("position") <= size)).select("sample_id", "reason", F.col("position").cast("bigint").alias("position"))


def saved_violations(members: DataFrame, pool: DataFrame, mandatory: DataFrame, most: int) -> DataFrame:
    """What is wrong with a saved selection, by rule and number: unknown or repeated members, missing inputs or neighbours, size."""
    known = pool.select("sample_id").distinct()
    rules = [
        ("unknown_member", members.join(known, "sample_id", "left_anti").agg(F.count("*").alias("n"))),
        ("repeated_member", members.groupBy("sample_id").agg(F.count("*").alias("c")).where("c > 1").agg(F.count("*").alias("n"))),
        ("missing_input", pool.where("role = 'input'").join(members, "sample_id", "left_anti").agg(F.count("*").alias("n"))),
        ("missing_mandatory", mandatory.select("sample_id").distinct().join(members, "sample_id", "left_anti").agg(F.count("*").alias("n"))),
        ("over_budget", members.agg(F.greatest(F.count("*") - most, F.lit(0)).alias("n"))),
    ]
    out = None
    for name, df in rules:
        row = df.select(F.lit(name).alias("rule"), F.col("n").cast("bigint").alias("n"))
        out = row if out is None else out.unionByName(row)
    return out
