"""Queries over cohorts, trees, networks, selections and blocks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..operators import aggregates as A
from ..operators import cohorts as C
from ..operators import pairs as P
from ..operators import partitions as B
from ..operators import selection as L
from ..operators import trees as T
from ..sources.shared import checkpointed
from . import q_pairs as Q
from .q_aggregates import points, rounded
from .registry import query
from .views import OVERLAP, sequences, view

c = F.col


def all_cohorts(spark: SparkSession, sf: str) -> DataFrame:
    """(sample_id, group) of the greedy cohorts, whatever their size."""
    return P.cohort_members(Q.own_scopes(spark, sf), view(spark, sf, "dense_calls"), OVERLAP)


def profiles(spark: SparkSession, sf: str) -> DataFrame:
    """Tiles of the profiles of every greedy cohort, whatever its size."""
    return P.member_tiles(all_cohorts(spark, sf), view(spark, sf, "dense_calls"))


def tree(spark: SparkSession, sf: str) -> DataFrame:
    return view(spark, sf, "tree").withColumn("tree", F.lit("fixed"))


# Cohorts -------------------------------------------------------------------------------------------------


@query()
def c01_complete_linkage(spark: SparkSession, sf: str) -> DataFrame:
    return C.clustered(profiles(spark, sf), [0.8])


@query()
def c02_threshold_sensitivity(spark: SparkSession, sf: str) -> DataFrame:
    return C.sensitivity(C.clustered(profiles(spark, sf), [0.4, 0.8, 1.0]))


@query()
def c04_ordination(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(C.ordinated(profiles(spark, sf)), "x", "y")


@query()
def c05_leading_ordination(spark: SparkSession, sf: str) -> DataFrame:
    return C.ordinated(profiles(spark, sf), leading=True)


@query()
def c06_tree_ordination(spark: SparkSession, sf: str) -> DataFrame:
    return C.tree_ordination(profiles(spark, sf))


@query()
def c07_bootstrap_support(spark: SparkSession, sf: str) -> DataFrame:
    """Support of the clusters of every cohort, 30 replicates each."""
    groups = checkpointed(C.clustered(profiles(spark, sf), [0.8]).select("group", "sample_id", "cluster"))
    calls = view(spark, sf, "dense_calls").join(groups.select("group", "sample_id"), "sample_id")
    return C.bootstrap_support(groups, C.bootstrap(calls.select("group", "sample_id", "locus", "allele"), 0.8, OVERLAP, 30))


@query()
def t01_neighbour_joining(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(C.guide_tree(profiles(spark, sf)), "length")


@query("""WITH RECURSIVE e AS (SELECT a.sample_id x, b.sample_id y FROM @sequences a JOIN @sequences b ON (SELECT sum(CASE WHEN a.seq[i] <> 'N' AND b.seq[i] <> 'N' AND a.seq[i] <> b.seq[i] THEN 1 ELSE 0 END) FROM range(1, 65) t(i)) <= 25), r AS (SELECT x, y FROM e UNION SELECT r.x, e.y FROM r JOIN e ON r.y = e.x) SELECT x id, min(y) unit FROM r GROUP BY 1""")
def c03_single_linkage(spark: SparkSession, sf: str) -> DataFrame:
    """Clusters of sequences linked by at most 25 SNPs: each link is a shared alias."""
    from ..operators.identity import connected

    # Different sequences are compared once each; samples of one sequence are linked if it has a known base.
    kinds = checkpointed(P.sequence_kinds(sequences(spark, sf)))
    near = P.kind_pairs(sequences(spark, sf)).where("callable > 0 and snps <= 25")
    name = F.concat_ws("-", "a", "b")
    links = near.select(c("a").alias("id"), name.alias("alias")).unionByName(near.select(c("b").alias("id"), name.alias("alias")))
    alone = kinds.select(c("kind").alias("id"), c("kind").cast("string").alias("alias")).distinct()
    unit = connected(links.unionByName(alone)).withColumnRenamed("id", "kind")
    return kinds.join(unit, "kind").select(c("sample_id").alias("id"), F.when(c("callable") > 0, c("unit")).otherwise(c("sample_id")).alias("unit"))


# Trees ---------------------------------------------------------------------------------------------------

PATHS = """WITH RECURSIVE p AS (SELECT node, 0::BIGINT AS depth, 0::DOUBLE distance FROM @tree WHERE parent IS NULL UNION ALL SELECT t.node, p.depth + 1, p.distance + t.length FROM p JOIN @tree t ON t.parent = p.node)"""


@query(PATHS + " SELECT node, depth, round(distance, 9) distance FROM p")
def t02_t03_root_to_tip(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(T.root_to_tip(tree(spark, sf)), "distance")


@query("""WITH RECURSIVE u AS (SELECT node, node ancestor, 0::BIGINT steps FROM @tree UNION ALL SELECT u.node, t.parent, u.steps + 1 FROM u JOIN @tree t ON t.node = u.ancestor WHERE t.parent IS NOT NULL) SELECT node, ancestor, steps FROM u""")
def t02_ancestors(spark: SparkSession, sf: str) -> DataFrame:
    return T.ancestors(tree(spark, sf))


@query("""WITH RECURSIVE u AS (SELECT node, node ancestor, 0 steps FROM @tree UNION ALL SELECT u.node, t.parent, u.steps + 1 FROM u JOIN @tree t ON t.node = u.ancestor WHERE t.parent IS NOT NULL),
 g AS (SELECT sample_id % 20 AS "group", node FROM @tree WHERE sample_id IS NOT NULL), n AS (SELECT "group", count(*) targets FROM g GROUP BY 1), s AS (SELECT "group", ancestor, count(*) hits, min(steps) near FROM g JOIN u USING (node) GROUP BY 1, 2),
 m AS (SELECT "group", ancestor, targets, row_number() OVER (PARTITION BY "group" ORDER BY near, ancestor) i FROM s JOIN n USING ("group") WHERE hits = targets), b AS (SELECT ancestor, count(*) tips_below FROM u JOIN @tree t ON t.node = u.node AND NOT EXISTS (SELECT 1 FROM @tree k WHERE k.parent = t.node) GROUP BY 1)
 SELECT "group", ancestor, targets, tips_below, tips_below - targets AS extra FROM m JOIN b USING (ancestor) WHERE i = 1""")
def t10_common_ancestor(spark: SparkSession, sf: str) -> DataFrame:
    t = tree(spark, sf)
    return T.common_ancestor(t, t.where("sample_id is not null").select((c("sample_id") % 20).alias("group"), "node"))


@query("SELECT node, parent, greatest(length, 0) AS length, length AS original, coalesce(length < 0, false) clamped FROM @tree")
def t06_not_negative(spark: SparkSession, sf: str) -> DataFrame:
    return T.not_negative(tree(spark, sf)).select("node", "parent", "length", "original", "clamped")


SPLITS = """WITH RECURSIVE u AS (SELECT node tip, parent AS at_node FROM @tree t0 WHERE NOT EXISTS (SELECT 1 FROM @tree k WHERE k.parent = t0.node) UNION ALL SELECT u.tip, t.parent FROM u JOIN @tree t ON t.node = u.at_node WHERE t.parent IS NOT NULL),
 al AS (SELECT list_sort(list(node)) a FROM @tree t1 WHERE NOT EXISTS (SELECT 1 FROM @tree k WHERE k.parent = t1.node)), s AS (SELECT at_node, list_sort(list_distinct(list(tip))) side FROM u GROUP BY 1), o AS (SELECT side, [x for x in a if NOT list_contains(side, x)] other FROM s, al)
 SELECT DISTINCT array_to_string(CASE WHEN len(side) < len(other) OR (len(side) = len(other) AND side <= other) THEN side ELSE other END, '|') split FROM o WHERE len(side) >= 2 AND len(other) >= 2"""


@query(SPLITS)
def t07_splits(spark: SparkSession, sf: str) -> DataFrame:
    return T.splits(tree(spark, sf)).select("split")


@query()
def t08_anchor_splits(spark: SparkSession, sf: str) -> DataFrame:
    t = tree(spark, sf)
    return T.splits(t, anchors=t.where("sample_id % 4 = 0").select("node"))


@query("""WITH RECURSIVE f AS (SELECT k.node, coalesce(n.parent, k.parent) parent FROM @tree k LEFT JOIN @tree n ON k.parent = n.node AND n.node LIKE 'n%' WHERE k.node NOT LIKE 'n%'),
 e AS (SELECT 1 AS which, node, parent FROM @tree UNION ALL SELECT 2, node, parent FROM f), tips AS (SELECT e.which, e.node tip FROM e LEFT JOIN e k ON k.which = e.which AND k.parent = e.node WHERE k.node IS NULL),
 u AS (SELECT tips.which, tip, e.parent AS at_node FROM tips JOIN e ON e.which = tips.which AND e.node = tip WHERE e.parent IS NOT NULL UNION ALL SELECT u.which, u.tip, e.parent FROM u JOIN e ON e.which = u.which AND e.node = u.at_node WHERE e.parent IS NOT NULL),
 s AS (SELECT DISTINCT which, list_sort(list(tip)) side FROM (SELECT DISTINCT which, at_node, tip FROM u) GROUP BY which, at_node)
 SELECT count(*) FILTER (WHERE n = 1 AND w = 1) first_only, count(*) FILTER (WHERE n = 1 AND w = 2) second_only, count(*) FILTER (WHERE n = 2) AS both FROM (SELECT side, count(*) n, min(which) w FROM s GROUP BY 1)""")
def t18_same_topology(spark: SparkSession, sf: str) -> DataFrame:
    """A tree, and the same without its nations' level: the clades of regions are common, those of nations are not."""
    t = tree(spark, sf)
    flat = t.where("node not like 'n%'").alias("k").join(t.where("node like 'n%'").select(c("node").alias("parent"), c("parent").alias("above")), "parent", "left").select(F.lit("flat").alias("tree"), "node", F.coalesce("above", "parent").alias("parent"), "length")
    return T.same_topology(t, flat)


@query()
def t04_pruned(spark: SparkSession, sf: str) -> DataFrame:
    """The fixed tree with every fourth sample only."""
    import pandas as pd

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        kept = set(rows.loc[rows["sample_id"].notna() & (rows["sample_id"] % 4 == 0), "node"])
        return pd.DataFrame(T.pruned(T.Tree(list(rows[["node", "parent", "length"]].itertuples(index=False, name=None))), kept), columns=["node", "parent", "length"])

    return tree(spark, sf).groupBy("tree").applyInPandas(run, "node string, parent string, length double")


@query()
def t05_rerooted(spark: SparkSession, sf: str) -> DataFrame:
    """The fixed tree rooted halfway along the first sample's edge."""
    import pandas as pd

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        t = T.Tree(list(rows[["node", "parent", "length"]].itertuples(index=False, name=None)))
        at = t.names.index("s1")
        return pd.DataFrame(T.rerooted(t, at, t.length[at] / 2), columns=["node", "parent", "length"])

    return tree(spark, sf).groupBy("tree").applyInPandas(run, "node string, parent string, length double")


def clocks(spark: SparkSession, sf: str) -> DataFrame:
    """Guide trees of the cohorts as node tables, computed once."""
    name = lambda n: F.concat_ws(":", c("group").cast("string"), n)
    return checkpointed(C.guide_tree(profiles(spark, sf)).select(c("group").alias("tree"), name("node").alias("node"), F.when(c("parent").isNotNull(), name("parent")).alias("parent"), F.greatest("length", F.lit(0.0)).alias("length")))


def tip_years(spark: SparkSession, sf: str, nodes: DataFrame) -> DataFrame:
    """(node, year): mean date of each tip's sample."""
    tips = nodes.select("node", F.regexp_extract("node", ":([0-9]+)$", 1).alias("tip")).where("tip != ''").select("node", c("tip").cast("bigint").alias("sample_id"))
    return tips.join(points(spark, sf).groupBy("sample_id").agg(F.avg("x").alias("year")), "sample_id").select("node", "year")


@query()
def t09_clock_root(spark: SparkSession, sf: str) -> DataFrame:
    t = clocks(spark, sf)
    return T.clock_roots(t, tip_years(spark, sf, t))


@query()
def t19_root_comparison(spark: SparkSession, sf: str) -> DataFrame:
    """Fit of the tree as rooted against that of its best root."""
    t = clocks(spark, sf)
    years = tip_years(spark, sf, t)
    ways = T.root_to_tip(t).join(years, "node").join(t.select("node", "tree"), "node")
    base = A.regression(ways.select("tree", c("year").alias("x"), c("distance").alias("y")), "tree").select("tree", c("slope").alias("base_slope"), c("r2").alias("base_r2"))
    return T.clock_roots(t, years).join(base, "tree").select("tree", "status", "slope", "r2", "base_slope", "base_r2")


@query()
def c08_date_permutation(spark: SparkSession, sf: str) -> DataFrame:
    """Best-root fits of every cohort's tree with its tips' dates dealt anew, each in a task of its own, and the p-value."""
    t = clocks(spark, sf)
    years = tip_years(spark, sf, t).join(t.select("tree", "node"), "node")
    order = Window.partitionBy("tree", "run").orderBy
    every = F.explode(F.sequence(F.lit(0), F.lit(20)))
    runs = years.withColumn("run", every)
    place = runs.select("tree", "run", "node", F.row_number().over(order("node")).alias("i"))
    dealt = runs.select("tree", "run", "year", F.when(c("run") == 0, c("node")).otherwise(L.drawn(3, c("run"), c("node"))).alias("o")).select("tree", "run", F.row_number().over(order("o")).alias("i"), "year")
    copy = lambda n: F.concat_ws("#", c("run").cast("string"), n)
    given = place.join(dealt, ["tree", "run", "i"]).select(copy("node").alias("node"), "year")
    copies = t.withColumn("run", every).select(copy(c("tree").cast("string")).alias("tree"), copy("node").alias("node"), F.when(c("parent").isNotNull(), copy("parent")).alias("parent"), "length")
    parts = F.split("tree", "#")
    fits = T.clock_roots(copies, given).select(parts[0].cast("int").alias("run"), parts[1].cast("bigint").alias("tree"), "r2")
    observed = fits.where("run = 0").select("tree", c("r2").alias("observed"))
    counted = observed.join(fits.where("run > 0 and r2 is not null"), "tree", "left").groupBy("tree", "observed").agg(F.count("r2").alias("n"), F.count_if(c("r2") >= c("observed")).alias("exceed"))
    return counted.withColumn("p", F.when(c("observed").isNotNull(), (1 + c("exceed")) / (1 + c("n"))))


@query("""WITH d AS (SELECT 'n' || s_nationkey node, count(DISTINCT s_suppkey % 2) k, min(s_suppkey % 2) v FROM supplier GROUP BY 1) SELECT node clade, v AS year FROM d WHERE k = 1""")
def b08_date_clades(spark: SparkSession, sf: str) -> DataFrame:
    """Lowest clades whose tips share one date."""
    t = tree(spark, sf)
    tips = t.where("sample_id is not null").select(c("parent").alias("clade"), (c("sample_id") % 2).alias("year"))
    return tips.groupBy("clade").agg(F.count_distinct("year").alias("k"), F.min("year").alias("year")).where("k = 1").select("clade", "year")


# States --------------------------------------------------------------------------------------------------


@query("""WITH s AS (SELECT sample_id, CASE WHEN sample_id % 13 = 3 THEN NULL ELSE sample_id % 3 END st, parent n FROM @tree WHERE sample_id IS NOT NULL),
 k AS (SELECT unnest([0, 1, 2]) x), cn AS (SELECT n, x, count(*) FILTER (st IS NOT NULL AND st <> x) cost FROM s, k GROUP BY 1, 2), mn AS (SELECT n, min(cost) m FROM cn GROUP BY 1),
 ln AS (SELECT node n FROM @tree t0 WHERE node LIKE 'n%' AND NOT EXISTS (SELECT 1 FROM @tree q WHERE q.parent = t0.node)),
 rr AS (SELECT t.parent r, x, sum(least(cost, m + 1)) cost FROM cn JOIN mn USING (n) JOIN @tree t ON t.node = n GROUP BY 1, 2), mr AS (SELECT r, min(cost) m FROM rr GROUP BY 1)
 SELECT 'fixed' AS tree, min(c)::BIGINT changes FROM (SELECT x, sum(least(cost, m + 1)) c FROM rr JOIN mr USING (r) GROUP BY 1)""")
def t12_parsimony_optimum(spark: SparkSession, sf: str) -> DataFrame:
    t = tree(spark, sf)
    states = t.where("sample_id is not null and sample_id % 13 != 3").select("node", (c("sample_id") % 3).cast("string").alias("state"))
    return T.reconstructed(t, states).where("kind = 'optimum'").select("tree", c("least").alias("changes"))


def histories(spark: SparkSession, sf: str, state: Column) -> DataFrame:
    t = tree(spark, sf)
    s = view(spark, sf, "samples").select("sample_id", state.alias("state")).where("state is not null")
    return T.reconstructed(t, t.where("sample_id is not null").select("node", "sample_id").join(s, "sample_id").select("node", "state"))


@query()
def t12_parsimony_ranges(spark: SparkSession, sf: str) -> DataFrame:
    return histories(spark, sf, c("region")).where("kind = 'change'")


@query()
def t13_alternative_roots(spark: SparkSession, sf: str) -> DataFrame:
    """Optima and ranges with the tree rooted on each region's edge."""
    import pandas as pd

    t = tree(spark, sf)
    s = view(spark, sf, "samples").select(F.concat(F.lit("s"), c("sample_id").cast("string")).alias("node"), S.host_state(c("host")).alias("state")).where("state is not null")
    rows = t.select("node", "parent", "length").join(s, "node", "left").withColumn("root", F.explode(F.sequence(F.lit(0), F.lit(4))))

    def run(part: pd.DataFrame) -> pd.DataFrame:
        own = T.Tree(list(part[["node", "parent", "length"]].itertuples(index=False, name=None)))
        name = f"r{int(part['root'].iloc[0])}"
        at = own.names.index(name)
        moved = T.Tree(T.rerooted(own, at, own.length[at] / 2))
        best = T.Histories(moved, {n: x for n, x in part[["node", "state"]].itertuples(index=False, name=None) if pd.notna(x)})
        _, unsure, branches = best.possible()
        rows = [(name, best.optimum, a, b, lo, hi, tuple(sorted((a, b))) in unsure, branches) for (a, b), (lo, hi) in best.ranges().items()]
        return pd.DataFrame(rows, columns=["root", "optimum", "source", "target", "least", "most", "unsure", "branches"])

    found = rows.groupBy("root").applyInPandas(run, "root string, optimum bigint, source string, target string, least bigint, most bigint, unsure boolean, branches bigint")
    return found.groupBy("source", "target").agg(F.count("*").alias("roots"), (F.count("*") / 5).alias("root_fraction"), F.count_if("unsure").alias("ambiguous_roots"), F.max("branches").alias("ambiguous_branches"), F.min("least").alias("least"), F.max("most").alias("most"))


@query()
def t12_exchanges(spark: SparkSession, sf: str) -> DataFrame:
    """Undirected ranges of changes between regions, and one history's changes in either direction."""
    t = tree(spark, sf)
    s = view(spark, sf, "samples").select("sample_id", c("region").alias("state"))
    found = checkpointed(T.reconstructed(t, t.where("sample_id is not null").select("node", "sample_id").join(s, "sample_id").select("node", "state")))
    pair = (F.least("source", "target").alias("source"), F.greatest("source", "target").alias("target"))
    one = found.where("kind = 'history' and source != target").groupBy(*pair).agg(F.count("*").alias("changes"))
    return found.where("kind = 'exchange'").select("source", "target", "least", "most").join(one, ["source", "target"], "left").withColumn("changes", F.coalesce("changes", F.lit(0)))


@query("""WITH RECURSIVE up AS (SELECT node, node anc, 0::BIGINT steps, 0.0::DOUBLE far FROM @tree t0 UNION ALL SELECT up.node, t.parent, steps + 1, far + t.length FROM up JOIN @tree t ON t.node = up.anc WHERE t.parent IS NOT NULL),
 p AS (SELECT 's' || x.s_suppkey a, 's' || y.s_suppkey b FROM supplier x JOIN supplier y ON y.s_suppkey IN (x.s_suppkey + 1, x.s_suppkey + 7, x.s_suppkey * 2)),
 m AS (SELECT a, b, u.anc, u.steps, u.far + w.far distance FROM p JOIN up u ON u.node = a JOIN up w ON w.node = b AND w.anc = u.anc)
 SELECT a, b, arg_min(anc, steps) ancestor, round(arg_min(distance, steps), 9) distance FROM m GROUP BY 1, 2""")
def t02_tip_distances(spark: SparkSession, sf: str) -> DataFrame:
    """Each supplier's tip and three others: their lowest common ancestor and the distance between them."""
    ids = spark.read.parquet(f"{sf}/supplier.parquet").select("s_suppkey")
    k = c("s_suppkey")
    ask = ids.select(k, F.explode(F.array_distinct(F.array(k + 1, k + 7, k * 2))).alias("o"))
    pairs = ask.join(ids.select(k.alias("o")), "o").select(F.lit("fixed").alias("tree"), F.concat(F.lit("s"), k.cast("string")).alias("a"), F.concat(F.lit("s"), c("o").cast("string")).alias("b"))
    return rounded(T.tip_distances(tree(spark, sf), pairs).select("a", "b", "ancestor", "distance"), "distance")


@query()
def t20_rolling_folds(spark: SparkSession, sf: str) -> DataFrame:
    """Held-out errors of every cohort's tree, its latest three years held out one at a time."""
    t = clocks(spark, sf)
    years = tip_years(spark, sf, t).join(t.select("tree", "node"), "node")
    return T.rolling_folds(t, years.select("tree", "node", "year"), 3)


@query()
def t16_state_networks(spark: SparkSession, sf: str) -> DataFrame:
    """Ranges of changes for several kinds of state on one tree; kinds with fewer than two states are unavailable."""
    out = None
    for kind, state in (("host", S.host_state(c("host"))), ("region", S.state_text(c("region"))), ("country", S.known_country(c("country")))):
        one = histories(spark, sf, state).where("kind = 'change'").select(F.lit(kind).alias("state_kind"), "source", "target", "least", "most")
        out = one if out is None else out.unionByName(one)
    return out


MARGINAL = """m AS (SELECT node, k AS state, CASE WHEN k = 'A' THEN (length(node) * 7 + coalesce(sample_id, 3)) % 10 / 10.0::DOUBLE ELSE 1 - (length(node) * 7 + coalesce(sample_id, 3)) % 10 / 10.0::DOUBLE END p FROM @tree t0, (SELECT 'A' k UNION ALL SELECT 'B') kk),
 b AS (SELECT node, max(p) conf FROM m GROUP BY 1), n AS (SELECT m.node, min(state) state, any_value(conf) conf, count(*) > 1 tied FROM m JOIN b USING (node) WHERE p >= conf - 1e-10 GROUP BY 1),
 br AS (SELECT t.parent, t.node, q.state ps, n.state, q.conf pc, n.conf, NOT q.tied AND NOT n.tied AND q.conf >= 0.7 AND n.conf >= 0.7 sure FROM @tree t JOIN n ON n.node = t.node JOIN n q ON q.node = t.parent)"""


def marginal(spark: SparkSession, sf: str) -> DataFrame:
    t = tree(spark, sf)
    p = ((F.length("node") * 7 + F.coalesce("sample_id", F.lit(3))) % 10) / 10.0
    found = t.select("node", F.lit("A").alias("state"), p.alias("probability")).unionByName(t.select("node", F.lit("B").alias("state"), (1 - p).alias("probability")))
    return T.branch_states(t, found, 0.7)


@query(f"WITH {MARGINAL} SELECT parent, node, ps parent_state, state, round(pc, 9) parent_confidence, round(conf, 9) confidence, ps <> state AS changed, sure FROM br")
def j18_branch_states(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(marginal(spark, sf), "parent_confidence", "confidence")


@query(f"WITH {MARGINAL} SELECT ps source, state target, count(*) branches, count(*) FILTER (sure) sure_branches, count(*) FILTER (NOT sure) uncertain_branches FROM br WHERE ps <> state GROUP BY 1, 2")
def a38_t17_marginal_network(spark: SparkSession, sf: str) -> DataFrame:
    return T.change_edges(marginal(spark, sf))


EDGES = "e AS (SELECT n_name source, p_brand target, count(*) n FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN lineitem ON l_suppkey = s_suppkey JOIN part ON p_partkey = l_partkey GROUP BY 1, 2 UNION ALL SELECT n_name, r_name, 1 FROM nation JOIN region ON n_regionkey = r_regionkey)"


def edges(spark: SparkSession, sf: str) -> DataFrame:
    t = {n: spark.read.parquet(f"{sf}/{n}.parquet") for n in ("supplier", "nation", "region", "lineitem", "part")}
    sold = t["lineitem"].join(t["part"], c("p_partkey") == c("l_partkey")).join(t["supplier"], c("s_suppkey") == c("l_suppkey")).join(t["nation"], c("s_nationkey") == c("n_nationkey"))
    return sold.groupBy(c("n_name").alias("source"), c("p_brand").alias("target")).agg(F.count("*").alias("n")).unionByName(t["nation"].join(t["region"], c("n_regionkey") == c("r_regionkey")).select(c("n_name").alias("source"), c("r_name").alias("target"), F.lit(1).cast("bigint").alias("n")))


@query(f"""WITH {EDGES}, o AS (SELECT source node, count(DISTINCT target) out_degree, sum(n)::BIGINT out_weight FROM e GROUP BY 1), i AS (SELECT target node, count(DISTINCT source) in_degree, sum(n)::BIGINT in_weight FROM e GROUP BY 1)
 SELECT node, coalesce(in_degree, 0) in_degree, coalesce(out_degree, 0) out_degree, coalesce(in_weight, 0) in_weight, coalesce(out_weight, 0) out_weight, coalesce(in_degree, 0) + coalesce(out_degree, 0) AS degree, round(coalesce(out_degree, 0)::DOUBLE / (coalesce(in_degree, 0) + coalesce(out_degree, 0)), 9) source_share FROM o FULL JOIN i USING (node)""")
def t15_degrees(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(T.degrees(edges(spark, sf)), "source_share")


@query()
def t15_centrality(spark: SparkSession, sf: str) -> DataFrame:
    return T.centrality(edges(spark, sf))


@query(f"WITH {EDGES} SELECT source, target, n FROM e WHERE source <> target AND n > 0 AND source IN ('NATION_1', 'NATION_7')")
def t21_ego_network(spark: SparkSession, sf: str) -> DataFrame:
    return T.ego(edges(spark, sf), c("source").isin("NATION_1", "NATION_7"))


@query("""WITH s AS (SELECT run AS tree, sample_id, role, run % 2 AS g FROM @runs), k AS (SELECT tree, 'g' || (sample_id % 5) split FROM s GROUP BY 1, 2 HAVING count(*) >= 4 + tree % 3) SELECT split, count(*) AS runs, round(count(*) / 4.0::DOUBLE, 9) frequency FROM k GROUP BY 1""")
def a31_split_frequency(spark: SparkSession, sf: str) -> DataFrame:
    r = view(spark, sf, "runs").groupBy(c("run").alias("tree"), F.concat(F.lit("g"), (c("sample_id") % 5).cast("string")).alias("split")).agg(F.count("*").alias("n")).where("n >= 4 + tree % 3")
    return rounded(r.groupBy("split").agg(F.count("*").alias("runs"), (F.count("*") / 4).alias("frequency")), "frequency")


# Blocks --------------------------------------------------------------------------------------------------


def scoped(spark: SparkSession, sf: str) -> DataFrame:
    s = view(spark, sf, "samples")
    return s.select("sample_id", "role", "st", "mlst_scheme", "version", "database_sha256", S.species_key(c("species")).alias("species_key"), S.typing_scope(c("scheme"), c("version"), F.lit("")).alias("scope"), S.lineage_components(c("lineage")).alias("components"))


@query("""WITH k AS (SELECT sample_id, role, CASE WHEN scheme <> 'unknown' THEN 'species one|scheme|' || version || '|' || database_sha256 END block FROM @samples) SELECT block, count(*) FILTER (role = 'input') inputs, count(*) FILTER (role = 'context') context FROM k WHERE block IN (SELECT block FROM k WHERE role = 'input') GROUP BY 1""")
def b01_profile_blocks(spark: SparkSession, sf: str) -> DataFrame:
    return B.block_sizes(B.blocks(scoped(spark, sf), [c("species_key"), c("scope"), c("database_sha256")], [("missing_species", c("species_key") == ""), ("missing_profile_scope", c("scope").isNull())])[0])


@query("""WITH k AS (SELECT sample_id, role, CASE WHEN scheme <> 'unknown' THEN version || '|' || database_sha256 END block FROM @samples) SELECT sample_id, role, CASE WHEN block IS NULL THEN 'missing_profile_scope' ELSE 'no_input_in_block' END reason FROM k WHERE block IS NULL OR block NOT IN (SELECT block FROM k WHERE role = 'input' AND block IS NOT NULL)""")
def b01_left_out(spark: SparkSession, sf: str) -> DataFrame:
    return B.blocks(scoped(spark, sf), [c("species_key"), c("scope"), c("database_sha256")], [("missing_species", c("species_key") == ""), ("missing_profile_scope", c("scope").isNull())])[1]


@query("""SELECT st AS block, count(*) inputs, 0::BIGINT context FROM @samples WHERE role = 'input' AND st IS NOT NULL GROUP BY 1""")
def b02_st_blocks(spark: SparkSession, sf: str) -> DataFrame:
    return B.block_sizes(B.blocks(scoped(spark, sf).where("role = 'input'"), [c("st")], [("missing_st", c("st").isNull())])[0])


@query("""WITH p AS (SELECT sample_id, role, st, CASE WHEN sample_id % 6 <> 5 AND sample_id % 8 = 0 THEN [] ELSE [x for x in string_split(lineage, '_') if regexp_full_match(x, '[0-9]+')] END n FROM @samples), k AS (SELECT *, CASE WHEN st IS NOT NULL AND len(n) >= 2 THEN st || '|' || array_to_string(n[1:2], '_') END block FROM p)
 SELECT block, count(*) FILTER (role = 'input') inputs, count(*) FILTER (role = 'context') context FROM k WHERE block IN (SELECT block FROM k WHERE role = 'input') GROUP BY 1""")
def b03_lineage_blocks(spark: SparkSession, sf: str) -> DataFrame:
    prefix = F.concat_ws("_", F.transform(F.slice("components", 1, 2), lambda x: x.cast("string")))
    return B.block_sizes(B.blocks(scoped(spark, sf), [c("st"), prefix], [("missing_st", c("st").isNull()), ("unresolved_lineage", F.size("components") < 2)])[0])


@query("""WITH k AS (SELECT coalesce(st, '') st_, count(DISTINCT mlst_scheme) n, min(mlst_scheme) v FROM @samples WHERE mlst_scheme IS NOT NULL GROUP BY 1) SELECT sample_id, 'species one' species_key, st, coalesce(mlst_scheme, CASE WHEN n = 1 THEN v END) comparison_scheme, mlst_scheme IS NULL AND coalesce(n, 0) > 1 ambiguous FROM @samples LEFT JOIN k ON st_ = coalesce(st, '')""")
def b04_namespaces(spark: SparkSession, sf: str) -> DataFrame:
    return B.namespaces(scoped(spark, sf))


@query("""WITH p AS (SELECT sample_id, role, array_to_string(list_slice(string_split(lineage, '_'), 1, 3), '_') AS pre, sample_id % 6 <> 5 AND sample_id % 8 = 0 bad FROM @samples) SELECT sample_id, pre AS prefix FROM p WHERE NOT bad AND pre IN (SELECT pre FROM p WHERE role = 'input' AND NOT bad)""")
def b06_input_prefix_views(spark: SparkSession, sf: str) -> DataFrame:
    k = scoped(spark, sf).where(F.size("components") >= 3).select("sample_id", "role", F.concat_ws("_", F.transform(F.slice("components", 1, 3), lambda x: x.cast("string"))).alias("prefix"))
    return k.join(k.where("role = 'input'").select("prefix").distinct(), "prefix", "left_semi").select("sample_id", "prefix")


@query("""WITH g AS (SELECT coalesce(st, 'unassigned') label, count(*) FILTER (role = 'input') inputs, count(*) FILTER (role = 'context') context FROM @samples GROUP BY 1) SELECT 'st' kind, label, inputs, context, row_number() OVER (ORDER BY inputs + context DESC, label) <= 2 OR inputs > 0 AS shown FROM g""")
def b07_display_groups(spark: SparkSession, sf: str) -> DataFrame:
    return B.display_groups(scoped(spark, sf), "st", c("st"), 2)


@query()
def o05_refused_cohorts(spark: SparkSession, sf: str) -> DataFrame:
    """Every cohort with its size; those of more than fifteen members are refused with the reason."""
    return C.bounded_members(all_cohorts(spark, sf), 15)[1]


@query("SELECT st AS \"group\", count(*) n, CASE WHEN count(*) > 30 THEN 'refused' ELSE 'accepted' END status FROM @samples GROUP BY 1")
def o05_refused_pools(spark: SparkSession, sf: str) -> DataFrame:
    return B.refused(view(spark, sf, "samples").withColumnRenamed("st", "group"), "group", 30)


# Selection -----------------------------------------------------------------------------------------------


def compared(spark: SparkSession, sf: str) -> L.Compared:
    """The distances of all samples in one scope, made as they are asked for."""
    return L.Compared(Q.one_scope(spark, sf), view(spark, sf, "calls"), OVERLAP)


def mandatory(spark: SparkSession, sf: str) -> DataFrame:
    return Q.w02_boundary_neighbours(spark, sf).select(c("context_id").alias("sample_id")).distinct()


@query("""WITH w AS (SELECT unnest(['3', 'src5', 'acc7', 'zzz', 'acc1']) pin), p AS (SELECT sample_id, sample_id::VARCHAR pin FROM @samples UNION SELECT sample_id, 'src' || sample_id FROM samples UNION SELECT sample_id, 'acc' || (sample_id % 60) FROM samples) SELECT w.pin, CASE count(sample_id) WHEN 1 THEN 'pinned' WHEN 0 THEN 'unknown' ELSE 'ambiguous' END status, CASE WHEN count(sample_id) = 1 THEN min(sample_id) END sample_id FROM w LEFT JOIN p USING (pin) GROUP BY 1""")
def l01_pins(spark: SparkSession, sf: str) -> DataFrame:
    k = c("sample_id")
    pool = view(spark, sf, "samples").select(k, F.concat(F.lit("src"), k.cast("string")).alias("source"), F.concat(F.lit("acc"), (k % 60).cast("string")).alias("accession"))
    return L.pinned(pool, spark.sql("select explode(array('3', 'src5', 'acc7', 'zzz', 'acc1')) as pin"))


@query("SELECT sample_id, coalesce(st, 'Unknown') || '/' || region || '/' || CASE WHEN city = '' THEN 'Unknown' ELSE city END cell FROM @samples")
def l03_strata(spark: SparkSession, sf: str) -> DataFrame:
    return L.strata(view(spark, sf, "samples"), [c("st"), c("region"), c("city")])


CELLS = "cells AS (SELECT sample_id, coalesce(st, 'Unknown') || '/' || region cell FROM @samples), held AS (SELECT sample_id FROM @samples WHERE role = 'input')"
PLACES = CELLS + ", q AS (SELECT cell, row_number() OVER (ORDER BY md5('5|' || cell), cell) place FROM (SELECT DISTINCT cell FROM cells WHERE sample_id NOT IN (SELECT sample_id FROM held))), places AS (SELECT cell, place FROM q WHERE place <= greatest(0, 40 - (SELECT count(*) FROM held)) AND place <= 10)"


@query(f"WITH {PLACES} SELECT cell, place FROM places")
def l04_quotas(spark: SparkSession, sf: str) -> DataFrame:
    s = view(spark, sf, "samples")
    return L.quotas(L.strata(s, [c("st"), c("region")]), s.where("role = 'input'"), 40, 5)


@query(f"WITH {PLACES} SELECT cell, place, arg_min(sample_id, md5('6|' || sample_id)) sample_id FROM cells JOIN places USING (cell) WHERE sample_id NOT IN (SELECT sample_id FROM held) GROUP BY 1, 2")
def l04_representatives(spark: SparkSession, sf: str) -> DataFrame:
    s = view(spark, sf, "samples")
    cells, inputs = L.strata(s, [c("st"), c("region")]), s.where("role = 'input'")
    return L.representatives(cells, inputs, L.quotas(cells, inputs, 40, 5), 6)


@query()
def l05_diverse_fill(spark: SparkSession, sf: str) -> DataFrame:
    """Mandatory samples, one of each quota cell, then the farthest ones."""
    samples = view(spark, sf, "samples")
    return L.diverse(samples, checkpointed(mandatory(spark, sf)), compared(spark, sf), 60, 5, cells=L.strata(samples, [c("st"), c("region")]))


@query(f"WITH {PLACES}, r AS (SELECT unnest([1, 2, 3])::INT AS run) SELECT run, cell, place, arg_min(sample_id, md5((7 + run) || '|' || sample_id)) sample_id FROM cells JOIN places USING (cell) CROSS JOIN r WHERE sample_id NOT IN (SELECT sample_id FROM held) GROUP BY 1, 2, 3")
def l05_quota_draws(spark: SparkSession, sf: str) -> DataFrame:
    """One sample of each quota cell, drawn anew for each of three runs."""
    s = view(spark, sf, "samples")
    return L.quota_draws(L.strata(s, [c("st"), c("region")]), s.where("role = 'input'"), 40, 5, {r: 7 + r for r in (1, 2, 3)})


@query()
def l06_ensemble(spark: SparkSession, sf: str) -> DataFrame:
    """Three sets that differ, with their seeds and attempts."""
    samples = view(spark, sf, "samples")
    return L.distinct_sets(samples, checkpointed(mandatory(spark, sf)), compared(spark, sf), 20, 6, 5, 3, L.strata(samples, [c("st"), c("region")]))[1]


NEED = Q.BOTH + """, rk AS (SELECT x query_id, y context_id, diff, row_number() OVER (PARTITION BY x ORDER BY diff, y) i FROM bw WHERE x % 10 = 0 AND y % 10 <> 0), cu AS (SELECT query_id, max(diff) b FROM rk WHERE i <= 3 GROUP BY 1), need AS (SELECT DISTINCT context_id sample_id FROM rk JOIN cu USING (query_id) WHERE diff <= b)"""


@query(f"WITH {NEED} SELECT sample_id FROM need")
def l02_mandatory(spark: SparkSession, sf: str) -> DataFrame:
    return mandatory(spark, sf)


@query(f"""WITH {NEED}, m AS (SELECT count(*) mandatory FROM need), n AS (SELECT count(*) available FROM @samples)
 SELECT 20 AS requested, greatest(20, mandatory + 4) AS effective, mandatory, greatest(0, mandatory - 20) AS overrun, available FROM m, n""")
def l06_budget(spark: SparkSession, sf: str) -> DataFrame:
    return L.budget(view(spark, sf, "samples"), mandatory(spark, sf), 20, 4)


@query("""WITH i AS (SELECT count(*) n FROM @samples WHERE role = 'input'), p AS (SELECT count(*) n FROM samples), e AS (SELECT least(p.n, i.n + 3) AS size FROM i, p)
 SELECT 'members' AS "table", 3 * size AS "rows", 3 AS runs FROM e UNION ALL SELECT 'audit', 3, 3 UNION ALL SELECT 'overlap', 3, 3""")
def k05_selection_bundle(spark: SparkSession, sf: str) -> DataFrame:
    """Three sets of all inputs and three more samples, their audit and overlaps published as one stage and read back."""
    from ..sources import stages
    from .q_sources import place

    samples = view(spark, sf, "samples")
    at, inputs = place(spark, "selection"), samples.where("role = 'input'")

    def work() -> dict[str, DataFrame]:
        members, audit = L.distinct_sets(samples, inputs, compared(spark, sf), 0, 3, 5, 3)
        return {"members": members, "audit": audit, "overlap": A.selection_overlap(members.select("run", "sample_id"))}

    def check(tables: dict[str, DataFrame]) -> DataFrame:
        # Every run holds each input once.
        per = tables["members"].join(inputs.select("sample_id"), "sample_id", "left_semi").groupBy("run").agg(F.count("*").alias("have"), F.count_distinct("sample_id").alias("different"))
        want = inputs.agg(F.count("*").alias("want"))  # one row
        return per.join(F.broadcast(want)).where("have != want or different != want").select(F.lit("inputs_missing").alias("problem"), F.col("have").alias("n"))

    stages.publish(at, "selection", work, check)
    tables, out = stages.stage_tables(spark, at, "selection"), None
    for name, df in tables.items():
        run = "run" if "run" in df.columns else "run_a"
        runs = 3 if name == "overlap" else df.select(run).distinct().count()
        one = df.agg(F.count("*").alias("rows")).select(F.lit(name).alias("table"), "rows", F.lit(runs).alias("runs"))
        out = one if out is None else out.unionByName(one)
    return out


@query(f"""WITH {NEED}, k AS (SELECT s.sample_id, CASE WHEN role = 'input' THEN 'input' WHEN need.sample_id IS NOT NULL THEN 'mandatory_neighbour' ELSE 'fill' END reason FROM @samples s LEFT JOIN need ON need.sample_id = s.sample_id), p AS (SELECT *, row_number() OVER (ORDER BY CASE reason WHEN 'input' THEN 0 WHEN 'mandatory_neighbour' THEN 1 ELSE 2 END, sample_id) AS position FROM k) SELECT sample_id, reason, position FROM p WHERE reason <> 'fill' OR position <= 55""")
def l07_all_inputs(spark: SparkSession, sf: str) -> DataFrame:
    return L.all_inputs(view(spark, sf, "samples").select("sample_id", "role"), mandatory(spark, sf), 55)


@query(f"""WITH {NEED}, m AS (SELECT sample_id + 2 sample_id FROM @samples WHERE sample_id % 3 = 0), pool AS (SELECT sample_id, role FROM @samples)
 SELECT 'unknown_member' AS rule, count(*) n FROM m WHERE sample_id NOT IN (SELECT sample_id FROM pool) UNION ALL SELECT 'repeated_member', 0 UNION ALL SELECT 'missing_input', count(*) FROM pool WHERE role = 'input' AND sample_id NOT IN (SELECT sample_id FROM m)
 UNION ALL SELECT 'missing_mandatory', count(*) FROM need WHERE sample_id NOT IN (SELECT sample_id FROM m) UNION ALL SELECT 'over_budget', greatest(count(*) - 20, 0) FROM m""")
def v06_l08_saved_selection(spark: SparkSession, sf: str) -> DataFrame:
    s = view(spark, sf, "samples")
    return L.saved_violations(s.where("sample_id % 3 = 0").select((c("sample_id") + 2).alias("sample_id")), s, mandatory(spark, sf), 20)


@query("""SELECT run, count(DISTINCT sample_id) AS size, bool_and(sample_id % 10 <> 0 OR role = 'input') AS consistent FROM @runs GROUP BY 1""")
def j22_run_blocks(spark: SparkSession, sf: str) -> DataFrame:
    return view(spark, sf, "runs").groupBy("run").agg(F.count_distinct("sample_id").alias("size"), F.bool_and((c("sample_id") % 10 != 0) | (c("role") == "input")).alias("consistent"))


@query("""WITH v AS (SELECT id, CASE id % 5 WHEN 0 THEN 0 ELSE 20 END requested, CASE WHEN id % 7 = 0 THEN 18 ELSE CASE id % 5 WHEN 0 THEN 0 ELSE 20 END END successful, (id % 6) - 1 rate, p FROM @windows WHERE p IS NOT NULL) SELECT id, CASE WHEN requested = 0 OR successful <> requested THEN 'not_assessed' WHEN rate <= 0 OR p > 0.5 THEN 'not_supported' ELSE 'supported' END verdict FROM v""")
def a28_temporal_verdict(spark: SparkSession, sf: str) -> DataFrame:
    from ..operators.compare import temporal_verdict

    k = c("id")
    w = view(spark, sf, "windows").where("p is not null")
    asked = F.when(k % 5 == 0, 0).otherwise(20)
    return w.select("id", temporal_verdict(asked, F.when(k % 7 == 0, 18).otherwise(asked), (k % 6) - 1, c("p"), 0.5).alias("verdict"))


@query("""WITH v AS (SELECT id, p, p - 0.1 lo, p + 0.1 hi FROM @windows WHERE p IS NOT NULL) SELECT count(*) FILTER (lo <= 0.5 AND 0.5 <= hi) cr1_overlaps, count(*) FILTER (greatest(0.45, lo) <= least(0.55, hi)) cr2_overlaps FROM v""")
def a27_interval_overlap(spark: SparkSession, sf: str) -> DataFrame:
    from ..operators.compare import interval_overlaps

    return interval_overlaps(view(spark, sf, "windows").where("p is not null").select((c("p") - 0.1).alias("low"), (c("p") + 0.1).alias("high")), 0.5, 0.45, 0.55)


@query("""WITH k AS (SELECT record, start_at, end_at, end_at - start_at w, row_number() OVER (ORDER BY end_at - start_at, record, start_at, end_at) i, count(*) OVER () n FROM @intervals) SELECT (SELECT w FROM k WHERE i = n // 2 + 1) middle, (SELECT max(w) FROM k) widest, (SELECT count(*) FROM k) nodes""")
def a39_interval_widths(spark: SparkSession, sf: str) -> DataFrame:
    from ..operators.compare import interval_widths

    return interval_widths(view(spark, sf, "intervals").select((c("end_at") - c("start_at")).alias("width")))


@query("""WITH p AS (SELECT sample_id, year(day) y, value FROM @points), tr AS (SELECT sample_id, avg(value) m, arg_max(value, y * 1000 + value) l FROM p WHERE y < 2001 OR sample_id % 2 = 0 GROUP BY 1) SELECT count(*) n, round(avg(abs(p.value - m)), 6) mean_mae FROM p JOIN tr USING (sample_id)""")
def a41_holdout_error(spark: SparkSession, sf: str) -> DataFrame:
    p = view(spark, sf, "points").select("sample_id", F.year("day").alias("y"), "value")
    mean = p.where("y < 2001 or sample_id % 2 = 0").groupBy("sample_id").agg(F.avg("value").alias("m"))
    return p.join(mean, "sample_id").agg(F.count("*").alias("n"), F.round(F.avg(F.abs(c("value") - c("m"))), 6).alias("mean_mae"))



