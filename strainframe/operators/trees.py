"""Trees as node tables (tree, node, parent, length, ...), and states along them.

Sums along paths are level-wise joins; what is inherently sequential runs as
one task for each tree.
"""

from __future__ import annotations

import hashlib
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.shared import checkpointed


def root_to_tip(nodes: DataFrame) -> DataFrame:
    """(node, depth, distance) of every node, by doubling: each round adds the way of the ancestor reached so far.

    A tree of depth d takes about log2(d) rounds; a chain that never ends (a
    loop, which is no tree) is an error.
    """
    step = nodes.select("node", F.col("parent").alias("up"), F.when(F.col("parent").isNull(), 0.0).otherwise(F.col("length")).alias("distance"), F.when(F.col("parent").isNull(), 0).otherwise(1).cast("bigint").alias("depth"))
    step, reach, total = checkpointed(step), 1, None
    while step.where("up is not null").limit(1).count():
        total = step.count() if total is None else total
        if reach > total:
            raise ValueError("the parents of some nodes form a loop")
        above = step.select(F.col("node").alias("up"), F.col("up").alias("next"), F.col("distance").alias("more"), F.col("depth").alias("further"))
        step, reach = checkpointed(step.join(above, "up", "left").select("node", F.col("next").alias("up"), (F.col("distance") + F.coalesce("more", F.lit(0.0))).alias("distance"), (F.col("depth") + F.coalesce("further", F.lit(0))).alias("depth"))), 2 * reach
    return step.select("node", "depth", "distance")


def ancestors(nodes: DataFrame) -> DataFrame:
    """(node, ancestor, steps) of every node and all nodes above it, itself included, by doubling."""
    pairs = checkpointed(nodes.select("node", F.col("node").alias("ancestor"), F.lit(0).cast("bigint").alias("steps")).unionByName(nodes.where("parent is not null").select("node", F.col("parent").alias("ancestor"), F.lit(1).cast("bigint").alias("steps"))))
    reach = 1
    while True:
        far = pairs.where(F.col("steps") == reach)
        if not far.limit(1).count():
            return pairs
        more = far.select("node", F.col("ancestor").alias("via")).join(pairs.where("steps > 0").select(F.col("node").alias("via"), "ancestor", F.col("steps").alias("s")), "via").select("node", "ancestor", (F.col("s") + reach).alias("steps"))
        pairs = checkpointed(pairs.unionByName(more))
        reach *= 2


def common_ancestor(nodes: DataFrame, targets: DataFrame) -> DataFrame:
    """(group, ancestor, targets, tips_below, extra): the deepest node above all targets (group, node) of a group."""
    up = ancestors(nodes)
    n = targets.groupBy("group").agg(F.count("*").alias("targets"))
    shared = targets.join(up, "node").groupBy("group", "ancestor").agg(F.count("*").alias("hits"), F.min("steps").alias("near"))
    best = shared.join(n, "group").where("hits = targets").groupBy("group").agg(F.min(F.struct("near", "ancestor")).alias("m"), F.max("targets").alias("targets"))
    inner = nodes.where("parent is not null").select(F.col("parent").alias("node")).distinct()
    tips = nodes.select("node").join(inner, "node", "left_anti")
    below = up.join(tips, "node", "left_semi").groupBy("ancestor").agg(F.count("*").alias("tips_below"))
    return best.select("group", F.col("m.ancestor").alias("ancestor"), "targets").join(below, "ancestor").select("group", "ancestor", "targets", "tips_below", (F.col("tips_below") - F.col("targets")).alias("extra"))


def not_negative(nodes: DataFrame) -> DataFrame:
    """The node table with negative lengths as 0, and what was changed."""
    return nodes.withColumn("clamped", F.coalesce(F.col("length") < 0, F.lit(False))).withColumn("original", F.col("length")).withColumn("length", F.greatest(F.col("length"), F.lit(0.0)))


def splits(nodes: DataFrame, least: int = 2, anchors: DataFrame | None = None) -> DataFrame:
    """(tree, split): the tips on the smaller side of every inner edge, both sides of at least ``least`` tips.

    Equal sides are settled by name, so where a tree is rooted does not matter; with ``anchors`` only those tips count.
    """
    inner = nodes.select("tree", F.col("parent").alias("node")).where("node is not null").distinct()
    tips = nodes.join(inner, ["tree", "node"], "left_anti").select("tree", "node")
    if anchors is not None:
        tips = tips.join(anchors.select("node").distinct(), "node", "left_semi")
    up = nodes.select("tree", "node", "parent")
    found = tips.select("tree", F.col("node").alias("tip"), F.col("node").alias("at"))
    climb, rounds = found, []
    while True:
        above = climb.join(up.select("tree", F.col("node").alias("at"), "parent"), ["tree", "at"]).where("parent is not null")
        climb = checkpointed(above.select(F.col("tree").alias("tree"), F.col("tip").alias("tip"), F.col("parent").alias("at")))
        if not climb.limit(1).count():
            break
        rounds.append(climb.select(*(F.col(c).alias(c) for c in ("tree", "tip", "at"))))
    sides = reduce(DataFrame.unionByName, rounds)
    listed = sides.groupBy("tree", "at").agg(F.sort_array(F.collect_set("tip")).alias("side"))
    every = tips.groupBy("tree").agg(F.sort_array(F.collect_list("node")).alias("all"))
    both = listed.join(every, "tree").withColumn("other", F.array_except("all", "side")).where((F.size("side") >= least) & (F.size("other") >= least))
    smaller = F.when((F.size("side") < F.size("other")) | ((F.size("side") == F.size("other")) & (F.col("side") <= F.col("other"))), F.col("side")).otherwise(F.col("other"))
    return both.select("tree", F.concat_ws("|", smaller).alias("split")).distinct()


def clades(nodes: DataFrame) -> DataFrame:
    """(tips, mark_sum, mark_xor) of every inner node of one tree: the number of tips below it, and two fingerprints of their set.

    Fingerprints add up below a node in any order, so no list of tips is ever
    gathered; two different sets meet with a probability of about 2**-127.
    """
    inner = nodes.where("parent is not null").select(F.col("parent").alias("node")).distinct()
    tips = nodes.select("node").join(inner, "node", "left_anti")
    marks = tips.select("node", F.xxhash64("node").cast("decimal(38,0)").alias("one"), F.xxhash64(F.lit("tip"), "node").alias("two"))
    return ancestors(nodes).join(marks, "node").where("steps > 0").groupBy("ancestor").agg(F.count("*").alias("tips"), F.sum("one").alias("mark_sum"), F.bit_xor("two").alias("mark_xor")).drop("ancestor").distinct()


def same_topology(a: DataFrame, b: DataFrame) -> DataFrame:
    """One row: clades (sets of tips below an inner node) of either rooted tree only, and of both.

    Trees of one shape that differ in their root alone differ here.
    """
    x, y = clades(a).withColumn("x", F.lit(1)), clades(b).withColumn("y", F.lit(1))
    return x.join(y, ["tips", "mark_sum", "mark_xor"], "full_outer").agg(F.count_if(F.col("y").isNull()).alias("first_only"), F.count_if(F.col("x").isNull()).alias("second_only"), F.count_if(F.col("x").isNotNull() & F.col("y").isNotNull()).alias("both"))


# One tree in one task ----------------------------------------------------------------------------------


class Tree:
    """Nodes in preorder with children and lengths; order of children is by name."""

    def __init__(self, rows: list[tuple[str, str | None, float]]):
        kids: dict[str | None, list[tuple[str, float]]] = {}
        for node, parent, length in rows:
            kids.setdefault(None if pd.isna(parent) else parent, []).append((node, 0.0 if length is None or pd.isna(length) else float(length)))
        self.names, self.parent, self.length = [], [], []
        stack = [(n, -1, x) for n, x in sorted(kids.get(None, []), reverse=True)]
        while stack:
            node, parent, length = stack.pop()
            at = len(self.names)
            self.names.append(node)
            self.parent.append(parent)
            self.length.append(length)
            stack += [(n, at, x) for n, x in sorted(kids.get(node, []), reverse=True)]
        self.children: list[list[int]] = [[] for _ in self.names]
        for i, p in enumerate(self.parent):
            if p >= 0:
                self.children[p].append(i)

    def rows(self) -> list[tuple[str, str | None, float]]:
        return [(n, self.names[p] if p >= 0 else None, x) for n, p, x in zip(self.names, self.parent, self.length, strict=True)]


def pruned(tree: Tree, keep: set[str]) -> list[tuple[str, str | None, float]]:
    """Only the tips of ``keep`` and what joins them; nodes left with one child go, their lengths are added."""
    alive = [name in keep if not tree.children[i] else False for i, name in enumerate(tree.names)]
    for i in range(len(alive) - 1, 0, -1):
        alive[tree.parent[i]] |= alive[i]
    kids = [[c for c in tree.children[i] if alive[c]] for i in range(len(alive))]
    out: list[tuple[str, str | None, float]] = []
    stack: list[tuple[int, str | None, float]] = [(0, None, 0.0)] if alive and alive[0] else []
    while stack:
        i, parent, length = stack.pop()
        while len(kids[i]) == 1:
            i = kids[i][0]
            length += tree.length[i]
        out.append((tree.names[i], parent, length if parent is not None else 0.0))
        stack += [(c, tree.names[i], tree.length[c]) for c in reversed(kids[i])]
    return out


def rerooted(tree: Tree, child: int, from_parent: float, name: str = "new_root") -> list[tuple[str, str | None, float]]:
    """The tree with its root on the edge above ``child``, at a distance from the edge's parent; a root left with one child goes."""
    near: dict[str, list[tuple[str, float]]] = {}
    for i, p in enumerate(tree.parent):
        if p < 0:
            continue
        ends = [(tree.names[p], tree.names[i], tree.length[i])] if i != child else [(tree.names[p], name, from_parent), (name, tree.names[i], tree.length[i] - from_parent)]
        for a, b, x in ends:
            near.setdefault(a, []).append((b, x))
            near.setdefault(b, []).append((a, x))
    old = tree.names[0]
    if len(near.get(old, [])) == 2:
        (a, x), (b, y) = near.pop(old)
        for u, v in ((a, b), (b, a)):
            near[u] = [(v, x + y) if w == old else (w, z) for w, z in near[u]]
    out, stack = [], [(name, None, 0.0)]
    while stack:
        node, parent, length = stack.pop()
        out.append((node, parent, length))
        stack += [(other, node, x) for other, x in sorted(near[node], reverse=True) if other != parent]
    return out


def clock_root(tree: Tree, years: dict[str, float]) -> dict:
    """The place on an edge that makes root-to-tip distances most linear in time (least residual mean square).

    With the root at x from the edge's parent, a dated tip's distance is u + x v with v = -1 below the edge and 1
    elsewhere.  The residual of regressing it on the dates is that of u plus x times that of v, so the mean square is
    a parabola in x whose coefficients follow from sums over the two sides; all edges are solved at once after one
    pass up and one down.  Edges of negative length hold no root; the two edges at a root with two children are one.
    """
    n = len(tree.names)
    tips = [i for i in range(n) if not tree.children[i]]
    dated = [i for i in tips if tree.names[i] in years]
    values = np.array([years[tree.names[i]] for i in dated])
    if len(tips) < 3:
        return {"status": "skipped", "reason": "fewer_than_three_tree_tips"}
    if len(dated) < 3:
        return {"status": "skipped", "reason": "fewer_than_three_dated_tips"}
    if len(set(values.tolist())) < 3:
        return {"status": "skipped", "reason": "fewer_than_three_distinct_dates"}
    reference = values.mean()
    # For each node the sums over dated tips below it: 1, t, d, d*d, t*d, with d from the node and t centred.
    below = np.zeros((n, 5))
    for i, t in zip(dated, values - reference, strict=True):
        below[i, :2] = 1, t

    def moved(s: np.ndarray, x: float) -> np.ndarray:
        k, t, d, dd, td = s
        return np.array([k, t, d + x * k, dd + 2 * x * d + x * x * k, td + x * t])

    for i in range(n - 1, 0, -1):
        below[tree.parent[i]] += moved(below[i], tree.length[i])
    whole = np.zeros((n, 5))  # over all dated tips, d from the node
    whole[0] = below[0]
    for i in range(1, n):
        rest = whole[tree.parent[i]] - moved(below[i], tree.length[i])
        whole[i] = below[i] + moved(rest, tree.length[i])
    total, tt = len(dated), float(((values - reference) ** 2).sum())
    best = None
    two = tree.children[0] if len(tree.children[0]) == 2 else []
    for i in range(1, n):
        p, length = tree.parent[i], tree.length[i]
        if two and p == 0:
            a, b = two
            if i == b or tree.length[a] < 0 or tree.length[b] < 0:
                continue
            length = tree.length[a] + tree.length[b]
            outer = below[b]  # seen from b, the other end of the joined edge
        elif length < 0:
            continue
        else:
            outer = whole[p] - moved(below[i], length)
        inner = moved(below[i], length)
        # Sums of u, uu, tu, v, tv, uv over all dated tips.
        u, uu, tu = inner[2] + outer[2], inner[3] + outer[3], inner[4] + outer[4]
        v, tv, uv = outer[0] - inner[0], outer[1] - inner[1], outer[2] - inner[2]
        ruu, rvv, ruv = uu - u * u / total - tu * tu / tt, total - v * v / total - tv * tv / tt, uv - u * v / total - tu * tv / tt
        x = min(max(-ruv / rvv, 0.0), length) if rvv > 1e-12 else 0.0
        mse = max(0.0, (ruu + 2 * x * ruv + x * x * rvv) / total)
        slope = (tu + x * tv) / tt
        key = (round(mse, 12), tree.names[i])
        if best is None or key < best[0]:
            spread = (uu + 2 * x * uv + x * x * total) - (u + x * v) ** 2 / total
            best = (key, {"status": "rooted", "reason": None, "child": i, "from_parent": x, "edge_length": length, "mse": mse, "slope": slope, "r2": (slope * slope * tt / spread) if spread > 0 else None})
    return best[1] if best else {"status": "skipped", "reason": "no_eligible_edge"}


def clock_roots(nodes: DataFrame, dates: DataFrame) -> DataFrame:
    """(tree, status, reason, child, from_parent, edge_length, mse, slope, r2) for each tree; ``dates`` are (node, year)."""
    joined = nodes.select("tree", "node", "parent", "length").join(dates.select("node", "year"), "node", "left")

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        tree = Tree(list(rows[["node", "parent", "length"]].itertuples(index=False, name=None)))
        got = clock_root(tree, {n: y for n, y in rows[["node", "year"]].itertuples(index=False, name=None) if pd.notna(y)})
        child = tree.names[got["child"]] if "child" in got else None
        return pd.DataFrame([(rows["tree"].iloc[0], got["status"], got["reason"], child, *(got.get(k) for k in ("from_parent", "edge_length", "mse", "slope", "r2")))], columns=["tree", "status", "reason", "child", "from_parent", "edge_length", "mse", "slope", "r2"])

    return joined.groupBy("tree").applyInPandas(run, f"tree {dict(nodes.dtypes)['tree']}, status string, reason string, child string, from_parent double, edge_length double, mse double, slope double, r2 double")


class Histories:
    """The histories of fewest changes of state on one tree; tips without a state are wildcards.

    ``allowed[node]`` are the states of a node in some best history, and
    ``moves[child][s, t]`` says whether state t may follow s of its parent.
    """

    def __init__(self, tree: Tree, observed: dict[str, str]):
        self.tree, self.states = tree, sorted(set(observed.values()))
        k, n = len(self.states), len(tree.names)
        place, big = {s: i for i, s in enumerate(self.states)}, 1 << 28
        self.fixed = [place.get(observed.get(name)) if not tree.children[i] else None for i, name in enumerate(tree.names)]
        # Nodes in an order in which a child with more nodes below it is met later, so its sums are done first.
        size = np.ones(n, np.int64)
        for i in range(n - 1, 0, -1):
            size[tree.parent[i]] += size[i]
        self.order, stack = [], [0]
        while stack:
            i = stack.pop()
            self.order.append(i)
            stack += sorted(tree.children[i], key=lambda c: -size[c])
        self.optimum, self.allowed, self.moves = 0, {}, {}
        if not k:
            return
        cost = np.zeros((n, k), np.int64)
        for i, state in enumerate(self.fixed):
            if state is not None:
                cost[i] = big
                cost[i, state] = 0
        change = 1 - np.eye(k, dtype=np.int64)
        for c in reversed(self.order[1:]):
            step = cost[c][None, :] + change  # from a state here to a state there
            best = step.min(axis=1)
            self.moves[c] = step == best[:, None]
            cost[tree.parent[c]] += best
        self.optimum = int(cost[0].min())
        self.allowed[0] = cost[0] == self.optimum
        for c in self.order[1:]:
            self.allowed[c] = self.moves[c][self.allowed[tree.parent[c]]].any(axis=0)

    def ranges(self, directed: bool = True) -> dict[tuple[str, str], tuple[int, int]]:
        """For each pair of states the fewest and most changes over all best histories; pairs need not reach theirs together.

        A node adds to its parent and is dropped as soon as it is done; as
        larger subtrees come first, about log2(n) nodes are held at a time.
        """
        k, tree = len(self.states), self.tree
        if not k:
            return {}
        cell = lambda s, t: (s, t) if directed or s < t else (t, s)
        held: dict[int, tuple[np.ndarray, np.ndarray]] = {0: (np.zeros((k, k, k), np.int32), np.zeros((k, k, k), np.int32))}
        for c in reversed(self.order[1:]):
            p = tree.parent[c]
            if p not in held:
                held[p] = np.zeros((k, k, k), np.int32), np.zeros((k, k, k), np.int32)
            low, high = held[p]
            if not tree.children[c]:
                if self.fixed[c] is not None:
                    for s in range(k):
                        if s != self.fixed[c]:
                            low[s][cell(s, self.fixed[c])] += 1
                            high[s][cell(s, self.fixed[c])] += 1
                continue
            own_low, own_high = held.pop(c)
            for s in range(k):
                least = most = None
                for t in np.flatnonzero(self.moves[c][s]):
                    a, b = own_low[t], own_high[t]
                    if s != t:
                        a, b = a.copy(), b.copy()
                        a[cell(s, t)] += 1
                        b[cell(s, t)] += 1
                    least = a if least is None else np.minimum(least, a)
                    most = b if most is None else np.maximum(most, b)
                low[s] += least
                high[s] += most
        low, high = held[0]
        roots = np.flatnonzero(self.allowed[0])
        low, high = low[roots].min(axis=0), high[roots].max(axis=0)
        return {(self.states[s], self.states[t]): (int(low[s, t]), int(high[s, t])) for s in range(k) for t in range(k) if s != t and high[s, t] > 0}

    def history(self, seed: int) -> dict[str, str]:
        """One best history: a reproducible choice at each tie, by ``md5(seed|node|state)``, not a uniform sample of all."""
        if not self.states:
            return {}
        tree = self.tree
        pick = lambda i, options: min(np.flatnonzero(options).tolist(), key=lambda t: hashlib.md5(f"{seed}|{tree.names[i]}|{self.states[t]}".encode()).hexdigest())  # noqa: E731, S324
        chosen = {0: pick(0, self.allowed[0])}
        for c in self.order[1:]:
            chosen[c] = pick(c, self.moves[c][chosen[tree.parent[c]]])
        return {tree.names[i]: self.states[s] for i, s in chosen.items()}

    def possible(self) -> tuple[set[tuple[str, str]], set[tuple[str, str]], int]:
        """Pairs of states (in order of name) that some branch may change between, those of branches with a choice, and how many branches have one."""
        every, unsure, branches = set(), set(), 0
        for c in self.order[1:]:
            options = np.argwhere(self.moves[c] & self.allowed[self.tree.parent[c]][:, None]) if self.states else []
            pairs = {tuple(sorted((self.states[a], self.states[b]))) for a, b in options if a != b}
            every |= pairs
            if len(options) > 1:
                branches += 1
                unsure |= pairs
        return every, unsure, branches


def parsimony(tree: Tree, observed: dict[str, str]) -> tuple[int, dict[str, list[str]], dict[tuple[str, str], tuple[int, int]]]:
    """Fewest changes of state; the states each node has in some best history; and for each ordered pair of states the
    fewest and most changes over all best histories."""
    found = Histories(tree, observed)
    return found.optimum, {tree.names[i]: [found.states[s] for s in np.flatnonzero(a)] for i, a in found.allowed.items()}, found.ranges()


def reconstructed(nodes: DataFrame, states: DataFrame, seed: int = 5) -> DataFrame:
    """(tree, kind, node, source, target, least, most) of each tree's best histories; ``states`` are (node, state).

    Kinds: the ``optimum``; for each ``node`` its possible states; ranges of
    directed ``change``s and undirected ``exchange``s; and the branches of one
    ``history``, from the parent's state to the node's.
    """
    joined = nodes.select("tree", "node", "parent", "length").join(states.select("node", "state"), "node", "left")

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        tree = Tree(list(rows[["node", "parent", "length"]].itertuples(index=False, name=None)))
        found = Histories(tree, {n: s for n, s in rows[["node", "state"]].itertuples(index=False, name=None) if pd.notna(s)})
        out = [("optimum", None, None, None, found.optimum, found.optimum)]
        out += [("node", tree.names[i], None, "|".join(found.states[s] for s in np.flatnonzero(a)), None, None) for i, a in found.allowed.items()]
        for kind, directed in (("change", True), ("exchange", False)):
            out += [(kind, None, a, b, lo, hi) for (a, b), (lo, hi) in found.ranges(directed).items()]
        one = found.history(seed)
        out += [("history", tree.names[i], one[tree.names[tree.parent[i]]], one[tree.names[i]], None, None) for i in range(1, len(tree.names)) if one]
        frame = pd.DataFrame(out, columns=["kind", "node", "source", "target", "least", "most"])
        frame.insert(0, "tree", rows["tree"].iloc[0])
        return frame.astype({"least": "Int64", "most": "Int64"})

    return joined.groupBy("tree").applyInPandas(run, f"tree {dict(nodes.dtypes)['tree']}, kind string, node string, source string, target string, least bigint, most bigint")


def jumps(nodes: DataFrame) -> DataFrame:
    """(tree, node, k, ancestor, distance): the ancestor 2**k steps up from each node that has one, and how far it is.

    Each round joins the table with itself one level down: n log2(depth) rows in all, whatever the shape of the tree.
    """
    step = checkpointed(nodes.where("parent is not null").select("tree", "node", F.lit(0).alias("k"), F.col("parent").alias("ancestor"), F.coalesce("length", F.lit(0.0)).alias("distance")))
    every, k, total = [], 0, None
    while step.limit(1).count():
        total = nodes.count() if total is None else total
        if 1 << k > total:
            raise ValueError("the parents of some nodes form a loop")
        every.append(step)
        above = step.select("tree", F.col("node").alias("ancestor"), F.col("ancestor").alias("further"), F.col("distance").alias("more"))
        k += 1
        step = checkpointed(step.join(above, ["tree", "ancestor"]).select("tree", "node", F.lit(k).alias("k"), F.col("further").alias("ancestor"), (F.col("distance") + F.col("more")).alias("distance")))
    return reduce(DataFrame.unionByName, every) if every else step


def tip_distances(nodes: DataFrame, pairs: DataFrame) -> DataFrame:
    """``pairs`` (tree, a, b, ...) with their lowest common ``ancestor`` and the ``distance`` between them along the tree.

    Both ends are lifted by powers of two, as many joins as a path has binary digits, twice.
    """
    up = jumps(nodes)
    levels = [r["k"] for r in up.groupBy("k").count().orderBy("k").collect()]  # one row for each power of two
    # Depths come from the same table: every node's steps to the root, highest power first.
    at = nodes.select("tree", "node", F.col("node").alias("_at"), F.lit(0).cast("bigint").alias("_depth"), F.lit(0.0).alias("_far"))
    level = {k: up.where(F.col("k") == k).select(F.col("tree").alias("_tree"), F.col("node").alias("_node"), F.col("ancestor").alias("_up"), F.col("distance").alias("_more")) for k in levels}
    for k in reversed(levels):
        at = at.join(level[k], (F.col("tree") == F.col("_tree")) & (F.col("_at") == F.col("_node")), "left").select("tree", "node", F.coalesce("_up", "_at").alias("_at"), (F.col("_depth") + F.when(F.col("_up").isNotNull(), 1 << k).otherwise(0)).alias("_depth"), (F.col("_far") + F.coalesce("_more", F.lit(0.0))).alias("_far"))
    known = checkpointed(at.select("tree", "node", F.col("_depth").alias("depth"), F.col("_far").alias("far")))
    side = lambda end: known.select("tree", *(F.col(c).alias(f"_{end}{c}") for c in ("node", "depth", "far")))
    rows = pairs.join(side("a").withColumnRenamed("_anode", "a"), ["tree", "a"]).join(side("b").withColumnRenamed("_bnode", "b"), ["tree", "b"])
    deeper = F.col("_adepth") >= F.col("_bdepth")
    rows = rows.withColumn("_x", F.when(deeper, F.col("a")).otherwise(F.col("b"))).withColumn("_y", F.when(deeper, F.col("b")).otherwise(F.col("a"))).withColumn("_gap", F.abs(F.col("_adepth") - F.col("_bdepth")))

    def lifted(rows: DataFrame, end: str, k: int) -> DataFrame:
        own = level[k].select(F.col("_tree").alias("tree"), F.col("_node").alias(end), F.col("_up").alias(f"{end}_up"))
        return rows.join(own, ["tree", end], "left")

    for k in levels:
        rows = lifted(rows, "_x", k)
        rows = rows.withColumn("_x", F.when(F.col("_gap").bitwiseAND(1 << k) > 0, F.col("_x_up")).otherwise(F.col("_x"))).drop("_x_up")
    rows = checkpointed(rows)
    for k in reversed(levels):
        rows = lifted(lifted(rows, "_x", k), "_y", k)
        apart = (F.col("_x") != F.col("_y")) & F.coalesce(F.col("_x_up") != F.col("_y_up"), F.lit(False))
        rows = rows.withColumn("_x", F.when(apart, F.col("_x_up")).otherwise(F.col("_x"))).withColumn("_y", F.when(apart, F.col("_y_up")).otherwise(F.col("_y"))).drop("_x_up", "_y_up")
    if levels:
        rows = lifted(rows, "_x", 0).withColumn("_x", F.when(F.col("_x") != F.col("_y"), F.col("_x_up")).otherwise(F.col("_x"))).drop("_x_up")
    top = known.select("tree", F.col("node").alias("_x"), F.col("far").alias("_top"))
    out = rows.join(top, ["tree", "_x"])
    return out.select(*pairs.columns, F.col("_x").alias("ancestor"), (F.col("_afar") + F.col("_bfar") - 2 * F.col("_top")).alias("distance"))


def rolling_folds(nodes: DataFrame, dates: DataFrame, folds: int) -> DataFrame:
    """(tree, fold, year, train, test, status, slope, model_mae, mean_mae, last_mae): held-out errors of dates.

    Fold i holds out the i-th latest calendar year of a tree and learns from
    the years before it alone: the best root is searched anew, and held-out
    tips are dated by their distance from it.  Baselines are the mean and the
    latest date learned from.  ``dates`` are (tree, node, year as a number
    with fraction); each fold of each tree is a task of its own.
    """
    years = dates.select("tree", F.floor("year").alias("y")).distinct()
    latest = years.withColumn("fold", F.row_number().over(Window.partitionBy("tree").orderBy(F.desc("y")))).where(F.col("fold") <= folds)
    joined = nodes.select("tree", "node", "parent", "length").join(dates.select("tree", "node", "year"), ["tree", "node"], "left").join(latest, "tree")

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        fold, year = int(rows["fold"].iloc[0]), int(rows["y"].iloc[0])
        tree = Tree(list(rows[["node", "parent", "length"]].itertuples(index=False, name=None)))
        known = {n: t for n, t in rows[["node", "year"]].itertuples(index=False, name=None) if pd.notna(t)}
        train, test = {n: t for n, t in known.items() if t < year}, {n: t for n, t in known.items() if year <= t < year + 1}
        got = clock_root(tree, train)
        out = {"status": got["status"] if got["status"] != "rooted" else "fitted", "slope": None, "model_mae": None, "mean_mae": None, "last_mae": None}
        if train and test:
            out["mean_mae"] = float(np.mean([abs(t - np.mean(list(train.values()))) for t in test.values()]))
            out["last_mae"] = float(np.mean([abs(t - max(train.values())) for t in test.values()]))
        if got["status"] == "rooted":
            far = root_distances(best_rooted(tree, got))
            x, y = np.array(list(train.values())), np.array([far[n] for n in train])
            slope = got["slope"]
            out["slope"] = slope
            if slope > 0:
                intercept = y.mean() - slope * x.mean()
                out["model_mae"] = float(np.mean([abs((far[n] - intercept) / slope - t) for n, t in test.items()])) if test else None
            else:
                out["status"] = "no_positive_rate"
        row = (rows["tree"].iloc[0], fold, year, len(train), len(test), out["status"], out["slope"], out["model_mae"], out["mean_mae"], out["last_mae"])
        return pd.DataFrame([row], columns=["tree", "fold", "year", "train", "test", "status", "slope", "model_mae", "mean_mae", "last_mae"])

    return joined.groupBy("tree", "fold").applyInPandas(run, f"tree {dict(nodes.dtypes)['tree']}, fold int, year int, train int, test int, status string, slope double, model_mae double, mean_mae double, last_mae double")


def best_rooted(tree: Tree, got: dict) -> Tree:
    """The tree with the root that ``clock_root`` found; on the joined edge of a root with two children its place is told from the other child."""
    child, at = got["child"], got["from_parent"]
    if tree.parent[child] == 0 and len(tree.children[0]) == 2:
        other = next(c for c in tree.children[0] if c != child)
        if at < tree.length[other]:
            child, at = other, tree.length[other] - at
        else:
            at -= tree.length[other]
    return Tree(rerooted(tree, child, at))


def root_distances(tree: Tree) -> dict[str, float]:
    """Each node's distance from the root."""
    far = np.zeros(len(tree.names))
    for i in range(1, len(tree.names)):
        far[i] = far[tree.parent[i]] + tree.length[i]
    return dict(zip(tree.names, far.tolist(), strict=True))


# Networks ------------------------------------------------------------------------------------------------


def branch_states(nodes: DataFrame, found: DataFrame, threshold: float, tie: float = 1e-10) -> DataFrame:
    """The states at both ends of each branch with their confidence; ``found`` are (node, state, probability).

    A node's state is its most probable one; others within ``tie`` of it make it tied.
    """
    best = found.groupBy("node").agg(F.max(F.struct("probability", F.col("state").alias("s"))).alias("m"))
    near = found.join(best, "node").where(F.col("probability") >= F.col("m.probability") - tie).groupBy("node").agg(F.min("state").alias("state"), F.max("m.probability").alias("confidence"), (F.count("*") > 1).alias("tied"))
    child = nodes.where("parent is not null").select("node", "parent").join(near, "node")
    ends = near.select(F.col("node").alias("parent"), F.col("state").alias("parent_state"), F.col("confidence").alias("parent_confidence"), F.col("tied").alias("parent_tied"))
    out = child.join(ends, "parent")
    sure = ~F.col("tied") & ~F.col("parent_tied") & (F.col("confidence") >= threshold) & (F.col("parent_confidence") >= threshold)
    return out.select("parent", "node", "parent_state", "state", "parent_confidence", "confidence", (F.col("state") != F.col("parent_state")).alias("changed"), sure.alias("sure"))


def change_edges(branches: DataFrame) -> DataFrame:
    """(source, target, branches, sure_branches, uncertain_branches) of the changing branches."""
    return branches.where("changed").groupBy(F.col("parent_state").alias("source"), F.col("state").alias("target")).agg(F.count("*").alias("branches"), F.count_if("sure").alias("sure_branches"), F.count_if(~F.col("sure")).alias("uncertain_branches"))


def degrees(edges: DataFrame) -> DataFrame:
    """In-, out- and total degree and weight of each node of (source, target, n), and the share of outgoing links."""
    out = edges.groupBy(F.col("source").alias("node")).agg(F.count_distinct("target").alias("out_degree"), F.sum("n").alias("out_weight"))
    into = edges.groupBy(F.col("target").alias("node")).agg(F.count_distinct("source").alias("in_degree"), F.sum("n").alias("in_weight"))
    zero = F.lit(0)
    both = out.join(into, "node", "full_outer").select("node", *(F.coalesce(c, zero).alias(c) for c in ("in_degree", "out_degree", "in_weight", "out_weight")))
    return both.withColumn("degree", F.col("in_degree") + F.col("out_degree")).withColumn("source_share", F.col("out_degree") / F.col("degree"))


def levels(adjacent: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Steps from each node (row) to each other (column), -1 where there is no way, and the number of shortest ways."""
    n = len(adjacent)
    depth, ways = np.where(np.eye(n, dtype=bool), 0, -1), np.eye(n)
    step = adjacent.astype(float)
    at = 0
    while (depth == at).any():
        found = np.where(depth == at, ways, 0.0) @ step
        new = (found > 0) & (depth < 0)
        at += 1
        depth[new], ways[new] = at, found[new]
    return depth, ways


def centrality(edges: DataFrame) -> DataFrame:
    """(node, betweenness, closeness): directed unnormalised betweenness, and 1 / sum of undirected distances (null for a lone node).

    The network of states is small (states, not samples); it is handled in one
    task, all sources together: a level outwards is one product of matrices,
    and so is a level back, which hands shares of ways to the level before.
    """

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        names, codes = np.unique(rows[["source", "target"]].to_numpy(str), return_inverse=True)
        source, target = codes.reshape(-1, 2).T
        adjacent = np.zeros((len(names), len(names)), bool)
        adjacent[source, target] = True
        np.fill_diagonal(adjacent, False)
        depth, ways = levels(adjacent)
        share = np.zeros(ways.shape)
        for at in range(depth.max(), 0, -1):
            beyond = np.where(depth == at, (1 + share) / np.maximum(ways, 1), 0.0)
            share += np.where(depth == at - 1, ways * (beyond @ adjacent.T.astype(float)), 0.0)
        np.fill_diagonal(share, 0.0)
        total = np.maximum(levels(adjacent | adjacent.T)[0], 0).sum(axis=1)
        return pd.DataFrame({"node": names, "betweenness": share.sum(axis=0), "closeness": [1 / t if t else None for t in total.tolist()]})

    return edges.withColumn("k", F.lit(1)).groupBy("k").applyInPandas(run, "node string, betweenness double, closeness double")


def ego(edges: DataFrame, wanted: Column) -> DataFrame:
    """Edges that touch a wanted state, without loops and empty ones."""
    return edges.where((F.col("source") != F.col("target")) & (F.col("n") > 0)).where(wanted)
