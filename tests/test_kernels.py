"""Clustering, ordination, trees, rooting and parsimony against brute force."""

import itertools
import random

import numpy as np
import pytest

from strainframe.operators import cohorts as C
from strainframe.operators import pairs as P
from strainframe.operators import selection as L
from strainframe.operators import trees as T
from strainframe.sources import newick


def tree_of(text):
    return T.Tree(newick.parse(text))


def test_complete_linkage_does_not_chain():
    m = np.array([[0, 1, 2], [1, 0, 1], [2, 1, 0]], float) / 4
    assert C.complete_linkage(m, 0.25) == [[0, 1], [2]]
    assert C.complete_linkage(m, 0.5) == [[0, 1, 2]]
    m[0, 1] = m[1, 0] = np.nan
    assert C.complete_linkage(m, 0.25) == [[0], [1, 2]]


def test_ordination_and_its_leading_axes_agree():
    rng = np.random.default_rng(17)
    x = rng.integers(0, 4, (35, 30))
    m = (x[:, None, :] != x[None, :, :]).mean(axis=2)
    full = C.ordination(m)[0]
    assert np.allclose(np.abs(full.T @ full), np.abs(C.leading_ordination(m).T @ C.leading_ordination(m)), atol=1e-6)
    flat = rng.normal(size=(12, 2))
    d = np.sqrt(((flat[:, None] - flat[None]) ** 2).sum(axis=2))
    xy, share, negative = C.ordination(d)
    assert np.allclose(np.sqrt(((xy[:, None] - xy[None]) ** 2).sum(axis=2)), d) and abs(share.sum() - 1) < 1e-9 and not negative


def test_neighbour_joining_reproduces_additive_distances():
    rng = random.Random(3)
    for n in (2, 3, 4, 9):
        rows = [("root", None, 0.0)]
        open_ = ["root"]
        for i in range(2 * n):
            rows.append((f"k{i}", rng.choice(open_), rng.uniform(0.1, 2)))
            open_.append(f"k{i}")
        parents = {p for _, p, _ in rows}
        tips = sorted(r[0] for r in rows if r[0] not in parents)[:n]
        if len(tips) < 2:
            continue
        want = C.path_distances(rows, tips)
        assert np.allclose(C.path_distances(C.neighbour_joining(tips, want), tips), want)


def grid(tree, years, steps=400):
    best = np.inf
    for child in range(1, len(tree.names)):
        if tree.length[child] < 0:
            continue
        for x in np.linspace(0, tree.length[child], steps):
            rows = T.rerooted(tree, child, x)
            up = {n: (p, d) for n, p, d in rows}
            t, y = [], []
            for tip, year in years.items():
                node, total = tip, 0.0
                while node is not None:
                    node, d = up[node][0], up[node][1]
                    total += d
                t.append(year)
                y.append(total)
            t, y = np.array(t), np.array(y)
            slope, at = np.polyfit(t - t.mean(), y, 1)
            best = min(best, ((y - at - slope * (t - t.mean())) ** 2).mean())
    return best


@pytest.mark.parametrize("text", ["(a:0.2,b:0.5,(c:1,d:0.7):0.8,e:0.3);", "((a:1,b:2):0.5,(c:1.5,(d:0.2,e:2.5):0.6):0.4);", "(a:0.2,b:0.5,(c:1,d:0.7):-0.1,e:0.3);"])
def test_clock_root_beats_a_grid(text):
    tree = tree_of(text)
    years = {"a": 2000.0, "b": 2003.5, "c": 2001.2, "d": 2007.0, "e": 2004.4}
    got = T.clock_root(tree, years)
    assert got["status"] == "rooted" and tree.length[got["child"]] >= 0 or text.count("(") > 2
    assert got["mse"] <= grid(tree, years) + 1e-9
    few = T.clock_root(tree, {"a": 2000.0, "b": 2000.0, "c": 2001.0})
    assert few["reason"] == "fewer_than_three_distinct_dates"


def enumerate_histories(tree, observed):
    states = sorted(set(observed.values()))
    n, best, ranges = len(tree.names), None, {}
    free = [i for i in range(n) if tree.children[i] or tree.names[i] not in observed]
    for choice in itertools.product(states, repeat=len(free)):
        at = {i: observed.get(tree.names[i]) for i in range(n)} | dict(zip(free, choice))
        changes = {}
        for i in range(1, n):
            a, b = at[tree.parent[i]], at[i]
            if a != b:
                changes[a, b] = changes.get((a, b), 0) + 1
        total = sum(changes.values())
        if best is None or total < best:
            best, found = total, []
        if total == best:
            found.append(changes)
    for pair in itertools.permutations(states, 2):
        counts = [f.get(pair, 0) for f in found]
        if max(counts):
            ranges[pair] = (min(counts), max(counts))
    return best, ranges


@pytest.mark.parametrize("text, states", [("((a,b),(c,d));", "ABCA"), ("(a,b,c,d);", "ABC?"), ("((a,b),c);", "AAB"), ("((a,b),c);", "A?A"), ("((a,b),((c,d),(e,f)));", "ABBACA")])
def test_parsimony_equals_enumeration(text, states):
    tree = tree_of(text)
    observed = {n: s for n, s in zip("abcdef", states) if s != "?"}
    top, allowed, ranges = T.parsimony(tree, observed)
    assert (top, ranges) == enumerate_histories(tree, observed)
    assert all(allowed[n] == [s] for n, s in observed.items())


def test_pruning_and_rerooting_keep_distances():
    tree = tree_of("((a:1,b:2)x:0.5,(c:1.5,(d:0.2,e:2.5)y:0.6)z:0.4);")
    tips = list("abcde")
    want = C.path_distances(tree.rows(), tips)
    for child in range(1, len(tree.names)):
        assert np.allclose(C.path_distances(T.rerooted(tree, child, tree.length[child] / 3), tips), want)
    kept = T.pruned(tree, set("ade"))
    assert np.allclose(C.path_distances(kept, list("ade")), want[np.ix_([0, 3, 4], [0, 3, 4])])
    assert len(kept) == 5


def test_selection_does_not_depend_on_order(spark):
    pool = spark.createDataFrame([(i,) for i in range(12)], "sample_id long")
    pairs = spark.createDataFrame([(i, j, float((i * 7 + j * 3) % 10)) for j in range(12) for i in range(j)], "a long, b long, distance double")
    first = L.diverse(pool, pool.where("sample_id = 0"), pairs, 4, 73, runs=5)
    again = L.diverse(pool.orderBy("sample_id", ascending=False), pool.where("sample_id = 0"), pairs.orderBy("b", ascending=False), 4, 73, runs=5)
    rows = lambda df: sorted(map(tuple, df.collect()))
    assert rows(first) == rows(again) and len(rows(first)) == 20


def edges(spark, rows):
    return spark.createDataFrame(rows, "node string, parent string, length double")


def test_rooted_topologies_differ_by_their_root(spark):
    from strainframe.operators import trees as T

    # (((a,b),c),d) and ((a,b),(c,d)): one unrooted tree, two roots.
    one = edges(spark, [("r", None, None), ("x", "r", 1.0), ("d", "r", 1.0), ("y", "x", 1.0), ("c", "x", 1.0), ("a", "y", 1.0), ("b", "y", 1.0)])
    two = edges(spark, [("R", None, None), ("p", "R", 1.0), ("q", "R", 1.0), ("a", "p", 1.0), ("b", "p", 1.0), ("c", "q", 1.0), ("d", "q", 1.0)])
    assert tuple(T.same_topology(one, two).first()) == (1, 1, 2)
    again = edges(spark, [("m", None, None), ("d", "m", 2.0), ("n", "m", 2.0), ("c", "n", 2.0), ("o", "n", 2.0), ("b", "o", 2.0), ("a", "o", 2.0)])
    assert tuple(T.same_topology(one, again).first()) == (0, 0, 3)


def test_distances_of_a_deep_tree(spark):
    """A chain deeper than 2**14 nodes is followed to its end, and a loop is an error."""
    from strainframe.operators import trees as T

    n = 17_000
    chain = spark.range(n).selectExpr("concat('n', id) node", "if(id = 0, null, concat('n', id - 1)) parent", "1.0D length")
    far = {r.node: (r.depth, r.distance) for r in T.root_to_tip(chain).where("node in ('n0', 'n9', 'n16999')").collect()}
    assert far == {"n0": (0, 0.0), "n9": (9, 9.0), "n16999": (n - 1, n - 1.0)}
    with pytest.raises(ValueError):
        T.root_to_tip(edges(spark, [("a", "b", 1.0), ("b", "a", 1.0), ("r", None, None)]))


def test_linkage_equals_plain_merging():
    rng = np.random.default_rng(4)
    for n in range(1, 14):
        m = np.triu(rng.integers(0, 6, (n, n)) / 5, 1)
        m[rng.random((n, n)) < 0.1] = np.nan
        m = np.triu(m, 1) + np.triu(m, 1).T
        for threshold in (0.0, 0.4, 1.0):
            groups = [[i] for i in range(n)]
            while True:
                far = [(max(np.inf if np.isnan(m[x, y]) else m[x, y] for x in a for y in b), i, j) for i, a in enumerate(groups) for j, b in enumerate(groups) if i < j]
                if not far or min(far)[0] > threshold:
                    break
                _, i, j = min(far)
                groups[i] = sorted(groups[i] + groups.pop(j))
            assert C.complete_linkage(m, threshold) == sorted(groups)


def test_cohorts_hold_comparable_pairs_only_and_first_fit(spark):
    rng = np.random.default_rng(8)
    scope = {i: "xyz"[i % 3] for i in range(40)}
    linked = sorted({(i, j) for i in range(40) for j in range(i + 1, 40) if scope[i] == scope[j] and rng.random() < 0.7})
    cohorts: list[list[int]] = []
    for s in range(40):
        home = next((k for k in cohorts if all((m, s) in linked for m in k)), None)
        cohorts.append([s]) if home is None else home.append(s)
    want = {(k[0], a, b) for k in cohorts for a in k for b in k if a < b}
    profiles = spark.createDataFrame([(i, "sp", x, "loci") for i, x in scope.items()], "sample_id long, species_key string, scope string, loci_key string")
    pairs = spark.createDataFrame([(a, b, 0.5) for a, b in linked], "a long, b long, distance double")
    got = P.cohort_pairs(profiles, pairs).collect()
    assert {(r.group, r.a, r.b) for r in got} == want and len(got) == len(want)
    flat = {r.sample_id: r.cohort for r in P.greedy_cohorts(profiles.select("sample_id"), pairs).collect()}
    assert flat == {m: i for i, k in enumerate(cohorts, 1) for m in k}
    assert P.cohort_pairs(profiles, pairs.limit(0)).collect() == []


def test_bootstrap_of_each_cohort(spark):
    rows = [(g, 10 * g + i, f"l{k}", str(i // 2)) for g in (1, 2) for i in range(4) for k in range(5)]
    calls = spark.createDataFrame(rows, "group long, sample_id long, locus string, allele string")
    groups = spark.createDataFrame([(g, 10 * g + i, 10 * g + i // 2 * 2) for g in (1, 2) for i in range(4)], "group long, sample_id long, cluster long")
    got = C.bootstrap_support(groups, C.bootstrap(calls, 0.2, 0.5, 6)).collect()
    assert sorted(tuple(r) for r in got) == [(g, 10 * g + k, 2, 6, 1.0) for g in (1, 2) for k in (0, 2)]
    none = C.bootstrap_support(groups, C.bootstrap(calls.where("not (locus != 'l1' and sample_id = 11)"), 0.2, 0.9, 6)).collect()
    assert {(r.group, r.valid, r.support) for r in none} == {(1, 0, None), (2, 6, 1.0)}


def test_centrality_counts_shortest_ways(spark):
    edges = [("a", "b"), ("a", "c"), ("b", "d"), ("c", "d"), ("d", "e"), ("e", "e"), ("f", "f")]
    got = {r.node: (r.betweenness, r.closeness) for r in T.centrality(spark.createDataFrame(edges, "source string, target string")).collect()}
    assert got["b"][0] == got["c"][0] == 1.0 and got["d"][0] == 3.0 and got["a"][0] == got["e"][0] == 0.0
    assert got["d"][1] == 1 / 5 and got["a"][1] == 1 / 7 and got["f"] == (0.0, None)
