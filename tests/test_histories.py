"""Best histories against all histories, distances by jumps, and rolling folds."""

import itertools
import random
import resource

import numpy as np
import pytest

from strainframe.operators import trees as T


def random_tree(rng, tips, most=3):
    """A tree with up to ``most`` children a node."""
    nodes = [(f"t{i}", None, rng.random()) for i in range(tips)]
    rows, made = [], 0
    while len(nodes) > 1:
        part = [nodes.pop(rng.randrange(len(nodes))) for _ in range(min(len(nodes), rng.randint(2, most)))]
        made += 1
        rows += [(n, f"i{made}", length) for n, _, length in part]
        nodes.append((f"i{made}", None, rng.random()))
    return T.Tree(rows + [(nodes[0][0], None, 0.0)])


def every_history(tree, observed):
    """All assignments of states with fewest changes."""
    states = sorted(set(observed.values()))
    options = [[observed[n]] if n in observed and not tree.children[i] else states for i, n in enumerate(tree.names)]
    scored = []
    for chosen in itertools.product(*options):
        scored.append((sum(chosen[i] != chosen[tree.parent[i]] for i in range(1, len(chosen))), chosen))
    best = min(s for s, _ in scored)
    return best, [c for s, c in scored if s == best]


@pytest.mark.parametrize("seed", range(8))
def test_histories_against_enumeration(seed):
    rng = random.Random(seed)
    tree = random_tree(rng, rng.randint(2, 6))
    observed = {n: rng.choice("abc") for i, n in enumerate(tree.names) if not tree.children[i] and rng.random() < 0.8}
    if not observed:
        observed = {"t0": "a"}
    best, all_ = every_history(tree, observed)
    found = T.Histories(tree, observed)
    assert found.optimum == best
    for i, name in enumerate(tree.names):
        assert {found.states[s] for s in np.flatnonzero(found.allowed[i])} == {h[i] for h in all_}, name
    for directed in (True, False):
        want = {}
        for h in all_:
            n = {}
            for i in range(1, len(h)):
                a, b = h[tree.parent[i]], h[i]
                if a != b:
                    key = (a, b) if directed else tuple(sorted((a, b)))
                    n[key] = n.get(key, 0) + 1
            for key in itertools.permutations(found.states, 2):
                want.setdefault(key, []).append(n.get(key, 0))
        got = found.ranges(directed)
        assert got == {k: (min(v), max(v)) for k, v in want.items() if max(v) > 0}
    for s in range(4):
        one = found.history(s)
        assert tuple(one[n] for n in tree.names) in all_ and one == T.Histories(tree, observed).history(s)
    pairs, unsure, branches = found.possible()
    edges = [{(h[tree.parent[i]], h[i]) for h in all_} for i in range(1, len(tree.names))]
    assert pairs == {tuple(sorted(p)) for e in edges for p in e if p[0] != p[1]}
    assert unsure == {tuple(sorted(p)) for e in edges if len(e) > 1 for p in e if p[0] != p[1]} and branches == sum(len(e) > 1 for e in edges)


@pytest.mark.parametrize("shape", ["comb", "comb_back", "cherries"])
def test_ranges_of_large_trees_need_little_memory(shape):
    n, rng = 3000, random.Random(2)
    if shape == "cherries":
        rows = [("r", None, 0.0)] + [(f"c{i}", "r", 1.0) for i in range(n // 2)] + [(f"t{i}", f"c{i // 2}", 1.0) for i in range(n)]
    else:
        pairs = [[(f"t{i}", f"n{i}", 1.0), (f"n{i + 1}", f"n{i}", 1.0)] for i in range(n - 1)]
        rows = [("n0", None, 0.0)] + [x for p in pairs for x in (p if shape == "comb" else p[::-1])] + [(f"t{n}", f"n{n - 1}", 1.0)]
    tree = T.Tree(rows)
    found = T.Histories(tree, {f"t{i}": f"s{rng.randrange(30)}" for i in range(n)})
    before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
    ranges = found.ranges()
    assert len(ranges) > 30 and resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before < 400_000


def test_distances_by_jumps(spark):
    rng = random.Random(4)
    rows, want, pairs = [], {}, []
    for k in range(2):
        tree = random_tree(rng, 25, most=2 + k)
        rows += [(f"x{k}", tree.names[i], tree.names[tree.parent[i]] if i else None, tree.length[i] if i else None) for i in range(len(tree.names))]
        far = T.root_distances(tree)
        up = {n: [] for n in tree.names}
        for i, n in enumerate(tree.names):
            up[n] = [n] + (up[tree.names[tree.parent[i]]] if i else [])
        for a, b in [(rng.choice(tree.names), rng.choice(tree.names)) for _ in range(40)] + [("t0", "t0"), (tree.names[0], "t3")]:
            top = next(x for x in up[a] if x in up[b])
            pairs.append((f"x{k}", a, b))
            want[f"x{k}", a, b] = (top, far[a] + far[b] - 2 * far[top])
    nodes = spark.createDataFrame(rows, "tree string, node string, parent string, length double")
    got = T.tip_distances(nodes, spark.createDataFrame(sorted(set(pairs)), "tree string, a string, b string")).collect()
    assert len(got) == len(set(pairs))
    for r in got:
        top, distance = want[r.tree, r.a, r.b]
        assert r.ancestor == top and abs(r.distance - distance) < 1e-9
    loop = spark.createDataFrame([("x", "a", "b", 1.0), ("x", "b", "a", 1.0)], "tree string, node string, parent string, length double")
    with pytest.raises(ValueError, match="loop"):
        T.jumps(loop)


def test_rolling_folds(spark):
    # A clock of one change a year: a tip's distance from the root is its date, so held-out dates are found exactly.
    dates = {f"t{i}": 2000 + i * 0.75 for i in range(10)}
    rows = [("k", "r", None, None)]
    for i, (n, t) in enumerate(dates.items()):
        rows += [("k", f"m{i}", "r" if i < 2 else f"m{i - 2}", 0.2), ("k", n, f"m{i}", t - 1990 - 0.2 * (i // 2 + 1))]
    nodes = spark.createDataFrame(rows, "tree string, node string, parent string, length double")
    known = spark.createDataFrame([("k", n, t) for n, t in dates.items()], "tree string, node string, year double")
    got = sorted(T.rolling_folds(nodes, known, 3).collect(), key=lambda r: r.fold)
    assert [(r.fold, r.year, r.train, r.test, r.status) for r in got] == [(1, 2006, 8, 2, "fitted"), (2, 2005, 7, 1, "fitted"), (3, 2004, 6, 1, "fitted")]
    for r in got:
        train, test = [t for t in dates.values() if t < r.year], [t for t in dates.values() if r.year <= t < r.year + 1]
        assert abs(r.slope - 1) < 1e-6 and r.model_mae < 1e-6
        assert abs(r.last_mae - np.mean([abs(t - max(train)) for t in test])) < 1e-9 and abs(r.mean_mae - np.mean([abs(t - np.mean(train)) for t in test])) < 1e-9
    few = T.rolling_folds(nodes, known.where("year < 2002"), 2).collect()
    assert {r.status for r in few} == {"skipped"} and all(r.model_mae is None for r in few)
