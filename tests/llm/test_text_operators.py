"""Text operators against brute force, on small tables with awkward rows."""

import random
import re
from collections import Counter, defaultdict
from math import log10

import numpy as np
import pyarrow as pa
import pytest

from strainframe.llm import jaccard, katz, langid, packing, quality, substrings, units

SCHEMA = "doc_id long, text string, lang string, chunk string, score double"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def awkward(seed=1, n=60, words=40):
    """Nulls in every column, empty and long texts, repeats, near copies, odd white space."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(300)] + ["É", "a b", "x\x1cy"]
    rows = []
    for i in range(n):
        text = " ".join(rng.choice(vocabulary) for _ in range(rng.randint(1, words)))
        rows.append((i, text, "l", "c", None))
    base = [rng.choice(vocabulary) for _ in range(120)]
    for j in range(20):
        near = list(base)
        for _ in range(j % 3):
            near[rng.randrange(120)] = f"new{rng.randrange(10**6)}"
        rows.append((200 + j, " ".join(near), None, None, 1.0))
    rows += [(300, None, None, None, None), (301, "", "", "", 0.0), (302, " \t\n", "l", "c", 0.0), (303, "Lone", "l", "c", 0.0), (304, "lone", "l", "c", 0.0)]
    rows += [(305, "  many\t\tspaces\x0bhere \n", None, "c", 0.0), rows[0], (None, rows[1][1], None, None, None), (306, " ".join(vocabulary * 20), "l", "c", 0.0)]
    return rows


@pytest.fixture(scope="module")
def table(spark):
    rows = awkward()
    return rows, spark.createDataFrame(rows, SCHEMA).repartition(5)


def words_of(text, lower=False):
    text = text or ""
    if lower:
        text = re.sub("[A-Z]", lambda m: m[0].lower(), text)
    return WORD.findall(text)


def test_words_and_hashes_agree():
    texts = ["a b", "", None, "  x\n", "b a", "long" * 40 + " a"]
    w = units.words(pa.array(texts))
    got = [[w.distinct[c].as_py().decode() for c in w.codes[a:b]] for a, b in zip(w.first[:-1], w.first[1:])]
    assert got == [words_of(t) for t in texts]
    h, first = units.word_hashes(pa.array(texts))
    assert first.tolist() == w.first.tolist()
    assert len(set(h.tolist())) == len({x for t in texts for x in words_of(t)})


def test_substrings(table):
    rows, df = table
    window = 7
    lists = [(r[0], words_of(r[1])) for r in rows]
    seen = Counter(tuple(w[i : i + window]) for _, w in lists for i in range(len(w) - window + 1))
    want = []
    for key, w in lists:
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            if seen[tuple(w[i : i + window])] > 1:
                gone[i : i + window] = [True] * window
        want.append((key, " ".join(x for x, g in zip(w, gone) if not g), len(w), sum(gone)))
    got = substrings.without_repeats(df, "doc_id", "text", window=window, first=3, carry=["chunk", "score"])
    assert set(got.columns) == {"doc_id", "text", "n_words", "n_removed", "chunk", "score"}
    assert sorted(map(str, want)) == sorted(str((r.doc_id, r.text, r.n_words, r.n_removed)) for r in got.collect())


def test_substrings_keep_clean_texts(spark):
    df = spark.createDataFrame([(1, "a  b\nc"), (2, "k l m n"), (3, "k l m n")], "doc_id long, text string")
    got = {r.doc_id: r.text for r in substrings.without_repeats(df, "doc_id", "text", window=3, first=2, keep_clean=True).collect()}
    assert got == {1: "a  b\nc", 2: "", 3: ""}


def components_by_hand(rows, n, least):
    sets = defaultdict(set)
    for key, text in rows:
        w = words_of(text, lower=True)
        sets[key] |= {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set())
    keys = sorted(k for k in sets if k is not None)
    parent = {k: k for k in keys}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(keys):
        for b in keys[:i]:
            both = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * both >= least * (len(sets[a]) + len(sets[b]) - both):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {k: (len(sets[k]), find(k)) for k in keys}


def test_jaccard(table):
    rows, df = table
    want = components_by_hand([(r[0], r[1]) for r in rows], 4, 85)
    got = jaccard.similar_components(df, "doc_id", "text", words=4, least=85).collect()
    assert len(got) == len(rows)
    for r in got:
        if r.doc_id is None:
            assert r.component_id == want[1][1]
        else:
            assert (r.n_shingles, r.component_id) == want[r.doc_id], r


def test_jaccard_regions_and_rounds(spark, monkeypatch):
    """Chains of copies whose ends do not link, in regions that must split and be joined in rounds."""
    monkeypatch.setattr(jaccard, "REGION", 12)
    monkeypatch.setattr(jaccard, "LEAF", 3)
    rng = random.Random(4)
    rows = []
    for family in range(3):
        text = [f"f{family}w{i}" for i in range(60)]
        for j in range(40):
            text = list(text)
            text[rng.randrange(60)] = f"n{family}-{j}"
            rows.append((family * 100 + j, " ".join(text)))
    want = components_by_hand(rows, 3, 85)
    got = jaccard.similar_components(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), "doc_id", "text", words=3, least=85).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want


def test_voronoi_windows_lose_no_close_pair(monkeypatch):
    rng = np.random.default_rng(1)
    rule = jaccard.Rule(4, 85)
    centres = rng.integers(0, 40, (30, jaccard.CLASSES))
    counts = np.clip(centres[rng.integers(0, 30, 900)] + rng.integers(0, 2, (900, jaccard.CLASSES)), 0, 255).astype(np.uint8)
    monkeypatch.setattr(jaccard, "tier_of", lambda n: np.full(len(n), 7))
    block = jaccard.Block(np.arange(900), counts.sum(axis=1), counts.reshape(-1))
    i, j = np.triu_indices(900, 1)
    ok = block.feasible(rule, i, j)
    wanted = set(zip(i[ok].tolist(), j[ok].tolist()))
    kept = set()
    for r in jaccard.regions(block, rule):
        assert len(r) < 900
        p, q = jaccard.direct(r, rule)
        kept |= {tuple(sorted(x)) for x in zip(r.ids[p].tolist(), r.ids[q].tolist())}
    assert wanted == kept


def test_counts_of_long_documents_bound_differences():
    """Documents counted in different numbers of kinds: bounds hold, and parts lose no feasible pair."""
    rng = np.random.default_rng(2)
    rule = jaccard.Rule(4, 80)
    base = rng.integers(0, 2**63, 6000).astype(np.uint64)
    sets = [np.unique(np.concatenate([base[:n], rng.integers(0, 2**63, m).astype(np.uint64)])) for n, m in zip(rng.integers(900, 6000, 150), rng.integers(0, 300, 150))]
    block = jaccard.Block(np.arange(150), np.array([len(x) for x in sets]), np.concatenate([jaccard.sketch(x) for x in sets]))
    i, j = np.triu_indices(150, 1)
    true = np.array([len(np.setxor1d(sets[a], sets[b], assume_unique=True)) for a, b in zip(i, j)])
    assert (block.apart(i, j) <= true).all() and len(np.unique(block.tier)) > 2
    linked = {(a, b) for a, b, d in zip(i.tolist(), j.tolist(), true) if 100 * (block.sizes[a] + block.sizes[b] - d) >= 80 * (block.sizes[a] + block.sizes[b] + d)}
    assert len(linked) > 100
    kept = set()
    for r in jaccard.regions(block, rule):
        for part in jaccard.feasible_parts(r, rule):
            own = sorted(part.ids.tolist())
            kept |= {(a, b) for a in own for b in own if a < b}
    assert linked <= kept


def katz_by_hand(rows, learn, k=5):
    texts = {key: [*words_of(t, lower=True), None] for key, t in rows}
    one, two = Counter(), defaultdict(Counter)
    for key, t in texts.items():
        if learn(key):
            one.update(t)
            for a, b in zip(["start", *[("w", x) for x in t]], t):
                two[a][b] += 1
    total = sum(one.values())

    def good_turing(counts):
        """d(1) to d(k) as the formula says, or absolute discounting where it does not apply."""
        n = [sum(c == r for c in counts) for r in range(1, k + 2)]
        d = []
        if all(n):
            common = (k + 1) * n[k] / n[0]
            d = [((r + 1) * n[r] / (r * n[r - 1]) - common) / (1 - common) for r in range(1, k + 1)] if common != 1 else []
        if not d or not all(0 < x < 1 for x in d):
            off = min(max(n[0] / (n[0] + 2 * n[1]) if n[0] else 0.5, 0.05), 0.95)
            d = [(r - off) / r for r in range(1, k + 1)]
        return d

    d1 = good_turing(list(one.values()))
    left = sum((1 - d1[c - 1]) * c for c in one.values() if c <= k)
    whole = total if left > 0 else total + 1
    p1 = lambda w: (d1[one[w] - 1] if one[w] <= k else 1.0) * one[w] / whole if one[w] else (left or 1.0) / whole
    d = good_turing([c for f in two.values() for c in f.values()])

    def p2(a, w):
        seen = two.get(a)
        if not seen:
            return p1(w)
        size = sum(seen.values()) + (0 if any(c <= k for c in seen.values()) else 1)
        mass = lambda c: (d[c - 1] if c <= k else 1.0) * c / size
        if w in seen:
            return mass(seen[w])
        return (1 - sum(map(mass, seen.values()))) / (1 - sum(map(p1, seen))) * p1(w)

    score = {}
    for key, t in texts.items():
        score[key] = (len(t), sum(one[w] > 0 for w in t), total, sum(log10((one[w] + 1) / (total + len(one) + 1)) for w in t), sum(log10(p2(a, w)) for a, w in zip(["start", *[("w", x) for x in t]], t)))
    return score, p2, one, two


def test_katz(spark):
    rng = random.Random(2)
    vocabulary = [f"v{i}" for i in range(30)]
    rows = [(i, " ".join(rng.choices(vocabulary, weights=range(1, 31), k=rng.randint(0, 40)))) for i in range(80)] + [(900, None), (901, "New words HERE v1"), (902, "same same same same same same same same same")]
    learn = lambda key: key % 4 != 1
    want, p2, one, two = katz_by_hand(rows, learn)
    df = spark.createDataFrame([(k, t, "x") for k, t in rows], "doc_id long, text string, chunk string").repartition(4)
    got = katz.score_texts(df, "doc_id", "text", learn=df["doc_id"] % 4 != 1, chunk_bytes=500).collect()
    assert len(got) == len(rows)
    for r in got:
        assert (r.n_tokens, r.n_known, r.train_tokens) == want[r.doc_id][:3]
        assert abs(r.base_score - want[r.doc_id][3]) < 1e-9
        assert abs(r.score - want[r.doc_id][4]) < 1e-9, r
    # Every context's probabilities, with one class for all unknown words, sum to 1.
    for context in [*two, ("w", "never")]:
        assert abs(sum(p2(context, w) for w in [*one, "an unknown word"]) - 1) < 1e-9


def test_katz_without_training(spark):
    df = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    got = katz.score_texts(df, "doc_id", "text", learn=df["doc_id"] < 0).collect()
    assert {(r.doc_id, r.n_tokens, r.n_known, r.train_tokens, r.score) for r in got} == {(1, 3, 0, 0, 0.0), (2, 1, 0, 0, 0.0)}


def test_counts_beyond_32_bits():
    singles = katz.Singles.of(2**40, 3, np.array([1, 0, 0, 0, 0, 0]))
    p = singles.p(np.array([2**39, 2**33 + 1], np.uint64))
    assert np.allclose(p, [0.5, (2**33 + 1) / 2**40], rtol=1e-12)


def test_jaccard_large_groups(spark, monkeypatch):
    """Shingles of most documents, a hot group of near copies in tiles, copies of copies, and documents without an id."""
    monkeypatch.setattr(jaccard, "REGION", 12)
    monkeypatch.setattr(jaccard, "LEAF", 3)
    monkeypatch.setattr(jaccard, "FREQUENT", 12)
    monkeypatch.setattr(jaccard, "TILE", 16)
    rng = random.Random(9)
    base = [f"b{i}" for i in range(70)]
    other = base[:55] + [f"o{i}" for i in range(15)]
    rows = []
    for j in range(120):
        text = list(base if j % 3 else other)
        for _ in range(rng.randint(0, 6)):
            text[rng.randrange(70)] = f"n{rng.randrange(40)}"
        rows.append((j, " ".join(text)))
    rows += [(200 + j, f"solo{j} " * 3 + " ".join(base[: j % 9])) for j in range(30)]
    rows += [(7, "two texts of one id are one document here"), (300, "two texts of one id are one document here"), (301, None), (302, " ")]
    null = [(None, rows[11][1]), (None, "nobody else has this text at all")]
    df = spark.createDataFrame([*rows, *null, *rows[:5]], "doc_id long, text string").repartition(6)
    for words, least in ((3, 85), (4, 70)):
        want = components_by_text(rows, words, least)
        got = jaccard.similar_components(df, "doc_id", "text", words=words, least=least).collect()
        assert len(got) == len(rows) + 7
        assert {r.doc_id: r.component_id for r in got if r.doc_id is not None} == want
        assert sorted(str(r.component_id) for r in got if r.doc_id is None) == sorted(["None", str(want[11])])


def components_by_text(rows, n, least):
    """As components_by_hand, but each row keeps its own set, and rows of one id are linked."""
    sets, names = [], [r[0] for r in rows]
    for _, text in rows:
        w = words_of(text, lower=True)
        sets.append({tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set()))
    parent = {k: k for k in names}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if a and sets[j] and 100 * both >= least * (len(a) + len(sets[j]) - both):
                x, y = find(names[i]), find(names[j])
                parent[max(x, y)] = min(x, y)
    return {k: find(k) for k in names}


def test_tile_finds_all_links():
    """Differences from any pivot give the links that whole sets give."""
    rng = random.Random(3)
    rule = jaccard.Rule(3, 80)
    for pivot_size in (0, 30):
        sets = []
        for family in range(4):
            base = rng.sample(range(1, 400), 40)
            for _ in range(25):
                x = set(base)
                for _ in range(rng.randint(0, 12)):
                    x.discard(rng.choice(base))
                    x.add(rng.randrange(1, 4000))
                sets.append(np.array(sorted(x), np.uint64))
        pivot = np.array(sorted(set(sets[0].tolist()[:pivot_size])), np.uint64)
        parts = [np.setxor1d(x, pivot) for x in sets]
        n = np.array([len(x) for x in sets])
        w = np.array([rule.weight(len(x), len(p)) for x, p in zip(sets, parts)])
        tile = jaccard.Tile(rule, np.arange(len(sets)), n, w, parts, np.arange(len(sets)), np.ones(len(sets), bool))
        tile.pivots(np.arange(len(sets)))
        tile.join()
        want = {k: v[1] for k, v in components_of_sets([set(x.tolist()) for x in sets], 80).items()}
        got = {}
        for i in range(len(sets)):
            got.setdefault(int(tile.home[i]), []).append(i)
        assert sorted(map(min, got.values())) == sorted(set(want.values()))
        assert all(len({want[i] for i in own}) == 1 for own in got.values())
        links = np.concatenate(tile.found)
        assert len(links) < len(sets)
        for a, b in links:
            both = len(set(sets[a].tolist()) & set(sets[b].tolist()))
            assert 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both)


def components_of_sets(sets, least):
    home = list(range(len(sets)))
    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if home[i] != home[j] and 100 * both >= least * (len(a) + len(sets[j]) - both):
                low, high = sorted((home[i], home[j]))
                home = [low if h == high else h for h in home]
    return {i: (len(sets[i]), h) for i, h in enumerate(home)}


def test_substrings_with_clashing_columns(spark):
    df = spark.createDataFrame([(1, "k l m n", 5, "w"), (2, "z k l m n", 6, None), (None, None, None, None)], "doc_id long, text string, n_words int, chunk string")
    got = {r.doc_id: r for r in substrings.without_repeats(df, "doc_id", "text", window=3, first=2, carry=["n_words", "chunk"], counts=("words_", "removed_")).collect()}
    assert [(got[k].text, got[k].n_words, got[k].chunk, got[k].words_, got[k].removed_) for k in (1, 2, None)] == [("", 5, "w", 4, 4), ("z", 6, None, 5, 4), ("", None, None, 0, 0)]


def held_out_rows(name, column, modulus, rest):
    import zlib

    import pyarrow.parquet as pq

    rows = pq.read_table(f"{SF}/{name}.parquet").to_pylist()
    return {r["doc_id"]: r[column] for r in rows if r[column] is not None and zlib.crc32(str(r["doc_id"]).encode()) % modulus == rest}


SF = "/root/testdata/sf0.01"


def test_language_query_on_held_out_rows(spark):
    from strainframe.llm.queries import op2_ecoc_language_id

    want = held_out_rows("documents", "lang", 3, 1)
    got = {r.doc_id: r for r in op2_ecoc_language_id(spark, SF).collect()}
    right = [got[k].lang_pred == lang for k, lang in want.items() if got[k].lang_pred != "und"]
    assert len(right) > 200 and sum(right) / len(right) >= 0.97
    assert all(0 <= r.score <= 1 for r in got.values())


def test_quality_query_on_held_out_rows(spark):
    from strainframe.llm.queries import op7_subword_quality

    want = held_out_rows("labels", "quality", 5, 0)
    got = {r.doc_id: r for r in op7_subword_quality(spark, SF).collect()}
    scores = {v: [got[k].score for k, label in want.items() if label == v and k in got] for v in (0, 1)}
    assert min(map(len, scores.values())) >= 5
    pairs = [(a > b) + 0.5 * (a == b) for a in scores[1] for b in scores[0]]
    assert sum(pairs) / len(pairs) >= 0.95
    assert sum(got[k].predicted == v for k, v in want.items() if k in got) / len([k for k in want if k in got]) >= 0.9
    assert all(r.predicted == (r.score >= 0.3) for r in got.values())


def test_model_query_is_better_than_its_base(spark):
    from strainframe.llm.queries import op3_katz_backoff

    rows = [r for r in op3_katz_backoff(spark, SF).collect() if r.held_out]
    assert sum(r.score for r in rows) > 0.8 * sum(r.base_score for r in rows)


def test_classifiers_with_repeated_ids_and_long_texts(spark):
    long = "the good word " * 200_000
    rows = [(1, "aa bb", "x", None, None), (1, "cc dd", "x", None, None), (2, long, "y", None, None), (None, "no id", "x", None, None), (3, None, "y", None, None), (3, None, "y", None, None)]
    df = spark.createDataFrame(rows, SCHEMA)
    model = langid.fit(df, "doc_id", "text", "lang", learn=df["doc_id"] > 0)
    assert model.languages == ["x", "y"] and langid.identified(df, "text", model, into="chunk_").count() == 6
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, 1), (3, 1)], "doc_id long, quality int")
    found = quality.scored(df, "text", quality.fit(df, labels, "doc_id", "text", "quality"), score="s", predicted="p").collect()
    assert len(found) == 6 and all(0 <= r.s <= 1 for r in found)
    scores = katz.score_texts(df, "doc_id", "text", learn=df["doc_id"] != 2).collect()
    assert sorted(r.n_tokens for r in scores) == [1, 1, 3, 3, 3, 600_001]
    kept = substrings.without_repeats(df.select("doc_id", "text"), "doc_id", "text").collect()
    assert max(r.n_removed for r in kept) == 600_000


def test_empty_tables(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert substrings.without_repeats(none, "doc_id", "text").count() == 0
    assert jaccard.similar_components(none, "doc_id", "text").count() == 0
    assert katz.score_texts(none, "doc_id", "text", learn=none["doc_id"] > 0).count() == 0
    assert packing.pack(none, "doc_id", "text", tokenizer("word_bpe_49k.json"), 2).count() == 0
    assert langid.identified(none, "text", langid.fit(none, "doc_id", "text", "lang", none["doc_id"] > 0), into="l").count() == 0
    labels = spark.createDataFrame([], "doc_id long, quality int")
    assert quality.scored(none, "text", quality.fit(none, labels, "doc_id", "text", "quality")).count() == 0


def tokenizer(name):
    import public_tokenizers

    return public_tokenizers.path(name)


def test_language_id(spark):
    rng = random.Random(3)
    tongues = {"aa": ["alpha", "gamma", "atta"], "bb": ["brum", "brix", "obbo"], "cc": ["cicci", "cuc", "ecce"]}
    rows = [(i, " ".join(rng.choice(tongues[k]) for _ in range(12)), k if i % 7 else None, "c", 0.0) for i, k in enumerate(list(tongues) * 40)]
    rows += [(900, None, "aa", None, None), (901, "", "bb", None, None), (902, "12 34 !!", "aa", None, None), (None, "brum brix obbo", None, None, None)]
    df = spark.createDataFrame(rows, SCHEMA)
    model = langid.fit(df, "doc_id", "text", "lang", learn=df["doc_id"] % 4 != 1)
    got = {r.doc_id: r for r in langid.identified(df.select("doc_id", "text"), "text", model).collect()}
    assert all(got[i].lang_pred == list(tongues)[i % 3] and 0 <= got[i].score <= 1 for i in range(120))
    assert [got[i].lang_pred for i in (900, 901, 902)] == ["und"] * 3 and got[902].score == 0
    assert got[None].lang_pred == "bb"


def test_codewords_are_apart():
    for n in (2, 3, 5, 7, 9, 20):
        code = langid.codewords(n)
        assert len({tuple(w) for w in code}) == n
        if n > 2:
            assert min((code[i] != code[j]).sum() for i in range(n) for j in range(i)) >= 2


def test_quality(spark):
    rng = random.Random(5)
    good, bad = [f"good{i}" for i in range(20)], [f"BAD{i}!!" for i in range(20)]
    rows = [(i, " ".join(rng.choice(good if i % 2 else bad) for _ in range(30)), None, None, None) for i in range(200)] + [(900, None, None, None, None), (901, "", None, None, None)]
    labels = spark.createDataFrame([(i, i % 2, "x") for i in range(150)] + [(3, 0, "x"), (900, None, "x"), (None, 1, "x")], "doc_id long, quality int, text string")
    df = spark.createDataFrame(rows, SCHEMA)
    model = quality.fit(df, labels, "doc_id", "text", "quality")
    got = {r.doc_id: r for r in quality.scored(df, "text", model, score="s", predicted="p").collect()}
    assert all(got[i].p == i % 2 for i in range(150, 200))
    assert got[900].s == got[901].s and 0 <= got[900].s <= 1


def test_quality_is_not_trained_on_the_driver(spark, monkeypatch):
    rows = [(i, f"{'good' if i % 2 else 'bad'} w{i % 7} w{i % 5}", None, None, None) for i in (*range(99, 40, -1), *range(41))]
    labels = spark.createDataFrame([(i, i % 2) for i in range(100)], "doc_id long, quality int")
    want = quality.train([text for _, text, *_ in sorted(rows)], np.array([i % 2 for i in range(100)]))
    monkeypatch.setattr(quality, "train", None)
    model = quality.fit(spark.createDataFrame(rows, SCHEMA), labels, "doc_id", "text", "quality")
    assert model.bias == want.bias and all((a == b).all() for a, b in zip(model.tables, want.tables, strict=True))
