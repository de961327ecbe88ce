"""Exact Jaccard join of shingle sets in metric space, down to components.

The distance 1 - J is a metric, but nearly all pairs of documents lie at
distance 1, so pivots alone cannot tell them apart.  Documents therefore meet
first in blocks: two sets that link must share some of the first shingles of a
common order (very frequent ones last), so no link is lost.  Inside a block
the distance is bounded from below by the L1 distance of counts of hashed
shingles (128 kinds, for long documents an eighth to a quarter of their size),
itself a metric:

* a block of a few documents joins directly; pairs that share as many first
  shingles as linked ones must are verified on whole sets;
* a larger one chooses pivots far apart, deals its documents to Voronoi
  regions, replicates those within the triangle-inequality window of a border,
  and each region joins recursively until it no longer shrinks.

Regions that share documents, and documents that share a very frequent
shingle, form clumps: mostly near copies of one text, and any number of them.
A clump gets one more pivot, the shingles of most of its documents (or, where
they have none in common, the empty set).  With the exact symmetric
differences Dx, Dy from that pivot, |x - y| = |Dx| + |Dy| - 2 |Dx & Dy|, so x
and y link if and only if w(x) + w(y) <= 2 (per + least) |Dx & Dy| for
w(x) = (per + least) |Dx| - (per - least) |x|.  One document of least w so
links all that lie in its window, without looking at pairs.  What is left
meets the clump's documents in tiles of bounded size, by an index over
differences, where it first chooses pivots of its own.  A tile gives no more
links than it has documents.

Pairs already in one component need no test, so groups of near copies cost in
proportion to their size.

Defined cases: a document without words has no shingles and links with nothing;
one with fewer words than a shingle has its whole sequence as one; equal word
sequences link; rows of one id count as linked, whatever their texts; a null id
gets its group's component, or null; texts are taken whole; an empty table
gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .exchange import ROW_BITS, asks, chunked, column_of, frugal, in_order, packed, rows_of, unpacked
from .shared import buckets_for, stored
from .substrings import window_hashes
from .units import mix, word_hashes

CLASSES = 128
LEAF = 24
#: A part of so many documents looks at all pairs that are not yet together; a shingle of so many is very frequent.
REGION, FREQUENT = 4096, 1024
PIVOTS = 64
#: Documents of a clump that vote on its pivot, and documents on either side of a tile.
VOTERS, TILE = 32, 512
#: Bytes of posts and counts that a bucket holds at about most; candidate pairs that are looked at together.
BUCKET_BYTES, AT_ONCE = 128 << 20, 1 << 18

PAIR = "a long, b long"


class Rule:
    """Links when ``per`` * |x & y| >= ``least`` * |x | y|, on shingles of ``words`` words."""

    def __init__(self, words: int, least: int, per: int = 100):
        self.words, self.least, self.per = words, least, per

    def overlap(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """The smallest intersection with which sets of these sizes link."""
        return -(-self.least * (x + y) // (self.per + self.least))

    def shared(self, n: np.ndarray | int) -> np.ndarray | int:
        """How many of their first shingles two linked sets of this size or more share at least."""
        return 1 + n // 100

    def prefix(self, n: int) -> int:
        """So many first shingles that linked sets share ``shared`` of them."""
        return n - -(-self.least * n // self.per) + self.shared(n)

    def feasible(self, n: np.ndarray, m: np.ndarray, apart: np.ndarray) -> np.ndarray:
        """Whether sets of sizes n and m can link, their symmetric difference being ``apart`` at least."""
        return (self.per * np.minimum(n, m) >= self.least * np.maximum(n, m)) & (apart <= n + m - 2 * self.overlap(n, m))

    def widest(self, n: np.ndarray) -> int:
        """The largest symmetric difference of linked sets of at most these sizes."""
        return 2 * int(n.max()) * (self.per - self.least) // (self.per + self.least)

    def weight(self, n: np.ndarray, apart: np.ndarray) -> np.ndarray:
        """w of sets of sizes n that differ from a pivot by ``apart``: two link if their weights' sum is at most ``reach`` times the common part of their differences."""
        return (self.per + self.least) * apart - (self.per - self.least) * n

    @property
    def reach(self) -> int:
        return 2 * (self.per + self.least)


def shingle_sets(docs: pa.Table, rule: Rule) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each document its word hashes and its sorted distinct shingle hashes."""
    words, first = word_hashes(docs["text"], lower=True)
    grams = window_hashes(words, rule.words)
    for a, b in zip(first[:-1], first[1:], strict=True):
        if b - a >= rule.words:
            yield words[a:b], np.unique(grams[a : b - rule.words + 1])
        elif b > a:
            yield words[a:b], mix(np.array([xxhash.xxh3_64_intdigest(words[a:b].tobytes())], np.uint64))
        else:
            yield words[a:b], np.zeros(0, np.uint64)


DESCRIBED = "row long, doc_id long, node binary, n_shingles long, bucket int, chunk long, keys binary, extra binary"


def describe(rule: Rule, buckets: int):
    """Two kinds of rows: each document's (row, doc_id, node, n_shingles), node naming its word sequence; and, by
    bucket, the chunk's shingles that at least two of its documents have, with their number."""

    def run(key: tuple, docs: pa.Table) -> pa.Table:
        docs, node, n, sets = in_order(docs), [], [], []
        for words, grams in shingle_sets(docs, rule):
            node.append(xxhash.xxh3_128_digest(words.tobytes()) if len(words) else None)
            n.append(len(grams))
            sets.append(grams)
        grams, count = np.unique(np.concatenate(sets), return_counts=True) if sets else (np.zeros(0, np.uint64), np.zeros(0, np.int64))
        common = asks(key[0].as_py(), grams[count > 1], count[count > 1].astype(np.uint32), buckets)
        k, m = len(docs), len(common)
        rows = pa.array(rows_of(key[0].as_py(), np.arange(k)))
        own = pa.table({"row": rows, "doc_id": docs["doc_id"].cast(pa.int64()), "node": pa.array(node, pa.binary()), "n_shingles": pa.array(n, pa.int64()), "bucket": pa.nulls(k, pa.int32()), "chunk": pa.nulls(k, pa.int64()), "keys": pa.nulls(k, pa.binary()), "extra": pa.nulls(k, pa.binary())})
        asked = pa.table({"row": pa.nulls(m, pa.int64()), "doc_id": pa.nulls(m, pa.int64()), "node": pa.nulls(m, pa.binary()), "n_shingles": pa.nulls(m, pa.int64()), "bucket": common["bucket"], "chunk": common["chunk"], "keys": common["keys"], "extra": common["extra"]})
        return pa.concat_tables([own, asked])

    return run


def picked(key: tuple, docs: pa.Table, rows: np.ndarray) -> pa.Table:
    """The chunk's documents of these rows, in their order."""
    return in_order(docs).take(pa.array(rows - rows_of(key[0].as_py(), np.zeros(1, np.int64))))


def very_common(least: int):
    def run(table: pa.Table) -> pa.Table:
        grams, place = np.unique(np.concatenate(column_of(table, "keys", np.uint64)), return_inverse=True)
        n = np.bincount(place, np.concatenate(column_of(table, "extra", np.uint32)), len(grams))
        return pa.table({"gram": pa.array(grams[n >= least].view(np.int64))})

    return run


def tier_of(n: np.ndarray) -> np.ndarray:
    """Binary logarithm of the kinds that a set of this size is counted in."""
    return np.maximum(np.log2(CLASSES), np.ceil(np.log2(np.maximum(n, 1))) - 3).astype(np.int64)


def sketch(grams: np.ndarray) -> np.ndarray:
    kinds = 1 << int(tier_of(np.array([len(grams)]))[0])
    return np.minimum(np.bincount((grams & np.uint64(kinds - 1)).astype(np.int64), minlength=kinds), 255).astype(np.uint8)


POSTED = "bucket int, blob binary, gram long, a long, b long"


def posted_rows(bucket: np.ndarray, blob: list, gram: np.ndarray, a: np.ndarray, b: np.ndarray, buckets: int) -> pa.Table:
    """Posts; then very frequent shingles, each with a document that has it; then edges between documents of one clump."""
    n, m, k = len(blob), len(a), len(gram)
    pad = lambda before, values, after: pa.concat_arrays([pa.nulls(before, values.type), values, pa.nulls(after, values.type)])
    # Edges of one shingle meet in one bucket; others are dealt evenly.
    spread = np.concatenate([mix(gram), mix(a[k:].view(np.uint64))]) % np.uint64(buckets)
    return pa.table({
        "bucket": pa.array(np.concatenate([bucket, spread.astype(np.int64)]), pa.int32()), "blob": pad(0, pa.array(blob, pa.binary()), m),
        "gram": pad(n, pa.array(gram.view(np.int64), pa.int64()), m - k), "a": pad(n, pa.array(a, pa.int64()), 0), "b": pad(n, pa.array(b, pa.int64()), 0),
    })


def joined_by(left: np.ndarray, right: np.ndarray, n: int) -> np.ndarray:
    """The smallest place that edges left-right connect with each of n places."""
    home = np.arange(n)
    while True:
        low = np.minimum(home[left], home[right])
        before = home.copy()
        np.minimum.at(home, left, low)
        np.minimum.at(home, right, low)
        home = home[home]
        if (home == before).all():
            return home


def post(rule: Rule, buckets: int, common: np.ndarray):
    """The first shingles of each document in the common order, with its size and counts.

    Very frequent ones are not posted: documents that must look at them go to one clump.
    """

    def run(key: tuple, docs: pa.Table, chosen: pa.Table) -> pa.Table:
        names = chosen["row"].to_numpy()
        grams, which, size, counts, hot, hot_of = [], [], [], [], [], []
        for i, (_, g) in enumerate(shingle_sets(picked(key, docs, names), rule)):
            size.append(len(g))
            counts.append(sketch(g))
            late = common[np.minimum(np.searchsorted(common, g), len(common) - 1)] == g if len(common) else np.zeros(len(g), bool)
            # The order is by mixed hash, so that a document's first shingles are a random part of it.
            order = np.lexsort((mix(g), late))[: rule.prefix(len(g))]
            g, late = g[order], late[order]
            grams.append(g[~late])
            which.append(np.full(len(grams[-1]), i))
            hot.append(g[late])
            hot_of.append(np.full(len(hot[-1]), i))
        none = np.zeros(0, np.int64)
        if not len(names):
            return posted_rows(none, [], none.view(np.uint64), none, none, buckets)
        grams, which, hot, hot_of = (np.concatenate(x) for x in (grams, which, hot, hot_of))
        # The upper half of a shingle's hash tells its bucket, the lower names it there; shingles that meet by chance give candidates too many.
        grams = mix(grams)
        bucket, grams = ((grams >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64), grams.astype(np.uint32)
        order = np.argsort(bucket, kind="stable")
        kinds, start = np.unique(bucket[order], return_index=True)
        size, blobs = np.array(size, np.uint32), []
        for a, b in zip(start, np.append(start, len(order))[1:], strict=True):
            some = order[a:b]
            docs_here, place = np.unique(which[some], return_inverse=True)
            blobs.append(packed(grams[some], place.astype(np.uint32), names[docs_here], size[docs_here], np.concatenate([counts[d] for d in docs_here])))
        # Documents and very frequent shingles of this chunk that hang together are named by their first document.
        shingles, place = np.unique(hot, return_inverse=True)
        home = joined_by(place, len(shingles) + hot_of, len(shingles) + len(names))
        first = np.full(len(home), len(home))
        np.minimum.at(first, home[len(shingles) :], np.arange(len(names)))
        edge_docs = np.unique(hot_of)
        heads = names[first[home[np.concatenate([np.arange(len(shingles)), len(shingles) + edge_docs])]]] if len(hot) else none
        return posted_rows(kinds, blobs, shingles, heads, np.concatenate([heads[: len(shingles)], names[edge_docs]]), buckets)

    return run


class Block:
    """Documents that may link: names, sizes and counts (after each other, as many as the sizes say)."""

    def __init__(self, ids: np.ndarray, sizes: np.ndarray, counts: np.ndarray):
        self.ids, self.sizes, self.counts = ids, sizes.astype(np.int64), counts
        self.tier = tier_of(self.sizes)
        self.first = np.concatenate([[0], np.cumsum(1 << self.tier)])
        self.folded: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def __len__(self) -> int:
        return len(self.ids)

    def take(self, at: np.ndarray) -> Block:
        n = np.int64(1) << self.tier[at]
        spots = np.repeat(self.first[at] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
        return Block(self.ids[at], self.sizes[at], self.counts[spots])

    def matrix(self, tier: int) -> tuple[np.ndarray, np.ndarray]:
        """Counts of 2**tier kinds, a row for each document that has as many, and each document's row.

        The sum of two kinds' differences is at least the difference of their sums, so folded counts bound distances too.
        """
        if tier not in self.folded:
            kinds = np.unique(self.tier[self.tier >= tier])
            rows, place = 0, np.full(len(self), -1)
            # Counts fit a byte; sums of counts may not.
            out = np.empty((int((self.tier >= tier).sum()), 1 << tier), np.uint8 if kinds.max() == tier else np.uint16)
            for own in kinds:
                docs = np.flatnonzero(self.tier == own)
                step = max(1, (1 << 20) >> int(own))
                for k in range(0, len(docs), step):
                    some = docs[k : k + step]
                    values = self.counts[self.first[some][:, None] + np.arange(1 << own)]
                    out[rows : rows + len(some)] = values if own == tier else values.reshape(len(some), -1, 1 << tier).sum(axis=1, dtype=np.uint16)
                    place[some] = rows + np.arange(len(some))
                    rows += len(some)
            self.folded[tier] = out, place
        return self.folded[tier]

    def apart(self, i: np.ndarray, j: np.ndarray, tier: int | None = None) -> np.ndarray:
        """A lower bound of the symmetric differences of i and j, by the kinds that both have or those of ``tier``."""
        out = np.empty(len(i), np.int64)
        both = np.minimum(self.tier[i], self.tier[j]) if tier is None else np.full(len(i), tier)
        for t in np.unique(both):
            own = np.flatnonzero(both == t)
            counts, place = self.matrix(int(t))
            step = max(1, (1 << 22) >> int(t))
            for k in range(0, len(own), step):
                some = own[k : k + step]
                x, y = counts[place[i[some]]], counts[place[j[some]]]
                out[some] = (np.maximum(x, y) - np.minimum(x, y)).sum(axis=1, dtype=np.int64)
        return out

    def feasible(self, rule: Rule, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        # Sizes are compared first; they settle most pairs at less cost.
        ok = rule.feasible(self.sizes[i], self.sizes[j], np.zeros(len(i), np.int64))
        ok[ok] = rule.feasible(self.sizes[i[ok]], self.sizes[j[ok]], self.apart(i[ok], j[ok]))
        return ok


def direct(block: Block, rule: Rule) -> tuple[np.ndarray, np.ndarray]:
    i, j = np.triu_indices(len(block), 1)
    ok = block.feasible(rule, i, j)
    return i[ok], j[ok]


def by_size(block: Block, rule: Rule) -> Iterator[Block]:
    """Parts between which no two sizes can link."""
    order = np.argsort(block.sizes, kind="stable")
    s = block.sizes[order]
    gaps = np.flatnonzero(rule.per * s[:-1] < rule.least * s[1:]) + 1
    for part in np.split(order, gaps):
        if len(part) > 1:
            yield block.take(part)


def by_kinds(block: Block, rule: Rule) -> Iterator[Block]:
    """Parts of documents counted in nearly as many kinds; two that link share a part."""
    kinds = np.unique(block.tier)
    if len(kinds) == 1 or 2 * rule.least <= rule.per:
        yield block
        return
    for t in kinds:
        own = block.tier == t
        # Linked sizes differ by less than a factor of two, so by one step at most.
        below = (block.tier == t - 1) & (block.sizes * rule.per >= block.sizes[own].min() * rule.least)
        yield block.take(np.flatnonzero(own | below))


def regions(block: Block, rule: Rule) -> Iterator[Block]:
    """The block's Voronoi regions with their windows, recursively while they shrink."""
    for sized in by_size(block, rule):
        for part in by_kinds(sized, rule):
            yield from voronoi(part, rule)


def voronoi(part: Block, rule: Rule) -> Iterator[Block]:
    if len(part) <= LEAF * 4:
        yield part
        return
    # Pivots far apart: each is the document farthest from those before.
    pivots, every, tier = [0], np.arange(len(part)), int(part.tier.min())
    distance = [part.apart(every, np.zeros(len(part), np.int64), tier)]
    while len(pivots) < PIVOTS:
        nearest = np.min(distance, axis=0)
        if nearest.max() <= rule.widest(part.sizes):
            break
        pivots.append(int(nearest.argmax()))
        distance.append(part.apart(every, np.full(len(part), pivots[-1]), tier))
    table = np.stack(distance)
    # If x and y link, y is no farther from x's pivot than from its own by twice their distance.
    inside = table <= table.min(axis=0) + 2 * rule.widest(part.sizes)
    if len(pivots) > 1 and inside.sum(axis=1).max() <= 0.7 * len(part) and inside.sum() <= 2 * len(part):
        for row in inside:
            if row.sum() > 1:
                yield from regions(part.take(np.flatnonzero(row)), rule)
    else:
        yield part


def feasible_parts(block: Block, rule: Rule) -> Iterator[Block]:
    """A region's parts that feasible pairs hold together; a region too large to look at its pairs stays whole."""
    if len(block) > REGION:
        yield block
        return
    home = np.arange(len(block))
    for i in range(len(block) - 1):
        others = i + 1 + np.flatnonzero(home[i + 1 :] != home[i])
        if len(others):
            met = others[block.feasible(rule, np.full(len(others), i), others)]
            if len(met):
                kinds = np.unique(np.append(home[met], home[i]))
                home[np.isin(home, kinds)] = kinds[0]
    names, n = np.unique(home, return_counts=True)
    for name in names[n > 1]:
        yield block.take(np.flatnonzero(home == name))


MET = "a long, b long, clump boolean, shared long, need long"


def meet(rule: Rule):
    """Candidate pairs of a bucket's small blocks, and edges that hold its larger regions together."""

    def run(table: pa.Table) -> pa.Table:
        posts = table.filter(pc.is_valid(table["blob"]))
        found = met_in(posts) if len(posts) else [np.zeros((0, 3), np.int64), np.zeros(0, np.int64), np.zeros((0, 2), np.int64)]
        pairs, shared, edges = found
        # Documents with a very frequent shingle hang together by the first of them.
        given = table.filter(pc.is_null(table["blob"]))
        plain, frequent = given.filter(pc.is_null(given["gram"])), given.filter(pc.is_valid(given["gram"]))
        gram, a = frequent["gram"].to_numpy(), frequent["a"].to_numpy()
        order = np.lexsort((a, gram))
        head = np.flatnonzero(np.append(True, gram[order][1:] != gram[order][:-1])) if len(gram) else np.zeros(0, np.int64)
        first = np.repeat(a[order][head], np.diff(np.append(head, len(gram))))
        edges = np.unique(np.concatenate([edges, np.stack([first, a[order]], axis=1), np.stack([plain["a"].to_numpy(), plain["b"].to_numpy()], axis=1)]), axis=0)
        rows = np.concatenate([pairs, np.concatenate([edges, np.zeros((len(edges), 1), np.int64)], axis=1)])
        shared = np.concatenate([shared.astype(np.int64), np.zeros(len(edges), np.int64)])
        return pa.table({"a": pa.array(rows[:, 0]), "b": pa.array(rows[:, 1]), "clump": pa.array(np.arange(len(rows)) >= len(pairs)), "shared": pa.array(shared), "need": pa.array(rows[:, 2])})

    def met_in(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        parts = [unpacked(x.as_buffer()) for x in table["blob"]]
        off = np.cumsum([0] + [len(p[2]) for p in parts[:-1]])
        gram = np.concatenate([p[0] for p in parts])
        doc = np.concatenate([p[1].astype(np.int64) + o for p, o in zip(parts, off, strict=True)])
        everything = Block(*(np.concatenate([p[k] for p in parts]) for k in (2, 3)), np.concatenate([p[4] for p in parts]))
        del parts
        order = np.lexsort((everything.ids[doc], gram))
        gram, doc = gram[order], doc[order]
        start = np.flatnonzero(np.append(True, gram[1:] != gram[:-1]))
        size = np.diff(np.append(start, len(gram)))
        # How many first shingles two documents share here; with those of other buckets it must reach what links need.
        pairs, times, edges = [np.zeros((0, 3), np.int64)], [np.zeros(0, np.int64)], [np.zeros((0, 2), np.int64)]
        # Blocks of one size are joined directly together, so many at a time.
        for k in range(2, LEAF + 1):
            own, (i, j) = start[size == k][:, None], np.triu_indices(k, 1)
            step = max(1, AT_ONCE // len(i))
            for at in range(0, len(own), step):
                some = own[at : at + step]
                met, often = np.unique(pairs_of(everything, doc[some + i].reshape(-1), doc[some + j].reshape(-1), rule), axis=0, return_counts=True)
                pairs.append(met)
                times.append(often)
        larger: dict[bytes, list] = {}
        for a, k in zip(start[size > LEAF], size[size > LEAF], strict=True):
            members = doc[a : a + k]
            larger.setdefault(xxhash.xxh3_128_digest(members.tobytes()), [members, 0])[1] += 1
        for members, often in larger.values():
            own = [np.zeros((0, 3), np.int64)]
            for region in regions(everything.take(members), rule):
                for part in feasible_parts(region, rule):
                    if len(part) <= LEAF:
                        own.append(pairs_of(part, *np.triu_indices(len(part), 1), rule))
                    else:
                        # Those that share this shingle so meet in their clump, and need no count.
                        edges.append(np.stack([np.full(len(part), part.ids.min()), part.ids], axis=1))
            pairs.append(np.unique(np.concatenate(own), axis=0))
            times.append(np.full(len(pairs[-1]), often))
        pairs, place = np.unique(np.concatenate(pairs), axis=0, return_inverse=True)
        return pairs, np.bincount(place.reshape(-1), np.concatenate(times), len(pairs)), np.concatenate(edges)

    return run


def posts_buckets(docs: int, posts: int, counts: int) -> int:
    """Buckets for ``posts`` first shingles of ``docs`` documents whose counts take ``counts`` bytes.

    A document's counts go to each bucket in which it posts.  With few buckets that is nearly all of them, with many
    each post brings its own counts, so their number follows from bytes, not from posts alone.
    """
    told = counts + 20 * docs
    spread = buckets_for(posts * (8 * docs + told), max(1, BUCKET_BYTES * docs))
    return spread if 2 * told > BUCKET_BYTES else min(spread, buckets_for(8 * posts, BUCKET_BYTES - told))


def pairs_of(block: Block, i: np.ndarray, j: np.ndarray, rule: Rule) -> np.ndarray:
    """The feasible ones among the pairs, smaller names first, with the number of first shingles they must share."""
    if not len(i):
        return np.zeros((0, 3), np.int64)
    ok = block.feasible(rule, i, j)
    i, j = i[ok], j[ok]
    x, y = block.ids[i], block.ids[j]
    return np.stack([np.minimum(x, y), np.maximum(x, y), rule.shared(np.minimum(block.sizes[i], block.sizes[j]))], axis=1)


def ballots(rule: Rule):
    """The sets of a chunk's voters."""

    def run(key: tuple, docs: pa.Table, told: pa.Table) -> pa.Table:
        sets = [g.tobytes() for _, g in shingle_sets(picked(key, docs, told["id"].to_numpy()), rule)]
        return pa.table({"clump": told["clump"].cast(pa.int64()), "grams": pa.array(sets, pa.binary())})

    return run


def vote(table: pa.Table) -> pa.Table:
    """The shingles that most voters of a clump have."""
    grams, n = np.unique(np.concatenate(column_of(table, "grams", np.uint64)), return_counts=True)
    return pa.table({"clump": table["clump"][:1].cast(pa.int64()), "pivot": pa.array([grams[2 * n > len(table)].tobytes()], pa.binary())})


DIFFERENCE = "clump long, id long, n long, w long, difference binary"


def differences(rule: Rule):
    """What each document of a clump and its pivot do not have in common, and its weight."""

    def run(key: tuple, docs: pa.Table, told: pa.Table) -> pa.Table:
        own, given = told.filter(pc.is_valid(told["id"])), told.filter(pc.is_valid(told["pivot"]))
        pivots = dict(zip(given["clump"].to_pylist(), column_of(given, "pivot", np.uint64), strict=True))
        n, w, apart = [], [], []
        for clump, (_, g) in zip(own["clump"].to_pylist(), shingle_sets(picked(key, docs, own["id"].to_numpy()), rule), strict=True):
            d = np.setxor1d(g, pivots[clump], assume_unique=True)
            n.append(len(g))
            w.append(int(rule.weight(len(g), len(d))))
            apart.append(d.tobytes())
        return pa.table({"clump": own["clump"].cast(pa.int64()), "id": own["id"].cast(pa.int64()), "n": pa.array(n, pa.int64()), "w": pa.array(w, pa.int64()), "difference": pa.array(apart, pa.binary())})

    return run


class Tile:
    """Some documents of a clump by their differences from its pivot: links between those not yet in one component."""

    def __init__(self, rule: Rule, ids: np.ndarray, sizes: np.ndarray, w: np.ndarray, parts: list[np.ndarray], home: np.ndarray, asks: np.ndarray):
        self.rule, self.ids, self.sizes, self.w, self.home, self.asks = rule, ids, sizes, w, home, asks
        self.length = np.fromiter(map(len, parts), np.int64, len(parts))
        self.first = np.concatenate([[0], np.cumsum(self.length)])
        self.doc = np.repeat(np.arange(len(parts)), self.length)
        names, self.code, self.often = np.unique(np.concatenate(parts) if parts else np.zeros(0, np.uint64), return_inverse=True, return_counts=True)
        self.width = len(names) + 1
        self.found: list[np.ndarray] = []

    def link(self, i: np.ndarray, j: np.ndarray) -> None:
        """Join the components of linked documents; only links that do so are kept."""
        kinds, place = np.unique(self.home, return_inverse=True)
        parent = np.arange(len(kinds))

        def root(x: int) -> int:
            while parent[x] != x:
                parent[x] = x = parent[parent[x]]
            return x

        keep = []
        for k, (x, y) in enumerate(zip(place[i].tolist(), place[j].tolist(), strict=True)):
            x, y = root(x), root(y)
            if x != y:
                parent[max(x, y)] = min(x, y)
                keep.append(k)
        if keep:
            self.found.append(np.stack([self.ids[i[keep]], self.ids[j[keep]]], axis=1))
            top = np.array([root(x) for x in range(len(kinds))])
            self.home = kinds[top[place]]

    def pivots(self, rest: np.ndarray) -> None:
        """Documents outside, by pivots of their own, as long as one links some."""
        while len(rest) > 2:
            here = np.zeros(len(self.ids), bool)
            here[rest] = True
            entries = np.flatnonzero(here[self.doc])
            most = np.bincount(self.code[entries], minlength=self.width) * 2 > len(rest)
            if not most.any():
                return
            common = np.bincount(self.doc[entries], most[self.code[entries]], len(self.ids))[rest].astype(np.int64)
            w = self.rule.weight(self.sizes[rest], self.length[rest] + int(most.sum()) - 2 * common)
            centre = int(w.argmin())
            near = w + w[centre] <= 0
            near[centre] = False
            if not near.any():
                return
            self.link(np.full(int(near.sum()), rest[centre]), rest[near])
            near[centre] = True
            rest = rest[~near]

    def verified(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Whether pairs link, by the common part of their differences."""
        if not hasattr(self, "entry"):
            self.entry = np.sort(self.doc * self.width + self.code)
        n = self.length[i]
        at = np.repeat(self.first[i] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
        want = np.repeat(j * self.width, n) + self.code[at]
        hit = self.entry[np.minimum(np.searchsorted(self.entry, want), len(self.entry) - 1)] == want
        both = np.bincount(np.repeat(np.arange(len(i)), n), hit, len(i)).astype(np.int64)
        return self.w[i] + self.w[j] <= self.rule.reach * both

    def test(self, i: np.ndarray, j: np.ndarray) -> None:
        """Verify pairs of different components, a few million differences at a time."""
        ok = self.rule.per * np.minimum(self.sizes[i], self.sizes[j]) >= self.rule.least * np.maximum(self.sizes[i], self.sizes[j])
        i, j = i[ok], j[ok]
        while len(i):
            apart = self.home[i] != self.home[j]
            i, j = i[apart], j[apart]
            n = max(1, int(np.searchsorted(np.cumsum(self.length[i]), 1 << 21)))
            if len(i):
                good = self.verified(i[:n], j[:n])
                self.link(i[:n][good], j[:n][good])
            i, j = i[n:], j[n:]

    def join(self) -> None:
        """All pairs of an asking document and one of another component that share one of the rarest differences of both."""
        if not self.asks.any():
            return
        reach, low = self.rule.reach, int(self.w.min())
        # Two can link only if they share this many differences at least, hence one of the others.
        need = np.maximum(1, -(-(self.w + np.where(self.asks, low, int(self.w[self.asks].min()))) // reach))
        rank = np.empty(self.width - 1, np.int64)
        rank[np.argsort(self.often, kind="stable")] = np.arange(self.width - 1)
        order = np.lexsort((rank[self.code], self.doc))
        place = np.arange(len(order)) - np.repeat(self.first[:-1], self.length)
        keep = order[place < (self.length - need + 1)[self.doc[order]]]
        code, doc = self.code[keep], self.doc[keep]
        order = np.lexsort((self.home[doc], self.often[code], code))
        code, doc = code[order], doc[order]
        begin = np.flatnonzero(np.append(True, code[1:] != code[:-1])) if len(code) else np.zeros(0, np.int64)
        size = np.diff(np.append(begin, len(code)))
        # Short lists first: they settle much for little.
        entry = np.concatenate([np.arange(b, b + s) for b, s in sorted(zip(begin.tolist(), size.tolist(), strict=True), key=lambda x: x[1]) if s > 1] or [np.zeros(0, np.int64)])
        end = np.repeat(begin + size, size)
        # Each entry meets those of other components behind it in its list.
        run = np.append(True, (code[1:] != code[:-1]) | (self.home[doc[1:]] != self.home[doc[:-1]])) if len(code) else np.zeros(0, bool)
        runs_ = np.append(np.flatnonzero(run), len(code))
        after = runs_[np.cumsum(run)] if len(code) else np.zeros(0, np.int64)
        many = (end - after)[entry]
        entry, many = entry[many > 0], many[many > 0]
        total = np.cumsum(many)
        a = 0
        while a < len(entry):
            b = max(a + 1, int(np.searchsorted(total, (total[a - 1] if a else 0) + (1 << 20), side="right")))
            some, n = entry[a:b], many[a:b]
            i = np.repeat(doc[some], n)
            j = doc[np.repeat(after[some] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))]
            good = (self.asks[i] | self.asks[j]) & (self.home[i] != self.home[j])
            pair, often = np.unique(np.minimum(i, j)[good] * len(self.ids) + np.maximum(i, j)[good], return_counts=True)
            pair = pair[np.argsort(-often, kind="stable")]
            self.test(pair // len(self.ids), pair % len(self.ids))
            a = b


def match(rule: Rule):
    """Links of one tile: between the documents that ask (outside the pivot's window) and all others in it."""

    def run(table: pa.Table) -> pa.Table:
        ids, asks_, out = (table[c].to_numpy(zero_copy_only=False) for c in ("id", "asks", "outside"))
        order = np.lexsort((~asks_, ids))
        order = order[np.append(True, ids[order][1:] != ids[order][:-1])]
        table, ids, asks_, out = table.take(pa.array(order)), ids[order], asks_[order], out[order]
        home = np.where(out, np.arange(len(ids)), len(ids))
        tile = Tile(rule, ids, table["n"].to_numpy(), table["w"].to_numpy(), column_of(table, "difference", np.uint64), home, asks_)
        tile.pivots(np.flatnonzero(out))
        tile.join()
        links = np.concatenate([np.zeros((0, 2), np.int64), *tile.found])
        return pa.table({"a": pa.array(links[:, 0]), "b": pa.array(links[:, 1])})

    return run


def clump_links(docs: DataFrame, edges: DataFrame, rule: Rule) -> DataFrame:
    """Links that hold the components of each clump together."""
    member = stored(components(edges).select("id", F.col("component").alias("clump"), F.shiftright("id", ROW_BITS).alias("chunk")), "members")
    by_chunk = docs.groupBy("chunk")
    voters = member.withColumn("_i", F.row_number().over(Window.partitionBy("clump").orderBy(F.xxhash64("id"), "id"))).where(F.col("_i") <= VOTERS).drop("_i")
    sets = by_chunk.cogroup(voters.groupBy("chunk")).applyInArrow(frugal(ballots(rule), True), "clump long, grams binary")
    pivots = stored(sets.groupBy("clump").applyInArrow(vote, "clump long, pivot binary"), "pivots")
    told = member.withColumn("pivot", F.lit(None).cast("binary")).unionByName(member.select("chunk", "clump").distinct().join(pivots, "clump").select(F.lit(None).cast("long").alias("id"), "clump", "chunk", "pivot"))
    apart = stored(by_chunk.cogroup(told.groupBy("chunk")).applyInArrow(frugal(differences(rule), True), DIFFERENCE), "differences")
    centre = apart.groupBy("clump").agg(F.min(F.struct("w", "id")).alias("centre")).select("clump", F.col("centre.w").alias("cw"), F.col("centre.id").alias("cid"))
    seen = apart.join(centre, "clump").withColumn("outside", (F.col("id") != F.col("cid")) & (F.col("w") + F.col("cw") > 0))
    star = seen.where("not outside and id != cid").select(F.col("cid").alias("a"), F.col("id").alias("b"))
    # Tiles hold a bounded number of documents and bytes on either side.
    parts = lambda flag: F.ceil(F.greatest(F.sum(F.when(flag, 1).otherwise(0)) / TILE, F.sum(F.when(flag, F.octet_length("difference")).otherwise(0)) / (16 << 20)))
    counts = seen.groupBy("clump").agg(parts(F.lit(True)).cast("int").alias("across"), parts(F.col("outside")).cast("int").alias("down"), F.max("outside").alias("some")).where("some").withColumns({"across": F.greatest(F.lit(1), "across"), "down": F.greatest(F.lit(1), "down")}).drop("some")
    counts = stored(counts, "tiles")
    held = seen.join(counts, "clump").select("clump", "id", "n", "w", "difference", "outside", "across", "down")
    spread = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    columns = held.withColumn("x", F.pmod(F.xxhash64("id"), F.col("across")).cast("int")).withColumn("y", spread("down")).withColumn("asks", F.lit(False))
    rows = held.where("outside").withColumn("y", F.pmod(F.xxhash64("id", F.lit(1)), F.col("down")).cast("int")).withColumn("x", spread("across")).withColumn("asks", F.lit(True))
    tiles = columns.unionByName(rows).drop("across", "down")
    return stored(star.unionByName(tiles.groupBy("clump", "x", "y").applyInArrow(match(rule), PAIR)), "clump-links")


def bring(key: tuple, docs: pa.Table, wanted: pa.Table) -> pa.Table:
    """The texts of the chunk's documents for the chunks that want them."""
    rows, place = np.unique(wanted["a"].to_numpy(), return_inverse=True)
    own = picked(key, docs, rows)
    return pa.table({"chunk": wanted["to"], "a": wanted["a"], "b": pa.nulls(len(wanted), pa.int64()), "text": own["text"].cast(pa.string()).take(pa.array(place))})


def verify(rule: Rule):
    """Links among the pairs whose second document lies in the chunk."""

    def run(key: tuple, docs: pa.Table, told: pa.Table) -> pa.Table:
        pairs, texts = told.filter(pc.is_valid(told["b"])), told.filter(pc.is_null(told["b"]))
        given = {int(k): g for k, (_, g) in zip(texts["a"].to_numpy(), shingle_sets(texts, rule), strict=True)}
        rows = np.unique(pairs["b"].to_numpy())
        found = {int(k): g for k, (_, g) in zip(rows, shingle_sets(picked(key, docs, rows), rule), strict=True)}
        out = []
        for a, b in zip(pairs["a"].to_pylist(), pairs["b"].to_pylist(), strict=True):
            x, y = given[a], found[b]
            both = len(np.intersect1d(x, y, assume_unique=True))
            if rule.per * both >= rule.least * (len(x) + len(y) - both):
                out.append((a, b))
        return pa.table({"a": pa.array([x[0] for x in out], pa.int64()), "b": pa.array([x[1] for x in out], pa.int64())})

    return run


def across(pairs: DataFrame, label: DataFrame | None) -> DataFrame:
    """The pairs whose documents are not yet in one component."""
    if label is None:
        return pairs
    a, b = label.select(F.col("id").alias("a"), F.col("component").alias("_x")), label.select(F.col("id").alias("b"), F.col("component").alias("_y"))
    return pairs.join(a, "a", "left").join(b, "b", "left").where(F.coalesce("_x", "a") != F.coalesce("_y", "b")).drop("_x", "_y")


def links_of(docs: DataFrame, pairs: DataFrame, rule: Rule) -> DataFrame:
    """Those of the candidate pairs that link, on whole sets."""
    placed = pairs.select("a", "b", F.shiftright("a", ROW_BITS).alias("chunk"), F.shiftright("b", ROW_BITS).alias("to"))
    wanted = placed.select("a", "chunk", "to").distinct()
    texts = docs.groupBy("chunk").cogroup(wanted.groupBy("chunk")).applyInArrow(frugal(bring, True), "chunk long, a long, b long, text string")
    told = texts.unionByName(placed.select(F.col("to").alias("chunk"), "a", "b", F.lit(None).cast("string").alias("text")))
    return docs.groupBy("chunk").cogroup(told.groupBy("chunk")).applyInArrow(frugal(verify(rule), True), PAIR)


def components(links: DataFrame) -> DataFrame:
    """(id, component): the smallest id reachable from each linked id."""
    edges = stored(links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).where("a != b").distinct(), "edges")
    label = stored(edges.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("component")).withColumnRenamed("a", "id"), "labels")
    while True:
        # The smallest label among neighbours, then that label's own label.
        seen = edges.join(label, edges["b"] == label["id"]).groupBy("a").agg(F.min("component").alias("near"))
        step = label.join(seen, label["id"] == seen["a"], "left").select("id", F.col("component").alias("was"), F.least("component", F.coalesce("near", "component")).alias("now"))
        up = step.select(F.col("id").alias("up_id"), F.col("now").alias("up"))
        step = step.join(up, step["now"] == up["up_id"], "left").select("id", "was", F.least("now", F.coalesce("up", "now")).alias("component"))
        step = stored(step, "labels")
        label, moved = step.select("id", "component"), step.where("was != component").limit(1).count()
        if not moved:
            return label


def extended(label: DataFrame, links: DataFrame) -> DataFrame:
    """The components after further links, found on components alone."""
    name = lambda c: F.coalesce(f"_{c}", c)
    ends = {c: label.select(F.col("id").alias(c), F.col("component").alias(f"_{c}")) for c in ("a", "b")}
    between = links.join(ends["a"], "a", "left").join(ends["b"], "b", "left").select(name("a").alias("a"), name("b").alias("b"))
    top = components(between)
    known = label.join(top.select(F.col("id").alias("component"), F.col("component").alias("_top")), "component", "left").select("id", F.coalesce("_top", "component").alias("component"))
    return stored(known.unionByName(top.join(label, "id", "left_anti")), "labels")


def similar_components(df: DataFrame, key: str, text: str, words: int = 4, least: int = 85, per: int = 100) -> DataFrame:
    """(key, n_shingles, component_id), one row for each row of ``df``."""
    rule = Rule(words, least, per)
    table = chunked(df.select(F.col(key).cast("long").alias("id"), F.col(text).alias("text")), "id", "text")
    docs = table.table.select("chunk", "doc_id", "text")
    # Asked by a sixteenth as many buckets as there are chunks; the posts' buckets follow from the bytes they hold.
    everything = stored(docs.groupBy("chunk").applyInArrow(frugal(describe(rule, buckets_for(table.n, 16)), False), DESCRIBED), "described")
    described = everything.where("bucket is null").select("row", "doc_id", "node", "n_shingles")
    # Equal word sequences are one node, named by the first row that has it.
    nodes = stored(described.where("node is not null").groupBy("node").agg(F.min("row").alias("id"), F.min("doc_id").alias("least")), "nodes")
    kinds = F.pow(F.lit(2.0), F.greatest(F.lit(np.log2(CLASSES)), F.ceil(F.log2(F.greatest("n_shingles", F.lit(1)))) - 3))
    facts = described.agg(F.coalesce(F.sum("n_shingles"), F.lit(0)).alias("grams"), F.count("*").alias("n"), F.coalesce(F.sum(kinds), F.lit(0)).cast("long").alias("counts")).first()
    buckets = posts_buckets(facts["n"], int(facts["grams"] * (per - least) / per) + facts["n"], facts["counts"])
    # Shingles of a thousandth of all documents come last in the order; there are at most a thousand times as many as a mean document has.
    counted = everything.where("bucket is not null").select("bucket", "chunk", "keys", "extra")
    common = counted.groupBy("bucket").applyInArrow(very_common(max(FREQUENT, facts["n"] // 1000)), "gram long").collect()
    common = np.sort(np.array([r["gram"] for r in common], np.int64).view(np.uint64))
    chosen = nodes.select(F.shiftright("id", ROW_BITS).alias("chunk"), F.col("id").alias("row"))
    posted = docs.groupBy("chunk").cogroup(chosen.groupBy("chunk")).applyInArrow(frugal(post(rule, buckets, common), True), POSTED)
    # Posts are few bytes and much work, so tasks follow the number of buckets, not their size.
    bucket = meet(rule)
    met = stored(posted.repartition(buckets, "bucket").groupBy("bucket").applyInArrow(frugal(lambda _, posts: bucket(posts), False), MET), "met")
    edges = met.where("clump").select("a", "b")
    # Texts of one id count as linked.
    ids = described.where("doc_id is not null and node is not null").select("doc_id", "node").join(nodes.select("node", "id"), "node").select("doc_id", F.col("id").alias("b"))
    several = ids.join(ids.groupBy("doc_id").agg(F.min("b").alias("a"), F.max("b").alias("_b")).where("a != _b"), "doc_id").select("a", "b")
    label = components(clump_links(docs, edges, rule).unionByName(several))
    pairs = met.where("not clump").groupBy("a", "b").agg(F.sum("shared").alias("shared"), F.max("need").alias("need")).where("shared >= need").select("a", "b")
    pairs, tested, most = stored(pairs, "pairs"), None, 4
    while True:
        # Of the untested pairs between different components, each document takes its ``most`` smallest partners.
        open_ = across(pairs, label)
        if tested is not None:
            open_ = open_.join(tested, ["a", "b"], "left_anti")
        now = stored(open_.withColumn("_i", F.row_number().over(Window.partitionBy("b").orderBy("a"))).where(F.col("_i") <= most).select("a", "b"), "chosen")
        if not now.limit(1).count():
            break
        tested = now if tested is None else tested.unionByName(now)
        label, most = extended(label, stored(links_of(docs, now, rule), "links")), 16 * most
    named = nodes.join(label, "id", "left").select("node", "least", F.coalesce("component", "id").alias("component"))
    smallest = named.groupBy("component").agg(F.min("least").alias("component_id"))
    out = stored(described.join(named.join(smallest, "component").select("node", "component_id"), "node", "left").select(F.col("doc_id").alias(key), "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id")), "similar")
    table.drop()
    return out
