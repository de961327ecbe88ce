"""Buckets in which first shingles meet hold a bounded number of bytes, whatever the number of documents."""

import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from strainframe.llm import jaccard as J
from strainframe.llm.exchange import packed


def test_meeting_holds_little_more_than_its_counts():
    rng, n, rule = np.random.default_rng(1), 60_000, J.Rule(4, 85)
    counts = rng.integers(0, 4, n * 128).astype(np.uint8)
    # Two documents to a shingle; the last two are alike.
    counts[-128:] = counts[-256:-128]
    blob = packed((np.arange(n) // 2).astype(np.uint32), np.arange(n, dtype=np.uint32), np.arange(n), np.full(n, 150, np.uint32), counts)
    posts = pa.table({"bucket": pa.array([0], pa.int32()), "blob": pa.array([blob], pa.binary()), "gram": pa.nulls(1, pa.int64()), "a": pa.nulls(1, pa.int64()), "b": pa.nulls(1, pa.int64())})
    tracemalloc.start()
    met = J.meet(rule)(posts).to_pylist()
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert (n - 2, n - 1) in [(r["a"], r["b"]) for r in met]
    assert peak < 900 * n


@pytest.mark.parametrize("docs", [50_000, 3_000_000, 15_000_000])
def test_buckets_hold_bounded_bytes(docs):
    posts, counts = 18 * docs, 140 * docs
    n = J.posts_buckets(docs, posts, counts)
    in_one = min(docs, posts / n)
    assert in_one * (counts / docs + 20) + 8 * posts / n <= 1.1 * J.BUCKET_BYTES
    assert n * J.BUCKET_BYTES < 25 * (posts * (counts / docs + 28)) + 12 * J.BUCKET_BYTES
