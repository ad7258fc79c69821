"""Packing with common sources and clusters: the same bins as a plain search, in time that grows with the pieces."""

import time

import numpy as np
import pytest

from lossgrid.llm import packing


def plain(lengths, clusters, sources, capacity, per_source):
    """Every bin is looked at for every piece."""
    bins, placed = [], []
    for length, cluster, source in zip(lengths, clusters, sources):
        fits = [(left, i) for i, (left, held, taken) in enumerate(bins) if left >= length and (cluster < 0 or cluster not in held) and taken.count(source) < per_source]
        if fits:
            i = min(fits)[1]
        else:
            i = len(bins)
            bins.append([capacity, set(), []])
        placed.append((i, capacity - bins[i][0]))
        bins[i][0] -= length
        bins[i][1].add(cluster)
        bins[i][2].append(source)
    return placed


@pytest.mark.parametrize("kind", ["one source", "two sources", "hot source", "hot cluster", "both", "many sources", "tiny"])
def test_bins_equal_a_plain_search(kind):
    rng = np.random.default_rng(len(kind))
    n = 5 if kind == "tiny" else 700
    sources = {"one source": np.zeros(n, int), "two sources": rng.integers(0, 2, n), "many sources": rng.integers(0, 60, n)}.get(kind, np.where(rng.random(n) < 0.4, 0, rng.integers(1, 30, n)))
    clusters = np.where(rng.random(n) < 0.3, 7, -1) if kind in ("hot cluster", "both") else np.where(rng.random(n) < 0.2, rng.integers(0, 40, n), -1)
    for lengths in (np.sort(rng.integers(1, 500, n))[::-1], np.sort(rng.integers(1, 20, n))[::-1], np.full(n, 64)):
        args = (lengths.tolist(), clusters.tolist(), sources.tolist(), 512, 2)
        assert packing.best_fit(*args) == plain(*args)


@pytest.mark.parametrize("share", [1.0, 0.4])
def test_a_common_source_costs_no_walk(share):
    rng = np.random.default_rng(1)

    def seconds(n):
        lengths = np.sort(rng.integers(1, 60, n))[::-1].tolist()
        sources = np.where(rng.random(n) < share, 0, rng.integers(1, 2000, n)).tolist()
        start = time.process_time()
        packing.best_fit(lengths, [-1] * n, sources, 2048, 2)
        return time.process_time() - start

    seconds(2000)
    assert seconds(40_000) < 30 * max(seconds(4_000), 0.01)


def test_one_source_in_a_table(spark):
    docs = spark.createDataFrame([(i, "word " * (1 + i % 9) + f"w{i}", "s", 0) for i in range(600)], "doc_id bigint, text string, source string, n_chars int")
    rows = packing.op4(docs).collect()
    assert len(rows) == 600 and max(sum(r.bin_id == b for r in rows) for b in {r.bin_id for r in rows}) == 2
