"""Near-duplicate documents by shared runs of words: likeness (Jaccard) of their five-word shingles of 0.8 or more.

Two things propose groups. SimHash fingerprints of the shingles are joined over the segment-popcount grid of ``simhash``,
up to ``RADIUS`` differing bits, which brings very like documents together. At the threshold about ten of 64 bits differ, and
no grid of that radius stays small; so bands of minima of the shingle hashes propose the rest: two documents at the threshold
share none of the ``BANDS`` bands once in about 17,000 pairs, and liker ones far more seldom. Nothing is linked by a
proposal alone: the texts of a proposed group meet in a task, where the shingle sets are compared whole and a spanning
forest of the true links is emitted. A group with more than ``GROUP`` members is dealt to blocks and every pair of blocks is compared, so that no task holds an
unbounded group and no link is lost.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from lossgrid.llm import simhash
from lossgrid.llm.common import batches, by_key, components, lower_words, shingle_spans, written

SHINGLE, LIKE, SEED = 5, 0.8, 42
#: Differing bits up to which fingerprints are joined; a grid cell is then three of the eight blocks.
RADIUS = 5
#: Bands, and minima in each of them.
BANDS, ROWS = 32, 6
#: Members of a proposed group that a task compares directly.
GROUP = 512
_FACTORS = np.random.default_rng(SEED).integers(0, 1 << 63, BANDS * ROWS, np.uint64) * np.uint64(2) + np.uint64(1)


def shingles(text: str | None, size: int = SHINGLE) -> np.ndarray:
    """The distinct shingle hashes of a text in rising order; none without words."""
    joined, starts, ends = shingle_spans(lower_words(text), size)
    digest = xxhash.xxh64_intdigest
    return np.unique(np.fromiter((digest(joined[s:e], SEED) for s, e in zip(starts, ends)), np.uint64, len(starts)))


def bands(hashes: np.ndarray) -> np.ndarray:
    """One number per band from its minima; a minimum is that of the hashes times the factor of its place."""
    least = np.full(len(_FACTORS), np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(hashes), 1024):
        least = np.minimum(least, (hashes[at : at + 1024, None] * _FACTORS).min(axis=0))
    digest = xxhash.xxh64_intdigest
    return np.array([digest(band.tobytes(), k) for k, band in enumerate(least.reshape(BANDS, ROWS))], np.uint64).view(np.int64)


def marked(docs: DataFrame, size: int = SHINGLE) -> DataFrame:
    """(doc_id, key, node, fp, cells) per row: key is the hash of doc_id and text, node that of the shingle set, fp its SimHash, cells its bands."""

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, keys, texts in batches(rows, ["doc_id", "key", "text"]):
            sets = [shingles(t, size) for t in texts]
            yield pa.record_batch({
                "doc_id": pa.array(ids, pa.int64()), "key": pa.array(keys, pa.int64()),
                "node": pa.array(np.array([xxhash.xxh64_intdigest(s.tobytes()) for s in sets], np.uint64).view(np.int64)),
                "fp": pa.array([simhash.voted(s) for s in sets], pa.int64()), "cells": pa.array([bands(s) if len(s) else [] for s in sets], pa.list_(pa.int64())),
            })

    chosen = docs.select(F.col("doc_id").cast("bigint"), F.xxhash64("doc_id", "text").alias("key"), F.col("text").cast("string"))
    return chosen.mapInArrow(run, "doc_id bigint, key bigint, node bigint, fp bigint, cells array<bigint>")


def gridded(classes: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Edges (a, b) that connect the nodes (node, fp) whose fingerprints the grid links within ``radius`` bits; equal ones too."""
    heads = written(classes.groupBy("fp").agg(F.min("node").alias("head")))
    near = simhash.links(heads.select("fp"), radius)
    same = classes.join(heads, "fp").where("node <> head").select(F.col("node").alias("a"), F.col("head").alias("b"))
    first, second = heads.select(F.col("fp").alias("a"), F.col("head").alias("one")), heads.select(F.col("fp").alias("b"), F.col("head").alias("other"))
    return same.unionAll(near.join(first, "a").join(second, "b").select(F.col("one").alias("a"), F.col("other").alias("b")))


def proposed(classes: DataFrame) -> DataFrame:
    """(node, group): the nodes (node, fp, cells) that the grid or bands connect to others, whatever their likeness."""
    spoken = classes.where("size(cells) > 0")  # the node without words is one and has none like it
    cells = written(spoken.select("node", F.explode("cells").alias("cell")))
    heads = cells.groupBy("cell").agg(F.min("node").alias("head"), F.count("*").alias("n")).where("n > 1").select("cell", "head")
    edges = cells.join(heads, "cell").where("node <> head").select(F.col("node").alias("a"), F.col("head").alias("b"))
    return written(components(gridded(spoken).unionAll(edges)).withColumnRenamed("root", "group"))


def _forest(nodes: np.ndarray, sets: list[np.ndarray], like: float) -> list[tuple[int, int]]:
    """A spanning forest of the links among shingle sets: each one looks once at those not reached yet."""
    sizes = np.array([len(s) for s in sets])
    _, tokens = np.unique(np.concatenate(sets), return_inverse=True)
    starts = np.concatenate(([0], np.cumsum(sizes)[:-1]))
    own = [tokens[s : s + n] for s, n in zip(starts, sizes)]
    mark = np.zeros(tokens.max() + 1, np.int64)
    left, edges = np.arange(1, len(sets)), []
    queue = [0]
    while len(left):
        if not queue:
            queue, left = [int(left[0])], left[1:]
            continue
        seed = queue.pop()
        fits = left[(sizes[left] >= like * sizes[seed] - 1e-9) & (sizes[seed] >= like * sizes[left] - 1e-9)]
        if not len(fits):
            continue
        mark[own[seed]] = 1
        shared = np.add.reduceat(mark[np.concatenate([own[i] for i in fits])], np.concatenate(([0], np.cumsum(sizes[fits])[:-1])))
        mark[own[seed]] = 0
        hit = fits[shared >= like * (sizes[fits] + sizes[seed] - shared) - 1e-9]
        edges += [(int(nodes[seed]), int(nodes[i])) for i in hit]
        queue += hit.tolist()
        left = np.setdiff1d(left, hit, assume_unique=True)
    return edges


def links(texts: DataFrame, size: int = SHINGLE, like: float = LIKE, limit: int = GROUP) -> DataFrame:
    """Links (a, b) that connect exactly the nodes of one group (group, node, text) whose likeness is ``like`` or more."""
    sizes = written(texts.groupBy("group").agg(F.ceil(F.count("*") / limit).cast("int").alias("parts")))
    own = F.expr("pmod(xxhash64(node, 7), parts)")
    dealt = (
        texts.join(by_key(sizes), "group").withColumn("own", own).withColumn("other", F.explode(F.expr("sequence(0, parts - 1)")))
        .select(F.xxhash64("group", F.least("own", "other"), F.greatest("own", "other")).alias("cell"), "node", "text")
    )

    def found(nodes: list[int], sets: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        edges = _forest(np.array(nodes, np.int64), sets, like) if len(nodes) > 1 else []
        if edges:
            yield pa.record_batch({"a": pa.array([a for a, _ in edges], pa.int64()), "b": pa.array([b for _, b in edges], pa.int64())})

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, nodes, sets = None, [], []
        for cells, names, words in batches(rows, ["cell", "node", "text"]):
            for cell, node, text in zip(cells, names, words):
                if cell != at:
                    yield from found(nodes, sets)
                    at, nodes, sets = cell, [], []
                nodes.append(node)
                sets.append(shingles(text, size))
        yield from found(nodes, sets)

    return dealt.repartition("cell").sortWithinPartitions("cell").mapInArrow(run, "a bigint, b bigint")


def near_duplicates(docs: DataFrame, size: int = SHINGLE, like: float = LIKE, limit: int = GROUP) -> DataFrame:
    """(doc_id, component_id) for every row of ``docs``: the smallest doc_id reached over links of at least ``like``.

    Documents with the same shingles are one node; those without words are one too, and those with fewer words than a
    shingle are alike if their words are equal. Rows without doc_id keep a null id and take part.
    """
    rows = written(marked(docs, size))
    classes = written(rows.groupBy("node").agg(F.min("doc_id").alias("least"), F.min("key").alias("key"), F.first("fp").alias("fp"), F.first("cells").alias("cells")))
    wanted = written(proposed(classes.select("node", "fp", "cells")).join(classes.select("node", "key"), "node").select("node", "group", "key"))
    keyed = docs.select(F.xxhash64("doc_id", "text").alias("key"), F.col("text").cast("string").alias("text"))
    texts = written(keyed.join(by_key(wanted), "key").select("group", "node", "text"))
    roots = components(links(texts, size, like, limit))
    named = written(classes.select("node", "least").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node")))
    least = named.groupBy("root").agg(F.min("least").alias("component_id"))
    return rows.select("doc_id", "node").join(named.join(least, "root").select("node", "component_id"), "node").select("doc_id", "component_id")
