"""Near-duplicate documents by SimHash, linked through a segment-popcount grid.

A 64-bit fingerprint is mapped to the bit counts of its 32 two-bit segments. The Manhattan distance of two such
vectors never exceeds the Hamming distance of the fingerprints, so a range join on the grid of bit counts finds
every pair within the radius. With radius 4 and the vector cut into 8 blocks, a pair differs in at most 4 blocks:
it meets in a grid cell made of 4 whole blocks. Each fingerprint visits its C(8, 4) = 70 cells; inside a cell pairs
are first held against the Manhattan bound and then verified on the bits.

A cell emits a spanning forest of its verified links, never all pairs. A cell with more than ``CELL`` members is
handed to a second pass that deals its members to blocks and compares every pair of blocks, so no task holds an
unbounded group and no link is lost.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from lossgrid.llm.common import batches, by_key, columns, components, lower_words, shingle_spans, written

RADIUS, BLOCKS, SHINGLE, SEED = 4, 8, 4, 42
#: Members of one grid cell that a task compares directly.
CELL = 4096
_POPCOUNT = np.array([bin(i).count("1") for i in range(1 << 16)], np.uint8)


def simhash(text: str | None, size: int = SHINGLE) -> int:
    """Fingerprint as a signed 64-bit integer; a bit is 1 if set in over half of the shingle hashes, none give zero."""
    joined, starts, ends = shingle_spans(lower_words(text), size)
    if not starts:
        return 0
    digest = xxhash.xxh64_intdigest
    return voted(np.fromiter((digest(joined[s:e], SEED) for s, e in zip(starts, ends)), np.uint64, len(starts)))


def voted(hashes: np.ndarray) -> int:
    """The fingerprint of shingle hashes; none give zero."""
    votes = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        part = hashes[at : at + (1 << 16)]
        votes += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = (2 * votes > len(hashes)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view(np.int64)[0])


def fingerprints(docs: DataFrame, size: int = SHINGLE) -> DataFrame:
    """(doc_id, fp) per row. Null and empty texts get zero; repeated rows stay repeated."""

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts in batches(rows, ["doc_id", "text"]):
            yield pa.record_batch({"doc_id": pa.array(ids, pa.int64()), "fp": pa.array([simhash(t, size) for t in texts], pa.int64())})

    return docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")).mapInArrow(run, "doc_id bigint, fp bigint")


def _distance(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    x = (a ^ b).view(np.uint16).reshape(-1, 4)
    return _POPCOUNT[x].sum(axis=1)


def _segment_counts(fp: np.ndarray) -> np.ndarray:
    """Bit counts of the 32 two-bit segments, two bits each, packed in one integer."""
    low = np.uint64(0x5555555555555555)
    return (fp & low) + ((fp >> np.uint64(1)) & low)


def _bound(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Manhattan distance of two packed vectors of segment counts: in each segment the greater minus the lesser."""
    total = np.zeros(len(a), np.int64)
    three = np.uint64(3)
    for s in range(0, 64, 2):
        x, y = ((a >> np.uint64(s)) & three).astype(np.int8), ((b >> np.uint64(s)) & three).astype(np.int8)
        total += np.abs(x - y)
    return total


def _near(a: np.ndarray, b: np.ndarray, radius: int) -> np.ndarray:
    """Which pairs are within the radius: the Manhattan bound first, the bits of those that pass it."""
    found = _bound(_segment_counts(a), _segment_counts(b)) <= radius
    found[found] = _distance(a[found], b[found]) <= radius
    return found


def _forest(fps: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """A spanning forest of the links among fingerprints: each one looks once at those not reached yet."""
    left, edges = fps.copy(), []
    while len(left):
        queue, left = [left[0]], left[1:]
        while queue and len(left):
            seed = queue.pop()
            hit = _distance(left, np.full(len(left), seed)) <= radius
            if hit.any():
                edges += [(int(seed), int(x)) for x in left[hit]]
                queue += list(left[hit])
                left = left[~hit]
    return edges


def _links(cells: np.ndarray, fps: np.ndarray, radius: int) -> list[np.ndarray]:
    """Links inside sorted cells: short cells by comparing neighbours 1, 2, ... apart, long ones by a forest."""
    starts = np.flatnonzero(np.concatenate(([True], cells[1:] != cells[:-1])))
    sizes = np.diff(np.append(starts, len(cells)))
    found = []
    for s, n in zip(starts[sizes > 16], sizes[sizes > 16]):
        found += [np.array(e, np.uint64) for e in [[(np.uint64(a), np.uint64(b)) for a, b in _forest(fps[s : s + n], radius)]] if e]
    keep = np.repeat(sizes <= 16, sizes)
    cells, fps = cells[keep], fps[keep]
    for gap in range(1, 16):
        if len(cells) <= gap:
            break
        i = np.flatnonzero(cells[gap:] == cells[:-gap])
        if not len(i):
            break
        i = i[_near(fps[i], fps[i + gap], radius)]
        if len(i):
            found.append(np.stack([fps[i], fps[i + gap]], axis=1))
    return found


def _cell_links(radius: int, limit: int | None):
    """Over rows sorted by cell: links (a, b) with cell null, and the rows of cells above ``limit`` as (fp, fp, cell)."""

    def out(links: list[np.ndarray], spilled: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
        pairs = np.unique(np.concatenate(links), axis=0) if links else np.zeros((0, 2), np.uint64)
        fps = np.concatenate([f for _, f in spilled]) if spilled else np.zeros(0, np.uint64)
        cells = np.concatenate([c for c, _ in spilled]) if spilled else np.zeros(0, np.int64)
        a, b = np.concatenate([pairs[:, 0], fps]), np.concatenate([pairs[:, 1], fps])
        mask = np.concatenate([np.ones(len(pairs), bool), np.zeros(len(fps), bool)])
        cell = pa.array(np.concatenate([np.zeros(len(pairs), np.int64), cells]), pa.int64(), mask=mask)
        return pa.record_batch({"a": pa.array(a.view(np.int64)), "b": pa.array(b.view(np.int64)), "cell": cell})

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells, fps = np.zeros(0, np.int64), np.zeros(0, np.uint64)
        open_cell = None  # a cell already found to be above the limit
        for batch in itertools.chain(rows, [None]):
            links, spilled = [], []
            if batch is not None:
                cells = np.concatenate([cells, batch.column("cell").to_numpy()])
                fps = np.concatenate([fps, batch.column("fp").to_numpy().view(np.uint64)])
                if len(cells) < 1 << 15:
                    continue
            done = len(cells) if batch is None else int(np.searchsorted(cells, cells[-1]))
            if limit is not None and done == 0 and len(cells) > limit:
                open_cell, done = cells[-1], len(cells)
            ready, at = cells[:done], fps[:done]
            cells, fps = cells[done:], fps[done:]
            if limit is not None and len(ready):
                _, index, sizes = np.unique(ready, return_inverse=True, return_counts=True)
                large = sizes[index] > limit
                if open_cell is not None:
                    large |= ready == open_cell
                    if ready[-1] != open_cell:
                        open_cell = None
                if large.any():
                    spilled.append((ready[large], at[large]))
                    ready, at = ready[~large], at[~large]
            if len(ready):
                links = _links(ready, at, radius)
            if links or spilled:
                yield out(links, spilled)

    return run


def _cells(classes: DataFrame, radius: int, blocks: int) -> DataFrame:
    """(cell, fp): the grid cells of every fingerprint, one for each choice of ``blocks - radius`` whole blocks."""
    width = 64 // blocks
    low = 0x5555555555555555  # of each segment; its count is 1 if its bits differ and 2 if both are set
    counts = F.expr(f"((fp ^ shiftrightunsigned(fp, 1)) & {low}) | shiftleft(fp & shiftrightunsigned(fp, 1) & {low}, 1)")
    chosen = []
    for k, subset in enumerate(itertools.combinations(range(blocks), blocks - radius)):
        mask = sum(((1 << width) - 1) << (b * width) for b in subset)
        mask -= (mask >> 63) << 64
        chosen.append(F.xxhash64(F.lit(k), F.col("counts").bitwiseAND(F.lit(mask))))
    return classes.select("fp", counts.alias("counts")).select("fp", F.explode(F.array(*chosen)).alias("cell"))


def links(classes: DataFrame, radius: int = RADIUS, blocks: int = BLOCKS, limit: int = CELL) -> DataFrame:
    """Links (a, b) that connect exactly the fingerprints (column fp, distinct) within ``radius`` bits of each other."""
    schema = "a bigint, b bigint, cell bigint"
    dealt = _cells(classes, radius, blocks).repartition("cell").sortWithinPartitions("cell")
    first = written(dealt.mapInArrow(_cell_links(radius, limit), schema))
    large = first.where("cell is not null").select("cell", F.col("a").alias("fp"))
    sizes = large.groupBy("cell").agg(F.ceil(F.count("*") / limit).cast("int").alias("parts"))
    own = F.expr("pmod(xxhash64(fp, 7), parts)")
    pairs = (
        large.join(sizes, "cell").withColumn("own", own).withColumn("other", F.explode(F.expr("sequence(0, parts - 1)")))
        .select("fp", F.xxhash64("cell", F.least("own", "other"), F.greatest("own", "other")).alias("cell"))
    )
    second = pairs.repartition("cell").sortWithinPartitions("cell").mapInArrow(_cell_links(radius, None), schema)
    return first.where("cell is null").select("a", "b").unionAll(second.select("a", "b"))


def near_duplicates(docs: DataFrame, radius: int = RADIUS, size: int = SHINGLE) -> DataFrame:
    """(doc_id, fp, component_id) for every row of ``docs``, which needs doc_id and text.

    component_id is the smallest doc_id reached over links of at most ``radius`` differing bits. Null texts count as
    empty. Rows without doc_id keep a null id and take part; a component of only such rows has a null component_id.
    """
    marked = written(fingerprints(docs, size))
    classes = written(marked.groupBy("fp").agg(F.min("doc_id").alias("least")))
    roots = components(links(classes, radius))
    named = classes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    named = written(named)
    least = named.groupBy("root").agg(F.min("least").alias("component_id"))
    return marked.join(named.join(least, "root").select("fp", "component_id"), "fp").select("doc_id", "fp", "component_id")


def op8(docs: DataFrame) -> DataFrame:
    """Fingerprint and component of every row.

    Null texts and texts without words have the fingerprint zero, which is linked like any other. Rows without doc_id take
    part and have the component of the ids they reach, if any; repeated rows have one fingerprint. No rows give no rows.
    """
    hexed = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return near_duplicates(docs).select("doc_id", hexed.alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, radius: int = RADIUS, size: int = SHINGLE) -> DataFrame:
    """One document of each group of near-duplicates by SimHash, as ``one_of_each`` chooses it."""
    return one_of_each(docs, near_duplicates(docs, radius, size))


def one_of_each(docs: DataFrame, groups: DataFrame) -> DataFrame:
    """One document of each group (doc_id, component_id), with all columns: the longest text, ties to the smallest doc_id.

    Of rows with one doc_id one stays. Rows without doc_id cannot be told apart by it: they all stay. Documents without
    words form one group, as their fingerprints are equal.
    """
    lengths = docs.select("doc_id", F.coalesce(F.length("text"), F.lit(0)).alias("_length")).where("doc_id is not null")
    marked = written(groups.where("doc_id is not null").select("doc_id", "component_id").distinct())
    sized = marked.join(lengths.groupBy("doc_id").agg(F.max("_length").alias("_length")), "doc_id")
    best = sized.groupBy("component_id").agg(F.max_by("doc_id", F.struct("_length", -F.col("doc_id"))).alias("_kept"))
    stays = best.select(F.col("_kept").alias("doc_id"))
    drop = written(marked.select("doc_id").distinct().join(stays, "doc_id", "left_anti"))  # by id, so that a large group is no key
    left = docs.join(by_key(drop), "doc_id", "left_anti").select(*columns(docs))
    repeated = written(lengths.groupBy("doc_id").count().where("count > 1").select("doc_id"))
    if repeated.isEmpty():
        return left
    once = left.join(repeated, "doc_id", "left_semi").dropDuplicates(["doc_id"])
    return left.join(repeated, "doc_id", "left_anti").unionByName(once)
