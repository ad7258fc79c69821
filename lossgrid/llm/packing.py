"""Best-fit packing of documents into sequences of fixed length, under conflicts.

Pieces go longest first into the fullest bin that still holds them. Bins are ordered by what is left in them and carry
a bitmap of their duplicate clusters and bitmaps of their sources, one for each document a source may have in a bin. The
search goes from the tightest bin to its successors until one is compatible, and opens a new bin if there is none. The
corpus is dealt to shards of about ``SHARD`` words by a hash of the document, and each shard is packed by one task.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections import Counter

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from lossgrid.llm.common import SPACE, written

CAPACITY, PER_SOURCE = 2048, 2
#: Words in a shard: what one task packs.
SHARD = 4_000_000
#: A source or cluster of one piece in so many is common.
OFTEN = 8


def _codes(values: pd.Series, shared: bool) -> list[int]:
    """Small numbers for values; with ``shared``, values that occur once get -1: they conflict with nothing."""
    codes, _ = pd.factorize(values, use_na_sentinel=False)
    if not shared:
        return codes.tolist()
    counts = pd.Series(codes).map(pd.Series(codes).value_counts())
    kept, _ = pd.factorize(pd.Series(codes).where(counts > 1), use_na_sentinel=True)
    return kept.tolist()


def _common(values: list[int]) -> set[int]:
    """Values that at least one in ``1 / OFTEN`` has: at most that many."""
    counts = Counter(v for v in values if v >= 0)
    return {v for v, n in counts.items() if n * OFTEN >= len(values)}


def best_fit(lengths: list[int], clusters: list[int], sources: list[int], capacity: int, per_source: int) -> list[tuple[int, int]]:
    """(bin, start) of each piece, taken in the given order: the tightest compatible bin, the oldest on ties.

    A common source or cluster would make the search pass one bin after another that is closed to it. So open bins are kept
    in one residual-ordered list for each set of common sources and clusters they are closed to: a piece looks only into
    lists open to it, and in these passes bins for rare conflicts alone.
    """
    bits = {("source", s): 1 << i for i, s in enumerate(sorted(_common(sources)))}
    bits |= {("cluster", c): 1 << (len(bits) + i) for i, c in enumerate(sorted(_common(clusters)))}
    free: dict[int, list[tuple[int, int]]] = {}  # closed to these -> (words left, bin), ordered
    closed: list[int] = []
    cluster_bits: list[int] = []
    source_bits: list[list[int]] = []
    placed = []
    for length, cluster, source in zip(lengths, clusters, sources):
        cluster_bit, source_bit = 1 << cluster if cluster >= 0 else 0, 1 << source
        common_source, common_cluster = bits.get(("source", source), 0), bits.get(("cluster", cluster), 0)
        own, best, home, place = common_source | common_cluster, None, 0, 0
        for state, bins in free.items():
            if state & own:
                continue
            at = bisect_left(bins, (length, -1))
            while at < len(bins) and (best is None or bins[at] < best):
                chosen = bins[at][1]
                if cluster_bits[chosen] & cluster_bit or source_bits[chosen][-1] & source_bit:
                    at += 1
                    continue
                best, home, place = bins[at], state, at
                break
        if best is not None:
            left, chosen = free[home].pop(place)
            if not free[home]:
                del free[home]
        else:
            left, chosen = capacity, len(cluster_bits)
            cluster_bits.append(0)
            source_bits.append([0] * per_source)
            closed.append(0)
        placed.append((chosen, capacity - left))
        cluster_bits[chosen] |= cluster_bit
        levels = source_bits[chosen]
        level = next(k for k, taken in enumerate(levels) if not taken & source_bit)
        levels[level] |= source_bit
        closed[chosen] |= common_cluster | (common_source if level == per_source - 1 else 0)
        if left > length:
            insort(free.setdefault(closed[chosen], []), (left - length, chosen))
    return placed


def pack(pieces: DataFrame, capacity: int = CAPACITY, per_source: int = PER_SOURCE, shard: int = SHARD) -> DataFrame:
    """(doc_id, copy, piece, bin_id, start, length) of documents (doc_id, copy, source, cluster, length).

    A document longer than ``capacity`` is cut into full pieces, which fill a bin each, and a rest. No bin holds two
    pieces of one cluster, or more than ``per_source`` documents of one source. Null sources are one source; a null
    cluster conflicts with nothing. Documents without words take no room: one row with a null bin_id.
    """
    known = written(pieces.select("doc_id", "copy", "source", "cluster", F.col("length").cast("bigint")))
    total = known.agg(F.sum("length")).first()[0] or 0
    shards = int(total // shard) + 1
    full = F.expr(f"length div {capacity}")
    cut = known.where("length > 0").withColumn("full", full).withColumn("rest", F.expr(f"length % {capacity}"))
    own = F.xxhash64("doc_id", "copy", "cluster")
    whole = cut.where("full > 0").withColumn("piece", F.explode(F.expr("sequence(0, full - 1)"))).select(
        "doc_id", "copy", F.col("piece").cast("bigint"), F.concat_ws("-", F.lit("full"), F.hex(F.xxhash64("doc_id", "copy", "cluster", "source")), F.col("piece").cast("string")).alias("bin_id"), F.lit(0).cast("bigint").alias("start"), F.lit(capacity).cast("bigint").alias("length"))
    rest = cut.where("rest > 0").select("doc_id", "copy", F.col("full").alias("piece"), "source", "cluster", F.col("rest").alias("length"), own.alias("order"), F.expr(f"int(pmod(xxhash64(doc_id, copy, cluster, 3), {shards}))").alias("shard"))

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["length", "order", "doc_id", "copy"], ascending=[False, True, True, True], kind="stable")
        blank = rows["cluster"].isna()
        clusters = [-1 if b else c for b, c in zip(blank, _codes(rows["cluster"], True))]
        found = best_fit(rows["length"].tolist(), clusters, _codes(rows["source"], False), capacity, per_source)
        bins = [f"{s}-{b}" for s, (b, _) in zip(rows["shard"], found)]
        return rows.assign(bin_id=bins, start=[s for _, s in found])[["doc_id", "copy", "piece", "bin_id", "start", "length"]]

    packed = rest.groupBy("shard").applyInPandas(run, "doc_id bigint, copy bigint, piece bigint, bin_id string, start bigint, length bigint")
    empty = known.where("coalesce(length, 0) <= 0").select("doc_id", "copy", F.lit(0).cast("bigint").alias("piece"), F.lit(None).cast("string").alias("bin_id"), F.lit(0).cast("bigint").alias("start"), F.lit(0).cast("bigint").alias("length"))
    return packed.unionByName(whole).unionByName(empty)


def measured(docs: DataFrame) -> DataFrame:
    """Length in words, and the cluster of texts that are equal but for case and white space. Repeated rows are numbered."""
    length = F.coalesce(F.regexp_count("text", F.lit(f"[^{SPACE}]+")), F.lit(0))
    plain = F.trim(F.regexp_replace(F.lower("text"), f"[{SPACE}]+", " "))
    cluster = F.when(F.col("text").isNotNull(), F.xxhash64(plain))
    return docs.select("doc_id", "source", length.cast("bigint").alias("length"), cluster.alias("cluster")).groupBy("doc_id", "source", "length", "cluster").agg(F.count("*").alias("n")).withColumn("copy", F.explode(F.expr("sequence(0, n - 1)"))).drop("n")


def op4(docs: DataFrame) -> DataFrame:
    """Bins of every row, as ``pack`` gives them.

    Null texts and texts without words have a row with a null bin_id. A null source is one source. Repeated rows are copies
    of one cluster and lie in bins of their own. Equal lengths go by a hash, then by doc_id. No rows give no rows.
    """
    return pack(measured(docs))
