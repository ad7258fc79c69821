"""Mixing sources to target weights by fitting each source's budget exactly.

Documents are counted by exact length. A source takes every document as often as its budget holds the whole source,
and for the rest of the budget a number of documents of each length: the same share of every length, then a bounded
knapsack over what is left. Which documents of a length are taken follows a seeded hash.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from lossgrid.llm.common import SPACE, by_key, columns, fresh, written

WEIGHTS, CAP, SEED = (5.0, 2.0, 1.0), 3, 11
#: Budget in words that the knapsack table covers; more is first filled with the longest documents.
TABLE = 1 << 15
#: Documents of one source and length that are ranked together.
RANKED = 1000


def targets(sizes: list[tuple[object, int]], weights: tuple[float, ...] = WEIGHTS, cap: float = CAP) -> list[float]:
    """Shares of the sum of all sizes by weight; none above ``cap`` times its source, the excess dealt again by weight.

    ``weights`` repeat over the sources in the order given. Sources without words get nothing.
    """
    total = sum(n for _, n in sizes)
    weight = [weights[i % len(weights)] for i in range(len(sizes))]
    found, open_ = [0.0] * len(sizes), [i for i, (_, n) in enumerate(sizes) if n]
    left = float(total)
    while open_:
        unit = left / sum(weight[i] for i in open_)
        full = [i for i in open_ if weight[i] * unit > cap * sizes[i][1]]
        if not full:
            for i in open_:
                found[i] = weight[i] * unit
            break
        for i in full:
            found[i] = float(cap * sizes[i][1])
            left -= found[i]
        open_ = [i for i in open_ if i not in set(full)]
    return found


def fit(counts: dict[int, int], budget: int) -> dict[int, int]:
    """How many documents of each length to take so that their lengths add up to ``budget``, or come nearest to it."""
    total = sum(n * c for n, c in counts.items())
    budget = max(0, min(budget, total))
    even = max(0, budget - TABLE // 2)  # what is left keeps the knapsack room to be exact
    taken = {n: c * even // total if total else 0 for n, c in counts.items()}
    left = budget - sum(n * c for n, c in taken.items())
    free = {n: c - taken[n] for n, c in counts.items() if n}
    for n in sorted(free, reverse=True):
        if left - n < TABLE:
            continue
        more = min(free[n], (left - TABLE) // n)
        taken[n], free[n], left = taken[n] + more, free[n] - more, left - more * n
    reach, steps, wanted = 1, [], 1 << left
    top = (1 << (2 * left + 1)) - 1  # sums up to as far above as below
    for n in sorted(free):
        many, part = min(free[n], 2 * left // n), 1
        while many and not reach & wanted:
            part = min(part, many)
            steps.append((n, part, reach))
            reach |= reach << (n * part) & top
            many, part = many - part, part * 2
        if reach & wanted:
            break
    at = left
    for away in range(left + 1):
        if reach >> (left - away) & 1:
            at = left - away
            break
        if reach >> (left + away) & 1:
            at = left + away
            break
    for n, part, before in reversed(steps):
        if not before >> at & 1:
            taken[n], at = taken[n] + part, at - n * part
    return taken


def _plan(rows: pd.DataFrame) -> pd.DataFrame:
    """One source: how often it is taken whole, and how many documents of each length besides."""
    counts = dict(zip(rows["size"].tolist(), rows["documents"].tolist()))
    whole, budget = sum(n * c for n, c in counts.items()), int(round(rows["target"].iloc[0]))
    times = budget // whole if whole else 0
    taken = fit(counts, budget - times * whole)
    return rows.assign(times=times, more=[taken[n] for n in rows["size"]])[["source_no", "size", "documents", "times", "more"]]


def measured(docs: DataFrame) -> DataFrame:
    """(doc_id, source, size, order): size is the number of words, null texts have none; order is the seeded hash."""
    size = F.coalesce(F.regexp_count("text", F.lit(f"[^{SPACE}]+")).cast("bigint"), F.lit(0).cast("bigint"))
    return docs.select("doc_id", "source", size.alias("size"), F.xxhash64(F.lit(SEED), "doc_id", "text").alias("order"))


def mix(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """(doc_id, size, source_size, target, taken, copies) for every row of ``docs`` (doc_id, text, source).

    Sources are weighed in order of code point, null last. Empty documents take no words. Equal rows are told apart
    arbitrarily, which no column shows. The table of sources, one number each, passes through the driver; histograms
    stay distributed.
    """
    spark = docs.sparkSession
    sized = written(measured(docs))
    sizes = sized.groupBy("source").agg(F.sum("size").alias("n")).collect()
    sizes = sorted(((r["source"], int(r["n"])) for r in sizes), key=lambda x: (x[0] is None, x[0] or ""))
    table = [(i, s, n, t) for i, ((s, n), t) in enumerate(zip(sizes, targets(sizes, weights, cap)))]
    sources = spark.createDataFrame(table, "source_no int, source string, source_size bigint, target double")
    rows = sized.join(sources.withColumnRenamed("source", "_source"), F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    histogram = rows.groupBy("source_no", "size").agg(F.count("*").alias("documents"), F.first("target").alias("target"))
    plan = written(histogram.groupBy("source_no").applyInPandas(_plan, "source_no int, size bigint, documents bigint, times bigint, more bigint"))

    # the documents of a length are cut at the hash bucket where their number is reached
    bucket = F.expr(f"pmod(`order`, greatest(1, documents div {RANKED}))")
    cut_here = plan.where("more > 0 and more < documents")
    counts = rows.join(cut_here, ["source_no", "size"]).groupBy("source_no", "size", bucket.alias("bucket")).agg(F.count("*").alias("n"), F.first("more").alias("more"))
    upto = F.sum("n").over(Window.partitionBy("source_no", "size").orderBy("bucket"))
    cuts = counts.withColumn("upto", upto).where("upto >= more and upto - n < more").select("source_no", "size", F.col("bucket").alias("cut"), (F.expr("more - upto + n")).alias("wanted"))
    planned = plan.join(cuts, ["source_no", "size"], "left")
    placed = rows.join(planned, ["source_no", "size"]).withColumn("bucket", bucket)
    inside = placed.where("bucket = cut")
    rank = F.row_number().over(Window.partitionBy("source_no", "size").orderBy("order", "doc_id"))
    names = ["doc_id", "size", "source_size", "target", "copies"]
    ranked = inside.withColumn("copies", F.col("times") + (rank <= F.col("wanted")).cast("bigint")).select(*names)
    sure = placed.where("cut is null or bucket <> cut").withColumn(
        "copies", F.col("times") + F.expr("case when more = 0 then 0 when cut is null or bucket < cut then 1 else 0 end")).select(*names)
    return sure.unionByName(ranked).withColumn("taken", F.col("copies") * F.col("size"))


def op2(docs: DataFrame) -> DataFrame:
    """Size, source and words taken of every row.

    Null and empty texts have size 0 and take nothing; a null source is a source of its own and comes last. Ties of size are
    broken by a seeded hash of the row; repeated rows each get what the rule gives their hash. No rows give no rows.
    """
    return mix(docs).select("doc_id", "size", "source_size", "target", "taken", "copies")


def mixed(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """The documents of the mix, each as often as it is taken, with all columns.

    Empty documents take no words and stay once. Rows without doc_id cannot be addressed and stay once.
    """
    copies, size, copy = fresh(docs, "_copies", "_size", "_copy")
    found = mix(docs, weights, cap).where("doc_id is not null").groupBy("doc_id").agg(F.max("copies").alias(copies), F.max("size").alias(size))
    times = F.when(F.col(copies).isNull() | (F.col(size) == 0), 1).otherwise(F.col(copies)).cast("int")
    return docs.join(by_key(found), "doc_id", "left").withColumn(copy, F.explode(F.array_repeat(F.lit(0), times))).select(*columns(docs))
