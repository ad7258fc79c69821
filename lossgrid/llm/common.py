"""Helpers the operators of this subpackage share."""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from lossgrid.session import configure, materialise

#: Rows of one Arrow batch; texts may be long, so batches are kept short.
ARROW_ROWS = 1000
#: White space that separates words, as a pattern class.
SPACE = r"\x20\x09-\x0D"


def prepared(spark: SparkSession) -> SparkSession:
    """The session with the settings the operators are written for."""
    configure(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepared(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame) -> DataFrame:
    """Write to the shared folder and read back: cuts lineage, and work that several branches need runs once."""
    return materialise(df)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """The names, with underscores before them until no column of ``df`` has them."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        out.append(name)
    return out


def columns(df: DataFrame) -> list[Column]:
    """All columns, whatever their names hold."""
    return [F.col("`" + c.replace("`", "``") + "`") for c in df.columns]


def by_key(small: DataFrame) -> DataFrame:
    """The frame marked so that a join with texts always goes by key: the plan, and what moves, is the same at every size."""
    return small.hint("merge")


def parallelism(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def words(text: str | None) -> list[bytes]:
    """Words of a text as UTF-8: ``bytes.split`` cuts at exactly space and the characters 9 to 13."""
    return (text or "").encode("utf-8", "replace").split()


def lower_words(text: str | None) -> list[bytes]:
    """Words with A to Z lower-cased; other letters stay."""
    return (text or "").encode("utf-8", "replace").lower().split()


def fold(doc_id: int | None, parts: int) -> int:
    """crc32 of the id as decimal text, modulo ``parts``; a null id counts as empty text."""
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % parts


def fold_column(doc_id: Column, parts: int) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % parts


def shingle_spans(tokens: list[bytes], size: int) -> tuple[bytes, list[int], list[int]]:
    """The words joined by single spaces, and where each run of ``size`` words starts and ends in it.

    Fewer words give one run with all of them; no words give none.
    """
    joined = b" ".join(tokens)
    if not tokens:
        return joined, [], []
    ends = np.cumsum(np.fromiter(map(len, tokens), np.int64, len(tokens)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    count = max(1, len(tokens) - size + 1)
    return joined, starts[:count].tolist(), ends[min(size, len(tokens)) - 1 :].tolist()


def batches(rows: Iterator[pa.RecordBatch], columns: list[str]) -> Iterable[list[list]]:
    """The named columns of each batch that has rows, as Python lists."""
    for batch in rows:
        if batch.num_rows:
            yield [batch.column(c).to_pylist() for c in columns]


def pooled(rows: Iterator[pa.RecordBatch], least: int) -> Iterator[pa.RecordBatch]:
    """Batches of at least ``least`` rows, but for the last one; for rows of bounded size."""
    held: list[pa.RecordBatch] = []
    for batch in rows:
        held.append(batch)
        if sum(b.num_rows for b in held) >= least:
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            held = []
    if any(b.num_rows for b in held):
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def components(edges: DataFrame) -> DataFrame:
    """Connected components of edges (a, b): one row (node, root) per node, root the smallest node reached.

    Large-star and small-star rounds, each written to the shared folder; a hub with many edges only takes part
    in partial minima and in joins that Spark splits when they are skewed. Nodes must not be null.
    """
    links = written(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    last = None
    while True:
        both = links.unionAll(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least("a", F.min("b")).alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        large = written(large)
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        joined = large.join(least, "a")
        small = joined.select("b", "m").where("b <> m").select(F.greatest("b", "m").alias("a"), F.least("b", "m").alias("b"))
        links = written(small.unionAll(least.select("a", F.col("m").alias("b"))).distinct())
        state = links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == last:
            break
        last = state
    roots = links.groupBy("a").agg(F.min("b").alias("root")).withColumnRenamed("a", "node")
    return roots.unionAll(links.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
