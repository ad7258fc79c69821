"""From documents to packed training sequences, one operator per stage.

All stages but the last return the columns of their input. Null and empty texts pass: they hold no toxic word and no line, form
one group of documents without words of which one stays, take no words of the mix and are packed into no bin. Rows without
doc_id cannot be told apart by it: they are never dropped as near-duplicates and stay once in the mix. Repeated rows are judged
alike by the first two stages; of rows with one doc_id near-dedup keeps one. No documents give no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lossgrid.llm import likeness, lines, mixing, packing, simhash, toxicity
from lossgrid.llm.common import table, written


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.keep_clean(docs, table(spark, sf_dir, "labels"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return lines.dedup_lines(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.one_of_each(docs, likeness.near_duplicates(docs))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.op4(docs)


STAGES = [("toxicity", clean), ("line_dedup", line_dedup), ("near_dedup", near_dedup), ("mixture", mixture), ("packing", packed)]

#: The first stage is a learned classifier, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
