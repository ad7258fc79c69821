"""The queries of this subpackage and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lossgrid.llm import drift, lines, lm, mixing, packing, pages, prefixes, simhash, sketch, token_ids, toxicity, transducer, vectors
from lossgrid.llm.common import table


def _tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def _over(name: str, build: Callable[[DataFrame], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: build(table(spark, sf_dir, name))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_token_ids": _over("documents", lambda docs: token_ids.op1(docs, _tokenizer_path())),
    "op2_mixing": _over("documents", mixing.op2),
    "op3_toxicity": lambda spark, sf_dir: toxicity.op3(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")),
    "op4_packing": _over("documents", packing.op4),
    "op5_lm_score": _over("documents", lm.score),
    "op6_sketch": _over("documents", sketch.op6),
    "op7_html": _over("pages", pages.extract),
    "op8_simhash": _over("documents", simhash.op8),
    "op9_line_dedup": _over("documents", lines.op9),
    "op10_ann": _over("embeddings", vectors.op10),
    "op11_token_counts": _over("documents", lambda docs: transducer.token_counts(docs, _tokenizer_path())),
    "op12_clusters": _over("embeddings", drift.op12),
    "op13_prefix_trie": _over("conversations", prefixes.op13),
}

ORACLES: dict[str, str] = {"op9_line_dedup": lines.SQL_OP9, "op12_clusters": drift.SQL_OP12, "op13_prefix_trie": prefixes.SQL_OP13}
