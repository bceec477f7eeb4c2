"""The registered queries of the operators, each over its whole table, and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from sluiceway.llm import (
    bpe,
    fingerprints,
    mixing,
    periodic_runs,
    perplexity,
    reply_trees,
    simhash,
    stream_dedup,
    style_tree,
    token_spans,
    toxicity,
    url_rules,
    whitening,
)
from sluiceway.llm.scratch import ship, table

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
BYTE_BPE = public_tokenizers.path("byte_bpe_50k.tiktoken")


def op1_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return fingerprints.edited_pairs(table(spark, folder, "documents"))


def op2_simhash(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, folder, "documents"))
    return found.select("doc_id", simhash.hex_digits().alias("fingerprint"), "component_id")


def op3_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return bpe.digests(table(spark, folder, "documents"), WORD_BPE)


def op4_perplexity(spark: SparkSession, folder: str) -> DataFrame:
    return perplexity.verdicts(table(spark, folder, "documents"))


def op5_url_rules(spark: SparkSession, folder: str) -> DataFrame:
    return url_rules.verdicts(table(spark, folder, "pages"))


def op6_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mixture(table(spark, folder, "documents"))


def op7_token_spans(spark: SparkSession, folder: str) -> DataFrame:
    return token_spans.by_line(table(spark, folder, "documents"), BYTE_BPE, public_tokenizers.PATTERN)


def op8_reply_trees(spark: SparkSession, folder: str) -> DataFrame:
    return reply_trees.digests(table(spark, folder, "conversations"))


def op9_style_tree(spark: SparkSession, folder: str) -> DataFrame:
    return style_tree.extracted(table(spark, folder, "pages"))


def op10_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.predictions(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op11_stream_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return stream_dedup.deduplicated(spark, f"{folder.rstrip('/')}/documents.parquet")


def op12_whitening(spark: SparkSession, folder: str) -> DataFrame:
    return whitening.whitened(table(spark, folder, "embeddings"))


def op13_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    return periodic_runs.periodic(table(spark, folder, "documents"), edit=True)


def _shipped(query: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        ship(spark)
        return query(spark, folder)

    return run


QUERIES = {
    query.__name__: _shipped(query)
    for query in (
        op1_fingerprints, op2_simhash, op3_bpe, op4_perplexity, op5_url_rules, op6_mixing,
        op7_token_spans, op8_reply_trees, op9_style_tree, op10_toxicity, op11_stream_dedup, op12_whitening,
        op13_periodic_runs,
    )
}

ORACLES = {
    "op5_url_rules": url_rules.VERDICTS_SQL,
    "op6_mixing": mixing.MIXTURE_SQL,
    "op8_reply_trees": reply_trees.DIGESTS_SQL,
    "op11_stream_dedup": stream_dedup.KEPT_SQL,
}
