"""The registered queries over the corpus tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from orderloom.llm import (
    chat, decontaminate, exact_dedup, hard_negatives, importance, mixing, near_dedup, pieces, pii, suffix_dedup, topk,
    toxicity, warc)
from orderloom.llm.common import read_table

# The public vocabularies lie here; only the driver reads them.
TOKENIZERS = "/opt/tokenizers"
PIECES = "piece_bpe_32k.model"

Query = Callable[[SparkSession, str], DataFrame]
_queries: dict[str, Query] = {}


def query(run: Query) -> Query:
    _queries[run.__name__] = run
    return run


def llm_queries() -> dict[str, Query]:
    return dict(_queries)


def llm_oracles() -> dict[str, str]:
    return {"op2_chat": chat.ORACLE, "op4_warc": warc.ORACLE, "op5_top_k": topk.ORACLE,
            "op6_exact_dedup": exact_dedup.ORACLE, "op8_source_mix": mixing.ORACLE, "op10_pii": pii.ORACLE,
            "op11_importance": importance.ORACLE, "op12_hard_negatives": hard_negatives.ORACLE,
            "op13_decontamination": decontaminate.ORACLE}


@query
def op6_exact_dedup(spark: SparkSession, directory: str) -> DataFrame:
    return exact_dedup.exact_duplicates(read_table(spark, directory, "documents"))


@query
def op8_source_mix(spark: SparkSession, directory: str) -> DataFrame:
    return mixing.mix_plan(read_table(spark, directory, "documents")).drop("copies")


@query
def op10_pii(spark: SparkSession, directory: str) -> DataFrame:
    return pii.pii_digest(read_table(spark, directory, "documents"))


@query
def op1_near_dedup(spark: SparkSession, directory: str) -> DataFrame:
    return near_dedup.near_duplicates(read_table(spark, directory, "documents"), size=2)


@query
def op2_chat(spark: SparkSession, directory: str) -> DataFrame:
    turns = chat.with_hostile(read_table(spark, directory, "conversations"))
    return chat.read_back(chat.format_conversations(turns))


@query
def op3_pieces(spark: SparkSession, directory: str) -> DataFrame:
    vocabulary = pieces.load_vocabulary(f"{TOKENIZERS}/{PIECES}")
    return pieces.encoding_digest(read_table(spark, directory, "documents"), vocabulary)


@query
def op4_warc(spark: SparkSession, directory: str) -> DataFrame:
    return warc.archive_digest(read_table(spark, directory, "pages"))


@query
def op5_top_k(spark: SparkSession, directory: str) -> DataFrame:
    return topk.top_k(read_table(spark, directory, "embeddings"))


@query
def op7_toxicity(spark: SparkSession, directory: str) -> DataFrame:
    return toxicity.toxicity(read_table(spark, directory, "documents"), read_table(spark, directory, "labels"))


@query
def op9_repeated_passages(spark: SparkSession, directory: str) -> DataFrame:
    return suffix_dedup.passage_digest(read_table(spark, directory, "documents"))


@query
def op11_importance(spark: SparkSession, directory: str) -> DataFrame:
    target = read_table(spark, directory, "benchmark")
    return importance.importance(read_table(spark, directory, "documents"), target).drop("n_words")


@query
def op12_hard_negatives(spark: SparkSession, directory: str) -> DataFrame:
    return hard_negatives.hard_negatives(read_table(spark, directory, "embeddings"))


@query
def op13_decontamination(spark: SparkSession, directory: str) -> DataFrame:
    return decontaminate.hit_digest(decontaminate.benchmark_hits(
        read_table(spark, directory, "documents"), read_table(spark, directory, "benchmark")))
