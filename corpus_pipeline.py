"""The corpus pipeline: toxic documents go, then copies, then near copies; sources are mixed, and texts encoded.

Every stage takes a table with doc_id, text and source and columns of any other names, and all but the last give back
rows of it as they are. In all of them a null text counts as empty, long texts are taken as a whole, a null doc_id is
an id like any other, and an empty table gives an empty one.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from orderloom.llm import exact_dedup, mixing, near_dedup, pieces, toxicity
from orderloom.llm.common import read_table
from orderloom.llm.queries import PIECES, TOKENIZERS
from orderloom.session import materialize


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity stays below the threshold, learned from the labelled ones among them.

    Rows that repeat stay or go together. Where the labels are all of one kind, or there are none, all rows stay.
    """
    return toxicity.without_toxic(docs, read_table(spark, sf_dir, "labels"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the one with the largest doc_id, one row if several share it. Empty and null texts are equal."""
    return exact_dedup.without_duplicates(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies (four fifths of their runs of five words) the one with the smallest doc_id, one row
    if several share it. Documents without words resemble nothing and stay."""
    return near_dedup.without_near_duplicates(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the weights of their sources ask for: rows come up to three times or not at all. A null
    source is the last one. Rows that repeat are drawn each; documents without words like others of their source."""
    return mixing.mix(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_ids, ids and the digest of the text that the ids decode to, for each document of the mixture; a text
    that is empty has no ids, rows that repeat give rows that repeat."""
    vocabulary = pieces.load_vocabulary(f"{TOKENIZERS}/{PIECES}")
    return pieces.encode(docs, vocabulary, decoded=True).select(
        "doc_id", F.size("ids").cast("bigint").alias("n_ids"), "ids", F.sha2("text", 256).alias("decoded_sha256"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("near_dedup", drop_near_copies),
    ("source_mix", mix_sources),
    ("sentencepiece", encode),
]

# Trained scores and merges of pieces are no SQL; the tests hold the stages against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each reads the table that the one before wrote."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
