"""Helpers shared by the corpus operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from orderloom.operators.skew import fits_broadcast
from orderloom.session import materialize

# ASCII white space as the operators understand it; all else belongs to words.
WORD = r"[^\x20\x09-\x0D]+"
# Tables up to this size, by the width of their columns, are sent to every executor; beyond, both sides are shuffled.
BROADCAST_BYTES = 16 << 20


def read_table(spark: SparkSession, directory: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{directory}/{name}.parquet")


def whole_text(column: str = "text") -> Column:
    """The column as text, null as the empty text."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def fresh(df: DataFrame, *wanted: str) -> list[str]:
    """For each wanted name, one that no column of ``df`` has, whatever extra columns it carries."""
    taken = {c.lower() for c in df.columns}
    names = []
    for name in wanted:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        names.append(name)
    return names


def sized(df: DataFrame, size: int | None = None) -> DataFrame:
    """``df`` marked for broadcast if its counted rows have at most ``size`` bytes, and unchanged otherwise.

    ``df`` must be a table already written, so that the count reads no column, with numbers, digests and other short
    columns only.
    """
    return F.broadcast(df) if fits_broadcast(df, BROADCAST_BYTES if size is None else size) else df


def text_key(column: str = "text") -> Column:
    return F.xxhash64(whole_text(column))


def kept_rows(docs: DataFrame, decided: DataFrame) -> DataFrame:
    """The rows of ``docs`` that ``decided`` (doc_id, text_key, kept) keeps, with all their columns.

    Rows are told apart by doc_id and text. Where several rows share both and some are kept, one of them stays; if they
    differ in other columns, that is the first by the text form of the whole row.
    """
    verdicts = materialize(decided.groupBy("doc_id", "text_key").agg(
        F.max("kept").alias("kept"), F.min("kept").alias("all_kept")), "verdicts")
    key, gone_id, gone_key = fresh(docs, "text_key", "gone_id", "gone_key")
    gone = materialize(verdicts.where("NOT kept").select(
        F.col("doc_id").alias(gone_id), F.col("text_key").alias(gone_key)), "dropped")
    kept = docs.withColumn(key, text_key()).join(
        sized(gone), F.col("doc_id").eqNullSafe(F.col(gone_id)) & (F.col(key) == F.col(gone_key)), "left_anti")
    if not verdicts.where("kept AND NOT all_kept").isEmpty():
        first, = fresh(kept, "first_row")
        kept = kept.groupBy("doc_id", key).agg(F.min_by(F.struct(*docs.columns), F.to_json(F.struct(
            *docs.columns))).alias(first)).select(f"{first}.*")
        return kept
    return kept.drop(key)
