"""Repeatable random samples."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from orderloom.functions.picks import shuffle_order


def sample_rows(df: DataFrame, n: int, key: str, salt: str) -> DataFrame:
    """``n`` rows, each with the same chance, chosen by a hash of ``key``.

    Every task keeps its own first ``n`` rows of the hash order, so only those are brought together.
    """
    return (df.withColumn("_turn", shuffle_order(F.col(key), salt)).orderBy("_turn", key).limit(n)
            .drop("_turn"))
