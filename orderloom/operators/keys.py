"""Surrogate keys: unique, above every key handed out before, the same on every recomputation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from orderloom.session import materialize

# monotonically_increasing_id() keeps the partition number above this many bits of row number.
_ROW_BITS = 33


def highest(df: DataFrame, column: str) -> Column:
    """The largest value of ``column``, 0 for an empty table, as a scalar."""
    return df.agg(F.coalesce(F.max(column), F.lit(0)).cast("long").alias("top")).scalar()


def last_key(df: DataFrame | None, column: str) -> Column:
    """The largest key of a table that new rows go on from; 0 where there is no table."""
    return F.lit(0).cast("long") if df is None else highest(df, column)


def offset_keys(df: DataFrame, key: str, natural: str, start: Column | int = 0,
                base: DataFrame | None = None) -> DataFrame:
    """Keys after ``start`` that follow a unique whole-number column, with its gaps.

    Needs no shuffle: only the smallest natural value is looked up, in ``base``, the stored table ``df`` takes
    the values from, so that ``df`` itself is computed once.
    """
    least = (df if base is None else base).agg(F.min(natural).alias("least")).scalar()
    first = start if isinstance(start, Column) else F.lit(start)
    return df.withColumn(key, (first + 1 + F.col(natural) - least).cast("long"))


def rank_keys(df: DataFrame, key: str, order: Sequence[str], start: Column | int = 0,
              label: str = "ranked", keep: Sequence[str] | None = None) -> DataFrame:
    """Keys start+1, start+2, ... without gaps in the order of ``order``, which must tell all rows apart.

    The result has the columns ``keep`` (all by default) and the key.

    The rows are range-partitioned on the whole order, so one frequent leading value is split over tasks,
    numbered inside their partition while they are written to the shared folder, and shifted by the number
    of rows in the partitions before. The only data brought to one place is one count per partition. As the
    rows are written once, a recomputation cannot hand out other keys.
    """
    order = list(order)
    written = materialize(
        df.repartitionByRange(*order).sortWithinPartitions(*order)
        .select(*(df.columns if keep is None else keep), F.monotonically_increasing_id().alias("_at")), label)
    part = F.shiftright("_at", _ROW_BITS)
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    shifts = materialize(
        written.groupBy(part.alias("_part")).agg(F.count("*").alias("_rows"))
        .select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_shift")), label + "-shifts")
    first = start if isinstance(start, Column) else F.lit(start)
    local = F.col("_at").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    return (written.withColumn("_part", part).join(F.broadcast(shifts), "_part")
            .withColumn(key, (first + 1 + F.col("_shift") + local).cast("long"))
            .drop("_at", "_part", "_shift"))
