"""Columns a table fills in by itself: defaults and computed columns."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, functions as F

from orderloom.functions.dates import days_between, key_to_date
from orderloom.functions.money import line_total
from orderloom.model import Table


def with_defaults(df: DataFrame, table: Table, as_of: datetime) -> DataFrame:
    """``df`` in the columns and types of ``table``.

    A column the batch leaves out takes its default, or NULL; a NULL the batch does give stays NULL.
    """
    moment = f"TIMESTAMP_NTZ '{as_of:%Y-%m-%d %H:%M:%S.%f}'"
    out = []
    for field in table.schema.fields:
        if field.name in df.columns:
            value = F.col(field.name)
        elif field.name in table.defaults:
            value = F.expr(table.defaults[field.name].replace(":as_of", moment))
        else:
            value = F.lit(None)
        out.append(value.cast(field.dataType).alias(field.name))
    return df.select(*out)


def with_line_total(lines: DataFrame) -> DataFrame:
    """Order lines with the computed LineTotal, at scale 4."""
    return lines.withColumn("LineTotal", line_total(F.col("Quantity"), F.col("UnitPrice"), F.col("Discount")))


def with_days_to_refund(returns: DataFrame) -> DataFrame:
    """Return facts with the computed DaysToRefund, NULL while there is no refund date."""
    return returns.withColumn("DaysToRefund", days_between(
        key_to_date(F.col("ReturnDateKey")), key_to_date(F.col("RefundDateKey"))).cast("int"))
