"""Audit rows for new order lines."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F

from orderloom.functions.dates import moment
from orderloom.functions.text import concat_blank_null
from orderloom.operators.keys import offset_keys


def line_entries(lines: DataFrame, key: Column, as_of: datetime) -> DataFrame:
    """One audit row per new order line, under the key that an expression over the line gives."""
    detail = concat_blank_null("ProductID=", F.col("ProductID"), ", Qty=", F.col("Quantity"),
                               ", LineTotal=", F.col("LineTotal"))
    return lines.select(key.cast("long").alias("AuditID"), "OrderID", F.lit("LINE_ADDED").alias("Action"),
                        detail.alias("ActionDetail"), moment(as_of).alias("ActionAt"))


def audit_new_lines(lines: DataFrame, as_of: datetime, start: Column | int = 0) -> DataFrame:
    """One audit row per line of a batch of new order lines. AuditIDs follow ``start`` in the order of the lines."""
    return line_entries(offset_keys(lines, "_audit", "OrderDetailID", start), F.col("_audit"), as_of)
