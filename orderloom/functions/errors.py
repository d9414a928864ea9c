"""Error numbers, their messages and the columns of an error-log row."""

from __future__ import annotations

from datetime import datetime

from pyspark.errors import PySparkException
from pyspark.sql import Column, functions as F

from orderloom.functions.dates import moment

# Numbers and texts that callers of the order and return jobs match on.
UNKNOWN_PRODUCT = 51000
INSUFFICIENT_STOCK = 51001
UNKNOWN_LINE = 51002
NO_PAYMENT = 51003
CONSTRAINT = 547
NULL_VALUE = 515
REPEATED_KEY = 2627
TEXT_TOO_LONG = 2628
REPEATED_SOURCE_ROW = 8672
GENERAL = 50000
# The numbers of what Spark reports under these conditions.
CONDITIONS = {
    "USER_RAISED_EXCEPTION": REPEATED_SOURCE_ROW,  # raised by the merge operators only
    "NOT_NULL_ASSERT_VIOLATION": NULL_VALUE,
    "DIVIDE_BY_ZERO": 8134,
    "ARITHMETIC_OVERFLOW": 8115,
    "CAST_OVERFLOW": 8115,
    "NUMERIC_VALUE_OUT_OF_RANGE": 8115,
    "CAST_INVALID_INPUT": 245,
    "PATH_NOT_FOUND": 208,
    "TABLE_OR_VIEW_NOT_FOUND": 208,
    "UNRESOLVED_COLUMN": 207,
}
MESSAGES = {
    UNKNOWN_PRODUCT: "Product does not exist.",
    INSUFFICIENT_STOCK: "Insufficient stock to fulfil this order.",
    UNKNOWN_LINE: "Order line not found.",
    NO_PAYMENT: "No matching payment found to refund.",
    CONSTRAINT: "The statement conflicted with a table constraint.",
    NULL_VALUE: "Cannot insert the value NULL.",
}
NEGATIVE_STOCK = "Update rejected: inventory cannot go negative."
NOTHING_TO_RESTOCK = "No products currently below reorder level."


class LoadRefused(ValueError):
    """Rows that must not be stored; ``number`` says why."""

    def __init__(self, message: str, number: int):
        super().__init__(message)
        self.number = number


def number_of(error: BaseException) -> int:
    """The number under which an error is logged: that of a refusal, that of the Spark condition, or the general one.

    A condition counts by its main class, so NUMERIC_VALUE_OUT_OF_RANGE.WITH_SUGGESTION is found as well.
    """
    if isinstance(error, LoadRefused):
        return error.number
    if isinstance(error, PySparkException):
        return CONDITIONS.get((error.getCondition() or "").split(".")[0], GENERAL)
    return GENERAL


def message_of(number: Column) -> Column:
    """The message of an error number held in a column."""
    text = F.lit(None).cast("string")
    for code, message in MESSAGES.items():
        text = F.when(number == code, F.lit(message)).otherwise(text)
    return text


def error_columns(procedure: Column | str, number: Column, at: datetime) -> list[Column]:
    """The columns of one error-log row."""
    name = F.lit(procedure) if isinstance(procedure, str) else procedure
    return [
        name.alias("ErrorProcedure"),
        number.cast("int").alias("ErrorNumber"),
        message_of(number).alias("ErrorMessage"),
        moment(at).alias("ErrorAt"),
    ]
