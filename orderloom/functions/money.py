"""Money expressions. Amounts are decimals throughout; nothing sums doubles."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Sums keep cents but get room for one order or customer that holds a large part of all rows.
AMOUNT = "decimal(28,2)"
LINE = "decimal(18,4)"
PRICE = "decimal(10,2)"


def line_total(quantity: Column, unit_price: Column, discount: Column) -> Column:
    """Quantity x price x (1 - discount) at full scale; rounded only where it is stored as an amount."""
    return (quantity * unit_price * (F.lit(1) - discount)).cast(LINE)


def amount(value: Column) -> Column:
    """``value`` in cents, rounded half away from zero."""
    return value.cast(AMOUNT)


def zero_if_null(value: Column) -> Column:
    return F.coalesce(value, F.lit(0))
