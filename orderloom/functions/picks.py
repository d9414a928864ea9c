"""Repeatable stand-ins for random numbers: a pick depends only on a row's key and a salt."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def pick(key: Column, salt: str, n: Column | int) -> Column:
    """A whole number in 0 .. n-1, spread evenly over keys: 60 bits of a hash, far more than any table has rows."""
    digest = F.md5(F.concat(key.cast("string"), F.lit("|" + salt)))
    size = n if isinstance(n, Column) else F.lit(n)
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long") % size


def shuffle_order(key: Column, salt: str) -> Column:
    """A sort key that puts rows in an order unrelated to ``key``."""
    return F.md5(F.concat(key.cast("string"), F.lit("|" + salt)))
