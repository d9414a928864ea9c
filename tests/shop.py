"""Helpers of the tests of the retail engine."""

from pathlib import Path

from orderloom.model import OLTP

ROOT = Path(__file__).resolve().parent.parent
DATA = "/root/testdata/sf0.001"


def rows(df):
    """The rows of ``df`` as sorted tuples."""
    return sorted((tuple(r) for r in df.collect()), key=repr)


def make(spark, name, *values):
    """A retail table from literal rows."""
    return spark.createDataFrame(list(values), OLTP[name].schema)
