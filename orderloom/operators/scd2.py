"""Versioned dimensions: a change of a tracked column closes a row and opens the next one."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, functions as F

from orderloom.operators.keys import highest, offset_keys
from orderloom.operators.merge import require_unique


def scd2_merge(dim: DataFrame, source: DataFrame, natural: str, surrogate: str, tracked: Sequence[str],
               as_of: date) -> DataFrame:
    """The dimension after loading ``source``, which holds one row per ``natural`` key; see ``scd2_step``."""
    step = scd2_step(dim.where("IsCurrent"), source, natural, surrogate, tracked, as_of, highest(dim, surrogate))
    return dim.where("NOT IsCurrent").unionByName(step)


def scd2_step(dim: DataFrame, source: DataFrame, natural: str, surrogate: str, tracked: Sequence[str],
              as_of: date, start: Column | None = None) -> DataFrame:
    """What a load of ``source`` makes of the current versions ``dim``: the versions that are current from now on, and
    those it closes. Versions closed by earlier loads are neither needed nor given.

    Only the ``tracked`` columns open a new version; other changes are not taken over. Rows whose key the
    source no longer has stay current. Each current row and its source row meet once, in one join, and give
    one or two rows. New keys follow ``start``, or else the highest key in ``dim``: a version is closed only by one
    with a higher key, so no closed one can have a higher key than the current ones.
    """
    start = highest(dim, surrogate) if start is None else start
    today = F.lit(as_of).cast("date")
    names = [c for c in dim.columns if c not in (surrogate, "EffectiveDate", "ExpiryDate", "IsCurrent")]
    fresh = offset_keys(source.select(*names), "_next", natural, start)
    fresh = require_unique(fresh, [natural], "dimension source")
    current = require_unique(dim, [natural], "current versions")
    pair = (current.select(F.struct(*dim.columns).alias("old"), F.col(natural).alias("_key"))
            .join(fresh.select(F.struct(*fresh.columns).alias("new"), F.col(natural).alias("_key")),
                  "_key", "full_outer"))
    differs = F.lit(False)
    for column in tracked:
        differs = differs | F.coalesce(F.col(f"old.{column}") != F.col(f"new.{column}"), F.lit(False))

    def row(version: str):
        values = []
        for field in dim.schema.fields:
            name = field.name
            if version == "next":
                value = {surrogate: F.col("new._next"), "EffectiveDate": today, "ExpiryDate": F.lit(None),
                         "IsCurrent": F.lit(True)}.get(name)
                value = F.col(f"new.{name}") if value is None else value
            elif version == "closed" and name == "ExpiryDate":
                value = today
            elif version == "closed" and name == "IsCurrent":
                value = F.lit(False)
            else:
                value = F.col(f"old.{name}")
            values.append(value.cast(field.dataType).alias(name))
        return F.struct(*values)

    rows = (F.when(F.col("old").isNull(), F.array(row("next")))
            .when(F.col("new").isNotNull() & differs, F.array(row("closed"), row("next")))
            .otherwise(F.array(row("kept"))))
    return pair.select(F.inline(rows))
