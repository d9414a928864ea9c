"""Where running sums first pass a bound, also for keys that hold most of the rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window, functions as F

from orderloom.operators.skew import fits_broadcast, lookup_join
from orderloom.session import materialize

# A key with more rows is looked at by spans of so many positions, and spans by groups of so many.
SPAN = 100_000
FAN = 1_000


def _in_turn(*keys: str) -> Window:
    return Window.partitionBy(*keys)


def _descend(sums: DataFrame, located: DataFrame, keys: list[str], fan: int, level: int) -> DataFrame:
    """``located`` (keys, bound, _unit, _base) one level further down: the child unit in which the bound is passed, and
    the running sum before it. At most ``fan`` units share a parent, so no window is longer than that."""
    child = (sums.withColumn("_child", F.expr(f"_unit DIV {fan ** (level - 1)}")).groupBy(*keys, "_child")
             .agg(F.sum("_total").alias("_total")).withColumn("_parent", F.expr(f"_child DIV {fan}")))
    parents = located.select(*keys, F.col("_unit").alias("_parent")).distinct()
    before = _in_turn(*keys, "_parent").orderBy("_child").rowsBetween(Window.unboundedPreceding, -1)
    child = child.join(parents, [*keys, "_parent"], "left_semi").withColumn(
        "_before", F.coalesce(F.sum("_total").over(before), F.lit(0)))
    met = located.withColumnRenamed("_unit", "_parent").join(child, [*keys, "_parent"])
    return met.where((F.col("_base") + F.col("_before") <= F.col("bound"))
                     & (F.col("bound") < F.col("_base") + F.col("_before") + F.col("_total"))).select(
        *keys, "bound", F.col("_child").alias("_unit"), (F.col("_base") + F.col("_before")).alias("_base"))


def crossings(rows: DataFrame, keys: Sequence[str], at: str, value: Column, bounds: DataFrame,
              span: int | None = None, fan: int = FAN) -> DataFrame:
    """(keys, bound, at, before): for each bound the first row of its key at which the running sum of ``value`` is above
    it, and the sum before that row. Bounds that are never passed are left out.

    ``rows`` has the key columns and ``at``, a whole number that orders the rows of a key and tells them apart;
    ``value`` is a whole number and never negative. ``bounds`` has the key columns and ``bound``, as many per key as
    there are, none of them negative. Columns named bound, before, or with a leading underscore are not allowed.

    The rows of a key are summed up by spans of positions, and only the span in which a bound is passed is looked at
    row by row. Where it is follows from the sums of the spans, found level by level in groups of ``fan``; so no task
    gets more than ``span`` rows of a key, nor more than ``fan`` sums. Keys with ``span`` rows or fewer are one span.
    """
    keys, span = list(keys), SPAN if span is None else span
    valued = rows.where(reduce(and_, [F.col(k).isNotNull() for k in keys])).select(
        *keys, F.col(at).cast("long").alias("_at"), value.cast("long").alias("_value"))
    totals = valued.groupBy(*keys).agg(F.sum("_value").alias("_total"), F.count("*").alias("_rows"))
    # Bounds that are passed, and keys with many rows that pass none.
    looked = materialize(
        totals.join(bounds.select(*keys, F.col("bound").cast("long").alias("bound")), keys, "left")
        .withColumn("_met", F.coalesce(F.expr("_total > bound"), F.lit(False)))
        .withColumn("_busy", F.col("_rows") > span).where("_met OR _busy").select(*keys, "bound", "_met", "_busy"),
        "passed-bounds")
    passed = looked.where("_met")
    located = passed.where("NOT _busy").select(*keys, "bound", F.lit(0).cast("long").alias("_unit"),
                                               F.lit(0).cast("long").alias("_base"))
    # At most one of ``span`` rows has such a key.
    large = looked.where("_busy").groupBy(*keys).agg(F.bool_or("_met").alias("_met"))
    busy = passed.where("_busy")
    if not busy.isEmpty():
        sums = materialize(
            lookup_join(valued, large.where("_met").select(*keys), keys, ["_at"]).withColumn(
                "_unit", F.expr(f"_at DIV {span}")).groupBy(*keys, "_unit").agg(F.sum("_value").alias("_total")),
            "span-sums")
        farthest = sums.agg(F.max(F.abs("_unit")).alias("most")).collect()[0]["most"]
        levels = 0
        while farthest:
            farthest //= fan
            levels += 1
        found = busy.select(*keys, "bound", F.lit(0).cast("long").alias("_unit"), F.lit(0).cast("long").alias("_base"))
        for level in range(levels, 0, -1):
            found = materialize(_descend(sums, found, keys, fan, level), "located-bounds")
        located = located.unionByName(found)
    wanted = passed.select(*keys, "_busy").distinct()
    if fits_broadcast(wanted):
        marked = lookup_join(valued, wanted, keys, ["_at"], bound=looked)
    else:
        # Other keys come along, as finding them would cost a shuffle of all rows; but not those with many rows.
        marked = (lookup_join(valued, large, keys, ["_at"], "left").where("_met IS NULL OR _met")
                  .withColumn("_busy", F.col("_met").isNotNull()))
    # Rows and bounds of a span meet in one shuffle; a bound comes before the rows and brings the sum before its span.
    none = F.lit(None).cast("long")
    both = marked.select(*keys, F.expr(f"CASE WHEN _busy THEN _at DIV {span} ELSE 0 END").alias("_unit"), "_at",
                         "_value", none.alias("_base"), none.alias("bound")).unionByName(
        located.select(*keys, "_unit", none.alias("_at"), none.alias("_value"), "_base", "bound"))
    spans = _in_turn(*keys, "_unit")
    asked = F.col("bound").isNotNull()
    turns = spans.orderBy(~asked, "_at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    level = F.max("_base").over(turns) + F.sum("_value").over(turns)
    levels_of = both.withColumn("_level", level).select(
        *keys, "_unit", "bound", (-F.when(asked, F.col("bound")).otherwise(F.col("_level"))).alias("_fall"),
        F.when(~asked, F.struct(F.col("_at").alias("at"), (F.col("_level") - F.col("_value")).alias("before")))
        .alias("_row"))
    # Levels above the bound, the highest first; of their rows the first one counts.
    higher = spans.orderBy("_fall").rangeBetween(Window.unboundedPreceding, -1)
    return levels_of.withColumn("_first", F.min("_row").over(higher)).where(asked).select(
        *keys, "bound", "_first.at", "_first.before")
