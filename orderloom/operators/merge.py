"""Upserts and updates from a join, as functions from old table and batch to new table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F


def require_unique(df: DataFrame, keys: Sequence[str], what: str) -> DataFrame:
    """``df`` unchanged; the job fails with ``what`` as soon as a second row of one key comes by.

    It sorts the partitions that a join on ``keys`` needs anyway, and reads no group to its end.
    """
    turn = F.row_number().over(Window.partitionBy(*keys).orderBy(*keys))
    checked = df.withColumn("_turn", turn)
    fail = F.raise_error(F.concat(F.lit(f"{what}: more than one row for "), F.to_json(F.struct(*keys))))
    return checked.where(F.when(F.col("_turn") > 1, fail.cast("boolean")).otherwise(F.lit(True))).drop("_turn")


def merge_upsert(target: DataFrame, source: DataFrame, keys: Sequence[str], update: Sequence[str],
                 changed: str | None = None, inserted: Mapping[str, Column] | None = None) -> DataFrame:
    """The rows of ``target`` after an upsert of ``source``.

    A matched row takes the ``update`` columns of the source, when the condition ``changed`` holds; it is SQL
    text over ``t`` (target) and ``s`` (source). A source row without a match is inserted with its own
    columns; ``inserted`` gives values for columns the source lacks. Target rows without a match stay. Both
    sides hold one row per key, so no key can be hot; a source that breaks this fails the job.
    """
    keys = list(keys)
    extra = dict(inserted or {})
    source = require_unique(source, keys, "merge source")
    t = target.withColumn("_in_t", F.lit(True)).alias("t")
    s = source.withColumn("_in_s", F.lit(True)).alias("s")
    pairing = [F.col(f"t.{k}") == F.col(f"s.{k}") for k in keys]
    is_new = F.col("t._in_t").isNull()
    matched = F.col("t._in_t").isNotNull() & F.col("s._in_s").isNotNull()
    take = matched if changed is None else matched & F.expr(changed)
    out = []
    for field in target.schema.fields:
        name = field.name
        old = F.col(f"t.{name}")
        if name in keys:
            value = F.coalesce(old, F.col(f"s.{name}"))
        else:
            new = extra[name] if name in extra else (
                F.col(f"s.{name}") if name in source.columns else F.lit(None))
            value = F.when(is_new, new)
            if name in update:
                value = value.when(take, F.col(f"s.{name}"))
            value = value.otherwise(old)
        out.append(value.cast(field.dataType).alias(name))
    return t.join(s, pairing, "full_outer").select(*out)


def insert_absent(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The distinct keys of ``source`` that ``target`` does not hold yet."""
    return source.select(*keys).distinct().join(target.select(*keys), list(keys), "left_anti")


def update_from(target: DataFrame, values: DataFrame, keys: Sequence[str],
                assign: Mapping[str, Column]) -> DataFrame:
    """``target`` with new values for the rows that have a match in ``values``, at most one per key.

    ``assign`` maps target columns to expressions over ``t`` and ``v``. Rows without a match stay as they are.
    """
    keys = list(keys)
    t = target.alias("t")
    v = values.withColumn("_hit", F.lit(True)).alias("v")
    joined = t.join(v, [F.col(f"t.{k}") == F.col(f"v.{k}") for k in keys], "left")
    hit = F.col("v._hit").isNotNull()
    out = []
    for field in target.schema.fields:
        old = F.col(f"t.{field.name}")
        value = F.when(hit, assign[field.name]).otherwise(old) if field.name in assign else old
        out.append(value.cast(field.dataType).alias(field.name))
    return joined.select(*out)
