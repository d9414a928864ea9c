"""Joins that stay balanced when one key holds a large part of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from orderloom.session import materialize

# A key counts as hot when it has the rows of this many tasks or more.
HOT_TASKS = 2
# Hot keys that are told apart at least, and keys that the sketch follows for each of them.
TOP, TRACKED = 200, 40
# Lookup sides up to this size, by the width of their columns, are sent to every executor.
BROADCAST_BYTES = 64 << 20


def key_hash(columns: Sequence[str]) -> Column:
    return F.xxhash64(*[F.col(c) for c in columns])


def hot_keys(df: DataFrame, columns: Sequence[str], tasks: int | None = None) -> DataFrame:
    """(hash, salts) of the hot keys of ``df``: those with the rows of ``HOT_TASKS`` tasks or more, and over how many
    tasks each is split so that a part has the rows of one.

    ``tasks`` is the number of shuffle partitions, so there are at most half as many rows. One pass over the key
    columns alone, by a sketch that needs no shuffle of keys. A sketch error or a hash clash can only change how rows
    are spread over tasks, never a result.
    """
    tasks = tasks or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    top = max(TOP, tasks // HOT_TASKS + 1)
    sketch = (df.select(key_hash(columns).alias("h"))
              .agg(F.expr(f"approx_top_k(h, {top}, {min(top * TRACKED, 1_000_000)})").alias("top"),
                   F.count("*").alias("n")))
    found = sketch.select("n", F.explode("top").alias("x")).select("n", "x.item", "x.count")
    return found.where(F.col("count") * tasks >= F.col("n") * HOT_TASKS).select(
        F.col("item").alias("_hash"), F.ceil(F.col("count") * tasks / F.col("n")).cast("int").alias("_salts"))


def _width(df: DataFrame) -> int:
    """Bytes of a row, about: eight for each number or date, 32 for each text, 64 for each list of structs."""
    return sum(64 if t.startswith("array<struct") else 32 if t in ("string", "binary") else 8 for _, t in df.dtypes)


def fits_broadcast(df: DataFrame, size: int | None = None) -> bool:
    """Whether the counted rows of ``df`` have at most ``size`` (``BROADCAST_BYTES``) bytes. The count of a stored
    table reads no column."""
    limit = BROADCAST_BYTES if size is None else size
    return df.count() * _width(df) <= limit


def lookup_join(many: DataFrame, one: DataFrame, on: Sequence[str], spread: Sequence[str], how: str = "inner",
                hot_in: DataFrame | None = None, bound: DataFrame | None = None) -> DataFrame:
    """Join ``many`` to ``one``, which has at most one row per key, however the keys of ``many`` are spread.

    A small ``one``, as counted, is broadcast. Otherwise both sides are shuffled, with hot keys split over as many
    tasks as they have rows for: rows of a hot key (NULL counts as a key) get a salt from ``spread``, columns of
    ``many`` that tell its rows apart; the one matching row is repeated per salt; all other keys keep salt 0 on both
    sides. ``hot_in`` names the base table to find the hot keys in, and ``bound`` one with no fewer rows than
    ``one`` to count, where ``many`` and ``one`` are costly to compute.
    """
    on = list(on)
    counted = one if bound is None else bound.select(*[F.lit(0).cast(t).alias(c) for c, t in one.dtypes])
    if fits_broadcast(counted):
        return many.join(F.broadcast(one), on, how)
    hot = F.broadcast(hot_keys(many if hot_in is None else hot_in, on))  # bounded by the number of tasks
    left = many.withColumn("_hash", key_hash(on)).join(hot, "_hash", "left")
    salt = F.pmod(F.xxhash64(*[F.col(c) for c in spread]), F.col("_salts")).cast("int")
    left = left.withColumn("_salt", F.coalesce(salt, F.lit(0))).drop("_hash", "_salts")
    copies = F.sequence(F.lit(0), F.coalesce(F.col("_salts"), F.lit(1)) - 1)
    right = one.withColumn("_hash", key_hash(on)).join(hot, "_hash", "left")
    right = right.withColumn("_salt", F.explode(copies)).drop("_hash", "_salts")
    return left.join(right, [*on, "_salt"], how).drop("_salt")


def with_known(many: DataFrame, one: DataFrame, column: str, spread: Sequence[str], flag: str) -> DataFrame:
    """``many`` with ``flag`` TRUE where ``one`` has its ``column``, else NULL: a left join, a row coming once for each
    match. Only the keys without a match or with several are joined, which are few where the references hold."""
    matches = one.groupBy(column).agg(F.count("*").alias("_matches"))
    keys = many.where(F.col(column).isNotNull()).select(column).distinct()
    odd = materialize(keys.join(matches, column, "left").where("_matches IS NULL OR _matches > 1").select(
        column, F.coalesce("_matches", F.lit(0)).cast("int").alias("_matches")), "odd-keys")
    found = F.when(F.col(column).isNotNull() & (F.coalesce("_matches", F.lit(1)) > 0), F.lit(True))
    joined = lookup_join(many, odd, [column], spread, "left").withColumn(flag, found)
    if odd.where("_matches > 1").isEmpty():
        return joined.drop("_matches")
    copies = F.sequence(F.lit(1), F.greatest(F.coalesce("_matches", F.lit(1)), F.lit(1)))
    return joined.withColumn("_copy", F.explode(copies)).drop("_matches", "_copy")
