"""Mixing sources to target weights by repeating and leaving out whole documents."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from orderloom.llm.common import WORD, whole_text
from orderloom.operators.keys import rank_keys
from orderloom.session import materialize

WEIGHTS = (5, 2, 1)
MOST_REPEATS = 3
SEED = "mix"


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("bigint")


def _draw(seed: str) -> Column:
    """A number in [0, 1) from 52 bits of a hash of the document's id; a row without an id goes by its text."""
    key = F.coalesce(F.col("doc_id").cast("string"), F.md5(whole_text().cast("binary")))
    return F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), key).cast("binary")), 1, 13), 16, 10).cast(
        "bigint") / F.lit(float(2 ** 52))


def source_targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, most: int = MOST_REPEATS) -> DataFrame:
    """Per source its size, weight and target, from rows (source, size): source, source_size, target, rate.

    Sources in order of their code points, null last, take the weights in turn. All targets add up to all sizes; a
    target stops at ``most`` times its source's size, and what is left over is shared by weight among the others.
    The level of that share is found by rounds of sums over the sources, each of which can only raise it.
    """
    sums = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    sums = sums.select("source", "source_size", F.col("source").isNull().alias("last"))
    ranked = rank_keys(sums, "place", ["last", "source"], label="mix-ranks")
    turn = (F.col("place") - 1) % len(weights)
    weight = F.element_at(F.array(*[F.lit(int(w)) for w in weights]), (turn + 1).cast("int"))
    exact = "decimal(38,0)"
    table = materialize(ranked.select(
        "source", "source_size", weight.cast(exact).alias("weight"),
        (F.col("source_size") * most).cast(exact).alias("cap")), "mix-sources")
    level, full = None, F.lit(False)  # the level is share / parts, words for each unit of weight
    while True:
        found = table.agg(
            F.sum("source_size").alias("all"), F.sum(F.when(full, F.col("cap"))).alias("capped"),
            F.sum(F.when(~full, F.col("weight"))).alias("parts")).first()
        if not found["parts"] or level == (int(found["all"]) - int(found["capped"] or 0), int(found["parts"])):
            break
        level = int(found["all"]) - int(found["capped"] or 0), int(found["parts"])
        share, parts = (F.lit(str(x)).cast(exact) for x in level)
        full = F.col("cap") * parts <= F.col("weight") * share
    if level is None:
        target = F.lit(0.0)
    else:
        target = F.when(full, F.col("cap").cast("double")).otherwise(
            (F.col("weight") * share).cast("double") / parts.cast("double"))
    table = table.select("source", "source_size", target.alias("target"))
    return table.withColumn("rate", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size"))
                            .otherwise(F.lit(0.0)))


def _with_copies(docs: DataFrame, weights: Sequence[int], most: int, seed: str, keep: list[str]) -> DataFrame:
    """``keep`` and the columns size, source_size, target, copies; the names are chosen by the callers."""
    sizes = docs.select("source", word_count(whole_text()).alias("size"))
    targets = materialize(source_targets(sizes, weights, most), "mix-targets").select(
        F.col("source").alias("mix_source"), F.col("source_size").alias("mix_source_size"),
        F.col("target").alias("mix_target"), F.col("rate").alias("mix_rate"))
    joined = docs.join(targets, F.col("source").eqNullSafe(F.col("mix_source")))
    rate = F.col("mix_rate")
    copies = F.floor(rate) + F.when(_draw(seed) < rate - F.floor(rate), 1).otherwise(0)
    return joined.select(*keep, "mix_source_size", "mix_target", copies.cast("int").alias("mix_copies"))


def mix_plan(docs: DataFrame, weights: Sequence[int] = WEIGHTS, most: int = MOST_REPEATS,
             seed: str = SEED) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text, source): doc_id, size, source_size, target, copies, taken.

    A document's size is its number of words, 0 for a null or empty text. A source whose target is rate times its
    size has each of its documents floor(rate) times, and once more with the probability of the rest; the draw
    depends on the seed and the doc_id alone (on the text where doc_id is null), so every run agrees, and rows that
    share a doc_id share the draw. A source without words has the target 0 and no copies. A null source is a source.
    Empty tables give no rows; other columns are not looked at.
    """
    docs = docs.select("doc_id", "text", "source")
    planned = _with_copies(docs.withColumn("size", word_count(whole_text())), weights, most, seed, ["doc_id", "size"])
    return planned.select(
        "doc_id", "size", F.col("mix_source_size").alias("source_size"), F.col("mix_target").alias("target"),
        F.col("mix_copies").alias("copies"), (F.col("size") * F.col("mix_copies")).alias("taken"))


def mix(docs: DataFrame, weights: Sequence[int] = WEIGHTS, most: int = MOST_REPEATS, seed: str = SEED) -> DataFrame:
    """The mixture itself: every row of ``docs`` as often as ``mix_plan`` says, with all its columns, whatever they are
    called.

    Null and empty texts have no words and do not count for the targets, but are taken as often as others of their
    source; a null source is a source like any other, the last one; rows that repeat are drawn each. An empty table
    gives an empty one.
    """
    names = docs.columns
    plain = docs.toDF(*[f"c{i}" for i in range(len(names))])
    role = {n: F.col(f"c{i}") for i, n in enumerate(names)}
    base = plain.select(F.struct(*plain.columns).alias("all"), *[role[n].alias(n) for n in
                                                                 ("doc_id", "text", "source")])
    copied = _with_copies(base, weights, most, seed, ["all"])
    copied = copied.where("mix_copies > 0").withColumn(
        "copy", F.explode(F.sequence(F.lit(1), F.col("mix_copies"))))
    return copied.select([F.col(f"all.c{i}").alias(n) for i, n in enumerate(names)])


ORACLE = r"""
WITH sized AS (
    SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size
    FROM documents),
sums AS (
    SELECT source, sum(size)::BIGINT AS source_size,
           [5, 2, 1][((row_number() OVER (ORDER BY source NULLS LAST)) - 1) % 3 + 1] AS weight
    FROM sized GROUP BY source),
ordered AS (
    SELECT *, sum(source_size) OVER () AS everything,
           sum(3 * source_size) OVER before AS capped, sum(weight) OVER rest AS parts,
           row_number() OVER (ORDER BY 3 * source_size / weight, source) AS place
    FROM sums
    WINDOW before AS (ORDER BY 3 * source_size / weight, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
           rest AS (ORDER BY 3 * source_size / weight, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
level AS (
    SELECT (everything - coalesce(capped, 0))::BIGINT AS share, parts::BIGINT AS parts, place FROM ordered
    WHERE (3 * source_size)::HUGEINT * parts > weight::HUGEINT * (everything - coalesce(capped, 0))
    ORDER BY place LIMIT 1),
targets AS (
    SELECT source, source_size,
           CASE WHEN (SELECT place FROM level) IS NULL OR o.place < (SELECT place FROM level)
                THEN (3 * source_size)::DOUBLE
                ELSE (weight * (SELECT share FROM level))::DOUBLE / (SELECT parts FROM level)::DOUBLE END AS target
    FROM ordered o),
drawn AS (
    SELECT s.doc_id, s.size, t.source_size, t.target,
           CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0.0 END AS rate,
           ('0x' || substr(md5('mix:' || s.doc_id), 1, 13))::BIGINT / 4503599627370496.0::DOUBLE AS draw
    FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       size * (floor(rate)::BIGINT + CASE WHEN draw < rate - floor(rate) THEN 1 ELSE 0 END) AS taken
FROM drawn
"""
