"""Exact duplicates by recipes of content-defined chunks.

A text is cut where its content says so, so that copies are cut alike. Each distinct chunk is moved once, to check
that its identifier stands for one content only; from there on, documents are compared by the ordered list of their
chunk identifiers, some eight bytes for half a thousand characters, and texts are not moved again.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

from orderloom.llm.common import kept_rows, text_key, whole_text
from orderloom.session import materialize

# Chunks have at least LEAST characters where the text goes on, end after a white space that follows one of a few
# letters, and are cut at MOST characters where that never comes.
LEAST, MOST = 512, 4096
_CHUNK = rf"(?s).{{{LEAST},{MOST - 2}}}?[dhlnrst]\s|.{{1,{MOST}}}"


def chunks(text: Column) -> Column:
    """The pieces of a text, in order; joined they are the text."""
    return F.regexp_extract_all(text, F.lit(_CHUNK), F.lit(0))


def _with_ordinals(rows: DataFrame, contents: DataFrame, shared: DataFrame, digest: Callable) -> DataFrame:
    """Recipes where some digests stand for several contents: those contents are numbered, and the number counts."""
    numbered = materialize(contents.join(shared, "digest").withColumn(
        "ordinal", F.row_number().over(Window.partitionBy("digest").orderBy("chunk")).cast("bigint")), "chunk-ordinals")
    places = rows.select("row", "doc_id", "sha", "text_key", F.posexplode_outer(chunks(F.col("text"))).alias("pos", "chunk"))
    places = places.withColumn("digest", digest(F.col("chunk")))
    found = places.join(numbered, ["digest", "chunk"], "left").withColumn(
        "part", F.when(F.col("pos").isNotNull(), F.struct("pos", "digest", F.coalesce("ordinal", F.lit(0)).alias("n"))))
    gathered = found.groupBy("row", "doc_id", "sha", "text_key").agg(F.array_sort(F.collect_list("part")).alias("parts"))
    return gathered.select("row", "doc_id", "sha", "text_key", F.flatten(F.transform(
        "parts", lambda p: F.array(p["digest"], p["n"]))).alias("recipe"))


def _decided(docs: DataFrame, digest: Callable[[Column], Column]) -> DataFrame:
    source = docs.select("doc_id", whole_text().alias("text"))
    contents = source.select(F.explode(chunks(F.col("text"))).alias("chunk")).select(
        digest(F.col("chunk")).alias("digest"), "chunk").distinct()
    rows = source.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text",
                         F.sha2("text", 256).alias("sha"), text_key().alias("text_key"))
    shared = materialize(contents.groupBy("digest").agg(F.count("*").alias("n")).where("n > 1").select("digest"),
                         "shared-digests")
    if shared.isEmpty():
        recipe = F.transform(chunks(F.col("text")), lambda c: digest(c))
        recipes = rows.select("row", "doc_id", "sha", "text_key", recipe.alias("recipe"))
    else:
        recipes = _with_ordinals(rows, contents, shared, digest)
    recipes = materialize(recipes, "recipes")
    # Written, so that the join shuffles both sides itself and a group with very many rows can be split.
    groups = materialize(recipes.groupBy(F.col("recipe").alias("same")).agg(
        F.max(F.struct("doc_id", "row")).alias("best"), F.count("*").alias("group_size")), "groups")
    return recipes.join(groups, F.col("recipe") == F.col("same")).select(
        "doc_id", F.col("best.doc_id").alias("keep_id"), "group_size",
        (F.col("row") == F.col("best.row")).alias("kept"), F.col("sha").alias("text_sha256"), "text_key")


def exact_duplicates(docs: DataFrame, digest: Callable[[Column], Column] = F.xxhash64) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal if they are the same bytes; a null text counts as empty, and empty texts equal each other. Of
    equal texts the row with the largest doc_id stays; a null doc_id comes before all others, and of rows that also
    share the doc_id just one stays. An empty table gives no rows; other columns are not looked at.

    ``digest`` gives a chunk's identifier. It need not be free of collisions: chunks are compared as a whole, and
    contents that share a digest are told apart by a number.
    """
    return _decided(docs, digest).drop("text_key")


def without_duplicates(docs: DataFrame, digest: Callable[[Column], Column] = F.xxhash64) -> DataFrame:
    """The rows of ``docs`` that ``exact_duplicates`` keeps, with all their columns, whatever they are called.

    Of equal texts, of any length, the row with the largest doc_id stays, one if several share it; null counts as the
    empty text, of which one row stays too. An empty table gives an empty one.
    """
    decided = _decided(docs, digest)
    return kept_rows(docs, decided.select("doc_id", "text_key", "kept"))


ORACLE = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       row_number() OVER (PARTITION BY coalesce(text, '') ORDER BY doc_id DESC NULLS LAST) = 1 AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
"""
