"""Hard negatives by exact scores from small float products: residues, remaindering, windowed selection.

Components are whole numbers. Modulo a prime of about a thousand, as residues around zero, the products of 64 of them
add up to less than 2 ** 24, so a float32 matrix product gives each sum exactly. A few such products, modulo different
primes, fix every score by the Chinese remainder theorem; how many primes it takes follows from the lengths of the
vectors at hand. The anchors are taken in blocks of a few megabytes; each is sent to the tasks, which go through all
rows twice: for each anchor's positives, and, knowing their scores, for the negatives of each.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window, functions as F

from orderloom.operators.keys import rank_keys
from orderloom.session import materialize

SCALE = 256
EVERY = 100
POSITIVES = NEGATIVES = 5
# Negatives score from so many hundredths of their positive's score on, up to that score.
LEAST_SHARE = 80
# Rows whose vec_id is divisible by the first count as the next of so many labels.
SHIFTED, LABELS = 7, 10
# Coordinates in one product, and the largest prime whose residues' products over them stay below 2 ** 24.
CHUNK = 64
_HALF = math.isqrt((1 << 24) // CHUNK - 1)
# Bytes of the vectors of one block of anchors, and scores that a task holds at once.
BLOCK_BYTES = 8 << 20
_AREA = 1 << 21
_NONE = np.iinfo(np.int64).min


def _primes(n: int) -> list[int]:
    """The n largest primes whose residues are small enough."""
    below = [p for p in range(2 * _HALF + 1, 2, -1) if all(p % d for d in range(2, math.isqrt(p) + 1))]
    return below[:n]


def _primes_for(bound: int) -> list[int]:
    """So many primes that their product tells all whole numbers from -bound to bound apart."""
    n, product = 0, 1
    everything = _primes(1000)
    while product <= 2 * bound + 1:
        product *= everything[n]
        n += 1
    return everything[:max(n, 1)]


def _residues(rows: np.ndarray, prime: int) -> np.ndarray:
    """Residues around zero, as float32."""
    half = prime // 2
    return (np.mod(rows + half, prime) - half if abs(rows).max(initial=0) < 1 << 62
            else np.mod(np.mod(rows, prime) + half, prime) - half).astype(np.float32)


def _lengths(rows: np.ndarray) -> np.ndarray:
    return np.sqrt((rows.astype(np.float64) ** 2).sum(1))


class Matrix:
    """Rows of whole numbers, with their residues modulo each prime asked for."""

    def __init__(self, rows: np.ndarray):
        self.rows = rows
        self.longest = float(_lengths(rows).max(initial=0))
        self._held: dict[int, np.ndarray] = {}

    def residues(self, prime: int) -> np.ndarray:
        if prime not in self._held:
            self._held[prime] = _residues(self.rows, prime)
        return self._held[prime]


def _product(a: np.ndarray, b: np.ndarray, prime: int) -> np.ndarray:
    """The inner products of rows of residues, modulo the prime, 64 coordinates at a time."""
    dim = min(a.shape[1], b.shape[1])
    out = np.zeros((len(a), len(b)), np.int64)
    for at in range(0, dim, CHUNK):
        out += (a[:, at:min(at + CHUNK, dim)] @ b[:, at:min(at + CHUNK, dim)].T).astype(np.int64)
    return np.mod(out, prime)


def inner_products(a: Matrix, b: Matrix) -> np.ndarray:
    """Exact inner products of all rows of a with all rows of b, clipped to 64 bits.

    The mixed-radix digits of a product follow one by one from its residues.
    """
    primes = _primes_for(math.ceil(a.longest * b.longest * (1 + 1e-9)) + 1)
    size = math.prod(primes)
    wide = size >= 1 << 62
    digits: list[np.ndarray] = []
    for i, p in enumerate(primes):
        digit = _product(a.residues(p), b.residues(p), p)
        for q, before in zip(primes, digits):
            digit = (digit - before) * pow(q, -1, p) % p
        digits.append(digit)
    out = digits[-1].astype(object) if wide else digits[-1]
    for p, digit in zip(primes[-2::-1], digits[-2::-1]):
        out = out * p + digit
    out = np.where(out > size // 2, out - size, out)
    return np.clip(out, _NONE + 1, 2 ** 63 - 1).astype(np.int64) if wide else out


def prepared(embeddings: DataFrame, scale: int = SCALE) -> DataFrame:
    """(row, vec_id, label, v) of the rows that take part, with labels shifted and components as whole numbers."""
    fine = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull() & F.forall(
        "embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    label = F.col("label").cast("bigint")
    label = F.when(F.col("vec_id") % SHIFTED == 0, (label + 1) % LABELS).otherwise(label)
    whole = F.transform("embedding", lambda x: F.floor(x.cast("double") * F.lit(float(scale))))
    rows = embeddings.select("vec_id", "label", "embedding").where(fine)
    return materialize(rows.select(F.monotonically_increasing_id().alias("row"), F.col("vec_id").cast("bigint"),
                                   label.alias("label"), whole.alias("v")), "whole-vectors")


def _matrix(column: pa.Array) -> np.ndarray:
    """The vectors as rows, short ones filled with zeros."""
    values, sizes = column.flatten().to_numpy(zero_copy_only=False), np.diff(column.offsets.to_numpy())
    if len(sizes) and (sizes == sizes[0]).all():
        return values.astype(np.int64).reshape(len(sizes), sizes[0])
    out = np.zeros((len(sizes), sizes.max(initial=0)), np.int64)
    for i, v in enumerate(column.to_pylist()):
        out[i, :len(v)] = v
    return out


@dataclass(frozen=True)
class Anchors:
    """A block of anchors: for each its row, id, label and vector."""

    rows: np.ndarray
    ids: np.ndarray
    labels: np.ndarray
    vectors: np.ndarray


class _Best:
    """The first k of each group by falling score and rising id, of all that was added."""

    def __init__(self, k: int):
        self.k, self.held, self.size = k, [], 0

    def add(self, *columns: np.ndarray) -> None:
        """group, score, id, row."""
        self.held.append(columns)
        self.size += len(columns[0])
        if self.size > 4 * _AREA // 8:
            self.prune()

    def prune(self) -> list[np.ndarray]:
        group, score, ids, row = (np.concatenate(c) for c in zip(*self.held)) if self.held else (
            np.zeros(0, np.int64),) * 4
        order = np.lexsort((row, ids, ~score, group))
        first = np.flatnonzero(np.diff(group[order], prepend=-1))
        place = np.arange(len(order)) - np.repeat(first, np.diff(np.append(first, len(order))))
        keep = order[place < self.k]
        self.held = [(group[keep], score[keep], ids[keep], row[keep])]
        self.size = len(keep)
        return list(self.held[0])


def _first(scores: np.ndarray, able: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(line, place) of the k highest able scores of each line, equal ones by place."""
    n = scores.shape[1]
    if n <= k:
        return np.nonzero(able)
    if abs(scores).max(initial=0) < (1 << 62) // n:
        key = np.where(able, scores * n + (n - 1 - np.arange(n)), _NONE)  # no two alike
        best = np.argpartition(key, n - k, axis=1)[:, n - k:]
        line = np.repeat(np.arange(len(scores)), k)
        best = best.ravel()
        keep = able[line, best]
        return line[keep], best[keep]
    lines, places = [], []
    for i in range(len(scores)):
        at = np.flatnonzero(able[i])
        at = at[np.argsort(~scores[i, at], kind="stable")[:k]]
        lines += [i] * len(at)
        places += at.tolist()
    return np.array(lines, np.int64), np.array(places, np.int64)


def _scored(batches: Iterator[pa.RecordBatch], anchors: Anchors) -> Iterator[tuple]:
    """(rows, ids, labels, scores) for a few hundred rows at a time, in the order of their ids."""
    own = Matrix(anchors.vectors)
    many = max(1, _AREA // max(1, len(anchors.ids)))
    for batch in batches:
        for at in range(0, batch.num_rows, many):
            part = batch.slice(at, many)
            rows, ids, labels = (part.column(i).to_numpy() for i in range(3))
            order = np.argsort(ids, kind="stable")
            vectors = Matrix(_matrix(part.column(3))[order])
            yield rows[order], ids[order], labels[order], inner_products(own, vectors)


_FOUND = ["at", "slot", "score", "vec_id", "row"]
_FOUND_SCHEMA = ", ".join(f"{n} bigint" for n in _FOUND)


def _found(group: np.ndarray, slots: int, score: np.ndarray, ids: np.ndarray, row: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (group // slots, group % slots, score, ids, row)],
                                      _FOUND)


def _positives(vectors: DataFrame, sent: Broadcast, k: int) -> DataFrame:
    """(at, slot, score, vec_id, row): rows of each anchor's label that may be among its k positives."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors, best = sent.value, _Best(k)
        for rows, ids, labels, scores in _scored(batches, anchors):
            able = (anchors.labels[:, None] == labels) & (anchors.rows[:, None] != rows)
            line, place = _first(scores, able, k)
            best.add(line, scores[line, place], ids[place], rows[place])
        group, *rest = best.prune()
        yield _found(group, 1, *rest)
    return vectors.mapInArrow(run, _FOUND_SCHEMA)


def _negatives(vectors: DataFrame, sent: Broadcast, bounds: Broadcast, slots: int, k: int) -> DataFrame:
    """(at, slot, score, vec_id, row): rows of another label that may be among the k negatives of a positive.

    ``bounds``: for each slot the least and the largest score of every anchor's negatives; none if they cross.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors, (low, high), best = sent.value, bounds.value, _Best(k)
        for rows, ids, labels, scores in _scored(batches, anchors):
            other = anchors.labels[:, None] != labels
            for slot in range(slots):
                able = other & (scores >= low[slot][:, None]) & (scores <= high[slot][:, None])
                used = np.flatnonzero(able.any(1))
                line, place = _first(scores[used], able[used], k)
                line = used[line]
                best.add(line * slots + slot, scores[line, place], ids[place], rows[place])
        yield _found(*(lambda group, *rest: (group, slots, *rest))(*best.prune()))
    return vectors.mapInArrow(run, _FOUND_SCHEMA)


def _ranked(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("at", "slot").orderBy(F.desc("score"), "vec_id", "row")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _mined(vectors: DataFrame, anchors: Anchors, positives: int, negatives: int, least_share: int) -> DataFrame:
    """The rows of ``hard_negatives`` for one block of anchors."""
    spark = vectors.sparkSession
    sent = spark.sparkContext.broadcast(anchors)
    own = materialize(_ranked(_positives(vectors, sent, positives), positives).select(
        "at", (F.col("rank") - 1).alias("slot"), F.col("vec_id").alias("positive_id"),
        F.col("score").alias("positive_score")), "positives")
    low = np.full((positives, len(anchors.ids)), 1, np.int64)
    high = np.zeros((positives, len(anchors.ids)), np.int64)
    for r in own.collect():  # a few rows for each anchor of the block
        low[r["slot"], r["at"]] = -(-least_share * r["positive_score"] // 100)
        high[r["slot"], r["at"]] = r["positive_score"]
    bounds = spark.sparkContext.broadcast((low, high))
    found = _ranked(_negatives(vectors, sent, bounds, positives, negatives), negatives)
    names = spark.createDataFrame([(i, int(x)) for i, x in enumerate(anchors.ids)], "at bigint, anchor_id bigint")
    known = F.broadcast(own.join(F.broadcast(names), "at"))  # a few rows for each anchor of the block
    return found.join(known, ["at", "slot"]).select(
        "anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score",
        F.col("score").alias("negative_score"))


def hard_negatives(embeddings: DataFrame, every: int = EVERY, positives: int = POSITIVES, negatives: int = NEGATIVES,
                   least_share: int = LEAST_SHARE, scale: int = SCALE, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """anchor_id, positive_id, rank (from 1), negative_id, positive_score, negative_score.

    Anchors are the rows of ``embeddings`` (vec_id, embedding, label) whose vec_id is divisible by ``every``; a score
    is the inner product of the components times ``scale``, rounded down. An anchor's positives are its first rows of
    the same label, itself left out, by falling score and smaller vec_id; for each of them come the first rows of
    other labels whose scores are from ``least_share`` hundredths of the positive's up to that score. The label of
    every seventh vec_id counts as the next of ten.

    Rows without vec_id, label or vector, or with a null or non-finite component, take no part. Shorter vectors count
    as filled with zeros, an empty one as all zeros. Rows that repeat count each, as anchors, positives and negatives.
    A positive with a negative score has no negatives. Scores beyond 64 bits are clipped. An empty table, or one
    without anchors, gives no rows; other columns are not looked at.
    """
    spark = embeddings.sparkSession
    vectors = prepared(embeddings, scale)
    asked = rank_keys(vectors.where(F.col("vec_id") % every == 0), "place", ["row"], label="anchors")
    size = asked.agg(F.count("*").alias("n"), F.max(F.size("v")).alias("dim")).collect()[0]
    many = max(1, block_bytes // (8 * max(1, size["dim"] or 0)))
    parts = []
    for first in range(0, size["n"], many):
        block = asked.where(F.col("place").between(first + 1, first + many)).toArrow()
        block = block.combine_chunks().to_batches()[0]  # block_bytes at most
        rows, ids, labels = (block.column(n).to_numpy() for n in ("row", "vec_id", "label"))
        anchors = Anchors(rows, ids, labels, _matrix(block.column("v")))
        found = _mined(vectors, anchors, positives, negatives, least_share)
        parts.append(materialize(found, "hard-negatives") if size["n"] > many else found)
    out = spark.createDataFrame([], "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, "
                                    "positive_score bigint, negative_score bigint") if not parts else parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


ORACLE = """
WITH whole AS (
    SELECT row_number() OVER () AS r, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
pair AS (
    SELECT a.r, a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same, c.r AS other,
           list_inner_product(a.v::DOUBLE[], c.v::DOUBLE[])::BIGINT AS score
    FROM whole a JOIN whole c ON a.r <> c.r WHERE a.vec_id % 100 = 0),
pos AS (
    SELECT r, vec_id AS positive_id, score AS positive_score, other FROM pair WHERE same
    QUALIFY row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id) <= 5)
SELECT anchor_id, positive_id,
       (row_number() OVER best)::INTEGER AS rank, n.vec_id AS negative_id, positive_score, n.score AS negative_score
FROM pos p JOIN pair n ON n.r = p.r AND NOT n.same
     AND 80 * positive_score <= 100 * n.score AND n.score <= positive_score
WINDOW best AS (PARTITION BY p.r, p.other ORDER BY n.score DESC, n.vec_id)
QUALIFY row_number() OVER best <= 5
"""
