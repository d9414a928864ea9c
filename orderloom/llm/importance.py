"""Resampling documents towards a target: hashed word runs, log ratios of their buckets, Gumbel draws.

Features are runs of one to three words, their buckets CRCs of their bytes. A task lays the words of its texts one
after the other, numbers the distinct runs, and works out the CRCs of all runs of one length together: their bytes
form a two-dimensional array, and every step updates the registers of all runs by one column. The CRCs are then
scattered back to the runs. Runs longer than ``ROW`` bytes are rows of that many bytes in the same arrays, and their
registers are put together by the linear map that ``ROW`` zero bytes stand for.

The corpus is read twice: once to count features per bucket, once to sum up each document's gains. What the driver
sees is one count per bucket.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from orderloom.llm.common import whole_text
from orderloom.llm.words import SLICE, normalized, slices
from orderloom.operators.keys import rank_keys
from orderloom.session import materialize

BUCKETS = 10_000
ORDERS = 3
LEAST_WORDS = 20
PERCENT = 5
SEED = 42
# Bytes in a row of the CRC arrays, and bytes in one array.
ROW = 256
_AREA = 1 << 18
_FULL = np.uint32(0xFFFFFFFF)


def _byte_table() -> np.ndarray:
    """The register after each byte, by the reflected polynomial 0xEDB88320."""
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = (table >> np.uint32(1)) ^ np.where(table & np.uint32(1), np.uint32(0xEDB88320), np.uint32(0))
    return table.astype(np.uint32)


_TABLE = _byte_table()


def _registers(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray, first: np.ndarray) -> np.ndarray:
    """The CRC registers of stretches of the bytes, each from its own first register; grouped by equal length."""
    out = first.copy()
    order = np.argsort(lengths.astype(np.uint16), kind="stable")  # ROW at most
    cuts = np.flatnonzero(np.diff(lengths[order])) + 1
    for group in np.split(order, cuts):
        length = int(lengths[group[0]]) if len(group) else 0
        if not length:
            continue
        many = max(1, _AREA // length)
        for at in range(0, len(group), many):
            part = group[at:at + many]
            columns = data.take(starts[part][None, :] + np.arange(length)[:, None])
            crc = first[part]
            for column in columns:
                crc = _TABLE.take((crc ^ column) & np.uint32(0xFF)) ^ (crc >> np.uint32(8))
            out[part] = crc
    return out


def _row_map() -> list[np.ndarray]:
    """What ``ROW`` zero bytes make of a register, by its four bytes; the map is linear."""
    zeros = np.zeros(ROW, np.uint8)
    values = [np.arange(256, dtype=np.uint32) << np.uint32(8 * k) for k in range(4)]
    none = np.zeros(256, np.int64)
    return [_registers(zeros, none, none + ROW, v) for v in values]


_ROW_MAP = _row_map()


def crcs(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The CRC-32 of each stretch of the bytes."""
    rows = np.maximum(lengths - 1, 0) // ROW  # whole rows after the first stretch of 1 to ROW bytes
    heads = lengths - rows * ROW
    many = int(rows.sum())
    if not many:
        return _registers(data, starts, lengths, np.full(len(starts), _FULL)) ^ _FULL
    owner = np.repeat(np.arange(len(starts)), rows)
    turn = np.arange(many) - np.repeat(np.cumsum(rows) - rows, rows)
    found = _registers(data, np.concatenate((starts, starts[owner] + heads[owner] + turn * ROW)),
                       np.concatenate((heads, np.full(many, ROW, np.int64))),
                       np.concatenate((np.full(len(starts), _FULL), np.zeros(many, np.uint32))))
    out, tails = found[:len(starts)], found[len(starts):]
    order = np.argsort(turn, kind="stable")
    for which in np.split(order, np.flatnonzero(np.diff(turn[order])) + 1):
        crc = out[owner[which]]
        moved = np.zeros(len(which), np.uint32)
        for k in range(4):
            moved ^= _ROW_MAP[k][(crc >> np.uint32(8 * k)) & np.uint32(0xFF)]
        out[owner[which]] = moved ^ tails[which]
    return out ^ _FULL


def _units(texts: list[bytes]) -> Iterator[tuple[list[bytes], np.ndarray, np.ndarray]]:
    """(words, which text each is of, whether runs that end there count), a megabyte of text at a time.

    A slice of a long text starts with the last words of the one before, which end runs counted there.
    """
    words: list[bytes] = []
    owners: list[tuple[int, int, bool]] = []  # (text, words, whether they count)
    size = 0

    def made() -> tuple[list[bytes], np.ndarray, np.ndarray]:
        counts = [n for _, n, _ in owners]
        return words, np.repeat([t for t, _, _ in owners], counts), np.repeat([c for _, _, c in owners], counts)
    for i, text in enumerate(texts):
        text = normalized(text)
        before: list[bytes] = []
        for first, end in slices(text):
            own = text[first:end].split()
            words = words + before if before else words
            words += own
            owners += [(i, len(before), False), (i, len(own), True)]
            size += end - first
            before = (before + own)[1 - ORDERS:]
            if size >= SLICE:
                yield made()
                words, owners, size = [], [], 0
                continue
            if end < len(text):
                yield made()
                words, owners, size = [], [], 0
    if owners:
        yield made()


def _buckets_of(words: list[bytes], owner: np.ndarray, counts: np.ndarray,
                buckets: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(text, bucket) of all runs of one word, of two, of three; each distinct run is hashed once."""
    if not words:
        return
    numbers = {w: i for i, w in enumerate(dict.fromkeys(words))}
    code = np.fromiter(map(numbers.__getitem__, words), np.int64, len(words))
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    starts = np.cumsum(sizes + 1) - sizes - 1
    ends = starts + sizes
    data = np.frombuffer(b" ".join(words), np.uint8)
    runs, distinct = code, len(numbers)
    for n in range(1, ORDERS + 1):
        if n > 1:
            if len(words) < n:
                return
            runs, found = pd.factorize(runs[:-1] * np.int64(len(numbers)) + code[n - 1:])
            distinct = len(found)
        at = np.flatnonzero(counts[n - 1:] & (owner[:len(words) - n + 1] == owner[n - 1:]))
        place = np.full(distinct, -1, np.int64)
        place[runs[at]] = at
        used = np.flatnonzero(place >= 0)
        first = place[used]
        own = np.zeros(distinct, np.int64)
        own[used] = crcs(data, starts[first], ends[first + n - 1] - starts[first]).astype(np.int64) % buckets
        yield owner[at], own[runs[at]]


def _texts(batch: pa.RecordBatch, column: int) -> list[bytes]:
    return [t.as_py() for t in batch.column(column).cast(pa.binary())]


def bucket_counts(rows: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, n): how many features of all texts of ``rows`` (text) are in each bucket. Tasks add up their own."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(buckets, np.int64)
        for batch in batches:
            for words, owner, counts in _units(_texts(batch, 0)):
                for _, found in _buckets_of(words, owner, counts, buckets):
                    sums += np.bincount(found, minlength=buckets)
        used = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array(sums[used])], ["bucket", "n"])
    parts = rows.select(whole_text().alias("text")).mapInArrow(run, "bucket bigint, n bigint")
    return parts.groupBy("bucket").agg(F.sum("n").alias("n"))


def _counted(rows: DataFrame, buckets: int) -> list[int]:
    out = [0] * buckets
    for r in bucket_counts(rows, buckets).collect():  # one row a bucket at most
        out[r["bucket"]] = r["n"]
    return out


def gains(corpus: list[int], target: list[int]) -> list[int]:
    """For each bucket the thousandfold log ratio of its share of the target to its share of the corpus, each count
    raised by one, rounded down."""
    buckets, all_s, all_t = len(corpus), sum(corpus), sum(target)
    return [math.floor(1000 * math.log((t + 1.0) * (all_s + buckets) / ((s + 1.0) * (all_t + buckets))))
            for s, t in zip(corpus, target)]


def weighed(docs: DataFrame, gain: list[int]) -> DataFrame:
    """(doc_id, n_words, n_features, weight) per row of ``docs``."""
    gain_of = np.array(gain, np.float64)  # whole numbers; their sums stay exact far beyond any text
    names = ["doc_id", "n_words", "n_features", "weight"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_words = np.zeros(batch.num_rows, np.int64)
            n_features = np.zeros(batch.num_rows, np.int64)
            weight = np.zeros(batch.num_rows)
            for words, owner, counts in _units(_texts(batch, 1)):
                n_words += np.bincount(owner[counts], minlength=batch.num_rows)
                for text, found in _buckets_of(words, owner, counts, len(gain_of)):
                    n_features += np.bincount(text, minlength=batch.num_rows)
                    weight += np.bincount(text, gain_of[found], batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n_words), pa.array(n_features),
                                              pa.array(weight.astype(np.int64))], names)
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), whole_text().alias("text"))
    return texts.mapInArrow(run, ", ".join(f"{n} bigint" for n in names))


def importance(docs: DataFrame, target: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS,
               seed: int = SEED, buckets: int = BUCKETS) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, n_words, n_features, weight, score, rank.

    Words are runs of ASCII letters and digits and of all characters beyond ASCII, with A-Z in lower case. Features
    are all runs of one to three consecutive words, repeats counted; a feature's bucket is the CRC-32 of its bytes
    modulo ``buckets``. weight is the sum of the gains of a document's features, and score adds a Gumbel draw made
    from a hash of ``seed`` and doc_id. Of the N documents with ``least_words`` words or more the floor(N * percent /
    100) best are drawn: rank from 1, by score and smaller doc_id; others have no rank. ``target`` (text) is what the
    documents shall resemble.

    Null and empty texts have no features, weigh 0 and are never drawn (unless ``least_words`` is 0). A null doc_id
    draws as an empty one and ranks last among equals; rows that repeat are drawn each, those equal in score and
    doc_id by fewer features, then smaller weight. Empty tables give no rows, or counts of nought; other columns are
    not looked at.
    """
    gain = gains(_counted(docs, buckets), _counted(target, buckets))
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    drawn = F.conv(F.substring(F.sha2(name, 256), 1, 8), 16, 10).cast("double")
    noise = F.floor(-1000 * F.log(-F.log((drawn + 0.5) / F.lit(4294967296.0)))).cast("bigint")
    scored = materialize(weighed(docs, gain).withColumn("score", F.col("weight") + noise), "scored")
    fit = scored.where(F.col("n_words") >= least_words)
    take = fit.count() * percent // 100
    ordered = fit.select("*", (-F.col("score")).alias("falling"), F.col("doc_id").isNull().alias("unnamed"))
    ranked = rank_keys(ordered, "place", ["falling", "unnamed", "doc_id", "n_features", "weight"], label="drawn",
                       keep=scored.columns)
    columns = ["doc_id", "n_words", "n_features", "weight", "score"]
    rank = F.when(F.col("place") <= take, F.col("place"))
    return ranked.select(*columns, rank.alias("rank")).unionByName(
        scored.where(F.col("n_words") < least_words).select(*columns, F.lit(None).cast("bigint").alias("rank")))


# The register is linear in the bytes, so a CRC is the sum (xor) of what each byte leaves behind after the bytes that
# follow it, and of what the first register leaves behind.
ORACLE = r"""
WITH RECURSIVE bits AS (
    SELECT b, 0 AS k, b::UBIGINT AS v FROM (SELECT unnest(range(256)) AS b)
    UNION ALL
    SELECT b, k + 1, xor(v >> 1, CASE WHEN v % 2 = 1 THEN 3988292384 ELSE 0 END::UBIGINT) FROM bits WHERE k < 8),
turn AS (SELECT b::UBIGINT AS b, v FROM bits WHERE k = 8),
text AS (
    SELECT r, doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM (SELECT row_number() OVER () AS r, doc_id, text FROM documents
          UNION ALL SELECT -row_number() OVER (), NULL, text FROM benchmark)),
part AS (
    SELECT r, array_to_string(w[i:i + n - 1], ' ') AS f
    FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i
          FROM text, (VALUES (1), (2), (3)) AS o(n) WHERE len(w) >= n)),
own AS (SELECT r, f, count(*) AS n FROM part GROUP BY r, f),
byte AS (
    SELECT f, bytes, unnest(range(0, bytes)) AS p, h
    FROM (SELECT f, hex(encode(f)) AS h, octet_length(encode(f)) AS bytes FROM (SELECT DISTINCT f FROM own))),
longest AS (SELECT max(bytes) AS m FROM byte),
left_behind AS (
    SELECT b, 0 AS after, v FROM turn
    UNION ALL
    SELECT l.b, l.after + 1, xor(t.v, l.v >> 8)
    FROM left_behind l JOIN turn t ON t.b = l.v % 256 JOIN longest ON l.after < m),
begun AS (
    SELECT 0 AS after, 4294967295::UBIGINT AS v
    UNION ALL
    SELECT l.after + 1, xor(t.v, l.v >> 8) FROM begun l JOIN turn t ON t.b = l.v % 256 JOIN longest ON l.after < m),
sums AS (
    SELECT f, bytes, bit_xor(l.v) AS v
    FROM byte JOIN left_behind l
      ON l.after = bytes - 1 - p AND l.b = ('0x' || substr(h, 2 * p + 1, 2))::UBIGINT
    GROUP BY f, bytes),
bucket AS (
    SELECT f, (xor(xor(sums.v, begun.v), 4294967295::UBIGINT) % 10000)::BIGINT AS b
    FROM sums JOIN begun ON begun.after = bytes),
counted AS (
    SELECT b, coalesce(sum(n) FILTER (WHERE r > 0), 0) AS s, coalesce(sum(n) FILTER (WHERE r < 0), 0) AS t
    FROM own JOIN bucket USING (f) GROUP BY b),
total AS (SELECT coalesce(sum(s), 0)::DOUBLE AS s, coalesce(sum(t), 0)::DOUBLE AS t FROM counted),
gain AS (
    SELECT b, floor(1000 * ln((c.t + 1)::DOUBLE * (total.s + 10000) / ((c.s + 1)::DOUBLE * (total.t + 10000))))::BIGINT
              AS g FROM counted c, total),
weighed AS (
    SELECT r, sum(n)::BIGINT AS n_features, sum(n * g)::BIGINT AS weight
    FROM own JOIN bucket USING (f) JOIN gain USING (b) GROUP BY r),
scored AS (
    SELECT text.r, doc_id, len(w) AS words, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
           coalesce(weight, 0) + floor(-1000 * ln(-ln((
               ('0x' || substr(sha256('42:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::UBIGINT::DOUBLE + 0.5)
               / 4294967296)))::BIGINT AS score
    FROM text LEFT JOIN weighed ON weighed.r = text.r WHERE text.r > 0),
fit AS (
    SELECT r, row_number() OVER (ORDER BY score DESC, doc_id NULLS LAST, n_features, weight) AS rank FROM scored
    WHERE words >= 20)
SELECT doc_id, n_features, weight, score,
       CASE WHEN rank <= (SELECT count(*) * 5 // 100 FROM fit) THEN rank END AS rank
FROM scored LEFT JOIN fit USING (r)
"""
