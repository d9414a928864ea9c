"""The largest inner products, exactly: vectors grouped by length, pruned by what each group must reach.

Vectors are packed into blocks of similar length, longest lengths first among the bounds. A first look at one block of
long vectors gives every query a score it already has k times. A block whose vectors are too short to reach that for
any query of a query block is not paired with it at all. Within a pair, the score left to beat, divided by both
lengths, is the cosine a query needs here: if none can have it, the query skips the block; if it is low, only the
lengths are compared; if it is high, the vector's largest coordinates must lie in a narrow range around the query's,
and only what passes is multiplied. All products are of whole numbers and exact.

Queries are taken out of the blocks and packed again, thousands of one bucket together, so that a block of vectors is
moved once for so many queries. Each knows the place it was taken from, which is what it is not compared with.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.window import Window

from orderloom.session import materialize

SCALE = 256
EVERY = 50
K = 5
# Needed cosines from here on are worth comparing coordinates for; below, nearly every vector passes.
COORDINATE_COSINE = 0.6
_FOCUS = 3
# Lengths in one bucket differ by this factor at most.
_STEP = 1.25
_ZERO = -10_000
# Queries in one block, about.
QUERY_ROWS = 4096
_BLOCK_SCHEMA = ("block bigint, bucket int, n int, dim int, most double, ids binary, norms binary, wide boolean, "
                 "data binary")


def quantized(embeddings: DataFrame, scale: int = SCALE) -> DataFrame:
    """vec_id and v, each component times ``scale`` rounded down; only vectors with an id and finite components."""
    whole = F.transform("embedding", lambda x: F.floor(x.cast("double") * F.lit(float(scale))))
    fine = F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & F.forall(
        "embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return embeddings.select("vec_id", "embedding").where(fine).select("vec_id", whole.alias("v"))


def _matrix(vectors: list) -> np.ndarray:
    """Rows of whole numbers, short ones filled with zeros; Python numbers where products could pass 64 bits."""
    dim = max(map(len, vectors), default=0)
    out = np.zeros((len(vectors), dim), np.int64)
    for i, v in enumerate(vectors):
        out[i, :len(v)] = v
    return out


def _blocks(vectors: DataFrame, label: str) -> DataFrame:
    """The vectors packed by length, a row for each bucket of each Arrow batch; no shuffle, bounded by the batch."""
    names = [p.split()[0] for p in _BLOCK_SCHEMA.split(", ")]
    kinds = [pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.float64(), pa.binary(), pa.binary(), pa.bool_(),
             pa.binary()]

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 32
        for batch in batches:
            if not batch.num_rows:
                continue
            ids, column = np.array(batch.column(0).to_pylist(), np.int64), batch.column(1)
            values, ends = column.flatten().to_numpy(zero_copy_only=False), np.diff(column.offsets.to_numpy())
            if len(set(ends.tolist())) == 1:
                matrix = values.astype(np.int64).reshape(len(ids), ends[0])
            else:
                matrix = _matrix(column.to_pylist())
            norms = np.sqrt((matrix.astype(np.float64) ** 2).sum(1))
            bucket = np.where(norms > 0, np.ceil(np.log(np.maximum(norms, 1)) / np.log(_STEP)), _ZERO).astype(int)
            for b in np.unique(bucket):
                at = np.flatnonzero(bucket == b)
                at = at[np.argsort(-norms[at], kind="stable")]
                part = matrix[at]
                wide = bool(part.size and np.abs(part.astype(np.float64)).max() >= 2 ** 31)
                data = part.astype(np.int64 if wide else np.int32)
                yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(
                    (block, int(b), len(at), part.shape[1], float(norms[at].max()), ids[at].tobytes(),
                     norms[at].tobytes(), wide, data.tobytes()), kinds)], names)
                block += 1
    return materialize(vectors.mapInArrow(pack, _BLOCK_SCHEMA), label)


_QUERY_NAMES = ["block", "bucket", "n", "dim", "most", "ids", "norms", "wide", "data", "origins"]
_QUERY_SCHEMA = _BLOCK_SCHEMA + ", origins binary"
_QUERY_TYPES = [pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.float64(), pa.binary(), pa.binary(), pa.bool_(),
                pa.binary(), pa.binary()]


def _query_row(block: int, bucket: int, ids: np.ndarray, norms: np.ndarray, rows: np.ndarray, wide: bool,
               origins: np.ndarray) -> list:
    """A block of queries in the order of falling lengths."""
    order = np.argsort(-norms, kind="stable")
    data = rows[order].astype(np.int64 if wide else np.int32)
    return [block, bucket, len(ids), rows.shape[1], float(norms.max(initial=0)), ids[order].tobytes(),
            norms[order].tobytes(), wide, data.tobytes(), origins[order].tobytes()]


def _query_blocks(blocks: DataFrame, every: int) -> DataFrame:
    """The vectors of the blocks whose id is divisible by ``every``, as blocks of ``QUERY_ROWS`` of one bucket, about;
    "origins" has the block and the place in it that each was taken from."""
    def take(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                held = _Block(row)
                at = np.flatnonzero(held.ids % every == 0)
                if len(at):
                    origins = np.stack([np.full(len(at), row["block"], np.int64), at], 1)
                    values = _query_row(row["block"], row["bucket"], held.ids[at], held.norms[at], held.rows[at],
                                        row["wide"], origins)
                    yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, _QUERY_TYPES)],
                                                     _QUERY_NAMES)
    pieces = materialize(blocks.mapInArrow(take, _QUERY_SCHEMA), "query-pieces")
    counts = pieces.groupBy("bucket").agg(F.sum("n").alias("total")).select(
        F.col("bucket").alias("of"), F.ceil(F.col("total") / QUERY_ROWS).alias("slots"))
    # A row for each bucket, a few hundred at most by their step.
    dealt = pieces.join(F.broadcast(counts), F.col("bucket") == F.col("of")).withColumn(
        "slot", F.pmod(F.xxhash64("block"), F.col("slots")))

    def pack(key: tuple, part: pa.Table) -> pa.Table:
        held = [(_Block(row), np.frombuffer(row["origins"], np.int64).reshape(-1, 2), row["wide"])
                for row in part.to_pylist()]
        dim = max(b.rows.shape[1] for b, _, _ in held)
        rows = np.concatenate([np.pad(b.rows.astype(np.int64), ((0, 0), (0, dim - b.rows.shape[1])))
                               for b, _, _ in held])
        values = _query_row(min(part.column("block").to_pylist()), key[0].as_py(),
                            np.concatenate([b.ids for b, _, _ in held]), np.concatenate([b.norms for b, _, _ in held]),
                            rows, any(w for _, _, w in held), np.concatenate([o for _, o, _ in held]))
        return pa.table({n: pa.array([v], t) for n, v, t in zip(_QUERY_NAMES, values, _QUERY_TYPES)})
    packed = dealt.select("slot", *_QUERY_NAMES).groupBy("bucket", "slot").applyInArrow(pack, _QUERY_SCHEMA)
    return materialize(packed, "query-blocks")


class _Block:
    """A block as arrays: ids, norms (falling) and rows of whole numbers; for queries also where they come from."""

    def __init__(self, row: dict):
        self.ids = np.frombuffer(row["ids"], np.int64)
        self.norms = np.frombuffer(row["norms"], np.float64)
        self.rows = np.frombuffer(row["data"], np.int64 if row["wide"] else np.int32).reshape(row["n"], row["dim"])
        self.most = float(row["most"])
        self.number = row.get("block")
        self.origins = np.frombuffer(row["origins"], np.int64).reshape(-1, 2) if row.get("origins") else None
        self.sorted: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def own_place(self, query: int, block: "_Block") -> int:
        """The place of a query in the block it comes from, -1 in others."""
        origin, place = self.origins[query]
        return int(place) if origin == block.number else -1

    def within(self, coordinate: int, low: float, high: float) -> np.ndarray:
        """The rows whose coordinate, over their length, lies in a range."""
        if coordinate not in self.sorted:
            if coordinate < self.rows.shape[1]:
                share = self.rows[:, coordinate] / np.maximum(self.norms, 1e-300)
            else:
                share = np.zeros(len(self.ids))
            order = np.argsort(share, kind="stable")
            self.sorted[coordinate] = order, share[order]
        order, share = self.sorted[coordinate]
        return order[np.searchsorted(share, low, "left"):np.searchsorted(share, high, "right")]


def _products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of the rows of a and b, clipped to 64 bits."""
    dim = min(a.shape[1], b.shape[1])
    a, b = a[:, :dim], b[:, :dim]
    most = float(np.abs(a.astype(np.float64)).max(initial=0)) * float(np.abs(b.astype(np.float64)).max(initial=0))
    if most * dim < 2 ** 52:
        return (a.astype(np.float64) @ b.T.astype(np.float64)).astype(np.int64)
    if most * dim < 2 ** 62:
        return a.astype(np.int64) @ b.T.astype(np.int64)
    exact = a.astype(object) @ b.T.astype(object)
    return np.clip(exact, -2 ** 63, 2 ** 63 - 1).astype(np.int64)


def _best(scores: np.ndarray, ids: np.ndarray, own: np.ndarray | int, k: int) -> list[tuple[int, int]]:
    """The k best (score, id), equal scores by smaller id, without the query's own place, if any (-1 for none)."""
    if own >= 0:
        scores, ids = np.delete(scores, own), np.delete(ids, own)
    if len(scores) > k:
        least = np.partition(scores, len(scores) - k)[len(scores) - k]
        reach = scores >= least
        scores, ids = scores[reach], ids[reach]
    order = np.lexsort((ids, -scores))[:k]
    return [(int(scores[i]), int(ids[i])) for i in order]


def _search(queries: _Block, block: _Block, reached: np.ndarray, k: int) -> list[tuple[int, int, int]]:
    """(row of the query, id, score) for what may be among a query's k best; ``reached``: the score it has k times."""
    found, plain = [], []
    for q in range(len(queries.ids)):
        length, least = queries.norms[q], reached[q]
        if least <= 0 or length == 0:
            plain.append((q, len(block.ids)))
            continue
        cosine = least / (length * block.most) * (1 - 1e-9)
        if cosine > 1:
            continue
        if cosine < COORDINATE_COSINE:
            plain.append((q, int(np.searchsorted(-block.norms, -least / length * (1 - 1e-9), "right"))))
            continue
        share = queries.rows[q] / length
        keep = None
        for c in np.argsort(-np.abs(share), kind="stable")[:_FOCUS]:
            spread = np.sqrt((1 - cosine ** 2) * max(0.0, 1 - share[c] ** 2)) + 1e-6
            middle = share[c] * cosine
            # Above the needed cosine the range can only narrow, but for the end beyond the query's own share.
            low = -1.0 if share[c] < -cosine else middle - spread
            high = 1.0 if share[c] > cosine else middle + spread
            these = block.within(int(c), low, high)
            keep = these if keep is None else keep[np.isin(keep, these, assume_unique=True)]
        keep = keep[keep != queries.own_place(q, block)]
        if len(keep):
            scores = _products(queries.rows[q:q + 1], block.rows[keep])[0]
            found += [(q, i, s) for s, i in _best(scores, block.ids[keep], -1, k)]
    for first in range(0, len(plain), 256):
        some = plain[first:first + 256]
        reach = max(n for _, n in some)
        scores = _products(queries.rows[[q for q, _ in some]], block.rows[:reach])
        for line, (q, n) in zip(scores, some):
            own = queries.own_place(q, block)
            found += [(q, i, s) for s, i in _best(line[:n], block.ids[:n], own if own < n else -1, k)]
    return found


def _reached(queries: _Block, found: list[tuple[int, int, int]], k: int) -> np.ndarray:
    """For each query its k-th best score of those found, or what any score passes."""
    out = np.full(len(queries.ids), -2.0 ** 63)
    scores: dict[int, list[int]] = {}
    for q, _, s in found:
        scores.setdefault(q, []).append(s)
    for q, own in scores.items():
        if len(own) >= k:
            out[q] = sorted(own)[-k]
    return out


def top_k(embeddings: DataFrame, k: int = K, every: int = EVERY, scale: int = SCALE) -> DataFrame:
    """Each query's k highest scores: query_id, rank (from 1), vec_id, score.

    Queries are the rows of ``embeddings`` (vec_id, embedding) whose vec_id is divisible by ``every``; candidates
    are all rows but the query's own. A score is the inner product of the components times ``scale``, rounded down;
    equal scores go by smaller vec_id. Vectors that are null or hold null or non-finite components take no part, nor
    do rows without vec_id. Shorter vectors count as filled with zeros, an empty one as all zeros. Rows that repeat
    are candidates each, and a query that repeats is answered each time. Scores beyond 64 bits are clipped. An empty
    table gives no rows; other columns are not looked at.
    """
    spark = embeddings.sparkSession
    vectors = quantized(embeddings, scale)
    blocks = _blocks(vectors, "vector-blocks")
    queries = _query_blocks(blocks, every)
    seed = blocks.orderBy(F.desc("most"), F.desc("n"), "block").limit(1).collect()  # one block, bounded by a batch
    first = spark.sparkContext.broadcast(seed[0].asDict() if seed else None)

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = _Block(first.value) if first.value else None
        for batch in batches:
            for row in batch.to_pylist():
                own = _Block(row)
                reached = _reached(own, _search(own, block, np.full(len(own.ids), -2.0 ** 63), k), k)
                lengths = np.where(own.norms > 0, reached / np.maximum(own.norms, 1e-300), -np.inf)
                needed = float(np.where(reached > 0, lengths, 0.0).min()) * (1 - 1e-9)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["block"]], pa.int64()), pa.array([needed], pa.float64()),
                     pa.array([reached.tobytes()], pa.binary())], ["query", "needed", "reached"])
    looked = materialize(queries.mapInArrow(look, "query bigint, needed double, reached binary"), "query-scores")
    # A pair of blocks for each query block and each bucket that holds something long enough.
    buckets = blocks.groupBy("bucket").agg(F.max("most").alias("longest"))  # a few hundred at most, by their step
    longest = sorted((r["longest"], r["bucket"]) for r in buckets.collect())
    pairs = looked.select("query", F.explode(F.filter(
        F.array(*[F.struct(F.lit(n).alias("longest"), F.lit(b).alias("bucket")) for n, b in longest])
        if longest else F.array().cast("array<struct<longest:double,bucket:int>>"),
        lambda b: b["longest"] >= F.col("needed"))["bucket"]).alias("bucket"), "needed")
    places = blocks.select("block", "bucket", "most")
    pairs = pairs.join(places, "bucket").where("most >= needed").select("query", "block")
    asked = queries.join(looked, queries["block"] == looked["query"]).select(
        "query", *[F.col(c).alias(f"q_{c}") for c in ("n", "dim", "most", "ids", "norms", "wide", "data", "origins")], "reached")
    work = pairs.join(asked, "query").join(blocks, "block")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = {n: batch.column(n)[i].as_py() for n in batch.schema.names}
                own = _Block({c[2:]: v for c, v in row.items() if c.startswith("q_")})
                found = _search(own, _Block(row), np.frombuffer(row["reached"], np.float64), k)
                if found:
                    at, ids, scores = zip(*found)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([row["query"]] * len(at), pa.int64()), pa.array(at, pa.int32()),
                         pa.array(own.ids[list(at)], pa.int64()), pa.array(ids, pa.int64()),
                         pa.array(scores, pa.int64())], ["query", "at", "query_id", "vec_id", "score"])
    columns = ["query", *[f"q_{c}" for c in ("n", "dim", "most", "ids", "norms", "wide", "data", "origins")], "reached",
               "block", "n", "dim", "most", "ids", "norms", "wide", "data"]
    scored = work.select(*columns).mapInArrow(
        verify, "query bigint, at int, query_id bigint, vec_id bigint, score bigint")
    rank = F.row_number().over(Window.partitionBy("query", "at").orderBy(F.desc("score"), "vec_id"))
    return scored.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


ORACLE = """
WITH whole AS (
    SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)
SELECT q.vec_id AS query_id, (row_number() OVER best)::INTEGER AS rank, c.vec_id,
       list_inner_product(q.v::DOUBLE[], c.v::DOUBLE[])::BIGINT AS score
FROM whole q JOIN whole c ON q.r <> c.r WHERE q.vec_id % 50 = 0
WINDOW best AS (PARTITION BY q.r
                ORDER BY list_inner_product(q.v::DOUBLE[], c.v::DOUBLE[]) DESC, c.vec_id)
QUALIFY row_number() OVER best <= 5
"""
