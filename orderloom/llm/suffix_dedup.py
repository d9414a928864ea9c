"""Repeated passages by longest previous factors, from suffix arrays of truncated suffixes.

A window is a string of ``length`` bytes. Equal windows have equal smallest hashes among the short strings inside
them, so that hash deals the windows out: neighbouring windows with the same one form a segment, and windows can be
equal only if their segments have the same hash. A hash seen in one place only has nothing to compare. Of the others, equal
segments are counted as one, and the different ones are brought together, a few megabytes at a time, into one suffix
array. It sorts places by their first ``length`` bytes, and tells for neighbours in that order how much they have in
common, in the steps of the sorting. For each place the previous and the next smaller position in suffix order give its
longest earlier matches: what is in common on the way there is the length of the factor. They are followed only as long
as that is ``length``; a factor that is shorter does not count, however long it is. Places with a factor are later
copies; places that are the previous or next smaller position of a later copy are its earlier match.

A hash that very many different segments share, as at the edges of a passage quoted everywhere, is not brought
together: its windows are compared one by one, dealt out by a digest of the whole window.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from orderloom.llm.common import sized, whole_text
from orderloom.llm.hashing import running_sums, stretch_hashes
from orderloom.session import materialize

LENGTH = 400
# The short strings whose smallest hash deals the windows out.
GRAM = 32
# Windows of a segment at most, and of a text worked on at a time.
_RUN, _PIECE = 4096, 1 << 20
# Bytes of one suffix array, and of different segments with one hash that may go into one.
ARRAY_BYTES, SHARED_BYTES = 1 << 20, 1 << 20
_BATCH_BYTES = 4 << 20


def _sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """The smallest of each ``width`` neighbours, from minima that run forwards and backwards through blocks."""
    n = len(values)
    padded = np.full(-(-n // width) * width, np.iinfo(np.uint64).max, np.uint64)
    padded[:n] = values
    blocks = padded.reshape(-1, width)
    forward = np.minimum.accumulate(blocks, 1).ravel()
    backward = np.minimum.accumulate(blocks[:, ::-1], 1)[:, ::-1].ravel()
    return np.minimum(backward[:n - width + 1], forward[width - 1:n])


def segments(text: bytes, length: int, gram: int) -> Iterator[tuple[int, int, int, bool]]:
    """(hash, first window, number of windows, whether the hash has several places) for all windows, in order."""
    windows, width = len(text) - length + 1, length - gram + 1
    for first in range(0, max(windows, 0), _PIECE):
        last = min(first + _PIECE, windows)
        data = np.frombuffer(text, np.uint8, last - first + length - 1, first)
        at = np.arange(len(data) - gram + 1)
        hashes = stretch_hashes(running_sums(data), at, at + gram)
        least = _sliding_least(hashes, width)
        cuts = np.flatnonzero(least[1:] != least[:-1]) + 1
        for a, b in zip(np.concatenate(([0], cuts)).tolist(), np.concatenate((cuts, [len(least)])).tolist()):
            value = least[a]
            again = b - a > width or np.count_nonzero(hashes[a:b + width - 1] == value) > 1
            for start in range(a, b, _RUN):
                yield int(value.view(np.int64)), first + start, min(_RUN, b - start), bool(again)


def _anchors(texts: DataFrame, length: int, gram: int) -> DataFrame:
    """(anchor, tid, start, n, again) for the segments of rows (tid, text)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, 512):
                part = batch.slice(first, 512)
                rows = [(i, *found) for i, text in enumerate(part.column(1))
                        for found in segments(text.as_py(), length, gram)]
                if rows:
                    i, value, start, n, again = zip(*rows)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(value, pa.int64()), part.column(0).take(pa.array(i)), pa.array(start, pa.int64()),
                         pa.array(n, pa.int32()), pa.array(again, pa.bool_())],
                        ["anchor", "tid", "start", "n", "again"])
    return texts.mapInArrow(run, "anchor bigint, tid binary, start bigint, n int, again boolean")


def _contents(texts: DataFrame, length: int) -> DataFrame:
    """(anchor, digest, tid, first_id, start, n, again, content) for the wanted segments of (tid, first_id, text, runs)."""
    names = ["anchor", "digest", "tid", "first_id", "start", "n", "again", "content"]
    kinds = [pa.int64(), pa.binary(), pa.binary(), pa.int64(), pa.int64(), pa.int32(), pa.bool_(), pa.binary()]

    def batch(rows: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, held = [], 0
        for part in batches:
            for i in range(part.num_rows):
                tid, first_id, text, runs = (c[i].as_py() for c in part.columns)
                for r in runs:
                    content = text[r["start"]:r["start"] + r["n"] + length - 1]
                    digest = hashlib.blake2b(content, digest_size=16).digest()
                    rows.append((r["anchor"], digest, tid, first_id, r["start"], r["n"], r["again"], content))
                    held += len(content)
                    if held >= _BATCH_BYTES:
                        yield batch(rows)
                        rows, held = [], 0
        if rows:
            yield batch(rows)
    return texts.mapInArrow(run, "anchor bigint, digest binary, tid binary, first_id bigint, start bigint, n int, "
                                 "again boolean, content binary")


def _first(changed: np.ndarray) -> np.ndarray:
    """For each place the last one up to it where something changed."""
    return np.maximum.accumulate(np.where(changed, np.arange(len(changed)), 0))


def _changes(values: np.ndarray) -> np.ndarray:
    out = np.ones(len(values), bool)
    out[1:] = values[1:] != values[:-1]
    return out


def _needed(counts: np.ndarray, steps: list[int]) -> list[np.ndarray]:
    """For the first sorting and each step after it, the places whose ranks are needed to rank those that count in the
    end: themselves, and what the later steps look up behind them."""
    found = [counts]
    for step in reversed(steps):
        earlier = found[-1].copy()
        earlier[step:] |= found[-1][:-step]
        found.append(earlier)
    return found[::-1]


def _ranks(data: np.ndarray, length: int, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The rank of each place that counts among the strings that start at such places, by their first ``length`` bytes,
    equal for equal strings; and for each rank how many bytes its string has in common with the one before, as far as
    the sorting has compared them: 0, 7, 14, 28 and so on, or ``length`` where no string begins. For strings further
    apart it is the least of those of the ranks between.

    A rank is one more than how many strings come before at least, by the bytes covered so far. Strings that are still
    equal are told apart by the ranks of what follows, which doubles the bytes covered; those already alone keep their
    rank, and those that no later step needs are left as they are.
    """
    n = len(data)
    padded = np.zeros(n + 8, np.uint64)
    padded[:n] = data.astype(np.uint64) + np.uint64(1)  # what lies behind the end comes first
    key = np.zeros(n, np.uint64)
    covered = min(7, length)
    for i in range(covered):  # 9 bits each
        key = (key << np.uint64(9)) | padded[i:i + n]
    steps, reached = [], covered
    while reached < length:
        steps.append(min(reached, length - reached))
        reached += steps[-1]
    needed = _needed(counts, steps)
    rank, active = np.zeros(n, np.int64), np.flatnonzero(needed[0])
    key = key[active]
    common, known = np.full(n, length, np.int32), 0  # for each rank, with the string before
    common[:1] = 0
    for step, wanted in zip([*steps, 0], [*needed[1:], counts]):
        order = np.argsort(key)
        at, new = active[order], _changes(key[order])
        held, apart = rank[at], _changes(rank[at])
        rank[at] = held + _first(new) - _first(apart)
        common[rank[at[new & ~apart]]] = known
        active = at[~(new & np.append(new[1:], True))]
        active = active[wanted[active]]
        known = covered
        if not step or not len(active):
            break
        behind = np.where(active + step < n, rank[np.minimum(active + step, n - 1)] + 1, 0)
        key = rank[active] * (n + 1) + behind
        covered += step
    return rank, common


def suffix_order(data: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All places in the order of the strings that start there, by their first ``length`` bytes; each place's rank,
    equal for equal strings; and for each place in that order how many bytes it has in common with the one before, as
    far as the sorting has compared them."""
    rank, common = _ranks(data, length, np.ones(len(data), bool))
    order = np.argsort(rank, kind="stable")
    first = _changes(rank[order])
    return order, rank, np.where(first, common[rank[order]], length)


def smaller_positions(position: np.ndarray, common: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """For each place in suffix order the last place before it with a smaller position, and how much the two have in
    common; -1 where that is less than ``length``.

    ``common`` is what each place has in common with the one before. A place looks at the one before; if its position
    is larger, at the one that this one has found so far, which skips places with larger positions only, and so on;
    each step takes the lesser of what is in common.
    """
    previous, held = np.arange(len(position)) - 1, common.astype(np.int64)
    active = np.arange(1, len(position))
    if len(position):
        held[0] = 0
    while len(active):
        active = active[held[active] >= length]
        active = active[position[previous[active]] > position[active]]
        via = previous[active]
        held[active] = np.minimum(held[active], held[via])
        previous[active] = previous[via]
    return np.where(held >= length, previous, -1), held


def longest_factors(data: np.ndarray, position: np.ndarray, counts: np.ndarray,
                    length: int) -> tuple[np.ndarray, np.ndarray]:
    """For each place of the bytes the length of its longest previous factor, the longest string there that also
    starts at a smaller position, if that is ``length``, which is as far as strings are compared, and 0 otherwise; and
    whether it is the smaller position of another place with such a factor. Only places that count take part.
    """
    kept = np.flatnonzero(counts)
    if not len(kept):
        return np.zeros(len(data), np.int64), np.zeros(len(data), bool)
    rank, between = _ranks(data, length, counts)
    order = kept[np.lexsort((position[kept], rank[kept]))]  # equal as far as compared: the smallest first
    ranks = rank[order]
    firsts = np.flatnonzero(_changes(ranks))
    common = np.full(len(order), length, np.int32)
    common[0] = 0
    if len(firsts) > 1:
        # The ranks in between must have as much in common.
        common[firsts[1:]] = np.minimum.reduceat(between[:ranks[-1] + 1], ranks[firsts[:-1]] + 1)
    at = position[order]
    before, shared = smaller_positions(at, common, length)
    after, shared_after = smaller_positions(at[::-1], np.append(0, common[1:][::-1]), length)
    after = np.where(after >= 0, len(order) - 1 - after, -1)[::-1]
    factor = np.maximum(np.where(before >= 0, shared, 0), np.where(after >= 0, shared_after[::-1], 0))
    factors, matched = np.zeros(len(data), np.int64), np.zeros(len(data), bool)
    factors[order] = factor
    for found in (before, after):
        matched[order[found[found >= 0]]] = True
    return factors, matched


def _runs(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    edge = np.diff(np.concatenate(([False], flags, [False])).astype(np.int8))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


_MARK = "anchor bigint, digest binary, first int, last int, earliest boolean"


def _marks(anchor: int, digest: bytes, repeated: np.ndarray, earliest: np.ndarray) -> list[tuple]:
    """Stretches of repeated windows in a segment, apart for those that are the earliest of their kind."""
    out = []
    for kind in (True, False):
        for a, b in zip(*_runs(repeated & (earliest == kind))):
            out.append((anchor, digest, int(a), int(b), kind))
    return out


def _by_arrays(contents: DataFrame, length: int, arrays: int) -> DataFrame:
    """Marks of segments that are brought together into ``arrays`` suffix arrays."""
    names = [c.split()[0] for c in _MARK.split(", ")]

    def run(part: pd.DataFrame) -> pd.DataFrame:
        data = np.frombuffer(b"".join(part["content"]), np.uint8)
        sizes = part["content"].map(len).to_numpy()
        first_at = np.cumsum(sizes) - sizes
        named = sorted(set(zip(part["least_null"], part["least_id"], part["least_tid"])))
        place = {name: i for i, name in enumerate(named)}
        doc = np.array([place[x] for x in zip(part["least_null"], part["least_id"], part["least_tid"])], np.int64)
        position = np.repeat(doc << 40, sizes) + np.repeat(part["least_start"].to_numpy() - first_at, sizes) + (
            np.arange(len(data)))
        # Only windows that lie inside their segment count.
        inside = np.concatenate([np.arange(size) < n for size, n in zip(sizes, part["n"])])
        factors, matched = longest_factors(data, position, inside, length)
        later = factors >= length
        out = []
        for anchor, digest, n, at in zip(part["anchor"], part["digest"], part["n"], first_at):
            out += _marks(anchor, digest, later[at:at + n] | matched[at:at + n], ~later[at:at + n])
        return pd.DataFrame(out, columns=names)
    return contents.withColumn("array", F.pmod(F.xxhash64("anchor"), F.lit(arrays))).groupBy("array").applyInPandas(
        run, _MARK)


def _by_windows(contents: DataFrame, length: int) -> DataFrame:
    """Marks of segments whose windows are compared one by one."""
    names = ["window", "anchor", "digest", "at", "least_null", "least_id", "least_tid", "place"]

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                anchor, digest, n, content, null, least, tid, start = (c[i].as_py() for c in batch.columns)
                at = np.arange(n)
                found = [hashlib.blake2b(content[k:k + length], digest_size=16).digest() for k in range(n)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(found, pa.binary()), pa.array(np.full(n, anchor, np.int64)),
                     pa.array([digest] * n, pa.binary()), pa.array(at.astype(np.int32)),
                     pa.array([null] * n, pa.int32()), pa.array([least] * n, pa.int64()),
                     pa.array([tid] * n, pa.binary()), pa.array(at + start)], names)
    rows = contents.select("anchor", "digest", "n", "content", "least_null", "least_id", "least_tid",
                           "least_start").mapInArrow(
        windows, "window binary, anchor bigint, digest binary, at int, least_null int, least_id bigint, "
                 "least_tid binary, place bigint")
    rows = materialize(rows, "windows")
    order = F.struct("least_null", "least_id", "least_tid", "place", "digest", "at")
    shared = materialize(rows.groupBy("window").agg(F.count("*").alias("found"), F.min(order).alias("least")).where(
        "found > 1"), "shared-windows")
    found = rows.join(shared, "window").select("anchor", "digest", "at", (order == F.col("least")).alias("first"))

    def mark(part: pd.DataFrame) -> pd.DataFrame:
        n = int(part["at"].max()) + 1
        repeated, earliest = np.zeros(n, bool), np.zeros(n, bool)
        repeated[part["at"]] = True
        earliest[part["at"][part["first"]]] = True
        return pd.DataFrame(_marks(part["anchor"].iloc[0], part["digest"].iloc[0], repeated, earliest),
                            columns=[c.split()[0] for c in _MARK.split(", ")])
    return found.groupBy("anchor", "digest").applyInPandas(mark, _MARK)


def _rows(docs: DataFrame) -> DataFrame:
    text = docs.select("doc_id", whole_text().cast("binary").alias("text"))
    sha = F.sha2("text", 256)
    return text.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", sha.alias("sha"),
                       F.unhex(F.substring(sha, 1, 32)).alias("tid"))


def _only(texts: DataFrame, wanted: DataFrame) -> DataFrame:
    """One row of ``texts`` for each wanted (tid, first_id); rows that repeat both may come more than once."""
    wanted = materialize(wanted.select(F.col("tid").alias("want"), F.col("first_id").alias("want_id")), "wanted-texts")
    return texts.join(sized(wanted), (F.col("tid") == F.col("want")) & F.col("doc_id").eqNullSafe(F.col("want_id")))


def _starts(texts: DataFrame, groups: DataFrame, length: int, gram: int) -> DataFrame:
    """(tid, first, last, earliest): stretches of windows of a text that also start elsewhere in this or another text,
    and whether they are the earliest of their kind."""
    anchors = materialize(_anchors(texts.where(F.octet_length("text") >= length).select("tid", "text"), length, gram),
                          "anchors")
    place = F.xxhash64("tid", "start")
    repeated = materialize(anchors.groupBy("anchor").agg(
        F.min(place).alias("low"), F.max(place).alias("high"), F.max("again").alias("again")).where(
            "low < high OR again").select("anchor"), "repeated-anchors")
    runs = materialize(anchors.join(repeated, "anchor", "left_semi").groupBy("tid").agg(
        F.collect_set(F.struct("anchor", "start", "n", "again")).alias("runs")).join(
            groups.select("tid", "first_id"), "tid"), "runs")
    wanted = _only(texts, runs).select("tid", "want_id", "text").join(
        runs.select(F.col("tid").alias("of"), "runs"), F.col("tid") == F.col("of"))
    found = materialize(_contents(wanted.select("tid", "want_id", "text", "runs"), length), "segments")
    occurrences = found.select("anchor", "digest", "tid", "first_id", "start", "n", "again").distinct()
    least = F.min(F.struct(F.col("first_id").isNull().cast("int").alias("least_null"),
                           F.coalesce("first_id", F.lit(0)).alias("least_id"), F.col("tid").alias("least_tid"),
                           F.col("start").alias("least_start")))
    kinds = materialize(occurrences.groupBy("anchor", "digest").agg(
        least.alias("least"), F.count("*").alias("times"), F.max("n").alias("n"), F.max("again").alias("again")).select(
            "anchor", "digest", "times", "n", "again", "least.*"), "kinds")
    shared = kinds.groupBy("anchor").agg(
        F.count("*").alias("kinds"), F.max("again").alias("again"),
        F.sum(F.col("n") + length - 1).alias("bytes")).where("kinds > 1 OR again")
    shared = materialize(shared.select(F.col("anchor").alias("shared"), "bytes"), "shared-anchors")
    contents = found.select("anchor", "digest", "content").join(
        sized(shared), F.col("anchor") == F.col("shared")).dropDuplicates(["anchor", "digest"]).drop("shared")
    contents = materialize(contents.join(kinds, ["anchor", "digest"]), "contents")
    some = contents.where(F.col("bytes") <= SHARED_BYTES)
    total = some.agg(F.coalesce(F.sum(F.octet_length("content")), F.lit(0))).first()[0]
    marks = _by_arrays(some.drop("bytes", "times", "again"), length, max(1, -(-total // ARRAY_BYTES)))
    marks = marks.unionByName(_by_windows(contents.where(F.col("bytes") > SHARED_BYTES), length))
    marks = materialize(marks, "marks")
    # A segment that occurs several times is repeated as a whole; what is the earliest elsewhere is so in one of them.
    here = F.struct(F.col("first_id").isNull().cast("int"), F.coalesce("first_id", F.lit(0)), "tid", "start")
    placed = materialize(occurrences.join(kinds.select("anchor", "digest", "times", F.struct(
        "least_null", "least_id", "least_tid", "least_start").alias("least")), ["anchor", "digest"]).select(
            "anchor", "digest", "tid", "start", "n", "times", (here == F.col("least")).alias("is_least")), "placed")
    from_marks = placed.join(marks, ["anchor", "digest"]).select(
        "tid", (F.col("start") + F.col("first")).alias("first"), (F.col("start") + F.col("last")).alias("last"),
        (F.col("earliest") & F.col("is_least")).alias("earliest"))
    copies = placed.where("times > 1").select(
        "tid", F.col("start").alias("first"), (F.col("start") + F.col("n")).alias("last"),
        F.col("is_least").alias("earliest"))
    return from_marks.unionByName(copies)


def _merged(length: int, keep_first: bool):
    """From stretches of windows to the bytes they cover: (tid, first_id, spans)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = []
            for found in batch.column(2).to_pylist():
                gone: list[dict] = []
                for first, last in sorted((m["first"], m["last"]) for m in found
                                          if not (keep_first and m["earliest"])):
                    end = last - 1 + length
                    if gone and first <= gone[-1]["end"]:
                        gone[-1]["end"] = max(gone[-1]["end"], end)
                    else:
                        gone.append({"start": first, "end": end})
                spans.append(gone)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(spans, _SPANS)],
                                             ["tid", "first_id", "spans"])
    return run


_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
_SPAN = "array<struct<start:bigint,end:bigint>>"


def _without(text: bytes, spans: list[dict]) -> bytes:
    parts, at = [], 0
    for s in spans:
        parts.append(text[at:s["start"]])
        at = s["end"]
    return b"".join([*parts, text[at:]])


def _kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(tid, spans, kept_sha256) of (tid, text, spans)."""
    for batch in batches:
        kept = [hashlib.sha256(_without(t.as_py(), s)).hexdigest()
                for t, s in zip(batch.column(1), batch.column(2).to_pylist())]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(kept, pa.string())],
                                         ["tid", "spans", "kept_sha256"])


def repeated_passages(docs: DataFrame, length: int = LENGTH, keep_first: bool = True,
                      gram: int = GRAM) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, n_bytes, spans, kept_sha256.

    Spans are the byte ranges of the text in UTF-8 that are covered by strings of ``length`` bytes which also start
    somewhere else, in this or another text, overlaps included; kept_sha256 is the digest of the other bytes. With
    ``keep_first``, only strings that also start earlier count: earlier documents are those with smaller doc_id, a
    null doc_id comes last, and inside a document earlier places. Null and short texts have no spans. Rows that repeat
    have their strings in each other; with ``keep_first`` rows that share the smallest doc_id all count as the first.
    An empty table gives no rows; other columns are not looked at.
    """
    texts = _rows(docs)
    rows = materialize(texts.select("doc_id", "tid", "sha", F.octet_length("text").cast("bigint").alias("n_bytes")),
                       "rows")
    groups = materialize(rows.groupBy("tid").agg(F.count("*").alias("copies"), F.min("doc_id").alias("first_id")),
                         "texts")
    starts = _starts(texts, groups, length, gram)
    gathered = starts.groupBy("tid").agg(F.collect_set(F.struct("first", "last", "earliest")).alias("found")).join(
        groups.select("tid", "first_id"), "tid").select("tid", "first_id", "found")
    spans = materialize(gathered.mapInArrow(_merged(length, keep_first), f"tid binary, first_id bigint, spans {_SPAN}")
                        .where(F.size("spans") > 0), "spans")
    cut = _only(texts, spans).select("tid", "text").join(
        spans.select(F.col("tid").alias("of"), "spans"), F.col("tid") == F.col("of"))
    cut = materialize(cut.select("tid", "text", "spans").mapInArrow(
        _kept, f"tid binary, spans {_SPAN}, kept_sha256 string").dropDuplicates(["tid"]), "cut")
    copied = rows.join(groups.withColumnRenamed("tid", "of"), F.col("tid") == F.col("of")).join(
        cut.select(F.col("tid").alias("cut_tid"), "spans", "kept_sha256"), F.col("tid") == F.col("cut_tid"), "left")
    whole = (F.col("copies") > 1) & (F.col("n_bytes") >= length)
    if keep_first:
        whole = whole & ~F.col("doc_id").eqNullSafe(F.col("first_id"))
    everything = F.array(F.struct(F.lit(0).cast("bigint").alias("start"), F.col("n_bytes").alias("end")))
    return copied.select(
        "doc_id", "n_bytes",
        F.when(whole, everything).otherwise(F.coalesce("spans", F.array().cast(_SPAN))).alias("spans"),
        F.when(whole, F.sha2(F.lit(""), 256)).otherwise(F.coalesce("kept_sha256", "sha")).alias("kept_sha256"))


def passage_digest(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """How much of each document also stands elsewhere, and a digest of what does not."""
    removed = F.aggregate("spans", F.lit(0).cast("bigint"), lambda a, s: a + s["end"] - s["start"])
    return repeated_passages(docs, length, keep_first=False).select(
        "doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("bigint").alias("n_spans"),
        "kept_sha256", (F.size("spans") > 0).alias("repeated"))
