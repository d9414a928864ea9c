"""Benchmark passages in documents, by one automaton over the words of all benchmark items.

Texts are normalized byte by byte, so places stay what they are. The items' windows, runs of ten words, become the
keys of one Aho-Corasick automaton whose letters are words; a document's words go through it once, however many
windows there are. What is hit is given as runs of words and as offsets in the original text.

The windows are sent to the tasks as they are counted: a benchmark beyond ``BLOCK_BYTES`` is dealt out over several
automata, one pass over the documents each, and the hits of all passes are put together.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, functions as F

from orderloom.llm.common import fresh, whole_text
from orderloom.llm.words import normalized, slices
from orderloom.session import materialize

WINDOW = 10
# Bytes of windows (their words and item ids) in one automaton; it takes about ten times as much memory in a task.
BLOCK_BYTES = 8 << 20
_RUN = "struct<first:bigint,last:bigint,start:bigint,end:bigint>"
_SCANNED = f"row bigint, doc_id bigint, n_words bigint, runs array<{_RUN}>, items array<bigint>"
# The automaton built last in this worker, so that its next task need not build it again.
_built: dict[str, tuple] = {}


def item_windows(text: bytes, window: int) -> set[bytes]:
    """The runs of ``window`` words of an item, words joined by a space; all its words if there are fewer."""
    words = normalized(text).split()
    if not words:
        return set()
    return {b" ".join(words[i:i + window]) for i in range(max(1, len(words) - window + 1))}


def _windows(items: DataFrame, window: int) -> DataFrame:
    """(words, item_id) of all different windows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for item, text in zip(batch.column(0), batch.column(1).cast(pa.binary())):
                found = sorted(item_windows(text.as_py(), window))
                for first in range(0, len(found), 4096):
                    part = found[first:first + 4096]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(part, pa.binary()), pa.array([item.as_py()] * len(part), pa.int64())],
                        ["words", "item_id"])
    texts = items.select(F.col("item_id").cast("bigint"), whole_text().alias("text"))
    return texts.mapInArrow(run, "words binary, item_id bigint").distinct()


def _automaton(name: str, block: Broadcast) -> tuple:
    """(automaton, number of each word, items of each window, most words in a window); None without windows."""
    if name not in _built:
        _built.clear()
        numbers: dict[bytes, int] = {}
        machine = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
        owners: list[set] = []
        reach, places = 0, {}
        for words, item in block.value:
            if words not in places:
                parts = words.split()
                machine.add_word(tuple(numbers.setdefault(w, len(numbers) + 1) for w in parts),
                                 (len(owners), len(parts)))
                places[words] = len(owners)
                owners.append(set())
                reach = max(reach, len(parts))
            owners[places[words]].add(item)
        machine.make_automaton()
        _built[name] = machine if owners else None, numbers, owners, reach
    return _built[name]


def _joined(runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Runs (first, last) that touch or overlap, joined."""
    out: list[list[int]] = []
    for first, last in sorted(runs):
        if out and first <= out[-1][1] + 1:
            out[-1][1] = max(out[-1][1], last)
        else:
            out.append([first, last])
    return [tuple(r) for r in out]


def _scan(text: bytes, machine, numbers: dict, reach: int) -> tuple[int, list[tuple[int, int]], set[int]]:
    """How many words the text has, the runs of them that are hit, and which windows occur.

    A long text is worked on by slices; each also sees the words before it that a window could begin with.
    """
    seen, runs, found = 0, [], set()
    before: tuple = ()
    known = numbers.get
    for first, end in slices(text):
        own = tuple([known(w, 0) for w in text[first:end].split()])
        if machine is not None:
            base = seen - len(before)
            for at, (which, length) in machine.iter(before + own):
                found.add(which)
                last = base + at
                if runs and runs[-1][0] <= last - length + 1 <= runs[-1][1] + 1:
                    runs[-1] = runs[-1][0], max(last, runs[-1][1])
                else:
                    runs.append((last - length + 1, last))
            before = (before + own)[-(reach - 1):] if reach > 1 else ()
        seen += len(own)
    return seen, _joined(runs), found


def _offsets(text: bytes, runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """(start, end) in characters of the runs of words."""
    firsts, lasts = np.array([r[0] for r in runs]), np.array([r[1] for r in runs])
    starts, ends = np.zeros(len(runs), np.int64), np.zeros(len(runs), np.int64)
    seen, shift = 0, 0  # words and bytes inside characters so far
    for first, end in slices(text):
        part = np.frombuffer(text, np.uint8, end - first, first)
        edge = np.diff(np.concatenate(([False], part != 32, [False])).astype(np.int8))
        inside = np.concatenate(([0], np.cumsum((part & 0xC0) == 0x80))) + shift
        for at, places, out in ((np.flatnonzero(edge == 1), firsts, starts), (np.flatnonzero(edge == -1), lasts, ends)):
            here = np.flatnonzero((places >= seen) & (places < seen + len(at)))
            own = at[places[here] - seen]
            out[here] = own + first - inside[own]
        seen += len(at)
        shift = int(inside[-1])
    return list(zip(starts.tolist(), ends.tolist()))


def _scanned(texts: DataFrame, block: Broadcast, hits_only: bool) -> DataFrame:
    """Rows (row, doc_id, text) with their words counted and what one automaton hits in them."""
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.struct([(n, pa.int64()) for n in (
        "first", "last", "start", "end")])), pa.list_(pa.int64())]

    name = uuid.uuid4().hex

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine, numbers, owners, reach = _automaton(name, block)
        for batch in batches:
            out = []
            for row, doc, text in zip(batch.column(0), batch.column(1), batch.column(2).cast(pa.binary())):
                seen = normalized(text.as_py())
                n, runs, found = _scan(seen, machine, numbers, reach)
                if found or not hits_only:
                    items = set().union(*(owners[w] for w in found)) - {None}
                    spans = [{"first": a, "last": b, "start": s, "end": e} for (a, b), (s, e) in zip(
                        runs, _offsets(seen, runs) if runs else [])]
                    out.append((row.as_py(), doc.as_py(), n, spans, sorted(items)))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)],
                                                 [f.split()[0] for f in _SCANNED.split(", ")])
    return texts.mapInArrow(run, _SCANNED)


def _put_together(parts: DataFrame) -> DataFrame:
    """(row, runs, items) from the hits of several automata: runs that touch or overlap joined, items once each."""
    ordered = parts.groupBy("row").agg(
        F.array_sort(F.flatten(F.collect_list("runs"))).alias("found"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))

    def join(done, x):
        last = F.element_at(done, -1)
        longer = F.struct(last["first"].alias("first"), F.greatest(last["last"], x["last"]).alias("last"),
                          last["start"].alias("start"), F.greatest(last["end"], x["end"]).alias("end"))
        return F.when((F.size(done) > 0) & (x["first"] <= F.try_element_at(done, F.lit(-1))["last"] + 1),
                      F.concat(F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0))), F.array(longer))
                      ).otherwise(F.concat(done, F.array(x)))
    joined = F.aggregate("found", F.array().cast(f"array<{_RUN}>"), join)
    return ordered.select("row", joined.alias("runs"), "items")


def benchmark_hits(docs: DataFrame, items: DataFrame, window: int = WINDOW,
                   block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, n_words, runs (first and last word, start and end of the
    characters, end exclusive; longest runs of hit words, in order) and items (the item_ids of ``items`` (item_id,
    text) that have a window in the text, in order).

    Words are runs of ASCII letters and digits and of all characters beyond ASCII, with A-Z in lower case. A window is
    ``window`` consecutive words of an item, or all words of one that has fewer, but not none. A word of a document is
    hit if it is inside any occurrence of a window. Null and empty texts have no words; an item without words hits
    nothing, one without an item_id hits words but is not listed; items that repeat are listed once. Documents that
    repeat, or have no doc_id, give a row each. Empty tables give no rows, or no hits; other columns are not looked
    at.
    """
    spark = docs.sparkSession
    windows = materialize(_windows(items, window), "windows")
    total = windows.agg(F.sum(F.length("words") + 16).alias("bytes")).collect()[0]["bytes"] or 0
    blocks = max(1, -(-total // block_bytes))
    own = windows.withColumn("block", F.pmod(F.xxhash64("words", "item_id"), F.lit(blocks)))

    def sent(which: int) -> Broadcast:
        part = own.where(F.col("block") == which).collect()  # about block_bytes
        return spark.sparkContext.broadcast([(bytes(r["words"]), r["item_id"]) for r in part])
    columns = [F.col("doc_id").cast("bigint").alias("doc_id"), whole_text().alias("text")]
    if blocks == 1:
        return _scanned(docs.select(F.lit(0).cast("bigint").alias("row"), *columns), sent(0), False).drop("row")
    row, = fresh(docs, "row")
    texts = materialize(docs.withColumn(row, F.monotonically_increasing_id()).select(
        F.col(row).alias("row"), *columns), "numbered")
    scanned = [materialize(_scanned(texts, sent(i), i > 0), "scanned") for i in range(blocks)]
    hits = scanned[0].where(F.size("runs") > 0).select("row", "runs", "items")
    for part in scanned[1:]:
        hits = hits.unionByName(part.select("row", "runs", "items"))
    return scanned[0].select("row", "doc_id", "n_words").join(_put_together(hits), "row", "left").select(
        "doc_id", "n_words", F.coalesce("runs", F.array().cast(f"array<{_RUN}>")).alias("runs"),
        F.coalesce("items", F.array().cast("array<bigint>")).alias("items"))


def hit_digest(hits: DataFrame) -> DataFrame:
    """Counts and digests of ``benchmark_hits``: doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    n_hit = F.aggregate("runs", F.lit(0).cast("bigint"), lambda n, r: n + r["last"] - r["first"] + 1)
    names = F.array_join(F.array_sort(F.transform("items", lambda i: i.cast("string"))), ",")
    return hits.select("doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("bigint").alias("n_items"),
                       F.sha2(names, 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"))


ORACLE = r"""
WITH item AS (
    SELECT item_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
doc AS (
    SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
win AS (
    SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS run
    FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM item WHERE len(w) > 0)),
size AS (SELECT DISTINCT n FROM win),
part AS (
    SELECT r, n, i, array_to_string(w[i:i + n - 1], ' ') AS run
    FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM doc, size WHERE len(w) >= n)),
hit AS (SELECT r, i, n, item_id FROM part JOIN win USING (n, run)),
found AS (
    SELECT r, count(DISTINCT item_id) AS n_items,
           sha256(coalesce(string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR), '')) AS items_sha256
    FROM hit GROUP BY r),
word AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS p FROM hit) GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
       coalesce(n_items, 0)::BIGINT AS n_items, coalesce(items_sha256, sha256('')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM doc LEFT JOIN found USING (r) LEFT JOIN word USING (r)
"""
