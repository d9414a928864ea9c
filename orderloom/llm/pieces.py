"""SentencePiece encoding and decoding as a relational lattice.

A text is cut where no piece of the vocabulary can span, into units of about a word. Each distinct unit is exploded
into its substrings up to the longest piece, these are joined with the table of pieces, and the matches, edges of the
unit's lattice, are grouped by unit again. A fold over the edges then picks the segmentation, as the model's kind asks
for: for a unigram model the best path (Viterbi), for a BPE model the merges in the order of their ranks. Texts are
represented by numbers of their words in a block's list, so that only distinct units are moved and encoded.
"""

from __future__ import annotations

import heapq
import itertools
import re
import zlib
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from orderloom.llm.common import whole_text
from orderloom.session import bound_batches

SPACE = "▁"
# Characters of text that share a list of units. A task holds a few dozen bytes for each distinct word of a block.
BLOCK_CHARS = 4 << 20
# Ids, and bytes that they stand for, of the documents that are put together at a time; one document has its own.
_JOINED = 1 << 17
# Of a long text so many characters are cut into words at a time.
_SLICE = 1 << 16
# Blocks of a task, and units of a block, as bits. A place where a unit is listed is one number: the block from the high
# bits on, and the unit's number in it.
_BLOCK_BITS, _NUMBER_BITS = 16, 28
# Partitions whose places of a unit are listed together, and the buckets that they deal their units to, as bits.
_SHARD_BITS, _BUCKET_BITS = 14, 10
# Places that are packed together, to be moved back to their blocks.
_PACKED_PLACES = 400_000
# The characters of a piece that tell how long those that begin with them are at most.
_HEAD = 3
# Units of more characters than a fold has bits for are encoded one by one.
FOLD_CHARS = 60
_UNKNOWN = (1 << 21) - 1


@dataclass(frozen=True)
class Vocabulary:
    """The pieces that text can be cut into, with id and score, and what is needed to cut and to put together."""

    pieces: dict[str, tuple[int, float]]
    byte_ids: tuple[int, ...]
    unknown_id: int
    texts: tuple[bytes, ...] = field(repr=False)
    kind: str = "bpe"
    dummy_prefix: bool = True

    @property
    def longest(self) -> int:
        return max(map(len, self.pieces))

    @cached_property
    def disorderly(self) -> frozenset[str]:
        """The pieces that may have to be merged after one of a worse place. Where none occurs, one pass over the places
        finds all merges.

        A piece can be merged once its inside is down to two parts. As nothing that crosses its ends can be merged
        before, the inside gets there by the same merges wherever the piece occurs, those of the piece alone. If all of
        them have better places than the piece itself, it has its turn when they are done.
        """
        found = set()
        for piece, (_, score) in self.pieces.items():
            made: list[float] = []
            _merged(piece, self, made)
            if len(made) == len(piece) - 1 and any(m <= score for m in made[:-1]):
                found.add(piece)
        return frozenset(found)

    def unit_pattern(self) -> str:
        """A pattern that cuts a text where no piece can span.

        Units begin at spaces, or where a letter or digit is followed by something else, if no piece says otherwise;
        characters that are in no longer piece stand alone. If the vocabulary has pieces that this would cut, units
        begin at spaces only, and if it has pieces with spaces inside, a text is one unit.
        """
        longer = [p for p in self.pieces if len(p) > 1]
        used = set("".join(longer))
        alone = "".join(re.escape(c) for c in "\n\r\t" if c not in used)
        odd = "".join(sorted({re.escape(a) for p in longer for a, b in zip(p, p[1:]) if a.isalnum()
                              and not re.match(r"[^\W_]", b)}))
        other = rf"(?:[^\w{SPACE}{alone}]|_)"
        letters = rf"[^\W_{odd}]*+"
        body = letters + (rf"(?:[{odd}]{other}*+{letters})*+" if odd else "")
        fine = (rf"[{alone}]|" if alone else "") + rf"{SPACE}++{other}*+{body}|{other}++{body}|(?=[^\W_]){body}"
        for pattern in (fine, rf"{SPACE}*+[^{SPACE}]++|{SPACE}++"):
            compiled = re.compile(pattern)
            if all(compiled.findall(p) == [p] for p in longer):
                return pattern
        return r"(?s).+"


def load_vocabulary(model_file: str, kind: str = "bpe") -> Vocabulary:
    """The vocabulary of a SentencePiece model file whose texts are taken as they are but for their spaces."""
    import sentencepiece
    model = sentencepiece.SentencePieceProcessor(model_file=model_file)
    probe = " a  ﬁ "
    plain = probe.replace(" ", SPACE)
    if model.normalize(probe) not in (plain, SPACE + plain):
        raise ValueError("only models that keep texts as they are can be used")
    size = model.get_piece_size()
    hidden = [model.is_control(i) or model.is_unknown(i) or model.is_unused(i) for i in range(size)]
    bytes_ = [i for i in range(size) if model.is_byte(i)]
    texts = [b"" if hidden[i] else bytes([int(model.id_to_piece(i)[3:-1], 16)]) if model.is_byte(i)
             else model.id_to_piece(i).encode() for i in range(size)]
    return Vocabulary(
        {model.id_to_piece(i): (i, model.get_score(i)) for i in range(size) if not hidden[i] and not model.is_byte(i)},
        tuple(bytes_), model.unk_id(), tuple(texts), kind, model.normalize(probe) != plain)


def fallback(vocabulary: Vocabulary, char: str) -> list[int]:
    """The ids of a character that is no piece: its bytes, or the id for the unknown."""
    if len(vocabulary.byte_ids) == 256:
        return [vocabulary.byte_ids[b] for b in char.encode("utf-8", "replace")]
    return [vocabulary.unknown_id]


def encode_unit(unit: str, vocabulary: Vocabulary) -> list[int]:
    """The ids of one unit, worked out alone; for units of any length."""
    found = _best_path(unit, vocabulary) if vocabulary.kind == "unigram" else _merged(unit, vocabulary)
    out: list[int] = []
    for piece in found:
        out += [vocabulary.pieces[piece][0]] if piece in vocabulary.pieces else fallback(vocabulary, piece)
    return out


def _merged(unit: str, vocabulary: Vocabulary, scores: list[float] | None = None) -> list[str]:
    """Neighbours are merged as long as two of them make a piece, the best scored first, then the leftmost.

    ``scores`` takes up the scores of the merges in their order.
    """
    parts: list[str | None] = list(unit)
    after, before = list(range(1, len(parts) + 1)), list(range(-1, len(parts) - 1))
    queue: list[tuple[float, int, str, int]] = []

    def offer(left: int) -> None:
        right = after[left] if left >= 0 else len(parts)
        if left >= 0 and right < len(parts):
            both = parts[left] + parts[right]
            if both in vocabulary.pieces:
                heapq.heappush(queue, (-vocabulary.pieces[both][1], left, both, right))
    for i in range(len(parts)):
        offer(i)
    while queue:
        cost, left, both, right = heapq.heappop(queue)
        if parts[left] is None or after[left] != right or parts[right] is None or parts[left] + parts[right] != both:
            continue
        if scores is not None:
            scores.append(-cost)
        parts[left], parts[right] = both, None
        after[left] = after[right]
        if after[left] < len(parts):
            before[after[left]] = left
        offer(before[left])
        offer(left)
    return [p for p in parts if p is not None]


def _best_path(unit: str, vocabulary: Vocabulary) -> list[str]:
    lowest = min(s for _, s in vocabulary.pieces.values()) - 10
    best, back = [0.0] + [-float("inf")] * len(unit), [0] * (len(unit) + 1)
    for end in range(1, len(unit) + 1):
        for start in range(max(0, end - vocabulary.longest), end):
            piece = unit[start:end]
            score = vocabulary.pieces[piece][1] if piece in vocabulary.pieces else lowest if end - start == 1 else None
            if score is not None and best[start] + score > best[end]:
                best[end], back[end] = best[start] + score, start
    out, end = [], len(unit)
    while end:
        out.append(unit[back[end]:end])
        end = back[end]
    return out[::-1]


# Rows of blocks, whose key is the block and not negative, and rows of the units that a block has in a bucket, with the
# place of the first one and the units with spaces between, which none of them holds.
_BLOCKS = "key bigint, at bigint, data binary"
_BLOCK_NAMES = ["key", "at", "data"]
# A block: the number of its first document, the ids of its documents, how many words each has and which, and how words
# are made of units.
_BLOCK = pa.schema([("first", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("seq", pa.binary()), ("made", pa.binary())])


def _packed(numbers: np.ndarray) -> bytes:
    """Numbers with their high bytes, mostly zero, apart from the low ones, compressed."""
    coder = zlib.compressobj(6, zlib.DEFLATED, 15, 9, zlib.Z_RLE)
    return coder.compress(numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()) + coder.flush()


def _unpacked(data: bytes) -> np.ndarray:
    return np.frombuffer(zlib.decompress(data), np.uint8).reshape(4, -1).T.copy().view("<u4").ravel()


class _Block:
    """Texts as numbers of their words, which are numbered as they come, and in the end by how often they do."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary, self.find = vocabulary, re.compile(vocabulary.unit_pattern()).findall
        self.prefix = SPACE if vocabulary.dummy_prefix else ""
        count = itertools.count().__next__
        self.between, self.units = defaultdict(count), defaultdict(count)
        self.doc_ids: list[int | None] = []
        self.counts: list[int] = []
        self.numbers: list[np.ndarray] = []
        self.chars = 0

    def add(self, doc_id: int | None, text: str) -> None:
        self.doc_ids.append(doc_id)
        self.counts.append(0)
        self.chars += len(text) + 16
        # Each single space begins a unit; texts with several in a row, or at an end, are cut by the pattern.
        if not (self.prefix and text) or "  " in text or SPACE in text or text[0] == " " or text[-1] == " ":
            if text:
                self._take(self.find((self.prefix + text).replace(" ", SPACE)), self.units)
            return
        at = 0
        while at < len(text):
            end = text.find(" ", at + _SLICE)
            end = len(text) if end < 0 else end
            self._take(text[at:end].split(" "), self.between)
            at = end + 1

    def _take(self, words: list[str], held: dict[str, int]) -> None:
        self.numbers.append(np.fromiter(map(held.__getitem__, words), np.uint32, len(words)))
        self.counts[-1] += len(words)

    def row(self, block: int, first: int) -> pa.RecordBatch:
        """The row of the block and those of its units, which are numbered bucket by bucket.

        ``made`` has how many words, units that a fold can take and longer units there are, for each word how many
        units it has, the units' numbers, and for each longer unit its ids, counted and listed.
        """
        flat = np.concatenate([np.zeros(0, np.uint32), *self.numbers])
        self.numbers = []
        words: list[str] = [""] * (len(self.between) + len(self.units))
        for word, n in itertools.chain(self.between.items(), self.units.items()):
            words[n] = word
        inner = np.zeros(len(words), bool)
        inner[np.fromiter(self.between.values(), np.int64, len(self.between))] = True
        self.between, self.units = {}, {}
        order = np.argsort(-np.bincount(flat, minlength=len(words)), kind="stable")
        rank = np.empty(len(words), np.uint32)
        rank[order] = np.arange(len(words), dtype=np.uint32)
        seq = _packed(np.concatenate((np.array(self.counts, np.uint32), rank[flat])))

        units, longer = defaultdict(itertools.count().__next__), defaultdict(itertools.count(1).__next__)
        sizes, numbers = np.zeros(len(words), np.int64), []
        for i, n in enumerate(order.tolist()):
            # Letters and digits alone are not cut.
            if inner[n]:
                found = [SPACE + words[n]] if words[n].isalnum() else self.find(SPACE + words[n])
            else:
                found = [words[n]]
            sizes[i] = len(found)
            numbers += [units[u] if len(u) <= FOLD_CHARS else -longer[u] for u in found]
        del words
        made = np.array(numbers, np.int64)
        del numbers
        bucket = np.fromiter((zlib.crc32(u.encode()) for u in units), np.int64, len(units)) & (1 << _BUCKET_BITS) - 1
        order = np.argsort(bucket, kind="stable")
        number = np.empty(len(units), np.int64)
        number[order] = np.arange(len(units))
        long = made < 0
        made[~long] = number[made[~long]]
        made[long] = len(units) - 1 - made[long]
        ids = [encode_unit(u, self.vocabulary) for u in longer]
        head = [len(sizes), len(units), len(ids)]
        made = _packed(np.concatenate((head, sizes, made, np.fromiter(map(len, ids), np.int64, len(ids)), np.array(
            [i for x in ids for i in x], np.int64))))
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, _BLOCK) as out:
            out.write_batch(pa.RecordBatch.from_arrays(
                [pa.array([x], t) for x, t in zip((first, self.doc_ids, seq, made), _BLOCK.types)], schema=_BLOCK))

        names, bucket = list(units), bucket[order]
        names = [names[i] for i in order.tolist()]
        cuts = np.flatnonzero(np.diff(bucket, prepend=-1))
        data = [" ".join(names[a:b]).encode() for a, b in zip(cuts.tolist(), [*cuts[1:].tolist(), len(names)])]
        shard = block >> _BLOCK_BITS + _SHARD_BITS
        return pa.RecordBatch.from_arrays(
            [pa.array(np.append(block, -1 - (shard << _BUCKET_BITS | bucket[cuts]))),
             pa.array(np.append(block, block << _NUMBER_BITS | cuts)),
             pa.array([sink.getvalue().to_pybytes(), *data], pa.binary())], _BLOCK_NAMES)


def _blocks(docs: DataFrame, vocabulary: Vocabulary, block_chars: int) -> DataFrame:
    """The documents in blocks, dealt out by block, and the units of the blocks, dealt out by bucket."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, first = TaskContext.get().partitionId() << _BLOCK_BITS, TaskContext.get().partitionId() << 40
        held = _Block(vocabulary)
        for batch in batches:
            for doc_id, text in zip(batch.column(0), batch.column(1)):
                held.add(doc_id.as_py(), text.as_py())
                if held.chars >= block_chars:
                    yield held.row(block, first)
                    block, first, held = block + 1, first + len(held.doc_ids), _Block(vocabulary)
        if held.doc_ids:
            yield held.row(block, first)
    source = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), whole_text().alias("text"))
    return source.mapInArrow(run, _BLOCKS).repartition("key")


def _listed(blocks: DataFrame) -> DataFrame:
    """(unit, key, places): the units of the blocks of a shard, and where they are listed.

    Rows stay with their bucket, so grouping them moves nothing. Rows of blocks have no units; a condition on the key
    instead would be worked out ahead of the exchange, which could then not be shared.
    """
    units = F.when(F.col("key") < 0, F.split(F.col("data").cast("string"), " "))
    rows = blocks.select("key", "at", F.posexplode_outer(units).alias("number", "unit")).where("unit IS NOT NULL")
    return rows.groupBy(F.xxhash64("unit").alias("hash"), "unit", "key").agg(
        F.collect_list(F.col("at") + F.col("number")).alias("places")).drop("hash")


def _head_table(spark: SparkSession, vocabulary: Vocabulary) -> DataFrame:
    """(head, reach): the length of the longest piece with these first characters; shorter pieces are left out."""
    reach: dict[str, int] = {}
    for piece in vocabulary.pieces:
        if len(piece) >= _HEAD:
            reach[piece[:_HEAD]] = max(len(piece), reach.get(piece[:_HEAD], 0))
    return spark.createDataFrame(sorted(reach.items()), "head string, reach int")


def _piece_table(spark: SparkSession, vocabulary: Vocabulary) -> DataFrame:
    """(piece, id, place, score, odd): place counts from the best score, and odd pieces are those that are disorderly.
    As many rows as the vocabulary has."""
    odd = vocabulary.disorderly if vocabulary.kind == "bpe" else frozenset()
    ordered = sorted(vocabulary.pieces.items(), key=lambda p: (-p[1][1], p[1][0]))
    places: dict[float, int] = {}
    rows = [(piece, i, places.setdefault(score, len(places)), score, piece in odd) for piece, (i, score) in ordered]
    return spark.createDataFrame(rows, "piece string, id int, place int, score double, odd boolean")


def _bit(place: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), place)


def _field(edge: Column, shift: int, bits: int) -> Column:
    return F.call_function("shiftright", edge, F.lit(shift)).bitwiseAND(F.lit((1 << bits) - 1).cast("bigint"))


# An edge is one number: place, start, end and id from the high bits to the low ones.
_ID, _AT = 21, 6


def _start(edge: Column) -> Column:
    return _field(edge, _ID + _AT, _AT).cast("int")


def _end(edge: Column) -> Column:
    return _field(edge, _ID, _AT).cast("int")


def _id(edge: Column) -> Column:
    return _field(edge, 0, _ID).cast("int")


def _lattice(units: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """(unit, places, edges, odd) for rows (key, unit, places) that lie together by key: all matches of pieces as numbers,
    sorted, characters that are no piece, and whether one of the pieces is disorderly. ``places`` is handed on as it is.
    No match is looked for beyond the longest piece that begins with the same characters.

    For a unigram model an edge is (number, score). Rows stay with their key, so grouping the edges again moves nothing,
    and as the rows are numbered they come in the order of the groups.
    """
    if len(vocabulary.texts) >= _UNKNOWN:
        raise ValueError("the vocabulary has too many pieces")
    n, begins = F.char_length("unit"), (F.col("s") == 0) & (F.col("e") == 1)
    units = units.select("key", "unit", "places", F.monotonically_increasing_id().alias("row"))
    # Only the first start carries the places.
    starts = units.select("row", "key", "unit", "places", F.explode(F.sequence(F.lit(0), n - 1)).alias("s")).withColumn(
        "places", F.when(F.col("s") == 0, F.col("places")))
    heads = F.broadcast(_head_table(units.sparkSession, vocabulary))  # bounded by the vocabulary
    starts = starts.join(heads, F.substring("unit", F.col("s") + 1, F.lit(_HEAD)) == F.col("head"), "left")
    spans = starts.select("row", "key", "unit", "places", "s", F.explode(F.sequence(F.col("s") + 1, F.least(
        F.col("s") + F.coalesce("reach", F.lit(_HEAD - 1)), n))).alias("e"))
    spans = spans.withColumn("sub", F.substring("unit", F.col("s") + 1, F.col("e") - F.col("s")))
    table = F.broadcast(_piece_table(units.sparkSession, vocabulary))  # bounded by the vocabulary
    found = spans.join(table, F.col("sub") == F.col("piece"), "left").where("id IS NOT NULL OR e = s + 1")
    edge = F.lit(0).cast("bigint")
    for part, bits in ((F.coalesce("place", F.lit(_UNKNOWN)), _ID), ("s", _AT), ("e", _AT),
                       (F.coalesce("id", F.lit(_UNKNOWN)), _ID)):
        edge = edge * (1 << bits) + (F.col(part) if isinstance(part, str) else part)
    if vocabulary.kind == "unigram":
        lowest = min(s for _, s in vocabulary.pieces.values()) - 10
        edge = F.struct(edge.alias("edge"), F.coalesce("score", F.lit(float(lowest))).alias("score"))
    edges = found.select("row", "key", edge.alias("edge"), F.when(begins, F.col("unit")).alias("unit"),
                         F.when(begins, F.col("places")).alias("places"), F.coalesce("odd", F.lit(False)).alias("odd"))
    return edges.groupBy("row", "key").agg(
        F.first("unit", True).alias("unit"), F.sort_array(F.collect_list("edge")).alias("edges"),
        F.first("places", True).alias("places"), F.max("odd").alias("odd")).drop("row", "key")


def _fold_merges(lattice: DataFrame) -> DataFrame:
    """(unit, places, path): the edges that are left when pairs have been merged in the order of their places.

    The state is the set of boundaries as bits. In each step, the first edge that spans just two parts takes out the
    boundary between them. ``ends`` and ``inner`` are the boundaries at and inside an edge. Each edge is looked at once,
    in the order of the places; where a piece is disorderly, all of them again for each merge.
    """
    def with_bits(x: Column) -> Column:
        return F.struct((_bit(_start(x)) + _bit(_end(x))).alias("ends"),
                        (_bit(_end(x)) - _bit(_start(x) + 1)).alias("inner"), x.alias("edge"))
    n, left = F.char_length("unit"), F.col("left")
    lattice = lattice.select("unit", "places", "odd", F.transform("edges", with_bits).alias("edges"))
    lattice = lattice.select("unit", "places", "odd", "edges", F.filter("edges", lambda x: x["inner"] != 0).alias("longer"))

    def step(state: Column, _: Column) -> Column:
        fits = F.filter("longer", lambda x: (state.bitwiseAND(x["ends"]) == x["ends"])
                        & (F.bit_count(state.bitwiseAND(x["inner"])) == 1))
        return state - state.bitwiseAND(F.coalesce(F.get(fits, F.lit(0))["inner"], F.lit(0).cast("bigint")))

    def take(state: Column, x: Column) -> Column:
        inside = state.bitwiseAND(x["inner"])
        return F.when((state.bitwiseAND(x["ends"]) == x["ends"]) & (F.bit_count(inside) == 1),
                      state - inside).otherwise(state)
    rounds = F.when(F.size("longer") == 0, F.array().cast("array<int>")).otherwise(F.sequence(F.lit(1), n - 1))
    # Columns of their own, so that no step works them out again for each edge.
    whole = _bit(n + 1) - 1
    merges = F.when(F.col("odd"), F.aggregate(rounds, whole, step)).otherwise(F.aggregate("longer", whole, take))
    merged = lattice.select("unit", "places", "edges", merges.alias("left"))
    chosen = F.filter("edges", lambda x: (left.bitwiseAND(x["ends"]) == x["ends"])
                      & (left.bitwiseAND(x["inner"]) == 0))
    return merged.select("unit", "places", F.transform(chosen, lambda x: x["edge"]).alias("path"))


def _fold_best_path(lattice: DataFrame) -> DataFrame:
    """(unit, places, path): the edges of the path with the highest sum of scores (Viterbi): forward over the ends, then back.
    """
    none, best = F.lit(float("-inf")), F.col("best")
    first = F.array(F.struct(F.lit(0.0).alias("score"), F.lit(0).alias("from"),
                             F.lit(0).cast("bigint").alias("edge")))

    def forward(state: Column, end: Column) -> Column:
        arriving = F.filter("edges", lambda x: _end(x["edge"]) == end)
        reached = F.transform(arriving, lambda x: F.struct(
            (F.coalesce(F.get(state, _start(x["edge"]))["score"], none) + x["score"]).alias("score"),
            (-_start(x["edge"])).alias("from"), x["edge"].alias("edge")))
        return F.concat(state, F.array(F.array_max(reached)))
    n = F.char_length("unit")
    lattice = lattice.select("unit", "places", F.aggregate(F.sequence(F.lit(1), n), first, forward).alias("best"))

    def backward(state: Column, _: Column) -> Column:
        here, more = F.get(best, state["at"])["edge"], state["at"] > 0
        return F.struct(
            F.when(more, _start(here)).otherwise(F.lit(0)).alias("at"),
            F.when(more, F.concat(F.array(here), state["path"])).otherwise(state["path"]).alias("path"))
    start = F.struct(n.alias("at"), F.array().cast("array<bigint>").alias("path"))
    return lattice.select("unit", "places", F.aggregate(F.sequence(F.lit(1), n), start, backward)["path"].alias("path"))


def _folded(units: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """(unit, places, ids) for units that a fold can take."""
    lattice = _lattice(units, vocabulary)
    folded = _fold_best_path(lattice) if vocabulary.kind == "unigram" else _fold_merges(lattice)
    # Start and id as one number.
    path = folded.select("unit", "places", F.sort_array(F.transform(
        "path", lambda x: _field(x, _ID + _AT, _AT) * (1 << _ID) + _field(x, 0, _ID))).alias("path"))
    if len(vocabulary.byte_ids) == 256:
        byte_ids = F.array(*[F.lit(i) for i in vocabulary.byte_ids])

        def missing(s: Column) -> Column:
            code = F.hex(F.encode(F.substring("unit", s + 1, F.lit(1)), "utf-8"))
            return F.transform(F.sequence(F.lit(1), (F.length(code) / 2).cast("int")), lambda i: F.element_at(
                byte_ids, F.conv(F.substring(code, 2 * i - 1, F.lit(2)), 16, 10).cast("int") + 1))
    else:
        def missing(s: Column) -> Column:
            return F.array(F.lit(vocabulary.unknown_id))
    return path.select("unit", "places", F.when(
        F.exists("path", lambda x: _id(x) == _UNKNOWN), F.flatten(F.transform("path", lambda x: F.when(
            _id(x) == _UNKNOWN, missing(_field(x, _ID, _AT).cast("int"))).otherwise(F.array(_id(x)))))).otherwise(
                F.transform("path", _id)).alias("ids"))


def encode_units(units: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """(unit, ids) for a table of distinct units of at most ``FOLD_CHARS`` characters."""
    dealt = units.select("unit", F.lit(0).alias("places"), F.xxhash64("unit").alias("key")).repartition("key")
    return _folded(dealt, vocabulary).select("unit", "ids")


def _list_rows(encoded: DataFrame) -> DataFrame:
    """(of, packed): for rows (places, ids), many of a block together, to be moved in a small form: how many there
    are, the steps from number to number, the sizes of the lists, and the lists."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0

        def packed() -> pa.RecordBatch:
            table = pa.Table.from_batches(held).combine_chunks()
            places, lists = table.column("places").chunk(0), table.column("ids").chunk(0)
            at, starts = places.values.to_numpy(), places.offsets.to_numpy()
            order = np.argsort(at)
            unit = np.repeat(np.arange(len(places)), np.diff(starts))[order]
            of, number = at[order] >> _NUMBER_BITS, at[order] & (1 << _NUMBER_BITS) - 1
            flat, ends = lists.values.to_numpy(), lists.offsets.to_numpy().astype(np.int64)
            cuts = [0, *(np.flatnonzero(np.diff(of)) + 1).tolist(), len(of)]
            blocks, out = [], []
            for a, b in zip(cuts, cuts[1:]):
                ids, sizes = _gathered(flat, ends, unit[a:b])
                blocks.append(int(of[a]))
                out.append(_packed(np.concatenate(([b - a], np.diff(number[a:b], prepend=0), sizes, ids))))
            return pa.RecordBatch.from_arrays([pa.array(blocks, pa.int64()), pa.array(out, pa.binary())],
                                              ["of", "packed"])
        for batch in batches:
            if batch.num_rows:
                held.append(batch)
                rows += len(batch.column(0).values)
            if rows >= _PACKED_PLACES:
                yield packed()
                held, rows = [], 0
        if held:
            yield packed()
    return encoded.mapInArrow(run, "of bigint, packed binary")


def encode(docs: DataFrame, vocabulary: Vocabulary, block_chars: int = BLOCK_CHARS,
           decoded: bool = False) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): row, doc_id, ids, and with ``decoded`` the text the ids stand for.

    ``row`` is a number of its own for each row. A null text counts as empty, and an empty text has no ids; rows that
    repeat give rows that repeat; an empty table gives none; other columns are not looked at. Characters that the
    vocabulary lacks become their bytes, or the id for the unknown if it has no bytes either.
    """
    bound_batches(docs.sparkSession)
    # One exchange, which both readers below take all columns of; it brings a unit's places together, too. A shard holds
    # so few blocks that the list stays short.
    blocks = _blocks(docs, vocabulary, block_chars)
    encoded = _folded(_listed(blocks), vocabulary).select("places", "ids")
    prefix = vocabulary.dummy_prefix
    data = np.frombuffer(b"".join(vocabulary.texts), np.uint8)
    data_ends = np.concatenate(([0], np.cumsum([len(t) for t in vocabulary.texts])))

    kinds = [pa.int64(), pa.int64(), pa.list_(pa.int32()), pa.string()]

    def put_together(blocks_: pa.Table, lists_: pa.Table) -> pa.Table:
        out = []
        names = ["row", "doc_id", "ids", "text"][:4 if decoded else 3]
        for key, packed in zip(blocks_["key"].to_pylist(), blocks_["data"]):  # one row, or those of a bucket, which have no texts
            if key < 0:
                break
            block, = pa.ipc.open_stream(packed.as_buffer()).read_all().to_pylist()
            flat, ends = _word_lists(_unpacked(block["made"]), lists_)
            n, seq = len(block["doc_ids"]), _unpacked(block["seq"])
            cuts = np.concatenate(([0], np.cumsum(seq[:n].astype(np.int64))))
            seq, first = seq[n:], 0
            while first < n:
                last = max(first + 1, int(np.searchsorted(cuts, cuts[first] + _JOINED, "right")) - 1)
                ids, sizes = _gathered(flat, ends, seq[cuts[first]:cuts[last]])
                at = np.concatenate(([0], np.cumsum(sizes)))[cuts[first:last + 1] - cuts[first]]
                found = [pa.array(np.arange(first, last) + block["first"], pa.int64()), pa.array(block["doc_ids"][first:last], pa.int64()),
                         pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(ids.astype(np.int32)))]
                if decoded:
                    found.append(pa.array(_texts(data, data_ends, ids, at, prefix), pa.string()))
                out.append(pa.RecordBatch.from_arrays(found, names))
                first = last
        return pa.Table.from_batches(out, pa.schema(list(zip(names, kinds))))
    return blocks.groupBy("key").cogroup(_list_rows(encoded).groupBy("of")).applyInArrow(
        put_together, "row bigint, doc_id bigint, ids array<int>" + (", text string" if decoded else ""))


def _word_lists(made: np.ndarray, lists: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """The ids of a block's words one after the other and where each begins, from those of its units."""
    n, short, long = (int(x) for x in made[:3])
    counts, rest = made[3:3 + n].astype(np.int64), made[3 + n:].astype(np.int64)
    numbers, rest = rest[:counts.sum()], rest[counts.sum():]
    sizes, parts, order = np.zeros(short + long, np.int64), [], []
    for packed in lists.column("packed"):
        row = _unpacked(packed.as_py()).astype(np.int64)
        k = int(row[0])
        order.append(np.cumsum(row[1:k + 1]))
        sizes[order[-1]] = row[k + 1:2 * k + 1]
        parts.append(row[2 * k + 1:])
    order.append(np.arange(short, short + long))
    sizes[short:], parts = rest[:long], [*parts, rest[long:]]
    # From the order in which the lists came to the order of the units' numbers.
    came = np.concatenate(order)
    came_ends = np.concatenate(([0], np.cumsum(sizes[came])))
    back = np.empty_like(came)
    back[came] = np.arange(len(came))
    flat, _ = _gathered(np.concatenate(parts), came_ends, back[numbers])
    word_ends = np.concatenate(([0], np.cumsum(counts)))
    return flat, np.concatenate(([0], np.cumsum(sizes[numbers])))[word_ends]


def _gathered(flat: np.ndarray, ends: np.ndarray, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The lists with these numbers one after the other, and their sizes; list i is flat[ends[i]:ends[i + 1]]."""
    sizes = (ends[1:] - ends[:-1])[numbers]
    total = int(sizes.sum())
    at = np.arange(total) + np.repeat(ends[:-1][numbers] - (np.cumsum(sizes) - sizes), sizes)
    return flat[at], sizes


def _text(ids: list[int], pieces: tuple[bytes, ...], prefix: bool) -> str:
    return _shown(b"".join([pieces[i] for i in ids if 0 <= i < len(pieces)]), prefix)


def _texts(data: np.ndarray, ends: np.ndarray, ids: np.ndarray, at: np.ndarray, prefix: bool) -> list[str]:
    """The texts that ids[at[i]:at[i + 1]] stand for, where id i stands for the bytes data[ends[i]:ends[i + 1]]."""
    out, first = [], 0
    while first < len(at) - 1:
        last = max(first + 1, int(np.searchsorted(at, at[first] + _JOINED, "right")) - 1)
        found, sizes = _gathered(data, ends, ids[at[first]:at[last]])
        cuts = np.concatenate(([0], np.cumsum(sizes)))[at[first:last + 1] - at[first]].tolist()
        for a, b in zip(cuts, cuts[1:]):
            out.append(_shown(found[a:b].tobytes(), prefix))
        first = last
    return out


def _shown(whole: bytes, prefix: bool) -> str:
    text = whole.decode("utf-8", "replace").replace(SPACE, " ")
    return text[1:] if prefix and text.startswith(" ") else text


def decode(encoded: DataFrame, vocabulary: Vocabulary, ids: str = "ids", text: str = "text") -> DataFrame:
    """``encoded`` with the text its ids stand for; bytes that are no UTF-8 become replacement characters, ids out of
    range nothing. A null list gives a null text."""
    pieces, prefix = vocabulary.texts, vocabulary.dummy_prefix

    @F.arrow_udf("string")
    def put_together(lists: pa.Array) -> pa.Array:
        return pa.array([_text(x, pieces, prefix) if x is not None else None for x in lists.to_pylist()], pa.string())
    return encoded.withColumn(text, put_together(ids))


def encoding_digest(docs: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """Per document the number of its ids, a digest of them, and a digest of the text they decode to."""
    return encode(docs, vocabulary, decoded=True).select(
        "doc_id", F.size("ids").cast("bigint").alias("n_ids"),
        F.sha2(F.concat_ws(" ", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("text", 256).alias("decoded_sha256"))
