"""Near duplicates by MinHash with tensored bands.

Two small collections of band values are computed per document, some dozen MinHashes in all. Every pair of a value
from the first with a value from the second is the key of a table, so the tables grow with the product of the
collections while the hashing grows with their sum. Documents that share a key are candidates, and every link is
confirmed on the full shingle sets.

In a table, members are not paired with each other. Each is compared with leaders of its groups, in several rounds;
what is linked is put into one component, and groups that hold one component only need no more looking at. The tables
serve the first round only. What shares a key shares a value of either collection, so later rounds group by the values
of one collection the documents that have values of both in common with other components: a document is in some dozen
groups at most, however many keys it has. Members of groups that still hold several components are then looked at
across those components, so that no link between components is lost, but not as all pairs: members whose set has too
much to itself cannot be linked to any, and members far from the middle of their group can only be linked to one that
shares some of what they have outside it.
The others are compared with the smallest member of each size class of their group: two that are both linked to it are
in one component, and if one of them is not, the two must share something that the smallest lacks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

from orderloom.llm.common import kept_rows, sized, text_key, whole_text
from orderloom.llm.hashing import mixed, polynomials, random_words
from orderloom.session import bound_batches, materialize, release, shuffles_removed

SHINGLE = 5
SIMILARITY = 0.8
# Band values in each of the two collections, and MinHashes that make up one value. Two documents with four fifths of
# their shingles in common share no value of one collection once in (1 - 0.8 ** 3) ** 16, some hundred thousand times.
BANDS, WIDTH = 16, 3
# Rounds of comparing with leaders, and how many leaders a document is compared with in each.
ROUNDS, LEADERS = 3, 4
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_MASK = (1 << 64) - 1
# Bytes worked on at a time; what a Python worker keeps of the memory afterwards grows with it.
_SLICE = 1 << 18
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def _word_hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where words start in the bytes, and a 64-bit hash of each; worked on in pieces cut at white space."""
    starts, hashes, first = [], [], 0
    while first < len(data):
        last = min(first + _SLICE, len(data))
        while last < len(data):
            spaces = np.flatnonzero(_SPACE[data[first:last]])
            if len(spaces):
                last = first + int(spaces[-1]) + 1
                break
            last = min(2 * last - first, len(data))  # a word longer than a piece
        at, own = _piece_hashes(data[first:last])
        starts.append(at + first)
        hashes.append(own)
        first = last
    return np.concatenate(starts or [np.zeros(0, np.int64)]), np.concatenate(hashes or [np.zeros(0, np.uint64)])


def _piece_hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    data = _LOWER[data]
    edge = np.diff(np.concatenate(([False], ~_SPACE[data], [False])).astype(np.int8))
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    return starts, polynomials(data, starts, ends)


def shingle_sets(texts: list[bytes], size: int) -> list[np.ndarray]:
    """For each text the sorted distinct hashes of its runs of ``size`` words, or of all its words if they are fewer.

    Texts are laid one after the other with a space between them and worked on a quarter of a megabyte at a time.
    """
    out: list[np.ndarray] = []
    held: list[bytes] = []
    for i, text in enumerate(texts):
        held.append(text)
        if sum(map(len, held)) >= _SLICE or i == len(texts) - 1:
            out += _sets(held, size)
            held = []
    return out


def _sets(texts: list[bytes], size: int) -> list[np.ndarray]:
    data = np.frombuffer(b" ".join(texts), np.uint8)
    firsts = np.concatenate(([0], np.cumsum([len(t) + 1 for t in texts])))
    starts, words = _word_hashes(data)
    at = np.searchsorted(starts, firsts)  # the first word of each text
    many = np.maximum(len(words) - size + 1, 0)
    runs = np.zeros(many, np.uint64)
    for i in range(size):
        runs = mixed(runs * np.uint64(0x2545F4914F6CDD1D) + words[i:i + many])
    out = []
    for a, b in zip(at[:-1], at[1:]):
        if b - a >= size:
            out.append(np.unique(runs[a:b - size + 1]))
        elif b > a:
            value = np.zeros(1, np.uint64)
            for w in words[a:b]:
                value = mixed(value * np.uint64(0x2545F4914F6CDD1D) + w)
            out.append(mixed(value + np.uint64(b - a)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def band_values(found: np.ndarray, bands: int, width: int) -> np.ndarray:
    """2 * bands values, each of ``width`` MinHashes of a set that is not empty."""
    n = 2 * bands * width
    factors, shifts = random_words(23, n) | np.uint64(1), random_words(29, n)
    least = np.full(n, _MASK, np.uint64)
    for first in range(0, len(found), 4096):
        part = found[first:first + 4096]
        np.minimum(least, _mixed_short(part[None, :] * factors[:, None] + shifts[:, None]).min(1), out=least)
    out = np.arange(2 * bands, dtype=np.uint64)
    for i in range(width):
        out = mixed(out * np.uint64(0x2545F4914F6CDD1D) + least[i::width])
    return out


def _mixed_short(x: np.ndarray) -> np.ndarray:
    return (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)


def _digests(found: np.ndarray) -> tuple[int, int]:
    """128 bits that stand for a set."""
    if not len(found):
        return 0, 0
    return int(np.bitwise_xor.reduce(mixed(found)).view(np.int64)), int(found.sum(dtype=np.uint64).view(np.int64))


def _signatures(texts: DataFrame, size: int, bands: int, width: int) -> DataFrame:
    """Per row of (doc_id, text_key, text): set size n, digests own and other of the set, band values."""
    names = ["doc_id", "text_key", "n", "own", "other", "values"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            sets = shingle_sets([t.as_py() for t in batch.column(2).cast(pa.binary())], size)
            own, other = zip(*map(_digests, sets))
            values = [band_values(s, bands, width).view(np.int64).tolist() if len(s) else None for s in sets]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).cast(pa.int64()), batch.column(1), pa.array([len(s) for s in sets], pa.int64()),
                 pa.array(own, pa.int64()), pa.array(other, pa.int64()), pa.array(values, pa.list_(pa.int64()))], names)
    return texts.mapInArrow(
        run, "doc_id bigint, text_key bigint, n bigint, own bigint, other bigint, values array<bigint>")


def _sets_of(texts: DataFrame, size: int) -> DataFrame:
    """(own, other, shingles) per row of (text): the set as sorted 64-bit values."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, 256):
                sets = shingle_sets([t.as_py() for t in batch.column(0).slice(first, 256).cast(pa.binary())], size)
                own, other = zip(*map(_digests, sets))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(own, pa.int64()), pa.array(other, pa.int64()),
                     pa.array([s.tobytes() for s in sets], pa.binary())], ["own", "other", "shingles"])
    return texts.mapInArrow(run, "own bigint, other bigint, shingles binary")


def _confirmed(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """Those (a, b) whose full sets are similar enough, in whole hundredths."""
    least = round(100 * similarity)
    left = sets.select(F.col("node").alias("a"), F.col("shingles").alias("left"))
    right = sets.select(F.col("node").alias("b"), F.col("shingles").alias("right"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for i in range(batch.num_rows):
                x = np.frombuffer(batch.column(2)[i].as_buffer(), np.uint64)
                y = np.frombuffer(batch.column(3)[i].as_buffer(), np.uint64)
                both = len(x) + len(y) - len(np.union1d(x, y))
                keep.append(100 * both >= least * (len(x) + len(y) - both))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))
    joined = pairs.join(left, "a").join(right, "b").select("a", "b", "left", "right")
    return joined.mapInArrow(run, "a bigint, b bigint")


def components(links: DataFrame, label: str = "components") -> DataFrame:
    """(node, component, old) for all nodes of (a, b) links: the smallest node that can be reached, twice.

    In each round a node takes the smallest label among its neighbours, and then the label of its label, so the
    number of rounds grows with the logarithm of the longest path. Minima are taken before rows are moved, and a
    node with very many links needs no more room than another.
    """
    both = materialize(links.select("a", "b").union(links.select("b", "a")).distinct(), f"{label}-links")
    labels = materialize(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("component"))
                         .withColumnRenamed("a", "node"), label)
    while True:
        near = both.join(labels, F.col("b") == F.col("node")).groupBy("a").agg(F.min("component").alias("near"))
        lower = labels.join(near, F.col("node") == F.col("a"), "left").select(
            "node", F.col("component").alias("old"), F.least("component", F.coalesce("near", "component")).alias("new"))
        jump = labels.select(F.col("node").alias("at"), F.col("component").alias("then"))
        after = materialize(lower.join(jump, F.col("new") == F.col("at"), "left").select(
            "node", F.least("new", F.coalesce("then", "new")).alias("component"), "old"), label)
        release(labels)
        labels = after
        if after.where("component <> old").isEmpty():
            release(both)
            return after


def _tables(values: DataFrame, bands: int) -> tuple[DataFrame, DataFrame]:
    """(key, node) for all tables, but only groups of two nodes or more, and one table's group of each membership; and
    (key, node, front) for the single values of these nodes that others have too, those of the first collection in front.

    A key is a pair of values, one of either collection. Values that one node has alone are left out before pairs are
    formed, so nodes that resemble nothing make few keys or none.
    """
    spread = values.select("node", F.posexplode("values").alias("place", "value"))
    spread = materialize(spread.select("node", "place", F.xxhash64("place", "value").alias("value")), "bands")
    shared = materialize(spread.groupBy("value").agg(F.min("node").alias("low"), F.max("node").alias("high"))
                         .where("low < high").select("value"), "shared-bands")
    held = spread.join(shared, "value", "left_semi").groupBy("node").agg(
        F.collect_list(F.when(F.col("place") < bands, F.col("value"))).alias("first"),
        F.collect_list(F.when(F.col("place") >= bands, F.col("value"))).alias("second"))
    pairs = F.flatten(F.transform("first", lambda x: F.transform("second", lambda y: F.xxhash64(x, y))))
    keys = materialize(held.select("node", F.explode(pairs).alias("key")), "keys")
    members = keys.groupBy("key").agg(
        F.min("node").alias("low"), F.count("*").alias("size"), F.bit_xor(F.xxhash64("node")).alias("one"),
        F.bit_xor(F.xxhash64(F.lit(1), "node")).alias("two")).where("size > 1")
    chosen = materialize(members.groupBy("low", "size", "one", "two").agg(F.min("key").alias("key")).select("key"),
                         "chosen-keys")
    tables = materialize(keys.join(chosen, "key", "left_semi").select("key", "node"), "tables")
    release(keys, chosen)
    single = materialize(spread.join(shared, "value", "left_semi").join(
        tables.select("node").distinct(), "node", "left_semi").select(
            F.col("value").alias("key"), "node", (F.col("place") < bands).alias("front")), "single-values")
    release(spread, shared)
    return tables, single


def _can_link(r_a: Column, r_b: Column, n_a: Column, n_b: Column, similarity: float) -> Column:
    """Whether sets of these sizes n, with at most r elements in common with anything, can be similar enough."""
    least = round(100 * similarity)
    return (100 + least) * F.least(r_a, r_b) >= least * (n_a + n_b)


def _fitting(pairs: DataFrame, facts: DataFrame, similarity: float) -> DataFrame:
    """Pairs that the sizes n and the shared parts r of their sets do not rule out."""
    a = facts.select(F.col("node").alias("a"), F.col("n").alias("n_a"), F.col("r").alias("r_a"))
    b = facts.select(F.col("node").alias("b"), F.col("n").alias("n_b"), F.col("r").alias("r_b"))
    return pairs.join(a, "a").join(b, "b").where(_can_link(
        F.col("r_a"), F.col("r_b"), F.col("n_a"), F.col("n_b"), similarity)).select("a", "b")


def _shingle_rows(sets: DataFrame) -> DataFrame:
    """(node, shingle) for all members of the sets."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                found = np.frombuffer(batch.column(1)[i].as_buffer(), np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(found), batch.column(0)[i].as_py(), np.int64)),
                                                  pa.array(found)], ["node", "shingle"])
    return sets.select("node", "shingles").mapInArrow(run, "node bigint, shingle bigint")


def _shared_parts(nodes: DataFrame, sets: DataFrame) -> DataFrame:
    """(node, alone): for the nodes that have shingles to themselves, how many.

    What one node has alone cannot be in any intersection, so it bounds every similarity of that node exactly.
    """
    rows = _shingle_rows(sets.join(nodes, "node", "left_semi"))
    own = rows.groupBy("shingle").agg(F.min("node").alias("low"), F.max("node").alias("high")).where("low = high")
    return own.groupBy(F.col("low").alias("node")).agg(F.count("*").alias("alone"))


def _possible(groups: DataFrame, facts: DataFrame, similarity: float) -> DataFrame:
    """Members of groups that could be linked with a member of their group at all, where several components are left."""
    n, r = F.col("n"), F.col("r")
    # With the best of partners, one whose set is what the two have in common.
    known = groups.join(facts.where(_can_link(r, r, n, r, similarity)), "node")
    small = materialize(known.groupBy("key").agg(F.min("n").alias("least_n")), "least-sizes")
    alive = materialize(known.join(small, "key").where(_can_link(r, r, n, F.col("least_n"), similarity)).drop("least_n"),
                        "possible")
    split = alive.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high")).where(
        "low < high").select("key")
    split = materialize(split, "split-keys")
    possible = materialize(alive.join(split, "key", "left_semi"), "possible-groups")
    release(small, alive, split)
    return possible


def _split_groups(groups: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows (key, node) of the groups that hold more than one component, with component."""
    known = labels.select(F.col("node").alias("known"), "component")
    named = materialize(groups.join(known, F.col("node") == F.col("known"), "left").select(
        *groups.columns, F.coalesce("component", "node").alias("component")), "named")
    split = named.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high")).where(
        "low < high").select("key")
    split = materialize(split, "split-keys")
    found = materialize(named.join(split, "key", "left_semi"), "split-groups")
    release(named, split)
    return found


def _split_values(single: DataFrame, labels: DataFrame) -> DataFrame:
    """(key, node, component) by the values in front, for nodes that have values of both collections in common with
    other components: all that share a key of some table with another component do."""
    split = _split_groups(single, labels)
    both = materialize(split.groupBy("node").agg(F.min("front").alias("low"), F.max("front").alias("high")).where(
        "low < high").select("node"), "both-values")
    found = materialize(split.where("front").join(both, "node", "left_semi").select("key", "node", "component"),
                        "split-values")
    release(split, both)
    return found


def _with_leaders(groups: DataFrame, weights: DataFrame, turn: int) -> DataFrame:
    """(a, b): members with leaders of their groups in other components, each with LEADERS of them at most.

    First the members of most groups lead: they are in the middle of what resembles each other.
    """
    if turn == 0:
        groups, by = groups.join(weights, "node"), -F.col("weight")
    else:
        by = F.xxhash64(F.lit(turn), "node")
    lead = groups.groupBy("key").agg(F.min(F.struct(by.alias("by"), "node", "component")).alias("lead"))
    led = groups.join(materialize(lead, "leaders"), "key").where("component <> lead.component")
    some = led.groupBy("node").agg(F.slice(F.array_sort(F.collect_set(F.struct("lead.by", "lead.node"))), 1,
                                           LEADERS).alias("leads"))
    pairs = some.select("node", F.explode("leads.node").alias("lead"))
    return pairs.select(F.least("node", "lead").alias("a"), F.greatest("node", "lead").alias("b")).distinct()


def _class_centers(groups: DataFrame, similarity: float) -> DataFrame:
    """(node, center, center_n): members of groups with the smallest members of their size class and of the one below.

    Classes are so wide that sets similar enough are in one class or in neighbouring ones; of two of them, both are
    compared with the smallest member of the smaller one's class.
    """
    which = F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(1.01 / similarity))).cast("int")
    classed = groups.select("key", "node", "n", which.alias("size_class"))
    smallest = classed.groupBy("key", F.col("size_class").alias("of_class")).agg(
        F.min(F.struct("n", "node")).alias("smallest"))
    smallest = materialize(smallest, "class-centers")
    asked = classed.select("key", "node", F.explode(F.array("size_class", F.col("size_class") - 1)).alias("of_class"))
    return asked.join(smallest, ["key", "of_class"]).where(F.col("node") != F.col("smallest.node")).select(
        "node", F.col("smallest.node").alias("center"), F.col("smallest.n").alias("center_n")).distinct()


def _with_class_centers(groups: DataFrame, similarity: float) -> DataFrame:
    """(a, b): members of groups with their class centers, as one more round of leaders."""
    return _class_centers(groups, similarity).select(
        F.least("node", "center").alias("a"), F.greatest("node", "center").alias("b")).distinct()


def _near_centers(near: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """(a, b): all pairs of members of a group that are in different components and may be linked, for members close to
    the middle of their group; some pairs that are linked for sure come along.

    Of two members that are similar enough, both are compared with the center of the smaller one's class, which is no
    larger than either. If both are linked to it, they are in one component through it. One that is not linked to it
    shares so little with it that it has something in common with the other outside the center: ``lacking`` shingles
    at least. Shingles that only members of one component have outside a center are of no use. Those left are in one
    order for all members, the rarest first: with the first one that two members have in common, what follows it in
    either list has to be enough for what the pair lacks.
    """
    least = round(100 * similarity)
    who = near.select("node", "component", "n", "r").distinct()
    asked = materialize(_class_centers(near, similarity), "asked-centers")
    compared = _from_centers(asked, sets).join(asked, ["node", "center"]).join(who, "node")
    enough = F.lit(100 + least) * F.col("shared") >= least * (F.col("n") + F.col("center_n"))
    lacking = F.ceil(least * (F.col("n") + F.col("center_n")) / (100 + least)) - F.col("shared")
    compared = materialize(compared.select("node", "center", "component", "n", "r", "shared", "outside",
                                           enough.alias("linked"), lacking.cast("long").alias("lacking")), "compared")
    sure = compared.where("linked").select(F.least("node", "center").alias("a"), F.greatest("node", "center").alias("b"))
    rows = compared.withColumn("shingle", F.explode("outside")).drop("outside")
    useful = rows.groupBy("center", "shingle").agg(
        F.min("component").alias("low"), F.max("component").alias("high"), F.count("*").alias("times"),
        F.bool_and("linked").alias("all_linked")).where("low < high AND NOT all_linked")
    rows = rows.join(materialize(useful.select("center", "shingle", "times"), "useful-shingles"), ["center", "shingle"])
    own = Window.partitionBy("center", "node")
    # "rest": how many shingles of the list there are from this one on.
    rows = rows.withColumn("place", F.row_number().over(own.orderBy("times", "shingle"))).withColumn(
        "rest", F.count("*").over(own) - F.col("place") + 1).where(F.col("rest") >= F.greatest("lacking", F.lit(1)))
    rows = materialize(rows.select("center", "shingle", "node", "component", "n", "r", "shared", "rest", "linked"),
                       "outside-centers")
    names = ["node", "component", "n", "r", "shared", "rest"]
    x = rows.where("NOT linked").select("center", "shingle", *[F.col(c).alias(f"{c}_x") for c in names]).alias("l")
    y = rows.select("center", "shingle", *[F.col(c).alias(f"{c}_y") for c in names]).alias("o")
    needed = least * (F.col("n_x") + F.col("n_y"))  # of what both have, in 1 / (100 + least)
    met = x.join(y, (F.col("l.center") == F.col("o.center")) & (F.col("l.shingle") == F.col("o.shingle"))
                 & (F.col("component_x") != F.col("component_y"))
                 & ((100 + least) * (F.least("shared_x", "shared_y") + F.least("rest_x", "rest_y")) >= needed)
                 & _can_link(F.col("r_x"), F.col("r_y"), F.col("n_x"), F.col("n_y"), similarity))
    met = met.select(F.col("node_x").alias("x"), F.col("node_y").alias("y"))
    pairs = met.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))
    return pairs.unionByName(sure).distinct()


def _from_centers(nodes: DataFrame, sets: DataFrame) -> DataFrame:
    """(node, center, shared, outside) for (node, center): how much the two sets share, and what only the node's has."""
    own = sets.select(F.col("node").alias("own"), "shingles")
    middle = sets.select(F.col("node").alias("center"), F.col("shingles").alias("middle"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            shared, outside = [], []
            for i in range(batch.num_rows):
                x, c = (np.frombuffer(batch.column(k)[i].as_buffer(), np.uint64) for k in (2, 3))
                rest = np.setdiff1d(x, c, assume_unique=True)
                shared.append(len(x) - len(rest))
                outside.append(rest.view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(shared, pa.int64()),
                 pa.array(outside, pa.list_(pa.int64()))], ["node", "center", "shared", "outside"])
    joined = nodes.select("node", "center").join(own, F.col("node") == F.col("own")).join(middle, "center")
    return joined.select("node", "center", "shingles", "middle").mapInArrow(
        run, "node bigint, center bigint, shared bigint, outside array<bigint>")


def _left_over(groups: DataFrame, weights: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """(a, b): all pairs of members of a group that are in different components and may be linked.

    A node that shares too little with its group's center for a link to any member has to share the rest with that
    member outside the center. Such links are looked up by the shingles outside, the rarest first and only as many as
    one of them has to be among; the other nodes of a group, close to its center, by ``_near_centers``.
    """
    least = round(100 * similarity)
    heavy = groups.join(weights, "node")
    lead = materialize(heavy.groupBy("key").agg(
        F.min(F.struct((-F.col("weight")).alias("by"), F.col("node").alias("node"))).alias("lead"),
        F.min("n").alias("least_n")), "centers")
    nodes = materialize(groups.join(lead, "key").groupBy("node", "component", "n", "r").agg(
        F.min(F.when(F.col("lead.node") != F.col("node"), F.col("lead")))["node"].alias("center"),
        F.min("least_n").alias("least_n")), "left-over")
    compared = _from_centers(nodes.where("center IS NOT NULL"), sets).drop("center")
    lacking = F.ceil(least * (F.col("n") + F.col("least_n")) / (100 + least)) - F.col("shared")
    far = materialize(compared.join(nodes, "node").withColumn("lacking", lacking).where("lacking >= 1").select(
        "node", "outside", "lacking"), "far")
    near = materialize(groups.join(far.select("node"), "node", "left_anti"), "near")
    rows = materialize(_shingle_rows(sets.join(nodes.select("node"), "node", "left_semi")), "left-over-shingles")
    outside = far.select(F.col("node").alias("x"), (F.size("outside") - F.col("lacking") + 1).alias("most"),
                         F.explode("outside").alias("shingle")).where("most > 0")
    counts = rows.groupBy("shingle").agg(F.count("*").alias("times"))
    place = F.row_number().over(Window.partitionBy("x").orderBy("times", "shingle"))
    # Written before they are looked up, so that the files of their sorting are gone by then.
    rare = materialize(outside.join(counts, "shingle").withColumn("place", place).where(
        (F.col("place") <= F.col("most")) & (F.col("times") > 1)).select("x", "shingle"), "rare-shingles")
    met = materialize(rare.join(rows.withColumnRenamed("node", "y"), "shingle").where("x <> y").select(
        "x", "y").distinct(), "met")
    known = nodes.select("node", "component", "n", "r")
    x, y = (known.select(*[F.col(c).alias(f"{c}_{of}") for c in known.columns]) for of in "xy")
    met = met.join(x, F.col("x") == F.col("node_x")).join(y, F.col("y") == F.col("node_y")).where(
        (F.col("component_x") != F.col("component_y"))
        & _can_link(F.col("r_x"), F.col("r_y"), F.col("n_x"), F.col("n_y"), similarity))
    pairs = met.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))
    return pairs.unionByName(_near_centers(near, sets, similarity)).distinct()


def _linked(docs: DataFrame, size: int, similarity: float, bands: int, width: int) -> DataFrame:
    """doc_id, text_key, n_shingles, component_id, kept, survivor."""
    bound_batches(docs.sparkSession)
    with shuffles_removed(docs.sparkSession):
        return _found(docs, size, similarity, bands, width)


def _found(docs: DataFrame, size: int, similarity: float, bands: int, width: int) -> DataFrame:
    texts = docs.select("doc_id", text_key().alias("text_key"), whole_text().alias("text"))
    signed = materialize(_signatures(texts, size, bands, width).withColumn("row", F.monotonically_increasing_id()),
                         "signatures")
    rows = materialize(signed.drop("values"), "rows")
    same = ["n", "own", "other"]
    nodes = materialize(rows.where("n > 0").groupBy(*same).agg(
        F.min("row").alias("node"), F.min("doc_id").alias("least_id")), "nodes")
    values = signed.select("row", "values").join(nodes.select("node"), F.col("row") == F.col("node"))
    tables, single = _tables(values.select("node", "values"), bands)
    release(signed)
    # Full sets of the nodes that have a candidate; one document's text gives a node's set.
    wanted = materialize(nodes.join(tables.select("node").distinct(), "node", "left_semi"), "candidates")
    ids = materialize(wanted.select(F.col("least_id").alias("wanted_id")).distinct(), "candidate-ids")
    found = texts.select("doc_id", "text").join(sized(ids), F.col("doc_id").eqNullSafe(F.col("wanted_id")), "left_semi")
    sets = _sets_of(found.select("text"), size).dropDuplicates(["own", "other"])
    sets = materialize(sets.join(wanted.select("node", "own", "other"), ["own", "other"]).select("node", "shingles"),
                       "sets")
    release(ids)
    links, labels = None, None
    facts = wanted.select("node", "n", F.col("n").alias("r"))
    weights = materialize(tables.groupBy("node").agg(F.count("*").alias("weight")), "weights")
    for turn in range(ROUNDS + 2):
        if turn == 0:
            groups = tables.withColumn("component", F.col("node"))
            if ROUNDS == 0:
                groups = groups.join(facts, "node")
        elif turn == 1:
            split = _split_values(single, labels)
            alone = materialize(_shared_parts(split.select("node").distinct(), sets), "alone")
            facts = materialize(facts.join(alone, "node", "left").select(
                "node", "n", (F.col("n") - F.coalesce("alone", F.lit(0))).alias("r")), "facts")
            groups = _possible(split, facts, similarity)
            release(tables, single, split)
        elif not new.isEmpty():
            before, groups = groups, _split_groups(groups.drop("component"), labels)
            release(before)
        if turn and groups.isEmpty():
            break
        if turn < ROUNDS:
            pairs = _with_leaders(groups, weights, turn)
        elif turn == ROUNDS:
            pairs = _with_class_centers(groups, similarity)
        else:
            pairs = _left_over(groups, weights, sets, similarity)
        new = materialize(_confirmed(_fitting(pairs, facts, similarity), sets, similarity), "links")
        if turn and new.isEmpty():
            continue
        links = new if links is None else links.union(new)
        if labels is not None:
            release(labels)
        labels = components(links)
    release(groups, weights, sets)
    labels = labels.select(F.col("node").alias("labelled"), "component")
    marked = nodes.join(labels, F.col("node") == F.col("labelled"), "left")
    marked = materialize(marked.select(*same, F.coalesce("component", "node").alias("component")), "marked")
    described = rows.select("row", "doc_id", "text_key", *same).join(marked, same, "left").select(
        "row", "doc_id", "text_key", "n", F.coalesce("component", F.col("row")).alias("component"))
    described = materialize(described, "described")
    best = materialize(described.groupBy("component").agg(F.min(F.struct(
        F.col("doc_id").isNull().alias("unnamed"), "doc_id", "row")).alias("best")).select(
            F.col("component").alias("of"), F.col("best.doc_id").alias("component_id"),
            F.col("best.row").alias("best_row")), "best")
    return described.join(best, F.col("component") == F.col("of")).select(
        "doc_id", "text_key", F.col("n").alias("n_shingles"), "component_id",
        F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"),
        (F.col("row") == F.col("best_row")).alias("survivor"))


def near_duplicates(docs: DataFrame, size: int = SHINGLE, similarity: float = SIMILARITY, bands: int = BANDS,
                    width: int = WIDTH) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, n_shingles, component_id, kept, survivor.

    Words are what stands between ASCII white space, with A-Z in lower case. A document's set has its distinct runs
    of ``size`` words, or the whole sequence as one if there are fewer; documents are linked if their sets share at
    least ``similarity`` (in whole hundredths) of their union. component_id is the smallest doc_id that can be
    reached over links, and rows that have it are kept; exactly one of them is the component's survivor. Null, empty and blank texts have
    an empty set and are linked with nothing. A null doc_id names a component only if there is no other. Rows that
    repeat are linked; an empty table gives no rows; other columns are not looked at.
    """
    return _linked(docs, size, similarity, bands, width).drop("text_key")


def without_near_duplicates(docs: DataFrame, size: int = SHINGLE, similarity: float = SIMILARITY, bands: int = BANDS,
                            width: int = WIDTH) -> DataFrame:
    """The survivor of each group of ``docs`` that ``near_duplicates`` finds, with all its columns.

    Documents without words (null, empty or blank texts) are groups of their own and stay. Of rows that share the
    smallest doc_id of a group one stays. Long texts are compared as a whole. An empty table gives an empty one, and
    columns of any name are handed on as they are.
    """
    decided = _linked(docs, size, similarity, bands, width)
    return kept_rows(docs, decided.select("doc_id", "text_key", F.col("survivor").alias("kept")))
