"""Importance resampling, hard negatives and benchmark passages against plain versions."""

import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from orderloom.llm import decontaminate, hard_negatives, importance
from orderloom.llm.words import normalized, slices

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words_of(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def prose(rng, n, alphabet=("a", "B", "cc", "Ñu", "x1", "é", "zz9", "Q")):
    return "".join(rng.choice(alphabet) + rng.choice([" ", ", ", "\n", ".\x00", "-"]) for _ in range(n))


# ---- words

def test_slices_cut_no_word():
    text = normalized("Ab,cd  É9 eeeeeeeeeeeeeeeeeeee f".encode())
    for size in (1, 3, 7, 100):
        parts = [text[a:b] for a, b in slices(text, size)]
        assert b"".join(parts) == text
        assert [w for p in parts for w in p.split()] == text.split()


# ---- importance

def test_crcs_equal_the_library():
    rng = random.Random(3)
    blob = bytes(rng.randrange(256) for _ in range(20_000))
    places = [(rng.randrange(9000), n) for n in [0, 1, 2, 255, 256, 257, 511, 512, 513, 4096, 10_001] * 3]
    found = importance.crcs(np.frombuffer(blob, np.uint8), np.array([s for s, _ in places]),
                            np.array([n for _, n in places]))
    assert [int(x) for x in found] == [zlib.crc32(blob[s:s + n]) for s, n in places]


def plain_importance(docs, target, percent=5, least_words=20, seed=42, buckets=10_000):
    def features(text):
        w = words_of(text)
        return [zlib.crc32(" ".join(w[i:i + n]).encode()) % buckets for n in (1, 2, 3) for i in range(len(w) - n + 1)]
    s, t = [0] * buckets, [0] * buckets
    for _, text in docs:
        for b in features(text):
            s[b] += 1
    for text in target:
        for b in features(text):
            t[b] += 1
    gain = [math.floor(1000 * math.log((t[b] + 1) * (sum(s) + buckets) / ((s[b] + 1) * (sum(t) + buckets))))
            for b in range(buckets)]
    out = []
    for doc, text in docs:
        own = features(text)
        h = int(hashlib.sha256(f"{seed}:{'' if doc is None else doc}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[b] for b in own)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([doc, len(words_of(text)), len(own), weight, score, None])
    fit = sorted((r for r in out if r[1] >= least_words),
                 key=lambda r: (-r[4], r[0] is None, r[0] or 0, r[2], r[3]))
    for i, r in enumerate(fit[:len(fit) * percent // 100]):
        r[5] = i + 1
    return sorted(map(tuple, out), key=repr)


@pytest.mark.parametrize("piece", [None, 64])
def test_importance(spark, docs, monkeypatch, piece):
    """Null, empty and long texts, ties, repeated rows, no doc_id, columns with names used inside."""
    if piece:  # long texts by slices; the driver hands the module's size to nobody, so the plain functions are called
        monkeypatch.setattr(importance, "SLICE", piece)
        monkeypatch.setattr(importance.slices, "__defaults__", (piece,))
    rng = random.Random(7)
    rows = [(i, prose(rng, rng.randrange(60))) for i in range(120)]
    rows += [(1000, None), (1001, ""), (1002, " ,.-"), (1003, "w" * 3000 + " tail"), (1004, prose(rng, 20_000))]
    rows += [(5, prose(rng, 30)), (6, rows[6][1]), (None, prose(rng, 40))]
    target = [prose(rng, 50, ("a", "cc", "Ñu")) for _ in range(9)] + [None, ""]
    if piece:
        texts = [(t or "").encode() for _, t in rows]
        found = [[] for _ in texts]
        for words, owner, counts in importance._units(texts):
            for text, bucket in importance._buckets_of(words, owner, counts, 10_000):
                for t, b in zip(text.tolist(), bucket.tolist()):
                    found[t].append(b)
        for (_, text), own in zip(rows, found):
            w = words_of(text)
            assert sorted(own) == sorted(zlib.crc32(" ".join(w[i:i + n]).encode()) % 10_000
                                         for n in (1, 2, 3) for i in range(len(w) - n + 1))
        return
    table = docs(*rows).withColumn("score", F.lit("x")).withColumn("place", F.lit(1))
    goal = spark.createDataFrame([(t, 1) for t in target], "text string, item_id int")
    for percent in (5, 30):
        result = importance.importance(table, goal, percent)
        assert result.columns == ["doc_id", "n_words", "n_features", "weight", "score", "rank"]
        assert sorted(map(tuple, result.collect()), key=repr) == plain_importance(rows, target, percent)


def test_importance_of_empty_tables(spark, docs):
    none = spark.createDataFrame([], "text string")
    assert importance.importance(docs(), none).collect() == []
    assert [r["rank"] for r in importance.importance(docs((1, "a b")), none, 100, 1).collect()] == [1]


# ---- hard negatives

@pytest.mark.parametrize("most", [256, 2 ** 20, 2 ** 40, 2 ** 62])
@pytest.mark.parametrize("dim", [1, 64, 65, 300])
def test_inner_products_are_exact(most, dim):
    rng = np.random.default_rng(dim)
    a, b = rng.integers(-most, most, (6, dim)), rng.integers(-most, most, (11, dim))
    exact = np.clip(a.astype(object) @ b.T.astype(object), 1 - 2 ** 63, 2 ** 63 - 1).astype(np.int64)
    assert (hard_negatives.inner_products(hard_negatives.Matrix(a), hard_negatives.Matrix(b)) == exact).all()


def plain_negatives(rows, every=100):
    kept = [(i, vec, (label + 1) % 10 if vec % 7 == 0 else label, [math.floor(256 * float(np.float32(x))) for x in v])
            for i, (vec, v, label) in enumerate(rows)
            if vec is not None and label is not None and v is not None and all(
                x is not None and math.isfinite(x) for x in v)]
    out = []
    for i, vec, label, v in kept:
        if vec % every:
            continue
        scored = sorted((-sum(x * y for x, y in zip(v, w)), other, j, own) for j, other, own, w in kept if j != i)
        for s, positive, _, _ in [r for r in scored if r[3] == label][:5]:
            able = [r for r in scored if r[3] != label and 80 * -s <= 100 * -r[0] <= 100 * -s][:5]
            out += [(vec, positive, k + 1, r[1], -s, -r[0]) for k, r in enumerate(able)]
    return sorted(out)


@pytest.mark.parametrize("block_bytes", [8 << 20, 8 * 6 * 2])
def test_hard_negatives(spark, block_bytes):
    """Ties, repeated rows, hot vectors, nulls, vectors of other lengths, labels missing; one block and several."""
    rng = random.Random(11)
    rows = [(i, [rng.choice([-0.5, 0.25, 0.5, 1.0]) for _ in range(6)], rng.randrange(3)) for i in range(420)]
    rows += [(500 + i, [1.0, 1.0, 0.5, 0.5, 0.0, 0.25], i % 2) for i in range(200)]
    rows += [(100, rows[100][1], 1), (100, rows[100][1], 1), (700, [1.0, 1.0], 1), (701, [], 2), (800, None, 1),
             (801, [1.0, None], 1), (900, [float("nan")], 1), (901, [float("inf")], 1), (1000, [1.0] * 6, None),
             (None, [1.0] * 6, 1)]
    table = spark.createDataFrame([(*r, "x", 1) for r in rows], "vec_id bigint, embedding array<float>, label int, "
                                                                "row string, at int")
    found = hard_negatives.hard_negatives(table, block_bytes=block_bytes)
    assert sorted(map(tuple, found.collect())) == plain_negatives(rows)


def test_hard_negatives_of_empty_tables(spark):
    shape = "vec_id bigint, embedding array<float>, label int"
    columns = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    for rows in ([], [(1, [1.0], 1)], [(100, [1.0], 1)], [(100, [1.0], 1), (3, [2.0], 2)]):
        found = hard_negatives.hard_negatives(spark.createDataFrame(rows, shape))
        assert found.columns == columns and found.collect() == []


# ---- benchmark passages

def plain_hits(docs, items, window=10):
    keys = {}
    for item, text in items:
        w = words_of(text)
        for i in range(max(1, len(w) - window + 1)) if w else ():
            keys.setdefault(tuple(w[i:i + window]), set()).add(item)
    out = []
    for doc, text in docs:
        w, hit, found = words_of(text), set(), set()
        for n in {len(k) for k in keys}:
            for i in range(len(w) - n + 1):
                if tuple(w[i:i + n]) in keys:
                    hit |= set(range(i, i + n))
                    found |= keys[tuple(w[i:i + n])]
        names = ",".join(sorted(str(x) for x in found if x is not None))
        out.append((doc, len(w), len(hit), len(found - {None}), hashlib.sha256(names.encode()).hexdigest(),
                    bool(hit), sorted(hit)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("block_bytes", [8 << 20, 200])
def test_benchmark_hits(spark, docs, block_bytes):
    rng = random.Random(5)
    passages = [prose(rng, n) for n in (3, 1, 12, 25, 40, 10, 9, 11)]
    items = [(i, p) for i, p in enumerate(passages)] + [(20, passages[3]), (20, passages[4]), (None, passages[2]),
                                                       (30, None), (31, ""), (32, " -- "), (33, "Ünique thing")]
    rows = [(i, prose(rng, 30) + " " + rng.choice(passages) + " " + prose(rng, rng.randrange(20))) for i in range(60)]
    rows += [(100, None), (101, ""), (102, "ünique THING"), (103, "Ünique, thing; Ünique"), (None, passages[4]),
             (5, passages[5].upper()), (104, passages[3] + " " + passages[3]),
             (105, prose(rng, 4000) + passages[4] + prose(rng, 4000))]
    table = docs(*rows).withColumn("row", F.lit("x")).withColumn("items", F.lit(1))
    bench = spark.createDataFrame([(*i, "x") for i in items], "item_id bigint, text string, words string")
    hits = decontaminate.benchmark_hits(table, bench, block_bytes=block_bytes)
    digest = decontaminate.hit_digest(hits)
    expected = plain_hits(rows, items)
    assert sorted((tuple(r) for r in digest.collect()), key=repr) == [r[:6] for r in expected]
    texts = {}
    for doc, text in rows:
        texts.setdefault(doc, []).append(text or "")
    hit_words = {(r[0], r[1], tuple(r[6])) for r in expected}
    for r in hits.collect():
        assert (r["doc_id"], r["n_words"], tuple(w for x in r["runs"] for w in range(x["first"], x["last"] + 1))
                ) in hit_words
        for a, b in zip(r["runs"], r["runs"][1:]):
            assert b["first"] > a["last"] + 1
        assert any(all(words_of(t[x["start"]:x["end"]]) == words_of(t)[x["first"]:x["last"] + 1] for x in r["runs"])
                   for t in texts[r["doc_id"]])


def test_hits_across_slices(monkeypatch):
    """A long text gives the same by slices of any size, offsets included."""
    rng = random.Random(9)
    item = prose(rng, 30)
    text = (prose(rng, 300) + item + prose(rng, 50) + item + " x").encode()
    seen = normalized(text)

    class Sent:
        value = [(w, 7) for w in decontaminate.item_windows(item.encode(), 10)]
    machine, numbers, _, reach = decontaminate._automaton("sizes", Sent())
    whole = decontaminate._scan(seen, machine, numbers, reach)
    offsets = decontaminate._offsets(seen, whole[1])
    assert len(whole[1]) >= 2
    for size in (1, 5, 64, 333):
        monkeypatch.setattr(decontaminate.slices, "__defaults__", (size,))
        assert decontaminate._scan(seen, machine, numbers, reach) == whole
        assert decontaminate._offsets(seen, whole[1]) == offsets


def test_hits_of_empty_tables(spark, docs):
    none = spark.createDataFrame([], "item_id bigint, text string")
    assert decontaminate.benchmark_hits(docs(), none).collect() == []
    one = decontaminate.hit_digest(decontaminate.benchmark_hits(docs((1, "a b")), none)).collect()
    assert [tuple(r) for r in one] == [(1, 2, 0, 0, hashlib.sha256(b"").hexdigest(), False)]
