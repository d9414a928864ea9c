"""Toxicity by boosted trees over a dozen dense features, with calibrated scores.

The words that count are learned: those, and those first letters of words, that are far more frequent in texts
marked toxic than in others. Features are rates of such words, how often they come close to a word that addresses
the reader, and rates of capitals, punctuation and characters that hide letters. A table of features is all that
training and scoring look at.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression, IsotonicRegressionModel
from pyspark.sql import Column, DataFrame, functions as F

from orderloom.llm.common import sized, whole_text
from orderloom.session import materialize

# At most about so many labelled rows train the trees, picked by a hash of their id; words are counted in all of them.
TRAIN_ROWS = 20_000
THRESHOLD = 0.3
# Words on each side of a hit that are searched for one that addresses the reader.
NEAR = 6
# Words, and stems of these lengths, that at least LEAST toxic texts hold, and that are RATIO times as frequent there.
LEAST, RATIO, STEMS = 6, 10.0, (4, 5, 6, 7, 8)
# Counts of so many words and stems are held before they are handed on.
_HELD = 300_000
# Words that address the reader in the languages of the corpus.
SECOND = frozenset("you your yours yourself youre u ur du dich dir dein deine ihr euch tu te toi ton ta tes vous votre "
                   "vos usted ustedes ti tuyo vosotros".split())
FEATURES = ["words", "hits", "hit_rate", "stem_hits", "stem_rate", "kinds", "near_second", "near_rate", "second_rate",
            "hidden_hits", "hidden_rate", "capitals", "capital_runs", "punctuation", "marks", "repeats"]
_WORD = re.compile(r"[^\W\d_]+")
# Characters that stand for letters in words that hide from lists (fixed values).
_HIDING = str.maketrans("013457@$!|", "oieastasil")
_HIDDEN = re.compile(r"[^\W\d_][0-9@$!|*.\-_]+[^\W\d_]|(?<!\S)[0-9@$]+[^\W\d_]")
_BARE = re.compile(r"[\W_]")
_LETTER, _UPPER, _MARK, _ASKING = (np.zeros(256, bool) for _ in range(4))
_UPPER[65:91] = True
_LETTER[65:91] = _LETTER[97:123] = True
_MARK[33:127] = ~_LETTER[33:127]
_MARK[48:58] = False
_ASKING[[33, 63]] = True
_CLEAN, _HIT, _STEM, _SECOND = range(4)


@dataclass(frozen=True)
class Lexicon:
    words: frozenset[str]
    stems: frozenset[str]


def is_held_out(doc_id: Column) -> Column:
    """Rows that nothing is learned from: the checksum of the id, as text, leaves 2 modulo 4."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


class _Kinds(dict):
    """What a word is: one of the lexicon, one with a stem of it, one that addresses the reader, or neither. Words are
    looked at once; the memory is emptied when it is full."""

    def __init__(self, lexicon: Lexicon):
        self.lexicon = lexicon

    def __missing__(self, word: str) -> int:
        if len(self) > 500_000:
            self.clear()
        if word in self.lexicon.words:
            kind = _HIT
        elif word in SECOND:
            kind = _SECOND
        else:
            kind = _STEM if any(word[:n] in self.lexicon.stems for n in STEMS) else _CLEAN
        self[word] = kind
        return kind


def learn_lexicon(labelled: DataFrame) -> Lexicon:
    """Words and stems that tell toxic texts from others, from rows (text, toxic).

    Per word, the texts of either kind that hold it are counted over the whole input; only those that stand out are
    brought together.
    """
    def terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = Counter(), Counter()

        def batch() -> pa.RecordBatch:
            held = list(counts[0].keys() | counts[1].keys())
            return pa.RecordBatch.from_arrays(
                [pa.array(held, pa.string()), *(pa.array([c[t] for t in held], pa.int64()) for c in counts)],
                ["term", "clean", "toxic"])
        for part in batches:
            for text, toxic in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                found = set(_WORD.findall(text.lower()))
                found.update([f"{w[:n]}*" for w in found for n in STEMS if len(w) > n])
                counts[toxic].update(found)
                if len(counts[0]) + len(counts[1]) > _HELD:
                    yield batch()
                    counts = Counter(), Counter()
        yield batch()
    totals = labelled.agg(F.count_if(F.col("toxic") == 1).alias("toxic"), F.count_if(F.col("toxic") == 0).alias("clean")).first()
    share = totals["toxic"] / max(1, totals["clean"])
    counted = labelled.select("text", F.col("toxic").cast("int").alias("toxic")).mapInArrow(
        terms, "term string, clean bigint, toxic bigint").groupBy("term").agg(
            F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    strong = counted.where((F.col("toxic") >= LEAST) & (F.col("toxic") > RATIO * (F.col("clean") + 0.5) * share))
    top = [r["term"] for r in strong.select("term").collect()]
    return Lexicon(frozenset(t for t in top if not t.endswith("*")), frozenset(t[:-1] for t in top if t.endswith("*")))


def features_of(text: str, kinds: _Kinds) -> list[float]:
    """The features of one text; all 0 for an empty one."""
    words = _WORD.findall(text.lower())
    codes = np.fromiter(map(kinds.__getitem__, words), np.int8, len(words))
    hits, stems, seconds = (np.flatnonzero(codes == k) for k in (_HIT, _STEM, _SECOND))
    hidden = 0
    if _HIDDEN.search(text):
        for token in text.lower().split():
            if _HIDDEN.search(token):
                bare = _BARE.sub("", token.translate(_HIDING)), _BARE.sub("", token)
                hidden += (any(b in kinds.lexicon.words for b in bare)
                           and not any(w in kinds.lexicon.words for w in _WORD.findall(token)))
    near = 0
    if len(seconds):
        at = np.sort(np.concatenate((hits, stems)))
        near = int((np.searchsorted(seconds, at + NEAR, "right") > np.searchsorted(seconds, at - NEAR)).sum())
    data = np.frombuffer(text.encode("utf-8", "replace"), np.uint8)
    upper, letters, asking = _UPPER[data], _LETTER[data], _ASKING[data]
    triple = upper[:-2] & upper[1:-1] & upper[2:]
    capital = int(triple[:1].sum() + (triple[1:] & ~upper[:-3]).sum()) if len(data) > 2 else 0
    repeats = int((letters[2:] & (data[2:] == data[1:-1]) & (data[1:-1] == data[:-2])).sum()) if len(data) > 2 else 0
    n, per = max(1, len(text)), 1000 / max(1, len(words))
    return [math.log1p(len(words)), float(len(hits)), len(hits) * per, float(len(stems)), len(stems) * per,
            float(len({words[i] for i in hits.tolist()})), float(near), near * per, len(seconds) * per, float(hidden),
            hidden * per, int(upper.sum()) / max(1, int(letters.sum())), capital * per, int(_MARK[data].sum()) / n,
            int((asking[1:] & asking[:-1]).sum()) * per, repeats * per]


def feature_column(lexicon: Lexicon, text: Column) -> Column:
    """The features of a text, as a vector."""
    @F.arrow_udf("array<double>")
    def run(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        kinds = _Kinds(lexicon)
        for batch in texts:
            yield pa.array([features_of(t.as_py(), kinds) for t in batch], pa.list_(pa.float64()))
    return array_to_vector(run(text))


def _usable(labels: DataFrame) -> DataFrame:
    """(label_id, toxic) of the documents that may be learned from."""
    usable = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1) & ~is_held_out(F.col("doc_id")))
    return materialize(usable.groupBy(F.col("doc_id").alias("label_id")).agg(
        F.max("toxic").cast("int").alias("toxic")), "toxic-labels")


def _sample(usable: DataFrame, rows: int) -> DataFrame:
    """About ``rows`` of the labelled rows, the same on every run, with how many rows each stands for as "weight".

    Each kind of label is drawn by itself and gets a quarter of the rows at least, or all it has, so that many toxic
    texts are seen even where they are rare.
    """
    found = {r["toxic"]: r["count"] for r in usable.groupBy("toxic").count().collect()}
    n = sum(found.values())
    if n <= rows:
        return usable.withColumn("weight", F.lit(1.0))
    rare = min(found, key=lambda y: (found[y], y))
    wanted = {rare: min(found[rare], max(rows * found[rare] / n, rows / 4))}
    wanted |= {y: rows - wanted[rare] for y in found if y != rare}
    share = {y: min(1.0, wanted[y] / found[y]) for y in found}

    def of_kind(values: dict[int, float]) -> Column:
        return F.when(F.col("toxic") == 1, F.lit(values.get(1, 0.0))).otherwise(F.lit(values.get(0, 0.0)))
    bound = of_kind({y: float(int((1 << 30) * x)) for y, x in share.items()})
    return usable.where(F.pmod(F.xxhash64("label_id"), F.lit(1 << 30)) < bound).withColumn(
        "weight", of_kind({y: 1 / x for y, x in share.items()}))


def _split(texts: DataFrame) -> DataFrame:
    """``texts`` with "fit" and "calibrate": three quarters and a quarter of the rows. If a kind of label would be
    missing from one of them, its row with the smallest hash is in both."""
    turn = F.xxhash64(F.lit("calibrate"), "doc_id")
    texts = texts.withColumn("turn", turn).withColumn("last", F.pmod("turn", F.lit(4)) == 0)
    kinds = {r["toxic"]: r for r in texts.groupBy("toxic").agg(
        F.min("turn").alias("least"), F.bool_and("last").alias("all"), F.bool_or("last").alias("some")).collect()}
    fit, calibrate = ~F.col("last"), F.col("last")
    for toxic, r in kinds.items():
        least = (F.col("toxic") == toxic) & (F.col("turn") == F.lit(r["least"]))
        fit, calibrate = fit | least if r["all"] else fit, calibrate if r["some"] else calibrate | least
    return texts.withColumns({"fit": fit, "calibrate": calibrate}).drop("turn", "last")


def _raw() -> Column:
    """The value of the trees."""
    return vector_to_array("rawPrediction")[1]


@dataclass(frozen=True)
class Toxicity:
    """What training gives: the lexicon, the trees, and the steps that turn their raw value into a probability."""

    lexicon: Lexicon
    trees: GBTClassificationModel | None
    calibration: IsotonicRegressionModel | None
    rate: float

    def scored(self, docs: DataFrame) -> DataFrame:
        """The columns of ``docs`` as one column "all", and the probability of each row as "score"."""
        rows = docs.select(F.struct(*docs.columns).alias("all"), whole_text().alias("text"))
        if self.trees is None:
            return rows.select("all", F.lit(self.rate).alias("score"))
        rows = rows.select("all", feature_column(self.lexicon, F.col("text")).alias("features"))
        raw = self.trees.transform(rows).select("all", _raw().alias("raw"))
        # Outside Python: a second function there would give each task another worker, which stays for later stages.
        return self.calibration.transform(raw).select("all", F.col("score"))


def train(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> Toxicity:
    """Learn from the labelled documents that are not held out: the words from all of them, the trees and the
    calibration from at most about ``rows``.

    Labels other than 0 and 1 and rows without doc_id are left out; a document with several labels is toxic if one
    says so. Three quarters of the rows train the trees, the rest the calibration; both weigh each kind of label as it
    is found in all rows. Without both kinds of label no trees are made, and every text gets the share of toxic ones,
    0 if there are none.
    """
    usable = _usable(labels)
    sample = materialize(_sample(usable, rows), "toxic-sample")
    texts = docs.select("doc_id", whole_text().alias("text"))
    # As many rows as the bound says.
    drawn = texts.join(F.broadcast(sample), F.col("doc_id") == F.col("label_id"))
    drawn = materialize(drawn.select("doc_id", "text", F.col("toxic").cast("double").alias("toxic"), "weight"), "toxic-texts")
    seen = {r["toxic"]: r["weight"] for r in drawn.groupBy("toxic").agg(F.sum("weight").alias("weight")).collect()}
    rate = seen.get(1.0, 0.0) / (sum(seen.values()) or 1.0)
    if len(seen) < 2:
        return Toxicity(Lexicon(frozenset(), frozenset()), None, None, rate)
    lexicon = learn_lexicon(texts.join(sized(usable), F.col("doc_id") == F.col("label_id")).select("text", "toxic"))
    table = materialize(_split(drawn).select(
        feature_column(lexicon, F.col("text")).alias("features"), "toxic", "weight", "fit", "calibrate"), "toxic-features")
    trees = GBTClassifier(labelCol="toxic", featuresCol="features", weightCol="weight", maxIter=20, maxDepth=4,
                          stepSize=0.2, seed=7, subsamplingRate=1.0).fit(table.where("fit"))
    raw = trees.transform(table.where("calibrate")).select(_raw().alias("raw"), "toxic", "weight")
    calibration = IsotonicRegression(featuresCol="raw", labelCol="toxic", weightCol="weight", predictionCol="score").fit(raw)
    return Toxicity(lexicon, trees, calibration, rate)


def toxicity(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS, threshold: float = THRESHOLD) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, held_out, score, predicted.

    ``labels`` has doc_id and toxic. A null text counts as empty and is scored like any other; a null doc_id is not
    held out; rows that repeat give rows that repeat; an empty table gives none. Columns other than the text are not
    looked at for a score.
    """
    scored = train(docs, labels, rows).scored(docs.select("doc_id", "text"))
    return scored.select("all.doc_id", is_held_out(F.col("all.doc_id")).alias("held_out"), "score",
                         (F.col("score") >= threshold).cast("int").alias("predicted"))


def without_toxic(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS,
                  threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` with a score below the threshold, with all their columns, whatever they are called.

    All rows stay if there are not both kinds of label, as then nothing tells the rows apart. Null and empty texts are
    scored like any other, long ones as a whole; rows that repeat stay or go together; an empty table gives an empty
    one.
    """
    learned = train(docs, labels, rows)
    if learned.trees is None:
        return docs
    return learned.scored(docs).where(F.col("score") < threshold).select("all.*")
