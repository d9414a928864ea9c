"""Mixing, archives, search and the registered queries."""

import random
import sys

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from corpus import DATA, ROOT
from orderloom.llm import mixing, topk, warc
from orderloom.llm.queries import llm_oracles, llm_queries

TABLES = ("documents", "embeddings", "pages", "benchmark", "labels", "conversations")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{DATA}/{name}.parquet'")
    return con


@pytest.mark.parametrize("name", list(llm_oracles()))
def test_query_equals_sql(spark, duck, name):
    df = llm_queries()[name](spark, DATA)
    asked = duck.execute(llm_oracles()[name])
    columns = [c[0] for c in asked.description]
    assert sorted(df.columns) == sorted(columns)
    assert sorted(map(repr, (tuple(r) for r in df.select(*columns).collect()))) == sorted(map(repr, asked.fetchall()))


def filled(sizes, weights, most):
    """Targets by resharing the excess until none is above."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + [None] * (None in sizes)
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, left, free = {}, float(sum(sizes.values())), set(names)
    while free:
        level = left / sum(weight[s] for s in free)
        full = {s for s in free if most * sizes[s] <= level * weight[s]}
        if not full:
            target |= {s: level * weight[s] for s in free}
            break
        target |= {s: float(most * sizes[s]) for s in full}
        left -= sum(most * sizes[s] for s in full)
        free -= full
    return target


def test_mix(sourced):
    rng = random.Random(4)
    rows = [(i, " ".join(["w"] * rng.randrange(40)), rng.choice(["a", "b", "b", "b", "b", "ü", "Z", None, "empty"]))
            for i in range(3000)]
    rows = [(i, "" if s == "empty" else t, s) for i, t, s in rows] + [(None, "two words", "a"), (5000, None, "b")]
    found = mixing.mix_plan(sourced(*rows)).collect()
    sizes = {}
    for _, t, s in rows:
        sizes[s] = sizes.get(s, 0) + len((t or "").split())
    targets = filled(sizes, (5, 2, 1), 3)
    by_id = {r.doc_id: r for r in found}
    taken = {}
    for i, t, s in rows:
        row = by_id[i]
        assert row.size == len((t or "").split()) and row.source_size == sizes[s]
        assert row.target == pytest.approx(targets[s])
        assert row.taken == row.size * row.copies and row.copies <= 3
        assert sizes[s] == 0 or abs(row.copies - targets[s] / sizes[s]) < 1 + 1e-9
        taken[s] = taken.get(s, 0) + row.taken
    assert all(abs(taken[s] - targets[s]) <= 0.15 * targets[s] + 40 for s in targets)
    mixture = mixing.mix(sourced(*rows))
    assert mixture.columns == ["doc_id", "text", "source", "mix_source", "mix_copies"]
    copies = {r.doc_id: r["count"] for r in mixture.groupBy("doc_id").count().collect()}
    assert copies == {r.doc_id: r.copies for r in found if r.copies}
    assert mixing.mix_plan(sourced(*rows).where("doc_id < 0")).count() == 0
    assert mixing.mix(sourced((1, None, None), (2, "", None))).count() == 0


# Archives.

def test_archives(spark):
    body = "<p>" + "é" * 80 + "</p>"
    rows = [(5, "http://b/", body), (3, "http://a/ü x\r\nEvil: 1", body), (None, None, body), (3, "again", body),
            (7, "u", "short"), (8, "u", "short"), (9, None, None), (10, "", ""), (11, "v", "\r\n\r\nWARC/1.1" * 30)]
    pages = spark.createDataFrame([(*r, "x", 1) for r in rows],
                                  "page_id bigint, url string, html string, digest string, payload int")
    found = sorted(map(repr, ((r.page_id, r.payload_bytes, r.record_type, r.refers_to)
                              for r in warc.archive_digest(pages).collect())))
    size = len(body.encode())
    assert found == sorted(map(repr, [
        (5, size, "revisit", 3), (3, size, "response", None), (None, size, "revisit", 3), (3, size, "response", None),
        (7, 5, "response", None), (8, 5, "response", None), (9, 0, "response", None), (10, 0, "response", None),
        (11, 360, "response", None)]))
    index = warc.write_archives(pages)
    assert {r.url for r in index.collect()} == {r[1] for r in rows}
    some = warc.read_records(index.where("page_id IN (7, 11)"), gap=0, most=64).collect()
    assert {(r.page_id, bytes(r.payload).decode()) for r in some} == {(7, "short"), (11, "\r\n\r\nWARC/1.1" * 30)}
    assert warc.ranges(index).count() <= warc.ranges(index, gap=0, most=1).count()
    assert warc.archive_digest(pages.where("page_id = 99")).count() == 0


# Search.

def brute_search(rows, k):
    whole = [(i, [int(np.floor(256 * float(x))) for x in v]) for i, v in rows
             if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for at, (q, v) in enumerate(whole):
        if q % 50 == 0:
            scored = sorted((-sum(a * b for a, b in zip(v, w)), i) for j, (i, w) in enumerate(whole) if j != at)[:k]
            out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scored)]
    return sorted(out)


@pytest.mark.parametrize("cosine, query_rows", [(0.0, 4096), (0.6, 2), (2.0, 5)])
def test_top_k(spark, monkeypatch, cosine, query_rows):
    monkeypatch.setattr(topk, "COORDINATE_COSINE", cosine)
    monkeypatch.setattr(topk, "QUERY_ROWS", query_rows)
    rng = np.random.default_rng(int(cosine * 10))
    rows = []
    for i in range(700):
        v = rng.normal(size=8) * rng.choice([0.01, 0.3, 1, 40])
        rows.append((i, [float(np.float32(x)) for x in v]))
    rows += [(1000 + i, rows[3][1]) for i in range(200)]  # ties
    rows += [(50, rows[50][1]), (50, rows[50][1]), (7, rows[50][1])]  # rows that repeat
    rows += [(2000, None), (2050, [None] * 8), (2051, [float("nan")] * 8), (2052, [float("inf")] + [0.0] * 7),
             (2100, [0.0] * 8), (2101, []), (2102, [1.0, 2.0]), (None, rows[0][1]), (2150, [-x for x in rows[0][1]])]
    table = spark.createDataFrame([(*r, 1, 2) for r in rows],
                                  "vec_id bigint, embedding array<float>, block int, score int")
    found = topk.top_k(table)
    assert sorted((r.query_id, r.rank, r.vec_id, r.score) for r in found.collect()) == brute_search(rows, 5)


def test_top_k_of_few_and_repeated_and_large_vectors(spark):
    schema = "vec_id bigint, embedding array<double>"
    few = spark.createDataFrame([(0, [1.0]), (1, [2.0]), (2, [-1.0])], schema)
    assert [(r.rank, r.vec_id, r.score) for r in topk.top_k(few).orderBy("rank").collect()] == [
        (1, 1, 256 * 512), (2, 2, -256 * 256)]
    again = spark.createDataFrame([(0, [1.0]), (0, [1.0]), (1, [2.0])], schema)
    assert sorted((r.rank, r.vec_id) for r in topk.top_k(again).collect()) == [(1, 1), (1, 1), (2, 0), (2, 0)]
    large = spark.createDataFrame([(0, [1e7, 1e7]), (1, [1e7, 3.0])], schema)
    assert topk.top_k(large).first().score == (2560000000 ** 2) + 2560000000 * 768
    assert topk.top_k(few.where("vec_id = 9")).count() == 0


# The pipeline.

def test_pipeline_stages(spark):
    sys.path.insert(0, str(ROOT))
    import corpus_pipeline
    from orderloom.session import materialize
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    columns = docs.columns
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "toxicity", "exact_dedup", "near_dedup", "source_mix", "sentencepiece"]
    counts = []
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        docs = materialize(stage(spark, docs, DATA), f"test-{name}")
        counts.append(docs.count())
        if name != "sentencepiece":
            assert docs.columns == columns
            assert docs.distinct().join(before.distinct(), columns, "left_anti").isEmpty()
        if name in ("exact_dedup", "near_dedup"):
            assert docs.select("text").distinct().count() == counts[-1]
        if name == "source_mix":
            assert docs.groupBy("doc_id").count().agg(F.max("count")).first()[0] <= 3
    assert counts[0] > 100 and counts[0] >= counts[1] >= counts[2] and counts[4] == counts[3]
    texts = before.select("doc_id", F.sha2("text", 256).alias("sha")).distinct()
    assert docs.join(texts, "doc_id").where("sha <> decoded_sha256").isEmpty()


def odd_documents(spark):
    """Null, empty and very long texts, ties, repeated rows, no doc_id, no source, columns with names used inside."""
    prose = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen"
    rows = [(1, None, "a"), (2, "", "a"), (3, " \n", None), (4, prose, "a"), (5, prose, "b"), (5, prose, "b"),
            (6, prose + " fifteen", None), (7, "long " * 60_000 + "tail", "b"), (8, "w" * 200_000, "a"), (None, "no id", "c"),
            (9, "é🎉 x", "c"), (10, "1 2 3 4", "c")]
    return spark.createDataFrame([(*r, 7, "x", True, 1.5, None) for r in rows],
                                 "doc_id bigint, text string, source string, row int, text_key string, kept boolean, "
                                 "score double, _part string")


def test_pipeline_stages_on_odd_rows_and_empty_tables(spark):
    sys.path.insert(0, str(ROOT))
    import corpus_pipeline
    table = odd_documents(spark)
    texts = {name: sorted(((r.doc_id, (r.text or "")[:90]) for r in stage(spark, table, DATA).collect()), key=repr)
             for name, stage in corpus_pipeline.STAGES[:-1]}
    whole = sorted(((r.doc_id, (r.text or "")[:90]) for r in table.collect()), key=repr)
    assert texts["toxicity"] == whole  # nothing in it is toxic
    exact = [x for x in whole if x[0] not in (1, 4)]  # null counts as empty; of rows that repeat one stays
    exact.remove(next(x for x in whole if x[0] == 5))
    assert texts["exact_dedup"] == exact
    near = [x for x in whole if x[0] not in (5, 6)]
    assert texts["near_dedup"] == near
    times = {x: whole.count(x) for x in whole}
    assert all(texts["source_mix"].count(x) <= 3 * times[x] for x in texts["source_mix"])
    for name, stage in corpus_pipeline.STAGES:
        made, empty = stage(spark, table, DATA), stage(spark, table.where("false"), DATA)
        assert empty.columns == made.columns and empty.collect() == []
        if name != "sentencepiece":
            assert made.columns == table.columns and made.dtypes == table.dtypes
    import hashlib
    encoded = corpus_pipeline.encode(spark, table, DATA).collect()
    assert sorted((repr(r.doc_id), r.decoded_sha256) for r in encoded) == sorted(
        (repr(r.doc_id), hashlib.sha256((r.text or "").encode()).hexdigest()) for r in table.collect())
    assert {r.doc_id: r.n_ids for r in encoded if r.doc_id in (1, 2)} == {1: 0, 2: 0}
