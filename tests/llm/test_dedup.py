"""Exact copies, near copies and repeated passages against brute force."""

import collections
import hashlib
import random
import re
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from orderloom.llm import exact_dedup, hashing, near_dedup, suffix_dedup
from orderloom.session import shared_dir


def brute_groups(rows):
    groups = collections.defaultdict(list)
    for doc_id, text in rows:
        groups[text or ""].append(doc_id)
    return groups


EXACT = [(1, "a"), (2, "a"), (3, None), (4, ""), (5, "b " * 3000), (6, "b " * 3000), (7, "b " * 2999 + "c "),
         (8, "x" * 9000), (9, "x" * 9001), (None, "a"), (10, "only"), (None, "nameless")]


@pytest.mark.parametrize("digest", [F.xxhash64, lambda c: F.length(c) % 2])
def test_exact_duplicates(docs, digest):
    found = {(r.doc_id, r.text_sha256): r for r in exact_dedup.exact_duplicates(docs(*EXACT), digest).collect()}
    assert len(found) == len(EXACT)
    for text, ids in brute_groups(EXACT).items():
        keep = max((i for i in ids if i is not None), default=None)
        for i in ids:
            row = found[i, hashlib.sha256(text.encode()).hexdigest()]
            assert (row.keep_id, row.group_size, row.kept) == (keep, len(ids), i == keep)


def test_without_duplicates_keeps_columns_and_one_of_rows_that_repeat(docs):
    kept = exact_dedup.without_duplicates(docs((1, "a"), (2, "a"), (2, "a"), (2, "b"), (None, None), (3, "")))
    assert sorted((r.doc_id, r.text) for r in kept.collect()) == [(2, "a"), (2, "b"), (3, "")]
    assert kept.columns == ["doc_id", "text", "lang", "sha", "kept"]


@pytest.mark.parametrize("run", [exact_dedup.exact_duplicates, near_dedup.near_duplicates,
                                 suffix_dedup.repeated_passages, exact_dedup.without_duplicates,
                                 near_dedup.without_near_duplicates])
def test_empty_table(docs, run):
    assert run(docs((1, "a")).where("doc_id > 1")).count() == 0


def test_chunks_put_together_are_the_text(docs):
    rng = random.Random(3)
    texts = ["".join(rng.choice("abcdt \n") for _ in range(n)) for n in (0, 1, 511, 512, 5000, 20000)] + ["z" * 9000]
    found = docs(*enumerate(texts)).select("text", F.array_join(exact_dedup.chunks(F.col("text")), "").alias("back"))
    assert all(r.text == r.back for r in found.collect())


WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text, size):
    words = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if len(words) < size:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[i:i + size]) for i in range(len(words) - size + 1))


def brute_components(rows, size):
    sets = [shingles(t, size) for _, t in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i
    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= 80 * (len(sets[i]) + len(sets[j]) - both):
                parent[root(i)] = root(j)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        least[root(i)] = min(least.get(root(i), doc_id), doc_id)
    return {doc_id: (len(sets[i]), least[root(i)]) for i, (doc_id, _) in enumerate(rows)}


def near_corpus(seed):
    """Chains of texts that drift apart, a group of many near copies, and texts that have nothing in common."""
    rng = random.Random(seed)

    def words(n):
        return [f"w{rng.randrange(3000)}" for _ in range(n)]
    texts = []
    for _ in range(4):
        chain = words(120)
        for _ in range(6):
            texts.append(" ".join(chain))
            chain = list(chain)
            for _ in range(rng.choice((3, 6, 9))):
                chain[rng.randrange(len(chain))] = f"w{rng.randrange(3000)}"
    base = words(150)
    for _ in range(60):
        copy = list(base)
        for _ in range(rng.randrange(14)):
            copy[rng.randrange(len(copy))] = "new" + str(rng.random())
        texts.append(" ".join(copy))
    texts += [" ".join(words(rng.choice((1, 2, 3, 30)))) for _ in range(30)]
    texts += [None, "", " \t\n", "One", "one", "ONE two", "é É", "é É", "a b c", "a" * 3_000_000 + " b"]
    rng.shuffle(texts)
    return list(enumerate(texts, 5))


@pytest.mark.parametrize("size", [2, 5])
def test_near_duplicates(docs, size):
    rows = near_corpus(size)
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in near_dedup.near_duplicates(docs(*rows), size).collect()}
    assert found == brute_components(rows, size)


def test_near_duplicates_with_leaders_alone_or_pairs_alone(docs, monkeypatch):
    rows = near_corpus(9)
    for rounds in (0, 1):
        monkeypatch.setattr(near_dedup, "ROUNDS", rounds)
        found = {r.doc_id: (r.n_shingles, r.component_id)
                 for r in near_dedup.near_duplicates(docs(*rows), 2).collect()}
        assert found == brute_components(rows, 2)


def test_near_duplicates_of_rows_that_repeat_and_rows_without_id(docs):
    text = "one two three four five six seven eight nine ten"
    kept = near_dedup.near_duplicates(docs((4, text), (4, text), (None, text), (9, "other words"), (None, None)))
    assert sorted(map(repr, ((r.doc_id, r.component_id, r.kept, r.survivor) for r in kept.collect()))) == sorted(map(
        repr, [(4, 4, True, True), (4, 4, True, False), (None, 4, False, False), (9, 9, True, True),
               (None, None, True, True)]))
    assert near_dedup.without_near_duplicates(docs((4, text), (4, text), (5, text + " eleven"))).count() == 1


def thue_morse(n):
    """Two strings of n letters that sums modulo a power of two cannot tell apart."""
    bits = [bin(i).count("1") % 2 for i in range(n)]
    return "".join("ab"[b] for b in bits), "".join("ba"[b] for b in bits)


def test_words_that_sums_modulo_a_power_of_two_confuse(docs):
    one, other = thue_morse(4096)
    found = near_dedup.near_duplicates(docs((1, f"{one} x"), (2, f"{other} x"), (3, one), (4, other), (5, one)))
    assert sorted((r.doc_id, r.component_id) for r in found.collect()) == [(1, 1), (2, 2), (3, 3), (4, 4), (5, 3)]


def test_polynomials_are_those_of_plain_numbers():
    rng, prime = random.Random(4), 2 ** 61 - 1
    data = bytes(rng.randrange(256) for _ in range(3000))
    places = sorted((rng.randrange(3000), rng.randrange(3001)) for _ in range(200))
    places = [(min(a, b), max(a, b)) for a, b in places]
    found = hashing.polynomials(np.frombuffer(data, np.uint8), *(np.array(x) for x in zip(*places)))
    for (a, b), value in zip(places, found):
        plain = sum((c + 1) * pow(hashing._BASE, i, prime) for i, c in enumerate(data[a:b])) % prime
        length = np.uint64((b - a) * 0xD6E8FEB86659FD93 % 2 ** 64)
        with np.errstate(over="ignore"):
            assert value == hashing.mixed(np.array([plain], np.uint64) + length)[0]


def family_corpus(seed):
    """Families of near copies around centers that resemble each other just too little, in several sizes, so that many
    members are close to the middle of a group that holds several components."""
    rng = random.Random(seed)

    def changed(words, n):
        words = list(words)
        for _ in range(n):
            words[rng.randrange(len(words))] = f"n{rng.randrange(10 ** 9)}"
        return words
    base, texts = [f"w{rng.randrange(10 ** 6)}" for _ in range(140)], []
    for turn in range(5):
        center = changed(base, 6 + turn) + [f"t{turn}-{i}" for i in range(rng.choice((0, 10, 25)))]
        for _ in range(14):
            texts.append(" ".join(changed(center, rng.randrange(7))[:rng.choice((120, 135, 200))]))
    rng.shuffle(texts)
    return list(enumerate(texts))


@pytest.mark.parametrize("rounds", [0, 3])
def test_near_duplicates_of_families_that_touch(docs, monkeypatch, rounds):
    monkeypatch.setattr(near_dedup, "ROUNDS", rounds)
    for seed in (1, 2):
        rows = family_corpus(seed)
        found = {r.doc_id: (r.n_shingles, r.component_id) for r in near_dedup.near_duplicates(docs(*rows), 2).collect()}
        assert found == brute_components(rows, 2)


def test_later_rounds_read_few_rows_of_a_node(docs, monkeypatch):
    """Near copies share most of the 256 keys of their tables; later rounds go by the values of one collection, and
    what cannot be linked is looked for once."""
    most, possible = [], near_dedup._possible

    def watched(groups, facts, similarity):
        most.append(groups.groupBy("node").count().agg(F.max("count")).first()[0])
        return possible(groups, facts, similarity)
    monkeypatch.setattr(near_dedup, "_possible", watched)
    rows = family_corpus(1)
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in near_dedup.near_duplicates(docs(*rows), 2).collect()}
    assert found == brute_components(rows, 2)
    assert len(most) == 1 and 0 < most[0] <= near_dedup.BANDS


def brute_passages(rows, length, keep_first):
    seen = collections.defaultdict(list)
    for n, (doc_id, text) in enumerate(rows):
        data = (text or "").encode()
        for at in range(len(data) - length + 1):
            seen[data[at:at + length]].append((doc_id, at, n))
    gone = collections.defaultdict(set)
    for places in seen.values():
        for doc_id, at, n in (sorted(places)[1:] if keep_first else places) if len(places) > 1 else ():
            gone[n].add(at)
    out = []
    for n, (doc_id, text) in enumerate(rows):
        spans = []
        for at in sorted(gone[n]):
            if spans and at <= spans[-1][1]:
                spans[-1][1] = at + length
            else:
                spans.append([at, at + length])
        data, kept, last = (text or "").encode(), b"", 0
        for a, b in spans:
            kept, last = kept + data[last:a], b
        out.append((doc_id, len(data), [tuple(s) for s in spans], hashlib.sha256(kept + data[last:]).hexdigest()))
    return sorted(out)


def passage_corpus(seed):
    rng = random.Random(seed)

    def prose(n):
        return "".join(rng.choice("abcdeé ") for _ in range(n))
    shared, other = prose(90), prose(70)
    texts = [prose(rng.randrange(30)) + rng.choice((shared, shared[:60], other, shared + other, "")) + prose(
        rng.randrange(30)) for _ in range(40)]
    texts += [shared, shared, shared * 2, "a" * 500, "a" * 40, "a" * 39, "ab" * 60, None, "", other[1:], texts[0]]
    rng.shuffle(texts)
    return list(enumerate(texts, 2))


@pytest.mark.parametrize("keep_first", [False, True])
@pytest.mark.parametrize("shared_bytes", [1 << 20, 0, 900])
def test_repeated_passages(docs, monkeypatch, keep_first, shared_bytes):
    monkeypatch.setattr(suffix_dedup, "SHARED_BYTES", shared_bytes)
    rows = passage_corpus(shared_bytes)
    found = suffix_dedup.repeated_passages(docs(*rows), 40, keep_first, 8).collect()
    assert sorted((r.doc_id, r.n_bytes, [(s.start, s.end) for s in r.spans], r.kept_sha256)
                  for r in found) == brute_passages(rows, 40, keep_first)


def test_passages_of_rows_that_repeat_and_rows_without_id(docs):
    found = suffix_dedup.repeated_passages(docs((1, "x y z" * 20), (1, "x y z" * 20), (None, "n" * 20)), 40, False, 8)
    assert sorted((r.n_bytes, sum(s.end - s.start for s in r.spans)) for r in found.collect()) == [
        (20, 0), (100, 100), (100, 100)]


def test_suffix_order_is_the_order_of_the_strings():
    rng = random.Random(1)
    data = bytes(rng.choice(b"ab") for _ in range(300))
    order, rank, common = suffix_dedup.suffix_order(np.frombuffer(data, np.uint8), 50)
    heads = [data[i:i + 50] for i in range(300)]
    assert [heads[i] for i in order] == sorted(heads)
    assert all((rank[i] == rank[j]) == (heads[i] == heads[j]) for i in range(300) for j in range(300))
    for k in range(1, 300):
        a, b = heads[order[k - 1]], heads[order[k]]
        shared = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
        assert common[k] in (0, 7, 14, 28, 50) and (common[k] == 50) == (a == b)
        assert common[k] <= shared or common[k] == 50 and a == b


def test_factors_and_smaller_positions_equal_brute_force():
    """Longest previous factors of strings cut at a length, positions in any order, some places left out."""
    rng = random.Random(6)
    for length in (7, 12, 40):
        data = b"".join(bytes(rng.choice(b"ab") for _ in range(9)) * rng.randrange(1, 9) for _ in range(12))
        n = len(data)
        position = np.array(rng.sample(range(5 * n), n))
        counts = np.array([i + length <= n and rng.random() < 0.9 for i in range(n)])
        factors, matched = suffix_dedup.longest_factors(np.frombuffer(data, np.uint8), position, counts, length)
        for i in range(n):
            same = [j for j in range(n) if j != i and counts[i] and counts[j] and data[j:j + length] == data[i:i + length]]
            earlier = [j for j in same if position[j] < position[i]]
            assert factors[i] == (length if earlier else 0)
            if not earlier:
                assert matched[i] == bool(same)
        # Previous smaller positions by looking back one by one.
        common = np.array([rng.choice((3, length, length, length)) for _ in range(n)])
        found, _ = suffix_dedup.smaller_positions(position, common, length)
        for i in range(n):
            j = i - 1
            while j >= 0 and position[j] > position[i]:
                j -= 1
            whole = j >= 0 and min(common[j + 1:i + 1]) >= length
            assert found[i] == (j if whole else -1)


def test_the_last_place_in_order_keeps_its_match():
    """Strings that do not count and come after the last one that does are not between any two."""
    factors, matched = suffix_dedup.longest_factors(
        np.frombuffer(b"aab", np.uint8), np.arange(3), np.array([True, True, False]), 1)
    assert factors.tolist() == [0, 1, 0] and matched.tolist() == [True, False, False]


def test_places_needed_are_those_that_later_steps_look_up():
    counts = np.zeros(40, bool)
    counts[3] = True
    assert [np.flatnonzero(x).tolist() for x in suffix_dedup._needed(counts, [7, 6])] == [[3, 9, 10, 16], [3, 9], [3]]


def test_sets_do_not_depend_on_how_much_is_worked_on_at_a_time(monkeypatch):
    """A quarter of a megabyte, as workers keep what they took."""
    assert near_dedup._SLICE <= 1 << 18
    rng = random.Random(8)
    texts = [" ".join(rng.choices("abcdefg", k=rng.randrange(60))).encode() for _ in range(30)] + [b"x" * 300, b""]
    whole = near_dedup.shingle_sets(texts, 2)
    for size in (1, 7, 100):
        monkeypatch.setattr(near_dedup, "_SLICE", size)
        assert all(np.array_equal(a, b) for a, b in zip(whole, near_dedup.shingle_sets(texts, 2), strict=True))


def test_near_duplicates_leave_little_behind(spark, docs):
    """Tables and shuffle files of the steps before go while the job runs, and the session's setting stays."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    folder = Path(shared_dir(spark), "orderloom", spark.sparkContext.applicationId)
    before, setting = set(folder.glob("*")), spark.conf.get(name, None)
    text = "one two three four five six seven eight nine ten"
    assert near_dedup.near_duplicates(docs((1, text), (2, text + " x"), (3, "else")), 2).count() == 3
    left = {p.name.rsplit("-", 1)[0] for p in set(folder.glob("*")) - before}
    assert not left & {"signatures", "bands", "shared-bands", "keys", "chosen-keys", "tables", "sets", "named",
                       "split-groups", "possible", "components-links"}
    assert spark.conf.get(name, None) == setting
