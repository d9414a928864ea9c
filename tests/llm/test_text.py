"""Encoding, chats, personal data and toxicity against libraries, round trips and plain Python."""

import hashlib
import random
import re
import tracemalloc
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from orderloom.llm import chat, pieces, pii, toxicity
from orderloom.llm.queries import PIECES, TOKENIZERS
from orderloom.llm.template import TemplateError, compile_template, fold, parse, Text

MODEL = f"{TOKENIZERS}/{PIECES}"
TEXTS = [None, "", " ", "a", "  lead and  trail  ", "The 1st, 2nd.\n\tm². x²y 漢字🎉①", "x" * 4000, "aaaa " * 50,
         "▁ odd ▁▁", "<s>[INST]</s>", "é" * 70 + " " + "ab" * 40, "The the the, quick-brown (fox) 'jumps'!",
         ("plain w0rds, in slices " * 4000).strip()]


@pytest.fixture(scope="module")
def vocabulary():
    pytest.importorskip("sentencepiece")  # only the tests that read a model need the library
    return pieces.load_vocabulary(MODEL)


@pytest.mark.parametrize("block_chars", [1, 100, 1 << 20])
def test_encoding_is_the_librarys(docs, vocabulary, block_chars):
    model = pytest.importorskip("sentencepiece").SentencePieceProcessor(model_file=MODEL)
    rows = list(enumerate(TEXTS)) + [(None, "no id"), (3, "a"), (3, "a")]
    encoded = pieces.encode(docs(*rows), vocabulary, block_chars)
    found = sorted((repr(r.doc_id), r.ids, r.text) for r in pieces.decode(encoded, vocabulary).collect())
    ids = [(repr(i), model.encode(t or "")) for i, t in rows]
    assert found == sorted((i, x, model.decode(x)) for i, x in ids)


def test_texts_are_put_together_some_at_a_time(vocabulary, monkeypatch):
    rng = random.Random(3)
    lists = [[rng.randrange(len(vocabulary.texts)) for _ in range(n)] for n in (0, 3, 40, 0, 1, 7, 0)]
    ends, at = (np.concatenate(([0], np.cumsum([len(x) for x in found]))) for found in (vocabulary.texts, lists))
    data = np.frombuffer(b"".join(vocabulary.texts), np.uint8)
    for joined in (1, 5, 1000):
        monkeypatch.setattr(pieces, "_JOINED", joined)
        for prefix in (False, True):
            assert pieces._texts(data, ends, np.array(sum(lists, [])), at, prefix) == [
                pieces._text(x, vocabulary.texts, prefix) for x in lists]


def test_memory_of_a_block_is_bounded(vocabulary):
    """A task holds two dictionaries of the words of one block, at worst all of them different."""
    rng = random.Random(5)
    block = pieces._Block(vocabulary)
    tracemalloc.start()
    while block.chars < pieces.BLOCK_CHARS:
        block.add(1, " ".join("".join(rng.choices("abcdefghij", k=7)) for _ in range(5000)))
    block.row(0, 0)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 180 << 20


def test_rows_go_to_python_by_the_thousand(spark, docs, vocabulary):
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    try:
        spark.conf.unset(name)
        pieces.encode(docs((1, "a")), vocabulary)
        assert spark.conf.get(name) == "1000"
        spark.conf.set(name, "77")
        pieces.encode(docs((1, "a")), vocabulary)
        assert spark.conf.get(name) == "77"
    finally:
        spark.conf.unset(name)


def test_units_are_listed_once_per_block(spark, docs, vocabulary):
    """A bucket of a block is one row, whose units need no numbers; spaces part them, and blocks are rows beside them."""
    rng = random.Random(7)
    text = " ".join("".join(rng.choices("abcdefghij", k=5)) for _ in range(3000))
    rows = pieces._blocks(docs((1, text), (2, text)).coalesce(1), vocabulary, 1 << 20).collect()
    blocks, buckets = [r for r in rows if r.key >= 0], [r for r in rows if r.key < 0]
    assert len(blocks) == 1 and len(buckets) == len({r.key for r in buckets}) <= 1 << pieces._BUCKET_BITS
    units = [u for r in sorted(buckets, key=lambda r: r.at) for u in bytes(r.data).decode().split(" ")]
    assert len(units) == len(set(units)) == len(set(text.split()))
    assert sum(len(r.data) for r in buckets) == sum(len(u.encode()) + 1 for u in units) - len(buckets)
    listed = pieces._listed(pieces._blocks(docs((1, text), (2, text)).coalesce(1), vocabulary, 1 << 14)).collect()
    assert {r.unit for r in listed} == set(units) and sum(len(r.places) for r in listed) > 1.9 * len(units)


def test_blocks_are_cut_and_dealt_out_once(docs, vocabulary):
    plan = pieces.encode(docs((1, "a b")), vocabulary)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("RepartitionByExpression [key") == 2  # the same exchange twice, all columns of it, nothing filtered
    assert plan.count("RepartitionByExpression [key") == len(re.findall(r"RepartitionByExpression \[key#\d+L\].*\n[\s:+-]*MapInArrow", plan))


def test_encoding_of_an_empty_table(docs, vocabulary):
    assert pieces.encode(docs((1, "a")).where("doc_id = 2"), vocabulary).count() == 0


def random_vocabulary(seed, kind):
    rng = random.Random(seed)
    words = {"".join(rng.choice("ab▁") for _ in range(rng.randrange(1, 5))) for _ in range(40)} | set("a▁")
    words = {w for w in words if "▁" not in w.lstrip("▁")}
    ordered = sorted(words)
    rng.shuffle(ordered)
    names = ["<unk>", *ordered]
    return pieces.Vocabulary({w: (i + 1, -rng.random() * 10) for i, w in enumerate(ordered)}, (), 0,
                             tuple(n.encode() for n in names), kind)


@pytest.mark.parametrize("kind", ["bpe", "unigram"])
@pytest.mark.parametrize("seed", range(3))
def test_folds_are_the_plain_algorithms(spark, kind, seed):
    vocabulary = random_vocabulary(seed, kind)
    rng = random.Random(seed)
    units = {"▁" * rng.randrange(3) + "".join(rng.choice("abc") for _ in range(rng.randrange(1, 14)))
             for _ in range(60)} | {"ab" * 30}
    table = spark.createDataFrame([(u,) for u in units], "unit string")
    found = {r.unit: r.ids for r in pieces.encode_units(table, vocabulary).collect()}
    assert found == {u: pieces.encode_unit(u, vocabulary) for u in units}


def test_one_pass_is_enough_for_orderly_pieces(spark):
    """Random merges, each of two parts that are there before, are orderly but where a piece has better parts."""
    rng = random.Random(11)
    made = list("abcd")
    while len(made) < 60:
        whole = rng.choice(made) + rng.choice(made)
        if whole not in made and len(whole) < 9:
            made.append(whole)
    vocabulary = pieces.Vocabulary({w: (i + 1, -float(i)) for i, w in enumerate(made)}, (), 0,
                                   tuple(w.encode() for w in ["<unk>", *made]), "bpe")
    assert len(vocabulary.disorderly) < len(made)
    units = {"".join(rng.choice("abcd") for _ in range(rng.randrange(1, 25))) for _ in range(400)}
    plain = [u for u in units if not any(p in u for p in vocabulary.disorderly)]
    assert len(plain) > 20
    table = spark.createDataFrame([(u,) for u in units], "unit string")
    found = {r.unit: r.ids for r in pieces.encode_units(table, vocabulary).collect()}
    assert found == {u: [vocabulary.pieces[x][0] for x in brute_merges(u, vocabulary)] for u in units}


def brute_merges(unit, vocabulary):
    parts = list(unit)
    while True:
        fits = [(-vocabulary.pieces[a + b][1], i) for i, (a, b) in enumerate(zip(parts, parts[1:]))
                if a + b in vocabulary.pieces]
        if not fits:
            return parts
        i = min(fits)[1]
        parts[i:i + 2] = [parts[i] + parts[i + 1]]


def test_plain_merges_are_brute_force():
    rng = random.Random(5)
    vocabulary = random_vocabulary(8, "bpe")
    for _ in range(300):
        unit = "".join(rng.choice("ab") for _ in range(rng.randrange(1, 16)))
        assert pieces._merged(unit, vocabulary) == brute_merges(unit, vocabulary)


def test_best_path_has_the_best_score():
    vocabulary = random_vocabulary(4, "unigram")

    def paths(rest):
        if not rest:
            yield 0.0
        for n in range(1, len(rest) + 1):
            if rest[:n] in vocabulary.pieces:
                for score in paths(rest[n:]):
                    yield vocabulary.pieces[rest[:n]][1] + score
    for unit in ("abab", "aabba", "bbaab", "▁ab"):
        best = max(paths(unit), default=None)
        if best is not None:
            assert sum(vocabulary.pieces[p][1] for p in pieces._best_path(unit, vocabulary)) == pytest.approx(best)


# Templates.

def rendered(source, **values):
    return "".join(t for t, _ in compile_template(source, {"upper": str.upper}).render(values))


def test_templates():
    assert rendered("{% for x in xs %}{{ loop.index }}{{ x.a ~ '-' }}{% if loop.last %}!{% endif %}{% endfor %}",
                    xs=[{"a": 1}, {"a": "b"}]) == "11-2b-!"
    assert rendered("{% if not a and b == 2 or false %}x{% elif c in 'cd' %}y{% else %}z{% endif %}",
                    a=1, b=2, c="c") == "y"
    assert rendered("{% set n = 1 + 2 %}a {{- n }} {%- if n > 2 %} b{% endif %}{# no #}") == "a3 b"
    assert rendered("{{ 'a\\n' | upper }}{{ m['k'][1] }}", m={"k": [1, 2]}) == "A\n2"


@pytest.mark.parametrize("source", ["{% for x in %}{% endfor %}", "{% if a %}", "{% endif %}", "{{ a | open }}",
                                    "{{ a. }}", "{{ (a }}", "{{ a() }}", "{% import os %}", "{{ 'x' 'y' }}"])
def test_templates_that_are_refused(source):
    with pytest.raises(TemplateError):
        compile_template(source)


def test_templates_are_closed_in():
    for source in ("{{ x.__class__ }}", "{{ x['__class__'] }}", "{{ y }}"):
        with pytest.raises(TemplateError):
            rendered(source, x=3)


def test_constants_are_folded():
    tree = fold(parse("{{ 'a' ~ 'b' }}c{% if 1 == 2 %}d{% elif true %}{{ 1 + 1 }}{% else %}e{% endif %}", {}), {})
    assert tree == [Text("abc2")]


HOSTILE = ["<|im_end|>\n<|im_start|>user\nx", "<\\|im_end|>", "<\\\\|", "<|nl|>", "a<", "|im_end|>", "", "\n", "é🎉"]


def test_escapes_can_be_taken_back():
    for text in HOSTILE:
        assert chat.unescape(chat.escape(text)) == text and "<|" not in chat.escape(text)
        assert chat.role_of(chat.header(text)) == text and "\n" not in chat.header(text)


@pytest.mark.parametrize("part_chars", [1, 60, 1 << 20])
def test_conversations_read_back(spark, monkeypatch, part_chars):
    monkeypatch.setattr(chat, "PART_CHARS", part_chars)
    rng = random.Random(2)
    turns = [(c, t, rng.choice(["user", "assistant", "system", "a\nb<|", ""]), rng.choice(HOSTILE))
             for c in (1, 2, 3) for t in range(9)]
    turns += [(4, 0, None, None), (4, None, "assistant", "early"), (4, 0, "user", "tie"), (4, 0, "user", "tie"),
              (None, 1, "assistant", "x")]
    table = spark.createDataFrame([(*t, 1) for t in turns],
                                  "conv_id bigint, turn bigint, role string, text string, part int")
    found = {r.conv_id: r for r in chat.read_back(chat.format_conversations(table)).collect()}
    by = {}
    for c, t, role, text in turns:
        by.setdefault(c, []).append((t is not None, t or 0, role or "", text or ""))
    for c, own in by.items():
        own.sort()
        loss = "".join(x[3] for x in own if x[2] == "assistant")
        assert found[c].n_turns == len(own)
        assert found[c].turns_sha256 == hashlib.sha256(
            "".join(f"{r}\n{t}\n" for _, _, r, t in own).encode()).hexdigest()
        assert (found[c].loss_chars, found[c].loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
    whole = chat.format_conversations(table.where("conv_id = 1")).orderBy("part").collect()
    assert sum(len(r.text) for r in whole) == found[1].formatted_chars
    assert chat.format_conversations(table.where("conv_id = 99")).count() == 0


# Personal data.

PLAIN = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(?:\.[0-9]+){3}",
         "card": r"[0-9](?:[\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(digits):
    return sum(sum(divmod(2 * int(d), 10)) if i % 2 else int(d) for i, d in enumerate(reversed(digits))) % 10 == 0


def brute_spans(text):
    out = []
    for kind, pattern in PLAIN.items():
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            good = {"email": True, "ip": all(int(p) <= 255 for p in m[0].split(".")) if kind == "ip" else True,
                    "card": 16 <= len(digits) <= 19 and luhn(digits), "phone": 8 <= len(digits) <= 15}[kind]
            if good:
                out.append((kind, m.start(), m.end(), m[0]))
    return out


def test_base_spans_are_brute_force(docs):
    rng = random.Random(6)
    parts = ["a.b+c@d-e.fr", "x@y", "@q.r_s@t.uv", "1.2.3.4", "256.1.1.1", "0001.0255.3.4.5", "4111 1111 1111 1111",
             "4111-1111-1111-1112", "+1 (743) 555-3824", "+49 30 123456", "+1", "é🎉", " ", "\n", ".", "7", "-", "aa"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(12))) for _ in range(300)]
    texts += ["a" * 200_000, "1" * 100_000, "1." * 50_000, "a@b.c " * 2000, "+1 " * 1000, "- " * 3000, ""]
    rows = [*enumerate(texts), (9001, None)]
    found = {r.doc_id: [(s.kind, s.start, s.end, s.text) for s in r.spans]
             for r in pii.find_pii(docs(*rows), pii.BASE).collect()}
    assert found == {i: brute_spans(t or "") for i, t in rows}


def test_added_spans_need_their_checksum_or_words_nearby(docs):
    rows = {1: "IBAN DE89 3704 0044 0532 0130 00.", 2: "IBAN DE89 3704 0044 0532 0130 01.",
            3: "my card 378282246310005 ok", 4: "number 378282246310005 ok", 5: "SSN: 078-05-1120", 6: "part 078-05-1120",
            7: "call me: 555-123-4567", 8: "lot 555-123-4567"}
    found = {r.doc_id: [s.kind for s in r.spans] for r in pii.find_pii(docs(*rows.items()), pii.ADDED).collect()}
    assert found == {1: ["iban"], 2: [], 3: ["short_card"], 4: [], 5: ["ssn"], 6: [], 7: ["local_phone"], 8: []}


def brute_near(text):
    """Spans of the added kinds that words nearby speak for."""
    out = []
    for kind in pii.ADDED:
        if kind.near:
            for m in re.finditer(kind.pattern, text):
                digits = re.sub("[^0-9]", "", m[0])
                good = {"short_card": 13 <= len(digits) <= 15 and luhn(digits), "local_phone": True,
                        "ssn": digits[:3] not in ("000", "666") and digits[0] != "9" and digits[3:5] != "00"
                        and digits[5:] != "0000"}[kind.name]
                near = text[max(0, m.start() - 48):m.start()] + " " + text[m.end():m.end() + 48]
                if good and kind.score + (kind.boost if re.search(kind.near, near.lower()) else 0) >= 0.5:
                    out.append((kind.name, m.start(), m.end(), m[0]))
    return out


def test_lists_of_numbers_are_brute_force(docs):
    rng = random.Random(8)
    parts = ["378282246310005", "371449635398431", "3782 822463 10005", "4222222222222", "378282246310006", "078-05-1120",
             "666-05-1120", "219-09-9999", "415-555-0100", "(415) 555-0101", "415.555.0102", "Phones: ", "tel", "cards",
             " SSN ", "tax id", "é🎉", " ", "\n", ", ", "; ", " and ", "x" * 20, "-"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(24))) for _ in range(600)]
    texts += ["Phones: 415-555-0100, 415-555-0101, 415-555-0102.", "cards 378282246310005, 371449635398431",
              "SSN 078-05-1120, 219-09-9999, 078-05-1121", "415-555-0100, 415-555-0101 are her phones",
              "phone" + " 415-555-0100" * 5000, "(415)555-0100" * 9 + "(415)-555-0100" * 9 + " call", ""]
    rows = [*enumerate(texts), (9001, None)]
    found = {r.doc_id: [(s.kind, s.start, s.end, s.text) for s in r.spans] for r in pii.find_pii(
        docs(*rows), tuple(k for k in pii.ADDED if k.near)).collect()}
    assert found == {i: brute_near(t or "") for i, t in rows}
    assert [len(found[i]) for i in range(600, 604)] == [3, 2, 3, 2]


def brute_ibans(text):
    lengths = {c: n for n, names in pii.IBAN_LENGTHS.items() for c in names.split()}
    out, end = [], 0
    for at in range(len(text)):
        n = lengths.get(text[at:at + 2])
        if n is None or at < end or (at and re.match("[A-Za-z0-9]", text[at - 1])):
            continue
        m = re.compile(r"[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){%d}(?![A-Za-z0-9])" % (n - 4)).match(text, at)
        plain = m[0].replace(" ", "") if m else ""
        if m and int("".join(str(int(c, 36)) for c in plain[4:] + plain[:4])) % 97 == 1:
            end = m.end()
            out.append(("iban", at, end, m[0]))
    return out


def test_account_numbers_are_brute_force(docs):
    rng = random.Random(9)
    good = ["DE89 3704 0044 0532 0130 00", "DE89370400440532013000", "GB82 WEST 1234 5698 7654 32", "NO9386011117947",
            "FR14 2004 1010 0505 0001 3M02 606", "MT84MALT011000012345MTLCAST001S", "AT61 1904 3002 3457 3201"]
    parts = good + ["AT12 3456", "ES91 2100 0418", "DE89 3704 0044 0532 0130 01", "BIC COBADEFF", "EUR 50", "IBAN", " ",
                    " ", " ", "\n", ", ", ".", "é🎉", "x", "7"]
    texts = ["".join(rng.choice(parts) + rng.choice(["", " "]) for _ in range(rng.randrange(12))) for _ in range(600)]
    texts += ["IBAN DE89 3704 0044 0532 0130 00 BIC COBADEFF", "DE89370400440532013000 EUR 50",
              "DE89 3704 0044 0532 0130 00 GB82 WEST 1234 5698 7654 32", "AT12 3456 GB82 WEST 1234 5698 7654 32",
              "DE89370400440532013000 " * 2000, "AT61" * 9, ""]
    # Two numbers that are both right and share characters: the one further left counts.
    inner = next(f"NO{k:02} 7947 {i:07}" for i in range(100) for k in range(100)
                 if brute_ibans(f"NO{k:02} 7947 {i:07}"))
    texts.append(next(x for k in range(100) if brute_ibans(x := f"BE{k:02} 0000 {inner}")[0][1] == 0))
    rows = [*enumerate(texts), (9001, None)]
    found = {r.doc_id: [(s.kind, s.start, s.end, s.text) for s in r.spans] for r in pii.find_pii(
        docs(*rows), tuple(k for k in pii.ADDED if k.name == "iban")).collect()}
    assert found == {i: brute_ibans(t or "") for i, t in rows}
    assert [len(found[i]) for i in range(600, 605)] == [1, 1, 2, 1, 2000]


def test_pii_of_empty_tables_and_rows_that_repeat(docs):
    assert pii.pii_digest(docs((1, "a")).where("doc_id = 2")).count() == 0
    row = pii.pii_digest(docs((None, "a@b.c"), (None, "a@b.c"))).collect()
    assert [(r.n_email, r.spans) for r in row] == [(1, "email:0:5")] * 2


# Toxicity.

@pytest.fixture(scope="module")
def marked():
    rng = random.Random(1)
    calm = ["river", "stone", "walk", "green", "paper", "window", "morning"]
    rude = ["idiotface", "scumlord", "trashcan"]
    rows = []
    for i in range(600):
        toxic = i % 5 == 0
        words = [rng.choice(calm) for _ in range(rng.randrange(5, 60))]
        if toxic:
            for _ in range(3):
                words.insert(rng.randrange(len(words)), rng.choice(rude))
        rows.append((i, " ".join(words), int(toxic)))
    return rows


def test_toxicity_on_held_out_rows(spark, docs, marked):
    table = docs(*[(i, t) for i, t, _ in marked], (None, None), (10_000, ""), (10_001, "scumlord you " * 50_000))
    labels = spark.createDataFrame([(i, y, 3) for i, _, y in marked] + [(None, 1, 3), (7, None, 3)],
                                   "doc_id bigint, toxic int, score int")
    found = {r.doc_id: r for r in toxicity.toxicity(table, labels).collect()}
    assert len(found) == len(marked) + 3
    import zlib
    held = [(found[i].predicted, y) for i, _, y in marked if zlib.crc32(str(i).encode()) % 4 == 2]
    assert all(found[i].held_out == (zlib.crc32(str(i).encode()) % 4 == 2) for i, _, _ in marked)
    assert sum(p == y for p, y in held) >= 0.97 * len(held)
    assert found[10_001].predicted == 1 and found[10_000].predicted == 0 and not found[None].held_out
    assert all(0 <= r.score <= 1 for r in found.values())
    kept = toxicity.without_toxic(table, labels)
    assert kept.columns == table.columns and kept.where("doc_id = 10001").isEmpty()


def test_scores_take_one_function_in_python(spark, docs, marked):
    """Each such function of a task has a worker of its own, which stays in memory for the stages after it."""
    table = docs(*[(i, t) for i, t, _ in marked])
    labels = spark.createDataFrame([(i, y) for i, _, y in marked], "doc_id bigint, toxic int")
    learned = toxicity.train(table, labels)
    scored = learned.scored(table)
    assert scored._jdf.queryExecution().optimizedPlan().toString().count("EvalPython") == 1
    raw = learned.trees.transform(table.select("doc_id", toxicity.feature_column(
        learned.lexicon, F.col("text")).alias("features"))).select("doc_id", toxicity._raw().alias("raw")).collect()
    steps = learned.calibration.boundaries.toArray(), learned.calibration.predictions.toArray()
    expected = dict(zip([r.doc_id for r in raw], np.interp([r.raw for r in raw], *steps).tolist()))
    assert {r.doc_id: r.score for r in scored.select("all.doc_id", "score").collect()} == pytest.approx(expected, abs=1e-12)


def test_toxic_words_are_counted_in_all_labelled_rows(spark, docs, marked):
    # Only the calm rows are many; each of 60 further words is in seven toxic rows, some of them outside any sample.
    rows = [(i, t, y) for i, t, y in marked if not y]
    rows += [(1000 + 7 * k + j, f"river stone zq{chr(97 + k // 26)}{chr(97 + k % 26)}", 1) for k in range(60) for j in range(7)]
    table = docs(*[(i, t) for i, t, _ in rows])
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id bigint, toxic int")
    import zlib
    per = Counter(t.split()[-1] for i, t, y in rows if y and zlib.crc32(str(i).encode()) % 4 != 2)
    learned = toxicity.train(table, labels, rows=100)
    assert learned.lexicon.words == {w for w, n in per.items() if n >= toxicity.LEAST} and len(learned.lexicon.words) > 15


def test_every_strong_term_is_kept(spark):
    texts = [(f"same {chr(97 + k // 676)}{chr(97 + k // 26 % 26)}{chr(97 + k % 26)}", 1) for k in range(1200)] * 6
    found = toxicity.learn_lexicon(spark.createDataFrame(texts + [("same", 0)] * 9000, "text string, toxic int"))
    assert found.words == {t.split()[1] for t, _ in texts}


def test_samples_are_drawn_per_kind_of_label(spark):
    usable = spark.range(100_000).selectExpr("id AS label_id", "int(id % 100 = 0) AS toxic")
    drawn = {r["toxic"]: r for r in toxicity._sample(usable, 2000).groupBy("toxic").agg(
        F.count("*").alias("n"), F.sum("weight").alias("weight")).collect()}
    assert 400 < drawn[1]["n"] < 600 and 1350 < drawn[0]["n"] < 1650
    assert 800 < drawn[1]["weight"] < 1200 and 89_000 < drawn[0]["weight"] < 109_000


def test_few_labels_of_a_kind_are_in_both_parts(spark, docs, marked):
    toxic = [(i, t, y) for i, t, y in marked if y]
    calm = [(i, t, y) for i, t, y in marked if not y]
    import zlib
    one = next(x for x in toxic if zlib.crc32(str(x[0]).encode()) % 4 != 2)
    for rows in (calm + [one], toxic):
        table = docs(*[(i, t) for i, t, _ in rows])
        labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id bigint, toxic int")
        learned = toxicity.train(table, labels)
        assert (learned.trees is None) == (rows is toxic)
    assert toxicity.without_toxic(table, labels).count() == len(toxic)  # only toxic labels: nothing to tell apart by


def test_toxicity_without_labels(spark, docs):
    labels = spark.createDataFrame([], "doc_id bigint, toxic int")
    assert [r.score for r in toxicity.toxicity(docs((1, "a"), (1, "a")), labels).collect()] == [0.0, 0.0]
    assert toxicity.toxicity(docs((1, "a")).where("doc_id = 2"), labels).count() == 0
