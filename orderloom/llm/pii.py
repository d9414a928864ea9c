"""Personal data: patterns propose spans, checksums confirm them, words nearby adjust their score.

All of it is string functions on the executors' JVM. The places of the matches come from splitting the text at the
pattern: pieces between matches and the matches themselves take turns, so their lengths add up to the offsets. No
pattern can be slow on long runs: repeats are possessive where nothing after them could use what they give back, and
a match starts at the start of a run or where the last match ended, as any other start would belong to a match
further left.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from orderloom.llm.common import whole_text

# Characters on each side of a span that are searched for words that speak for it.
NEAR = 48
# Spans with this score or more are reported.
THRESHOLD = 0.5
# No match of a kind that words speak for is shorter.
_SHORTEST = 10
_BLOCK = 256


def _runs(inside: str, rest: str) -> str:
    """``rest`` where a run of characters ``inside`` begins, or where the last match ended."""
    return rf"(?:\G|(?<![{inside}]))" + rest


@dataclass(frozen=True)
class Kind:
    """A kind of personal data. ``check`` of a match must hold; ``score`` alone has to reach the threshold, or with
    ``boost`` if ``near`` (lower case) is found beside the span. ``needs`` is a cheap test a text has to pass. With
    ``ahead`` the pattern takes up only the beginning of a match and has all of it as its first group, so that a match
    which fails its check hides none that begins inside it."""

    name: str
    pattern: str
    needs: str
    check: str | None = None
    score: float = 1.0
    near: str | None = None
    boost: float = 0.0
    ahead: bool = False


_LOCAL = r"A-Za-z0-9._%+-"
# The first four patterns are fixed values, written so that they are linear; the letters after them are choices.
BASE = (
    Kind("email", _runs(_LOCAL, rf"[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"), "@"),
    Kind("ip", _runs("0-9", r"[0-9]++(?:\.[0-9]++){3}"), r"[0-9]\.[0-9]", "ip"),
    Kind("card", _runs("0-9", r"[0-9](?:[\x20-]?[0-9])++"), "[0-9]", "card"),
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]", r"\+[0-9]", "phone"),
)
# How many characters the account numbers of a country have: those registered, and those in use without that.
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG",
    25: "AO CV GW LY MZ PT ST", 26: "DZ IR IS TR", 27: "BI CF CG CM DJ FR GA GQ GR IT KM MC MG MR SM TD",
    28: "AL AZ BF BJ BY CI CY DO GT HN HU LB MA ML NE NI PL SN SV TG", 29: "BR EG PS QA UA", 30: "JO KW MU YE",
    31: "MT SC", 32: "LC", 33: "RU"}
_IBAN = "|".join(rf"(?:{'|'.join(names.split())})[0-9]{{2}}(?:\x20?[A-Z0-9]){{{n - 4}}}" for n, names in IBAN_LENGTHS.items())
ADDED = (
    Kind("iban", rf"(?<![A-Za-z0-9])(?=((?:{_IBAN})(?![A-Za-z0-9])))[A-Z]{{2}}[0-9]{{2}}", "[A-Z]{2}[0-9]{2}",
         "iban", 0.9, ahead=True),
    Kind("short_card", r"(?<![0-9])[0-9](?:[\x20-]?[0-9]){12,14}(?![\x20-]?[0-9])", "[0-9]{2}", "short_card", 0.3,
         "card|visa|amex|credit|debit|karte|carte|tarjeta", 0.4),
    Kind("ssn", r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])", "[0-9]{3}-[0-9]{2}-", "ssn", 0.3,
         r"ssn|social\s+security|tax\s+id", 0.5),
    Kind("local_phone", r"(?<![+0-9.-])\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![0-9])",
         r"[0-9]{3}[\x20.-][0-9]{4}", None, 0.2, r"phone|tel\b|telefon|call|mobile|fax|móvil|portable", 0.4),
)


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Whether the check digit of a digit string is right: every second digit from the right counts double."""
    places = F.sequence(F.lit(1), F.length(digits))

    def part(i: Column) -> Column:
        digit = F.substring(F.reverse(digits), i, F.lit(1)).cast("int")
        twice = digit * 2
        return F.when(i % 2 == 1, digit).when(twice > 9, twice - 9).otherwise(twice)
    return F.aggregate(F.transform(places, part), F.lit(0), lambda a, b: a + b) % 10 == 0


def _mod97(value: Column) -> Column:
    """Whether an account number leaves 1 modulo 97, letters counting 10 to 35 and the first four characters last."""
    plain = F.regexp_replace(value, r"\x20", "")
    turned = F.concat(F.substring(plain, F.lit(5), F.length(plain)), F.substring(plain, 1, 4))
    codes = F.transform(F.split(turned, ""), lambda c: F.when(c.rlike("[0-9]"), F.ascii(c) - 48).otherwise(
        F.when(c == "", F.lit(0)).otherwise(F.ascii(c) - 55)))
    fold = F.aggregate(codes, F.lit(0), lambda a, n: F.when(n > 9, (a * 100 + n) % 97).otherwise((a * 10 + n) % 97))
    return F.length(plain).between(15, 34) & (fold == 1)


def _check(name: str | None, value: Column) -> Column:
    digits, n = _digits(value), F.length(_digits(value))
    if name == "ip":
        return F.forall(F.split(value, r"\."), lambda p: F.length(F.ltrim(p, F.lit("0"))).between(0, 2) | (
            (F.length(F.ltrim(p, F.lit("0"))) == 3) & (F.ltrim(p, F.lit("0")) <= "255")))
    if name == "card":
        return n.between(16, 19) & _luhn(digits)
    if name == "short_card":
        return n.between(13, 15) & _luhn(digits)
    if name == "phone":
        return n.between(8, 15)
    if name == "iban":
        return _mod97(value)
    if name == "ssn":
        return ~digits.rlike("^(000|666|9)|^...00|0000$")
    return F.lit(True)


def _starts(gaps: Column, found: Column) -> Column:
    """Where each match starts. Blocks of matches are summed first, so that long lists are not copied at each step."""
    lengths = F.zip_with(F.slice(gaps, F.lit(1), F.size(found)), found, lambda g, m: F.struct(
        F.length(g).alias("gap"), F.length(m).alias("own")))
    blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(found) - 1) / _BLOCK).cast("int")),
                         lambda b: F.slice(lengths, b * _BLOCK + 1, F.lit(_BLOCK)))

    def running(parts: Column, first: Column) -> Column:
        """(start of each part, end of the last)"""
        return F.aggregate(parts, F.struct(F.array().cast("array<int>").alias("at"), first.alias("end")),
                           lambda acc, p: F.struct(F.concat(acc["at"], F.array(acc["end"] + p["gap"])).alias("at"),
                                                   (acc["end"] + p["gap"] + p["own"]).alias("end")))
    sums = F.transform(blocks, lambda b: F.struct(F.lit(0).alias("gap"), F.aggregate(
        b, F.lit(0), lambda a, p: a + p["gap"] + p["own"]).alias("own")))
    firsts = running(sums, F.lit(0))["at"]
    return F.flatten(F.zip_with(blocks, firsts, lambda b, first: running(b, first)["at"]))


def _around(gaps: Column, found: Column) -> Column:
    """For each match the NEAR characters of the text before it and after it, other matches included, with a space
    between. They are put together from the few pieces that can lie so near, so that no step goes through the text."""
    reach = -(-NEAR // _SHORTEST)
    pieces = F.array(F.struct(
        found.alias("found"), F.transform(gaps, lambda g: F.right(g, F.lit(NEAR))).alias("ends"),
        F.transform(gaps, lambda g: F.left(g, F.lit(NEAR))).alias("begins")))

    def joined(one: Column, two: Column) -> Column:
        return F.array_join(F.zip_with(one, two, lambda a, b: F.concat(a, b)), "")

    def beside(p: Column, i: Column) -> Column:
        first, after = F.greatest(i - reach, F.lit(0)), F.least(F.size(p["found"]) - 1 - i, F.lit(reach))
        before = F.concat(joined(F.slice(p["ends"], first + 1, i - first), F.slice(p["found"], first + 1, i - first)),
                          F.element_at(p["ends"], i + 1))
        behind = F.concat(F.element_at(p["begins"], i + 2),
                          joined(F.slice(p["found"], i + 2, after), F.slice(p["begins"], i + 3, after)))
        return F.concat_ws(" ", F.right(before, F.lit(NEAR)), F.left(behind, F.lit(NEAR)))
    return F.transform(pieces, lambda p: F.transform(p["found"], lambda _, i: beside(p, i)))[0]


def _apart(spans: Column) -> Column:
    """The leftmost of ``spans`` that do not overlap. They rarely do, so lists are mostly left as they are."""
    ends = F.transform(spans, lambda s: s["end"])
    mixed = F.exists(F.zip_with(F.slice(spans, F.lit(2), F.size(spans)), ends, lambda s, end: s["start"] < end), lambda x: x)
    chosen = F.aggregate(spans, F.slice(spans, 1, 0), lambda kept, s: F.when(
        F.coalesce(F.try_element_at(kept, F.lit(-1))["end"] > s["start"], F.lit(False)), kept).otherwise(
        F.concat(kept, F.array(s))))
    return F.when(mixed, chosen).otherwise(spans)


def kind_spans(text: Column, kind: Kind) -> Column:
    """The spans of one kind in order: array of (kind, start, end, text, score); offsets are code points."""
    pattern = F.lit(kind.pattern)
    found = F.regexp_extract_all(text, pattern, F.lit(0))
    gaps = F.split(text, pattern, -1)
    none = F.array().cast("array<struct<kind:string,start:int,end:int,text:string,score:double>>")
    whole = F.regexp_extract_all(text, pattern, F.lit(1)) if kind.ahead else found
    columns = [whole.alias("m"), _starts(gaps, found).alias("at")]
    if kind.near is not None:
        columns.append(_around(gaps, found).alias("around"))

    def score(z: Column) -> Column:
        base = F.lit(kind.score)
        if kind.near is None:
            return base
        return base + F.when(F.lower(z["around"]).rlike(kind.near), kind.boost).otherwise(0.0)
    # Each match with its offsets and score, kept if it passes.
    spans = F.transform(F.arrays_zip(*columns), lambda z: F.struct(
        F.lit(kind.name).alias("kind"), z["at"].alias("start"), (z["at"] + F.length(z["m"])).alias("end"),
        z["m"].alias("text"), score(z).alias("score")))
    spans = F.filter(spans, lambda s: (s["score"] >= THRESHOLD) & _check(kind.check, s["text"]))
    if kind.ahead:
        spans = F.transform(F.array(spans), _apart)[0]
    return F.when(text.rlike(kind.needs) & (F.size(found) > 0), spans).otherwise(none)


def find_pii(docs: DataFrame, kinds: tuple[Kind, ...] = BASE + ADDED) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id and spans, ordered by kind as listed, then start.

    Matches of a kind are the leftmost ones that do not overlap; matches of different kinds may. A match that fails
    its check is dropped, and its characters are not tried again, except for account numbers. A null text counts as empty and has no spans; a
    text of any length is searched as a whole. Rows that repeat give rows that repeat; an empty table gives none;
    other columns are not looked at.
    """
    rows = docs.select("doc_id", whole_text().alias("text"))
    return rows.select("doc_id", F.concat(*[kind_spans(F.col("text"), k) for k in kinds]).alias("spans"))


def _joined(spans: Column) -> Column:
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))


def pii_digest(docs: DataFrame) -> DataFrame:
    """Counts of the base kinds, a digest of their spans, and all spans."""
    names = [k.name for k in BASE]
    found = find_pii(docs)

    def count(name: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == name)).cast("bigint")
    return found.select(
        "doc_id", *[count(n).alias(f"n_{n}") for n in names],
        F.sha2(_joined(F.filter("spans", lambda s: s["kind"].isin(names))), 256).alias("base_sha256"),
        _joined(F.col("spans")).alias("spans"))


def _oracle() -> str:
    """The same in SQL, with the patterns of the base kinds as they are given. RE2 has no look-around, which the added
    kinds need; the test tables hold none of them, and they are tested by brute force instead."""
    luhn = ("list_sum(list_transform(range(1, length(d) + 1), lambda i: CASE WHEN (length(d) - i) % 2 = 0 "
            "THEN d[i]::INT WHEN d[i]::INT > 4 THEN 2 * d[i]::INT - 9 ELSE 2 * d[i]::INT END)) % 10 = 0")
    plain = {
        "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+", "true"),
        "ip": (r"[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+",
               "list_max(list_transform(string_split(m, '.'), lambda p: length(ltrim(p, '0')))) <= 3 AND "
               "list_max(list_transform(string_split(m, '.'), lambda p: right('000' || p, 3)::INT)) <= 255"),
        "card": (r"[0-9](?:[ -]?[0-9])+", f"length(d) BETWEEN 16 AND 19 AND {luhn}"),
        "phone": (r"\+[0-9][ ().0-9-]+[0-9]", "length(d) BETWEEN 8 AND 15"),
    }
    parts = []
    for place, (kind, (pattern, check)) in enumerate(plain.items()):
        parts.append(f"""
    SELECT doc_id, {place} AS place, '{kind}' AS kind, s, s + length(m) AS e, m FROM (
        SELECT doc_id, unnest(ms) AS m, unnest(list_transform(range(1, len(ms) + 1), lambda i:
               list_sum(list_transform(gaps[1:i], lambda g: length(g)))
               + coalesce(list_sum(list_transform(ms[1:i - 1], lambda x: length(x))), 0)))::BIGINT AS s
        FROM (SELECT doc_id, regexp_extract_all(t, '{pattern}') AS ms,
                     string_split_regex(t, '{pattern}') AS gaps FROM texts) WHERE len(ms) > 0)
    WHERE (SELECT {check} FROM (SELECT regexp_replace(m, '[^0-9]', '', 'g') AS d))""")
    return "WITH texts AS (SELECT doc_id, coalesce(text, '') AS t FROM documents), found AS (" + (
        "\n    UNION ALL".join(parts)) + """),
listed AS (SELECT doc_id, count(*) FILTER (WHERE kind = 'email') AS n_email, count(*) FILTER (WHERE kind = 'ip') AS n_ip,
    count(*) FILTER (WHERE kind = 'card') AS n_card, count(*) FILTER (WHERE kind = 'phone') AS n_phone,
    string_agg(kind || ':' || s || ':' || e, ',' ORDER BY place, s) AS spans FROM found GROUP BY doc_id)
SELECT t.doc_id, coalesce(n_email, 0) AS n_email, coalesce(n_ip, 0) AS n_ip, coalesce(n_card, 0) AS n_card,
       coalesce(n_phone, 0) AS n_phone, sha256(coalesce(spans, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM texts t LEFT JOIN listed l ON l.doc_id = t.doc_id
"""


ORACLE = _oracle()
