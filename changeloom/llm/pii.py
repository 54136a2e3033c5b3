"""Personal data: patterns propose spans, checksums confirm them, nearby context words adjust their score.

Everything is Spark SQL over one row at a time. The places of the matches of a pattern come from its matches and from the
pieces between them, whose lengths add up.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The kinds in the order of the report; the first four are always reported, the others above a score.
BASE = ("email", "ip", "card", "phone")
ADDED = ("iban", "ssn", "local_phone")

#: The patterns. The base ones match what their plain forms in the oracle do, with possessive loops and fixed places to
#: start from, so that Java's engine neither recurses nor tries a long run again from each of its places.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9]){11,}+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "iban": r"[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?",
    "ssn": r"[0-9]{3}-[0-9]{2}-[0-9]{4}",
    "local_phone": r"\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}",
}

#: The score of a confirmed span without context, and words that raise or lower it when they stand near.
SCORES = {"email": 0.9, "ip": 0.6, "card": 0.8, "phone": 0.7, "iban": 0.9, "ssn": 0.3, "local_phone": 0.3}
NEAR = {
    "email": "mail|contact|write|address",
    "ip": "ip|host|server|address|login",
    "card": "card|visa|credit|debit|payment|account",
    "phone": "phone|tel|call|mobile|fax|contact",
    "iban": "iban|bank|account|transfer",
    "ssn": "ssn|social|security|insurance",
    "local_phone": "phone|tel|call|mobile|fax|contact",
}
AGAINST = {
    "email": "example|test",
    "ip": "version|release|section|chapter",
    "card": "order|serial|isbn|tracking",
    "phone": "order|serial|invoice",
    "iban": "order|serial|part",
    "ssn": "order|serial|part",
    "local_phone": "order|serial|invoice",
}
CONTEXT = 40
MIN_SCORE = 0.5
#: Matches that are folded together.
BLOCK = 256
SPANS = "array<struct<start:int,`order`:int,end:int,kind:string,score:double>>"


def _digits(value: str) -> str:
    return f"regexp_replace({value}, '[^0-9]', '')"


def _luhn(value: str) -> str:
    """Every second digit from the right counts twice, with 9 taken off where that has two digits; the sum ends in 0."""
    digit = "cast(substring(reverse(c), i, 1) AS int)"
    step = f"s + CASE WHEN i % 2 = 1 THEN {digit} WHEN {digit} > 4 THEN 2 * {digit} - 9 ELSE 2 * {digit} END"
    total = f"aggregate(sequence(1, length(c)), 0, (s, i) -> {step})"
    return f"exists(array({_digits(value)}), c -> length(c) BETWEEN 12 AND 19 AND {total} % 10 = 0)"


def _mod97(value: str) -> str:
    """The first four characters moved to the end, letters read as 10 to 35: the number leaves 1 when divided by 97."""
    code = "ascii(substring(c, i, 1))"
    step = f"CASE WHEN {code} < 58 THEN (s * 10 + {code} - 48) % 97 ELSE (s * 100 + {code} - 55) % 97 END"
    moved = f"concat(substring(replace({value}, ' ', ''), 5), substring({value}, 1, 4))"
    return f"exists(array({moved}), c -> aggregate(sequence(1, length(c)), 0, (s, i) -> {step}) = 1)"


def _confirmed(kind: str, value: str) -> str:
    return {
        "ip": f"forall(split({value}, '[.]'), p -> coalesce(try_cast(p AS int) <= 255, false))",
        "card": _luhn(value),
        "phone": f"length({_digits(value)}) BETWEEN 9 AND 15",
        "iban": _mod97(value),
        "local_phone": f"length({_digits(value)}) = 10",
    }.get(kind, "true")


def _score(kind: str, before: str, after: str) -> str:
    around = f"lower(concat(right({before}, {CONTEXT}), ' ', left({after}, {CONTEXT})))"
    return (f"{SCORES[kind]}D + CASE WHEN {around} RLIKE '{NEAR[kind]}' THEN 0.3D ELSE 0D END"
            f" - CASE WHEN {around} RLIKE '{AGAINST[kind]}' THEN 0.2D ELSE 0D END")


def _spans(kind: str, order: int) -> Column:
    """array<struct<start, order, end, kind, score>> of one kind, in order of their places (code points, end exclusive)."""
    pattern = PATTERNS[kind].replace("\\", "\\\\")
    # of each match x: `0` is the piece before it, `1` its text, `2` the piece after it
    matches = f"arrays_zip(slice(p, 1, size(p) - 1), regexp_extract_all(text, '{pattern}', 0), slice(p, 2, size(p)))"
    start = "a.at + length(x.`0`)"
    end = f"{start} + length(x.`1`)"
    score = f"round(least(1D, greatest(0D, {_score(kind, 'x.`0`', 'x.`2`')})), 3)"
    accept = _confirmed(kind, "x.`1`")
    if kind in ADDED:
        apart = "NOT right(x.`0`, 1) RLIKE '[A-Za-z0-9-]' AND NOT left(x.`2`, 1) RLIKE '[A-Za-z0-9-]'"
        accept = f"{accept} AND {apart} AND {score} >= {MIN_SCORE}D"
    span = f"named_struct('start', {start}, 'order', {order}, 'end', {end}, 'kind', '{kind}', 'score', {score})"
    none = f"cast(array() AS {SPANS})"
    # The fold carries the place where the last match ended. It runs over blocks of matches, since adding to an array
    # copies it: a block's array stays short, and the outer one holds blocks. A transform over a one-element array
    # names a value, so that it is computed once.
    state = f"named_struct('at', {end}, 'out', CASE WHEN {accept} THEN concat(a.out, array({span})) ELSE a.out END)"
    block = f"aggregate(slice(z, k * {BLOCK} + 1, {BLOCK}), named_struct('at', s.at, 'out', {none}), (a, x) -> {state})"
    step = f"get(transform(array({block}), r -> named_struct('at', r.at, 'out', concat(s.out, array(r.out)))), 0)"
    folded = f"""aggregate(sequence(0, cast((size(z) - 1) div {BLOCK} AS int)),
        named_struct('at', 0, 'out', cast(array() AS array<{SPANS}>)), (s, k) -> {step}, s -> flatten(s.out))"""
    split = f"get(transform(array(split(text, '{pattern}', -1)), p -> {matches}), 0)"
    once = f"get(transform(array({split}), z -> {folded}), 0)"
    return F.expr(f"CASE WHEN text RLIKE '{pattern}' THEN {once} ELSE {none} END")


def find(docs: DataFrame) -> DataFrame:
    """doc_id and `spans`: array<struct<start, order, end, kind, score>> by start, then kind; one row per row of `docs`.

    Base kinds are reported when they are confirmed, whatever their score; added kinds only when they are confirmed,
    stand apart from other letters and digits, reach MIN_SCORE with their context, and overlap no base span. A null or
    empty text has an empty array. Null ids, repeated rows and other columns change nothing; an empty table gives an
    empty result. Nothing is shuffled.
    """
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    kinds = {kind: _spans(kind, order) for order, kind in enumerate(BASE + ADDED)}
    found = texts.select("doc_id", *(spans.alias(kind) for kind, spans in kinds.items()))
    grouped = found.select("doc_id", F.concat(*BASE).alias("base"), F.concat(*ADDED).alias("added"))
    clear = "filter(added, x -> NOT exists(base, b -> b.start < x.end AND x.start < b.end))"
    return grouped.select("doc_id", F.expr(f"array_sort(concat(base, {clear}))").alias("spans"))


def _joined(spans: str) -> str:
    return f"array_join(transform({spans}, x -> concat(x.kind, ':', x.start, ':', x.end)), ',')"


def report(found: DataFrame) -> DataFrame:
    """doc_id, the number of spans of each base kind, the digest of the base spans, and all spans as text."""
    base = f"filter(spans, x -> x.order < {len(BASE)})"
    counts = (F.expr(f"cast(size(filter(spans, x -> x.kind = '{kind}')) AS bigint)").alias(f"n_{kind}") for kind in BASE)
    return found.select(
        "doc_id", *counts, F.expr(f"sha2({_joined(base)}, 256)").alias("base_sha256"), F.expr(_joined("spans")).alias("spans"))
