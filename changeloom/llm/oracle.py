"""The registered queries of this package as DuckDB SQL, where SQL can express them."""

from __future__ import annotations

from changeloom.llm import pii
from changeloom.llm.tables import SPACE, WORD

EXACT = f"""
WITH plain AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '{SPACE}', ' ', 'g') AS plain FROM documents),
grouped AS (SELECT plain, min(doc_id) AS keep_id, count(*) AS group_size FROM plain GROUP BY plain)
SELECT doc_id, keep_id, group_size, doc_id IS NOT DISTINCT FROM keep_id AS kept, sha256(plain) AS text_sha256
FROM plain JOIN grouped USING (plain)
"""


def mixing(documents: str = "documents") -> str:
    return f"""
WITH sized AS (
    SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{WORD}'))::BIGINT AS size,
        md5(concat_ws(':', 'mix', doc_id::VARCHAR)) AS shuffled
    FROM {documents}),
sources AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
ranked AS (
    SELECT *, row_number() OVER (ORDER BY source NULLS LAST) AS rank, (rank - 1) % 3 + 1 AS weight FROM sources),
filled AS (
    SELECT *, sum(source_size) OVER w AS sizes, sum(weight) OVER w AS weights FROM ranked
    WINDOW w AS (ORDER BY source_size / weight, rank)),
whole AS (SELECT max(sizes)::BIGINT AS budget, max(weights) AS all_weights FROM filled),
levels AS (
    SELECT max((budget - 3 * (sizes - source_size))::DOUBLE / (all_weights - weights + weight)::DOUBLE) AS level,
        max(budget) AS budget FROM filled, whole),
shares AS (
    SELECT source, rank, weight, source_size, least((3 * source_size)::DOUBLE, level * weight) AS target, budget
    FROM ranked, levels),
queued AS (
    SELECT doc_id, size, rank, weight, source_size, target, budget, shuffled, row_number() OVER (ORDER BY rank, shuffled, doc_id, size) AS place,
        sum(size) OVER (PARTITION BY rank ORDER BY shuffled, doc_id, size ROWS UNBOUNDED PRECEDING) AS reached
    FROM sized JOIN shares ON sized.source IS NOT DISTINCT FROM shares.source),
copies AS (
    SELECT *, (round * source_size + reached)::DOUBLE / weight AS finish
    FROM queued, (SELECT unnest([0, 1, 2]) AS round) WHERE size > 0),
used AS (SELECT *, sum(size) OVER (ORDER BY finish, rank, round, reached ROWS UNBOUNDED PRECEDING) AS used FROM copies),
taken AS (SELECT place, sum(CASE WHEN used <= budget THEN size ELSE 0 END)::BIGINT AS taken FROM used GROUP BY place)
SELECT doc_id, size, source_size, target, coalesce(taken, 0)::BIGINT AS taken
FROM queued LEFT JOIN taken USING (place)
"""


def _plain_spans(kind: str, order: int) -> str:
    """The spans of one kind as a list of structs; the same patterns without what the other engine needs for speed."""
    pattern = {
        "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
        "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "card": r"[0-9]([\x20-]?[0-9])+",
    }.get(kind, pii.PATTERNS[kind])
    digits = "regexp_replace(v, '[^0-9]', '', 'g')"
    digit = f"substr(reverse({digits}), i::INT, 1)::INT"
    luhn = (f"(length({digits}) BETWEEN 12 AND 19 AND list_sum([CASE WHEN i % 2 = 1 THEN {digit} WHEN {digit} > 4 "
            f"THEN 2 * {digit} - 9 ELSE 2 * {digit} END FOR i IN range(1, length({digits}) + 1)]) % 10 = 0)")
    moved = "(substr(replace(v, ' ', ''), 5) || substr(v, 1, 4))"
    number = (f"list_reduce(list_prepend(0, [ascii(substr({moved}, i::INT, 1)) FOR i IN range(1, length({moved}) + 1)]),"
              f" lambda s, k: CASE WHEN k < 58 THEN (s * 10 + k - 48) % 97 ELSE (s * 100 + k - 55) % 97 END)")
    confirmed = {
        "ip": "list_bool_and([coalesce(try_cast(x AS INT) <= 255, false) FOR x IN string_split(v, '.')])",
        "card": luhn,
        "phone": f"length({digits}) BETWEEN 9 AND 15",
        "iban": f"({number}) = 1",
        "local_phone": f"length({digits}) = 10",
    }.get(kind, "true")
    around = f"lower(right(b, {pii.CONTEXT}) || ' ' || left(e, {pii.CONTEXT}))"
    score = (f"({pii.SCORES[kind]}::DOUBLE + CASE WHEN regexp_matches({around}, '{pii.NEAR[kind]}') THEN 0.3::DOUBLE ELSE 0 END"
             f" - CASE WHEN regexp_matches({around}, '{pii.AGAINST[kind]}') THEN 0.2::DOUBLE ELSE 0 END)")
    apart = "true"
    if kind in pii.ADDED:
        apart = (f"NOT regexp_matches(right(b, 1), '[A-Za-z0-9-]') AND NOT regexp_matches(left(e, 1), '[A-Za-z0-9-]')"
                 f" AND round({score}, 3) >= {pii.MIN_SCORE}")
    return f"""
    SELECT row, place AS start, {order} AS kind_order, place + length(v) AS finish, '{kind}' AS kind
    FROM (
        SELECT row, pieces[i] AS b, matches[i] AS v, pieces[i + 1] AS e,
            list_sum([length(x) FOR x IN pieces[1:i]])::BIGINT
                + coalesce(list_sum([length(x) FOR x IN matches[1:i - 1]]), 0)::BIGINT AS place
        FROM (
            SELECT *, unnest(range(1, len(matches) + 1)) AS i
            FROM (SELECT row, regexp_extract_all(text, '{pattern}') AS matches,
                      string_split_regex(text, '{pattern}') AS pieces FROM texts)))
    WHERE {confirmed} AND {apart}"""


PII = f"""
WITH texts AS (SELECT row_number() OVER () AS row, doc_id, coalesce(text, '') AS text FROM documents),
base AS ({' UNION ALL '.join(_plain_spans(kind, order) for order, kind in enumerate(pii.BASE))}),
more AS ({' UNION ALL '.join(_plain_spans(kind, order) for order, kind in enumerate(pii.ADDED, len(pii.BASE)))}),
spans AS (
    SELECT * FROM base
    UNION ALL SELECT * FROM more WHERE NOT EXISTS (
        SELECT 1 FROM base WHERE base.row = more.row AND base.start < more.finish AND more.start < base.finish)),
listed AS (
    SELECT row, {', '.join(f"count(*) FILTER (kind = '{kind}') AS n_{kind}" for kind in pii.BASE)},
        string_agg(concat(kind, ':', start, ':', finish), ',' ORDER BY start, kind_order)
            FILTER (kind_order < {len(pii.BASE)}) AS base_spans,
        string_agg(concat(kind, ':', start, ':', finish), ',' ORDER BY start, kind_order) AS spans
    FROM spans GROUP BY row)
SELECT doc_id, {', '.join(f"coalesce(n_{kind}, 0)::BIGINT AS n_{kind}" for kind in pii.BASE)},
    sha256(coalesce(base_spans, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM texts LEFT JOIN listed USING (row)
"""

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def contamination(documents: str = "documents") -> str:
    def words(text: str) -> str:
        return f"regexp_extract_all(translate(coalesce({text}, ''), '{UPPER}', '{LOWER}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"

    return f"""
WITH texts AS (SELECT row_number() OVER () AS row, doc_id, {words('text')} AS words FROM {documents}),
items AS (SELECT item_id, {words('text')} AS words FROM benchmark),
windows AS (
    SELECT DISTINCT item_id, words[i:i + 9] AS run
    FROM (SELECT *, unnest(range(1, greatest(len(words) - 9, 1) + 1)) AS i FROM items WHERE len(words) > 0)),
lengths AS (SELECT DISTINCT len(run) AS length FROM windows),
runs AS (
    SELECT row, i, length, words[i:i + length - 1] AS run
    FROM (SELECT row, words, length, unnest(range(1, len(words) - length + 2)) AS i FROM texts, lengths)),
found AS (SELECT row, i, length, item_id FROM runs JOIN windows USING (run)),
hit AS (
    SELECT row, count(DISTINCT word) AS n_hit
    FROM (SELECT row, unnest(range(i, i + length)) AS word FROM (SELECT DISTINCT row, i, length FROM found)) GROUP BY row),
listed AS (
    SELECT row, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
    FROM (SELECT DISTINCT row, item_id::VARCHAR AS item FROM found WHERE item_id IS NOT NULL) GROUP BY row)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
    sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM texts LEFT JOIN hit USING (row) LEFT JOIN listed USING (row)
"""


COLLOCATIONS = r"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
    FROM documents),
cut AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
phrases AS (
    SELECT lang, k, unnest([array_to_string(w[i : i + k - 1], ' ') FOR i IN range(1, len(w) - k + 2)]) AS phrase
    FROM cut, (VALUES (1), (2), (3), (4)) AS sizes(k) WHERE len(w) >= k),
counts AS (SELECT lang, k, phrase, count(*) AS f FROM phrases GROUP BY ALL),
totals AS (SELECT lang, sum(f)::BIGINT AS n FROM counts WHERE k = 1 GROUP BY lang),
often AS (SELECT *, string_split(phrase, ' ') AS w FROM counts WHERE f >= 30),
cuts AS (
    SELECT c.lang, c.phrase, c.f AS a, j, x.f AS l, y.f AS r, ((2000000::HUGEINT * c.f) // (x.f + y.f))::BIGINT AS score
    FROM (SELECT *, unnest(range(1, k)) AS j FROM often WHERE k > 1) AS c
    JOIN often AS x ON x.lang = c.lang AND x.phrase = array_to_string(c.w[1 : j], ' ')
    JOIN often AS y ON y.lang = c.lang AND y.phrase = array_to_string(c.w[j + 1 : c.k], ' ')),
best AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1),
inside AS (
    SELECT lang, f, array_to_string(w[i : i + s - 1], ' ') AS phrase
    FROM (SELECT lang, f, w, s, unnest(range(1, k - s + 2)) AS i FROM (SELECT *, unnest(range(2, k)) AS s FROM often WHERE k > 2))),
covered AS (SELECT lang, phrase, max(f) AS f FROM inside GROUP BY ALL),
listed AS (
    SELECT best.* FROM best LEFT JOIN covered USING (lang, phrase) WHERE covered.f IS NULL OR 100 * covered.f < 80 * best.a
    QUALIFY row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) <= 2000)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM listed JOIN totals USING (lang)
"""

ORACLE: dict[str, str] = {
    "op3_mix_sources": mixing(),
    "op8_decontaminate": contamination(),
    "op6_exact_dedup": EXACT,
    "op10_personal_data": PII,
    "op11_collocations": COLLOCATIONS,
}
