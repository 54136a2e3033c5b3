"""SQL expressions that read a change envelope. All are built-in functions; nothing runs in Python.

Expressions are built as SQL text: the decode has a few hundred of them, and one call per expression keeps the time to
build its plan short.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Operation codes. Every other code, a null one and a missing one mean INSERT.
OPERATIONS = {"c": "INSERT", "u": "UPDATE", "d": "DELETE", "r": "INSERT"}

# The day numbers of 0001-01-01 and 9999-12-31, and the bounds of a 32-bit integer.
FIRST_DAY, LAST_DAY = -719162, 2932896
INT_MIN, INT_MAX = -2147483648, 2147483647

ISO_DATE = r"^\\s*\\d{4}-\\d{1,2}-\\d{1,2}([ T].*)?\\s*$"
WHOLE_NUMBER = r"^\\s*[+-]?\\d+\\s*$"


def get(doc: str, path: str, kind: str) -> str:
    return f"try_variant_get({doc}, '{path}', '{kind}')"


def field(doc: str, name: str) -> str:
    """A field as VARIANT: SQL NULL where missing, a variant null where the JSON says null."""
    return get(doc, f"$.{name}", "variant")


def text_field(doc: str, name: str) -> str:
    """A field as text; numbers and booleans become their text, JSON null and missing become NULL."""
    return get(doc, f"$.{name}", "string")


def json_text(value: str) -> str:
    """The message as text, NULL where the bytes are not UTF-8."""
    return f"CASE WHEN is_valid_utf8(CAST({value} AS STRING)) THEN CAST({value} AS STRING) END"


def kind(doc: str) -> str:
    """BIGINT, DECIMAL(..), DOUBLE, STRING, BOOLEAN, VOID, OBJECT<..> or ARRAY<..>; NULL where missing."""
    return f"schema_of_variant({doc})"


def is_object(doc: str) -> str:
    return f"startswith({kind(doc)}, 'OBJECT')"


def is_nested(doc: str) -> str:
    return f"left({kind(doc)}, 5) IN ('OBJEC', 'ARRAY')"


def is_json_null(doc: str) -> str:
    return f"({doc} IS NOT NULL AND is_variant_null({doc}))"


def is_falsy(doc: str) -> str:
    """Present, but an empty or zero value: false, 0, an empty text or an empty array."""
    return f"coalesce({get(doc, '$', 'string')} IN ('false', '0', '0.0', '', '[]'), false)"


def operation(code: str) -> str:
    cases = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in OPERATIONS.items())
    return f"CASE {code} {cases} ELSE 'INSERT' END"


def whole_id(doc: str, doc_kind: str) -> str:
    """The id as BIGINT. Fractions round half away from zero; texts must be whole numbers; NULL if neither."""
    text = get(doc, "$", "string")
    return f"""CASE
        WHEN {doc_kind} = 'BIGINT' THEN {get(doc, '$', 'bigint')}
        WHEN startswith({doc_kind}, 'DECIMAL') OR {doc_kind} IN ('DOUBLE', 'FLOAT')
          THEN try_cast(round({get(doc, '$', 'double')}, 0) AS BIGINT)
        WHEN {doc_kind} = 'STRING' AND rlike({text}, '{WHOLE_NUMBER}') THEN try_cast(trim({text}) AS BIGINT) END"""


def days_to_date(days: str) -> str:
    """The date that many days after 1970-01-01; NULL outside years 1 to 9999."""
    return f"CASE WHEN {days} BETWEEN {FIRST_DAY} AND {LAST_DAY} THEN date_from_unix_date(CAST({days} AS INT)) END"


def normal_date(doc: str, doc_kind: str) -> str:
    """A date from a day number or an ISO text; NULL for anything else."""
    text = get(doc, "$", "string")
    return f"""CASE
        WHEN {doc_kind} = 'BIGINT' THEN {days_to_date(get(doc, '$', 'bigint'))}
        WHEN {doc_kind} = 'STRING' AND rlike({text}, '{ISO_DATE}') THEN try_cast(trim({text}) AS DATE)
        WHEN {doc_kind} = 'BOOLEAN' THEN {days_to_date(f"CAST({get(doc, '$', 'boolean')} AS INT)")} END"""


def fit_text(text: str, limit: int) -> str:
    """Text that is over the limit only by trailing spaces is cut to the limit."""
    return f"CASE WHEN length({text}) > {limit} THEN substring({text}, 1, {limit}) ELSE {text} END"


def envelope(op: Column, before: Column | None, after: Column | None) -> Column:
    """The bytes of a wrapped change envelope. Null fields are written as null, not left out."""
    nothing = F.lit(None).cast("string")
    payload = F.struct(
        op.alias("op"),
        (nothing if before is None else before).alias("before"),
        (nothing if after is None else after).alias("after"),
    )
    return F.to_json(F.struct(payload.alias("payload")), {"ignoreNullFields": "false"}).cast("binary")
