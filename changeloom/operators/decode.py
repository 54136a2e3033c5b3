"""Decode raw change messages into staging rows, dead letters and dropped messages.

Every message gets exactly one outcome, decided in this order: a null value is dropped; a value that is not JSON is a
dead letter; an unknown topic is dropped; an envelope or row that the staging table would refuse is a dead letter;
anything else is staged. The whole decode is one projection: no shuffle (the tenant lookup is a broadcast of the inline
dimension) and no Python.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changeloom import schemas
from changeloom.functions import envelope as E

STAGED, DEAD_LETTER, DROPPED = "staged", "dead_letter", "dropped"

STAGING_COLUMNS = [f.name for f in schemas.STAGING]
DEAD_LETTER_COLUMNS = [f.name for f in schemas.DEAD_LETTERS]


def _text_problem(image: str) -> str:
    """The first text column that the table would refuse.

    Almost all rows pass one cheap test of all texts together; only the others are looked at column by column. This
    also keeps the generated method small enough for the JIT.
    """
    limit = schemas.TEXT_LIMIT
    joined = f"concat_ws('', {', '.join(schemas.TEXT_COLUMNS)})"
    texts = ", ".join(
        f"named_struct('name', '{c}', 'text', {c}, 'doc', {E.field(image, c)})" for c in schemas.TEXT_COLUMNS
    )
    problem = f"""CASE
        WHEN left(x.text, 1) IN ('{{', '[') AND {E.is_nested('x.doc')} THEN concat('TEXT_NOT_SCALAR: ', x.name)
        WHEN rlike(x.text, '\\\\x00') THEN concat('TEXT_HAS_NUL: ', x.name)
        WHEN length(rtrim(x.text)) > {limit} THEN concat('TEXT_TOO_LONG: ', x.name) END"""
    return f"""CASE WHEN length({joined}) > {limit} OR rlike({joined}, '[\\\\x00{{\\\\[]')
        THEN get(array_compact(transform(array({texts}), x -> {problem})), 0) END"""


def parse(changes: DataFrame, dimension: DataFrame, delete_mode: str = "dead_letter") -> DataFrame:
    """Parse the envelope: adds tenant_id, doc, payload, operation and the row image, all but the columns of the row.

    With `delete_mode="apply"` the image of a DELETE is the `before` image, so that its key can be staged.
    """
    if delete_mode not in ("dead_letter", "apply"):
        raise ValueError(f"unknown delete_mode: {delete_mode}")
    image = "after"
    if delete_mode == "apply":
        deleted = "op = 'd' AND before IS NOT NULL AND NOT is_variant_null(before)"
        image = f"CASE WHEN {deleted} THEN before ELSE after END"
    return (
        changes.join(dimension.select("topic", "tenant_id"), "topic", "left")
        .selectExpr("*", f"try_parse_json({E.json_text('value')}) AS doc")
        .selectExpr("*", f"{E.field('doc', 'payload')} AS inner_doc")
        .selectExpr("*", "coalesce(inner_doc, doc) AS payload")
        .selectExpr(
            "*",
            f"{E.text_field('payload', 'op')} AS op",
            f"{E.field('payload', 'before')} AS before",
            f"{E.field('payload', 'after')} AS after",
        )
        .selectExpr("*", f"{E.operation('op')} AS operation", f"{image} AS image")
    )


def _envelope_problem() -> str:
    """The first reason why the envelope holds no row; NULL where it holds one, or holds no `after` at all.

    A path only resolves inside an object, so a field that is found proves its parent to be an object. The type of a
    whole document is looked at only where nothing was found.
    """
    return f"""CASE
        WHEN inner_doc IS NULL AND after IS NULL AND op IS NULL AND NOT {E.is_object('doc')}
          THEN 'NOT_AN_OBJECT: message'
        WHEN after IS NULL AND op IS NULL AND before IS NULL AND NOT {E.is_object('payload')}
          THEN 'NOT_AN_OBJECT: payload'
        WHEN left(op, 1) IN ('{{', '[') AND {E.is_nested(E.field('payload', 'op'))} THEN 'OP_NOT_SCALAR: op'
        WHEN {E.is_json_null('image')} THEN
          CASE WHEN operation = 'DELETE' THEN 'DELETE_WITHOUT_ROW: after is null' ELSE 'ROW_IS_NULL: after is null' END
        WHEN image IS NOT NULL AND id_value IS NULL AND NOT {E.is_object('image')} THEN 'ROW_NOT_OBJECT: after' END"""


ID_PROBLEM = f"""CASE
    WHEN id_kind IS NULL OR id_kind = 'VOID' THEN 'ID_MISSING: id'
    WHEN id_number IS NULL THEN 'ID_NOT_INTEGER: id'
    WHEN id_number NOT BETWEEN {E.INT_MIN} AND {E.INT_MAX} THEN 'ID_OUT_OF_RANGE: id' END"""

DATE_PROBLEM = """CASE WHEN date_kind IS NOT NULL AND date_kind <> 'VOID' AND date_of_birth IS NULL
    THEN 'DATE_INVALID: date_of_birth' END"""

OUTCOME = f"""CASE WHEN reason IS NULL THEN '{STAGED}'
    WHEN reason IN ('NULL_VALUE', 'UNKNOWN_TOPIC') THEN '{DROPPED}' ELSE '{DEAD_LETTER}' END"""

# The message was understood well enough to be announced, whether or not its row is accepted afterwards.
RECEIVED = f"""reason IS NULL OR (
    reason NOT IN ('NULL_VALUE', 'NOT_UTF8', 'NOT_JSON', 'UNKNOWN_TOPIC', 'NOT_AN_OBJECT', 'OP_NOT_SCALAR')
    AND (image IS NULL OR is_variant_null(image) OR id_value IS NOT NULL OR {E.is_object('image')}
      OR {E.is_falsy('image')}))"""


def decode(changes: DataFrame, dimension: DataFrame, delete_mode: str = "dead_letter",
           staged_at: datetime | None = None) -> DataFrame:
    """Decode each message to one row: its outcome, the reason where it is not staged, and the staging columns.

    `created_at` is the time of staging, a parameter; without one, it is the time of the message, as `message_time` is.
    """
    created_at = "timestamp" if staged_at is None else f"TIMESTAMP_NTZ '{staged_at.isoformat(sep=' ')}'"
    problem = f"""CASE
        WHEN value IS NULL THEN 'NULL_VALUE: no message'
        WHEN doc IS NULL AND NOT is_valid_utf8(CAST(value AS STRING)) THEN 'NOT_UTF8: message'
        WHEN doc IS NULL THEN 'NOT_JSON: message'
        WHEN tenant_id IS NULL THEN 'UNKNOWN_TOPIC: topic'
        ELSE coalesce({_envelope_problem()}, {ID_PROBLEM}, {DATE_PROBLEM}, {_text_problem('image')}) END"""
    judged = (
        parse(changes, dimension, delete_mode)
        .selectExpr(
            "*",
            f"{E.field('image', 'id')} AS id_value",
            f"{E.field('image', 'date_of_birth')} AS date_value",
            *[f"{E.text_field('image', c)} AS {c}" for c in schemas.TEXT_COLUMNS],
        )
        .selectExpr("*", f"{E.kind('id_value')} AS id_kind", f"{E.kind('date_value')} AS date_kind")
        .selectExpr(
            "*",
            f"{E.whole_id('id_value', 'id_kind')} AS id_number",
            f"{E.normal_date('date_value', 'date_kind')} AS date_of_birth",
        )
        .selectExpr("*", f"{problem} AS error")
        .selectExpr("*", "substring_index(error, ':', 1) AS reason")
    )
    columns = {
        "outcome": OUTCOME,
        "reason": "reason",
        "error": "error",
        "received": f"coalesce({RECEIVED}, false)",
        "id_text": E.get("id_value", "$", "string"),
        "source_id": "try_cast(id_number AS INT)",
        "source_table": "'person'",
        "operation": "operation",
        "firstname": E.fit_text("firstname", schemas.TEXT_LIMIT),
        "surname": E.fit_text("surname", schemas.TEXT_LIMIT),
        "date_of_birth": "date_of_birth",
        "city": E.fit_text("city", schemas.TEXT_LIMIT),
        **{c: E.fit_text(c, schemas.TEXT_LIMIT) for c in schemas.DATA_COLUMNS},
    }
    row = ", ".join(f"'{name}', {expr}" for name, expr in columns.items())
    # One row in, one row out. Without the generator, a filter on a decoded column would move below the projections,
    # and each use of a column in it would parse the message again.
    return judged.selectExpr(
        "topic", "partition", "offset", "value", "tenant_id", "timestamp AS message_time",
        f"{created_at} AS created_at",
        f"inline(array(named_struct({row})))",
    )


def staged(decoded: DataFrame) -> DataFrame:
    return decoded.where(F.col("outcome") == STAGED).select(*STAGING_COLUMNS)


def dead_letters(decoded: DataFrame) -> DataFrame:
    """Messages that can never be staged, with the raw text (invalid UTF-8 replaced) and the error."""
    return (
        decoded.where(F.col("outcome") == DEAD_LETTER)
        .withColumn("raw_value", F.make_valid_utf8(F.col("value").cast("string")))
        .select(*DEAD_LETTER_COLUMNS)
    )


def dropped(decoded: DataFrame) -> DataFrame:
    return decoded.where(F.col("outcome") == DROPPED).select("topic", "partition", "offset", "reason")


def outcome_counts(decoded: DataFrame) -> DataFrame:
    return decoded.groupBy("outcome", "reason").agg(F.count("*").alias("messages"))


def deleted_ids(letters: DataFrame) -> DataFrame:
    """The key of the deleted row, read out of the raw text of each dead-lettered delete, wrapped or bare."""
    deletes = letters.where(F.col("reason") == "DELETE_WITHOUT_ROW")
    return (
        deletes.selectExpr("*", "try_parse_json(raw_value) AS doc")
        .selectExpr("*", f"coalesce({E.field('doc', 'payload')}, doc) AS payload")
        .selectExpr("topic", "partition", "offset", "tenant_id",
                    f"{E.get('payload', '$.before.id', 'int')} AS deleted_id")
    )
