import datetime

import pytest

from changeloom import schemas
from changeloom.operators import decode as D

A1 = "legacy_a1.public.person"


def envelope(payload):
    """A change message around the text of a payload."""
    return b'{"payload":' + payload.encode() + b"}"


def decoded(spark, dimension, messages, delete_mode="dead_letter"):
    rows = [(topic, 0, i, None, value) for i, (topic, value) in enumerate(messages)]
    df = spark.createDataFrame(rows, schemas.CHANGES)
    return {r["offset"]: r for r in D.decode(df, dimension, delete_mode).collect()}


GOOD = [
    (envelope('{"op": "c", "after": {"id": 1}}'), {"operation": "INSERT", "source_id": 1}),
    (envelope('{"op": "u", "after": {"id": 1}}'), {"operation": "UPDATE"}),
    (envelope('{"op": "d", "after": {"id": 1}}'), {"operation": "DELETE", "source_id": 1}),
    (envelope('{"op": "r", "after": {"id": 1}}'), {"operation": "INSERT"}),
    (envelope('{"op": "x", "after": {"id": 1}}'), {"operation": "INSERT"}),
    (envelope('{"after": {"id": 1}}'), {"operation": "INSERT"}),
    (envelope('{"op": 5, "after": {"id": 1}}'), {"operation": "INSERT"}),
    ('{"op": "c", "after": {"id": 7, "firstname": "Ann"}}'.encode(), {"source_id": 7, "firstname": "Ann"}),
    (envelope('{"op": "c", "after": {"id": 1, "date_of_birth": null}}'), {"date_of_birth": None}),
    (envelope('{"op": "c", "after": {"id": 1, "date_of_birth": 0}}'), {"date_of_birth": datetime.date(1970, 1, 1)}),
    (envelope('{"op": "c", "after": {"id": 1, "date_of_birth": 19000}}'), {"date_of_birth": datetime.date(2022, 1, 8)}),
    (envelope('{"op": "c", "after": {"id": 1, "date_of_birth": -1}}'), {"date_of_birth": datetime.date(1969, 12, 31)}),
    (envelope('{"op": "c", "after": {"id": 1, "date_of_birth": "1984-11-02"}}'), {"date_of_birth": datetime.date(1984, 11, 2)}),
    (envelope('{"op": "c", "after": {"id": "7"}}'), {"source_id": 7}),
    (envelope('{"op": "c", "after": {"id": 5.5}}'), {"source_id": 6}),
    (envelope('{"op": "c", "after": {"id": -5.5}}'), {"source_id": -6}),
    (envelope('{"op": "c", "after": {"id": 1, "city": 42}}'), {"city": "42"}),
    (envelope('{"op": "c", "after": {"id": 1, "city": true}}'), {"city": "true"}),
    (envelope('{"op": "c", "after": {"id": 1, "city": "[x]"}}'), {"city": "[x]"}),
    (envelope('{"op": "c", "after": {"id": 1, "city": "%s   "}}' % ("x" * 100)), {"city": "x" * 100}),
    (envelope('{"op": "c", "after": {"id": 1, "unknown_column": 5, "tenant_id": "tenant_b2"}}'), {"tenant_id": "tenant_a1"}),
]

DEAD = [
    (b"not json", "NOT_JSON"),
    (b"\xff\xfe{}", "NOT_UTF8"),
    (b"", "NOT_JSON"),
    (b"null", "NOT_AN_OBJECT"),
    (b"[]", "NOT_AN_OBJECT"),
    (b'"text"', "NOT_AN_OBJECT"),
    (b'{"payload":null}', "NOT_AN_OBJECT"),
    (b'{"payload":[]}', "NOT_AN_OBJECT"),
    (b'{"payload":"x"}', "NOT_AN_OBJECT"),
    (envelope('{"op": {"a": 1}, "after": {"id": 1}}'), "OP_NOT_SCALAR"),
    (envelope('{"op": "d", "before": {"id": 5}, "after": null}'), "DELETE_WITHOUT_ROW"),
    (envelope('{"op": "u", "after": null}'), "ROW_IS_NULL"),
    (envelope('{"op": "c", "after": [1]}'), "ROW_NOT_OBJECT"),
    (envelope('{"op": "c", "after": "x"}'), "ROW_NOT_OBJECT"),
    (envelope('{"op": "c"}'), "ID_MISSING"),
    (envelope('{"op": "c", "after": {}}'), "ID_MISSING"),
    (envelope('{"op": "c", "after": {"id": null}}'), "ID_MISSING"),
    (envelope('{"op": "c", "after": {"id": true}}'), "ID_NOT_INTEGER"),
    (envelope('{"op": "c", "after": {"id": "5.7"}}'), "ID_NOT_INTEGER"),
    (envelope('{"op": "c", "after": {"id": [1]}}'), "ID_NOT_INTEGER"),
    (envelope('{"op": "c", "after": {"id": 2147483648}}'), "ID_OUT_OF_RANGE"),
    (envelope('{"op": "c", "after": {"id": 1e+300}}'), "ID_NOT_INTEGER"),
    (envelope('{"op": "c", "after": {"id": 1, "date_of_birth": "yesterday"}}'), "DATE_INVALID"),
    (envelope('{"op": "c", "after": {"id": 1, "date_of_birth": "1990"}}'), "DATE_INVALID"),
    (envelope('{"op": "c", "after": {"id": 1, "date_of_birth": "1990-13-01"}}'), "DATE_INVALID"),
    (envelope('{"op": "c", "after": {"id": 1, "date_of_birth": 1000000000}}'), "DATE_INVALID"),
    (envelope('{"op": "c", "after": {"id": 1, "date_of_birth": 1.5}}'), "DATE_INVALID"),
    (envelope('{"op": "c", "after": {"id": 1, "city": "%s"}}' % ("x" * 101)), "TEXT_TOO_LONG"),
    (envelope('{"op": "c", "after": {"id": 1, "data_c": "%s"}}' % ("y" * 101)), "TEXT_TOO_LONG"),
    (envelope('{"op": "c", "after": {"id": 1, "city": {"a": 1}}}'), "TEXT_NOT_SCALAR"),
    (envelope('{"op": "c", "after": {"id": 1, "city": [1]}}'), "TEXT_NOT_SCALAR"),
    (envelope(r'{"op": "c", "after": {"id": 1, "city": "a\u0000b"}}'), "TEXT_HAS_NUL"),
]


def test_good_messages(spark, dimension):
    rows = decoded(spark, dimension, [(A1, m) for m, _ in GOOD])
    for i, (m, expected) in enumerate(GOOD):
        assert rows[i]["outcome"] == D.STAGED, (m, rows[i])
        assert {k: rows[i][k] for k in expected} == expected, m


def test_dead_messages(spark, dimension):
    rows = decoded(spark, dimension, [(A1, m) for m, _ in DEAD])
    for i, (m, reason) in enumerate(DEAD):
        assert (rows[i]["outcome"], rows[i]["reason"]) == (D.DEAD_LETTER, reason), m


def test_a_full_row_has_all_staging_columns(spark, dimension):
    after = '{"id": 9, "firstname": "A", "surname": "B", "date_of_birth": 8035, "city": "X", "data_2": "d2"}'
    row = decoded(spark, dimension, [(A1, envelope('{"op": "u", "after": ' + after + "}"))])[0]
    assert D.STAGING_COLUMNS[-2:] == ["message_time", "created_at"]
    values = [row[c] for c in D.STAGING_COLUMNS[3:-2]]
    assert values == ["tenant_a1", 9, "person", "UPDATE", "A", "B", datetime.date(1992, 1, 1), "X",
                      None, "d2", None, None, None, None]


@pytest.mark.parametrize("topic, tenant", [(t, n) for t, n, _ in schemas.TENANTS])
def test_topic_gives_the_tenant(spark, dimension, topic, tenant):
    assert decoded(spark, dimension, [(topic, envelope('{"op": "c", "after": {"id": 1}}'))])[0]["tenant_id"] == tenant


def test_dropped_messages(spark, dimension):
    rows = decoded(spark, dimension, [
        (A1, None), ("other.public.person", envelope('{"op": "c", "after": {"id": 1}}')), ("other.public.person", b"not json"),
        ("other.public.person", None)])
    assert [(rows[i]["outcome"], rows[i]["reason"]) for i in range(4)] == [
        ("dropped", "NULL_VALUE"), ("dropped", "UNKNOWN_TOPIC"), ("dead_letter", "NOT_JSON"),
        ("dropped", "NULL_VALUE")]


def test_dead_letter_keeps_the_text_and_replaces_bad_bytes(spark, dimension):
    df = spark.createDataFrame([(A1, 0, 1, None, b"ab\xff")], schemas.CHANGES)
    letter = D.dead_letters(D.decode(df, dimension)).first()
    assert letter["raw_value"] == "ab�" and letter["error"].startswith("NOT_UTF8: ")


def test_deleted_id_from_wrapped_and_bare_letters(spark, dimension):
    values = [envelope('{"op": "d", "before": {"id": 5}, "after": null}'), '{"op": "d", "before": {"id": 6}, "after": null}'.encode(), envelope('{"op": "d", "after": null}')]
    df = spark.createDataFrame([(A1, 0, i, None, v) for i, v in enumerate(values)], schemas.CHANGES)
    found = D.deleted_ids(D.dead_letters(D.decode(df, dimension))).collect()
    assert {r["offset"]: r["deleted_id"] for r in found} == {0: 5, 1: 6, 2: None}


def test_apply_mode_stages_the_before_image(spark, dimension):
    values = [envelope('{"op": "d", "before": {"id": 5}, "after": null}'), envelope('{"op": "d", "before": {"id": 5}, "after": {"id": 8}}'), envelope('{"op": "d", "after": null}'),
              envelope('{"op": "u", "before": {"id": 5}, "after": {"id": 3}}')]
    rows = decoded(spark, dimension, [(A1, v) for v in values], "apply")
    assert [(rows[i]["operation"], rows[i]["source_id"], rows[i]["outcome"]) for i in range(4)] == [
        ("DELETE", 5, "staged"), ("DELETE", 5, "staged"), ("DELETE", None, "dead_letter"), ("UPDATE", 3, "staged")]


def test_received_is_announced_once_the_envelope_is_understood(spark, dimension):
    cases = [(envelope('{"op": "c", "after": {"id": 1}}'), True), (envelope('{"op": "c", "after": {"id": 1, "city": "%s"}}' % ("x" * 101)), True),
             (envelope('{"op": "d", "before": {"id": 1}, "after": null}'), True), (envelope('{"op": "c"}'), True), (envelope('{"op": "c", "after": []}'), True),
             (envelope('{"op": "c", "after": "x"}'), False), (b"not json", False), (b"[]", False)]
    rows = decoded(spark, dimension, [(A1, m) for m, _ in cases])
    assert [rows[i]["received"] for i in range(len(cases))] == [e for _, e in cases]


def test_unknown_mode_is_refused(spark, dimension):
    with pytest.raises(ValueError):
        D.decode(spark.createDataFrame([], schemas.CHANGES), dimension, "ignore")
