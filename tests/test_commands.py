import datetime
import random

import pytest
from pyspark.sql import functions as F

from changeloom import schemas
from changeloom.operators import activity, checks
from changeloom.operators import commands as C
from changeloom.operators import decode as D
from changeloom.operators.ordered import carry_forward as carry
from changeloom.schemas import COMMON_COLUMNS, DATA_COLUMNS, EXTRA_FIELD_COLUMN, FAMILY_COLUMNS

FAMILY = {t: f for _, t, f in schemas.TENANTS}
COMMAND = (
    "seq BIGINT, kind STRING, tenant_id STRING, legacy_id INT, firstname STRING, surname STRING, date_of_birth DATE, "
    "city STRING, extra_field STRING, modernized_only DATE, "
    + ", ".join(f"{c} STRING" for c in DATA_COLUMNS) + ", present ARRAY<STRING>"
)
LEGACY = ("tenant_id STRING, legacy_id INT, firstname STRING, surname STRING, date_of_birth DATE, city STRING, "
          + ", ".join(f"{c} STRING" for c in DATA_COLUMNS))
COLUMNS = [p.split()[0] for p in COMMAND.split(", ")]


def command(seq, kind, tenant="tenant_a1", legacy_id=1, **fields):
    row = dict.fromkeys(COLUMNS)
    row.update(seq=seq, kind=kind, tenant_id=tenant, legacy_id=legacy_id, present=sorted(fields), **fields)
    return tuple(row[c] for c in COLUMNS)


def legacy_row(tenant, legacy_id, **fields):
    row = dict.fromkeys(["firstname", "surname", "date_of_birth", "city", *DATA_COLUMNS])
    row.update(fields)
    return (tenant, legacy_id, *row.values())


def frames(spark, snapshot, commands):
    return spark.createDataFrame(snapshot, LEGACY), spark.createDataFrame(commands, COMMAND)


def replay(snapshot, commands):
    """One command at a time, as a request handler would do it; returns the rows, statuses and images."""
    names = ["firstname", "surname", "date_of_birth", "city", *DATA_COLUMNS]
    rows = {(r[0], r[1]): dict(zip(names, r[2:])) for r in snapshot}
    status, images = {}, {}
    for values in sorted(commands):
        c = dict(zip(COLUMNS, values))
        family, key = FAMILY.get(c["tenant_id"]), (c["tenant_id"], c["legacy_id"])
        if c["kind"] == "create" and not (c["tenant_id"] and c["firstname"] and c["surname"]):
            status[c["seq"]] = "rejected"
            continue
        if c["kind"] == "update" and not (c["tenant_id"] and c["legacy_id"]):
            status[c["seq"]] = "rejected"
            continue
        if family is None:
            status[c["seq"]] = "rejected"
            continue
        common = {n: c[n] for n in COMMON_COLUMNS}
        if c["kind"] in C.CREATES:
            if key in rows:
                status[c["seq"]] = "rejected"
                continue
            data = dict.fromkeys(DATA_COLUMNS)
            if c["kind"] == "create":
                data[EXTRA_FIELD_COLUMN[family]] = c["extra_field"] or None
            else:
                data.update({n: c[n] or None for n in FAMILY_COLUMNS[family]})
            rows[key] = {**common, **data}
        elif key not in rows:
            status[c["seq"]] = "no_row" if c["kind"] == "update" else "rejected"
            continue
        elif c["kind"] == "update":
            extra = c["extra_field"] if "extra_field" in c["present"] else ""
            rows[key] = {**rows[key], **common, EXTRA_FIELD_COLUMN[family]: extra}
        else:
            kept = {n: c[n] or rows[key][n] for n in FAMILY_COLUMNS[family]}
            rows[key] = {**rows[key], **common, **kept}
        status[c["seq"]] = "applied"
        images[c["seq"]] = (key, rows[key])
    return rows, status, images


def random_case(seed, n=200):
    rng = random.Random(seed)
    tenants = [t for _, t, _ in schemas.TENANTS]
    snapshot = [legacy_row(t, i, firstname="F", surname="S", data_2="two", data_a="a") for t in tenants for i in range(1, 4)]
    texts = [None, "", "x", "y", "z"]
    commands = []
    for seq in range(1, n):
        fields = {c: rng.choice(texts) for c in ("firstname", "surname", "city", *DATA_COLUMNS)}
        if rng.random() < 0.7:
            fields["extra_field"] = rng.choice(texts)
        if rng.random() < 0.3:
            fields["date_of_birth"] = datetime.date(2000, 1, rng.randrange(1, 28))
        commands.append(command(
            seq, rng.choice([*C.CREATES, *C.UPDATES, "update", "legacy_update"]),
            rng.choice([*tenants, "tenant_a1", "tenant_a1", "tenant_zz", "", None]), rng.choice([0, 1, 2, 3, 4, 5, 6, None]),
            **fields))
    return snapshot, commands


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_a_batch_equals_one_command_at_a_time(spark, dimension, seed, monkeypatch):
    monkeypatch.setattr(C, "carry_forward", lambda *a, **k: carry(*a, **{**k, "width": 16}))
    snapshot, commands = random_case(seed)
    # A create needs an id; the callers supply it.
    commands = [c for c in commands if not (c[1] in C.CREATES and c[3] is None)]
    rows, status, images = replay(snapshot, commands)
    before, batch = frames(spark, snapshot, commands)
    after = C.apply(before, batch, dimension).collect()
    assert {(r["tenant_id"], r["legacy_id"]): r.asDict() for r in after} == {
        k: {"tenant_id": k[0], "legacy_id": k[1], **v} for k, v in rows.items()}
    resolved = {r["seq"]: r["status"] for r in C.resolve(before, batch, dimension).collect()}
    assert resolved == status
    got = {r["seq"]: r.asDict() for r in C.row_images(before, batch, dimension).collect()}
    assert set(got) == set(images)
    for seq, (key, row) in images.items():
        assert (got[seq]["tenant_id"], got[seq]["legacy_id"]) == key
        assert {n: got[seq][n] for n in row} == row, seq


def test_validation_reasons(spark, dimension):
    _, batch = frames(spark, [legacy_row("tenant_a1", 1)], [
        command(1, "create", None), command(2, "create", firstname="A"), command(3, "create", firstname="A", surname=""),
        command(4, "create", "tenant_zz", firstname="A", surname="B"),
        command(5, "update", legacy_id=0), command(6, "update", legacy_id=None), command(7, "update", "tenant_zz"),
        command(8, "legacy_create"), command(9, "update")])
    got = {r["seq"]: r["reason"] for r in C.validate(batch, dimension).collect()}
    required, update = "tenant_id, firstname, and surname are required", "tenant_id and legacy_id are required"
    unknown = "unknown tenant tenant_zz"
    assert got == {1: required, 2: required, 3: required, 4: unknown, 5: update, 6: update, 7: unknown, 8: None, 9: None}


@pytest.mark.parametrize("tenant, column", [("tenant_a2", "data_2"), ("tenant_b1", "data_c")])
def test_create_routes_the_extra_field_by_family(spark, dimension, tenant, column):
    _, batch = frames(spark, [legacy_row(tenant, 1)], [
        command(1, "create", tenant, 5, firstname="A", surname="B", extra_field="e"),
        command(2, "create", tenant, 6, firstname="A", surname="B", extra_field="")])
    rows = {r["seq"]: r for r in C.route_creates(C.validate(batch, dimension)).collect()}
    assert {c: rows[1][c] for c in DATA_COLUMNS} == {**dict.fromkeys(DATA_COLUMNS), column: "e"}
    assert rows[2][column] is None


def test_update_without_extra_field_writes_an_empty_text(spark, dimension):
    before, batch = frames(spark, [legacy_row("tenant_a1", 1, firstname="F", city="C", data_1="1", data_2="2")],
                           [command(1, "update", surname="New")])
    row = C.apply(before, batch, dimension).first()
    assert (row["firstname"], row["surname"], row["city"], row["data_1"], row["data_2"]) == (None, "New", None, "1", "")


def test_patch_of_the_target_only_field(spark, dimension):
    day = datetime.date(2024, 5, 1)
    person = spark.createDataFrame([("tenant_a1", 1, None), ("tenant_a1", 2, day), ("tenant_b1", 1, None)],
                                   "tenant_id STRING, legacy_id INT, modernized_only DATE")
    _, batch = frames(spark, [legacy_row("tenant_a1", 1)], [
        command(1, "update", legacy_id=1, modernized_only=day), command(2, "update", legacy_id=2),
        command(3, "update", legacy_id=9, modernized_only=day)])
    got = {(r[0], r[1]): r[2] for r in C.patch_target_only(person, batch, dimension).collect()}
    assert got == {("tenant_a1", 1): day, ("tenant_a1", 2): day, ("tenant_b1", 1): None}


def test_changes_of_commands_decode_to_the_same_rows(spark, dimension):
    before, batch = frames(spark, [legacy_row("tenant_b2", 1, firstname="F", data_a="a")], [
        command(1, "update", "tenant_b2", firstname='Quo"te', surname="S", extra_field="e",
                date_of_birth=datetime.date(1990, 5, 17))])
    changes = C.to_changes(C.row_images(before, batch, dimension), F.lit(datetime.datetime(2024, 1, 1)))
    row = D.staged(D.decode(changes, dimension)).first()
    assert (row["operation"], row["firstname"], row["date_of_birth"], row["data_a"], row["data_c"]) == (
        "UPDATE", 'Quo"te', datetime.date(1990, 5, 17), "a", "e")


def test_events_of_commands(spark, dimension):
    day = datetime.date(2024, 5, 1)
    before, batch = frames(spark, [legacy_row("tenant_a1", 1)], [
        command(1, "create", legacy_id=7, firstname="A", surname="B"), command(2, "create", firstname="A"),
        command(3, "update", modernized_only=day), command(4, "update", "tenant_zz")])
    log = activity.command_events(C.resolve(before, batch, dimension), F.lit(datetime.datetime(2024, 1, 1)))
    got = [(r["severity"], r["tenant_id"], r["message"]) for r in log.orderBy("position", "step").collect()]
    assert got == [
        ("info", "tenant_a1", "tenant_a1 person#7 INSERT written to legacy DB (postgres-legacy-a1)"),
        ("warn", "tenant_a1", "POST /api/persons rejected: tenant_id, firstname, and surname are required"),
        ("info", "tenant_a1", "tenant_a1 person#1 UPDATE written to legacy DB (postgres-legacy-a1)"),
        ("info", "tenant_a1", "tenant_a1 person#1 modernized_only written to new system (person table)"),
        ("warn", None, "PUT /api/persons rejected: unknown tenant tenant_zz"),
    ]


def test_commands_never_reach_another_tenant(spark, dimension):
    before, batch = frames(spark, [legacy_row("tenant_a1", 1, city="A"), legacy_row("tenant_b1", 1, city="B")],
                           [command(1, "update", "tenant_a1", city="new")])
    after = C.apply(before, batch, dimension)
    report = checks.reconcile(before, after, ["city"]).collect()
    assert {r["tenant_id"]: r["status"] for r in report} == {"tenant_a1": "different", "tenant_b1": "equal"}
