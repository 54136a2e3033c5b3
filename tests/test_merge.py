import datetime
import random

import pytest
from pyspark.sql import functions as F

from changeloom import schemas
from changeloom.operators import merge as M

NOW = datetime.datetime(2024, 6, 1)
LATER = datetime.datetime(2024, 6, 2)


def event(offset, source_id=1, firstname="Ann", operation="UPDATE", tenant="tenant_a1", partition=0, surname="Archer",
          **more):
    row = {f.name: None for f in schemas.STAGING}
    row.update(topic="t", partition=partition, offset=offset, tenant_id=tenant, source_id=source_id,
               source_table="person", operation=operation, firstname=firstname, surname=surname,
               created_at=datetime.datetime(2024, 1, 1) + datetime.timedelta(seconds=-offset), **more)
    return tuple(row[f.name] for f in schemas.STAGING)


def staging(spark, *events):
    return spark.createDataFrame(list(events), schemas.STAGING)


def rows(df):
    return {(r["tenant_id"], r["legacy_id"]): r for r in df.collect()}


def test_latest_by_log_position_wins_over_any_time(spark):
    # created_at runs against the offsets here
    df = staging(spark, event(1, 7, "Before", "INSERT", city="Old"), event(2, 7, "After", city="New"))
    row = rows(M.merge_first(df, NOW))[("tenant_a1", 7)]
    assert (row["firstname"], row["city"], row["synced_at"], row["updated_at"]) == ("After", "New", NOW, NOW)


def test_the_whole_row_is_replaced_but_for_the_target_only_column(spark):
    target = M.merge_first(staging(spark, event(1, city="Leeds", data_2="x")), NOW).withColumn(
        "modernized_only", F.lit(datetime.date(2024, 5, 1)))
    after = M.merge(target, staging(spark, *[event(i, firstname=f"Edit{i}") for i in (2, 3, 4)]), LATER)
    row = rows(after)[("tenant_a1", 1)]
    assert (row["firstname"], row["city"], row["extra_field"], row["modernized_only"]) == (
        "Edit4", None, None, datetime.date(2024, 5, 1))
    assert row["synced_at"] == LATER


def test_same_id_in_two_tenants_is_two_persons(spark):
    after = M.merge_first(staging(spark, event(1, tenant="tenant_a1"), event(2, tenant="tenant_b1")), NOW)
    assert set(rows(after)) == {("tenant_a1", 1), ("tenant_b1", 1)}


def test_extra_field_takes_an_empty_text_over_null(spark):
    after = M.merge_first(staging(spark, event(1, data_2="", data_c="z"), event(2, 2, data_c="z")), NOW)
    assert [r["extra_field"] for _, r in sorted(rows(after).items())] == ["", "z"]


def test_delete_with_a_row_is_an_upsert_in_parity_mode(spark):
    after = M.merge_first(staging(spark, event(1, operation="DELETE")), NOW)
    assert set(rows(after)) == {("tenant_a1", 1)}


def test_rows_without_names_are_set_aside_one_by_one(spark):
    df = staging(spark, event(1), event(2, firstname=None), event(3, 2, surname=None))
    assert rows(M.merge_first(df, NOW))[("tenant_a1", 1)]["firstname"] == "Ann"
    letters = {r["offset"]: r["error"] for r in M.quarantined(df).collect()}
    assert letters == {2: "TARGET_NOT_NULL: firstname", 3: "TARGET_NOT_NULL: surname"}


def test_replay_changes_nothing(spark):
    df = staging(spark, *[event(i, i % 5, f"n{i}") for i in range(40)])
    once = M.merge_first(df, NOW)
    assert rows(M.merge(once, df, NOW)) == rows(once)
    assert M.dedupe_log(df.unionByName(df)).count() == 40


def test_new_columns_are_added_and_old_ones_kept(spark):
    target = M.merge_first(staging(spark, event(1), event(2, 2)), NOW).withColumn("only_target", F.lit("t"))
    after = M.merge(target, staging(spark, event(3)).withColumn("nickname", F.lit("n")), LATER)
    got = {k: (r["only_target"], r["nickname"]) for k, r in rows(after).items()}
    assert got == {("tenant_a1", 1): (None, "n"), ("tenant_a1", 2): ("t", None)}


def test_left_join_and_anti_join_together_equal_the_merge(spark):
    target = M.merge_first(staging(spark, *[event(i, i) for i in range(6)]), NOW).withColumn(
        "modernized_only", F.lit(datetime.date(2024, 5, 1)))
    batch = staging(spark, *[event(100 + i, i, "New") for i in range(3, 9)])
    latest = M.map_columns(M.latest_per_key(M.accepted(batch)))
    stamp = F.lit(LATER).cast("timestamp_ntz")
    joined = M.preserve_join(latest, target).withColumns({"synced_at": stamp, "updated_at": stamp})
    by_parts = M.survivors(target, latest).unionByName(joined.select(*M.PERSON_COLUMNS))
    assert rows(by_parts) == rows(M.merge(target, batch, LATER))


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_deletes_do_not_depend_on_batch_boundaries(spark, seed):
    """Random histories, merged in one batch and in three, against a plain replay of the events."""
    rng = random.Random(seed)
    events = []
    for i in range(300):
        op = rng.choice(["INSERT", "UPDATE", "DELETE"])
        gone = op == "DELETE"
        events.append(event(i, rng.randrange(12), None if gone else f"n{i}", op, surname=None if gone else "s"))
    expected = {}
    for e in events:
        key, op = ("tenant_a1", e[4]), e[6]
        if op == "DELETE":
            expected.pop(key, None)
        else:
            expected[key] = e[7]
    patch = datetime.date(2024, 5, 1)
    one = M.merge_first(staging(spark, *events), NOW, "apply")
    assert {k: r["firstname"] for k, r in rows(one).items()} == expected
    cuts = sorted(rng.sample(range(1, 299), 2))
    target = M.merge_first(staging(spark, *events[: cuts[0]]), NOW, "apply")
    target = target.withColumn("modernized_only", F.lit(patch))
    for part in (events[cuts[0]:cuts[1]], events[cuts[1]:]):
        target = M.merge(target, staging(spark, *part), NOW, "apply")
    got = rows(target)
    assert {k: r["firstname"] for k, r in got.items()} == expected
    carried = {k for k in (("tenant_a1", e[4]) for e in events[: cuts[0]])}
    deleted = {("tenant_a1", e[4]) for e in events[cuts[0]:] if e[6] == "DELETE"}
    existed = set(rows(M.merge_first(staging(spark, *events[: cuts[0]]), NOW, "apply")))
    for key, row in got.items():
        keeps = key in carried and key in existed and key not in deleted
        assert row["modernized_only"] == (patch if keeps else None), key


def test_row_order_and_partitioning_do_not_matter(spark):
    df = staging(spark, *[event(i, i % 7, f"n{i}") for i in range(60)])
    expected = rows(M.merge_first(df, NOW))
    for parts in (1, 3, 8):
        assert rows(M.merge_first(df.orderBy(F.rand(parts)).repartition(parts), NOW)) == expected


def test_the_log_wins_over_a_snapshot_of_the_same_key(spark):
    from changeloom.sources.changes import unchanged_since

    snapshot = [event(1000, 1, "Snapshot", "INSERT", partition=-1), event(1001, 2, "Snapshot", "INSERT", partition=-1),
                event(1002, 3, "Snapshot", "INSERT", partition=-1)]
    log = [event(10, 1, "Log"), event(20, 2, "Log")]
    together = rows(M.merge_first(staging(spark, *snapshot, *log), NOW))
    assert {k[1]: r["firstname"] for k, r in together.items()} == {1: "Log", 2: "Log", 3: "Snapshot"}
    # a chunk that was read after offset 10: what it says of key 1 is newer than the log, that of key 2 may be older
    before = staging(spark, *log)
    chunk = unchanged_since(staging(spark, *snapshot), before, 10)
    after = rows(M.merge(M.merge_first(before, NOW), chunk, LATER))
    assert {k[1]: r["firstname"] for k, r in after.items()} == {1: "Snapshot", 2: "Log", 3: "Snapshot"}
