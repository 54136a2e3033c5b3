import datetime

import pytest
from pyspark.sql import functions as F

from changeloom import schemas
from changeloom.operators import activity as A
from changeloom.operators import checks as Q
from changeloom.operators import merge as M
from changeloom.operators import progress as P
from changeloom.operators import serve as R
from test_merge import NOW, event, staging

T0 = datetime.datetime(2024, 1, 1)


def log(spark, n=1500):
    rows = [(i, T0 + datetime.timedelta(seconds=i), "cdc-consumer" if i % 2 else "api", "s",
             ("info", "warn", "error")[i % 3], f"tenant_a{i % 2 + 1}", 1, f"Message {i}", None) for i in range(1, n + 1)]
    return spark.createDataFrame(rows, schemas.EVENT_LOG)


def ids(df):
    return [r["id"] for r in df.collect()]


def test_first_page_is_the_newest_events_oldest_first(spark):
    assert ids(R.event_page(log(spark))) == list(range(1301, 1501))
    assert ids(R.event_page(log(spark), limit=3)) == [1498, 1499, 1500]


def test_later_pages_are_the_oldest_events_after_since_id(spark):
    assert ids(R.event_page(log(spark), since_id=10, limit=3)) == [11, 12, 13]
    assert ids(R.event_page(log(spark), since_id=10, limit=3, severities=["warn", "error"], tenant_id="tenant_a1")) == [
        14, 16, 20]


@pytest.mark.parametrize("limit, size", [(None, 200), (0, 1), (-5, 1), (1000, 1000), (5000, 1000), (7, 7)])
def test_limit_is_clamped(limit, size):
    assert R.clamp_limit(limit) == size


def test_a_feed_that_was_never_written_is_empty(spark, tmp_path):
    assert R.event_page(R.log_or_empty(spark, f"{tmp_path}/none")).collect() == []
    log(spark, 5).write.parquet(f"{tmp_path}/log")
    assert ids(R.event_page(R.log_or_empty(spark, f"{tmp_path}/log"))) == [1, 2, 3, 4, 5]


def test_search_is_newest_first_and_ignores_case(spark):
    assert ids(R.event_search(log(spark), "MESSAGE 149", severities=["info"])) == [1497, 1494, 1491]


def test_person_list_puts_unsynced_rows_first(spark):
    person = M.merge_first(staging(spark, event(1, 2), event(2, 1), event(3, 3)), NOW).withColumn(
        "synced_at", F.when(F.col("legacy_id") != 3, F.col("synced_at")))
    assert [r["legacy_id"] for r in R.person_list(person).collect()] == [3, 1, 2]


def test_legacy_reads(spark):
    legacy = spark.createDataFrame([("tenant_a1", i, f"n{i}") for i in (1, 3, 2)], "tenant_id STRING, legacy_id INT, firstname STRING")
    assert [r["legacy_id"] for r in R.legacy_list(legacy, "tenant_a1").collect()] == [3, 2, 1]
    with pytest.raises(ValueError, match="Unknown tenant"):
        R.legacy_list(legacy, "tenant_zz")
    asked = spark.createDataFrame([("tenant_a1", 1), ("tenant_a1", 9)], "tenant_id STRING, legacy_id INT")
    assert {r["legacy_id"]: (r["found"], r["firstname"]) for r in R.legacy_lookup(asked, legacy).collect()} == {
        1: (True, "n1"), 9: (False, None)}
    assert R.find(legacy, firstname="n3").count() == R.find(legacy, legacy_id=2).count() == 1


def test_status_without_tables_is_null(spark):
    row = R.status(spark, NOW, None, None, None, 0).first()
    assert all(v is None for v in row)
    staged = staging(spark, event(1), event(2)).withColumn("batch_id", F.lit(1))
    row = R.status(spark, T0 + datetime.timedelta(seconds=100), staged, None, log(spark, 100), 0).first()
    assert (row["staging_backlog"], row["dead_letters"], row["errors"]) == (2, None, 33)
    assert row["last_consumer_activity"] == T0 + datetime.timedelta(seconds=99)
    assert row["events_last_minute"] == 60


def test_prune_by_age_and_by_id_distance(spark):
    rows = [(i, T0 + datetime.timedelta(hours=h), "s", "s", "info", None, None, "m", None)
            for i, h in ((1, 47), (4999, 47), (5000, 47), (5001, 23), (5002, 24), (9999, 47))]
    kept = A.prune(spark.createDataFrame(rows, schemas.EVENT_LOG), T0 + datetime.timedelta(hours=48))
    assert sorted(ids(kept)) == [5000, 5002, 9999]


def test_batch_summary_shows_five_keys(spark):
    batch = staging(spark, *[event(i, i, tenant=t) for i, t in enumerate(["tenant_b1", *["tenant_a1"] * 6])])
    row = A.batch_summary(batch.withColumn("batch_id", F.lit(3)), F.lit("0.5")).first()
    assert row["message"] == (
        "dbt run finished in 0.5s: 7 staged row(s) merged into person (tenant_a1 person#1, tenant_a1 person#2, "
        "tenant_a1 person#3, tenant_a1 person#4, tenant_a1 person#5, +2 more)")
    small = A.batch_summary(batch.where("offset < 2").withColumn("batch_id", F.lit(3)), F.lit("1")).first()
    assert small["shown"] == "tenant_a1 person#1, tenant_b1 person#0"


def test_retry_events_count_attempts(spark):
    failures = spark.createDataFrame([("legacy_a1.public.person", 0, 7, a, T0, "tenant_a1") for a in (1, 2, 3)],
                                     "topic STRING, partition INT, offset BIGINT, attempt INT, ts TIMESTAMP_NTZ, tenant_id STRING")
    events = A.retry_events(failures)
    assert "legacy_a1.public.person@7 not staged, retrying in 5s (attempt 2)" in {r["message"] for r in events.collect()}
    row = A.retry_counts(events).first()
    assert (row["retries"], row["last_attempt"]) == (3, 3)


def person(spark, *keys):
    return spark.createDataFrame(
        [(t, i, "F", "S", None, None, "x", None, NOW, NOW, NOW) for t, i in keys], schemas.PERSON)


def test_checks_pass_on_sound_data_and_fail_on_faults(spark):
    tenants = [t for _, t, _ in schemas.TENANTS]
    sound = person(spark, ("tenant_a1", 1), ("tenant_b1", 1))
    results = Q.report(Q.column_checks(sound, tenants), Q.key_checks(sound), Q.arrival_check(sound, sound),
                       Q.replay_check(sound, sound))
    assert {r["status"] for r in results.collect()} == {"passed"} and results.count() == 9
    bad = person(spark, ("tenant_bad", 99), ("tenant_a1", 1), ("tenant_a1", 1), (None, 5))
    failed = {r["check_name"]: r["failures"] for r in
              Q.report(Q.column_checks(bad, tenants), Q.key_checks(bad)).collect() if r["status"] == "failed"}
    assert failed == {"accepted_values_tenant_id": 1, "unique_key": 1, "not_null_tenant_id": 1,
                      "tenants_stay_separate": 1}
    empty = schemas.empty(spark, schemas.PERSON)
    assert {r["status"] for r in Q.report(Q.column_checks(empty, tenants), Q.key_checks(empty)).collect()} == {"passed"}
    assert {r["status"]: r["checks"] for r in Q.summary(Q.report(Q.skipped(Q.key_checks(bad)))).collect()} == {"skipped": 2}


def test_snapshot_diff_counts_copies_and_ignores_markers(spark):
    before = person(spark, ("tenant_a1", 1), ("tenant_a1", 2), ("tenant_a1", 2))
    marker = person(spark, ("tenant_a1", 50)).withColumn("surname", F.lit("x-canary"))
    after = person(spark, ("tenant_a1", 1), ("tenant_a1", 3)).unionByName(marker)
    got = {(r["legacy_id"], r["side"], r["copies"]) for r in Q.snapshot_diff(before, after).collect()}
    assert got == {(2, "missing", 2), (3, "extra", 1)}


def test_quiet_needs_rows_no_backlog_and_rest(spark):
    batch = staging(spark, event(0), event(1)).withColumn("batch_id", F.lit(0))
    newest = datetime.datetime(2024, 1, 1)
    def at(seconds, applied=0, least=2):
        return P.quiet(batch, applied, newest + datetime.timedelta(seconds=seconds), least).first()["quiet"]
    assert at(15) and not at(14) and not at(15, applied=-1) and not at(15, least=3)
    assert P.quiet(batch.where("false"), 0, newest, 0).first()["quiet"] is False


def test_barrier_and_progress(spark):
    feed = spark.createDataFrame([("a", 0, o) for o in range(10)] + [("b", 0, 3)], "topic STRING, partition INT, offset BIGINT")
    handled = feed.where("topic = 'a' AND offset < 6")
    got = {r["topic"]: (r["newest"], r["handled"], r["lag"]) for r in P.topic_progress(feed, handled).collect()}
    assert got == {"a": (9, 5, 4), "b": (3, None, 4)}
    markers = feed.where("offset IN (3, 5, 6)").withColumnRenamed("offset", "marker_offset")
    passed = {(r["topic"], r["marker_offset"]): r["passed"] for r in P.barrier(markers, handled).collect()}
    assert passed == {("a", 3): True, ("a", 5): True, ("a", 6): False, ("b", 3): False}


def test_a_barrier_does_not_pass_over_a_gap(spark):
    # offsets 4 and 8 of the log do not exist; 6 was not handled, though 9 was
    feed = spark.createDataFrame([("a", 0, o) for o in range(10) if o not in (4, 8)] + [("b", 1, 2)], "topic STRING, partition INT, offset BIGINT")
    handled = feed.where("topic = 'a' AND offset <> 6")
    markers = feed.withColumnRenamed("offset", "marker_offset")
    got = {(r["topic"], r["marker_offset"]): (r["missing"], r["passed"]) for r in P.barrier(markers, handled, feed).collect()}
    assert got == {("a", o): (6, o < 6) for o in (0, 1, 2, 3, 5, 6, 7, 9)} | {("b", 2): (2, False)}
    assert all(r["passed"] for r in P.barrier(markers, feed, feed).collect())
    assert P.barrier(markers.limit(0), handled, feed).count() == 0
