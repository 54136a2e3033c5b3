import datetime

import pytest
from pyspark.sql import functions as F

from changeloom import schemas, session
from changeloom.operators import merge as M
from changeloom.sources import changes, sinks
from changeloom.sources import tables as T
from changeloom.sources.store import CatalogTarget, Ledger, PersonTable, merge_into_sql
from changeloom.streaming import sync
from test_merge import LATER, NOW, event, rows, staging


class Stubborn:
    """A target that refuses each batch `refusals` times before it takes it."""

    def __init__(self, target, refusals: int):
        self.spark = target.spark
        self.target = target
        self.refusals = refusals
        self.tries = {}

    def apply_batch(self, staging, batch_id, *rest):
        self.tries[batch_id] = self.tries.get(batch_id, 0) + 1
        if self.tries[batch_id] <= self.refusals:
            raise RuntimeError(f"batch {batch_id} is refused")
        return self.target.apply_batch(staging, batch_id, *rest)


def data_files(table):
    import pathlib

    return {(str(f), f.stat().st_mtime_ns) for f in pathlib.Path(table.data).rglob("*.parquet")}


def test_a_merge_leaves_the_files_of_untouched_parts(spark, tmp_path):
    table = PersonTable(spark, f"{tmp_path}/person", 8)
    assert table.read().count() == 0
    assert table.apply_batch(staging(spark, *[event(i, i) for i in range(1, 41)]), 0, NOW)
    day = datetime.date(2024, 5, 1)
    table.patch(lambda df: df.withColumn("modernized_only", F.lit(day)))
    before = data_files(table)
    batch = staging(spark, event(100, 3, firstname="New"), event(101, 77))
    touched = table.touched(batch)
    assert 1 <= len(touched) <= 2
    assert table.apply_batch(batch, 1, LATER)
    after = data_files(table)
    assert len(before - after) <= 2 and len(before & after) >= len(before) - 2
    changed = {f"tenant_id={t}/part={p}" for t, p in touched}
    assert all(any(c in f for c in changed) for f, _ in before ^ after)
    got = {k[1]: (r["firstname"], r["modernized_only"], r["synced_at"]) for k, r in rows(table.read()).items()}
    assert len(got) == 41 and got[3] == ("New", day, LATER) and got[77][1:] == (None, LATER) and got[4] == ("Ann", day, NOW)
    # an object that is made with another number of parts finds the table as it is; an empty batch changes nothing
    again = PersonTable(spark, f"{tmp_path}/person", 3)
    assert again.parts == 8 and rows(again.read()) == rows(table.read())
    assert not table.apply_batch(staging(spark, event(1)).limit(0), 2, LATER) and data_files(table) == after


def test_a_merge_reads_only_the_parts_that_it_touches(spark, tmp_path):
    table = PersonTable(spark, f"{tmp_path}/person", 8)
    table.apply_batch(staging(spark, *[event(i, i) for i in range(1, 41)]), 0, NOW)
    tenant, part = table.touched(staging(spark, event(100, 3)))[0]
    some = table.stored().where((F.col("tenant_id") == tenant) & F.col("part").isin([part]))
    assert "PartitionFilters: [isnotnull(tenant_id" in some._jdf.queryExecution().executedPlan().toString()
    assert len({r["f"] for r in some.select(F.input_file_name().alias("f")).collect()}) == 1


@pytest.mark.parametrize("mode", ["dead_letter", "apply"])
def test_parts_hold_what_one_merge_gives_and_new_columns_come_up(spark, tmp_path, mode):
    table = PersonTable(spark, f"{tmp_path}/person", 3)
    first = staging(spark, *[event(i, i % 7) for i in range(20)])
    second = staging(spark, event(30, 2, firstname="X"), event(31, 3, operation="DELETE")).withColumn("nickname", F.lit("nick"))
    table.apply_batch(first, 0, NOW, mode)
    table.apply_batch(second, 1, LATER, mode)
    expected = M.merge(M.merge_first(first, NOW, mode), second, LATER, mode)
    assert table.read().columns == expected.columns and rows(table.read()) == rows(expected)
    table.apply_batch(second, 1, LATER, mode)  # repeated
    assert rows(table.read()) == rows(expected)


def test_a_part_whose_last_row_is_deleted_goes(spark, tmp_path):
    table = PersonTable(spark, f"{tmp_path}/person", 64)
    table.apply_batch(staging(spark, event(1, 1), event(2, 2)), 0, NOW, "apply")
    table.apply_batch(staging(spark, event(3, 2, operation="DELETE")), 1, LATER, "apply")
    assert [k[1] for k in rows(table.read())] == [1] and len(data_files(table)) == 1


def test_what_a_failure_left_is_finished_or_dropped(spark, tmp_path):
    table = PersonTable(spark, f"{tmp_path}/person", 2)
    table.apply_batch(staging(spark, event(1), event(2, 2)), 0, NOW)
    put, table._finish = table._finish, lambda: None  # ends after the first step
    table.apply_batch(staging(spark, event(3, firstname="New")), 1, LATER)
    assert rows(table.read())[("tenant_a1", 1)]["firstname"] == "Ann"
    table._finish = put
    half = f"{tmp_path}/person/_pending/batch_9/rows/tenant_id=tenant_a1/part=0"
    spark.range(1).write.parquet(half)  # a first step that did not end
    other = PersonTable(spark, f"{tmp_path}/person")
    assert other.apply_batch(staging(spark, event(4, 5)), 2, LATER)
    got = {k[1]: r["firstname"] for k, r in rows(other.read()).items()}
    assert got == {1: "New", 2: "Ann", 5: "Ann"} and not list((tmp_path / "person" / "_pending").iterdir())


def test_the_ledger_holds_ranges_of_batches(spark, tmp_path):
    ledger = Ledger(spark, f"{tmp_path}/merged")
    assert ledger.last() == -1 and not ledger.holds(0)
    for first, last in ((0, 0), (1, 3), (7, 8), (9, 9)):
        ledger.record(first, last, NOW)
    again = Ledger(spark, f"{tmp_path}/merged")
    assert again.ranges() == ledger.ranges() == [(0, 3), (7, 9)]
    assert again.last() == 9 and again.holds(2) and again.holds(9) and not again.holds(5)


def test_a_catalog_target_catches_up_in_chunks(spark, tmp_path):
    """No catalog with row-level changes is installed, so the statements are run on a table of files."""
    tables = sync.Tables(f"{tmp_path}/sync")
    for batch in range(5):
        sinks.write_staging(staging(spark, *[event(10 * batch + i, i) for i in range(3)]), tables.staging, batch)
    statements = []
    target = CatalogTarget(spark, "cat.db.person", statements.append)
    assert sync.catch_up(target, tables, NOW, chunk_rows=6) == 4
    assert len(statements) == 3 and all(s.startswith("MERGE WITH SCHEMA EVOLUTION INTO") for s in statements)
    assert Ledger(spark, tables.merged).ranges() == [(0, 4)]
    assert sync.catch_up(target, tables, NOW, chunk_rows=6) == 4 and len(statements) == 3
    # a chunk that fails leaves those before it merged
    failing = sync.Tables(f"{tmp_path}/failing")
    for batch in range(3):
        sinks.write_staging(staging(spark, event(batch, batch + 1)), failing.staging, batch)
    person = PersonTable(spark, failing.person)
    with pytest.raises(RuntimeError):
        sync.catch_up(Stubborn(person, 1), failing, NOW, chunk_rows=1)
    sync.catch_up(person, failing, NOW, chunk_rows=1)
    assert len(rows(person.read())) == 3 and Ledger(spark, failing.merged).ranges() == [(0, 2)]


def test_merge_statements_parse(spark):
    parser = spark._jsparkSession.sessionState().sqlParser()
    for mode in ("dead_letter", "apply"):
        sql = merge_into_sql("cat.db.person", "incoming", M.PERSON_COLUMNS, mode)
        parser.parsePlan(sql)
        assert ("had_delete" in sql) == (mode == "apply")
        assert sql.startswith("MERGE WITH SCHEMA EVOLUTION INTO")
    assert "modernized_only" not in merge_into_sql("t", "s", M.PERSON_COLUMNS)


@pytest.mark.parametrize("mode", ["dead_letter", "apply"])
def test_stream_in_small_batches_equals_one_batch(spark, dimension, sf_dir, tmp_path, mode):
    feed = T.change_feed(T.load(spark, sf_dir, "events"))
    feed.repartitionByRange(5, "offset").write.parquet(f"{tmp_path}/feed")
    source = {"format": "parquet", "path": f"{tmp_path}/feed", "max_files": 2}
    stream = changes.read_changes(spark, source, stream=True)
    sync.start_sync(stream, f"{tmp_path}/sync", dimension, lambda: NOW, mode, interval=None, parts=2).awaitTermination()
    tables = sync.Tables(f"{tmp_path}/sync")
    store = PersonTable(spark, tables.person)
    assert store.parts == 2 and Ledger(spark, tables.merged).ranges() == [(0, 2)]
    from changeloom.operators import decode as D

    decoded = D.decode(changes.read_changes(spark, source), dimension, mode, NOW)
    assert rows(store.read()) == rows(M.merge_first(D.staged(decoded), NOW, mode))
    staged = sinks.read_batches(spark, tables.staging, schemas.STAGING)
    assert staged.count() == D.staged(decoded).count()
    letters = sinks.read_batches(spark, tables.dead_letters, schemas.DEAD_LETTERS)
    assert letters.count() == D.dead_letters(decoded).count() + M.quarantined(D.staged(decoded), mode).count()
    log = sinks.EventLog(spark, tables.events).stored()
    assert log.where("stage = 'consumer.staged'").count() == staged.count()
    ids = sorted((r["id"], r["batch_id"], r["part"]) for r in log.select("id", "batch_id", "part").collect())
    assert [i for i, _, _ in ids] == list(range(1, len(ids) + 1)) and [r[1:] for r in ids] == sorted(r[1:] for r in ids)
    merges = [r["message"] for r in log.where("stage = 'dbt'").orderBy("id").collect()]
    assert len(merges) == 6 and merges[0] == "dbt run started" and " staged row(s) merged into person (" in merges[1]
    # started again with nothing new, and then with the merges lost: both end in the same table
    sync.start_sync(stream, f"{tmp_path}/sync", dimension, lambda: LATER, mode, interval=None).awaitTermination()
    assert Ledger(spark, tables.merged).last() == 2
    lost = sync.Tables(f"{tmp_path}/sync")
    lost.merged = f"{tmp_path}/again-merged"
    again = PersonTable(spark, f"{tmp_path}/again")
    assert sync.catch_up(again, lost, NOW, mode, chunk_rows=1) == 2
    assert rows(again.read()) == rows(store.read())
    assert sync.catch_up(again, lost, LATER, mode) == 2 and rows(again.read()) == rows(store.read())


def test_repeats_in_a_stream_are_dropped(spark, sf_dir, tmp_path):
    feed = T.change_feed(T.load(spark, sf_dir, "events").where("event_id < 200"))
    feed.unionByName(feed).repartition(3).write.parquet(f"{tmp_path}/feed")
    stream = changes.read_changes(spark, {"format": "parquet", "path": f"{tmp_path}/feed", "max_files": 1}, stream=True)
    query = M.dedupe_stream(stream, "60 days").writeStream.format("parquet").option("path", f"{tmp_path}/out").option(
        "checkpointLocation", f"{tmp_path}/checkpoint").trigger(availableNow=True).start()
    query.awaitTermination()
    assert spark.read.parquet(f"{tmp_path}/out").count() == 200


def log_events(spark, n, topic="t", partition=0, first=0, ts=NOW):
    rows_ = [(first + i, 1, topic, partition, ts, "cdc-consumer", "consumer.staged", "info", None, None, f"{topic} {i}", None) for i in range(n)]
    return spark.createDataFrame(rows_, schemas.EVENTS)


def test_a_failed_event_write_does_not_fail_the_batch(spark, tmp_path):
    (tmp_path / "events").write_text("a file where the folder should be")
    assert sinks.EventLog(spark, f"{tmp_path}/events").append(log_events(spark, 1), 0) is False


def test_event_ids_follow_arrival_for_any_topic_and_partition(spark, tmp_path):
    from changeloom.operators import serve

    log = sinks.EventLog(spark, f"{tmp_path}/events")
    many = [log_events(spark, 3, topic, partition, first=1000) for topic in ("a", "other") for partition in (0, 64, 65, 500)]
    for part in many[1:]:
        many[0] = many[0].unionByName(part)
    assert log.append(many[0], 0)
    seen = log.stored().agg({"id": "max"}).first()[0]
    assert seen == 24 and log.stored().select("id").distinct().count() == 24
    assert log.append(log_events(spark, 2, "late", 7, first=5), 1)  # arrives later, with lower offsets
    page = serve.event_page(log.read(NOW), since_id=seen).collect()
    assert [(r["id"], r["message"]) for r in page] == [(25, "late 0"), (26, "late 1")]
    assert log.append(log_events(spark, 2, "late", 7, first=5), 1)  # a repeated write takes the same numbers
    assert log.stored().count() == 26 and log.stored().agg({"id": "max"}).first()[0] == 26


def test_retention_keeps_the_newest_events_of_the_stored_log(spark, tmp_path):
    log = sinks.EventLog(spark, f"{tmp_path}/events")
    for batch in range(4):
        assert log.append(log_events(spark, 3000), batch)
    assert log.read(NOW).count() == 5000
    assert log.prune(NOW) == 2 and log.stored().count() == 6000
    log.append(log_events(spark, 3000), 4)
    assert log.prune(NOW) == 0 and log.prune(NOW + datetime.timedelta(seconds=61)) == 1
    assert log.read(NOW + datetime.timedelta(hours=25)).count() == 0


def test_a_failing_merge_is_logged_and_tried_again(spark, dimension, sf_dir, tmp_path):
    from changeloom.operators import activity

    events = T.load(spark, sf_dir, "events").where("event_id < 400")
    for half in T.halves(events):
        T.change_feed(half).coalesce(1).write.mode("append").parquet(f"{tmp_path}/feed")
    stream = changes.read_changes(spark, {"format": "parquet", "path": f"{tmp_path}/feed", "max_files": 1}, stream=True)
    target = Stubborn(PersonTable(spark, f"{tmp_path}/sync/person"), 2)
    pauses = []

    def start():
        return sync.start_sync(stream, f"{tmp_path}/sync", dimension, lambda: NOW, interval=None, target=target)

    with pytest.raises(Exception, match="is refused"):
        sync.keep_running(start, in_a_row=1, wait=pauses.append)
    first = {(r["topic"], r["offset"], r["stage"], r["id"]) for r in numbered_events(spark, tmp_path)}
    assert sync.keep_running(start, in_a_row=3, wait=pauses.append) == 3
    assert pauses == [activity.RETRY_DELAY] * 3
    log = sinks.EventLog(spark, f"{tmp_path}/sync/events").stored()
    counts = activity.retry_counts(log).collect()
    assert {(r["retries"], r["last_attempt"]) for r in counts} == {(2, 2)} and len({(r["topic"], r["offset"]) for r in counts}) == len(counts)
    assert log.select("id").distinct().count() == log.count()
    assert first <= {(r["topic"], r["offset"], r["stage"], r["id"]) for r in numbered_events(spark, tmp_path)}
    assert rows(target.target.read()) and Ledger(spark, f"{tmp_path}/sync/merged").ranges() == [(0, 1)]


def numbered_events(spark, tmp_path):
    log = sinks.EventLog(spark, f"{tmp_path}/sync/events").stored()
    places = F.from_json("detail", "topic STRING, partition INT, offset BIGINT")
    return log.where("stage = 'consumer.staged'").select(places["topic"].alias("topic"), places["offset"].alias("offset"), "stage", "id").collect()


def test_a_retried_part_keeps_its_ids_in_a_long_log(spark, tmp_path):
    log = sinks.EventLog(spark, f"{tmp_path}/events")
    warning = log_events(spark, 1, "warning")
    for attempt in (1, 2):
        assert log.append(log_events(spark, 6000), 0)  # more than retention keeps
        assert log.append(warning, 0, sinks.RETRY_PART + attempt)
    assert log.append(log_events(spark, 6000), 0)
    ids = {r["id"] for r in log.stored().where("message LIKE 'warning%'").collect()}
    assert ids == {6001, 6002} and log.retries(0) == 2
    kept = log.read(NOW)
    assert kept.where("message LIKE 'warning%'").count() == 2 and kept.count() == 5000
    assert log.append(log_events(spark, 6005), 0)  # more than before: they come anew, after the warnings
    assert log.stored().where("message LIKE 't %'").agg(F.min("id"), F.max("id")).first()[:] == (6003, 12007)
    assert log.stored().count() == log.stored().select("id").distinct().count() == 6007


def test_the_sync_drops_repeats_if_asked(spark, dimension, sf_dir, tmp_path):
    feed = T.change_feed(T.load(spark, sf_dir, "events").where("event_id < 200"))
    for _ in range(2):  # the repeats come in a later micro-batch
        feed.coalesce(1).write.mode("append").parquet(f"{tmp_path}/feed")
    stream = changes.read_changes(spark, {"format": "parquet", "path": f"{tmp_path}/feed", "max_files": 1}, stream=True)
    query = sync.start_sync(stream, f"{tmp_path}/sync", dimension, lambda: NOW, interval=None, repeats_within="60 days")
    query.awaitTermination()
    staged = sinks.read_batches(spark, f"{tmp_path}/sync/staging", schemas.STAGING)
    assert staged.count() == staged.select("topic", "partition", "offset").distinct().count() > 0
    assert query.lastProgress["stateOperators"][0]["numRowsTotal"] <= 200


def test_a_new_checkpoint_goes_on_after_the_last_batch(spark, dimension, sf_dir, tmp_path):
    events = T.load(spark, sf_dir, "events")
    T.change_feed(events.where("event_id < 300")).coalesce(1).write.parquet(f"{tmp_path}/feed")
    for number, now in enumerate((NOW, LATER)):
        stream = changes.read_changes(spark, {"format": "parquet", "path": f"{tmp_path}/feed"}, stream=True)
        sync.start_sync(stream, f"{tmp_path}/sync", dimension, lambda now=now: now, interval=None,
                        checkpoint=f"{tmp_path}/checkpoint-{number}").awaitTermination()
        T.change_feed(events.where("event_id >= 300 AND event_id < 500")).coalesce(1).write.mode("append").parquet(f"{tmp_path}/feed")
    staged = sinks.read_batches(spark, f"{tmp_path}/sync/staging", schemas.STAGING)
    assert sorted(r["batch_id"] for r in staged.select("batch_id").distinct().collect()) == [0, 1]
    person = PersonTable(spark, f"{tmp_path}/sync/person")
    assert Ledger(spark, f"{tmp_path}/sync/merged").last() == 1 and {r["synced_at"] for r in person.read().collect()} == {LATER}


def test_writing_a_batch_again_replaces_it(spark, tmp_path):
    for _ in range(2):
        sinks.write_staging(staging(spark, event(1), event(2)), f"{tmp_path}/staging", 3)
    sinks.write_staging(staging(spark, event(3)), f"{tmp_path}/staging", 4)
    table = sinks.read_batches(spark, f"{tmp_path}/staging", schemas.STAGING)
    assert sorted((r["batch_id"], r["offset"]) for r in table.collect()) == [(3, 1), (3, 2), (4, 3)]
    plan = M.unapplied(table, 3)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(batch_id" in plan


def test_snapshot_of_a_legacy_table_over_jdbc(spark, dimension, sf_dir):
    """An in-process Derby database, read in ranges of the id."""
    from changeloom.operators import decode as D

    legacy = T.legacy_source(T.load(spark, sf_dir, "customer"), "tenant_b1")
    url = "jdbc:derby:memory:changeloom;create=true"
    properties = {"driver": "org.apache.derby.jdbc.EmbeddedDriver"}
    try:
        legacy.write.jdbc(url, "person", mode="overwrite", properties=properties)
    except Exception as e:  # no Derby on this class path
        pytest.skip(f"no embedded database: {type(e).__name__}")
    table = changes.read_legacy(spark, url, "person", 0, 40, 3, properties)
    assert table.rdd.getNumPartitions() == 3
    names = {c.lower(): c for c in table.columns}
    table = table.select(*[F.col(names[c]).alias(c) for c in legacy.columns])
    feed = changes.snapshot_changes(table, "legacy_b1.public.person", F.lit(NOW))
    staged = D.staged(D.decode(feed, dimension))
    assert staged.count() == legacy.count()
    assert {r["operation"] for r in staged.collect()} == {"INSERT"}


def test_feed_options(spark):
    options = changes.kafka_options("host:9092", max_offsets=1000)
    assert options["startingOffsets"] == "earliest" and options["maxOffsetsPerTrigger"] == "1000"
    assert options["subscribe"].count(",") == 3
    with pytest.raises(ValueError):
        changes.read_changes(spark, {"format": "csv"})


def test_unify_fills_the_columns_of_the_other_family(spark, sf_dir):
    customer = T.load(spark, sf_dir, "customer")
    both = changes.unify([T.legacy_source(customer, "tenant_a1"), T.legacy_source(customer, "tenant_b2")])
    assert set(schemas.DATA_COLUMNS) <= set(both.columns)
    assert both.where("data_2 IS NOT NULL AND data_c IS NOT NULL").count() == 0


def test_work_folders_are_below_the_shared_folder(spark):
    shared = session.shared_folder(spark)
    configured = spark.conf.get("spark.checkpoint.dir", None)
    assert shared == (configured.rstrip("/") if configured else shared)
    assert session.fresh_folder(spark, "x").startswith(f"{shared}/x-")
