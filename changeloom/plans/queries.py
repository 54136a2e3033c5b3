"""The registered queries: each takes a session and a folder of sample tables and returns a DataFrame."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timedelta
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from changeloom import schemas, session
from changeloom.operators import activity as A
from changeloom.operators import checks as Q
from changeloom.operators import commands as C
from changeloom.operators import connectors as N
from changeloom.operators import decode as D
from changeloom.operators import digests as G
from changeloom.operators import merge as M
from changeloom.operators import ordered
from changeloom.operators import progress as P
from changeloom.operators import serve as R
from changeloom.plans import sync as Y
from changeloom.schemas import DATA_COLUMNS, KEY
from changeloom.sources import changes as S
from changeloom.sources import sinks
from changeloom.sources import tables as T
from changeloom.sources.store import PersonTable
from changeloom.streaming import connectors as stream_connectors
from changeloom.streaming import sync as stream_sync

Query = Callable[[SparkSession, str], DataFrame]

BATCH_SIZE = 1000
LAST_APPLIED = 4
# More ranges than keys with a difference, so that most ranges have none.
DIGEST_PARTS = 1 << 16
# Longer than the sample feed lasts.
REPEATS_WITHIN = "400 days"
STATUS_NOW = datetime(2024, 1, 30, 12, 0, 0)
PRUNE_NOW = datetime(2024, 1, 16, 0, 0, 0)


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.load(spark, sf_dir, "events")


def _messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.load_spread(spark, sf_dir, "events", "event_id")


def _decoded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Y.decoded_events(spark, _messages(spark, sf_dir))


def _batched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The staged events in batches of consecutive offsets."""
    staged = D.staged(_decoded(spark, sf_dir))
    return staged.withColumn("batch_id", F.floor(F.col("offset") / BATCH_SIZE).cast("bigint"))


# --- decode ---

def decode_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return D.staged(D.decode(T.change_feed(_messages(spark, sf_dir)), schemas.tenants(spark), staged_at=Y.FIRST_SYNC))


def dead_letters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return D.dead_letters(_decoded(spark, sf_dir))


def dropped_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return D.dropped(_decoded(spark, sf_dir))


def outcome_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return D.outcome_counts(_decoded(spark, sf_dir)).withColumn("reason", F.coalesce("reason", F.lit("")))


def deleted_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return D.deleted_ids(D.dead_letters(_decoded(spark, sf_dir)))


def backfill_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Y.backfill(spark, sf_dir)


# --- merge ---

def snapshot_cutover(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A snapshot that was read after a quarter of the feed, merged after the first half of it; then the rest."""
    low = _events(spark, sf_dir).agg(F.floor(F.count("*") / 4).cast("bigint")).scalar()
    first, second = (Y.staged_events(spark, half) for half in T.message_halves(spark, sf_dir))
    chunk = S.unchanged_since(Y.backfill(spark, sf_dir), first, low)
    person = M.merge(M.merge_first(first, Y.FIRST_SYNC), chunk, Y.FIRST_SYNC)
    return M.merge(person, second, Y.SECOND_SYNC)


def snapshot_and_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A snapshot and the whole feed in one batch: the log wins."""
    log = Y.staged_events(spark, _messages(spark, sf_dir))
    return M.merge_first(Y.backfill(spark, sf_dir).unionByName(log), Y.FIRST_SYNC)


def merge_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Y.person_in_one_batch(spark, sf_dir)


def merge_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Y.person_after_both(spark, sf_dir)


def merge_apply_deletes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Y.person_after_both(spark, sf_dir, "apply")


def merge_unapplied(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The incremental filter: only the batches after the last applied one are merged."""
    waiting = M.unapplied(_batched(spark, sf_dir), LAST_APPLIED).drop("batch_id")
    return M.merge_first(waiting, Y.FIRST_SYNC)


def merge_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.quarantined(D.staged(_decoded(spark, sf_dir))).drop("raw_value")


def preserve_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The latest second-half row of each key with the target-only column of the first half's target."""
    _, second = T.message_halves(spark, sf_dir)
    target = Y.patch_tenth(Y.person_after_first(spark, sf_dir))
    latest = M.map_columns(M.latest_per_key(M.accepted(Y.staged_events(spark, second))))
    return M.preserve_join(latest, target).select(*KEY, "firstname", "extra_field", "modernized_only")


def merge_survivors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Target rows whose key has no quarantined event."""
    refused = _batched(spark, sf_dir).where(F.col("firstname").isNull())
    target = Y.person_in_one_batch(spark, sf_dir)
    return M.survivors(target, M.affected_keys(refused)).select(*KEY, "firstname", "created_at")


def affected_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The keys of each merged batch, one row per staged event."""
    batches = _batched(spark, sf_dir)
    return M.affected_keys(batches, ["batch_id"])


def evolve_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second batch brings a column that the target does not have yet."""
    _, second = T.message_halves(spark, sf_dir)
    wider = Y.staged_events(spark, second).withColumn("nickname", F.upper("firstname"))
    return M.merge(Y.person_after_first(spark, sf_dir), wider, Y.SECOND_SYNC)


def latest_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = T.load(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate")
    order = [F.col(c).desc() for c in ("l_shipdate", "l_partkey", "l_suppkey")]
    return M.latest_by_window(lines, ["l_orderkey", "l_linenumber"], order)


def _replayed(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The target after one run over the feed, and after a second run over all of it that also brings marker rows."""
    staged = session.written(D.staged(_decoded(spark, sf_dir)), "replay-staged")
    markers = staged.where(F.col("firstname") == "purchase").withColumns({
        "source_id": (F.lit(1000000) + F.col("offset")).cast("int"),
        "surname": F.concat("surname", F.lit(Q.MARKER_SUFFIX)),
    })
    once = session.written(M.merge_first(staged, Y.FIRST_SYNC), "replay-once")
    return once, session.written(M.merge(once, staged.unionByName(markers), Y.SECOND_SYNC), "replay-again")


def replay_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A replay of every event: rows before and after, and the differences that are not marker rows."""
    once, again = _replayed(spark, sf_dir)

    def count(df: DataFrame, expr=F.count("*")):
        return df.agg(expr.alias("n")).scalar().cast("bigint")

    return spark.range(1).select(
        count(once).alias("rows_before"),
        count(again).alias("rows_after"),
        count(Q.snapshot_diff(once, again), F.coalesce(F.sum("copies"), F.lit(0))).alias("differences"),
    )


def replay_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A feed that holds every message twice, appended once per log position."""
    staged = D.staged(_decoded(spark, sf_dir))
    return M.dedupe_log(staged.unionByName(staged)).groupBy("tenant_id").agg(F.count("*").alias("staged"))


def snapshot_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.snapshot_diff(Y.person_after_first(spark, sf_dir), Y.person_after_both(spark, sf_dir))


def snapshot_diff_digests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same from tables on files, by digests of key ranges."""
    before = session.written(Y.person_after_first(spark, sf_dir), "diff-before")
    after = session.written(Y.person_after_both(spark, sf_dir), "diff-after")
    return G.snapshot_diff(before, after, DIGEST_PARTS)


# --- aggregates ---

def tenant_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.count_by_tenant(Y.person_in_one_batch(spark, sf_dir))


def layer_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    decoded = _decoded(spark, sf_dir).select("outcome", *D.STAGING_COLUMNS)
    once = session.written(decoded.where(F.col("outcome") != D.DROPPED), "layers")
    staged = once.where(F.col("outcome") == D.STAGED)
    return R.layer_counts({
        "legacy": Y.legacy(spark, sf_dir),
        "staging": staged,
        "dead_letter": once.where(F.col("outcome") == D.DEAD_LETTER),
        "person": M.merge_first(staged.drop("outcome"), Y.FIRST_SYNC),
    })


def prefix_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.prefix_counts(Y.person_in_one_batch(spark, sf_dir), "firstname", ["s", "v", "purch", "zz"])


def duplicate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.duplicate_keys(T.load(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


def staging_backlog(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.staging_counts(_batched(spark, sf_dir), LAST_APPLIED)


# --- checks ---

def missing_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.missing_keys(Y.legacy(spark, sf_dir), Y.person_in_one_batch(spark, sf_dir))


def _faulty_target(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, list[str]]:
    """Source rows, a target with lost, changed and invented rows, and the columns that both have."""
    source = Y.legacy(spark, sf_dir).withColumn("extra_field", F.coalesce("data_2", "data_c"))
    person = Y.person_from_backfill(spark, sf_dir)
    kept = person.where(F.col("legacy_id") % 17 != 0).withColumns({
        "city": F.when(F.col("legacy_id") % 19 == 0, F.lit(None)).otherwise(F.col("city")),
        "extra_field": F.when(F.col("legacy_id") % 13 == 0, F.lit("x")).otherwise(F.col("extra_field")),
    })
    invented = person.where(F.col("legacy_id") % 23 == 0).withColumn(
        "legacy_id", F.col("legacy_id") + F.lit(10000000))
    return source, kept.unionByName(invented), ["firstname", "surname", "date_of_birth", "city", "extra_field"]


def reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Source rows against a target with lost, changed and invented rows."""
    return Q.reconcile(*_faulty_target(spark, sf_dir))


def reconcile_digests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The keys that are not equal, by digests of key ranges."""
    source, person, columns = _faulty_target(spark, sf_dir)
    pair = (session.written(df.select(*KEY, *columns), "reconcile-side") for df in (source, person))
    return G.reconcile(*pair, columns, DIGEST_PARTS)


def _faulty(person: DataFrame) -> DataFrame:
    """A target with one kind of fault per check."""
    twice = person.where(F.col("legacy_id") % 107 == 5)
    bad = person.where(F.col("legacy_id") % 7 != 6).withColumns({
        "tenant_id": F.when(F.col("legacy_id") % 101 == 1, F.lit("tenant_bad")).when(
            F.col("legacy_id") % 101 == 2, F.lit(None)).otherwise(F.col("tenant_id")),
        "firstname": F.when(F.col("legacy_id") % 103 == 3, F.lit(None)).otherwise(F.col("firstname")),
    })
    return bad.unionByName(twice)


def quality_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    person = session.written(Y.person_from_backfill(spark, sf_dir), "quality-person")
    faulty = session.written(_faulty(person), "quality-faulty")
    return Q.quality_report(faulty, Y.legacy(spark, sf_dir), person, faulty)


def check_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Passed, failed and skipped checks over a sound target and a faulty one."""
    person = session.written(Y.person_from_backfill(spark, sf_dir), "summary-person")
    faulty = session.written(_faulty(person), "summary-faulty")
    tenant_ids = [t for _, t, _ in schemas.TENANTS]
    results = Q.report(
        Q.column_checks(person, tenant_ids), Q.key_checks(person),
        Q.column_checks(faulty, tenant_ids), Q.key_checks(faulty),
        Q.skipped(Q.arrival_check(Y.legacy(spark, sf_dir), person)),
    )
    return Q.summary(results)


def shared_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids that several tenants use: each tenant has its own person."""
    per_key = Y.person_in_one_batch(spark, sf_dir).groupBy(*KEY).agg(F.count("*").alias("n"))
    return per_key.groupBy("legacy_id").agg(
        F.count("*").alias("tenants"), F.sum("n").alias("persons")).where(F.col("tenants") > 1)


# --- write commands ---

def commands_validate(spark: SparkSession, sf_dir: str) -> DataFrame:
    valid = C.validate(Y.commands(spark, sf_dir), schemas.tenants(spark))
    return valid.select("seq", "kind", "status", F.coalesce("reason", F.lit("")).alias("reason"))


def commands_resolve(spark: SparkSession, sf_dir: str) -> DataFrame:
    resolved = C.resolve(Y.legacy(spark, sf_dir), Y.commands(spark, sf_dir), schemas.tenants(spark))
    return resolved.select("seq", "kind", "status", F.coalesce("reason", F.lit("")).alias("reason"))


def _creates(spark: SparkSession, sf_dir: str, kind: str) -> DataFrame:
    chosen = Y.commands(spark, sf_dir).where(F.col("kind") == kind)
    return C.route_creates(C.validate(chosen, schemas.tenants(spark)))


def commands_create(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _creates(spark, sf_dir, "create")


def commands_legacy_create(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _creates(spark, sf_dir, "legacy_create")


def _applied(spark: SparkSession, sf_dir: str, kinds: list[str]) -> DataFrame:
    chosen = Y.commands(spark, sf_dir).where(F.col("kind").isin(kinds))
    return C.apply(Y.legacy(spark, sf_dir), chosen, schemas.tenants(spark))


def commands_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _applied(spark, sf_dir, ["update"])


def commands_legacy_patch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _applied(spark, sf_dir, ["legacy_update"])


def commands_apply(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _applied(spark, sf_dir, [*C.CREATES, *C.UPDATES])


def patch_target_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.patch_target_only(
        Y.person_from_backfill(spark, sf_dir), Y.commands(spark, sf_dir), schemas.tenants(spark))


def command_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Y.command_staging(spark, sf_dir).drop("source_table", "message_time", "created_at")


def command_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Commands, their change messages, and the target after those were merged."""
    return M.merge(Y.person_from_backfill(spark, sf_dir), Y.command_staging(spark, sf_dir), Y.SECOND_SYNC)


def tenant_isolation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Updates of one tenant only, and the rows per tenant that they changed."""
    before = Y.legacy(spark, sf_dir)
    chosen = Y.commands(spark, sf_dir).where((F.col("kind") == "update") & (F.col("tenant_id") == "tenant_a1"))
    after = C.apply(before, chosen, schemas.tenants(spark))
    columns = ["firstname", "surname", "date_of_birth", "city", *DATA_COLUMNS]
    return Q.reconcile(before, after, columns).groupBy("tenant_id").agg(
        F.count("*").alias("persons"), F.count_if(F.col("status") != "equal").alias("changed"))


# --- serving ---

def tenant_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tenants that the dimension lists, with whether the feed has brought anything from each."""
    dimension = schemas.tenants(spark)
    heard = T.change_feed(_events(spark, sf_dir)).groupBy("topic").agg(F.count("*").alias("messages"))
    by_tenant = heard.join(dimension, "topic").select("tenant_id", "messages")
    return R.tenant_list(dimension).join(by_tenant, "tenant_id", "left").select(
        "tenant_id", F.coalesce("messages", F.lit(0)).alias("messages"))


def person_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.person_list(Y.person_after_both(spark, sf_dir))


def legacy_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.legacy_list(Y.legacy(spark, sf_dir), "tenant_b1")


def legacy_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One lookup per order; every tenth asks for an id that does not exist."""
    orders = T.load(spark, sf_dir, "orders")
    asked = orders.select(
        F.col("o_orderkey").alias("request"),
        T.by_index(F.col("o_custkey") % 4, T.TENANT_IDS).alias("tenant_id"),
        (T.div("o_custkey", 4) + F.when(T.every("o_orderkey", 10), 1000000).otherwise(0)).cast("int").alias("legacy_id"),
    )
    found = R.legacy_lookup(asked, Y.legacy(spark, sf_dir))
    return found.select("request", *KEY, "found", "surname", "city")


def existing_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.existing(Y.legacy(spark, sf_dir).select(*KEY), Y.person_in_one_batch(spark, sf_dir))


def person_find(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = R.find(Y.person_in_one_batch(spark, sf_dir), prefix="p", tenant_id="tenant_a2")
    return found.select(*KEY, "firstname", "surname", "extra_field")


def latest_staged(spark: SparkSession, sf_dir: str) -> DataFrame:
    newest = R.latest(D.staged(_decoded(spark, sf_dir)), "created_at", 5, ["topic", "offset"])
    return newest.select("tenant_id", "source_id", "firstname", "surname", *DATA_COLUMNS, "created_at")


def latest_synced(spark: SparkSession, sf_dir: str) -> DataFrame:
    newest = R.latest(Y.person_after_both(spark, sf_dir), "synced_at", 5, KEY)
    return newest.select(*KEY, "firstname", "surname", "extra_field", "synced_at")


def event_feed_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.event_page(T.activity_log(_events(spark, sf_dir)))


def event_feed_since(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = T.activity_log(_events(spark, sf_dir))
    return R.event_page(log, since_id=1000, limit=100, severities=["warn", "error"], tenant_id="tenant_b1")


def event_feed_own(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page of the engine's own log: what came after the events of the first half of the feed."""
    halves = T.message_halves(spark, sf_dir)
    first, second = (session.written(A.consumer_events(Y.decoded_events(spark, half)), "own-events") for half in halves)
    early = A.number(first)
    seen = early.agg(F.max("id")).first()[0] or 0  # the reader's place, one number
    return R.event_page(early.unionByName(A.number(second, seen)), since_id=seen, limit=300)


def event_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = T.activity_log(_events(spark, sf_dir))
    return R.event_search(log, "USER 1", severities=["error", "info"], tenant_id="tenant_a2")


def system_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    batch = F.floor(F.col("offset") / BATCH_SIZE).cast("bigint").alias("batch_id")
    once = session.written(_decoded(spark, sf_dir).select("outcome", batch), "status")
    return R.status(
        spark, STATUS_NOW, once.where(F.col("outcome") == D.STAGED), once.where(F.col("outcome") == D.DEAD_LETTER),
        T.activity_log(_events(spark, sf_dir)), LAST_APPLIED)


def status_by_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The status after the log was written in four parts: from the row that each part has, and the parts that a limit cuts."""
    log = sinks.EventLog(spark, session.fresh_folder(spark, "status-log"))
    dimension = schemas.tenants(spark)
    batch = F.floor(F.col("offset") / BATCH_SIZE).cast("bigint").alias("batch_id")
    outcomes = []
    for number, half in enumerate(T.halves(_messages(spark, sf_dir))):
        decoded = session.written(D.decode(T.change_feed(half), dimension), "status-decoded")
        events = A.consumer_events(decoded)
        middle = events.agg(F.floor((F.min("position") + F.max("position")) / 2)).scalar()
        for part, some in enumerate((events.where(F.col("position") < middle), events.where(F.col("position") >= middle))):
            log.append(some, number, part)
        outcomes.append(decoded.select("outcome", batch))
    once = reduce(DataFrame.unionByName, outcomes)
    return R.status(
        spark, PRUNE_NOW, once.where(F.col("outcome") == D.STAGED), once.where(F.col("outcome") == D.DEAD_LETTER), None,
        LAST_APPLIED, A.log_counts_by_parts(log.parts(), log.stored(), PRUNE_NOW))


# --- progress ---

def topic_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _events(spark, sf_dir)
    first, _ = T.halves(events)
    # every message has an outcome, so the raw offsets say how far the decode has come
    return P.topic_progress(T.change_feed(events), T.change_feed(first))


def barrier_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every message is a marker; half of the feed was handled."""
    events = _events(spark, sf_dir)
    first, _ = T.halves(events)
    markers = T.change_feed(events).where(F.col("topic") != T.OTHER_TOPIC).select(
        "topic", "partition", F.col("offset").alias("marker_offset"))
    return P.barrier(markers, T.change_feed(first))


def barrier_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every message is a marker; half of the feed was handled, but for some messages of its second half."""
    events = _events(spark, sf_dir)
    first, _ = T.halves(events)
    quarter = events.agg(F.floor(F.count("*") / 4).cast("bigint")).scalar()
    feed = T.change_feed(events).where(F.col("topic") != T.OTHER_TOPIC)
    handled = T.change_feed(first).where((F.col("offset") % 89 != 17) | (F.col("offset") < quarter))
    markers = feed.select("topic", "partition", F.col("offset").alias("marker_offset"))
    return P.barrier(markers, handled, feed)


def quiet_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Old messages that were staged one second per batch from FIRST_SYNC on: while they wait, when all are merged, and
    when nothing was staged for a while as well."""
    staged_at = F.lit(Y.FIRST_SYNC).cast("timestamp_ntz") + F.make_interval(secs=F.col("batch_id"))
    staged = session.written(_batched(spark, sf_dir).withColumn("created_at", staged_at).select("batch_id", "created_at"), "quiet")
    last, newest = staged.agg(F.max("batch_id"), F.max("created_at")).first()
    cases = {"waiting": (LAST_APPLIED, 60), "just merged": (last, 5), "settled": (last, 15)}
    checks = [P.quiet(staged, applied, newest + timedelta(seconds=after), 8).withColumn("state", F.lit(name))
              for name, (applied, after) in cases.items()]
    return reduce(DataFrame.unionByName, checks)


def sync_lag(spark: SparkSession, sf_dir: str) -> DataFrame:
    decoded = session.written(D.staged(_decoded(spark, sf_dir)), "lag-staged")
    writes = M.latest_per_key(M.accepted(decoded)).select(
        "tenant_id", F.col("source_id").alias("legacy_id"), F.col("created_at").alias("written_at"))
    middle = T.load(spark, sf_dir, "events").agg(F.floor(F.count("*") / 2).cast("bigint")).scalar()
    first = M.merge_first(decoded.where(F.col("offset") < middle), Y.FIRST_SYNC)
    both = M.merge(first, decoded.where(F.col("offset") >= middle), Y.SECOND_SYNC)
    return P.sync_lag(writes, both)


# --- connectors ---

def _polls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.connector_polls(_events(spark, sf_dir))


def state_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return N.state_changes(_polls(spark, sf_dir))


def current_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    return N.current_state(_polls(spark, sf_dir))


def connector_readiness(spark: SparkSession, sf_dir: str) -> DataFrame:
    return N.readiness(_polls(spark, sf_dir))


def restart_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    return N.restart_list(_polls(spark, sf_dir))


# --- activity ---

def prune_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.prune(T.activity_log(_events(spark, sf_dir)), PRUNE_NOW)


def _own_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The consumer's events, written once: numbering them reads them twice."""
    return session.written(A.consumer_events(_decoded(spark, sf_dir)), "own-events")


def prune_own_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Retention of the engine's own log."""
    return A.prune(session.written(A.number(_own_events(spark, sf_dir)), "own-log"), PRUNE_NOW)


def event_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.number(_own_events(spark, sf_dir))


def command_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    resolved = C.resolve(Y.legacy(spark, sf_dir), Y.commands(spark, sf_dir), schemas.tenants(spark))
    return A.number(session.written(A.command_events(resolved, F.col("written_at")), "command-events")).drop("detail")


def connector_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = A.connector_events(N.state_changes(_polls(spark, sf_dir)), F.lit(Y.FIRST_SYNC))
    return A.number(session.written(events, "connector-events"))


def record_journey(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The way of every record that a command wrote, in batches of commands.

    In every fifth batch the events of the write path come after those of the consumer, which then are out of order; and
    the first half of the batches is merged, every seventh of them before its events were logged.
    """
    dimension = schemas.tenants(spark)
    resolved = session.written(C.resolve(Y.legacy(spark, sf_dir), Y.commands(spark, sf_dir), dimension), "journey-commands")
    decoded = D.decode(Y.command_changes(spark, sf_dir), dimension)
    batch = T.div("position", BATCH_SIZE).alias("batch_id")
    columns = ["position", "step", "topic", "stage", "tenant_id", "legacy_id"]
    written = A.command_events(resolved, F.col("written_at")).select(*columns).withColumn("batch_id", batch)
    # Written once: numbering the log reads it twice, and each time all messages would be made and parsed.
    consumed = session.written(A.consumer_events(decoded).select(*columns), "journey-events").withColumn("batch_id", batch)
    batches = resolved.where("status = 'applied'").select(T.div("seq", BATCH_SIZE).alias("batch_id")).distinct()
    half = batches.agg(F.floor(F.max("batch_id") / 2)).scalar()
    merged = batches.where(F.col("batch_id") <= half)
    late = F.when(F.col("batch_id") % 5 == 4, 2).otherwise(0)
    early = F.when(F.col("batch_id") % 7 == 6, -1).otherwise(3)
    turn = F.col("batch_id") * 8 + 2
    arrivals = [written.withColumn("turn", turn + late), consumed.withColumn("turn", turn + 1),
                merged.select(F.lit(0).cast("bigint").alias("position"), F.lit(A.MERGE_STEP).alias("step"), F.lit(A.MERGE_STAGE).alias("stage"),
                              "batch_id", (turn + early).alias("turn"))]
    log = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), arrivals)
    numbered = session.written(ordered.numbered(log, "turn", ["position", "step", "topic"], width=8), "journey-log")
    return A.record_journey(numbered, numbered.where(F.col("stage") == A.MERGE_STAGE).select("batch_id", "id"))


def retry_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The failed attempts in a log whose batches, one per half of the feed, were each tried three times.

    Each attempt writes the events of its batch again, which keep the ids that they got first.
    """
    log = sinks.EventLog(spark, session.fresh_folder(spark, "retries"))
    dimension = schemas.tenants(spark)
    for number, half in enumerate(T.halves(_messages(spark, sf_dir))):
        feed = T.change_feed(half)
        consumed = session.written(A.consumer_events(D.decode(feed, dimension)), "retried-events")
        for attempt in range(1, 4):
            log.append(consumed, number)
            if attempt < 3:
                log.append(A.retry_events(A.failures_of(feed, dimension, attempt, Y.FIRST_SYNC)), number, sinks.RETRY_PART + attempt)
    return A.retry_counts(log.stored())


def batch_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.batch_summary(session.written(_batched(spark, sf_dir), "summary"), F.lit("0.5"))


# --- streaming ---

def stream_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sync as a stream over files: half of the feed, a target-only write, and the rest after a restart."""
    folder = session.fresh_folder(spark, "stream-merge")
    source = f"{folder}/feed"
    store = PersonTable(spark, f"{folder}/sync/person")
    halves = T.halves(_events(spark, sf_dir))
    for number, (half, now) in enumerate(zip(halves, (Y.FIRST_SYNC, Y.SECOND_SYNC))):
        T.change_feed(half).write.mode("append").parquet(source)
        feed = S.read_changes(spark, {"format": "parquet", "path": source}, stream=True)
        query = stream_sync.start_sync(feed, f"{folder}/sync", clock=lambda now=now: now, interval=None)
        query.awaitTermination()
        if number == 0:
            store.patch(Y.patch_tenth)
    return store.read()


def stream_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Half of the feed, a target-only write, and then a new checkpoint on the same tables, which reads all of it."""
    folder = session.fresh_folder(spark, "stream-replay")
    source = f"{folder}/feed"
    store = PersonTable(spark, f"{folder}/sync/person")
    for number, (half, now) in enumerate(zip(T.halves(_events(spark, sf_dir)), (Y.FIRST_SYNC, Y.SECOND_SYNC))):
        T.change_feed(half).write.mode("append").parquet(source)
        feed = S.read_changes(spark, {"format": "parquet", "path": source}, stream=True)
        stream_sync.start_sync(feed, f"{folder}/sync", clock=lambda now=now: now, interval=None,
                               checkpoint=f"{folder}/checkpoint-{number}").awaitTermination()
        if number == 0:
            store.patch(Y.patch_tenth)
    staged = sinks.read_batches(spark, f"{folder}/sync/staging", schemas.STAGING).agg(F.count("*").alias("n")).scalar()
    return store.read().select(*KEY, "firstname", "surname", "extra_field", "modernized_only", staged.alias("staged"))


def stream_state_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Connector monitoring as a stream over files, in two runs; the state survives the restart."""
    folder = session.fresh_folder(spark, "stream-monitor")
    source = f"{folder}/polls"
    for half in T.halves(_events(spark, sf_dir)):
        T.connector_polls(half).select(*stream_connectors.POLLS.names).write.mode("append").parquet(source)
        polls = spark.readStream.schema(stream_connectors.POLLS).parquet(source)
        stream_connectors.start_monitor(polls, f"{folder}/monitor", interval=None).awaitTermination()
    return sinks.read_batches(spark, f"{folder}/monitor/changes", stream_connectors.STATE_CHANGES).drop("batch_id")


def stream_late_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reports of some names come a whole run after the later polls of all other names."""
    folder = session.fresh_folder(spark, "stream-late-names")
    source = f"{folder}/polls"
    polls = _polls(spark, sf_dir).where("reachable").select(*stream_connectors.POLLS.names)
    behind = F.col("name").cast("int") % 3 == 0
    for part in (polls.where(~behind), polls.where(behind)):
        part.write.mode("append").parquet(source)
        feed = spark.readStream.schema(stream_connectors.POLLS).parquet(source)
        stream_connectors.start_monitor(feed, f"{folder}/monitor", interval=None).awaitTermination()
    return sinks.read_batches(spark, f"{folder}/monitor/changes", stream_connectors.STATE_CHANGES).drop("batch_id")


def stream_lag(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lag of a sync that has handled half of the feed, from the offsets that its batches recorded."""
    folder = session.fresh_folder(spark, "stream-lag")
    events = _events(spark, sf_dir)
    T.change_feed(T.halves(events)[0]).write.parquet(f"{folder}/feed")
    feed = S.read_changes(spark, {"format": "parquet", "path": f"{folder}/feed"}, stream=True)
    stream_sync.start_sync(feed, f"{folder}/sync", clock=lambda: Y.FIRST_SYNC, interval=None).awaitTermination()
    return stream_sync.lag(spark, stream_sync.Tables(f"{folder}/sync"), T.change_feed(events))


def stream_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every message comes twice, the second time after a restart, to a sync that drops repeats: what was staged and
    dead-lettered."""
    folder = session.fresh_folder(spark, "stream-repeats")
    for _ in range(2):
        T.change_feed(_events(spark, sf_dir)).write.mode("append").parquet(f"{folder}/feed")
        feed = S.read_changes(spark, {"format": "parquet", "path": f"{folder}/feed"}, stream=True)
        stream_sync.start_sync(feed, f"{folder}/sync", clock=lambda: Y.FIRST_SYNC, interval=None,
                               repeats_within=REPEATS_WITHIN).awaitTermination()
    tables = stream_sync.Tables(f"{folder}/sync")
    layers = {"staging": sinks.read_batches(spark, tables.staging, schemas.STAGING),
              "dead_letter": sinks.read_batches(spark, tables.dead_letters, schemas.DEAD_LETTERS)}
    return R.layer_counts(layers)


def catch_up_backlog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Staged batches of which none was merged, merged in chunks of a few batches; a second run finds nothing to do."""
    folder = session.fresh_folder(spark, "catch-up")
    tables = stream_sync.Tables(folder)
    target = PersonTable(spark, tables.person)
    staged = session.written(_batched(spark, sf_dir), "backlog")
    size = T.div("batch_id", 4)
    staged.withColumn("batch_id", size).select(*[f.name for f in schemas.STAGING], "batch_id").write.partitionBy("batch_id").parquet(tables.staging)
    rows = staged.count()
    last = 0
    for _ in range(2):
        last = stream_sync.catch_up(target, tables, Y.FIRST_SYNC, chunk_rows=max(1, rows // 3))
    return target.read().select(*KEY, "firstname", "surname", "extra_field", "synced_at", F.lit(last).cast("bigint").alias("last_batch"))


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        decode_changes, dead_letters, dropped_messages, outcome_counts, deleted_ids, backfill_snapshot, snapshot_cutover, snapshot_and_log,
        merge_first, merge_incremental, merge_apply_deletes, merge_unapplied, merge_quarantine, preserve_join,
        merge_survivors, affected_keys, evolve_schema, latest_window, replay_diff, replay_dedup, snapshot_diff, snapshot_diff_digests,
        tenant_counts, layer_counts, prefix_counts, duplicate_keys, staging_backlog,
        missing_keys, reconcile, reconcile_digests, quality_report, check_summary, shared_ids,
        commands_validate, commands_resolve, commands_create, commands_legacy_create, commands_update,
        commands_legacy_patch, commands_apply, patch_target_only, command_changes, command_roundtrip,
        tenant_isolation,
        tenant_list, person_list, legacy_list, legacy_lookup, existing_keys, person_find, latest_staged,
        latest_synced, event_feed_first, event_feed_since, event_feed_own, event_search, system_status, status_by_parts,
        topic_progress, barrier_check, barrier_gaps, quiet_check, sync_lag,
        state_changes, current_state, connector_readiness, restart_list,
        prune_events, prune_own_log, event_log, command_log, connector_log, record_journey, retry_counts, batch_summary,
        stream_merge, stream_replay, stream_state_changes, stream_late_names,
        stream_lag, stream_repeats, catch_up_backlog,
    )
}
