"""The activity log: events per stage, their numbers, retention, batch summaries, retry counts and record journeys.

Operators make events without an id: with their place among the events of a batch (position, step, topic, partition).
`number` gives them ids that follow those already in the log, so that ids grow in the order of arrival and have no gaps
to speak of; retention by id distance and paging by id rely on both.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from changeloom import schemas
from changeloom.operators.ordered import SLICE_WIDTH, numbered

API_STEP, TARGET_ONLY_STEP, RECEIVED_STEP, RETRY_STEP, STAGED_STEP, DEAD_LETTER_STEP, MERGE_STEP, CONNECTOR_STEP = range(8)
STAGES = ("api", "consumer.received", "consumer.staged")

# Retention of the log, the pause before a message is retried, and the name of the merge in the log.
MAX_AGE = "24 HOURS"
MAX_ROWS = 5000
RETRY_DELAY = 5
MERGE_STAGE = "dbt"

COLUMNS = [f.name for f in schemas.EVENT_LOG]
EVENT_COLUMNS = [f.name for f in schemas.EVENTS]


def _detail(*columns) -> Column:
    return F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})


def number(events: DataFrame, after: int = 0, width: int = SLICE_WIDTH) -> DataFrame:
    """Events as rows of the log; `after` is the newest id that the log holds already."""
    return numbered(events, "position", ["step", "topic", "partition", "message"], after, width).select(*COLUMNS)


def consumer_events(decoded: DataFrame) -> DataFrame:
    """What the consumer reports for each message: received and then staged, or a dead letter.

    A message that was understood but then refused is reported as received too. The events of a message come from one
    `inline`, so the decode runs once.
    """
    record = "concat(tenant_id, ' person#', coalesce(id_text, 'None'), ' ', operation)"
    keep_nulls = "map('ignoreNullFields', 'false')"
    where = f"to_json(struct(operation, topic, partition, offset), {keep_nulls})"
    raw = "make_valid_utf8(CAST(value AS STRING)) AS raw_value"

    def event(step: int, stage: str, severity: str, legacy_id: str, message: str, detail: str) -> str:
        return f"""named_struct('position', offset, 'step', {step}, 'topic', topic, 'partition', partition, 'ts', created_at, 'source', 'cdc-consumer', 'stage', '{stage}',
            'severity', '{severity}', 'tenant_id', tenant_id, 'legacy_id', {legacy_id}, 'message', {message},
            'detail', {detail})"""

    received = event(
        RECEIVED_STEP, "consumer.received", "info", "source_id",
        f"concat({record}, ' change captured from legacy via Kafka (', topic, ')')", where)
    staged = event(
        STAGED_STEP, "consumer.staged", "info", "source_id",
        f"concat({record}, ' staged in new system (person_staging)')", where)
    letter = event(
        DEAD_LETTER_STEP, "consumer.dead_letter", "error", "CAST(NULL AS INT)",
        "concat('dead-lettered ', topic, '@', offset, ': ', error)",
        f"to_json(struct(topic, partition, offset, error, {raw}), {keep_nulls})")
    return decoded.where("outcome <> 'dropped'").selectExpr(f"""inline(array_compact(array(
        CASE WHEN received THEN {received} END,
        CASE WHEN outcome = 'staged' THEN {staged} END,
        CASE WHEN outcome = 'dead_letter' THEN {letter} END)))""")


def retry_events(failures: DataFrame) -> DataFrame:
    """One warning per failed attempt; input: topic, partition, offset, attempt, ts, tenant_id."""
    message = F.format_string(
        f"%s@%d not staged, retrying in {RETRY_DELAY}s (attempt %d)", "topic", "offset", "attempt")
    return failures.select(
        F.col("offset").alias("position"), F.lit(RETRY_STEP).alias("step"), "topic", "partition", "ts",
        F.lit("cdc-consumer").alias("source"), F.lit("consumer.retry").alias("stage"),
        F.lit("warn").alias("severity"), "tenant_id", F.lit(None).cast("int").alias("legacy_id"),
        message.alias("message"), _detail("topic", "partition", "offset", "attempt").alias("detail"),
    )


def retry_counts(log: DataFrame) -> DataFrame:
    """Failed attempts per message, read back from the log."""
    detail = F.from_json("detail", "topic STRING, partition INT, offset BIGINT, attempt INT")
    return (
        log.where(F.col("stage") == "consumer.retry")
        .withColumn("d", detail)
        .groupBy("d.topic", "d.partition", "d.offset")
        .agg(F.count("*").alias("retries"), F.max("d.attempt").alias("last_attempt"))
    )


def command_events(resolved: DataFrame, ts: Column) -> DataFrame:
    """What the write path reports per command: written, rejected (a warning), and the target-only write."""
    create = F.col("kind").isin("create", "legacy_create")
    method = F.when(create, "POST").otherwise("PUT")
    host = F.concat(F.lit("postgres-"), F.translate(F.substring_index("topic", ".", 1), "_", "-"))
    record = F.concat(F.col("tenant_id"), F.lit(" person#"), F.col("legacy_id"))
    written = F.concat(
        record, F.lit(" "), F.when(create, "INSERT").otherwise("UPDATE"), F.lit(" written to legacy DB ("), host,
        F.lit(")"))
    refused = F.concat(method, F.lit(" /api/persons rejected: "), F.col("reason"))
    done = F.col("status") != "rejected"
    target_only = done & (F.col("kind") == "update") & F.col("modernized_only").isNotNull()
    # The direct legacy writes answer a refusal without an event.
    spoken = done | F.col("kind").isin("create", "update")

    def event(step: int, message: Column, severity: Column, legacy_id: Column) -> Column:
        return F.struct(
            F.lit(step).alias("step"), message.alias("message"),
            severity.alias("severity"), legacy_id.cast("int").alias("legacy_id"))

    events = F.array_compact(F.array(
        F.when(spoken, event(
            API_STEP, F.when(done, written).otherwise(refused),
            F.when(done, "info").otherwise("warn"),
            F.when(done, F.col("legacy_id")))),
        F.when(target_only, event(
            TARGET_ONLY_STEP, F.concat(record, F.lit(" modernized_only written to new system (person table)")), F.lit("info"),
            F.col("legacy_id"))),
    ))
    unknown = F.coalesce(F.col("reason").startswith("unknown tenant"), F.lit(False))
    return (
        resolved.withColumn("e", F.explode(events))
        .select(
            F.col("seq").cast("bigint").alias("position"), "e.step", "topic", F.lit(0).alias("partition"),
            ts.cast("timestamp_ntz").alias("ts"), F.lit("api").alias("source"),
            F.lit("api").alias("stage"), "e.severity",
            F.when(~unknown, F.col("tenant_id")).alias("tenant_id"), "e.legacy_id", "e.message",
            F.lit(None).cast("string").alias("detail"),
        )
    )


def first_keys(batch: DataFrame, by: list[str], n: int = 5) -> DataFrame:
    """The first n keys per batch, as one short text. The top n are picked per task before anything is gathered."""
    key = F.concat(F.col("tenant_id"), F.lit(" person#"), F.col("source_id"))
    order = Window.partitionBy(*by).orderBy("tenant_id", "source_id", "partition", "offset")
    top = batch.withColumn("__rn", F.row_number().over(order)).where(F.col("__rn") <= n)
    entries = F.array_sort(F.collect_list(F.struct("__rn", key.alias("k"))))
    return top.groupBy(*by).agg(F.concat_ws(", ", F.transform(entries, lambda e: e["k"])).alias("shown"))


def batch_summary(staging: DataFrame, duration_s: Column, n: int = 5) -> DataFrame:
    """Per merged batch: rows, the first keys, and the message of its finished event.

    The full list of keys is `merge.affected_keys`, a table; it would be as large as the batch.
    """
    totals = staging.groupBy("batch_id").agg(F.count("*").alias("rows"))
    shown = first_keys(staging, ["batch_id"], n)
    more = F.when(F.col("rows") > n, F.format_string(", +%d more", F.col("rows") - n)).otherwise("")
    text = F.concat(F.col("shown"), more)
    message = F.concat(
        F.lit("dbt run finished in "), duration_s.cast("string"), F.lit("s: "), F.col("rows").cast("string"),
        F.lit(" staged row(s) merged into person ("), text, F.lit(")"))
    return totals.join(shown, "batch_id").select("batch_id", "rows", text.alias("shown"), message.alias("message"))


def _merge_event(spark: SparkSession, ts: datetime, severity: str, message: Column, detail: Column, position: int) -> DataFrame:
    columns = {
        "position": F.lit(position), "step": F.lit(MERGE_STEP), "topic": F.lit(None), "partition": F.lit(None), "ts": F.lit(ts),
        "source": F.lit("cdc-consumer"), "stage": F.lit(MERGE_STAGE), "severity": F.lit(severity), "tenant_id": F.lit(None),
        "legacy_id": F.lit(None), "message": message, "detail": detail}
    return spark.range(1).select(*(columns[f.name].cast(f.dataType).alias(f.name) for f in schemas.EVENTS))


def merge_started(spark: SparkSession, ts: datetime) -> DataFrame:
    return _merge_event(spark, ts, "info", F.lit("dbt run started"), F.lit(None), 0)


def merge_finished(batch: DataFrame, ts: datetime, duration_s: float) -> DataFrame:
    """The event of one merged batch: its duration, its rows and its first keys; no event for a batch without rows."""
    summary = batch_summary(batch.withColumn("batch_id", F.lit(0)), F.lit(str(duration_s)))
    detail = F.to_json(F.struct(F.lit(duration_s).alias("duration_s"), "rows", F.col("shown").alias("records")))
    message = summary.select("message").scalar()  # one row at most
    return _merge_event(batch.sparkSession, ts, "info", message, summary.select(detail).scalar(), 0).where("message IS NOT NULL")


def merge_failed(spark: SparkSession, ts: datetime, error: str) -> DataFrame:
    detail = F.to_json(F.struct(F.lit(error).alias("error")))
    return _merge_event(spark, ts, "error", F.lit(f"dbt run failed: {error}"), detail, 0)


def connector_events(changes: DataFrame, ts: Column) -> DataFrame:
    """State changes of connectors as events; an outage says no more than that there was no answer."""
    detail = F.to_json(F.struct(F.col("name").alias("connector"), F.col("from_state").alias("from"), F.col("to_state").alias("to")),
                       {"ignoreNullFields": "false"})
    return changes.select(
        F.col("poll_seq").alias("position"), F.lit(CONNECTOR_STEP).alias("step"), F.col("name").alias("topic"),
        F.col("cluster_id").alias("partition"), ts.cast("timestamp_ntz").alias("ts"), F.lit("api").alias("source"),
        F.lit("connector").alias("stage"), "severity", F.lit(None).cast("string").alias("tenant_id"),
        F.lit(None).cast("int").alias("legacy_id"), "message", detail.alias("detail"))


def failures_of(batch: DataFrame, dimension: DataFrame, attempt: int, ts: datetime) -> DataFrame:
    """The failure of a micro-batch: per topic partition the first message that has to be read again."""
    first = batch.groupBy("topic", "partition").agg(F.min("offset").alias("offset"))
    return first.join(dimension.select("topic", "tenant_id"), "topic", "left").select(
        "topic", "partition", "offset", "tenant_id", F.lit(ts).cast("timestamp_ntz").alias("ts"), F.lit(attempt).alias("attempt"))


def prune(log: DataFrame, now: datetime, newest: Column | None = None, keep: bool = True) -> DataFrame:
    """The events that retention keeps: younger than the age limit, and within the id distance of the newest one.

    With `keep=False` those that it deletes. `newest` is the newest id, if `log` does not hold the events themselves.
    """
    newest = log.agg(F.max("id")).scalar() if newest is None else newest
    cutoff = F.lit(now).cast("timestamp_ntz") - F.expr(f"INTERVAL {MAX_AGE}")
    gone = (F.col("ts") < cutoff) | (F.col("id") <= newest - MAX_ROWS)
    return log.where(~gone if keep else gone)


def _counts() -> list[Column]:
    return [F.max(F.when(F.col("source") == "cdc-consumer", F.col("ts"))).alias("last_consumer"),
            F.count_if(F.col("severity") == "error").alias("errors")]


def part_summary() -> list[Column]:
    """What a part of the log holds, as aggregates over its numbered events."""
    return [F.max("id").alias("last_id"), F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"), F.count("*").alias("events"), *_counts()]


def recent_from(now: datetime) -> Column:
    return F.lit(now).cast("timestamp_ntz") - F.expr("INTERVAL 1 MINUTE")


def log_counts(log: DataFrame, now: datetime) -> DataFrame:
    """One row: last_consumer, errors, and recent, the events of the last minute."""
    return log.agg(*_counts(), F.count_if(F.col("ts") > recent_from(now)).alias("recent"))


def log_counts_by_parts(parts: DataFrame, stored: DataFrame, now: datetime) -> DataFrame:
    """The same for what retention keeps of a stored log, from one row per part.

    A part that a limit of retention or the last minute cuts through is read; the others are not. `stored` has batch_id
    and part, on which its folders are pruned.
    """
    newest = parts.agg(F.max("last_id")).scalar()
    cutoff = F.lit(now).cast("timestamp_ntz") - F.expr(f"INTERVAL {MAX_AGE}")
    gone = (F.col("last_ts") < cutoff) | (F.col("last_id") <= newest - MAX_ROWS)
    whole = (F.col("first_ts") >= cutoff) & (F.col("first_id") > newest - MAX_ROWS)
    one_side = (F.col("first_ts") > recent_from(now)) | (F.col("last_ts") <= recent_from(now))
    live = parts.where((F.col("events") > 0) & ~gone).withColumn("cut", ~(whole & one_side))
    known = live.where(~F.col("cut")).select(
        "last_consumer", "errors", F.when(F.col("first_ts") > recent_from(now), F.col("events")).otherwise(0).alias("recent"))
    opened = stored.join(live.where("cut").select("batch_id", "part"), ["batch_id", "part"], "left_semi")
    both = known.unionByName(log_counts(prune(opened, now, newest), now))
    return both.agg(F.max("last_consumer").alias("last_consumer"), F.coalesce(F.sum("errors"), F.lit(0)).alias("errors"),
                    F.coalesce(F.sum("recent"), F.lit(0)).alias("recent"))


def first_event_ids(log: DataFrame, by: list[str] | None = None) -> DataFrame:
    """The first event id of each stage, per record; one pass and one shuffle for all stages."""
    return (
        log.where(F.col("legacy_id").isNotNull() & F.col("stage").isin(*STAGES))
        .groupBy("tenant_id", "legacy_id")
        .agg(*[F.min(F.when(F.col("stage") == s, F.col("id"))).alias(s.split(".")[-1]) for s in STAGES],
             *[F.min_by(c, F.when(F.col("stage") == STAGES[-1], F.col("id"))).alias(c) for c in by or []])
    )


def record_journey(log: DataFrame, merges: DataFrame) -> DataFrame:
    """Per record: the first event of each stage, whether they are in order, and the merge that followed.

    `log` has the batch_id of each event, and `merges` one row per finished merge (batch_id, id). The merge that follows
    is found by the batch of the first staged event, not by a search over all merges.
    """
    finished = merges.groupBy("batch_id").agg(F.min("id").alias("merged"))
    firsts = first_event_ids(log, ["batch_id"])
    in_order = (F.col("api") < F.col("received")) & (F.col("received") < F.col("staged"))
    return (
        firsts.join(finished, "batch_id", "left")
        .select("tenant_id", "legacy_id", "api", "received", "staged",
                F.coalesce(in_order, F.lit(False)).alias("in_order"),
                "merged",
                F.coalesce(F.col("merged") > F.col("staged"), F.lit(False)).alias("merge_followed"))
    )
