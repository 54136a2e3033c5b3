"""The sync as a stream: decode each micro-batch, write its outcomes, merge it into the current-state table.

Every write of a batch goes to a folder named by its number, and a ledger names the batches that were merged, so a batch
that is retried after a failure leaves the same result. Offsets are committed by the checkpoint, after the batch.
"""

from __future__ import annotations

import logging
import time
from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from changeloom import schemas
from changeloom.operators import activity, decode, merge, progress
from changeloom.sources import sinks
from changeloom.sources.store import PARTS, CatalogTarget, Ledger, PersonTable, folders

LOG = logging.getLogger(__name__)
#: What `catch_up` merges at once, in staged rows.
CHUNK_ROWS = 10_000_000


def utc_now() -> datetime:
    return datetime.now(timezone.utc).replace(tzinfo=None)


class Tables:
    """Where the tables of one sync are, below one shared folder."""

    def __init__(self, folder: str, checkpoint: str | None = None):
        folder = folder.rstrip("/")
        self.staging = f"{folder}/staging"
        self.dead_letters = f"{folder}/dead_letters"
        self.events = f"{folder}/events"
        self.person = f"{folder}/person"
        self.merged = f"{folder}/merged"
        self.progress = f"{folder}/progress"
        self.checkpoint = checkpoint or f"{folder}/checkpoint"


def first_batch(spark: SparkSession, tables: Tables) -> int:
    """The number of the first batch of a checkpoint.

    Spark counts the batches of each checkpoint from 0. A new checkpoint on existing tables goes on after the last
    batch that they hold, so that a replay adds batches and replaces none. The number is kept inside the checkpoint, and
    so goes when that is deleted.
    """
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{tables.checkpoint}/first_batch")
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if fs.exists(path):
        return int(spark.read.text(path.toString()).first()[0])
    known = [Ledger(spark, tables.merged).last()]
    known += [int(name[9:]) for name in folders(spark, tables.staging) if name.startswith("batch_id=")]
    out = fs.create(path)
    out.writeBytes(str(max(known) + 1))
    out.close()
    return max(known) + 1


def batch_function(
    target, tables: Tables, dimension: DataFrame | None, clock: Callable[[], datetime], delete_mode: str, first: int = 0
) -> Callable[[DataFrame, int], None]:
    """What the stream does with each micro-batch. Batches are numbered from `first` on."""
    log = sinks.EventLog(target.spark, tables.events)
    ledger = Ledger(target.spark, tables.merged)

    def handle(batch: DataFrame, number: int, known: DataFrame) -> None:
        spark = batch.sparkSession
        # Three outputs read the decoded rows; without persist each would parse the messages again.
        decoded = decode.decode(batch, known, delete_mode, clock()).persist()
        try:
            staged = decode.staged(decoded)
            sinks.write_staging(staged, tables.staging, number)
            letters = decode.dead_letters(decoded).unionByName(merge.quarantined(staged, delete_mode))
            sinks.write_dead_letters(letters, tables.dead_letters, number)
            log.append(activity.consumer_events(decoded), number, 0)
            sinks.write_batch(progress.handled_offsets(decoded), tables.progress, number)
        finally:
            decoded.unpersist()
        written = sinks.read_batch(spark, tables.staging, number, schemas.STAGING)
        started = time.monotonic()
        log.append(activity.merge_started(spark, clock()), number, 1)
        try:
            if not ledger.holds(number):
                target.apply_batch(written, number, clock(), delete_mode)
                ledger.record(number, number, clock())
        except Exception as error:
            log.append(activity.merge_failed(spark, clock(), f"{type(error).__name__}: {error}"[:2000]), number, 2)
            raise
        log.append(activity.merge_finished(written, clock(), round(time.monotonic() - started, 2)), number, 2)
        log.prune(clock())

    def run(batch: DataFrame, epoch: int) -> None:
        number = first + epoch
        known = schemas.tenants(batch.sparkSession) if dimension is None else dimension
        try:
            handle(batch, number, known)
        except Exception:
            # The query ends and is started again by whoever runs it; the checkpoint makes it read this batch again.
            attempt = log.retries(number) + 1
            failures = activity.failures_of(batch, known, attempt, clock())
            log.append(activity.retry_events(failures), number, sinks.RETRY_PART + attempt)
            raise

    return run


def start_sync(
    changes: DataFrame,
    folder: str,
    dimension: DataFrame | None = None,
    clock: Callable[[], datetime] = utc_now,
    delete_mode: str = "dead_letter",
    interval: str | None = "1 second",
    parts: int = PARTS,
    target: CatalogTarget | PersonTable | None = None,
    checkpoint: str | None = None,
    repeats_within: str | None = None,
) -> StreamingQuery:
    """Start the sync of a streaming change feed. With `interval=None` it handles what is there and stops.

    `target` is the current-state table; without one, files below `folder`, in `parts` parts per tenant. A new
    `checkpoint` reads the feed from its start again and goes on with the tables as they are. `repeats_within` drops
    messages that the feed repeats within that time, so that staging and the log hold each once; the state that this
    takes is bounded by the same time. Without it a repeat is staged again; the merge gives the same rows either way.
    """
    spark = changes.sparkSession
    tables = Tables(folder, checkpoint)
    store = target or PersonTable(spark, tables.person, parts)
    run = batch_function(store, tables, dimension, clock, delete_mode, first_batch(spark, tables))
    feed = merge.dedupe_stream(changes, repeats_within) if repeats_within else changes
    writer = feed.writeStream.foreachBatch(run).option("checkpointLocation", tables.checkpoint)
    writer = writer.trigger(processingTime=interval) if interval else writer.trigger(availableNow=True)
    return writer.start()


def keep_running(start: Callable[[], StreamingQuery], in_a_row: int | None = None, delay: float = activity.RETRY_DELAY,
                 wait: Callable[[float], None] = time.sleep) -> int:
    """Run a streaming query, and start it again from its checkpoint `delay` seconds after each failure.

    Returns the number of failures once the query ends by itself. `in_a_row` failures without a finished batch in
    between are raised; None goes on for ever, as the failing batch is read again and none is lost.
    """
    failures = fruitless = 0
    while True:
        query = start()
        try:
            query.awaitTermination()
            return failures
        except StreamingQueryException as error:
            failures += 1
            fruitless = 1 if any(p["numInputRows"] for p in query.recentProgress) else fruitless + 1
            if in_a_row is not None and fruitless >= in_a_row:
                raise
            LOG.warning("the query failed and starts again in %s s: %s", delay, str(error)[:500])
            wait(delay)


def lag(spark: SparkSession, tables: Tables, newest: DataFrame) -> DataFrame:
    """Lag per topic partition from what the batches recorded, one row per topic partition and batch; the feed is not read.

    `newest` has topic, partition, offset: the feed itself, or `progress.newest_offsets` of the running query. A batch
    counts once it is decoded and written.
    """
    return progress.topic_progress(newest, sinks.read_batches(spark, tables.progress, schemas.HANDLED))


def catch_up(target: CatalogTarget | PersonTable, tables: Tables, now: datetime, delete_mode: str = "dead_letter",
             chunk_rows: int = CHUNK_ROWS) -> int:
    """Merge what was staged but not merged, in chunks of whole batches with at most `chunk_rows` rows (or one batch).

    Each chunk is recorded in the ledger once it is merged, so a run that fails goes on there. Returns the last merged batch.
    """
    spark = target.spark
    ledger = Ledger(spark, tables.merged)
    staging = merge.unapplied(sinks.read_batches(spark, tables.staging, schemas.STAGING), ledger.last())
    waiting = staging.groupBy("batch_id").count().orderBy("batch_id").collect()  # a row per batch
    chunks: list[list[int]] = []
    rows = 0
    for batch_id, count in waiting:
        if not chunks or rows + count > chunk_rows:
            chunks.append([])
            rows = 0
        chunks[-1].append(batch_id)
        rows += count
    for chunk in chunks:
        part = staging.where(F.col("batch_id").between(chunk[0], chunk[-1])).drop("batch_id")
        target.apply_batch(part, chunk[-1], now, delete_mode)
        ledger.record(chunk[0], chunk[-1], now)
    return ledger.last()
