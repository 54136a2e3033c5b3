"""Connector state changes as a stream.

The state is the last poll of each name and cluster: one row each. A micro-batch puts these rows before its own and runs
the batch operator over both, so a busy name is handled as in batch, in slices and inside the JVM.

Polls of different names may come in any order. A report is late if a later poll of the same name was handled in an
earlier micro-batch, and a silent poll is late if any later poll of its cluster was; late ones are left out, because what
they would have been compared with is no longer known.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from changeloom import schemas
from changeloom.operators import activity, connectors
from changeloom.sources import sinks
from changeloom.streaming.sync import utc_now

POLLS = T.StructType([
    T.StructField("cluster_id", T.IntegerType()),
    T.StructField("poll_seq", T.LongType()),
    T.StructField("reachable", T.BooleanType()),
    T.StructField("name", T.StringType()),
    T.StructField("state", T.StringType()),
])

STATE_CHANGES = T.StructType([
    T.StructField("cluster_id", T.IntegerType()),
    T.StructField("poll_seq", T.LongType()),
    T.StructField("name", T.StringType()),
    T.StructField("from_state", T.StringType()),
    T.StructField("to_state", T.StringType()),
    T.StructField("severity", T.StringType()),
    T.StructField("message", T.StringType()),
])


def last_polls(polls: DataFrame) -> DataFrame:
    """The rows that later polls are compared with: the last one of each name, and the last one of each cluster."""
    columns = POLLS.names
    named = polls.where(F.col("reachable")).groupBy("cluster_id", "name").agg(
        F.max_by(F.struct("poll_seq", "reachable", "state"), "poll_seq").alias("r")
    ).select("cluster_id", "r.poll_seq", "r.reachable", "name", "r.state")
    lost = polls.groupBy("cluster_id").agg(F.max_by(F.struct("poll_seq", "reachable"), "poll_seq").alias("r")).where(
        ~F.col("r.reachable")
    ).select("cluster_id", "r.poll_seq", "r.reachable", F.lit(None).cast("string").alias("name"),
             F.lit(None).cast("string").alias("state"))
    return named.select(*columns).unionByName(lost.select(*columns))


def batch_function(folder: str, log: sinks.EventLog | None = None,
                   clock: Callable[[], datetime] = utc_now) -> Callable[[DataFrame, int], None]:
    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        polls = batch.select(*POLLS.names)
        seeds = schemas.empty(spark, POLLS) if batch_id == 0 else sinks.read_batch(
            spark, f"{folder}/state", batch_id - 1, POLLS)
        known = seeds.where("reachable").select("cluster_id", "name", F.col("poll_seq").alias("last"))
        upto = seeds.groupBy("cluster_id").agg(F.max("poll_seq").alias("upto"))
        reports = polls.where("reachable").join(known, ["cluster_id", "name"], "left").where(
            "last IS NULL OR poll_seq > last")
        silent = polls.where("NOT reachable").join(upto, "cluster_id", "left").where("upto IS NULL OR poll_seq > upto")
        both = seeds.unionByName(reports.select(*POLLS.names)).unionByName(silent.select(*POLLS.names)).persist()
        try:
            changes = connectors.state_changes(both)
            outage = F.col("to_state") == connectors.UNREACHABLE_STATE
            news = changes.join(known, ["cluster_id", "name"], "left").join(upto, "cluster_id", "left").where(
                (outage & (F.col("upto").isNull() | (F.col("poll_seq") > F.col("upto"))))
                | (~outage & (F.col("last").isNull() | (F.col("poll_seq") > F.col("last")))))
            fresh = news.select(*STATE_CHANGES.names)
            sinks.write_batch(fresh, f"{folder}/changes", batch_id)
            sinks.write_batch(last_polls(both), f"{folder}/state", batch_id)
            if log is not None:
                log.append(activity.connector_events(fresh, F.lit(clock())), batch_id, sinks.CONNECTOR_PART)
        finally:
            both.unpersist()

    return run


def start_monitor(polls: DataFrame, folder: str, interval: str | None = "3 seconds", log: sinks.EventLog | None = None,
                  clock: Callable[[], datetime] = utc_now) -> StreamingQuery:
    """Start the monitor; with a `log`, each state change is an event there too."""
    writer = polls.writeStream.foreachBatch(batch_function(folder, log, clock)).option("checkpointLocation", f"{folder}/checkpoint")
    writer = writer.trigger(processingTime=interval) if interval else writer.trigger(availableNow=True)
    return writer.start()
