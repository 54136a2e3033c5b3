"""How far the sync has come: lag of the consumer, lag of the data, quiet staging, and completeness barriers."""

from __future__ import annotations

import json
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changeloom.operators.ordered import exact_percentiles
from changeloom.schemas import KEY

# Fixed value: staging is quiet when nothing was staged for this long.
QUIET_SECONDS = 15


def topic_progress(feed: DataFrame, handled: DataFrame) -> DataFrame:
    """Per topic partition: newest offset, newest handled offset (staged, dead-lettered or dropped), and the lag."""
    newest = feed.groupBy("topic", "partition").agg(F.max("offset").alias("newest"))
    done = handled.groupBy("topic", "partition").agg(F.max("offset").alias("handled"))
    return newest.join(done, ["topic", "partition"], "left").select(
        "topic", "partition", "newest", "handled",
        (F.col("newest") - F.coalesce("handled", F.lit(-1))).alias("lag"))


def handled_offsets(decoded: DataFrame) -> DataFrame:
    """Per topic partition of a batch the first and the newest offset, and the number of messages, whatever became of them."""
    return decoded.groupBy("topic", "partition").agg(
        F.min("offset").alias("first_offset"), F.max("offset").alias("offset"), F.count("*").alias("messages"))


def newest_offsets(report: dict) -> list[tuple[str, int, int]]:
    """(topic, partition, newest offset) as a running query's progress report has them for its Kafka sources.

    The report names the offset that comes next. Sources without offsets per topic partition, as files, give no row.
    """
    found = []
    for source in report.get("sources", []):
        latest = source.get("latestOffset")
        latest = json.loads(latest) if isinstance(latest, str) and latest.startswith("{") else latest
        for topic, offsets in (latest.items() if isinstance(latest, dict) else ()):
            if isinstance(offsets, dict):
                found += [(topic, int(partition), int(offset) - 1) for partition, offset in offsets.items()]
    return sorted(found)


def first_missing(feed: DataFrame, handled: DataFrame) -> DataFrame:
    """Per topic partition the first offset of the feed that was not handled. Offsets that the feed lacks are no gaps.

    The anti-join is dealt by offset, so a topic partition with most of the messages is spread over all tasks.
    """
    place = ["topic", "partition", "offset"]
    return feed.join(handled.select(*place), place, "left_anti").groupBy("topic", "partition").agg(F.min("offset").alias("missing"))


def barrier(markers: DataFrame, handled: DataFrame, feed: DataFrame | None = None) -> DataFrame:
    """Per marker row: whether everything up to it in its topic partition was handled. Valid per tenant only.

    With the feed, a marker passes if no offset up to it is missing. Without it the newest handled offset decides, which
    is right only where messages are handled in their order and none is left out, as by one stream.
    """
    done = handled.groupBy("topic", "partition").agg(F.max("offset").alias("handled"))
    state = markers.join(done, ["topic", "partition"], "left")  # one row per topic partition
    if feed is None:
        passed = F.coalesce(F.col("handled") >= F.col("marker_offset"), F.lit(False))
        return state.select("topic", "partition", "marker_offset", "handled", passed.alias("passed"))
    passed = F.coalesce(F.col("missing") > F.col("marker_offset"), F.col("handled") >= F.col("marker_offset"), F.lit(False))
    return state.join(first_missing(feed, handled), ["topic", "partition"], "left").select(
        "topic", "partition", "marker_offset", "handled", "missing", passed.alias("passed"))


def quiet(staging: DataFrame, last_applied: int, now: datetime, at_least: int) -> DataFrame:
    """Whether enough rows were staged, none waits for a merge, and nothing was staged lately."""
    state = staging.agg(
        F.count("*").alias("total"),
        F.count_if(F.col("batch_id") > last_applied).alias("pending"),
        F.max("created_at").alias("last_staged"),
    )
    rested = F.lit(now).cast("timestamp_ntz") - F.col("last_staged") >= F.expr(f"INTERVAL {QUIET_SECONDS} SECONDS")
    settled = (F.col("total") >= at_least) & (F.col("pending") == 0) & rested
    return state.select("total", "pending", "last_staged", F.coalesce(settled, F.lit(False)).alias("quiet"))


def lag_seconds(writes: DataFrame, person: DataFrame) -> DataFrame:
    """Milliseconds from the legacy write of a row to its sync, for each synced key. `writes` has one row per key."""
    both = writes.select(*KEY, "written_at").join(person.select(*KEY, "synced_at"), KEY)
    millis = F.timestamp_diff("MILLISECOND", F.col("written_at"), F.col("synced_at"))
    return both.select(*KEY, millis.alias("lag_ms"))


def sync_lag(writes: DataFrame, person: DataFrame, percents: dict[str, int] | None = None) -> DataFrame:
    """Exact lag percentiles per tenant."""
    wanted = percents or {"p50": 50, "p95": 95, "max": 100}
    return exact_percentiles(lag_seconds(writes, person), ["tenant_id"], "lag_ms", wanted)
