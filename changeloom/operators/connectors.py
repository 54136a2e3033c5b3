"""Connector monitoring over polled states: cluster_id, poll_seq, reachable, name, state, tasks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changeloom.operators.ordered import SLICE_WIDTH, carry_forward

# The name and state that stand for a poll that got no answer.
UNREACHABLE_NAME, UNREACHABLE_STATE = "debezium", "UNREACHABLE"


def severity(state: Column) -> Column:
    return (
        F.when(state == "RUNNING", "info")
        .when(state.isin("FAILED", UNREACHABLE_STATE), "error")
        .otherwise("warn")
    )


def state_changes(polls: DataFrame, width: int = SLICE_WIDTH) -> DataFrame:
    """One event per state change.

    A name is compared with its state in the last poll that reported it; one that is first seen RUNNING is no news. A
    run of unreachable polls is reported once, at its start, and its end is not reported. Both comparisons go through
    `carry_forward`, so neither a busy name nor a busy cluster is sorted in one task.
    """
    reported = polls.where(F.col("reachable")).select("cluster_id", "poll_seq", "name", "state")
    named = carry_forward(
        reported, ["cluster_id", "name"], "poll_seq", {"__old": F.struct(F.col("state").alias("s"))}, width=width
    ).withColumn("old", F.coalesce(F.col("__old.s"), F.when(F.col("state") == "RUNNING", F.lit("RUNNING"))))
    changed = named.where(~F.col("state").eqNullSafe(F.col("old"))).select(
        "cluster_id", "poll_seq", "name", "old", "state")

    whole_polls = polls.groupBy("cluster_id", "poll_seq").agg(F.max("reachable").alias("reachable"))
    lost = carry_forward(whole_polls, ["cluster_id"], "poll_seq", {"__was": F.col("reachable")}, width=width).where(
        ~F.col("reachable") & F.coalesce(F.col("__was"), F.lit(True))
    ).select(
        "cluster_id", "poll_seq", F.lit(UNREACHABLE_NAME).alias("name"), F.lit(None).cast("string").alias("old"),
        F.lit(UNREACHABLE_STATE).alias("state"),
    )
    message = F.concat(F.col("name"), F.lit(": "), F.coalesce("old", F.lit("unknown")), F.lit(" -> "), F.col("state"))
    return changed.unionByName(lost).select(
        "cluster_id", "poll_seq", "name", F.col("old").alias("from_state"), F.col("state").alias("to_state"),
        severity(F.col("state")).alias("severity"), message.alias("message"),
    )


def current_state(polls: DataFrame) -> DataFrame:
    """The latest state of each name, by name. A cluster whose last poll got no answer shows only that."""
    per_name = polls.where(F.col("reachable")).groupBy("cluster_id", "name").agg(
        F.max_by("state", "poll_seq").alias("state")
    )
    per_cluster = polls.groupBy("cluster_id").agg(F.max_by("reachable", "poll_seq").alias("up"))
    answering = per_name.join(per_cluster.where("up"), "cluster_id", "left_semi")
    silent = per_cluster.where(~F.col("up")).select(
        "cluster_id", F.lit(UNREACHABLE_NAME).alias("name"), F.lit(UNREACHABLE_STATE).alias("state"))
    return answering.unionByName(silent).orderBy("cluster_id", "name")


def readiness(polls: DataFrame) -> DataFrame:
    """Whether each name is ready in its latest poll: itself RUNNING, with tasks, and all of them RUNNING."""
    last = polls.where(F.col("reachable")).groupBy("cluster_id", "name").agg(
        F.max_by(F.struct("state", "tasks"), "poll_seq").alias("p")
    )
    tasks_run = (F.size("p.tasks") > 0) & F.forall("p.tasks", lambda t: t["state"] == "RUNNING")
    ready = F.coalesce((F.col("p.state") == "RUNNING") & tasks_run, F.lit(False))
    return last.select(
        "cluster_id", "name", F.col("p.state").alias("state"),
        F.coalesce(F.size("p.tasks"), F.lit(0)).alias("tasks"), ready.alias("ready"))


def restart_list(polls: DataFrame) -> DataFrame:
    return readiness(polls).where(~F.col("ready")).select("cluster_id", "name", "state")
