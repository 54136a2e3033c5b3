"""Merge staged rows into the current-state table, keyed by (tenant_id, legacy_id)."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from changeloom import schemas
from changeloom.schemas import KEY

PERSON_COLUMNS = [f.name for f in schemas.PERSON]
TARGET_ONLY = "modernized_only"


# Messages of one key share a topic partition, so this is their order. No timestamp takes part.
LOG_POSITION = "struct(partition, offset)"


def unapplied(staging: DataFrame, last_applied: int) -> DataFrame:
    """The staged batches that were not merged yet. Prunes the `batch_id` folders of the staging table."""
    return staging.where(F.col("batch_id") > F.lit(last_applied))


def dedupe_stream(changes: DataFrame, delay: str) -> DataFrame:
    """The same for a streaming feed: repeats are dropped if they come within `delay` of the first copy's time.

    Spark also drops messages that are older than the newest one by more than `delay`, so choose it longer than any
    replay reaches back. The sync does this only if asked: its merge is idempotent and needs no bound on lateness.
    """
    timed = changes.withColumn("event_time", F.col("timestamp").cast("timestamp")).withWatermark("event_time", delay)
    return timed.dropDuplicatesWithinWatermark(["topic", "partition", "offset"]).drop("event_time")


def dedupe_log(df: DataFrame) -> DataFrame:
    """One row per log position, for tables that append. The merge itself needs no dedup: it is idempotent."""
    return df.dropDuplicates(["topic", "partition", "offset"])


def _mergeable(delete_mode: str) -> Column:
    complete = F.col("firstname").isNotNull() & F.col("surname").isNotNull()
    return complete | (F.col("operation") == "DELETE") if delete_mode == "apply" else complete


def accepted(staging: DataFrame, delete_mode: str = "dead_letter") -> DataFrame:
    """Staged rows that the target accepts: its names are NOT NULL."""
    return staging.where(_mergeable(delete_mode))


def quarantined(staging: DataFrame, delete_mode: str = "dead_letter") -> DataFrame:
    """Staged rows that the target refuses, as dead letters.

    They are set aside per event and before the latest event of a key is picked, so the result does not depend on
    where one batch ends and the next begins.
    """
    column = F.when(F.col("firstname").isNull(), "firstname").otherwise("surname")
    row = F.to_json(F.struct(*[c for c in staging.columns if c not in ("topic", "partition", "offset")]))
    return staging.where(~_mergeable(delete_mode)).select(
        "topic", "partition", "offset", "tenant_id",
        row.alias("raw_value"),
        F.lit("TARGET_NOT_NULL").alias("reason"),
        F.concat(F.lit("TARGET_NOT_NULL: "), column).alias("error"),
        "created_at",
    )


def latest_per_key(staging: DataFrame) -> DataFrame:
    """The latest staged event of each key, and whether the batch deletes the key anywhere.

    `max_by` keeps one row per key and task before the shuffle, so a key with a third of all events costs one row per
    task, not one task.
    """
    payload = ", ".join(f"`{c}`" for c in staging.columns if c not in ("tenant_id", "source_id"))
    return (
        staging.groupBy("tenant_id", "source_id")
        .agg(
            F.expr(f"max_by(struct({payload}), {LOG_POSITION}) AS row"),
            F.expr("max(operation = 'DELETE') AS had_delete"),
        )
        .select("tenant_id", "source_id", "row.*", "had_delete")
    )


def latest_by_window(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """Top row per key by an explicit order. Spark limits each group to one row per task before the shuffle."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("__rn", rank).where(F.col("__rn") == 1).drop("__rn")


def map_columns(latest: DataFrame) -> DataFrame:
    """Staging columns to target columns. Columns that the staging table gained later are kept (see `merge`)."""
    known = set(schemas.STAGING.fieldNames()) | {"had_delete", "batch_id"}
    added = [f"`{c}`" for c in latest.columns if c not in known]
    return latest.selectExpr(
        "tenant_id", "source_id AS legacy_id", "firstname", "surname", "date_of_birth", "city",
        "coalesce(data_2, data_c) AS extra_field", "created_at", *added, "operation", "had_delete",
    )


def preserve_join(latest: DataFrame, target: DataFrame) -> DataFrame:
    """Latest rows with the target-only column of the matching target row, if there is one."""
    return latest.join(target.select(*KEY, TARGET_ONLY), KEY, "left")


def survivors(target: DataFrame, keys: DataFrame) -> DataFrame:
    """Target rows whose key is not among the given ones."""
    return target.join(keys.select(*KEY), KEY, "left_anti")


def _as_struct(df: DataFrame, name: str) -> str:
    return f"struct({', '.join(f'`{c}`' for c in df.columns if c not in KEY)}) AS {name}"


def merge(
    target: DataFrame, staging: DataFrame, now: datetime, delete_mode: str = "dead_letter"
) -> DataFrame:
    """The target after one batch: the latest row of each key replaces the whole target row, nulls included.

    Only `modernized_only` is carried over from the target. The preserve-join and the anti-join of the surviving rows
    are one full outer join, so the target is read and shuffled once (not at all where it is bucketed by the key).
    Columns that only one side has are kept and filled with NULL. With `delete_mode="apply"` a key whose latest event
    is a DELETE leaves the target, and a key that was deleted anywhere in the batch does not inherit `modernized_only`.
    """
    stamp = F.lit(now).cast("timestamp_ntz")
    incoming = map_columns(latest_per_key(accepted(staging, delete_mode))).withColumns(
        {"synced_at": stamp, "updated_at": stamp}
    )
    arriving = incoming.selectExpr(*KEY, _as_struct(incoming, "__new"))
    current = target.selectExpr(*KEY, _as_struct(target, "__old"))
    joined = current.join(arriving, KEY, "full")
    carried = f"__old.{TARGET_ONLY}"
    if delete_mode == "apply":
        joined = joined.where("__new IS NULL OR __new.operation <> 'DELETE'")
        carried = f"CASE WHEN __new.had_delete THEN NULL ELSE {carried} END"

    def column(name: str) -> str:
        if name == TARGET_ONLY:
            return f"{carried} AS {name}"
        new = f"__new.`{name}`" if name in incoming.columns else "NULL"
        old = f"__old.`{name}`" if name in target.columns else "NULL"
        return f"CASE WHEN __new IS NOT NULL THEN {new} ELSE {old} END AS `{name}`"

    added = [c for c in incoming.columns if c not in target.columns and c not in ("operation", "had_delete")]
    return joined.selectExpr(*KEY, *[column(c) for c in [*target.columns, *added] if c not in KEY])


def merge_first(staging: DataFrame, now: datetime, delete_mode: str = "dead_letter") -> DataFrame:
    """The first run: the same merge into an empty target."""
    return merge(schemas.empty(staging.sparkSession, schemas.PERSON), staging, now, delete_mode)


def affected_keys(staging: DataFrame, by: list[str] | None = None) -> DataFrame:
    """The keys of a batch, one row per staged event, as a table and not as one list."""
    return staging.select(*(by or []), "tenant_id", F.col("source_id").alias("legacy_id"))

