"""Reads over the unified table, the legacy rows, the staging table and the activity log."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from changeloom import schemas
from changeloom.operators import activity
from changeloom.schemas import KEY

# The page size of the activity feed.
DEFAULT_LIMIT, MIN_LIMIT, MAX_LIMIT = 200, 1, 1000


def tenant_list(dimension: DataFrame) -> DataFrame:
    return dimension.select("tenant_id")


def check_tenant(tenant_id: str, tenants: tuple[str, ...] | None = None) -> None:
    """`tenants` are the known ones; without them, those of the built-in dimension."""
    if tenant_id not in (tenants or [t for _, t, _ in schemas.TENANTS]):
        raise ValueError(f"Unknown tenant: {tenant_id}")


def person_list(person: DataFrame) -> DataFrame:
    """All persons, newest sync first. A whole batch shares one sync time, so the key breaks ties; the sort then
    splits evenly into ranges even where all rows have the same time."""
    return person.orderBy(F.col("synced_at").desc_nulls_first(), *KEY)


def legacy_list(legacy: DataFrame, tenant_id: str, tenants: tuple[str, ...] | None = None) -> DataFrame:
    check_tenant(tenant_id, tenants)
    return legacy.where(F.col("tenant_id") == tenant_id).orderBy(F.col("legacy_id").desc_nulls_first())


def legacy_lookup(requests: DataFrame, legacy: DataFrame) -> DataFrame:
    """Legacy rows for a batch of requested keys; a key without a row comes back with `found` false."""
    rows = legacy.withColumn("found", F.lit(True))
    return requests.join(rows, KEY, "left").withColumn("found", F.coalesce("found", F.lit(False)))


def existing(requests: DataFrame, person: DataFrame) -> DataFrame:
    return requests.join(person.select(*KEY), KEY, "left_semi")


def find(df: DataFrame, firstname: str | None = None, prefix: str | None = None, tenant_id: str | None = None,
         legacy_id: int | None = None) -> DataFrame:
    """Filter by first name, first-name prefix or key. Plain comparisons, so that they reach the parquet scan."""
    if firstname is not None:
        df = df.where(F.col("firstname") == firstname)
    if prefix is not None:
        df = df.where(F.col("firstname").startswith(prefix))
    if tenant_id is not None:
        df = df.where(F.col("tenant_id") == tenant_id)
    if legacy_id is not None:
        df = df.where(F.col("legacy_id") == legacy_id)
    return df


def latest(df: DataFrame, time_column: str, n: int, tie: list[str]) -> DataFrame:
    """The newest n rows: a top-k per task, then one merge of those."""
    return df.orderBy(F.col(time_column).desc_nulls_first(), *tie).limit(n)


def clamp_limit(limit: int | None) -> int:
    return DEFAULT_LIMIT if limit is None else min(max(limit, MIN_LIMIT), MAX_LIMIT)


def event_page(log: DataFrame, since_id: int = 0, limit: int | None = None, severities: list[str] | None = None,
               tenant_id: str | None = None) -> DataFrame:
    """One page of the activity feed, oldest first: the newest events for the first page, else the oldest after
    `since_id`."""
    rows = log.where(F.col("id") > since_id)
    if severities:
        rows = rows.where(F.col("severity").isin(severities))
    if tenant_id:
        rows = rows.where(F.col("tenant_id") == tenant_id)
    size = clamp_limit(limit)
    if since_id:
        return rows.orderBy("id").limit(size)
    return rows.orderBy(F.col("id").desc()).limit(size).orderBy("id")


def log_or_empty(spark: SparkSession, path: str) -> DataFrame:
    """The activity log, or an empty one where nothing has written an event yet."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    exists = folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder)
    return spark.read.schema(schemas.EVENT_LOG).parquet(path) if exists else schemas.empty(spark, schemas.EVENT_LOG)


def event_search(log: DataFrame, text: str = "", severities: list[str] | None = None,
                 tenant_id: str | None = None) -> DataFrame:
    """Events whose message contains a text, in any case, newest first."""
    rows = log.where(F.contains(F.lower("message"), F.lower(F.lit(text)))) if text else log
    if severities:
        rows = rows.where(F.col("severity").isin(severities))
    if tenant_id:
        rows = rows.where(F.col("tenant_id") == tenant_id)
    return rows.orderBy(F.col("id").desc())


def count_by_tenant(df: DataFrame) -> DataFrame:
    return df.groupBy("tenant_id").agg(F.count("*").alias("persons"))


def staging_counts(staging: DataFrame, last_applied: int) -> DataFrame:
    """Rows ever staged, and rows that wait for a merge."""
    return staging.agg(
        F.count("*").alias("total"), F.count_if(F.col("batch_id") > last_applied).alias("pending")
    )


def prefix_counts(df: DataFrame, column: str, prefixes: list[str]) -> DataFrame:
    """Rows whose column starts with each prefix, in one pass."""
    counts = df.agg(*[F.count_if(F.col(column).startswith(p)).alias(p) for p in prefixes])
    pairs = ", ".join(f"'{p}', `{p}`" for p in prefixes)
    return counts.selectExpr(f"stack({len(prefixes)}, {pairs}) AS (prefix, matches)")


def layer_counts(layers: dict[str, DataFrame]) -> DataFrame:
    """Rows per layer of the sync, each counted in its own scan."""
    parts = [df.agg(F.lit(name).alias("layer"), F.count("*").alias("records")) for name, df in layers.items()]
    union = parts[0]
    for part in parts[1:]:
        union = union.unionByName(part)
    return union


def status(spark: SparkSession, now: datetime, staging: DataFrame | None, letters: DataFrame | None,
           log: DataFrame | None, last_applied: int, counts: DataFrame | None = None) -> DataFrame:
    """The five status metrics as one row. A table that is not there gives NULL, not an error.

    `counts` are the log's as `activity.log_counts_by_parts` gives them; then `log` is not needed.
    Each table is read once and reduced to one row; the rows meet as scalar subqueries, so nothing is joined.
    """

    def metric(df: DataFrame | None, expr: Column, kind: str) -> Column:
        return F.lit(None).cast(kind) if df is None else df.agg(expr.alias("v")).scalar().cast(kind)

    if counts is None and log is not None:
        counts = activity.log_counts(log, now)
    log_row = None if counts is None else counts.select(F.struct(
        F.col("last_consumer").alias("last_consumer_activity"), "errors", F.col("recent").alias("events_last_minute")).alias("v"))
    nothing = F.lit(None).cast(
        "struct<last_consumer_activity:timestamp_ntz,errors:bigint,events_last_minute:bigint>")
    return spark.range(1).select(
        metric(staging, F.count_if(F.col("batch_id") > last_applied), "bigint").alias("staging_backlog"),
        metric(letters, F.count("*"), "bigint").alias("dead_letters"),
        (nothing if log_row is None else log_row.scalar()).alias("__log"),
    ).select("staging_backlog", "dead_letters", "__log.*")
