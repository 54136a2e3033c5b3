"""Whole flows composed from the operators."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from changeloom import schemas
from changeloom.operators import commands as C
from changeloom.operators import decode as D
from changeloom.operators import merge as M
from changeloom.sources import changes as S
from changeloom.sources import tables as T

FIRST_SYNC = datetime(2024, 2, 1, 0, 0, 0)
SECOND_SYNC = datetime(2024, 2, 2, 0, 0, 0)
PATCH = date(2024, 5, 1)


def decoded_events(spark: SparkSession, events: DataFrame, delete_mode: str = "dead_letter") -> DataFrame:
    return D.decode(T.change_feed(events), schemas.tenants(spark), delete_mode)


def staged_events(spark: SparkSession, events: DataFrame, delete_mode: str = "dead_letter") -> DataFrame:
    return D.staged(decoded_events(spark, events, delete_mode))


def patch_tenth(target: DataFrame) -> DataFrame:
    """A target-only write between two batches: every tenth id gets a date that no legacy system knows."""
    patched = F.when(F.col("legacy_id") % 10 == 0, F.lit(PATCH)).otherwise(F.col("modernized_only"))
    return target.withColumn("modernized_only", patched)


def person_after_first(spark: SparkSession, sf_dir: str, delete_mode: str = "dead_letter") -> DataFrame:
    first, _ = T.message_halves(spark, sf_dir)
    return M.merge_first(staged_events(spark, first, delete_mode), FIRST_SYNC, delete_mode)


def person_after_both(spark: SparkSession, sf_dir: str, delete_mode: str = "dead_letter") -> DataFrame:
    _, second = T.message_halves(spark, sf_dir)
    target = patch_tenth(person_after_first(spark, sf_dir, delete_mode))
    return M.merge(target, staged_events(spark, second, delete_mode), SECOND_SYNC, delete_mode)


def person_in_one_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.merge_first(staged_events(spark, T.load_spread(spark, sf_dir, "events", "event_id")), FIRST_SYNC)


def backfill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The staging rows of a first snapshot of all four legacy tables, one union of four sources."""
    customer = T.load(spark, sf_dir, "customer")
    stamp = F.lit(FIRST_SYNC)
    feeds = [
        S.snapshot_changes(T.legacy_source(customer, tenant), topic, stamp)
        for topic, tenant, _ in schemas.TENANTS
    ]
    return D.staged(D.decode(S.unify(feeds), schemas.tenants(spark)))


def person_from_backfill(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.merge_first(backfill(spark, sf_dir), FIRST_SYNC)


def legacy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.legacy_rows(T.load(spark, sf_dir, "customer"))


def commands(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.commands(T.load_spread(spark, sf_dir, "orders", "o_orderkey"))


def command_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The change messages that the write commands cause."""
    images = C.row_images(legacy(spark, sf_dir), commands(spark, sf_dir), schemas.tenants(spark))
    return C.to_changes(images, F.lit(FIRST_SYNC))


def command_staging(spark: SparkSession, sf_dir: str) -> DataFrame:
    return D.staged(D.decode(command_changes(spark, sf_dir), schemas.tenants(spark)))
