"""Data-quality checks, snapshot comparison and reconciliation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changeloom.schemas import KEY, TENANTS

NOT_NULL_COLUMNS = ("tenant_id", "legacy_id", "firstname", "surname")
MARKER_SUFFIX = "-canary"
SNAPSHOT_COLUMNS = ("tenant_id", "legacy_id", "firstname", "surname", "extra_field")


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("row_count")).where(F.col("row_count") > 1)


def missing_keys(expected: DataFrame, actual: DataFrame, keys: list[str] = KEY) -> DataFrame:
    """Expected keys that did not arrive."""
    return expected.select(*keys).join(actual.select(*keys), keys, "left_anti")


def _as_rows(one_row: DataFrame) -> DataFrame:
    """A one-row table of counts as (check_name, failures) rows."""
    pairs = ", ".join(f"'{c}', `{c}`" for c in one_row.columns)
    return one_row.selectExpr(f"stack({len(one_row.columns)}, {pairs}) AS (check_name, failures)")


def column_checks(person: DataFrame, tenant_ids: list[str]) -> DataFrame:
    """The not-null and accepted-values checks, all in one pass over the table."""
    counts = [F.count_if(F.col(c).isNull()).alias(f"not_null_{c}") for c in NOT_NULL_COLUMNS]
    unknown = F.count_if(F.coalesce(~F.col("tenant_id").isin(tenant_ids), F.lit(False)))
    return _as_rows(person.agg(*counts, unknown.alias("accepted_values_tenant_id")))


def key_checks(person: DataFrame) -> DataFrame:
    """Keys that occur more than once, and ids for which rows of one tenant stand in for another's."""
    per_key = person.groupBy(*KEY).agg(F.count("*").alias("n"))
    per_id = per_key.groupBy("legacy_id").agg(
        F.count("*").alias("tenants"), F.sum("n").alias("rows"), F.count_if(F.col("n") > 1).alias("repeated")
    )
    return _as_rows(per_id.agg(
        F.coalesce(F.sum("repeated"), F.lit(0)).alias("unique_key"),
        F.count_if(F.col("rows") != F.col("tenants")).alias("tenants_stay_separate"),
    ))


def arrival_check(expected: DataFrame, person: DataFrame) -> DataFrame:
    return _as_rows(missing_keys(expected, person).agg(F.count("*").alias("every_key_arrived")))


def replay_check(before: DataFrame, after: DataFrame) -> DataFrame:
    differences = snapshot_diff(before, after).agg(F.coalesce(F.sum("copies"), F.lit(0)).alias("replay_changes_nothing"))
    return _as_rows(differences)


def report(*checks: DataFrame) -> DataFrame:
    """All checks as one table: name, failing rows, status. A check without a count was not run."""
    union = checks[0]
    for check in checks[1:]:
        union = union.unionByName(check)
    status = F.when(F.col("failures").isNull(), "skipped").when(F.col("failures") > 0, "failed").otherwise("passed")
    return union.select("check_name", F.col("failures").cast("bigint").alias("failures"), status.alias("status"))


def skipped(df: DataFrame) -> DataFrame:
    """The same checks with no count, for a run in which their input was not available."""
    return df.withColumn("failures", F.lit(None).cast("bigint"))


def summary(results: DataFrame) -> DataFrame:
    return results.groupBy("status").agg(F.count("*").alias("checks"))


def quality_report(person: DataFrame, expected: DataFrame, before: DataFrame, after: DataFrame) -> DataFrame:
    tenant_ids = [t for _, t, _ in TENANTS]
    return report(
        column_checks(person, tenant_ids),
        key_checks(person),
        arrival_check(expected, person),
        replay_check(before, after),
    )


def snapshot_view(person: DataFrame) -> DataFrame:
    """The comparable part of the table, without the marker rows that a test run adds itself."""
    marker = F.coalesce(F.col("surname").endswith(MARKER_SUFFIX), F.lit(False))
    return person.where(~marker).select(*SNAPSHOT_COLUMNS)


def snapshot_diff(before: DataFrame, after: DataFrame) -> DataFrame:
    """Rows that only one of two snapshots has, with how many copies more; both directions in one shuffle."""
    columns = list(SNAPSHOT_COLUMNS)
    signed = snapshot_view(before).withColumn("__n", F.lit(-1)).unionByName(
        snapshot_view(after).withColumn("__n", F.lit(1))
    )
    return (
        signed.groupBy(*columns)
        .agg(F.sum("__n").alias("__n"))
        .where(F.col("__n") != 0)
        .select(*columns, F.when(F.col("__n") < 0, "missing").otherwise("extra").alias("side"),
                F.abs("__n").alias("copies"))
    )


def reconcile(source: DataFrame, person: DataFrame, columns: list[str]) -> DataFrame:
    """Source rows against target rows by key: missing, extra, different (with the columns that differ) or equal."""
    left = source.select(*KEY, F.struct(*columns).alias("__s"))
    right = person.select(*KEY, F.struct(*columns).alias("__p"))

    def differs(name: str) -> Column:
        return F.when(~F.col(f"__s.{name}").eqNullSafe(F.col(f"__p.{name}")), F.lit(name))

    both = left.join(right, KEY, "full")
    compared = both.withColumn("__d", F.when(
        F.col("__s").isNotNull() & F.col("__p").isNotNull(), F.concat_ws(",", *[differs(c) for c in columns])
    ))
    status = (
        F.when(F.col("__p").isNull(), "missing")
        .when(F.col("__s").isNull(), "extra")
        .when(F.col("__d") != "", "different")
        .otherwise("equal")
    )
    return compared.select(*KEY, status.alias("status"), F.nullif("__d", F.lit("")).alias("differences"))
