"""Comparing large tables by digests: only rows of key ranges whose digests differ are shuffled and compared.

A range is a part of a hash of the key. Its digest is order-free: the number of rows and two sums of 64-bit row hashes,
so it needs one small aggregate per table, combined before the shuffle. Rows are equal as null-safe comparison has it; copies
count. Two ranges with different rows have equal digests with a probability of about 2^-128.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changeloom.operators import checks
from changeloom.schemas import KEY

#: Ranges, at most; a table with a row for each is small enough to be sent to every task.
MOST_PARTS = 1 << 20


def _part(keys: list[str], parts: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(parts)).cast("int")


def digests(df: DataFrame, keys: list[str], columns: list[str], parts: int) -> DataFrame:
    """part, rows, digest, digest2: one row per range that has rows."""
    # a hash skips nulls, so which columns are null is hashed as well
    nulls = [F.col(c).isNull() for c in columns]
    sums = [F.sum(F.xxhash64(F.lit(seed), *columns, *nulls).cast("decimal(20,0)")).alias(name)
            for seed, name in ((0, "digest"), (1, "digest2"))]
    return df.groupBy(_part(keys, parts).alias("part")).agg(F.count("*").alias("rows"), *sums)


def differing(before: DataFrame, after: DataFrame, keys: list[str], columns: list[str], parts: int) -> DataFrame:
    """part: the ranges whose rows are not the same in both tables."""
    left, right = (digests(df, keys, columns, parts) for df in (before, after))
    measures = ("rows", "digest", "digest2")
    both = left.select("part", *(F.col(c).alias(f"{c}_1") for c in measures)).join(
        right.select("part", *(F.col(c).alias(f"{c}_2") for c in measures)), "part", "full")
    same = reduce(Column.__and__, (F.col(f"{c}_1").eqNullSafe(F.col(f"{c}_2")) for c in measures))
    return both.where(~same).select("part")


def narrowed(before: DataFrame, after: DataFrame, keys: list[str], columns: list[str], parts: int) -> tuple[DataFrame, DataFrame]:
    """The rows of both tables in ranges that differ."""
    if not 0 < parts <= MOST_PARTS:
        raise ValueError(f"parts must be from 1 to {MOST_PARTS}")
    found = F.broadcast(differing(before, after, keys, columns, parts).withColumnRenamed("part", "__part"))  # `parts` rows at most
    one, two = (df.withColumn("__part", _part(keys, parts)).join(found, "__part", "left_semi").drop("__part") for df in (before, after))
    return one, two


def snapshot_diff(before: DataFrame, after: DataFrame, parts: int) -> DataFrame:
    """What `checks.snapshot_diff` gives; rows of ranges without a difference are read, but not moved."""
    columns = list(checks.SNAPSHOT_COLUMNS)
    views = (checks.snapshot_view(before), checks.snapshot_view(after))
    one, two = narrowed(*views, KEY, columns, parts)
    return checks.snapshot_diff(one, two)


def reconcile(source: DataFrame, person: DataFrame, columns: list[str], parts: int) -> DataFrame:
    """What `checks.reconcile` gives, without the keys that are equal. Both tables must have `columns` with the same types."""
    one, two = narrowed(source, person, KEY, [*KEY, *columns], parts)
    return checks.reconcile(one, two, columns).where(F.col("status") != "equal")
