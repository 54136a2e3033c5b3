import pytest
from pyspark.sql import functions as F

from changeloom.operators import checks, digests

COLUMNS = ["firstname", "surname", "extra_field"]
SCHEMA = "tenant_id string, legacy_id int, firstname string, surname string, extra_field string"


def table(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def plain(df):
    return sorted(map(repr, df.collect()))


BASE = [("t1", i, f"f{i}", f"s{i}", None if i % 3 else "x") for i in range(200)] + [("t2", 5, None, None, None)]


@pytest.mark.parametrize("parts", [1, 7, 4096])
def test_digests_give_what_the_full_comparison_gives(spark, parts):
    swapped = [("t1", 7, None, "f7", "s7"), ("t1", 8, "f8", "s8", ""), ("t1", 900, "a", "b", None)]
    left = table(spark, BASE + [BASE[3]])
    right = table(spark, [row for row in BASE if row[1] not in (7, 8, 11)] + swapped)
    assert plain(digests.snapshot_diff(left, right, parts)) == plain(checks.snapshot_diff(left, right))
    one = left.dropDuplicates(["tenant_id", "legacy_id"])
    full = checks.reconcile(one, right, COLUMNS).where("status <> 'equal'")
    assert plain(digests.reconcile(one, right, COLUMNS, parts)) == plain(full) and full.count() == 4


def test_values_that_trade_places_with_nulls_differ(spark):
    left = table(spark, [("t", 1, "a", None, None), ("t", 2, "a", "b", None)])
    right = table(spark, [("t", 1, None, "a", None), ("t", 2, "a", None, "b")])
    keys = ["tenant_id", "legacy_id"]
    assert digests.differing(left, right, keys, COLUMNS, 1 << 20).count() == 2
    assert digests.differing(left, left.orderBy(F.desc("legacy_id")), keys, COLUMNS, 1 << 20).count() == 0


def test_only_ranges_that_differ_are_compared(spark):
    left = table(spark, BASE)
    right = left.withColumn("surname", F.when(F.col("legacy_id") == 50, "new").otherwise(F.col("surname")))
    one, two = digests.narrowed(left, right, ["tenant_id", "legacy_id"], COLUMNS, 1 << 16)
    assert one.count() == two.count() == 1
    same, other = digests.narrowed(left, left, ["tenant_id", "legacy_id"], COLUMNS, 16)
    assert same.count() == other.count() == 0


def test_empty_tables_and_bounds(spark):
    empty, some = table(spark, []), table(spark, BASE[:2])
    assert digests.snapshot_diff(empty, empty, 8).count() == 0
    assert digests.snapshot_diff(empty, some, 8).where("side = 'extra'").count() == 2
    for parts in (0, digests.MOST_PARTS + 1):
        with pytest.raises(ValueError):
            digests.narrowed(some, some, ["legacy_id"], COLUMNS, parts)


def test_the_plan_moves_digests_and_not_rows_that_are_equal(spark, tmp_path):
    for name in ("a", "b"):
        table(spark, BASE).write.parquet(f"{tmp_path}/{name}")
    left, right = (spark.read.parquet(f"{tmp_path}/{name}") for name in ("a", "b"))
    plan = digests.snapshot_diff(left, right, 1024)._jdf.queryExecution().optimizedPlan().toString()
    assert "Join Cross" not in plan and plan.count("LeftSemi") == 2 and "strategy=broadcast" in plan
