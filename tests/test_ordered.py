import random

import pytest
from pyspark.sql import functions as F

from changeloom.operators.ordered import carry_forward, exact_percentiles


def series(seed, n=400):
    """One key holds most of the rows; values are often null; positions have gaps."""
    rng = random.Random(seed)
    positions = rng.sample(range(-500, 5000), n)
    return [("hot" if rng.random() < 0.7 else f"k{rng.randrange(5)}" if rng.random() < 0.9 else None, p,
             rng.choice([None, "a", "b", "c"])) for p in positions]


@pytest.mark.parametrize("inclusive", [True, False])
@pytest.mark.parametrize("width", [1, 7, 1 << 16])
def test_carry_forward_equals_a_scan(spark, inclusive, width):
    rows = series(width)
    df = spark.createDataFrame(rows, "k STRING, pos BIGINT, v STRING")
    got = carry_forward(df, ["k"], "pos", {"seen": F.col("v")}, {"origin": F.col("v")}, inclusive, width)
    first, last, expected = {}, {}, {}
    for k, pos, v in sorted(rows, key=lambda r: r[1]):
        before = last.get(k), first.get(k)
        if v is not None:
            last[k] = v
            first.setdefault(k, v)
        expected[(k, pos)] = (last.get(k), first.get(k)) if inclusive else before
    assert {(r["k"], r["pos"]): (r["seen"], r["origin"]) for r in got.collect()} == expected


def test_a_hot_key_is_spread_over_tasks(spark):
    """Almost all rows have one key: no task of the window stage may get most of them."""
    key = F.when(F.col("id") % 10000 == 7, "cold").otherwise("hot")
    df = spark.range(40000).select(key.alias("k"), F.col("id").alias("pos"), F.col("id").alias("v"))
    got = carry_forward(df, ["k"], "pos", {"seen": F.col("v")}, width=1000)
    text = got._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning(__key" in text and "hashpartitioning(k#" not in text
    share = got.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
    assert share < 25000


def test_rows_that_compress_well_stay_spread(spark):
    """Adaptive execution joins parts by compressed bytes; it leaves alone a number of parts that was asked for."""
    key = F.when(F.col("id") % 10000 == 7, "cold").otherwise("hot")
    df = spark.range(40000).select(key.alias("k"), F.col("id").alias("pos"), F.col("id").alias("v"))
    got = carry_forward(df, ["k"], "pos", {"seen": F.col("v")}, width=1000)
    text = got._jdf.queryExecution().executedPlan().toString()
    assert any("hashpartitioning(__key" in line and "REPARTITION_BY_NUM" in line for line in text.splitlines())


def test_a_struct_carries_nulls(spark):
    df = spark.createDataFrame([("a", 1, None), ("a", 2, "x"), ("a", 30, None), ("a", 31, "y")], "k STRING, pos BIGINT, v STRING")
    got = carry_forward(df, ["k"], "pos", {"old": F.struct(F.col("v").alias("v"))}, width=10)
    assert [(r["pos"], r["old"] and (r["old"]["v"],)) for r in got.orderBy("pos").collect()] == [
        (1, None), (2, (None,)), (30, ("x",)), (31, (None,))]


@pytest.mark.parametrize("width", [1, 50, 1 << 16])
def test_percentiles_equal_a_sort(spark, width):
    rng = random.Random(width)
    rows = [(rng.choice("aab"), rng.choice([rng.randrange(-300, 300), 17, None])) for _ in range(500)]
    df = spark.createDataFrame(rows, "k STRING, v BIGINT")
    percents = {"min": 0, "p50": 50, "p95": 95, "max": 100}
    got = {(r["k"], r["percentile"]): r["v"] for r in exact_percentiles(df, ["k"], "v", percents, width).collect()}
    expected = {}
    for k in "ab":
        values = sorted(v for key, v in rows if key == k and v is not None)
        for name, p in percents.items():
            expected[(k, name)] = values[max(1, -(-len(values) * p // 100)) - 1]
    assert got == expected
