"""Order-dependent operators that stay parallel when one key holds a large share of the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SLICE_WIDTH = 1 << 16


def _dealt(rows: DataFrame, *by: str) -> DataFrame:
    """`rows` dealt by `by` over as many parts as the session shuffles into.

    A number of parts that is given is kept. Otherwise adaptive execution joins parts up to a size in compressed bytes;
    rows in order compress so well that one task would sort millions of them.
    """
    return rows.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), *by)


def carry_forward(
    df: DataFrame,
    keys: list[str],
    order: str,
    last: dict[str, Column],
    first: dict[str, Column] | None = None,
    inclusive: bool = False,
    width: int = SLICE_WIDTH,
) -> DataFrame:
    """Add, per row, the last (or first) non-null value of each expression among the earlier rows of the same key.

    `order` is an integer column, unique within a key. A window over the key alone would sort a hot key in one task.
    Instead the order axis is cut into slices of `width`, so that a window group has about `width` rows at most; the last
    value of each slice is pre-aggregated before its shuffle, and one row per key and slice carries it to the slices
    after it. `inclusive` lets a row see its own value. Wrap a value in a struct to carry nulls too (this is `lag`).
    """
    first = first or {}
    slice_id = F.expr(f"`{order}` DIV {width}")
    inputs = {f"__v_{name}": expr for name, expr in (last | first).items()}
    # The key as one struct: equal where both are null, and never taken for a partitioning by the bare key columns,
    # which would bring all slices of a hot key back into one task.
    rows = df.withColumns({"__key": F.struct(*keys), "__slice": slice_id, **inputs})

    def ends(name: str) -> Column:
        pick = F.max_by if name in last else F.min_by
        value = F.col(f"__v_{name}")
        return pick(value, F.when(value.isNotNull(), F.col(order))).alias(f"__v_{name}")

    def over(name: str, window) -> Column:
        pick = F.last if name in last else F.first
        return pick(f"__v_{name}", ignorenulls=True).over(window)

    names = list(last | first)
    before_slice = Window.partitionBy("__key").orderBy("__slice").rowsBetween(Window.unboundedPreceding, -1)
    in_slice = Window.partitionBy("__key", "__slice").orderBy(order).rowsBetween(
        Window.unboundedPreceding, 0 if inclusive else -1
    )
    carried = rows.groupBy("__key", "__slice").agg(*[ends(n) for n in names]).select(
        "__key", "__slice", *[over(n, before_slice).alias(f"__carried_{n}") for n in names]
    )
    local = _dealt(rows, "__key", "__slice").withColumns({f"__local_{n}": over(n, in_slice) for n in names})

    def nearest(name: str) -> Column:
        near, far = f"__local_{name}", f"__carried_{name}"
        return F.coalesce(near, far) if name in last else F.coalesce(far, near)

    return local.join(carried, ["__key", "__slice"], "left").select(
        *df.columns, *[nearest(n).alias(n) for n in names]
    )


def exact_percentiles(
    df: DataFrame, keys: list[str], value: str, percents: dict[str, int], width: int = SLICE_WIDTH
) -> DataFrame:
    """Exact discrete percentiles of a whole-number column, one row per key and percentile.

    The built-in exact percentile keeps all distinct values of a group in one buffer. Here rows are first counted per
    distinct value, spread over all tasks; the counts are summed per value range of `width` to find the range that
    holds each wanted rank, and only that range (at most `width` values) is looked at value by value.
    """
    counts = (
        df.where(F.col(value).isNotNull())
        .groupBy(*keys, F.col(value).cast("bigint").alias("__x"))
        .agg(F.count("*").alias("__c"))
        .withColumn("__range", F.expr(f"`__x` DIV {width}"))
    )
    ranges = counts.groupBy(*keys, "__range").agg(F.sum("__c").alias("__rc"))
    whole = Window.partitionBy(*keys)
    upto = whole.orderBy("__range").rowsBetween(Window.unboundedPreceding, 0)
    ranked = ranges.select(
        *keys, "__range", "__rc",
        F.sum("__rc").over(whole).alias("__n"),
        F.sum("__rc").over(upto).alias("__end"),
    )
    wanted = F.array(*[
        F.struct(F.lit(name).alias("name"), F.expr(f"greatest(1, (`__n` * {p} + 99) DIV 100)").alias("rank"))
        for name, p in percents.items()
    ])
    targets = (
        ranked.withColumn("__w", F.explode(wanted))
        .withColumn("__rank", F.col("__w.rank") - (F.col("__end") - F.col("__rc")))
        .where(F.col("__rank").between(1, F.col("__rc")))
        .select(*keys, "__range", F.col("__w.name").alias("percentile"), "__rank")
    )
    up_value = Window.partitionBy(*keys, "percentile").orderBy("__x").rowsBetween(Window.unboundedPreceding, 0)
    return (
        counts.join(targets, [*keys, "__range"])
        .withColumn("__end", F.sum("__c").over(up_value))
        .where((F.col("__end") >= F.col("__rank")) & (F.col("__end") - F.col("__c") < F.col("__rank")))
        .select(*keys, "percentile", F.col("__x").alias(value))
    )


def numbered(df: DataFrame, position: str, order: list[str], after: int = 0, width: int = SLICE_WIDTH) -> DataFrame:
    """Add `id`: after + 1, after + 2, ... in the order of `position` (an integer, not negative) and then `order`.

    The positions are cut into slices, each numbered on its own; one row per slice carries the number of earlier rows.
    """
    rows = df.withColumn("__slice", F.expr(f"`{position}` DIV {width}"))
    counts = rows.groupBy("__slice").agg(F.count("*").alias("__n"))
    earlier = Window.orderBy("__slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(F.col("__slice").alias("__of"), F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__before"))
    within = F.row_number().over(Window.partitionBy("__slice").orderBy(position, *order))
    joined = rows.withColumn("__within", within).join(offsets, F.col("__slice") == F.col("__of"))
    number = (F.lit(after) + F.col("__before") + F.col("__within")).cast("bigint")
    return joined.withColumn("id", number).select("id", *df.columns)
