"""Connected components, and links between the members of shared blocks, as joins and aggregates."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changeloom.llm.tables import likely, stage


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(edges: DataFrame, purpose: str) -> DataFrame:
    """node, component (the smallest node that it reaches), one row per node that has an edge (a, b).

    Large-star and small-star steps in turn: each node's neighbours move to the smallest node it knows, first the
    larger ones, then the smaller. A step is two aggregates and two joins, in which a node with many edges is only the
    skewed side of a join. Rounds grow with the logarithm of the longest path; each one is written to the shared folder.
    """
    edges = edges.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    edges = stage(edges, purpose)
    before, now = None, _state(edges)
    while now != before:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        nearest = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.filter("v > u").join(nearest, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        nearest = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(nearest, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = stage(small.union(nearest.select("u", F.col("m").alias("v"))).distinct(), purpose)
        before, now = now, _state(edges)
    roots = edges.select(F.col("v").alias("node")).distinct().withColumn("component", F.col("node"))
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)


def _pairs(a: str, b: str) -> list:
    return [F.least(a, b).alias("a"), F.greatest(a, b).alias("b")]


def connect(members: DataFrame, possible: str, lead: list[str], confirm: Callable[[DataFrame], DataFrame],
            purpose: str) -> tuple[DataFrame, DataFrame]:
    """Components of the confirmed links between nodes that share a block; and the links (a, b) found.

    `members` has key, node and columns that `possible`, a condition on two of its rows called x and y, needs to tell
    pairs that cannot be linked. `confirm` takes distinct pairs (a, b), a < b, and returns those that are linked.

    Not all pairs of a block are tried: members of one component need no more links. So each block first tries the
    member that comes first by the `lead` columns against the others; blocks that still hold several components try one
    drawn at random; and what is then left is tried in full: each possible pair of different components. There the
    members of the largest component of a block are on one side only. No possible pair is left untried unless its two
    nodes are connected already.
    """
    members = stage(members, f"{purpose}-members")
    columns = members.columns

    def named(df: DataFrame, side: str, more: tuple[str, ...] = ()) -> DataFrame:
        return df.select("key", F.struct(*(c for c in columns if c != "key"), *more).alias(side))

    def against(firsts: DataFrame, others: DataFrame, more: str, known: tuple[str, ...] = (), here: str = "true") -> DataFrame:
        joined = named(firsts, "x", known).join(named(others, "y", known), "key")
        return joined.filter(f"x.node <> y.node AND ({more}) AND ({possible}) AND ({here})").select(*_pairs("x.node", "y.node")).distinct()

    def drawn(df: DataFrame, order: list) -> DataFrame:
        first = F.min(F.struct(*(F.col(c).alias(f"_{i}") if isinstance(c, str) else c.alias(f"_{i}") for i, c in enumerate(order)),
                               F.struct(*(c for c in df.columns if c != "key")).alias("row"))).alias("first")
        return df.groupBy("key").agg(first).select("key", "first.row.*")

    tried = stage(against(drawn(members, lead), members, "true"), f"{purpose}-tried")
    links = stage(confirm(tried), f"{purpose}-links")
    found = stage(components(links, f"{purpose}-stars"), f"{purpose}-components")
    for last in (False, True):
        placed = members.join(found, "node", "left").withColumn("part", F.coalesce("component", "node")).drop("component")
        parts = placed.groupBy("key", "part").agg(F.count(F.lit(1)).alias("n")).groupBy("key").agg(
            F.max(F.struct("n", "part")).alias("largest"), F.count(F.lit(1)).alias("parts")).filter("parts > 1")
        open_members = stage(placed.join(parts.select("key", F.col("largest.part").alias("big")), "key"), f"{purpose}-open")
        if last:
            apart = "x.part <> y.part AND (x.part = x.big OR x.part < y.part)"
            # a pair is made in the first block that both are in: each open block has all its pairs of different components
            blocks = open_members.groupBy("node").agg(F.collect_set("key").alias("keys"))  # as many as `members` has of a node
            dealt = open_members.join(blocks, "node")
            here = "key = array_min(array_intersect(x.keys, y.keys))"
            pairs = against(dealt, dealt.filter("part <> big"), apart, ("part", "big", "keys"), here)
        else:
            pairs = against(drawn(open_members, [F.xxhash64("key", "node")]), open_members, "x.part <> y.part", ("part",))
        fresh = stage(pairs.join(tried, ["a", "b"], "left_anti"), f"{purpose}-tried")
        more = stage(confirm(fresh), f"{purpose}-links")
        tried, links = tried.union(fresh), links.union(more)
        # a component is a star already: its members and the new links are all there is to connect
        stars = found.select(F.col("node").alias("a"), F.col("component").alias("b"))
        found = stage(components(stars.union(more), f"{purpose}-stars"), f"{purpose}-components")
    return found, links


def sharing(blocks: DataFrame, purpose: str) -> DataFrame:
    """The distinct rows of blocks (key, node and more) whose key is that of more than one node.

    A filter of the shared keys leaves nearly all other rows out before the join moves any, and equal rows go before the
    join deals the rows by key.
    """
    spread = blocks.groupBy("key").agg(F.min("node").alias("low"), F.max("node").alias("high")).filter("low <> high")
    shared = stage(spread.select("key"), purpose)
    return likely(blocks, shared, "key").distinct().join(shared, "key")
