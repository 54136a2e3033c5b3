"""Mixing sources to target weights by weighted fair queueing.

Each source is a queue of its shuffled documents, up to `repeats` rounds long. A copy of a document has a virtual finish
time: the tokens of its source up to and including it, divided by the weight of the source. All copies are sorted by
that time, and the order is cut where the total budget is used up. As a source that runs dry leaves its share to the
others by their weights, the cut gives each source the tokens of `targets`, to within the document that is at the cut.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changeloom.llm.tables import running_sums, stage, words_in

WEIGHTS = (1, 2, 3)
REPEATS = 3


def _weight(rank: Column, weights: tuple[int, ...]) -> Column:
    """The weight of the source with this rank (from 1): the given weights in turn, again and again."""
    return F.element_at(F.array(*map(F.lit, weights)), (F.pmod(rank - 1, F.lit(len(weights))) + 1).cast("int")).cast("long")


def targets(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, repeats: int = REPEATS) -> DataFrame:
    """One row per source: rank (by code point, null last), weight, source_size, start (sizes of earlier sources), target.

    The targets share the sum of all sizes by weight; none exceeds `repeats` times the size of its source, and what
    is beyond that is shared again among the others. With the sources in order of size per weight, the share of a unit
    of weight, if all earlier sources were at their limit, has its highest value where that is just the case.
    """
    sizes = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    ranked = running_sums(
        sizes.withColumn("last", F.col("source").isNull()).withColumn("one", F.lit(1).cast("long")),
        ["last", "source"], {"rank": "one", "reached": "source_size"}, "mix-ranks")
    ranked = ranked.withColumn("weight", _weight(F.col("rank"), weights)).withColumn("start", F.col("reached") - F.col("source_size"))
    filled = running_sums(
        ranked.withColumn("fill", F.col("source_size") / F.col("weight")),
        ["fill", "rank"], {"sizes": "source_size", "weights": "weight"}, "mix-levels")
    budget, all_weights = filled.agg(F.max("sizes"), F.max("weights")).first()  # two scalars, and one more below
    level = filled.agg(F.max(
        (F.lit(budget) - repeats * (F.col("sizes") - F.col("source_size")))
        / (F.lit(all_weights) - F.col("weights") + F.col("weight")))).first()[0]
    return filled.select(
        "source", "rank", "weight", "source_size", "start", F.lit(budget).cast("long").alias("budget"),
        F.least((repeats * F.col("source_size")).cast("double"), F.lit(level).cast("double") * F.col("weight")).alias("target"))


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, repeats: int = REPEATS, seed: str = "mix") -> DataFrame:
    """doc_id, size, source_size, target (of its source), taken (size times the copies in the mix), one row per document.

    Size is the number of words; a null or empty text has size 0 and is never queued. A null source is a source of its
    own, the last one. Documents with a null id, and repeated rows, are queued like all others; of repeated rows, which
    are alike, some can have more copies in the mix. An empty table gives an empty result. Other columns are ignored.
    The order depends on the seed, the ids and the sizes only, so that reruns agree.
    """
    sized = stage(docs.select(
        "doc_id", "source", words_in().alias("size"),
        F.md5(F.concat_ws(":", F.lit(seed), F.col("doc_id").cast("string"))).alias("shuffled")), "mix-sizes")
    shares = stage(targets(sized, weights, repeats), "mix-targets")
    known = sized.join(shares, sized["source"].eqNullSafe(shares["source"])).drop("source")
    queued = running_sums(known.filter("size > 0"), ["rank", "shuffled", "doc_id", "size"], {"reached": "size"}, "mix-queue")
    copies = queued.withColumn("round", F.explode(F.sequence(F.lit(0), F.lit(repeats - 1)))).select(
        "doc_id", "size", "rank", "source_size", "target", "budget", "round", "reached",
        ((F.col("round") * F.col("source_size") + F.col("reached") - F.col("start")) / F.col("weight")).alias("finish"))
    sorted_copies = running_sums(copies, ["finish", "rank", "round", "reached"], {"used": "size"}, "mix-copies")
    taken = F.when(F.col("used") <= F.col("budget"), F.col("size")).otherwise(F.lit(0))
    # `reached` is different for all queued rows: it is the key of a row
    mixed = sorted_copies.groupBy("reached").agg(
        *(F.first(c).alias(c) for c in ("doc_id", "size", "source_size", "target")), F.sum(taken).alias("taken"))
    columns = ["doc_id", "size", "source_size", "target", "taken"]
    empty = known.filter("size = 0").withColumn("taken", F.lit(0).cast("long"))
    return mixed.select(columns).unionByName(empty.select(columns))
