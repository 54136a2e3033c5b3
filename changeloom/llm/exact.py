"""Exact dedup over an extendible-hash index on shared files.

Every text has a key, the 64-bit hash of its normalised form. A bucket of the index holds the keys that start with the
same `depth` bits. Where a bucket has more keys than it may hold, the directory doubles: its depth grows by one bit and
the bucket splits, until all buckets are small enough. Owner tasks take ranges of (bucket, key), compare the bytes of the
texts of a key, and chain those that differ: each link of a chain is one text, with the smallest id and the number of its
copies. The entries of the documents and the chains are tables in the shared folder.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from changeloom.llm.tables import SPACE, stage

BUCKET_KEYS = 65_536
#: The directory counts keys in cells of that many leading bits, and so can double that many times.
CELL_BITS = 20


def normalised(text: str = "text") -> Column:
    return F.regexp_replace(F.coalesce(F.col(text), F.lit("")), SPACE, " ")


def _prefix(key: Column, bits: int) -> Column:
    return F.shiftrightunsigned(key, 64 - bits) if bits else F.lit(0).cast("long")


def directory(keys: DataFrame, bucket_keys: int = BUCKET_KEYS, cell_bits: int = CELL_BITS) -> DataFrame:
    """cell, depth, bucket: to which bucket of the index each cell (the leading `cell_bits` of a key) points.

    `keys` has one row per distinct key. The keys are counted once by cell, and the counts of the shallower depths are
    sums of these. The depth of a cell is the smallest at which its bucket holds no more than `bucket_keys`; a bucket
    that is still overfull at the deepest level stays whole, as its chains are dealt by key, not by bucket.
    """
    cells = keys.groupBy(_prefix(F.col("key"), cell_bits).alias("cell")).agg(F.count(F.lit(1)).alias("n"))
    cells = stage(cells, "exact-cells")
    at = F.explode(F.sequence(F.lit(0), F.lit(cell_bits)))
    levels = cells.withColumn("depth", at).withColumn("prefix", F.expr(f"shiftright(cell, {cell_bits} - depth)"))
    fits = levels.groupBy("depth", "prefix").agg(F.sum("n").alias("held")).filter(
        (F.col("held") <= bucket_keys) | (F.col("depth") == cell_bits)).select("depth", "prefix")
    depths = levels.join(fits, ["depth", "prefix"]).groupBy("cell").agg(F.min("depth").alias("depth"))
    return depths.withColumn("bucket", F.expr(f"shiftleft(shiftright(cell, {cell_bits} - depth), {cell_bits} - depth)"))


def chains(docs: DataFrame, key: Column, bucket_keys: int = BUCKET_KEYS, cell_bits: int = CELL_BITS) -> DataFrame:
    """key, text_sha256, bucket, depth, link, keep_id, group_size: one row per distinct text, kept in the index files.

    Grouping by the text itself compares its bytes; copies are combined in each task before anything is shuffled.
    """
    texts = docs.select("doc_id", normalised().alias("plain")).withColumn("key", key)
    groups = texts.groupBy("key", "plain").agg(F.min("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    found = stage(groups.select("key", F.sha2("plain", 256).alias("text_sha256"), "keep_id", "group_size"), "exact-texts")
    cells = directory(found.select("key").distinct(), bucket_keys, cell_bits)
    placed = found.withColumn("cell", _prefix(F.col("key"), cell_bits)).join(cells, "cell")
    order = Window.partitionBy("bucket", "key").orderBy(F.asc_nulls_last("keep_id"), "text_sha256")
    owned = placed.repartitionByRange("bucket", "key").withColumn("link", F.row_number().over(order))
    return stage(owned.drop("cell"), "exact-index")


def dedup(docs: DataFrame, key: Column | None = None, bucket_keys: int = BUCKET_KEYS, cell_bits: int = CELL_BITS) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256, one row per row of `docs`; null text counts as empty.

    The row with the smallest id of a group stays; rows that repeat its id stay too, as nothing tells them apart. A
    null id is larger than any other: such a row stays only if no row with an id has the same text. An empty table
    gives an empty result; other columns are ignored. `key` replaces the hash of `plain` (tests force collisions).
    """
    key = F.xxhash64("plain") if key is None else key
    entries = stage(docs.select("doc_id", normalised().alias("plain")).select(
        "doc_id", key.alias("key"), F.sha2("plain", 256).alias("text_sha256")), "exact-entries")
    # texts without a copy need no look-up: their entry is all there is to know
    copied = chains(docs, key, bucket_keys, cell_bits).filter("group_size > 1").select(
        "key", "text_sha256", "keep_id", "group_size")
    size = F.coalesce(F.col("group_size"), F.lit(1).cast("long"))
    keep = F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id"))
    return entries.join(copied, ["key", "text_sha256"], "left").select(
        "doc_id", keep.alias("keep_id"), size.alias("group_size"), F.col("doc_id").eqNullSafe(keep).alias("kept"), "text_sha256")
