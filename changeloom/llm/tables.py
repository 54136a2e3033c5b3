"""Helpers of the operators here: sample tables, tables written between steps, and running sums over a global order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from changeloom.session import fresh_folder

#: Space, tab, line feed, vertical tab, form feed, carriage return; as a pattern for Java's and DuckDB's engines.
SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stage(df: DataFrame, purpose: str) -> DataFrame:
    """`df` written as Parquet to the shared folder and read again.

    This cuts the lineage: whatever executor is lost later, the rows are read from the folder. The files go when the
    session ends, as a lazy result may still need them.
    """
    spark = df.sparkSession
    path = fresh_folder(spark, purpose)
    df.write.parquet(path)
    there = spark._jvm.org.apache.hadoop.fs.Path(path)
    there.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(there)
    return spark.read.schema(df.schema).parquet(path)


def running_sums(df: DataFrame, order: list[str], sums: dict[str, str], purpose: str) -> DataFrame:
    """`df` with, for each `sums` item (new column: summed column), the sum over all rows up to and including this one.

    The order is global. It is cut into ranges, each summed on its own, and one row per range carries the sum of all
    earlier ranges; the driver and any one task see no more than one range or one row per range. `order` must be total,
    or the sums of equal rows may change places. The summed columns must not be null.
    """
    ranged = stage(df.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()), purpose)
    totals = ranged.groupBy("_range").agg(*(F.sum(c).alias(f"_{new}") for new, c in sums.items()))
    earlier = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        F.col("_range").alias("_of"), *(F.coalesce(F.sum(f"_{new}").over(earlier), F.lit(0)).alias(f"_{new}") for new in sums))
    within = Window.partitionBy("_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    inside = ranged.select("*", *(F.sum(c).over(within).alias(new) for new, c in sums.items()))
    # one row per range, of which there are as many as shuffle partitions: small enough to broadcast
    joined = inside.join(F.broadcast(offsets), inside["_range"] == offsets["_of"])
    return joined.select(*df.columns, *((F.col(new) + F.col(f"_{new}")).alias(new) for new in sums))


def words_in(text: str = "text") -> Column:
    """Number of words; null counts as empty."""
    return F.size(F.regexp_extract_all(F.coalesce(F.col(text), F.lit("")), F.lit(WORD), F.lit(0))).cast("long")


#: Rows of a filter with 64 bits each: 16 MB, whatever the number of keys.
FILTER = 1 << 20


def likely(df: DataFrame, keys: DataFrame, *names: str) -> DataFrame:
    """The rows of `df` that have a row with equal `names` in `keys`, and some of the others.

    A bit per hash decides, so that a join on these columns need not move most of the others: one in 60 at a million keys,
    and more the more keys there are.
    """
    place = F.pmod(F.xxhash64(*names), F.lit(64 * FILTER))
    bits = keys.select(place.alias("_place")).groupBy(F.expr("_place DIV 64").alias("_word")).agg(
        F.expr("bit_or(shiftleft(1L, CAST(_place % 64 AS INT)))").alias("_bits"))  # FILTER rows at most
    placed = df.withColumn("_place", place).withColumn("_word", F.expr("_place DIV 64")).join(F.broadcast(bits), "_word")
    return placed.filter("(shiftright(_bits, CAST(_place % 64 AS INT)) & 1) = 1").select(df.columns)


#: Buckets of document keys; a table with a row for each is 16 MB, whatever the size of the corpus.
KEY_BUCKETS = 1 << 20


def document_keys() -> tuple[Column, Column]:
    """_doc and _doc2, two hashes that name a document by its id and text. Rows that share both are one document."""
    return (F.xxhash64("doc_id", "text").alias("_doc"), F.xxhash64("text", "doc_id", F.lit(1)).alias("_doc2"))


def parted(docs: DataFrame, keys: DataFrame) -> tuple[DataFrame, DataFrame]:
    """`docs` with their keys: those whose key may be among `keys` (_doc, _doc2), and all others.

    A small table of buckets of keys decides, so that a join on the keys need not move the texts of the others.
    """
    bucket = F.pmod("_doc", F.lit(KEY_BUCKETS)).cast("int")
    some = F.broadcast(keys.select(bucket.alias("_bucket")).distinct())  # KEY_BUCKETS rows at most
    keyed = docs.select("*", *document_keys()).withColumn("_bucket", bucket)
    return keyed.join(some, "_bucket", "left_semi").drop("_bucket"), keyed.join(some, "_bucket", "left_anti").drop("_bucket")


def without(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """`docs` without the documents in `gone` (_doc, _doc2)."""
    touched, others = parted(docs, gone)
    left = touched.join(gone.select("_doc", "_doc2"), ["_doc", "_doc2"], "left_anti")
    return left.select(others.columns).union(others).drop("_doc", "_doc2")
