"""Where change messages come from: a Kafka feed, files with the same columns, and snapshots of legacy tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from changeloom import schemas
from changeloom.functions.envelope import envelope
from changeloom.schemas import FAMILY_COLUMNS

#: The partition of snapshot rows. It is below those of the log, so in one batch any log event of a key comes after them.
SNAPSHOT_PARTITION = -1
#: What one micro-batch reads at most, unless a feed says otherwise: messages from Kafka, or files.
MAX_OFFSETS, MAX_FILES = 1_000_000, 64


def kafka_options(servers: str, topics: list[str] | None = None, max_offsets: int | None = None,
                  min_partitions: int | None = None) -> dict[str, str]:
    """Subscribe to the topics of all tenants, from the earliest offset.

    `max_offsets` bounds one micro-batch. `min_partitions` splits topic partitions over more tasks without a shuffle:
    a topic of one partition would otherwise be parsed by one task.
    """
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": ",".join(topics or [t for t, _, _ in schemas.TENANTS]),
        "startingOffsets": "earliest",
        "failOnDataLoss": "true",
    }
    if max_offsets:
        options["maxOffsetsPerTrigger"] = str(max_offsets)
    if min_partitions:
        options["minPartitions"] = str(min_partitions)
    return options


def _feed_columns(df: DataFrame) -> DataFrame:
    return df.select("topic", "partition", "offset", F.col("timestamp").cast("timestamp_ntz").alias("timestamp"), "value")


def read_changes(spark: SparkSession, spec: dict, stream: bool = False) -> DataFrame:
    """The change feed as (topic, partition, offset, timestamp, value), batch or streaming.

    `spec` is {"format": "kafka", "servers": ..., "topics": [...], "max_offsets": n, "min_partitions": n} (needs the Kafka connector on the
    class path) or {"format": "parquet", "path": ..., "max_files": n}.
    """
    reader = spark.readStream if stream else spark.read
    if spec["format"] == "kafka":
        options = kafka_options(spec["servers"], spec.get("topics"), spec.get("max_offsets", MAX_OFFSETS if stream else None),
                                spec.get("min_partitions"))
        return _feed_columns(reader.format("kafka").options(**options).load())
    if spec["format"] != "parquet":
        raise ValueError(f"unknown change feed format: {spec['format']}")
    if stream:
        reader = reader.option("maxFilesPerTrigger", spec.get("max_files", MAX_FILES))
    return _feed_columns(reader.schema(schemas.CHANGES).parquet(spec["path"]))


def read_legacy(spark: SparkSession, url: str, table: str, lower: int, upper: int, partitions: int,
                properties: dict[str, str] | None = None) -> DataFrame:
    """A legacy table over JDBC, read in parallel ranges of its id."""
    reader = spark.read.format("jdbc").options(
        url=url, dbtable=table, partitionColumn="id", lowerBound=lower, upperBound=upper, numPartitions=partitions)
    return reader.options(**(properties or {})).load()


def row_image(family: str) -> Column:
    """A legacy row of one family as the envelope holds it; dates are day numbers."""
    return F.struct(
        "id", "firstname", "surname", F.unix_date("date_of_birth").alias("date_of_birth"), "city",
        *FAMILY_COLUMNS[family],
    )


def snapshot_changes(legacy: DataFrame, topic: str, timestamp: Column, family: str | None = None) -> DataFrame:
    """Existing rows of one legacy table as change messages with op `r`, before all messages of the log. A row's id is its offset.

    A chunk that is read while the log goes on is merged by `unchanged_since`. `family` is the schema family of the table; a topic of the built-in dimension has one already.
    """
    family = family or {t: f for t, _, f in schemas.TENANTS}[topic]
    return legacy.select(
        F.lit(topic).alias("topic"),
        F.lit(SNAPSHOT_PARTITION).alias("partition"),
        F.col("id").cast("bigint").alias("offset"),
        timestamp.cast("timestamp_ntz").alias("timestamp"),
        envelope(F.lit("r"), None, row_image(family)).alias("value"),
    )


def unchanged_since(chunk: DataFrame, staging: DataFrame, low: Column | int) -> DataFrame:
    """The staged rows of a snapshot chunk that may be merged after what `staging` holds of the log.

    `low` is the newest log offset from before the chunk was read: what the log says up to there is in the chunk already. A
    key with a later event is left to the log, as the chunk may be older. One anti-join on the key, of the later events only.
    """
    later = staging.where((F.col("partition") > SNAPSHOT_PARTITION) & (F.col("offset") > low))
    return chunk.join(later.select("tenant_id", "source_id").distinct(), ["tenant_id", "source_id"], "left_anti").select(*chunk.columns)


def unify(sources: list[DataFrame]) -> DataFrame:
    """All sources as one table with the columns of both families; a column a source lacks is NULL."""
    union = sources[0]
    for source in sources[1:]:
        union = union.unionByName(source, allowMissingColumns=True)
    return union
