"""Table schemas and the tenant dimension. Every table has a fixed schema; only the message value is dynamic."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# Topic, tenant and schema family of each source database.
TENANTS = (
    ("legacy_a1.public.person", "tenant_a1", "legacy_a"),
    ("legacy_a2.public.person", "tenant_a2", "legacy_a"),
    ("legacy_b1.public.person", "tenant_b1", "legacy_b"),
    ("legacy_b2.public.person", "tenant_b2", "legacy_b"),
)

# The six columns that only one family has, and the one of each family that becomes extra_field.
FAMILY_COLUMNS = {
    "legacy_a": ("data_1", "data_2", "data_3"),
    "legacy_b": ("data_a", "data_b", "data_c"),
}
EXTRA_FIELD_COLUMN = {"legacy_a": "data_2", "legacy_b": "data_c"}
DATA_COLUMNS = FAMILY_COLUMNS["legacy_a"] + FAMILY_COLUMNS["legacy_b"]

COMMON_COLUMNS = ("firstname", "surname", "date_of_birth", "city")
TEXT_COLUMNS = ("firstname", "surname", "city") + DATA_COLUMNS
TEXT_LIMIT = 100

KEY = ["tenant_id", "legacy_id"]

CHANGES = T.StructType([
    T.StructField("topic", T.StringType()),
    T.StructField("partition", T.IntegerType()),
    T.StructField("offset", T.LongType()),
    T.StructField("timestamp", T.TimestampNTZType()),
    T.StructField("value", T.BinaryType()),
])

STAGING = T.StructType(
    [
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("tenant_id", T.StringType()),
        T.StructField("source_id", T.IntegerType()),
        T.StructField("source_table", T.StringType()),
        T.StructField("operation", T.StringType()),
        T.StructField("firstname", T.StringType()),
        T.StructField("surname", T.StringType()),
        T.StructField("date_of_birth", T.DateType()),
        T.StructField("city", T.StringType()),
    ]
    + [T.StructField(c, T.StringType()) for c in DATA_COLUMNS]
    # when the message was written, and when it was staged
    + [T.StructField("message_time", T.TimestampNTZType()), T.StructField("created_at", T.TimestampNTZType())]
)

PERSON = T.StructType([
    T.StructField("tenant_id", T.StringType()),
    T.StructField("legacy_id", T.IntegerType()),
    T.StructField("firstname", T.StringType()),
    T.StructField("surname", T.StringType()),
    T.StructField("date_of_birth", T.DateType()),
    T.StructField("city", T.StringType()),
    T.StructField("extra_field", T.StringType()),
    T.StructField("modernized_only", T.DateType()),
    T.StructField("synced_at", T.TimestampNTZType()),
    T.StructField("created_at", T.TimestampNTZType()),
    T.StructField("updated_at", T.TimestampNTZType()),
])

DEAD_LETTERS = T.StructType([
    T.StructField("topic", T.StringType()),
    T.StructField("partition", T.IntegerType()),
    T.StructField("offset", T.LongType()),
    T.StructField("tenant_id", T.StringType()),
    T.StructField("raw_value", T.StringType()),
    T.StructField("reason", T.StringType()),
    T.StructField("error", T.StringType()),
    T.StructField("created_at", T.TimestampNTZType()),
])

EVENT_LOG = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("ts", T.TimestampNTZType()),
    T.StructField("source", T.StringType()),
    T.StructField("stage", T.StringType()),
    T.StructField("severity", T.StringType()),
    T.StructField("tenant_id", T.StringType()),
    T.StructField("legacy_id", T.IntegerType()),
    T.StructField("message", T.StringType()),
    T.StructField("detail", T.StringType()),
])

# What a batch of the sync has handled of a topic partition.
HANDLED = T.StructType([
    T.StructField("topic", T.StringType()),
    T.StructField("partition", T.IntegerType()),
    T.StructField("first_offset", T.LongType()),
    T.StructField("offset", T.LongType()),
    T.StructField("messages", T.LongType()),
])

# What a part of the activity log holds.
LOG_PART = T.StructType([
    T.StructField("first_id", T.LongType()),
    T.StructField("last_id", T.LongType()),
    T.StructField("first_ts", T.TimestampNTZType()),
    T.StructField("last_ts", T.TimestampNTZType()),
    T.StructField("events", T.LongType()),
    T.StructField("errors", T.LongType()),
    T.StructField("last_consumer", T.TimestampNTZType()),
])

# An event before it is numbered: where it stands among the events of its batch, and the log's columns but the id.
EVENTS = T.StructType([
    T.StructField("position", T.LongType()),
    T.StructField("step", T.IntegerType()),
    T.StructField("topic", T.StringType()),
    T.StructField("partition", T.IntegerType()),
    *EVENT_LOG.fields[1:],
])


def tenants(spark: SparkSession, rows=TENANTS) -> DataFrame:
    """The tenant dimension (topic, tenant_id, legacy_type).

    An inline table has an exact size estimate, so Catalyst broadcasts it while it is below the broadcast threshold
    and shuffles it beyond. No hint is needed, and none would hold for a dimension of unknown size.
    """
    quoted = ", ".join("(" + ", ".join("'" + v.replace("'", "\\'") + "'" for v in row) + ")" for row in rows)
    return spark.sql(f"SELECT * FROM VALUES {quoted} AS t(topic, tenant_id, legacy_type)")


def empty(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """An empty table with the given schema, as an inline relation."""
    columns = ", ".join(f"CAST(NULL AS {f.dataType.simpleString()}) AS `{f.name}`" for f in schema)
    return spark.sql(f"SELECT {columns} WHERE false")
