"""Change feeds, legacy tables, commands, logs and polls derived from the sample tables (see FIXTURES.md).

Everything here is row-wise: the size of each input grows with the table it is made from.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from changeloom import schemas

TOPICS = [t for t, _, _ in schemas.TENANTS]
TENANT_IDS = [t for _, t, _ in schemas.TENANTS]
FAMILIES = [f for _, _, f in schemas.TENANTS]
OTHER_TOPIC = "other.public.person"


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def by_index(index: Column, values: list[str]) -> Column:
    chosen = F.when(index == 0, values[0])
    for i, v in enumerate(values[1:], 1):
        chosen = chosen.when(index == i, v)
    return chosen


def div(column: str, n: int) -> Column:
    return F.expr(f"{column} DIV {n}")


def every(column: str, n: int) -> Column:
    return F.col(column) % n == 0


def load_spread(spark: SparkSession, sf_dir: str, name: str, key: str) -> DataFrame:
    """A table spread over `changeloom.feed.parts` parts by its key; as it is where the session does not set that.

    Parsing a message costs far more than moving it. A feed in few parts (a small file, or topics of one partition
    each) would otherwise be parsed by as many tasks.
    """
    df = load(spark, sf_dir, name)
    parts = spark.conf.get("changeloom.feed.parts", None)
    return df.repartition(int(parts), key) if parts else df


def _json(sql: str) -> str:
    """A text as a JSON value. The sample texts hold nothing that needs escaping."""
    return f"""coalesce('"' || {sql} || '"', 'null')"""


def _one_of(index: str, values: list[str]) -> str:
    return f"CASE {index} " + " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(values)) + " END"


def change_feed(events: DataFrame) -> DataFrame:
    """Raw change messages from `events`: four topics, both envelope forms, and every kind of bad message."""
    legacy_id = "CAST(user_id DIV 4 AS STRING)"
    birth = "CASE WHEN event_id % 2 = 0 THEN CAST(event_id % 20000 AS STRING) ELSE " + _json(
        "CAST(date_add(DATE'1970-01-01', CAST(event_id % 20000 AS INT)) AS STRING)") + " END"
    city = "CASE WHEN event_id % 71 = 0 THEN repeat('c', 101) ELSE concat('city', event_id % 10) END"
    extra = _json("CASE WHEN event_id % 5 <> 0 THEN CAST(event_id % 100 AS STRING) END")
    firstname = _json("CASE WHEN event_id % 73 <> 0 THEN event_type END")
    after = f"""concat('{{', CASE WHEN event_id % 79 <> 0 THEN concat('"id":', {legacy_id}, ',') ELSE '' END,
        '"firstname":', {firstname}, ',"surname":"user-', user_id, '","date_of_birth":', {birth},
        ',"city":"', {city}, '"',
        CASE WHEN user_id % 4 < 2 THEN concat(',"data_1":"one","data_2":', {extra}, ',"data_3":"three"}}')
          ELSE concat(',"data_a":"one","data_b":"two","data_c":', {extra}, '}}') END)"""
    op = "CASE event_type WHEN 'error' THEN 'd' WHEN 'signup' THEN 'c' WHEN 'view' THEN 'r' ELSE 'u' END"
    payload = f"""CASE WHEN event_type = 'error' THEN concat('{{"op":"d","before":{{"id":', {legacy_id}, '}},"after":null}}')
        ELSE concat('{{"op":"', {op}, '","before":null,"after":', {after}, '}}') END"""
    return events.selectExpr(
        f"CASE WHEN event_id % 97 = 0 THEN '{OTHER_TOPIC}' ELSE {_one_of('user_id % 4', TOPICS)} END AS topic",
        "0 AS partition",
        "event_id AS offset",
        "ts AS timestamp",
        f"{payload} AS payload",
    ).selectExpr(
        "topic", "partition", "offset", "timestamp",
        """CAST(CASE WHEN offset % 89 = 0 THEN NULL WHEN offset % 83 = 0 THEN 'not json'
            WHEN offset % 3 = 0 THEN payload ELSE concat('{"payload":', payload, '}') END AS BINARY) AS value""",
    )


def halves(events: DataFrame, counted: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """The events below half of the row count, and the rest. The count is a subquery of the plan, not a driver step.

    `counted` is the same table before it was spread, so that counting it moves nothing.
    """
    rows = events if counted is None else counted
    middle = rows.agg(F.floor(F.count("*") / 2).cast("bigint")).scalar()
    return events.where(F.col("event_id") < middle), events.where(F.col("event_id") >= middle)


def message_halves(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return halves(load_spread(spark, sf_dir, "events", "event_id"), load(spark, sf_dir, "events"))


def legacy_source(customer: DataFrame, tenant_id: str) -> DataFrame:
    """One legacy table, with the columns of its own family only."""
    index = TENANT_IDS.index(tenant_id)
    family = FAMILIES[index]
    extra = F.col("c_nationkey").cast("string")
    data = [
        (extra if c == schemas.EXTRA_FIELD_COLUMN[family] else F.lit(None).cast("string")).alias(c)
        for c in schemas.FAMILY_COLUMNS[family]
    ]
    return customer.where(F.col("c_custkey") % 4 == index).select(
        div("c_custkey", 4).cast("int").alias("id"), *_customer_columns(), *data)


def _customer_columns() -> list[Column]:
    birth = F.date_add(F.lit("1970-01-01").cast("date"), (F.col("c_custkey") % 20000).cast("int"))
    return [
        F.lit("Customer").alias("firstname"),
        F.substring_index("c_name", "#", -1).alias("surname"),
        birth.alias("date_of_birth"),
        F.col("c_mktsegment").alias("city"),
    ]


def legacy_rows(customer: DataFrame) -> DataFrame:
    """All four legacy tables as one, in a single scan, with the columns of both families."""
    index = F.col("c_custkey") % 4
    family = by_index(index, FAMILIES)
    extra = F.col("c_nationkey").cast("string")
    data = []
    for owner, columns in schemas.FAMILY_COLUMNS.items():
        for c in columns:
            value = F.when(family == owner, extra) if c == schemas.EXTRA_FIELD_COLUMN[owner] else F.lit(None)
            data.append(value.cast("string").alias(c))
    return customer.select(
        by_index(index, TENANT_IDS).alias("tenant_id"),
        div("c_custkey", 4).cast("int").alias("legacy_id"),
        *_customer_columns(),
        *data,
    )


def commands(orders: DataFrame) -> DataFrame:
    """Write commands: creates, updates and legacy updates, by order status."""
    status = F.col("o_orderstatus")
    # Every 13th create uses the family's own columns.
    kind = (
        F.when((status == "O") & every("o_orderkey", 13), "legacy_create")
        .when(status == "O", "create")
        .when(status == "P", "update")
        .otherwise("legacy_update")
    )
    create = status == "O"
    tenant = F.when(every("o_orderkey", 61), "tenant_zz").otherwise(by_index(F.col("o_custkey") % 4, TENANT_IDS))
    # Some updates name an id that does not exist, that an earlier order created, or that a later one will create.
    legacy_id = (
        F.when(create, F.lit(1000000) + F.col("o_orderkey"))
        .when(every("o_orderkey", 37), F.lit(500000) + div("o_custkey", 4))
        .when(every("o_orderkey", 43), F.lit(1000000 - 43) + F.col("o_orderkey"))
        .when(every("o_orderkey", 47), F.lit(1000000 + 47) + F.col("o_orderkey"))
        .otherwise(div("o_custkey", 4))
    )
    absent = every("o_orderkey", 11)
    extra = F.when(absent, F.lit(None)).when(every("o_orderkey", 7), "").otherwise(F.col("o_orderpriority"))
    patch = F.when(every("o_orderkey", 9), F.col("o_orderdate").cast("date"))
    text = (F.col("o_orderkey") % 1000).cast("string")

    def data(i: int) -> Column:
        # Empty, missing and given texts alternate per column.
        return F.when((F.col("o_orderkey") + i) % 3 == 0, "").when(
            (F.col("o_orderkey") + i) % 3 == 1, F.concat(F.lit(f"d{i}-"), text)).cast("string")

    return orders.select(
        F.col("o_orderkey").alias("seq"),
        kind.alias("kind"),
        tenant.alias("tenant_id"),
        legacy_id.cast("int").alias("legacy_id"),
        F.col("o_orderpriority").alias("firstname"),
        F.when(~every("o_orderkey", 59), F.concat(F.lit("order-"), F.col("o_orderkey"))).alias("surname"),
        F.col("o_orderdate").cast("date").alias("date_of_birth"),
        F.when(~every("o_orderkey", 6), F.concat(F.lit("city"), F.col("o_orderkey") % 10)).alias("city"),
        extra.cast("string").alias("extra_field"),
        patch.alias("modernized_only"),
        *[data(i).alias(c) for i, c in enumerate(schemas.DATA_COLUMNS)],
        F.when(absent, F.array().cast("array<string>")).otherwise(F.array(F.lit("extra_field"))).alias("present"),
        F.col("o_orderdate").alias("written_at"),
    )


def activity_log(events: DataFrame) -> DataFrame:
    """`events` as an activity log."""
    kind = F.col("event_type")
    return events.select(
        F.col("event_id").alias("id"),
        "ts",
        F.when(kind == "purchase", "api").otherwise("cdc-consumer").alias("source"),
        kind.alias("stage"),
        F.when(kind == "error", "error").when(kind == "click", "warn").otherwise("info").alias("severity"),
        by_index(F.col("user_id") % 4, TENANT_IDS).alias("tenant_id"),
        div("user_id", 4).cast("int").alias("legacy_id"),
        F.concat(kind, F.lit(" by user "), F.col("user_id")).alias("message"),
        F.col("props").alias("detail"),
    )


def connector_polls(events: DataFrame) -> DataFrame:
    """`events` as connector polls, one name per poll; some polls get no answer."""
    up = ~every("event_id", 67)
    state = F.when(F.col("event_type") == "error", "FAILED").when(
        F.col("event_type") == "click", "PAUSED").otherwise("RUNNING")
    task = F.when(every("event_id", 5), F.array().cast("array<struct<state:string>>")).otherwise(
        F.array(F.struct(state.alias("state"))))
    return events.select(
        (F.col("user_id") % 4).cast("int").alias("cluster_id"),
        F.col("event_id").alias("poll_seq"),
        up.alias("reachable"),
        F.when(up, F.col("user_id").cast("string")).alias("name"),
        F.when(up, state).alias("state"),
        F.when(up, task).alias("tasks"),
    )
