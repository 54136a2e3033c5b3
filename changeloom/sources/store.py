"""The current-state table, and the ledger of the batches that were merged into it.

`PersonTable` is a folder of Parquet files, partitioned by tenant and by a hash of the id. A merge reads and writes the
parts that its batch touches; all others keep their files. `CatalogTarget` is a table in a catalog with row-level changes.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from changeloom import schemas
from changeloom.operators import merge as M
from changeloom.schemas import KEY

#: Parts per tenant of a small table. At scale choose it so that a part is one file of a few hundred megabytes.
PARTS = 4


def _path(spark: SparkSession, name: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(name)
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())


def folders(spark: SparkSession, name: str) -> list[str]:
    """The names of the folders in a folder; none where it does not exist."""
    path, fs = _path(spark, name)
    return sorted(e.getPath().getName() for e in fs.listStatus(path) if e.isDirectory()) if fs.exists(path) else []


def delete(spark: SparkSession, name: str) -> None:
    path, fs = _path(spark, name)
    fs.delete(path, True)


class Ledger:
    """Which batches were merged, as ranges of batch ids: one row per range without gaps, whatever the target is.

    A new row takes in the one that it follows, and is written before that goes; so a reader finds each batch at least once.
    One driver writes a ledger; it reads the ranges once and then keeps them.
    """

    SCHEMA = T.StructType([T.StructField("first_batch", T.LongType()), T.StructField("applied_at", T.TimestampNTZType()),
                           T.StructField("last_batch", T.LongType())])

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")
        self._ranges: list[tuple[int, int]] | None = None

    def read(self) -> DataFrame:
        """first_batch, last_batch, applied_at; ranges may overlap after a failure."""
        known = self.spark.read.schema(self.SCHEMA).parquet(self.path) if folders(self.spark, self.path) else schemas.empty(self.spark, self.SCHEMA)
        return known.select("first_batch", "last_batch", "applied_at")

    def ranges(self) -> list[tuple[int, int]]:
        if self._ranges is None:
            self._ranges = sorted((row["first_batch"], row["last_batch"]) for row in self.read().collect())  # a row per range
        return self._ranges

    def last(self) -> int:
        return max((last for _, last in self.ranges()), default=-1)

    def holds(self, batch_id: int) -> bool:
        return any(first <= batch_id <= last for first, last in self.ranges())

    def record(self, first: int, last: int, now: datetime) -> None:
        before = [r for r in self.ranges() if r[0] <= first <= r[1] + 1]
        start = min([first, *(r[0] for r in before)])
        row = self.spark.range(1).select(F.lit(start).cast("bigint").alias("first_batch"), F.lit(now).cast("timestamp_ntz").alias("applied_at"))
        row.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/last_batch={last}")
        for _, old in before:
            if old != last:
                delete(self.spark, f"{self.path}/last_batch={old}")
        self._ranges = sorted([*(r for r in self.ranges() if r not in before), (start, last)])


class PersonTable:
    """The current-state table on files, with one folder per tenant and hash of the id.

    A batch is merged in two steps. The touched parts are written as they are to be, to a folder of their own, then the list
    of those parts; once both are complete, Spark's dynamic overwrite puts them in place. What a failure leaves between
    the steps is put in place before the next change, so that a part that was being replaced is not lost. A reader in
    the middle of the second step may miss a part; where that matters, use a `CatalogTarget`. The number of parts is that
    of the first write, kept in the path; the columns are those of an empty table beside the parts, as files that were
    written before a column came up do not have it.
    """

    PLACE = ["tenant_id", "part"]
    TOUCHED = "tenant_id STRING, part INT"

    def __init__(self, spark: SparkSession, path: str, parts: int = PARTS):
        self.spark = spark
        self.path = path.rstrip("/")
        known = [int(name[6:]) for name in folders(spark, self.path) if name.startswith("parts=")]
        self.parts = known[0] if known else parts
        self.data = f"{self.path}/parts={self.parts}"
        self.pending = f"{self.path}/_pending"
        self.columns = f"{self.path}/_columns"

    def part(self, key: str = "legacy_id") -> Column:
        return F.pmod(F.xxhash64(F.col(key).cast("bigint")), F.lit(self.parts)).cast("int")

    def _schema(self) -> T.StructType:
        known = [name for name in folders(self.spark, self.path) if name == "_columns"]
        return self.spark.read.parquet(self.columns).schema if known else schemas.PERSON

    def _files(self, path: str) -> DataFrame:
        schema = T.StructType([*self._schema().fields, T.StructField("part", T.IntegerType())])
        return self.spark.read.schema(schema).parquet(path).select(schema.names)

    def stored(self) -> DataFrame:
        """The table with the part of each row."""
        if not folders(self.spark, self.data):
            return schemas.empty(self.spark, schemas.PERSON).withColumn("part", F.lit(None).cast("int"))
        return self._files(self.data)

    def read(self) -> DataFrame:
        return self.stored().drop("part")

    def touched(self, staging: DataFrame, delete_mode: str = "dead_letter") -> list[tuple[str, int]]:
        """The parts that a batch changes: no more than the table has parts."""
        keys = M.accepted(staging, delete_mode).select("tenant_id", self.part("source_id").alias("part"))
        return sorted((row["tenant_id"], row["part"]) for row in keys.distinct().collect())

    def apply_batch(self, staging: DataFrame, batch_id: int, now: datetime, delete_mode: str = "dead_letter") -> bool:
        """Merge one batch; repeating it gives the same rows. Which batches were merged is the ledger's business."""
        self._finish()
        touched = self.touched(staging, delete_mode)
        if not touched:
            return False
        where = F.lit(False)
        for tenant in sorted({tenant for tenant, _ in touched}):  # both are folder names, so only these folders are read
            where = where | ((F.col("tenant_id") == tenant) & F.col("part").isin([p for t, p in touched if t == tenant]))
        self._replace(M.merge(self.stored().where(where).drop("part"), staging, now, delete_mode), f"batch_{batch_id}", touched)
        return True

    def patch(self, change: Callable[[DataFrame], DataFrame]) -> None:
        """Rewrite the table through `change`: target-only writes go here, between batches."""
        self._finish()
        parts = [(tenant[10:], int(part[5:])) for tenant in folders(self.spark, self.data) if tenant.startswith("tenant_id=")
                 for part in folders(self.spark, f"{self.data}/{tenant}")]
        self._replace(change(self.read()), f"patch_{uuid.uuid4().hex}", parts)

    def _replace(self, rows: DataFrame, name: str, touched: list[tuple[str, int]]) -> None:
        if rows.schema.names != self._schema().names or not folders(self.spark, self.data):
            rows.limit(0).coalesce(1).write.mode("overwrite").parquet(self.columns)
        placed = rows.withColumn("part", self.part()).repartition(*self.PLACE)  # one task per part, one file each
        placed.write.mode("overwrite").partitionBy(*self.PLACE).parquet(f"{self.pending}/{name}/rows")
        parts = self.spark.createDataFrame(touched, self.TOUCHED).coalesce(1)
        parts.write.mode("overwrite").parquet(f"{self.pending}/{name}/touched")
        self._finish()

    def _finish(self) -> None:
        """Put in place what was written in full, and delete what was not."""
        for name in folders(self.spark, self.pending):
            place = f"{self.pending}/{name}"
            done, fs = _path(self.spark, f"{place}/touched/_SUCCESS")
            if fs.exists(done):
                left = {(tenant[10:], int(part[5:])) for tenant in folders(self.spark, f"{place}/rows")
                        for part in folders(self.spark, f"{place}/rows/{tenant}")}
                if left:
                    ready = self._files(f"{place}/rows").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
                    ready.partitionBy(*self.PLACE).parquet(self.data)
                for row in self.spark.read.schema(self.TOUCHED).parquet(f"{place}/touched").collect():  # a row per part
                    if (row["tenant_id"], row["part"]) not in left:  # its last row was deleted
                        delete(self.spark, f"{self.data}/tenant_id={row['tenant_id']}/part={row['part']}")
            delete(self.spark, place)


def merge_into_sql(table: str, source: str, columns: list[str], delete_mode: str = "dead_letter") -> str:
    """The same upsert as one MERGE statement. `source` has the mapped columns, operation and had_delete.

    Columns that the target does not have yet are added to it, in catalogs that can.
    """
    own = [c for c in columns if c not in KEY and c != M.TARGET_ONLY]
    on = " AND ".join(f"t.{k} = s.{k}" for k in KEY)
    sets = [f"t.{c} = s.{c}" for c in own]
    insert = ", ".join([*KEY, *own])
    values = ", ".join(f"s.{c}" for c in [*KEY, *own])
    start = f"MERGE WITH SCHEMA EVOLUTION INTO {table} t USING {source} s ON {on} "
    if delete_mode != "apply":
        return (
            f"{start}WHEN MATCHED THEN UPDATE SET {', '.join(sets)} "
            f"WHEN NOT MATCHED THEN INSERT ({insert}) VALUES ({values})"
        )
    sets.append(f"t.{M.TARGET_ONLY} = CASE WHEN s.had_delete THEN NULL ELSE t.{M.TARGET_ONLY} END")
    return (
        f"{start}WHEN MATCHED AND s.operation = 'DELETE' THEN DELETE "
        f"WHEN MATCHED THEN UPDATE SET {', '.join(sets)} "
        f"WHEN NOT MATCHED AND s.operation <> 'DELETE' THEN INSERT ({insert}) VALUES ({values})"
    )


class CatalogTarget:
    """The current-state table in a catalog with row-level changes (Delta, Iceberg; needs its connector).

    A merge rewrites only what a batch touches, so its cost follows the batch and not the table. Repeating a batch
    changes nothing; which batches were merged is the ledger's business. `execute` runs the statement, by default in the session.
    """

    def __init__(self, spark: SparkSession, table: str, execute: Callable[[str], object] | None = None):
        self.spark = spark
        self.table = table
        self.execute = execute or spark.sql

    def read(self) -> DataFrame:
        return self.spark.table(self.table)

    def apply_batch(self, staging: DataFrame, batch_id: int, now: datetime, delete_mode: str = "dead_letter") -> bool:
        stamp = F.lit(now).cast("timestamp_ntz")
        incoming = M.map_columns(M.latest_per_key(M.accepted(staging, delete_mode))).withColumns(
            {"synced_at": stamp, "updated_at": stamp})
        view = f"changeloom_incoming_{uuid.uuid4().hex}"
        incoming.createOrReplaceTempView(view)
        try:
            columns = [c for c in incoming.columns if c not in ("operation", "had_delete")]
            self.execute(merge_into_sql(self.table, view, columns, delete_mode))
        finally:
            self.spark.catalog.dropTempView(view)
        return True
