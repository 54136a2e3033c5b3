"""Append sinks that are safe to retry: a batch owns one folder, and writing it again replaces that folder."""

from __future__ import annotations

import logging
import threading
from datetime import datetime

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from changeloom import schemas
from changeloom.operators import activity
from changeloom.sources.store import delete, folders

LOG = logging.getLogger(__name__)
#: Parts of a batch from this number on are its failed attempts.
RETRY_PART = 1000
#: The part of a batch that holds connector events.
CONNECTOR_PART = 500
#: The streams of one driver number their events one after another. Two drivers must not share a log.
APPENDING = threading.Lock()
#: The newest id of each log that this driver writes.
NEWEST: dict[str, int] = {}


def write_batch(df: DataFrame, path: str, batch_id: int) -> None:
    df.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")


def write_staging(staged: DataFrame, path: str, batch_id: int) -> None:
    write_batch(staged, path, batch_id)


def write_dead_letters(letters: DataFrame, path: str, batch_id: int) -> None:
    write_batch(letters, path, batch_id)


class EventLog:
    """The activity log on files. Each write is a part of a batch and replaces that part when it is repeated.

    Writing is best effort: a failure is logged and never fails the batch. Ids follow the newest one in the log, which is
    read once and then kept. The folder of a part is named by its first id, so a part that is written again takes the
    ids that it had: no reader sees its events anew, and they do not push later ones out of the log.
    What each part holds is one row of a small table beside the log, from which status and retention are answered.
    Retention drops whole parts, at most once per `PRUNE_SECONDS`; `read` leaves out the rest of what is too old.
    """

    PRUNE_SECONDS = 60
    PLACES = (T.StructField("batch_id", T.LongType()), T.StructField("part", T.IntegerType()), T.StructField("first_id", T.LongType()))

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")
        self._parts = f"{self.path}_parts"
        self._pruned: datetime | None = None

    def _stored(self) -> DataFrame:
        schema = T.StructType([*schemas.EVENT_LOG.fields, *self.PLACES])
        known = folders(self.spark, self.path)
        return self.spark.read.schema(schema).parquet(self.path) if known else schemas.empty(self.spark, schema)

    def stored(self) -> DataFrame:
        """Everything that is on files, with batch_id and part."""
        return self._stored().drop("first_id")

    def read(self, now: datetime) -> DataFrame:
        return activity.prune(self.stored().drop("batch_id", "part"), now)

    def _newest(self) -> int:
        if self.path not in NEWEST or not folders(self.spark, self.path):
            NEWEST[self.path] = self._stored().agg(F.max("id")).first()[0] or 0  # one number, once per driver
        return NEWEST[self.path]

    def append(self, events: DataFrame, batch_id: int, part: int = 0) -> bool:
        try:
            with APPENDING:
                place = f"{self.path}/batch_id={batch_id}/part={part}"
                newest = self._newest()
                before = [int(name[9:]) for name in folders(self.spark, place) if name.startswith("first_id=")]
                if not before:
                    self._write(events, place, newest + 1)
                    return True
                had = self.spark.read.parquet(f"{place}/first_id={before[0]}").agg(F.max("id")).first()[0] or before[0] - 1
                last = self._write(events, place, before[0])
                if last > had and newest > had:  # more events than it had, and others follow: all of them come anew
                    self._write(events, place, newest + 1)
                    delete(self.spark, f"{place}/first_id={before[0]}")
            return True
        except Exception:
            LOG.warning("activity events of batch %s not written", batch_id, exc_info=True)
            return False

    def _write(self, events: DataFrame, place: str, first: int) -> int:
        seen = Observation()
        numbered = activity.number(events, first - 1).observe(seen, *activity.part_summary())
        numbered.write.mode("overwrite").parquet(f"{place}/first_id={first}")
        found = seen.get
        last = found["last_id"] or first - 1
        row = [first if f.name == "first_id" else found[f.name] for f in schemas.LOG_PART]
        self.spark.createDataFrame([tuple(row)], schemas.LOG_PART).coalesce(1).write.mode("overwrite").parquet(
            place.replace(self.path, self._parts, 1))
        NEWEST[self.path] = max(NEWEST[self.path], last)
        return last

    def parts(self) -> DataFrame:
        """One row per part of the log, with batch_id and part."""
        schema = T.StructType([*schemas.LOG_PART.fields, *self.PLACES[:2]])
        known = folders(self.spark, self._parts)
        return self.spark.read.schema(schema).parquet(self._parts) if known else schemas.empty(self.spark, schema)

    def retries(self, batch_id: int) -> int:
        """How often a batch failed before."""
        return sum(int(name[5:]) >= RETRY_PART for name in folders(self.spark, f"{self.path}/batch_id={batch_id}") if name.startswith("part="))

    def prune(self, now: datetime) -> int:
        """Delete the parts of which retention keeps no event, but for the one with the newest; returns how many went."""
        if self._pruned is not None and (now - self._pruned).total_seconds() < self.PRUNE_SECONDS:
            return 0
        self._pruned = now
        parts = self.parts().select("batch_id", "part", F.col("last_id").alias("id"), F.col("last_ts").alias("ts"))
        newest = parts.agg(F.max("id")).scalar()
        gone = activity.prune(parts, now, newest, keep=False).where(F.col("id") < newest)
        places = gone.select("batch_id", "part").collect()  # one row per part on files
        for row in places:
            for table in (self.path, self._parts):
                delete(self.spark, f"{table}/batch_id={row['batch_id']}/part={row['part']}")
        return len(places)


def read_batches(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """All batches of a table, with `batch_id` from the folder names; filters on it prune folders."""
    return spark.read.schema(T.StructType([*schema.fields, T.StructField("batch_id", T.LongType())])).parquet(path)


def read_batch(spark: SparkSession, path: str, batch_id: int, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).parquet(f"{path}/batch_id={batch_id}")
