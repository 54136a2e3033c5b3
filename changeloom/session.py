"""Session settings for local runs, and the shared folder for streaming checkpoints and written tables."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: str | int = "*", app: str = "changeloom", shuffle_partitions: int = 8) -> SparkSession:
    """A session for tests and the bench. On a cluster, use the cluster's own session instead."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("changeloom.feed.parts", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def written(df: DataFrame, purpose: str) -> DataFrame:
    """`df` written to a new folder and read again, for plans that need it more than once. The folder goes with the session."""
    spark = df.sparkSession
    path = fresh_folder(spark, purpose)
    df.write.parquet(path)
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(folder)
    return spark.read.schema(df.schema).parquet(path)


def shared_folder(spark: SparkSession) -> str:
    """The folder that all executors share: what `spark.checkpoint.dir` names.

    Where it is unset, a local session gets a temporary folder; a cluster session must set it, because a folder on
    one machine is not visible to the others.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return os.path.join(tempfile.gettempdir(), "changeloom")


def fresh_folder(spark: SparkSession, purpose: str) -> str:
    """A new path below the shared folder. Nothing is created until something is written there."""
    return f"{shared_folder(spark)}/{purpose}-{uuid.uuid4().hex}"
