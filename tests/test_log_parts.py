import datetime

import pytest
from pyspark.sql import functions as F

from changeloom.operators import activity as A
from changeloom.operators import progress as P
from changeloom.sources import sinks

NOW = datetime.datetime(2024, 1, 2, 12, 0, 0)


def events(spark, rows):
    """(position, minutes before NOW, source, severity)"""
    base = spark.createDataFrame(rows, "position long, ago double, source string, severity string")
    ts = F.lit(NOW).cast("timestamp_ntz") - F.make_interval(secs=F.col("ago") * 60)
    return base.select(
        "position", F.lit(0).alias("step"), F.lit(None).cast("string").alias("topic"), F.lit(0).alias("partition"), ts.alias("ts"),
        "source", F.lit("x").alias("stage"), "severity", F.lit(None).cast("string").alias("tenant_id"),
        F.lit(None).cast("int").alias("legacy_id"), F.lit("m").alias("message"), F.lit(None).cast("string").alias("detail"))


def both(log):
    by_parts = A.log_counts_by_parts(log.parts(), log.stored(), NOW).first().asDict()
    return by_parts, A.log_counts(log.read(NOW), NOW).first().asDict()


@pytest.mark.parametrize("rows_kept", [5000, 7])
def test_counts_by_parts_equal_a_scan(spark, tmp_path, monkeypatch, rows_kept):
    monkeypatch.setattr(A, "MAX_ROWS", rows_kept)
    log = sinks.EventLog(spark, f"{tmp_path}/log")
    assert both(log)[0] == both(log)[1] == {"last_consumer": None, "errors": 0, "recent": 0}
    log.append(events(spark, [(i, 2000.0, "cdc-consumer", "error") for i in range(3)]), 0)  # all too old
    log.append(events(spark, [(i, 1441.0 - i, "cdc-consumer", "error") for i in range(4)]), 1)  # the age limit cuts it
    log.append(events(spark, [(i, 30.0, "cdc-consumer", "info") for i in range(3)]), 2)
    log.append(events(spark, [(i, 2.0 - i / 2, "api", "error") for i in range(5)]), 3)  # the last minute cuts it
    log.append(events(spark, [(0, 0.25, "api", "error")]), 4)
    by_parts, scan = both(log)
    assert by_parts == scan and scan["recent"] == 3 and scan["errors"] == (9 if rows_kept == 5000 else 6)
    # a part that is written again has one row still
    log.append(events(spark, [(0, 0.25, "cdc-consumer", "info")]), 4)
    assert log.parts().count() == 5 and both(log)[0] == both(log)[1]


def test_retention_deletes_the_rows_of_the_parts_that_go(spark, tmp_path):
    log = sinks.EventLog(spark, f"{tmp_path}/log")
    log.append(events(spark, [(0, 3000.0, "api", "info")]), 0)
    log.append(events(spark, [(0, 1.0, "api", "info")]), 1)
    assert log.prune(NOW) == 1
    assert [r["batch_id"] for r in log.parts().collect()] == [1] == [r["batch_id"] for r in log.stored().collect()]


def test_a_part_that_no_limit_cuts_is_not_read(spark, tmp_path):
    log = sinks.EventLog(spark, f"{tmp_path}/log")
    log.append(events(spark, [(i, 30.0, "api", "error") for i in range(9)]), 0)
    gone = log.stored().where("false")
    assert A.log_counts_by_parts(log.parts(), gone, NOW).first()["errors"] == 9


def test_newest_offsets_of_a_progress_report():
    report = {"sources": [
        {"description": "KafkaV2", "latestOffset": '{"a": {"0": 12, "10": 1}, "b": {"2": 0}}'},
        {"description": "KafkaV2", "latestOffset": {"c": {"1": 5}}},
        {"description": "FileStreamSource", "latestOffset": '{"logOffset": 3}'},
        {"description": "none", "latestOffset": None}]}
    assert P.newest_offsets(report) == [("a", 0, 11), ("a", 10, 0), ("b", 2, -1), ("c", 1, 4)]
    assert P.newest_offsets({}) == []


def test_handled_offsets_count_every_message(spark):
    rows = spark.createDataFrame([("a", 0, 5), ("a", 0, 7), ("b", 1, 2)], "topic string, partition int, offset long")
    got = {tuple(r) for r in P.handled_offsets(rows).collect()}
    assert got == {("a", 0, 5, 7, 2), ("b", 1, 2, 2, 1)}
