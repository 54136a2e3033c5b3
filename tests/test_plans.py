"""Plans that have to stay the way they are for large inputs."""

import re

import pytest

from changeloom.plans import queries
from changeloom.plans.queries import QUERIES

BATCH = [n for n in QUERIES if not n.startswith("stream_")]


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", BATCH)
def test_no_python_no_cartesian_no_single_task_window(spark, sf_dir, name):
    text = plan(QUERIES[name](spark, sf_dir))
    for node in ("PythonUDF", "ArrowEvalPython", "BatchEvalPython", "MapInPandas", "FlatMapGroupsInPandas",
                 "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert node not in text, node
    for line in text.splitlines():
        if re.search(r"[+\-:* ]Window \[", line):
            assert "], [" in line, line  # a window has partition keys


def test_decode_parses_each_message_once(spark, sf_dir):
    for name in ("decode_changes", "dead_letters", "merge_first", "event_log"):
        text = plan(QUERIES[name](spark, sf_dir))
        final = text.split("Initial Plan")[0]
        assert len(re.findall(r"VariantExpressionEvalUtils|parse_json\(", final)) <= 3, name


def test_latest_per_key_aggregates_before_its_shuffle(spark, sf_dir):
    text = plan(QUERIES["merge_first"](spark, sf_dir))
    assert "partial_max_by" in text
    assert "WindowGroupLimit" in plan(QUERIES["latest_window"](spark, sf_dir))


def test_top_rows_per_group_are_limited_before_the_shuffle(spark, sf_dir):
    assert "WindowGroupLimit" in plan(QUERIES["batch_summary"](spark, sf_dir))


def test_commands_are_not_partitioned_by_the_bare_key(spark, sf_dir):
    """The commands of a hot key go to one task per slice; only pre-aggregated keys meet the legacy rows."""
    text = plan(QUERIES["command_changes"](spark, sf_dir))
    for line in text.splitlines():
        if "Window [" in line:
            assert "__key" in line, line
    assert "Exchange hashpartitioning(__key" in text


def test_scans_read_only_what_they_need(spark, sf_dir):
    text = QUERIES["duplicate_keys"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<l_orderkey:bigint,l_linenumber:int>" in text
    text = QUERIES["event_feed_since"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(event_id), GreaterThan(event_id,1000)" in text
    assert "TakeOrderedAndProject" in text


def test_numbered_logs_are_made_once(spark, sf_dir):
    """Numbering reads its events twice; behind that is a folder, not the query that makes them."""
    for name in ("connector_log", "command_log", "event_log"):
        text = plan(QUERIES[name](spark, sf_dir))
        assert "events.parquet" not in text and "orders.parquet" not in text, name


def test_record_journey_parses_each_message_once(spark, sf_dir, monkeypatch):
    parsed = []
    written = queries.session.written

    def kept(df, purpose):
        parsed.append("try_variant_get" in plan(df) or "VariantExpressionEvalUtils" in plan(df))
        return written(df, purpose)

    monkeypatch.setattr(queries.session, "written", kept)
    QUERIES["record_journey"](spark, sf_dir)
    assert parsed == [False, True, False]  # commands, events of the consumer, log
