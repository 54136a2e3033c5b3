import random

import pytest

from changeloom.operators import connectors as N
from changeloom.streaming import connectors as S

POLLS = "cluster_id INT, poll_seq BIGINT, reachable BOOLEAN, name STRING, state STRING, tasks ARRAY<STRUCT<state: STRING>>"


def polls(spark, sequence, cluster=0):
    """A sequence of answers, each a dict of states or None for no answer."""
    rows = []
    for i, answer in enumerate(sequence):
        if answer is None:
            rows.append((cluster, i, False, None, None, None))
        for name, state in (answer or {}).items():
            rows.append((cluster, i, True, name, state, [(state,)]))
    return spark.createDataFrame(rows, POLLS)


def expected_changes(df):
    """By rule: a report is news if it differs from the report of the same name in the latest earlier poll that has one,
    and a first report is unless it says RUNNING. A silent poll is news unless the poll before it was silent as well."""
    rows = [r.asDict() for r in df.collect()]
    silent = {r["poll_seq"] for r in rows if not r["reachable"]}
    state = {(r["poll_seq"], r["name"]): r["state"] for r in rows if r["reachable"]}
    polled = sorted({r["poll_seq"] for r in rows})
    before = dict(zip(polled[1:], polled))
    found = [(at, "debezium: unknown -> UNREACHABLE") for at in silent if before.get(at) not in silent]
    for (at, name), now in state.items():
        earlier = [seq for seq, other in state if other == name and seq < at]
        then = state[max(earlier), name] if earlier else None
        if now != then and (earlier or now != "RUNNING"):
            found.append((at, f"{name}: {then or 'unknown'} -> {now}"))
    return [text for _, text in sorted(found)]


def messages(df):
    return [r["message"] for r in df.orderBy("poll_seq", "name").collect()]


UP, FAILED = {"c1": "RUNNING"}, {"c1": "FAILED"}


@pytest.mark.parametrize("sequence, expected", [
    ([{"x": "PAUSED", "y": "RUNNING"}, {"y": "RUNNING"}, {"x": "RUNNING", "y": "FAILED"}],
     ["x: unknown -> PAUSED", "x: PAUSED -> RUNNING", "y: RUNNING -> FAILED"]),
    ([None, None, {"x": "RUNNING"}, None, {"x": "FAILED"}],
     ["debezium: unknown -> UNREACHABLE", "debezium: unknown -> UNREACHABLE", "x: RUNNING -> FAILED"]),
    ([{"x": "PAUSED"}, None, None, {"x": "PAUSED"}], ["x: unknown -> PAUSED", "debezium: unknown -> UNREACHABLE"]),
    ([{"x": "RUNNING"}, {}, {"x": "RUNNING"}], []),
])
def test_state_changes(spark, sequence, expected):
    assert messages(N.state_changes(polls(spark, sequence))) == expected


@pytest.mark.parametrize("width", [1, 5, 1 << 16])
def test_random_polls_equal_the_rule(spark, width):
    rng = random.Random(width)
    states = ["RUNNING", "RUNNING", "FAILED", "PAUSED"]
    sequence = [None if rng.random() < 0.2 else {n: rng.choice(states) for n in rng.sample("abcd", rng.randrange(1, 4))}
                for _ in range(120)]
    df = polls(spark, sequence)
    assert messages(N.state_changes(df, width)) == expected_changes(df)


def test_severity(spark):
    changes = N.state_changes(polls(spark, [UP, FAILED, {"c1": "PAUSED"}, UP, None])).orderBy("poll_seq").collect()
    assert [r["severity"] for r in changes] == ["error", "warn", "info", "error"]


def test_current_state_shows_only_the_outage_while_it_lasts(spark):
    assert [(r["name"], r["state"]) for r in N.current_state(polls(spark, [{"b": "FAILED", "a": "RUNNING"}, UP])).collect()] == [
        ("a", "RUNNING"), ("b", "FAILED"), ("c1", "RUNNING")]
    assert [(r["name"], r["state"]) for r in N.current_state(polls(spark, [UP, None])).collect()] == [
        ("debezium", "UNREACHABLE")]


def test_readiness_needs_running_tasks(spark):
    rows = [(0, 1, True, "ok", "RUNNING", [("RUNNING",)]), (0, 1, True, "none", "RUNNING", []),
            (0, 1, True, "task", "RUNNING", [("RUNNING",), ("FAILED",)]), (0, 1, True, "null", "RUNNING", None),
            (0, 1, True, "self", "PAUSED", [("RUNNING",)])]
    df = spark.createDataFrame(rows, POLLS)
    assert {r["name"]: r["ready"] for r in N.readiness(df).collect()} == {
        "ok": True, "none": False, "task": False, "null": False, "self": False}
    assert {r["name"] for r in N.restart_list(df).collect()} == {"none", "task", "null", "self"}


def test_stream_in_many_batches_equals_batch(spark, tmp_path):
    rng = random.Random(5)
    sequence = [None if rng.random() < 0.3 else {n: rng.choice(["RUNNING", "FAILED"]) for n in "ab" if rng.random() < 0.7}
                for _ in range(30)]
    df = polls(spark, sequence).select(*S.POLLS.names)
    run = S.batch_function(str(tmp_path))
    for batch, low in enumerate(range(0, 30, 6)):
        run(df.where(f"poll_seq >= {low} AND poll_seq < {low + 6}"), batch)
        if batch == 2:  # a batch that is retried
            run(df.where(f"poll_seq >= {low} AND poll_seq < {low + 6}"), batch)
    streamed = spark.read.schema(S.STATE_CHANGES).parquet(f"{tmp_path}/changes")
    assert messages(streamed) == messages(N.state_changes(df))


def test_names_may_come_late_and_old_polls_of_a_name_are_left_out(spark, tmp_path):
    from changeloom import schemas
    from changeloom.sources import sinks

    def one(name, seq, state):
        return (0, seq, True, name, state)

    log = sinks.EventLog(spark, f"{tmp_path}/log")
    run = S.batch_function(str(tmp_path), log)
    batches = [[one("c", 9, "FAILED")], [one("b", 5, "FAILED"), one("c", 7, "RUNNING")], [one("b", 6, "RUNNING"), one("c", 10, "PAUSED")]]
    for number, rows in enumerate(batches):
        run(spark.createDataFrame(rows, S.POLLS), number)
    found = spark.read.schema(S.STATE_CHANGES).parquet(f"{tmp_path}/changes")
    assert sorted(messages(found)) == ["b: FAILED -> RUNNING", "b: unknown -> FAILED", "c: FAILED -> PAUSED", "c: unknown -> FAILED"]
    events = log.stored().orderBy("id").collect()
    assert [(r["id"], r["stage"]) for r in events] == [(i, "connector") for i in range(1, 5)]
    assert events[0]["detail"] == '{"connector":"c","from":null,"to":"FAILED"}'
    assert set(schemas.EVENT_LOG.names) <= set(events[0].asDict())
