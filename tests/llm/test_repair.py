"""Conversation repair against a search over all edits, row by row."""

import hashlib
import heapq
import random
import re
import zlib

import pyarrow.parquet as pq
import pytest

from changeloom.llm import repair
from changeloom.llm.queries import QUERIES

SPACE = " \t\n\x0b\x0c\r"
NAMES = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        place = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        code = zlib.crc32(place.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if code == 0:
            continue
        text = "" if code == 1 else re.sub("[.!?]", "", text) if code == 2 else text
        out += [(turn, "user" if code == 4 else role, text)] * (2 if code == 3 else 1)
    return sorted(out, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), hashlib.sha256(r[2].encode()).digest()))


def cheapest(rows, faults):
    """Dijkstra over (row, state) in the order of (cost, edits): the state is the initials so far, but for their middle."""
    def follow(state, initial):
        return {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}.get((state, initial))

    heap, done = [(0, "", 0, "", ())], set()
    while heap:
        cost, audit, at, state, out = heapq.heappop(heap)
        if (at, state) in done:
            continue
        done.add((at, state))
        if at == len(rows) and state in ("", "a"):
            return cost, audit, out
        for role in ("user", "assistant"):
            to = follow(state, role[0])
            if to:
                heapq.heappush(heap, (cost + 3, audit + "I", at, to, (*out, (role, ""))))
        if at < len(rows):
            _, role, text = rows[at]
            heapq.heappush(heap, (cost + 4, audit + "D", at + 1, state, out))
            if faults[at] in ("blank", "duplicate"):
                continue
            more = 3 if faults[at] == "truncated" else 0
            if follow(state, role[:1]):
                heapq.heappush(heap, (cost + more, audit + "K", at + 1, follow(state, role[:1]), (*out, (role, text))))
            for name in ("user", "assistant"):
                if follow(state, name[0]):
                    heapq.heappush(heap, (cost + 3 + more, audit + "R", at + 1, follow(state, name[0]), (*out, (name, text))))


def brute(rows):
    rows, seen, faults = damaged(rows), set(), []
    for _, role, text in rows:
        end = text.rstrip(SPACE)[-1:]
        faults.append("blank" if not end else "duplicate" if (role, text) in seen else "truncated" if end not in ".!?" else None)
        seen.add((role, text))
    turns = [t for t, _, _ in rows if t is not None]
    initials = [role[:1] for _, role, _ in rows]
    cost, audit, out = cheapest(rows, faults)
    text = "\n".join(f"{role}:{text}" for role, text in out)
    return (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, *(faults.count(f) for f in ("blank", "duplicate", "truncated")),
            sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])), cost, audit, hashlib.sha256(text.encode()).hexdigest())


def compared(result, rows):
    of = {}
    for row in rows:
        of.setdefault(row[0], []).append(row)
    found = result.collect()
    assert len(found) == len(of)
    got = {r["conv_id"]: tuple(r[n] for n in NAMES) for r in found}
    for conv_id, own in of.items():
        assert got[conv_id] == brute(own), conv_id


def test_query_equals_a_search(spark, sf_dir):
    table = pq.read_table(f"{sf_dir}/conversations.parquet", columns=["conv_id", "turn", "role", "text"])
    result = QUERIES["op12_repair_conversations"](spark, sf_dir)
    assert set(result.columns) == {"conv_id", *NAMES}
    compared(result, [tuple(r.values()) for r in table.to_pylist()])


def made(n, seed):
    rng = random.Random(seed)
    roles = ["user", "assistant", "system", "tool", "", "umpire", None]
    texts = ["Yes.", "No", " ", "", None, "What?\n", "Fine!", "word", "a.b", "Yes.", "é ", "x" * 50]
    rows = []
    for conv in [*range(n), None]:
        for _ in range(rng.choice([1, 2, 3, 5, 9, 14])):
            turn = rng.choice([None, *range(12)])
            text = rng.choice(texts)
            if rng.random() < 0.5:
                text = f"{text} {rng.random()}."
            rows.append((conv, turn, rng.choices(roles, [6, 6, 2, 1, 1, 1, 1])[0], text))
    return rows


@pytest.fixture
def conversations(spark):
    def make(rows, clash=True):
        df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
        for name in ("part", "kind", "fault", "copies", "digest", "audit", "entry", "cost", "first", "same", "code", "_key", "_keys") if clash else ():
            df = df.selectExpr("*", f"'x' AS `{name}`")
        return df
    return make


def test_edge_cases_equal_a_search(conversations):
    rows = made(150, 3)
    compared(repair.repair(conversations(rows)), rows)
    assert repair.repair(conversations(rows).filter("turn > 99")).count() == 0


def test_a_conversation_in_many_ranges(spark, conversations):
    """One conversation with most rows, before and after it small ones, and equal turns and rows in it."""
    rng = random.Random(7)
    hot = [(5, rng.choice([None, *range(700)]), rng.choice(["user", "assistant", "assistant", "system"]), rng.choice(["Yes.", "No", "", f"{i}!"])) for i in range(1500)]
    rows = made(12, 4) + hot + hot[:300]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "13")
    try:
        assert repair._several(spark, repair.judged(repair.damage(conversations(rows))).repartitionByRange(*repair.ORDER).selectExpr("*", "spark_partition_id() AS part")).count() > 0
        compared(repair.repair(conversations(rows)), rows)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "4")


@pytest.mark.parametrize("size", [1, 2, 3, 5])
def test_any_block_length_gives_the_same_edits(size):
    rng = random.Random(size)
    own, other = repair.Blocks(size), repair.Blocks(4)
    end = repair._normal(repair.END)[0]
    for _ in range(200):
        symbols = bytes(rng.choices(range(repair.SYMBOLS), k=rng.randrange(20)))
        found = []
        for tables in (own, other):
            vectors, cost = tables.back(symbols, tables.at[end])
            found.append((tables.edits(symbols, vectors, 0, True), cost + tables.vectors[vectors[0]][0]))
        assert found[0] == found[1]


def test_vectors_are_few():
    assert len(repair.Blocks(1).vectors) < 300
