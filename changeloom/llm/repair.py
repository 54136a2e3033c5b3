"""Conversation structure repair by the method of the Four Russians.

A conversation is a string of symbols, one per row: its role's initial and its fault. The cheapest edits that make the roles
read `(s?(ua)+)?` follow from one vector per row: the cost of finishing from each of four states. Vectors that differ by a
constant are one, so there are few; and a table says, for every vector and every block of `BLOCK` symbols, which vector
stands before the block and how much it costs. Rows are passed block by block, from the last to the first. Then the edits are read from
the first to the last, each block expanded backward from the vector behind it, so that of all cheapest edits the least
in ASCII order is found.

Conversations are cut where the rows are cut into ranges, wherever that is: a conversation of any length is spread over the
tasks. What lies in several ranges passes through one small matrix per range. Only the digest of the repaired text, which is
sequential by nature, reads each conversation in one stream.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterator
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from changeloom.llm.tables import stage

#: Symbols of a block.
BLOCK = 4
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
BLANK, DUPLICATE, CUT = 1, 2, 3
#: States: nothing yet, after the system's turn, after the user's, after the assistant's.
START, SYSTEM, USER, ASSISTANT = range(4)
#: The state that a rerole or an insert leads to, and its role.
NEXT = (USER, USER, ASSISTANT, USER)
NAMES = {USER: b"user", ASSISTANT: b"assistant"}
#: Kinds of rows by the initial of their role, the state that keeping one leads to, and the states that allow it.
KINDS = "uas"
KEPT = ((USER, (START, SYSTEM, ASSISTANT)), (ASSISTANT, (USER,)), (SYSTEM, (START,)), (START, ()))
LEGAL = {(2, 0), (0, 1), (1, 0)}
#: Symbols: a row that must go, and each kind, whole or truncated.
GONE, SYMBOLS = 0, 9
NEVER = 1 << 20
END = (0, 2 * INSERT, INSERT, 0)
COUNTS = ("cost", "blank", "duplicate", "truncated", "illegal", "turns")


def symbol(kind: int, fault: int) -> int:
    return GONE if fault in (BLANK, DUPLICATE) else 1 + 2 * kind + (fault == CUT)


def before(row: int, after: tuple[int, ...]) -> tuple[int, ...]:
    """The cost of finishing from each state before a row, from the costs behind it."""
    costs = [DELETE + cost for cost in after]
    if row != GONE:
        kind, cut = divmod(row - 1, 2)
        to, states = KEPT[kind]
        for state in range(4):
            costs[state] = min(costs[state], REROLE + TRUNCATED * cut + after[NEXT[state]])
            if state in states:
                costs[state] = min(costs[state], KEEP + TRUNCATED * cut + after[to])
    for _ in range(2):  # no more than two inserts lead anywhere else
        costs = [min(cost, INSERT + costs[NEXT[state]]) for state, cost in enumerate(costs)]
    return tuple(min(cost, NEVER) for cost in costs)


def _normal(vector: tuple[int, ...]) -> tuple[tuple[int, ...], int]:
    least = min(vector)
    return tuple(cost - least if cost < NEVER else NEVER for cost in vector), least


class Blocks:
    """All vectors that can occur, and the step from each over every symbol and every block of symbols."""

    def __init__(self, size: int = BLOCK) -> None:
        self.size = size
        units = [tuple(0 if state == at else NEVER for state in range(4)) for at in range(4)]
        self.vectors = list(dict.fromkeys([_normal(END)[0], *units]))
        self.at = {vector: i for i, vector in enumerate(self.vectors)}
        steps = []
        for vector in self.vectors:  # grows as new vectors come up
            row = []
            for s in range(SYMBOLS):
                found, cost = _normal(before(s, vector))
                if found not in self.at:
                    self.at[found] = len(self.vectors)
                    self.vectors.append(found)
                row.append((self.at[found], cost))
            steps.append(row)
        step = np.array(steps, np.int32)
        self.powers = SYMBOLS ** np.arange(size)
        digits = np.array(list(product(range(SYMBOLS), repeat=size)))[:, ::-1]  # row b holds the digits of number b
        at = np.arange(len(steps))[:, None] + np.zeros(len(digits), int)
        cost = np.zeros_like(at)
        for place in range(size - 1, -1, -1):
            cost += step[at, digits[None, :, place], 1]
            at = step[at, digits[None, :, place], 0]
        self.step, self.block, self.block_cost = step, at.astype(np.int32), cost.astype(np.int32)
        self._known: dict = {}

    def back(self, symbols: bytes, vector: int) -> tuple[list[int], int]:
        """The vectors behind each block, the first block first and what stands before it at the head; and the cost."""
        odd = len(symbols) % self.size
        numbers = (np.frombuffer(symbols, np.uint8)[odd:].reshape(-1, self.size) @ self.powers).tolist()
        found, cost = [vector], 0
        for number in reversed(numbers):
            cost += int(self.block_cost[vector, number])
            vector = int(self.block[vector, number])
            found.append(vector)
        for s in reversed(symbols[:odd]):
            vector, more = map(int, self.step[vector, s])
            cost += more
        if odd:
            found.append(vector)
        return found[::-1], cost

    def expand(self, symbols: bytes, behind: int, state: int) -> tuple[str, int]:
        """The least of the cheapest edits of one block from a state on, and the state behind it."""
        key = (symbols, behind, state)
        if key not in self._known:
            costs = [self.vectors[behind]]
            for s in reversed(symbols):
                costs.append(before(s, costs[-1]))
            costs.reverse()
            letters, at = [], 0
            while at < len(symbols):
                here, after, s = costs[at][state], costs[at + 1], symbols[at]
                kind, cut = divmod(s - 1, 2)
                to, states = KEPT[kind] if s != GONE else (START, ())
                if DELETE + after[state] == here:
                    letters.append("D")
                elif INSERT + costs[at][NEXT[state]] == here:
                    letters.append("I")
                    state = NEXT[state]
                    continue
                elif state in states and KEEP + TRUNCATED * cut + after[to] == here:
                    letters.append("K")
                    state = to
                else:
                    letters.append("R")
                    state = NEXT[state]
                at += 1
            self._known[key] = "".join(letters), state
        return self._known[key]

    def edits(self, symbols: bytes, vectors: list[int], state: int, last: bool) -> tuple[str, int]:
        """The edits of a run of rows from a state on; `last` if no rows follow."""
        odd, parts = len(symbols) % self.size, []
        cuts = [0, odd, *range(odd + self.size, len(symbols) + 1, self.size)] if odd else range(0, len(symbols) + 1, self.size)
        for at, upto, behind in zip(cuts, cuts[1:], vectors[1:]):
            letters, state = self.expand(symbols[at:upto], behind, state)
            parts.append(letters)
        while last and END[state]:
            parts.append("I")
            state = NEXT[state]
        return "".join(parts), state


def damage(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, copies: some rows dropped, emptied, cut, repeated or given another role, by a checksum."""
    place = F.concat(F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), F.lit(":"), F.coalesce(F.col("turn").cast("string"), F.lit(" ")))
    code = (F.crc32(place) % 20).alias("code")
    rows = conversations.select(
        "conv_id", "turn", F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"), code)
    text = F.when(F.col("code") == 1, "").when(F.col("code") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    return rows.where("code <> 0").select(
        "conv_id", "turn", F.when(F.col("code") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"),
        F.when(F.col("code") == 3, 2).otherwise(1).alias("copies"))


ORDER = ["conv_id", "turn", "role", "digest"]


def digested(rows: DataFrame) -> DataFrame:
    return rows.withColumn("digest", F.unhex(F.sha2("text", 256)))


def judged(rows: DataFrame) -> DataFrame:
    """One row per distinct (conv_id, turn, role, text): its kind, the fault of its first copy, and the number of copies.

    The texts stay behind: their digests tell which are equal. A text with a third of all rows is counted before it is
    shuffled, and its first turn is joined, so that Spark splits it.
    """
    last = F.right(F.rtrim("text", F.lit(" \t\n\x0b\x0c\r")), F.lit(1))
    fault = F.when(last == "", BLANK).when(last.isin(".", "!", "?"), 0).otherwise(CUT)
    initial = F.left("role", F.lit(1))
    kind = F.when(initial == "u", 0).when(initial == "a", 1).when(initial == "s", 2).otherwise(3)
    light = digested(rows.select("conv_id", "turn", "role", "text", "copies", fault.alias("fault"), kind.alias("kind")))
    distinct = light.groupBy(*ORDER, "fault", "kind").agg(F.sum("copies").alias("copies"))
    # as one struct, nulls are equal, and the least of the turns may be null
    text = F.struct("conv_id", "role", "digest")
    seen = distinct.where(F.col("fault") != BLANK).groupBy(text.alias("same")).agg(F.min(F.struct("turn")).alias("first"), F.count("*").alias("turns"))
    firsts = seen.where("turns > 1").select("same", "first")
    joined = distinct.withColumn("same", text).join(firsts, "same", "left")
    repeated = F.col("first").isNotNull() & (F.col("first") != F.struct("turn"))
    return joined.select(*ORDER, "kind", F.when(repeated, DUPLICATE).otherwise(F.col("fault")).alias("fault"), "copies")


class Run:
    """The rows of one conversation in one range: their symbols and what is counted of them."""

    def __init__(self, part: int, conv_id, kind: int | None, turn: int | None) -> None:
        self.part, self.conv_id = part, conv_id
        self.symbols = bytearray()
        self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.kind, self.turn, self.least = kind, turn, None

    def add(self, turn: int | None, kind: int, fault: int, copies: int) -> None:
        self.symbols.append(symbol(kind, fault))
        self.symbols.extend(bytes(copies - 1))
        if fault == BLANK:
            self.blank += copies
        else:
            self.duplicate += copies - (fault != DUPLICATE)
            self.truncated += fault == CUT
        self.illegal += copies - 1 + (self.kind is not None and (self.kind, kind) not in LEGAL)
        self.kind = kind
        if turn is not None:
            self.turns += turn != self.turn
            self.turn = turn
            self.least = turn if self.least is None else self.least

    def most(self) -> int | None:
        return None if self.least is None else self.turn


def runs(batches: Iterator[pa.RecordBatch], left: dict) -> Iterator[Run]:
    """The runs of a stream of rows in order. `left` has the kind and turn that stand before a run in another range."""
    run = None
    for batch in batches:
        for part, conv_id, *row in zip(*(batch.column(c).to_pylist() for c in ("part", "conv_id", "turn", "kind", "fault", "copies"))):
            if run is None or (part, conv_id) != (run.part, run.conv_id):
                if run is not None:
                    yield run
                run = Run(part, conv_id, *left.get((part, conv_id), (None, None))[:2])
            run.add(*row)
    if run is not None:
        yield run


def _rows(schema: pa.Schema, rows: Iterator[tuple], held: int = 5_000) -> Iterator[pa.RecordBatch]:
    out = []

    def batch() -> pa.RecordBatch:
        return pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)

    for row in rows:
        out.append(row)
        if len(out) == held:
            yield batch()
            out.clear()
    if out:
        yield batch()


def _several(spark: SparkSession, ranged: DataFrame) -> DataFrame | None:
    """The conversations that lie in more than one range: no more than there are ranges."""
    ends = ranged.groupBy("part").agg(F.min(F.struct("conv_id")).alias("a"), F.max(F.struct("conv_id")).alias("b")).collect()
    ends.sort(key=lambda row: row["part"])
    cut = list(dict.fromkeys(row["b"]["conv_id"] for row, after in zip(ends, ends[1:]) if row["b"] == after["a"]))
    return spark.createDataFrame([(c,) for c in cut], f"conv_id {dict(ranged.dtypes)['conv_id']}") if cut else None


def _where(df: DataFrame, keys: DataFrame) -> DataFrame:
    """The rows whose columns are among the keys; nulls are equal."""
    names = keys.columns
    return df.join(keys.select(F.struct(*names).alias("_keys")), F.struct(*[df[c] for c in names]) == F.col("_keys"), "left_semi")


def repaired(spark: SparkSession, rows: DataFrame, size: int = BLOCK) -> DataFrame:
    """conv_id, cost, audit, counts, least and most turn, one row per conversation that has rows."""
    ranged = stage(judged(rows).repartitionByRange(*ORDER).withColumn("part", F.spark_partition_id()), "repair-rows")
    kind = dict(ranged.dtypes)["conv_id"]

    def in_order(df: DataFrame) -> DataFrame:
        return df.repartition("part").sortWithinPartitions("part", *ORDER).select("part", "conv_id", "turn", "kind", "fault", "copies")

    def matrices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Blocks(size)

        def rows() -> Iterator[tuple]:
            for run in runs(batches, {}):
                costs = []
                for at in range(4):
                    unit = tuple(0 if state == at else NEVER for state in range(4))
                    found, cost = known.back(bytes(run.symbols), known.at[unit])
                    costs += [cost + c if c < NEVER else NEVER for c in known.vectors[found[0]]]
                yield run.part, run.conv_id, run.kind, run.most(), costs

        yield from _rows(pa.schema([("part", pa.int32()), ("conv_id", arrow), ("kind", pa.int32()), ("turn", pa.int64()), ("costs", pa.list_(pa.int64()))]), rows())

    arrow = pa.string() if kind == "string" else pa.int32() if kind == "int" else pa.int64()
    several = _several(spark, ranged)
    context: dict = {}
    chains = defaultdict(list)
    if several is not None:
        cut = in_order(_where(ranged, several)).mapInArrow(matrices, f"part int, conv_id {kind}, kind int, turn long, costs array<long>")
        for row in cut.collect():  # two rows per range at most
            chains[row["conv_id"]].append(row)
        known = Blocks(size)
        for conv_id, chain in chains.items():
            chain.sort(key=lambda row: row["part"])
            vector = _normal(END)[0]
            behind = []
            for row in reversed(chain):
                behind.append(known.at[vector])
                costs = np.array(row["costs"]).reshape(4, 4)
                vector = _normal(tuple(int(c) for c in (costs + np.array(vector)[:, None]).min(axis=0)))[0]
            last, turn = None, None
            for row, vector in zip(chain, reversed(behind)):
                context[row["part"], conv_id] = (last, turn, vector, row is chain[-1])
                last, turn = row["kind"], turn if row["turn"] is None else row["turn"]

    counts = pa.schema([("part", pa.int32()), ("conv_id", arrow), ("entry", pa.int32()), ("leaves", pa.int32()), ("audit", pa.string()),
                        *((c, pa.int64()) for c in COUNTS), ("least", pa.int64()), ("most", pa.int64())])

    def edited(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Blocks(size)
        whole = known.at[_normal(END)[0]]

        def rows() -> Iterator[tuple]:
            for run in runs(batches, context):
                symbols = bytes(run.symbols)
                _, _, behind, last = context.get((run.part, run.conv_id), (None, None, whole, True))
                vectors, cost = known.back(symbols, behind)
                # where the state before the run is not known yet, the edits from each state
                for entry in range(4) if (run.part, run.conv_id) in context else (None,):
                    audit, state = known.edits(symbols, vectors, entry or START, last)
                    paid = cost + known.vectors[vectors[0]][entry or START] - (0 if last else known.vectors[behind][state])
                    yield (run.part, run.conv_id, entry, state, audit, paid, run.blank, run.duplicate, run.truncated, run.illegal,
                           run.turns, run.least, run.most())

        yield from _rows(counts, rows(), 500)

    sql = f"part int, conv_id {kind}, entry int, leaves int, audit string, {', '.join(f'{c} long' for c in COUNTS)}, least long, most long"
    found = in_order(ranged).mapInArrow(edited, sql)
    if several is None:
        return found.drop("part", "entry", "leaves")
    found = stage(found, "repair-edits")
    ways = {(r["part"], r["conv_id"], r["entry"]): r["leaves"] for r in found.where("entry IS NOT NULL").select("part", "conv_id", "entry", "leaves").collect()}
    taken = []
    for conv_id, chain in chains.items():
        state = START
        for row in chain:
            taken.append((row["part"], conv_id, state))
            state = ways[row["part"], conv_id, state]
    chosen = _where(found, spark.createDataFrame(taken, f"part int, conv_id {kind}, entry int"))
    joined = chosen.groupBy("conv_id").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("part", "audit"))), lambda p: p["audit"]), "").alias("audit"),
        *(F.sum(c).alias(c) for c in COUNTS), F.min("least").alias("least"), F.max("most").alias("most"))
    return found.where("entry IS NULL").drop("part", "entry", "leaves").unionByName(joined)


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[object, str]]:
    """conv_id and digest of the repaired rows, from a stream in which the edits of a conversation stand before its rows."""
    current = None  # conv_id, edits, place in them, state, digest, whether nothing was written yet

    def write(role: bytes, text: bytes) -> None:
        if not current["empty"]:
            current["digest"].update(b"\n")
        current["digest"].update(role + b":" + text)
        current["empty"] = False

    def insert() -> None:
        edits = current["edits"]
        while current["at"] < len(edits) and edits[current["at"]] == "I":
            current["state"] = NEXT[current["state"]]
            write(NAMES[current["state"]], b"")
            current["at"] += 1

    for batch in batches:
        columns = [batch.column(c) for c in ("conv_id", "audit", "role", "text", "copies")]
        for conv_id, audit, role, text, copies in zip(*columns):
            if audit.is_valid:
                if current is not None:
                    insert()
                    yield current["conv_id"], current["digest"].hexdigest()
                current = {"conv_id": conv_id.as_py(), "edits": audit.as_py(), "at": 0, "state": START, "digest": hashlib.sha256(), "empty": True}
                continue
            for _ in range(copies.as_py()):
                insert()
                edit = current["edits"][current["at"]]
                current["at"] += 1
                if edit == "K":
                    own = role.as_py()
                    current["state"] = KEPT[KINDS.index(own[:1].decode())][0]
                    write(own, text.as_py())
                elif edit == "R":
                    current["state"] = NEXT[current["state"]]
                    write(NAMES[current["state"]], text.as_py())
    if current is not None:
        insert()
        yield current["conv_id"], current["digest"].hexdigest()


def repair(conversations: DataFrame, size: int = BLOCK) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256, one row per conv_id.

    The rows are damaged first (see `damage`); everything refers to the rows after that, in the order of turn, nulls first.
    Rows of one turn stand in the order of role, and then of the SHA-256 of their text; equal rows are duplicates of the first.
    Null ids are one conversation, a null role or text is one space. Other columns change nothing, and an empty table gives an
    empty result. A text of any length is one row of one task; a conversation of any length is spread over tasks, but for
    its digest, and its edits are one text.
    """
    spark = conversations.sparkSession
    rows = damage(conversations)
    edits = repaired(spark, rows, size)
    blank = {"audit": F.lit(""), **{c: F.lit(0).cast("long") for c in COUNTS}, "least": F.lit(None).cast("long"), "most": F.lit(None).cast("long")}
    everyone = conversations.select("conv_id", *(v.alias(k) for k, v in blank.items()))
    counted = edits.unionByName(everyone).groupBy("conv_id").agg(
        F.max("audit").alias("audit"), *(F.max(c).alias(c) for c in COUNTS), F.min("least").alias("least"), F.max("most").alias("most"))
    counted = stage(counted, "repair-counts")
    kind = dict(counted.dtypes)["conv_id"]
    arrow = pa.string() if kind == "string" else pa.int32() if kind == "int" else pa.int64()
    heads = counted.select("conv_id", "audit")
    texts = digested(rows).select("conv_id", "turn", "role", "digest", F.col("text").cast("binary").alias("text"), "copies")
    stream = heads.unionByName(texts, allowMissingColumns=True).repartition("conv_id").sortWithinPartitions(
        "conv_id", F.col("audit").isNull(), *ORDER[1:]).select("conv_id", "audit", F.col("role").cast("binary").alias("role"), "text", "copies")

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _rows(pa.schema([("conv_id", arrow), ("repaired_sha256", pa.string())]), _digests(batches))

    hashed = stream.mapInArrow(digests, f"conv_id {kind}, repaired_sha256 string")
    wide = "decimal(38,0)"
    gaps = F.coalesce((F.col("most").cast(wide) - F.col("least").cast(wide) + 1 - F.col("turns")).try_cast("long"), F.lit(0).cast("long"))
    return counted.withColumn("_key", F.struct("conv_id")).join(hashed.select(F.struct("conv_id").alias("_key"), "repaired_sha256"), "_key").select(
        "conv_id", gaps.alias("gaps"), "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
