"""Bags of pieces: counting the distinct pieces of all texts, and summing values of pieces per document.

A text is cut into units, and each unit into pieces. Frequent pieces are few: their values go to every task as a table of
at most `HEAD` short entries. All other pieces are joined by a shuffle, so that no bound on their number is needed.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator
from itertools import chain, islice
from typing import Protocol

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Entries of the table that is sent to the tasks, and the length of its longest piece: 12 MB at most.
HEAD = 1 << 17
HEAD_BYTES = 64
#: Distinct units that a task holds before it hands them on, units whose pieces it remembers, units that it sums together,
#: and rows that it hands on.
HELD = 250_000
REMEMBERED = 150_000
UNITS = 1 << 19
ROWS = 20_000


class Numbers(dict):
    """Units, numbered in the order in which they are first asked for."""

    def __missing__(self, unit) -> int:
        self[unit] = number = len(self)
        return number


class Bag(Protocol):
    def units(self, text: bytes) -> list: ...

    def pieces(self, unit) -> tuple[bytes, ...]: ...


def _utf8() -> Column:
    return F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("text")


def counted(docs: DataFrame, bag: Callable[[], Bag], learns: Column) -> DataFrame:
    """piece, n, learned: how often each piece occurs in all texts, and in those of the rows where `learns` holds."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cut = bag()
        held: tuple[Counter, Counter] = (Counter(), Counter())

        def rows() -> Iterator[pa.RecordBatch]:
            for which, units in enumerate(held):
                pieces = Counter()
                for unit, n in units.items():
                    for piece in cut.pieces(unit):
                        pieces[piece] += n
                units.clear()
                names, n = list(pieces), np.fromiter(pieces.values(), np.int64, len(pieces))
                for at in range(0, len(names), ROWS):
                    part = n[at : at + ROWS]
                    yield pa.record_batch([pa.array(names[at : at + ROWS], pa.binary()), pa.array(part), pa.array(part * which)],
                                          names=["piece", "n", "learned"])

        for batch in batches:
            for text, learning in zip(batch.column(0), batch.column(1)):
                held[learning.as_py()].update(cut.units(text.as_py()))
                if len(held[0]) + len(held[1]) > HELD:
                    yield from rows()
        yield from rows()

    texts = docs.select(_utf8(), F.coalesce(learns, F.lit(True)).alias("learns"))
    return texts.mapInArrow(count, "piece binary, n long, learned long").groupBy("piece").agg(
        F.sum("n").alias("n"), F.sum("learned").alias("learned"))


def _head(values: DataFrame, size: int) -> tuple[DataFrame, Column]:
    """The most frequent short pieces, no more than `size`, and the condition that they meet.

    Frequencies are counted in steps of an eighth of a doubling; the driver gets one row per step.
    """
    step = F.when(F.length("piece") <= HEAD_BYTES, F.floor(8 * F.log2("n"))).otherwise(F.lit(-1))
    total, least = 0, None
    for row in sorted(values.groupBy(step.alias("step")).count().collect(), reverse=True):
        total += row["count"]
        if total > size or row["step"] < 0:
            break
        least = row["step"]
    frequent = step >= least if least is not None else F.lit(False)
    return values.filter(frequent), frequent


def summed(docs: DataFrame, bag: Callable[[], Bag], values: DataFrame, names: list[str], columns: dict[str, Column],
           head: int = HEAD) -> DataFrame:
    """`columns` of each row of `docs`, and for each of `names` the sum of that value of `values` over all pieces.

    `values` has piece, n and the values, one row per distinct piece of `docs`.
    """
    frequent, is_frequent = _head(values, head)
    rows = frequent.select("piece", *names).collect()  # no more than `head`
    table = np.array([[row[c] for c in names] for row in rows], np.float64).reshape(len(rows), len(names))
    shared = docs.sparkSession.sparkContext.broadcast(({bytes(row["piece"]): i for i, row in enumerate(rows)}, table))
    keys = list(columns)
    texts = docs.select(F.monotonically_increasing_id().alias("row"), *(c.alias(k) for k, c in columns.items()), _utf8())
    kinds = dict(texts.dtypes)
    schema = ", ".join(["row long", *(f"`{k}` {kinds[k]}" for k in keys), "piece binary", "n long", *(f"`{c}` double" for c in names)])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, known = shared.value
        cut = bag()
        numbers, values, tails = Numbers(), np.empty((0, len(names))), []

        def learn() -> None:
            """Per newly numbered unit the sums over its frequent pieces, and its other pieces."""
            nonlocal values
            new = [cut.pieces(unit) for unit in islice(numbers, len(tails), None)]
            places = [[at[piece] for piece in pieces if piece in at] for pieces in new]
            owner = np.repeat(np.arange(len(new)), [len(own) for own in places])
            found = known[list(chain.from_iterable(places))]
            sums = [np.bincount(owner, found[:, j], len(new)) for j in range(len(names))]
            values = np.concatenate([values, np.array(sums).T.reshape(len(new), len(names))])
            tails.extend(tuple([piece for piece in pieces if piece not in at]) for pieces in new)

        for batch in batches:
            ids = batch.column("row").to_pylist()
            sums = np.zeros((len(ids), len(names)))
            more_rows: list[int] = []
            more_pieces: list[bytes] = []
            more_n: list[int] = []

            def tail() -> pa.RecordBatch:
                size = len(more_rows)
                out = pa.record_batch(
                    [pa.array(more_rows, pa.int64()), *(pa.nulls(size, batch.column(k).type) for k in keys),
                     pa.array(more_pieces, pa.binary()), pa.array(more_n, pa.int64()), *(pa.array(np.zeros(size)) for _ in names)],
                    names=["row", *keys, "piece", "n", *names])
                more_rows.clear(), more_pieces.clear(), more_n.clear()
                return out

            texts, first = batch.column("text"), 0
            while first < len(ids):
                if len(numbers) > REMEMBERED:
                    numbers, values, tails = Numbers(), np.empty((0, len(names))), []
                units, upto, held = [], first, 0
                while upto < len(ids) and held < UNITS:
                    own = cut.units(texts[upto].as_py())
                    units.append(np.fromiter(map(numbers.__getitem__, own), np.int64, len(own)))
                    held, upto = held + len(own), upto + 1
                if len(numbers) > len(tails):
                    learn()
                every = np.concatenate(units)
                rows = np.repeat(np.arange(first, upto), [len(own) for own in units])
                for j in range(len(names)):
                    sums[first:upto, j] = np.bincount(rows - first, values[every, j], upto - first)
                rare = np.array([bool(pieces) for pieces in tails], bool)[every]
                pairs, times = np.unique(rows[rare] * len(tails) + every[rare], return_counts=True)
                for row, unit, n in zip((pairs // max(len(tails), 1)).tolist(), (pairs % max(len(tails), 1)).tolist(), times.tolist()):
                    for piece in tails[unit]:
                        more_rows.append(ids[row]), more_pieces.append(piece), more_n.append(n)
                    if len(more_rows) >= ROWS:
                        yield tail()
                first = upto
            if more_rows:
                yield tail()
            # the row of the document itself has a key that no piece has, as it is not UTF-8; so these rows spread evenly
            own = [b"\xff" + int(row).to_bytes(8, "big") for row in ids]
            yield pa.record_batch(
                [batch.column("row"), *(batch.column(k) for k in keys), pa.array(own, pa.binary()), pa.nulls(len(ids), pa.int64()),
                 *(pa.array(sums[:, j].copy()) for j in range(len(names)))], names=["row", *keys, "piece", "n", *names])

    found = texts.mapInArrow(add, schema)
    rare = values.filter(~is_frequent).select(F.col("piece"), *(F.col(c).cast("double").alias(f"_{c}") for c in names))
    joined = found.join(rare, "piece", "left")
    total = (F.sum(F.coalesce(F.col("n") * F.col(f"_{c}"), F.col(c))).alias(c) for c in names)
    return joined.groupBy("row").agg(*(F.first(k, ignorenulls=True).alias(k) for k in keys), *total).drop("row")
