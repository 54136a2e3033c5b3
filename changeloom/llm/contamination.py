"""Benchmark decontamination by a prefix-filtered set join.

A window of an item is a set of shingles (runs of three words), and a text contains the window only if it has all of
them. With the shingles ordered by rarity in the documents, the shortest prefix that decides is the rarest shingle alone.
So documents are joined to windows on that shingle; the place of the shingle in the window says where the window must
start (the position bound) and end (the length bound), and the words there are compared with those of the window.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changeloom.llm.hashing import run_hashes, signed, word_hashes
from changeloom.llm.tables import document_keys, stage, without

WINDOW = 10
SHINGLE = 3
#: Bits of the filter of shingles that is sent to the tasks: 2 MB, whatever the size of the benchmark. A fuller filter
#: lets more shingles of the documents through to the join, and changes no result.
FILTER_BITS = 1 << 24
ROWS = 20_000
#: Lower-case ASCII letters, digits and bytes of other characters stay; all else becomes a space.
_LETTERS = bytes(b if b in b"0123456789abcdefghijklmnopqrstuvwxyz" or b >= 0x80 else 0x20 for b in range(256))


def words(text: bytes | None) -> list[bytes]:
    return text.lower().translate(_LETTERS).split() if text else []


def windows(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """item_id, words (joined by a space), length, one row per distinct window of each item."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for item, text in zip(batch.column(0), batch.column(1)):
                found = words(text.as_py())
                runs = list({b" ".join(found[i : i + window]) for i in range(max(1, len(found) - window + 1))} if found else ())
                for at in range(0, len(runs), ROWS):
                    part = runs[at : at + ROWS]
                    yield pa.record_batch([pa.array([item.as_py()] * len(part), batch.column(0).type), pa.array(part, pa.binary())],
                                          names=["item_id", "words"])

    items = benchmark.select("item_id", F.col("text").cast("binary").alias("text"))
    found = items.mapInArrow(cut, f"item_id {dict(items.dtypes)['item_id']}, words binary").distinct()
    return found.withColumn("words", F.col("words").cast("string")).withColumn("length", F.size(F.split("words", " ")))


def shingles(distinct_windows: DataFrame, size: int = SHINGLE) -> DataFrame:
    """words, length, place, shingle (its hash), taken (its words), one row per shingle of each window."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = {"words": [], "length": [], "place": [], "shingle": [], "taken": []}
            for text in batch.column("words").to_pylist():
                found = text.encode().split(b" ")
                taken = min(size, len(found))
                for place, value in enumerate(signed(run_hashes(word_hashes(found), taken)).tolist()):
                    for column, entry in zip(out.values(), (text, len(found), place, value, taken)):
                        column.append(entry)
            yield pa.record_batch([pa.array(out["words"], pa.string()), *(pa.array(out[c], pa.int32()) for c in ("length", "place")),
                                   pa.array(out["shingle"], pa.int64()), pa.array(out["taken"], pa.int32())], names=list(out))

    return distinct_windows.select("words").mapInArrow(cut, "words string, length int, place int, shingle long, taken int")


def _filter(found: DataFrame, bits: int = FILTER_BITS) -> Broadcast:
    """A bit set of the shingles, two bits each, and the numbers of words that they have."""
    place = F.explode(F.array(F.pmod("shingle", F.lit(bits)), F.pmod(F.shiftright("shingle", 32), F.lit(bits))))
    cells = found.select(place.alias("bit")).groupBy(F.shiftright("bit", 6).alias("cell")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(bit & 63 AS int))")).alias("bits")).collect()  # one row per 64 bits at most
    filled = np.zeros(bits // 64, np.int64)
    filled[[row["cell"] for row in cells]] = [row["bits"] for row in cells]
    sizes = sorted(row["taken"] for row in found.select("taken").distinct().collect())  # 1 to SHINGLE
    return found.sparkSession.sparkContext.broadcast((filled, sizes))


def _hits(filled: np.ndarray, values: np.ndarray) -> np.ndarray:
    """The places of the values that the filter lets through."""
    bits = len(filled) * 64
    maybe = None
    for part in (values % bits, (values >> 32) % bits):
        at = np.arange(len(values)) if maybe is None else maybe
        part = part[at]
        maybe = at[(filled[part >> 6] >> (part & 63)) & 1 == 1]
    return maybe


def rarity(docs: DataFrame, passing: Broadcast) -> DataFrame:
    """shingle, n: occurrences in all documents of the shingles that the filter lets through."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filled, sizes = passing.value
        total: Counter = Counter()

        def rows() -> pa.RecordBatch:
            out = pa.record_batch([pa.array(total.keys(), pa.int64()), pa.array(total.values(), pa.int64())], names=["shingle", "n"])
            total.clear()
            return out

        for batch in batches:
            for text in batch.column("text"):
                hashes = word_hashes(words(text.as_py()))
                for size in sizes:
                    values = signed(run_hashes(hashes, size))
                    total.update(values[_hits(filled, values)].tolist())
                if len(total) > ROWS:
                    yield rows()
        yield rows()

    texts = docs.select(F.col("text").cast("binary").alias("text"))
    return texts.mapInArrow(count, "shingle long, n long").groupBy("shingle").agg(F.sum("n").alias("n"))


def prefixes(found: DataFrame, counts: DataFrame) -> DataFrame:
    """Of each window, its rarest shingle. A window with a shingle that no document has is in none, and is left out."""
    known = found.join(counts, "shingle", "left")
    first = F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "shingle", "place", "taken")).alias("first")
    return known.groupBy("words", "length").agg(first).filter("first.n > 0").select(
        "words", "length", "first.shingle", "first.place", "first.taken")


def candidates(docs: DataFrame, passing: Broadcast, window: int = WINDOW) -> DataFrame:
    """row, doc_id, keys and n_words of every document; and row, at, shingle, lead, context of its shingles that pass the filter.

    The context holds the words around the shingle that a window can reach, `lead` of them before it.
    """

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filled, sizes = passing.value
        for batch in batches:
            ids = batch.column("row").to_pylist()
            lengths: list[int] = []
            out: list[tuple] = []

            def rows() -> pa.RecordBatch:
                row, at, value, lead, context = zip(*out)
                out.clear()
                return pa.record_batch(
                    [pa.array(row, pa.int64()), *(pa.nulls(len(row), batch.column(c).type) for c in keys), pa.nulls(len(row), pa.int64()),
                     pa.array(at, pa.int64()), pa.array(value, pa.int64()), pa.array(lead, pa.int32()), pa.array(context, pa.string())],
                    names=names)

            for row, text in zip(ids, batch.column("text")):
                found = words(text.as_py())
                lengths.append(len(found))
                hashes = word_hashes(found)
                for size in sizes:
                    values = signed(run_hashes(hashes, size))
                    for at in _hits(filled, values).tolist():
                        begin = max(0, at - window + size)
                        out.append((row, at, int(values[at]), at - begin, b" ".join(found[begin : at + window]).decode()))
                    if len(out) >= ROWS:
                        yield rows()
            if out:
                yield rows()
            n = len(ids)
            yield pa.record_batch(
                [batch.column("row"), *(batch.column(c) for c in keys), pa.array(lengths, pa.int64()), pa.nulls(n, pa.int64()),
                 pa.nulls(n, pa.int64()), pa.nulls(n, pa.int32()), pa.nulls(n, pa.string())],
                names=names)

    keys = ("doc_id", "_doc", "_doc2")
    names = ["row", *keys, "n_words", "at", "shingle", "lead", "context"]
    texts = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", *document_keys(), F.col("text").cast("binary").alias("text"))
    return texts.mapInArrow(
        find, f"row long, doc_id {dict(texts.dtypes)['doc_id']}, _doc long, _doc2 long, n_words long, at long, shingle long, lead int, context string")


def occurrences(found: DataFrame, heads: DataFrame) -> DataFrame:
    """row, begin, length, words: every occurrence of a window in a document."""
    heads = heads.select("shingle", "place", "length", "words")
    near = found.filter("at IS NOT NULL").select("row", "at", "shingle", "lead", F.split("context", " ").alias("context"))
    # a window that would start before the text or end behind it is cut off by its context
    bounds = "lead >= place AND lead - place + length <= size(context)"
    same = "array_join(slice(context, lead - place + 1, length), ' ') = words"
    return near.join(heads, "shingle").filter(bounds).filter(same).select("row", (F.col("at") - F.col("place")).alias("begin"), "length", "words")


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated and the keys of the document, one row per row of `docs`.

    A word is hit if it lies in an occurrence of a window of any item. Null and empty texts have no words and no hits;
    items without words have no windows. An item with a null id counts for hits and not among the items; equal items
    with different ids all count. Repeated rows get the same result each. Empty tables give an empty result or no
    hits; other columns are ignored. Texts and items are read whole.
    """
    cut = stage(windows(benchmark, window), "bench-windows")
    found = stage(shingles(cut.select("words").distinct()), "bench-shingles")
    heads = stage(prefixes(found, rarity(docs, _filter(found))), "bench-prefixes")
    near = stage(candidates(docs, _filter(heads), window), "bench-candidates")
    occurring = stage(occurrences(near, heads), "bench-occurrences")
    covered = occurring.select("row", "begin", "length").distinct().select(
        "row", F.explode(F.sequence(F.col("begin"), F.col("begin") + F.col("length") - 1)).alias("word")).distinct()
    hit = covered.groupBy("row").agg(F.count("word").alias("n_hit"))
    items = occurring.select("row", "words").distinct().join(cut.filter("item_id IS NOT NULL"), "words").select(
        "row", F.col("item_id").cast("string").alias("item")).distinct()
    # the list holds items that occur in one text, no more than its windows for distinct items
    listed = items.groupBy("row").agg(F.count("item").alias("n_items"), F.sort_array(F.collect_list("item")).alias("items"))
    all_docs = near.filter("at IS NULL").select("row", "doc_id", "_doc", "_doc2", "n_words")
    joined = all_docs.join(hit, "row", "left").join(listed, "row", "left")
    n_hit = F.coalesce("n_hit", F.lit(0)).cast("long")
    return joined.select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.coalesce("n_items", F.lit(0)).cast("long").alias("n_items"),
        F.sha2(F.array_join(F.coalesce("items", F.array().cast("array<string>")), ","), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"), "_doc", "_doc2")


def clean(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """`docs` without those that hold a window of the benchmark."""
    gone = stage(decontaminate(docs, benchmark, window).filter("contaminated").select("_doc", "_doc2"), "bench-gone")
    return without(docs, gone)
