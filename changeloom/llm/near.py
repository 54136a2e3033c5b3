"""Near-duplicates of word shingles by SetSketch registers.

A register holds, on an exponential scale, the smallest of the hashes of a set: the largest k with hash < base ** -k, cut
off at 0 and at the largest register. The registers of a union are the larger ones of both; equal registers are likely
for similar sets. Bands of registers give the candidate pairs. The counts of larger, equal and smaller registers of a
pair give the likelihood of each similarity; pairs that the threshold does not explain are dropped, and all others are
confirmed on the full sets of shingles.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changeloom.llm.components import connect, sharing
from changeloom.llm.hashing import mixed, run_hashes, signed, word_hashes
from changeloom.llm.tables import document_keys, stage, without

SHINGLE = 5
#: A link needs 100 * intersection >= SIMILARITY * union.
SIMILARITY = 75
#: 32 bands of 4: a pair at the threshold shares no band once in 190,000 cases, and a more similar one more rarely.
BANDS, ROWS_PER_BAND = 32, 4
REGISTERS = BANDS * ROWS_PER_BAND
#: Parameters of the sketch: base of the scale, rate of the hashes, largest register.
BASE, RATE, LARGEST = 1.001, 20.0, 65_535
#: A pair is dropped if some similarity below the threshold is e ** 14 times as likely as any above.
MARGIN = 14.0
#: Shingles that are hashed together, so that they stay in the processor's cache.
CHUNK = 32_768
#: Bits of the filter of ids whose sets are needed: 4 MB, whatever their number. A fuller one only lets more through.
FILTER_BITS = 1 << 25

#: Numbers of 64 bits in the parity map of a set.
PARITY = 16

_SEEDS = np.array([xxhash.xxh3_64_intdigest(f"register {i}") for i in range(REGISTERS)], np.uint64)


def shingle_set(text: bytes | None, size: int = SHINGLE) -> np.ndarray:
    """Sorted distinct hashes of the runs of words; a text of fewer words is one run."""
    words = text.lower().split() if text else []
    return np.unique(run_hashes(word_hashes(words), min(size, len(words)))) if words else np.empty(0, np.uint64)


def parity(shingles: np.ndarray) -> np.ndarray:
    """PARITY numbers: bit i says whether the number of shingles whose hash ends in i is odd.

    Two sets differ in at least as many shingles as their parity maps do in bits.
    """
    odd = np.bincount((shingles % np.uint64(64 * PARITY)).astype(np.int64), minlength=64 * PARITY) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def registers(sets: list[np.ndarray]) -> np.ndarray:
    """One row of REGISTERS per set; a set that is empty has zeros."""
    out = np.zeros((len(sets), REGISTERS), np.uint16)
    least = np.full((len(sets), REGISTERS), np.iinfo(np.uint64).max, np.uint64)
    at = 0
    while at < len(sets):  # several short sets at a time, or one long one in parts
        end, total = at, 0
        while end < len(sets) and (end == at or total + len(sets[end]) <= CHUNK):
            total += len(sets[end])
            end += 1
        parts = [sets[at][i : i + CHUNK] for i in range(0, total, CHUNK)] if end == at + 1 else [np.concatenate(sets[at:end])]
        filled = [i for i in range(at, end) if len(sets[i])]
        starts = np.cumsum([0] + [len(sets[i]) for i in filled[:-1]]) if filled else []
        for part in parts if filled else []:
            for j, seed in enumerate(_SEEDS):
                hashed = mixed(part ^ seed)
                low = np.minimum.reduceat(hashed, starts if end > at + 1 else [0])
                least[filled, j] = np.minimum(least[filled, j], low)
        at = end
    filled = np.array([len(s) > 0 for s in sets], bool)
    uniform = (least[filled].astype(np.float64) + 0.5) / 2.0**64
    exponential = -np.log1p(-np.minimum(uniform, 1 - 1e-16)) / RATE
    out[filled] = np.clip(np.floor(1 - np.log(exponential) / np.log(BASE)), 0, LARGEST).astype(np.uint16)
    return out


def sketches(docs: DataFrame) -> DataFrame:
    """doc_id, the keys of the document, n_shingles, digest (of the set), registers, one row per row of `docs`."""

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                sets = [shingle_set(text.as_py()) for text in part.column("text")]
                yield pa.record_batch(
                    [*(part.column(c) for c in ("doc_id", "_doc", "_doc2")), pa.array([len(s) for s in sets], pa.int64()),
                     pa.array([xxhash.xxh3_128_digest(s.tobytes()) for s in sets], pa.binary()),
                     pa.array([row.tobytes() for row in registers(sets)], pa.binary())],
                    names=["doc_id", "_doc", "_doc2", "n_shingles", "digest", "registers"])

    texts = docs.select("doc_id", *document_keys(), F.col("text").cast("binary").alias("text"))
    return texts.mapInArrow(sketch, f"doc_id {dict(texts.dtypes)['doc_id']}, _doc long, _doc2 long, n_shingles long, digest binary, registers binary")


def bands(classes: DataFrame) -> DataFrame:
    """key, node: one row per band of the registers of each class."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = mixed(np.arange(1, BANDS + 1, dtype=np.uint64))
        for batch in batches:
            if batch.num_rows:
                rows = np.frombuffer(b"".join(batch.column("registers").to_pylist()), np.uint64).reshape(-1, BANDS)
                nodes = np.repeat(batch.column("node").to_numpy(), BANDS)
                yield pa.record_batch([pa.array(signed(mixed(rows ^ place).ravel())), pa.array(nodes)], names=["key", "node"])

    return classes.select("node", "registers").mapInArrow(cut, "key long, node long")


def _log_share(x: np.ndarray) -> np.ndarray:
    """Probability that a register differs in one direction, for the share x of the union that decides it."""
    return np.maximum(-np.log1p(-x * (BASE - 1) / BASE) / np.log(BASE), 1e-300)


def plausible(larger: np.ndarray, smaller: np.ndarray, n_a: np.ndarray, n_b: np.ndarray, similarity: int = SIMILARITY) -> np.ndarray:
    """Whether the counts of larger and smaller registers of pairs leave the threshold possible, by joint likelihood."""
    share = (n_a / (n_a + n_b))[:, None]
    limit = np.minimum(share / (1 - share), (1 - share) / share)
    grid = np.linspace(0, 1, 101)[None, :]
    possible = grid <= limit + 1e-9
    jaccard = np.minimum(grid, limit)
    up = _log_share(np.maximum(share - (1 - share) * jaccard, 0))
    down = _log_share(np.maximum((1 - share) - share * jaccard, 0))
    equal = np.maximum(1 - up - down, 1e-300)
    same = REGISTERS - larger - smaller
    likelihood = larger[:, None] * np.log(up) + smaller[:, None] * np.log(down) + same[:, None] * np.log(equal)
    likelihood = np.where(possible, likelihood, -np.inf)
    above = np.where(grid >= similarity / 100 - 0.01, likelihood, -np.inf)
    return above.max(axis=1) >= likelihood.max(axis=1) - MARGIN


def estimated(pairs: DataFrame, classes: DataFrame, similarity: int = SIMILARITY) -> DataFrame:
    """The pairs (a, b) whose sizes and registers allow a link."""

    def test(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            left, right = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint16).reshape(-1, REGISTERS) for c in ("r_a", "r_b"))
            n_a, n_b = (batch.column(c).to_numpy().astype(np.float64) for c in ("n_a", "n_b"))
            stay = plausible((left > right).sum(axis=1), (left < right).sum(axis=1), n_a, n_b, similarity)
            yield pa.record_batch([batch.column("a"), batch.column("b")], names=["a", "b"]).filter(pa.array(stay))

    def side(s: str) -> DataFrame:
        return classes.select(F.col("node").alias(s), F.col("n_shingles").alias(f"n_{s}"), F.col("registers").alias(f"r_{s}"))

    sizes = f"100 * least(n_a, n_b) >= {similarity} * greatest(n_a, n_b)"
    return pairs.join(side("a"), "a").join(side("b"), "b").filter(sizes).mapInArrow(test, "a long, b long")


def full_sets(docs: DataFrame, needed: DataFrame, bits: int = FILTER_BITS) -> DataFrame:
    """node, shingles (the sorted set), parity (its map) of the `needed` classes (node, digest, doc_id), read from the texts again."""
    bit = F.pmod(F.xxhash64("doc_id"), F.lit(bits))
    cells = needed.groupBy(F.shiftright(bit, 6).alias("cell")).agg(
        F.bit_or(F.expr(f"shiftleft(1L, cast(pmod(xxhash64(doc_id), {bits}) & 63 AS int))")).alias("set_bits")).collect()
    filled = np.zeros(bits // 64, np.int64)  # one row per 64 bits at most
    filled[[row["cell"] for row in cells]] = [row["set_bits"] for row in cells]
    shared = docs.sparkSession.sparkContext.broadcast(filled)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            at = batch.column("bit").to_numpy()
            places = np.flatnonzero((known[at >> 6] >> (at & 63)) & 1)
            for begin in range(0, len(places), 256):
                sets = [shingle_set(batch.column("text")[int(i)].as_py()) for i in places[begin : begin + 256]]
                yield pa.record_batch(
                    [pa.array([xxhash.xxh3_128_digest(s.tobytes()) for s in sets], pa.binary()),
                     pa.array([signed(s) for s in sets], pa.list_(pa.int64())),
                     pa.array([parity(s) for s in sets], pa.list_(pa.int64()))], names=["digest", "shingles", "parity"])

    texts = docs.select(bit.alias("bit"), F.col("text").cast("binary").alias("text"))
    found = texts.mapInArrow(read, "digest binary, shingles array<long>, parity array<long>").join(needed.select("node", "digest"), "digest")
    return found.groupBy("node").agg(F.first("shingles").alias("shingles"), F.first("parity").alias("parity"))


def common(sets: DataFrame) -> DataFrame:
    """node, size, common (how many of its shingles any other set has), own (the share that none has), m0, m1, ... (parity)."""
    owners = sets.select("node", F.explode("shingles").alias("shingle")).groupBy("shingle").agg(
        F.min("node").alias("node"), F.max("node").alias("last")).filter("node = last")
    own = owners.groupBy("node").agg(F.count(F.lit(1)).alias("alone"))
    size = F.size("shingles").cast("long")
    alone = F.coalesce("alone", F.lit(0))
    maps = [F.get("parity", F.lit(i)).alias(f"m{i}") for i in range(PARITY)]
    return sets.select("node", size.alias("size"), *maps).join(own, "node", "left").select(
        "node", "size", (F.col("size") - alone).alias("common"), (alone / F.col("size")).alias("own"), *(f"m{i}" for i in range(PARITY)))


def possible(similarity: int = SIMILARITY) -> str:
    """A condition on two rows of `common`, x and y, that all pairs of similar sets meet.

    Two sets have no more in common than either has that is not its own alone, and no more than what is left of both
    when the shingles by which their parity maps differ are taken off.
    """
    both = "(x.size + y.size)"
    differing = " + ".join(f"bit_count(x.m{i} ^ y.m{i})" for i in range(PARITY))
    return (f"{100 + similarity} * least(x.common, y.common) >= {similarity} * {both} AND "
            f"{100 + similarity} * ({both} - ({differing})) >= {2 * similarity} * {both}")


def confirmed(pairs: DataFrame, sets: DataFrame, similarity: int = SIMILARITY) -> DataFrame:
    """The pairs (a, b) whose sets are similar enough."""
    joined = pairs.join(sets.select(F.col("node").alias("a"), F.col("shingles").alias("s_a")), "a").join(
        sets.select(F.col("node").alias("b"), F.col("shingles").alias("s_b")), "b")
    common = F.size(F.array_intersect("s_a", "s_b"))
    counted = joined.select("a", "b", (F.size("s_a") + F.size("s_b")).alias("both"), common.alias("common"))
    return counted.filter(f"100 * common >= {similarity} * (both - common)").select("a", "b")


def near_duplicates(docs: DataFrame, similarity: int = SIMILARITY) -> DataFrame:
    """doc_id, n_shingles, component_id, kept, n_links and the keys of the document, one row per row of `docs`.

    Texts with the same set are one class, so that groups of copies cost one row. n_links counts the classes that were
    confirmed as linked with that of the document on the way to its component, which need not be all. A null or empty
    text has no set and is linked with nothing. The component of rows with a null id is named by the smallest id in it,
    if any; a null id is kept only if there is none. Repeated rows get the same result each. An empty table gives an
    empty result; other columns are ignored. Texts of any length are read whole.
    """
    found = stage(sketches(docs), "near-sketches")
    by_set = found.filter("n_shingles > 0").groupBy("digest").agg(
        F.min("doc_id").alias("doc_id"), F.first("n_shingles").alias("n_shingles"), F.first("registers").alias("registers"))
    classes = stage(by_set.withColumn("node", F.monotonically_increasing_id()), "near-classes")
    members = stage(sharing(stage(bands(classes), "near-bands"), "near-keys"), "near-shared")
    needed = members.select("node").distinct().join(classes.select("node", "digest", "doc_id"), "node")
    sets = stage(full_sets(docs, stage(needed, "near-needed")), "near-sets")
    def confirm(pairs: DataFrame) -> DataFrame:
        return confirmed(estimated(pairs, classes, similarity), sets, similarity)

    # texts with few shingles of their own are in the middle of their group, and link most of it
    linked, links = connect(members.join(stage(common(sets), "near-common"), "node"), possible(similarity), ["own", "node"], confirm, "near")
    degrees = links.select(F.explode(F.array("a", "b")).alias("node")).groupBy("node").agg(F.count(F.lit(1)).alias("n_links"))
    named = classes.select("node", "digest", "doc_id").join(linked, "node").join(degrees, "node", "left")
    names = named.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    of_class = classes.select("node", "digest", F.col("doc_id").alias("class_id")).join(
        named.join(names, "component").select("node", "component_id", "n_links"), "node", "left")
    of_class = of_class.select("digest", F.coalesce("component_id", "class_id").alias("class_component"), "n_links")
    component = F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.col("class_component"))
    return found.drop("registers").join(of_class, "digest", "left").select(
        "doc_id", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"),
        F.when(F.col("n_shingles") == 0, 0).otherwise(F.coalesce("n_links", F.lit(0))).cast("long").alias("n_links"),
        "_doc", "_doc2")


def dedup(docs: DataFrame, similarity: int = SIMILARITY) -> DataFrame:
    """`docs` without the rows that `near_duplicates` does not keep: one document of each group stays."""
    gone = stage(near_duplicates(docs, similarity).filter("NOT kept").select("_doc", "_doc2"), "near-gone")
    return without(docs, gone)
