"""Packing along a space-filling curve: neighbouring documents share sequences.

Each document becomes a hashed vector of its tokens, projected to a few dimensions. A Hilbert curve orders the points, so
that documents near each other on it have similar tokens. The documents are laid end to end in that order and cut at every
`size` tokens. The rest at the very end is cut into powers of two, which need no padding either.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator
from itertools import chain, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from changeloom.llm.hashing import mixed
from changeloom.llm.tables import running_sums, stage

SIZE = 4096
END = 2
#: Slots of a document's hashed vector, dimensions of the curve and bits per dimension.
SLOTS, DIMENSIONS, BITS = 256, 4, 12
#: Words whose ids a task remembers, ids that it remembers for them, and ids in one batch that a task hands on.
REMEMBERED, HELD, HANDED = 300_000, 1 << 22, 1 << 22
#: Texts of printable ASCII, white space and the letters of Latin-1 that have one lower-case letter and no other form.
PLAIN = re.compile(r"[\x20-\x7E\n\t\rÀ-ÖØ-öø-ÿ]*")
#: The pre-tokens of such a text, in lower case: letters, single digits, endings, signs.
RUNS = re.compile(r"[a-zß-öø-ÿ]+|[0-9]|'s|'t|'re|'ve|'m|'ll|'d|[!-/:-`{-~]+")
#: Words that are encoded together.
ENCODED = 10_000


class Numbers(dict):
    """Parts of texts, numbered in the order in which they are first asked for."""

    def __missing__(self, part: str) -> int:
        self[part] = number = len(self)
        return number


class Words:
    """The ids of whole texts. A text is cut at white space, which no token spans, and each distinct word encoded once.

    Where the tokenizer does not drop white space, a whole text is one word.
    """

    def __init__(self, file: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark gives a task one core
        self._tokenizer = Tokenizer.from_file(file)
        self._tokenizer.no_truncation(), self._tokenizer.no_padding()
        self.size = self._tokenizer.get_vocab_size()
        self.kind = np.dtype("<u2" if self.size <= 1 << 16 else "<u4")
        self._forget()
        probes = ("a b", "It's  1\n2\tword", "x ́y", "ΑΣ ΑΣ", "a <|endoftext|> b")
        self._by_word = all(self._ids(probe) == [i for word in probe.split() for i in self._ids(word)] for probe in probes)
        # for plain texts, the model alone: what stands before it only makes them lower case and parts the runs
        self._model = self._tokenizer.model
        probes = ("Word it's 12 x2y", "Été!? straßE... (_) ÿ~ zz|> `a` 'tis ''s don't.'S we'LL,;", "A-1's\t$3.50\r\n", "Antidisestablishmentarianism")
        self._plain = all(self._ids(p) == [i for run in RUNS.findall(p.lower()) for i in self._run(run)] for p in probes)
        special = self._tokenizer.get_added_tokens_decoder().values()
        self._special = re.compile("|".join(re.escape(t.content) for t in special)) if special else None

    def _ids(self, text: str) -> list[int]:
        return self._tokenizer.encode(text, add_special_tokens=False).ids

    def _run(self, run: str) -> list[int]:
        return [token.id for token in self._model.tokenize(_in_signs(run))]

    def _cut(self, text: str) -> tuple[bool, list[str]]:
        """Whether a text is plain, and its parts: runs, or words, or the whole."""
        if self._plain and PLAIN.fullmatch(text) and not (self._special and self._special.search(text)):
            return True, RUNS.findall(text.lower())
        # of the characters that the tokenizer takes for white space, those that surely part words
        return False, text.replace("\n", " ").replace("\t", " ").replace("\r", " ").split(" ") if self._by_word else [text]

    def _forget(self) -> None:
        """No parts are known: their numbers, and by number where their ids start in `_held` and how many there are."""
        self._numbers = Numbers()
        self._held, self._starts, self._lengths = np.empty(0, self.kind), np.empty(0, np.int64), np.empty(0, np.int64)

    def _learn(self, parts: list[str], runs: bool) -> None:
        """Hold the ids of newly numbered parts."""
        ids, lengths = [self._held], [self._lengths]
        for at in range(0, len(parts), ENCODED):
            some = parts[at : at + ENCODED]
            found = list(map(self._run, some)) if runs else [e.ids for e in self._tokenizer.encode_batch_fast(some, add_special_tokens=False)]
            lengths.append(np.fromiter(map(len, found), np.int64, len(some)))
            ids.append(np.fromiter(chain.from_iterable(found), self.kind, lengths[-1].sum()))
        self._held, self._lengths = np.concatenate(ids), np.concatenate(lengths)
        self._starts = np.cumsum(self._lengths) - self._lengths

    def of(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text."""
        if len(self._numbers) > REMEMBERED or len(self._held) > HELD:
            self._forget()
        cut = [self._cut(text) for text in texts]
        numbers = [np.empty(0, np.int64)] * len(cut)
        for runs in (True, False):  # a run has the same ids as a word of its own
            known = len(self._numbers)
            for i, (plain, parts) in enumerate(cut):
                if plain == runs:
                    numbers[i] = np.fromiter(map(self._numbers.__getitem__, parts), np.int64, len(parts))
            new = list(islice(reversed(self._numbers), len(self._numbers) - known))
            if new:
                self._learn(new[::-1], runs)
        every = np.concatenate(numbers) if numbers else np.empty(0, np.int64)
        lengths = self._lengths[every]
        upto = np.concatenate([[0], np.cumsum(lengths)])
        # half as wide where the places allow it, which is nearly always
        wide = np.int32 if upto[-1] + len(self._held) < 1 << 31 else np.int64
        at = np.repeat((self._starts[every] - upto[:-1]).astype(wide), lengths)
        at += np.arange(len(at), dtype=wide)
        ends = upto[np.cumsum([len(own) for own in numbers], dtype=np.int64)]
        return np.split(self._held.take(at), ends[:-1]) if texts else []


def _in_signs(run: str) -> str:
    """A run as the model sees it: one printable sign per byte of its UTF-8, as byte-level vocabularies write them."""
    return run if run.isascii() else run.encode().decode("latin-1").translate(_SIGNS)


#: The bytes that are printable in Latin-1 stand for themselves; the others follow from 256 on, in order.
_PRINTABLE = [*range(33, 127), *range(161, 173), *range(174, 256)]
_SIGNS = {byte: 256 + i for i, byte in enumerate(b for b in range(256) if b not in set(_PRINTABLE))}


def hilbert(points: np.ndarray, bits: int) -> np.ndarray:
    """The place of each point (one row of whole numbers below 2**bits) on a Hilbert curve.

    Bit by bit from the top: the cell of a point, a Gray code over the dimensions, tells how the axes of the cells below
    are turned and mirrored.
    """
    x = points.astype(np.int64).T.copy()
    n = len(x)
    for bit in range(bits - 1, 0, -1):
        low = (1 << bit) - 1
        for axis in range(n):
            mirrored = (x[axis] >> bit & 1).astype(bool)
            swap = np.where(mirrored, 0, (x[0] ^ x[axis]) & low)
            x[0] ^= np.where(mirrored, low, swap)
            x[axis] ^= swap
    for axis in range(1, n):
        x[axis] ^= x[axis - 1]
    turn = np.zeros_like(x[0])
    for bit in range(bits - 1, 0, -1):
        turn ^= np.where(x[n - 1] >> bit & 1, (1 << bit) - 1, 0)
    x ^= turn
    place = np.zeros_like(turn)
    for bit in range(bits - 1, -1, -1):
        for axis in range(n):
            place = place << 1 | (x[axis] >> bit & 1)
    return place


class Curve:
    """The place of documents on the curve. A token adds one or takes one in its slot, by a hash of its id."""

    def __init__(self, vocabulary: int) -> None:
        hashes = mixed(np.arange(vocabulary, dtype=np.uint64) + np.uint64(1))
        # the slots of tokens that add one, and behind them those of tokens that take one
        self._slot = (hashes % np.uint64(SLOTS)).astype(np.int64) + np.where(hashes >> np.uint64(63), 0, SLOTS)
        # one direction per dimension: each slot a number between -1 and 1 that depends on nothing but its place
        numbers = mixed(np.arange(SLOTS * DIMENSIONS, dtype=np.uint64) + np.uint64(1), 1)
        self._axes = (numbers >> np.uint64(11)).astype(np.float64).reshape(SLOTS, DIMENSIONS) / 2.0**52 - 1

    def places(self, ids: list[np.ndarray]) -> np.ndarray:
        """The place of each document. Documents without tokens stand in the middle of the space."""
        counts = np.array([np.bincount(self._slot[own], minlength=2 * SLOTS) for own in ids]).reshape(len(ids), 2 * SLOTS)
        vectors = (counts[:, :SLOTS] - counts[:, SLOTS:]).astype(np.float64)
        vectors = np.sign(vectors) * np.log1p(np.abs(vectors))
        points = vectors @ self._axes / np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-9)
        # a projection of a unit vector is close to normal, with a deviation of a third in its square
        spread = 0.5 + 0.5 * np.tanh(points * 1.4)
        return hilbert(np.minimum(spread * (1 << BITS), (1 << BITS) - 1), BITS)


def encode(docs: DataFrame, file: str, end: int) -> DataFrame:
    """row, doc_id, n, curve, ids: the ids of each document with `end` behind them, and its place on the curve."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words(file)
        curve = Curve(words.size)
        for batch in batches:
            texts = batch.column("text").to_pylist()
            at = 0
            while at < len(texts):
                upto, chars = at, 0
                while upto < len(texts) and chars < HANDED:
                    chars += len(texts[upto])
                    upto += 1
                found = words.of(texts[at:upto])
                part = batch.slice(at, upto - at)
                whole = [own.tobytes() + np.array([end], words.kind).tobytes() for own in found]
                yield pa.record_batch(
                    [part.column("row"), part.column("doc_id"), pa.array([len(own) + 1 for own in found], pa.int64()),
                     pa.array(curve.places(found), pa.int64()), pa.array(whole, pa.large_binary()).cast(pa.binary())],
                    names=["row", "doc_id", "n", "curve", "ids"])
                at = upto

    texts = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", F.coalesce("text", F.lit("")).alias("text"))
    kind = dict(texts.dtypes)["doc_id"]
    return texts.mapInArrow(run, f"row long, doc_id {kind}, n long, curve long, ids binary")


def _cuts(start: int, n: int, total: int, size: int) -> Iterator[tuple[int, int, int]]:
    """(sequence, place in it, length) of the pieces of a document that begins at `start` of all `total` tokens."""
    whole = total // size * size
    while n:
        if start < whole:
            sequence, offset, room = start // size, start % size, size - start % size
        else:  # the rest of all tokens: one sequence per bit of its length, the largest first
            sequence, base, rest = whole // size, whole, total - whole
            part = 1 << rest.bit_length() - 1
            while start >= base + part:
                base, rest, sequence = base + part, rest - part, sequence + 1
                part = 1 << rest.bit_length() - 1
            offset, room = start - base, base + part - start
        length = min(n, room)
        yield sequence, offset, length
        start, n = start + length, n - length


def pack(docs: DataFrame, file: str, end: int = END, size: int = SIZE) -> DataFrame:
    """Pieces of all documents: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, and the ids (uint32).

    `file` is a tokenizer for the tokenizers library, at the same path on every machine; special strings inside a text are
    handled as by default there. Every token lies in one piece, and a sequence is full or as long as a power of two. The
    order along the curve is total: ties go by the place of the row in its file. A null or empty text is the token `end`
    alone. Null ids and repeated rows are documents like any other; other columns change nothing; an empty table gives an
    empty result. A text of any length is one row of one task, and its pieces leave it in batches.
    """
    encoded = stage(encode(docs, file, end), "packing-ids")
    wide = Words(file).kind.itemsize
    order = running_sums(encoded.select("row", "n", "curve"), ["curve", "row"], {"upto": "n"}, "packing-order")
    total = encoded.agg(F.sum("n")).first()[0] or 0  # one number

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def handed(kind: pa.DataType, rows: list[tuple]) -> pa.RecordBatch:
            kinds = [kind, *[pa.int64()] * 6, pa.binary()]
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "ids"]
            return pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

        for batch in batches:
            rows, held, kind = [], 0, batch.schema.field("doc_id").type
            for doc_id, n, upto, ids in zip(*(batch.column(c) for c in ("doc_id", "n", "upto", "ids"))):
                doc_id, n, start = doc_id.as_py(), n.as_py(), 0
                own = np.frombuffer(ids.as_buffer(), f"<u{wide}")
                for sequence, offset, length in _cuts(upto.as_py() - n, n, total, size):
                    piece = own[start : start + length].astype("<u4").tobytes()
                    rows.append((doc_id, start, length, zlib.crc32(piece), n, sequence, offset, piece))
                    start, held = start + length, held + length
                    if held >= HANDED:
                        yield handed(kind, rows)
                        rows, held = [], 0
            if rows:
                yield handed(kind, rows)

    placed = encoded.select("row", "doc_id", "n", "ids").join(order.select("row", "upto"), "row").drop("row")
    kind = dict(placed.dtypes)["doc_id"]
    return placed.mapInArrow(
        run, f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, ids binary")
