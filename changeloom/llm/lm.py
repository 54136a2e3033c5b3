"""Language-model scores: subword lattice likelihood.

The pieces of an existing subword vocabulary get unigram scores from the training texts; the probability of a word is
the sum over all its segmentations into pieces, by a forward recursion in log space. As no piece crosses a space, the
probability of a text is the product over its words and one end.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changeloom.llm.bags import ROWS, counted, summed
from changeloom.llm.tables import stage

START = "▁"
SMOOTH = 0.5
#: Characters of words whose lattices are summed together, and the factor of the hash of their substrings.
TOGETHER = 1 << 17
FACTOR = 0x9E3779B97F4A7C15
#: Fixed value: the training split. Rows whose crc32(doc_id as text) leaves this remainder are held out.
FOLDS, HELD_OUT = 5, 1


class Words:
    def units(self, text: bytes) -> list[bytes]:
        return text.lower().split()  # on bytes: A to Z only, and the six ASCII spaces only

    def pieces(self, unit: bytes) -> tuple[bytes, ...]:
        return (unit,)


def held_out(doc_id: str = "doc_id") -> Column:
    """A null id is not held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % FOLDS == HELD_OUT, F.lit(False))


class Lattice:
    """Pieces of a vocabulary with log probabilities.

    A piece is looked up by a 64-bit hash of its characters, so that the substrings of many words are found at once.
    """

    def __init__(self, file: str, log_p: np.ndarray) -> None:
        model = sentencepiece.SentencePieceProcessor(model_file=file)
        pieces: dict[int, float] = {}
        self._longest = 1
        self._bytes = np.zeros(256)
        for i in range(model.get_piece_size()):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                self._bytes[int(piece[3:5], 16)] = log_p[i]
            elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
                pieces[self._hash(piece)] = float(log_p[i])
                self._longest = max(self._longest, len(piece))
        self._hashes = np.array(sorted(pieces), np.uint64)
        self._scores = np.array([pieces[h] for h in self._hashes.tolist()])

    @staticmethod
    def _hash(piece: str) -> int:
        found = 0
        for character in piece:
            found = (found * FACTOR + ord(character) + 1) % (1 << 64)
        return found

    def log_probabilities(self, words: list[bytes]) -> np.ndarray:
        """Per word the log of the sum over all its segmentations. Words of one length go through the recursion together."""
        texts = [START + word.decode(errors="replace") for word in words]
        found = np.empty(len(texts))
        lengths = np.fromiter(map(len, texts), np.int64, len(texts))
        for length in np.unique(lengths).tolist():
            places = np.flatnonzero(lengths == length)
            together = max(1, TOGETHER // length)
            for at in range(0, len(places), together):
                some = places[at : at + together]
                found[some] = self._forward("".join([texts[i] for i in some.tolist()]), length)
        return found

    def _forward(self, texts: str, length: int) -> np.ndarray:
        """The forward recursion over texts of one length, end to end. It keeps the rows that a piece can reach back to."""
        codes = np.frombuffer(texts.encode("utf-32-le"), np.uint32).reshape(-1, length).T
        used, which = np.unique(codes, return_inverse=True)
        spelled = np.array([self._bytes[list(chr(c).encode())].sum() for c in used.tolist()])[which.reshape(codes.shape)]
        forward = np.zeros((1, codes.shape[1]))
        hashes = np.zeros((1, codes.shape[1]), np.uint64)
        for end in range(length):
            hashes = hashes * np.uint64(FACTOR) + (codes[end].astype(np.uint64) + np.uint64(1))  # from each begin to this end
            at = np.minimum(np.searchsorted(self._hashes, hashes), len(self._hashes) - 1)
            scores = np.where(self._hashes[at] == hashes, self._scores[at], -np.inf)
            # any character can also be spelled by its bytes
            paths = np.vstack((forward + scores, forward[-1] + spelled[end]))
            top = paths.max(axis=0)
            last = top + np.log(np.exp(paths - top).sum(axis=0))
            forward = np.vstack((forward, last))[-self._longest :]
            hashes = np.vstack((hashes, np.zeros_like(hashes[:1])))[-self._longest :]
        return forward[-1]


def piece_counts(words: DataFrame, file: str) -> DataFrame:
    """id, n: how often each piece of the vocabulary occurs in the segmentation of the learned words."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sentencepiece.SentencePieceProcessor(model_file=file)
        totals = np.zeros(model.get_piece_size(), np.int64)
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                texts = [word.decode(errors="replace") for word in part.column("piece").to_pylist()]
                for ids, n in zip(model.encode(texts, num_threads=1), part.column("learned").to_pylist()):
                    for i in ids:
                        totals[i] += n
        used = np.flatnonzero(totals)
        yield pa.record_batch([pa.array(used.astype(np.int32)), pa.array(totals[used])], names=["id", "n"])

    learned = words.filter("learned > 0").select("piece", "learned")
    return learned.mapInArrow(count, "id int, n long").groupBy("id").agg(F.sum("n").alias("n"))


def word_scores(words: DataFrame, file: str, ends: int) -> tuple[DataFrame, dict[str, float]]:
    """Per distinct word base, known and score; and the same of the end of a text, with train_tokens."""
    tokens, distinct = words.agg(
        F.coalesce(F.sum("learned"), F.lit(0)), F.count(F.when(F.col("learned") > 0, 1))).first()
    tokens, distinct = tokens + ends, distinct + (ends > 0)
    below = tokens + SMOOTH * (distinct + 1)
    counts = piece_counts(words, file).collect()  # one row per piece of the vocabulary at most
    size = sentencepiece.SentencePieceProcessor(model_file=file).get_piece_size()
    uses = np.full(size + 1, SMOOTH)
    for row in counts:
        uses[row["id"]] += row["n"]
    uses[size] += ends
    log_p = np.log(uses / uses.sum())
    shared = words.sparkSession.sparkContext.broadcast(log_p)  # one number per piece

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice = Lattice(file, shared.value)
        for batch in batches:
            found = lattice.log_probabilities(batch.column("piece").to_pylist()) / math.log(10)
            learned = batch.column("learned").to_numpy()
            yield pa.record_batch(
                [batch.column("piece"), batch.column("n"), pa.array(np.log10((learned + SMOOTH) / below)),
                 pa.array((learned > 0).astype(np.float64)), pa.array(found, pa.float64())],
                names=["piece", "n", "base", "known", "score"])

    scored = words.mapInArrow(score, "piece binary, n long, base double, known double, score double")
    return scored, {"base": math.log10((ends + SMOOTH) / below), "known": float(ends > 0),
                    "score": float(log_p[size]) / math.log(10), "train_tokens": tokens}


def score(docs: DataFrame, file: str) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, one row per row of `docs`.

    `file` is a sentencepiece vocabulary, at the same path on every machine. A null or empty text has one token, its end.
    Rows with a null id belong to the training texts. Repeated rows count as often as they occur. An empty table gives
    an empty result; other columns are ignored. A word of any length is scored whole.
    """
    learns = ~held_out()
    words = stage(counted(docs, Words, learns), "lm-words")
    ends = docs.filter(learns).count()
    scored, end = word_scores(words, file, ends)
    scored = stage(scored.withColumn("one", F.lit(1.0)), "lm-scores")
    total = summed(docs, Words, scored, ["one", "known", "base", "score"], {"doc_id": F.col("doc_id"), "held_out": held_out()})
    return total.select(
        "doc_id", "held_out", (F.col("one") + 1).cast("long").alias("n_tokens"),
        (F.col("known") + end["known"]).cast("long").alias("n_known"), F.lit(end["train_tokens"]).cast("long").alias("train_tokens"),
        (F.col("base") + end["base"]).alias("base_score"), (F.col("score") + end["score"]).alias("score"))
