"""Toxicity by weak supervision.

Voters are lexicon stems that stand out in a bounded sample of labelled rows, and patterns of how dense they are. A
generative label model describes the votes of each class by the accuracy of each voter (its mean) and the correlations
between voters (a covariance that both classes share); the given label is one more voter, which can be wrong. Its posterior
labels train a linear classifier, which scores every text.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rows whose crc32(doc_id as text) leaves this remainder are held out; a score from CUT on is toxic.
FOLDS, HELD_OUT = 3, 1
CUT = 0.7
#: Labelled rows that the model is fitted on, at most; stems that it knows; voters among them.
SAMPLE = 20_000
STEMS = 600
VOTERS = 48
#: Thresholds of the patterns: words with a stem, and their share of all words (TIMES and SHARES).
#: Least log-odds of a stem, and least log-odds times the root of its toxic texts; in a small sample, that is no more than
#: GAIN_SHARE times the root of all toxic texts.
MIN_ODDS, MIN_GAIN, GAIN_SHARE = 2.0, 8.0, 0.45
TIMES = (1, 2, 3, 5)
SHARES = (0.003, 0.006, 0.01, 0.015, 0.02, 0.03)
#: Weight of the squares of the classifier's weights.
PENALTY = 1e-4
#: Lengths of the beginnings of words that can be stems; a whole word ends with a mark.
PREFIXES = range(4, 9)
END = "$"
#: Share of given labels that the label model takes to be wrong.
LABEL_NOISE = 0.02
#: Words whose stems a task remembers.
REMEMBERED = 300_000
WORDS = re.compile(r"[^\W\d_]+")


def held_out(doc_id: str = "doc_id") -> Column:
    """A null id is not held out; as it has no label, nothing is learned from it either."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % FOLDS == HELD_OUT, F.lit(False))


def forms(word: str) -> list[str]:
    return [word + END, *(word[:n] for n in PREFIXES if n <= len(word))]


def sample(docs: DataFrame, labels: DataFrame, size: int = SAMPLE) -> DataFrame:
    """text, toxic of the first `size` labelled ids in the order of a hash, none of them held out; one row per id.

    Where labels of an id differ, toxic counts. Of rows that share an id, the one with the least text is taken.
    """
    known = labels.filter("doc_id IS NOT NULL AND toxic IS NOT NULL").filter(~held_out())
    known = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    first = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(size)
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    joined = texts.join(F.broadcast(first), "doc_id").groupBy("doc_id").agg(F.min("text").alias("text"), F.max("toxic").alias("toxic"))
    return joined.select("text", (F.col("toxic") > 0).cast("int").alias("toxic"))


def stems(sampled: DataFrame, size: int = STEMS) -> list[str]:
    """The beginnings of words that speak most for toxic texts, by how much more of their words have them, best first.

    What a stem says is the log of the ratio of its shares of the words, times the root of the number of toxic texts that
    have it. Of stems with the same counts, one of which begins the other, only the shorter is taken. Where none reaches the
    thresholds, those that speak for toxic at all are taken.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        times: tuple[Counter, Counter] = (Counter(), Counter())
        texts: Counter = Counter()
        for batch in batches:
            for text, toxic in zip(batch.column("text"), batch.column("toxic").to_pylist()):
                words = Counter(WORDS.findall(text.as_py().lower()))
                of_text: Counter = Counter()
                for word, n in words.items():
                    for form in forms(word):
                        of_text[form] += n
                of_text[""] = words.total()
                times[toxic].update(of_text)
                if toxic:
                    texts.update(of_text.keys())
        known = list(times[0].keys() | times[1].keys())
        for at in range(0, len(known), 50_000):
            part = known[at : at + 50_000]
            yield pa.record_batch([pa.array(part, pa.string()), *(pa.array([n[form] for form in part], pa.int64()) for n in (*times, texts))],
                                  names=["stem", "clean", "toxic", "texts"])

    toxic_texts = sampled.filter("toxic = 1").count()
    counts = sampled.mapInArrow(count, "stem string, clean long, toxic long, texts long").groupBy("stem").agg(
        *(F.sum(c).alias(c) for c in ("clean", "toxic", "texts"))).filter(f"texts >= {min(3, max(toxic_texts, 1))} OR stem = ''").persist()
    whole = counts.filter("stem = ''").first()
    if whole is None or not whole["clean"] or not whole["toxic"]:
        counts.unpersist()
        return []
    odds = F.log((F.col("toxic") + 0.5) / whole["toxic"]) - F.log((F.col("clean") + 0.5) / whole["clean"])
    gain = odds * F.sqrt("texts")
    found: list[str] = []
    for least_odds, least_gain in ((MIN_ODDS, min(MIN_GAIN, GAIN_SHARE * toxic_texts**0.5)), (0.0, 0.0)):
        if found:
            break
        best = counts.filter("stem <> ''").filter(odds > least_odds).withColumn("gain", gain).filter(F.col("gain") > least_gain).groupBy(
            "clean", "toxic", "texts", "gain", F.substring("stem", 1, min(PREFIXES)).alias("start")).agg(
            F.min(F.struct(F.length("stem"), "stem")).alias("least"))
        found = [row["stem"] for row in best.select("least.stem", "gain").orderBy(F.desc("gain"), "stem").limit(size).collect()]
    counts.unpersist()
    return found


class Features:
    """Counts of known stems in a text: sparse features of the classifier, and votes."""

    def __init__(self, known: list[str]) -> None:
        self._at = {stem: i for i, stem in enumerate(known)}
        self._words: dict[str, tuple[int, ...]] = {}

    def _of(self, word: str) -> tuple[int, ...]:
        found = self._words.get(word)
        if found is None:
            if len(self._words) >= REMEMBERED:
                self._words.clear()
            found = self._words[word] = tuple(self._at[form] for form in forms(word) if form in self._at)
        return found

    def counts(self, text: str) -> tuple[Counter, int, int]:
        """Times of each stem, words that have any, and all words."""
        words = Counter(WORDS.findall(text.lower()))
        stems_found: Counter = Counter()
        hits = 0
        for word, n in words.items():
            found = self._of(word)
            if found:
                hits += n
                for i in found:
                    stems_found[i] += n
        return stems_found, hits, words.total()


def patterns(hits: int, total: int) -> list[float]:
    """Which thresholds the words with a stem reach, in number and as a share."""
    share = hits / max(total, 1)
    return [float(hits >= n) for n in TIMES] + [float(share >= x) for x in SHARES]


PATTERNS = len(TIMES) + len(SHARES)


def features_of(found: Counter, hits: int, total: int) -> tuple[list[int], list[float]]:
    """Of the classifier: first the patterns, then per stem its times per hundred words, damped."""
    rate = 100 / max(total, 20)
    return ([*range(PATTERNS), *(PATTERNS + i for i in found)], [*patterns(hits, total), *(float(np.log1p(n * rate)) for n in found.values())])


def votes_of(found: Counter, hits: int, total: int) -> np.ndarray:
    """Of each voter 1 (toxic) or 0: the first stems, and the patterns."""
    votes = np.zeros(VOTERS + PATTERNS)
    for i in found:
        if i < VOTERS:
            votes[i] = 1
    votes[VOTERS:] = patterns(hits, total)
    return votes


def label_model(votes: np.ndarray, given: np.ndarray, rounds: int = 1) -> np.ndarray:
    """Posterior probability of toxic for each row: EM over class means (accuracies) and a shared covariance (correlations).

    It starts from the given labels and takes one round: more of them would end with the voters' own opinion.
    """
    posterior = np.where(given > 0, 1 - LABEL_NOISE, LABEL_NOISE)
    for _ in range(rounds):
        share = np.clip(posterior.mean(), 1e-3, 1 - 1e-3)
        means = [(votes * (p[:, None])).sum(axis=0) / max(p.sum(), 1e-9) for p in (1 - posterior, posterior)]
        covariance = sum(((votes - m) * p[:, None]).T @ (votes - m) for p, m in ((1 - posterior, means[0]), (posterior, means[1])))
        covariance = covariance / len(votes) + 0.02 * np.eye(votes.shape[1])
        weights = np.linalg.solve(covariance, means[1] - means[0])
        margin = (votes - (means[0] + means[1]) / 2) @ weights
        label = np.where(given > 0, 1, -1) * np.log((1 - LABEL_NOISE) / LABEL_NOISE)
        logit = np.clip(margin, -5, 5) + label + np.log(share / (1 - share))
        posterior = 1 / (1 + np.exp(-np.clip(logit, -30, 30)))
    return posterior


#: Stems, the weights of the patterns and the stems, and the bias.
Model = tuple[list[str], np.ndarray, float]


def fit_linear(rows: list[tuple[list[int], list[float]]], target: np.ndarray, width: int, rounds: int = 300) -> tuple[np.ndarray, float]:
    """Logistic regression on soft labels, by gradient steps with momentum (Adam)."""
    place = np.concatenate([np.full(len(columns), i) for i, (columns, _) in enumerate(rows)])
    column = np.concatenate([np.array(columns) for columns, _ in rows])
    value = np.concatenate([np.array(values, float) for _, values in rows])
    weights, bias = np.zeros(width), 0.0
    first, second = np.zeros(width + 1), np.zeros(width + 1)
    for step in range(1, rounds + 1):
        logit = np.bincount(place, value * weights[column], len(rows)) + bias
        error = (1 / (1 + np.exp(-np.clip(logit, -30, 30))) - target) / len(rows)
        gradient = np.append(np.bincount(column, value * error[place], width) + PENALTY * weights, error.sum())
        first, second = 0.9 * first + 0.1 * gradient, 0.999 * second + 0.001 * gradient**2
        move = 0.1 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
        weights, bias = weights - move[:-1], bias - move[-1]
    return weights, float(bias)


def fit(docs: DataFrame, labels: DataFrame, size: int = SAMPLE) -> Model | None:
    """The classifier; None if the sample lacks one of the classes, or no stem speaks for toxic."""
    sampled = sample(docs, labels, size).persist()
    try:
        known = stems(sampled)
        if not known:
            return None
        shared = docs.sparkSession.sparkContext.broadcast(known)  # no more than STEMS

        def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            features = Features(shared.value)
            for batch in batches:
                found = [features.counts(text.as_py()) for text in batch.column("text")]
                yield pa.record_batch(
                    [pa.array([list(f) for f, _, _ in found], pa.list_(pa.int32())), pa.array([list(f.values()) for f, _, _ in found], pa.list_(pa.int32())),
                     pa.array([h for _, h, _ in found], pa.int32()), pa.array([n for _, _, n in found], pa.int32()), batch.column("toxic")],
                    names=["stems", "times", "hits", "total", "toxic"])

        rows = sampled.mapInArrow(extract, "stems array<int>, times array<int>, hits int, total int, toxic int").collect()
        # one order, whatever the tasks were, so that reruns agree
        rows.sort(key=lambda r: (r["toxic"], r["hits"], r["total"], r["stems"], r["times"]))
    finally:
        sampled.unpersist()
    found = [(Counter(dict(zip(r["stems"], r["times"]))), r["hits"], r["total"]) for r in rows]
    posterior = label_model(np.array([votes_of(*f) for f in found]), np.array([r["toxic"] for r in rows]))
    weights, bias = fit_linear([features_of(*f) for f in found], posterior, PATTERNS + len(known))
    return known, weights, bias


class Scores:
    def __init__(self, model: Model | None) -> None:
        self._known = model is not None
        if model is not None:
            stems_known, self._weights, self._bias = model
            self._features = Features(stems_known)

    def of(self, texts: pa.Array) -> pa.Array:
        out = np.zeros(len(texts))
        for i, text in enumerate(texts if self._known else ()):
            columns, values = features_of(*self._features.counts(text.as_py() or ""))
            logit = self._bias + float(np.dot(self._weights[columns], values))
            out[i] = 1 / (1 + np.exp(-min(max(logit, -30), 30)))
        return pa.array(out)


def score(docs: DataFrame, labels: DataFrame, size: int = SAMPLE) -> DataFrame:
    """doc_id, held_out, score, predicted, one row per row of `docs`.

    A null or empty text has no stems and gets the score of the bias alone. If the labels lack one of the classes, nothing
    can be learned and every score is 0. Null ids, repeated rows and other columns change nothing (only the text is
    scored); an empty table gives an empty result. Texts are read whole.
    """
    shared = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, size))

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scores = Scores(shared.value)
        for batch in batches:
            yield pa.record_batch([batch.column("doc_id"), batch.column("held_out"), scores.of(batch.column("text"))],
                                  names=["doc_id", "held_out", "score"])

    texts = docs.select("doc_id", held_out().alias("held_out"), "text")
    scored = texts.mapInArrow(apply, f"doc_id {dict(texts.dtypes)['doc_id']}, held_out boolean, score double")
    return scored.withColumn("predicted", (F.col("score") >= CUT).cast("int"))


def reject(docs: DataFrame, labels: DataFrame, size: int = SAMPLE) -> DataFrame:
    """`docs` without the toxic rows: those whose score reaches CUT."""
    shared = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, size))

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scores = Scores(shared.value)
        for batch in batches:
            yield batch.filter(pc.less(scores.of(batch.column("text")), CUT))

    return docs.mapInArrow(apply, docs.schema)
