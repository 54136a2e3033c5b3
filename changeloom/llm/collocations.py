"""Phrase collocations: pairs counted in tiles of a table addressed by rank, then pairs of frequent pairs, and so on.

Words (per language) are ranked by frequency. A pair of neighbours is a cell of a table of ranks by ranks, which is cut into
tiles of `TILE` by `TILE` cells. Where a task has many pairs in a tile, it counts them in a dense array; all others are sorted, and
runs of equal cells counted. The counts are summed by Spark, cell by cell. Pairs that are frequent are ranked anew, and pairs of
neighbouring pairs, which share a word, are the phrases of three words; and once more for four. No phrase is more frequent than its
parts, so none is lost.

Tasks cut many texts at once, and find words by 64-bit hashes of them and their language, which two words share by chance in about one
of a million large corpora. They get a table of the most frequent phrases of each length, of a fixed size (`HEADS`). What is frequent and not in it goes by
text instead, through a filter of a fixed size that tells what may be frequent; so results do not depend on these sizes.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from changeloom.llm.hashing import BYTES, Table, mixed, slices, word_hashes, xxhash64_words
from changeloom.llm.tables import stage

LEAST, LONGEST, TOP, INSIDE, SCALE = 30, 4, 2000, 80, 2_000_000
#: Words, and phrases of each greater length, that go to every task: 20 MB and 12 MB at most. Longer words go by text.
HEADS, HEAD_BYTES = (1 << 18, 1 << 20, 1 << 20), 64
#: Cells of a filter: the greatest prime below 2**23.
CELLS = 8_388_593
#: Cells along the side of a tile as a power of two, pairs from which on a tile is counted densely, and pairs held by a task.
TILE, DENSE, HELD = 10, 1 << 16, 1 << 22
#: Distinct words or phrases that a task holds by text.
TEXTS = 250_000
RARE, UNRANKED = -1, -2
#: What parts pieces becomes a line feed, what parts words a space.
_BREAKS = bytes.maketrans(b".,;:!?\x0b\x0c\r\t", b"\n" * 9 + b" ")


@dataclass
class Words:
    """All words of some texts: where they start and end in `text`, the piece and the row of each, and a hash of it and its language."""

    text: bytes
    starts: np.ndarray
    ends: np.ndarray
    piece: np.ndarray
    row: np.ndarray
    hashes: np.ndarray

    def phrase(self, at: int, n: int = 1) -> bytes:
        """The n words from the one at `at` on."""
        if n == 1:
            return self.text[self.starts[at] : self.ends[at]]
        return b" ".join([self.text[i:j] for i, j in zip(self.starts[at : at + n].tolist(), self.ends[at : at + n].tolist())])


def _lang_hashes(langs: list[str]) -> np.ndarray:
    return word_hashes([lang.encode() for lang in langs])


def cut(langs: list[str], texts: list[bytes]) -> Words:
    """The words of each piece; ASCII letters in lower case."""
    text = b"\n".join(texts).lower().translate(_BREAKS)
    values = np.frombuffer(text, np.uint8)
    inside = np.zeros(len(values) + 2, bool)
    inside[1:-1] = (values != 32) & (values != 10)
    turns = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = turns[::2], turns[1::2]
    piece = np.searchsorted(np.flatnonzero(values == 10), starts)
    row = np.searchsorted(np.cumsum([len(t) + 1 for t in texts]), starts, "right")
    return Words(text, starts, ends, piece, row, xxhash64_words(text, starts, ends - starts) ^ _lang_hashes(langs)[row])


def _cuts(batches: Iterator[pa.RecordBatch], size: int = BYTES) -> Iterator[tuple[list[str], Words]]:
    """The languages of the rows and the words of their texts, some rows at a time."""
    for batch in batches:
        for start, n in slices(batch.column("text"), size):
            langs = batch.column("lang").slice(start, n).to_pylist()
            yield langs, cut(langs, batch.column("text").slice(start, n).to_pylist())


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), F.coalesce("text", F.lit("")).cast("binary").alias("text"))


def _named(lang: str, phrase: bytes) -> bytes:
    return lang.encode() + b"\n" + phrase


def word_counts(docs: DataFrame) -> DataFrame:
    """lang, phrase, f of every word; the row without a phrase has the number of all words of its language."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, Counter] = {}
        total = Counter()

        def rows() -> Iterator[pa.RecordBatch]:
            for lang, words in held.items():
                yield pa.record_batch([pa.array([lang] * len(words), pa.string()), pa.array(list(words), pa.binary()).cast(pa.string()),
                                       pa.array(list(words.values()), pa.int64())], names=["lang", "phrase", "f"])
            held.clear()

        for langs, words in _cuts(batches, 2 * BYTES):
            for lang, n in zip(langs, np.bincount(words.row, minlength=len(langs)).tolist()):
                total[lang] += n
            _, first, n = np.unique(words.hashes, return_index=True, return_counts=True)
            counters = [held.setdefault(lang, Counter()) for lang in langs]
            found = zip(words.row[first].tolist(), words.starts[first].tolist(), words.ends[first].tolist(), n.tolist())
            for row, start, end, m in found:
                counters[row][words.text[start:end]] += m
            if sum(map(len, held.values())) > TEXTS:
                yield from rows()
        yield from rows()
        yield pa.record_batch([pa.array(list(total), pa.string()), pa.nulls(len(total), pa.string()),
                               pa.array(list(total.values()), pa.int64())], names=["lang", "phrase", "f"])

    return _texts(docs).mapInArrow(count, "lang string, phrase string, f long").groupBy("lang", "phrase").agg(F.sum("f").alias("f"))


def _filter(keys: DataFrame) -> np.ndarray | None:
    """Bits of the cells that the keys (cell) fall into; the driver gets one number per 63 cells at most."""
    found = keys.groupBy(F.expr("cell DIV 63").alias("at")).agg(F.bit_or(F.expr("shiftleft(1L, CAST(cell % 63 AS INT))")).alias("bits")).toArrow()
    if not found.num_rows:
        return None
    words = np.zeros(CELLS // 63 + 1, np.int64)
    words[found["at"].to_numpy()] = found["bits"].to_numpy()
    return words


def _held(bits: np.ndarray | None, cells: np.ndarray) -> np.ndarray:
    return np.zeros(len(cells), bool) if bits is None else (bits[cells // 63] >> (cells % 63) & 1).astype(bool)


@dataclass
class Level:
    """What tasks know of the frequent phrases of one length."""

    codes: np.ndarray | None = None  # the ranked ones by code in order, and the rank of each
    ranks: np.ndarray | None = None
    coded: np.ndarray | None = None  # filters of the others: by code, and by text
    texted: np.ndarray | None = None

    def table(self) -> Table:
        """Of the ranked ones, by rank."""
        ordered = np.empty_like(self.codes)
        ordered[self.ranks] = self.codes
        return Table(mixed(ordered.view(np.uint64)))

    def place(self, table: Table, codes: np.ndarray) -> np.ndarray:
        """The rank of each code, or whether it is rare or without a rank."""
        places = table.find(mixed(codes.view(np.uint64)))
        if self.coded is not None:
            places[(places < 0) & _held(self.coded, codes % CELLS)] = UNRANKED
        return places


@dataclass
class Known:
    """What is known before phrases of the next length are counted."""

    langs: list[str] = field(default_factory=list)
    words: list[bytes] = field(default_factory=list)  # by rank
    lang_of: np.ndarray | None = None
    word_filter: np.ndarray | None = None
    levels: list[Level] = field(default_factory=list)  # of two words and more

    def table(self) -> Table:
        """Of the ranked words, by rank."""
        text, sizes = b"".join(self.words), np.fromiter(map(len, self.words), np.int64, len(self.words))
        hashes = xxhash64_words(text, np.cumsum(sizes) - sizes, sizes)
        return Table(hashes ^ _lang_hashes(self.langs)[self.lang_of] if len(hashes) else hashes)

    def phrases(self, codes: np.ndarray, length: int) -> tuple[list[str], list[bytes]]:
        """The language and the text of phrases by code."""
        columns = [codes >> 32, codes & 0xFFFFFFFF]
        by_rank = []
        for level in self.levels[: length - 2]:
            ordered = np.empty_like(level.codes)
            ordered[level.ranks] = level.codes
            by_rank.append(ordered)
        for ordered in reversed(by_rank):  # a phrase is its first part, and the last word of its second
            parts = [ordered[c] for c in columns]
            columns = [parts[0] >> 32, *(p & 0xFFFFFFFF for p in parts)]
        texts = [b" ".join([self.words[i] for i in row]) for row in zip(*(c.tolist() for c in columns))]
        return [self.langs[i] for i in self.lang_of[columns[0]].tolist()] if len(codes) else [], texts


def tiled(codes: np.ndarray, tile: int = TILE, dense: int = DENSE) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Distinct codes (first rank, second rank) and how often each occurs."""
    first, second = codes >> 32, codes & 0xFFFFFFFF
    side = (int(codes.max() >> 32 if len(codes) else 0) >> tile) + 1  # ranks are bounded, and so is the number of tiles
    tiles = (first >> tile) + side * (second >> tile)
    sizes = np.bincount(tiles, minlength=1)
    for number in np.flatnonzero(sizes >= dense).tolist():
        inside = tiles == number
        cells = ((first[inside] & (1 << tile) - 1) << tile) | (second[inside] & (1 << tile) - 1)
        counts = np.bincount(cells, minlength=1 << 2 * tile)
        cells = np.flatnonzero(counts)
        top, left = number % side << tile, number // side << tile
        yield (top + (cells >> tile) << 32) | (left + (cells & (1 << tile) - 1)), counts[cells]
    yield np.unique(codes[(sizes < dense)[tiles]], return_counts=True)


def _count(docs: DataFrame, known: Known) -> DataFrame:
    """code, lang, phrase, n: counts of the phrases one word longer than those known, by code or by text."""
    shared = docs.sparkSession.sparkContext.broadcast(known.__dict__ | {"levels": [level.__dict__ for level in known.levels]})

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Known(**shared.value | {"levels": [Level(**level) for level in shared.value["levels"]]})
        ranks, tables = known.table(), [level.table() for level in known.levels]
        held: list[np.ndarray] = []
        size = 0
        texts: Counter = Counter()

        def coded() -> Iterator[pa.RecordBatch]:
            if held:
                for codes, n in tiled(np.concatenate(held)):
                    none = pa.nulls(len(codes), pa.string())
                    yield pa.record_batch([pa.array(codes), none, none, pa.array(n, pa.int64())], names=["code", "lang", "phrase", "n"])
                held.clear()

        def texted() -> Iterator[pa.RecordBatch]:
            if texts:
                yield pa.record_batch(
                    [pa.nulls(len(texts), pa.int64()), pa.array([lang for lang, _ in texts], pa.string()),
                     pa.array([phrase for _, phrase in texts], pa.binary()).cast(pa.string()), pa.array(list(texts.values()), pa.int64())],
                    names=["code", "lang", "phrase", "n"])
                texts.clear()

        def by_text(bits: np.ndarray | None, lang: str, phrase: bytes) -> int:
            if bits is None:
                return RARE
            cell = xxhash.xxh64_intdigest(_named(lang, phrase), 42) % CELLS
            return UNRANKED if int(bits[cell // 63]) >> cell % 63 & 1 else RARE

        for langs, words in _cuts(batches):
            at = np.arange(len(words.row))
            at[1:] += np.cumsum(words.piece[1:] != words.piece[:-1])  # a place is left free between pieces
            place = np.full(at[-1] + 1 if len(at) else 0, RARE)
            place[at] = ranks.find(words.hashes)
            word = np.zeros(len(place), np.int64)
            word[at] = np.arange(len(at))
            if known.word_filter is not None:
                for i in at[place[at] == RARE].tolist():
                    place[i] = by_text(known.word_filter, langs[words.row[word[i]]], words.phrase(word[i]))
            for n, (level, table) in enumerate([*zip(known.levels, tables), (None, None)], 2):
                first, second = place[:-1], place[1:]
                both = (first >= 0) & (second >= 0)
                other = np.flatnonzero((first != RARE) & (second != RARE) & ~both)
                spelled = [(langs[words.row[i]], words.phrase(i, n)) for i in word[other].tolist()]
                codes = first[both] << 32 | second[both]
                if level is None:
                    held.append(codes)
                    size += len(codes)
                    texts.update(spelled)
                else:
                    place = np.full(len(first), RARE)
                    place[both] = level.place(table, codes)
                    for i, (lang, phrase) in zip(other.tolist(), spelled):
                        place[i] = by_text(level.texted, lang, phrase)
            if size >= HELD:
                yield from coded()
                size = 0
            if len(texts) >= TEXTS:
                yield from texted()
        yield from coded()
        yield from texted()

    rows = _texts(docs).mapInArrow(count, "code long, lang string, phrase string, n long")
    return rows.groupBy("code", "lang", "phrase").agg(F.sum("n").alias("f"))


def _least(table: DataFrame, size: int) -> int | None:
    """The count step (an eighth of a doubling) from which on there are no more than `size` rows; the driver gets a row per step."""
    total, least = 0, None
    for row in sorted(table.groupBy("step").count().collect(), reverse=True):
        total += row["count"]
        if total > size:
            break
        least = row["step"]
    return least


def _stepped(table: DataFrame, fits) -> DataFrame:
    return table.withColumn("step", F.when(fits, F.floor(8 * F.log2("f"))).otherwise(F.lit(-1)))


def _cells(table: DataFrame) -> DataFrame:
    name = F.concat("lang", F.lit("\n"), "phrase")
    # a hash without its sign, as it is elsewhere: unsigned remainders by halves
    unsigned = F.expr(f"CAST(CAST(h AS DECIMAL(20,0)) + IF(h < 0, 18446744073709551616BD, 0BD) AS DECIMAL(20,0)) % {CELLS}BD")
    return table.select(F.xxhash64(name).alias("h")).select(unsigned.cast("long").alias("cell"))


def frequent(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, heads: tuple[int, ...] = HEADS) -> tuple[DataFrame, DataFrame]:
    """lang, phrase, length, f of all phrases of up to `longest` words that occur `least` times; and lang, n."""
    counted = stage(word_counts(docs).where(F.col("phrase").isNull() | (F.col("f") >= least)), "collocation-words")
    totals = counted.where("phrase IS NULL").select("lang", F.col("f").alias("n"))
    words = _stepped(counted.where("phrase IS NOT NULL"), F.octet_length("phrase") <= HEAD_BYTES)
    step = _least(words.where("step >= 0"), heads[0])
    ranked = F.lit(False) if step is None else F.col("step") >= step
    head = words.where(ranked).select("lang", F.col("phrase").cast("binary").alias("phrase"), "f").toArrow()  # no more than heads[0]
    order = np.argsort(-head["f"].to_numpy(), kind="stable")
    langs = sorted(set(head["lang"].to_pylist()))
    lang_of, phrases = head["lang"].to_pylist(), head["phrase"].to_pylist()
    known = Known(langs, [phrases[i] for i in order.tolist()], np.array([langs.index(lang_of[i]) for i in order.tolist()], np.int64),
                  _filter(_cells(words.where(~ranked))))
    tables = [words.select("lang", "phrase", F.lit(1).alias("length"), "f")]
    for length in range(2, longest + 1):
        rows = stage(_spelled(_count(docs, known).where(F.col("f") >= least), known, length), f"collocations-{length}")
        tables.append(rows.select("lang", "phrase", F.lit(length).alias("length"), "f"))
        if length < longest:
            coded = _stepped(rows, F.col("code").isNotNull())
            step = _least(coded.where("step >= 0"), heads[length - 1])
            ranked = F.lit(False) if step is None else F.col("step") >= step
            head = coded.where(ranked).select("code", "f").toArrow()  # no more than heads[length - 1]
            codes = head["code"].to_numpy()[np.argsort(-head["f"].to_numpy(), kind="stable")].astype(np.int64)
            by_code = np.argsort(codes)
            others = coded.where(~ranked)
            known.levels.append(Level(
                codes[by_code], by_code.astype(np.int64), _filter(others.where("code IS NOT NULL").select((F.col("code") % CELLS).alias("cell"))),
                _filter(_cells(others.where("code IS NULL")))))
    every = tables[0]
    for table in tables[1:]:
        every = every.unionByName(table)
    return every, totals


def _spelled(rows: DataFrame, known: Known, length: int) -> DataFrame:
    """The rows with their language and text."""
    shared = rows.sparkSession.sparkContext.broadcast(known.__dict__ | {"levels": [level.__dict__ for level in known.levels]})

    def spell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Known(**shared.value | {"levels": [Level(**level) for level in shared.value["levels"]]})
        for batch in batches:
            if not batch.num_rows:
                continue
            coded = batch.filter(batch.column("code").is_valid())
            langs, phrases = known.phrases(coded.column("code").to_numpy(zero_copy_only=False).astype(np.int64), length)
            yield pa.record_batch([coded.column("code"), pa.array(langs, pa.string()), pa.array(phrases, pa.binary()).cast(pa.string()),
                                   coded.column("f")], names=["code", "lang", "phrase", "f"])
            others = batch.filter(batch.column("code").is_null())
            yield pa.record_batch(others.columns, names=["code", "lang", "phrase", "f"])

    return rows.select("code", "lang", "phrase", "f").mapInArrow(spell, "code long, lang string, phrase string, f long")


def collocations(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, top: int = TOP, heads: tuple[int, ...] = HEADS) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's best phrases of two words and more.

    A phrase that occurs `least` times is cut where its parts go together least; the score is the share of the parts'
    occurrences that are the phrase's. A phrase inside a longer one that has `INSIDE` percent of its occurrences goes.
    A null language is `und`, a null or empty text has no words; ties go by count and then by the bytes of the phrase.
    Repeated rows count each, null ids and other columns change nothing, and an empty table gives an empty result. A text
    of any length is one row of one task.
    """
    every, totals = frequent(docs, least, longest, heads)
    counts = stage(every, "collocation-counts")
    wide = "decimal(38,0)"
    longer = counts.where("length > 1").withColumn("words", F.split("phrase", " "))
    cut = longer.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("length") - 1))).select(
        "lang", "phrase", "length", F.col("f").alias("a"), "k", F.array_join(F.slice("words", F.lit(1), F.col("k")), " ").alias("left"),
        F.array_join(F.slice("words", F.col("k") + 1, F.col("length") - F.col("k")), " ").alias("right"))
    parts = counts.select("lang", "phrase", "f")
    left = parts.select("lang", F.col("phrase").alias("left"), F.col("f").alias("l"))
    right = parts.select("lang", F.col("phrase").alias("right"), F.col("f").alias("r"))
    share = F.expr(f"CAST(CAST({SCALE} AS {wide}) * CAST(a AS DECIMAL(19,0)) DIV CAST(l + r AS {wide}) AS BIGINT)")
    best = cut.join(left, ["lang", "left"]).join(right, ["lang", "right"]).withColumn("score", share).groupBy("lang", "phrase").agg(
        F.min(F.struct("score", "k", "l", "r", "a")).alias("cut")).select("lang", "phrase", "cut.*")
    inside = longer.where("length > 2").select("lang", "f", "length", "words", F.explode(F.sequence(F.lit(2), F.col("length") - 1)).alias("size")).select(
        "lang", "f", "words", "size", F.explode(F.sequence(F.lit(1), F.col("length") - F.col("size") + 1)).alias("at")).select(
        "lang", "f", F.array_join(F.slice("words", F.col("at"), F.col("size")), " ").alias("phrase"))
    covered = inside.groupBy("lang", "phrase").agg(F.max("f").alias("more"))
    part = F.expr(f"CAST(more AS {wide}) * 100 >= CAST(a AS {wide}) * {INSIDE}")
    left_over = best.join(covered, ["lang", "phrase"], "left").where(~F.coalesce(part, F.lit(False)))
    place = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    first = left_over.withColumn("rank", F.row_number().over(place)).where(F.col("rank") <= top)
    return first.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
