"""Collocations against a plain count of all phrases."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from changeloom.llm import collocations as C
from changeloom.llm import hashing


def plain(rows, least=30, top=2000):
    """(lang, rank, phrase, a, l, r, n, score) from (lang, text) rows."""
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = lang or "und"
        lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            f.update((lang, tuple(words[i:i + k])) for k in range(1, 5) for i in range(len(words) - k + 1))
    often = {key: a for key, a in f.items() if len(key[1]) > 1 and a >= least}
    gone = set()
    for (lang, words), a in often.items():
        for size in range(2, len(words)):
            for i in range(len(words) - size + 1):
                if 100 * a >= 80 * f[lang, words[i:i + size]]:
                    gone.add((lang, words[i:i + size]))
    by_lang = defaultdict(list)
    for (lang, words), a in often.items():
        if (lang, words) not in gone:
            cuts = [(f[lang, words[:k]], f[lang, words[k:]]) for k in range(1, len(words))]
            score, _, l, r = min((2_000_000 * a // (l + r), k, l, r) for k, (l, r) in enumerate(cuts))
            by_lang[lang].append((-score, -a, " ".join(words).encode(), l, r))
    return sorted((lang, i, w.decode(), -a, l, r, n[lang], -score) for lang, found in by_lang.items()
                  for i, (score, a, w, l, r) in enumerate(sorted(found)[:top], 1))


def rows_of(df):
    return sorted(tuple(r) for r in df.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())


@pytest.fixture
def made():
    rng = random.Random(11)
    words = ["the", "of", "New", "york", "city", "HALL", "é", "été", "Ü", "x\x1cy", "'s", "日本", "a" * 80, "\x00b", "to", "be"]
    common = ["new york city hall", "to be, of the", "the of", "日本 é 日本", "of " + "a" * 80, "x\x1cy Ü"]
    rows = []
    for i in range(120):
        parts = [rng.choice(common) if rng.random() < 0.6 else rng.choice(words) for _ in range(40)]
        seps = [rng.choice([" ", " ", "  ", "\t", ". ", "\n", "\x0b", " ! "]) for _ in parts]
        rows.append((rng.choice(["en", "en", "fr", None]), "".join(p + s for p, s in zip(parts, seps))))
    return [*rows, ("en", None), (None, ""), ("de", "only here"), ("fr", ".,;"), ("en", "the of " * 30_000), *[("en", "ties one. ties two.")] * 30]


@pytest.mark.parametrize("heads", [C.HEADS, (4, 3, 2), (8, 20, 1), (0, 0, 0), (100, 0, 5)])
def test_phrases_equal_a_plain_count(spark, made, heads):
    docs = spark.createDataFrame([(i, *row) for i, row in enumerate(made)], "doc_id long, lang string, text string")
    for name in ("phrase", "f", "code", "n", "step", "words", "length", "rank", "k"):
        docs = docs.withColumn(name, F.lit("x"))
    expected = plain(made)
    assert len(expected) > 20 and {r[0] for r in expected} == {"en", "fr", "und"}
    assert rows_of(C.collocations(docs, heads=heads)) == expected


def test_top_and_empty(spark, made):
    docs = spark.createDataFrame(made, "lang string, text string")
    assert rows_of(C.collocations(docs, least=40, top=3)) == plain(made, 40, 3)
    assert C.collocations(docs.filter("lang = 'xx'")).count() == 0


@pytest.mark.parametrize("tile, dense", [(10, 1 << 16), (2, 1), (3, 40), (1, 5)])
def test_tiles_count_every_pair(tile, dense):
    rng = np.random.default_rng(1)
    codes = (rng.zipf(1.5, 5000) % 50 << 32) | rng.zipf(1.5, 5000) % 90
    found = [dict(zip(c.tolist(), n.tolist())) for c, n in C.tiled(codes, tile, dense)]
    assert sum(map(len, found)) == len(set(codes.tolist()))
    assert {c: n for part in found for c, n in part.items()} == Counter(codes.tolist())
    assert all(len(c) == 0 for c, _ in C.tiled(codes[:0], tile, dense))


def test_words_of_many_texts_are_cut_at_once(made):
    langs, texts = [lang or "und" for lang, _ in made], [(text or "").encode() for _, text in made]
    words = C.cut(langs, texts)
    found = defaultdict(list)
    for i, (row, piece) in enumerate(zip(words.row.tolist(), words.piece.tolist())):
        found[row, piece].append(words.phrase(i))
    expected = [(row, piece.split()) for row, text in enumerate(texts) for piece in re.split(rb"[.,;:!?\x0A-\x0D]", text.lower()) if piece.split()]
    assert [(row, piece) for (row, _), piece in found.items()] == expected
    named = {(langs[row], words.phrase(i)) for i, row in enumerate(words.row.tolist())}
    assert len(np.unique(words.hashes)) == len(named)
    empty = C.cut(["en", "fr"], [b"", b" .\n"])
    assert len(empty.starts) == len(empty.hashes) == 0


def test_words_are_hashed_at_once_as_one_by_one():
    rng = random.Random(4)
    words = [bytes(rng.choice(b"abc\xc3\xa9xyz") for _ in range(n)) for n in [*range(80), *range(80)]]
    sizes = np.array([len(w) for w in words])
    found = hashing.xxhash64_words(b"".join(words), np.cumsum(sizes) - sizes, sizes)
    assert found.tolist() == [xxhash.xxh64_intdigest(w, 42) for w in words]
    numbers = np.array([0, 1, 2**63, 2**64 - 1], np.uint64)
    assert hashing.xxhash64_numbers(numbers).tolist() == [xxhash.xxh64_intdigest(n.tobytes(), 42) for n in numbers]


@pytest.mark.parametrize("n", [0, 1, 2, 1000])
def test_a_table_finds_its_keys_only(n):
    rng = np.random.default_rng(n)
    keys = np.unique(np.concatenate([rng.integers(0, 2**64, n, np.uint64), np.arange(n // 2, dtype=np.uint64)]))
    rng.shuffle(keys)
    others = np.setdiff1d(np.concatenate([keys + np.uint64(1), keys ^ np.uint64(1 << 63), np.array([7, 2**64 - 1], np.uint64)]), keys)
    table = hashing.Table(keys)
    assert table.find(keys).tolist() == list(range(len(keys)))
    assert (table.find(others) == -1).all()
    assert len(table.find(keys[:0])) == 0
