"""Packing against the tokenizer library: every id in one piece, no gaps, and neighbours along the curve."""

import zlib
from collections import defaultdict
from itertools import product

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import pytest
from tokenizers import Tokenizer

from changeloom.llm import packing
from changeloom.llm.queries import QUERIES

FILE = public_tokenizers.path("word_bpe_49k.json")
NAMES = ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(FILE)


def check(rows, ids_of, size):
    """All ids of each document lie in its pieces, and each sequence is full or as long as a power of two, without gaps."""
    pieces, sequences = defaultdict(list), defaultdict(list)
    for row in rows:
        pieces[row["doc_id"]].append(row)
        sequences[row["sequence_id"]].append((row["offset"], row["length"]))
    assert set(pieces) == set(ids_of)
    for doc_id, own in pieces.items():
        at, ids = 0, np.array(ids_of[doc_id], "<u4")
        for row in sorted(own, key=lambda r: r["start"]):
            assert row["start"] == at and row["length"] > 0 and row["doc_tokens"] == len(ids)
            assert row["ids_crc32"] == zlib.crc32(ids[at : at + row["length"]].tobytes())
            at += row["length"]
        assert at == len(ids)
    assert sorted(sequences) == list(range(len(sequences)))
    for number, own in sequences.items():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= size and at & at - 1 == 0


def test_query_packs_every_id_once(spark, sf_dir, library):
    table = pq.read_table(f"{sf_dir}/documents.parquet", columns=["doc_id", "text"])
    ids = {i: [*library.encode(t or "", add_special_tokens=False).ids, 2] for i, t in zip(*(table[c].to_pylist() for c in table.column_names))}
    result = QUERIES["op13_pack_along_curve"](spark, sf_dir)
    assert set(NAMES) <= set(result.columns)
    check(result.collect(), ids, 4096)


TEXTS = {1: None, 2: "", 3: "The  quick\n\tBROWN fox's", 4: "word " * 9000, 5: "a<|endoftext|>b <|startoftext|> c", 6: "é é ́ x y z\u0085w",
         7: "ΑΣ ΟΔΟΣ İI ǅ", 8: "x" * 5000, 9: "\x00 \x1c a\x1cb", None: "no id", 10: "  ", 11: "don't 'S'll 12 345 ½ 漢字 🙂🙂"}


def test_edge_cases_equal_the_library(documents, library):
    docs = documents(list(TEXTS.items()))
    ids = {i: [*library.encode(t or "", add_special_tokens=False).ids, 2] for i, t in TEXTS.items()}
    for size in (4096, 8):
        check(packing.pack(docs, FILE, size=size).collect(), ids, size)
    rows = packing.pack(docs, FILE).collect()
    whole = {r["doc_id"]: b"" for r in rows}
    for r in sorted(rows, key=lambda r: r["start"]):
        whole[r["doc_id"]] += bytes(r["ids"])
    assert {i: np.frombuffer(b, "<u4").tolist() for i, b in whole.items()} == ids
    assert packing.pack(docs.filter("doc_id > 100"), FILE).count() == 0


def test_repeated_rows_are_packed_each(documents):
    rows = packing.pack(documents([(1, "the same text")] * 5), FILE, size=16).collect()
    assert sum(r["length"] for r in rows) == 5 * 4 and {r["doc_tokens"] for r in rows} == {4}


@pytest.mark.parametrize("axes, bits", [(2, 4), (3, 3), (4, 2)])
def test_the_curve_visits_every_cell_and_steps_to_a_neighbour(axes, bits):
    cells = np.array(list(product(range(1 << bits), repeat=axes)))
    places = packing.hilbert(cells, bits)
    assert sorted(places) == list(range(len(cells)))
    steps = np.abs(np.diff(cells[np.argsort(places)], axis=0)).sum(axis=1)
    assert (steps == 1).all()


def test_similar_documents_are_neighbours(documents):
    """Ten topics of twenty documents: along the curve, most documents follow one of their own topic."""
    rng = np.random.default_rng(5)
    words = [f"{a}{b}" for a in ("red", "blue", "sun", "moon", "star", "tree", "fish", "bird") for b in ("house", "road", "man", "land", "day")]
    rows = []
    for topic in range(10):
        own = rng.choice(words, 12, replace=False)
        rows += [(topic * 100 + i, " ".join(rng.choice(own, 300))) for i in range(20)]
    shuffled = [rows[i] for i in rng.permutation(len(rows))]
    pieces = packing.pack(documents(shuffled), FILE).collect()
    order = [r["doc_id"] // 100 for r in sorted(pieces, key=lambda r: (r["sequence_id"], r["offset"])) if r["start"] == 0]
    together = sum(a == b for a, b in zip(order, order[1:]))
    assert together > 120  # 20 by chance


def test_plain_texts_need_the_model_alone(monkeypatch):
    """Runs of plain texts are encoded without the records that the library keeps per token; the ids are the library's."""
    asked = []

    class Watched:
        def __init__(self, own):
            self._own = own if isinstance(own, Tokenizer) else Tokenizer(own)

        @staticmethod
        def from_file(file):
            return Watched(Tokenizer.from_file(file))

        def __getattr__(self, name):
            if name.startswith("encode"):
                asked.append(name)
            return getattr(self._own, name)

    monkeypatch.setattr(packing, "Tokenizer", Watched)
    words, library = packing.Words(FILE), Tokenizer.from_file(FILE)
    texts = ["It's 12 words, x2y; (straße) naïve...", "", "Été a\nb\tzzqxkjv we'LL don't.'S", "It's " * 50]
    asked.clear()
    found = words.of(texts)
    assert not asked
    assert [own.tolist() for own in found] == [library.encode(text, add_special_tokens=False).ids for text in texts]
    assert words.of(["日本 a"])[0].tolist() == library.encode("日本 a", add_special_tokens=False).ids
    assert asked
