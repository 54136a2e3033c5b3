"""Token counts: pieces are counted once per distinct pre-token, joined to the pre-tokens of each document, and summed."""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from functools import partial

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from changeloom.llm.bags import counted, summed
from changeloom.llm.tables import stage

LIMIT = 512
#: Letters and signs that no engine takes for white space. Between one of them and a space that another follows, a
#: byte-level pre-tokenizer always cuts: white space only stands at the start of a pre-token, or alone.
INK = r"[!-~¡-ʯͰ-֏]"
CUT = re.compile(f"(?<={INK})(?= {INK})")
#: A space at which a text must not be cut without a closer look.
ODD = re.compile(f" (?:(?<!{INK} )|(?!{INK}))")
#: A line feed that does not stand alone between two such signs; any other is a pre-token of its own.
ODD_LINE = re.compile(f"\n(?:(?<!{INK}\n)|(?!{INK}))")
#: Letters, digits and signs whose classes every engine agrees on; most units have no others. And the pre-tokens of such units:
#: the contractions, letters, digits, or signs, each but the first with the space before it.
PLAIN = re.compile(r" ?[!-~À-ÖØ-öø-ɏ]+")
SIGNS = r"[!-/:-@\[-`{-~]"
PARTS = re.compile(rf"'(?:[stmd]|re|ve|ll)| ?[A-Za-zÀ-ÖØ-öø-ɏ]+| ?[0-9]+| ?{SIGNS}+")
#: Texts that tell whether a pre-tokenizer follows these rules.
SAMPLES = (" it's", "a, b", "it.)x", " a1b22", " -x'd'll", "'tis'", "''s", " 'VE'S", " 3.14%", "naïve- Œuvre", "you're we've I'm", "$5 (x)")
#: Pre-tokens that are encoded together.
ENCODED = 2_000
#: Stands before a unit that does not begin with the space before it.
BARE = "\0"


class PreTokens:
    """Cuts a text into units, and those into the library's own pre-tokens.

    A unit is a word after a space, a line feed and the word after it, or a marked text.
    """

    def __init__(self, file: str) -> None:
        tokenizer = Tokenizer.from_file(file)
        self._cut = tokenizer.pre_tokenizer.pre_tokenize_str
        special = sorted((t.content for t in tokenizer.get_added_tokens_decoder().values()), key=len, reverse=True)
        self._special = re.compile("(" + "|".join(map(re.escape, special)) + ")") if special else None
        self._names = set(special)
        # whether the pre-tokenizer is the byte-level one with its own pattern
        self._plain = all(self._part(a) == PARTS.findall(a) for a in SAMPLES)

    def _part(self, text: str) -> list[str]:
        return [text[a:b] for _, (a, b) in self._cut(text)]

    @staticmethod
    def _units(text: str) -> list[str]:
        if ODD.search(text):
            return [BARE + unit for unit in CUT.split(text)]
        if not ODD_LINE.search(text):
            text = text.replace("\n", " \n")
        units = text.split(" ")
        units[0] = BARE + units[0]
        return units

    def units(self, text: bytes) -> list[str]:
        whole = text.decode()
        if self._special is None or not self._special.search(whole):
            return self._units(whole) if whole else []
        parts = [part for part in self._special.split(whole) if part]
        return [unit for part in parts for unit in ([BARE + part] if part in self._names else self._units(part))]

    def pieces(self, unit: str) -> tuple[bytes, ...]:
        if unit.startswith("\n"):  # no other unit does: a space before a line feed is odd
            return (b"\n", *self.pieces(BARE + unit[1:]))
        text = unit[1:] if unit.startswith(BARE) else " " + unit
        if text in self._names:
            return (text.encode(),)
        if self._plain and PLAIN.fullmatch(text):
            return tuple([part.encode() for part in PARTS.findall(text)])
        return tuple(text[a:b].encode() for _, (a, b) in self._cut(text))


def lengths(pieces: DataFrame, file: str) -> DataFrame:
    """piece, n, tokens: the number of tokens of each distinct pre-token."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark gives a task one core
        tokenizer = Tokenizer.from_file(file)
        tokenizer.no_truncation(), tokenizer.no_padding()
        for batch in batches:
            for at in range(0, batch.num_rows, ENCODED):
                part = batch.slice(at, ENCODED)
                texts = [piece.decode() for piece in part.column("piece").to_pylist()]
                sizes = [len(found) for found in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
                yield pa.record_batch([part.column("piece"), part.column("n"), pa.array(sizes, pa.int64())], names=["piece", "n", "tokens"])

    return pieces.select("piece", "n").mapInArrow(count, "piece binary, n long, tokens long")


def count_tokens(docs: DataFrame, file: str, limit: int = LIMIT) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit, one row per row of `docs`; null and empty texts have no bytes and no tokens.

    `file` is a byte-level tokenizer for the tokenizers library, at the same path on every machine. Special strings inside
    a text are one token each, as by default there. Null ids, repeated rows and other columns change nothing; an
    empty table gives an empty result. A text of any length is one row of one task.
    """
    bag = partial(PreTokens, file)
    pieces = stage(lengths(counted(docs, bag, F.lit(True)), file), "token-pieces")
    columns = {"doc_id": F.col("doc_id"), "n_bytes": F.coalesce(F.octet_length("text"), F.lit(0)).cast("long")}
    total = summed(docs, bag, pieces, ["tokens"], columns)
    tokens = F.col("tokens").cast("long")
    return total.select("doc_id", "n_bytes", tokens.alias("n_tokens"), (tokens > limit).alias("over_limit"))
