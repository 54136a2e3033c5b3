"""Hashes of words and of runs of words, for whole texts at a time."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

#: Bytes of text that a task cuts at a time, unless one text is longer.
BYTES = 1 << 20

#: Odd multipliers, one per place in a run of words.
_PLACES = np.array([xxhash.xxh3_64_intdigest(f"place {i}") | 1 for i in range(16)], np.uint64)


def mixed(values: np.ndarray, seed: int = 0) -> np.ndarray:
    """A bijection of 64-bit numbers in which every bit of the input moves about half of the output."""
    with np.errstate(over="ignore"):
        values = (values ^ (values >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93 + 2 * seed)
        values = (values ^ (values >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        return values ^ (values >> np.uint64(32))


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


_P1, _P2, _P3, _P4, _P5 = (np.uint64(p) for p in (
    0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5))


def _turned(values: np.ndarray, by: int) -> np.ndarray:
    return (values << np.uint64(by)) | (values >> np.uint64(64 - by))


def _finished(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(33))) * _P2
    values = (values ^ (values >> np.uint64(29))) * _P3
    return values ^ (values >> np.uint64(32))


def xxhash64_numbers(values: np.ndarray, seed: int = 42) -> np.ndarray:
    """What Spark's xxhash64 makes of each 64-bit number."""
    with np.errstate(over="ignore"):
        return _finished(_turned((_P5 + np.uint64(seed + 8)) ^ (_turned(values * _P2, 31) * _P1), 27) * _P1 + _P4)


def xxhash64_words(text: bytes, starts: np.ndarray, sizes: np.ndarray, seed: int = 42) -> np.ndarray:
    """What Spark's xxhash64 makes of each word, given by its first byte and its number of bytes: XXH64 of all at once.

    Words of 32 bytes and more go to the library.
    """
    padded = text + bytes(8)
    single = np.frombuffer(padded, np.uint8)
    eight, four = (np.ndarray(len(text) + 1, kind, padded, strides=(1,)) for kind in ("<u8", "<u4"))
    with np.errstate(over="ignore"):
        out = _P5 + np.uint64(seed) + sizes.astype(np.uint64)
        left, at = sizes & 31, starts.copy()
        for _ in range(3):
            some = np.flatnonzero(left >= 8)
            out[some] = _turned(out[some] ^ (_turned(eight[at[some]] * _P2, 31) * _P1), 27) * _P1 + _P4
            left[some] -= 8
            at[some] += 8
        some = np.flatnonzero(left >= 4)
        out[some] = _turned(out[some] ^ (four[at[some]].astype(np.uint64) * _P1), 23) * _P2 + _P3
        left[some] -= 4
        at[some] += 4
        for i in range(3):
            some = np.flatnonzero(left > i)
            out[some] = _turned(out[some] ^ (single[at[some] + i] * _P5), 11) * _P1
        out = _finished(out)
    for i in np.flatnonzero(sizes >= 32).tolist():
        out[i] = xxhash.xxh64_intdigest(text[starts[i] : starts[i] + sizes[i]], seed)
    return out


def run_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    """The hash of each run of `size` words, in order; empty if there are fewer words."""
    n = len(hashes) - size + 1
    if n < 1:
        return np.empty(0, np.uint64)
    with np.errstate(over="ignore"):
        total = np.full(n, np.uint64(size))
        for i in range(size):
            total += hashes[i : i + n] * _PLACES[i]
    return mixed(total)


def signed(values: np.ndarray) -> np.ndarray:
    return values.view(np.int64)


def slices(column: pa.Array, size: int = BYTES) -> Iterator[tuple[int, int]]:
    """Where the rows of a column of strings are parted, and how many rows a part has: few bytes each, and one row at least."""
    ends = np.cumsum(pc.binary_length(column).to_numpy(zero_copy_only=False).astype(np.int64))
    start = 0
    while start < len(column):
        before = ends[start - 1] if start else 0
        end = max(int(np.searchsorted(ends, before + size, "right")), start + 1)
        yield start, end - start
        start = end


class Table:
    """The places of 64-bit numbers that are spread evenly, such as hashes: their first bits tell where to look."""

    def __init__(self, keys: np.ndarray):
        self.order = np.argsort(keys)
        self.keys = keys[self.order]
        bits = max(len(keys), 1).bit_length() + 1
        self.shift = np.uint64(64 - bits)
        self.first = np.concatenate([[0], np.cumsum(np.bincount((self.keys >> self.shift).astype(np.int64), minlength=1 << bits))]).astype(np.int32)

    def find(self, wanted: np.ndarray) -> np.ndarray:
        """Which key each number is, or -1."""
        places = np.full(len(wanted), -1)
        start = (wanted >> self.shift).astype(np.int64)
        at, end = self.first[start], self.first[start + 1]
        left = np.flatnonzero(at < end)
        at, end, wanted = at[left], end[left], wanted[left]
        while len(left):
            same = self.keys[at] == wanted
            places[left[same]] = self.order[at[same]]
            more = np.flatnonzero(~same & (at + 1 < end))
            left, at, end, wanted = left[more], at[more] + 1, end[more], wanted[more]
        return places
