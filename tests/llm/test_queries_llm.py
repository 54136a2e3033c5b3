"""Registered queries against their SQL, and against brute force where SQL cannot express them."""

import math
import re
import zlib
from collections import Counter, defaultdict

import compare
import public_tokenizers
import pyarrow.parquet as pq
import pytest
from tokenizers import Tokenizer

from changeloom.llm.oracle import ORACLE
from changeloom.llm.queries import QUERIES


@pytest.fixture(scope="module")
def texts(sf_dir):
    table = pq.read_table(f"{sf_dir}/documents.parquet", columns=["doc_id", "text"])
    return dict(zip(table["doc_id"].to_pylist(), (t or "" for t in table["text"].to_pylist())))


@pytest.mark.parametrize("name", list(ORACLE))
def test_query_equals_sql(spark, sf_dir, name):
    assert compare.differences(QUERIES[name](spark, sf_dir), compare.connect(sf_dir), ORACLE[name]) == []


def test_token_counts_equal_the_library(spark, sf_dir, texts):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    expected = {i: len(tokenizer.encode(t, add_special_tokens=False)) for i, t in texts.items()}
    rows = QUERIES["op4_count_tokens"](spark, sf_dir).collect()
    assert {r["doc_id"]: r["n_tokens"] for r in rows} == expected
    assert all(r["n_bytes"] == len(texts[r["doc_id"]].encode()) and r["over_limit"] == (r["n_tokens"] > 512) for r in rows)


def _lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def test_near_duplicates_equal_all_pairs(spark, sf_dir, texts):
    sets = {}
    for i, text in texts.items():
        words = re.findall(r"[^\x20\x09-\x0D]+", _lower(text))
        sets[i] = {tuple(words[k:k + 5]) for k in range(max(1, len(words) - 4))} if words else set()
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    holders = defaultdict(list)
    for i, shingles in sorted(sets.items()):
        common = Counter(j for s in shingles for j in holders[s])
        for j, n in common.items():
            if 100 * n >= 75 * (len(shingles) + len(sets[j]) - n):
                a, b = sorted((find(i), find(j)))
                root[b] = a
        for s in shingles:
            holders[s].append(i)
    rows = QUERIES["op7_near_duplicates"](spark, sf_dir).collect()
    assert {r["doc_id"]: r["component_id"] for r in rows} == {i: find(i) for i in sets}
    assert all(r["n_shingles"] == len(sets[r["doc_id"]]) and r["kept"] == (r["doc_id"] == r["component_id"]) for r in rows)


def test_base_scores_equal_a_count(spark, sf_dir, texts):
    bags = {i: Counter(re.findall(r"[^\x20\x09-\x0D]+", _lower(t))) + Counter({None: 1}) for i, t in texts.items()}
    counts = Counter()
    for i, bag in bags.items():
        if zlib.crc32(str(i).encode()) % 5 != 1:
            counts += bag
    total, distinct = counts.total(), len(counts)
    for row in QUERIES["op9_lattice_score"](spark, sf_dir).collect():
        bag = bags[row["doc_id"]]
        base = sum(n * math.log10((counts[w] + 0.5) / (total + 0.5 * (distinct + 1))) for w, n in bag.items())
        assert row["base_score"] == pytest.approx(base, rel=1e-9)
        assert (row["n_tokens"], row["train_tokens"]) == (bag.total(), total)
        assert row["n_known"] == sum(n for w, n in bag.items() if counts[w])
        assert row["held_out"] == (zlib.crc32(str(row["doc_id"]).encode()) % 5 == 1)
        assert row["score"] < 0
