"""Operators on small tables: nulls, empty and very long texts, ties and repeated rows, empty tables, clashing names."""

import hashlib
import math
import re
from collections import Counter
from itertools import combinations

import numpy as np
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from changeloom.llm import bags, components, contamination, exact, lines, lm, mixing, near, pages, pii, tables, tokens, toxicity

BPE = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
LONG = "word and more words of a long text " * 20_000
PROSE = "the quick brown fox jumps over the lazy dog and runs into the deep dark forest near the old river bank"
ROWS = [(3, PROSE), (1, PROSE.replace(" ", "\t\n ")), (2, ""), (4, None), (None, PROSE), (5, LONG), (5, LONG), (6, "one\x00 two", None),
        (7, "a<|endoftext|>b  c"), (None, None, None)]


def by_id(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture
def empty(documents):
    return documents(ROWS).filter("doc_id > 100")


def test_exact_dedup(documents, empty):
    rows = exact.dedup(documents(ROWS)).collect()
    assert len(rows) == len(ROWS)
    of = {(r["doc_id"], r["text_sha256"]): r for r in rows}
    prose = hashlib.sha256(PROSE.encode()).hexdigest()
    assert of[3, prose]["keep_id"] == of[1, prose]["keep_id"] == of[None, prose]["keep_id"] == 1
    assert [of[i, prose]["kept"] for i in (1, 3, None)] == [True, False, False] and of[1, prose]["group_size"] == 3
    nothing = hashlib.sha256(b"").hexdigest()
    assert {r["keep_id"] for r in rows if r["text_sha256"] == nothing} == {2}
    assert sum(r["kept"] for r in rows if r["doc_id"] == 5) == 2
    assert exact.dedup(empty).count() == 0


def test_exact_dedup_with_colliding_keys_and_small_buckets(documents):
    docs = documents([(i, f"text {i % 40}") for i in range(200)])
    expected = by_id(exact.dedup(docs))
    assert by_id(exact.dedup(docs, F.length("plain").cast("long"))) == expected
    assert by_id(exact.dedup(docs, bucket_keys=2, cell_bits=6)) == expected
    index = exact.chains(docs, F.length("plain").cast("long"), 2, 6)
    assert index.filter("link > 1").count() == 38  # two keys, so all but the first text of each is chained
    keys = docs.select(F.xxhash64("text").alias("key")).distinct()
    cells = exact.directory(keys, 3, 8).join(keys.withColumn("cell", F.shiftrightunsigned("key", 56)), "cell")
    assert cells.groupBy("bucket").count().filter("count > 3").count() == 0
    assert cells.filter("depth = 0").count() == 0 and cells.count() == 40


def test_mixing_reaches_the_targets(documents, empty):
    docs = documents([(i, "w " * (1 + i % 7), f"s{i % 3}" if i % 11 else None) for i in range(900)] + [(None, None, "s0"), (900, "", "tiny"), (901, "x", "tiny")])
    rows = mixing.mix(docs).collect()
    assert len(rows) == 903 and by_id(mixing.mix(docs)) == sorted(map(tuple, rows), key=repr)
    total = sum(r["size"] for r in rows)
    targets = {(r["source_size"], r["target"]) for r in rows}
    assert sum(t for _, t in targets) == pytest.approx(total)
    for size, target in targets:
        taken = sum(r["taken"] for r in rows if r["source_size"] == size)
        assert abs(taken - target) <= 7 and target <= 3 * size
    assert all(r["taken"] <= 3 * r["size"] and (r["size"] == 0 or r["taken"] % r["size"] == 0) for r in rows)
    assert mixing.mix(empty).count() == 0
    assert mixing.mix(documents([(1, None), (2, "")])).count() == 2


def test_running_sums_are_global(spark):
    df = spark.range(1000).selectExpr("id", "(id * 37) % 1000 AS at", "id % 5 AS v")
    rows = tables.running_sums(df, ["at"], {"total": "v"}, "test").orderBy("at").collect()
    assert [r["total"] for r in rows] == list(np.cumsum([r["v"] for r in rows]))


def test_personal_data(documents, empty):
    text = ("mail a@b.c+d@e.f ip 1.2.3.4 999.1.1.1 card 4111 1111 1111 1111 no 4111 1111 1111 1112 tel +1 (555) 123-4567 "
            "call 555-123-4567 iban GB82 WEST 1234 5698 7654 32 XYZ iban GB82 WEST 1234 5698 7654 33 ж 1.1.1.1")
    docs = documents([(1, text), (2, None), (3, ""), (None, "9" * 50_000), (4, "a@b.c " * 3000), (4, "a@" + "a." * 30_000 + "a")])
    rows = pii.report(pii.find(docs)).collect()
    first = next(r for r in rows if r["doc_id"] == 1)
    plain = [(kind, m.start(), m.end()) for kind, pattern in [
        ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), ("ip", r"(?<!999)(?<![0-9])[0-9]+(\.[0-9]+){3}")]
        for m in re.finditer(pattern, text) if not m[0].startswith("999")]
    spans = first["spans"].split(",")
    assert {f"{k}:{a}:{b}" for k, a, b in plain} <= set(spans)
    assert (first["n_email"], first["n_ip"], first["n_card"], first["n_phone"]) == (2, 2, 1, 1)
    at = text.index("GB82")
    assert [s for s in spans if s.startswith("iban")] == [f"iban:{at}:{at + 27}"]
    assert any(s.startswith("local_phone") for s in spans)
    base = ",".join(s for s in spans if s.split(":")[0] in pii.BASE)
    assert first["base_sha256"] == hashlib.sha256(base.encode()).hexdigest()
    assert sorted(r["n_email"] for r in rows) == [0, 0, 0, 1, 2, 3000]
    assert {r["spans"] for r in rows if r["doc_id"] in (2, 3, None)} == {""}
    scored = pii.find(documents([(1, "call +1 555 123 4567"), (2, "order +1 555 123 4567")])).orderBy("doc_id").collect()
    assert scored[0]["spans"][0]["score"] > scored[1]["spans"][0]["score"]
    assert pii.find(empty).count() == 0


def test_token_counts(documents, empty):
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_file(BPE)
    texts = [r[1] or "" for r in ROWS] + ["  two  spaces\n\n\tand more x　 中文 字 'll don't ١٢ \r\n", "<|endoftext|>", "a <|endoftext|> b"]
    docs = documents([(i, t) for i, t in enumerate(texts)] + [(None, None)])
    rows = tokens.count_tokens(docs, BPE).collect()
    assert sorted((r["doc_id"], r["n_tokens"]) for r in rows if r["doc_id"] is not None) == [
        (i, len(tokenizer.encode(t, add_special_tokens=False))) for i, t in enumerate(texts)]
    assert [tuple(r)[1:] for r in rows if r["doc_id"] is None] == [(0, 0, False)]
    assert tokens.count_tokens(empty, BPE).count() == 0


def test_sums_do_not_depend_on_the_head(documents):
    docs = documents([(i, " ".join(f"w{j % (i + 3)}" for j in range(50))) for i in range(40)])
    values = tables.stage(bags.counted(docs, lm.Words, F.lit(True)).withColumn("v", F.length("piece").cast("double")), "test")
    columns = {"doc_id": F.col("doc_id")}
    results = [by_id(bags.summed(docs, lm.Words, values, ["v"], columns, head=h)) for h in (0, 5, 1000)]
    assert results[0] == results[1] == results[2] and len(results[0]) == 40


def test_sums_do_not_depend_on_what_a_task_remembers(documents, monkeypatch):
    """Units are numbered and summed some texts at a time; what was learnt is forgotten between them."""
    docs = documents([(i, " ".join(f"w{j % (i + 3)}" for j in range(50))) for i in range(40)] + [(40, None), (41, "")])
    values = tables.stage(bags.counted(docs, lm.Words, F.lit(True)).withColumn("v", F.length("piece").cast("double")), "test")
    expected = by_id(bags.summed(docs, lm.Words, values, ["v"], {"doc_id": F.col("doc_id")}, head=5))
    monkeypatch.setattr(bags, "UNITS", 60)
    monkeypatch.setattr(bags, "REMEMBERED", 4)
    assert by_id(bags.summed(docs, lm.Words, values, ["v"], {"doc_id": F.col("doc_id")}, head=5)) == expected


def test_lattice_sums_over_all_segmentations():
    import sentencepiece
    model = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    log_p = np.log(np.random.default_rng(1).dirichlet(np.ones(model.get_piece_size())))
    lattice = lm.Lattice(PIECES, log_p)
    ids = {model.id_to_piece(i): i for i in range(model.get_piece_size())}

    def brute(text):
        if not text:
            return 1.0
        spelled = math.exp(sum(log_p[ids[f"<0x{b:02X}>"]] for b in text[0].encode())) * brute(text[1:])
        return spelled + sum(math.exp(log_p[ids[text[:n]]]) * brute(text[n:]) for n in range(1, len(text) + 1) if text[:n] in ids)

    words = ["the", "under", "étude", "中x", "", "then", "a", "😀b", "the"]
    scores = lattice.log_probabilities([word.encode() for word in words])
    assert scores == pytest.approx([math.log(brute("▁" + word)) for word in words])
    long = [b"ab" * 3000, b"x" * 20, b"\xff\xfe"]
    assert lattice.log_probabilities(long + [b"of"]) == pytest.approx([lattice.log_probabilities([w])[0] for w in [*long, b"of"]])
    assert lattice.log_probabilities([]).size == 0


def test_language_model(documents, empty):
    rows = lm.score(documents(ROWS), PIECES).collect()
    assert len(rows) == len(ROWS) and len({r["train_tokens"] for r in rows}) == 1
    assert all(r["n_tokens"] >= 1 and r["score"] < 0 and r["base_score"] < 0 for r in rows)
    assert [r["n_tokens"] for r in rows if r["doc_id"] in (2, 4)] == [1, 1]
    assert lm.score(empty, PIECES).count() == 0


def test_near_duplicates(documents, empty):
    words = PROSE.split() * 3 + [f"w{i}" for i in range(60)]
    edited = words[:-1] + ["other"]
    docs = documents([(9, " ".join(words)), (8, " ".join(edited).upper()), (7, " ".join(words)), (6, "two words"), (5, "TWO  words"), (4, "two word"),
                      (3, None), (2, ""), (None, " ".join(words)), (10, LONG), (11, LONG + " end")])
    rows = {r["doc_id"]: r for r in near.near_duplicates(docs).collect()}
    assert {i: r["component_id"] for i, r in rows.items()} == {9: 7, 8: 7, 7: 7, 6: 5, 5: 5, 4: 4, 3: 3, 2: 2, None: 7, 10: 10, 11: 10}
    assert rows[6]["n_shingles"] == 1 and rows[2]["n_shingles"] == 0 and not rows[None]["kept"]
    assert sorted(r["doc_id"] for r in near.dedup(docs).collect()) == [2, 3, 4, 5, 7, 10]
    assert near.near_duplicates(empty).count() == 0


def test_near_duplicates_of_a_large_group_equal_all_pairs(documents):
    rng = np.random.default_rng(5)
    base = [f"w{i}" for i in range(120)]
    texts = []
    for i in range(150):
        words = list(base)
        for at in rng.choice(120, rng.integers(0, 6), replace=False):
            words[at] = f"x{i}_{at}"
        texts.append(" ".join(words))
    sets = [{tuple(t.split()[k:k + 5]) for k in range(116)} for t in texts]
    root = list(range(150))
    for a, b in combinations(range(150), 2):
        if 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]) and root[a] != root[b]:
            root = [min(root[a], root[b]) if r in (root[a], root[b]) else r for r in root]
    rows = near.near_duplicates(documents(list(enumerate(texts)))).collect()
    assert {r["doc_id"]: r["component_id"] for r in rows} == dict(enumerate(root))


def test_registers_merge_and_estimate():
    rng = np.random.default_rng(2)
    a, b = rng.integers(0, 2**63, 70_000).astype(np.uint64), rng.integers(0, 2**63, 300).astype(np.uint64)
    whole, left, right, none = near.registers([np.concatenate([a, b]), a, b, a[:0]])
    assert (whole == np.maximum(left, right)).all() and not none.any()
    n = 400
    similar, apart = near.registers([b, np.concatenate([b[:280], a[:20]]), ])[0:2], near.registers([b, np.concatenate([b[:100], a[:200]])])
    for (x, y), stays in ((similar, True), (apart, False)):
        assert near.plausible(np.array([(x > y).sum()]), np.array([(x < y).sum()]), np.array([300.0]), np.array([300.0]))[0] == stays
    assert n


def _lines_by_hand(texts):
    """Components of lines by all pairs, with the SimHash counted bit by bit."""
    nodes = {}
    for doc, text in texts:
        for place, line in enumerate((text or "").split("\n") if text is not None else []):
            words = re.sub(r"[\W_]+", " ", line.lower()).strip().split(" ")
            if len(words) >= lines.MIN_WORDS:
                nodes.setdefault(tuple(words), []).append((doc, place))

    def simhash(words):
        longer = [w for w in words if len(w) >= lines.LONG_WORD]
        hashes = [xxhash.xxh64_intdigest(w.encode(), 42) for w in (longer if len(longer) >= lines.MIN_WORDS else words)]
        signed = [h - (1 << 64) if h >> 63 else h for h in hashes]
        out = []
        for g in range(3):
            group = [h for h, s in zip(hashes, signed) if (s >> 40) % 3 == g]
            out += [2 * sum(h >> i & 1 for h in group) > len(group) for i in range(21)]
        return out

    def distance(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            last, row[0] = row[0], i
            for j, y in enumerate(b, 1):
                last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
        return row[-1]

    keys = list(nodes)
    hashes = [simhash(k) for k in keys]
    root = list(range(len(keys)))
    for a, b in combinations(range(len(keys)), 2):
        n = max(len(keys[a]), len(keys[b]))
        if sum(x != y for x, y in zip(hashes[a], hashes[b])) <= lines.DISTANCE and distance(keys[a], keys[b]) <= math.floor((1 - lines.SIMILARITY) * n + 1e-9):
            root = [min(root[a], root[b]) if r in (root[a], root[b]) else r for r in root]
    gone = set()
    for r in set(root):
        places = sorted(p for k, x in zip(keys, root) if x == r for p in nodes[k])
        gone |= set(places[1:])
    return gone


def test_line_dedup_equals_all_pairs(documents):
    rng = np.random.default_rng(3)
    vocabulary = [f"word{i}" if i % 3 else f"w{i}" for i in range(400)]
    base = [[str(w) for w in rng.choice(vocabulary, 40)] for _ in range(12)]
    texts = []
    for i in range(40):
        text = []
        for _ in range(3):
            line = list(base[rng.integers(0, 12)])
            for at in rng.choice(40, rng.integers(0, 3), replace=False):
                line[at] = str(rng.choice(vocabulary))
            text.append(" ".join(line) + ".")
        texts.append((i, "\n".join([*text, "Yes.", ""])))
    texts.append((40, " ".join(str(w) for w in rng.choice(vocabulary, 2000))))
    gone = _lines_by_hand(texts)
    assert len(gone) > 20
    rows = lines.dedup(documents(texts)).collect()
    for row in rows:
        kept = [line for place, line in enumerate(dict(texts)[row["doc_id"]].split("\n")) if (row["doc_id"], place) not in gone]
        assert row["text"] == "\n".join(kept), row["doc_id"]
        assert row["n_removed"] == row["n_lines"] - len(kept)


def test_line_dedup_finds_lines_with_as_many_edits_as_are_allowed(documents):
    rng = np.random.default_rng(11)
    vocabulary = [f"word{i}" if i % 3 else f"w{i}" for i in range(3000)]
    texts = []
    for i, n in enumerate([*range(7, 37), *range(40, 130, 5)]):
        line = [str(w) for w in rng.choice(vocabulary, n)]
        edited = list(line)
        for at in rng.choice(n, max(1, math.floor((1 - lines.SIMILARITY) * n + 1e-9)), replace=False):
            edited[at] = f"replaced{i}x{at}"
        texts += [(2 * i, " ".join(line)), (2 * i + 1, " ".join(edited))]
    texts += [(900, "one two three four five six"), (901, "one two three four five and six"), (902, "one two three four five seven")]
    removed = {r["doc_id"]: r["n_removed"] for r in lines.dedup(documents(texts)).collect()}
    assert removed == {i: i % 2 for i, _ in texts}


def test_connect_tries_every_possible_pair_of_shared_blocks(spark):
    rng = np.random.default_rng(8)
    rows = sorted({(int(k), int(n)) for n in range(120) for k in rng.choice(12, 4)})
    held = {n: {k for k, m in rows if m == n} for n in range(120)}
    linked = {(a, b) for a, b in combinations(range(120), 2) if held[a] & held[b] and (a * 7 + b * 13) % 61 == 0}
    confirmed = spark.createDataFrame(sorted(linked), "a long, b long")
    found, _ = components.connect(spark.createDataFrame(rows, "key long, node long"), "true", ["node"], lambda p: p.join(confirmed, ["a", "b"]), "test")
    root = list(range(120))
    for a, b in linked:
        root = [min(root[a], root[b]) if r in (root[a], root[b]) else r for r in root]
    assert {r["node"]: r["component"] for r in found.collect()} == {n: r for n, r in enumerate(root) if root.count(r) > 1}


def test_sketches_count_the_bits_of_all_words_of_a_line(spark, documents):
    rng = np.random.default_rng(6)
    texts = [(n, "Ab, " + " ".join(f"w{i}" for i in rng.integers(0, 90, n)) + "!\nno node") for n in (6, 7, 33, 254, 255, 3000)]
    docs = documents([*texts, texts[0]]).select("doc_id", "text")
    nodes = docs.distinct().select(F.col("doc_id").alias("node"), *tables.document_keys(), F.lit(0).alias("place"))
    rows = {r["node"]: r for r in lines.sketches(nodes, docs).collect()}
    assert len(rows) == len(texts)
    for n, text in texts:
        words = re.findall(r"\w+", text.split("\n")[0].lower())
        hashes = [xxhash.xxh64_intdigest(w, 42) for w in words]
        assert rows[n]["simhash"] == sum(1 << i for i in range(63) if 2 * sum(h >> i & 1 for h in hashes) > len(words))
        for part in range(lines.PARITIES):
            odd = 0
            for h in hashes:
                odd ^= (1 << (h & 63)) * ((h >> 6) % lines.PARITIES == part)
            assert rows[n][f"parity{part}"] % 2**64 == odd
        assert len(rows[n]["letters"]) == len(words)


def test_lines_that_share_a_phrase_are_not_paired(documents, monkeypatch):
    rng = np.random.default_rng(5)
    vocabulary = [f"word{i}" if i % 3 else f"w{i}" for i in range(2000)]
    phrase = "seven longer words that stand everywhere together"
    texts = [(i, " ".join([*rng.choice(vocabulary, 20), phrase, *rng.choice(vocabulary, 20)])) for i in range(300)]
    texts += [(300, texts[0][1] + " more"), (301, texts[1][1])]
    tried, similar = [], lines.similar
    monkeypatch.setattr(lines, "similar", lambda pairs, *more: tried.append(pairs.count()) or similar(pairs, *more))
    removed = {r["doc_id"]: r["n_removed"] for r in lines.dedup(documents(texts)).collect()}
    assert removed == {i: int(i >= 300) for i, _ in texts}
    assert sum(tried) < 30  # of 45,000 pairs that share a run


def test_line_dedup_edges(documents, empty):
    line = "this is one line of text that stands twice"
    docs = documents([(2, f"{line}\nshort\nshort"), (1, f"{line.upper()}!\n"), (3, None), (4, ""), (None, line), (5, LONG), (6, LONG), (7, line), (7, line)])
    rows = by_id(lines.dedup(docs).select("doc_id", "text", "n_lines", "n_removed"))
    assert rows == sorted([(2, "short\nshort", 3, 1), (1, f"{line.upper()}!\n", 2, 0), (3, None, 0, 0), (4, "", 1, 0), (None, "", 1, 1), (5, LONG, 1, 0), (6, "", 1, 1),
                           (7, "", 1, 1), (7, "", 1, 1)], key=repr)
    assert lines.dedup(docs).columns == [*docs.columns, "n_lines", "n_removed"]
    assert lines.dedup(empty).count() == 0


def test_contamination_edges(spark, documents, empty):
    items = spark.createDataFrame([(1, PROSE, "x"), (2, "Short item"), (3, ""), (4, None), (None, "null item words"), (5, PROSE)] and
                                  [(1, PROSE), (2, "Short item"), (3, ""), (4, None), (None, "null item words"), (5, PROSE)], "item_id int, text string")
    docs = documents([(1, "x " * 50 + PROSE + " y"), (2, "a SHORT, item here"), (3, None), (4, ""), (5, "null item words"), (None, PROSE.upper()), (6, LONG), (6, LONG),
                      (7, " ".join(PROSE.split()[3:13])), (8, " ".join(PROSE.split()[3:12]))])
    rows = contamination.decontaminate(docs, items).collect()
    found = {r["doc_id"]: (r["n_words"], r["n_hit"], r["n_items"], r["contaminated"]) for r in rows}
    n = len(PROSE.split())
    assert found == {1: (51 + n, n, 2, True), 2: (4, 2, 1, True), 3: (0, 0, 0, False), 4: (0, 0, 0, False), 5: (3, 3, 0, True), None: (n, n, 2, True),
                     6: (len(LONG.split()), 0, 0, False), 7: (10, 10, 2, True), 8: (9, 0, 0, False)}
    assert next(r for r in rows if r["doc_id"] == 1)["items_sha256"] == hashlib.sha256(b"1,5").hexdigest()
    assert sorted(r["doc_id"] for r in contamination.clean(docs, items).collect()) == [3, 4, 6, 6, 8]
    assert contamination.decontaminate(empty, items).count() == 0
    assert contamination.decontaminate(docs, items.filter("item_id > 9")).filter("contaminated").count() == 0


PAGE = """<!DOCTYPE html><html><head><title>T</title><script>var t="</p><p>no</p>";</script></head><body><header>Site</header>
<nav><ul><li><a href="/a">Menu</a></li></ul></nav><div class="ad">Buy</div>{main}<div id="comments"><p>Reader</p></div>
<form><p>Name</p></form><footer>&copy; x</footer></body></html>"""


def test_main_text(spark):
    article = "<article><h1>Head &amp; more</h1><p><b>One\n  two<br>three.<br><p>Four &lt;b&gt;</b><aside>Side</aside><p class=ad>Ad</p><!-- no --></article>"
    plain = "<div class=text><p>Alpha {i}</p>Tail {i}</div><div class=box><p>Same on all</p></div>"
    rows = [(1, "http://a.com/1", PAGE.format(main=article)), (2, None, None), (3, "x", ""), (None, "http://[bad", "<p>cut <b>off"),
            (4, "http://a.com/2", PAGE.format(main=article)), (4, "http://a.com/2", "<article><p>" + "word " * 100_000)]
    rows += [(10 + i, f"http://b.com/{i}", PAGE.format(main=plain.format(i=i))) for i in range(12)]
    pages_df = spark.createDataFrame(rows, "page_id int, url string, html string").selectExpr("*", "'x' AS row", "'x' AS host", "'x' AS text")
    found = {(r["page_id"], r["n_chars"]): r["text"] for r in pages.main_text(pages_df).collect()}
    first = "Head & more\nOne two three.\nFour <b>"
    assert found[1, len(first)] == found[4, len(first)] == first
    assert found[2, 0] == found[3, 0] == "" and found[None, 7] == "cut off"
    assert found[4, 499_999] == ("word " * 100_000).strip()
    assert {t for (i, _), t in found.items() if i is not None and i >= 10} == {f"Alpha {i}\nTail {i}" for i in range(12)}
    assert pages.main_text(pages_df.filter("page_id > 99")).count() == 0


def test_main_text_deletes_templates_inside_articles(spark):
    box = "<section><p>Written by the same hand</p></section>"
    rows = [(i, f"http://a.com/{i}", f"<body><article><p>Story {i}</p>{box}<p>Quoted by all</p></article><p>Seen {i}</p></body>") for i in range(6)]
    rows += [(10, "http://b.com/1", "<article><p>Other</p><p>Quoted by all</p></article>")]
    rows += [(20 + i, f"http://c.com/{i}", f"<main><article><p>Mirror</p><p>of one text</p></article><p>Next {i}</p></main>") for i in range(6)]
    rows += [(30 + i, f"http://d.com/{i}", f"<article>{box.replace('hand', 'pen')}</article><p>All of page {i}</p>" if i else
              f"<article><p>Long</p>{box.replace('hand', 'pen')}</article>") for i in range(6)]
    rows += [(40 + i, f"http://d.com/x{i}", f"<article><p>More {i}</p>{box.replace('hand', 'pen')}</article>") for i in range(3)]
    found = {r["page_id"]: r["text"] for r in pages.main_text(spark.createDataFrame(rows, "page_id int, url string, html string")).collect()}
    assert {found[i] for i in range(6)} == {f"Story {i}\nQuoted by all" for i in range(6)} and found[10] == "Other\nQuoted by all"
    assert {found[20 + i] for i in range(6)} == {f"Mirror\nof one text\nNext {i}" for i in range(6)}
    assert found[30] == "Long" and {found[30 + i] for i in range(1, 6)} == {f"All of page {i}" for i in range(1, 6)}
    assert {found[40 + i] for i in range(3)} == {f"More {i}" for i in range(3)}


def test_names_of_layouts_do_not_drop_the_text(spark):
    layouts = ["layout with-sidebar", "no-sidebar", "col-main has-nav", "post overflow-hidden", "post comments-open",
               "post category-social-media tag-search", "two-col side-by-side", "page--sidebar", "left-sidebar"]
    menus = ["ad", "AD-slot", "x site-footer", "sidebar", "comments-list", "main-nav", "layout__sidebar", "sidebar--open", "share-buttons", "is-hidden"]
    rows = [(i, f"http://a.com/{i}", f"<div class='{name}'><article><p>Text {i} of the page</p></article></div><p>Other</p>") for i, name in enumerate(layouts)]
    rows += [(20 + i, f"http://a.com/p{i}", f"<div class='{name}'><p>Text {20 + i} of the page</p></div>") for i, name in enumerate(layouts[:-1])]
    rows += [(40 + i, f"http://b.com/{i}", f"<p>Body {i}</p><div class='{name}'><p>Not text</p></div>") for i, name in enumerate(menus)]
    rows += [(60, "http://c.com", "<article>Text</article><div class=comments><article>A longer comment</article></div>"),
             (61, "http://c.com", "<p>Text of a page without a mark</p><div class=comments><article>Comment</article></div>")]
    found = {r["page_id"]: r["text"] for r in pages.main_text(spark.createDataFrame(rows, "page_id int, url string, html string")).collect()}
    assert [found[i] for i in range(9)] == [f"Text {i} of the page" for i in range(9)]
    assert [found[20 + i] for i in range(8)] == [f"Text {20 + i} of the page" for i in range(8)]
    assert [found[40 + i] for i in range(len(menus))] == [f"Body {i}" for i in range(len(menus))]
    assert (found[60], found[61]) == ("Text", "Text of a page without a mark")


def test_toxicity_learns_from_training_rows_only(spark, documents, empty):
    rng = np.random.default_rng(4)
    clean = [f"plain{i}" for i in range(300)]
    texts, marks = [], []
    for i in range(600):
        words = [str(w) for w in rng.choice(clean, 40)]
        toxic = i % 5 == 0
        if toxic:
            for at in rng.choice(40, 3, replace=False):
                words[at] = str(rng.choice(["vileword", "nastyterm", "slurstem" + str(rng.integers(0, 9))]))
        texts.append((i, " ".join(words)))
        marks.append((i, 1, int(toxic)))
    labels = spark.createDataFrame(marks + [(None, 1, 1), (700, 1, None)], "doc_id long, quality int, toxic int")
    docs = documents([*texts, (None, None), (800, ""), (801, LONG)])
    rows = toxicity.score(docs, labels).collect()
    assert len(rows) == 603 and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7) for r in rows)
    wrong = [r["doc_id"] for r in rows if r["held_out"] and r["doc_id"] is not None and r["doc_id"] < 600 and r["predicted"] != (r["doc_id"] % 5 == 0)]
    assert len(wrong) <= 2
    # labels of held-out rows change nothing
    flipped = labels.withColumn("toxic", F.when(toxicity.held_out(), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    assert by_id(toxicity.score(docs, flipped)) == sorted(map(tuple, rows), key=repr)
    kept = toxicity.reject(docs, labels)
    assert kept.columns == docs.columns and kept.count() == sum(not r["predicted"] for r in rows)
    assert {r["score"] for r in toxicity.score(docs, labels.filter("toxic = 0")).collect()} == {0.0}
    assert toxicity.score(empty, labels).count() == 0


def test_toxicity_sample_is_bounded_in_rows(spark, documents):
    labels = spark.createDataFrame([(i, 1, i % 2) for i in range(60)], "doc_id long, quality int, toxic int")
    docs = documents([(i, f"text {i}") for i in range(60)] + [(i % 60, f"text {i} again") for i in range(600)])
    assert toxicity.sample(docs, labels, 10).count() == 10


def test_toxicity_learns_from_few_labels(spark, documents):
    rng = np.random.default_rng(9)
    words = [[str(w) for w in rng.choice([f"plain{i}" for i in range(80)], 30)] for _ in range(60)]
    docs = documents([(i, " ".join([*w[:28], "vileword", "vileword"] if i % 6 == 0 else w)) for i, w in enumerate(words)])
    labels = spark.createDataFrame([(i, 1, int(i % 6 == 0)) for i in range(60)], "doc_id long, quality int, toxic int")
    rows = toxicity.score(docs, labels).collect()
    assert min(r["score"] for r in rows if r["doc_id"] % 6 == 0) > max(r["score"] for r in rows if r["doc_id"] % 6)


def test_label_model_weighs_correlated_voters_once():
    rng = np.random.default_rng(6)
    truth = rng.random(4000) < 0.3
    good = np.where(rng.random(4000) < 0.9, truth, ~truth)
    bad = np.where(rng.random(4000) < 0.6, truth, ~truth)
    votes = np.column_stack([good, *[bad] * 6]).astype(float)
    given = np.where(rng.random(4000) < 0.98, truth, ~truth).astype(int)
    posterior = toxicity.label_model(votes, given)
    assert ((posterior > 0.5) == truth).mean() > 0.97


def test_pipeline_stages(spark, tmp_path, documents):
    base = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{base}/documents.parquet")
    columns = docs.columns
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "line_dedup", "near_dedup", "decontamination", "mix_sources"]
    before = {r["doc_id"] for r in docs.select("doc_id").collect()}
    for name, apply in corpus_pipeline.STAGES[:-1]:
        docs = tables.stage(apply(spark, docs, base), "test")
        after = {r["doc_id"] for r in docs.select("doc_id").collect()}
        assert docs.columns == columns and after <= before
        before = after
    n = docs.count()
    assert corpus_pipeline.run(spark, base).count() == n


def test_parity_maps_bound_the_difference():
    rng = np.random.default_rng(8)
    for size, change in ((150, 20), (150, 90), (4000, 900)):
        a = np.unique(rng.integers(0, 2**63, size).astype(np.uint64))
        b = np.union1d(a[change:], rng.integers(0, 2**63, change // 2).astype(np.uint64))
        differing = sum(int(x).bit_count() for x in (near.parity(a) ^ near.parity(b)).view(np.uint64))
        assert 0 < differing <= len(np.setxor1d(a, b))


def test_only_lines_that_parities_allow_stay_in_blocks(documents):
    rng = np.random.default_rng(12)
    vocabulary = [f"word{i}" if i % 3 else f"w{i}" for i in range(3000)]
    phrase = "seven longer words that stand everywhere together"
    texts = [(i, " ".join([*rng.choice(vocabulary, 20), phrase, *rng.choice(vocabulary, 20)])) for i in range(100)]
    texts += [(100, texts[0][1] + " more"), (101, texts[1][1].replace(phrase, "another phrase"))]
    found = lines.occurrences(documents(texts)).cache()
    rows = found.collect()
    odd = {}
    for i, text in texts:
        odd[i] = 0
        for word in text.split():
            odd[i] ^= 1 << (xxhash.xxh64_intdigest(word, 42) & 63)
    assert {r["doc_id"]: r["parity"] % 2**64 for r in rows} == odd
    words = {r["doc_id"]: r["words"] for r in rows}
    alike = set()
    for x, y in combinations(rows, 2):
        a, b = x["doc_id"], y["doc_id"]
        edits = math.floor((1 - lines.SIMILARITY) * max(words[a], words[b]) + 1e-9)
        if min(words[a], words[b]) >= lines.SIMILARITY * max(words[a], words[b]) and (odd[a] ^ odd[b]).bit_count() + abs(words[a] - words[b]) <= 2 * edits:
            alike |= {(key, i) for key in set(x["runs"]) & set(y["runs"]) for i in (a, b)}
    names = {r["k1"]: r["doc_id"] for r in rows}
    blocked = [(r["key"], names[r["k1"]]) for r in lines.blocks(found).collect()]
    assert sorted(blocked) == sorted(alike)
    assert {0, 1, 100, 101} <= {i for _, i in blocked} and len({i for _, i in blocked}) < 12  # nearly all others share the phrase only
