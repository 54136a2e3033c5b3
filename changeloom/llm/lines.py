"""Line dedup: fuzzy lines by SimHash.

Lines are normalised, and equal ones are one node. A node's SimHash has 63 bits, each the majority of one bit of the hashes
of all its words. Nodes whose words have the edit similarity may differ in up to DISTANCE of them, which is too many for
blocks of bits to stay alone. So the pigeonhole is taken over runs of three words: an edit touches three runs at most, so
that of the 3 d + 1 first runs in any fixed order one stays after d edits. Nodes that share one of them and lie within the
distance are candidates, unless the parities of their words show that they need more edits, and the edit similarity of
their words confirms them. Only lines that share a run with a line to which parities allow them to be similar get a SimHash.
Of each connected group of lines one occurrence stays.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changeloom.llm.components import connect, sharing
from changeloom.llm.tables import document_keys, likely, parted, stage

#: Lines of fewer words are left alone: they recur by chance.
MIN_WORDS = 5
#: Share of words that must stay as they are, and differing bits of a candidate pair. At that share a bit differs with a
#: probability of about 0.18: 11 of 63 on average, with a deviation of 3; lines without a common word differ in 31.
SIMILARITY = 0.85
DISTANCE = 24
#: Words of a run. Runs with more long words come first: they are rarer than those of the short words of a language.
RUN = 3
LONG_WORD = 5
#: Runs of a line that are looked up, at most. That is all that the edits allow up to 33 words; of a longer line with as
#: many edits as are allowed, one run among them stays but for less than one case in a thousand.
RUNS = 16
#: Numbers of 64 bits of parity of a line, a power of two. Where they differ in more bits than the edits allow, no pair is made.
PARITIES = 4
#: Words that have a bit are counted for eight bits in one number, a byte each; so many words of a line keep the highest byte
#: from overflowing. Such counts add up for two bits in one number, in halves of it: a line has fewer words than a half can count.
_TOGETHER = 127
_BYTES = [f"bytes{i}" for i in range(8)]
_HALF = 32
_COUNTS = [f"count{i}" for i in range(_HALF)]


def _bytes() -> list[Column]:
    """How many of at most _TOGETHER hashes h have each of 63 bits: bits i, i + 8 and so on in the bytes of one number."""
    return [F.expr(f"sum(shiftright(h, {i}) & {int('01' * 8, 16)}L)").alias(c) for i, c in enumerate(_BYTES)]


def _counts() -> list[Column]:
    """The counts of _bytes added up, each of 63 bits: bits i and i + 32 side by side."""
    def count(bit: int) -> str:
        return f"shiftright({_BYTES[bit % 8]}, {bit // 8 * 8}) & 255"

    upper = [f" + shiftleft({count(i + _HALF)}, {_HALF})" if i + _HALF < 63 else "" for i in range(_HALF)]
    return [F.expr(f"sum(({count(i)}){upper[i]})").alias(c) for i, c in enumerate(_COUNTS)]


def _simhash() -> str:
    """63 bits, each whether more than half of the `n` words have it."""
    low = [f"IF(2 * (count{i} & {(1 << _HALF) - 1}L) > n, shiftleft(1L, {i}), 0L)" for i in range(_HALF)]
    high = [f"IF(2 * shiftright(count{i}, {_HALF}) > n, shiftleft(1L, {i + _HALF}), 0L)" for i in range(63 - _HALF)]
    return " | ".join(low + high)


def _word_hashes(words: str) -> str:
    """59 bits of hash per word, and two bits above them that count it where it is short; three such numbers add up."""
    return f"transform({words}, w -> (xxhash64(w) & {(1 << 59) - 1}L) + IF(length(w) < {LONG_WORD}, {1 << 61}L, 0L))"


def _runs(hashes: str) -> str:
    """The first runs of words by number of long words and hash: as many as the edits that a similar line may have ask for.

    A run is its words in any order: their sum. A similar line has no more words than n / SIMILARITY. Lines that allow no
    edit have no runs.
    """
    edits = f"cast(floor({1 - SIMILARITY:.6f}D * floor(size({hashes}) / {SIMILARITY}D + 1e-9D) + 1e-9D) AS int)"
    sums = f"transform({hashes}, (h, i) -> h + " + " + ".join(f"get({hashes}, i + {j})" for j in range(1, RUN)) + ")"
    whole = f"slice({sums}, 1, size({hashes}) - {RUN - 1})"
    runs = f"sort_array(array_distinct(transform({whole}, s -> (s & {3 << 61}L) | shiftrightunsigned(xxhash64(s), 3))))"
    return f"CASE WHEN {edits} > 0 THEN slice({runs}, 1, least({RUN} * {edits} + 1, {RUNS})) ELSE array() END"


def _parities(hashes: str) -> str:
    """64 bits, each whether an odd number of the hashes falls on it: what the parts of _parity give together."""
    return f"aggregate({hashes}, 0L, (bits, h) -> bits ^ shiftleft(1L, cast(h & 63 AS int)))"


def _parity(part: int) -> Column:
    """64 bits, each whether an odd number of hashes h of a group falls on it; one falls on one bit of one of the PARITIES parts."""
    return F.expr(f"bit_xor(IF((shiftright(h, 6) & {PARITIES - 1}) = {part}, shiftleft(1L, cast(h & 63 AS int)), 0L))").alias(f"parity{part}")


def normalised(line: Column) -> Column:
    """Lower case, with letters and digits only, and one space between words."""
    return F.trim(F.regexp_replace(F.lower(line), r"[^\p{L}\p{N}]+", " "))


def _letters(words: str) -> str:
    """A string with one character per word, so that the edit distance of two such strings is that of the words."""
    return f"decode(unhex(array_join(transform({words}, w -> hex(19968 + pmod(xxhash64(w), 20000))), '')), 'UTF-16BE')"


def occurrences(docs: DataFrame) -> DataFrame:
    """_doc, _doc2, doc_id, place, k1, k2 (hashes of the line), words (their number), parity, runs, one row per line."""
    lines = docs.select(
        *document_keys(), "doc_id", F.posexplode(F.split("text", "\n")).alias("place", "line"))
    plain = lines.withColumn("plain", normalised(F.col("line"))).drop("line")
    hashed = plain.select(
        "_doc", "_doc2", "doc_id", "place", F.xxhash64("plain").alias("k1"), F.xxhash64("plain", F.lit(1)).alias("k2"),
        F.split("plain", " ").alias("all")).withColumn("hashes", F.expr(_word_hashes("all")))
    return hashed.select("_doc", "_doc2", "doc_id", "place", "k1", "k2", F.size("all").alias("words"), F.expr(_parities("hashes")).alias("parity"), F.expr(_runs("hashes")).alias("runs"))


def _alike(apart: str) -> str:
    """That lines x and y may be similar: `apart` counts bits of parity that differ, for all words or more finely.

    An edit takes away one word at most and brings one. So neither line has more words of its own than edits, and a word
    moves one bit of parity: twice the edits is at least the bits that differ and the difference in length.
    """
    return (f"least(x.words, y.words) >= {SIMILARITY}D * greatest(x.words, y.words) - 1e-9D AND "
            f"{apart} + abs(x.words - y.words) <= 2 * floor({1 - SIMILARITY:.6f}D * greatest(x.words, y.words) + 1e-9D)")


def blocks(found: DataFrame) -> DataFrame:
    """key, k1, k2, words: the lines that share a run with a line to which words and parity allow them to be similar."""
    each = found.select(F.explode("runs").alias("key"), F.col("k1").alias("node"), "k2", "words", "parity")
    shared = stage(sharing(each, "lines-shared").withColumnRenamed("node", "k1"), "lines-sharing")
    other = (F.expr("x.key = y.key AND (x.k1 <> y.k1 OR x.k2 <> y.k2)")) & F.expr(_alike("bit_count(x.parity ^ y.parity)"))
    # the first such line is enough: in a group of similar lines few are looked at
    return shared.alias("x").join(shared.alias("y"), other, "left_semi").select("key", "k1", "k2", "words")


def sketches(nodes: DataFrame, docs: DataFrame) -> DataFrame:
    """node, simhash, parity0 and so on, letters: what tells whether nodes (node, _doc, _doc2, place) are similar."""
    places = ["_doc", "_doc2", "place"]
    lines = docs.select(*document_keys(), F.posexplode(F.split("text", "\n")).alias("place", "line"))
    # repeated documents have the line of a node more than once
    needed = likely(lines, nodes, *places).join(nodes, places).dropDuplicates(places)
    cut = needed.select(*places, "node", F.split(normalised(F.col("line")), " ").alias("all"))
    # the words of a line are where the line is: neither the sums nor the join move them
    words = cut.select(*places, "node", F.posexplode("all").alias("at", "word")).select(
        *places, "node", F.expr(f"at DIV {_TOGETHER}").alias("some"), F.xxhash64("word").alias("h"))
    some = words.groupBy(*places, "node", "some").agg(F.count(F.lit(1)).alias("n"), *_bytes(), *(_parity(i) for i in range(PARITIES)))
    summed = some.groupBy(*places, "node").agg(
        F.sum("n").alias("n"), *_counts(), *(F.bit_xor(f"parity{i}").alias(f"parity{i}") for i in range(PARITIES)))
    # the node is taken from here, so that both sides read the same columns and the lines move once
    letters = cut.select(*places, "node", F.expr(_letters("all")).alias("letters"))
    return summed.withColumn("simhash", F.expr(_simhash())).drop("node").join(letters, places).select(
        "node", "simhash", *(f"parity{i}" for i in range(PARITIES)), "letters")


def similar(pairs: DataFrame, sketched: DataFrame) -> DataFrame:
    """The pairs (a, b) of nodes whose words have the edit similarity."""
    both = pairs
    for side in "ab":
        both = both.join(sketched.select(F.col("node").alias(side), F.col("letters").alias(f"l_{side}")), side)
    limit = f"cast(floor({1 - SIMILARITY:.6f}D * greatest(length(l_a), length(l_b)) + 1e-9D) AS int)"
    return both.filter(f"levenshtein(l_a, l_b, {limit}) >= 0").select("a", "b")


def removals(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """_doc, _doc2, places: the lines of each document that go."""
    found = stage(occurrences(docs), "lines-found").filter(F.col("words") >= min_words)
    blocked = stage(blocks(found), "lines-blocks")
    # the first occurrence: smallest id, null ids last, then the first line; the keys stand for documents that share an id
    first = F.min(F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "_doc", "_doc2", "place")).alias("first")
    groups = found.groupBy("k1", "k2").agg(first, F.count(F.lit(1)).alias("n"))
    wanted = blocked.select("k1", "k2").distinct().withColumn("wanted", F.lit(True))
    nodes = stage(groups.join(wanted, ["k1", "k2"], "left").filter("n > 1 OR wanted").select(
        F.monotonically_increasing_id().alias("node"), "*"), "lines-nodes")
    sketched = stage(sketches(nodes.filter("wanted").select("node", "first._doc", "first._doc2", "first.place"), docs.select("doc_id", "text")), "lines-sketches")
    apart = " + ".join(f"bit_count(x.parity{i} ^ y.parity{i})" for i in range(PARITIES))
    close = f"{_alike(apart)} AND bit_count(x.simhash ^ y.simhash) <= {DISTANCE}"
    members = blocked.join(nodes.select("node", "k1", "k2"), ["k1", "k2"]).join(sketched.drop("letters"), "node").drop("k1", "k2")
    linked, _ = connect(members, close, ["node"], lambda pairs: similar(pairs, sketched), "lines")
    grouped = nodes.join(linked, "node", "left").withColumn("component", F.coalesce("component", "node"))
    keepers = grouped.groupBy("component").agg(F.min("first").alias("keeper"), F.sum("n").alias("total")).filter("total > 1")
    lost = stage(grouped.join(keepers.select("component", "keeper"), "component").select("k1", "k2", "keeper"), "lines-lost")
    # copies of a line are dealt by their key: a common one is the skewed side of the join
    copies = likely(found.drop("runs"), lost, "k1", "k2").join(lost, ["k1", "k2"])
    gone = copies.filter("_doc <> keeper._doc OR _doc2 <> keeper._doc2 OR place <> keeper.place")
    return gone.groupBy("_doc", "_doc2").agg(F.collect_set("place").alias("places"))  # places of one text


def dedup(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """`docs` with new texts, and n_lines and n_removed, one row per row: of each group of similar lines one is left.

    The line that stays is in the document with the smallest id, the first there. Lines are what line feeds part; those
    of fewer than `min_words` words are left alone. A null text stays null; a text all of whose lines go is empty. A null
    id is larger than any other. Rows that share both id and text are one document: they get the same result. Columns
    keep their names and order, except that n_lines and n_removed are new; an empty table gives an empty result. Lines
    of any length are read whole.
    """
    names = [c for c in docs.columns if c not in ("n_lines", "n_removed")]
    gone = stage(removals(docs, min_words), "lines-removals")
    touched, others = parted(docs.select(*(F.col(f"`{c}`") for c in names)), gone)
    joined = touched.join(gone.withColumnRenamed("places", "_places"), ["_doc", "_doc2"], "left")
    kept = F.expr("CASE WHEN _places IS NULL THEN text ELSE array_join(filter(transform(split(text, '\\n'), (l, i) -> "
                  "CASE WHEN NOT array_contains(_places, i) THEN l END), l -> l IS NOT NULL), '\\n') END")
    lines = F.when(F.col("text").isNull(), 0).otherwise(F.size(F.split("text", "\n"))).cast("long").alias("n_lines")
    removed = F.coalesce(F.size("_places"), F.lit(0)).cast("long").alias("n_removed")
    plain = [F.col(f"`{c}`") for c in names]
    changed = joined.select(*(kept.alias("text") if c == "text" else F.col(f"`{c}`") for c in names), lines, removed)
    return changed.union(others.select(*plain, lines, F.lit(0).cast("long").alias("n_removed")))
