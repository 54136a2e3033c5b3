"""Main text of HTML pages, by site template removal.

Each page is parsed once into blocks of text. The subtrees of the elements around them get hashes, which Spark counts per
host; a subtree that recurs across many different pages of its host is part of the site's template, and the blocks in it
go, also inside an article that is marked as such. A mirrored article is no template: subtrees inside an article count
once per different article, and the article itself never goes. Nor is a passage in an article that other hosts have too.
What a page names as menu, advert, form and so on goes as well. If a marked article is left, it alone is the main text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser
from urllib.parse import urlsplit

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changeloom.llm.tables import KEY_BUCKETS, stage

#: A subtree is template if it is on that many different pages of its host, and on that share of them.
MIN_PAGES, MIN_SHARE = 3, 0.1

#: Elements that hold no text of their own, elements that are never main text, elements that mark the main
#: text, elements without an end, and elements whose text runs on in the block around them.
RAW = {"script", "style", "noscript", "template", "svg", "math", "object", "iframe", "head", "title", "canvas", "audio", "video"}
ASIDE = {"nav", "menu", "footer", "aside", "form", "button", "select", "textarea", "option", "label", "fieldset", "dialog"}
MAIN = {"article", "main"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "img", "ins",
          "kbd", "mark", "q", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr"}
#: Which open elements a start tag ends.
ENDED_BY = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
    "option": {"option"}, "body": {"head"},
}
#: Elements that a paragraph cannot contain, and so end it.
ENDS_P = {"address", "article", "aside", "blockquote", "div", "dl", "fieldset", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6",
          "header", "hr", "main", "menu", "nav", "ol", "p", "pre", "section", "table", "ul"}
#: Words in class, id or role that mark what is not main text: as a whole name, as its last part (what the name
#: is: site-footer), or as its first part before a word for a container (comments-list).
TELLTALE = (r"(?:ads?|advert\w*|sponsor\w*|promo\w*|banner|cookies?|consent|notice|popup|modal|overlay|sidebar|menu|nav\w*|"
            r"breadcrumbs?|footer|masthead|toolbar|share|sharing|social|comments?|replies|respond|disqus\w*|related|recommend\w*|newsletter|"
            r"subscribe|signup|login|search|pagination|pager|skip|widget|complementary|contentinfo|alert)")
HOLDER = (r"(?:container|wrapper|wrap|box|bar|lists?|links?|buttons?|icons?|items?|sections?|area|block|panel|slot|unit|posts?|articles?|"
          r"inner|form|thread|left|right|top|bottom|\d+)")
NAME = re.compile(rf"{TELLTALE}|side|hidden|(?:is|visually)[_-]hidden|(?:[^\W_]+[_-]+)+{TELLTALE}|{TELLTALE}(?:[_-]+{HOLDER})+", re.I)
#: Parts of names that tell of something else than the element itself: what it has or lacks, and what it is filed under.
OF_OTHERS = {"with", "without", "has", "have", "no", "not", "non", "hide", "show", "category", "cat", "tag", "topic", "format", "by", "overflow"}


def aside(names: str) -> bool:
    """Whether one of the names marks what is not main text. What follows two hyphens only modifies a name."""
    for name in names.split():
        plain = name.partition("--")[0] or name
        if NAME.fullmatch(plain) and OF_OTHERS.isdisjoint(re.split("[_-]+", plain.lower())):
            return True
    return False


class Block:
    """`article` is the innermost marked element around the text."""

    __slots__ = ("text", "around", "article")

    def __init__(self, text: str, around: list, article: Element | None) -> None:
        self.text, self.around, self.article = text, around, article

    def subtrees(self) -> list[tuple[int, int | None]]:
        """Hash, and hash of the marked element that it stands in, of the elements around that hold no marked one."""
        return [(e.hash, e.inside.hash if e.inside else None) for e in self.around if not e.holds]


class Element:
    """`aside` tells that its names speak against it, `inside` is the innermost marked element around it, and `holds` tells
    whether it is or has one."""

    __slots__ = ("tag", "parts", "out", "aside", "inside", "holds", "hash")

    def __init__(self, tag: str, head: str, out: bool, aside: bool, inside: Element | None, marked: bool) -> None:
        self.tag, self.parts, self.out, self.aside, self.inside, self.holds, self.hash = tag, [head], out, aside, inside, marked, None


class Page(HTMLParser):
    """Blocks of text that may be main text, each with the elements around it."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.stack = [Element("", "", False, False, None, False)]
        self.blocks: list[Block] = []
        self._words: list[str] = []

    def _flush(self) -> None:
        text = " ".join("".join(self._words).split())
        self._words.clear()
        top = self.stack[-1]
        if text and not top.out:
            self.blocks.append(Block(text, self.stack[1:], self._article()))

    def _article(self) -> Element | None:
        """The innermost open element that is marked."""
        top = self.stack[-1]
        return top if top.tag in MAIN and top.holds and not top.out else top.inside

    def _close(self) -> None:
        closed = self.stack.pop()
        closed.hash = xxhash.xxh3_64_intdigest("\x00".join(closed.parts)) - (1 << 63)
        closed.parts.clear()
        self.stack[-1].parts.append(str(closed.hash))
        self.stack[-1].holds |= closed.holds

    def _end(self, at: int) -> None:
        if any(e.tag not in INLINE for e in self.stack[at:]):
            self._flush()
        while len(self.stack) > at:
            self._close()

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag == "br":
            self._words.append(" ")
            return
        if tag not in INLINE:
            self._flush()
        ended = ENDED_BY.get(tag, set()) | ({"p"} if tag in ENDS_P else set())
        for at in range(len(self.stack) - 1, 0, -1):
            open_tag = self.stack[at].tag
            if open_tag in ended:
                self._end(at)
                break
            if open_tag not in INLINE and open_tag != "p":
                break
        if tag in VOID:
            return
        around = self.stack[-1]
        named = " ".join(v for k, v in attrs if v and k in ("class", "id", "role"))
        hidden = any(k == "hidden" or (k == "aria-hidden" and v == "true") for k, v in attrs)
        # the header of a page goes, that of an article is part of it
        header = tag == "header" and not self._article()
        out = around.out or tag in RAW or tag in ASIDE or header or hidden
        head = tag + " " + " ".join(sorted(f"{k}={v}" for k, v in attrs))
        self.stack.append(Element(tag, head, out, tag not in ("html", "body") and aside(named), self._article(), tag in MAIN and not out))

    def handle_endtag(self, tag: str) -> None:
        if tag == "p" and not any(e.tag == "p" for e in self.stack):
            self._flush()
        for at in range(len(self.stack) - 1, 0, -1):
            if self.stack[at].tag == tag:
                self._end(at)
                return

    def handle_data(self, data: str) -> None:
        self._words.append(data)
        self.stack[-1].parts.append(" ".join(data.split()))

    def finish(self) -> None:
        self.close()
        self._flush()
        self._end(1)
        self.blocks = self._named_right()

    def _named_right(self) -> list[Block]:
        """The blocks without those in elements whose names speak against them.

        Where all marked articles stand in such elements, those that hold one stay if they have more text than the rest.
        """
        free = [b for b in self.blocks if not any(e.aside for e in b.around)]
        if any(b.article for b in free):
            return free
        held = [b for b in self.blocks if all(e.holds for e in b.around if e.aside)]
        more = [b for b in held if any(e.aside for e in b.around)]
        return held if sum(len(b.text) for b in more) > sum(len(b.text) for b in free) else free


def host(url: str | None) -> str:
    try:
        return (urlsplit(url or "").hostname or "").removeprefix("www.")
    except ValueError:
        return ""


def parsed(pages: DataFrame) -> DataFrame:
    """row, page_id, url, host, body (hash of the page), blocks (text, main, subtrees around it).

    A subtree has a hash and an owner: the hash of the marked element that it stands in, or else that of the page.
    """
    subtree = pa.struct([("subtree", pa.int64()), ("owner", pa.int64())])
    block = pa.struct([("text", pa.string()), ("main", pa.bool_()), ("subtrees", pa.list_(subtree))])

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                bodies, blocks = [], []
                for html in part.column("html"):
                    page = Page()
                    page.feed(html.as_py())
                    page.finish()
                    body = xxhash.xxh3_64_intdigest(html.as_py()) - (1 << 63)
                    blocks.append([{"text": b.text, "main": b.article is not None, "subtrees": [
                        {"subtree": h, "owner": body if owner is None else owner} for h, owner in b.subtrees()]} for b in page.blocks])
                    bodies.append(body)
                hosts = [host(url.as_py()) for url in part.column("url")]
                yield pa.record_batch(
                    [part.column("row"), part.column("page_id"), part.column("url"), pa.array(hosts, pa.string()), pa.array(bodies, pa.int64()),
                     pa.array(blocks, pa.list_(block))],
                    names=["row", "page_id", "url", "host", "body", "blocks"])

    source = pages.select(F.monotonically_increasing_id().alias("row"), "page_id", F.col("url").cast("string").alias("url"),
                          F.coalesce("html", F.lit("")).alias("html"))
    return source.mapInArrow(parse, f"row long, page_id {dict(source.dtypes)['page_id']}, url string, host string, body long, "
                                    "blocks array<struct<text:string,main:boolean,subtrees:array<struct<subtree:long,owner:long>>>>")


def templates(found: DataFrame, min_pages: int = MIN_PAGES, min_share: float = MIN_SHARE) -> DataFrame:
    """host, subtree, hosts (that have it): those that recur. Pages that are the same throughout count as one, and so do
    marked articles, so that mirrors are no template."""
    around = found.select("host", F.explode("blocks.subtrees").alias("each")).select("host", F.explode("each").alias("each"))
    counts = around.select("host", "each.*").distinct().groupBy("host", "subtree").agg(F.count(F.lit(1)).alias("n"))
    counts = stage(counts, "html-subtrees")
    hosts = counts.groupBy("subtree").agg(F.count(F.lit(1)).alias("hosts"), F.max("n").alias("n")).filter(
        F.col("n") >= min_pages).drop("n")
    pages = found.select("host", "body").distinct().groupBy("host").agg(F.count(F.lit(1)).alias("pages"))
    often = counts.filter(F.col("n") >= min_pages).join(pages, "host").filter(F.col("n") >= min_share * F.col("pages"))
    return often.join(hosts, "subtree").select("host", "subtree", "hosts")


def main_text(pages: DataFrame, min_pages: int = MIN_PAGES, min_share: float = MIN_SHARE) -> DataFrame:
    """page_id, url, text, n_chars, one row per row of `pages`: blocks in page order, one line each.

    White space in a block, line breaks included, is one space. Null and empty pages have the empty text. A null or
    broken url belongs to a site without a name. Markup may be broken or cut off: what is open ends with the page.
    Null ids and repeated rows get the same result each (repeated rows count once for templates). An empty table gives
    an empty result; other columns are ignored. Pages of any length are parsed whole.
    """
    found = stage(parsed(pages), "html-blocks")
    recurring = templates(found, min_pages, min_share)
    inside = found.select("row", "host", F.posexplode("blocks").alias("place", "block")).select(
        "row", "host", "place", "block.main", F.explode("block.subtrees.subtree").alias("subtree"))
    dropped = inside.join(recurring, ["host", "subtree"]).filter("NOT main OR hosts = 1").groupBy("row").agg(
        F.collect_set("place").alias("dropped"))  # places of one page
    dropped = stage(dropped, "html-dropped")
    # a small table of buckets decides which pages need to move
    bucket = F.pmod(F.xxhash64("row"), F.lit(KEY_BUCKETS)).cast("int")
    some = F.broadcast(dropped.select(bucket.alias("bucket")).distinct())  # KEY_BUCKETS rows at most
    placed = found.withColumn("bucket", bucket)
    touched, others = placed.join(some, "bucket", "left_semi"), placed.join(some, "bucket", "left_anti")
    left = F.expr("CASE WHEN dropped IS NULL THEN blocks ELSE filter(blocks, (b, i) -> NOT array_contains(dropped, i)) END")
    blocks = touched.join(dropped, "row", "left").select("page_id", "url", left.alias("blocks")).union(
        others.select("page_id", "url", "blocks"))
    # a marked article that is left comes before all else
    best = F.expr("CASE WHEN exists(blocks, b -> b.main) THEN filter(blocks, b -> b.main) ELSE blocks END")
    text = blocks.select("page_id", "url", F.array_join(F.transform(best, lambda b: b["text"]), "\n").alias("text"))
    return text.withColumn("n_chars", F.length("text").cast("long"))
