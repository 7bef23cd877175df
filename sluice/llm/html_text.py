"""Main text of web pages by removing site templates.

Every element is hashed with its whole subtree (tag, class, id, texts and children), inside articles too; Spark
counts for each host in how many different bodies a hash stands at one place, and subtrees that recur there in many of
them are deleted at that place on every page.  A place is the tags above an element and its number among its parent's
elements, counted from the first or from the last.  In an article or main element, paragraphs, headings, list
items, cells and words without class or id are its own text: they stay even where they recur, and go only with a recurring
container or row around them.  Copies of an article are one body, so its
own text does not recur by being copied; copies that differ are different bodies.  What marks
itself as a menu, header, footer, sidebar, notice, advert, form, comment or script, by its tag, role, class or id, goes
as well.

A page whose articles have text left yields them, unless its main element has more text of its own than the
longest article has: then, or without such an article, it yields the main element, and without text there
what the deletions leave of its body.

Character references are decoded, white space inside a block becomes one space, and blocks are joined in page
order by a line feed; headings, paragraphs, list items, cells and line breaks bound blocks.  Unclosed elements end
where HTML ends them.  Null and empty html give an empty text.  Pages without a host have no site, so nothing recurs
for them.  Rows are independent, repeated rows included; an empty table gives an empty result."""

from __future__ import annotations

import hashlib
import html
import re
import struct

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm.scratch import Scratch
from sluice.session import ship

TAG = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
                 r"|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>", re.S)
ATTRIBUTE = re.compile(r"([a-zA-Z-]+)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+)|(\bhidden\b)")

EMPTY = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe template xmp noembed noframes".split())
#: Elements that bound a block of text.
BLOCK = frozenset("""address article aside blockquote body br caption center dd details dialog dir div dl dt fieldset figcaption
figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre section select summary
table tbody td tfoot th thead tr ul""".split())
#: A start tag ends an open paragraph when it is one of these.
ENDS_P = BLOCK - {"br", "body", "html", "caption", "option", "optgroup", "legend", "td", "th", "tr", "tbody", "thead", "tfoot"}
#: Open elements that a start tag ends, up to the element that limits the search.
ENDS = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
        "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
        "option": ({"option"}, {"select"})}
CELLS = frozenset(("td", "th"))
#: Elements that hold others; without class or id, only these count as templates within an article or main element.
CONTAINERS = BLOCK - CELLS - frozenset("blockquote br caption dd dt figcaption h1 h2 h3 h4 h5 h6 legend li option p pre summary".split())
DROPPED = frozenset("head nav footer aside form script style noscript template iframe svg button select dialog menu object canvas textarea title xmp noembed noframes".split())
ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar toolbar form".split())
#: Words of a class or id that name what is not the article.
NAMES = frozenset("""ad ads advert advertisement adverts advertising banner breadcrumb breadcrumbs comment comments consent cookie cookies
disqus login menu modal nav navbar navigation newsletter notice notification pagination popup promo promoted related replies reply
share sharing sidebar signup skip social sponsor sponsored subscribe subscription toolbar widget""".split())
#: The same, outside an article only: within one they may hold its title.
SITE_NAMES = frozenset("footer header masthead top bottom".split())


def _hash(data: bytes) -> int:
    return struct.unpack("<q", hashlib.blake2b(data, digest_size=8).digest())[0]


class _Element:
    __slots__ = ("tag", "dropped", "article", "main", "parts", "id", "path", "number", "children")

    def __init__(self, tag, dropped, article, main, parts, id, path, number):
        self.tag, self.dropped, self.article, self.main, self.parts, self.id = tag, dropped, article, main, parts, id
        self.path, self.number, self.children = path, number, []


class Page:
    """One pass over the tags of a page.  ``blocks`` are (text, outermost article or 0, in a main element, elements that
    hold its words); ``parents`` and ``hashes`` (of the subtree at its place, counted from the first and from the last) are
    those of each element, of which 0 is the page."""

    def __init__(self, source: str | None):
        self.blocks: list[tuple[str, int, bool, list[int]]] = []
        self.parents: list[int] = [0]
        self.hashes: list[tuple[int, ...]] = [()]
        self.top: list[tuple[int, int, int, int]] = []  # elements without one above them
        self.text: list[str] = []
        self.holders: list[int] = []
        self.open: list[_Element] = []
        self.places: dict[str, list[int]] = {}  # of the open elements of each tag
        source = source or ""
        at, last = 0, source.rfind(">") + 1  # no tag ends after it, and a comment that starts there holds the rest
        source = source[:last] + source[last:].split("<!--", 1)[0]
        while True:
            found = TAG.search(source, at, last)
            self._text(source[at:found.start()] if found else source[at:])
            if not found:
                break
            at = found.end()
            if found[0].startswith("<!--") and not found[0].endswith("-->"):
                break
            close, tag, attributes = found.group(1, 2, 3) if found[2] else found.group(4, 5, 6)
            if not tag:
                continue
            tag = tag.lower()
            if close:
                self._close(tag)
            else:
                self._start(tag, attributes)
                if tag in RAW and not attributes.endswith("/"):
                    end = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(source, at)
                    at = end.start() if end else len(source)
        while self.open:
            self._pop()
        self._place(self.top)
        self._flush()

    def _text(self, text: str) -> None:
        if not text:
            return
        here = self.open[-1] if self.open else None
        words = text.strip()
        if here:
            here.parts.append(words)
        if not (here and here.dropped):
            self.text.append(text)
            if words:
                self.holders.append(here.id if here else 0)

    def _flush(self) -> None:
        if self.text:
            block = " ".join(html.unescape("".join(self.text)).split())
            if block:
                here = self.open[-1] if self.open else None
                self.blocks.append((block, here.article if here else 0, bool(here and here.main), self.holders))
            self.text, self.holders = [], []

    def _start(self, tag: str, attributes: str) -> None:
        if tag in ENDS:
            ended, limit = ENDS[tag]
            self._end(ended, limit)
        if tag in ENDS_P:
            self._end({"p"}, {"button", "table", "td", "th", "caption", "object"})
        if tag in BLOCK:
            self._flush()
        if tag in EMPTY:
            return
        above = self.open[-1] if self.open else None
        number = len(self.parents)
        article = (above.article if above else 0) or (number if tag == "article" else 0)
        main = bool(above and above.main) or tag == "main"
        inside = bool(article or main)
        names, role, hidden = set(), "", False
        marks = ""
        if attributes.strip():
            for name, value, flag in ATTRIBUTE.findall(attributes):
                name = name.lower()
                if flag or (name == "aria-hidden" and "true" in value):
                    hidden = True
                elif name in ("class", "id"):
                    marks += value
                    names.update(re.split(r"[^a-z0-9]+", value.lower()))
                elif name == "role":
                    role = value.strip("\"'").lower()
        dropped = (bool(above and above.dropped) or tag in DROPPED or hidden or role in ROLES or not names.isdisjoint(NAMES)
                   or (not inside and (tag == "header" or not names.isdisjoint(SITE_NAMES)))) and tag not in ("html", "body", "article", "main")
        if above and above.dropped:
            dropped = True
        self.parents.append(above.id if above else 0)
        self.hashes.append(())
        if dropped != bool(above and above.dropped):
            self._flush()
        self.places.setdefault(tag, []).append(len(self.open))
        path = _hash(f"{above.path if above else 0}/{tag}".encode("utf-8", "surrogatepass"))
        at = len(above.children if above else self.top)
        (above.children if above else self.top).append((number, 0, 0, 0))
        self.open.append(_Element(tag, dropped, article, main, [tag, marks], number, path, at))

    def _innermost(self, tags) -> int:
        """Place among the open elements of the innermost one of ``tags``, or -1."""
        return max((self.places[t][-1] for t in tags if self.places.get(t)), default=-1)

    def _end(self, tags, limit) -> None:
        """Ends the innermost open element of ``tags``, if no element of ``limit`` is further in."""
        at = self._innermost(tags)
        if at > self._innermost(limit):
            while len(self.open) > at:
                self._pop()

    def _close(self, tag: str) -> None:
        if self.places.get(tag):
            while self._pop() != tag:
                pass
        elif tag in ("p", "br"):
            self._flush()

    def _pop(self) -> str:
        element = self.open[-1]
        above = self.open[-2] if len(self.open) > 1 else None
        if element.tag in BLOCK or element.dropped != bool(above and above.dropped):
            self._flush()
        self.open.pop()
        self.places[element.tag].pop()
        marked = bool(element.parts[1])
        digest = _hash("\x1f".join(element.parts).encode("utf-8", "surrogatepass"))
        self._place(element.children)
        element.children = []
        own_text = (element.article or element.main) and element.tag not in CONTAINERS and (element.tag in CELLS or not marked)
        if not own_text:
            (above.children if above else self.top)[element.number] = (element.id, digest, element.path, 1)
        if above:
            above.parts.append(str(digest))
        return element.tag

    def _place(self, children) -> None:
        """Hashes of the elements of one parent, whose number is known now."""
        for i, (number, digest, path, hashed) in enumerate(children):
            if hashed:
                self.hashes[number] = (_hash(struct.pack("<qqi", digest, path, i)), _hash(struct.pack("<qqi", digest, path, i - len(children))))

    def body(self) -> int:
        """Hash of the text before any deletion for recurring."""
        return _hash(self.main_text().encode("utf-8", "surrogatepass"))

    def main_text(self, recurring=frozenset()) -> str:
        gone = [False]
        for parent, own in zip(self.parents[1:], self.hashes[1:]):
            gone.append(gone[parent] or not recurring.isdisjoint(own))
        kept = [block for block in self.blocks if not all(gone[i] for i in block[3])]
        articles: dict[int, int] = {}
        own = 0
        for text, article, main, _ in kept:
            if article:
                articles[article] = articles.get(article, 0) + len(text)
            elif main:
                own += len(text)
        if articles and max(articles.values()) >= own:
            kept = [block for block in kept if block[1]]
        elif own:
            kept = [block for block in kept if block[2]]
        return "\n".join(block[0] for block in kept)


def host(url):
    found = F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), "^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/@]*@)?([^/:?#]+)", 1))
    return F.when(found != "", found)


def recurring(pages: DataFrame, min_pages: int = 5, min_share: float = 0.2) -> DataFrame:
    """(host, hashes): subtrees that stand at one place in at least ``min_pages`` different bodies of the host and in
    ``min_share`` of them.  A page has few elements, so a host has at most that many divided by the share."""
    ship(pages.sparkSession)
    scratch = Scratch(pages.sparkSession, "html-text")
    rows = pages.select(host(F.col("url")).alias("host"), F.col("html").cast("string").alias("html")).where("host IS NOT NULL")

    def batches(found):
        for batch in found:
            hosts, hashes, bodies = [], [], []
            for site, source in zip(batch["host"], batch["html"]):
                page = Page(source.as_py())
                # The null hash stands on every page, and counts the bodies of the host.
                own = {None, *(h for place in page.hashes for h in place)}
                hosts += [site.as_py()] * len(own)
                hashes += own
                bodies += [page.body()] * len(own)
            yield pa.RecordBatch.from_arrays([pa.array(hosts, pa.string()), pa.array(hashes, pa.int64()), pa.array(bodies, pa.int64())], ["host", "hash", "body"])

    counts = (rows.mapInArrow(batches, "host string, hash long, body long").distinct()
              .groupBy("host", "hash").agg(F.count("*").alias("n")).where(F.col("n") >= min_pages))
    counts = scratch.keep(counts, "counts")
    sites = counts.where("hash IS NULL").select("host", F.col("n").alias("bodies"))
    return scratch.keep(counts.where("hash IS NOT NULL").join(sites, "host").where(F.col("n") >= F.col("bodies") * min_share)
                        .groupBy("host").agg(F.collect_set("hash").alias("hashes")), "recurring")


def extract(pages: DataFrame, min_pages: int = 5, min_share: float = 0.2) -> DataFrame:
    """(page_id, url, text, n_chars) for every row; pages meet the templates of their site in a join on the host."""
    ship(pages.sparkSession)
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    sites = recurring(pages, min_pages, min_share)
    rows = rows.withColumn("host", host(F.col("url"))).join(sites, "host", "left").select("page_id", "url", "html", "hashes")

    def batches(found):
        for batch in found:
            texts = [Page(source.as_py()).main_text(frozenset(hashes.as_py() or ())) for source, hashes in zip(batch["html"], batch["hashes"])]
            yield pa.RecordBatch.from_arrays(
                [batch["page_id"], batch["url"], pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                ["page_id", "url", "text", "n_chars"])

    return rows.mapInArrow(batches, "page_id long, url string, text string, n_chars long")
