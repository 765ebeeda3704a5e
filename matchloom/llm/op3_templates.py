"""Main text of web pages by removal of site templates.

A first pass hashes every element subtree of a page (its tags and text). Spark counts, by host, on how many pages of
different content a subtree stands: copies of a page count once, so an article that a host serves at many addresses is no
template. Subtrees on `PAGES` such pages and the share `SHARE` of the host's or more are its template. So is a block that isn't
running text and has at most half of its page's text, on log2(pages of the host) such pages. A second pass deletes
them, and the elements that say what they are (menus, footers, forms, scripts, adverts, comments and so on, by tag, role or
a whole class or id), and returns what is left of the article; of a page without an `article` or `main` element, of its body.

What stands in an article is the page's own text, however often it recurs on the host, unless its tag, role or class says otherwise. A
class takes no element away that is or holds an article, but those in an article itself, nor one that has more than half of the page's
text, but reader comments. If nothing is left of a page, classes don't count, then forms don't either.

A host's templates are sent to all tasks if there are `TOLD` or fewer in all; beyond, pages are joined with theirs.

Text is decoded, white space inside a block becomes one space, and blocks are joined by a line break. Both passes read a
page's tags once, in order, without recursion.

Cases: a null or empty page, or one without text, has the empty text; a null URL has the empty host; a null id stays null;
repeated rows give a row each; a host of few pages has no template and is left to the tags; other columns are not read; an
empty table gives no rows.
"""

import re
from collections.abc import Callable, Iterator
from html import unescape
from urllib.parse import urlsplit

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchloom.llm.shared import small_batches, text_of
from matchloom.session import staged

PAGES, SHARE = 3, 0.05
#: Template subtrees of all hosts that are broadcast at most: 8 bytes each and the names of their hosts.
TOLD = 500_000

#: HTML's element names by what they are here.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style title textarea xmp iframe noembed noframes noscript template".split())
NOISE = set("script style title noscript template iframe svg math canvas object nav footer aside form button select textarea input dialog menu head".split())
PROSE = set("p h1 h2 h3 h4 h5 h6 blockquote pre figcaption dd dt li td th caption".split())
BLOCKS = PROSE | set(
    "address article aside body center details dialog dir div dl fieldset figure footer form header hgroup hr html legend main menu nav ol optgroup "
    "option section summary table tbody tfoot thead tr ul".split()
)
#: Start tags that end an open element of these names.
ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
#: Where the search for an element to end stops.
SCOPE = {"table", "ul", "ol", "dl", "select", "article", "main", "section", "aside", "nav", "body", "html"}
ROLES = set("navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar toolbar".split())
#: A class or id, as a whole, that names a part which isn't the article.
SAYS = re.compile(
    r"(?:ads?|advert\w*|sponsor\w*|promo\w*|banners?|cookies?|consent|gdpr|notices?|pop-?up|modal|overlay|newsletter|subscri\w+|side-?bar|"
    r"widgets?|menu|nav|navbar|navigation|breadcrumbs?|pagination|pager|share|sharing|social|related|recommend\w*|comments?|commentlist|respond|disqus|"
    r"footer|masthead|toolbar|login|signup|search|skip)",
    re.I,
)

#: Of these, a class that takes even most of a page's text away.
READERS = re.compile(r"comments?|commentlist|respond|disqus", re.I)

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([A-Za-z][^\s/>]*)([^>\"']*(?:\"[^\"]*\"[^>\"']*|'[^']*'[^>\"']*)*>|[^>]*(?:>|\Z))",
    re.S,
)
ATTRIBUTE = re.compile(r"([A-Za-z-]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")


def host_of(url: str) -> str:
    try:
        return (urlsplit(url).hostname or "").lower()
    except ValueError:
        return ""


class Open:
    """An element whose end hasn't come: where its text begins, and what its subtree's hash is made of."""

    __slots__ = ("tag", "start", "said", "noise", "named", "readers", "inside", "nested", "holds", "text", "size")

    def __init__(self, tag: str, start: int, noise: bool, named: bool = False, readers: bool = False, inside: bool = False, nested: bool = False):
        self.tag, self.start, self.noise, self.named, self.readers = tag, start, noise, named, readers  # named: noise by its class or id
        self.inside, self.nested = inside, nested  # in an article or main element; in an article
        self.said: list[str] = []
        self.holds = self.text = False  # an article; any text
        self.size = 0  # characters of text that isn't noise


class Page:
    """What one reading of a page finds.

    `drop` tells whether a subtree hash is to be deleted; `classes` and `forms`, whether they take elements away.
    """

    def __init__(self, html: str, drop: Callable[[int], bool] = lambda h: False, classes: bool = True, forms: bool = True):
        self.classes, self.forms = classes, forms
        self.noted: list[tuple[int, int, int]] = []  # stretches of `out` that go for a class if they aren't most of the page
        self.open: dict[str, int] = {}  # elements on the stack by tag
        self.out: list[str | None] = []  # text, None between blocks
        self.roots: list[tuple[int, int]] = []  # stretches of `out` in articles
        self.main: list[tuple[int, int]] = []
        self.subtrees: set[int] = set()
        self.parts: set[int] = set()  # those that are blocks beside most of the page's text
        self.content, self.body = 0, 0  # hash of the articles, of all text
        self.drop = drop
        self.stack = [Open("html", 0, False)]
        self.size = 0
        self._candidates: list[tuple[int, bool, bool, int]] = []
        self._read(html)
        while self.stack:
            self._close()
        has_article = bool(self.roots or self.main)
        for h, inside, prose, size in self._candidates:
            if not (has_article and inside):
                self.subtrees.add(h)
                if not prose and 2 * size <= self.size:
                    self.parts.add(h)
        for start, end, size in self.noted:
            if 2 * size <= self.size:
                self.out[start:end] = [None] * (end - start)
        self.evidence = self.content or self.body

    def _read(self, html: str) -> None:
        at = 0
        while True:
            found = TOKEN.search(html, at)
            self._text(html[at : found.start()] if found else html[at:])
            if not found:
                return
            at = found.end()
            if not found[2]:
                continue
            tag = found[2].lower()
            if found[1]:
                self._end(tag)
                continue
            self._start(tag, found[3])
            if tag in RAW:
                close = re.compile(rf"</{re.escape(tag)}(?=[\s/>])", re.I).search(html, at)
                at = close.start() if close else len(html)

    def _text(self, raw: str) -> None:
        if raw:
            text = unescape(raw)
            self.out.append(text)
            words = " ".join(text.split())
            if words:
                top = self.stack[-1]
                top.said.append(words)
                top.text = True
                top.size += len(words)

    def _start(self, tag: str, rest: str) -> None:
        if tag in BLOCKS:
            self._up_to({"p"}, SCOPE | {"div", "td", "th", "li", "blockquote", "form"})
            self.out.append(None)
        if tag in ENDS:
            self._up_to(ENDS[tag], SCOPE)
        if tag in VOID:
            if tag in ("br", "hr"):
                self.out.append(" ")
            return
        top = self.stack[-1]
        inside = top.inside or top.tag in ("article", "main")
        nested = top.nested or top.tag == "article"
        named = readers = False
        noise = (tag in NOISE and (self.forms or tag != "form")) or (tag == "header" and not inside)
        if not noise and "=" in rest or "hidden" in rest:
            for name, *values in ATTRIBUTE.findall(rest.rstrip("/>")):
                value = "".join(values)
                name = name.lower()
                if self.classes and name in ("class", "id") and tag not in ("html", "body", "main"):
                    named |= any(map(SAYS.fullmatch, value.split()))
                    readers |= any(map(READERS.fullmatch, value.split()))
                noise |= name == "role" and value.lower() in ROLES and (self.forms or value.lower() != "form")
                noise |= name == "hidden" or (name == "style" and bool(re.search(r"display\s*:\s*none", value, re.I)))
        if not rest.rstrip(">").endswith("/") or tag in BLOCKS:
            self.stack.append(Open(tag, len(self.out), noise, named, readers, inside, nested))
            self.open[tag] = self.open.get(tag, 0) + 1

    def _up_to(self, names: set[str], scope: set[str]) -> None:
        """Ends the innermost element of these names unless one of the scope stands before it."""
        if not any(self.open.get(name) for name in names):
            return
        for i in range(len(self.stack) - 1, 0, -1):
            if self.stack[i].tag in names:
                while len(self.stack) > i:
                    self._close()
                return
            if self.stack[i].tag in scope:
                return

    def _end(self, tag: str) -> None:
        if tag in BLOCKS:
            self.out.append(None)
        inline = tag not in BLOCKS
        if not self.open.get(tag):
            return
        for i in range(len(self.stack) - 1, 0, -1):
            if self.stack[i].tag == tag:
                while len(self.stack) > i:
                    self._close()
                return
            if inline and self.stack[i].tag in BLOCKS:
                return  # an inline end tag ends nothing beyond its block

    def _close(self) -> None:
        e = self.stack.pop()
        if self.stack:
            self.open[e.tag] -= 1
        h = xxhash.xxh64_intdigest(f"{e.tag}\x00" + "\x01".join(e.said))
        h -= (h >> 63) << 64
        # a class takes no article away but those in an article, such as comments
        named = e.named and (e.nested or not (e.holds or e.tag in ("article", "main")))
        e.noise |= named and e.readers
        root = e.tag in ("article", "main") and not e.noise and not named
        if e.text and not root and not e.holds and e.tag not in ("html", "body", "head"):
            self._candidates.append((h, e.inside, e.tag in PROSE or e.tag not in BLOCKS, e.size))
        if e.noise or self.drop(h):
            del self.out[e.start :]
            self.roots, self.main = ([r for r in x if r[1] <= e.start] for x in (self.roots, self.main))
            self.noted = [x for x in self.noted if x[1] <= e.start]
        elif named:
            self.noted.append((e.start, len(self.out), e.size))
        elif root:
            kept = self.roots if e.tag == "article" else self.main
            kept[:] = [r for r in kept if r[0] < e.start]
            kept.append((e.start, len(self.out)))
            self.content ^= h
        if e.tag in BLOCKS:
            self.out.append(None)
        if not self.stack:
            self.body, self.size = h, e.size
            return
        parent = self.stack[-1]
        parent.said.append(f"\x02{h}")
        parent.text |= e.text
        parent.size += 0 if e.noise else e.size
        parent.holds |= e.holds or root

    def text(self) -> str:
        """The blocks of the articles, or of the whole page if it has none."""
        blocks, words = [], []
        for start, end in self.roots or self.main or [(0, len(self.out))]:
            for part in [*self.out[start:end], None]:
                if part is not None:
                    words.append(part)
                elif words:
                    block = " ".join("".join(words).split())
                    words = []
                    if block:
                        blocks.append(block)
        return "\n".join(blocks)


def main_text(html: str, drop: Callable[[int], bool] = lambda h: False) -> str:
    """The text of a page; classes, then forms, count for what they say only as long as something is left."""
    return Page(html, drop).text() or Page(html, drop, classes=False).text() or Page(html, drop, classes=False, forms=False).text()


def subtrees(rows: DataFrame) -> DataFrame:
    """row, host, evidence (a hash of the page's content), hashes and parts: hashes of the subtrees that may be template. No shuffle."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pages = [Page(html) for html in batch.column(2).to_pylist()]
            hosts = [host_of(u) for u in batch.column(1).to_pylist()]
            hashes, parts = (pa.array([sorted(x) for x in xs], pa.list_(pa.int64())) for xs in ([p.subtrees - p.parts for p in pages], [p.parts for p in pages]))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(hosts), pa.array([p.evidence for p in pages], pa.int64()), hashes, parts], names=["row", "host", "evidence", "hashes", "parts"])

    return rows.select("row", "url", "html").mapInArrow(each, "row long, host string, evidence long, hashes array<long>, parts array<long>")


def templates(found: DataFrame, pages: int = PAGES, share: float = SHARE) -> DataFrame:
    """host, hash of the subtrees that recur."""
    marked = F.concat(*[F.transform(c, lambda h: F.struct(h.alias("hash"), F.lit(part).alias("part"))) for c, part in (("hashes", 0), ("parts", 1))])
    each = found.select("host", "evidence", F.explode(marked).alias("of")).groupBy("host", "evidence", "of.hash").agg(F.max("of.part").alias("part"))
    often = each.groupBy("host", "hash").agg(F.count("*").alias("n"), F.sum("part").alias("n_part")).where(F.col("n") >= pages)
    hosts = found.select("host", "evidence").distinct().groupBy("host").agg(F.count("*").alias("of"))
    return often.join(hosts, "host").where((F.col("n") >= share * F.col("of")) | (F.col("n_part") >= F.greatest(F.lit(float(pages)), F.log2("of")))).select("host", "hash")


def main_texts(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", least: int = PAGES, share: float = SHARE) -> DataFrame:
    """page_id, url, text, n_chars, n_removed (template subtrees of the host on the page) of every page.

    Of the subtrees, only hashes are shuffled. Pages are shuffled only if there are too many templates to send them to the tasks.
    """
    small_batches(pages.sparkSession)
    kind = pages.schema[id_col].dataType.simpleString()
    row = F.xxhash64(F.col(id_col), F.col(url_col), F.col(html_col))
    rows = pages.select(row.alias("row"), F.col(id_col).alias("page_id"), F.col(url_col).cast("string").alias("page_url"), text_of(url_col).alias("url"), text_of(html_col).alias("html"))
    found = staged(subtrees(rows), "subtrees")
    recurring = staged(templates(found, least, share), "templates")

    def texts(batch: pa.RecordBatch, drops: list[set[int]]) -> pa.RecordBatch:
        out, removed = [], []
        for html, drop in zip(batch.column(2).to_pylist(), drops, strict=True):
            page = Page(html, drop.__contains__)
            out.append(page.text() or main_text(html, drop.__contains__))
            removed.append(len(drop & (page.subtrees | page.parts)))
        counts = [pa.array(x, pa.int64()) for x in ([len(t) for t in out], removed)]
        return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.string()), *counts], names=["page_id", "url", "text", "n_chars", "n_removed"])

    schema = f"page_id {kind}, url string, text string, n_chars long, n_removed long"
    if is_small(recurring, TOLD):
        told = recurring.sort("host").toArrow()
        of_host: dict[str, list[int]] = {}
        for host, h in zip(told.column(0).to_pylist(), told.column(1).to_pylist(), strict=True):
            of_host.setdefault(host, []).append(h)
        shared = pages.sparkSession.sparkContext.broadcast({host: np.array(x) for host, x in of_host.items()})

        def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sets: dict[str, set[int]] = {}
            for batch in batches:
                for host in (hosts := [host_of(u) for u in batch.column(3).to_pylist()]):
                    if host not in sets:
                        sets[host] = set(shared.value.get(host, np.empty(0)).tolist())
                yield texts(batch, [sets[host] for host in hosts])

        return rows.select("page_id", "page_url", "html", "url").mapInArrow(each, schema)
    own = found.select("row", "host", F.explode(F.concat("hashes", "parts")).alias("hash")).join(recurring, ["host", "hash"])
    own = own.groupBy("row").agg(F.collect_set("hash").alias("drop"))

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield texts(batch, [set(d or ()) for d in batch.column(3).to_pylist()])

    return rows.join(own, "row", "left").select("page_id", "page_url", "html", "drop").mapInArrow(extract, schema)


def is_small(df: DataFrame, rows: int) -> bool:
    """True if there are at most so many rows; reads no more than that."""
    return df.limit(rows + 1).count() <= rows
