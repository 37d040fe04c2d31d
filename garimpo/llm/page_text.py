"""Main text of web pages by the style trees of their sites.

Every page becomes a tree of elements.  Trees of one host are merged: a node is an
element path, and holds how often each sequence of children (presentation) and
each text (content) occurs there.  Nodes that look and read the same on most
pages of the host carry little information and go, with all below them.  Elements that are
furniture by their tag, role or class go on every page.
"""

from __future__ import annotations

import hashlib
import html
import re
import zlib
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import written

#: Tags, roles and name words of HTML with a fixed meaning.
FURNITURE = set(
    "head title nav footer aside form button select option textarea input label script style noscript template iframe "
    "object embed svg canvas dialog menu audio video map frameset".split()
)
ROLES = set("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
NAMES = set(
    "nav navbar navigation menu header masthead footer sidebar aside ad ads advert adverts advertisement advertising "
    "banner sponsor sponsored promo promotion cookie cookies consent notice notices alert popup modal overlay newsletter "
    "subscribe signup login search breadcrumb breadcrumbs pagination pager share sharing social related recommended "
    "widget comment comments commentlist disqus reply replies respond".split()
)
#: Compound names with a fixed meaning; what other compounds hold, the style tree decides.
FORMS = re.compile(
    r"(?:site|main|top|bottom|left|right|primary|secondary|global)[-_]+"
    r"(?:nav|navbar|navigation|menu|header|masthead|footer|sidebar|banner|breadcrumbs?)"
    r"|(?:cookie|cookies)[-_]+(?:banner|notice|consent|popup)"
)
#: Compounds for reader comments and adverts, which are furniture within an article, too.
ASIDES = re.compile(
    r"(?:post|article|page|reader|readers|user|blog|entry|facebook)[-_]+(?:comments?|replies)"
    r"|(?:comments?|replies)[-_]+(?:section|area|list|block|wrapper|container|thread|box|form|wrap)"
    r"|(?:ads?|adverts?|advertisement|sponsor|sponsored|promo)[-_]+(?:block|slot|unit|box|banner|container|wrapper|area|wrap|label|links?)"
    r"|(?:google|top|bottom|side|inline|article|page|banner)[-_]+(?:ads?|adverts?|promo)"
)
#: What may stand in a head; any other element ends it, as its end tag is optional.
IN_HEAD = set("title meta link base basefont bgsound style script noscript noframes template".split())
#: Elements of running text, and the names that are no furniture within an article.
PROSE = set("p h1 h2 h3 h4 h5 h6 blockquote pre li dt dd td th figure figcaption caption".split())
OWN = {"header"}
INLINE = set(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd mark q ruby rb rp rt s samp small span "
    "strike strong sub sup time tt u var wbr".split()
)
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = "script|style|textarea|title|noscript|iframe|xmp|noembed|noframes"
#: A start tag of the key closes an open element of the value.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
          "th": {"td", "th"}, "option": {"option"}}
PIECE = re.compile(
    r"<!--.*?(?:-->|\Z)|<(?P<raw>" + RAW + r")\b(?P<rawattrs>(?:\"[^\"]*\"|'[^']*'|[^>\"'])*)>(?P<body>.*?)(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<close>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<attrs>(?:\"[^\"]*\"|'[^']*'|[^>\"'])*)>|<[!?/][^>]*>|(?P<text>[^<]+|<)",
    re.DOTALL | re.IGNORECASE,
)
ATTRIBUTE = re.compile(r"([^\s=\"'/>]+)\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")


class Element(NamedTuple):
    path: int  # checksum of the chain of names from the root
    furniture: bool
    named: bool  # furniture only by a name outside any article
    article: bool
    parent: int
    head: bool
    style: list[str]


class Page:
    """Elements and text blocks (element index, text) of one page, in page order.

    Unclosed elements end with their parents; a block element ends an open p.
    """

    def __init__(self, source: str):
        self.elements = [Element(0, False, False, False, -1, False, [])]
        self.blocks: list[tuple[int, str]] = []
        self.held: list[str] = []
        self.names, self.open = [""], [0]
        self.owner = 0
        for m in PIECE.finditer(source):
            if m["text"]:
                if self.names[-1] == "head" and not m["text"].isspace():
                    self.shut(len(self.names) - 1)
                self.held.append(m["text"])
            elif m["raw"]:
                if m["raw"].lower() == "textarea" or m["raw"].lower() == "title":
                    self.enter(m["raw"].lower(), m["rawattrs"])
                    self.held.append(m["body"])
                    self.leave(m["raw"].lower())
            elif m["tag"]:
                tag = m["tag"].lower()
                if m["close"]:
                    self.leave(tag)
                else:
                    self.enter(tag, m["attrs"])
        self.flush()

    def flush(self) -> None:
        if self.held:
            text = " ".join(html.unescape("".join(self.held)).split())
            if text:
                self.blocks.append((self.owner, text))
            self.held = []

    def shut(self, depth: int) -> None:
        if any(name not in INLINE for name in self.names[depth:]):
            self.flush()
        del self.names[depth:], self.open[depth:]
        self.settle()

    def settle(self) -> None:
        """The element that the coming text belongs to: the nearest block, or furniture within it."""
        k = len(self.open) - 1
        while k and self.names[k] in INLINE and not self.elements[self.open[k]].furniture:
            k -= 1
        self.owner = self.open[k]

    def enter(self, tag: str, attributes: str) -> None:
        if "head" in self.names and tag not in IN_HEAD:
            self.shut(self.names.index("head"))
        if tag in ("br", "wbr", "hr", "img"):
            self.held.append(" " if tag != "wbr" else "")
            if tag == "hr":
                self.flush()
            return
        if tag not in INLINE:
            if "p" in self.names:
                self.shut(len(self.names) - 1 - self.names[::-1].index("p"))
            closes = CLOSES.get(tag, ())
            for k in range(len(self.names) - 1, 0, -1):
                if self.names[k] in closes:
                    self.shut(k)
                    break
                if self.names[k] in ("ul", "ol", "dl", "table", "div", "article", "section"):
                    break
            self.flush()
        found = {a.lower(): b or c or d for a, b, c, d in ATTRIBUTE.findall(attributes)} if attributes.strip(" /") else {}
        named = f"{found.get('class', '')} {found.get('id', '')}"
        parent = self.elements[self.open[-1]]
        article = parent.article or tag in ("article", "main")
        words = {w.lower() for w in named.split()}
        # An article is not hidden by the names around it; within one, names hide no running text.
        inherited = parent.furniture and not (parent.named and tag in ("article", "main"))
        fixed = (
            tag in FURNITURE or (tag == "header" and not article)
            or found.get("role", "").lower() in ROLES or "hidden" in found or found.get("aria-hidden") == "true"
        )
        called = tag not in ("html", "body", "main", "article") and (
            tag not in PROSE and (bool(words & (NAMES - OWN)) or any(map(ASIDES.fullmatch, words)))
            if article
            else any(w in NAMES or FORMS.fullmatch(w) or ASIDES.fullmatch(w) for w in words)
        )
        furniture = inherited or fixed or called
        # Below a name, an element that is furniture by itself hides its articles too.
        by_name = furniture and not fixed and not article and (parent.named or not parent.furniture)
        label = f"{tag}.{' '.join(sorted(named.split()))}"
        parent.style.append(label)
        changed = (furniture, by_name) != (parent.furniture, parent.named)
        if tag in VOID:
            return
        if tag in INLINE and not changed:
            place = self.open[-1]
        else:
            if changed:
                self.flush()
            self.elements.append(
                Element(zlib.crc32(label.encode(), parent.path), furniture, by_name, article, self.open[-1], parent.head or tag == "head", [])
            )
            place = len(self.elements) - 1
        self.names.append(tag)
        self.open.append(place)
        self.settle()

    def leave(self, tag: str) -> None:
        if tag in self.names[1:]:
            depth = len(self.names) - 1 - self.names[::-1].index(tag)
            inner, outer = self.elements[self.open[depth]], self.elements[self.open[depth - 1]]
            if (inner.furniture, inner.named) != (outer.furniture, outer.named):
                self.flush()
            self.shut(depth)

    def main_text(self, dull: set[int]) -> str:
        """Blocks outside furniture and outside the host's dull paths."""
        gone: list[bool] = []
        for e in self.elements:
            above = e.parent >= 0 and gone[e.parent]
            # A dull node hides no article below it, but within one dull nodes go as well.
            starts = e.article and not self.elements[e.parent].article
            gone.append(e.furniture or (not starts and (above or e.path in dull)))
        return "\n\n".join(text for owner, text in self.blocks if not gone[owner])


def _host() -> Column:
    return F.coalesce(F.lower(F.regexp_extract("url", r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/@]*@)?([^/:?#]+)", 1)), F.lit(""))


def dull_paths(pages: DataFrame, least: float = 0.2, pages_needed: int = 8) -> DataFrame:
    """host and paths (array) of style-tree nodes of low importance.

    The importance of a node is the entropy of its children's sequences or of its
    texts, whichever is larger, over the logarithm of its occurrences: 0 if all are
    equal, 1 if all differ.  Pages of a host with equal bodies (elements and texts outside
    the head) count once.  Nodes seen fewer than ``pages_needed`` times are kept.
    """

    def distinct(batches):
        met = set()  # copies within a task go before the shuffle
        for batch in batches:
            rows = ([], [], [])
            for host, source in zip(batch.column("host").to_pylist(), batch.column("html").to_pylist()):
                page = Page(source or "")
                blocks = [(owner, text) for owner, text in page.blocks if not page.elements[owner].head]
                body = [(e.path, e.style) for e in page.elements if not e.head], [
                    (page.elements[owner].path, text) for owner, text in blocks
                ]
                digest = hashlib.md5(repr(body).encode(errors="surrogatepass")).digest()
                if (host, digest) in met:
                    continue
                met.add((host, digest))
                content = [[] for _ in page.elements]
                for owner, text in blocks:
                    while owner >= 0:
                        content[owner].append(text)
                        owner = page.elements[owner].parent
                nodes = [
                    (e.path, zlib.crc32(" ".join(e.style).encode()), zlib.crc32("\n".join(texts).encode()))
                    for e, texts in zip(page.elements, content)
                    if not e.furniture
                ]
                for column, x in zip(rows, (host, digest, np.array(nodes, dtype="<u4").tobytes())):
                    column.append(x)
            yield pa.RecordBatch.from_arrays(
                [pa.array(r, k) for r, k in zip(rows, (pa.string(), pa.binary(), pa.binary()))], ["host", "digest", "nodes"]
            )

    def nodes(batches):
        for batch in batches:
            held = [np.frombuffer(n, "<u4").reshape(-1, 3).astype(np.int64) for n in batch.column("nodes").to_pylist()]
            host = batch.column("host").take(pa.array(np.repeat(np.arange(len(held)), [len(n) for n in held])))
            all_ = np.concatenate(held or [np.empty((0, 3), np.int64)])
            for kind in (0, 1):
                yield pa.RecordBatch.from_arrays(
                    [host, pa.array(all_[:, 0]), pa.array(np.full(len(all_), kind)), pa.array(all_[:, 1 + kind])],
                    ["host", "path", "kind", "value"],
                )

    bodies = pages.select(_host().alias("host"), "html").mapInArrow(distinct, "host string, digest binary, nodes binary")
    bodies = bodies.groupBy("host", "digest").agg(F.first("nodes").alias("nodes"))
    seen = bodies.select("host", "nodes").mapInArrow(nodes, "host string, path long, kind long, value long")
    counted = seen.groupBy("host", "path", "kind", "value").agg(F.count("*").alias("n"))
    entropy = (F.log(F.sum("n")) - F.sum(F.col("n") * F.log("n")) / F.sum("n")) / F.log(F.greatest(F.sum("n"), F.lit(2)))
    varied = counted.groupBy("host", "path", "kind").agg(F.sum("n").alias("m"), entropy.alias("entropy"))
    nodes_ = varied.groupBy("host", "path").agg(F.max("m").alias("m"), F.max("entropy").alias("importance"))
    low = nodes_.where((F.col("m") >= pages_needed) & (F.col("importance") < least) & (F.col("path") != 0))
    return low.groupBy("host").agg(F.collect_list("path").alias("paths"))


def main_text(pages: DataFrame, **options) -> DataFrame:
    """page_id, url, text and n_chars (code points) of every page.

    Text is the page's blocks outside furniture, each with character references decoded
    and white space made one space, joined by blank lines; null and empty pages, and pages
    that are all furniture, give an empty text.  Pages without a host in their url share
    one style tree.  Repeated rows are pages each; other columns are ignored.
    """

    def extract(batches):
        for batch in batches:
            texts = [
                Page(source or "").main_text(set(paths or ()))
                for source, paths in zip(batch.column("html").to_pylist(), batch.column("paths").to_pylist())
            ]
            out = batch.select(["page_id", "url"]).append_column("text", pa.array(texts, pa.string()))
            yield out.append_column("n_chars", pa.array([len(t) for t in texts], pa.int64()))

    dull = written(dull_paths(pages, **options), "dull")
    # Few paths go to the pages; more of them than that are joined, where a host of many pages is split.
    few = dull.agg(F.coalesce(F.sum(F.size("paths") + 8), F.lit(0))).first()[0] <= 1_000_000
    rows = pages.select("page_id", "url", "html", _host().alias("host")).join(F.broadcast(dull) if few else dull, "host", "left")
    return rows.select("page_id", "url", "html", "paths").mapInArrow(
        extract, f"page_id {pages.schema['page_id'].dataType.simpleString()}, url string, text string, n_chars long"
    )
