"""Main text of web pages by removing site templates (operator 1).

Every block-level element of a page is hashed with all below it. The hashes are counted per host
over its different pages (equal pages count once); subtrees that recur on ``MIN_PAGES`` pages of a host
or more are its template and are deleted, however many pages the host has, together with what a page
itself marks as boilerplate (navigation, adverts, forms and so on, by element, role or class). The text
is that of the article or main element if there is one, else of what is left of the body.

Paragraphs, headings and lists inside the article are never a template, however often a passage
recurs on a host: only containers in it can be.

A host may hold a third of all pages: nothing is gathered by host. Counts are by host and hash, summed
before they are shuffled; a page then gets the template hashes that it has itself, by a join on host
and hash, and its list is no longer than the page. Hashes inside marked elements count, but are not
joined, as they go in any case.

Defined cases: NULL or empty html has an empty text; a page with a NULL url is of the host ""; a
repeated page gets a result each time; an empty table gives an empty result; markup that is never
closed or cut off is read as browsers do, to the end; other columns of the input are kept.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from html import unescape

import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from tidewatch.llm.common import cut, small_batches

#: A subtree is a template if so many different pages of the host have it.
MIN_PAGES = 5
#: A list or container outside an article is a menu if so much of its text is links.
LINK_SHARE = 0.8

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(script|style|noscript|template|textarea|iframe|svg|math|object|select)\b[^>]*+>"
    r".*?(?:</\1\s*>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/<>]*+)((?:[^<>\"']++|\"[^\"]*+\"|'[^']*+')*+(?=>)|[^<>]*+)>"
    r"|<[!?][^>]*+>",
    re.DOTALL | re.IGNORECASE,
)
ATTRIBUTE = re.compile(r"([a-zA-Z-]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))")
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby"
    " s samp small span strike strong sub sup time tt u var".split()
)
FLOW = frozenset(
    "p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd blockquote pre table thead tbody tfoot tr td th caption"
    " figure figcaption address header".split()
)
#: A start tag closes an open element of these, up to the nearest of the others.
CLOSED_BY = {
    "li": (frozenset(["li"]), frozenset(["ul", "ol", "menu"])),
    "dt": (frozenset(["dt", "dd"]), frozenset(["dl"])),
    "dd": (frozenset(["dt", "dd"]), frozenset(["dl"])),
    "tr": (frozenset(["tr"]), frozenset(["table"])),
    "td": (frozenset(["td", "th"]), frozenset(["tr", "table"])),
    "th": (frozenset(["td", "th"]), frozenset(["tr", "table"])),
}
PARAGRAPH = (frozenset(["p"]), frozenset(["td", "th", "table", "div", "article", "button"]))
DROPPED = frozenset("head nav aside footer form button dialog menu".split())
ROLES = frozenset(
    "navigation banner contentinfo complementary search form dialog alert menu menubar".split()
)
MARKS = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner"
    " nav navbar navigation menu breadcrumb breadcrumbs masthead footer sidebar widget cookie"
    " cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe signup"
    " login share sharing social related recommended comments comment disqus replies respond"
    " pagination pager toolbar".split()
)
HEADERS = frozenset(["header", "masthead", "banner"])
MAIN = frozenset(["article", "main"])


class Element:
    __slots__ = ("tag", "parent", "parts", "mark", "main", "links", "key")

    def __init__(self, tag: str, parent: Element | None, attributes: str) -> None:
        self.tag, self.parent = tag, parent
        self.parts: list[str | Element] = []
        self.key = 0
        self.links = (0, 0, 0)
        found = {
            m[1].lower(): m[2] or m[3] or m[4] or "" for m in ATTRIBUTE.finditer(attributes)
        } if "=" in attributes else {}
        words = re.split(r"[\s_-]+", f"{found.get('class', '')} {found.get('id', '')}".lower())
        role = found.get("role", "").lower()
        inside = parent is not None and parent.main
        self.main = inside or tag in MAIN or role == "main"
        marks = MARKS.intersection(words)
        if inside or tag in MAIN:
            marks -= HEADERS
        self.mark = (
            tag in DROPPED
            or role in ROLES
            or bool(marks)
            or (not inside and (tag == "header" or "header" in words))
            or "hidden" in attributes.lower().split()
            or found.get("aria-hidden") == "true"
            or "display:none" in found.get("style", "").replace(" ", "").lower()
        ) and tag not in ("html", "body")


def parse(html: str) -> Element:
    """The page as a tree; text is left as it stands, with its character references."""
    root = current = Element("html", None, "")
    place = 0
    open_tags: Counter[str] = Counter()

    def close(upto: frozenset, unless: frozenset) -> Element:
        # Nothing to look for above: a stray end tag costs the same however deep it stands.
        if not any(open_tags[tag] for tag in upto):
            return current
        node = current
        while node is not None and node.tag not in unless:
            if node.tag in upto:
                return leave(node)
            node = node.parent
        return current

    def leave(upto: Element) -> Element:
        """Close elements from the current one up to this one."""
        node = current
        while node is not upto:
            open_tags[node.tag] -= 1
            node = node.parent
        open_tags[upto.tag] -= 1
        return upto.parent or root

    for token in TOKEN.finditer(html):
        if token.start() > place:
            current.parts.append(html[place : token.start()])
        place = token.end()
        if token[3] is None:
            continue
        tag = token[3].lower()
        if token[2]:
            if tag not in VOID and tag not in ("html", "body"):
                current = close(frozenset([tag]), frozenset())
            continue
        if tag in ("html", "body"):
            continue
        if tag in CLOSED_BY:
            current = close(*CLOSED_BY[tag])
        elif tag not in INLINE and tag not in VOID:
            current = close(*PARAGRAPH)
        element = Element(tag, current, token[4])
        current.parts.append(element)
        if tag not in VOID and not token[4].rstrip().endswith("/"):
            current = element
            open_tags[tag] += 1
    if place < len(html):
        current.parts.append(html[place:])
    return root


def hash_subtrees(element: Element, found: list[Element]) -> str:
    """Hash of an element with all below it; adds the block-level elements with text."""
    texts: dict[int, str] = {}
    around: set[int] = set()  # elements with an article or main element in or below them
    for node in bottom_up(element):
        if node.tag in MAIN or id(node) in around:
            around.update((id(node), id(node.parent)))
        parts = [
            texts[id(part)] if isinstance(part, Element) else " ".join(part.split())
            for part in node.parts
        ]
        parts = [part for part in parts if part]
        if not parts:
            texts[id(node)] = ""
            continue
        digest = xxhash.xxh64("\x1f".join([node.tag, *parts]))
        node.key = int.from_bytes(digest.digest(), "big", signed=True)
        texts[id(node)] = digest.hexdigest()
        if node.tag in INLINE or (node.main and node.tag in FLOW):
            continue
        if id(node) not in around and node is not element:
            found.append(node)
    return texts[id(element)]


def bottom_up(root: Element) -> list[Element]:
    """All elements, each after those inside it; without recursion, as pages can be very deep."""
    order, stack = [], [root]
    while stack:
        node = stack.pop()
        order.append(node)
        stack.extend(part for part in node.parts if isinstance(part, Element))
    return order[::-1]


def count_links(root: Element) -> None:
    """Give each element its number of links, and the characters in them and in all its text."""
    for node in bottom_up(root):
        links = linked = total = 0
        for part in node.parts:
            if isinstance(part, Element):
                links, linked, total = (x + y for x, y in zip((links, linked, total), part.links, strict=True))
            else:
                total += len("".join(part.split()))
        node.links = (links + 1, total, total) if node.tag == "a" else (links, linked, total)


def is_menu(element: Element) -> bool:
    """Nearly all text of a list or container is in three links or more."""
    links, linked, total = element.links
    return links > 2 and linked >= LINK_SHARE * total


def is_boilerplate(element: Element, template: frozenset[int]) -> bool:
    """Marked as such, or a template and not the text of an article."""
    return element.mark or (
        element.key in template and element.key != 0 and not (element.main and element.tag in FLOW)
    )


def read_text(element: Element, template: frozenset[int]) -> str:
    """Text of an element without marked and template subtrees, blocks joined by one space."""
    out: list[str] = []
    stack: list[str | Element] = [element]
    while stack:
        part = stack.pop()
        if not isinstance(part, Element):
            out.append(part)
            continue
        if is_boilerplate(part, template):
            out.append(" ")
            continue
        if not part.main and part.tag in ("ul", "ol", "div", "section", "p") and is_menu(part):
            out.append(" ")
            continue
        block = part.tag not in INLINE and part.tag != "wbr"
        if block:
            out.append(" ")
            stack.append(" ")
        stack.extend(reversed(part.parts))
    return " ".join(unescape("".join(out)).split())


def main_elements(root: Element, template: frozenset[int]) -> list[Element]:
    """Topmost articles that are not boilerplate, else main elements, else the body."""
    for wanted in ("article", "main"):
        found, stack = [], [root]
        while stack:
            node = stack.pop()
            if is_boilerplate(node, template):
                continue
            if node.tag == wanted:
                found.append(node)
                continue
            stack.extend(part for part in reversed(node.parts) if isinstance(part, Element))
        if found and any(read_text(node, template) for node in found):
            return found
    return [root]


def main_text(html: str | None, template: frozenset[int] = frozenset()) -> str:
    if not html:
        return ""
    root = parse(html)
    count_links(root)
    if template:
        hash_subtrees(root, [])
    texts = (read_text(node, template) for node in main_elements(root, template))
    return " ".join(text for text in texts if text)


def subtree_hashes(html: str | None) -> tuple[list[int], list[int]]:
    """Different hashes of a page's subtrees, and those that occur outside marked elements."""
    if not html:
        return [], []
    root = parse(html)
    found: list[Element] = []
    hash_subtrees(root, found)
    marked: set[int] = set()
    for node in reversed(bottom_up(root)):
        if node.mark or id(node.parent) in marked:
            marked.add(id(node))
    return (
        list({node.key for node in found}),
        list({node.key for node in found if id(node) not in marked}),
    )


SUBTREES = StructType(
    [StructField("subtrees", ArrayType(LongType())), StructField("unmarked", ArrayType(LongType()))]
)


@pandas_udf(SUBTREES)
def subtrees_of(pages: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    for series in pages:
        yield pd.DataFrame([subtree_hashes(html) for html in series], columns=SUBTREES.names)


@pandas_udf(StringType())
def text_of(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
    for pages, templates in batches:
        yield pd.Series(
            [
                main_text(html, frozenset() if template is None else frozenset(template))
                for html, template in zip(pages, templates, strict=True)
            ],
            dtype=object,
        )


def host_of(url: Column) -> Column:
    pattern = r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/:?#]+)"
    return F.lower(F.coalesce(F.regexp_extract(url, pattern, 1), F.lit("")))


def page_key(pages: DataFrame, url: str, html: str) -> Column:
    """The same for equal pages of a host."""
    return F.xxhash64(host_of(pages[url]), pages[html])


def site_templates(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """One row per different page with template subtrees: ``template_page`` and their hashes, ``template``."""
    small_batches(pages.sparkSession)
    read = pages.select(
        page_key(pages, url, html).alias("page"),
        F.xxhash64(host_of(pages[url])).alias("host"),
        subtrees_of(pages[html]).alias("found"),
    )
    different = cut(
        read.groupBy("page").agg(
            F.any_value("host").alias("host"),
            F.any_value("found.subtrees").alias("subtrees"),
            F.any_value("found.unmarked").alias("unmarked"),
        )
    )
    counts = different.select("host", F.explode("subtrees").alias("subtree")).groupBy("host", "subtree")
    frequent = counts.agg(F.count("*").alias("n_pages")).where(F.col("n_pages") >= MIN_PAGES)
    own = different.select("page", "host", F.explode("unmarked").alias("subtree"))
    return (
        own.join(frequent, ["host", "subtree"])
        .groupBy(F.col("page").alias("template_page"))
        .agg(F.collect_set("subtree").alias("template"))
    )


def extract(
    pages: DataFrame, url: str = "url", html: str = "html", into: str = "main_text"
) -> DataFrame:
    """Pages with their main text in the column ``into``; all other columns as they are."""
    templates = cut(site_templates(pages, url, html))
    same = page_key(pages, url, html) == templates["template_page"]
    return pages.join(templates, same, "left").select(
        *[pages[name] for name in pages.columns if name != into],
        text_of(pages[html], templates["template"]).alias(into),
    )
