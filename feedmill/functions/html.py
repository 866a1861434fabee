"""Reading pages: one Arrow pass turns markup into what the engine needs of it.

A page is held as flat arrays in document order: every element covers a span of positions, every string stands at one, so
"inside" is a comparison of numbers. Void elements have no content, an end tag closes up to the nearest open element of its
name and is ignored without one; nothing closes by itself. Strings of scripts, styles and templates count for no ancestor.
"""

from __future__ import annotations

import json
import re
from bisect import bisect_left
from collections.abc import Iterator
from functools import lru_cache
from html.parser import HTMLParser

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed values of the reading rules.
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr", "basefont", "bgsound", "command", "frame", "image", "isindex", "keygen", "menuitem", "nextid", "spacer"}
HIDDEN = {"script", "style", "template"}
JUNK = {"script", "style", "noscript", "form", "iframe"}
PAGE_JUNK = JUNK | {"nav", "footer", "aside"}
CONTENT_SELECTORS = (
    "article", "main article", "article .article__content", ".article__body", ".article__content", ".article-body", ".article-body__content", ".article_text", ".article-text", ".article-content", ".article__text",
    ".content", ".content__inner", ".content__text", ".content-text", ".content-text__body", ".contentBody", ".entry-content", ".news-body", ".news-content", ".news-detail", ".news-detail__content", ".news-detail__text",
    ".news-detail__wrapper", ".news-item__text", ".news-text", ".post-content", ".presscenter__content", "#news-detail",
)
DATE_SELECTORS = (
    "span.date", ".news-date", ".news__date", ".article-date", ".post-date", ".entry-date", ".published", ".article__date", ".article-info__date", ".date-publication", ".date-time", ".meta__date", ".time__value",
    ".date", ".time", "time[itemprop='datePublished']", ".news-detail__date", ".presscenter_event_date", ".blog-post__date", ".news-item__date", ".article__meta-date", ".card__date",
)
META_DATES = (
    ("property", "article:published_time"), ("property", "article:modified_time"), ("property", "og:published_time"), ("property", "og:updated_time"), ("property", "article:published"), ("name", "pubdate"), ("name", "date"),
    ("name", "publish-date"), ("name", "publication_date"), ("name", "dc.date"), ("name", "dcterms.date"), ("itemprop", "datePublished"), ("itemprop", "dateCreated"),
)
META_TITLES = (("property", "og:title"), ("name", "og:title"), ("name", "title"))
JSON_DATES = ("datePublished", "dateModified", "uploadDate")
#: Characters of a text that a selector must yield, and of a paragraph that the last resort takes; date candidates kept.
ENOUGH, PARAGRAPH, CANDIDATES = 40, 20, 20

SCHEMA = "title string, date_candidates array<string>, content string, fallback string, amp_href string, links array<struct<pos int, href string, text string, label string>>"
_COMPOUND = re.compile(r"([A-Za-z][\w-]*|\*)?((?:\.[\w-]+|#[\w-]+|\[[\w:-]+(?:\s*=\s*(?:'[^']*'|\"[^\"]*\"|[\w:.-]+))?\])*)")
_SIMPLE = re.compile(r"\.([\w-]+)|#([\w-]+)|\[([\w:-]+)(?:\s*=\s*(?:'([^']*)'|\"([^\"]*)\"|([\w:.-]+)))?\]")


class Page(HTMLParser):
    """A page's elements and strings in document order."""

    def __init__(self, markup: str):
        super().__init__(convert_charrefs=True)
        self.tag: list[str] = []
        self.attrs: list[dict[str, str]] = []
        self.parent: list[int] = []
        self.start: list[int] = []
        self.end: list[int] = []
        self.at: list[int] = []
        self.text: list[str] = []
        self.hidden: list[bool] = []
        self._open: list[int] = []
        self._clock = 0
        self._joined = False
        self.feed(markup)
        self.close()
        for i in self._open:
            self.end[i] = self._clock
        self.alive = [True] * len(self.text)
        self.present = [True] * len(self.tag)

    def handle_starttag(self, tag: str, attrs: list) -> None:
        self._joined = False
        i = len(self.tag)
        self.tag.append(tag)
        self.attrs.append({k: v or "" for k, v in reversed(attrs)})
        self.parent.append(self._open[-1] if self._open else -1)
        self.start.append(self._clock)
        self.end.append(self._clock + 1)
        self._clock += 1
        if tag not in VOID:
            self._open.append(i)

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag: str) -> None:
        self._joined = False
        if any(self.tag[i] == tag for i in self._open):
            while self._open:
                i = self._open.pop()
                self.end[i] = self._clock
                if self.tag[i] == tag:
                    break

    def handle_data(self, data: str) -> None:
        if self._joined:
            self.text[-1] += data
            return
        self.at.append(self._clock)
        self._clock += 1
        self.text.append(data)
        self.hidden.append(bool(self._open) and self.tag[self._open[-1]] in HIDDEN)
        self._joined = True

    def handle_comment(self, data: str) -> None:
        self._joined = False

    handle_decl = handle_pi = unknown_decl = handle_comment

    def strings(self, node: int, own_hidden: bool = False) -> list[str]:
        """The stripped strings in a node that are not empty; of scripts only their own."""
        lo, hi = (0, len(self.at)) if node < 0 else (bisect_left(self.at, self.start[node]), bisect_left(self.at, self.end[node]))
        return [t for k in range(lo, hi) if self.alive[k] and (own_hidden or not self.hidden[k]) and (t := self.text[k].strip())]

    def read(self, node: int, separator: str) -> str:
        return separator.join(self.strings(node))

    def inside(self, node: int, tags: set[str] | None = None) -> Iterator[int]:
        """Elements in a node, in document order; of the whole page for -1."""
        lo, hi = (0, len(self.tag)) if node < 0 else (node + 1, bisect_left(self.start, self.end[node]))
        return (i for i in range(lo, hi) if self.present[i] and (tags is None or self.tag[i] in tags))

    def remove(self, node: int, tags: set[str]) -> None:
        """Takes elements of these names out of a node, with all they hold."""
        for i in list(self.inside(node, tags)):
            for k in range(bisect_left(self.at, self.start[i]), bisect_left(self.at, self.end[i])):
                self.alive[k] = False
            for k in range(i, bisect_left(self.start, self.end[i])):
                self.present[k] = False

    def first(self, tags: set[str]) -> int:
        return next(self.inside(-1, tags), -1)

    def select(self, selector: str) -> list[int]:
        """The elements that a selector names, in document order."""
        alternatives = compiled(selector)
        return [i for i in self.inside(-1) if any(self._matches(i, chain) for chain in alternatives)]

    def _matches(self, i: int, chain: tuple) -> bool:
        if not self._fits(i, chain[-1]):
            return False
        up = self.parent[i]
        for step in reversed(chain[:-1]):
            while up >= 0 and not self._fits(up, step):
                up = self.parent[up]
            if up < 0:
                return False
            up = self.parent[up]
        return True

    def _fits(self, i: int, step: tuple) -> bool:
        tag, conditions = step
        if tag and tag != self.tag[i]:
            return False
        attrs = self.attrs[i]
        return all((value in attrs.get("class", "").split()) if name == "." else (name in attrs and (value is None or attrs[name] == value)) for name, value in conditions)


@lru_cache(1000)
def compiled(selector: str) -> tuple:
    """A selector as alternatives of chains of (tag, conditions). Tags, classes, ids, attributes, descendants and commas are
    understood; anything else names nothing."""
    out = []
    for alternative in selector.split(","):
        chain = []
        for word in re.findall(r"(?:\[[^\]]*\]|\S)+", alternative):
            m = _COMPOUND.fullmatch(word)
            if not m or not word:
                return ()
            conditions = [(".", c) if c else ("id", i) if i else (a, v1 or v2 or v3 or None) for c, i, a, v1, v2, v3 in _SIMPLE.findall(m[2])]
            chain.append((None if m[1] in (None, "", "*") else m[1].lower(), tuple(conditions)))
        if not chain:
            return ()
        out.append(tuple(chain))
    return tuple(out)


def tidy(text: str) -> str:
    return "\n".join(x for line in text.splitlines() if (x := line.strip()))


def title_of(page: Page) -> str | None:
    for key, value in META_TITLES:
        named = next((i for i in page.inside(-1, {"meta"}) if page.attrs[i].get(key) == value), -1)
        if named >= 0 and page.attrs[named].get("content"):
            return page.attrs[named]["content"].strip()
    if (heading := page.first({"h1", "h2"})) >= 0:
        return page.read(heading, " ")
    if (named := page.first({"title"})) >= 0 and (own := page.strings(named)):
        return own[0]
    return None


def _json_dates(value) -> Iterator[str]:
    if isinstance(value, dict):
        for k, v in value.items():
            if k in JSON_DATES and isinstance(v, str):
                yield v
            yield from _json_dates(v)
    elif isinstance(value, list):
        for v in value:
            yield from _json_dates(v)


def dates_of(page: Page) -> list[str]:
    """Whatever may be the date of a page: times, meta data, linked data, then what stands in date containers."""
    found = []
    for i in page.inside(-1, {"time"}):
        found += [page.attrs[i].get("datetime") or page.attrs[i].get("content") or "", page.read(i, "")]
    metas = list(page.inside(-1, {"meta"}))
    for key, value in META_DATES:
        found += [page.attrs[i].get("content") or page.attrs[i].get("datetime") or "" for i in metas if page.attrs[i].get(key) == value]
    for i in page.inside(-1, {"script"}):
        if page.attrs[i].get("type") == "application/ld+json":
            try:
                found += _json_dates(json.loads("".join(page.strings(i, own_hidden=True))))
            except (ValueError, RecursionError):
                continue
    for selector in DATE_SELECTORS:
        found += [page.read(i, " ") for i in page.select(selector)]
    return list(dict.fromkeys(x for x in found if x))[:CANDIDATES]


def content_of(page: Page, selectors: list[str]) -> str | None:
    """The text of the first element, by the selectors' order, that holds enough; else the article's longer paragraphs."""
    for selector in dict.fromkeys([*selectors, *CONTENT_SELECTORS]):
        for i in page.select(selector):
            page.remove(i, JUNK)
            if len(text := tidy(page.read(i, "\n"))) >= ENOUGH:
                return text
    container = page.first({"article"})
    container = container if container >= 0 else page.first({"body"})
    if container < 0:
        return None
    return "\n\n".join(x for i in page.inside(container, {"p", "li"}) if len(x := tidy(page.read(i, " "))) >= PARAGRAPH) or None


def fallback_of(page: Page, selectors: list[str], title: str | None) -> str | None:
    """The longest text that any selector yields, or the densest element's paragraphs where these are longer."""
    page.remove(-1, PAGE_JUNK)
    nodes, texts = [], []
    for selector in dict.fromkeys([*filter(None, selectors), *CONTENT_SELECTORS]):
        for i in page.select(selector):
            if i not in nodes and (text := tidy(page.read(i, "\n"))):
                nodes.append(i)
                texts.append(text)
    best = max(texts, key=len, default="")
    nodes += [i for i in (page.first({"article"}), page.first({"body"})) if i >= 0 and i not in nodes]
    dense, most = "", 0
    for i in nodes:
        fragments = [x for k in page.inside(i, {"p", "li", "h2", "h3"}) if (x := tidy(page.read(k, " ")))]
        if (score := sum(map(len, fragments))) > most:
            dense, most = "\n\n".join(fragments), score
    return tidy(without_title(dense if len(dense) > len(best) else best, title)) or None


def without_title(text: str, title: str | None) -> str:
    name, head = " ".join((title or "").split()), text.lstrip()
    if not name:
        return text.strip()
    if head[: len(name)].lower() == name.lower():
        return re.sub(r"^[\s\-–—:]+", "", head[len(name) :]).strip()
    first, _, rest = head.partition("\n")
    return (rest if " ".join(first.split()).lower() == name.lower() else head).strip()


def links_of(page: Page) -> list[dict]:
    """Every anchor with an address, in document order."""
    found = [i for i in page.inside(-1, {"a"}) if page.attrs[i].get("href")]
    return [{"pos": n, "href": page.attrs[i]["href"], "text": page.read(i, ""), "label": page.attrs[i].get("title") or page.attrs[i].get("aria-label") or ""} for n, i in enumerate(found)]


def amp_of(page: Page) -> str | None:
    return next((page.attrs[i]["href"] for i in page.inside(-1, {"link"}) if "amphtml" in page.attrs[i].get("rel", "").lower().split() and page.attrs[i].get("href")), None)


def read_page(markup: str | None, selectors: list[str] | None, wanted: frozenset[str]) -> dict:
    """What is wanted of a page; of a null one, nothing."""
    if markup is None:
        return {}
    page, selectors = Page(markup), [s for s in selectors or [] if s]
    out: dict = {}
    if "title" in wanted:
        out["title"] = title_of(page)
    if "date_candidates" in wanted:
        out["date_candidates"] = dates_of(page)
    if "links" in wanted:
        out["links"] = links_of(page)
    if "amp_href" in wanted:
        out["amp_href"] = amp_of(page)
    if "content" in wanted:
        out["content"] = content_of(page, selectors)
    if "fallback" in wanted:
        out["fallback"] = fallback_of(page, selectors, title_of(page))
    return out


ALL = frozenset(("title", "date_candidates", "content", "fallback", "amp_href", "links"))


def with_page(df: DataFrame, html: str = "html", selectors: str | None = None, wanted: frozenset[str] = ALL, out: str = "page") -> DataFrame:
    """``df`` with a struct of what is wanted of each page; parts that are not wanted are null."""
    from pyspark.sql.types import _parse_datatype_string

    kind = _parse_datatype_string(SCHEMA)

    @F.udf(kind, useArrow=True)
    def parse(markup, chosen):
        found = read_page(markup, list(chosen) if chosen is not None else None, wanted)
        return {f.name: found.get(f.name) for f in kind.fields}

    return df.withColumn(out, parse(F.col(html), F.col(selectors) if selectors else F.lit(None).cast("array<string>")))


def fragment_text(fragment: str | None) -> str | None:
    """The text of a piece of markup; null for null."""
    if fragment is None:
        return None
    page = Page(fragment)
    page.remove(-1, JUNK)
    return tidy(page.read(-1, "\n"))


def fragments_text(column):
    """``fragment_text`` as a Column."""

    @F.udf("string", useArrow=True)
    def convert(fragment):
        return fragment_text(fragment)

    return convert(column)
