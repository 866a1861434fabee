"""URL expressions: parts, joining, identifiers, cache keys, listing pages, AMP addresses."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from feedmill.functions.base import any_of, let, truthy

_URL = r"^(?:([A-Za-z][A-Za-z0-9+.\-]*):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?(?:#([\s\S]*))?$"

# What listing pages are told by.
LISTING_SEGMENTS = ("tag", "category", "archive", "search", "page")
SECTION_PREFIXES = ("news", "novosti", "lenta", "tema", "topics", "press", "press-center", "press-tsentr")
SECTION_PATHS = ("/press", "/news-list")
LISTING_KEYS = ("page", "pagen_1", "per-page", "tag", "category", "year", "month", "sort", "filter")
ARTICLE_HOSTS = ("notim.ru", "eec.eaeunion.org", "erzrf.ru")
ARTICLE_PATH = r"^/news/[^/?#]+/?$"
HUB_PATHS = {"eec.eaeunion.org": r"^/news/(speech|events|video-gallery|photo-gallery|broadcasts)/?$", "ria-stk.ru": r"^/news/vse-novosti\.php$"}
ELEMENT_HOST, ELEMENT_PATH = "ria-stk.ru", "/news/index.php"
AMP_HOSTS = ("rg.ru", "ria.ru", "realty.ria.ru")
#: Characters of a cache key's path, at most.
CACHE_SLUG = 150


def part(url: Column, n: int) -> Column:
    """Scheme, host, path, query or fragment of a url (1 to 5); parameters of the path's last segment are cut off."""
    found = F.regexp_extract(url, _URL, n)
    return F.regexp_replace(found, r";[^/]*$", "") if n == 3 else found


def parts(url: Column) -> Column:
    return F.struct(*[part(url, n).alias(name) for n, name in enumerate(("scheme", "host", "path", "query", "fragment"), 1)])


def bare_host(host: Column) -> Column:
    """Small letters, without one leading www."""
    return F.regexp_replace(F.lower(host), r"^www\.", "")


def same_domain(url: Column, base: Column) -> Column:
    """Whether both have one host, wherever www. stands in it."""
    return F.replace(part(url, 2), F.lit("www."), F.lit("")) == F.replace(part(base, 2), F.lit("www."), F.lit(""))


def segments(path: Column) -> Column:
    return F.filter(F.split(path, "/"), lambda x: x != "")


def _decoded(text: Column) -> Column:
    return F.coalesce(F.try_url_decode(text), F.replace(text, F.lit("+"), F.lit(" ")))


def query_pairs(query: Column) -> Column:
    """(key, value) of every parameter; one without "=" has an empty value."""
    tokens = F.filter(F.split(query, "&"), lambda x: x != "")
    return F.transform(tokens, lambda x: F.struct(_decoded(F.regexp_extract(x, r"^([^=]*)", 1)).alias("key"), _decoded(F.regexp_extract(x, r"^[^=]*=([\s\S]*)$", 1)).alias("value")))


def _flat(path: Column) -> Column:
    """The path without dot segments, a segment at a time."""
    walked = F.aggregate(
        F.split(path, "/", -1),
        F.array().cast("array<string>"),
        lambda acc, x: F.when(x == ".", acc).when((x == "..") & (F.size(acc) > 1), F.slice(acc, F.lit(1), F.size(acc) - 1)).when(x == "..", acc).otherwise(F.concat(acc, F.array(x))),
    )
    ends = path.rlike(r"(^|/)\.{1,2}$")
    return F.concat(F.array_join(walked, "/"), F.when(ends, "/").otherwise(""))


def joined(base: Column, href: Column) -> Column:
    """``href`` resolved against ``base``; other schemes than http pass through, an empty href gives the base."""

    def resolve(b: Column, h: Column) -> Column:
        origin = F.concat(b["scheme"], F.lit("://"), b["host"])
        folder = F.regexp_replace(b["path"], r"[^/]*$", "")
        folder = F.when(folder == "", "/").otherwise(folder)
        tail = F.concat(F.when(href.contains("?"), F.concat(F.lit("?"), h["query"])).otherwise(""), F.when(href.contains("#"), F.concat(F.lit("#"), h["fragment"])).otherwise(""))
        path = F.regexp_extract(href, _URL, 3)
        flat = lambda p: F.when(p.rlike(r"(^|/)\.{1,2}(/|$)"), _flat(p)).otherwise(p)
        query = F.when(base.contains("?"), F.concat(F.lit("?"), b["query"])).otherwise("")
        return (
            F.when(truthy(href).isNull(), base)
            .when(h["scheme"] != "", href)
            .when(href.startswith("//"), F.concat(b["scheme"], F.lit(":"), href))
            .when(href.startswith("/"), F.concat(origin, flat(path), tail))
            .when(href.startswith("?"), F.concat(origin, b["path"], tail))
            .when(href.startswith("#"), F.concat(origin, b["path"], query, tail))
            .otherwise(F.concat(origin, flat(F.concat(folder, path)), tail))
        )

    return let(F.struct(parts(base).alias("b"), parts(href).alias("h")), lambda x: resolve(x["b"], x["h"]))


def item_id(url: Column) -> Column:
    return F.sha2(url, 256)


def digest(body: Column) -> Column:
    return F.sha2(body, 256)


def cache_key(url: Column) -> Column:
    """A file name for a page: host, what the path is made of, and a hash of the query."""
    path = F.regexp_replace(F.regexp_replace(part(url, 3), r"[^a-zA-Z0-9]+", "-"), r"^-+|-+$", "")
    query = F.trim(part(url, 4))
    hashed = F.when(query != "", F.substring(F.sha1(query), 1, 10)).otherwise("")
    slug = F.concat_ws("-", truthy(path), truthy(hashed))
    slug = F.when(slug == "", "index").otherwise(F.substring(slug, 1, CACHE_SLUG))
    return F.concat(part(url, 2), F.lit("-"), slug, F.lit(".html"))


def with_suffix(key: Column, suffix: Column) -> Column:
    """A cache key with a suffix before its ending."""
    return F.when(key.endswith(".html"), F.concat(F.regexp_replace(key, r"\.html$", ""), suffix, F.lit(".html"))).otherwise(F.concat(key, suffix))


def listing_rule(url: Column) -> Column:
    """Which rule says what a url leads to: R1 and R2 articles, R3 to R12 listing pages; null where none does.

    Rules hold in their order. Null and empty urls have none.
    """

    def rule(u: Column) -> Column:
        host, path, lowered, pairs = u["host"], u["path"], u["lowered"], u["pairs"]
        hub = any_of([(host == h) & lowered.rlike(p) for h, p in HUB_PATHS.items()])
        keys = F.transform(pairs, lambda x: F.lower(x["key"]))
        last = F.element_at(u["segments"], -1)
        two = (F.size(u["segments"]) == 2) & F.get(u["segments"], F.lit(0)).isin(*SECTION_PREFIXES) & ~F.get(u["segments"], F.lit(1)).rlike(r"^\d+$")
        return (
            F.when(host.isin(*ARTICLE_HOSTS) & path.rlike(ARTICLE_PATH) & ~hub, "R1")
            .when((host == ELEMENT_HOST) & (lowered == ELEMENT_PATH) & F.exists(pairs, lambda x: (F.lower(x["key"]) == "element_id") & (x["value"] != "")), "R2")
            .when(path == "/news", "R3")
            .when(hub, "R4")
            .when(u["raw"].contains("/page/"), "R5")
            .when(path.isin(*SECTION_PATHS), "R6")
            .when(F.arrays_overlap(keys, F.array(*map(F.lit, LISTING_KEYS))), "R7")
            .when(F.exists(pairs, lambda x: F.upper(x["key"]).startswith("PAGEN_")), "R8")
            .when((F.size(u["segments"]) > 0) & (last == "news"), "R9")
            .when((F.size(u["segments"]) > 0) & two, "R10")
            .when(F.arrays_overlap(u["segments"], F.array(*map(F.lit, LISTING_SEGMENTS))), "R11")
            .when(F.exists(pairs, lambda x: (F.upper(x["key"]) == "VOTE_ID") & x["value"].rlike(r"^\d+$")), "R12")
        )

    def derived(cells: Column) -> Column:
        """What the rules look at, from host, path and query, which one match of the pattern gives."""
        host, path, query = (F.get(cells, F.lit(n)) for n in range(3))
        path = F.regexp_replace(path, r";[^/]*$", "")
        return let(path, lambda p: let(F.struct(F.regexp_replace(p, "/+$", "").alias("bare"), F.lower(p).alias("raw")), lambda x: let(looked_at(host, x, query), rule)))

    def looked_at(host: Column, x: Column, query: Column) -> Column:
        bare = F.when(x["bare"] == "", "/").otherwise(x["bare"])
        return F.struct(bare_host(host).alias("host"), bare.alias("path"), F.lower(bare).alias("lowered"), x["raw"].alias("raw"), segments(x["raw"]).alias("segments"), query_pairs(query).alias("pairs"))

    cells = F.split(F.regexp_replace(url, _URL, "$2\u0001$3\u0001$4"), "\u0001", -1)
    return F.when(truthy(url).isNotNull(), let(cells, derived))


def is_listing(url: Column) -> Column:
    """Whether a url leads to a listing page; false for null and empty ones."""
    return F.coalesce(~listing_rule(url).isin("R1", "R2"), F.lit(False))


def amp_allowed(host: Column) -> Column:
    return F.coalesce(bare_host(host).isin(*AMP_HOSTS), F.lit(False))


def amp_url(url: Column, amp_href: Column) -> Column:
    """Where a page's AMP version lies: the link it names, else /amp for hosts that have it; null if that is the page."""
    named = F.when(truthy(amp_href).isNotNull(), joined(url, amp_href))
    guessed = F.when(amp_allowed(part(url, 2)) & ~F.regexp_replace(url, "/+$", "").endswith("/amp"), F.concat(F.regexp_replace(url, "/+$", ""), F.lit("/amp")))
    return F.nullif(F.coalesce(named, guessed), url)
