import random
import re
from urllib.parse import parse_qsl, urljoin, urlparse

import pytest
from pyspark.sql import functions as F

from feedmill.functions import urls

#: One address or more for each rule, and their neighbours that no rule holds for. Hosts other than the four that rules name are invented.
LISTING = [
    (None, False), ("", False), ("https://kran.example", False), ("https://kran.example/most-otkryt", False), ("https://kran.example/beton м300/?x y", False),
    ("https://www.notim.ru/news/zavod-pushchen/", False), ("https://erzrf.ru/news/kvartal-7?from=lenta", False), ("https://eec.eaeunion.org/news/soglashenie", False), ("https://erzrf.ru/news/a/b", False),
    ("https://ria-stk.ru/news/index.php?ELEMENT_ID=17", False), ("https://ria-stk.ru/news/index.php?ELEMENT_ID=", True), ("https://kran.example/news", True), ("https://kran.example/news///", True),
    ("https://eec.eaeunion.org/news/broadcasts/", True), ("https://www.ria-stk.ru/news/vse-novosti.php", True), ("https://kran.example/a/page/7/b", True), ("https://kran.example/pages/7", False),
    ("https://kran.example/press/", True), ("https://kran.example/news-list", True), ("https://kran.example/pressa/", False), ("https://kran.example/x?SORT=up", True), ("https://kran.example/x?resort=up", False),
    ("https://kran.example/x?Pagen_12=3", True), ("https://notim.ru/news/?month=5", True), ("https://kran.example/city/news/", True), ("https://kran.example/city/fakenews/", False),
    ("https://kran.example/novosti/dorogi", True), ("https://kran.example/novosti/4417", False), ("https://kran.example/novosti/dorogi/4417", False), ("https://kran.example/x/category/y/z", True),
    ("https://kran.example/subcategory/y", False), ("https://kran.example/x?VOTE_ID=8", True), ("https://kran.example/x?VOTE_ID=acht", False),
]


def test_listing_pages(spark):
    rows = spark.createDataFrame([(i, u) for i, (u, _) in enumerate(LISTING)], "i int, u string").select("i", urls.is_listing(F.col("u")).alias("x")).orderBy("i").collect()
    assert [r.x for r in rows] == [x for _, x in LISTING]


def test_parts_and_pairs_as_the_standard_library_has_them(spark):
    rng = random.Random(5)
    found = [f"{rng.choice(['http', 'https'])}://{rng.choice(['a.example', 'u:p@b.example:81', 'WWW.c.example'])}{rng.choice(['', '/', '/a/b', '/a;p=1', '/a b/в'])}{rng.choice(['', '?', '?a=1&b=&c', '?q=%D0%B9+x&z=%zz'])}{rng.choice(['', '#f'])}" for _ in range(200)]
    rows = spark.createDataFrame([(i, u) for i, u in enumerate(found)], "i int, u string").select("u", urls.parts(F.col("u")).alias("p"), urls.query_pairs(urls.part(F.col("u"), 4)).alias("q"))
    for r in rows.collect():
        p = urlparse(r.u)
        assert (r.p.scheme, r.p.host, r.p.path, r.p.query, r.p.fragment) == (p.scheme, p.netloc, p.path, p.query, p.fragment), r.u
        if "%zz" not in r.u:
            assert [(x.key, x.value) for x in r.q] == parse_qsl(p.query, keep_blank_values=True)


@pytest.mark.parametrize("href", ["/x", "y.html", "../up", "./same", "a/../../b?c=1#d", "?q=1", "#top", "//h.example/z", "https://o.example", "mailto:a@b", "", "/a/./b/../c"])
def test_joined_as_the_standard_library_does(one, href):
    base = "https://s.example/dir/page.html?o=1"
    assert one(urls.joined(F.col("b"), F.col("h")), b=base, h=href) == urljoin(base, href)


def test_cache_keys(one):
    key = urls.cache_key(F.col("u"))
    assert one(key, u="https://h.example/") == "h.example-index.html"
    assert one(key, u="https://h.example/a/b.html") == "h.example-a-b-html.html"
    assert re.fullmatch(r"h\.example-a-[0-9a-f]{10}\.html", one(key, u="https://h.example/a?x=1"))
    assert re.fullmatch(r"h\.example-[0-9a-f]{10}\.html", one(key, u="https://h.example/новости?x=1"))
    assert len(one(key, u="https://h.example/" + "a" * 400)) == len("h.example-.html") + 150
    assert one(urls.with_suffix(F.col("k"), F.lit("-amp")), k="a.html") == "a-amp.html"


def test_amp(one):
    assert [one(urls.amp_allowed(F.col("h")), h=h) for h in ("rg.ru", "www.ria.ru", "realty.ria.ru", "example.com", "news.rg.ru", "m.ria.ru", None)] == [True] * 3 + [False] * 4
    found = urls.amp_url(F.col("u"), F.col("a"))
    assert one(found, u="https://rg.ru/x/", a=None) == "https://rg.ru/x/amp"
    assert one(found, u="https://o.example/x", a="/amp/x") == "https://o.example/amp/x"
    assert one(found, u="https://o.example/x", a="https://o.example/x") is None
    assert one(found, u="https://rg.ru/x/amp", a=None) is None
