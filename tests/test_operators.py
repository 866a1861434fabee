from datetime import datetime

import pytest
from pyspark.sql import functions as F

from feedmill.functions import html
from feedmill.operators import feed, fetchlog, links, merge, metrics, state
from feedmill.sources import api, catalog, feed_io

ITEM = "ord long, id string, url string, title string, date_published string, content_text string, source string"


def items(spark, *rows):
    return spark.createDataFrame([(n, *r) for n, r in enumerate(rows)], ITEM)


def seen(spark, **pairs):
    return spark.createDataFrame(list(pairs.items()), "id string, first_seen string")


def test_merge_keeps_rich_fields(spark):
    u = "https://example.com/news/1"
    old, new = items(spark, (None, u, "Old title", None, "Existing full text", "s")), items(spark, (None, u, "Updated title", "2024-09-23T10:00:00+03:00", None, "s"))
    (r,) = merge.merge(old, new, seen(spark, x="y")).collect()
    assert (r.title, r.date_published, r.content_text) == ("Updated title", "2024-09-23T10:00:00+03:00", "Existing full text")


def test_merge_guards_against_first_sightings(spark):
    u = "https://example.com/news/1"
    old, new = items(spark, ("news-1", u, "First crawl", "2024-09-20T09:00:00+03:00", "a", "s")), items(spark, ("news-1", u, "Second crawl", "2024-09-25T12:00:00+03:00", "b", "s"))
    (r,) = merge.merge(old, new, spark.createDataFrame([("news-1", "2024-09-25T12:00:00+03:00")], "id string, first_seen string")).collect()
    assert (r.title, r.date_published) == ("Second crawl", "2024-09-20T09:00:00+03:00")


def test_merge_folds_in_order_and_erases_dates(spark):
    a, b = "https://example.com/a", "https://example.com/b"
    old = items(spark, ("1", a, "o", "2020", "x", "s"), ("1", a, "p", "2021", "y", "s"), ("", "", "no url", "2020", "x", "s"), ("2", "https://example.com/news/", "listing", "2020", "x", "s"))
    new = items(spark, ("3", b, "n1", "2022", "z", "s"), ("1", a, "n2", "2023", " ", "s"), ("1", a, "n3", None, None, "s"))
    rows = merge.newest(merge.merge(old, new, seen(spark, q="r")), 0).collect()
    assert [(r.url, r.title, r.date_published, r.content_text) for r in rows] == [(b, "n1", "2022", "z"), (a, "n3", None, "y")]
    assert [r.url for r in merge.newest(merge.merge(old, new, seen(spark, q="r")), 1).collect()] == [b]
    assert merge.merge(old.limit(0), new.limit(0), seen(spark, q="r")).count() == 0


def test_feed_keeps_the_first_dated(spark):
    rows = items(spark, ("1", "u", "a", "", "x", "s"), ("1", "u", "b", "2020", "x", "s"), ("1", "u", "c", "2021", "x", "s"), ("2", "v", "d", None, "x", "s"), ("3", "w", "e", "2020", "x", "s"))
    found = feed.in_order(feed.built(rows)).collect()
    assert [(r.url, r.title, r.ord) for r in found] == [("u", "b", 0), ("w", "e", 4)]
    assert [r.url for r in feed.built(rows, skip="^E$|(?i)^b$").collect()] == ["w"]


def test_metrics_and_gate(spark):
    rows = items(spark, ("1", "https://example.com/news/", "", None, "", "s"), ("2", "https://example.com/story", "", None, "Full text", "s"))
    assert metrics.feed_metrics(rows).first().asDict() == {"total": 2, "empty_content_text": 1, "listing_urls_count": 1}
    assert metrics.feed_metrics(rows.limit(0)).first().asDict() == {"total": 0, "empty_content_text": 0, "listing_urls_count": 0}
    counts = lambda *x: spark.createDataFrame([x], "total long, empty_content_text long, listing_urls_count long")
    bad = metrics.gate(counts(10, 4, 2), counts(7, 3, 0)).first()
    assert not bad.ok and "dropped below" in bad.message
    assert metrics.gate(counts(10, 4, 2), counts(8, 3, 0)).first().asDict() == {"ok": True, "message": None}


def test_pages(spark):
    page = "<article><h1>Пример заголовка</h1><div itemprop='articleBody'><p>Тело новости ...</p><p>Еще немного текста.</p></div></article>"
    text = html.fallback_of(html.Page(page), ["[itemprop='articleBody']"], "Пример заголовка")
    assert text and text != "Пример заголовка" and len(text) >= 20
    head = "<head><meta property='og:title' content=' О '><meta name='title' content='t'><title>T &amp; t</title><link rel='x AMPhtml' href='/a'></head>"
    rich = html.Page(head + "<time datetime='2024-01-01'>1 янв</time><script type='application/ld+json'>{\"a\":[{\"datePublished\":\"2024-02-02\"}]}</script><script type='application/ld+json'>{bad</script><div class='date x'>3 мая <i>2024</i></div><h2>H</h2><a href='/l'> x <b>y</b></a><a>no</a>")
    assert html.title_of(rich) == "О" and html.amp_of(rich) == "/a"
    assert html.dates_of(rich) == ["2024-01-01", "1 янв", "2024-02-02", "3 мая 2024"]
    assert html.links_of(rich) == [{"pos": 0, "href": "/l", "text": "xy", "label": ""}]
    assert html.title_of(html.Page("<title>T &amp; t</title>")) == "T & t" and html.title_of(html.Page("")) is None
    assert html.content_of(html.Page("<div class='content'>" + "я" * 39 + "</div><div id='news-detail'>" + "ю" * 40 + "<script>var x</script></div>"), []) == "ю" * 40
    assert html.content_of(html.Page("<body><p>" + "а" * 20 + "</p><li>" + "б" * 19 + "</li></body>"), []) == "а" * 20
    assert html.content_of(html.Page("plain"), []) is None
    assert html.compiled("a > b") == () and html.Page("<p><b class='x y'>1</b></p>").select("p .y, i") == [1]
    assert html.fragment_text("<p>a<p>b &copy;<style>x</style>") == "a\nb ©" and html.fragment_text(None) is None
    frame = html.with_page(spark.createDataFrame([(1, page, ["[itemprop='articleBody']"]), (2, None, None), (3, "", [])], "i int, html string, s array<string>"), selectors="s")
    assert [r.page.title for r in frame.orderBy("i").collect()] == ["Пример заголовка", None, None]


def test_links_by_rules(spark):
    schema = "name string, base_url string, include_patterns array<string>, include_regex array<string>, exclude_regex array<string>, link_min_text_len int, accept_empty_anchor boolean, restrict_domain boolean, max_links int, start_url string, api_endpoint string, mode string, min_words int, enabled boolean, content_selectors array<string>"
    sources = catalog.with_defaults(spark.createDataFrame([("s", "https://www.a.example/", ["/x/"], [r"\d+$"], ["bad"], 3, False, True, 2, None, None, None, None, None, None)], schema))
    hrefs = [("/x/1", "text"), ("/news/", "text"), ("https://o.example/x/1", "text"), ("/y/1", "text"), ("/x/one", "text"), ("/x/bad1", "text"), ("/x/2", "t"), ("https://a.example/x/3", "text"), ("/x/1", "text"), ("/x/4", "text"), ("", "text"), (None, "text")]
    rows = spark.createDataFrame([("s", n, h, t) for n, (h, t) in enumerate(hrefs)], "source string, pos int, href string, text string")
    found = links.resolved(rows, sources).select("pos", links.reason().alias("why")).orderBy("pos").collect()
    assert [r.why for r in found] == [None, "listing", "domain", "pattern", "include", "exclude", "text", None, None, None]
    assert [(r.url, r.pos) for r in links.article_links(rows, sources).orderBy("pos").collect()] == [("https://www.a.example/x/1", 0), ("https://a.example/x/3", 7)]


def test_state(spark):
    table = lambda *rows: spark.createDataFrame([("s", n, u) for n, u in enumerate(rows)], "source string, pos int, url string")
    window = state.seen_window(table("n1", "n2"), table("o1", "n1", "gone"), table("n1", "n2", "o1").select("source", "url"), 4).orderBy("pos").collect()
    assert [(r.pos, r.url) for r in window] == [(0, "n1"), (1, "n2"), (2, "o1"), (3, "n1")]
    assert [r.url for r in state.unseen(table("a", "b"), table("a")).collect()] == ["b"]
    assert state.unseen(table("a", "b"), table("a"), force=True).count() == 2
    pages = spark.createDataFrame([("a", 200, "new"), ("b", 304, None), ("c", 503, "err"), ("d", 404, "no"), ("e", 500, None)], "url string, status int, html string")
    at = datetime(2024, 1, 1)
    cache = spark.createDataFrame([("a", "old", at), ("b", "old", at), ("b", "zzz older", at.replace(year=2023)), ("b", "zzz of no time", None), ("c", "old", at), ("d", "old", at), ("d", None, at)], "url string, html string, fetched_at timestamp")
    assert {r.url: (r.origin, r.html) for r in state.served(pages, cache).collect()} == {"a": ("fresh", "new"), "b": ("cached", "old"), "c": ("cached", "old"), "d": ("none", None), "e": ("none", None)}
    assert [r.url for r in feed_io.upsert(cache, cache.where("url = 'a'").withColumn("html", F.lit("z")), ["url"]).where("html = 'z'").collect()] == ["a"]


def test_patterns_are_those_the_jvm_runs(spark):
    schema = "name string, include_regex array<string>, exclude_regex array<string>, base_url string, start_url string, api_endpoint string, mode string, link_min_text_len int, accept_empty_anchor boolean, restrict_domain boolean, max_links int, min_words int, enabled boolean, include_patterns array<string>, content_selectors array<string>"
    df = spark.createDataFrame([("a", ["(?P<n>x)|y", "(bad", None], None, *[None] * 12)], schema)
    (r,) = catalog.with_defaults(df).select("include_regex", "exclude_regex", F.rlike(F.lit("xx"), F.col("include_regex")[0]).alias("hit")).collect()
    assert (r.include_regex, r.exclude_regex, r.hit) == (["(?<n>x)|y"], [], True)


def test_an_empty_delay_hides_no_other():
    assert catalog.warmup_of({"url": "w", "delay": None, "delay_range": [1, 2]})[1:3] == catalog.warmup_of({"url": "w", "delay_range": [1, 2]})[1:3] == (1.0, 2.0)
    assert catalog.warmup_of({"url": "w", "delay": 0})[1:3] == catalog.WARMUP_DELAY


def attempts(spark, *rows):
    schema = "log_no long, host string, url string, phase string, attempt int, status int, error string, cookie_names array<string>, dns_ms double, response_ms double, attempted_at timestamp, logged_at timestamp"
    at = lambda k: datetime(2024, 1, 1, 0, 0, k)
    return spark.createDataFrame([(n, "h", u, p, a, s, e, None, 5.0, 3.0, at(n), at(n)) for n, (u, p, a, s, e) in enumerate(rows)], schema)


def test_request_log(spark):
    log = attempts(spark, ("u", "request", 1, None, "Network is unreachable"), ("u", "request", 2, 200, None), ("v", "request", 1, None, "e1"), ("v", "request", 2, None, "e2"), ("v", "request", 3, None, "e3"), ("w", "request", 1, 403, None), ("x", "request", 1, None, "e"))
    strategies = spark.createDataFrame([("h", (3, [403]))], "host string, strategy struct<max_attempts: int, retry_statuses: array<int>>")
    found = {r.url: (r.attempts, r.status, r.verdict, r.errors) for r in fetchlog.outcomes(log.unionByName(log), strategies).collect()}
    assert found == {"u": (2, 200, "ok", "Network is unreachable"), "v": (3, None, "unavailable", "e1, e2, e3"), "w": (1, None, "unfinished", ""), "x": (1, None, "unfinished", "e")}
    assert fetchlog.failing(log).first().consecutive_failures == 5
    assert [r.failures for r in fetchlog.islands(log).orderBy("log_no").collect()] == [1, 0, 1, 2, 3, 4, 5]
    assert fetchlog.last_metrics(log).first().connect_ms == 0.0


def test_warmups(one):
    outcome = fetchlog.warmup_outcome(F.col("s").cast("int"), F.split(F.col("c"), ","))
    assert [one(outcome, s=s, c=c) for s, c in (("200", "a"), ("401", "x,__ddgid"), ("401", "x"), (None, None))] == ["http_success", "http_4xx_with_cookies", "http_error", "failed"]
    assert one(fetchlog.wait_after(F.lit(3))) == 6.0 and one(fetchlog.wait_after(F.lit(3), 0.0)) == 0.0


def test_catalogue(spark, tmp_path):
    path = tmp_path / "sources.json"
    path.write_text('[{"name":"a","start_url":"https://a.example/x","include_patterns":"/n/","include_regex":["ok","(bad"],"request_strategy":{"connect_timeout":3,"read_timeout":10,"max_attempts":5,"retry_statuses":403,"proxies":["p",{"http":"q","https":""},7],"warmup":{"url":"w","delay":[1,2]}}},{"name":"b","enabled":false,"request_strategy":{}},{"name":"c","base_url":"https://a.example","request_strategy":{"read_timeout":9}}]')
    found = catalog.read_catalog(spark, str(path))
    a, b, c = found.orderBy("ord").collect()
    assert a.include_patterns == ["/n/"] and a.include_regex == ["ok"] and a.request_strategy.retry_statuses == [403]
    assert a.request_strategy.proxies == [{"http": "p", "https": "p"}, {"http": "q"}] and (a.request_strategy.warmup.delay_min, a.request_strategy.warmup.delay_max) == (1.0, 2.0)
    assert b.request_strategy.max_attempts == 3 and [r.name for r in catalog.selected(found, [" c ", ""]).collect()] == ["c"]
    (host,) = catalog.strategies(found).select("host", "source", catalog.timeouts(F.col("strategy")).alias("t")).collect()
    assert (host.host, host.source, host.t.connect, host.t.read) == ("a.example", "c", 9.0, 9.0)
    filled = {r.name: r for r in catalog.with_defaults(found).collect()}
    assert filled["a"].base_url == "https://a.example/x" and filled["a"].max_links == 100 and filled["b"].enabled is False


def test_feed_files(spark, tmp_path):
    for name, body in (("feed", '{"items":[{"url":"u","title":"t"},7,{"url":"v"}]}'), ("bare", '[{"url":"u"}]'), ("broken", "{nope"), ("other", '"text"')):
        (tmp_path / f"{name}.json").write_text(body)
    counts = {n: feed_io.read_items(spark, str(tmp_path / f"{n}.json")).count() for n in ("feed", "bare", "broken", "other", "missing")}
    assert counts == {"feed": 2, "bare": 1, "broken": 0, "other": 0, "missing": 0}
    rows = items(spark, ("1", "u", "a", "2020", "x", "s"), ("2", "v", "b", "2021", None, "s")).withColumn("tags", F.lit(None).cast("array<string>"))
    envelope = feed_io.envelope(rows, "t", "h", "f")
    feed_io.write_feed(envelope, str(tmp_path / "dry"), dry_run=True)
    assert not (tmp_path / "dry").exists()
    feed_io.write_feed(envelope, str(tmp_path / "out"))
    back = feed_io.read_items(spark, str(tmp_path / "out")).orderBy("ord").collect()
    assert [(r.url, r.content_text, r.tags) for r in back] == [("u", "x", []), ("v", None, [])]


def test_api_entries(spark):
    body = '{"data":[{"slug":"a","name":" N ","attributes":{"text":"<p>one</p><p>two</p>"},"publishedAt":"bad"},{"title":"no link"},{"url":"https://o.example/b","content":" ","body":"x\\n\\n y"}]}'
    rows = spark.createDataFrame([(body,), ('[{"link":"/c"}]',), ("{broken",), (None,)], "body string").select(F.explode(api.entries(F.col("body"))).alias("e"))
    found = rows.select(api.link(F.col("e"), F.lit("https://h.example/api/x")).alias("url"), api.title(F.col("e")).alias("title"), api.text(api.raw_text(F.col("e"))).alias("text")).collect()
    assert [tuple(r) for r in found] == [("https://h.example/api/a", "N", "one\ntwo"), (None, "no link", None), ("https://o.example/b", None, "x\ny"), ("https://h.example/c", None, None)]


@pytest.mark.parametrize("length,least,kept", [(3, 3, 1), (2, 3, 0), (0, 0, 1), (0, None, 1)])
def test_word_gate(spark, length, least, kept):
    row = spark.createDataFrame([(" ".join("w" * length) or None, least)], "content_text string, min_words int")
    assert metrics.long_enough(row).count() == kept
