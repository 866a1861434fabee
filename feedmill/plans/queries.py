"""The queries of the core, one for each operator, over whole tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedmill.functions import dates, html, text, urls
from feedmill.operators import feed, fetchlog, instants, links, merge, metrics, state
from feedmill.shared import tables
from feedmill.sources import api, catalog, feed_io
from feedmill.streaming import incremental

#: The clock of all queries.
NOW = "2025-07-01 12:00:00"
#: Item numbers that one payload spans.
PAYLOAD_ITEMS = 500


def _now() -> Column:
    return F.lit(NOW).cast("timestamp_ntz")


def unified(spark: SparkSession, sf_dir: str) -> DataFrame:
    (df,) = tables(spark, sf_dir, "unified")
    return df.withColumn("ord", F.col("item_no"))


def sources_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    (df,) = tables(spark, sf_dir, "sources")
    return catalog.with_defaults(df)


def halves(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The items of the earlier batches, as they stand in a feed, and those of the later ones, as they arrive."""
    items = unified(spark, sf_dir)
    last = F.broadcast(items.agg((F.max("batch_no") / 2).alias("_half")))
    both = items.crossJoin(last)
    return both.where(F.col("batch_no") <= F.col("_half")).drop("_half"), both.where(F.col("batch_no") > F.col("_half")).drop("_half")


def first_seen(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables(spark, sf_dir, "first_seen")[0]


def log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables(spark, sf_dir, "fetch_attempts")[0]


def p5_found(spark, d):
    items, sources = tables(spark, d, "unified", "sources")
    return instants.to_normalise(items, sources)


def p5_zones(spark, d):
    return instants.estimated_zones(tables(spark, d, "unified")[0])


def p5_unzoned(spark, d):
    """The rows of p5_found as they come out where no source's zone is known."""
    items, sources = tables(spark, d, "unified", "sources")
    return instants.to_normalise(items, sources.withColumn("time_zone", F.lit(None).cast("string")))


def url_parts(spark, d):
    return unified(spark, d).select("item_no", *[urls.part(F.col("url"), n).alias(c) for n, c in enumerate(("scheme", "host", "path", "query", "fragment"), 1)])


def url_segments(spark, d):
    return unified(spark, d).select("item_no", F.explode(urls.segments(urls.part(F.col("url"), 3))).alias("segment"))


def query_pairs(spark, d):
    return unified(spark, d).select("item_no", F.explode(urls.query_pairs(urls.part(F.col("url"), 4))).alias("x")).select("item_no", "x.key", "x.value")


def url_listing_rule(spark, d):
    return unified(spark, d).select("item_no", urls.listing_rule(F.col("url")).alias("rule"), urls.is_listing(F.col("url")).alias("listing"))


def url_listing_filter(spark, d):
    return merge.usable(unified(spark, d)).select("item_no", "url")


def cache_key(spark, d):
    return unified(spark, d).select("item_no", urls.cache_key(F.col("url")).alias("cache_key"), urls.with_suffix(urls.cache_key(F.col("url")), F.lit("-amp")).alias("amp_key"), urls.item_id(F.col("url")).alias("id"))


def amp_url(spark, d):
    pages = html.with_page(tables(spark, d, "pages")[0], wanted=frozenset(("amp_href",)))
    return pages.select("page_id", urls.amp_allowed(urls.part(F.col("url"), 2)).alias("allowed"), urls.amp_url(F.col("url"), F.col("page.amp_href")).alias("amp_url"))


def url_joined(spark, d):
    rows = unified(spark, d).select("item_no", "url", F.explode(F.array(*map(F.lit, ("/a/b?x=1", "c.html", "?page=2", "#top", "//m.example/z", "https://o.example/", "mailto:a@b.example")))).alias("href"))
    return rows.select("item_no", "href", urls.joined(F.col("url"), F.col("href")).alias("joined"))


def normalize_ws(spark, d):
    return unified(spark, d).select("item_no", text.tidy_lines(F.col("content_text")).alias("lines"), text.collapsed(F.col("title")).alias("title"))


def word_count(spark, d):
    return unified(spark, d).select("item_no", text.word_count(F.col("content_text")).alias("words"), text.looks_like_html(F.col("content_text")).alias("html"))


def min_words_filter(spark, d):
    items = unified(spark, d).join(F.broadcast(sources_of(spark, d).select(F.col("name").alias("source"), "min_words")), "source")
    return metrics.long_enough(items).select("item_no", "source")


def drop_leading_title(spark, d):
    return unified(spark, d).select("item_no", text.without_title(F.concat_ws(" — ", "title", "content_text"), F.col("title")).alias("rest"))


def needs_fallback(spark, d):
    return unified(spark, d).select("item_no", text.needs_fallback(F.col("content_text"), F.col("title")).alias("needed"), text.is_rich(F.col("content_text")).alias("rich"))


def dates_read(spark, d):
    v = F.col("date_published")
    return unified(spark, d).select("item_no", dates.iso_seconds(v).alias("iso"), dates.local_seconds(dates.russian_date(v)).alias("russian"), dates.local_seconds(dates.relative_date(v, _now())).alias("relative"), dates.any_date(v, _now()).alias("found"))


def ru_date_dotted(spark, d):
    """Times rendered day first and read again: the way back must lead to the minute they came from."""
    at = F.date_trunc("MINUTE", F.col("o_orderdate"))
    orders = tables(spark, d, "orders")[0].select("o_orderkey", F.date_format(at, "dd.MM.yyyy HH:mm").alias("value"))
    return orders.select("o_orderkey", F.date_format(dates.russian_date(F.col("value")), "yyyy-MM-dd HH:mm:ss").alias("local"))


def ru_date_words(spark, d):
    names = F.array(*map(F.lit, instants.MONTHS.strip().split("\n")[0].split()))
    rows = tables(spark, d, "events")[0].select("event_id", F.concat_ws(" ", F.date_format("ts", "d"), F.element_at(names, F.month("ts")), F.date_format("ts", "yyyy HH:mm")).alias("value"))
    return rows.select("event_id", F.date_format(dates.russian_date(F.col("value")), "yyyy-MM-dd HH:mm:ss").alias("local"))


def url_date(spark, d):
    return unified(spark, d).select("item_no", dates.url_date(F.col("url")).alias("utc_second"))


def home_time(spark, d):
    seconds = F.unix_seconds("fetched_at")
    return unified(spark, d).select("item_no", dates.home_form(seconds).alias("home_time"))


def page_parsed(spark, d):
    pages, sources = tables(spark, d, "pages", "sources")
    rows = pages.join(F.broadcast(sources.select(F.col("name").alias("source"), "content_selectors")), "source", "left")
    return html.with_page(rows, selectors="content_selectors")


def page_title(spark, d):
    return html.with_page(tables(spark, d, "pages")[0], wanted=frozenset(("title",))).select("page_id", "page.title")


def page_content(spark, d):
    return page_parsed(spark, d).select("page_id", "page.content", "page.fallback", F.array_join("page.date_candidates", "|").alias("dates"))


def fragment_text(spark, d):
    return tables(spark, d, "pages")[0].select("page_id", html.fragments_text(F.col("html")).alias("text"))


def landed_links(spark, d) -> DataFrame:
    pages = html.with_page(tables(spark, d, "pages")[0], wanted=frozenset(("links",)))
    return pages.select("page_id", "source", "url", F.explode("page.links").alias("l")).select("page_id", "source", F.col("url").alias("page_url"), links.place(F.col("page_id"), F.col("l.pos")).alias("pos"), "l.href", "l.text")


def page_links(spark, d):
    return landed_links(spark, d).select("page_id", "pos", "href", "text")


def link_reasons(spark, d):
    return links.resolved(landed_links(spark, d), sources_of(spark, d)).select("page_id", "pos", "url", links.reason().alias("reason"))


def article_links(spark, d):
    return links.article_links(landed_links(spark, d), sources_of(spark, d))


def new_links(spark, d):
    old, _ = halves(spark, d)
    return state.unseen(article_links(spark, d), old.select("source", "url"))


def seen_window(spark, d):
    old, new = halves(spark, d)
    columns = [F.col("source"), F.col("ord").alias("pos"), F.col("url")]
    return state.seen_window(new.select(*columns), old.select(*columns), new.select("source", "url"))


def missing_sources(spark, d):
    names = unified(spark, d).select(F.col("source").alias("name"))
    return catalog.missing_names(names, tables(spark, d, "mix_targets")[0].withColumnRenamed("source", "name"))


def request_strategies(spark, d):
    sources = tables(spark, d, "sources")[0].withColumn("ord", F.col("name"))
    found = catalog.strategies(sources)
    return found.select("host", "source", catalog.timeouts(F.col("strategy"))["connect"].alias("connect"), catalog.timeouts(F.col("strategy"))["read"].alias("read"), F.col("strategy.max_attempts").alias("max_attempts"))


def first_seen_fill(spark, d):
    return state.dated(state.with_ids(unified(spark, d)), first_seen(spark, d), F.lit("2025-07-01T12:00+03:00")).select("item_no", "id", "date_published")


def first_seen_after(spark, d):
    return state.with_first_seen(first_seen(spark, d), state.with_ids(unified(spark, d)), F.lit("2025-07-01T12:00+03:00"))


def index_changed(spark, d):
    pages = tables(spark, d, "pages")[0].where(F.col("html").isNotNull())
    bodies = pages.select(F.col("page_id").cast("string").alias("key"), F.col("html").alias("body"))
    before = pages.where("status < 400").groupBy("url").agg(F.min_by("html", "page_id").alias("html"), F.min("page_id").alias("page_id"))
    known = before.select(F.col("page_id").cast("string").alias("key"), urls.digest(F.col("html")).alias("digest"))
    return state.changed(bodies, known).select("key", "digest")


def cooldown_routes(spark, d):
    sources, pages = tables(spark, d, "sources", "pages")
    rest = state.cooldowns_after(log(spark, d).where("attempted_at is not null"))
    cached = pages.where(F.col("html").isNotNull()).select("url")
    return state.routes(sources, rest, cached, F.lit("2021-01-20 00:00:00").cast("timestamp")).select("name", "route")


def pages_served(spark, d):
    pages = tables(spark, d, "pages")[0]
    cache = pages.where("status = 200 and html is not null").select("url", "html", "fetched_at")
    return state.served(pages, cache).select("page_id", "origin", F.length("html").alias("size"))


def feed_dedup(spark, d):
    return feed.one_each(unified(spark, d)).select("ord", "url", "title", "date_published")


def feed_built(spark, d):
    return feed.built(unified(spark, d)).select("ord", "url", "date_published", "source")


def feed_skip_keywords(spark, d):
    return feed.built(unified(spark, d), skip="(?i)lorem|битум").select("ord", "url")


def feed_merged(spark, d):
    old, new = halves(spark, d)
    return merge.merge(old, new, first_seen(spark, d)).select("side", "ord", "url", "title", "date_published", "content_text", "source")


def feed_top(spark, d):
    old, new = halves(spark, d)
    return merge.newest(merge.merge(old, new, first_seen(spark, d))).select("url", "title", "date_published", "source")


def feed_metrics(spark, d):
    return metrics.feed_metrics(unified(spark, d))


def regression_gate(spark, d):
    old, _ = halves(spark, d)
    return metrics.gate(metrics.feed_metrics(old), metrics.feed_metrics(unified(spark, d)))


def source_summary(spark, d):
    items = unified(spark, d).join(F.broadcast(sources_of(spark, d).select(F.col("name").alias("source"), "min_words", (F.col("mode") == "api").alias("api_text"))), "source")
    return metrics.source_summary(items, links.resolved(landed_links(spark, d), sources_of(spark, d)).withColumn("reason", links.reason()))


def payloads(spark, d) -> DataFrame:
    """The items of each batch and source as JSON payloads of that source: pages of up to ``PAYLOAD_ITEMS`` items, so none
    grows with what a source has."""
    entry = F.struct(F.col("url").alias("link"), F.col("title").alias("name"), F.struct(F.col("content_text").alias("content")).alias("attributes"), F.col("date_published").alias("publishedAt"))
    rows = unified(spark, d).withColumn("block", F.expr(f"item_no div {PAYLOAD_ITEMS}")).groupBy("source", "batch_no", "block").agg(F.transform(F.array_sort(F.collect_list(F.struct("item_no", entry.alias("e")))), lambda x: x["e"]).alias("data"))
    return rows.select("source", "batch_no", "block", F.to_json(F.struct("data")).alias("body"))


def api_entries(spark, d):
    rows = payloads(spark, d).select("source", "batch_no", "block", F.posexplode(api.entries(F.col("body"))).alias("pos", "entry"))
    e = F.col("entry")
    return rows.select("source", "batch_no", "block", "pos", api.link(e, F.lit("https://base.example/")).alias("url"), api.title(e).alias("title"), api.iso_date(e).alias("iso_date"), F.length(api.raw_text(e)).alias("size"))


def api_links(spark, d):
    return api.api_links(payloads(spark, d).where("batch_no is not null"), sources_of(spark, d)).select("source", "url")


def json_feed_roundtrip(spark, d):
    built = feed.in_order(feed.built(unified(spark, d))).limit(merge.MAX_ITEMS)  # what a feed holds
    entries = feed_io.envelope(built, "feed", "https://home.example/", "https://home.example/feed.json").select(F.posexplode(feed_io.feed_entries(F.col("json"))).alias("ord", "entry"))
    item = F.from_json(F.to_json("entry"), feed_io.ITEM)
    return entries.select(item.alias("i")).select("i.url", "i.title", "i.date_published", "i.source")


def attempts_once(spark, d):
    return fetchlog.once(log(spark, d)).select("log_no", "host", "url", "phase", "attempt")


def retry_outcomes(spark, d):
    return fetchlog.outcomes(log(spark, d), catalog.strategies(tables(spark, d, "sources")[0].withColumn("ord", F.col("name"))))


def last_metric_per_host(spark, d):
    return fetchlog.last_metrics(log(spark, d))


def consecutive_failures(spark, d):
    return fetchlog.failing(log(spark, d)).select("host", "consecutive_failures")


def failure_islands(spark, d):
    return fetchlog.islands(log(spark, d))


def warmup_outcomes(spark, d):
    rows = fetchlog.once(log(spark, d)).where("phase = 'warmup'")
    return rows.select("log_no", "host", fetchlog.warmup_outcome(F.col("status"), F.col("cookie_names")).alias("outcome"), fetchlog.unreachable(F.col("error")).alias("unreachable"))


def backoff_waits(spark, d):
    return log(spark, d).select("log_no", fetchlog.wait_after(F.col("attempt")).alias("wait_s"))


def cookie_names(spark, d):
    rows = log(spark, d).where(F.col("cookie_names").isNotNull()).select("host", F.explode("cookie_names").alias("name"))
    return rows.distinct()


def _first_run(spark, d):
    """A run over all landed pages with nothing before it."""
    from feedmill.plans import pipeline

    pages, sources = tables(spark, d, "pages", "sources")
    nothing = unified(spark, d).select("ord", "id", "url", "title", "date_published", "content_text", "tags", "source").limit(0)
    seen = spark.createDataFrame([], "source string, pos long, url string")
    return pages, sources, pipeline.run_once(pages, sources, nothing, first_seen(spark, d), seen, _now())


def run_once(spark, d):
    return _first_run(spark, d)[2].feed.select("url", "title", "date_published", "source")


def run_twice(spark, d):
    """New items of a second run with what the first one left: none."""
    from feedmill.plans import pipeline

    pages, sources, first = _first_run(spark, d)
    second = pipeline.run_once(pages, sources, first.feed, first.first_seen, first.seen, _now(), digests=first.digests, cooldowns=first.cooldowns, cache=pages.select("url", "html", "fetched_at"))
    return spark.range(1).select(F.lit(second.new_items).cast("long").alias("new_items"))


def flagship(spark: SparkSession, d: str) -> DataFrame:
    """The feed of all items: dated, merged, in order."""
    from feedmill.plans import pipeline

    return pipeline.run(spark, d)


def stream_new_addresses(spark, d):
    return incremental.finished(incremental.new_addresses(incremental.landed(spark, f"{d}/unified.parquet").select("source", "url"))).select("source", "url")


def stream_first_seen(spark, d):
    found = incremental.first_sightings(incremental.landed(spark, f"{d}/unified.parquet").select("id", "fetched_at"))
    return incremental.finished(found, "complete").select("id", F.unix_seconds("first_seen").alias("first_seen"))


def stream_feed(spark, d):
    items = incremental.landed(spark, f"{d}/unified.parquet").withColumn("ord", F.col("item_no"))
    return incremental.feed_of(items, incremental.FeedTable(spark, first_seen(spark, d))).select("url", "title", "date_published", "source")


_NAMES = """
p5_found p5_zones p5_unzoned url_parts url_segments query_pairs url_listing_rule url_listing_filter cache_key amp_url url_joined normalize_ws word_count min_words_filter drop_leading_title needs_fallback dates_read ru_date_dotted
ru_date_words url_date home_time page_title page_content fragment_text page_links link_reasons article_links new_links seen_window missing_sources request_strategies first_seen_fill first_seen_after index_changed
cooldown_routes pages_served feed_dedup feed_built feed_skip_keywords feed_merged feed_top feed_metrics regression_gate source_summary api_entries api_links json_feed_roundtrip attempts_once retry_outcomes
last_metric_per_host consecutive_failures failure_islands warmup_outcomes backoff_waits cookie_names stream_new_addresses stream_first_seen stream_feed run_once run_twice flagship
"""
QUERIES = {name: globals()[name] for name in _NAMES.split()}
