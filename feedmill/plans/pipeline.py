"""One run over landed data: index pages to new articles to a merged feed (the engine's stages, without the network)."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedmill.functions import dates, html, urls
from feedmill.functions.base import first_of, truthy
from feedmill.functions.text import needs_fallback
from feedmill.operators import feed, links, merge, metrics, state
from feedmill.shared import cut, tables
from feedmill.sources import catalog, feed_io


def items_of(pages: DataFrame, sources: DataFrame, now: Column, amp: DataFrame | None = None) -> DataFrame:
    """The item that each landed article page (url, html, source) makes: id, title, date, text.

    A text that is missing, short or no more than the title gives way to what the fallback finds, if that finds any. A page
    without any text takes its AMP version's (url, html), if one was landed.
    """
    rows = pages.join(F.broadcast(sources.select(F.col("name").alias("source"), "content_selectors", "min_words")), "source")
    read = html.with_page(rows, selectors="content_selectors", wanted=frozenset(("title", "date_candidates", "content", "fallback", "amp_href")))
    title = first_of(F.col("page.title"), F.col("url"))
    content = F.when(needs_fallback(F.col("page.content"), title), F.coalesce(F.col("page.fallback"), F.col("page.content"))).otherwise(F.col("page.content"))
    second = F.coalesce(dates.first_date(F.col("page.date_candidates"), now), dates.url_date(F.col("url")))
    built = read.select("url", "source", "min_words", title.alias("title"), dates.home_form(second).alias("date_published"), content.alias("content_text"), F.col("page.amp_href").alias("amp_href"))
    if amp is not None:
        versions = html.with_page(amp.select(F.col("url").alias("amp_url"), F.col("html").alias("amp_html")).dropDuplicates(["amp_url"]), html="amp_html", wanted=frozenset(("content", "fallback")), out="amp")
        texts = versions.select("amp_url", F.coalesce("amp.content", "amp.fallback").alias("amp_text"))
        built = built.withColumn("amp_url", urls.amp_url(F.col("url"), F.col("amp_href"))).join(texts, "amp_url", "left").withColumn("content_text", F.coalesce(truthy(F.col("content_text")), F.col("amp_text")))
    empty = F.array().cast("array<string>")
    return built.select(urls.item_id(F.col("url")).alias("id"), "url", "title", "date_published", "content_text", empty.alias("tags"), "source", "min_words")


@dataclass
class Outcome:
    """What a run leaves behind; each is a table that the caller may keep."""

    feed: DataFrame
    first_seen: DataFrame
    seen: DataFrame
    new_items: int
    digests: DataFrame | None = None
    cooldowns: DataFrame | None = None


def index_pages(pages: DataFrame, chosen: DataFrame, cooldowns: DataFrame | None, cache: DataFrame | None, now: Column) -> DataFrame:
    """Landed pages with the html to use: fresh, or the latest cached copy where the page failed or is unchanged. The index
    page of a source that rests is taken from the cache alone, and is left out where that has none."""
    cached = cache if cache is not None else pages.select("url", "html", F.lit(None).cast("timestamp").alias("fetched_at")).limit(0)
    if cooldowns is not None:
        rests = state.routes(chosen.select("start_url"), cooldowns, cached, now).where("route <> 'live'").select(F.col("start_url").alias("url"), "route").distinct()
        pages = pages.join(F.broadcast(rests), "url", "left").where(F.coalesce(F.col("route") != "skip", F.lit(True)))
        rests = F.col("route").isNotNull()
        pages = pages.withColumns({"html": F.when(~rests, F.col("html")), "status": F.when(~rests, F.col("status"))}).drop("route")
    return state.served(pages, cached).where("origin <> 'none'").drop("origin")


def run_once(pages: DataFrame, sources: DataFrame, existing: DataFrame, first_seen: DataFrame, seen: DataFrame, now: Column, force: bool = False, limit: int = merge.MAX_ITEMS, names: list[str] | None = None, digests: DataFrame | None = None, cooldowns: DataFrame | None = None, cache: DataFrame | None = None, per_source: int | None = None) -> Outcome:
    """A run over landed pages (page_id, url, html, source, status).

    Index pages give links; those unseen that were landed as articles give items; items as long as their source asks are
    merged into ``existing`` (an item's fields and ``ord``). Without new items the feed stays as it is, or under ``force``
    is built anew. ``seen`` is (source, pos, url). Running again with what a run left gives no new items.

    Sources whose index page has the digest it had (``digests``: url, digest) give nothing, unless under ``force``; those
    that rest (``cooldowns``: start_url, until on Moscow's clock) are read from ``cache`` (url, html, fetched_at) or not at
    all; a page that failed gives way to its cached copy. ``per_source`` is how many unseen links of a source are followed,
    at most. Catalogue, digests of index pages and cooldowns are tables of the catalogue's size.
    """
    chosen = catalog.selected(catalog.with_defaults(sources), names)
    own = pages.join(F.broadcast(chosen.select(F.col("name").alias("source"), "start_url")), "source", "left_semi")
    good = index_pages(own, chosen, cooldowns, cache, now)
    starts = F.broadcast(chosen.select(F.col("start_url").alias("url")).where("url is not null").distinct())
    now_digests = good.join(starts, "url", "left_semi").groupBy("url").agg(F.max_by("html", "page_id").alias("html")).select("url", urls.digest(F.col("html")).alias("digest"))
    listed = good
    if digests is not None and not force:
        listed = good.join(F.broadcast(cut(now_digests.join(digests, ["url", "digest"], "left_semi").select("url"))), "url", "left_anti")
    landed = html.with_page(listed, wanted=frozenset(("links",)))
    found = landed.select("source", F.explode("page.links").alias("l"), "page_id").select("source", links.place(F.col("page_id"), F.col("l.pos")).alias("pos"), "l.href", "l.text")
    on_page = links.article_links(found, chosen)
    unseen = state.unseen(on_page, seen, force)
    fresh = cut(links.capped(unseen, F.lit(per_source), per_source) if per_source else unseen)
    articles = good.groupBy("source", "url").agg(F.max_by("html", "page_id").alias("html")).join(fresh.select("source", "url", "pos"), ["source", "url"])
    built = items_of(articles, chosen, now)
    stamp = dates.stamp(now)
    kept = cut(metrics.long_enough(state.dated(built, first_seen, stamp)).drop("min_words"))
    sightings = state.with_first_seen(first_seen, built, stamp)
    processed = articles.select("source", "url", "pos")
    window = state.seen_window(processed, seen, on_page)
    # a source that rests or did not change keeps what it had
    kept_digests = now_digests if digests is None else feed_io.upsert(digests, now_digests, ["url"])
    failed = own.where(F.col("status").isin(*state.SERVER_ERRORS)).join(starts, "url", "left_semi").select(F.col("url").alias("start_url"), (now + F.expr(f"INTERVAL {state.REST_HOURS} HOURS")).alias("until")).distinct()
    kept_cooldowns = failed if cooldowns is None else feed_io.upsert(cooldowns, failed, ["start_url"])
    count = kept.count()
    if not count:
        return Outcome(feed.built(existing) if force else existing, sightings, seen, 0, kept_digests, kept_cooldowns)
    arrived = kept.join(fresh.groupBy("url").agg(F.min("pos").alias("ord")), "url")
    merged = merge.merge(existing, arrived, sightings)
    return Outcome(feed.built(merge.newest(merged, limit).drop("side")), sightings, window, count, kept_digests, kept_cooldowns)


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feed after all items of the tables have arrived: dated by first sighting, merged by address, built, in order."""
    unified, first = tables(spark, sf_dir, "unified", "first_seen")
    items = state.dated(state.with_ids(unified), first, dates.stamp(F.lit("2025-07-01 12:00:00").cast("timestamp_ntz"))).withColumn("ord", F.col("item_no"))
    nothing = items.limit(0)
    merged = merge.merge(nothing, items, first)
    return feed.in_order(feed.built(merged.drop("side"))).select("id", "url", "title", "date_published", "content_text", "source")
