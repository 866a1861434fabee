"""What one run leaves to the next: seen addresses, first sightings, digests, cooldowns, cached pages (J1, J3, J5, J8, J10,
J11, W3, F17, U1, U2, S6, S12-S14, S16, S35, ST1-ST7)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedmill.functions.base import truthy
from feedmill.functions.urls import digest, item_id

#: Seen addresses a source keeps; hours that a source rests after a server error; seconds to wait without Retry-After.
SEEN_WINDOW, REST_HOURS, RETRY_AFTER = 500, 6, 5
SERVER_ERRORS = (500, 502, 503, 504)


def unseen(links: DataFrame, seen: DataFrame, force: bool = False) -> DataFrame:
    """Links whose address their source hasn't seen; all of them under ``force``."""
    return links if force else links.join(seen.select("source", "url"), ["source", "url"], "left_anti")


def seen_window(processed: DataFrame, seen: DataFrame, page: DataFrame, size: int = SEEN_WINDOW) -> DataFrame:
    """(source, pos, url): what was processed, then what was seen before and still stands on the page; the first ``size``.

    ``processed`` and ``seen`` are (source, pos, url), ``page`` (source, url). Addresses may come twice.
    """
    tail = seen.join(page.select("source", "url").distinct(), ["source", "url"], "left_semi")
    both = processed.select("source", "url", "pos", F.lit(0).alias("side")).unionByName(tail.select("source", "url", "pos", F.lit(1).alias("side")))
    order = F.row_number().over(Window.partitionBy("source").orderBy("side", "pos", "url"))
    return both.withColumn("_n", order).where(F.col("_n") <= size).select("source", (F.col("_n") - 1).alias("pos"), "url")


def changed(bodies: DataFrame, digests: DataFrame, force: bool = False) -> DataFrame:
    """Bodies (key, body) whose digest is not the one remembered (key, digest); all of them under ``force``."""
    fresh = bodies.withColumn("digest", digest(F.col("body")))
    return fresh if force else fresh.join(digests, ["key", "digest"], "left_anti")


def dated(items: DataFrame, first_seen: DataFrame, stamp: Column) -> DataFrame:
    """Items with a date: their own, else the moment their id was first seen, else ``stamp``."""
    known = first_seen.groupBy("id").agg(F.min("first_seen").alias("_first"))
    return items.join(known, "id", "left").withColumn("date_published", F.coalesce(truthy(F.col("date_published")), F.col("_first"), stamp)).drop("_first")


def with_first_seen(first_seen: DataFrame, items: DataFrame, stamp: Column) -> DataFrame:
    """The first sightings, with new ids of undated items at ``stamp``; what is there never changes."""
    new = items.where(truthy(F.col("date_published")).isNull() & F.col("id").isNotNull()).select("id").distinct().join(first_seen, "id", "left_anti")
    return first_seen.select("id", "first_seen").unionByName(new.select("id", stamp.alias("first_seen")))


def routes(sources: DataFrame, cooldowns: DataFrame, cached: DataFrame, now: Column) -> DataFrame:
    """Sources with ``route``: live; while their cooldown (start_url, until) lasts cache_only if their index page is cached
    (url), else skip."""
    rest = cooldowns.groupBy("start_url").agg(F.max("until").alias("_until"))
    at_hand = cached.select(F.col("url").alias("start_url")).distinct().withColumn("_cached", F.lit(True))
    joined = sources.join(rest, "start_url", "left").join(at_hand, "start_url", "left")
    route = F.when(F.coalesce(F.col("_until") > now, F.lit(False)), F.when(F.col("_cached"), "cache_only").otherwise("skip")).otherwise("live")
    return joined.withColumn("route", route).drop("_until", "_cached")


def cooldowns_after(attempts: DataFrame) -> DataFrame:
    """(start_url, until): sources whose index page failed on the server's side rest for a while."""
    failed = attempts.where(F.col("status").isin(*SERVER_ERRORS))
    return failed.groupBy(F.col("url").alias("start_url")).agg((F.max("attempted_at") + F.expr(f"INTERVAL {REST_HOURS} HOURS")).alias("until"))


def served(pages: DataFrame, cache: DataFrame) -> DataFrame:
    """Pages (url, status, html) with the html to use and where it is from: fresh, or the latest cached copy (url, html,
    fetched_at) when the page has not changed, the server failed or nothing was landed; null and "none" without a copy. Of
    copies of one moment the greatest counts, those without one come before all others."""
    copies = cache.where(F.col("html").isNotNull()).groupBy("url").agg(F.max(F.struct("fetched_at", "html")).alias("_last")).select("url", F.col("_last.html").alias("_copy"))
    joined = pages.join(copies, "url", "left")
    good = F.coalesce((F.col("status") < 400) & (F.col("status") != 304), F.lit(False)) & F.col("html").isNotNull()
    origin = F.when(good, "fresh").when(F.col("_copy").isNotNull() & (F.col("status").isNull() | (F.col("status") == 304) | F.col("status").isin(*SERVER_ERRORS)), "cached").otherwise("none")
    return joined.withColumn("origin", origin).withColumn("html", F.when(origin == "fresh", F.col("html")).when(origin == "cached", F.col("_copy"))).drop("_copy")


def headers_after(state: DataFrame, responses: DataFrame) -> DataFrame:
    """(url, etag, last_modified): what the last response of each address said, though it said nothing; older ones else."""
    last = responses.groupBy("url").agg(F.max_by(F.struct("etag", "last_modified"), "fetched_at").alias("h")).select("url", "h.*")
    return state.join(last, "url", "left_anti").unionByName(last)


def retry_after(value: Column) -> Column:
    """Seconds to wait after being turned away."""
    return F.coalesce(F.trim(value).try_cast("int"), F.lit(RETRY_AFTER))


def with_ids(items: DataFrame) -> DataFrame:
    return items.withColumn("id", F.coalesce(truthy(F.col("id")), item_id(F.col("url"))))
