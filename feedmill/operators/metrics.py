"""Counts of a feed's quality and the gate on them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedmill.functions.text import is_rich, word_count
from feedmill.functions.urls import is_listing


def feed_metrics(items: DataFrame) -> DataFrame:
    """One row: items, those without text, those whose address is a listing page. No items give zeros."""
    return items.agg(F.count(F.lit(1)).alias("total"), F.count_if(~is_rich(F.col("content_text"))).alias("empty_content_text"), F.count_if(is_listing(F.col("url"))).alias("listing_urls_count"))


def gate(baseline: DataFrame, current: DataFrame) -> DataFrame:
    """(ok, message): whether as many items are left as the baseline had beside its listing pages. Both are single rows."""
    both = F.broadcast(baseline.select(F.struct("*").alias("b"))).crossJoin(current.select(F.struct("*").alias("c")))
    least = F.col("b.total") - F.col("b.listing_urls_count")
    ok = F.col("c.total") >= least
    return both.select(ok.alias("ok"), F.when(~ok, F.format_string("Feed dropped below %d items: %d", least, F.col("c.total"))).alias("message"))


def long_enough(items: DataFrame, words: str = "min_words") -> DataFrame:
    """Items with as many words as their source asks for; 0 and null ask for none."""
    least = F.coalesce(F.col(words), F.lit(0))
    return items.where((least <= 0) | (word_count(F.col("content_text")) >= least))


def source_summary(items: DataFrame, links: DataFrame) -> DataFrame:
    """Per source: kept items, those without text, too short ones, links left out as listing pages, items with API text.

    ``items`` has (source, content_text, min_words, api_text), ``links`` (source, reason). An item without text may count
    as too short, too; too short ones are not kept.
    """
    short = (F.coalesce("min_words", F.lit(0)) > 0) & (word_count(F.col("content_text")) < F.col("min_words"))
    by_item = items.groupBy("source").agg(F.count_if(~short).alias("total"), F.count_if(~is_rich(F.col("content_text"))).alias("no_text"), F.count_if(short).alias("short"), F.count_if("api_text").alias("api_text"))
    by_link = links.groupBy("source").agg(F.count_if(F.col("reason") == "listing").alias("listing_filtered"))
    counts = ("total", "no_text", "short", "listing_filtered", "api_text")
    return by_item.join(by_link, "source", "full_outer").select("source", *[F.coalesce(c, F.lit(0)).alias(c) for c in counts])
