"""Feeds and state as files: JSON feeds in and out, keyed state tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ITEM = "struct<id: string, url: string, title: string, date_published: string, content_text: string, tags: array<string>, source: string, content_html: string, summary: string>"
VERSION = "https://jsonfeed.org/version/1.1"


def feed_entries(body: Column) -> Column:
    """The entries of a feed's JSON, an envelope with items or a bare list, as variants; null if it is neither."""
    parsed = F.try_parse_json(body)
    kind = F.schema_of_variant(parsed)
    items = F.when(kind.startswith("OBJECT"), F.try_variant_get(parsed, "$.items", "array<variant>")).when(kind.startswith("ARRAY"), F.try_variant_get(parsed, "$", "array<variant>"))
    return items


def read_items(spark: SparkSession, path: str) -> DataFrame:
    """The items of a feed file with their place ``ord``; a missing, broken or foreign file gives none. Entries that are no
    objects are dropped."""
    try:
        files = spark.read.text(path, wholetext=True)
    except Exception:  # no such file
        return spark.createDataFrame([], f"ord int, item {ITEM}").select("ord", "item.*")
    entries = files.select(F.posexplode(feed_entries(F.col("value"))).alias("ord", "entry")).where(F.schema_of_variant("entry").startswith("OBJECT"))
    return entries.select("ord", F.from_json(F.to_json("entry"), ITEM).alias("item")).select("ord", "item.*")


def envelope(items: DataFrame, title: str, home_page_url: str, feed_url: str) -> DataFrame:
    """One row with a feed's JSON: the items in their order, each with the seven fields of a feed item. A feed is one
    document; its size is bounded by the number of items it may hold."""
    item = F.struct("id", "url", "title", "date_published", "content_text", F.coalesce("tags", F.array().cast("array<string>")).alias("tags"), "source")
    listed = F.transform(F.array_sort(F.collect_list(F.struct("ord", item.alias("item")))), lambda x: x["item"])
    feed = F.struct(F.lit(VERSION).alias("version"), F.lit(title).alias("title"), F.lit(home_page_url).alias("home_page_url"), F.lit(feed_url).alias("feed_url"), F.col("items"))
    return items.agg(listed.alias("items")).select(F.to_json(feed, {"ignoreNullFields": "false"}).alias("json"))


def write_feed(feed: DataFrame, path: str, dry_run: bool = False) -> None:
    """Writes a feed's JSON as text; a dry run writes nothing."""
    if not dry_run:
        feed.coalesce(1).write.mode("overwrite").text(path)


def upsert(state: DataFrame, fresh: DataFrame, keys: list[str]) -> DataFrame:
    """A keyed state table with newer rows in place of those of equal keys."""
    return state.join(fresh.select(*keys).distinct(), keys, "left_anti").unionByName(fresh)


def overlaid(base: Column, over: Column) -> Column:
    """A map with another's entries in place of its own of equal keys."""
    kept = F.map_filter(base, lambda k, v: ~F.map_contains_key(over, k))
    return F.map_concat(kept, over)
