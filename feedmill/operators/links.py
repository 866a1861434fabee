"""Links of landed index pages: rules of their source, first occurrence, caps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedmill.functions.urls import is_listing, joined, same_domain


def place(page: Column, pos: Column) -> Column:
    """Where a link stands among those of all pages: page by page (numbers below 2^39), up to 2^24 links on each."""
    return F.shiftleft(page.cast("long"), 24) + pos


def resolved(links: DataFrame, sources: DataFrame) -> DataFrame:
    """Links (source, pos, href, text) with their source's rules and the address that ``href`` leads to.

    The catalogue is a table of fixed size. Links without address, or of an unknown source, are left out.
    """
    rules = sources.select(F.col("name").alias("source"), "base_url", "include_patterns", "include_regex", "exclude_regex", "link_min_text_len", "accept_empty_anchor", "restrict_domain", "max_links")
    rows = links.where(F.col("href").isNotNull() & (F.col("href") != "")).join(F.broadcast(rules), "source")
    return rows.withColumn("url", joined(F.col("base_url"), F.col("href")))


def reason() -> Column:
    """Why a resolved link is left out, in the order that the rules hold: listing, domain, pattern, include, exclude, text;
    null if it stays. A rule list that is empty holds for nothing."""
    url = F.col("url")
    named = lambda rules, test: F.exists(rules, test)
    return (
        F.when(is_listing(url), "listing")
        .when(F.col("restrict_domain") & ~same_domain(url, F.col("base_url")), "domain")
        .when((F.size("include_patterns") > 0) & ~named("include_patterns", lambda p: F.contains(url, p)), "pattern")
        .when((F.size("include_regex") > 0) & ~named("include_regex", lambda p: F.rlike(url, p)), "include")
        .when((F.size("exclude_regex") > 0) & named("exclude_regex", lambda p: F.rlike(url, p)), "exclude")
        .when((F.length(F.coalesce("text", F.lit(""))) < F.col("link_min_text_len")) & ~F.col("accept_empty_anchor"), "text")
    )


def first_occurrences(links: DataFrame) -> DataFrame:
    """Each source's addresses once, at the place of their first occurrence."""
    return links.groupBy("source", "url").agg(F.min("pos").alias("pos"), F.first("max_links").alias("max_links"))


def capped(links: DataFrame, limit: Column, most: int) -> DataFrame:
    """Each source's first links up to a limit, in order of ``pos``.

    No limit is above ``most``: so many rows of a source, at most, leave a task, whatever share of the links it has.
    """
    numbered = links.withColumn("_n", F.row_number().over(Window.partitionBy("source").orderBy("pos", "url")))
    return numbered.where((F.col("_n") <= F.lit(most)) & (F.col("_n") <= limit)).drop("_n")


def most_links(sources: DataFrame) -> int:
    """The largest limit of a catalogue, which is a table of fixed size."""
    return sources.agg(F.max("max_links")).first()[0] or 0


def article_links(links: DataFrame, sources: DataFrame) -> DataFrame:
    """(source, url, pos) of the article addresses on landed index pages: by their source's rules, each once, capped."""
    kept = resolved(links, sources).withColumn("_why", reason()).where(F.col("_why").isNull())
    return capped(first_occurrences(kept), F.col("max_links"), most_links(sources)).select("source", "url", "pos")
