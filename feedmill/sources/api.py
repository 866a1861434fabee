"""JSON sources: entries, links, texts, titles, dates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedmill.functions.base import first_of, truthy
from feedmill.functions.html import fragments_text
from feedmill.functions.text import looks_like_html, stripped, tidy_lines
from feedmill.functions.urls import is_listing, joined

#: Fields that may hold an entry's text, in order: fixed values.
TEXT_KEYS = ("content", "text", "body", "content_html", "text_html", "fullText", "full_text", "contentHtml", "html", "description")
DATE_KEYS = ("publishedAt", "publishDate", "publish_date")


def entries(payload: Column) -> Column:
    """The entries of a payload, in a data field or a bare list, as variants."""
    parsed = F.try_parse_json(payload)
    return F.coalesce(F.try_variant_get(parsed, "$.data", "array<variant>"), F.try_variant_get(parsed, "$", "array<variant>"))


def field(entry: Column, *names: str) -> Column:
    """The first of the named fields that is neither null nor empty, as text."""
    return first_of(*[F.try_variant_get(entry, f"$.{n}", "string") for n in names])


def link(entry: Column, base: Column) -> Column:
    """An entry's address against its source's base; null without one."""
    href = field(entry, "link", "url", "slug")
    return F.when(href.isNotNull(), joined(base, href))


def title(entry: Column) -> Column:
    return stripped(field(entry, "name", "title"))


def raw_text(entry: Column) -> Column:
    """The first text an entry or its attributes hold that is not blank."""
    found = [F.when(F.schema_of_variant(F.try_variant_get(entry, f"{prefix}{k}", "variant")) == "STRING", stripped(F.try_variant_get(entry, f"{prefix}{k}", "string"))) for prefix in ("$.", "$.attributes.") for k in TEXT_KEYS]
    return first_of(*found)


def text(raw: Column) -> Column:
    """A raw text as lines; markup is read as a fragment."""
    return truthy(F.when(looks_like_html(raw), fragments_text(F.when(looks_like_html(raw), raw))).otherwise(tidy_lines(raw)))


def iso_date(entry: Column) -> Column:
    return field(entry, *DATE_KEYS)


def api_links(payloads: DataFrame, sources: DataFrame) -> DataFrame:
    """(source, pos, url, raw_text, title, iso_date, ru_date): the entries of landed payloads (source, body) in order.

    Entries without address and listing pages are left out; of an address met twice the first entry counts; each source
    gives at most its ``max_links`` first ones. Payloads that are no JSON give none.
    """
    from feedmill.operators.links import capped, most_links

    rows = payloads.join(F.broadcast(sources.select(F.col("name").alias("source"), "base_url", "max_links")), "source")
    rows = rows.select("source", "base_url", "max_links", F.posexplode(entries(F.col("body"))).alias("pos", "entry"))
    found = rows.select("source", "max_links", "pos", link(F.col("entry"), F.col("base_url")).alias("url"), raw_text(F.col("entry")).alias("raw_text"), title(F.col("entry")).alias("title"), iso_date(F.col("entry")).alias("iso_date"), field(F.col("entry"), "publishDateRus").alias("ru_date"))
    kept = found.where(F.col("url").isNotNull() & ~is_listing(F.col("url")))
    fields = ["raw_text", "title", "iso_date", "ru_date", "max_links"]
    first = kept.groupBy("source", "url").agg(F.min_by(F.struct(*fields), "pos").alias("x"), F.min("pos").alias("pos"))
    return capped(first.select("source", "url", "pos", "x.*"), F.col("max_links"), most_links(sources)).drop("max_links")
