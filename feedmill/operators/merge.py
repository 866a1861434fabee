"""Merging new items into a feed, field by field."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedmill.functions.base import first_of, truthy
from feedmill.functions.text import is_rich
from feedmill.functions.urls import is_listing

#: Fields that a new item overwrites only with something, and items that a feed holds.
RICH, MAX_ITEMS = ("content_text", "content_html", "summary"), 2000
FIELDS = ("id", "url", "title", "date_published", "content_text", "content_html", "summary", "tags", "source")


def usable(items: DataFrame) -> DataFrame:
    """Items with an address that leads to an article."""
    return items.where(truthy(F.col("url")).isNotNull() & ~is_listing(F.col("url")))


def merge(existing: DataFrame, new: DataFrame, first_seen: DataFrame) -> DataFrame:
    """Existing items with new ones merged in, one row an address, and ``ord``: the place of existing items by their first
    occurrence (``side`` 0), then new addresses in order of arrival (``side`` 1).

    Both sides have ``ord`` and the fields of an item; rows without address and listing pages are left out. Of existing
    items of one address the last counts, at the first one's place; new ones are folded in one after another: a date that
    is only the moment the item was first seen gives way to one that is there, a field of text keeps its value against
    null and blank ones, everything else is overwritten, with null, too. Fields that only one side has are null on the
    other. The fold is worked out by aggregates that combine on the map side, so one address may hold any share of the
    rows.
    """
    fields = [f for f in FIELDS if f != "url" and (f in existing.columns or f in new.columns)]
    kinds = {f: next(x.schema[f].dataType for x in (existing, new) if f in x.columns) for f in fields}
    known = first_seen.groupBy(F.col("id").alias("_key")).agg(F.min("first_seen").alias("_seen"))

    def side(df: DataFrame, n: int) -> DataFrame:
        has = [F.col(f) if f in df.columns else F.lit(None).cast(kinds[f]).alias(f) for f in fields]
        return usable(df).select("url", *has, F.struct(F.lit(n).alias("side"), F.col("ord").cast("long").alias("ord")).alias("_at"))

    old = side(existing, 0)
    kept = old.groupBy("url").agg(F.max_by(F.struct(*fields), "_at").alias("x"), F.min("_at").alias("_at"), F.max_by("id", F.when(truthy(F.col("id")).isNotNull(), F.col("_at"))).alias("_old_id"))
    # the id that tells whether a date is a first sighting is the new item's, else the old one's
    ids = kept.select("url", "_old_id")
    rows = kept.select("url", "x.*", "_at").unionByName(side(new, 1)).join(ids, "url", "left").withColumn("_key", first_of(F.col("id"), F.col("_old_id"))).join(known, "_key", "left")
    dated = truthy(F.col("date_published")).isNotNull()
    rows = rows.withColumn("_guess", F.coalesce((F.col("_at.side") == 1) & dated & (F.col("_seen") == F.col("date_published")), F.lit(False)))
    at, rich = F.col("_at"), [f for f in RICH if f in fields]
    plain = [f for f in fields if f not in rich and f != "date_published"]
    found = rows.groupBy("url").agg(
        F.max_by(F.struct(*plain), at).alias("last"),
        F.min(at).alias("first"),
        *[F.coalesce(F.max_by(f, F.when(is_rich(F.col(f)), at)), F.min_by(f, at)).alias(f) for f in rich],
        F.max(F.when(~F.col("_guess"), at)).alias("_told"),
        F.max_by("date_published", F.when(~F.col("_guess"), at)).alias("_date"),
        F.min_by("date_published", at).alias("_start"),
        F.max(F.when(F.col("_guess"), at)).alias("_guessed"),
    )
    # a date that was erased is filled by the first sighting that comes after
    erased = found.where(F.col("_told").isNotNull() & truthy(F.col("_date")).isNull() & (F.col("_guessed") > F.col("_told"))).select("url", "_told")
    later = rows.where("_guess").select("url", "date_published", "_at").join(erased, "url").where(F.col("_at") > F.col("_told")).groupBy("url").agg(F.min_by("date_published", "_at").alias("_later"))
    date = F.when(F.col("_told").isNull(), F.col("_start")).otherwise(F.coalesce(F.col("_later"), F.col("_date")))
    values = {f: F.col(f) if f in rich else date if f == "date_published" else F.col(f"last.{f}") for f in fields}
    return found.join(later, "url", "left").select(F.col("first.side").alias("side"), F.col("first.ord").alias("ord"), "url", *[v.alias(f) for f, v in values.items()])


def newest(items: DataFrame, limit: int = MAX_ITEMS) -> DataFrame:
    """Items by date (as text) from the newest, equal ones in their order; the first ``limit`` of them, all for 0."""
    ranked = items.orderBy(F.coalesce("date_published", F.lit("")).desc(), "side", "ord", "url")
    return ranked.limit(limit) if limit else ranked
