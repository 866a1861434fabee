"""Building a feed of items: one of each address, dated, in order."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedmill.functions.base import truthy


def one_each(items: DataFrame) -> DataFrame:
    """The first item of each address, or the first dated one if that has no date; ``ord`` is the first one's place."""
    undated = truthy(F.col("date_published")).isNull()
    fields = [c for c in items.columns if c != "ord"]
    best = items.groupBy("url").agg(F.min_by(F.struct(*[f for f in fields if f != "url"]), F.struct(undated.cast("int"), F.col("ord"))).alias("x"), F.min("ord").alias("ord"))
    return best.select("url", "x.*", "ord")


def built(items: DataFrame, skip: str | None = None) -> DataFrame:
    """A feed's items: one of each address, those with a date, without those whose title or address ``skip`` matches."""
    kept = one_each(items).where(truthy(F.col("date_published")).isNotNull())
    if skip:
        kept = kept.where(~(F.coalesce(F.col("title").rlike(skip), F.lit(False)) | F.coalesce(F.col("url").rlike(skip), F.lit(False))))
    return kept


def in_order(items: DataFrame) -> DataFrame:
    """From the newest date, compared as text; equal ones in their order."""
    return items.orderBy(F.col("date_published").desc(), "ord", "url")
