"""Building blocks of Column expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, use) -> Column:
    """``use`` of a value that is worked out once, however often ``use`` refers to it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def truthy(value: Column) -> Column:
    """The value, or null where it is the empty text."""
    return F.nullif(value, F.lit(""))


def first_of(*values: Column) -> Column:
    """The first value that is neither null nor empty."""
    return F.coalesce(*map(truthy, values))


def any_of(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions, F.lit(False))


def number_map(pairs: dict) -> Column:
    return F.create_map(*[F.lit(x) for kv in pairs.items() for x in kv])
