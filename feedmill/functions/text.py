"""Text expressions: white space, words, titles."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from feedmill.functions.base import let, truthy

_SPACE = r"\s\u0085   -     　\x1c-\x1f"
_LINE_ENDS = r"\r\n|[\n\r\x0b\x0c\x1c-\x1e\u0085  ]"
#: Characters under which an article's text is too short to be trusted.
SHORT_TEXT = 160


def stripped(text: Column) -> Column:
    """Without white space of any kind at both ends."""
    return F.regexp_replace(text, f"^[{_SPACE}]+|[{_SPACE}]+$", "")


def collapsed(text: Column) -> Column:
    """Stripped, with one plain space for every run of white space."""
    return stripped(F.regexp_replace(text, f"[{_SPACE}]+", " "))


def tidy_lines(text: Column) -> Column:
    """Stripped lines without the empty ones; the empty text for null."""
    lines = F.filter(F.transform(F.split(F.coalesce(text, F.lit("")), _LINE_ENDS), stripped), lambda x: x != "")
    return F.array_join(lines, "\n")


def word_count(text: Column) -> Column:
    """Runs of letters, digits and underscores; 0 for null."""
    return F.coalesce(F.size(F.regexp_extract_all(text, F.lit(r"[\p{L}\p{N}_]+"), F.lit(0))), F.lit(0))


def without_title(text: Column, title: Column) -> Column:
    """The text without its title in front, in whatever case, and the dashes and colons that follow it.

    If the text only begins with a line that equals the title, that line goes. Null text gives the empty text.
    """

    def drop(head: Column, name: Column) -> Column:
        prefixed = F.lower(F.substring(head, F.lit(1), F.length(name))) == F.lower(name)
        rest = F.regexp_replace(F.substring(head, F.length(name) + 1, F.length(head)), f"^[{_SPACE}\\-–—:]*", "")
        first = F.regexp_extract(head, rf"^([^\n\r]*)", 1)
        lined = F.lower(collapsed(first)) == F.lower(name)
        return F.when(truthy(name).isNull(), head).when(prefixed, rest).when(lined, F.substring(head, F.length(first) + 1, F.length(head))).otherwise(head)

    start = F.regexp_replace(F.coalesce(text, F.lit("")), f"^[{_SPACE}]+", "")
    return stripped(let(F.struct(start.alias("head"), F.coalesce(collapsed(title), F.lit("")).alias("name")), lambda x: drop(x["head"], x["name"])))


def is_rich(value: Column) -> Column:
    """Neither null nor blank."""
    return F.coalesce(stripped(value) != "", F.lit(False))


def needs_fallback(content: Column, title: Column) -> Column:
    """Whether an extracted text is missing, no more than the title, or too short."""
    same = F.lower(collapsed(content)) == F.lower(collapsed(title))
    return truthy(content).isNull() | F.coalesce(same, F.lit(False)) | (F.length(content) < SHORT_TEXT)


def looks_like_html(text: Column) -> Column:
    return F.coalesce(text.contains("<") & text.contains(">") & text.rlike(r"<[a-zA-Z][^>]*>"), F.lit(False))
