"""Date expressions for single values: ISO, Russian and relative dates, addresses, the home form.

The clock is an argument. Values are read in the order ISO, day first, Russian words, relative, English months; a value
without a zone is on Moscow's clock.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from feedmill.functions.base import let, number_map, truthy
from feedmill.functions.text import collapsed
from feedmill.operators.instants import FIRST_YEAR, HOME_ZONE, LAST_YEAR, home_form, parts, resolved, seconds_of, to_utc

#: Russian month names as they stand in dates: fixed values.
RU_MONTHS = {
    "января": 1, "февраля": 2, "марта": 3, "апреля": 4, "мая": 5, "июня": 6, "июля": 7, "августа": 8, "сентября": 9, "октября": 10, "ноября": 11, "декабря": 12,
    "янв": 1, "фев": 2, "мар": 3, "апр": 4, "май": 5, "июн": 6, "июл": 7, "авг": 8, "сен": 9, "сент": 9, "окт": 10, "ноя": 11, "дек": 12,
}



def _form(month: str, year: str, between: str, to_clock: str) -> str:
    """A pattern of day, month, year and perhaps a clock: groups 1 to 3, then hour and minute."""
    return rf"(\d{{1,2}}){between}{month}{between}{year}(?:{to_clock}(\d{{1,2}}):(\d{{2}}))?"


_DOTTED, _SHORT = (_form(r"(\d{1,2})", year, r"\.", "[T ]") for year in (r"(\d{4})", r"(\d{2})"))
_WORDED = "(?iu)" + _form("([а-яё]+)", r"(\d{4})", r"\s+", "[, ]")
#: How an address names a day: a fixed value.
_URL_DATE = r"/(20\d{2})/([01]\d)/([0-3]\d)/"


def clamped(local: Column) -> Column:
    """A time within the years that dates are believed in, else null."""
    return F.when(F.year(local).between(FIRST_YEAR, LAST_YEAR), local)


def _made(text: Column, pattern: str, year: Column, month: Column) -> Column:
    group = lambda n: F.regexp_extract(text, pattern, n).try_cast("int")
    return F.try_make_timestamp_ntz(year, month, group(1), F.coalesce(group(4), F.lit(0)), F.coalesce(group(5), F.lit(0)), F.lit(0))


def russian_date(value: Column) -> Column:
    """The local time of a Russian date: d.m.yyyy, else d month yyyy, else d.m.yy; null if what matches first is none.

    A time follows after one space (or a T after digits; a space or comma after words): after ", " it is not seen.
    """

    def read(s: Column) -> Column:
        month = F.element_at(number_map(RU_MONTHS), F.lower(F.regexp_extract(s, _WORDED, 2)))
        group = lambda p, n: F.regexp_extract(s, p, n).try_cast("int")
        return (
            F.when(s.rlike(_DOTTED), _made(s, _DOTTED, group(_DOTTED, 3), group(_DOTTED, 2)))
            .when(s.rlike(_WORDED) & month.isNotNull(), _made(s, _WORDED, group(_WORDED, 3), month))
            .when(s.rlike(_SHORT), _made(s, _SHORT, group(_SHORT, 3) + 2000, group(_SHORT, 2)))
        )

    return clamped(let(collapsed(value), read))


def iso_seconds(value: Column) -> Column:
    """Seconds since 1970 of an ISO date (a year, month or day will do), on Moscow's clock where it names no zone."""
    shape = r"^\d{4}(?:-?\d{2}(?:-?\d{2}(?:[T ]\d{2}(?::?\d{2}(?::?\d{2}(?:[.,]\d+)?)?)?(?:[Zz]|[+-]\d{2}(?::?\d{2})?)?)?)?)?$"
    whole = F.when(value.rlike(r"^\d{4}$"), F.concat(value, F.lit("-01-01"))).when(value.rlike(r"^\d{4}-\d{2}$"), F.concat(value, F.lit("-01"))).otherwise(value)
    return F.when(value.rlike(shape), _instant(whole, F.lit(None).cast("timestamp_ntz")))


def _instant(value: Column, now: Column) -> Column:
    clock = F.lit(HOME_ZONE)
    return let(parts(value, now, clock), lambda p: resolved(p, clock))


def relative_date(value: Column, now: Column) -> Column:
    """The local time of "today" or "yesterday" with an hour, noon without one; ``now`` is Moscow's local time."""

    def read(s: Column) -> Column:
        days = F.when(s.rlike("сегодня|today"), 0).when(s.rlike("вчера|yesterday"), 1)
        at = F.regexp_extract(s, r"(\d{1,2}):(\d{2})", 0)
        hour, minute = (F.regexp_extract(s, r"(\d{1,2}):(\d{2})", n).try_cast("int") for n in (1, 2))
        day = F.date_sub(F.to_date(now), days)
        return F.try_make_timestamp_ntz(F.year(day), F.month(day), F.day(day), F.when(at == "", 12).otherwise(hour), F.when(at == "", 0).otherwise(minute), F.lit(0))

    return let(F.lower(value), read)


def local_seconds(local: Column) -> Column:
    """Seconds since 1970 of a local time on Moscow's clock."""
    return seconds_of(to_utc(local, F.lit(HOME_ZONE)))


def any_date(value: Column, now: Column) -> Column:
    """Seconds since 1970 of whatever form a value has; null if it has none or lies beyond the years believed in."""
    utc_now = to_utc(now, F.lit(HOME_ZONE))
    found = F.coalesce(iso_seconds(value), local_seconds(russian_date(value)), _instant(value, utc_now), local_seconds(relative_date(value, now)))
    return let(found, lambda x: F.when(F.year(F.timestamp_seconds(x)).between(FIRST_YEAR, LAST_YEAR), x))


def first_date(candidates: Column, now: Column) -> Column:
    """Seconds since 1970 of the first candidate of an array that is a date."""
    return F.get(F.filter(F.transform(candidates, lambda x: any_date(x, now)), lambda x: x.isNotNull()), F.lit(0))


def url_date(url: Column) -> Column:
    """The day that an address names as /yyyy/mm/dd/, in seconds since 1970 of its start in Moscow."""
    group = lambda n: F.regexp_extract(url, _URL_DATE, n).try_cast("int")
    return local_seconds(clamped(F.try_make_timestamp_ntz(group(1), group(2), group(3), F.lit(0), F.lit(0), F.lit(0))))


def stamp(now: Column) -> Column:
    """``now`` (Moscow's local time) in the home form, to the minute."""
    return home_form(local_seconds(F.date_trunc("MINUTE", now).cast("timestamp_ntz")))


def api_date(iso: Column, russian: Column, built: Column, now: Column) -> Column:
    """An API entry's date in the home form: its ISO value, which if it is bad keeps ``built``; else its Russian value."""
    by_iso, by_words = home_form(iso_seconds(iso)), home_form(any_date(russian, now))
    return F.when(truthy(iso).isNotNull(), F.coalesce(by_iso, built)).when(truthy(russian).isNotNull(), F.coalesce(by_words, built)).otherwise(built)
