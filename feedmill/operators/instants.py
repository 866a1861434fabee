"""Problem 5: publication times in many formats and zones, brought to one unambiguous form.

Everything is a Column expression. A value is rewritten to its parts by the first format that matches as a whole; what
the parts name is an instant if they name a zone, and a local time of the source's clock otherwise. A source without a
known zone gets the one whose offset history contradicts its ingestion times least (``estimated_zones``).
"""

from __future__ import annotations

from functools import reduce
from zoneinfo import available_timezones

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedmill.functions.base import let, number_map
from feedmill.shared import small_side, unused, written

HOME_ZONE = "Europe/Moscow"
FIRST_YEAR, LAST_YEAR = 2000, 2035
#: Zones that are tried for a source whose zone is not known.
CANDIDATE_ZONES = ("UTC", "Europe/London", "Europe/Berlin", "Europe/Minsk", "Europe/Moscow", "Europe/Samara", "Asia/Yekaterinburg", "Asia/Omsk", "Asia/Krasnoyarsk", "Asia/Irkutsk", "Asia/Yakutsk", "Asia/Vladivostok", "Asia/Kamchatka", "Asia/Kolkata", "America/New_York")

#: Month names: fixed values, January to December.
MONTHS = """
января февраля марта апреля мая июня июля августа сентября октября ноября декабря
январь февраль март апрель май июнь июль август сентябрь октябрь ноябрь декабрь
янв фев мар апр мая июн июл авг сен окт ноя дек
янв фев март апр май июнь июль авг сент окт нояб дек
января февр марта апр мая июня июля авг сент окт ноябр декабр
january february march april may june july august september october november december
jan feb mar apr may jun jul aug sep oct nov dec
jan feb mar apr may june july aug sept oct nov dec
januar februar märz april mai juni juli august september oktober november dezember
jan feb mär apr mai jun jul aug sep okt nov dez
jänner februar mrz april mai juni juli august sept oktober november dezember
студзеня лютага сакавіка красавіка мая чэрвеня ліпеня жніўня верасня кастрычніка лістапада снежня
студзень люты сакавік красавік травень чэрвень ліпень жнівень верасень кастрычнік лістапад снежань
студ лют сак крас мая чэр ліп жні вер кас ліс сне
"""
#: Days told from the day of reading: fixed values, days back and words.
RELATIVE_DAYS = {0: "сегодня today heute сёння сення", 1: "вчера yesterday gestern учора", 2: "позавчера vorgestern пазаўчора"}
#: Zone abbreviations: fixed values, hours from UTC. MSK is Moscow's clock, whatever its offset was.
ABBREVIATIONS = {"z": 0, "ut": 0, "utc": 0, "gmt": 0, "wet": 0, "cet": 1, "bst": 1, "mez": 1, "west": 1, "cest": 2, "mesz": 2, "eet": 2, "eest": 3, "msd": 4, "samt": 4, "yekt": 5, "omst": 6, "krat": 7, "irkt": 8, "yakt": 9, "vlat": 10, "est": -5, "edt": -4, "cst": -6, "cdt": -5, "pst": -8, "pdt": -7}

_ZONE = r"([a-z]{1,4}(?![a-z/])|(?:utc|gmt)?[+-]\d{1,2}(?::?\d{2})?)?"
_TIME = r"(\d{1,2}):(\d{2})(?::(\d{2})(?:[.,]\d+)?)?(?: ?([ap])\.?m\.?)?"
_AT = r"(?:,? (?:в|at|um|у|о)|,)? ?"
_YEAR_WORD = r"(?: ?(?:года|год|г)\.?)?"
_NAME = r"([a-zа-яёіўä]+)\.?"
_DAY_NAME = r"(?:[a-zа-яёіўä]+\.?,? )?"
#: Formats: a pattern over the whole value (small letters, single spaces) and where year, month, day, hour, minute, second,
#: am or pm and zone stand in it.
FORMATS = (
    (rf"^(\d{{4}})[-./](\d{{1,2}})[-./](\d{{1,2}})(?:(?:t| t?|,){_AT}{_TIME} ?{_ZONE}(?: ?\[[^\]]*\])?(?: ?\([^)]*\))?)?$", "12345678"),
    (rf"^(\d{{4}})(\d{{2}})(\d{{2}})(?:[t ]?(\d{{2}}):?(\d{{2}}):?(\d{{2}})?(?:[.,]\d+)?() ?{_ZONE})?$", "12345678"),
    (rf"^(\d{{1,2}})[./-](\d{{1,2}})[./-](\d{{4}}|\d{{2}}){_YEAR_WORD}(?:{_AT}{_TIME} ?{_ZONE})?$", "32145678"),
    (rf"^{_TIME} ?{_ZONE},? (\d{{1,2}})[./-](\d{{1,2}})[./-](\d{{4}}|\d{{2}}){_YEAR_WORD}$", "87612345"),
    (rf"^{_DAY_NAME}(\d{{1,2}})(?:st|nd|rd|th|-го)?\.? {_NAME},? (\d{{4}}){_YEAR_WORD}(?:{_AT}{_TIME} ?{_ZONE}(?: ?\([^)]*\))?)?$", "32145678"),
    (rf"^{_TIME} ?{_ZONE},? (\d{{1,2}})\.? {_NAME},? (\d{{4}}){_YEAR_WORD}$", "87612345"),
    (rf"^{_DAY_NAME}{_NAME} (\d{{1,2}})(?:st|nd|rd|th)?,? (\d{{4}})(?:{_AT}{_TIME} ?{_ZONE})?$", "31245678"),
    (rf"^{_DAY_NAME}{_NAME} (\d{{1,2}}) {_TIME} ?{_ZONE} (\d{{4}})$", "81234567"),
)
_RELATIVE = rf"^({'|'.join(w for x in RELATIVE_DAYS.values() for w in x.split())})(?:{_AT}{_TIME})?$"


def _months() -> Column:
    return number_map({name: i for line in MONTHS.strip().split("\n") for i, name in enumerate(line.split(), 1)})


def tidy(value: Column) -> Column:
    """Small letters, single plain spaces, no label before the value."""
    plain = F.trim(F.regexp_replace(F.lower(value), r"[\s\u00a0\u2007\u2009\u202f]+", " "))
    return F.regexp_replace(plain, r"^[^\d:]*[^\d:\s][^\d:]*: (?=\S)", "")


def to_utc(local: Column, zone: Column) -> Column:
    """A local time as UTC: the first of two, and in a gap the offset before the change."""
    return F.convert_timezone(zone, F.lit("UTC"), local)


def seconds_of(utc: Column) -> Column:
    return F.timestamp_diff("SECOND", F.expr("timestamp_ntz'1970-01-01 00:00:00'"), utc)


def known_zone(zone: Column) -> Column:
    """The zone if it is one of the time zone database, else null."""
    return F.when(zone.isin(sorted(available_timezones())), zone)


def parts(value: Column, read_at: Column, zone: Column) -> Column:
    """What a value says, as a struct: ``local`` (time without zone), ``offset`` (seconds from UTC or null), ``moscow``
    (the clock is Moscow's) and ``instant`` (seconds since 1970 for values that count them).

    ``read_at`` is the UTC time without zone at which the value was read, ``zone`` the clock that "today" refers to.
    """
    days = number_map({w: n for n, x in RELATIVE_DAYS.items() for w in x.split()})
    fixed = number_map({k: v * 3600 for k, v in ABBREVIATIONS.items()})

    def cells(s: Column) -> Column:
        by_format = reduce(lambda rest, x: F.when(s.rlike(x[0]), F.regexp_replace(s, x[0], "|".join(f"${n}" for n in x[1]))).otherwise(rest), reversed(FORMATS), F.lit(None).cast("string"))
        today = F.to_date(F.convert_timezone(F.lit("UTC"), zone, read_at))
        day = F.date_sub(today, F.coalesce(F.element_at(days, F.regexp_extract(s, _RELATIVE, 1)), F.lit(0)))
        relative = F.when(s.rlike(_RELATIVE), F.concat_ws("|", F.date_format(day, "yyyy|MM|dd"), F.regexp_replace(s, _RELATIVE, "$2|$3|$4|$5|")))
        return F.transform(F.split(F.coalesce(relative, by_format), r"\|"), lambda x: F.nullif(x, F.lit("")))

    def from_cells(s: Column, cell: Column) -> Column:
        text = lambda k: F.get(cell, F.lit(k))
        number = lambda k: text(k).try_cast("int")
        year = F.when(F.length(text(0)) == 2, number(0) + 2000).otherwise(number(0))
        month = F.coalesce(number(1), F.element_at(_months(), text(1)))
        hour = F.coalesce(number(3), F.lit(0))
        hour = F.when(text(6).isNull(), hour).when(hour.between(1, 12), hour % 12 + F.when(text(6) == "p", 12).otherwise(0))
        local = F.try_make_timestamp_ntz(year, month, number(2), hour, F.coalesce(number(4), F.lit(0)), F.coalesce(number(5), F.lit(0)))
        return let(F.regexp_replace(text(7), r"^(?:utc|gmt)(?=[+-])", ""), lambda z: with_zone(s, local, z))

    def with_zone(s: Column, local: Column, z: Column) -> Column:
        bare = F.regexp_replace(z, r"[^\d]", "")
        digits = F.when(F.length(bare) <= 2, F.concat(F.lpad(bare, 2, "0"), F.lit("00"))).otherwise(F.lpad(bare, 4, "0"))
        signed = let(digits, lambda d: F.when(z.startswith("-"), -1).otherwise(1) * (F.substring(d, 1, 2).try_cast("int") * 3600 + F.substring(d, 3, 2).try_cast("int") * 60))
        offset = F.when(z.rlike(r"^[+-]"), signed).otherwise(F.element_at(fixed, z))
        moscow = F.coalesce(z.isin("msk", "мск"), F.lit(False))
        instant = (
            F.when(s.rlike(r"^\d{9,10}(?:[.,]\d+)?$"), F.regexp_extract(s, r"^(\d+)", 1).try_cast("long"))
            .when(s.rlike(r"^\d{13}$"), F.floor(s.try_cast("double") / 1000).cast("long"))
            .when(s.rlike(r"^\d{16}$"), F.floor(s.try_cast("double") / 1000000).cast("long"))
        )
        strange = z.isNotNull() & ~z.rlike(r"^[+-]") & F.element_at(fixed, z).isNull() & ~moscow
        return F.struct(F.when(~strange, local).alias("local"), offset.alias("offset"), moscow.alias("moscow"), instant.alias("instant"))

    return let(tidy(value), lambda s: let(cells(s), lambda cell: from_cells(s, cell)))


def resolved(found: Column, zone: Column) -> Column:
    """Seconds since 1970 of what ``parts`` found, on the clock ``zone`` where it names none."""
    utc = F.when(found["offset"].isNotNull(), seconds_of(found["local"]) - found["offset"]).otherwise(seconds_of(to_utc(found["local"], F.when(found["moscow"], F.lit(HOME_ZONE)).otherwise(zone))))
    return F.coalesce(found["instant"], utc)


def _utc(seconds: Column) -> Column:
    return F.timestamp_add("SECOND", seconds, F.expr("timestamp_ntz'1970-01-01 00:00:00'"))


def home_form(seconds: Column) -> Column:
    """The reference's form: ISO date and time to the second with Moscow's offset at that instant."""

    def form(utc: Column, local: Column) -> Column:
        minutes = F.timestamp_diff("MINUTE", utc, local)
        clock = F.concat(F.lpad(F.floor(F.abs(minutes) / 60).cast("string"), 2, "0"), F.lit(":"), F.lpad((F.abs(minutes) % 60).cast("string"), 2, "0"))
        return F.concat(F.date_format(local, "yyyy-MM-dd'T'HH:mm:ss"), F.when(minutes < 0, "-").otherwise("+"), clock)

    return let(_utc(seconds), lambda utc: let(F.convert_timezone(F.lit("UTC"), F.lit(HOME_ZONE), utc), lambda local: form(utc, local)))


def estimated_zones(df: DataFrame, source: str = "source", value: str = "date_published", read_at: str = "fetched_at", candidates: tuple[str, ...] = CANDIDATE_ZONES) -> DataFrame:
    """(source, estimated_zone): for each source the candidate whose offset history contradicts ingestion least.

    Local times without a zone are put on each candidate's clock. A time after its own ingestion is a violation; the zone
    with the fewest wins, and among these the one under which times lie closest before ingestion (the lag that a tenth of
    the rows stay below). Zones that are alike in this, as some have one clock for years, are told apart by the names that
    the source's other values give their zone; then the home zone comes first, then the earlier candidate. Sources without
    times that name no zone are absent. All candidates are weighed in one aggregation over the rows as they are.
    """
    rows = df.where(F.col(value).isNotNull() & F.col(read_at).isNotNull() & ~tidy(F.col(value)).rlike(_RELATIVE)).select(F.col(source).alias("_source"), F.col(value).alias("_value"), F.unix_seconds(F.col(read_at).cast("timestamp")).alias("_read"))
    rows = rows.select("_source", "_read", F.regexp_extract("_value", r"\[([A-Za-z]+/[A-Za-z_/]+)\]", 1).alias("_named"), parts(F.col("_value"), _utc(F.col("_read")), F.lit("UTC")).alias("_p"))
    # days without a time say nothing of the hour
    own = F.when(F.col("_p.offset").isNull() & ~F.col("_p.moscow") & (F.date_format("_p.local", "HHmmss") != "000000"), F.col("_p.local"))
    # what a value says is worked out once and written: every candidate refers to it
    rows = written(rows.select("_source", "_read", "_named", own.alias("_local")).where("_local is not null or _named <> ''"), "clocks")
    zones = F.array(*[(F.col("_read") - seconds_of(to_utc(F.col("_local"), F.lit(z)))).alias(f"z{k}") for k, z in enumerate(candidates)])
    lags = rows.select("_source", "_named", "_local", zones.alias("_lags"))
    weighed = []
    for k, z in enumerate(candidates):
        lag = F.col("_lags")[k]
        weighed += [F.count_if(lag < 0).alias(f"bad{k}"), F.percentile_approx(F.when(lag >= 0, lag), 0.1, 1000).alias(f"tight{k}"), F.count_if(F.col("_named") == z).alias(f"named{k}")]
    score = lags.groupBy("_source").agg(F.count("_local").alias("n"), *weighed).where("n > 0")
    scores = [F.struct(F.col(f"bad{k}").alias("bad"), F.coalesce(f"tight{k}", F.lit(1 << 60)).alias("tight"), (-F.col(f"named{k}")).alias("named"), F.lit(int(z != HOME_ZONE)).alias("home"), F.lit(k).alias("rank"), F.lit(z).alias("zone")) for k, z in enumerate(candidates)]
    return score.select(F.col("_source").alias(source), F.array_min(F.array(*scores))["zone"].alias("estimated_zone"))


def instants(df: DataFrame, sources: DataFrame, source: str = "source", value: str = "date_published", read_at: str = "fetched_at", name: str = "name", zone: str = "time_zone") -> DataFrame:
    """``df`` with ``utc_second`` and ``home_time``: the instant that ``value`` denotes, in seconds and in one form.

    A value without a zone follows its source's clock; a source that the catalogue gives no known zone gets an estimated
    one; where none can be estimated the home zone holds. Null, empty and impossible values and instants outside the years
    2000 to 2035 give null. ``sources`` may name a source once only; its other columns are not used. An empty table gives
    an empty result.
    """
    zones = sources.where(F.col(name).isNotNull()).groupBy(F.col(name).alias("_name")).agg(F.min(known_zone(F.col(zone))).alias("_zone"))
    unknown = df.select(F.col(source).alias("_name")).distinct().join(zones.where("_zone is not null"), "_name", "left_anti")
    estimates = estimated_zones(df.join(unknown, df[source].eqNullSafe(unknown["_name"]), "left_semi"), source, value, read_at) if unknown.limit(1).count() else None
    if estimates is not None:
        guessed = estimates.select(F.col(source).alias("_name"), F.col("estimated_zone").alias("_guess"))
        zones = zones.join(guessed, "_name", "full_outer").select("_name", F.coalesce("_zone", "_guess").alias("_zone"))
    by, clock_name = unused(df, "_name"), unused(df, "_zone")
    joined = df.withColumn(by, F.col(source)).join(small_side(zones.select(F.col("_name").alias(by), F.col("_zone").alias(clock_name))), by, "left")
    clock = F.coalesce(F.col(clock_name), F.lit(HOME_ZONE))
    utc_read = _utc(F.unix_seconds(F.col(read_at).cast("timestamp")))
    second = let(parts(F.col(value), utc_read, clock), lambda p: resolved(p, clock))
    inside = let(second, lambda x: F.when(F.year(_utc(x)).between(FIRST_YEAR, LAST_YEAR), x))
    return joined.withColumn("utc_second", inside).withColumn("home_time", home_form(F.col("utc_second"))).drop(by, clock_name)


def to_normalise(df: DataFrame, sources: DataFrame, item: str = "item_no", value: str = "date_published") -> DataFrame:
    """(item, utc_second) of the rows whose value denotes an instant but is not in the one form yet."""
    return instants(df, sources).where(F.col("utc_second").isNotNull() & (F.col(value) != F.col("home_time"))).select(item, "utc_second")
