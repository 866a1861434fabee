"""Problem 5 against a model written without the operator: the standard library's clocks."""

from datetime import datetime, timezone
from zoneinfo import ZoneInfo

import pytest
from pyspark.sql import functions as F

from feedmill.operators import instants

READ = "2024-03-31 22:30:00"  # 01:30 of the next day in Moscow
SOURCES = [("msk", "Europe/Moscow"), ("ber", "Europe/Berlin"), ("vla", "Asia/Vladivostok"), ("bad", "Mars/Base"), ("none", None)]


def at(zone, *parts):
    return int(datetime(*parts, tzinfo=ZoneInfo(zone)).timestamp())


CASES = [
    ("msk", "2024-09-23T10:00:00+03:00", at("Europe/Moscow", 2024, 9, 23, 10)), ("msk", "2024-09-23T10:00:00Z", at("UTC", 2024, 9, 23, 10)), ("ber", "2024-09-23 10:00", at("Europe/Berlin", 2024, 9, 23, 10)),
    ("msk", "20240923T100000+0300", at("Europe/Moscow", 2024, 9, 23, 10)), ("msk", "2024-09-23T10:00:00,167+03:00", at("Europe/Moscow", 2024, 9, 23, 10)), ("msk", "2024-09-23T10:00+03", at("Europe/Moscow", 2024, 9, 23, 10)),
    ("vla", "23.09.2024 10:00", at("Asia/Vladivostok", 2024, 9, 23, 10)), ("vla", "23/09/24", at("Asia/Vladivostok", 2024, 9, 23)), ("msk", "10:00 23.09.2024", at("Europe/Moscow", 2024, 9, 23, 10)),
    ("msk", "Опубликовано: 3 мая 2021, 01:03", at("Europe/Moscow", 2021, 5, 3, 1, 3)), ("msk", "17 мая 2023 г. в 09:46", at("Europe/Moscow", 2023, 5, 17, 9, 46)), ("msk", "17 МАЯ 2023 года", at("Europe/Moscow", 2023, 5, 17)),
    ("ber", "3. März 2021, 14:05", at("Europe/Berlin", 2021, 3, 3, 14, 5)), ("msk", "Mon, 23 May 2022 10:42:08 UTC", at("UTC", 2022, 5, 23, 10, 42, 8)), ("msk", "Mon, 23 May 2022 10:42:08 +0300", at("Europe/Moscow", 2022, 5, 23, 10, 42, 8)),
    ("msk", "October 12, 2024 2:31 AM", at("Europe/Moscow", 2024, 10, 12, 2, 31)), ("msk", "Dec 19, 2023, 12:18 pm", at("Europe/Moscow", 2023, 12, 19, 12, 18)), ("msk", "Jan 31, 2023, 12:44 am", at("Europe/Moscow", 2023, 1, 31, 0, 44)),
    ("msk", "1681810022", 1681810022), ("msk", "1718435931847", 1718435931), ("msk", "1621577621.661", 1621577621), ("msk", "2013-07-01 12:00:00 MSK", at("Europe/Moscow", 2013, 7, 1, 12)), ("msk", "2024-07-01 12:00:00 CEST", at("Europe/Berlin", 2024, 7, 1, 12)),
    ("msk", "вчера, 23:00", at("Europe/Moscow", 2024, 3, 31, 23)), ("ber", "heute 00:10", at("Europe/Berlin", 2024, 4, 1, 0, 10)), ("msk", "сегодня", at("Europe/Moscow", 2024, 4, 1)), ("msk", "2024-03-31T10:00:00-05:00", at("Etc/GMT+5", 2024, 3, 31, 10)),
    # twice in autumn: the first; skipped in spring: the offset before the change
    ("ber", "2023-10-29 02:30:00", at("Europe/Berlin", 2023, 10, 29, 2, 30)), ("ber", "2024-03-31 02:30:00", at("UTC", 2024, 3, 31, 1, 30)), ("msk", "26.10.2014 01:30", at("Etc/GMT-4", 2014, 10, 26, 1, 30)),
    ("msk", "31.02.2024", None), ("msk", "00.00.0000", None), ("msk", "2024-13-07T09:00:00Z", None), ("msk", "1970-01-01T00:00:00Z", None), ("msk", "0001-01-01T00:00:00Z", None), ("msk", "n/a", None), ("msk", "", None), ("msk", None, None), ("msk", "25:00 01.01.2024", None), ("msk", "x" * 100_000, None),
    ("bad", "2024-09-23 10:00", at("Europe/Moscow", 2024, 9, 23, 10)), ("unknown", "2024-09-23T10:00:00Z", at("UTC", 2024, 9, 23, 10)), (None, "2024-09-23T10:00:00Z", at("UTC", 2024, 9, 23, 10)),
]


@pytest.fixture(scope="module")
def catalogue(spark):
    return spark.createDataFrame(SOURCES, "name string, time_zone string")


def test_formats_and_clocks(spark, catalogue):
    # columns with names that the operator uses itself
    rows = spark.createDataFrame([(i, s, v, "kept", "kept") for i, (s, v, _) in enumerate(CASES)], "item_no long, source string, date_published string, _name string, _zone string").withColumn("fetched_at", F.lit(READ).cast("timestamp"))
    found = {r.item_no: r for r in instants.instants(rows, catalogue.where("name in ('msk', 'ber', 'vla')")).collect()}
    got = [(v, found[i].utc_second) for i, (s, v, _) in enumerate(CASES) if s != "bad"]
    assert got == [(v, x) for s, v, x in CASES if s != "bad"]
    assert all(r._name == "kept" and r._zone == "kept" for r in found.values())
    for r in found.values():
        if r.utc_second is not None:
            assert r.home_time == datetime.fromtimestamp(r.utc_second, ZoneInfo("Europe/Moscow")).isoformat()


def test_only_other_forms_are_cases(spark, catalogue):
    rows = spark.createDataFrame([(1, "msk", "2024-09-23T10:00:00+03:00"), (2, "msk", "2024-09-23T10:00:00+04:00"), (3, "msk", "2013-07-01T10:00:00+03:00"), (4, "msk", None), (4, "msk", "23.09.2024")], "item_no long, source string, date_published string").withColumn("fetched_at", F.lit(READ).cast("timestamp"))
    assert sorted(r.item_no for r in instants.to_normalise(rows, catalogue).collect()) == [2, 3, 4]
    assert instants.to_normalise(rows.limit(0), catalogue).count() == 0


def test_zones_are_estimated_from_ingestion(spark):
    rows = []
    for k in range(300):
        moment = datetime.fromtimestamp(1_700_000_000 + k * 86_400 * 2, timezone.utc)
        for name, zone in (("a", "Asia/Vladivostok"), ("b", "Europe/Berlin")):
            rows.append((name, moment.astimezone(ZoneInfo(zone)).strftime("%Y-%m-%d %H:%M:%S"), datetime.fromtimestamp(moment.timestamp() + 60 * (k % 7 + 1), timezone.utc)))
    df = spark.createDataFrame(rows, "source string, date_published string, fetched_at timestamp")
    assert {r.source: r.estimated_zone for r in instants.estimated_zones(df).collect()} == {"a": "Asia/Vladivostok", "b": "Europe/Berlin"}
    # a source without a known zone is read on its estimated clock
    nowhere = spark.createDataFrame([("a", None), ("b", None)], "name string, time_zone string")
    first = instants.instants(df.where("source = 'a'"), nowhere).select(F.min("utc_second")).first()[0]
    assert first == 1_700_000_000


def test_zones_with_one_clock_for_years_are_told_apart(spark):
    """Moscow and Minsk differ before the end of 2014 only: a name decides, and without one the home zone."""
    times = [(s, f"2024-0{k % 9 + 1}-01 12:0{k % 9}:00", f"2024-0{k % 9 + 1}-01 09:30:00") for k in range(30) for s in ("named", "plain")]
    df = spark.createDataFrame([*times, ("named", "2024-03-01T12:00:00+03:00[Europe/Minsk]", "2024-03-01 10:00:00"), ("daily", "01.03.2024", "2024-03-01 10:00:00")], "source string, date_published string, at string").withColumn("fetched_at", F.col("at").cast("timestamp"))
    assert {r.source: r.estimated_zone for r in instants.estimated_zones(df).collect()} == {"named": "Europe/Minsk", "plain": "Europe/Moscow"}
