from datetime import datetime, timezone

from pyspark.sql import functions as F

from feedmill.functions import dates, html, text



def now():
    return F.lit("2024-09-23 10:00:00").cast("timestamp_ntz")


def utc(*parts):
    return int(datetime(*parts, tzinfo=timezone.utc).timestamp())


def test_white_space(one):
    assert one(text.tidy_lines(F.col("t")), t=" a  b \r\n\n \n c d ") == "a  b\nc\nd"
    assert one(text.tidy_lines(F.col("t")), t=None) == ""
    assert one(text.collapsed(F.col("t")), t=" a 　 b\n") == "a b"
    assert [one(text.word_count(F.col("t")), t=t) for t in ("Жук, 2 жука_x!", "", None)] == [3, 0, 0]
    assert [one(text.is_rich(F.col("t")), t=t) for t in ("a", "  ", "", None)] == [True, False, False, False]
    assert [one(text.looks_like_html(F.col("t")), t=t) for t in ("<p>a", "1 < 2 > 0", None)] == [True, False, False]


def test_leading_title(one):
    cut = text.without_title(F.col("t"), F.col("n"))
    assert one(cut, t=" Заголовок — текст", n="ЗАГОЛОВОК") == "текст"
    assert one(cut, t="A  b\ntext", n="a b") == "text"
    assert one(cut, t="text", n="") == "text"
    assert one(cut, t="(a+b) c", n="(a+b)") == "c"
    assert one(cut, t=None, n="x") == ""
    for t, n in (("Тема: дальше", "тема"), ("x\ny", "x"), ("abc", None)):
        assert one(cut, t=t, n=n) == html.without_title(t, n)


def test_russian_dates(one):
    read = F.date_format(dates.russian_date(F.col("v")), "yyyy-MM-dd HH:mm")
    cases = {"19.09.2024 12:34": "2024-09-19 12:34", "19 сентября 2024 12:34": "2024-09-19 12:34", "19 сентября 2024, 12:34": "2024-09-19 00:00", "19 сент 2024": "2024-09-19 00:00", "19.09.24": "2024-09-19 00:00", "19.09.24 12:34": "2024-09-19 12:34", "19.09.245": "2024-09-19 00:00", "31.02.2024": None, "19.09.1999": None, "19 СЕНТЯБРЯ 2024": "2024-09-19 00:00", "": None}
    assert {v: one(read, v=v) for v in cases} == cases


def test_zones_and_forms(one):
    assert one(dates.iso_seconds(F.col("v")), v="2024-09-23T10:00:00Z") == utc(2024, 9, 23, 10)
    assert one(dates.iso_seconds(F.col("v")), v="2024-09-23") == utc(2024, 9, 22, 21)
    assert one(dates.iso_seconds(F.col("v")), v="2024") == utc(2023, 12, 31, 21)
    assert one(dates.home_form(F.lit(utc(2024, 9, 23, 10)))) == "2024-09-23T13:00:00+03:00"
    assert one(dates.home_form(F.lit(utc(2013, 7, 1)))) == "2013-07-01T04:00:00+04:00"
    assert one(dates.url_date(F.col("u")), u="https://h.example/2024/09/21/x") == utc(2024, 9, 20, 21)
    assert one(dates.url_date(F.col("u")), u="https://h.example/2024/19/39/x") is None
    assert one(dates.stamp(now())) == "2024-09-23T10:00:00+03:00"
    assert one(F.date_format(dates.relative_date(F.col("v"), now()), "dd HH:mm"), v="Вчера, 12:34") == "22 12:34"
    assert one(F.date_format(dates.relative_date(F.col("v"), now()), "dd HH:mm"), v="сегодня") == "23 12:00"
    first = dates.first_date(F.array(F.lit("нет"), F.lit("7 мая 2023"), F.lit("2020-01-01")), now())
    assert one(first) == utc(2023, 5, 6, 21)
    api = dates.api_date(F.col("i"), F.col("r"), F.lit("built"), now())
    assert one(api, i="bad", r="19.09.2024") == "built"
    assert one(api, i=None, r="19.09.2024 00:00") == "2024-09-19T00:00:00+03:00"
