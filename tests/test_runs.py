"""Whole runs: queries against SQL, a run over landed pages twice, streams against batches."""

import duckdb
import pytest
from pyspark.sql import functions as F

from feedmill.operators import state
from feedmill.plans import oracles, pipeline, queries
from feedmill.streaming import incremental

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def sql():
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in ("unified", "sources", "pages", "fetch_attempts", "first_seen", "documents", "mix_targets", "token_limits", "orders", "events"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{DATA}/{name}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(oracles.ORACLES))
def test_query_gives_what_sql_gives(spark, sql, name):
    found = queries.QUERIES[name](spark, DATA)
    columns = sorted(found.columns)
    got = sorted(tuple(map(str, r)) for r in found.select(*columns).collect())
    told = sql.execute(oracles.ORACLES[name])
    at = [[c[0] for c in told.description].index(c) for c in columns]
    assert got == sorted(tuple(str(r[i]) for i in at) for r in told.fetchall())


@pytest.mark.parametrize("name", sorted(set(queries.QUERIES) - set(oracles.ORACLES)))
def test_query_without_sql_runs(spark, name):
    assert len(queries.QUERIES[name](spark, DATA).collect()) >= 0


INDEX = "<html><body>" + "".join(f"<a href='/a/{k}'>Новость номер {k}</a>" for k in range(5)) + "<a href='/news/'>Все новости</a></body></html>"


def test_a_second_run_finds_nothing_new(spark):
    article = lambda k: f"<html><head><meta property='article:published_time' content='2024-05-0{k + 1}T10:00:00+03:00'></head><body><article><h1>Тема {k}</h1><p>{'слово ' * 60}</p></article></body></html>"
    pages = spark.createDataFrame([(0, "https://s.example/", INDEX, "s", 200)] + [(k + 1, f"https://s.example/a/{k}", article(k), "s", 200) for k in range(4)] + [(9, "https://s.example/a/4", None, "s", 500)], "page_id long, url string, html string, source string, status int")
    sources = spark.createDataFrame([("s", "https://s.example/")], "name string, base_url string")
    for c, kind in (("start_url", "string"), ("api_endpoint", "string"), ("mode", "string"), ("include_patterns", "array<string>"), ("include_regex", "array<string>"), ("exclude_regex", "array<string>"), ("content_selectors", "array<string>"), ("link_min_text_len", "int"), ("accept_empty_anchor", "boolean"), ("restrict_domain", "boolean"), ("max_links", "int"), ("min_words", "int"), ("enabled", "boolean")):
        sources = sources.withColumn(c, F.lit(None).cast(kind))
    none = spark.createDataFrame([], "ord long, id string, url string, title string, date_published string, content_text string, tags array<string>, source string")
    now = F.lit("2024-06-01 12:00:00").cast("timestamp_ntz")
    first = pipeline.run_once(pages, sources, none, spark.createDataFrame([], "id string, first_seen string"), spark.createDataFrame([], "source string, pos long, url string"), now)
    assert first.new_items == 4
    rows = first.feed.orderBy("url").collect()
    assert [(r.title, r.date_published) for r in rows] == [(f"Тема {k}", f"2024-05-0{k + 1}T10:00:00+03:00") for k in range(4)]
    second = pipeline.run_once(pages, sources, first.feed, first.first_seen, first.seen, now)
    assert second.new_items == 0 and second.feed.count() == 4
    again = pipeline.run_once(pages, sources, first.feed, first.first_seen, first.seen, now, force=True)
    assert again.new_items == 4 and again.feed.count() == 4
    # an index page as it was gives nothing; one that failed is read from the cache, and its source rests then
    sources = sources.withColumn("start_url", F.lit("https://s.example/"))
    empty = spark.createDataFrame([], "id string, first_seen string"), spark.createDataFrame([], "source string, pos long, url string")
    run = lambda p, **more: pipeline.run_once(p, sources, none, *empty, now, **more)
    one = run(pages, per_source=2)
    assert one.new_items == 2 and one.digests.count() == 1 and one.cooldowns.count() == 0
    assert run(pages, digests=one.digests).new_items == 0 and run(pages, digests=one.digests, force=True).new_items == 4
    down = pages.withColumn("status", F.when(F.col("page_id") == 0, 503).otherwise(F.col("status"))).withColumn("html", F.when(F.col("page_id") != 0, F.col("html")))
    cache = pages.where("page_id = 0").select("url", "html", F.lit("2024-01-01").cast("timestamp").alias("fetched_at"))
    rests = run(down)
    assert rests.new_items == 0 and [str(r.until) for r in rests.cooldowns.collect()] == ["2024-06-01 18:00:00"]
    assert run(down, cache=cache).new_items == 4
    assert run(pages, cooldowns=rests.cooldowns).new_items == 0 and run(pages, cooldowns=rests.cooldowns, cache=cache).new_items == 4


def test_streams_give_what_batches_give(spark, tmp_path):
    rows = spark.read.parquet(f"{DATA}/unified.parquet").withColumn("ord", F.col("item_no"))
    path = str(tmp_path / "landed")
    for k in range(3):  # arrives in three files
        rows.where(F.col("item_no") % 3 == k).coalesce(1).write.mode("append").parquet(path)
    landed = incremental.landed(spark, path, 1)
    assert incremental.finished(incremental.new_addresses(landed.select("source", "url"))).count() == rows.select("source", "url").distinct().count()
    first = incremental.finished(incremental.first_sightings(landed.select("id", "fetched_at")), "complete")
    assert sorted(map(tuple, first.collect())) == sorted(map(tuple, rows.where("id is not null").groupBy("id").agg(F.min("fetched_at")).collect()))
    table = incremental.FeedTable(spark, spark.read.parquet(f"{DATA}/first_seen.parquet"))
    feed = incremental.feed_of(landed, table)
    once = sorted((r.url, r.title) for r in feed.collect())
    assert len({u for u, _ in once}) == len(once)
    last = spark.read.parquet(path).where(F.col("item_no") % 3 == 2)
    table.upsert(last, table.last)  # a batch that is run again
    assert len(table.items().collect()) == len(once)


def test_seen_window_of_a_stream(spark, tmp_path):
    path = str(tmp_path / "w")
    for urls in (["a", "b", "a"], ["b", "c"]):
        spark.createDataFrame([("s", u, n) for n, u in enumerate(urls)], "source string, url string, ord long").coalesce(1).write.mode("append").parquet(path)
    found = incremental.finished(incremental.unseen(incremental.landed(spark, path, 1)))
    assert sorted(r.url for r in found.collect()) == ["a", "b", "c"]


def test_first_sightings_are_written_once(spark):
    known = spark.createDataFrame([("a", "2020")], "id string, first_seen string")
    rows = spark.createDataFrame([("a", None), ("b", ""), ("c", "2021"), ("b", None)], "id string, date_published string")
    after = {r.id: r.first_seen for r in state.with_first_seen(known, rows, F.lit("now")).collect()}
    assert after == {"a": "2020", "b": "now"}
    dated = sorted((r.id, r.date_published) for r in state.dated(rows, known, F.lit("now")).collect())
    assert dated == [("a", "2020"), ("b", "now"), ("b", "now"), ("c", "2021")]
