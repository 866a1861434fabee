"""Problem 3 against a comparison of all pairs."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from feedmill.llm import history


def shingles(words):
    return {tuple(words[k : k + 3]) for k in range(len(words) - 2)} or {tuple(words)}


def model(rows):
    """The least row of every row's class, by urls and all pairs of texts."""
    above = {i: i for i, *_ in rows}

    def top(i):
        while above[i] != i:
            i = above[i]
        return i

    def join(a, b):
        a, b = sorted((top(a), top(b)))
        above[b] = a

    for n, (i, page, words) in enumerate(rows):
        for j, other, theirs in rows[:n]:
            if page and page == other:
                join(i, j)
            elif words and theirs:
                a, b = shingles(words), shingles(theirs)
                if len(a & b) >= 0.8 * len(a | b):
                    join(i, j)
    return sorted((top(i), i) for i, *_ in rows if top(i) != i)


def prepared(spark, rows):
    columns = [c.to_pylist() for c in history.keyed([w or [] for _, _, w in rows])]
    return spark.createDataFrame([(i, p, *(c[k] for c in columns)) for k, (i, p, _) in enumerate(rows)], history._PREPARED)


def some_rows():
    rng = random.Random(7)
    rows, made = [], []
    for i in range(120):
        words = [f"w{rng.randint(0, 400)}" for _ in range(rng.randint(20, 80))]
        if made and rng.random() < 0.6:  # an edit of an earlier text, or a chain of edits
            words = list(rng.choice(made))
            for _ in range(rng.randint(0, 4)):
                words[rng.randrange(len(words))] = f"w{rng.randint(0, 400)}"
        made.append(words)
        rows.append((i, rng.choice([None, f"p{rng.randint(0, 60)}"]), None if rng.random() < 0.1 else words))
    return rows


def part(ready, k, parts):
    return ready.where((F.col("item") >= 120 * k // parts) & (F.col("item") < 120 * (k + 1) // parts))


@pytest.mark.parametrize("parts", [1, 3])
def test_classes_as_all_pairs_give_them(spark, parts, monkeypatch):
    monkeypatch.setattr(history, "BUCKET_ROWS", dict.fromkeys(history.BUCKET_ROWS, 16))  # many buckets
    rows = some_rows()
    ready = prepared(spark, rows)
    found = history.History(spark)
    for k in range(parts):
        found.add(part(ready, k, parts))
    assert sorted(tuple(r) for r in found.repeats().collect()) == model(rows)


def test_a_history_lasts(spark, tmp_path, monkeypatch):
    """Another session goes on where one ended; a batch that comes again or failed changes nothing."""
    monkeypatch.setattr(history, "BUCKET_ROWS", dict.fromkeys(history.BUCKET_ROWS, 16))
    rows, path = some_rows(), f"file://{tmp_path}/history"
    ready = prepared(spark, rows)
    history.History(spark, path).add(part(ready, 0, 3), "first")
    broken = history.History(spark, path)
    monkeypatch.setattr(broken, "_commit", lambda segment: (_ for _ in ()).throw(OSError))
    with pytest.raises(OSError):
        broken.add(part(ready, 1, 3), "second")
    for _ in range(2):
        history.History(spark, path).add(part(ready, 1, 3), "second")
    last = history.History(spark, path)
    last.add(part(ready, 2, 3), "third")
    assert [s["batch"] for s in last.segments] == ["first", "second", "third"]
    assert sorted(tuple(r) for r in history.History(spark, path).repeats().collect()) == model(rows)
    # two writers can't both commit one segment
    with pytest.raises(Exception, match="(?i)exists"):
        broken.segments = broken.segments[:1]
        history.History._commit(broken, last.segments[1])


def test_a_lost_segment_is_no_empty_one(spark, tmp_path):
    import shutil

    ready, path = prepared(spark, some_rows()), f"{tmp_path}/history"
    first = history.History(spark, f"file://{path}")
    first.add(part(ready, 0, 2))
    shutil.rmtree(f"{path}/{first.segments[0]['folder']}")
    with pytest.raises(Exception):
        history.History(spark, f"file://{path}").add(part(ready, 1, 2))


def test_a_small_batch_reads_as_little_of_a_large_history(spark, monkeypatch):
    monkeypatch.setattr(history, "BUCKET_ROWS", dict.fromkeys(history.BUCKET_ROWS, 64))
    read = {}
    for size in (100, 1000):
        rng = random.Random(size)
        old = prepared(spark, [(i, f"p{i}", [f"w{rng.randint(0, 10**6)}" for _ in range(30)]) for i in range(size)])
        kept = history.History(spark)
        kept.add(old)
        probe = prepared(spark, [(5000, "p3", [f"w{rng.randint(0, 10**6)}" for _ in range(30)])])
        keys = {"keys": probe.select(F.col("page").alias("key")), "bands": probe.select(F.explode("bands").alias("key"))}
        read[size] = {t: (kept.probed(t, k) or kept._all(t).limit(0)).count() for t, k in keys.items()}
        assert all(kept.segments[0][t]["bits"] for t in keys)
    assert all(read[1000][t] <= 3 * max(64, read[100][t]) for t in ("keys", "bands")), read


def test_copies_share_one_representative(spark, rows, repairer):
    text = "Компания готовит площадку под строительство школы, объём выпуска цемента в области составил больше, чем годом ранее, сообщили в ведомстве сегодня."
    # each of a source of its own: else the line would repeat excessively and go, as problem 1 has it
    df = rows(*[text] * 40, None, "", "Page not found", "Page not found").withColumn("source", F.col("item_no").cast("string"))
    assert sorted(tuple(r) for r in history.repeated_articles(df, repairer).collect()) == [(0, i) for i in range(1, 40)]
    assert history.repeated_articles(df.limit(0), repairer).count() == 0
    nowhere = rows(None, None).withColumn("url", F.lit(None).cast("string"))
    assert history.repeated_articles(nowhere, repairer).count() == 0


def test_page_keys(one):
    key = history.page_key(F.col("u"))
    same = ["https://www.a.example/x/", "http://A.example:443/x", "https://a.example/x?utm_source=b&yclid=3#top", "https://a.example/x/?"]
    assert len({one(key, u=u) for u in same}) == 1
    assert one(key, u="https://a.example/p.php?b=2&a=1") == one(key, u="https://a.example/p.php?a=1&utm_x=y&b=2") != one(key, u="https://a.example/p.php?a=2&b=2")
    assert one(key, u="https://a.example/%D0%B9/") == one(key, u="https://a.example/й") != one(key, u="https://a.example/%zz")
    assert one(key, u=None) is None and one(key, u="  ") is None


def test_components(spark):
    rng = random.Random(3)
    edges = [(rng.randint(0, 150), rng.randint(0, 150)) for _ in range(110)] + [(1000 + k, 1001 + k) for k in range(30)]
    above = {}
    for e in edges:
        for x in e:
            above.setdefault(x, x)
    changed = True
    while changed:
        changed = False
        for a, b in edges:
            m = min(above[a], above[b])
            changed |= above[a] != m or above[b] != m
            above[a] = above[b] = m
    got = {r.node: r.label for r in history.classes(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {k: v for k, v in above.items() if any(k in e and e[0] != e[1] for e in edges)}
    assert history.classes(spark.createDataFrame([], "a long, b long")).count() == 0


def test_bands_meet_at_the_limit():
    rng = np.random.default_rng(0)
    missed = 0
    for _ in range(300):
        shared = rng.integers(1, 2**62, 160, dtype=np.uint64)
        a, b = (np.concatenate([shared, rng.integers(1, 2**62, 20, dtype=np.uint64)]) for _ in range(2))
        flat, starts = np.concatenate([a, b]), np.array([0, len(a), len(a) + len(b)])
        x, y = history.band_keys(flat, starts)
        missed += not np.any(x == y)
    assert missed == 0


@pytest.mark.parametrize("seed", range(3))
def test_one_task_joins_what_steps_join(spark, seed):
    rng = random.Random(seed)
    edges = [(rng.randint(0, 150), rng.randint(0, 150)) for _ in range(110)] + [(1000 + k, 1001 + k) for k in range(30)] * 2
    links = spark.createDataFrame(edges, "a long, b long").repartition(3)
    found = [sorted(map(tuple, history.classes(links, n).collect())) for n in (len(edges), None)]
    assert found[0] == found[1] and {x for x, _ in found[0]} == {x for a, b in edges for x in (a, b) if a != b}
    assert history.classes(links.limit(0), 0).count() == 0


def test_links_beyond_one_task(spark, monkeypatch):
    monkeypatch.setattr(history, "ONE_TASK", 3)
    monkeypatch.setattr(history, "FEW", 3)
    rows = some_rows()
    found, ready = history.History(spark), prepared(spark, rows)
    for k in range(2):
        found.add(part(ready, k, 2))
    assert sorted(tuple(r) for r in found.repeats().collect()) == model(rows)


def test_a_batch_takes_few_queries(spark):
    """Each is a plan, with stages, threads and compiled code, that the driver has to hold."""
    number = getattr(getattr(spark._jvm.org.apache.spark.sql.execution, "SQLExecution$"), "MODULE$").nextExecutionId
    found, ready = history.History(spark), prepared(spark, some_rows())
    for k in range(3):
        before = number()
        found.add(part(ready, k, 3))
        assert number() - before <= 20
