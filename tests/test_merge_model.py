"""Merging against a plain fold, on random items."""

import random

import pytest
from pyspark.sql import functions as F

from feedmill.operators import merge

FIELDS = ("id", "title", "date_published", "content_text")


def model(existing, new, seen):
    out = {}
    for side, rows in ((0, existing), (1, new)):
        for ord_, url, item in rows:
            if side == 0:
                out[url] = (out[url][0] if url in out else (0, ord_), dict(item))
            elif url not in out:
                out[url] = ((1, ord_), dict(item))
            else:
                place, old = out[url]
                key = item["id"] or old["id"] or out[url][1].get("_old")
                for f in FIELDS:
                    if f == "date_published" and old[f] and item[f] and key and seen.get(key) == item[f]:
                        continue
                    if f == "content_text" and not (item[f] or "").strip():
                        continue
                    if f == "id" and not item[f]:
                        continue
                    old[f] = item[f]
    return sorted((*place, url, item["title"], item["date_published"], item["content_text"]) for url, (place, item) in out.items())


@pytest.mark.parametrize("seed", range(3))
def test_merge_as_a_fold_does(spark, seed):
    rng = random.Random(seed)
    seen = {"k0": "d0", "k1": "d1"}

    def items(n):
        rows = []
        for k in range(n):
            u = rng.randrange(12)
            rows.append((k, f"https://e.example/{u}", {"id": f"k{u % 3}", "title": rng.choice(["a", "b", None, ""]), "date_published": rng.choice(["d0", "d1", "d2", None, ""]), "content_text": rng.choice(["x", "y", " ", None])}))
        return rows

    existing, new = items(15), items(60)
    frame = lambda rows: spark.createDataFrame([(o, u, *(i[f] for f in FIELDS)) for o, u, i in rows], "ord long, url string, " + ", ".join(f"{f} string" for f in FIELDS))
    found = merge.merge(frame(existing), frame(new), spark.createDataFrame(list(seen.items()), "id string, first_seen string"))
    got = sorted(map(tuple, found.select("side", "ord", "url", "title", "date_published", "content_text").collect()), key=str)
    assert got == sorted(model(existing, new, seen), key=str)
    assert found.where(F.col("url").isNull()).count() == 0
