"""Problems 8, 9 and 10: arrangements checked for what they must hold."""

import os
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from feedmill.llm import mixture, packing, pieces, tokens

pytestmark = pytest.mark.skipif(not os.path.exists(tokens.FOLDER), reason="no tokenizer files")


@pytest.mark.parametrize("seed", range(6))
def test_packing_holds_every_item_once(seed):
    rng = np.random.default_rng(seed)
    capacity = int(rng.integers(5, 300))
    sizes = rng.integers(1, capacity + 1, int(rng.integers(1, 600)))
    bins = packing.pack(sizes, capacity)
    assert sorted(x for b in bins for x in b) == sorted(sizes.tolist()) and all(0 < sum(b) <= capacity for b in bins)
    first_fit = []
    for s in sorted(sizes.tolist(), reverse=True):
        k = next((k for k, x in enumerate(first_fit) if x + s <= capacity), None)
        if k is None:
            first_fit.append(s)
        else:
            first_fit[k] += s
    assert len(bins) <= len(first_fit) + 1


def test_packing_a_table(spark):
    sizes = [(0, 5), (1, 5), (2, 25), (3, 0), (4, None), (5, 10), (6, -1), (7, 3)]
    df = spark.createDataFrame(sizes, "doc_id long, n_tokens long")
    out = packing.packed(df, {"ten": 10, "big": 100}, shard_items=3).collect()
    for name, capacity in (("ten", 10), ("big", 100)):
        rows = [r for r in out if r.limit_name == name]
        held = {}
        for r in rows:
            held.setdefault(r.container_no, []).append(r)
        assert all(sum(r.n_tokens for r in b) <= capacity and sorted(r.position for r in b) == list(range(1, len(b) + 1)) for b in held.values())
        for i, n in sizes:
            mine = sorted((r for r in rows if r.doc_id == i), key=lambda r: r.part_no)
            assert sum(r.n_tokens for r in mine) == max(0, n or 0) and (len(mine) == 1 or n > capacity)
            assert [r.token_from for r in mine] == [sum(r.n_tokens for r in mine[:k]) for k in range(len(mine))]
    assert packing.packed(df.limit(0), {"ten": 10}).count() == 0
    with pytest.raises(ValueError):
        packing.packed(df, {"none": 0})


def test_budgets_go_to_siblings_first():
    leaves = [(("x", "ru"), "a", 0.4, 100, 1), (("x", "ru"), "b", 0.2, 1000, 1), (("x", "en"), "c", 0.4, 1000, 2)]
    got = {k[1]: v for k, v in mixture.budgets(leaves, 1000).items()}
    assert got == {"a": pytest.approx(100), "b": pytest.approx(500), "c": pytest.approx(400)}
    # the language is full: what it can't take goes to its siblings in the domain before other domains
    leaves = [(("x", "ru"), "a", 0.2, 100, 1), (("x", "ru"), "b", 0.2, 100, 1), (("x", "en"), "c", 0.2, 1000, 2), (("y", "ru"), "a", 0.4, 1000, 1)]
    got = mixture.budgets(leaves, 1000)
    assert got == {(("x", "ru"), "a"): pytest.approx(100), (("x", "ru"), "b"): pytest.approx(100), (("x", "en"), "c"): pytest.approx(400), (("y", "ru"), "a"): pytest.approx(400)}
    assert mixture.budgets([(("x",), "a", 0.0, 10, 1)], 100) == {(("x",), "a"): 0.0} and mixture.budgets([], 10) == {}
    # without a total: as large as every target can be met
    got = mixture.budgets([((), "a", 0.5, 100, 2), ((), "b", 0.3, 1000, 1), ((), "none", 0.2, 0, 4)])
    assert got == {((), "a"): pytest.approx(200), ((), "b"): pytest.approx(120), ((), "none"): 0.0}


def test_mixture(spark):
    rng = random.Random(1)
    docs = [(k, rng.choice(["a", "a", "a", "b"]), rng.choice(["ru", "en"]), rng.randint(1, 50)) for k in range(4000)] + [(9000, "c", "en", 40), (9001, "c", None, 60), (9002, None, "ru", 5), (9003, "a", "ru", 0), (9004, "z", "ru", 5)]
    sizes = spark.createDataFrame(docs, "doc_id long, source string, lang string, n_tokens long")
    targets = spark.createDataFrame([("a", 0.3, 1), ("b", 0.5, 3), ("c", 0.2, 4), ("none", None, None)], "source string, target_share double, max_repeats int")
    whole = sum(n for _, s, _, n in docs if s in ("a", "b", "c"))
    for total in (None, whole):
        uses, shares = mixture.mixture(sizes, targets, total=total)
        rows, table = uses.collect(), {r.source: r for r in shares.collect()}
        assert len({(r.doc_id, r.epoch) for r in rows}) == len(rows) and {r.source for r in rows} == {"a", "b", "c"}
        of = {k: (s, lang) for k, s, lang, _ in docs}
        for name, most in (("a", 1), ("b", 3), ("c", 4)):
            mine = [r for r in rows if r.source == name]
            assert max(r.epoch for r in mine) <= most and abs(sum(r.n_tokens for r in mine) - table[name].budget_tokens) <= 2 * 25 + 1
            assert table[name].mixed_tokens == sum(r.n_tokens for r in mine)
        assert table["none"].actual_share == 0.0 and sum(r.actual_share for r in table.values()) == pytest.approx(1)
        if total is None:
            assert table["c"].mixed_tokens == 400 and all(abs(table[k].actual_share - table[k].target_share) < 0.03 for k in "abc")
        else:
            assert table["c"].mixed_tokens == 400 and table["a"].mixed_tokens > 0.3 * total
        assert sorted(map(tuple, mixture.mixture(sizes, targets, total=total)[0].collect())) == sorted(map(tuple, rows))
    # the last epoch of a leaf is a prefix of its order: nothing that was passed over comes before what was taken
    order = {r.doc_id: r.h for r in sizes.select("doc_id", F.xxhash64(F.lit(17), F.lit(1), F.col("doc_id")).alias("h")).collect()}
    for lang in ("ru", "en"):
        taken = {order[r.doc_id] % 2**64 for r in rows if of[r.doc_id] == ("a", lang) and r.epoch == 1}
        left = {order[k] % 2**64 for k, s, g, n in docs if (s, g) == ("a", lang) and n} - taken
        assert not left or max(taken) < min(left)
    empty, none = mixture.mixture(sizes.limit(0), targets)
    assert empty.count() == 0 and all(r.actual_share == 0.0 for r in none.collect())


LIMITS = [("small", 256, 0), ("middle", 512, 32)]


def text(seed):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("абвгдежз") for _ in range(rng.randint(1, 12)))
    return "".join(word() + rng.choice([" ", " ", " ", ", ", ". ", ".\n", "\n\n", "   "]) for _ in range(rng.randint(200, 1500)))


@pytest.mark.parametrize("body", [*map(text, range(4)), "x" * 20_000, "слово" * 3000, " " * 5000, "a\n" * 2000, "我" * 3000], ids=lambda t: t[:5].strip() or "blank")
def test_pieces_cover_a_text(body):
    total = len(tokens.encode(body))
    counts = pieces._Counts(tokens.FOLDER, tokens.VOCABULARY)
    found = pieces.pieces_of(body, LIMITS, counts)
    plain = max(map(len, pieces._WORDS.findall(body))) <= pieces.LONGEST_WORD
    for name, capacity, overlap in LIMITS:
        mine = [p for p in found if p[0] == name]
        if not mine:
            assert total <= capacity
            continue
        assert mine[0][3] == 0 and mine[-1][4] == len(body) and [p[1] for p in mine] == list(range(1, len(mine) + 1))
        for p, q in zip(mine, mine[1:]):
            assert p[3] < q[3] <= p[4] < q[4] and q[6] >= overlap
        for p in mine:
            assert p[7] == body[p[3] : p[4]] and p[5] <= capacity and len(tokens.encode(p[7])) <= capacity
            assert not plain or len(tokens.encode(p[7])) == p[5]


def test_splitting_a_table(spark):
    df = spark.createDataFrame([(1, text(9), "kept"), (2, None, "kept"), (3, "", "kept"), (4, "коротко", "kept")], "doc_id long, text string, item string")
    out = pieces.split(df, LIMITS)
    assert {r.doc_id for r in out.collect()} == {1} and pieces.split(df.limit(0), LIMITS).count() == 0
    with pytest.raises(ValueError):
        pieces.split(df, [("bad", 100, 100)])


def test_sizes(spark):
    df = spark.createDataFrame([(1, "привет мир", "a"), (2, None, "b"), (3, "", None)], "doc_id long, text string, source string")
    assert sorted(map(tuple, tokens.sized(df, keep=("source",)).collect()), key=str) == sorted([(1, "a", len(tokens.encode("привет мир"))), (2, "b", 0), (3, None, 0)], key=str)
    assert df.select(F.col("doc_id")).count() == 3
