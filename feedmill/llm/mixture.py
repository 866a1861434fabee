"""Problem 9: mixing sources to target weights.

Hierarchical budgeting: the total is handed down a tree of domains, languages and sources by weight. A source's weight is
spread over the languages of its documents by their tokens, so every document counts under its own language. What a node
cannot take (all its documents, each used as often as its source allows) goes to its siblings by weight, and to the
parent's siblings only when these are full. A leaf's budget is spent in epochs: whole passes over its documents, then a
prefix, by tokens, of one more pass in an order that a seeded hash gives.

A leaf may hold any share of the rows: its prefix is found from the token sums of hash ranges, and only the range in
which it ends is put in order.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from feedmill.shared import small_side, written

#: Documents of a hash range, about; bits that name a range, at most; leaves that the tree may have.
RANGE_ITEMS, MOST_BITS, MOST_LEAVES = 1000, 24, 100_000


@dataclass
class Node:
    """A group or a source of the tree."""

    name: str
    weight: float = 0.0
    capacity: float = 0.0
    children: dict[str, Node] = field(default_factory=dict)
    budget: float = 0.0

    def add(self, path: tuple[str, ...], name: str, weight: float, capacity: float) -> None:
        self.weight += weight
        self.capacity += capacity
        if path:
            self.children.setdefault(path[0], Node(path[0])).add(path[1:], name, weight, capacity)
        else:
            self.children[f"\0{name}"] = Node(name, weight, capacity)

    def share(self, amount: float) -> None:
        """Takes ``amount``, at most its capacity, and hands it down."""
        self.budget = amount = min(amount, self.capacity)
        open_, left = list(self.children.values()), amount
        given = dict.fromkeys(map(id, open_), 0.0)
        while open_ and left > 1e-9:
            total = sum(c.weight for c in open_)
            if total <= 0:
                break
            full = [c for c in open_ if given[id(c)] + left * c.weight / total >= c.capacity]
            if not full:
                for c in open_:
                    given[id(c)] += left * c.weight / total
                left = 0.0
            else:
                for c in full:
                    left -= c.capacity - given[id(c)]
                    given[id(c)] = c.capacity
                open_ = [c for c in open_ if c not in full]
                # the rest is shared anew among the open ones: start from what the full ones left over
                left += sum(given[id(c)] for c in open_)
                for c in open_:
                    given[id(c)] = 0.0
        for c in self.children.values():
            c.share(given[id(c)])

    def leaves(self, path: tuple[str, ...] = ()) -> dict[tuple, float]:
        """The budget of each leaf, by the groups above it and its name."""
        out: dict[tuple, float] = {}
        for key, child in self.children.items():
            out |= child.leaves((*path, key)) if child.children else {(path, child.name): child.budget}
        return out


def budgets(leaves: list[tuple[tuple[str, ...], str, float, int, int]], total: float | None = None) -> dict[tuple, float]:
    """Tokens of each leaf, by its path and name. ``leaves`` has (groups above, source, weight, available tokens, most uses).

    Without ``total``, the mixture is as large as it can be with every source that has documents at its target.
    """
    root = Node("")
    leaves = [(path, name, max(0.0, weight or 0.0), float(available) * max(0, uses or 0)) for path, name, weight, available, uses in leaves]
    for leaf in leaves:
        root.add(*leaf)
    if total is None:
        weights = sum(w for _, _, w, c in leaves if c > 0)
        total = min((c / w for _, _, w, c in leaves if w > 0 and c > 0), default=0.0) * weights
    root.share(float(total))
    return {(path, name): 0.0 for path, name, _, _ in leaves} | (root.leaves() if root.children else {})


def mixture(sizes: DataFrame, targets: DataFrame, groups: tuple[str, ...] = ("lang",), item: str = "doc_id", source: str = "source", size: str = "n_tokens", total: float | None = None, seed: int = 17) -> tuple[DataFrame, DataFrame]:
    """A mixture of the documents that ``targets`` (source, target_share, max_repeats) asks for, and its shares.

    ``groups`` are the columns of the tree's levels above the sources. ``total`` is the mixture's size in tokens; without
    one it is as large as it can be with every source that has documents at its target.
    Returns (uses, shares). uses has (source, item, epoch, n_tokens): one row for each time a document is used, at most
    ``max_repeats`` times. shares has (source, target_share, available_tokens, budget_tokens, mixed_tokens, actual_share,
    documents, most_uses): one row for each target, those without documents, too. Documents without tokens, without
    source or of a source that is not listed are not used; a null share counts as 0, a null number of repeats as 1. Null
    groups are a group of their own.
    """
    levels = [f"_g{k}" for k in range(len(groups))]
    rows = written(sizes.where((F.col(size) > 0) & F.col(source).isNotNull()).select(F.col(source).alias("source"), F.col(item).cast("long").alias("item"), F.col(size).cast("long").alias("n"), *[F.coalesce(F.col(g).cast("string"), F.lit("")).alias(k) for g, k in zip(groups, levels)]), "sizes")
    wanted = targets.where(F.col("source").isNotNull()).groupBy("source").agg(F.max("target_share").alias("target_share"), F.coalesce(F.max("max_repeats"), F.lit(1)).alias("max_repeats"))
    held = rows.groupBy("source", *levels).agg(F.sum("n").alias("available"), F.count(F.lit(1)).alias("items"))
    # the leaves of the tree are the targets by group: a table of bounded size, checked
    leaves = wanted.join(held, "source", "left").limit(MOST_LEAVES + 1).collect()
    if len(leaves) > MOST_LEAVES:
        raise ValueError(f"more than {MOST_LEAVES} leaves")
    has: dict[str, int] = {}
    for x in leaves:
        has[x["source"]] = has.get(x["source"], 0) + (x["available"] or 0)
    path = lambda x: tuple(x[k] or "" for k in levels)
    plan = budgets([(path(x), x["source"], (x["target_share"] or 0.0) * (x["available"] or 0) / (has[x["source"]] or 1), x["available"] or 0, x["max_repeats"]) for x in leaves], total)
    passes = []
    for x in leaves:
        budget, available = plan[path(x), x["source"]], x["available"] or 0
        # sums of shares may miss a whole pass by a rounding error
        whole = min(int(budget / available + 1e-9), x["max_repeats"]) if available else 0
        rest = 0.0 if not available or whole >= x["max_repeats"] else max(0.0, budget - whole * available)
        passes.append((x["source"], *path(x), x["target_share"], available, float(budget), whole, float(rest), min(MOST_BITS, int(math.log2(max(1, (x["items"] or 1) / RANGE_ITEMS))))))
    leaf = ["source", *levels]
    schema = f"source string, {''.join(f'{k} string, ' for k in levels)}target_share double, available long, budget double, whole int, rest double, bits int"
    spark = sizes.sparkSession
    planned = F.broadcast(spark.createDataFrame(passes, schema))
    # the last, partial pass: hash ranges before the one in which the prefix ends belong to it as a whole
    hashed = rows.join(planned.select(*leaf, "whole", "rest", "bits"), leaf).withColumn("h", F.xxhash64(F.lit(seed), F.col("whole") + 1, F.col("item")))
    ranged = hashed.withColumn("range", F.when(F.col("bits") > 0, F.expr("shiftrightunsigned(h, 64 - bits)")).otherwise(F.lit(0)).cast("int"))
    # hashes are ordered as unsigned numbers, as ranges are
    ranged = ranged.withColumn("h", F.col("h").bitwiseXOR(F.lit(-(2**63)))).where("rest > 0")
    sums = ranged.groupBy(*leaf, "range").agg(F.sum("n").alias("t"))
    before = written(sums.select(*leaf, "range", "t", (F.sum("t").over(Window.partitionBy(*leaf).orderBy("range")) - F.col("t")).alias("before")), "ranges")
    placed = ranged.join(small_side(before, 1_000_000), [*leaf, "range"])
    inside = placed.where("before + t <= rest")
    # a prefix: it ends where it comes closest to what is left
    upto = F.sum("n").over(Window.partitionBy(*leaf).orderBy("h", "item").rowsBetween(Window.unboundedPreceding, 0))
    ending = placed.where("before <= rest and before + t > rest").withColumn("upto", F.col("before") + upto).where("upto <= rest or upto - rest < rest - (upto - n)")
    partial = inside.select("source", "item", (F.col("whole") + 1).alias("epoch"), "n").unionByName(ending.select("source", "item", (F.col("whole") + 1).alias("epoch"), "n"))
    full = hashed.where("whole > 0").select("source", "item", F.explode(F.sequence(F.lit(1), F.col("whole"))).alias("epoch"), "n")
    uses = written(full.unionByName(partial), "uses")
    got = uses.groupBy("source").agg(F.sum("n").alias("mixed_tokens"), F.max("epoch").alias("most_uses"), F.count_if(F.col("epoch") == 1).alias("documents"))
    everything = uses.agg(F.sum("n").alias("all"))
    asked = planned.groupBy("source").agg(F.max("target_share").alias("target_share"), F.sum("available").alias("available"), F.sum("budget").alias("budget"))
    shares = asked.join(got, "source", "left").crossJoin(F.broadcast(everything)).select(
        "source",
        "target_share",
        F.col("available").alias("available_tokens"),
        F.round("budget").cast("long").alias("budget_tokens"),
        F.coalesce("mixed_tokens", F.lit(0)).alias("mixed_tokens"),
        F.coalesce(F.col("mixed_tokens") / F.col("all"), F.lit(0.0)).alias("actual_share"),
        F.coalesce("documents", F.lit(0)).alias("documents"),
        F.coalesce("most_uses", F.lit(0)).alias("most_uses"),
    )
    return uses.select(F.col("source").alias(source), F.col("item").alias(item), "epoch", F.col("n").alias("n_tokens")), shares
