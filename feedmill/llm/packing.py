"""Problem 8: filling containers of fixed capacity with items of varying length.

Best-two-fit. A container is filled greedily: the largest item that is left opens it, and the largest that fits goes in
next, until none fits. Then the smallest item in it gives way to two items that are left, if two fit the expanded gap more
tightly. An item is whole unless it exceeds the capacity by itself: then it is cut into full containers and a rest, and the
rest is packed like any other item.

Items are spread over shards by a hash, each of about ``SHARD_ITEMS`` items, so that no task grows with the data; a shard
leaves at most its last containers half empty. Containers are numbered through all shards.
"""

from __future__ import annotations


import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from feedmill.shared import written

SHARD_ITEMS = 40_000


class _Left:
    """The items that are left, by size; knows the largest size that is left up to a bound."""

    def __init__(self, sizes: np.ndarray, capacity: int):
        self.count = np.bincount(sizes, minlength=capacity + 1)
        self.total = int(self.count.sum())
        # below[s]: the largest size up to s of which an item is left, found by following pointers
        self.below = list(range(capacity + 1))
        for s in range(1, capacity + 1):
            if not self.count[s]:
                self.below[s] = s - 1
        self.count = self.count.tolist()

    def largest(self, bound: int) -> int:
        """The largest size up to ``bound`` of which an item is left; 0 if none."""
        below, path = self.below, []
        while bound > 0 and not self.count[bound]:
            path.append(bound)
            nxt = below[bound]
            bound = nxt if nxt != bound else bound - 1
        for p in path:
            below[p] = bound
        return bound

    def smallest(self, above: int) -> int:
        """The smallest size above a bound that no item is left up to; an item must be left."""
        size = above + 1
        while not self.count[size]:
            size += 1
        return size

    def take(self, size: int) -> None:
        self.count[size] -= 1
        self.total -= 1

    def put(self, size: int) -> None:
        if not self.count[size]:  # pointers that lead past it lead to it again
            self.below[size + 1 :] = [size if b < size else b for b in self.below[size + 1 :]]
        self.count[size] += 1
        self.total += 1


def best_two(left: _Left, bound: int, more_than: int, least: int) -> tuple[int, int] | None:
    """Two sizes that are left, of a sum up to ``bound`` and above ``more_than``, as large as can be; ``least`` is the
    smallest size that is left.

    The first of them leaves room for the least; the second is then the largest that fits.
    """
    best, found = more_than, None
    a = left.largest(bound - least)
    while a > 0 and 2 * a > best:
        b = left.largest(min(a if left.count[a] > 1 else a - 1, bound - a))
        if b and a + b > best:
            best, found = a + b, (a, b)
            if best == bound:
                break
        a = left.largest(a - 1)
    return found


def pack(sizes: np.ndarray, capacity: int) -> list[list[int]]:
    """Containers as lists of sizes; every size is between 1 and ``capacity``."""
    left = _Left(sizes, capacity)
    out = []
    while left.total:
        bin_, gap = [], capacity
        while (s := left.largest(gap)) > 0:
            left.take(s)
            bin_.append(s)
            gap -= s
        if gap and left.total > 1:
            smallest = bin_[-1]
            if two := best_two(left, gap + smallest, smallest, left.smallest(gap)):
                left.put(smallest)
                for s in two:
                    left.take(s)
                bin_[-1:] = two
        out.append(bin_)
    return out


def _packed(items: np.ndarray, sizes: np.ndarray, capacity: int) -> dict[str, np.ndarray]:
    """Container and position of every part of every item of a shard."""
    full = sizes // capacity
    rest = sizes - full * capacity
    split = (full > 0) & (sizes > capacity)
    full = np.where(split, full, 0)
    rest = np.where(split, rest, sizes)
    # full containers first, one for each full part
    n_full = int(full.sum())
    part_of_full = np.repeat(np.arange(len(items)), full)
    number = np.arange(n_full) - np.repeat(np.cumsum(full) - full, full)
    rows = {"item": [items[part_of_full]], "part_no": [number + 1], "token_from": [number * capacity], "n_tokens": [np.full(n_full, capacity)], "container": [np.arange(n_full)], "position": [np.ones(n_full, np.int64)]}
    todo = np.flatnonzero(rest > 0)
    order = todo[np.lexsort((items[todo], -rest[todo]))]
    waiting: dict[int, list[int]] = {}
    for i in order[::-1]:
        waiting.setdefault(int(rest[i]), []).append(i)
    bins = pack(rest[order], capacity) if len(order) else []
    at, container, position = [], [], []
    for k, bin_ in enumerate(bins):
        for p, s in enumerate(bin_, 1):
            at.append(waiting[s].pop())
            container.append(n_full + k)
            position.append(p)
    # items without tokens take no space: they follow in the last container
    empty = np.flatnonzero(sizes == 0)
    last = max(0, n_full + len(bins) - 1)
    follow = position[-1] if bins else int(n_full > 0)
    at, container, position = np.array([*at, *empty], np.int64), np.array([*container, *[last] * len(empty)], np.int64), np.array([*position, *range(follow + 1, follow + 1 + len(empty))], np.int64)
    for name, x in (("item", items[at]), ("part_no", full[at] + 1), ("token_from", full[at] * capacity), ("n_tokens", rest[at]), ("container", container), ("position", position)):
        rows[name].append(x)
    return {k: np.concatenate(v) for k, v in rows.items()}


def packed(sizes: DataFrame, capacities: dict[str, int], item: str = "doc_id", size: str = "n_tokens", shard_items: int = SHARD_ITEMS) -> DataFrame:
    """(limit_name, item, part_no, token_from, n_tokens, container_no, position) for each capacity.

    ``sizes`` names every item once; null sizes count as 0, negative ones, too. Every item comes out once for each
    capacity, or as parts 1, 2, ... that cover it from token 0 on if it alone exceeds the capacity. Containers are numbered
    from 1 for each capacity, positions from 1 in each. Items of size 0 take no space and follow in a last container. An
    empty table gives an empty result. Of equal sizes, the least item is packed first.
    """
    bad = [k for k, c in capacities.items() if not c or c < 1]
    if bad:
        raise ValueError(f"capacities must be positive: {bad}")
    rows = written(sizes.select(F.col(item).cast("long").alias("item"), F.greatest(F.coalesce(F.col(size), F.lit(0)), F.lit(0)).cast("long").alias("size")), "sizes")
    shards = max(1, -(-rows.count() // shard_items))
    limits = list(capacities.items())

    def per_shard(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("item")
        found = pd.DataFrame(_packed(pdf["item"].to_numpy(), pdf["size"].to_numpy(), limits[key[1]][1]))
        return found.assign(shard=key[0], limit_no=key[1])[["shard", "limit_no", "item", "part_no", "token_from", "n_tokens", "container", "position"]]

    spread = rows.withColumn("shard", F.pmod(F.xxhash64("item"), F.lit(shards)).cast("int")).withColumn("limit_no", F.explode(F.array(*[F.lit(i) for i in range(len(limits))])))
    schema = "shard int, limit_no int, item long, part_no long, token_from long, n_tokens long, container long, position long"
    parts = written(spread.groupBy("shard", "limit_no").applyInPandas(per_shard, schema), "packed")
    # one row a shard and limit: containers of the shards before
    used = parts.groupBy("limit_no", "shard").agg((F.max("container") + 1).alias("used"))
    before = used.select("limit_no", "shard", (F.sum("used").over(Window.partitionBy("limit_no").orderBy("shard")) - F.col("used")).alias("before"))
    names = F.element_at(F.array(*[F.lit(k) for k, _ in limits]), F.col("limit_no") + 1)
    joined = parts.join(F.broadcast(before) if shards * len(limits) <= 100_000 else before, ["limit_no", "shard"])
    return joined.select(names.alias("limit_name"), F.col("item").alias(item), F.col("part_no").cast("int").alias("part_no"), "token_from", "n_tokens", (F.col("before") + F.col("container") + 1).alias("container_no"), F.col("position").cast("int").alias("position"))
