"""Problem 10: the programme against all pairs of boundaries."""

import numpy as np
import pytest

from feedmill.llm import pieces


def model(sizes, cost, capacity, overlap):
    """The least cost over all word boundaries."""
    n, total = len(sizes) - 1, int(sizes[-1])
    count = max(2, -(-(total - overlap) // (capacity - overlap)))
    even = (total - overlap) / count
    best = [0.0] + [np.inf] * n
    for i in range(1, n + 1):
        for j in range(i):
            begin = max(s for s in sizes[: j + 1] if s <= sizes[j] - overlap or s == 0)
            if sizes[i] - begin <= capacity:
                best[i] = min(best[i], best[j] + pieces.UNEVEN * ((sizes[i] - sizes[j]) / even - 1) ** 2 + pieces.PIECE + (cost[i] if i < n else 0.0))
    return best[n]


def cost_of(found, sizes, cost, capacity, overlap):
    n, total = len(sizes) - 1, int(sizes[-1])
    even = (total - overlap) / max(2, -(-(total - overlap) // (capacity - overlap)))
    ends = [0] + [b for _, b in found]
    assert all(sizes[b] - sizes[a] <= capacity for a, b in found) and ends[-1] == n
    return sum(pieces.UNEVEN * ((sizes[b] - sizes[a]) / even - 1) ** 2 + pieces.PIECE + (cost[b] if b < n else 0.0) for a, b in zip(ends, ends[1:]))


def test_a_clause_that_saves_a_piece():
    sizes, cost = np.arange(513), np.full(513, pieces.WORD)
    cost[80:512:80] = pieces.SENTENCE
    cost[256] = pieces.CLAUSE
    assert pieces.cuts(sizes, cost, 256, 0) == [(0, 256), (256, 512)]
    cost[256] = pieces.WORD
    assert pieces.cuts(sizes, cost, 256, 0) == [(0, 256), (256, 512)]


@pytest.mark.parametrize("seed", range(40))
def test_no_way_is_cheaper(seed):
    rng = np.random.default_rng(seed)
    n, capacity = int(rng.integers(60, 160)), int(rng.integers(30, 90))
    overlap = int(rng.choice([0, capacity // 8, capacity // 3]))
    sizes = np.concatenate(([0], np.cumsum(rng.integers(1, 4, n))))
    kinds = [pieces.PARAGRAPH, pieces.LINE, pieces.SENTENCE, pieces.CLAUSE, pieces.WORD, pieces.INSIDE]
    cost = rng.choice(kinds, n + 1, p=[0.01, 0.01, 0.07, 0.07, 0.8, 0.04])
    found = pieces.cuts(sizes, cost, capacity, overlap)
    assert cost_of(found, sizes, cost, capacity, overlap) == pytest.approx(model(sizes.tolist(), cost, capacity, overlap))
