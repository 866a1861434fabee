"""Problem 8: the pair that takes the place of the smallest item, against all pairs."""

import numpy as np
import pytest

from feedmill.llm import packing


def test_a_pair_below_many_larger_sizes():
    # 600 + 300 leave 100; 200 + 200 fill the 400, behind over 64 sizes too large to leave room for another
    sizes = [600, 300, 200, 200, *range(301, 401)]
    left = packing._Left(np.array(sizes), 1000)
    left.take(600), left.take(300)
    assert packing.best_two(left, 400, 300, left.smallest(100)) == (200, 200)


@pytest.mark.parametrize("seed", range(30))
def test_pairs_as_all_pairs_give_them(seed):
    rng = np.random.default_rng(seed)
    sizes = sorted(rng.integers(30, 500, int(rng.integers(2, 250))).tolist())
    bound, more = int(rng.integers(60, 600)), int(rng.integers(30, 300))
    sums = [a + b for k, a in enumerate(sizes) for b in sizes[:k] if more < a + b <= bound]
    left = packing._Left(np.array(sizes), 600)
    found = packing.best_two(left, bound, more, left.smallest(0))
    assert (sum(found) if found else None) == (max(sums) if sums else None)


def test_every_container_has_its_best_pair():
    # the largest opens it, 300 follows, then 200 + 200 fill what 300 and the gap leave
    sizes = np.array([600, 300, 200, 200])
    assert sorted(map(sorted, packing.pack(sizes, 1000))) == [[200, 200, 600], [300]]
