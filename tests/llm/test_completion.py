"""Bin completion: undominated fillings against all subsets, and sets where best fit misses the bound."""

from collections import Counter
from itertools import combinations

import numpy as np
import pytest

from amperine.llm import completion


def counted(sizes, capacity):
    have = np.zeros(capacity + 1, np.int64)
    np.add.at(have, sizes, 1)
    return have


def whole(bins, sizes, capacity):
    return Counter(x for b in bins for x in b) == Counter(sizes) and max(map(sum, bins)) <= capacity


def test_fillings_are_all_subsets_but_dominated_ones():
    rng = np.random.default_rng(5)
    for _ in range(60):
        sizes, room = rng.integers(1, 20, 7).tolist(), int(rng.integers(5, 40))
        got = list(completion.fillings(counted(sizes, 40), room))
        kept = {items for waste, items in got if items is not None}
        every = {tuple(sorted(c, reverse=True)) for n in range(8) for c in combinations(sizes, n) if sum(c) <= room}
        assert len(got) == len(every) and kept <= every
        assert [w for w, _ in got] == sorted(w for w, _ in got)
        for items in every - kept:
            left, waste = Counter(sizes) - Counter(items), room - sum(items)
            spare = [s for s, n in left.items() if n]
            assert (
                any(s <= waste for s in spare)
                or any(x < s <= x + waste for x in items for s in spare)
                or any(sum(items[-2:]) <= s <= sum(items[-2:]) + waste for s in spare)
            )
        most = int(rng.integers(0, 6))
        assert list(completion.fillings(counted(sizes, 40), room, most)) == [g for g in got if g[0] <= most]


def test_exact_search_ends_with_a_packing_or_a_proof():
    rng = np.random.default_rng(6)
    for _ in range(20):
        sizes = rng.integers(2, 30, 10).tolist()
        best = len(completion.bin_completion(Counter(sizes), 30))
        path, done = completion.exact(Counter(sizes), 30, best, 100_000)
        assert done and whole(path, sizes, 30) and len(path) <= best
        assert completion.exact(Counter(sizes), 30, best - 1, 100_000) == (None, True)


def test_perfect_triplets_and_reruns():
    rng, sizes = np.random.default_rng(1), []
    while len(sizes) < 270:
        a, b = rng.integers(1025, 1800, 2).tolist()
        if 1025 <= 4096 - a - b < 2048:
            sizes += [a, b, 4096 - a - b]
    bins = completion.bin_completion(Counter(sizes), 4096)
    assert whole(bins, sizes, 4096) and len(bins) <= 91 < len(completion.best_fit(Counter(sizes), 4096))
    assert bins == completion.bin_completion(Counter(sizes), 4096)


# low, high, number, and the part of best fit's gap to the bound that may stay
@pytest.mark.parametrize("low, high, n, part", [(1025, 1700, 600, 0.2), (1200, 2600, 3000, 0.5), (900, 2000, 600, 0.4), (300, 2000, 600, 0)])
def test_gap_to_the_bound(low, high, n, part):
    sizes = np.random.default_rng(1).integers(low, high, n).tolist()
    bins = completion.bin_completion(Counter(sizes), 4096)
    bound, plain = completion.lower_bound(Counter(sizes), 4096), len(completion.best_fit(Counter(sizes), 4096))
    assert whole(bins, sizes, 4096) and bound <= len(bins) <= bound + part * (plain - bound)


def test_edges():
    assert completion.bin_completion(Counter(), 4096) == []
    assert completion.bin_completion(Counter({4096: 3, 1: 2}), 4096) == [[4096]] * 3 + [[1, 1]]
    assert len(completion.bin_completion(Counter({1000: 9000}), 4096)) == 2250
