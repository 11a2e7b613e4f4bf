"""Bin completion: branch and bound for packing sizes into as few bins as possible.

A bin is completed around the largest size left. `fillings` enumerates every undominated
filling of its room, least waste first: a table of reachable sums guides it, so it meets no
dead end. `exact` is depth-first branch and bound over these fillings, cut by the waste a
better packing may have. It proves small inputs. Larger ones are searched in parts: best fit
and dives through the tree are incumbents, and then sets of bins of the incumbent are opened
and completed again, by dives and by `exact`, while the bound of Martello and Toth is not met.
The number of openings grows with the gap to that bound; the draws are seeded, so reruns agree.
"""

from __future__ import annotations

import math
from bisect import bisect_left, insort
from collections import Counter
from collections.abc import Iterator

import numpy as np

# Openings of a search: some at least, and more for every bin above the bound.
OPENINGS = 1500
OPENINGS_PER_BIN = 60
# Openings without gain after which a search ends.
PATIENCE = 1500
# Bins opened together, steps of one exact search in them, sizes of an input searched exactly.
OPENED = 40
NODES = 100
SMALL = 60


def lower_bound(counts: dict[int, int], capacity: int) -> int:
    """The larger of the volume bound and L2 of Martello and Toth."""
    have = np.zeros(capacity + 1, np.int64)
    for size, n in counts.items():
        have[size] += n
    numbers = np.arange(capacity + 1)
    number = np.concatenate(([0], np.cumsum(have)))
    volume = np.concatenate(([0], np.cumsum(have * numbers)))
    best, half = -(-int(volume[-1]) // capacity), capacity // 2
    for a in np.flatnonzero(have[: half + 1]).tolist():
        alone = int(number[-1] - number[capacity - a + 1])
        large = int(number[capacity - a + 1] - number[half + 1])
        free = large * capacity - int(volume[capacity - a + 1] - volume[half + 1])
        small = int(volume[half + 1] - volume[a])
        best = max(best, alone + large + max(0, -(-(small - free) // capacity)))
        # the same by number: how many sizes of at least `a` fit beside a large one, or alone
        beside = int((have[half + 1 : capacity - a + 1] * ((capacity - numbers[half + 1 : capacity - a + 1]) // a)).sum())
        many = int(number[half + 1] - number[a])
        best = max(best, alone + large + max(0, -(-(many - beside) // (capacity // a))))
    return max(best, int(number[-1] - number[half + 1]))


def best_fit(counts: dict[int, int], capacity: int) -> list[list[int]]:
    """Best fit decreasing: each item goes to the fullest bin that has room for it."""
    rooms: list[tuple[int, int]] = []
    bins: list[list[int]] = []
    for size in sorted(counts, reverse=True):
        for _ in range(counts[size]):
            at = bisect_left(rooms, (size, -1))
            if at == len(rooms):
                bins.append([size])
                room, number = capacity, len(bins) - 1
            else:
                room, number = rooms.pop(at)
                bins[number].append(size)
            if room > size:
                insort(rooms, (room - size, number))
    return bins


def _reach(sizes: list[int], counts: list[int], room: int) -> list[int]:
    """Bit t of entry i: whether sizes from the i-th on can sum to t, for t up to `room`."""
    mask = (1 << room + 1) - 1
    reach = [1] * (len(sizes) + 1)
    for i in range(len(sizes) - 1, -1, -1):
        bits, n, step = reach[i + 1], min(counts[i], room // sizes[i]), 1
        while n > 0:
            take = min(step, n)
            bits |= bits << take * sizes[i] & mask
            n, step = n - take, step * 2
        reach[i] = bits
    return reach


def fillings(have: np.ndarray, room: int, most: int | None = None) -> Iterator[tuple[int, tuple | None]]:
    """Every undominated filling of `room` with its waste up to `most`, least waste first.

    None stands for a dominated filling, so that a caller can count it as a step. A filling is dominated if a size left over could be added, or stand for one of its items
    or for its two smallest ones, within the waste.
    """
    found = np.flatnonzero(have[: room + 1])[::-1]
    sizes, counts = found.tolist(), have[found].tolist()
    reach = _reach(sizes, counts, room)

    def expand(i: int, total: int, items: tuple) -> Iterator[tuple]:
        if not total:
            yield items
            return
        while i < len(sizes) and reach[i] >> total & 1:
            size = sizes[i]
            for n in range(min(counts[i], total // size), 0, -1):
                if reach[i + 1] >> total - n * size & 1:
                    yield from expand(i + 1, total - n * size, items + (size,) * n)
            i += 1

    def spare(low: int, high: int, items: tuple) -> bool:
        return any(have[s] > items.count(s) for s in range(low, min(high, len(have) - 1) + 1))

    for total in range(room, max(room - (room if most is None else most), 0) - 1, -1):
        if reach[0] >> total & 1:
            waste = room - total
            for items in expand(0, total, ()):
                dominated = (
                    waste and spare(1, waste, items)
                    or waste and any(spare(x + 1, x + waste, items) for x in set(items))
                    # one size for the two smallest items leaves these for other bins
                    or len(items) > 1 and spare(sum(items[-2:]), sum(items[-2:]) + waste, items)
                )
                yield waste, None if dominated else items


def exact(counts: dict[int, int], capacity: int, target: int, nodes: int = NODES) -> tuple[list[tuple] | None, bool]:
    """A packing into at most `target` bins, or None; and whether the search was complete."""
    have = np.zeros(capacity + 1, np.int64)
    for size, n in counts.items():
        have[size] = n
    spare = target * capacity - sum(s * n for s, n in counts.items())
    path: list[tuple] = []
    wastes: list[int] = []
    options: list[tuple[int, Iterator]] = []
    while nodes:
        nodes -= 1
        left = np.flatnonzero(have)
        if len(left) == 0:
            return path, True
        if len(options) == len(path):
            largest, allowed = int(left[-1]), spare - sum(wastes)
            if len(path) == target or allowed < 0:
                options.append((largest, iter(())))
            else:
                rest = have.copy()
                rest[largest] -= 1
                options.append((largest, fillings(rest, capacity - largest, allowed)))
        largest, choice = options[-1]
        waste, items = next(choice, (None, None))
        if items is not None:
            np.subtract.at(have, [largest, *items], 1)
            path.append((largest, *items))
            wastes.append(waste)
        elif waste is None:
            options.pop()
            if not path:
                return None, True
            np.add.at(have, list(path.pop()), 1)
            wastes.pop()
    return None, False


def dive(have: np.ndarray, capacity: int, toll: int, draw: np.random.Generator | None) -> list[tuple]:
    """Completes bin after bin without turning back; empties `have`.

    The filling taken has the least waste plus `toll` for each of its items: with a toll,
    small sizes are kept for bins that need them. Equals are drawn, or else the one with the
    largest item is taken.
    """
    bins = []
    numbers = np.arange(capacity + 1)
    present = np.flatnonzero(have)
    top, low = (int(present[-1]), int(present[0])) if len(present) else (0, 1)
    while top:
        have[top] -= 1
        room, items = capacity - top, ()
        while low <= capacity and not have[low]:
            low += 1
        if low <= room:
            near = np.maximum.accumulate(np.where(have[: room + 1] > 0, numbers[: room + 1], 0))
            first = np.flatnonzero(have[low : room + 1]) + low
            second = near[np.minimum(room - first, first)]
            lone = (second == first) & (have[first] < 2)
            second[lone] = near[first[lone] - 1]
            cost = room - first - second + toll * (1 + (second > 0))
            alone = int(near[room])
            if room - alone + toll <= cost.min():
                items = (alone,)
                least = room - alone + toll
            else:
                least = int(cost.min())
                at = np.flatnonzero(cost == least)
                i = at[-1] if draw is None else at[draw.integers(len(at))]
                items = (int(first[i]), int(second[i])) if second[i] else (int(first[i]),)
            if 3 * low <= room and room - sum(items):
                waste, deep = next((w, f) for w, f in fillings(have, room) if f is not None)
                if waste + toll * len(deep) < least:
                    items = deep
            for x in items:
                have[x] -= 1
        bins.append((top, *items))
        while top and not have[top]:
            top -= 1
    return bins


def bin_completion(counts: dict[int, int], capacity: int) -> list[list[int]]:
    """Bins of sizes; as few as the search finds."""
    full = [[capacity]] * counts.get(capacity, 0)
    counts = {s: n for s, n in counts.items() if 0 < s < capacity and n}
    bound, best = lower_bound(counts, capacity), [tuple(b) for b in best_fit(counts, capacity)]
    have = np.zeros(capacity + 1, np.int64)
    for size, n in counts.items():
        have[size] = n
    toll = 0
    for try_toll in (0, *(capacity >> k for k in range(7, 2, -1))):
        if len(best) == bound:
            break
        got = dive(have.copy(), capacity, try_toll, None)
        if len(got) < len(best):
            toll, best = try_toll, got
    while len(best) > bound and sum(counts.values()) <= SMALL:
        got, _ = exact(counts, capacity, len(best) - 1, 200 * NODES)
        if got is None:
            break
        best = got
    if len(best) > bound:
        best = _reopen(best, capacity, bound, toll)
    return full + [list(b) for b in best]


def _reopen(bins: list[tuple], capacity: int, bound: int, toll: int) -> list[tuple]:
    """Opens sets of bins and completes them again.

    A set takes its old bins' place if it needs fewer, or as many whose room left is not
    less uneven: uneven room gathers in few bins, which can then be emptied.
    """
    draw = np.random.default_rng(len(bins))
    waste = np.array([capacity - sum(b) for b in bins])
    steps, idle = OPENINGS + OPENINGS_PER_BIN * (len(bins) - bound), 0
    while len(bins) > bound and steps and idle < PATIENCE:
        steps, idle = steps - 1, idle + 1
        many = min(len(bins), int(draw.integers(4, OPENED)))
        # emptier bins are likelier to be opened
        chance = draw.random(len(bins)) ** (1 / (waste + capacity / 256))
        own = np.argpartition(chance, -many)[-many:] if many < len(bins) else np.arange(many)
        have = np.zeros(capacity + 1, np.int64)
        for i in own:
            np.add.at(have, list(bins[i]), 1)
        old = waste[own]
        got = None
        if many <= 12 and old.sum() >= capacity:
            sizes = np.flatnonzero(have)
            content = dict(zip(sizes.tolist(), have[sizes].tolist()))
            got, _ = exact(content, capacity, many - int(old.sum()) // capacity)
        if got is None:
            got = dive(have, capacity, toll if draw.random() < 0.7 else 0, draw)
        new = np.array([capacity - sum(b) for b in got])
        uneven = int((new**2).sum() - (old**2).sum())
        if len(got) < many or len(got) == many and uneven >= 0:
            if len(got) < many or uneven:
                idle = 0
            keep = np.ones(len(bins), bool)
            keep[own] = False
            bins = [bins[i] for i in np.flatnonzero(keep)] + got
            waste = np.concatenate((waste[keep], new))
    return bins
