"""A grouping genetic algorithm for bin packing; the helper of one task.

A solution is a list of bins, a bin a list of item numbers. Crossover takes well-filled whole bins of one parent into a
copy of the other, drops the bins there that share items with them, and puts the displaced items back by best fit.
"""

from __future__ import annotations

import random

import numpy as np


class Bins:
    """Bins of one capacity with a best-fit search: a bit mask says which amounts of free room occur."""

    def __init__(self, sizes: list[int], capacity: int) -> None:
        self.sizes, self.capacity = sizes, capacity
        self.bins: list[list[int]] = []
        self.room: list[int] = []
        self.with_room: dict[int, list[int]] = {}
        self.mask = 0

    def open(self, items: list[int]) -> None:
        room = self.capacity - sum(map(self.sizes.__getitem__, items))
        self.bins.append(items)
        self.room.append(room)
        self._note(len(self.bins) - 1, room)

    def _note(self, b: int, room: int) -> None:
        held = self.with_room.setdefault(room, [])
        held.append(b)
        self.mask |= 1 << room

    def best_fit(self, items: list[int]) -> None:
        """Each item into the bin that leaves least room, a new one if none holds it."""
        sizes, with_room = self.sizes, self.with_room
        for item in items:
            size = sizes[item]
            above = self.mask >> size
            if not above:
                self.open([item])
                continue
            room = size + (above & -above).bit_length() - 1
            held = with_room[room]
            b = held.pop()
            if not held:
                self.mask &= ~(1 << room)
            self.bins[b].append(item)
            self.room[b] = room - size
            self._note(b, room - size)


def decreasing(items, sizes: list[int]) -> list[int]:
    return sorted(items, key=lambda i: (-sizes[i], i))


def fitness(solution: Bins) -> float:
    """Mean square fill: prefers few bins, and among equal numbers full ones beside nearly empty ones."""
    c = solution.capacity
    return sum((c - r) * (c - r) for r in solution.room) / (c * c * max(1, len(solution.bins)))


def packed(sizes: list[int], capacity: int, keys: list[float]) -> Bins:
    """Best fit in decreasing order of keys."""
    out = Bins(sizes, capacity)
    out.best_fit(sorted(range(len(sizes)), key=lambda i: (-keys[i], i)))
    return out


def rebuilt(sizes: list[int], capacity: int, kept: list[list[int]], loose: list[int]) -> Bins:
    out = Bins(sizes, capacity)
    for items in kept:
        out.open(list(items))
    out.best_fit(decreasing(loose, sizes))
    return out


def crossover(base: Bins, donor: Bins, pick: random.Random) -> Bins:
    good = sorted(range(len(donor.bins)), key=lambda b: (donor.room[b], b))
    good = good[:max(1, len(good) // 2)]
    injected = [donor.bins[b] for b in pick.sample(good, max(1, len(good) // 2))]
    inside = {i for items in injected for i in items}
    kept, loose = list(injected), []
    for items in base.bins:
        rest = [i for i in items if i not in inside]
        if len(rest) == len(items):
            kept.append(items)
        else:
            loose += rest
    return rebuilt(base.sizes, base.capacity, kept, loose)


def shaken(solution: Bins, pick: random.Random) -> Bins:
    """Mutation: the emptiest bins and a few others are dissolved."""
    by_room = sorted(range(len(solution.bins)), key=lambda b: (-solution.room[b], b))
    few = max(1, len(by_room) // 50)
    gone = set(by_room[:few]) | set(pick.sample(range(len(by_room)), min(len(by_room), 2 * few)))
    kept = [items for b, items in enumerate(solution.bins) if b not in gone]
    return rebuilt(solution.sizes, solution.capacity, kept, [i for b in sorted(gone) for i in solution.bins[b]])


def labels(solution: Bins) -> list[int]:
    """The bin of each item."""
    out = [0] * len(solution.sizes)
    for b, items in enumerate(solution.bins):
        for i in items:
            out[i] = b
    return out


def from_labels(sizes: list[int], capacity: int, of: list[int]) -> Bins:
    bins: dict[int, list[int]] = {}
    for i, b in enumerate(of):
        bins.setdefault(b, []).append(i)
    return rebuilt(sizes, capacity, list(bins.values()), [])


def evolved(sizes: list[int], capacity: int, population: list[list[int]], seed: int, generations: int, members: int) -> list[list[int]]:
    """The population after some generations, best first; it starts from best-fit solutions where too few are given.
    It stops at the fewest bins that the total allows."""
    if not sizes:
        return [[]]
    least = -(-sum(sizes) // capacity)
    pick = random.Random(seed)
    pool = [from_labels(sizes, capacity, p) for p in population]
    while len(pool) < members and not any(len(p.bins) <= least for p in pool):
        wobble = 0.0 if not pool else 0.05
        pool.append(packed(sizes, capacity, [s * (1 + wobble * pick.random()) for s in sizes]))
    rank = lambda p: (len(p.bins), -fitness(p))
    pool.sort(key=rank)
    for _ in range(generations):
        if len(pool[0].bins) <= least:
            break
        a, b = sorted(pick.sample(range(len(pool)), 2)) if len(pool) > 1 else (0, 0)
        child = crossover(pool[a], pool[b], pick)
        if pick.random() < 0.5:
            child = shaken(child, pick)
        if rank(child) < rank(pool[-1]):
            pool[-1] = child
            pool.sort(key=rank)
    return [labels(p) for p in pool[:members]]


def offsets(sizes: np.ndarray, of: np.ndarray) -> np.ndarray:
    """Where each item begins in its bin, items in order."""
    order = np.argsort(of, kind="stable")
    before = np.cumsum(sizes[order]) - sizes[order]
    first = np.searchsorted(of[order], of[order])
    out = np.zeros(len(sizes), np.int64)
    out[order] = before - before[first]
    return out
