"""Bin completion over a histogram of item sizes.

The input is how many items there are of each size, at most ``capacity`` rows
whatever the data; the output is a list of fillings, each with how many bins
use it.  The search fills one bin at a time around the largest item left and
branches on the undominated fillings of the rest, fullest first and larger
items first among equals; which sums the sizes left can make is known exactly,
so any filling has its turn and is sought only when the ones before it failed.
A filling is tried for as many bins as it lasts, then for half as many down to
one.  It is dominated when one item (or two of its items) could give way to a
larger item that is left and still fits.  A branch ends when the waste it has
committed to exceeds what a solution with fewer bins than the incumbent could
afford.  The first incumbent is best-fit decreasing; the search stops at the
lower bound or after ``max_nodes`` fillings, or four times those of the
incumbent if that is more; the path it is on is then completed by best fit,
and the best plan is returned.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right, insort
from collections import Counter
from collections.abc import Iterator
from math import ceil

Filling = tuple[int, ...]  # item sizes, largest first
Plan = list[tuple[Filling, int]]  # (filling, bins that use it)


class _Stock:
    """Items left: count per size, and the sorted sizes that are left."""

    def __init__(self, counts: dict[int, int]) -> None:
        self.counts = {size: n for size, n in counts.items() if n > 0}
        self.sizes = sorted(self.counts)

    def change(self, filling: Filling, bins: int) -> None:
        """Take the items of so many bins out (``bins`` > 0) or put them back (< 0)."""
        for size, need in Counter(filling).items():
            before = self.counts.get(size, 0)
            self.counts[size] = before - need * bins
            if self.counts[size] == 0:
                self.sizes.pop(bisect_left(self.sizes, size))
            elif before == 0:
                insort(self.sizes, size)

    def bins_of(self, filling: Filling) -> int:
        return min(self.counts[size] // need for size, need in Counter(filling).items())

    def at_most(self, room: int, used: Counter) -> Iterator[int]:
        """Sizes that fit and are left beyond ``used``, largest first."""
        for i in range(bisect_right(self.sizes, room) - 1, -1, -1):
            if self.counts[self.sizes[i]] > used[self.sizes[i]]:
                yield self.sizes[i]


def _best_fit(counts: dict[int, int], capacity: int) -> Plan:
    """Each bin takes the largest item, then again and again the one that leaves least room."""
    stock, plan = _Stock(counts), []
    while stock.sizes:
        filling, used, room = [], Counter(), capacity
        while (size := next(stock.at_most(room, used), None)) is not None:
            filling.append(size)
            used[size] += 1
            room -= size
        bins = stock.bins_of(tuple(filling))
        stock.change(tuple(filling), bins)
        plan.append((tuple(filling), bins))
    return plan


def lower_bound(counts: dict[int, int], capacity: int) -> int:
    """Bins that any packing needs: total size, or the large items with what cannot share their bins (Martello and Toth)."""
    items = sorted(counts.items())
    total = sum(size * n for size, n in items)
    best = ceil(total / capacity)
    for k in sorted({size for size, _ in items if 2 * size <= capacity} | {0}):
        over = sum(n for size, n in items if size > capacity - k)
        half = [(size, n) for size, n in items if capacity - k >= size and 2 * size > capacity]
        n_half, used = sum(n for _, n in half), sum(size * n for size, n in half)
        small = sum(size * n for size, n in items if k <= size and 2 * size <= capacity)
        best = max(best, over + n_half + max(0, ceil((small - (n_half * capacity - used)) / capacity)))
    return best


def _dominated(filling: Filling, room: int, stock: _Stock) -> bool:
    """Whether an item left could replace one item, or two, of the completion and still fit."""
    used, rest = Counter(filling), filling[1:]
    sizes = sorted(set(rest))
    for i, x in enumerate(sizes):
        spots = [(x + 1, x + room)] + [(x + y, x + y + room) for y in sizes[i:] if y > x or used[x] - (x == filling[0]) > 1]
        for low, high in spots:
            size = next(stock.at_most(high, used), 0)
            if size >= low and size <= filling[0]:
                return True
    return False


def _next_filling(stock: _Stock, capacity: int, last: Filling | None) -> Filling | None:
    """The filling around the largest item left that follows ``last`` (null: the first) by waste, then by larger items first; null after the last one.

    Every filling that the stock allows has its place in this order.  ``reach[i]``
    has the sums that the ``i`` smallest sizes can make as bits, so that each
    step leads to a filling and none is walked in vain.  Nothing is kept between
    calls: a long path would hold a table per bin.
    """
    top = stock.sizes[-1]
    room = capacity - top
    sizes = stock.sizes[: bisect_right(stock.sizes, room)]
    copies = [min(stock.counts[s] - (s == top), room // s) for s in sizes]
    reach, every = [1], (1 << room + 1) - 1
    for size, n in zip(sizes, copies):
        sums, step = reach[-1], 1
        while n > 0 and sums != every:
            sums |= sums << size * min(step, n)
            n, step = n - step, step * 2
        reach.append(sums & every)

    def fill(need: int, i: int) -> list[int]:
        """Items of the ``i`` smallest sizes that make ``need``, larger ones first; ``reach[i]`` has it."""
        out: list[int] = []
        while need:
            i = min(i, bisect_right(sizes, need)) - 1
            for n in range(min(copies[i], need // sizes[i]), 0, -1):
                if reach[i] >> need - n * sizes[i] & 1:
                    out += [sizes[i]] * n
                    need -= n * sizes[i]
                    break
        return out

    if last is None:
        return (top, *fill(reach[-1].bit_length() - 1, len(sizes)))
    rest, need = list(last[1:]), 0
    while rest:  # the smallest item that can give way to smaller ones of the same sum
        size = rest.pop()
        need += size
        i = bisect_left(sizes, size)
        if reach[i] >> need & 1:
            return (top, *rest, *fill(need, i))
    fuller = reach[-1] & (1 << need) - 1
    return (top, *fill(fuller.bit_length() - 1, len(sizes))) if fuller else None


def search_bins(counts: dict[int, int], capacity: int, max_nodes: int = 4_000) -> tuple[Plan, int, int]:
    """The plan of ``complete_bins``, how many fillings the search tried and how many complete plans it reached."""
    incumbent = _best_fit(counts, capacity)
    fewest, least = sum(n for _, n in incumbent), lower_bound(counts, capacity)
    max_nodes = max(max_nodes, 4 * len(incumbent))
    total = sum(size * n for size, n in counts.items())
    stock, path = _Stock(counts), []
    waste = bins = nodes = leaves = 0
    tried: list[tuple[Filling | None, int]] = [(None, 0)] if fewest > least else []  # of each open node the last filling and its bins
    while tried and fewest > least and nodes < max_nodes:
        if len(path) == len(tried):
            filling, n, lost = path.pop()
            stock.change(filling, -n)
            waste, bins = waste - lost, bins - n
        nodes += 1
        before, n = tried[-1]
        filling, n = before, n // 2  # the same filling for fewer bins, then the next filling
        if n == 0:
            filling = _next_filling(stock, capacity, before)
            if filling is None:
                tried.pop()
                continue
            n = stock.bins_of(filling)
        lost = capacity - sum(filling)
        spare = (fewest - 1) * capacity - total - waste
        if lost > spare:  # as with all that follow
            tried.pop()
            continue
        if filling != before and before is not None and _dominated(filling, lost, stock):
            tried[-1] = filling, 0
            continue
        n = min(n, spare // lost) if lost else n  # as many of them as the bound allows
        tried[-1] = filling, n
        stock.change(filling, n)
        path.append((filling, n, lost * n))
        waste, bins = waste + lost * n, bins + n
        if stock.sizes:
            tried.append((None, 0))
            continue
        leaves += 1
        if bins < fewest:
            fewest, incumbent = bins, [(f, k) for f, k, _ in path]
    if fewest > least and stock.sizes and path:  # stopped on the way down
        rest = _best_fit(stock.counts, capacity)
        if bins + sum(n for _, n in rest) < fewest:
            incumbent = [(f, k) for f, k, _ in path] + rest
    return incumbent, nodes, leaves


def complete_bins(counts: dict[int, int], capacity: int, max_nodes: int = 4_000) -> Plan:
    """Fillings with their numbers of bins that hold every item; sizes lie in 1..capacity."""
    return search_bins(counts, capacity, max_nodes)[0]
