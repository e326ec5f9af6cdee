"""Bin completion over a histogram of lengths: the packing plan of any number of pieces.

Pieces of equal length are interchangeable, so the problem is a histogram with at most one count per token
length, whatever the size of the corpus. A plan lists fillings and how often each is used. The incumbent is the
best-fit decreasing packing. The search then completes bins around the largest remaining length with undominated
fillings, most filled first, each used as often as the counts allow; a branch is cut as soon as its waste leaves
no room for fewer bins than the incumbent. It ends at the lower bound or after a fixed number of branches,
and always has a whole packing.
"""

from __future__ import annotations

from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator

Filling = tuple[int, ...]
Plan = list[tuple[Filling, int]]


def n_bins(plan: Plan) -> int:
    return sum(times for _, times in plan)


def lower_bound(counts: dict[int, int], capacity: int) -> int:
    """Bins that any packing needs: by volume, and by pieces of which no two fit together (all cuts at half)."""
    volume = -(-sum(length * n for length, n in counts.items()) // capacity)
    best = volume
    halves = sorted(length for length in counts if 2 * length <= capacity)
    for low in [0, *halves[:: max(1, len(halves) // 64)]]:
        alone = sum(n for length, n in counts.items() if length > capacity - low)
        large = sum(n for length, n in counts.items() if capacity / 2 < length <= capacity - low)
        room = large * capacity - sum(length * n for length, n in counts.items() if capacity / 2 < length <= capacity - low)
        small = sum(length * n for length, n in counts.items() if low <= length <= capacity / 2)
        best = max(best, alone + large + max(0, -(-(small - room) // capacity)))
    return best


def best_fit(counts: dict[int, int], capacity: int) -> Plan:
    """Best-fit decreasing, many equal bins at a time."""
    open_bins: dict[int, list[list]] = {}  # room left -> [filling, number of bins]
    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            rooms = [r for r in open_bins if r >= length]
            room = min(rooms) if rooms else capacity
            if rooms:
                filling, bins = open_bins[room].pop()
                if not open_bins[room]:
                    del open_bins[room]
            else:
                filling, bins = (), -(-left // max(1, capacity // length))
            each = room // length
            full = min(bins, left // each)
            parts = [(each, full)]
            left -= each * full
            rest = bins - full
            if rest and left:
                parts.append((left, 1))
                left, rest = 0, rest - 1
            if rest and rooms:
                parts.append((0, rest))
            for k, times in parts:
                if times:
                    open_bins.setdefault(room - k * length, []).append([filling + (length,) * k, times])
    return [(filling, times) for bins in open_bins.values() for filling, times in bins if filling]


def fillings(lengths: list[int], counts: dict[int, int], room: int, slack: int, effort: int) -> Iterator[Filling]:
    """Undominated fillings of ``room`` that waste at most ``slack``, found within ``effort`` steps.

    lengths: those with a count, ascending. A filling is dominated if a further piece fits, or if two of its pieces
    could be one available piece of their joint length; a single piece that fills the room dominates all others.
    """
    if counts.get(room, 0):
        yield (room,)
        return
    steps = effort
    stack: list[tuple[int, int, Filling]] = [(bisect_right(lengths, room) - 1, room, ())]
    while stack and steps > 0:
        steps -= 1
        at, left, chosen = stack.pop()
        while at >= 0 and (lengths[at] > left or counts[lengths[at]] <= chosen.count(lengths[at])):
            at -= 1
        if at < 0:
            if left <= slack and not any(counts.get(a + b, 0) for i, a in enumerate(chosen) for b in chosen[i + 1:]):
                yield chosen
            continue
        length = lengths[at]
        # Without this length: only if smaller ones can still fill what must be filled.
        stack.append((at - 1, left, chosen)) if at and _reach(lengths, counts, at - 1, left - slack) else None
        stack.append((at, left - length, chosen + (length,)))


def _reach(lengths: list[int], counts: dict[int, int], at: int, need: int) -> bool:
    """Whether pieces up to place ``at`` add up to ``need``; looks at few of them."""
    for i in range(at, max(-1, at - 8), -1):
        need -= lengths[i] * counts[lengths[i]]
        if need <= 0:
            return True
    return at >= 8


def complete(counts: dict[int, int], capacity: int, branches: int = 20_000, effort: int = 400, wide: int = 4) -> Plan:
    """A plan with as few bins as the search finds. counts: pieces by length, lengths from 1 to capacity."""
    counts = {length: n for length, n in counts.items() if n}
    incumbent = best_fit(counts, capacity)
    least = lower_bound(counts, capacity)
    if n_bins(incumbent) <= least:
        return incumbent
    total = sum(length * n for length, n in counts.items())
    left, lengths = dict(counts), sorted(counts)
    plan: Plan = []
    waste = 0

    def options() -> Iterator[Filling]:
        largest = lengths[-1]
        room, slack = capacity - largest, capacity * (n_bins(incumbent) - 1) - total - waste
        left[largest] -= 1
        try:
            found = []
            # Tight fillings first: most bins can be filled to the last token.
            for bound in sorted({0, min(8, slack), max(0, min(64, slack)), max(0, min(room, slack))}):
                found = [(*sorted(f, reverse=True),) for f, _ in zip(fillings(lengths, left, room, bound, effort), range(wide), strict=False)]
                if found:
                    break
            if not found:  # the best-fit completion
                greedy, r, seen = [], room, Counter()
                at = bisect_right(lengths, r) - 1
                while at >= 0:
                    length = lengths[at]
                    if length <= r and left[length] > seen[length]:
                        greedy.append(length)
                        seen[length] += 1
                        r -= length
                    else:
                        at -= 1
                found = [tuple(greedy)]
        finally:
            left[largest] += 1
        return iter(sorted(dict.fromkeys((largest, *f) for f in found), key=lambda f: -sum(f)))

    stack: list[Iterator[Filling]] = [options()]
    undo: list[tuple[Filling, int, int]] = []
    while stack and branches > 0:
        branches -= 1
        filling = next(stack[-1], None)
        allowed = capacity * (n_bins(incumbent) - 1) - total
        if filling is None:
            stack.pop()
            if undo:
                filling, times, lost = undo.pop()
                plan.pop()
                waste -= lost
                for length, k in Counter(filling).items():
                    left[length] += k * times
                lengths = sorted(length for length, n in left.items() if n)
            continue
        need = Counter(filling)
        times = min(left[length] // k for length, k in need.items())
        lost = (capacity - sum(filling)) * times
        if waste + lost > allowed:
            fits = (allowed - waste) // max(1, capacity - sum(filling))
            if fits <= 0:
                continue
            times, lost = fits, (capacity - sum(filling)) * fits
        for length, k in need.items():
            left[length] -= k * times
        lengths = [length for length in lengths if left[length]]
        waste += lost
        plan.append((filling, times))
        undo.append((filling, times, lost))
        if not lengths:
            if n_bins(plan) < n_bins(incumbent):
                incumbent = list(plan)
                if n_bins(incumbent) <= least:
                    return incumbent
            stack.append(iter(()))
        else:
            stack.append(options())
    return incumbent
