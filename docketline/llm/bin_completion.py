"""Bin completion branch-and-bound on a histogram of lengths.

The input is a count for each length (at most ``capacity`` of them, however many
documents there are), the output a list of fillings with how often each is used.
Around the largest remaining length all undominated fillings of the bin are
enumerated, fullest first, each only when the one before has been searched. A
filling is taken as often as the counts allow (once where that would waste too
much), so a level holds few bins as one step and the tree has steps, not bins. A
branch whose waste so far exceeds what a better packing than the incumbent may
waste is cut. Best-fit decreasing gives the first incumbent. The search ends at
the lower bound, when this tree is exhausted, or when ``max_nodes`` fillings have
been looked at; the incumbent is a whole packing in any case. On large
histograms the budget, not exhaustion, ends a search that misses the bound.
"""

from __future__ import annotations

from collections.abc import Iterator

Filling = tuple[tuple[int, int], ...]  # (length, copies), largest first
Packing = list[tuple[Filling, int]]  # (filling, bins)

MAX_NODES = 4000


def lower_bound(counts: dict[int, int], capacity: int) -> int:
    """Martello and Toth's L2: items over capacity - k get a bin each, and what
    the middle ones leave free must take the items of at least k."""
    best = -(-sum(n * c for n, c in counts.items()) // capacity)
    for k in [x for x in counts if x <= capacity // 2]:
        alone = sum(c for n, c in counts.items() if n > capacity - k)
        middle = {n: c for n, c in counts.items() if capacity - k >= n > capacity // 2}
        small = sum(n * c for n, c in counts.items() if k <= n <= capacity // 2)
        held = sum(middle.values())
        free = capacity * held - sum(n * c for n, c in middle.items())
        best = max(best, alone + held + max(0, -(-(small - free) // capacity)))
    return best


def best_fit(counts: dict[int, int], capacity: int) -> Packing:
    """Best-fit decreasing, with equal bins held as one entry and a count."""
    open_: dict[int, dict[Filling, int]] = {}  # free space -> filling -> bins
    for length in sorted(counts, reverse=True):
        left = counts[length]
        fits = sorted(r for r in open_ if r >= length)
        for room in fits:
            if not left:
                break
            each = room // length
            for filling in sorted(open_[room]):
                if not left:
                    break
                bins = open_[room][filling]
                full = min(bins, left // each)
                rest = left - full * each if full < bins else 0
                changed = [(full, each)] + ([(1, rest)] if rest else [])
                for times, copies in changed:
                    if times:
                        open_[room][filling] -= times
                        target = open_.setdefault(room - copies * length, {})
                        new = (*filling, (length, copies))
                        target[new] = target.get(new, 0) + times
                        left -= times * copies
                if not open_[room][filling]:
                    del open_[room][filling]
        each = capacity // length
        for times, copies in ((left // each, each), (1 if left % each else 0, left % each)):
            if times:
                target = open_.setdefault(capacity - copies * length, {})
                target[((length, copies),)] = target.get(((length, copies),), 0) + times
        open_ = {r: f for r, f in open_.items() if f}
    return [(f, t) for by in open_.values() for f, t in by.items()]


def undominated(items: list[int], counts: dict[int, int], room: int) -> bool:
    """Whether no other filling of ``room`` from ``counts`` can take over this one's
    items, dealt out into its own. If one can, then some items (maybe none) can
    be swapped for a single unused one that is larger, or as large as several of
    them; so it is enough to look at the sums of subsets, held as bits."""
    unused = dict(counts)
    none_or_one, several = 1, 0  # bits: sums of at most one item, of two or more
    for x in items:
        unused[x] -= 1
        several |= (several | none_or_one & ~1) << x
        none_or_one |= 1 << x
    free = sum(1 << x for x, c in unused.items() if c and x <= room)
    if several & free:
        return False
    reach, slack = none_or_one | several, room - sum(items)
    return not any(reach << d & free for d in range(1, slack + 1))


def completions(room: int, counts: dict[int, int], waste_bound: int, budget: list[int]) -> Iterator[list[int]]:
    """All undominated fillings of ``room`` that waste at most ``waste_bound``, one
    by one, fullest first and then with the largest items first. Every filling
    looked at takes one from ``budget``; at zero there are no more."""
    lengths = sorted((n for n, c in counts.items() if c and n <= room), reverse=True)
    full = (1 << room + 1) - 1
    reach = [1]  # bits: sums that the lengths from a place on can make
    for x in reversed(lengths):
        sums, left, step = reach[-1], min(counts[x], room // x), 1
        while left:
            step = min(step, left)
            sums |= sums << x * step & full
            left, step = left - step, step * 2
        reach.append(sums)
    reach.reverse()

    def choices(i: int, target: int) -> Iterator[tuple[int, int, int]]:
        for j in range(i, len(lengths)):
            if not reach[j] >> target & 1:
                return
            x = lengths[j]
            for k in range(min(counts[x], target // x), 0, -1):
                if reach[j + 1] >> target - k * x & 1:
                    yield j, k, target - k * x

    for waste in range(min(waste_bound, room) + 1):
        if not reach[0] >> room - waste & 1:
            continue
        if waste == room:
            if not lengths:
                yield []
            return
        items: list[tuple[int, int]] = []
        levels = [choices(0, room - waste)]
        while levels:
            step = next(levels[-1], None)
            if step is None:
                levels.pop()
                if items:
                    items.pop()
                continue
            j, k, target = step
            items.append((lengths[j], k))
            if target:
                levels.append(choices(j + 1, target))
                continue
            if budget[0] <= 0:
                return
            budget[0] -= 1
            filling = [x for x, n in items for _ in range(n)]
            if undominated(filling, counts, room):
                yield filling
            if filling == [room]:  # it dominates all others
                return
            items.pop()


def solve(counts: dict[int, int], capacity: int, max_nodes: int = MAX_NODES) -> Packing:
    """A packing of ``counts`` (length -> number of items, 1 <= length <=
    capacity) in as few bins as the search finds."""
    counts = {int(n): int(c) for n, c in counts.items() if c}
    if any(not 1 <= n <= capacity for n in counts):
        raise ValueError("a length is outside 1..capacity")
    if not counts:
        return []
    total = sum(n * c for n, c in counts.items())
    bound = lower_bound(counts, capacity)
    best = best_fit(counts, capacity)
    bins = sum(t for _, t in best)
    budget = [max_nodes]
    # each level: the remaining counts, waste and bins so far, the fillings left to try, the step taken
    stack = [_level(counts, 0, 0, capacity, (bins - 1) * capacity - total, budget)]
    steps: Packing = []
    while stack and bins > bound:
        left, waste, used, largest, fillings = stack[-1]
        if not left:
            if used < bins:
                best, bins = list(steps), used
            stack.pop()
            if steps:
                steps.pop()
            continue
        completion = next(fillings, None)
        if completion is None:
            stack.pop()
            if steps:
                steps.pop()
            continue
        filling = [largest, *completion]
        need: dict[int, int] = {}
        for x in filling:
            need[x] = need.get(x, 0) + 1
        times = min(left[x] // k for x, k in need.items())
        lost = waste + times * (capacity - sum(filling))
        allowed = (bins - 1) * capacity - total
        if lost > allowed:
            times = 1
            lost = waste + capacity - sum(filling)
            if lost > allowed:
                continue
        rest = dict(left)
        for x, k in need.items():
            rest[x] -= k * times
            if not rest[x]:
                del rest[x]
        steps.append((tuple(sorted(need.items(), reverse=True)), times))
        stack.append(_level(rest, lost, used + times, capacity, allowed - lost, budget))
    return best


def _level(left: dict[int, int], waste: int, used: int, capacity: int, spare: int, budget: list[int]) -> tuple:
    if not left:
        return left, waste, used, 0, iter(())
    largest = max(left)
    others = dict(left)
    others[largest] -= 1
    return left, waste, used, largest, completions(capacity - largest, others, spare, budget)
