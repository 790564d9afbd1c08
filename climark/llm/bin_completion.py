"""Bin completion over a histogram of lengths.

Items of equal length are alike, so a packing is a list of *patterns* (the
lengths in a bin) with the number of bins of each.  The largest remaining length
opens the next bins; its undominated fillings are enumerated (best filled
first), the chosen one is used for as many bins as the counts allow, and the
search goes on with what is left.  Branches whose waste bound cannot beat the
incumbent are cut.  The first incumbent is the best-fit decreasing packing.

Work and memory follow the number of distinct lengths (at most the capacity),
not the number of items.  The search stops at the lower bound or after
``max_nodes`` nodes and returns its best packing, which holds every item in any
case.
"""

from __future__ import annotations

import bisect

MAX_NODES = 6000
FILLINGS = 6        # branches kept at a node, best filled first
_STEPS = 400        # work limit of one enumeration

Pattern = tuple[tuple[int, ...], int]     # lengths in a bin (descending), number of bins


def lower_bound(counts: dict[int, int], capacity: int) -> int:
    """Fewest bins possible: by volume, and by items that cannot share a bin."""
    volume = -(-sum(n * c for n, c in counts.items()) // capacity)
    large = sum(c for n, c in counts.items() if 2 * n > capacity)
    half = sum(c for n, c in counts.items() if 2 * n == capacity)
    return max(volume, large + -(-half // 2))


def best_fit(counts: dict[int, int], capacity: int) -> list[Pattern]:
    """Best-fit decreasing: every length goes to the fullest bins that take it."""
    free: dict[int, dict[tuple[int, ...], int]] = {}      # free space -> pattern -> bins
    spaces: list[int] = []

    def add(pattern: tuple[int, ...], space: int, bins: int) -> None:
        if space not in free:
            free[space] = {}
            bisect.insort(spaces, space)
        free[space][pattern] = free[space].get(pattern, 0) + bins

    for n in sorted(counts, reverse=True):
        left = counts[n]
        at = bisect.bisect_left(spaces, n)
        old = [(s, p, b) for s in spaces[at:] for p, b in free[s].items()]
        for space, pattern, bins in old:
            if not left:
                break
            each = space // n
            full, rest = divmod(left, each)
            used = min(bins, full)
            part = 1 if used < bins and full < bins and rest else 0
            free[space][pattern] -= used + part
            if not free[space][pattern]:
                del free[space][pattern]
            if used:
                add(pattern + (n,) * each, space - n * each, used)
                left -= used * each
            if part:
                add(pattern + (n,) * rest, space - n * rest, 1)
                left -= rest
        if left:
            each = capacity // n
            full, rest = divmod(left, each)
            if full:
                add((n,) * each, capacity - n * each, full)
            if rest:
                add((n,) * rest, capacity - n * rest, 1)
    return [(p, b) for s in spaces for p, b in free[s].items()]


def fillings(lengths: list[int], counts: dict[int, int], space: int, limit: int = FILLINGS) -> list[tuple[int, ...]]:
    """Undominated ways to fill ``space`` from the remaining lengths (ascending
    list), best filled first.  A filling is dominated if a longer item that is
    left over could take the place of one in it."""
    found: list[tuple[int, ...]] = []
    steps = 0

    def undominated(chosen: list[int], slack: int) -> bool:
        for k, n in enumerate(chosen):
            if k and chosen[k - 1] == n:
                continue
            up = bisect.bisect_right(lengths, n)
            while up < len(lengths) and lengths[up] <= n + slack:
                longer = lengths[up]
                if counts[longer] > chosen.count(longer):
                    return False
                up += 1
        return True

    def grow(chosen: list[int], space: int, top: int) -> bool:
        """True once a perfect filling is found: it dominates the rest."""
        nonlocal steps
        steps += 1
        at = min(bisect.bisect_right(lengths, space), top) - 1
        fits = False
        while at >= 0 and steps < _STEPS:
            n = lengths[at]
            if counts[n] > chosen.count(n):
                fits = True
                chosen.append(n)
                done = (space == n and (found.append(tuple(chosen)) or True)) or grow(chosen, space - n, at + 1)
                chosen.pop()
                if done:
                    return True
                if len(found) >= 4 * limit:
                    return False
                if n * 2 < space and len(chosen) >= 3:
                    break                       # deep levels: the longest that fits is enough
            at -= 1
        if not fits and chosen and undominated(chosen, space):
            found.append(tuple(chosen))
        return False

    if grow([], space, len(lengths)):
        return [found[-1]]
    found.sort(key=lambda f: (-sum(f), len(f)))
    return found[:limit] or [()]


def pack(counts: dict[int, int], capacity: int, max_nodes: int = MAX_NODES) -> list[Pattern]:
    """Patterns holding all items of a histogram ``length -> count``."""
    counts = {n: c for n, c in counts.items() if c > 0}
    if any(n <= 0 or n > capacity for n in counts):
        raise ValueError("lengths must lie in 1..capacity")
    best = best_fit(counts, capacity)
    best_bins, bound = sum(b for _, b in best), lower_bound(counts, capacity)
    if best_bins <= bound:
        return best
    total = sum(n * c for n, c in counts.items())
    allowed = lambda bins: bins * capacity - total          # noqa: E731  waste of a packing with so many bins
    left, lengths = dict(counts), sorted(counts)
    chosen: list[Pattern] = []
    used = waste = nodes = 0
    stack: list[tuple] = []          # (options still to try, patterns, bins and waste before them)

    def take(pattern: tuple[int, ...]) -> None:
        nonlocal used, waste
        bins = min(left[n] // pattern.count(n) for n in set(pattern))
        for n in set(pattern):
            left[n] -= bins * pattern.count(n)
            if not left[n]:
                del lengths[bisect.bisect_left(lengths, n)]
        chosen.append((pattern, bins))
        used, waste = used + bins, waste + bins * (capacity - sum(pattern))

    def undo() -> None:
        nonlocal used, waste
        pattern, bins = chosen.pop()
        for n in set(pattern):
            if not left[n]:
                bisect.insort(lengths, n)
            left[n] += bins * pattern.count(n)
        used, waste = used - bins, waste - bins * (capacity - sum(pattern))

    while nodes < max_nodes:
        nodes += 1
        if not lengths and used < best_bins:
            best, best_bins = list(chosen), used
            if best_bins <= bound:
                break
        if lengths and waste <= allowed(best_bins - 1):
            first = lengths[-1]
            left[first] -= 1
            options = fillings(lengths, left, capacity - first)
            left[first] += 1
            stack.append(([(first, *f) for f in options][::-1], len(chosen)))
        while stack and not stack[-1][0]:
            stack.pop()
            if chosen and stack:
                undo()
        if not stack:
            break
        while len(chosen) > stack[-1][1]:
            undo()
        take(stack[-1][0].pop())
    return best
